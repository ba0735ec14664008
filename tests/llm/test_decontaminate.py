import hashlib
import random
import re

import numpy as np
import pytest

from recsmith.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=10):
    """Every window of every item looked up at every place of every document."""
    spans = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            spans.setdefault(tuple(w[s:s + n]), set()).add("" if item is None else str(item))
    rows = []
    for doc, text in docs:
        w, hit, held = words(text), set(), set()
        for n in {len(x) for x in spans}:
            for s in range(len(w) - n + 1):
                found = spans.get(tuple(w[s:s + n]))
                if found:
                    hit.update(range(s, s + n))
                    held |= found
        rows.append((doc, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return sorted(rows, key=str)


def run(spark, docs, items, **kwargs):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, D.contamination(d, b, **kwargs).collect()), key=str)


def test_given_tables(spark, sf, docs):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = sorted(map(tuple, D.contamination(docs, items).collect()), key=str)
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                 [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got == want and any(r[5] for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_words(spark, seed):
    """Few different words: many shared spans of every length, ties of hashes, items of all lengths."""
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "é", "x1", "longer" * 15, "漢字"]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i % 7 or None, text(n)) for i, n in enumerate([0, 1, 2, 3, 5, 9, 10, 11, 14, 30, 60])]
    docs = [(i, text(rnd.randrange(40))) for i in range(60)] + [(99, items[-1][1] + " end " + items[-2][1])] * 2
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items[8:], window=14, gram=4) == brute(docs, items[8:], 14)


def test_long_texts_in_segments(monkeypatch):
    """Segments change nothing: word counts, places and fingerprints are those of one chunk."""
    rnd = random.Random(5)
    text = b" ".join(rnd.choice([b"ab", b"c", b"d" * 300, "ö".encode()]) for _ in range(4000)) + b"." * 3000 + b"z"
    full = np.full(1 << 13, 255, np.uint8)
    for levels, bitmap in (([3, 10], full), (list(range(1, 11)), None)):
        one, cut = D.Winnower(levels, 10, 5, bitmap), D.Winnower(levels, 10, 5, bitmap)
        n = one.texts([7], [text])
        monkeypatch.setattr(D, "CHUNK", 500)
        assert cut.texts([7], [text]) == n == [4001]
        monkeypatch.undo()
        place = lambda rows: {(fp, k, s + i, *w[i:i + k]) for _, fp, k, s, w in rows for i in range(len(w) - k + 1)}
        assert place(one.rows) == place(cut.rows) and len(place(one.rows)) == sum(4001 - k + 1 for k in levels if bitmap is not None or k == 10)


def test_every_shared_span_shares_a_fingerprint():
    rnd = random.Random(1)
    for _ in range(50):
        span = [str(rnd.randrange(50)) for _ in range(10)]
        pad = lambda: [str(rnd.randrange(50)) for _ in range(rnd.randrange(30))]
        prints = []
        for _ in range(2):
            w = D.Words([" ".join(pad() + span + pad()).translate({32: 0}).encode()])
            prints.append(set(D.winnow(w.hashes(), 10, 5)[1].tolist()))
        assert prints[0] & prints[1]


def test_odd_rows(spark, odd_docs, no_docs):
    long_item = "many words in one long text " * 3
    items = spark.createDataFrame([(1, long_item, "x"), (1, "é", "y"), (None, None, "z"), (2, "!!", "x"), (3, "A", "x")],
                                  "item_id long, text string, row string")
    got = sorted(map(tuple, D.contamination(odd_docs, items).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert D.contamination(no_docs, items).count() == 0
    clean = D.contamination(odd_docs, items.limit(0)).collect()
    assert len(clean) == odd_docs.count() and not any(r.n_hit or r.n_items or r.contaminated for r in clean)


def test_sparse_and_full_bitmaps_agree(spark, monkeypatch):
    """A bitmap too small for the benchmark lets more fingerprints through, never fewer."""
    rnd = random.Random(9)
    items = [(i, " ".join(str(rnd.randrange(3000)) for _ in range(40))) for i in range(50)]
    docs = [(i, " ".join(str(rnd.randrange(3000)) for _ in range(20)) + " " + items[i][1][5:120]) for i in range(50)]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    monkeypatch.setattr(D, "MAX_BITS", D.BUCKET)
    monkeypatch.setattr(D, "MIN_BITS", D.BUCKET)
    assert run(spark, docs, items) == want


def test_common_phrase_is_resolved_once(spark):
    """One phrase of all items in all documents: one class and one list of items, and one more for the
    documents that hold another window as well."""
    phrase = " ".join(f"p{i}" for i in range(12))
    items = [(i, f"own{i} {phrase}" if i else f"{phrase} then " + " ".join(f"w{j}" for j in range(10))) for i in range(40)]
    docs = [(i, f"x{i} {phrase} y{i}" + (" " + items[0][1] if i % 3 == 0 else "")) for i in range(300)]
    assert run(spark, docs, items) == brute(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    _, places, spans = D.occurrences(d, b)
    of, lists = D.items_by_class(places, spans)
    assert of.count() == 300 and sorted(r.n_items for r in lists.collect()) == [40, 40]
