import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from recsmith.llm import lattice_lm as lm
from recsmith.llm import queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lm.read_vocabulary(PATH)


def segmentations(word, pieces):
    """Every way to cut a marked word into pieces or bytes of unknown characters."""
    number = {p: i for i, p in enumerate(pieces.pieces) if p and i not in set(pieces.byte_ids.values()) and lm.MARK not in p[1:]}
    word = lm.MARK + word
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        if all(p in number or len(p) == 1 for p in parts):
            yield [i for p in parts for i in ([number[p]] if p in number else [pieces.byte_ids[b] for b in p.encode()])]


WORDS = ["the", "ciónñ", "漢字🙂", "a", "thndstnd", "inßverbe", "▁▁a", "zzz"]


def test_forward_equals_all_segmentations(vocabulary):
    want = [math.log(sum(math.exp(sum(vocabulary.weight[i] for i in s)) for s in segmentations(w, vocabulary)))
            for w in WORDS]
    assert lm.word_scores(vocabulary, WORDS) == pytest.approx(want, abs=1e-9)


def test_expected_counts_equal_all_segmentations(vocabulary):
    count = np.arange(1.0, len(WORDS) + 1)
    got = np.zeros(len(vocabulary.weight))
    for pick, codes in lm.batches_of(WORDS):
        got += vocabulary.expected(codes, count[pick])
    want = np.zeros(len(vocabulary.weight))
    for w, n in zip(WORDS, count):
        ways = list(segmentations(w, vocabulary))
        p = np.array([math.exp(sum(vocabulary.weight[i] for i in s)) for s in ways])
        for s, q in zip(ways, p / p.sum()):
            for i in s:
                want[i] += n * q
    assert got == pytest.approx(want, abs=1e-9)


def test_very_long_word(vocabulary):
    assert np.isfinite(lm.word_scores(vocabulary, ["ab" * 5000, ""])).all()


def test_query(spark, sf, texts):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op4_lattice_score"](spark, sf).collect()}
    assert set(rows) == set(texts)
    tokens = {i: [*t.encode().lower().split(), b""] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = rows[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
    # the score, with the same fit on one machine
    pieces = lm.read_vocabulary(PATH)
    words = sorted(w for w in counts if w)
    c = np.array([counts[w] for w in words], dtype=float)
    first = pieces.weight
    for _ in range(lm.ROUNDS):
        uses = np.exp(first) * len(first)
        for pick, codes in lm.batches_of([w.decode() for w in words]):
            uses += pieces.expected(codes, c[pick])
        uses[-1] += counts[b""]
        with np.errstate(divide="ignore"):
            pieces = lm.Pieces(pieces.pieces, pieces.byte_ids, np.log(uses / uses.sum()))
    assert np.exp(pieces.weight).sum() == pytest.approx(1)
    every = sorted({w for ws in tokens.values() for w in ws if w})
    score = dict(zip(every, lm.word_scores(pieces, [w.decode() for w in every])))
    for i, ws in tokens.items():
        want = (sum(score[w] for w in ws if w) + pieces.weight[-1]) / math.log(10)
        assert rows[i]["score"] == pytest.approx(want, rel=1e-9)


def test_fitting_raises_the_held_out_likelihood(spark, docs):
    plain = lm.score_documents(docs, PATH, rounds=0).filter("held_out").agg({"score": "sum"}).first()[0]
    fitted = lm.score_documents(docs, PATH).filter("held_out").agg({"score": "sum"}).first()[0]
    assert fitted > plain


def test_odd_rows_and_joined_words(odd_docs, no_docs):
    rows = lm.score_documents(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (3, 4, 5))
    joined = lm.score_documents(odd_docs, PATH, frequent=1).collect()  # every word goes through the join
    key = lambda r: (r["doc_id"] or -1, r["n_tokens"], r["n_known"])
    for a, b in zip(sorted(rows, key=key), sorted(joined, key=key)):
        assert key(a) == key(b)
        assert a["score"] == pytest.approx(b["score"]) and a["base_score"] == pytest.approx(b["base_score"])
    assert lm.score_documents(no_docs, PATH).count() == 0


def test_long_words_take_the_same_sums(vocabulary, monkeypatch):
    words = ["thndst" * 20, "ab漢🙂x" * 30, "0123456789" * 15]
    short = lm.word_scores(vocabulary, words)
    uses = sum(vocabulary.expected(codes, np.full(len(pick), 2.0)) for pick, codes in lm.batches_of(words))
    monkeypatch.setattr(lm, "LONG_WORD", 10)
    assert lm.word_scores(vocabulary, words) == pytest.approx(short, rel=1e-12)
    again = sum(vocabulary.expected(codes, np.full(len(pick), 2.0)) for pick, codes in lm.batches_of(words))
    assert again == pytest.approx(uses, abs=1e-8)
