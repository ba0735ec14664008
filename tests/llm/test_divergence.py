import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, lang string, source string, text string"


def brute(rows, least=30, top=50):
    """Dense weights of every kept term in every group, all pairs of sources compared term by term."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        groups.add((lang, source))
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, k in docs[lang].items() if k >= least]
        sources = [s for g, s in groups if g == lang]

        def weights(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: weights(n[lang, s]) for s in sources}
        q = weights(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            own = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pair), ("term", own)):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_given_table(spark, docs):
    want = brute([tuple(r) for r in docs.select("lang", "source", "text").collect()])
    assert result(D.audit(docs)) == want and {r[2] for r in want} == {"pair", "term"}


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed):
    """Few terms and small counts (equal rows, shared paths, ties), sources without terms, nulls,
    repeated rows, clashing column names."""
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "éxy"] + ["Z9z", "one-two", "漢"]
    rows = [(i, rnd.choice(["en", "de", None]), rnd.choice([None, "s", "t", "u", "é", "z"]),
             " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(6)))) for i in range(120)]
    rows += rows[:7] + [(None, "en", "mute", None), (1, "solo", "one", "a"), (2, None, "x", "... 12")]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("t")).withColumn("p", F.lit(0)).withColumn("n", F.lit(1))
    for least, top in ((1, 50), (4, 3), (10 ** 6, 50)):
        assert result(D.audit(table, least_docs=least, top_terms=top)) == brute([r[1:] for r in rows], least, top)


def test_tree_equals_direct_sums():
    """Sorted rows with multiplicities through the tree, whole or cut between tasks, against a sum
    over all terms; every node is paired with each ancestor once."""
    rnd = random.Random(3)
    none = {s: 100 + s for s in range(6)}
    rows = Counter(tuple((s, rnd.choice([150, 200])) for s in range(6) if rnd.random() < 0.6) for _ in range(300))
    want = Counter()
    for row, n in rows.items():
        for i, (b, pb) in enumerate(row):
            for a, pa in row[:i]:
                want[a, b] += n * (abs(pa - pb) - abs(pa - none[b]) - abs(none[a] - pb) + abs(none[a] - none[b]))
    for cuts in (1, 4):
        got = Counter()
        ordered = sorted(rows.items())
        for k in range(cuts):
            tree = D.PairSums()
            for row, n in ordered[k * len(ordered) // cuts:(k + 1) * len(ordered) // cuts]:
                s = np.array([x[0] for x in row], np.int64)
                tree.insert(s, np.array([x[1] for x in row], np.int64), s + 100, n)
            tree.close(0)
            for a, b, fix in tree.take():
                got[a, b] += fix
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_small_tables_of_held_terms(spark, docs, monkeypatch):
    """Counts do not depend on how often a task passes its terms on, nor on segments of long texts."""
    import pyarrow as pa
    text = "Ab c " * 400 + "é" * 900 + " ab"
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en", None]), pa.array(["s", "t", None]), pa.array([text, "ab ab x", ""])],
                                       ["lang", "source", "text"])

    def counted():
        total = Counter()
        for out in D._count_partition(iter([batch, batch])):
            for lang, source, term, n, k in zip(*(c.to_pylist() for c in out.columns)):
                total[lang, source, term] += n * 1000 + k
        return total

    want = counted()
    assert want["en", "s", "ab"] == 802 * 1000 + 2 and want["en", "s", "é" * 900] == 2002
    monkeypatch.setattr(D, "HELD_TERMS", 1)
    monkeypatch.setattr(D, "SEGMENT", 16)
    assert counted() == want


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    assert result(D.audit(odd_docs, least_docs=2)) == brute(rows, 2)
    assert D.audit(no_docs).count() == 0
