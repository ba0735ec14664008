import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.llm import mixing, queries
from recsmith.session import materialise


def brute_rates(p, tokens, targets, rounds=20_000):
    """Projected gradient on every document for itself."""
    mass = (p * tokens[:, None]).sum(axis=0)
    want = np.array(targets) * mass[0] / targets[0]
    rate = np.ones(len(p))
    for _ in range(rounds):
        miss = ((p * (tokens * rate)[:, None]).sum(axis=0) - want) / mass
        rate = np.maximum(0, rate - (p @ miss + mixing.ANCHOR * (rate - 1)) / (1 + mixing.ANCHOR))
    return rate


def test_rates_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    p = np.round(rng.dirichlet([0.6, 0.3, 0.2], 300) * mixing.GRID) / mixing.GRID
    tokens = rng.integers(1, 500, 300).astype(float)
    df = materialise(spark.createDataFrame([(i, int(t), x.tolist()) for i, (x, t) in enumerate(zip(p, tokens))],
                                           "doc_id long, n_tokens long, posterior array<double>"))
    targets = {"good": 0.8, "poor": 0.15, "toxic": 0.05}
    got = df.join(mixing.rates(df, list(mixing.DOMAINS), targets), "posterior").orderBy("doc_id").collect()
    rate = np.array([r["rate"] for r in got])
    want = brute_rates(p, tokens, list(targets.values()))
    assert rate.min() >= 0
    assert rate == pytest.approx(want, abs=0.02)
    totals = (p * (tokens * rate)[:, None]).sum(axis=0)
    assert totals / totals.sum() == pytest.approx(list(targets.values()), abs=0.01)


def test_query_meets_the_targets(spark):
    mid = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op10_mixing"](spark, mid)
    ids = {r[0] for r in spark.read.parquet(f"{mid}/documents.parquet").select("doc_id").collect()}
    got = rows.collect()
    assert len(got) == len(ids) and {r["doc_id"] for r in got} == ids
    total = {d: sum(r[f"p_{d}"] * r["n_tokens"] * r["rate"] for r in got) for d in mixing.DOMAINS}
    for d, share in mixing.TARGETS.items():
        assert total[d] / sum(total.values()) == pytest.approx(share, abs=0.02)
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in got)
    labels = spark.read.parquet(f"{mid}/labels.parquet").select("doc_id", mixing.label_domain().alias("domain"))
    best = F.expr("CASE WHEN p_good >= greatest(p_poor, p_toxic) THEN 'good' WHEN p_poor >= p_toxic THEN 'poor' ELSE 'toxic' END")
    right = rows.join(labels, "doc_id").agg(F.avg((best == F.col("domain")).cast("int"))).first()[0]
    assert right > 0.85


def test_tokens_are_words(spark, odd_docs):
    model = mixing.Classifier(list(mixing.DOMAINS), [0.0, 0.0, 0.0], {})
    rows = mixing.memberships(odd_docs, model).collect()
    plain = odd_docs.collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(
        len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in plain)
    assert all(r["posterior"] == pytest.approx([1 / 3] * 3, abs=0.002) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, "good"), (1, "poor"), (6, "poor"), (None, "good"), (7, None)],
                                   "doc_id long, domain string")
    rows = mixing.mix(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["rate"] >= 0 and r["copies"] >= 0 for r in rows)
    assert mixing.mix(no_docs, labels).count() == 0
    assert mixing.mix(odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op10_mixing"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_small_posteriors_are_held_exactly(spark):
    """Posteriors far below a grid step sum to 1, count in the totals and keep their domain in the fit."""
    model = mixing.Classifier(list(mixing.DOMAINS), [0.0, -3.0, float(np.log(4e-4))], {"odd": [0.0, 1.0, 0.6]})
    df = spark.createDataFrame([(i, "plain text " * 20 + ("odd" if i % 3 else "")) for i in range(60)], "doc_id long, text string")
    member = materialise(mixing.memberships(df, model))
    rows = member.collect()
    score = np.array([[0.0, -3.0, np.log(4e-4)] if r["doc_id"] % 3 == 0 else [0.0, -2.0, np.log(4e-4) + 0.6] for r in rows])
    # the traits of the text are not listed, so only the word speaks
    want = np.exp(score) / np.exp(score).sum(axis=1, keepdims=True)
    p = np.array([r["posterior"] for r in rows])
    assert p == pytest.approx(want, rel=1e-9) and p.max(axis=0)[2] < 1e-3
    targets = {"good": 0.9, "poor": 0.099, "toxic": 0.001}
    cell = {tuple(r["posterior"]): r["rate"] for r in mixing.rates(member, list(mixing.DOMAINS), targets).collect()}
    rate = np.array([cell[tuple(np.round(x * mixing.GRID) / mixing.GRID)] for x in p])
    tokens = np.array([float(r["n_tokens"]) for r in rows])
    assert rate == pytest.approx(brute_rates(p, tokens, list(targets.values()), mixing.ROUNDS), rel=0.02)


def test_query_meets_each_target_by_exact_posteriors(spark):
    got = queries.QUERIES["op10_mixing"](spark, "/root/testdata/sf0.01").collect()
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in got])
    assert p.sum(axis=1) == pytest.approx(np.ones(len(p)), abs=1e-9)
    total = (p * np.array([r["n_tokens"] * r["rate"] for r in got])[:, None]).sum(axis=0)
    for share, want in zip(total / total.sum(), mixing.TARGETS.values()):
        assert share == pytest.approx(want, rel=0.05)


def test_copies_equal_brute_force(spark):
    """Limits of the strata against a plain loop over their documents in the order of their draws."""
    rng = np.random.default_rng(11)
    rows = [(i, int(t), rng.dirichlet([1.0, 0.5, 0.3]).tolist(), float(r))
            for i, (t, r) in enumerate(zip(rng.integers(0, 4000, 700), rng.choice([0.0, 0.13, 0.5, 0.55, 0.997, 1.0, 2.31], 700)))]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>, rate double")
    drawn = materialise(mixing.strata(df, "doc_id"))
    limit = {tuple(r[c] for c in mixing.STRATUM): r["_limit"] for r in mixing.draw_limits(drawn).collect()}
    groups = {}
    for r in drawn.collect():
        assert r["_lead"] == int(np.argmax(r["posterior"])) + 1
        if r["_part"] > 0:
            groups.setdefault(tuple(r[c] for c in mixing.STRATUM), []).append((int(r["_draw"] * mixing.BINS), r["_part"], r["_draw"]))
    assert set(limit) == set(groups)
    for lead in (1, 2, 3):
        run, total = 0.0, 0
        for key in sorted((k for k in groups if k[0] == lead), key=lambda k: (-k[1], k[2])):
            want = sum(x[1] for x in groups[key])
            copies = int(np.floor(run + want + 0.5)) - int(np.floor(run + 0.5))
            run, total = run + want, total + copies
            bins = sorted(x[0] for x in groups[key])
            ends = [(abs(copies), 0.0)] + [(abs(sum(b <= e for b in bins) - copies), (e + 1) / mixing.BINS) for e in bins]
            assert limit[key] == pytest.approx(min(ends)[1], abs=1e-12)
            # nobody is drawn beyond the shared slice of a limit
            assert abs(sum(x[2] < limit[key] for x in groups[key]) - copies) <= max(bins.count(b) for b in bins)
        assert abs(total - run) <= 0.5 + 1e-6


def test_copies_meet_the_targets(spark):
    """Tokens as copied, not as expected, within a tenth of each target on a table of 10,000 documents."""
    got = queries.QUERIES["op10_mixing"](spark, "/root/testdata/sf0.1").collect()
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in got])
    total = (p * np.array([r["n_tokens"] * r["copies"] for r in got], float)[:, None]).sum(axis=0)
    for share, want in zip(total / total.sum(), mixing.TARGETS.values()):
        assert share == pytest.approx(want, rel=0.1)


def test_one_hot_id(spark):
    """A third of all rows of one id: equal rows, equal copies; the other documents keep their rates."""
    rows = [(7 if i % 3 == 0 else 1000 + i, "ordinary words of some text " * 8 + (f"word{i}" if i % 3 else "")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1001, "good"), (1004, "poor"), (1007, "toxic")], "doc_id long, domain string")
    out = mixing.mix(df, labels).collect()
    assert len(out) == 300 and len({r["copies"] for r in out if r["doc_id"] == 7}) == 1
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in out)
