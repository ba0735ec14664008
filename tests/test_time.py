"""Steps whose time is spent per row of users x lists: affinities, exclusions, bitmaps and moves of the candidates."""
import random

import pytest
from pyspark.sql import functions as F

from recsmith import catalog, session
from recsmith import params as P
from recsmith.functions import scoring as S
from recsmith.operators import candidates as C
from recsmith.operators import features as X
from recsmith.operators import recall as RC
from recsmith.operators import rerank as RR
from recsmith.plans import by_seed
from recsmith.sources.views import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def _plan(df, physical=True):
    run = df._jdf.queryExecution()
    return (run.executedPlan() if physical else run.optimizedPlan()).toString()


@pytest.mark.parametrize("large", [1.0, 3e9])
def test_affinity(spark, large):
    """the sums over all pairs of user and item, with repeated and null tags, of items with one tag, several and none, also
    where the sums need decimals; no search for each of the user's pairs."""
    rnd = random.Random(5)
    tags = [None, "a", "b", "c", "d"]
    user = [(u, k, rnd.choice(tags), rnd.randint(1, 99) / 7 * large) for u in range(6) for k in ("lan", "style", "other") for _ in range(u)]
    item = {(i, k, t): rnd.randint(-9, 99) / 13 for i in range(9) for k in ("lan", "style") for t in rnd.sample(tags, 1 if i % 2 else i // 2)}
    ua = spark.createDataFrame(user + [(None, "lan", "a", 1.0), (2, "lan", "a", None)], "user long, kind string, tag string, ratio double")
    ia = spark.createDataFrame([(*k, r) for k, r in item.items()] + [(3, "lan", "b", None), (None, "lan", "a", 1.0)], "item long, kind string, tag string, ratio double")
    cand = spark.createDataFrame([(u, i) for u in range(7) for i in range(10)] + [(None, 1), (1, None)], "user long, item long")

    own = ua.where((F.col("ratio") > P.AFFINITY_MIN) & ~((F.col("kind") == "style") & F.col("tag").isNull()))
    last = ia.groupBy("item", "kind", "tag").agg(F.max("ratio").alias("r")).select("item", F.col("kind").alias("k"), F.col("tag").alias("t"), "r")
    pairs = own.join(last, (F.col("kind") == F.col("k")) & F.col("tag").eqNullSafe(F.col("t")))
    units = F.sum(F.round(F.col("ratio") * F.col("r") * S.FIXED_SCALE).cast("decimal(28,0)")).cast("double") / S.FIXED_SCALE
    sums = {(r.user, r.item, r.kind): r.v for r in pairs.groupBy("user", "item", "kind").agg(units.alias("v")).collect()}
    got = X.with_affinity(cand, ua, ia)
    assert _rows(got, "user", "item", "lan", "style") == sorted(
        ((u, i, *((u is not None and sums.get((u, i, k))) or 0.0 for k in ("lan", "style"))) for u, i in map(tuple, cand.collect())), key=str)
    assert "array_position" not in _plan(got, False)


def test_whole_units(spark):
    """as ``round``, without the text of each number."""
    values = [0.49999999999999994, 0.5, -0.5, 1.5, 2.5, -2.5, 1e-9, 0.0, 4503599627370495.5, -4503599627370494.5, 123456789.49999999, None]
    x = spark.createDataFrame([(v,) for v in values], "x double").select(S.whole_units(F.col("x")).alias("a"), F.round("x").alias("b"))
    assert all(r.a == r.b for r in x.collect())
    y = spark.createDataFrame([(v,) for v in [1e9, 3e14, -7.123, 0.1, None]], "x double").select(S.fixed(F.col("x")).alias("a"), F.round(F.col("x") * S.FIXED_SCALE).cast("decimal(28,0)").alias("b"))
    assert all(r.a == r.b for r in y.collect())


def test_exclusions_are_looked_up_once(spark, shuffled):
    """neither a join nor a filter searches the entries of a head; lists that hold an item twice keep enough entries."""
    lists = spark.createDataFrame([(s, i // 6 if s else i, i, i % 5 == 0) for s in range(3) for i in range(60)] + [(1, None, 99, False)],
                                  "seed long, item long, pos long, _gated boolean")
    us = spark.createDataFrame([(u, s, s, 3) for u in range(6) for s in range(4)], "user long, seed long, i long, n_seeds long")
    excl = [(u, i) for u in range(1, 6) for i in range(u)]
    members = spark.createDataFrame([(2,), (3,)], "user long")
    gated = spark.createDataFrame([(0,)], "item long")
    arms = [(F.col("user") >= 0, lists)]
    got = C.headed_expansion(us, arms, "seed", (7, 4), spark.createDataFrame(excl, "user long, item long"), gated, members)
    rows = [tuple(r) for r in lists.collect()]
    want = [(u, s, p) for u in range(6) for s in range(3)
            for p in sorted(p for t, i, p, g in rows if t == s and (u in (2, 3) or not g) and (u, i) not in excl)[:7]]
    assert _rows(got, "user", "seed", "pos") == sorted(want, key=str)
    nodes = _plan(got, False).splitlines()
    assert not [x for x in nodes if ("Join" in x or " Filter " in x) and "array_contains" in x]


def test_bitmaps(spark):
    """a user's map of words is made once, not for each word."""
    cand = spark.createDataFrame([(u, i * 37) for u in range(4) for i in range(50 * u)], "user long, item long")
    got = RC.candidate_bitmaps(cand)
    bit = {r.item: r.b for r in cand.select("item", RC._bit(F.col("item")).alias("b")).distinct().collect()}
    for r in got.collect():
        assert {64 * k + b for k, w in enumerate(r["_bits"]) for b in range(64) if w >> b & 1} == {bit[37 * i] for i in range(50 * r.user)}
    assert not [x for x in _plan(got, False).splitlines() if "transform(" in x and "map_from_entries" in x]


@pytest.mark.parametrize("heavy", [False, True])
def test_seed_lists_lie_by_seed(spark, tmp_path, monkeypatch, heavy):
    """lines are moved once, by seed, and no step on a list moves it; the same lists where a seed is heavy."""
    lines = [(s, (s * 7 + k * k) % 23, 1.0 + k % 4) for s in range(6) for k in range(10 + 9 * s)] + [(None, 1, 2.0), (3, None, 2.0), (3, None, 1.0)]
    spark.createDataFrame(lines, "l_suppkey long, l_partkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    if heavy:
        monkeypatch.setattr(C, "HEAVY_ROWS", 3)
    x = Tables(spark, str(tmp_path)).seed_item()
    q = {}
    for s, i, n in lines:
        if s is not None:
            q[s, i] = q.get((s, i), 0) + n
    tot = {s: sum(n for (t, _), n in q.items() if t == s) for s in range(6)}
    want = []
    for s in range(6):
        order = sorted(((-n / tot[s], (i is not None, i or 0), i) for (t, i), n in q.items() if t == s))
        want += [(s, i, -n, p) for p, (n, _, i) in enumerate(order)]
    assert _rows(x, "seed", "item", "sim", "pos") == sorted(want, key=str)
    assert heavy or "Exchange" not in _plan(x.groupBy("seed").count())


def test_lists_that_no_arm_reads(spark):
    """a seed's list of an arm without a user of that arm is not made; the others are as before."""
    t = Tables(spark, SF)
    items = t.quality().select("item", (F.col("item") % 7 == 0).alias("_gated"))
    seeds = t.item_sim().select("item").distinct().where("item % 3 > 0").withColumn("_odd", F.col("item") % 3 == 1)
    seeds = seeds.unionByName(seeds.where("item % 2 = 0").withColumn("_odd", ~F.col("_odd")))
    for odd, whole, got in zip((True, False), t.open_lists(seeds.select("item"), items), t.open_lists(seeds, items)):
        read = seeds.where(F.col("_odd") == odd).select(F.col("item").alias("seed")).distinct()
        want = _rows(whole.join(read, "seed", "left_semi"), *got.columns)
        assert _rows(got, *got.columns) == want and 0 < len(want) < whole.count()


def test_reasons_of_the_seed_route(spark, shuffled):
    """F1: the lowest rank whose list holds the candidate; candidates and recalled rows meet by user, without a join on user and item."""
    rnd = random.Random(3)
    us = spark.createDataFrame([(u, s, k) for u in range(8) for k, s in enumerate(rnd.sample(range(9), 5))], "user long, seed long, i long")
    lists = spark.createDataFrame([(s, i) for s in range(8) for i in rnd.sample(range(50), 20)] + [(2, None)], "seed long, item long")
    cand = [(u, i, None if i == 4 else u + i / 7) for u in range(8) for i in range(0, 50, 3)] + [(1, None, 2.0)]
    merged = session.materialise(spark.createDataFrame(cand, "user long, item long, score double"), by="user")
    got = by_seed.reason_over_recalled(merged, us, lists)
    want = merged.join(us.join(lists, "seed").groupBy("user", "item").agg(F.min_by("seed", "i").alias("src")), ["user", "item"])
    assert _rows(got, "user", "item", "score", "src") == _rows(want, "user", "item", "score", "src") and got.count()
    assert not [x for x in _plan(got).splitlines() if "Exchange" in x and "item#" in x.split("hashpartitioning")[-1]]


def test_moves_of_the_scored_candidates(spark, shuffled):
    """scoring moves the candidates by item, by item and seed, and back by user, once each."""
    x = catalog.seed_inputs(Tables(spark, SF))
    cand = session.materialise(spark.createDataFrame([(u, i, 0.5, i % 3) for u in range(9) for i in range(30)], "user long, item long, score double, src long"), by="user")
    moved = [y for y in _plan(by_seed.score(cand, x, P.WEIGHTS, P.ITEM_WIDTH, P.DIVISOR, P.REMAINDER)).splitlines() if "Exchange hashpartitioning" in y]
    own = {c: f"{c}#{cand._jdf.queryExecution().analyzed().output().apply(k).exprId().id()}" for k, c in enumerate(cand.columns)}
    assert len([y for y in moved if own["item"] in y or own["user"] in y]) == 3


def test_first_ranks_of_the_head(spark):
    """the first ranks are the same when rows behind head and wanted ranks are dropped first."""
    df = spark.createDataFrame([(u, i, (i * 37 % 101) / (u + 1)) for u in range(4) for i in range(80)], "user long, item long, score double")
    boost, treated = (F.col("item") % 5) * 0.1, F.col("user") % 2 == 0
    for upto in (5, 20, 60):
        whole = RR.head_rerank(df, boost, treated, 20).where(F.col("rank") <= upto)
        assert _rows(RR.head_rerank(df, boost, treated, 20, upto=upto).where(F.col("rank") <= upto), *whole.columns) == _rows(whole, *whole.columns)
