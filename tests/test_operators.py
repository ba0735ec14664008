"""Hand-worked rows per operator: cap after exclusion, budget crossing, ties, re-rank windows."""
import math

from pyspark.sql import functions as F

from recsmith.functions import scoring as S
from recsmith.operators import candidates as C
from recsmith.operators import filters as FL
from recsmith.operators import recall as RC
from recsmith.operators import rerank as RR
from recsmith.sources import text as TX


def test_cap_counts_only_eligible(spark):
    exp = spark.createDataFrame([(1, 10, i, i, 3) for i in range(6)], "user long, seed long, item long, pos long, n_seeds long")
    excl = spark.createDataFrame([(1, 0), (1, 1)], "user long, item long")
    capped = C.per_seed_cap(FL.exclude_pairs(exp, excl), 2, 1, 10)
    assert sorted(r.item for r in capped.collect()) == [2, 3]


def test_cap_switches_with_many_seeds(spark):
    rows = [(1, s, s * 10 + i, i, 10) for s in range(10) for i in range(5)]
    exp = spark.createDataFrame(rows, "user long, seed long, item long, pos long, n_seeds long")
    capped = C.per_seed_cap(exp, 3, 1, 10)
    assert capped.count() == 10


def test_budget_keeps_crossing_seed_whole(spark):
    # seed 0: items 1,2 ; seed 1: items 2,3,4 ; seed 2: item 5.  budget 3
    rows = [(1, 0, 1), (1, 0, 2), (1, 1, 2), (1, 1, 3), (1, 1, 4), (1, 2, 5)]
    df = spark.createDataFrame(rows, "user long, i long, item long")
    kept = C.seed_budget(df, 3)
    assert sorted((r.i, r.item) for r in kept.collect()) == [(0, 1), (0, 2), (1, 2), (1, 3), (1, 4)]


def test_bounded_expansion_is_exact(spark):
    lists = spark.createDataFrame([(5, i, i, 1.0) for i in range(50)], "seed long, item long, pos long, sim double")
    users = spark.createDataFrame([(1, 5, 0, 3)], "user long, seed long, i long, n_seeds long")
    excl = spark.createDataFrame([(1, 0), (1, 2), (1, 40)], "user long, item long")
    gated = spark.createDataFrame([(1,), (3,)], "item long")
    nl = C.renumber(lists, "seed", gated=gated)
    exp = C.bounded_expansion(users, nl, "seed", F.lit(4), excl, members=spark.createDataFrame([], "user long"))
    capped = C.per_seed_cap(FL.exclude_pairs(exp, excl), 4)
    # non-member: gated 1,3 removed; excluded 0,2 removed -> first 4 eligible are 4,5,6,7
    assert sorted(r.item for r in capped.collect()) == [4, 5, 6, 7]


def test_harmonic_and_step_diversity(spark):
    df = spark.createDataFrame([(1, 1, 0.9, "a"), (1, 2, 0.8, "a"), (1, 3, 0.7, "a"), (1, 4, 0.6, "b")],
                               "user long, item long, score double, src string")
    h = {r.item: r.score for r in RR.diversity_harmonic(df).collect()}
    assert math.isclose(h[2], 0.4) and math.isclose(h[3], 0.7 / 3) and math.isclose(h[4], 0.6)
    s = {r.item: r.score for r in RR.diversity_step(df).collect()}
    assert math.isclose(s[2], 0.8) and math.isclose(s[3], 0.7 / 3.0)


def test_quota_interleave_round_robin(spark):
    rows = [(1, i, 1.0 - i / 10, "a") for i in range(4)] + [(1, 10 + i, 0.5 - i / 10, "b") for i in range(4)]
    df = spark.createDataFrame(rows, "user long, item long, score double, src string").withColumn("n_reasons", F.lit(2))
    out = RR.top_n(RR.quota_interleave(df, 4), 4).orderBy("rank").collect()
    # quota = clamp(4 div 2, 2, 5) = 2 -> a0, a1, b0, b1 kept; a1, b1 pushed below the heads
    assert [r.item for r in out] == [0, 10, 1, 11]


def test_head_rerank_only_moves_head(spark):
    rows = [(1, i, 1.0 - i / 100, 0.0) for i in range(5)]
    df = spark.createDataFrame(rows, "user long, item long, score double, boost double")
    out = RR.head_rerank(df, F.when(F.col("item") == 2, F.lit(0.5)).otherwise(F.lit(0.0)), F.lit(True), head_n=3)
    order = [r.item for r in out.orderBy("rank").collect()]
    assert order == [2, 0, 1, 3, 4]


def test_packed_list_reader_rules(spark):
    df = spark.createDataFrame([(1, "10:0.5,bad,11:,a:b:0.25"), (2, "20:0.1,21:xx"), (3, "30:1.0")],
                               "key long, packed string")
    out = TX.explode_weighted_list(df, "key", "packed", "last")
    got = sorted((r.key, r.id, r.score, r.pos) for r in out.collect())
    assert got == [(1, "10", 0.5, 0), (1, "a:b", 0.25, 1), (3, "30", 1.0, 0)]
    first = TX.explode_weighted_list(spark.createDataFrame([(1, "x:1:2,:3,y:4")], "key long, packed string"),
                                     "key", "packed", "first")
    assert sorted((r.id, r.score) for r in first.collect()) == [("y", 4.0)]


def test_vectors_and_json(spark):
    df = spark.createDataFrame([("1,0,x,1", '{"avgPubTime": 12, "score": 0.5}')], "bits string, j string")
    r = df.select(TX.parse_bit_vector(F.col("bits")).alias("b")).collect()[0]
    assert r.b == [1, 0, 0, 1]
    j = TX.parse_json_attributes(df.select("j"), "j").collect()[0]
    assert (j.avg_pub_time, j.score) == (12, 0.5)


def test_scoring_guards(spark):
    df = spark.createDataFrame([(float("inf"), 0.0), (None, 1.0), (0.001, 0.0)], "money double, click double")
    b = [r.b for r in df.select(S.pay_boost(F.col("money"), F.col("click"), 80.0, 0.0, 0.12).alias("b")).collect()]
    assert b[0] == 0.0 and b[1] == 0.0 and b[2] > 0
    x = spark.createDataFrame([([1.0, 2.0], [1, 1, 1])], "w array<double>, f array<int>")
    assert x.select(S.dense_lr(F.col("w"), F.col("f"))).collect()[0][0] == -1.0
    h = spark.range(1).select(S.half_up(F.lit(0.00005), 4).alias("h")).collect()[0].h
    assert h == 0.0001


def test_affinity_threshold_and_ignored(spark):
    ua = spark.createDataFrame([(1, "style", "unknow", 0.5), (1, "style", "rock", 0.02), (1, "lan", "en", 0.5)],
                               "user long, kind string, tag string, ratio double")
    assert [r.tag for r in FL.affinity_threshold(ua).collect()] == ["en"]


def test_distributed_rank_splits_hot_group(spark):
    from pyspark.sql import Window
    rows = [(0, s, float(s % 97)) for s in range(3000)] + [(u, s, float(s)) for u in range(1, 6) for s in range(5)]
    df = spark.createDataFrame(rows, "user long, seed long, score double")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = C.seed_rank(df)
        # the hot user's rows are range-partitioned over several slices
        keyed = df.repartitionByRange(6, F.col("user"), F.desc("score"), F.col("seed"))
        parts = keyed.where("user = 0").select(F.spark_partition_id()).distinct().count()
        w = Window.partitionBy("user").orderBy(F.desc("score"), "seed")
        want = df.withColumn("i", (F.row_number().over(w) - 1).cast("long"))
        got = r.select("user", "seed", "score", "i")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert r.where("user = 0").agg(F.max("n_seeds")).collect()[0][0] == 3000
        assert parts >= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_budget_matches_row_walk(spark):
    import random
    rnd = random.Random(7)
    rows = [(u, i, rnd.randrange(40)) for u in range(3) for i in range(25) for _ in range(6)]
    df = spark.createDataFrame(rows, "user long, i long, item long").dropDuplicates(["user", "i", "item"])
    kept = {(r.user, r.i, r.item) for r in C.seed_budget(df, 20).collect()}
    want = set()
    for u in range(3):
        seen = set()
        for i in range(25):
            if len(seen) >= 20:
                break
            items = {it for (uu, ii, it) in set(rows) if uu == u and ii == i}
            want |= {(u, i, it) for it in items}
            seen |= items
    assert kept == want


def test_renumber_numbers_each_variant(spark):
    rows = [(k, i, i * 7 % 40, i * 10) for k in (1, 2) for i in range(40)]  # positions unique per list
    lists = spark.createDataFrame(rows, "seed long, item long, pos long, create_days int")
    keep = spark.createDataFrame([(i,) for i in range(40) if i % 5], "item long")
    gated = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "item long")

    def want(entries):
        return {item: n for n, (pos, item) in enumerate(sorted((i * 7 % 40, i) for i in entries))}

    def got(df, variant):
        return {r.item: r.fpos for r in df.where((F.col("seed") == 1) & (F.col("variant") == variant)).collect()}

    kept = [i for i in range(40) if i % 5]
    a = C.renumber(lists, "seed", keep=keep, gated=gated)
    assert got(a, 1) == want(kept) and got(a, 0) == want([i for i in kept if i % 3])
    limits = spark.createDataFrame([(7, 200), (8, 200), (9, 50)], "user long, max_days int")
    b = C.renumber(lists, "seed", keep=keep, limits=limits)
    assert got(b, -1) == want(kept) and got(b, 200) == want([i for i in kept if i <= 20])
    assert got(b, 50) == want([i for i in kept if i <= 5])
    assert got(C.renumber(lists, "seed"), -1) == want(range(40))


def test_expansion_counts_within_the_age_limit(spark):
    lists = spark.createDataFrame([(5, i, i, 400 if i < 60 else 10) for i in range(100)],
                                  "seed long, item long, pos long, create_days int")
    limits = spark.createDataFrame([(1, 100)], "user long, max_days int")
    users = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "user long, seed long")
    excl = spark.createDataFrame([(1, 61), (2, 0)], "user long, item long")
    exp = C.bounded_expansion(users, C.renumber(lists, "seed", limits=limits), "seed", F.lit(2), excl, limits=limits)
    capped = C.per_seed_cap(FL.exclude_pairs(FL.user_age_limit(exp, limits), excl), 2)
    assert sorted((r.user, r.item) for r in capped.collect()) == [(1, 60), (1, 62), (2, 1), (2, 2)]


def test_seed_without_a_list_never_counts(spark):
    """A played and liked item without a list of the user's arm leaves no gap in the ranks."""
    seeds = spark.createDataFrame([(1, 10, 9.0), (1, 11, 5.0), (2, 11, 4.0), (2, 12, 3.0), (3, 11, 2.0), (3, 12, 1.0)],
                                  "user long, seed long, score double")
    base = spark.createDataFrame([(11, 100), (12, 101)], "item long, item2 long")
    alt = spark.createDataFrame([(12, 102), (10, 103)], "item long, item2 long")
    other = spark.createDataFrame([(3,)], "user long")
    r = C.seed_rank(RC.arm_seeds(seeds, base, alt, other))
    # 10 has no base list; 11 has no alternative list (user 2, and user 3 by exception)
    assert sorted((x.user, x.seed, x.i, x.n_seeds) for x in r.collect()) == [(1, 11, 0, 1), (2, 12, 0, 1), (3, 12, 0, 1)]


def test_long_packed_lists_stay_whole(spark):
    packed = ",".join(f"{i}:{i}" for i in range(2500))
    df = spark.createDataFrame([(1, packed)], "key long, packed string")
    for at in ("first", "last"):
        assert TX.explode_weighted_list(df, "key", "packed", at).count() == 2500
        assert TX.explode_weighted_list(df, "key", "packed", at, max_n=2000).count() == 2000
    # the bounded reader stops before a bad score behind its last entry
    bad = spark.createDataFrame([(1, packed + ",9:x")], "key long, packed string")
    assert TX.explode_weighted_list(bad, "key", "packed", "last").count() == 0
    assert TX.explode_weighted_list(bad, "key", "packed", "last", max_n=2000).count() == 2000


def test_sums_do_not_depend_on_row_order(spark):
    rows = [(1, 1, x) for x in (0.1, 0.2, 0.3, 1e-9, 0.7)]
    a = C.merge_sum(spark.createDataFrame(rows, "user long, item long, score double")).first().score
    b = C.merge_sum(spark.createDataFrame(rows[::-1], "user long, item long, score double").repartition(5)).first().score
    assert a == b and math.isclose(a, 1.300000001, abs_tol=1e-8)


def test_rejected_rows_and_nonfinite_pay(spark):
    df = spark.createDataFrame([("1", 1.0, 0.0), ("x", float("inf"), 0.0), (None, 0.5, 0.1)],
                               "id string, money double, click double")
    good, bad = TX.split_valid(df, F.col("id").try_cast("long").isNotNull())
    assert (good.count(), bad.count()) == (1, 2)
    n = df.where(S.nonfinite_pay(F.col("money"), F.col("click"), 80.0, 0.0)).count()
    assert n == 1


def test_active_threshold_zero_days(spark):
    import datetime as dt
    act = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2024, 1, 30, 5))],
                                "user long, last_ts timestamp")
    assert FL.active_users(act, dt.datetime(2024, 1, 31), 0).count() == 2
    assert [r.user for r in FL.active_users(act, dt.datetime(2024, 1, 31), 1).collect()] == [2]
