"""Repeated keys, observed counts, first lines, chunked lists, day folders, heavy keys, plans of the routes."""
import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from recsmith import catalog, session
from recsmith import params as P
from recsmith.operators import candidates as C
from recsmith.operators import features as X
from recsmith.operators import recall as RC
from recsmith.operators.keyed import POSITION, keyed_load
from recsmith.plans import by_liked, by_seed, by_tag
from recsmith.sources import lines as L
from recsmith.sources import text as TX
from recsmith.sources.views import Tables

SF = "/root/testdata/sf0.001"


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


# ---------------------------------------------------------------- repeated keys


def test_last_line_of_the_last_file_wins(spark, tmp_path):
    a = _write(tmp_path / "a.txt", ["(1,0.5,1)", "(2,0.5,1)", "(2,0.75,1)"])
    b = _write(tmp_path / "b.txt", ["(1,0.25,2)", "bad", "(3,1,1)", "(1,0.125,3)"])
    for paths in ([a, b], [b, a]):
        got = keyed_load(TX.read_lookup(spark, paths, L.pay), "item")
        assert sorted(tuple(r) for r in got.collect()) == [(1, 0.125, 3.0), (2, 0.75, 1.0), (3, 1.0, 1.0)]


def test_a_line_replaces_the_whole_item(spark, tmp_path):
    """Rates and tag ratios are maps per item: a later line drops the sources and tags it does not name."""
    r = _write(tmp_path / "rate.txt", ["9\ts1:x:0.1,s2:x:0.2", "8\ts1:x:0.3", "9\ts3:x:0.4,s3:x:0.5"])
    got = keyed_load(TX.read_lookup(spark, r, L.promoted_rate, 1), "item", "src")
    assert sorted(tuple(x) for x in got.collect()) == [(8, "s1", 0.3), (9, "s3", 0.5)]
    i = _write(tmp_path / "item.txt", ["8\ten:1\trock:0.5", "8\tfr:0.25,fr:0.75\t:1"])
    got = keyed_load(TX.read_lookup(spark, i, L.item_affinity), "item", "kind", "tag")
    assert [tuple(x) for x in got.collect()] == [(8, "lan", "fr", 0.75)]


def test_affinity_of_repeated_tags(spark):
    """User: each pair counts (or the last one); item: the last ratio of a tag."""
    cand = spark.createDataFrame([(1, 10), (2, 10)], "user long, item long")
    ua = spark.createDataFrame([(1, "style", "rock", 0.5, 1), (1, "style", "rock", 0.25, 2), (1, "lan", "rock", 0.5, 3)],
                               f"user long, kind string, tag string, ratio double, {POSITION} int")
    ia = spark.createDataFrame([(10, "style", "rock", 0.5, 2), (10, "style", "rock", 9.0, 1)],
                               f"item long, kind string, tag string, ratio double, {POSITION} int")
    got = {r.user: (r.lan, r.style) for r in X.with_affinity(cand, ua, ia).collect()}
    assert got == {1: (0.0, 0.375), 2: (0.0, 0.0)}
    got = {r.user: (r.lan, r.style) for r in X.with_affinity(cand, ua, ia, repeats="last").collect()}
    assert got == {1: (0.0, 0.125), 2: (0.0, 0.0)}


def _repeated(df, *keys):
    """Every row twice, the first time with other values."""
    values = [c for c in df.columns if c not in keys]

    def other(c):
        kind = dict(df.dtypes)[c]
        if kind.startswith("array"):
            return F.transform(c, lambda x: (x + 1).cast(kind[6:-1]))
        return (F.col(c) * 2 + 1).cast(kind)

    old = df.select(*keys, *[other(c).alias(c) for c in values], F.lit(0).alias(POSITION))
    return old.unionByName(df.withColumn(POSITION, F.lit(1)))


@pytest.mark.parametrize("route", ["seed", "tag", "liked"])
def test_routes_with_repeated_keys(spark, route):
    """Every lookup holds every key twice: the same lists come out."""
    t = Tables(spark, SF)
    keys = {"visited": ("user", "item"), "item_feat": ("item",), "user_feat": ("user",), "rate": ("item", "src"),
            "item_aff": ("item", "kind", "tag"), "pay": ("item",), "quality": ("item",), "profile": ("item",),
            "new_song_weight": ("user",), "user_max_age": ("user",)}
    inputs = {"seed": catalog.seed_inputs, "tag": catalog.tag_inputs, "liked": catalog.liked_inputs}[route](t)
    run = {"seed": lambda i: by_seed.recommend_by_seed(i, P.AS_OF, P.WEIGHTS, P.ITEM_WIDTH, P.DIVISOR, P.REMAINDER, P.REMAINDER_2,
                                                       P.ACTIVE_DAYS_P2, P.IMPRESS_WINDOW_P2),
           "tag": lambda i: by_tag.recommend_by_tag(i, P.AS_OF, P.WEIGHTS, P.WEIGHTS_AB, P.ITEM_WIDTH, P.DIVISOR, P.REMAINDER,
                                                    P.ACTIVE_DAYS_P3, P.IMPRESS_WINDOW_P3),
           "liked": lambda i: by_liked.recommend_by_liked(i, P.AS_OF, P.WEIGHTS, P.ITEM_WIDTH, P.DIVISOR, P.REMAINDER,
                                                          P.ACTIVE_DAYS_P4, P.IMPRESS_WINDOW_P4)}[route]
    # exclusion is by any visit of a pair, so only visits that exclude nothing are repeated with other values
    twice = {k: _repeated(getattr(inputs, k), *v) for k, v in keys.items() if getattr(inputs, k, None) is not None and k != "visited"}
    v = inputs.visited
    twice["visited"] = v.withColumn(POSITION, F.lit(1)).unionByName(v.withColumn("score", F.lit(0).cast("long")).withColumn(POSITION, F.lit(0)))
    want = sorted((tuple(r) for r in run(inputs).collect()), key=str)
    got = sorted((tuple(r) for r in run(dataclasses.replace(inputs, **twice)).collect()), key=str)
    assert want and got == want


def test_wrong_item_width_ends_the_job(spark):
    cand = spark.createDataFrame([(1, 10)], "user long, item long")
    feat = spark.createDataFrame([(10, [1, 0, 1])], "item long, bits array<int>")
    ok = cand.join(X.item_part(feat, {"zi": [1.0] * 59}, expected=3), "item", "left")  # 56 user weights, 3 of the item
    assert [(r.zi, r.n_bits) for r in ok.collect()] == [(2.0, 3)]
    with pytest.raises(Exception, match="feature width differs"):
        cand.join(X.item_part(feat, {"zi": [1.0] * 59}, expected=4), "item", "left").collect()


# ---------------------------------------------------------------- readers and sinks


def test_counts_come_with_the_rows(spark):
    """One cut per line and one scan for rows and counts."""
    lines = spark.createDataFrame([("s\trecommendclick\t7\t1\ta\t2024-01-05\tx",), ("short",), ("s\tsubscribe\tu\t1\t2024-01-05\tx",)],
                                  "value string")
    seen = Observation()
    rows = L.accepted(L.log(lines), seen)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert rows.count() == 1 and seen.get == {"n_lines": 3, "n_rejected": 2}
    assert tuple(L.rejects(L.log(lines)).first()) == (3, 2)


@pytest.mark.parametrize("size", ["200", "128m"])
def test_first_lines_of_a_folder(spark, tmp_path, size):
    """The order of files and lines, in many partitions and in one."""
    for k, n in enumerate([0, 7, 40, 0, 90]):
        _write(tmp_path / f"part-{k}.txt", [f"{k * 100 + i}\tx" for i in range(n)]) if n else (tmp_path / f"part-{k}.txt").write_text("")
    want = [100 + i for i in range(7)] + [200 + i for i in range(40)] + [400, 401, 402]
    conf = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parts = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        assert parts >= 4 if size == "200" else parts == 1
        assert sorted(r.id for r in TX.read_first_ids(spark, str(tmp_path)).collect()) == want
        assert TX.first_lines(spark, str(tmp_path), 1000).count() == 137
        assert TX.first_lines(spark, str(tmp_path), 0).count() == 0
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_chunked_lists_read_as_one(spark, tmp_path):
    rows = [(k, i, 1000 + i, i / 8) for k, n in ((1, 25), (2, 10), (3, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, pos long, id long, score double")
    packed = TX.pack_list(df, "key", "pos", F.col("id"), F.col("score"), chunk=10)
    assert packed.where(F.size(F.split("packed", ",")) > 10).count() == 0 and packed.count() == 5
    path = str(tmp_path / "packed")
    TX.write_lines(TX.chunked_lines(packed, "key"), path)
    for at in ("first", "last"):
        got = sorted((r.key, r.pos, int(r.id), r.score) for r in TX.read_packed(spark, path, at, chunked=True).collect())
        assert got == rows
        got = TX.read_packed(spark, path, at, max_n=12, chunked=True)
        assert {r.key: r["count"] for r in got.groupBy("key").count().collect()} == {1: 12, 2: 10, 3: 1}
    # skipped entries move what follows in later lines; a bad score empties the whole list, unless the reader stops before it
    bad = spark.createDataFrame([(1, 0, "5:1,x,6:2"), (1, 3, "7:3,8:y"), (2, 0, "5:1,6:2"), (2, 2, "7:3")],
                                "key long, offset long, packed string")
    read = lambda **k: sorted((r.key, r.id, r.pos) for r in TX.explode_weighted_list(bad, "key", "packed", offset="offset", **k).collect())
    assert read() == [(2, "5", 0), (2, "6", 1), (2, "7", 2)]
    assert read(max_n=3) == [(1, "5", 0), (1, "6", 1), (1, "7", 2), (2, "5", 0), (2, "6", 1), (2, "7", 2)]
    assert read(split_at="first") == [(1, "5", 0), (1, "6", 1), (1, "7", 2), (2, "5", 0), (2, "6", 1), (2, "7", 2)]


def test_a_day_can_be_run_again(spark, tmp_path):
    root, days = str(tmp_path / "out"), [dt.date(2024, 1, 28), dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
    df = spark.createDataFrame([(f"1\t{d.day}", d) for d in days[:2]], "value string, dt date")
    TX.write_days(df, root, days)
    as_of = dt.datetime(2024, 1, 31)
    read = lambda: sorted(r.item for r in TX.read_days(spark, root, "user long, item long", as_of, 1, 3, complete=True).collect())
    assert read() == [28, 29]  # the 30th is complete and empty
    untouched = sorted(p.name for p in (tmp_path / "out" / "dt=2024-01-28").iterdir())
    again = spark.createDataFrame([("1\t77", days[1]), ("1\t88", days[0])], "value string, dt date")
    TX.write_days(again, root, [days[1]])
    assert read() == [28, 77]
    assert sorted(p.name for p in (tmp_path / "out" / "dt=2024-01-28").iterdir()) == untouched
    (tmp_path / "out" / "dt=2024-01-29" / "_SUCCESS").unlink()  # as after a job that failed
    with pytest.raises(ValueError, match="2024-01-29"):
        read()
    assert TX.complete_days(spark, root, days) == [days[0], days[2]]


# ---------------------------------------------------------------- heavy keys


def test_heavy_keys_and_their_rank(spark, monkeypatch):
    rows = [(0, s, float(s % 97)) for s in range(4000)] + [(u, s, float(s)) for u in range(1, 60) for s in range(5)] + \
        [(None, s, float(s)) for s in range(3000)]
    df = spark.createDataFrame(rows, "user long, seed long, score double")
    w = Window.partitionBy("user")
    want = df.select("*", (F.row_number().over(w.orderBy(F.desc("score"), "seed")) - 1).cast("long").alias("i"),
                     F.count(F.lit(1)).over(w).alias("n_seeds"))
    assert C.heavy_keys(df, ["user"]) == []  # a plain window takes so few rows
    for floor in (100_000, 100):
        monkeypatch.setattr(C, "HEAVY_ROWS", floor)
        assert len(C.heavy_keys(df, ["user"])) == (0 if floor > 4000 else 2)
        got = C.seed_rank(df).select(want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_heavy_keys_at_many_partitions(spark, monkeypatch):
    """More shuffle partitions than the sketch can name keys, or than a table may have buckets."""
    df = spark.range(6000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("user"))
    monkeypatch.setattr(C, "HEAVY_ROWS", 100)
    changed = {"spark.sql.shuffle.partitions": "200000", "spark.sql.sources.bucketing.maxBuckets": "4"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        assert len(C.heavy_keys(df, ["user"])) == 1
        table = session.materialise(df, by="user")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert table.count() == 6000 and len(table.inputFiles()) == 4


# ---------------------------------------------------------------- plans of the routes


def test_bitmaps_keep_all_candidates(spark):
    rnd = random.Random(2)
    lists = spark.createDataFrame([(s, i) for s in range(30) for i in rnd.sample(range(3000), 300)], "seed long, item long")
    seeds = spark.createDataFrame([(u, s, k) for u in range(8) for k, s in enumerate(rnd.sample(range(30), 10))], "user long, seed long, i long")
    cand = seeds.join(lists, "seed").select("user", "item").distinct().where(F.pmod(F.xxhash64("user", "item"), F.lit(5)) == 0)
    want = seeds.join(lists, "seed").join(cand, ["user", "item"], "left_semi")
    got = RC.recalled_rows(seeds, lists, "seed", cand).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _exchanges(df, *needles):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange" in x and all(n in x for n in needles)]


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scoring_moves_no_vector(spark, shuffled):
    t = Tables(spark, SF)
    cand = t.visited().select("user", "item")
    scored = X.with_parts(cand, t.user_features(), t.item_features(), P.WEIGHTS)
    x = scored.join(X.item_part(t.item_features(), {"zi2": P.WEIGHTS_AB}), "item", "left")
    physical = x._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if "Exchange" in node.nodeName():
            found.append(node.schema().toDDL())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))
    walk(physical.initialPlan() if "AdaptiveSparkPlan" in physical.nodeName() else physical)
    assert len(found) >= 4 and not any("ARRAY" in s for s in found)


@pytest.mark.parametrize("route,stages", [("seed", by_seed), ("liked", by_liked)])
def test_stage_tables_are_bucketed_by_user(spark, shuffled, monkeypatch, route, stages):
    """From the caps on, no stage exchanges the user's rows again on user alone: budget, merge and reasons
    read bucketed tables.  What is exchanged are the lookups and the rows of the lists."""
    plans = []
    write = session.materialise

    def recorded(df, by=None):
        plans.append((by, _exchanges(df, "hashpartitioning(user")))
        return write(df, by)
    monkeypatch.setattr(stages, "materialise", recorded)
    t = Tables(spark, SF)
    inputs = {"seed": catalog.seed_inputs, "liked": catalog.liked_inputs}[route](t)
    args = (P.AS_OF, 1, (1, 14), 4)
    stages.candidates(inputs, *args).count()
    assert [by for by, _ in plans] == ["user"] * 3  # capped, merged, cand
    merged = [x for x in plans[1][1] if "hashpartitioning(user#" in x and ", item#" not in x.split("hashpartitioning")[1]]
    assert not merged
