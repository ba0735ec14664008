"""Steps whose cost grows with the input: list totals, items of the similarity lists, caps inside the joined row."""
import random

import pytest
from pyspark.sql import functions as F

from recsmith import catalog, session
from recsmith.operators import candidates as C
from recsmith.operators import recall as RC
from recsmith.plans import by_liked, by_seed, by_tag
from recsmith.sources import views
from recsmith.sources.views import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _same(got, want):
    rows = lambda df: sorted((tuple(r) for r in df.select(want.columns).collect()), key=str)
    assert rows(got) == rows(want)


def _no_rows_joined(df, names):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join Inner" in x]
    assert len(joins) == 1 and plan.count("Aggregate") == 2 and all(n in plan for n in names)


def test_totals_of_an_expansion(spark):
    """F8, F16: as the aggregate over the expanded rows, with null and repeated keys and values."""
    ut = spark.createDataFrame([(1, "a", 0.5, 0), (1, "a", 0.25, 1), (1, "b", None, 2), (2, "a", 1.0, 0), (None, "b", 2.0, 0),
                                (3, "c", 1.0, 0), (3, None, 1.0, 1)], "user long, tag string, pref double, pos long")
    ti = spark.createDataFrame([("a", 1, 0.5, 0), ("a", 2, None, 1), ("a", 2, 0.25, 2), ("b", 1, 4.0, 0), (None, 1, 1.0, 0), ("d", 1, 1.0, 0)],
                               "tag string, item long, quality double, pos long")
    want = RC.tag_expansion(ut, ti).groupBy("user", "tag").agg(F.count(F.lit(1)).alias("n_items"),
                                                               F.sum(F.col("pref") * F.col("quality")).alias("s"))
    got = RC.expansion_totals(ut, ti, "tag", "quality", "s", "pref")
    _same(got, want)
    _no_rows_joined(got, ["tag"])


def test_items_of_the_similarity_lists(spark):
    """the items of both columns, found without the pairs."""
    t = Tables(spark, SF)
    s, items = t.item_sim(), t.sim_items()
    _same(items.where("headed").select("item"), s.select("item").distinct())
    _same(items.where("listed").select("item"), s.select(F.col("item2").alias("item")).distinct())
    _same(t.seed_items(), t.seed_item().select("item").distinct())


@pytest.mark.parametrize("floor", [100_000, 5])
def test_similarity_lists(spark, monkeypatch, tmp_path, floor):
    """Both similarities from one pass over the pairs, with a part in most orders and null keys."""
    rnd = random.Random(3)
    lines = {(o, p) for o in range(60) for p in [0] * (o % 4 > 0) + rnd.sample(range(1, 25), rnd.randint(1, 4))}
    lines = list(lines) + [(None, 0), (None, 3), (5, None)] + [(1, 30), (2, 31), (2, 32)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(p, ["STANDARD", "PROMO", None][p % 3]) for p in range(31)],
                          "p_partkey long, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(C, "HEAVY_ROWS", floor)
    held = {(o, p) for o, p in lines if o is not None and p is not None}
    n = {p: len({o for o, x in lines if x == p}) for _, p in held}
    together = {}
    for o, a in held:
        for x, b in held:
            if x == o and a != b and a < 31:  # later parts are not in the part table
                together[a, b] = together.get((a, b), 0) + 1
    t = Tables(spark, str(tmp_path), materialise=False)
    for alt in (False, True):
        want = []
        for a in {a for a, _ in together}:
            if alt and a % 3 != 1:
                continue
            own = sorted((-k / (n[b] if alt else n[a]), b) for (x, b), k in together.items() if x == a)
            want += [(a, b, -s, i) for i, (s, b) in enumerate(own)]
        got = [tuple(r) for r in t.item_sim(alt=alt).collect()]
        assert want and sorted(got) == sorted(want)
    items = {r.item: (r.headed, r.listed) for r in t.sim_items().collect()}
    assert {i for i, x in items.items() if x[0]} == {a for a, _ in together}
    assert {i for i, x in items.items() if x[1]} == {b for _, b in together}


@pytest.mark.parametrize("carried", [256, 6, 0])
@pytest.mark.parametrize("kind", ["members", "limits"])
def test_capped_expansion(spark, monkeypatch, carried, kind):
    """The rows of expansion, exclusion and cap one after the other; users with more exclusions than
    a row carries and repeated user rows among them."""
    monkeypatch.setattr(C, "CARRIED", carried)
    rnd = random.Random(5)
    lists = spark.createDataFrame([(s, i, p, rnd.randint(0, 9)) for s in range(12)
                                   for p, i in enumerate(rnd.sample(range(80), 60))], "seed long, item long, pos long, create_days int")
    seeds = [(u, s, k, 5 + u % 9) for u in range(30) for k, s in enumerate(rnd.sample(range(14), 6))] + [(3, s, 9, 8) for s in range(12)]
    us = spark.createDataFrame(seeds, "user long, seed long, i long, n_seeds long").dropDuplicates(["user", "seed", "i"])
    excl = spark.createDataFrame([(u, i) for u in range(30) for i in rnd.sample(range(80), u)] + [(None, 1)], "user long, item long")
    args = {"members": spark.createDataFrame([(u,) for u in range(0, 30, 2)], "user long")} if kind == "members" else \
        {"limits": spark.createDataFrame([(u, u % 3 + 4) for u in range(0, 30, 2)], "user long, max_days int")}
    gated = spark.createDataFrame([(i,) for i in range(0, 80, 5)], "item long")
    numbered = C.renumber(lists, "seed", sized=lists, **({"gated": gated} if kind == "members" else args))
    cap = F.when(F.col("n_seeds") >= 10, F.lit(3)).otherwise(F.lit(5))
    old = C.bounded_expansion(us, numbered, "seed", cap, excl, **args).join(excl, ["user", "item"], "left_anti")
    want = C.per_seed_cap(old, 5, 3, 10)
    got = C.capped_expansion(us, numbered, "seed", (5, 3), excl, 10, **args)
    once = us.groupBy("user", "seed").count().where("count = 1").drop("count")
    _same(got.join(once, ["user", "seed"], "left_semi"), want.join(once, ["user", "seed"], "left_semi"))
    # of two rows of one user and key either may keep an entry
    _same(got.select("user", "seed", "pos"), want.select("user", "seed", "pos"))


@pytest.mark.parametrize("inputs,stages,args,unread", [
    (catalog.seed_inputs, by_seed, (1, (1, 14), 4), {"rate_by_seed", "user_affinity", "item_affinity", "pay", "user_features"}),
    (catalog.tag_inputs, by_tag, (2, (2, 90), 4), {"rate_by_tag", "user_affinity", "item_affinity", "user_features"}),
    (catalog.liked_inputs, by_liked, (1, (1, 14), 4), {"rate_by_liked", "user_affinity", "item_affinity", "pay"})])
def test_inputs_of_an_early_stage(spark, monkeypatch, inputs, stages, args, unread):
    """A query that stops at the caps derives no table of the scoring."""
    from recsmith import params as P
    made = []
    for name in unread:
        monkeypatch.setattr(views.Tables, name, lambda self, _n=name: made.append(_n))
    x = inputs(Tables(spark, SF))
    assert stages.candidate_stages(x, P.AS_OF, *args)["capped"].count() > 0
    assert not made


def test_tables_of_active_users(spark):
    """The routes derive their users' tables for active users alone, as the whole tables hold them."""
    from recsmith import params as P
    from recsmith.operators import filters as FL
    t = Tables(spark, SF)
    for days, users in ((1, FL.active_users(t.active(), P.AS_OF, 1)), (views.EVER, t.active())):
        for name in ("user_seed", "play", "subscriptions", "user_tag", "history", "user_affinity"):
            some, whole = getattr(t, name)(days), getattr(t, name)()
            _same(some, FL.only_active(whole, users))
            assert days != 1 or 0 < some.count() < whole.count()


def test_weights_query_joins_each_half_once(spark):
    """the user's and the item's halves are joined with the weights read alone."""
    plan = catalog.QUERIES["read_weights"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join LeftOuter" in x for x in plan.splitlines()) == 5  # rate, both affinities, both halves


@pytest.mark.parametrize("carried,floor", [(256, 100_000), (6, 100_000), (256, 30)])
def test_headed_expansion(spark, monkeypatch, carried, floor):
    """The rows of expansion, exclusion and cap one after the other, with gated entries, two arms, heavy lists,
    users with more exclusions than a row carries and repeated user rows."""
    rnd = random.Random(7)
    table = lambda n: spark.createDataFrame([(s, i, p) for s in range(12) for p, i in enumerate(rnd.sample(range(80), n(s)))],
                                            "seed long, item long, pos long")
    lists = [table(lambda s: 60 if s else 78), table(lambda s: 40)]
    us = [(u, s, k, 5 + u % 9) for u in range(30) for k, s in enumerate(rnd.sample(range(14), 6))] + [(3, s, 9, 8) for s in range(12)]
    us = spark.createDataFrame(us, "user long, seed long, i long, n_seeds long").dropDuplicates(["user", "seed", "i"])
    excl = spark.createDataFrame([(u, i) for u in range(30) for i in rnd.sample(range(80), u)] + [(None, 1)], "user long, item long")
    members = spark.createDataFrame([(u,) for u in range(0, 30, 2)], "user long")
    gated = spark.createDataFrame([(i,) for i in range(0, 80, 5)], "item long")
    monkeypatch.setattr(C, "CARRIED", carried)
    cap = F.when(F.col("n_seeds") >= 10, F.lit(3)).otherwise(F.lit(5))
    want, arms = None, []
    for k, x in enumerate(lists):
        mine = us.where(F.col("user") % 3 == k)
        old = C.bounded_expansion(mine, C.renumber(x, "seed", gated=gated), "seed", cap, excl, members=members)
        w = C.per_seed_cap(old.join(excl, ["user", "item"], "left_anti"), 5, 3, 10)
        want = w if want is None else want.unionByName(w)
        arms.append((F.col("user") % 3 == k, x.withColumn("_gated", F.col("item") % 5 == 0)))
    want = want.localCheckpoint()
    monkeypatch.setattr(C, "HEAVY_ROWS", floor)
    got = C.headed_expansion(us, arms, "seed", (5, 3), excl, gated, members, 10)
    once = us.groupBy("user", "seed").count().where("count = 1").drop("count")
    _same(got.join(once, ["user", "seed"], "left_semi"), want.join(once, ["user", "seed"], "left_semi"))
    _same(got.select("user", "seed", "pos"), want.select("user", "seed", "pos"))


def test_lists_of_seeds_and_open_items(spark):
    """The entries, similarities and order of the whole lists, and no exchange of them by a step on their seed."""
    t = Tables(spark, SF)
    seeds, items = t.item_sim().select("item").distinct().where("item % 3 = 0"), t.quality().select("item", (F.col("item") % 7 == 0).alias("_gated")).where("item % 2 = 0")
    for alt, got in zip((False, True), t.open_lists(seeds, items)):
        x = t.item_sim(alt=alt).join(seeds, "item", "left_semi").withColumnRenamed("item", "seed").withColumnRenamed("item2", "item").join(items, "item")
        assert x.count()
        rank = F.row_number().over(views.Window.partitionBy("seed").orderBy("pos"))
        _same(got.withColumn("pos", rank), x.withColumn("pos", rank).select(got.columns))
        assert "Exchange" not in got.groupBy("seed").count()._jdf.queryExecution().executedPlan().toString()
    heads = {r.item: (r.headed, r.headed_alt) for r in t.sim_items().collect()}
    for k, alt in enumerate((False, True)):
        assert {i for i, x in heads.items() if x[k]} == {r.item for r in t.item_sim(alt=alt).select("item").distinct().collect()}


def test_lists_of_the_seed_route_stay_in_place(spark, monkeypatch):
    """the lists are written by seed and the caps number no variant of them."""
    from recsmith import params as P
    from recsmith import session
    written = []
    write = session.materialise
    monkeypatch.setattr(session, "materialise", lambda df, by=None, **k: written.append((by, set(df.columns))) or write(df, by, **k))
    monkeypatch.setattr(C, "renumber", lambda *a, **k: pytest.fail("no list is numbered again"))
    x = catalog.seed_inputs(Tables(spark, SF))
    assert by_seed.candidate_stages(x, P.AS_OF, 1, (1, 14), 4)["capped"].count() > 0
    assert ("seed", {"seed", "item", "sim", "pos", "_gated"}) in written


def test_recalled_rows_carry_the_score(spark):
    """the recalled rows take the score from their candidate, so the candidates are joined once."""
    seeds = spark.createDataFrame([(u, s, s) for u in range(3) for s in range(4)], "user long, seed long, i long")
    lists = spark.createDataFrame([(s, i) for s in range(4) for i in range(s, 40)] + [(1, None)], "seed long, item long")
    cand = spark.createDataFrame([(u, i, u + i / 7) for u in range(3) for i in range(u, 30, 3)] + [(0, None, 1.0)], "user long, item long, score double")
    want = seeds.join(lists, "seed").join(cand, ["user", "item"])
    _same(RC.recalled_rows(seeds, lists, "seed", cand, ["score"]), want.select("user", "item", "seed", "i", "score"))


def test_reasons_after_the_caps(spark, shuffled):
    """The best seed of each candidate over all recalled rows, from rows within and after the caps; neither is moved again."""
    rnd = random.Random(11)
    entries = [(s, i, p, rnd.choice((0.25, 0.5, 0.75))) for s in range(12) for p, i in enumerate(rnd.sample(range(60), 40))]
    lists = spark.createDataFrame([(s, i, p, 1.0 - p // 4 / 16 if s % 2 else x) for s, i, p, x in entries], "seed long, item long, pos long, sim double")
    seeds = spark.createDataFrame([(u, s, k, 5) for u in range(20) for k, s in enumerate(rnd.sample(range(14), 6))], "user long, seed long, i long, n_seeds long")
    excl = spark.createDataFrame([(u, i) for u in range(20) for i in rnd.sample(range(60), 2 * u)], "user long, item long")
    gated = spark.createDataFrame([(i,) for i in range(0, 60, 5)], "item long")
    members = spark.createDataFrame([(u,) for u in range(0, 20, 2)], "user long")
    vis = spark.createDataFrame([(u, i, -i) for u in range(20) for i in range(0, 60, 7)] + [(77, 1, 5)], "user long, item long, _vis long")
    arms = [(F.col("user") >= 0, lists.withColumn("_gated", F.col("item") % 5 == 0))]
    plain = C.headed_expansion(seeds, arms, "seed", (5, 3), excl, gated, members).join(vis, ["user", "item"], "left")
    got = C.headed_expansion(seeds, arms, "seed", (5, 3), excl, gated, members, placed=True, marks=vis)
    _same(got, plain.select("user", "seed", "i", "item", "sim", "_vis"))
    capped = session.materialise(got, by="user")
    cand = capped.where("i < 4").groupBy("user", "item").agg(F.sum("sim").alias("score")).join(
        capped.groupBy("user", "item").agg(RC.best_sim().alias("_best")), ["user", "item"])
    cand = session.materialise(cand, by="user")
    whole = RC.reason_argmax_sim(seeds.join(lists, "seed").join(cand.select("user", "item"), ["user", "item"], "left_semi"))
    src = RC.reason_argmax_capped(capped, seeds.select("user", "seed"), [(whose, x.drop("_gated")) for whose, x in arms], cand)
    _same(src, cand.join(whole, ["user", "item"]).select("user", "item", "score", "src"))
    assert src.join(cand.select("user", "item", F.col("_best._s").alias("s")), ["user", "item"]).where("src <> -s").count() > 0  # a later entry counts
    plan = src._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange" in x and "item#" in x.split("hashpartitioning")[-1]]


def test_parts_of_orders_lie_by_part(spark, tmp_path, shuffled):
    """Parts of orders are counted and marked where they lie, also with orders and parts that are null or repeated."""
    lines = [(o, p) for o in range(40) for p in range(o % 7, 30, 7 + o % 3)] * 2 + [(None, 3), (None, 3), (5, None), (99, 29)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(p, ["STANDARD", "PROMO"][p % 2]) for p in range(30)], "p_partkey long, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    t = Tables(spark, str(tmp_path))
    x = t._order_parts()
    held = {y for y in lines if None not in y}
    size = {o: len({p for q, p in held if q == o}) for o, _ in held}
    assert sorted(map(tuple, x.where("l_orderkey is not null").collect())) == sorted((o, p, size[o]) for o, p in held)
    counts = {r.item: (r.n, r.m) for r in t._part_counts().collect()}
    assert counts == {p: (len({o for o, q in lines if q == p}), max(size[o] for o, q in held if q == p)) for _, p in held}
    assert "Exchange" not in x.groupBy("item").count()._jdf.queryExecution().executedPlan().toString()
    s, items = t.item_sim(), t.sim_items()
    _same(items.where("headed").select("item"), s.select("item").distinct())
    _same(items.where("listed").select("item"), s.select(F.col("item2").alias("item")).distinct())
    assert s.count()


def test_lines_hold_the_columns_read(spark):
    """The lines of active users are joined with the columns of their views alone."""
    t = Tables(spark, SF)
    assert t._active_lines(1, Tables.SPENT).columns == ["user", "l_partkey", "l_extendedprice"]
    assert t._active_lines(1, Tables.PLAYED).columns == ["user", "l_partkey", "l_quantity", "l_returnflag"]


@pytest.mark.parametrize("carried", [256, 2])
def test_marks_join_where_rows_lie(spark, monkeypatch, carried):
    """as the left join, with null keys and users with more marks than a row carries."""
    monkeypatch.setattr(C, "CARRIED", carried)
    rows = spark.createDataFrame([(u, i, u + i / 7) for u in range(6) for i in range(u, 20, 2)] + [(1, None, 1.0)], "user long, item long, score double")
    marks = spark.createDataFrame([(u, i, -i) for u in range(1, 8) for i in range(0, 3 * u, 3)] + [(2, None, 3), (None, 4, 4)], "user long, item long, _v long")
    rows = session.materialise(rows, by="user")
    got = C.with_marks(rows, marks, "_v")
    _same(got, rows.join(marks, ["user", "item"], "left"))
    assert got.where("_v is not null").count() == 3


def test_reasons_of_a_user_on_each_row(spark):
    """the number of reasons as the join with it gives."""
    pool = spark.createDataFrame([(u, i, "abc"[i % (u + 1)] if i % 5 else None) for u in range(3) for i in range(12)], "user long, item long, src string")
    _same(C.with_reasons(pool), pool.join(C.distinct_reasons(pool), "user"))


@pytest.mark.parametrize("query", ["reason_caps", "quota_interleave"])
def test_rows_of_the_tag_route_stay_with_their_user(spark, monkeypatch, query):
    """from the expansion to the caps no row is moved or written."""
    from recsmith import params as P
    written = []
    monkeypatch.setattr(by_tag, "materialise", lambda df, by=None: written.append(df.columns) or df)
    df = catalog.QUERIES[query](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(user" in x]
    assert not [x for x in moved if "src#" in x] and len([x for x in moved if "item#" in x]) <= 1  # that of the visits
    assert not written and df.count() > P.MAX_REC_P3


def test_heavy_user_of_the_tag_route(spark, monkeypatch):
    """with users heavier than a partition the rows are not written by user; the result is the same."""
    want = catalog.QUERIES["quota_interleave"](spark, SF)
    rows = sorted(map(tuple, want.collect()))
    by = []
    expand = C.capped_expansion
    monkeypatch.setattr(C, "capped_expansion", lambda *a, **k: by.append(k["by"]) or expand(*a, **k))
    monkeypatch.setattr(C, "heavy_keys", lambda df, part, floor=None: [1] if part == ["user"] else [])
    assert sorted(map(tuple, catalog.QUERIES["quota_interleave"](spark, SF).collect())) == rows and by == [None]


def test_rates_of_reasons_come_to_their_user(spark, shuffled):
    """rates as the join on the reason gives them, without moving a candidate by its reason; repeated and missing rates."""
    from recsmith.operators import features as X
    cand = session.materialise(spark.createDataFrame([(u, i, i % 4 if i % 7 else None) for u in range(5) for i in range(20)], "user long, item long, src long"), by="user")
    rate = spark.createDataFrame([(0, 0.5), (1, 0.25), (1, 0.75), (None, 0.1), (2, None)], "src long, rate double")
    want = cand.join(rate.groupBy("src").agg(F.max("rate").alias("rate")), "src", "left").withColumn("rate", F.coalesce("rate", F.lit(0.09)))
    got = X.with_src_rate(cand, rate, 0.09)
    _same(got, want.select(got.columns))
    moved = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x and "hashpartitioning(src" in x]
    assert len(moved) == 2  # the rates, and the users' distinct reasons


def test_candidates_of_the_liked_route_stay_with_their_user(spark, shuffled, monkeypatch):
    """from the caps to the freshness no row is moved for the publishing time of its item."""
    from recsmith import params as P
    plans, write = [], by_liked.materialise
    monkeypatch.setattr(by_liked, "materialise", lambda df, by=None: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, by))
    stages = by_liked.candidate_stages(catalog.liked_inputs(Tables(spark, SF)), P.AS_OF, 1, (1, 14), 4)
    assert stages["cand"].count() > 0
    assert len(plans) == 3 and not [x for x in plans[2].splitlines() if "Exchange hashpartitioning(item" in x]
