"""Seed ranking, per-seed caps, the distinct-item budget and merges
(WIN-01..05, AGG-04/05/10).

Order matters and is fixed here: exclusions -> per-seed cap (counts eligible
rows only) -> budget (computed on capped eligible rows) -> merge.

Scale notes: ``row_number() <= k`` filters are planned by Spark with a
``WindowGroupLimit`` on both sides of the exchange, so a hot (user,seed) or
user is cut to k rows map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.scoring import fixed_sum
from recsmith.operators.filters import position
from recsmith.operators.keyed import keyed_load

BLOCK = 32  # list positions of one block of the bounded expansion
CARRIED = 256  # exclusions that a user's row carries to the lists
HEAVY_ROWS = 100_000  # rows of a key that a plain window takes at any rate
SKETCH_ITEMS = 16  # items that the frequency sketch tracks for each key it may name
MOST_TRACKED = 1_000_000  # items that Spark's sketch tracks at most (fixed value of approx_top_k)


def heavy_keys(df: DataFrame, part: list[str], floor: int | None = None) -> list[int]:
    """Hashes of the keys that hold more rows than a partition holds on average (and than ``floor``):
    at most as many as there are shuffle partitions, found by a frequency sketch in one pass.

    With over ``MOST_TRACKED`` / ``SKETCH_ITEMS`` shuffle partitions the sketch names that many keys;
    one that it leaves out is then lighter than all of them."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64(*part)
    named = min(n, MOST_TRACKED // SKETCH_ITEMS)
    sketch = F.call_function("approx_top_k", key, F.lit(named), F.lit(SKETCH_ITEMS * named))
    top, rows = df.agg(sketch, F.count(F.lit(1))).first()
    least = max(HEAVY_ROWS if floor is None else floor, (rows or 0) // n)
    return [x["item"] for x in top or [] if x["count"] > least]


def distributed_rank(df: DataFrame, part, order, name: str = "i", count_col: str | None = None,
                     sized: tuple[DataFrame, list[str]] | None = None) -> DataFrame:
    """0-based rank within ``part`` by ``order`` without putting a heavy group in one task.

    A frequency sketch names the heavy keys.  The rows of all others are ranked by one plain
    window; those of heavy keys by a range partitioning (``sliced_rank``).  Where no key is heavy the
    second part is not planned.  Rows of a null key are ranked like those of any other.  ``sized``: rows,
    and columns of ``part``, that the sketch reads in place of ``df`` (a table that ``df`` is cut from, so that
    the cut is not run twice).
    """
    part = [part] if isinstance(part, str) else list(part)
    rows, by = sized or (df, part)
    heavy = heavy_keys(rows, by)
    is_heavy = F.xxhash64(*by).isin(heavy)
    whole = Window.partitionBy(*part)
    light = (df.where(~is_heavy) if heavy else df).withColumn(name, (F.row_number().over(whole.orderBy(*order)) - 1).cast("long"))
    if count_col:
        light = light.withColumn(count_col, F.count(F.lit(1)).over(whole))
    if not heavy:
        return light
    return light.unionByName(sliced_rank(df.where(is_heavy), part, order, name, count_col).select(light.columns))


def heavy_sums(totals: DataFrame, key: str, rows: str) -> list:
    """The values of ``key`` with more ``rows`` (its count of rows to come) than a partition holds on average
    and than ``HEAVY_ROWS``: at most as many as there are shuffle partitions."""
    n = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = totals.agg(F.sum(rows)).first()[0] or 0
    return [x[0] for x in totals.where(F.col(rows) > max(HEAVY_ROWS, every // n)).select(key).collect()]


def sliced_rank(df: DataFrame, part: list[str], order, name: str, count_col: str | None = None) -> DataFrame:
    """Rows are range-partitioned on (part, order), so a hot group spans many partitions;
    each (group, partition) slice is ranked locally and shifted by the row count of the
    group's earlier partitions (a prefix sum over a table of one row per slice).  The
    range-partitioned rows are written once, so both uses see the same partition ids."""
    from recsmith.session import materialise
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = materialise(df.repartitionByRange(n, *[F.col(c) for c in part], *order)
                        .withColumn("_p", F.spark_partition_id()))
    local = keyed.withColumn("_lr", F.row_number().over(Window.partitionBy(*part, "_p").orderBy(*order)))
    counts = keyed.groupBy(*part, "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*part).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_c").over(Window.partitionBy(*part)))
    offsets = offsets.drop("_c")
    # null-safe, as a null key has a rank like any other
    slices = offsets.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(part)], F.col("_p").alias("_kp"),
                            *[c for c in offsets.columns if c not in (*part, "_p")])
    same = F.col("_p") == F.col("_kp")
    for i, c in enumerate(part):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return (local.join(slices, same).drop("_kp", *[f"_k{i}" for i in range(len(part))])
            .withColumn(name, (F.col("_off") + F.col("_lr") - 1).cast("long"))
            .drop("_p", "_lr", "_off"))


def seed_rank(user_seed: DataFrame, score_col: str = "score", seed_col: str = "seed") -> DataFrame:
    """WIN-01: 0-based rank ``i`` of each seed per user (score desc, seed asc) and ``n_seeds``.

    The rank is a distributed rank (a user with a third of all seeds is split over many tasks).
    """
    return distributed_rank(user_seed, "user", [F.desc(score_col), F.col(seed_col)], count_col="n_seeds")


def per_seed_cap(rows: DataFrame, k_few: int, k_many: int | None = None, many_at: int = 10,
                 group=("user", "seed"), order=("pos",)) -> DataFrame:
    """WIN-02: keep the first k eligible rows per (user,seed) in list order.

    k = ``k_many`` when the user has at least ``many_at`` seeds, else ``k_few``.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    rn = F.row_number().over(w)
    if k_many is None:
        return rows.withColumn("_rn", rn).where(F.col("_rn") <= k_few).drop("_rn")
    k = F.when(F.col("n_seeds") >= many_at, F.lit(k_many)).otherwise(F.lit(k_few))
    # the literal bound lets the planner insert a group limit before the shuffle
    bound = F.col("_rn") <= max(k_few, k_many)
    return rows.withColumn("_rn", rn).where(bound & (F.col("_rn") <= k)).drop("_rn")


def budget_cut(capped: DataFrame, budget: int) -> DataFrame:
    """(user, _cut): the seed rank at which the user's distinct items reach ``budget``
    (users that never reach it have no row).

    Every seed with a fresh item adds at least one, so the crossing seed is among the first
    ``budget`` of them: the rank filter (a group limit before the shuffle) is exact and
    bounds the running sum to ``budget`` rows per user."""
    firsts = capped.groupBy("user", "item").agg(F.min("i").alias("_fi"))
    per_seed = firsts.groupBy("user", "_fi").agg(F.count(F.lit(1)).alias("_f"))
    by_rank = Window.partitionBy("user").orderBy("_fi")
    first = per_seed.withColumn("_rn", F.row_number().over(by_rank)).where(F.col("_rn") <= budget)
    upto = by_rank.rowsBetween(Window.unboundedPreceding, 0)
    return (first.withColumn("_cum", F.sum("_f").over(upto)).where(F.col("_cum") >= budget)
            .groupBy("user").agg(F.min("_fi").alias("_cut")))


def seed_budget(capped: DataFrame, budget: int, cut: DataFrame | None = None) -> DataFrame:
    """WIN-03: walk seeds in rank order and stop after the first seed at which the
    number of distinct items reaches ``budget``; that seed is kept whole.

    An item is fresh at its lowest seed rank (partial + final ``min``), fresh items are
    counted per seed (partial + final count), and the running sum runs over one row per
    seed with fresh items, not over the item rows; the crossing rank is then one value
    per user.
    """
    cut = budget_cut(capped, budget) if cut is None else cut
    return (capped.join(cut, "user", "left")
            .where(F.col("_cut").isNull() | (F.col("i") <= F.col("_cut"))).drop("_cut"))


def rank_discount(score, i) -> "F.Column":
    """WIN-04: score / sqrt(i + 1)."""
    return score / F.sqrt(i + F.lit(1))


def merge_max(rows: DataFrame, score_col: str = "score") -> DataFrame:
    """AGG-04: one row per (user,item), max score over seeds."""
    return rows.groupBy("user", "item").agg(F.max(score_col).alias("score"))


def merge_sum(rows: DataFrame, score_col: str = "score") -> DataFrame:
    """AGG-05: one row per (user,item), summed score over seeds (independent of row order)."""
    return rows.groupBy("user", "item").agg(fixed_sum(F.col(score_col)).alias("score"))


def reason_caps(df: DataFrame, per_reason: int, total: int, reason: str = "src") -> DataFrame:
    """WIN-05: by score desc (ties item asc): at most ``per_reason`` per reason, then the first ``total``."""
    w1 = Window.partitionBy("user", reason).orderBy(F.desc("score"), "item")
    w2 = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    a = df.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= per_reason).drop("_r1")
    return a.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= total).drop("_r2")


def distinct_reasons(df: DataFrame, reason: str = "src") -> DataFrame:
    """AGG-10: number of distinct reasons per user."""
    return df.groupBy("user").agg(F.countDistinct(reason).alias("n_reasons"))


def with_reasons(df: DataFrame, reason: str = "src") -> DataFrame:
    """AGG-10 on each row (``n_reasons``): the user's rows, bounded by the caps, are read once."""
    return df.withColumn("n_reasons", F.size(F.collect_set(reason).over(Window.partitionBy("user"))))


def with_marks(rows: DataFrame, marks: DataFrame, value: str, key: str = "item", written: bool = False) -> DataFrame:
    """Left join of ``rows`` with ``marks`` (user, item once, ``value``) on user and item (``key``: another column in its place).

    A join on both would move rows that lie by user, so the marks of a user join as one map, looked up in each row.  Where
    a user has more marks than a row carries (``CARRIED``), it is a plain join.  ``written``: the maps are written by user first."""
    marks = marks.select("user", key, value).where(F.col("user").isNotNull() & F.col(key).isNotNull())
    if marks.groupBy("user").count().where(F.col("count") > CARRIED).take(1):
        return rows.join(marks, ["user", key], "left")
    held = marks.groupBy("user").agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("_m"))
    if written:
        from recsmith.session import materialise
        held = materialise(held, by="user")
    return rows.join(held, "user", "left").withColumn(value, F.element_at("_m", F.col(key))).drop("_m")


def renumber(lists: DataFrame, keys, keep=None, gated: DataFrame | None = None,
             limits: DataFrame | None = None, sized: DataFrame | None = None) -> DataFrame:
    """Positions of list entries after user-independent drops (``pos`` is unique per list).

    ``keep``: optional DataFrame of items that may appear (others are removed, e.g.
    quality gate, blocklist).  A list comes back in variants, each numbered on its own
    (``fpos``, 0-based) with the distributed rank, so no list is ever in one task:

    * without ``gated`` and ``limits``: variant -1, all kept entries;
    * ``gated`` (items): variant 1 (segment members) all kept entries, variant 0 the
      entries that are not gated;
    * ``limits`` (max_days): variant -1 all kept entries, and one variant per distinct
      limit holding the entries whose ``create_days`` are within it.

    ``sized``: the lists before any drop, for the sketch of the rank.
    """
    x = lists
    keys = [keys] if isinstance(keys, str) else list(keys)
    if keep is not None:
        x = x.join(keep.select("item").distinct(), "item", "left_semi")
    if gated is not None:
        g = gated.select("item").distinct().withColumn("_gated", F.lit(True))
        open_to = F.when(F.col("_gated"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(0)))
        x = x.join(g, "item", "left").withColumn("variant", F.explode(open_to)).drop("_gated")
    elif limits is not None:
        # the distinct limits are days: a handful of numbers, brought in as one scalar array
        days = limits.agg(F.collect_set(F.col("max_days").cast("int")).alias("d")).scalar()
        x = x.withColumn("variant", F.explode(F.concat(F.array(F.lit(-1)), days)))
        x = x.where((F.col("variant") == -1) | (F.col("create_days") <= F.col("variant")))
    else:
        x = x.withColumn("variant", F.lit(-1))
    return distributed_rank(x, keys + ["variant"], [F.col("pos")], name="fpos", sized=None if sized is None else (sized, keys))


def _with_variant(u: DataFrame, members: DataFrame | None, limits: DataFrame | None) -> DataFrame:
    """``variant``: the variant of the lists (see ``renumber``) that is open to the row's user."""
    if members is not None:
        u = u.join(members.select("user").distinct().withColumn("_member", F.lit(True)), "user", "left")
        return u.withColumn("variant", F.coalesce(F.col("_member"), F.lit(False)).cast("int")).drop("_member")
    if limits is not None:
        held = keyed_load(limits.select("user", F.col("max_days").cast("int").alias("_days"), *position(limits)), "user")
        return u.join(held, "user", "left").withColumn("variant", F.coalesce("_days", F.lit(-1))).drop("_days")
    return u.withColumn("variant", F.lit(-1))


def capped_expansion(user_keys: DataFrame, lists: DataFrame, keys, caps: tuple[int, ...], excl_pairs: DataFrame,
                     many_at: int = 10, group: str = "seed", order: str = "pos", members: DataFrame | None = None,
                     limits: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """``bounded_expansion``, JOIN-08 on ``excl_pairs`` and ``per_seed_cap`` in one step, for the same rows.

    A user row with at most ``CARRIED`` exclusions carries them (as an array) to the list, of which it needs no more
    than the first cap + ``CARRIED`` entries open to the user; those are one bounded array per list.  Exclusion and cap
    then run inside the joined row, so that neither the expanded rows nor the exclusions are shuffled: what leaves
    the join are the rows kept.  Users with more exclusions, and (user, key) pairs that
    ``user_keys`` holds twice (one cap for both rows), take the steps one after the other.

    ``by``: the column ("user", or none) that the user rows are written by.  Where the heads of all lists are small enough to
    be broadcast, the rows kept then lie by it."""
    from recsmith.session import materialise
    keys = [keys] if isinstance(keys, str) else list(keys)
    on, most = keys + ["variant"], max(caps)
    cap = F.lit(caps[0]) if len(caps) == 1 else F.when(F.col("n_seeds") >= many_at, F.lit(caps[1])).otherwise(F.lit(caps[0]))
    u = materialise(_with_exclusions(user_keys, excl_pairs, group), by=by)
    alone = (F.col("_ne") <= CARRIED) & (F.col("_times") == 1)
    cols = [c for c in lists.columns if c not in (*on, "fpos")]
    heads = (lists.where(F.col("fpos") < most + CARRIED).groupBy(*on)
             .agg(F.array_sort(F.collect_list(F.struct("fpos", *cols))).alias("_head")))
    heads = materialise(heads)  # a table has a size that the planner knows
    x = _with_variant(u.where(alone), members, limits).join(heads, on)
    excl = F.coalesce("_excl", F.array().cast("array<long>"))
    seen = F.slice("_head", F.lit(1), (cap + F.col("_ne")).cast("int"))
    free = F.filter(seen, lambda e: ~F.coalesce(F.array_contains(excl, e["item"]), F.lit(False)))
    x = x.select(*user_keys.columns, F.explode(F.slice(free, F.lit(1), cap)).alias("_e"))
    x = x.select(*user_keys.columns, *[F.col(f"_e.{c}").alias(c) for c in cols])
    rest = u.where(~alone).select(user_keys.columns)
    if not rest.take(1):
        return x
    excluded = excl_pairs.select("user", "item")
    exp = bounded_expansion(rest, lists, keys, cap, excl_pairs, members, limits).join(excluded, ["user", "item"], "left_anti")
    return x.unionByName(per_seed_cap(exp, caps[0], caps[1] if len(caps) > 1 else None, many_at, ("user", group), (order,)).select(x.columns))


def headed_expansion(user_keys: DataFrame, arms: list[tuple["F.Column", DataFrame]], key: str, caps: tuple[int, ...], excl_pairs: DataFrame,
                     gated: DataFrame, members: DataFrame, many_at: int = 10, placed: bool = False,
                     marks: DataFrame | None = None) -> DataFrame:
    """``capped_expansion`` over lists that lie by their key, whose entries say whether they are ``_gated`` (read by
    ``members`` alone): the rows of user and list meet on the key, and the lists stay where they are.

    ``arms``: lists, and which rows of ``user_keys`` read them.  A list's head ends where its open entries suffice for
    any user who carries the exclusions; gate, exclusions and cap run inside the joined row.  Lists with more
    entries than a partition holds on average, users with more exclusions and repeated rows take ``renumber`` and the
    steps of ``capped_expansion``.

    ``placed``: the rows lie by user, as a table bucketed by user does.  A user's rows of a list go there as
    one row with an array of each column, and ``_last``, the ``pos`` of the last entry that this row keeps, comes in
    the place of ``pos``.  ``marks`` (user, item once, other columns): come with them, and a row takes those of its user and
    item, null where there are none; user and item are never null there."""
    from recsmith.session import bucket_count, materialise
    most = max(caps)
    cap = F.lit(caps[0]) if len(caps) == 1 else F.when(F.col("n_seeds") >= many_at, F.lit(caps[1])).otherwise(F.lit(caps[0]))
    u = _with_exclusions(user_keys, excl_pairs, key)
    u = u.join(members.select("user").distinct().withColumn("_member", F.lit(True)), "user", "left")
    u = materialise(u)
    alone = (F.col("_ne") <= CARRIED) & (F.col("_times") == 1)
    excl = F.coalesce("_excl", F.array().cast("array<long>"))
    out, rest_rows = None, bool(u.where(~alone).take(1))
    for whose, lists in arms:
        cols = [c for c in lists.columns if c not in (key, "_gated")]
        heavy = heavy_keys(lists, [key])
        is_heavy = F.xxhash64(key).isin(heavy)
        upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        free = (~F.col("_gated")).cast("int")
        heads = (lists.where(~is_heavy) if heavy else lists).withColumn("_before", F.sum(free).over(upto) - free)
        heads = (heads.where(F.col("_before") < most + CARRIED).groupBy(key)
                 .agg(F.array_sort(F.collect_list(F.struct("pos", *[c for c in cols if c != "pos"], "_gated"))).alias("_head")))
        heads = heads.withColumn("_free", F.filter("_head", lambda e: ~e["_gated"]))
        x = u.where(alone & whose).join(heads, key)
        mine = F.when(F.col("_member").isNotNull(), F.col("_head")).otherwise(F.col("_free"))
        first = F.slice(mine, F.lit(1), cap)
        # exclusions that meet none of the first entries leave them as they are; others are looked up in the entries that the cap
        # and they can reach, and in the whole head where it names an item twice
        upto = cap + F.col("_ne").cast("int")
        open_ = lambda entries: F.filter(entries, lambda e: ~F.coalesce(F.array_contains(excl, e["item"]), F.lit(False)))
        near = open_(F.slice(mine, F.lit(1), upto))
        held = F.when((F.size(mine) <= upto) | (F.size(near) >= cap), near).otherwise(open_(mine))
        held = F.when(~F.coalesce(F.arrays_overlap(first["item"], excl), F.lit(True)), first).otherwise(F.slice(held, F.lit(1), cap))
        if placed:  # a row that keeps nothing ends with its empty arrays
            x = x.select(*user_keys.columns, held.alias("_e"))
            x = x.select(*user_keys.columns, F.get("_e", F.size("_e") - 1)["pos"].alias("_last"), *[F.col("_e")[c].alias(c) for c in cols if c != "pos"])
        else:
            x = x.select(*user_keys.columns, F.explode(held).alias("_e")).select(*user_keys.columns, *[F.col(f"_e.{c}").alias(c) for c in cols])
        one = lambda y: y.select(*user_keys.columns, F.col("pos").alias("_last"), *[F.array(c).alias(c) for c in cols if c != "pos"]) if placed else y
        plain = lists.drop("_gated")
        if heavy:
            long_lists = plain.where(is_heavy)
            y = capped_expansion(u.where(alone & whose).select(user_keys.columns), renumber(long_lists, key, gated=gated, sized=long_lists), key,
                                 caps, excl_pairs, many_at, members=members)
            x = x.unionByName(one(y).select(x.columns))
        if rest_rows:
            y = bounded_expansion(u.where(~alone & whose).select(user_keys.columns), renumber(plain, key, gated=gated, sized=lists), key, cap, excl_pairs, members)
            y = y.join(excl_pairs.select("user", "item"), ["user", "item"], "left_anti")
            x = x.unionByName(one(per_seed_cap(y, caps[0], caps[1] if len(caps) > 1 else None, many_at, ("user", key))).select(x.columns))
        out = x if out is None else out.unionByName(x)
    if not placed:
        return out
    cols = [c for c in out.columns if c not in (*user_keys.columns, "_last")]
    more = []
    if marks is not None:
        more = [c for c in marks.columns if c not in ("user", "item")]
        marks = marks.select("user", F.array("item").alias("item"), *[F.array(F.lit(None)).cast(out.schema[c].dataType).alias(c) for c in cols if c != "item"],
                             *more, F.lit(True).alias("_mark"))
        out = out.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    out = out.repartition(bucket_count(out.sparkSession), "user")
    out = out.withColumn("_e", F.explode(F.arrays_zip(*cols))).withColumns({c: F.col("_e")[c] for c in cols}).drop("_e")
    if marks is not None:
        same = Window.partitionBy("user", "item")
        out = out.withColumns({c: F.max(c).over(same) for c in more}).where(~F.col("_mark")).drop("_mark")
    return out


def _with_exclusions(user_keys: DataFrame, excl_pairs: DataFrame, group: str) -> DataFrame:
    """Adds ``_times`` (rows of the user and key), ``_ne`` (the user's exclusions) and ``_excl`` (these, if at most ``CARRIED``)."""
    ne = excl_pairs.groupBy("user").agg(F.count(F.lit(1)).alias("_ne"))
    held = (excl_pairs.join(ne.where(F.col("_ne") <= CARRIED).drop("_ne"), "user", "left_semi")
            .groupBy("user").agg(F.collect_list("item").alias("_excl")))
    u = user_keys.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy("user", group)))
    return u.join(ne, "user", "left").join(held, "user", "left").withColumn("_ne", F.coalesce("_ne", F.lit(0)))


def bounded_expansion(user_keys: DataFrame, lists: DataFrame, keys, cap: "F.Column",
                      excl_pairs: DataFrame, members: DataFrame | None = None,
                      limits: DataFrame | None = None) -> DataFrame:
    """Exact pruning of the user x list expansion before the per-list cap.

    A user with E excluded (user,item) pairs and cap K can only keep entries whose
    position among the entries open to that user is < K + E: that prefix holds at most E
    excluded entries, so the first K eligible ones lie inside it.  The entries open to a
    user are one variant of the list (see ``renumber``): by segment membership
    (``members``) or by the user's age limit (``limits``: user, max_days).

    Lists are cut into blocks of ``BLOCK`` positions and a user row asks for the blocks
    below its bound (and within the list), so the join is an equi-join on (key, variant,
    block): the pairs compared are at most bound + BLOCK per user and key, and a hot list
    is spread over its blocks.
    """
    ne = excl_pairs.groupBy("user").agg(F.count(F.lit(1)).alias("_ne"))
    u = user_keys.join(ne, "user", "left").withColumn("_bound", cap + F.coalesce("_ne", F.lit(0))).drop("_ne")
    u = _with_variant(u, members, limits)
    keys = [keys] if isinstance(keys, str) else list(keys)
    on = keys + ["variant"]
    length = lists.groupBy(*on).agg((F.max("fpos") + 1).alias("_len"))
    u = u.join(length, on)  # a key without a list (in this variant) ends here
    last = F.floor((F.least("_bound", "_len") - 1) / BLOCK).cast("long")
    u = u.where(F.col("_bound") > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    blocks = lists.withColumn("_block", F.floor(F.col("fpos") / BLOCK).cast("long"))
    return (u.join(blocks, on + ["_block"]).where(F.col("fpos") < F.col("_bound"))
            .drop("variant", "_block", "_bound", "_len", "fpos"))
