"""Recall joins and reason selection (JOIN-01..04, AGG-06..08, SET-03/04).

Expansion rows carry ``user, seed, seed_score, item, sim, pos``.  Callers
semi-join active users *before* these joins, so the fan-out only happens for
users that get a list.  Hot seeds (one seed in a third of all user lists) are
split by AQE's skew-join handling on the ``seed`` key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.operators.keyed import POSITION, keyed_load
from recsmith.session import bucket_count, materialise

BITMAP_WORDS = 128  # longs of a user's bitmap of candidates: 8,192 bits for some 700 items


def seed_expansion(user_seed: DataFrame, seed_item: DataFrame) -> DataFrame:
    """JOIN-01: user->seed(score) x seed->item list on seed."""
    us = user_seed.select("user", "seed", F.col("score").alias("seed_score"),
                          *[c for c in user_seed.columns if c in ("i", "n_seeds")])
    return us.join(seed_item.select("seed", "item", "sim", "pos"), "seed")


def tag_expansion(user_tag: DataFrame, tag_item: DataFrame) -> DataFrame:
    """JOIN-04: user->tag(pref,pos) x tag->item(quality,pos) on tag."""
    ut = user_tag.select("user", "tag", "pref", F.col("pos").alias("tag_pos"))
    ti = tag_item.select("tag", "item", "quality", F.col("pos").alias("item_pos"))
    return ut.join(ti, "tag")


def expansion_totals(user_rows: DataFrame, lists: DataFrame, on, value: str, total: str,
                     weight: str | None = None) -> DataFrame:
    """(user, *on's key, n_items, total) of an expansion (JOIN-01, JOIN-03, JOIN-04) without its rows: entries and
    sum of ``value`` (times the user row's ``weight``) per user and key.

    A user row takes its whole list, so each list is counted and summed once, before the join: the rows
    joined are user rows and lists, not users x list lengths."""
    on = [on] if isinstance(on, str) else list(on)
    per_list = lists.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    x = user_rows.join(per_list, on)
    s = F.col("_s") if weight is None else F.col(weight) * F.col("_s")
    return x.groupBy("user", on[0]).agg(F.sum("_n").alias("n_items"), F.sum(s).alias(total))


def dedupe_plays(play: DataFrame) -> DataFrame:
    """AGG-08 / SET-03: one play row per (user,item): lower priority wins, then higher score."""
    return play.groupBy("user", "item").agg(
        F.min_by("score", F.struct("priority", -F.col("score"))).alias("score"))


def engaged_seeds(play: DataFrame, subs: DataFrame) -> DataFrame:
    """JOIN-02 / SET-04: played and subscribed (user,item) pairs become seeds (user, seed, score)."""
    p = dedupe_plays(play)
    return (p.join(subs.select("user", "item").distinct(), ["user", "item"], "left_semi")
            .select("user", F.col("item").alias("seed"), "score"))


def arm_lists(sim_base: DataFrame, sim_alt: DataFrame) -> DataFrame:
    """The lists of both arms: (seed, _odd, item, sim, pos)."""
    def one(sim, odd):
        return sim.select(F.col("item").alias("seed"), F.lit(odd).alias("_odd"), F.col("item2").alias("item"), "sim", "pos")
    return one(sim_base, True).unionByName(one(sim_alt, False))


def arm_seeds(seeds: DataFrame, sim_base: DataFrame, sim_alt: DataFrame,
              exceptions: DataFrame | None = None) -> DataFrame:
    """JOIN-03, seed side: odd users (but for the ``exceptions``) belong to the base arm
    (``_odd``), all others to the alternative one.  A seed without a base list is dropped, and
    so is one without the list of its user's arm."""
    odd = F.col("user") % 2 == 1
    s = seeds
    if exceptions is not None:
        s = s.join(exceptions.select("user").distinct().withColumn("_except", F.lit(True)), "user", "left")
        odd = odd & F.col("_except").isNull()
    s = s.withColumn("_odd", odd)
    s = s.select(*seeds.columns, "_odd")
    base = sim_base.select(F.col("item").alias("seed")).distinct()
    lists = base.withColumn("_odd", F.lit(True)).unionByName(
        sim_alt.select(F.col("item").alias("seed")).distinct().withColumn("_odd", F.lit(False)))
    return s.join(base, "seed", "left_semi").join(lists, ["seed", "_odd"], "left_semi")


def arm_lookup(seeds: DataFrame, sim_base: DataFrame, sim_alt: DataFrame) -> DataFrame:
    """JOIN-03: seeds of ``arm_seeds`` with the entries of their arm's list."""
    return seeds.join(arm_lists(sim_base, sim_alt), ["seed", "_odd"]).drop("_odd")


def reason_argmax_sim(expansion: DataFrame) -> DataFrame:
    """AGG-06 (P4): seed with the highest raw similarity, ties by lowest seed id."""
    return expansion.groupBy("user", "item").agg(
        F.max_by("seed", F.struct("sim", -F.col("seed"))).alias("src"))


def reason_first_tag(rows: DataFrame) -> DataFrame:
    """AGG-07 (P3): first tag in the user's list order that yields the item."""
    return rows.groupBy("user", "item").agg(F.min_by("tag", F.col("tag_pos")).alias("src"))


def last_wins(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """AGG-11: keyed load where a later row (by ``order_col``) overwrites an earlier one."""
    return keyed_load(df.withColumnRenamed(order_col, POSITION), key)


def _bit(item: Column) -> Column:
    """Bit number of an item in a user's bitmap."""
    return F.pmod(F.xxhash64(item), F.lit(64 * BITMAP_WORDS)).cast("int")


def candidate_bitmaps(candidates: DataFrame) -> DataFrame:
    """(user, _bits): a bitmap of each user's candidate items, as an array of ``BITMAP_WORDS`` longs.  A
    budget bounds the items of a user, so the bitmap's size is fixed."""
    bit = candidates.select("user", _bit(F.col("item")).alias("b")).select(
        "user", F.shiftright("b", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(63)).alias("v"))
    words = bit.groupBy("user", "word").agg(F.bit_or("v").alias("v"))
    held = words.groupBy("user").agg(F.map_from_entries(F.collect_list(F.struct("word", "v"))).alias("m"))
    every = F.sequence(F.lit(0), F.lit(BITMAP_WORDS - 1))
    bits = F.transform(every, lambda k: F.coalesce(F.element_at("m", k), F.lit(0).cast("long")))
    # no map is empty; named twice, it is made once per user and not inside the lambda, once per word
    return held.select("user", F.when(F.size("m") > 0, bits).alias("_bits"))


def best_sim() -> Column:
    """Similarity and negated seed of the row that ``reason_argmax_sim`` takes."""
    return F.max(F.struct("sim", (-F.col("seed")).alias("_s")))


def reason_argmax_capped(capped: DataFrame, seeds: DataFrame, lists, candidates: DataFrame) -> DataFrame:
    """``candidates`` (user, item, _best, other columns) with ``src`` in place of ``_best``: ``reason_argmax_sim`` over all recalled rows.

    ``_best`` is the best of the rows within the caps (``best_sim`` over ``capped``).  Gate and exclusions are by user and item, so
    an entry of a candidate that a list holds up to the last kept one (``_last``) is a row of ``capped``; only entries
    from there on are looked up in the lists.  They go to where the user's rows lie, and as an array of the user join
    those of the candidates, which a budget bounds: a join on user and item would move the candidates too."""
    last = capped.groupBy("user", "seed").agg(F.max("_last").alias("_last"))
    read = materialise(seeds.join(last, ["user", "seed"]), by="user")  # read by each arm
    after = recalled_rows(read, lists, "seed", candidates, entries=F.col("pos") >= F.col("_last"), placed=True)
    after = after.groupBy("user", "item").agg(best_sim().alias("_best"))
    after = after.groupBy("user").agg(F.collect_list(F.struct("item", "_best")).alias("_after"))
    more = [c for c in candidates.columns if c not in ("user", "item", "_best")]
    x = candidates.groupBy("user").agg(F.collect_list(F.struct("item", "_best", F.lit(True).alias("_c"), *more)).alias("_own"))
    x = x.join(after, "user", "left")
    others = F.transform("_after", lambda e: F.struct(e["item"].alias("item"), e["_best"].alias("_best"), F.lit(False).alias("_c"),
                                                      *[F.lit(None).cast(candidates.schema[c].dataType).alias(c) for c in more]))
    x = x.select("user", F.explode(F.concat("_own", F.coalesce(others, F.array()))).alias("_e")).select("user", "_e.*")
    # at most two rows of an item: max over plain columns is a hash aggregate, over structs a sort
    own, best = F.col("_c"), ("sim", "_s")
    x = x.select("user", "item", "_c", *more, *[F.col(f"_best.{c}").alias(f"_b{c}") for c in best])
    x = x.groupBy("user", "item").agg(
        F.bool_or(own).alias("_c"), F.bool_or(~own).alias("_a"), *[F.max(c).alias(c) for c in more],
        *[F.max(F.when(w, F.col(f"_b{c}"))).alias(f"{n}{c}") for n, w in (("_o", own), ("_l", ~own)) for c in best]).where("_c")
    held, later = (F.struct(*[F.col(f"{n}{c}").alias(c) for c in best]) for n in ("_o", "_l"))
    x = x.withColumn("_best", F.when(F.col("_a"), F.greatest(held, later)).otherwise(held))
    return x.select("user", "item", *more, (-F.col("_best._s")).alias("src"))


def recalled_rows(seeds: DataFrame, lists, on, candidates: DataFrame, carried=(), entries: Column | None = None, placed: bool = False) -> DataFrame:
    """The recalled rows (seeds x lists) of the users' candidates (user, item), for the reasons.

    The rows of ``likely_rows`` are compared with the candidates themselves.  So the shuffle holds about as many rows as there
    are candidates and seeds that recall them, not users x seeds x list lengths.  ``carried``: columns that the rows take from their candidate.
    ``placed``: the candidates lie by user; the rows left go there and are not compared."""
    kept = likely_rows(seeds, lists, on, candidates, entries)
    if placed:
        return kept.repartition(bucket_count(kept.sparkSession), "user")
    return kept.join(candidates.select("user", "item", *carried), ["user", "item"], "inner" if carried else "left_semi")


def likely_rows(seeds: DataFrame, lists, on, candidates: DataFrame, entries: Column | None = None) -> DataFrame:
    """Seeds x lists less nearly all rows whose item is no candidate of the user.

    Each seed row brings its user's bitmap of candidates to the list join, which drops the other
    entries in the task that reads them.  ``lists``: one table, or (which seed rows read it, table) for each arm.
    ``entries``: which joined rows are wanted."""
    arms = lists if isinstance(lists, list) else [(F.lit(True), lists)]
    bits = candidate_bitmaps(candidates)
    bits = materialise(bits, by="user") if len(arms) > 1 else bits  # read by each arm
    own = seeds.join(bits, "user")
    rows = None
    for whose, arm in arms:
        part = own.where(whose).join(arm.withColumn("_b", _bit(F.col("item"))), on)  # once per entry of a list
        part = part if entries is None else part.where(entries)
        rows = part if rows is None else rows.unionByName(part)
    word = F.get("_bits", F.shiftright("_b", 6))
    wanted = F.call_function("shiftright", word, F.col("_b").bitwiseAND(63)).bitwiseAND(F.lit(1)) == 1
    return rows.where(wanted).drop("_b", "_bits")
