"""Row restrictions and exclusions (FLT-*, SET-*), DataFrame in -> DataFrame out.

Exclusions are left-anti joins on (user,item) or item; restrictions are
left-semi joins.  Join strategies are left to the planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith import params as P
from recsmith.functions.scoring import as_of_date, midnight_threshold
from recsmith.operators.keyed import POSITION, keyed_load


def active_users(active: DataFrame, as_of, days: int) -> DataFrame:
    """FLT-08: users whose last activity is at or after midnight(as_of) - days."""
    return active.where(F.col("last_ts") >= midnight_threshold(as_of, days)).select("user")


def only_active(df: DataFrame, users: DataFrame) -> DataFrame:
    """JOIN-09: left-semi on user (done before any expansion)."""
    return df.join(users, "user", "left_semi")


def seen_pairs(visited: DataFrame, max_impress: int) -> DataFrame:
    """FLT-09: (user,item) clicked (score >= 1) or shown at least ``max_impress`` times."""
    return visited.where((F.col("score") >= 1) | (F.col("score") <= -max_impress)).select("user", "item")


def impression_window(impress: DataFrame, as_of, lo: int, hi: int) -> DataFrame:
    """FLT-10 / SRC-03: distinct (user,item) shown between ``hi`` and ``lo`` days before ``as_of``."""
    d = as_of_date(as_of)
    return (impress.where(F.col("dt").between(F.date_sub(d, hi), F.date_sub(d, lo)))
            .select("user", "item").distinct())


def exclusion_pairs(*pair_sets: DataFrame) -> DataFrame:
    """SET-01: union of (user,item) exclusion sets."""
    out = pair_sets[0].select("user", "item")
    for s in pair_sets[1:]:
        out = out.unionByName(s.select("user", "item"))
    return out.distinct()


def exclude_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """JOIN-08: left-anti on (user,item)."""
    return df.join(pairs.select("user", "item"), ["user", "item"], "left_anti")


def exclude_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """FLT-12: left-anti on item."""
    return df.join(items.select("item"), "item", "left_anti")


def first_n(ordered: DataFrame, n: int = P.FIRST_BLOCK_N) -> DataFrame:
    """SRC-17 / TOP-03: the first ``n`` ids of an explicitly ranked list."""
    return ordered.where(F.col("rank") < n).select("item")


def history_first(history: DataFrame, k: int = P.HISTORY_FIRST) -> DataFrame:
    """SRC-08: (user,item,tag,pos) for the first ``k`` entries of yesterday's packed list."""
    e = history.select("user", F.posexplode(F.split("packed", ",")).alias("pos", "entry"))
    parts = F.split("entry", ":")
    return (e.where(F.col("pos") < k)
            .select("user", F.expr("try_cast(split(entry, ':')[0] AS BIGINT)").alias("item"),
                    F.element_at(parts, 3).alias("tag"), F.col("pos").cast("long").alias("pos"))
            .where(F.col("item").isNotNull()))


def segment_gate(df: DataFrame, gated: DataFrame, segment: DataFrame) -> DataFrame:
    """FLT-15: gated items are kept only for users in the allowed segment."""
    g = gated.select("item").distinct().withColumn("_gated", F.lit(True))
    s = segment.select("user").distinct().withColumn("_member", F.lit(True))
    j = df.join(g, "item", "left").join(s, "user", "left")
    keep = ~(F.coalesce("_gated", F.lit(False)) & ~F.coalesce("_member", F.lit(False)))
    return j.where(keep).drop("_gated", "_member")


def quality_gate(df: DataFrame, quality: DataFrame) -> DataFrame:
    """FLT-13: the item needs a quality row with score != 0 (adds score, create_days)."""
    q = keyed_load(quality.select("item", F.col("score").alias("q_score"), "create_days", *position(quality)), "item")
    return df.join(q, "item").where(F.col("q_score") != 0)


def coverage(candidate_items: DataFrame, quality: DataFrame) -> DataFrame:
    """AGG-09: one row (n_quality, n_candidates, gate_on)."""
    cand = candidate_items.select("item").distinct()
    nq = quality.select("item").distinct().join(cand, "item", "left_semi").agg(F.count(F.lit(1)).alias("n_quality"))
    nc = cand.agg(F.count(F.lit(1)).alias("n_candidates"))
    # the candidate count enters as a scalar subquery (one value)
    out = nq.select("n_quality", nc.select("n_candidates").scalar().alias("n_candidates"))
    return out.withColumn("gate_on", F.col("n_quality") > F.floor(F.col("n_candidates") / 2))


def quality_gate_if_covered(df: DataFrame, quality: DataFrame, candidate_items: DataFrame) -> DataFrame:
    """FLT-14: apply FLT-13 only when quality covers more than half the candidate items.

    The coverage flag is a scalar subquery (one value), not a join.
    """
    gate_on = coverage(candidate_items, quality).select("gate_on").scalar()
    q = keyed_load(quality.select("item", F.col("score").alias("q_score"), *position(quality)), "item")
    j = df.join(q, "item", "left")
    ok = F.col("q_score").isNotNull() & (F.col("q_score") != 0)
    return j.where(~gate_on | ok).drop("q_score")


def user_age_limit(df: DataFrame, limits: DataFrame, age_col: str = "create_days") -> DataFrame:
    """FLT-17: users with a limit lose items older than their ``max_days``."""
    j = df.join(keyed_load(limits.select("user", "max_days", *position(limits)), "user"), "user", "left")
    return j.where(F.col("max_days").isNull() | (F.col(age_col) <= F.col("max_days"))).drop("max_days")


def restricted_lookup(lookup: DataFrame, candidate_items: DataFrame) -> DataFrame:
    """FLT-19: keep lookup rows only for items that can be recalled."""
    return lookup.join(candidate_items.select("item").distinct(), "item", "left_semi")


def candidate_items(*item_cols: DataFrame) -> DataFrame:
    """SET-02: distinct union of item columns."""
    out = item_cols[0]
    for d in item_cols[1:]:
        out = out.unionByName(d)
    return out.distinct()


def affinity_threshold(user_aff: DataFrame, min_ratio: float = P.AFFINITY_MIN,
                       ignored=P.AFFINITY_IGNORED) -> DataFrame:
    """FLT-16: user weight > 0.03; style literals 'unknow' / 'null' dropped."""
    if not ignored:
        return user_aff.where(F.col("ratio") > min_ratio)
    bad = (F.col("kind") == "style") & F.col("tag").isin(*ignored)
    return user_aff.where((F.col("ratio") > min_ratio) & ~bad)


def valid_play(action: Column, typ: Column, source: Column, user: Column, item: Column) -> Column:
    """FLT-03 predicate: play of a song from a list, user != 0, item all digits."""
    return ((action == P.PLAY_ACTION) & (typ == P.PLAY_TYPE) & (source == P.PLAY_SOURCE) & (user != 0)
            & item.rlike("^[0-9]+$"))


def subscription_filter(subs: DataFrame) -> DataFrame:
    """FLT-04: drop rows with user < 0 or type = 5; keep (item, user, time)."""
    return subs.where((F.col("user") >= 0) & (F.col("type") != 5)).select("item", "user", "time")


def impression_log_filter(lines: DataFrame, marker: str = P.IMPRESSION_MARKER) -> DataFrame:
    """FLT-05: impression rows carry ``marker``; user = abs(column 2), item = column 3."""
    cols = F.split("value", "\t")
    return (lines.where(F.col("value").contains(marker))
            .select(normal_user(F.get(cols, F.lit(2))).alias("user"),
                    F.get(cols, F.lit(3)).try_cast("long").alias("item"))
            .where(F.col("user").isNotNull() & F.col("item").isNotNull()))


def position(df: DataFrame) -> list[str]:
    """The column with the order of a lookup's rows, where it has one (see ``operators.keyed``)."""
    return [POSITION] if POSITION in df.columns else []


def normal_user(user: Column) -> Column:
    """FLT-06: the one sign rule for user ids of any input (Q-11); unparsable -> null."""
    return F.abs(user.try_cast("long"))


def play_log(lines: DataFrame) -> DataFrame:
    """FLT-03: ``action, user, song, type, source, list, ...`` play rows (tab-separated) ->
    (user, item, score 0.05, priority 1); the item is the list that was played from
    (column 5), the user id loses its sign."""
    c = F.split("value", "\t")
    at = lambda n: F.get(c, F.lit(n))
    user, item = normal_user(at(1)), at(5)
    ok = valid_play(at(0), at(3), at(4), F.coalesce(user, F.lit(0)), F.coalesce(item, F.lit("")))
    return (lines.where(ok)
            .select(user.alias("user"), item.try_cast("long").alias("item"),
                    F.lit(P.LOG_PLAY_SCORE).alias("score"), F.lit(1).alias("priority"))
            .where(F.col("item").isNotNull()))
