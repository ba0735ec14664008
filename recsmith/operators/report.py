"""Conversion report operators (P1): log filter, bucket label, first-touch
attribution, per-user counters and global rates.

Scale notes: clicks and subscribes are both keyed by (user,item); the
first-touch lookup is a partial+final ``min_by`` aggregate, so a hot user or
item is pre-aggregated map-side before the shuffle.  The global report sums
per alg with partial aggregation instead of funnelling every row to one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith import params as P

CLICK = P.CLICK_ACTION
SUBSCRIBE = P.SUBSCRIBE_ACTION


def log_filter(log: DataFrame, action: str, scene: str, os: str = "all", day=None) -> DataFrame:
    """FLT-01: scene equal, action equal, day equal (if given), os equal ignoring case or 'all'."""
    cond = (F.col("scene") == scene) & (F.col("action") == action)
    if day is not None:
        cond = cond & (F.col("day") == F.lit(day).cast("date"))
    if os.lower() != "all":
        cond = cond & (F.lower(F.col("os")) == os.lower())
    return log.where(cond)


def bucket_label(alg: Column, user: Column, n_buckets: int) -> Column:
    """FLT-07: alg -> alg_r for r = user % n in 0..5 when n != -1 and user > 0."""
    if n_buckets == -1:
        return alg
    r = user % n_buckets
    return F.when((user > 0) & r.isin(*P.BUCKET_LABELS),
                  F.concat_ws("_", alg, r.cast("string"))).otherwise(alg)


def clicks(log: DataFrame, scene: str, os: str = "all", day=None, n_buckets: int = -1) -> DataFrame:
    """Filtered click rows with the reserved-char rule (FLT-02) and bucket label applied."""
    c = log_filter(log, CLICK, scene, os, day).where(~F.col("alg").contains(":"))
    return c.withColumn("alg", bucket_label(F.col("alg"), F.col("user"), n_buckets))


def subscribes(log: DataFrame, scene: str, os: str = "all", day=None) -> DataFrame:
    return log_filter(log, SUBSCRIBE, scene, os, day)


def click_stats(clicks_df: DataFrame, keys=("user", "item")) -> DataFrame:
    """One partial + final aggregate over the clicks: per (keys, alg) the click count and
    the earliest (ts, event_id).  Both the first-touch lookup and the click totals read it,
    so the click log is scanned once."""
    return clicks_df.groupBy(*keys, "alg").agg(F.count(F.lit(1)).alias("_n"),
                                               F.min(F.struct("ts", "event_id")).alias("_first"))


def first_touch_from_stats(stats: DataFrame, keys=("user", "item")) -> DataFrame:
    """JOIN-05 build side from ``click_stats``: alg of the earliest click per key."""
    return stats.groupBy(*keys).agg(F.min_by("alg", "_first").alias("alg"),
                                     F.min("_first.ts").alias("first_ts"))


def click_counts(stats: DataFrame, keys) -> DataFrame:
    """AGG-01 from ``click_stats``."""
    return stats.groupBy(*keys).agg(F.sum("_n").alias("clicks"))


def attribute(subs_df: DataFrame, first: DataFrame, keys=("user", "item"),
              require_click_first: bool = False) -> DataFrame:
    """Credit every subscribe row to the first-touch alg of its (user,item).

    The reference credits a subscribe even when it precedes the click;
    ``require_click_first`` keeps only subscribes at or after the first click.
    """
    j = subs_df.select(*keys, "ts").join(first, list(keys))
    if require_click_first:
        j = j.where(F.col("ts") >= F.col("first_ts"))
    return j.drop("first_ts")


def per_user_counts(stats: DataFrame, credited: DataFrame, extra_keys=()) -> DataFrame:
    """AGG-01/02: (user, alg, subs, clicks) from ``click_stats``; algs without clicks never appear."""
    k = list(extra_keys) + ["user", "alg"]
    c = click_counts(stats, k)
    s = credited.groupBy(*k).agg(F.count(F.lit(1)).alias("subs"))
    return (c.join(s, k, "left")
            .select(*k, F.coalesce("subs", F.lit(0)).cast("long").alias("subs"), "clicks"))


def rate_report(stats: DataFrame, credited: DataFrame, extra_keys=()) -> DataFrame:
    """AGG-03: per alg totals and rate from ``click_stats`` (no per-user intermediate)."""
    k = list(extra_keys) + ["alg"]
    c = click_counts(stats, k)
    s = credited.groupBy(*k).agg(F.count(F.lit(1)).alias("subs"))
    return (c.join(s, k, "left")
            .select(*k, F.coalesce("subs", F.lit(0)).cast("long").alias("subs"), "clicks")
            .withColumn("rate", F.col("subs") / F.col("clicks")))


def report_lines(report: DataFrame) -> DataFrame:
    """SNK-03 text layout ``alg#subs#clicks#rate`` (rate to 6 places)."""
    return report.select(F.concat_ws("#", "alg", F.col("subs").cast("string"),
                                     F.col("clicks").cast("string"),
                                     F.format_string("%.6f", F.round("rate", 6))).alias("value"))


def packed_user_lines(per_user: DataFrame) -> DataFrame:
    """SNK-02 text layout ``user<TAB>alg:subs:clicks,...`` (algs in name order)."""
    e = F.concat_ws(":", "alg", F.col("subs").cast("string"), F.col("clicks").cast("string"))
    g = per_user.groupBy("user").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("alg", e.alias("e")))),
                                 lambda x: x["e"]), ",").alias("packed"))
    return g.select(F.concat_ws("\t", F.col("user").cast("string"), "packed").alias("value"))
