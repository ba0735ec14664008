"""Diversity windows, quota interleave, head re-rank and top-N (WIN-06..10, TOP-01).

All windows are partitioned by ``user`` (and reason); inputs are already cut
to a bounded candidate set per user (budget / caps), so each window partition
is small.  Ties are broken by item id so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith import params as P


def _by_score(*part):
    return Window.partitionBy(*part).orderBy(F.desc("score"), "item")


def diversity_harmonic(df: DataFrame, reason: str = "src") -> DataFrame:
    """WIN-06: score / n, n = 1-based rank within (user, reason) by score."""
    n = F.row_number().over(_by_score("user", reason))
    return df.withColumn("score", F.col("score") / n)


def diversity_step(df: DataFrame, reason: str = "src", step: float = P.DIVERSITY_STEP) -> DataFrame:
    """WIN-07: c = 0-based rank within (user, reason); c >= 2 -> score / (step * c)."""
    c = F.row_number().over(_by_score("user", reason)) - 1
    return df.withColumn("score", F.when(c >= 2, F.col("score") / (c * step)).otherwise(F.col("score")))


def adaptive_quota(max_rec: int, n_reasons: Column, lo: int = P.QUOTA_MIN, hi: int = P.QUOTA_MAX) -> Column:
    """WIN-09: clamp(max_rec div n_reasons, lo, hi)."""
    q = (F.lit(max_rec) / n_reasons).cast("long")
    return F.greatest(F.lit(lo), F.least(F.lit(hi), q))


def quota_interleave(df: DataFrame, max_rec: int, reason: str = "src",
                     n_reasons_col: str = "n_reasons") -> DataFrame:
    """WIN-08: by score, the c-th item of a reason (0-based) is dropped when c >= quota and
    otherwise scored -c + score / (10 c) for c >= 1; the first ``max_rec`` kept items (in
    pre-penalty order) are then re-sorted by the new score -> round-robin over reasons."""
    quota = adaptive_quota(max_rec, F.col(n_reasons_col))
    c = F.row_number().over(_by_score("user", reason)) - 1
    kept = df.withColumn("_c", c).where(F.col("_c") < quota)
    kept = (kept.withColumn("_k", F.row_number().over(_by_score("user")))
            .where(F.col("_k") <= max_rec))
    new = F.when(F.col("_c") >= 1, -F.col("_c") + F.col("score") / (F.col("_c") * P.QUOTA_PENALTY)
                 ).otherwise(F.col("score"))
    return kept.withColumn("score", new).drop("_c", "_k")


def head_rerank(df: DataFrame, boost: Column, treated: Column, head_n: int = P.HEAD_N,
                factor: float = P.PAY_P2_HEAD[2], upto: int | None = None) -> DataFrame:
    """WIN-10: for treated users, the first ``head_n`` get (boost + score) / (1 + factor) and
    are re-sorted among themselves; the tail keeps its place.  Adds ``rank`` (1-based).

    ``upto``: only the rows of the first ``upto`` ranks are wanted; as only the head changes places, those behind both
    are dropped before the second sort."""
    r = F.row_number().over(_by_score("user"))
    x = df.withColumn("_r", r)
    x = x if upto is None else x.where(F.col("_r") <= max(upto, head_n))
    head = F.col("_r") <= head_n
    new = F.when(treated & head, (boost + F.col("score")) / (1.0 + factor)).otherwise(F.col("score"))
    x = x.withColumn("score", new).withColumn("_head", head.cast("int"))
    w = Window.partitionBy("user").orderBy(F.desc("_head"), F.desc("score"), "_r")
    return x.withColumn("rank", F.row_number().over(w).cast("long")).drop("_r", "_head")


def top_n(df: DataFrame, n: int, rank_col: str | None = None) -> DataFrame:
    """TOP-01: the first ``n`` rows per user (by ``rank_col`` when given, else score desc,
    item asc); ``rank`` is 1-based."""
    if rank_col is None:
        df = df.withColumn("rank", F.row_number().over(_by_score("user")).cast("long"))
    elif rank_col != "rank":
        df = df.withColumnRenamed(rank_col, "rank")
    return df.where(F.col("rank") <= n)
