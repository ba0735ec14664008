"""Click -> subscribe conversion report per recommendation algorithm."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recsmith.operators import report as R


def conversion_report(log: DataFrame, scene: str = "user-playlist", os: str = "all", day=None,
                      n_buckets: int = -1, by_day: bool = False,
                      require_click_first: bool = False) -> DataFrame:
    """(alg, subs, clicks, rate) for one scene / os / day (``day=None``: every day).

    ``by_day=True`` runs the one-day report for every day at once: attribution
    and totals are then keyed by ``day`` as well.
    """
    keys = ("day", "user", "item") if by_day else ("user", "item")
    extra = ("day",) if by_day else ()
    stats = R.click_stats(R.clicks(log, scene, os, day, n_buckets), keys)
    s = R.subscribes(log, scene, os, day)
    credited = R.attribute(s, R.first_touch_from_stats(stats, keys), keys, require_click_first)
    return R.rate_report(stats, credited, extra)


def conversion_by_user(log: DataFrame, scene: str = "user-playlist", os: str = "all", day=None,
                       n_buckets: int = -1) -> DataFrame:
    """Stage-1 output: (user, alg, subs, clicks)."""
    stats = R.click_stats(R.clicks(log, scene, os, day, n_buckets))
    s = R.subscribes(log, scene, os, day)
    credited = R.attribute(s, R.first_touch_from_stats(stats))
    return R.per_user_counts(stats, credited)
