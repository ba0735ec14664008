"""Properties of the ranked lists: whole-table invariants at sf0.01."""
import pytest
from pyspark.sql import functions as F

from recsmith import catalog, params as P
from recsmith.operators import filters as FL
from recsmith.sources.views import Tables

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lists(spark):
    return {n: catalog.QUERIES[n](spark, SF).cache() for n in ("rec_by_seed", "rec_by_tag", "rec_by_liked")}


@pytest.mark.parametrize("name,top", [("rec_by_seed", P.TOP_P2), ("rec_by_tag", P.MAX_REC_P3),
                                      ("rec_by_liked", P.TOP_P4)])
def test_ranks_contiguous_and_bounded(lists, name, top):
    g = lists[name].groupBy("user").agg(F.count("*").alias("n"), F.max("rank").alias("mx"),
                                        F.countDistinct("item").alias("d")).collect()
    assert g and all(r.n == r.mx == r.d and r.n <= top for r in g)


@pytest.mark.parametrize("name,days", [("rec_by_seed", P.ACTIVE_DAYS_P2), ("rec_by_tag", P.ACTIVE_DAYS_P3),
                                       ("rec_by_liked", P.ACTIVE_DAYS_P4)])
def test_only_active_users_and_no_seen_items(spark, lists, name, days):
    t = Tables(spark, SF)
    users = FL.active_users(t.active(), P.AS_OF, days)
    assert lists[name].join(users, "user", "left_anti").count() == 0
    seen = FL.seen_pairs(t.visited(), P.max_impress())
    assert lists[name].join(seen, ["user", "item"], "left_semi").count() == 0


def test_blocked_items_never_recommended(spark, lists):
    t = Tables(spark, SF)
    blocked = FL.candidate_items(t.blocklist(), FL.first_n(t.first_block()))
    for n in ("rec_by_tag", "rec_by_liked"):
        assert lists[n].join(blocked, "item", "left_semi").count() == 0


def test_click_total_matches_filtered_rows(spark):
    t = Tables(spark, SF)
    rep = catalog.QUERIES["conversion_report"](spark, SF)
    clicks = t.clicklog().where((F.col("action") == "recommendclick") & ~F.col("alg").contains(":")).count()
    assert rep.agg(F.sum("clicks")).collect()[0][0] == clicks


@pytest.mark.parametrize("name", ["rec_by_seed", "rec_by_tag", "rec_by_liked", "diversity_step"])
def test_same_result_with_any_partitioning(spark, name):
    """Sums do not depend on the order of rows, so ties fall alike in 1, 3 and 16 partitions."""
    results = []
    try:
        for n in ("1", "3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(tuple, catalog.QUERIES[name](spark, SF_SMALL).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] and results[0] == results[1] == results[2]


def test_time_zone_independent(spark):
    """as_of thresholds are zone-free: a non-UTC session gives the same rows."""
    a = sorted(tuple(r) for r in catalog.QUERIES["active_users"](spark, SF).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        b = sorted(tuple(r) for r in catalog.QUERIES["active_users"](spark, SF).collect())
        c = sorted(tuple(r) for r in catalog.QUERIES["impression_window"](spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert a == b
    assert c == sorted(tuple(r) for r in catalog.QUERIES["impression_window"](spark, SF).collect())


def test_tag_route_skips_history_and_recent_impressions(spark, lists):
    t = Tables(spark, SF)
    hist = FL.history_first(t.history()).select("user", "item")
    shown = FL.impression_window(t.impressions(), P.AS_OF, *P.IMPRESS_WINDOW_P3)
    assert lists["rec_by_tag"].join(hist, ["user", "item"], "left_semi").count() == 0
    assert lists["rec_by_tag"].join(shown, ["user", "item"], "left_semi").count() == 0
    assert lists["rec_by_seed"].join(FL.impression_window(t.impressions(), P.AS_OF, *P.IMPRESS_WINDOW_P2),
                                     ["user", "item"], "left_semi").count() == 0
