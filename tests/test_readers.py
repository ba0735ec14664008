"""Text layouts of the reference read from small files (SRC-01..19, FLT-03..06, SNK-*)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from recsmith.operators import filters as FL
from recsmith.plans.conversion import conversion_report
from recsmith.sources import lines as L
from recsmith.sources import text as TX


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_tab_and_visited(spark, tmp_path):
    p = _write(tmp_path / "log.txt", ["s\trecommendclick\t7\t1\ta\t2024-01-05\tandroid", "short\tline"])
    df = TX.read_tab(spark, p, "scene string, action string, user long, item long, alg string, day date, os string")
    assert df.where(F.col("user").isNotNull()).count() == 1
    v = _write(tmp_path / "visited.csv", ["-7,1,2", "8,2,-3", "x,1,1"])
    got = sorted((r.user, r.item, r.score) for r in TX.read_visited(spark, v).collect())
    assert got == [(7, 1, 2), (8, 2, -3)]


def test_multi_day_partition_pruning(spark, tmp_path):
    for d in ("2024-01-28", "2024-01-29", "2024-01-30"):
        (tmp_path / f"dt={d}").mkdir()
        _write(tmp_path / f"dt={d}" / "part.txt", [f"1\t{d[-2:]}"])
    df = TX.read_days(spark, str(tmp_path), "user long, item long", dt.datetime(2024, 1, 31), 1, 2)
    assert sorted(r.item for r in df.collect()) == [29, 30]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dt" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_packed_promoted_history_quality(spark, tmp_path):
    p = _write(tmp_path / "sim.txt", ["5\t1:0.5,2:0.25,bad", "6\t3:x"])
    got = sorted((r.key, r.id, r.score) for r in TX.read_packed(spark, p).collect())
    assert got == [(5, "1", 0.5), (5, "2", 0.25)]
    r = _write(tmp_path / "rate.txt", ["9\tfoo\ts1:x:0.2,s2:0.3,s3:y:0.4"])
    got = sorted((x.item, x.src, x.rate) for x in TX.read_promoted_rate(spark, r, 2).collect())
    assert got == [(9, "s1", 0.2), (9, "s3", 0.4)]
    h = _write(tmp_path / "hist.txt", ["-3\t10:0.9:rock,11:0.8:pop,12:0.7:jazz"])
    got = sorted((x.user, x.item, x.tag) for x in TX.read_history(spark, h).collect())
    assert got == [(3, 10, "rock"), (3, 11, "pop")]
    q = _write(tmp_path / "q.txt", ["4\t0.5\tz\t30"])
    assert TX.read_quality(spark, q).collect()[0].create_days == 30


def test_id_sets_ranked_optional_header(spark, tmp_path):
    ids = _write(tmp_path / "ids.txt", [" 5", "-6", "x", "5"])
    assert sorted(r.id for r in TX.read_id_set(spark, ids, users=True).collect()) == [5, 6]
    ranked = _write(tmp_path / "rank.txt", [f"{i}\t{100 + i}" for i in range(60)])
    assert TX.read_ranked_ids(spark, ranked).count() == 50
    assert TX.optional(spark, "null", "user long, item long", TX.read_visited).count() == 0
    meta = _write(tmp_path / "meta.txt", ["user,bigint,id,x", "a comment", "newSongType,string,type,x", "newSongWeight,float,w,x"])
    data = _write(tmp_path / "portrait.txt", ["-7\tpop\t1.5", "8", "9\tpop\tx"])
    got = [(r.user, r.newSongWeight) for r in TX.header_pick(spark, meta, data).collect()]
    assert got == [(7, 1.5)]


def test_log_reader_and_rejects(spark, tmp_path):
    """Click: alg, day, os behind the item; subscribe: day, os."""
    p = _write(tmp_path / "log.txt", [
        "user-playlist\trecommendclick\t7\t1\ta\t2024-01-05\tandroid",
        "user-playlist\trecommendclick\t7\t1\tb\t2024-01-05\tandroid",
        "user-playlist\tsubscribe\t7\t1\t2024-01-05\tiPhone", "short\tline",
        "user-playlist\trecommendclick\t7\t1\ta", "user-playlist\tsubscribe\tx\t1\t2024-01-05\tiPhone"])
    log = TX.read_log(spark, p)
    assert sorted((r.action, r.user, r.item, r.alg, str(r.day), r.os) for r in log.collect()) == [
        ("recommendclick", 7, 1, "a", "2024-01-05", "android"), ("recommendclick", 7, 1, "b", "2024-01-05", "android"),
        ("subscribe", 7, 1, None, "2024-01-05", "iPhone")]
    assert tuple(L.rejects(L.log(spark.read.text(p))).first()) == (6, 3)
    rep = {r.alg: (r.subs, r.clicks) for r in conversion_report(log, day="2024-01-05").collect()}
    assert rep == {"a": (1, 1), "b": (0, 1)}  # the first line wins the credit


def test_seed_profile_affinity_readers(spark, tmp_path):
    s = _write(tmp_path / "seeds.txt", ["-12\t5:0.5:1500000000,6:2,7,8:x"])
    assert sorted(tuple(r) for r in TX.read_user_seeds(spark, s).collect()) == [(12, 5, 0.5), (12, 6, 2.0)]
    p = _write(tmp_path / "profile.txt", ["3\t9:1.5,:2,10:"])
    assert [tuple(r) for r in TX.read_lines(spark, p, L.play_profile).collect()] == [(3, 9, 1.5, 0)]
    u = _write(tmp_path / "aff.txt", ["-4\trock:0.5,:1,pop", "4\tlan\ten:0.25", "4\tother\ten:0.25"])
    got = sorted(tuple(r) for r in TX.read_lines(spark, u, L.user_affinity).collect())
    assert got == [(4, "lan", "en", 0.25), (4, "style", "rock", 0.5)]
    i = _write(tmp_path / "item.txt", ["8\ten:1.0\trock:0.5,:3"])
    assert sorted(tuple(r) for r in TX.read_lines(spark, i, L.item_affinity).collect()) == [
        (8, "lan", "en", 1.0), (8, "style", "rock", 0.5)]
    a = _write(tmp_path / "active.txt", ["-5\t1706659200", "6\tnever"])
    assert [(r.user, r.last_ts) for r in TX.read_lines(spark, a, L.last_active).collect()] == [(5, dt.datetime(2024, 1, 31))]


def test_weights_and_attributes(spark, tmp_path):
    w = _write(tmp_path / "w.txt", ["[0.5, -1,2]"])
    assert TX.read_weights(spark, w, 3).first().w == [0.5, -1.0, 2.0]
    two = _write(tmp_path / "w2.txt", ["[1]", "[2]"])
    for bad in (lambda: TX.read_weights(spark, two).collect(), lambda: TX.read_weights(spark, w, 4).collect()):
        with pytest.raises(Exception):
            bad()
    j = _write(tmp_path / "attr.txt", ['1\t{"avgPubTime": 12, "score": 0.5}', '2\t{"score": 0.5}', "3\t{bad",
                                       '4\t{"avgPubTime": 1, "score": 1}\tx'])
    assert [tuple(r) for r in TX.read_lines(spark, j, L.attributes).collect()] == [(1, 12, 0.5)]
    m = _write(tmp_path / "pay.txt", ["(7,0.1,Infinity)", "(8,x,1)", "(9"])
    assert [tuple(r) for r in TX.read_lines(spark, m, L.pay).collect()] == [(7, 0.1, float("inf"))]


def test_log_filters(spark, tmp_path):
    # action, user, song, type, source, list, log time, os, time
    rest = "\t1700000000\tandroid\t30"
    plays = _write(tmp_path / "plays.txt", [
        "play\t-7\t555\tsong\tlist\t9001" + rest, "play\t0\t1\tsong\tlist\t9" + rest,
        "play\t8\t5\tsong\tlist\t12a" + rest, "play\t9\t5\tvideo\tlist\t9" + rest,
        "play\t9\t5\tsong\tlist\t" + rest, "play\t9\t5\tsong\tlist\t" + "9" * 20 + rest, "play\t9\t5\tsong\tlist"])
    got = [(r.user, r.item, r.score) for r in FL.play_log(spark.read.text(plays)).collect()]
    assert got == [(7, 9001, 0.05)]
    imp = _write(tmp_path / "imp.txt", ["x\tuser-playlist\t-4\t77", "x\tother\t5\t6"])
    assert [(r.user, r.item) for r in FL.impression_log_filter(spark.read.text(imp)).collect()] == [(4, 77)]
    subs = spark.createDataFrame([(1, 2, 3, 1), (-1, 2, 3, 1), (1, 2, 3, 5)], "user long, item long, time long, type int")
    assert FL.subscription_filter(subs).count() == 1


def test_sinks_roundtrip(spark, tmp_path):
    ranked = spark.createDataFrame([(1, 1, 10, "0.5000", 3), (1, 2, 11, "0.2500", 4)],
                                   "user long, rank long, item long, score string, src long")
    line = TX.ranked_lines(ranked).collect()[0].value
    assert line == "1\t10:0.5000:3,11:0.2500:4"
    TX.write_lines(TX.ranked_lines(ranked), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 1
