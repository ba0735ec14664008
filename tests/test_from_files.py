"""Jobs from text files in the input layouts to output lines, worked out by hand."""
import datetime as dt

from pyspark.sql import functions as F

from recsmith.operators.report import report_lines
from recsmith.plans.by_seed import SeedInputs, recommend_by_seed
from recsmith.plans.conversion import conversion_report
from recsmith.sources import lines as L
from recsmith.sources import text as TX

AS_OF = dt.datetime(2024, 1, 31)


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_conversion_report_from_files(spark, tmp_path):
    click = "user-playlist\trecommendclick\t{}\t{}\t{}\t2024-01-30\tandroid"
    sub = "user-playlist\tsubscribe\t{}\t{}\t2024-01-30\tandroid"
    p = _write(tmp_path / "log.txt", [
        click.format(1, 10, "a"), click.format(1, 10, "b"), click.format(1, 11, "b"), click.format(2, 10, "b"),
        click.format(2, 12, "x:y"), "broken", sub.format(1, 10), sub.format(2, 10), sub.format(2, 99),
        sub.format(2, 10).replace("01-30", "01-29")])
    lines = report_lines(conversion_report(TX.read_log(spark, p), day="2024-01-30"))
    TX.write_lines(lines, str(tmp_path / "out"))
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    # a: the first click on (1, 10); b: clicks on (1, 10), (1, 11), (2, 10), credited with (2, 10)
    assert got == ["a#1#1#1.000000", "b#1#3#0.333333"]


def test_recommend_by_seed_from_files(spark, tmp_path):
    seeds = _write(tmp_path / "seeds.txt", ["1\t5:9:1700000000,6:3,7:1", "-2\t6:2", "3\t5:1"])
    lists = _write(tmp_path / "lists.txt", ["5\t100:0.9,101:0.8,102:0.7", "6\t102:0.6,103:0.5"])
    seen = _write(tmp_path / "visited.csv", ["1,101,2", "1,102,-1", "x,1,1"])
    active = _write(tmp_path / "active.txt", ["1\t1706659200", "2\t1706659300", "3\t1600000000"])
    gated = _write(tmp_path / "gated.txt", ["103"])
    segment = _write(tmp_path / "segment.txt", ["-2"])
    sim = TX.read_packed(spark, lists)
    one = [1.0] * 61  # user block 56, item block 2, rate, lan, style
    none = spark.createDataFrame([], "item long, src string, rate double")
    inputs = SeedInputs(
        active=TX.read_lines(spark, active, L.last_active), user_seed=TX.read_user_seeds(spark, seeds),
        seed_item=sim.select(F.col("key").alias("seed"), F.col("id").try_cast("long").alias("item"),
                             F.col("score").alias("sim"), "pos"),
        visited=TX.read_visited(spark, seen),
        impressions=spark.createDataFrame([(2, 102, dt.date(2024, 1, 30))], "user long, item long, dt date"),
        gated=TX.read_id_set(spark, gated).withColumnRenamed("id", "item"),
        segment=TX.read_id_set(spark, segment, users=True).withColumnRenamed("id", "user"),
        item_feat=spark.createDataFrame([(i, [0, 0]) for i in range(100, 104)], "item long, bits array<int>"),
        user_feat=spark.createDataFrame([], "user long, feats array<int>"), rate=none,
        user_aff=spark.createDataFrame([], "user long, kind string, tag string, ratio double"),
        item_aff=spark.createDataFrame([], "item long, kind string, tag string, ratio double"),
        pay=spark.createDataFrame([], "item long, money double, click double"))
    ranked = recommend_by_seed(inputs, AS_OF, one, 2, 10, 9, None, 1, (1, 60), max_impress=2)
    rows = {(r.user, r.item): (r.rank, r.src) for r in ranked.collect()}
    # user 1: 101 was clicked, 103 is gated (not in the segment), 102 was shown once (kept, smaller
    # score; seed 5 is its reason); seed 7 has no list.  user 2: 102 shown yesterday, 103 is open to the
    # segment.  user 3 is not active.
    assert rows == {(1, 100): (1, 5), (1, 102): (2, 5), (2, 103): (1, 6)}
    lines = sorted(r.value for r in TX.ranked_lines(ranked.withColumn("score", F.format_string("%.1f", "score"))).collect())
    assert [x.split("\t")[0] for x in lines] == ["1", "2"] and lines[1].endswith(":6")
