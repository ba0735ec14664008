"""Reader queries: text lines in the input layouts, built from the test tables with bad lines put
in by rule (keys divisible by 11), parsed back, against an oracle over the same tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from recsmith import params as P
from recsmith.catalog import _p1_sql, r6, register
from recsmith.catalog_ops import CHUNK, _halves, _lr_sql, _pair_features
from recsmith import oracle_chains as OC
from recsmith.functions import scoring as S
from recsmith.operators import candidates as C
from recsmith.operators import features as X
from recsmith.operators import filters as FL
from recsmith.operators.keyed import POSITION, keyed_load
from recsmith.oracle_views import with_views
from recsmith.plans import conversion as conv
from recsmith.session import app_id, checkpoint_dir
from recsmith.sources import lines as L
from recsmith.sources import text as TX
from recsmith.sources.views import Tables

BAD = 11


def sql(views, final, extra=None):
    return with_views(views, extra) + final


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _lines(df, sep, *cols, bad=None, instead=None, keep=()):
    """Text lines of ``cols``; where ``bad`` holds, the line is ``instead``."""
    line = F.concat_ws(sep, *[_s(c) for c in cols])
    if bad is not None:
        line = F.when(bad, instead).otherwise(line)
    return df.select(line.alias("value"), *keep)


def _signed(c):
    """Every other user id is written with a minus sign."""
    return F.when(F.col(c) % 2 == 0, -F.col(c)).otherwise(F.col(c))


def log_lines(t: Tables):
    e = t.clicklog().withColumn("d", F.date_format("day", "yyyy-MM-dd"))
    click = F.concat_ws("\t", "scene", "action", _s("user"), _s("item"), "alg", "d", "os")
    sub = F.concat_ws("\t", "scene", "action", _s("user"), _s("item"), "d", "os")
    short = F.concat_ws("\t", "scene", "action")
    line = F.when(F.col("event_id") % BAD == 0, short).when(F.col("action") == P.CLICK_ACTION, click).otherwise(sub)
    return e.select(line.alias("value"), "event_id")


@register("read_log", sql(["v_clicklog"], f"""
    SELECT scene, action, "user", item, alg, day, os, event_id FROM v_clicklog WHERE event_id % {BAD} <> 0"""))
def q_read_log(spark, d):
    return L.accepted(L.log(log_lines(Tables(spark, d)), "event_id")).drop("ts")


@register("read_log_rejects", sql(["v_clicklog"], f"""
    SELECT count(*) AS n_lines, count(*) FILTER (WHERE event_id % {BAD} = 0) AS n_rejected FROM v_clicklog"""))
def q_read_log_rejects(spark, d):
    return L.rejects(L.log(log_lines(Tables(spark, d)), "event_id"))


@register("conversion_from_lines", _p1_sql().replace("v_clicklog\n        WHERE", "v_clicklog WHERE").replace(
    "FROM v_clicklog", f"FROM (SELECT * REPLACE (CAST(day AS TIMESTAMP) AS ts) FROM v_clicklog WHERE event_id % {BAD} <> 0)"))
def q_conversion_from_lines(spark, d):
    """PIPE-1 from its own text layout: parse, then the report."""
    log = L.accepted(L.log(log_lines(Tables(spark, d)), "event_id"))
    return conv.conversion_report(log).withColumn("rate", r6(F.col("rate")))


@register("read_visited", sql(["v_visited"], f'SELECT "user", item, score FROM v_visited WHERE item % {BAD} <> 0'))
def q_read_visited(spark, d):
    v = Tables(spark, d).visited()
    return L.accepted(L.visited(_lines(v, ",", _signed("user"), "item", "score", bad=F.col("item") % BAD == 0,
                                       instead=F.concat_ws(",", _s("user"), _s("item"), F.lit("x")))))


def _folder(spark):
    """A new folder for files that a query writes and reads back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{app_id(spark)}/{uuid.uuid4().hex}"


@register("read_days", sql(["v_impress"], f"""SELECT "user", item, dt FROM v_impress
    WHERE dt BETWEEN DATE '2024-01-31' - {P.IMPRESS_WINDOW_P2[1]} AND DATE '2024-01-31' - {P.IMPRESS_WINDOW_P2[0]}"""))
def q_read_days(spark, d):
    """SRC-03: a folder with one sub-folder per day, of which only the window is read.  The days are written
    with broken lines at first, and one after the other half of them is run again."""
    root = _folder(spark)
    shown = Tables(spark, d).impressions()
    lines = shown.select(F.concat_ws("\t", _s("user"), _s("item")).alias("value"), "dt")
    lo, hi = P.IMPRESS_WINDOW_P2
    days = [(P.AS_OF - dt.timedelta(days=k)).date() for k in range(lo, hi + 2)]
    TX.write_days(lines.withColumn("value", F.when(F.dayofmonth("dt") % 2 == 0, "1\t1").otherwise(F.col("value"))), root, days)
    TX.write_days(lines, root, [x for x in days if x.day % 2 == 0])
    return TX.read_days(spark, root, "user long, item long", P.AS_OF, lo, hi, complete=True)


@register("read_promoted_rate", sql(["v_rate_seed"], f"""
    SELECT item, src, round(rate, 6) AS rate FROM v_rate_seed WHERE CAST(src AS BIGINT) % {BAD} <> 0"""))
def q_read_promoted_rate(spark, d):
    r = Tables(spark, d).rate_by_seed()
    bad = F.col("src").cast("long") % BAD == 0  # two parts only
    packed = TX.pack_list(C.distributed_rank(r, "item", [F.col("src")], "k"), "item", "k", F.col("src"),
                          F.when(bad, _s("rate")).otherwise("x"), F.when(~bad, _s("rate")), chunk=CHUNK)
    got = L.accepted(L.promoted_rate(_lines(packed, "\t", "item", F.lit("-"), "packed"), 2))
    return got.select("item", "src", r6(F.col("rate")).alias("rate"))


@register("read_pay", sql(["v_pay"], f"""SELECT item, round(money, 6) AS money, round(click, 6) AS click FROM v_pay
    WHERE item % {BAD} <> 0"""))
def q_read_pay(spark, d):
    p = Tables(spark, d).pay()
    lines = p.select(F.concat(F.lit("("), F.concat_ws(",", _s("item"), F.when(F.col("item") % BAD == 0, "abc").otherwise(
        _s("money")), _s("click")), F.lit(")")).alias("value"))
    return L.accepted(L.pay(lines)).select("item", r6(F.col("money")).alias("money"), r6(F.col("click")).alias("click"))


_B = P.USER_WIDTH + P.ITEM_WIDTH


@register("read_weights", _lr_sql(f"""CASE WHEN bits IS NULL THEN {P.MISSING_ITEM_SCORE} ELSE {OC.sigmoid(
    f"{OC.dot_user()} + {OC.dot_item()} + w[{_B + 1}] * rate + w[{_B + 2}] * lan + w[{_B + 3}] * style")} END"""))
def q_read_weights(spark, d):
    """SRC-10: the visited pairs scored with the weight vector that the job reads from its file."""
    path = _folder(spark)
    line = "[" + ", ".join(map(str, P.WEIGHTS)) + "]"
    spark.createDataFrame([(line,)], "value string").write.text(path)
    w = TX.read_weights(spark, path, P.WEIGHTS_LEN)
    t = Tables(spark, d)
    x = _halves(_pair_features(t), t, w)
    v = S.weights_lit(w)
    lr = S.lr_parts(F.col("zu"), F.col("zi"), v[_B] * F.col("rate"), v[_B + 1] * F.col("lan"), v[_B + 2] * F.col("style"))
    return x.select("user", "item", r6(lr).alias("lr"))


@register("read_quality", sql(["v_quality"], f"""SELECT item, round(score, 6) AS score, create_days FROM v_quality
    WHERE item % {BAD} <> 0"""))
def q_read_quality(spark, d):
    q = Tables(spark, d).quality()
    got = L.accepted(L.quality(_lines(q, "\t", "item", "score", F.lit("-"), "create_days", bad=F.col("item") % BAD == 0,
                                      instead=F.concat_ws("\t", _s("item"), _s("score")))))
    return got.select("item", r6(F.col("score")).alias("score"), "create_days")


META = ["user,bigint,user id,x", "a comment", "newSongType,string,type,x", "newSongWeight,float,weight,x", ""]


@register("read_header_pick", sql(["v_new_song_weight"], f"""
    SELECT "user", new_song_weight AS "newSongWeight" FROM v_new_song_weight WHERE "user" % {BAD} <> 0"""))
def q_read_header_pick(spark, d):
    """SRC-15: the metadata names the columns; lines too short for newSongType are rejected."""
    w = Tables(spark, d).new_song_weight()
    lines = _lines(w, "\t", _signed("user"), F.lit("pop"), "new_song_weight", bad=F.col("user") % BAD == 0,
                   instead=_s("user"))
    return L.accepted(L.header_pick(lines, META))


@register("read_id_set", sql(["v_gated"], f"SELECT item AS id FROM v_gated WHERE item % {BAD} <> 0"))
def q_read_id_set(spark, d):
    g = Tables(spark, d).gated()
    return L.accepted(L.ids(_lines(g, "", F.lit("  "), "item", F.lit(" "), bad=F.col("item") % BAD == 0,
                                   instead=F.concat(F.lit("x"), _s("item"))))).distinct()


@register("read_segment", sql(["v_segment"], f'SELECT "user" AS id FROM v_segment WHERE "user" % {BAD} <> 0'))
def q_read_segment(spark, d):
    s = Tables(spark, d).segment()
    return L.accepted(L.ids(_lines(s, "", _signed("user"), bad=F.col("user") % BAD == 0, instead=F.lit("-")),
                            users=True)).distinct()


@register("read_first_ids", f"""SELECT p_partkey AS id FROM (SELECT p_partkey, row_number() OVER (
    ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= {P.FIRST_BLOCK_N}""")
def q_read_first_ids(spark, d):
    """SRC-17: the first lines of a folder of several files without a rank column."""
    path = _folder(spark)
    p = Tables(spark, d)("part").select("p_partkey", "p_retailprice")
    order = [F.desc("p_retailprice"), F.col("p_partkey")]
    p = p.repartitionByRange(8, *order).sortWithinPartitions(*order)
    p.select(F.concat_ws("\t", _s("p_partkey"), _s("p_retailprice")).alias("value")).write.text(path)
    return TX.read_first_ids(spark, path)


@register("read_last_active", sql(["v_active"], f"""
    SELECT "user", CAST(floor(epoch(last_ts)) AS BIGINT) AS seconds FROM v_active WHERE "user" % {BAD} <> 0"""))
def q_read_last_active(spark, d):
    a = Tables(spark, d).active()
    seconds = F.unix_seconds(F.col("last_ts").cast("timestamp"))
    got = L.accepted(L.last_active(_lines(a, "\t", _signed("user"), seconds, bad=F.col("user") % BAD == 0,
                                          instead=F.concat_ws("\t", _s("user"), F.lit("never")))))
    return got.select("user", F.unix_seconds(F.col("last_ts").cast("timestamp")).alias("seconds"))


@register("play_log_filter", sql(["v_events"], f"""
    SELECT "user", item, {P.LOG_PLAY_SCORE} AS score, 1 AS priority FROM v_events
    WHERE event_type = 'view' AND event_id % {BAD} <> 0 AND event_id % 13 <> 0 AND "user" <> 0"""))
def q_play_log_filter(spark, d):
    """FLT-03: play lines; the item is the list (column 5), not the song (column 2)."""
    e = Tables(spark, d).events()
    action = F.when(F.col("event_type") == "view", "play").otherwise("stop")
    item = F.when(F.col("event_id") % BAD == 0, F.concat(_s("item"), F.lit("a"))).otherwise(_s("item"))
    kind = F.when(F.col("event_id") % 13 == 0, "video").otherwise("song")
    return FL.play_log(_lines(e, "\t", action, _signed("user"), "event_id", kind, F.lit("list"), item, F.lit("0"),
                              F.lit("android"), F.lit("30")))


@register("subscription_filter", sql(["v_events"], f"""
    SELECT item, "user", event_id AS time FROM v_events WHERE event_type = 'purchase' AND event_id % 7 <> 5
      AND event_id % 13 <> 0 AND event_id % {BAD} <> 0"""))
def q_subscription_filter(spark, d):
    """FLT-04: negative users and type 5 are dropped."""
    e = Tables(spark, d).events().where(F.col("event_type") == "purchase")
    user = F.when(F.col("event_id") % 13 == 0, -F.col("user") - 1).otherwise(F.col("user"))
    lines = _lines(e, "\t", F.lit("-"), user, "item", "event_id", F.col("event_id") % 7,
                   bad=F.col("event_id") % BAD == 0, instead=F.concat_ws("\t", F.lit("-"), _s("user")))
    return FL.subscription_filter(L.accepted(L.subscriptions(lines)))


@register("impression_log_filter", sql(["v_events"], f"""
    SELECT "user", item FROM v_events WHERE event_type = 'view' AND event_id % {BAD} <> 0"""))
def q_impression_log_filter(spark, d):
    e = Tables(spark, d).events().where(F.col("event_type") == "view")
    scene = F.when(F.col("event_id") % BAD == 0, "other-page").otherwise(P.IMPRESSION_MARKER)
    return FL.impression_log_filter(_lines(e, "\t", F.lit("impress"), scene, _signed("user"), "item"))


@register("read_user_seeds", sql(["v_user_seed"], f"""
    SELECT "user", seed, CAST(score AS DOUBLE) AS score FROM v_user_seed WHERE seed % {BAD} <> 0"""))
def q_read_user_seeds(spark, d):
    """``user<TAB>seed:score[:time],...``: a time behind every other score, a bad score now and then."""
    s = Tables(spark, d).user_seed().withColumn("score", F.col("score").cast("double"))
    value = F.when(F.col("seed") % BAD == 0, "bad").otherwise(_s("score"))
    time = F.when(F.col("seed") % 2 == 0, "1500000000")
    packed = TX.pack_list(C.distributed_rank(s, "user", [F.col("seed")], "k"), "user", "k", F.col("seed"), value, time, chunk=CHUNK)
    return L.accepted(L.user_seeds(_lines(packed, "\t", _signed("user"), "packed")))


@register("read_play_profile", sql(["v_play"], f"""
    SELECT "user", item, CAST(score AS DOUBLE) AS score, 0 AS priority FROM v_play WHERE priority = 0 AND item % {BAD} <> 0"""))
def q_read_play_profile(spark, d):
    p = Tables(spark, d).play().where("priority = 0").withColumn("score", F.col("score").cast("double"))
    item = F.when(F.col("item") % (2 * BAD) == 0, "").otherwise(_s("item"))
    score = F.when((F.col("item") % BAD == 0) & (F.col("item") % 2 == 1), "").otherwise(_s("score"))
    packed = TX.pack_list(C.distributed_rank(p, "user", [F.col("item")], "k"), "user", "k", item, score, chunk=CHUNK)
    return L.accepted(L.play_profile(_lines(packed, "\t", _signed("user"), "packed")))


@register("read_user_affinity", sql(["v_user_aff"], """
    SELECT "user", kind, tag, round(ratio, 6) AS ratio FROM v_user_aff"""))
def q_read_user_affinity(spark, d):
    a = Tables(spark, d).user_affinity()
    packed = a.select("user", "kind", F.concat_ws(":", "tag", _s("ratio")).alias("e")).groupBy("user", "kind").agg(
        F.array_join(F.collect_list("e"), ",").alias("p"))
    # an entry without a colon and one without a tag are rejected
    lan = F.concat_ws("\t", _s(_signed("user")), F.lit("lan"), F.concat(F.col("p"), F.lit(",nothing")))
    style = F.concat_ws("\t", _s(_signed("user")), F.concat(F.lit(":0.5,"), F.col("p")))
    got = L.accepted(L.user_affinity(packed.select(F.when(F.col("kind") == "lan", lan).otherwise(style).alias("value"))))
    return got.withColumn("ratio", r6(F.col("ratio")))


@register("read_item_affinity", sql(["v_item_aff"], "SELECT item, kind, tag, ratio FROM v_item_aff"))
def q_read_item_affinity(spark, d):
    a = Tables(spark, d).item_affinity().select("item", "kind", F.concat_ws(":", "tag", _s("ratio")).alias("e"))
    one = lambda k: F.array_join(F.collect_list(F.when(F.col("kind") == k, F.col("e"))), ",")
    packed = a.groupBy("item").agg(one("lan").alias("lan"), one("style").alias("style"))
    return L.accepted(L.item_affinity(_lines(packed, "\t", "item", "lan", F.concat(F.col("style"), F.lit(",:1")))))


@register("read_attributes", sql(["v_profile", "v_quality"], f"""
    SELECT p.item, p.avg_pub_time, round(q.score, 6) AS score FROM v_profile p JOIN v_quality q ON q.item = p.item
    WHERE p.item % {BAD} <> 0 AND p.item % 13 <> 0"""))
def q_read_attributes(spark, d):
    """SRC-13: exactly two columns, both attributes readable."""
    t = Tables(spark, d)
    x = t.profile().join(t.quality(), "item").select("item", F.to_json(F.struct(
        F.col("avg_pub_time").alias("avgPubTime"), "score")).alias("j"))
    broken = x.withColumn("j", F.when(F.col("item") % 13 == 0, F.lit('{"score": 0.5}')).otherwise(F.col("j")))
    lines = _lines(broken, "\t", "item", "j", bad=F.col("item") % BAD == 0,
                   instead=F.concat_ws("\t", _s("item"), "j", F.lit("y")))
    got = L.accepted(L.attributes(lines))
    return got.withColumn("score", r6(F.col("score")))


@register("optional_input", sql(["v_history"], 'SELECT "user", count(*) AS n FROM v_history GROUP BY "user"'))
def q_optional_input(spark, d):
    """SRC-19: a history that is there and one that is not, with the same columns."""
    path = _folder(spark)
    _lines(Tables(spark, d).history(), "\t", _signed("user"), "packed").write.text(path)
    read = lambda s, p: TX.read_history(s, p, 1)
    schema = "user long, item long, tag string, pos long"
    both = TX.optional(spark, path, schema, read).unionByName(TX.optional(spark, "null", schema, read))
    return both.groupBy("user").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- lookups with repeated keys

_OLD, _NEW = 0, 1


def _overlapping(spark, df, key, line):
    """Two files that overlap: the first names every key; the second names those not divisible by three, each
    twice.  ``line(kind)`` writes a key's line: "old", "first" (of the second file) or "last"."""
    root = _folder(spark)
    df.select(line("old").alias("value")).write.text(f"{root}/{_OLD}")
    twice = F.explode(F.array(line("first"), line("last"))).alias("value")
    df.where(F.col(key) % 3 != 0).select(twice).write.text(f"{root}/{_NEW}")
    return [f"{root}/{_OLD}", f"{root}/{_NEW}"]


def _which(old, first, last):
    return lambda kind: {"old": old, "first": first, "last": last}[kind]


def _cells(*cols):
    return F.concat_ws("\t", *[_s(c) for c in cols])


@register("keyed_pay", sql(["v_pay"], """
    SELECT item, round(CASE WHEN item % 3 = 0 THEN money + 1 ELSE money END, 6) AS money, round(click, 6) AS click FROM v_pay"""))
def q_keyed_pay(spark, d):
    line = lambda m: F.concat(F.lit("("), F.concat_ws(",", _s("item"), _s(m), _s("click")), F.lit(")"))
    m = F.col("money")
    paths = _overlapping(spark, Tables(spark, d).pay(), "item", _which(line(m + 1), line(m + 2), line(m)))
    got = keyed_load(TX.read_lookup(spark, paths, L.pay), "item")
    return got.select("item", r6(F.col("money")).alias("money"), r6(F.col("click")).alias("click"))


@register("keyed_rate", sql(["v_rate_seed"], """
    SELECT item, src, round(rate, 6) AS rate FROM (
      SELECT item, CASE WHEN item % 3 = 0 THEN lo ELSE hi END AS src, CASE WHEN item % 3 = 0 THEN 2.0 ELSE 0.25 END AS rate
      FROM (SELECT item, min(src) AS lo, max(src) AS hi FROM v_rate_seed GROUP BY item))"""))
def q_keyed_rate(spark, d):
    """A later line replaces all that an earlier one said of its item; in a line the last of a src counts."""
    r = Tables(spark, d).rate_by_seed().groupBy("item").agg(F.min("src").alias("lo"), F.max("src").alias("hi"))
    line = lambda src, *rates: _cells("item", F.concat_ws(",", *[F.concat_ws(":", src, F.lit(f"x:{x}")) for x in rates]))
    paths = _overlapping(spark, r, "item", _which(line("lo", 1.0, 2.0), line("lo", 3.0), line("hi", 0.5, 0.25)))
    got = keyed_load(TX.read_lookup(spark, paths, L.promoted_rate, 1), "item", "src")
    return got.select("item", "src", r6(F.col("rate")).alias("rate"))


@register("keyed_quality", sql(["v_quality"], """
    SELECT item, round(score, 6) AS score, CASE WHEN item % 3 = 0 THEN 1 ELSE create_days END AS create_days FROM v_quality"""))
def q_keyed_quality(spark, d):
    line = lambda days: _cells("item", "score", F.lit("-"), days)
    paths = _overlapping(spark, Tables(spark, d).quality(), "item", _which(line(F.lit(1)), line(F.lit(2)), line("create_days")))
    got = keyed_load(TX.read_lookup(spark, paths, L.quality), "item")
    return got.select("item", r6(F.col("score")).alias("score"), "create_days")


@register("keyed_profile", sql(["v_profile"], """
    SELECT item, CASE WHEN item % 3 = 0 THEN 7 ELSE avg_pub_time END AS avg_pub_time FROM v_profile"""))
def q_keyed_profile(spark, d):
    line = lambda v: _cells("item", F.to_json(F.struct(v.cast("long").alias("avgPubTime"), F.lit(0.5).alias("score"))))
    paths = _overlapping(spark, Tables(spark, d).profile(), "item",
                         _which(line(F.lit(7)), line(F.lit(8)), line(F.col("avg_pub_time"))))
    return keyed_load(TX.read_lookup(spark, paths, L.attributes), "item").select("item", "avg_pub_time")


@register("keyed_new_song_weight", sql(["v_new_song_weight"], """
    SELECT "user", CASE WHEN "user" % 3 = 0 THEN 9.0 ELSE new_song_weight END AS "newSongWeight" FROM v_new_song_weight"""))
def q_keyed_new_song_weight(spark, d):
    line = lambda w: _cells(_signed("user"), F.lit("pop"), w)
    paths = _overlapping(spark, Tables(spark, d).new_song_weight(), "user",
                         _which(line(F.lit(9.0)), line(F.lit(8.0)), line("new_song_weight")))
    return keyed_load(TX.read_lookup(spark, paths, L.header_pick, META), "user")


@register("keyed_visited", sql(["v_visited"], """
    SELECT "user", item, CASE WHEN item % 3 = 0 THEN 100 ELSE score END AS score FROM v_visited"""))
def q_keyed_visited(spark, d):
    line = lambda v: F.concat_ws(",", _s(_signed("user")), _s("item"), _s(v))
    paths = _overlapping(spark, Tables(spark, d).visited(), "item", _which(line(F.lit(100)), line(F.lit(-100)), line("score")))
    return keyed_load(TX.read_lookup(spark, paths, L.visited), "user", "item").withColumn("score", F.col("score").cast("long"))


def _vector_line(key, col):
    text = F.array_join(F.col(col).cast("array<string>"), ",")
    return lambda off: _cells(key, F.concat(F.lit(f"{off},"), text))


@register("keyed_item_features", sql(["v_item_feat"], """
    SELECT item, len(bits) + 1 AS width, list_sum(bits) + CASE WHEN item % 3 = 0 THEN 0 ELSE 1 END AS ones FROM v_item_feat"""))
def q_keyed_item_features(spark, d):
    line = _vector_line("item", "bits")
    paths = _overlapping(spark, Tables(spark, d).item_features(), "item", _which(line(0), line(0), line(1)))
    got = keyed_load(TX.read_lookup(spark, paths, L.bits), "item")
    return got.select("item", F.size("bits").cast("long").alias("width"),
                      F.aggregate("bits", F.lit(0).cast("long"), lambda a, v: a + v).alias("ones"))


@register("keyed_user_features", sql(["v_user_feat"], """
    SELECT "user", list_sum(feats) + CASE WHEN "user" % 3 = 0 THEN 5 ELSE 7 END AS total FROM v_user_feat"""))
def q_keyed_user_features(spark, d):
    line = _vector_line("user", "feats")
    paths = _overlapping(spark, Tables(spark, d).user_features(), "user", _which(line(5), line(6), line(7)))
    got = keyed_load(TX.read_lookup(spark, paths, L.user_features), "user")
    return got.select("user", F.aggregate("feats", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


@register("keyed_item_affinity", sql(["v_item_aff"], """
    SELECT item, kind, CASE WHEN item % 3 = 0 THEN 'old' ELSE tag END AS tag,
           CASE WHEN item % 3 = 0 THEN 0.75 ELSE ratio END AS ratio FROM v_item_aff"""))
def q_keyed_item_affinity(spark, d):
    """A later line replaces an item's tags; in a line the last ratio of a tag counts."""
    a = Tables(spark, d).item_affinity()
    tag = lambda k: F.max(F.when(F.col("kind") == k, F.col("tag"))).alias(k)
    one = a.groupBy("item").agg(tag("lan"), tag("style"))
    line = lambda x, y, *r: _cells("item", *[F.concat_ws(",", *[F.concat_ws(":", t, F.lit(str(v))) for v in r]) for t in (x, y)])
    old = line(F.lit("old"), F.lit("old"), 0.5, 0.75)
    paths = _overlapping(spark, one, "item", _which(old, line(F.lit("x"), F.lit("y"), 1.0), line("lan", "style", 0.1, 1.0)))
    return keyed_load(TX.read_lookup(spark, paths, L.item_affinity), "item", "kind", "tag")


_REPEATED = [
    ("pairs", 'SELECT "user", item FROM v_visited'),
    ("ua", """SELECT "user", kind, tag, ratio FROM v_user_aff
              UNION ALL SELECT "user", kind, tag, ratio / 2 FROM v_user_aff WHERE "user" % 2 = 0"""),
    ("aff", f"""SELECT c."user", c.item, sum(CASE WHEN ua.kind = 'lan' THEN ua.ratio * ia.ratio ELSE 0 END) AS lan,
                       sum(CASE WHEN ua.kind = 'style' THEN ua.ratio * ia.ratio ELSE 0 END) AS style
                FROM pairs c JOIN ua ON ua."user" = c."user" AND ua.ratio > {P.AFFINITY_MIN}
                JOIN v_item_aff ia ON ia.item = c.item AND ia.kind = ua.kind AND ia.tag = ua.tag GROUP BY ALL""")]


@register("affinity_repeated_tags", sql(["v_visited", "v_user_aff", "v_item_aff"], """
    SELECT "user", item, round(lan, 6) AS lan, round(style, 6) AS style FROM aff""", _REPEATED))
def q_affinity_repeated_tags(spark, d):
    """JOIN-11, FLT-16: a user's repeated tag counts twice, of an item's repeated tag the last ratio counts, and
    the two ignored style tags of both sides never do."""
    t = Tables(spark, d)
    ua, ia = t.user_affinity(), t.item_affinity()
    half = ua.where(F.col("user") % 2 == 0).withColumn("ratio", F.col("ratio") / 2)
    none = lambda df, key: df.select(key).distinct().select(
        key, F.lit("style").alias("kind"), F.explode(F.array(F.lit("unknow"), F.lit("null"))).alias("tag"), F.lit(0.5).alias("ratio"))
    ua = ua.unionByName(half).unionByName(none(ua, "user"))
    ia = ia.unionByName(none(ia, "item")).withColumn("_both", F.explode(F.array(F.lit(0), F.lit(1))))
    ia = ia.select("item", "kind", "tag", F.when(F.col("_both") == 0, 9.0).otherwise(F.col("ratio")).alias("ratio"),
                   F.col("_both").alias(POSITION))
    a = X.affinity_dot(t.visited().select("user", "item"), ua, ia)
    return a.select("user", "item", r6(F.col("lan")).alias("lan"), r6(F.col("style")).alias("style"))
