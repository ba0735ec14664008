"""Line parsers of the input layouts: a DataFrame of text lines (``value``) in, typed rows out.

Each parser cuts a line once, into an array of cells, and gives the line's columns and ``ok`` (false
where the line does not hold what the layout asks for).  ``accepted`` keeps the good rows and
counts lines and rejects as observed metrics of the same job (FLT-20), so a bad line neither fails a
job nor vanishes unseen, and no second scan counts them; ``rejects`` is the count as a table.  User
ids lose their sign in every parser (FLT-06).  Lines that know their place in the input (``POSITION``,
see ``operators.keyed``) keep it in their rows, with the place in the line where a line holds several
rows.  The readers of ``sources.text`` are these parsers over files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from recsmith import params as P
from recsmith.operators.filters import normal_user, position
from recsmith.operators.keyed import POSITION


def cells(lines: DataFrame, sep: str = "\t", *keep: str) -> DataFrame:
    """The cells of each line, cut once."""
    return lines.select(F.split("value", sep, -1).alias("_c"), *position(lines), *keep)


def cell(n: int) -> Column:
    """Cell ``n`` (from 0) of ``cells``; null past the line's end."""
    return F.get("_c", F.lit(n))


def n_cells() -> Column:
    return F.size("_c")


def tab(n: int) -> Column:
    """Field ``n`` (from 0) of a tab-separated line; null past its end."""
    return F.get(F.split("value", "\t", -1), F.lit(n))


def _counts() -> list[Column]:
    bad = (~F.coalesce("ok", F.lit(False))).cast("long")
    return [F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum(bad), F.lit(0)).alias("n_rejected")]


def accepted(parsed: DataFrame, counts: Observation | None = None) -> DataFrame:
    """The good rows.  ``counts`` receives n_lines and n_rejected when the rows are first computed."""
    seen = parsed.observe(counts or f"lines-{uuid.uuid4().hex}", *_counts())
    return seen.where(F.coalesce("ok", F.lit(False))).drop("ok")


def rejects(parsed: DataFrame) -> DataFrame:
    """One row: lines read and lines rejected."""
    return parsed.agg(*_counts())


def last_lines(lines: DataFrame, key: Column) -> DataFrame:
    """The last line of each ``key`` (an expression over ``value``), for layouts where a line replaces all
    that an earlier line said of its key; lines without positions stay as they are."""
    if POSITION not in lines.columns:
        return lines
    last = F.max_by(F.struct("value", POSITION), F.col(POSITION)).alias("l")
    return lines.groupBy(key.alias("_key")).agg(last).select("l.*")


def log(lines: DataFrame, at: str | None = None) -> DataFrame:
    """Click and subscribe log: the two actions have different columns behind the item
    (click: alg, day, os; subscribe: day, os).  The lines carry no time of day: ``at``
    names a column with the order of the lines (else the order they are read in), which
    becomes ``event_id``, and ``ts`` is the day."""
    click, sub = cell(1) == P.CLICK_ACTION, cell(1) == P.SUBSCRIBE_ACTION
    place = F.col(at) if at else F.monotonically_increasing_id()
    day = F.when(click, cell(5)).otherwise(cell(4)).try_cast("date")
    c = cells(lines, "\t", *([at] if at else []))
    out = c.select(cell(0).alias("scene"), cell(1).alias("action"), cell(2).try_cast("long").alias("user"),
                   cell(3).try_cast("long").alias("item"), F.when(click, cell(4)).alias("alg"), day.alias("day"),
                   F.when(click, cell(6)).otherwise(cell(5)).alias("os"), place.cast("long").alias("event_id"),
                   ((click & (n_cells() >= 7)) | (sub & (n_cells() >= 6))).alias("ok"))
    whole = F.col("user").isNotNull() & F.col("item").isNotNull() & F.col("day").isNotNull()
    return out.withColumn("ts", F.col("day").cast("timestamp_ntz")).withColumn("ok", F.col("ok") & whole)


def _typed(out: DataFrame, *needed: str) -> DataFrame:
    ok = F.lit(True)
    for c in needed:
        ok = ok & F.col(c).isNotNull()
    return out.withColumn("ok", ok)


def visited(lines: DataFrame) -> DataFrame:
    """SRC-02: ``user,item,score``."""
    c = cells(lines, ",")
    return _typed(c.select(normal_user(cell(0)).alias("user"), cell(1).try_cast("long").alias("item"),
                           cell(2).try_cast("int").alias("score"), *position(c)), "user", "item", "score")


def quality(lines: DataFrame) -> DataFrame:
    """SRC-14: columns 0, 1 and 3."""
    c = cells(lines)
    return _typed(c.select(cell(0).try_cast("long").alias("item"), cell(1).try_cast("double").alias("score"),
                           cell(3).try_cast("int").alias("create_days"), *position(c)), "item", "score", "create_days")


def ids(lines: DataFrame, users: bool = False) -> DataFrame:
    """SRC-16 / SRC-18: one id per line, trimmed; ``users`` lose their sign."""
    v = F.trim("value")
    return _typed(lines.select((normal_user(v) if users else v.try_cast("long")).alias("id")), "id")


def first_column(lines: DataFrame) -> DataFrame:
    """SRC-17: the id in the first column, whatever follows."""
    return _typed(cells(lines).select(cell(0).try_cast("long").alias("id")), "id")


def ranked_ids(lines: DataFrame) -> DataFrame:
    """``rank<TAB>id`` (explicit rank)."""
    return _typed(cells(lines).select(cell(0).try_cast("long").alias("rank"), cell(1).try_cast("long").alias("id")), "rank", "id")


def last_active(lines: DataFrame) -> DataFrame:
    """``user<TAB>epoch seconds`` (UTC)."""
    since = F.make_dt_interval(secs=cell(1).try_cast("long").cast("decimal(18,6)"))
    ts = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + since  # free of the session's time zone
    return _typed(cells(lines).select(normal_user(cell(0)).alias("user"), ts.alias("last_ts")), "user", "last_ts")


def pay(lines: DataFrame) -> DataFrame:
    """SRC-09: ``(item,money,click)``."""
    c = cells(lines.withColumn("value", F.regexp_replace(F.trim("value"), r"^\(|\)$", "")), ",")
    return _typed(c.select(cell(0).try_cast("long").alias("item"), cell(1).try_cast("double").alias("money"),
                           cell(2).try_cast("double").alias("click"), *position(c)), "item", "money", "click")


def weights(lines: DataFrame) -> DataFrame:
    """SRC-10: ``[w0,w1,...]``; the input must hold exactly one line that parses whole."""
    body = F.regexp_replace(F.trim("value"), r"^\[|\]$", "")
    w = F.transform(F.split(body, ","), lambda x: F.trim(x).try_cast("double"))
    return lines.select(w.alias("w")).withColumn("ok", ~F.exists("w", lambda x: x.isNull()))


def one_row(df: DataFrame) -> DataFrame:
    """The only row of ``df``; the job fails when there is none or another one."""
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return df.where(F.when(n == 1, F.lit(True)).otherwise(F.raise_error(F.lit("one row expected")).cast("boolean")))


def bits(lines: DataFrame) -> DataFrame:
    """SRC-11: ``item<TAB>0,1,...``: "1" is 1, anything else 0."""
    c = cells(lines)
    return _typed(c.select(cell(0).try_cast("long").alias("item"), bit_vector(cell(1)).alias("bits"), *position(c)), "item", "bits")


def bit_vector(text: Column) -> Column:
    """SRC-11: "1" -> 1, anything else -> 0."""
    return F.transform(F.split(text, ","), lambda x: F.when(x == "1", 1).otherwise(0))


def user_features(lines: DataFrame) -> DataFrame:
    """SRC-12: ``user<TAB>1,0,...``."""
    c = cells(lines)
    return _typed(c.select(normal_user(cell(0)).alias("user"), int_vector(cell(1)).alias("feats"), *position(c)), "user", "feats")


def int_vector(text: Column) -> Column:
    """SRC-12: comma-separated ints (unparsable -> null)."""
    return F.transform(F.split(text, ","), lambda x: x.try_cast("int"))


def json_attributes(text: Column) -> Column:
    """SRC-13 / FN-20: ``{"avgPubTime": ..., "score": ...}``."""
    return F.from_json(text, "avgPubTime long, score double")


def attributes(lines: DataFrame) -> DataFrame:
    """SRC-13: ``item<TAB>{json}``, exactly two columns, both attributes readable."""
    c = cells(lines)
    out = c.select(cell(0).try_cast("long").alias("item"), json_attributes(cell(1)).alias("j"), (n_cells() == 2).alias("two"), *position(c))
    out = out.select("item", F.col("j.avgPubTime").alias("avg_pub_time"), F.col("j.score").alias("score"), "two", *position(c))
    whole = F.col("item").isNotNull() & F.col("avg_pub_time").isNotNull() & F.col("score").isNotNull()
    return out.withColumn("ok", F.col("two") & whole).drop("two")


def subscriptions(lines: DataFrame) -> DataFrame:
    """FLT-04 input: ``?<TAB>user<TAB>item<TAB>time<TAB>type``; the sign of the user is kept, since
    negative users are dropped by the filter."""
    c = cells(lines)
    return _typed(c.select(cell(1).try_cast("long").alias("user"), cell(2).try_cast("long").alias("item"),
                           cell(3).try_cast("long").alias("time"), cell(4).try_cast("int").alias("type")),
                  "user", "item", "time", "type")


def _entries(c: DataFrame, key: Column, name: str, packed: Column, *more: Column) -> DataFrame:
    """One row per entry of a packed list, with its place in the line behind the line's own."""
    out = c.select(key.alias(name), *more, F.posexplode(F.split(F.coalesce(packed, F.lit("")), ",")).alias("_at", "e"), *position(c))
    if POSITION in c.columns:
        out = out.withColumn(POSITION, F.struct(F.col(POSITION).alias("line"), F.col("_at").alias("at")))
    return out.drop("_at")


def _parts(e: DataFrame) -> DataFrame:
    return e.withColumn("_p", F.split("e", ":")).drop("e")


def user_seeds(lines: DataFrame) -> DataFrame:
    """``user<TAB>seed:score[:time],...`` -> one row per entry (first two parts)."""
    e = _parts(_entries(cells(lines), normal_user(cell(0)), "user", cell(1)))
    return _typed(e.select("user", F.get("_p", F.lit(0)).try_cast("long").alias("seed"),
                           F.get("_p", F.lit(1)).try_cast("double").alias("score"), *position(e)), "user", "seed", "score")


def _first_colon(e: DataFrame, kind: str, *keys: str) -> DataFrame:
    at = F.instr("e", ":")
    return e.select(*keys, F.when(at > 0, F.substring_index("e", ":", 1)).alias(kind),
                    F.when(at > 0, F.expr("substring(e, instr(e, ':') + 1)")).try_cast("double").alias("score"), *position(e))


def play_profile(lines: DataFrame) -> DataFrame:
    """``user<TAB>item:score,...`` split at the first colon; entries with an empty part are skipped.
    Priority 0: a profile score beats the play log's constant (SET-03)."""
    x = _first_colon(_entries(cells(lines), normal_user(cell(0)), "user", cell(1)), "item", "user")
    x = x.select("user", F.col("item").try_cast("long").alias("item"), "score", F.lit(0).alias("priority"))
    return _typed(x, "user", "item", "score")


def user_affinity(lines: DataFrame) -> DataFrame:
    """``user<TAB>tag:ratio,...`` (style) and ``user<TAB>lan<TAB>tag:ratio,...`` -> (user,kind,tag,ratio); a
    tag may occur twice, and then counts twice."""
    lan = (n_cells() == 3) & (cell(1) == "lan")
    kind = F.when(n_cells() == 2, "style").when(lan, "lan").alias("kind")
    e = _entries(cells(lines), normal_user(cell(0)), "user", F.when(lan, cell(2)).otherwise(cell(1)), kind)
    x = _first_colon(e, "tag", "user", "kind")
    x = x.select("user", "kind", "tag", F.col("score").alias("ratio"), *position(x))
    return _typed(x, "user", "kind", "tag", "ratio").withColumn("ok", F.col("ok") & (F.col("tag") != ""))


def item_affinity(lines: DataFrame) -> DataFrame:
    """``item<TAB>lan:ratio,...<TAB>style:ratio,...`` -> (item,kind,tag,ratio).  A later line replaces an
    item's earlier one."""
    lines = last_lines(lines, F.substring_index("value", "\t", 1))
    c = cells(lines)

    def one(kind, n):
        x = _first_colon(_entries(c, cell(0).try_cast("long"), "item", cell(n)), "tag", "item")
        return x.select("item", F.lit(kind).alias("kind"), "tag", F.col("score").alias("ratio"), *position(x))
    x = _typed(one("lan", 1).unionByName(one("style", 2)), "item", "tag", "ratio")
    return x.withColumn("ok", F.col("ok") & (F.col("tag") != ""))


def promoted_rate(lines: DataFrame, column: int) -> DataFrame:
    """SRC-07: ``item<TAB>...<TAB>src:x:rate,...``, the list in column ``column``.  A later line replaces an
    item's earlier one."""
    lines = last_lines(lines, F.substring_index("value", "\t", 1))
    e = _parts(_entries(cells(lines), cell(0).try_cast("long"), "item", cell(column)))
    x = e.select("item", F.get("_p", F.lit(0)).alias("src"), F.get("_p", F.lit(2)).try_cast("double").alias("rate"), *position(e))
    return _typed(x, "item", "src", "rate")


def header_names(meta: list[str]) -> list[str]:
    """SRC-15: names of the data columns: the metadata lines with at least 4 comma-separated
    fields, in order."""
    return [m.split(",")[0] for m in meta if m and len(m.split(",")) >= 4]


def header_pick(lines: DataFrame, meta: list[str], column: str = "newSongWeight", guard: str = "newSongType") -> DataFrame:
    """SRC-15: user (column 0) and the metadata's ``column``; a line too short to hold ``guard`` is rejected."""
    names = header_names(meta)
    c = cells(lines)
    x = c.select(normal_user(cell(0)).alias("user"), cell(names.index(column)).try_cast("double").alias(column),
                 (n_cells() > names.index(guard)).alias("_long"), *position(c))
    return _typed(x, "user", column).withColumn("ok", F.col("ok") & F.col("_long")).drop("_long")
