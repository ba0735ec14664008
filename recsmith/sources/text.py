"""Readers and writers for the reference's text layouts (SRC-*, SNK-*).

Every reader takes an explicit schema (no inference), keeps malformed lines
out with ``try_cast`` / permissive parsing instead of failing the job, and
turns packed lists (``id:score,id:score``) into long rows with array
functions, so no per-row Python runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from recsmith import params as P
from recsmith.operators.filters import history_first, normal_user
from recsmith.operators.keyed import POSITION
from recsmith.session import file_system
from recsmith.sources import lines as L

DONE = "_SUCCESS"  # completion marker of a day's folder

# ---------------------------------------------------------------- packed lists


def _last_colon_ok(e: Column) -> Column:
    return e.contains(":") & ~e.endswith(":")


def explode_weighted_list(df: DataFrame, key: str, col: str, split_at: str = "last",
                          max_n: int | None = None, offset: str | None = None) -> DataFrame:
    """SRC-05 / SRC-06: ``key, "id:score,id:score,..."`` -> (key, id, score, pos).

    ``split_at='last'``: split at the last colon; entries without a colon or with a
    trailing one are skipped; one unparsable score empties the whole list.
    ``split_at='first'``: split at the first colon; entries whose colon position is <= 0
    are skipped (as are unparsable scores).  ``max_n`` (the candidate-set reader passes
    ``PACKED_LIST_MAX``): reading stops after so many kept entries, so a bad score
    behind them is never seen.  ``pos`` counts kept entries from 0.

    ``offset`` names a column by which the lines of a key that is cut into several lines are ordered
    (see ``pack_list``): they are read as one list.  What a line must know of the key's other lines
    (kept entries before it, a bad score anywhere) are two numbers per line.
    """
    arr = F.split(F.coalesce(F.col(col), F.lit("")), ",")
    if split_at == "last":
        kept = F.filter(arr, _last_colon_ok)
        ident = lambda e: F.regexp_extract(e, "^(.*):[^:]*$", 1)
        score = lambda e: F.regexp_extract(e, ":([^:]*)$", 1)
    elif split_at == "first":
        kept = F.filter(arr, lambda e: (F.instr(e, ":") > 1)
                        & F.regexp_extract(e, "^[^:]*:(.*)$", 1).try_cast("double").isNotNull())
        ident = lambda e: F.substring_index(e, ":", 1)
        score = lambda e: F.regexp_extract(e, "^[^:]*:(.*)$", 1)
    else:
        raise ValueError(split_at)
    lines = df.select(key, *([offset] if offset else []), kept.alias("_kept"))
    start = F.lit(0).cast("long")
    if offset:
        sizes = lines.select(key, offset, F.size("_kept").cast("long").alias("_n"))
        before = Window.partitionBy(key).orderBy(offset).rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
        lines, start = lines.join(starts, [key, offset]), F.col("_start")
    if max_n is not None:  # the reader stops here
        lines = lines.withColumn("_kept", F.slice("_kept", F.lit(1), F.greatest(F.lit(max_n) - start, F.lit(0)).cast("int")))
    if split_at == "last":
        bad = F.exists("_kept", lambda e: F.regexp_extract(e, ":([^:]*)$", 1).try_cast("double").isNull())
        if offset:
            lines = lines.join(lines.where(bad).select(key).distinct(), key, "left_anti")
        else:
            lines = lines.where(~bad)
    rows = lines.select(key, start.alias("_start"), F.posexplode("_kept").alias("pos", "entry"))
    return rows.select(key, ident(F.col("entry")).alias("id"),
                       score(F.col("entry")).try_cast("double").alias("score"),
                       (F.col("_start") + F.col("pos")).cast("long").alias("pos"))


def pack_list(df: DataFrame, key: str, order_col: str, id_col: Column, score_col: Column,
              extra: Column | None = None, chunk: int | None = None) -> DataFrame:
    """SNK-01 / SNK-02: (key, ...) rows -> (key, "id:score[:extra],...") in ``order_col`` order.

    Without ``chunk`` a packed line holds one key's whole list, which the caller has bounded (top-N, caps).
    With ``chunk`` a key's list is cut into lines of at most so many positions (``order_col`` counts
    from 0), each with its ``offset``: (key, offset, packed).  So a key with very many entries is many
    rows, in as many tasks as they need."""
    parts = [id_col.cast("string"), score_col.cast("string")]
    if extra is not None:
        parts.append(extra.cast("string"))
    e = F.concat_ws(":", *parts)
    by = [F.col(key)]
    if chunk is not None:
        by.append((F.floor(F.col(order_col) / chunk) * chunk).cast("long").alias("offset"))
    g = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                                 e.alias("e")))).alias("_l"))
    return g.select(key, *(["offset"] if chunk is not None else []),
                    F.array_join(F.transform("_l", lambda x: x["e"]), ",").alias("packed"))


# ---------------------------------------------------------------- vectors / json


parse_bit_vector, parse_int_vector = L.bit_vector, L.int_vector


def parse_json_attributes(df: DataFrame, col: str) -> DataFrame:
    """SRC-13 / FN-20: ``{"avgPubTime": ..., "score": ...}`` -> avg_pub_time, score."""
    return df.withColumn("_j", L.json_attributes(F.col(col))).select(
        *[c for c in df.columns if c != col],
        F.col("_j.avgPubTime").alias("avg_pub_time"), F.col("_j.score").alias("score"))


# ---------------------------------------------------------------- file readers


def read_tab(spark: SparkSession, paths, schema: str) -> DataFrame:
    """SRC-01: tab-separated text with an explicit schema; malformed fields -> null.  Quote
    characters are ordinary text."""
    return (spark.read.option("sep", "\t").option("quote", "").option("mode", "PERMISSIVE").schema(schema)
            .csv(paths if isinstance(paths, list) else [paths]))


def positioned_lines(spark: SparkSession, paths) -> DataFrame:
    """Text lines with their place in the input: file (by name), block of the file, line within it."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"))
    return spark.read.text(paths).select("value", place.alias(POSITION))


def read_lines(spark: SparkSession, paths, parser, *args, positions: bool = False, counts: Observation | None = None,
               **kwargs) -> DataFrame:
    """The accepted rows of text files under one of the parsers of ``sources.lines``.  ``counts`` observes
    lines and rejects in the same job; ``positions``: rows keep their place, so that lookups with
    repeated keys know the last one."""
    lines = positioned_lines(spark, paths) if positions else spark.read.text(paths)
    return L.accepted(parser(lines, *args, **kwargs), counts)


def read_lookup(spark: SparkSession, paths, parser, *args, **kwargs) -> DataFrame:
    """``read_lines`` with positions, for the lookups of the jobs (JOIN-07, JOIN-10, JOIN-11)."""
    return read_lines(spark, paths, parser, *args, positions=True, **kwargs)


def first_lines(spark: SparkSession, paths, n: int) -> DataFrame:
    """SRC-17: the first ``n`` lines over all files, in the order of file names and lines.

    Lines are counted per block of a file; a running total over the blocks (a few numbers per block)
    gives the number of each block's first line, and only blocks that begin before line ``n`` are
    read again."""
    lines = positioned_lines(spark, paths).select("value", F.col(f"{POSITION}.file").alias("file"),
                                                  F.col(f"{POSITION}.block").alias("block"), F.col(f"{POSITION}.line").alias("line"))
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).where(F.col("start") < n)
    head = lines.join(starts, ["file", "block"])
    rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("line"))
    return (head.withColumn("rank", rank).where(F.col("rank") <= n).where(F.col("start") + F.col("rank") <= n)
            .select("value"))


def read_first_ids(spark: SparkSession, paths, n: int = P.FIRST_BLOCK_N) -> DataFrame:
    """SRC-17: the ids in the first column of the first ``n`` lines over all files."""
    return L.accepted(L.first_column(first_lines(spark, paths, n)))


def read_log(spark: SparkSession, paths) -> DataFrame:
    """Click and subscribe log in its raw layout, ready for the conversion report."""
    return read_lines(spark, paths, L.log)


def read_user_seeds(spark: SparkSession, paths) -> DataFrame:
    """``user<TAB>seed:score[:time],...`` -> (user, seed, score)."""
    return read_lines(spark, paths, L.user_seeds)


def read_visited(spark: SparkSession, paths) -> DataFrame:
    """SRC-02: ``user,item,score`` (positive = clicks, negative = impressions)."""
    return read_lines(spark, paths, L.visited)


def day_folder(root: str, day) -> str:
    return f"{root.rstrip('/')}/dt={day.strftime('%Y-%m-%d')}"


def write_days(lines: DataFrame, root: str, days) -> None:
    """SNK-*, by day: the ``value`` lines of ``days`` (a column ``dt`` tells the day) replace those days
    under ``root`` and leave all other days as they are, so a day can be run again.  Each day's
    completion marker goes before the day is touched and comes back when its lines are written."""
    spark = lines.sparkSession
    markers = [f"{day_folder(root, d)}/{DONE}" for d in days]
    for m in markers:
        fs, path = file_system(spark, m)
        fs.delete(path, False)
    wanted = [F.lit(d.strftime("%Y-%m-%d")).cast("date") for d in days]
    (lines.where(F.col("dt").isin(*wanted)).select("value", "dt").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dt").text(root))
    for m in markers:
        fs, path = file_system(spark, m)
        fs.create(path, True).close()  # a day without lines is complete too


def complete_days(spark: SparkSession, root: str, days) -> list:
    """Those of ``days`` whose completion marker is there."""
    out = []
    for d in days:
        fs, path = file_system(spark, f"{day_folder(root, d)}/{DONE}")
        if fs.exists(path):
            out.append(d)
    return out


def read_days(spark: SparkSession, root: str, schema: str, as_of, lo: int, hi: int, complete: bool = False) -> DataFrame:
    """SRC-03: date-partitioned folder ``root/dt=YYYY-MM-DD/``; only days ``lo..hi`` before
    ``as_of`` are read (partition pruning).  ``complete``: every one of these days must carry its completion
    marker, else the read is refused."""
    if complete:
        days = [(as_of - dt.timedelta(days=k)).date() for k in range(lo, hi + 1)]
        missing = sorted({str(d) for d in days} - {str(d) for d in complete_days(spark, root, days)})
        if missing:
            raise ValueError(f"days without completion marker under {root}: {', '.join(missing)}")
    df = (spark.read.option("sep", "\t").schema(schema + ", dt date").csv(root))
    d = F.lit(as_of.strftime("%Y-%m-%d")).cast("date")
    return df.where(F.col("dt").between(F.date_sub(d, hi), F.date_sub(d, lo)))


def read_packed(spark: SparkSession, paths, split_at: str = "last", key_type: str = "long",
                max_n: int | None = None, chunked: bool = False) -> DataFrame:
    """``key<TAB>id:score,...`` files -> (key, id, score, pos); whole lists unless ``max_n`` is given.
    ``chunked``: a key's list may be cut into several lines ``key<TAB>list<TAB>offset``."""
    c = L.cells(spark.read.text(paths)).select(L.cell(0).try_cast(key_type).alias("key"), L.cell(1).alias("packed"),
                                               F.coalesce(L.cell(2).try_cast("long"), F.lit(0).cast("long")).alias("offset"))
    raw = c.where(F.col("key").isNotNull())
    return explode_weighted_list(raw, "key", "packed", split_at, max_n, offset="offset" if chunked else None)


def read_promoted_rate(spark: SparkSession, paths, column: int) -> DataFrame:
    """SRC-07: ``item<TAB>...<TAB>src:x:rate,...`` with the packed column index a parameter."""
    return read_lines(spark, paths, L.promoted_rate, column)


def read_quality(spark: SparkSession, paths) -> DataFrame:
    """SRC-14: columns 0, 1, 3 -> (item, score, create_days)."""
    return read_lines(spark, paths, L.quality)


def read_id_set(spark: SparkSession, paths, users: bool = False) -> DataFrame:
    """SRC-16 / SRC-18: one id per line -> distinct (id); user ids lose their sign."""
    return read_lines(spark, paths, L.ids, users).distinct()


def read_ranked_ids(spark: SparkSession, paths, n: int = P.FIRST_BLOCK_N) -> DataFrame:
    """SRC-17: first ``n`` ids of a ranked list file ``rank<TAB>id`` (explicit rank column, Q-10)."""
    return read_lines(spark, paths, L.ranked_ids).where(F.col("rank") < n).select("id")


def read_weights(spark: SparkSession, paths, width: int | None = None) -> DataFrame:
    """SRC-10: the one weight vector of a file; fails unless there is exactly one (of ``width``)."""
    w = L.one_row(read_lines(spark, paths, L.weights))
    if width is None:
        return w
    wrong = F.raise_error(F.lit(f"weight vector is not {width} wide")).cast("boolean")
    return w.where(F.when(F.size("w") == width, F.lit(True)).otherwise(wrong))


def read_history(spark: SparkSession, paths, k: int = P.HISTORY_FIRST) -> DataFrame:
    """SRC-08: ``user<TAB>item:score:tag,...`` -> first ``k`` entries (user, item, tag, pos)."""
    raw = spark.read.text(paths).select(normal_user(L.tab(0)).alias("user"), L.tab(1).alias("packed"))
    return history_first(raw.where(F.col("user").isNotNull()), k)


def optional(spark: SparkSession, path: str | None, schema: str, reader) -> DataFrame:
    """SRC-19: ``None`` / "null" -> an empty DataFrame of the same schema."""
    if path is None or path == "null":
        return spark.createDataFrame([], schema)
    return reader(spark, path)


def header_pick(spark: SparkSession, meta_path: str, data_path: str, column: str = "newSongWeight",
                guard: str = "newSongType") -> DataFrame:
    """SRC-15: (user, ``column``) of a table whose columns a comma-separated metadata file names.
    Only that small file is collected."""
    meta = [r.value for r in spark.read.text(meta_path).collect()]
    return read_lines(spark, data_path, L.header_pick, meta, column, guard)


def write_lines(df: DataFrame, path: str) -> None:
    """SNK-*: write one ``value`` string column as text."""
    df.select("value").write.mode("overwrite").text(path)


def ranked_lines(ranked: DataFrame) -> DataFrame:
    """SNK-01: (user, rank, item, score, src) -> ``user<TAB>item:score:src,...``."""
    p = pack_list(ranked, "user", "rank", F.col("item"), F.col("score"), F.col("src"))
    return p.select(F.concat_ws("\t", F.col("user").cast("string"), "packed").alias("value"))


def chunked_lines(packed: DataFrame, key: str) -> DataFrame:
    """The lines ``key<TAB>list<TAB>offset`` of ``pack_list`` with a chunk size."""
    return packed.select(F.concat_ws("\t", F.col(key).cast("string"), "packed", F.col("offset").cast("string")).alias("value"))


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """FLT-20: (kept rows, rejected rows) for a validity predicate; callers count or write
    the rejected side instead of failing the job or dropping rows silently."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)
