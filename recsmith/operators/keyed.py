"""Lookups with repeated keys (AGG-11): the last row of a key is in force.

Files of several days overlap, so a lookup may name a key more than once; the job's tables are
loaded in the order of the files and their lines, and a later row replaces an earlier one.  Readers
keep that order in the column ``POSITION`` (file, block, line, and the place in the line where a
line holds several rows); ``keyed_load`` keeps one row per key by a partial + final ``max_by``, so
a key with very many rows is reduced in the map tasks.  A table without positions has no
order: there the row with the largest values counts, the same in any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION = "_position"


def keyed_load(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key without ``POSITION``: the last one."""
    values = [c for c in df.columns if c not in (*keys, POSITION)]
    if not values:
        return df.select(*keys).distinct()
    if POSITION not in df.columns and len(values) == 1:
        return df.groupBy(*keys).agg(F.max(values[0]).alias(values[0]))  # stays a hash aggregate
    row = F.struct(*values)
    last = F.max_by(row, F.col(POSITION)) if POSITION in df.columns else F.max(row)
    return df.groupBy(*keys).agg(last.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])
