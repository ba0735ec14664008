"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from where the driver
    did (on a cluster it is installed, and this changes nothing there)."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), _ROOT) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_udf(fn: Callable[..., pa.Array], schema: str, setup: Callable[[], object] | None = None):
    """An Arrow UDF over whole columns: ``fn(state, *arrays)`` gives one array.

    ``setup`` runs once per task (models and vocabularies are loaded there).  The UDF is
    marked nondeterministic so that the optimizer never evaluates it a second time below a
    pushed filter; its results are a function of its inputs all the same."""

    def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        state = setup() if setup else None
        for arrays in parts:
            yield fn(state, *(arrays if isinstance(arrays, tuple) else (arrays,)))

    def one(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(parts)

    def many(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return run(parts)

    def call(*cols: Column) -> Column:
        importable(SparkSession.active())
        f = one if len(cols) == 1 else many
        # plain classes: the annotations of this module are strings
        f.__annotations__ = {"parts": Iterator[pa.Array] if len(cols) == 1 else Iterator[tuple[pa.Array, ...]],
                             "return": Iterator[pa.Array]}
        return F.arrow_udf(f, returnType=schema).asNondeterministic()(*cols)

    return call


def add_columns(df: DataFrame, result: Column, names: list[str]) -> DataFrame:
    """``df`` with the struct fields ``names`` of ``result``; a field replaces an input column
    of the same name (in any letter case)."""
    taken = {n.lower() for n in names}
    rest = [f"`{c}`" for c in df.columns if c.lower() not in taken]
    held = "_llm_result"
    while held in {c.lower() for c in df.columns}:
        held += "_"
    return df.withColumn(held, result).select(*rest, *(F.col(f"{held}.{n}").alias(n) for n in names))


def utf8(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


def structs(columns: dict[str, tuple[object, pa.DataType]]) -> pa.Array:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=t) for v, t in columns.values()]
    return pa.StructArray.from_arrays(arrays, names=list(columns))


def crc32_mod(col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n
