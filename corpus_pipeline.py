"""Corpus pipeline: quality rules, near-duplicates, personal data, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor kept; all
but the last return the columns of ``documents``.  ``run`` writes each stage as Parquet into
the shared folder and rereads it as the next one's input.  Inside a stage the columns have
neutral names, so extra columns of ``docs`` cannot clash with an operator's own."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm import mixing, packing, pii, quality_rules, simhash
from recsmith.llm.common import read_table
from recsmith.session import materialise, stage_scope

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral column names, and the neutral name of each column (lower case)."""
    return (docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]),
            {c.lower(): f"c{i}" for i, c in reversed(list(enumerate(docs.columns)))})


def _named(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select([f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    plain, name = _neutral(docs)
    measured = materialise(quality_rules.measure(plain, name["text"]))
    return _named(quality_rules.judge(measured, name["lang"]).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of the smallest id."""
    return simhash.one_per_group(docs, "doc_id", "text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; n_chars follows."""
    plain, name = _neutral(docs)
    text = F.coalesce("masked", name["text"])
    found = pii.find_personal_data(plain, name["text"]).withColumn(name["text"], text)
    if "n_chars" in name:
        n = F.when(F.col("masked").isNotNull(), F.length(name["text"])).otherwise(F.col(name["n_chars"]))
        found = found.withColumn(name["n_chars"], n.cast(docs.schema[int(name["n_chars"][1:])].dataType))
    return _named(found, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays in as many copies as its fitted rate gives (none, one or more)."""
    plain, name = _neutral(docs)
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias(name["doc_id"]),
                                                        mixing.label_domain().alias("domain"))
    mixed = mixing.mix(plain, labels, name["doc_id"], name["text"])
    one = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("_copy")
    return _named(mixed.select("*", one), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training sequences."""
    return packing.pack(docs, TOKENIZER, "doc_id", "text")


STAGES = [("quality_rules", quality), ("simhash_dedup", near_duplicates), ("personal_data", personal_data),
          ("mixing", mix), ("packing", pack)]

#: Jensen-Shannon verdicts, fingerprints and trained models are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with stage_scope(spark):  # a stage's own tables go once its result is written
            docs = materialise(stage(spark, docs, sf_dir), outer=True)
    return STAGES[-1][1](spark, docs, sf_dir)
