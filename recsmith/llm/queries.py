"""Registered queries of this package: ``opN_<name>`` applies operator N to its whole table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds DuckDB SQL where
SQL can express the operator (the others are tested against brute force in tests/llm)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm import (ann, bpe_count, decontaminate, divergence, lattice_lm, mixing, oracles, packing, pii, prefix_trie,
                          quality_clf, quality_rules, secret_scan, simhash)
from recsmith.llm.common import crc32_mod, read_table
from recsmith.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_count.token_counts(docs, TOKENIZER).drop("text")


@query
def op4_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_documents(read_table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_clf.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_clf.score(docs, model).drop("text")
    return scored.select("doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs).drop("text", "masked")


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = materialise(quality_rules.measure(docs).drop("text"))
    return quality_rules.judge(measured).select("doc_id", *quality_rules.BASE, "base_failed", "kept",
                                                "nearest_lang", "char_distance", "word_distance")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", mixing.label_domain().alias("domain"))
    mixed = mixing.mix(docs, labels, keep_text=False)
    posterior = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)]
    return mixed.select("doc_id", "n_tokens", *posterior, "rate", "copies")


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE["op11_decontamination"] = oracles.DECONTAMINATION


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


ORACLE["op12_prefix_trie"] = oracles.PREFIX_TRIE


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = oracles.DIVERGENCE
