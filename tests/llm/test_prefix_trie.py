import hashlib
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from recsmith.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def tie(role, text):
    """Spark's xxhash64(role, text): the order of turns with equal numbers."""
    x = xxhash.xxh64_intdigest(text, xxhash.xxh64_intdigest(role, 42))
    return x - (x >> 63 << 64)


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(seqs):
    """Every prefix of every conversation in one table, sums pushed to all prefixes of a prefix."""
    node = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            n = node.setdefault(tuple(seq[:d]), {"in": [], "end": [], "kids": 0, "leaves": 0, "saved": 0})
            n["in"].append(c)
            n["end"] += [c] * (d == len(seq))
    for p in node:
        if p:
            node[p[:-1]]["kids"] += 1
    for p, n in node.items():
        for d in range(len(p) + 1):
            node[p[:d]]["saved"] += (len(n["in"]) - 1) * (len(p[-1][1]) if p else 0)
            node[p[:d]]["leaves"] += n["kids"] == 0
    return sorted((min(n["in"]), len(p), min(node[p[:-1]]["in"]) if p else None, len(n["in"]), n["kids"], n["leaves"], n["saved"],
                   hashlib.sha256(",".join(map(str, sorted(n["end"]))).encode()).hexdigest()) for p, n in node.items())


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_given_table(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert result(P.conversation_trie(table)) == brute(rebuilt(rows))


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    """Few different turns (much sharing), nulls, equal turn numbers, repeated rows, negative ids,
    groups without a conversation c - c % 100, and columns with the operator's own names."""
    rnd = random.Random(seed)
    ids = [*range(0, 12), 100, 103, 199, 205, 207, -3, -100, -150, None]
    rows = [(rnd.choice(ids), rnd.choice([None, 0, 1, 2, 3, 3, 9]), rnd.choice([None, "u", "a"]), rnd.choice([None, "", "x", "é🙂"]))
            for _ in range(150)]
    rows += rows[:5] + [(301, None, None, None)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit(1)).withColumn("a", F.lit("z")).withColumn("conv", F.lit(0))
    assert result(P.conversation_trie(table)) == brute(rebuilt(rows))


def test_long_chains_and_blocks(spark, monkeypatch):
    """A conversation of many blocks, a caterpillar (a chain with a leaf at every node) and a bushy
    start: rounds stay few, totals exact."""
    monkeypatch.setattr(P, "BLOCK", 7)
    long = [("u", f"t{i}") for i in range(150)]
    seqs = {1: long, 2: long[:75], 3: []}
    seqs |= {10 + i: long[:i] + [("u", "side")] for i in range(0, 60)}
    seqs |= {500 + i: [("u", f"n{i % 3}"), ("a", str(i))] for i in range(20)}
    rows = [(c, i, *t) for c, seq in seqs.items() for i, t in enumerate(seq)]
    turns = P.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    rounds = []
    whole = P._round
    monkeypatch.setattr(P, "_round", lambda tree: rounds.append(1) or whole(tree))
    convs = spark.createDataFrame([(c,) for c in seqs], "conv long")
    assert result(P.prefix_trie(turns, convs)) == brute(seqs)
    assert len(rounds) <= 20  # 151 levels


def test_identical_conversations_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(P, "ID_BITS", 2)
    seqs = {c: [("u", "same")] for c in range(-40, 40, 3)} | {1000: [("u", "other")]}
    rows = [(c, 0, *t) for c, seq in seqs.items() for t in seq]
    table = spark.createDataFrame(rows, SCHEMA)
    assert result(P.conversation_trie(table, rebuild=None)) == brute(seqs)


def test_empty_table(spark):
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).count() == 0
    only = P.conversation_trie(spark.createDataFrame([(7, None, None, None)], SCHEMA), rebuild=None)
    assert result(only) == brute({7: [("", "")]})
