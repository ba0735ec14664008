"""Conversation prefix trie, with subtree totals by parallel tree contraction.

A node of depth d is a distinct sequence of first d turns (role, text) of the conversations; the
root is the empty sequence.  Its members are the conversations that start with it.

* Nodes: a prefix is known by the exclusive or of the 128-bit hashes of its (position, role,
  text), so the prefixes of a conversation are running totals.  They are taken in blocks of
  ``BLOCK`` turns and the blocks' totals in a second step, and turns are numbered by a
  distributed rank: a conversation that holds a third of all turns is spread over many tasks.
* Contraction (Miller and Reif, 1985): rounds of joins.  Each round *rakes* all leaves, whose
  totals are then known, into their parents, and *compresses* chains: a node with one child that
  is no leaf is spliced out, its own share kept on the edge to that child.  Of two neighbours on
  a chain only the one goes whose depth has fewer trailing zero bits, so an unbroken chain
  halves in each round, and the rounds grow with the logarithm of the size, not with the depth.
* Re-expansion: a spliced node's total is its share and the total of the node that it was spliced
  onto; these references are followed by pointer doubling.

The members that end at a node are hashed in ascending order by a task that streams over strings
of at most ``1 << ID_BITS`` ids each, so identical conversations never meet in memory.

Defined results: rows without a conversation id belong to none.  Turns are ordered by their
number (null first), equal numbers by hash of role and text, so repeated rows are repeated turns.
A null role or text is the empty string.  Long texts are hashed and measured in the first
projection and go no further.  An empty table has no node.  Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.llm.common import importable
from recsmith.operators.candidates import distributed_rank
from recsmith.session import materialise

BLOCK = 1024     # turns of a conversation that one group of a task holds
ID_BITS = 10     # conversation ids alike in all but these bits are written as one string
TOTALS = ["leaves", "saved"]
_SALT = "prefix"  # of the second half of a hash


# --- turns ----------------------------------------------------------------------------

def numbered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, pos, a, b, chars): each turn's place from 0, the hashes of its role and text and the
    text's length in code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(_SALT), text, role).alias("b"), F.length(text).cast("long").alias("chars"))
    ranked = distributed_rank(turns, "conv", [F.asc_nulls_first("turn"), F.col("a"), F.col("b"), F.col("chars")], "pos")
    return ranked.select("conv", "pos", "a", "b", "chars")


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns come from the conversation c - c % ``group``, those
    from the h-th on are the conversation's own; h is crc32(c) modulo ``most``."""
    base = F.col("conv") - F.col("conv") % group
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.select("conv").distinct().select("conv", base.alias("base"), h.alias("h"))
    heads = turns.filter((F.col("pos") < most - 1) & (F.col("conv") % group == 0))  # of few turns each
    held = heads.groupBy("conv").agg(F.count("*").alias("n"))
    convs = convs.join(held.withColumnRenamed("conv", "base"), "base", "left")
    convs = convs.withColumn("start", F.least("h", F.coalesce("n", F.lit(0).cast("long"))))
    shared = (convs.select("conv", "base", "h").join(heads.withColumnRenamed("conv", "base"), "base")
              .filter("pos < h").select("conv", "pos", "a", "b", "chars"))
    own = (turns.join(convs.select("conv", "h", "start"), "conv").filter("pos >= h")
           .select("conv", (F.col("pos") - F.col("h") + F.col("start")).alias("pos"), "a", "b", "chars"))
    return shared.unionByName(own)


# --- nodes ----------------------------------------------------------------------------

def memberships(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, a, b, up_a, up_b, chars): the node of every prefix of every conversation, its
    parent's hashes, and the length of its last text.  ``convs``: all ids, turnless ones included."""
    at = turns.withColumn("depth", F.col("pos") + 1)
    own = {c: F.xxhash64("depth", "a", "b", F.lit(c)) for c in "ab"}
    hashed = materialise(at.select("conv", "depth", *(own[c].alias(f"x{c}") for c in "ab"), "chars",
                                   F.expr(f"pos div {BLOCK}").alias("block")))
    blocks = hashed.groupBy("conv", "block").agg(*(F.bit_xor(f"x{c}").alias(f"t{c}") for c in "ab"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", *(F.coalesce(F.bit_xor(f"t{c}").over(before), F.lit(0)).alias(f"t{c}") for c in "ab"))
    upto = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inner = hashed.select("*", *(F.bit_xor(f"x{c}").over(upto).alias(f"r{c}") for c in "ab"))
    node = {c: F.col(f"t{c}").bitwiseXOR(F.col(f"r{c}")) for c in "ab"}
    prefixes = inner.join(blocks, ["conv", "block"]).select(
        "conv", "depth", *(node[c].alias(c) for c in "ab"), *(node[c].bitwiseXOR(F.col(f"x{c}")).alias(f"up_{c}") for c in "ab"),
        "chars")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), *(zero.alias(c) for c in ("a", "b", "up_a", "up_b", "chars")))
    return prefixes.unionByName(roots)


def _node(depth: Column, a: str, b: str) -> Column:
    return F.struct(depth.alias("d"), F.col(a).alias("a"), F.col(b).alias("b"))


def nodes_of(members: DataFrame) -> DataFrame:
    """(id, depth, conv_id, n_convs, chars, up): one row per node; ``up`` of the root is null."""
    same = [F.max(c).alias(c) for c in ("up_a", "up_b", "chars")]  # alike in all members
    out = members.groupBy("depth", "a", "b").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *same)
    return out.select(_node(F.col("depth"), "a", "b").alias("id"), "depth", "conv_id", "n_convs", "chars",
                      F.when(F.col("depth") > 0, _node(F.col("depth") - 1, "up_a", "up_b")).alias("up"))


# --- contraction ----------------------------------------------------------------------

def _late(depth: Column) -> Column:
    """Order in which the nodes of a chain are spliced: by trailing zero bits of the depth, then depth."""
    zeros = F.bit_count(depth.bitwiseAND(-depth) - 1)
    return F.shiftleft(zeros.cast("long"), 40).bitwiseOR(depth)


def _round(tree: DataFrame) -> DataFrame:
    """One rake and compress: every node of ``tree`` with what becomes of it (``fate``: leaf, spliced or kept),
    its only child, and its parent's fate."""
    has_up = F.col("up").isNotNull()
    kids = tree.filter(has_up).groupBy(F.col("up").alias("id")).agg(F.count("*").alias("kids"))
    known = materialise(tree.join(kids, "id", "left").withColumn("kids", F.coalesce("kids", F.lit(0))))
    leaf = F.col("kids") == 0
    # seen from the parent: what its leaves bring, and its only child where there is one
    below = known.filter(has_up).groupBy(F.col("up").alias("id")).agg(
        *(F.sum(F.when(leaf, F.col(t) + F.col(f"edge_{t}")).otherwise(0)).alias(f"raked_{t}") for t in TOTALS),
        F.max("kids").alias("kid_kids"), F.max(_late(F.col("depth"))).alias("kid_late"), F.max("id").alias("kid"),
        *(F.max(f"edge_{t}").alias(f"kid_edge_{t}") for t in TOTALS))
    over = known.select(F.col("id").alias("up"), F.col("kids").alias("up_kids"), _late(F.col("depth")).alias("up_late"),
                        F.col("up").isNull().alias("up_root"))
    x = known.join(below, "id", "left").join(over, "up", "left")
    late = _late(F.col("depth"))
    chain = (F.col("kids") == 1) & (F.col("kid_kids") > 0) & has_up
    first = (F.col("up_root") | (F.col("up_kids") > 1) | (late < F.col("up_late"))) & \
            ((F.col("kid_kids") > 1) | (late < F.col("kid_late")))
    fate = F.when(leaf, "leaf").when(chain & first, "spliced").otherwise("kept")
    own = [(F.col(t) + F.coalesce(f"raked_{t}", F.lit(0))).alias(t) for t in TOTALS]
    return materialise(x.select("id", "up", "depth", *own, *(f"edge_{t}" for t in TOTALS), "kid",
                                *(f"kid_edge_{t}" for t in TOTALS), fate.alias("fate")))


def subtree_totals(tree: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(id, total per value) of every node of ``tree`` (id, up, depth): the sum over its subtree, itself
    included.  ``leaves`` counts childless nodes, whatever its given value."""
    zero = F.lit(0).cast("long")
    left = tree.select("id", "up", "depth", *(values.get(t, zero).cast("long").alias(t) for t in TOTALS),
                       *(zero.alias(f"edge_{t}") for t in TOTALS))
    inner = tree.filter("up is not null").select(F.col("up").alias("id")).distinct().withColumn("inner", F.lit(True))
    left = materialise(left.join(inner, "id", "left")
                       .withColumn("leaves", F.when(F.col("inner"), 0).otherwise(1).cast("long")).drop("inner"))
    gone = []
    while not left.isEmpty():
        now = _round(left)
        leaves = now.filter("fate = 'leaf'").select("id", F.lit(None).cast(now.schema["id"].dataType).alias("next"), *TOTALS)
        spliced = now.filter("fate = 'spliced'")
        gone += [leaves, spliced.select("id", F.col("kid").alias("next"),
                                        *((F.col(t) + F.col(f"kid_edge_{t}")).alias(t) for t in TOTALS))]
        skip = spliced.select(F.col("id").alias("up"), F.col("up").alias("past"),
                              *((F.col(t) + F.col(f"edge_{t}")).alias(f"more_{t}") for t in TOTALS))
        kept = now.filter("fate = 'kept'").join(skip, "up", "left")
        left = materialise(kept.select(
            "id", F.coalesce("past", "up").alias("up"), "depth", *TOTALS,
            *((F.col(f"edge_{t}") + F.coalesce(f"more_{t}", F.lit(0))).alias(f"edge_{t}") for t in TOTALS)))
    if not gone:
        return left.select("id", *TOTALS)
    known = materialise(reduce(DataFrame.unionByName, gone))
    while not (open_ := known.filter("next is not null")).isEmpty():  # pointer doubling
        onto = known.select(F.col("id").alias("next"), F.col("next").alias("after"), *(F.col(t).alias(f"next_{t}") for t in TOTALS))
        jumped = open_.join(onto, "next").select("id", F.col("after").alias("next"),
                                                 *((F.col(t) + F.col(f"next_{t}")).alias(t) for t in TOTALS))
        known = materialise(known.filter("next is null").unionByName(jumped))
    return known.select("id", *TOTALS)


# --- members that end at a node ---------------------------------------------------------

def _hash_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ids) sorted by key: the SHA-256 of each key's strings, comma-joined."""
    held, digest = None, None
    keys, out = [], []
    for batch in batches:
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != held:
                if held is not None:
                    keys.append(held)
                    out.append(digest.hexdigest())
                held, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], ["key", "ends_sha256"])
        keys, out = [], []
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.string()), pa.array([digest.hexdigest()], pa.string())],
                                         ["key", "ends_sha256"])


def _key(depth: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), F.hex("a"), F.hex("b"))


def end_hashes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes at which a conversation ends (``lengths``: conv, depth)."""
    importable(members.sparkSession)
    ends = members.join(lengths, ["conv", "depth"]).select(_key(F.col("depth")).alias("key"), "conv")
    some = ends.groupBy("key", F.shiftright("conv", ID_BITS).alias("part")).agg(F.sort_array(F.collect_list("conv")).alias("c"))
    text = F.array_join(F.transform("c", lambda x: x.cast("string")), ",")
    ordered = (some.select("key", "part", text.alias("ids")).repartition("key").sortWithinPartitions("key", "part")
               .select("key", "ids"))
    return ordered.mapInArrow(_hash_partition, "key string, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.  ``turns``: (conv, pos, a, b, chars), ``convs``: (conv)."""
    members = materialise(memberships(turns, convs))
    tree = materialise(nodes_of(members))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    totals = subtree_totals(tree, {"saved": saved})
    kids = tree.filter("up is not null").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("n_children"))
    parents = tree.select(F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    lengths = members.groupBy("conv").agg(F.max("depth").alias("depth"))
    out = (tree.join(totals, "id").join(kids, "id", "left").join(parents, "up", "left")
           .select("*", "id.a", "id.b").withColumn("key", _key(F.col("depth")))
           .join(end_hashes(members, lengths), "key", "left"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", none).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, rebuild=with_shared_heads) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text), its conversations rebuilt before."""
    turns = numbered_turns(conversations)
    convs = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv")).distinct()
    return prefix_trie(rebuild(turns) if rebuild else turns, convs)
