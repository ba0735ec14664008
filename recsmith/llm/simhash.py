"""SimHash near-duplicates by a binary-trie self-join.

``fingerprints`` gives every text its 64-bit SimHash over 3-word shingles.  ``links`` joins the
distinct fingerprints with themselves: they are the leaves of a binary trie, and pairs of trie
nodes are walked down together, adding up differing bits and dropping a pair as soon as it
differs in more than ``max_bits``.

For ``max_bits`` errors, one of ``max_bits + 1`` blocks of the 64 bits is without any error.
So the walk runs over as many tries, each with another block first, and starts below that
block, where the error budget is still untouched: one row per fingerprint and trie, keyed by
its node.  A node with more than ``NODE_LIMIT`` leaves is walked further as DataFrame steps
(``_descend``): each leaf goes to the node pairs of the next bits that its budget admits, until
every node pair is small enough for one task.  There the rest of the walk is done level by
level on numpy arrays, and only a spanning forest of the links found is returned.  Distinct
64-bit values have at most 2,080 others within two bits, which bounds the walk per leaf.

Defined results: a null or empty text (and one of white space only) has fingerprint zero and
links like any other; fewer than three words: the whole word sequence is the only shingle.
Rows with equal texts share a fingerprint and so a component.  A null doc_id takes part; the
component id is the smallest doc_id that is not null (null if there is none).  An empty table
gives no rows.  Input columns named like an output column are replaced.  A very long text is
hashed whole, in time linear in its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import add_columns, importable, row_udf, structs, utf8
from recsmith.llm.components import connected_components
from recsmith.session import materialise

SHINGLE = 3       # words
MAX_BITS = 2      # differing bits of a link
SEED = 42
NODE_LIMIT = 8192  # leaves that one task walks as one node: some 380,000 node pairs at a level, 62 MB
STRIDE = 4        # bits of one DataFrame step below a hot node: a leaf goes to 11 node pairs at most
WALK_LIMIT = 1 << 22  # node pairs held at once in a task


# --- fingerprints ---------------------------------------------------------------------

def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` (big-endian uint64) have each of the 64 bits, highest first."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 255 * 256):
        bits = np.unpackbits(hashes[at:at + 255 * 256].view(np.uint8).reshape(-1, 8), axis=1)
        for k in range(0, len(bits), 255):  # at most 255 ones: the sum stays in a byte
            total += bits[k:k + 255].sum(axis=0, dtype=np.uint8)
    return total


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()  # bytes: lower() changes A-Z only, split() the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        hashes = [digest(joined[a:b], seed)
                  for a, b in zip(starts[:1 - shingle].tolist(), ends[shingle - 1:].tolist())]
    ones = _bit_counts(np.array(hashes, dtype=">u8"))
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprint(_, texts: pa.Array) -> pa.Array:
    values = [simhash(t) for t in utf8(texts)]
    return structs({"fp": (np.array(values, dtype=np.uint64).view(np.int64), pa.int64()),
                    "fingerprint": ([f"{v:016x}" for v in values], pa.string())})


def fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``fp`` (the fingerprint's bits as a long) and ``fingerprint`` (16 hex digits)."""
    return add_columns(df, row_udf(_fingerprint, "fp long, fingerprint string")(F.col(text_col)),
                       ["fp", "fingerprint"])


# --- trie self-join -------------------------------------------------------------------

NODE = ["trie", "depth", "a", "b"]  # a pair of nodes: prefixes a and b of ``depth`` bits


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``max_bits + 1`` blocks."""
    n = max_bits + 1
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(n)]


def _rotate(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _roots(fps: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and trie, at the node of the trie's first block."""
    tries = []
    for i, (first, width) in enumerate(_blocks(max_bits)):
        value = _rotate(F.col("fp"), first)
        prefix = F.shiftrightunsigned(value, 64 - width)
        tries.append(F.struct(F.lit(i).alias("trie"), F.lit(width).alias("depth"), prefix.alias("a"),
                              prefix.alias("b"), F.lit(0).alias("err"), F.lit(0).alias("side"), value.alias("value")))
    return fps.select(F.explode(F.array(*tries)).alias("r")).select("r.*")


def _descend(rows: DataFrame, max_bits: int) -> DataFrame:
    """The node pairs of the next ``STRIDE`` bits that each leaf takes part in: the other node's
    bits are the leaf's own with a mask of differing bits that the error budget admits."""
    masks = [m for m in range(1 << STRIDE) if m.bit_count() <= max_bits]
    table = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("e")) for m in masks])
    down = F.expr(f"shiftrightunsigned(value, 64 - depth - {STRIDE})").bitwiseAND(F.lit((1 << STRIDE) - 1))
    rows = rows.select("*", down.alias("own"), F.explode(table).alias("x")).filter(F.col("err") + F.col("x.e") <= max_bits)
    other = F.col("own").bitwiseXOR(F.col("x.m"))
    first = (F.col("side") == 1) | ((F.col("side") == 0) & (F.col("own") <= other))  # the leaf is below a
    side = F.when((F.col("side") == 0) & (F.col("x.m") == 0), 0).when(first, 1).otherwise(2)
    return rows.select("trie", (F.col("depth") + STRIDE).alias("depth"),
                       F.shiftleft("a", STRIDE).bitwiseOR(F.when(first, F.col("own")).otherwise(other)).alias("a"),
                       F.shiftleft("b", STRIDE).bitwiseOR(F.when(first, other).otherwise(F.col("own"))).alias("b"),
                       (F.col("err") + F.col("x.e")).alias("err"), side.alias("side"), "value")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _cross(alo, ahi, blo, bhi, err, same, value, max_bits):
    """Links (positions) among the leaves of small node pairs, by comparing them directly."""
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    k = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = alo[k] + at // nb[k], blo[k] + at % nb[k]
    keep = ~same[k] | (i < j)
    i, j = i[keep], j[keep]
    near = _popcount(value[i] ^ value[j]) <= max_bits
    return i[near], j[near]


def walk(value: np.ndarray, alo, ahi, blo, bhi, err, same, depth, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk the node pairs [alo, ahi) x [blo, bhi) of sorted leaves down together.

    ``depth``: the level at which each pair enters; at a level, each node splits where its
    leaves' bit turns from 0 to 1.  A pair whose bits differ costs one error, and pairs over the
    budget are dropped.  Two single leaves are compared at once.  Returns linked positions."""
    found_i, found_j = [], []
    cur = [np.empty(0, np.int64)] * 5 + [np.empty(0, bool)]
    for level in range(int(depth.min()) if len(depth) else 64, 65):
        enter = depth == level
        cur = [np.concatenate([c, x[enter]]) for c, x in zip(cur, (alo, ahi, blo, bhi, err, same))]
        a0, a1, b0, b1, e, s = cur
        small = (a1 - a0) * (b1 - b0) == 1
        if level == 64:
            small[:] = True
        if small.any():
            i, j = _cross(a0[small], a1[small], b0[small], b1[small], e[small], s[small], value, max_bits)
            found_i.append(i)
            found_j.append(j)
            a0, a1, b0, b1, e, s = (x[~small] for x in (a0, a1, b0, b1, e, s))
        if not len(a0):
            cur = [x for x in (a0, a1, b0, b1, e, s)]
            if not (depth > level).any():
                break
            continue
        zero = np.concatenate([[0], np.cumsum((value >> np.uint64(63 - level)) & np.uint64(1) == 0)])
        am, bm = a0 + zero[a1] - zero[a0], b0 + zero[b1] - zero[b0]
        nodes = [(a0, am, b0, bm, e, s), (am, a1, bm, b1, e, s), (a0, am, bm, b1, e + 1, np.zeros_like(s))]
        cross = ~s
        nodes.append(tuple(x[cross] for x in (am, a1, b0, bm, e + 1, s)))
        cur = [np.concatenate(x) for x in zip(*nodes)]
        keep = (cur[1] > cur[0]) & (cur[3] > cur[2]) & (cur[4] <= max_bits) & (~cur[5] | (cur[1] - cur[0] > 1))
        cur = [x[keep] for x in cur]
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position linked with each of ``n`` positions, directly or over others."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        if (new == label).all():
            return label
        label = new


def _walk_groups(cols: dict[str, np.ndarray], first_bits: list[int], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among complete node pairs (any number of them), as a forest of fingerprints."""
    value = cols["value"].view(np.uint64)
    order = np.lexsort((value, cols["side"], cols["b"], cols["a"], cols["depth"], cols["trie"]))
    cols = {k: v[order] for k, v in cols.items()}
    value = value[order]
    new = np.ones(len(value), bool)
    new[1:] = np.any([cols[k][1:] != cols[k][:-1] for k in NODE], axis=0)
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(value))
    # leaves below a come before those below b; a pair of one node with itself has side 0 only
    mid = lo + np.add.reduceat((cols["side"] != 2).astype(np.int64), lo)
    same = cols["side"][lo] == 0
    alo, ahi = lo, np.where(same, hi, mid)
    blo, bhi = np.where(same, lo, mid), hi
    use = (ahi > alo) & (bhi > blo) & (~same | (hi - lo > 1))
    err, depth = cols["err"][lo].astype(np.int64), cols["depth"][lo].astype(np.int64)
    pick = np.flatnonzero(use)
    cost = np.cumsum(np.minimum((hi - lo)[pick] ** 2, 2081 * (hi - lo)[pick]))
    found_i, found_j = [], []
    at = 0
    while at < len(pick):
        base = cost[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(cost, base + WALK_LIMIT, side="right")))
        p = pick[at:to]
        i, j = walk(value, alo[p], ahi[p], blo[p], bhi[p], err[p], same[p], depth[p], max_bits)
        found_i.append(i)
        found_j.append(j)
        at = to
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    shift = np.array(first_bits, dtype=np.uint64)[cols["trie"]]
    fp = np.where(shift > 0, (value >> shift) | (value << (np.uint64(64) - shift) % np.uint64(64)), value)
    _, ids = np.unique(fp, return_inverse=True)
    back = np.empty(ids.max() + 1, dtype=np.uint64)
    back[ids] = fp
    label = forest(len(back), ids[np.concatenate(found_i)], ids[np.concatenate(found_j)])
    moved = np.flatnonzero(label != np.arange(len(back)))
    return back[moved].view(np.int64), back[label[moved]].view(np.int64)


def _walker(max_bits: int):
    first_bits = [first for first, _ in _blocks(max_bits)]
    names = [*NODE, "err", "side", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def links(cols):
            u, v = _walk_groups(cols, first_bits, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            cols = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            if held is not None:
                cols = {n: np.concatenate([held[n], cols[n]]) for n in names}
            if not len(cols["value"]):
                continue
            last = np.all([cols[k] == cols[k][-1] for k in NODE], axis=0)  # may go on in the next batch
            held = {n: v[last] for n, v in cols.items()}
            if not last.all():
                yield links({n: v[~last] for n, v in cols.items()})
        if held is not None:
            yield links(held)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints ``fp`` which a chain of pairs
    within ``max_bits`` bits connects (a spanning forest per task, not all pairs)."""
    importable(fps.sparkSession)
    rows, small = _roots(fps, max_bits), []
    while True:
        rows = materialise(rows)
        sides = [F.count_if(F.col("side") != 2).alias("na"), F.count_if(F.col("side") != 1).alias("nb")]
        large = (rows.groupBy(*NODE).agg(F.count("*").alias("n"), *sides).filter(F.col("n") > node_limit)
                 .filter(F.col("depth") <= 64 - STRIDE))
        large = materialise(large)
        if large.isEmpty():
            small.append(rows)
            break
        small.append(rows.join(large, NODE, "left_anti"))
        # a pair with leaves on one side only has no links
        hot = large.filter("na > 0 AND nb > 0").select(*NODE)
        rows = _descend(rows.join(hot, NODE, "left_semi"), max_bits)
    pairs = small[0]
    for more in small[1:]:
        pairs = pairs.unionByName(more)
    return (pairs.repartition(*NODE).sortWithinPartitions(*NODE)
            .mapInArrow(_walker(max_bits), "u long, v long"))


def components(marked: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component, component_id) of every distinct fingerprint of ``marked`` (a written table)."""
    fps = materialise(marked.groupBy("fp").agg(F.min(id_col).alias("least")))
    joined = connected_components(links(fps.select("fp"), max_bits))
    node = fps.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    node = materialise(node)
    least = node.groupBy("component").agg(F.min("least").alias("component_id"))
    return node.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: id, fingerprint and the id of its near-duplicate component."""
    marked = materialise(fingerprints(df.select(F.col(id_col), F.col(text_col).alias("text"))).drop("text"))
    return marked.join(components(marked, id_col, max_bits), "fp").select(id_col, "fingerprint", "component_id")


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` with one row of each component: that of the smallest id (nulls last;
    of repeated rows with that id, one)."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    lower = [n.lower() for n in names]
    key, text = f"c{lower.index(id_col.lower())}", f"c{lower.index(text_col.lower())}"
    marked = materialise(fingerprints(plain, text).withColumn("row", F.monotonically_increasing_id()))
    small = marked.select("fp", F.col(key).alias(id_col), "row")
    group = small.join(components(small, id_col, max_bits), "fp")
    stay = (group.groupBy("component").agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), "row")).alias("x"))
            .select("x.row"))
    return marked.join(stay, "row", "left_semi").select(*plain.columns).toDF(*names)
