"""Source divergence audit over a frequent-pattern tree of term rows.

Terms are runs of letters (ASCII ones, A-Z lower-cased, and non-ASCII characters).  A language keeps
the terms in at least ``least_docs`` of its documents.  Each group (language, source) and each
language gives a kept term, with ``count`` occurrences there, the weight
``1 + floor(scale * (count + smoothing) / (N + smoothing * V))``: N is the sum of the counts, V the
number of kept terms.  Two sources of a language differ by the sum over all kept terms of the
absolute difference of the weights; a source's own terms are those whose weight is above the
language's.

A term that neither source has adds the same amount for every such term, and most terms are in few
sources, so a pair's sum is split: V times that amount, a correction for each term of one source
(taken over the distinct weights of the source), and a correction for each term that both have.
The last comes from a frequent-pattern tree (Han, Pei and Yin, 2000): a term's row, its nonzero weights
in the order of the sources, is a path from the root, and equal beginnings share their nodes, whose
multiplicity is the number of terms.  For each node and each of its ancestors one correction, times
the multiplicity, covers all those terms.  Equal rows are first merged to one with a count; then rows
are range-partitioned in their order, so that a task reads its part of the tree depth first and holds
one path only.  Nodes cut by a border between tasks are counted on both sides, each with its own
share of the multiplicity, which gives the same sums.

Terms are counted by a Python map over the documents with a table of at most ``HELD_TERMS`` terms, so
frequent ones leave a task once per table; long texts are cut into segments of ``SEGMENT`` bytes.
All sums are integers.

Defined results: a null text, language or source is the empty string; an empty text makes its group
occur.  Repeated rows are documents of their own.  A language without kept terms has the value 0 for
every pair and no terms; an empty table gives no rows.  Other columns are ignored."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.llm.common import importable, strings, utf8
from recsmith.session import materialise

LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
HELD_TERMS = 300_000   # terms that a task counts before it passes them on
HELD_CELLS = 4_000_000  # pair sums that a task holds
TASK_ROWS = 10_000     # term rows of a task that walks its part of the tree
BORDER_ENTRIES = 4     # entries of a row that decide its task
SEGMENT = 1 << 20      # bytes of a long text counted at once

# A-Z become a-z; bytes outside terms become spaces.  Bytes from 0x80 on are parts of non-ASCII characters.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# --- counting -------------------------------------------------------------------------

def _count_text(text: bytes, n: Counter, docs: Counter) -> None:
    folded = text.translate(FOLD)
    if len(folded) <= SEGMENT:
        terms = folded.split()
        n.update(terms)
        docs.update(set(terms))
        return
    seen, at = set(), 0
    while at < len(folded):
        end = folded.find(b" ", at + SEGMENT)
        end = len(folded) if end < 0 else end
        terms = folded[at:end].split()
        n.update(terms)
        seen.update(terms)
        at = end
    docs.update(seen)


def _count_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms, counts = list(n), list(n.values())
            for i in range(0, len(terms), 50_000):
                part = terms[i:i + 50_000]
                same = lambda v: pa.array([v] * len(part), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [same(lang), same(source), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array(counts[i:i + 50_000], pa.int64()), pa.array([docs[t] for t in part], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(strings(batch.column(0)), strings(batch.column(1)), utf8(batch.column(2))):
            n, docs = held[lang, source]
            size -= len(n)
            _count_text(text, n, docs)
            size += len(n)
            if size >= HELD_TERMS:
                yield from out()
                size = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group."""
    importable(docs.sparkSession)
    part = docs.select("lang", "source", "text").mapInArrow(_count_partition, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def weight(count: Column, total: Column, v: Column, smoothing: int = SMOOTHING, scale: int = SCALE) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * v)), exactly."""
    wide = [(x).cast("decimal(20,0)") for x in (count + smoothing, total + v * smoothing)]
    return (F.lit(1) + F.call_function("div", wide[0] * F.lit(scale).cast("decimal(10,0)"), wide[1])).cast("long")


# --- the tree -------------------------------------------------------------------------

class PairSums:
    """Corrections of source pairs from term rows that arrive in order: the path of the last row is
    held, and a node's corrections are made when its last row has passed."""

    def __init__(self):
        self.at = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)  # source, weight, weight of absence
        self.many: list[int] = []  # multiplicity of each node on the path
        self.sums: dict[int, np.ndarray] = {}  # later source -> sums by earlier source
        self.cells = 0

    def insert(self, source: np.ndarray, p: np.ndarray, p0: np.ndarray, n: int) -> None:
        """``n`` terms with this row."""
        depth = len(self.many)
        same = min(depth, len(source))
        differs = np.flatnonzero((self.at[0][:same] != source[:same]) | (self.at[1][:same] != p[:same]))
        shared = int(differs[0]) if len(differs) else same
        self.close(shared)
        self.at = source, p, p0
        self.many += [0] * (len(source) - shared)
        for i in range(len(self.many)):
            self.many[i] += n

    def close(self, depth: int) -> None:
        """End the nodes of the path below ``depth``."""
        source, p, p0 = self.at
        for d in range(len(self.many) - 1, max(depth, 1) - 1, -1):
            own, none, later = p[d], p0[d], int(source[d])
            up, up0 = p[:d], p0[:d]
            fix = np.abs(up - own) - np.abs(up - none) - np.abs(up0 - own) + np.abs(up0 - none)
            held = self.sums.get(later)
            if held is None:
                held = self.sums[later] = np.zeros(later + 1, np.int64)
                self.cells += later + 1
            held[source[:d]] += fix * self.many[d]
        del self.many[depth:]

    def take(self) -> Iterator[tuple[int, int, int]]:
        for later, sums in self.sums.items():
            for earlier in np.flatnonzero(sums).tolist():
                yield earlier, later, int(sums[earlier])
        self.sums, self.cells = {}, 0


def _tree_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, row, n) in order: sums of corrections (lang, a, b, fix)."""
    tree, held = PairSums(), None

    def out() -> pa.RecordBatch:
        rows = list(tree.take())
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array([held] * len(rows), pa.string()), *(pa.array(c, pa.int64()) for c in cols)],
                                          ["lang", "a", "b", "fix"])

    for batch in batches:
        rows = batch.column(1)
        ends = rows.offsets.to_numpy() - rows.offsets[0].as_py()
        fields = [rows.flatten().field(i).to_numpy() for i in range(3)]
        for i, (lang, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
            if lang != held:
                tree.close(0)
                yield out()
                held = lang
            tree.insert(*(f[ends[i]:ends[i + 1]] for f in fields), n)
            if tree.cells >= HELD_CELLS:
                yield out()
    tree.close(0)
    yield out()


def shared_corrections(entries: DataFrame, n_terms: int) -> DataFrame:
    """(lang, a, b, fix), a < b, from ``entries`` (lang, term, at, p, p0) of ``n_terms`` terms: what the terms
    that both sources have change in the sum of their pair."""
    importable(entries.sparkSession)
    rows = entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("at", "p", "p0"))).alias("row"))
    merged = rows.groupBy("lang", "row").agg(F.count("*").alias("n"))
    # the first entries set the borders: the driver samples them, not whole rows
    first = [c for i in range(BORDER_ENTRIES) for c in (F.get("row", F.lit(i))["at"], F.get("row", F.lit(i))["p"])]
    ordered = merged.repartitionByRange(1 + n_terms // TASK_ROWS, "lang", *first).sortWithinPartitions("lang", "row")
    return ordered.select("lang", "row", "n").mapInArrow(_tree_partition, "lang string, a long, b long, fix long").groupBy("lang", "a", "b").agg(
        F.sum("fix").alias("fix"))


def single_corrections(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, fix): what the terms that source a has change in its sum with b, as if b had none."""
    weights = entries.groupBy("lang", F.col("at").alias("a"), "p", F.col("p0").alias("none_a")).agg(F.count("*").alias("n"))
    other = groups.select("lang", F.col("at").alias("b"), F.col("p0").alias("none_b"))
    fix = F.col("n") * (F.abs(F.col("p") - F.col("none_b")) - F.abs(F.col("none_a") - F.col("none_b")))
    return weights.join(other, "lang").filter("a <> b").groupBy("lang", "a", "b").agg(F.sum(fix).alias("fix"))


# --- the audit ------------------------------------------------------------------------

def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, scale: int = SCALE, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair``, every other source of the language by
    falling difference; part ``term``, the ``top_terms`` terms furthest above the language's weight."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    rows = (term_counts(docs).groupBy("lang", "term")
            .agg(F.collect_list(F.struct("source", "n")).alias("row"), F.sum("docs").alias("docs"), F.sum("n").alias("all"))
            .filter(F.col("docs") >= least_docs))
    terms = materialise(rows.select("lang", "term", "row", "all"))  # one row per kept term
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("lang_n"))
    held = terms.select("lang", "term", "all", F.explode("row").alias("e")).select("lang", "term", "all", "e.source", "e.n")
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    zero = F.lit(0).cast("long")
    order = Window.partitionBy("lang").orderBy("source")
    groups = (docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("group_n", "v", "lang_n")))
              .withColumn("at", (F.row_number().over(order) - 1).cast("long"))
              .withColumn("p0", F.when(F.col("v") > 0, weight(zero, F.col("group_n"), F.col("v"), smoothing, scale))))
    groups = materialise(groups)
    entries = materialise(held.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "at", "p0", weight(F.col("n"), F.col("group_n"), F.col("v"), smoothing, scale).alias("p"),
        weight(F.col("all"), F.col("lang_n"), F.col("v"), smoothing, scale).alias("q")))

    both = lambda x: x.unionByName(x.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "fix"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("p0").alias("none_b"))
    pairs = groups.select("lang", "source", F.col("at").alias("a"), "p0", "v").join(other, "lang").filter("a <> b")
    fixes = (both(single_corrections(entries, groups)).unionByName(both(shared_corrections(entries, terms.count())))
             .groupBy("lang", "a", "b").agg(F.sum("fix").alias("fix")))
    absent = F.coalesce(F.col("v") * F.abs(F.col("p0") - F.col("none_b")), zero)
    pair = (pairs.join(fixes, ["lang", "a", "b"], "left")
            .select("lang", "source", F.lit("pair").alias("part"), "item", (absent + F.coalesce("fix", zero)).alias("value")))
    term = entries.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    top = term.withColumn("rank", rank).filter(F.col("rank") <= top_terms)
    return pair.withColumn("rank", rank).unionByName(top)
