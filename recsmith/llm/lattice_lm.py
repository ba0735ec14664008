"""Language-model scores by subword lattice likelihood.

A text is a stream of pieces and one end; a word is spelled by pieces of an existing subword
vocabulary, the first of which carries the word mark.  Every segmentation of a word counts: its
probability is the sum over all of them of the product of their piece probabilities, found by
the forward recursion in log space, and a document's log probability is the sum over its words
plus the end.  Characters without a piece are spelled by the vocabulary's byte pieces.

The vocabulary's own scores are the first weights (scores that are negative merge ranks become
weights 1 / (1 + rank)).  They are fitted to the training fold by expectation maximisation: each
round sums the expected piece counts of all distinct training words, weighted by their counts,
with forward and backward recursion in numpy batches of words of equal length.  Only the piece
table, of fixed size, comes to the driver.

``score_documents`` also gives the base: add-half word probabilities.  Word counts and word
log-probabilities form one distributed table.  Words holding at least a ``1 / FREQUENT`` share of
all tokens, at most ``FREQUENT`` by that definition, are broadcast and summed where the text is
read; the others are joined by word.

Defined results: a null or empty text is its end alone; a null id counts as empty text for the
fold; repeated rows are scored (and counted) each on their own; an empty table gives no rows;
without training rows the vocabulary's own weights are used and every count is zero; other
columns are ignored.  Time is linear in the text; words beyond ``LONG_WORD`` characters go edge by edge in
plain Python, about 7 seconds for each pass over a word of a million characters (one pass to
score it, one for each round of fitting).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.llm.common import crc32_mod, importable, utf8
from recsmith.session import materialise

FOLDS, HELD_OUT = 5, 1
ROUNDS = 2
FREQUENT = 1_000_000
HELD_WORDS = 200_000     # distinct words a counting task holds before it hands them on
CELLS = 1 << 19          # lattice positions of one numpy batch, about
BATCH_WORDS = 200_000    # distinct words that a lattice task takes at once, about
LONG_WORD = 512          # characters beyond which a word is not worth a numpy batch
MARK = "▁"

_STEP = np.uint64(0x9E3779B97F4A7C15)


# --- lattice --------------------------------------------------------------------------

def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x * np.uint64(0xC4CEB9FE1A85EC53)


class Pieces:
    """A subword vocabulary as a hash table over substring hashes.

    ``weight``: log probability of each piece, then of the end; entry -1 stands for no piece."""

    def __init__(self, pieces: list[str], byte_ids: dict[int, int], weight: np.ndarray):
        self.pieces, self.byte_ids, self.weight = pieces, byte_ids, weight
        usable = [(i, p) for i, p in enumerate(pieces) if p and MARK not in p[1:]]
        usable = [(i, p) for i, p in usable if i not in set(byte_ids.values())]
        self.longest = max((len(p) for _, p in usable), default=1)
        self.single = {ord(p) for _, p in usable if len(p) == 1}
        keys = np.array([self._hash(p) for _, p in usable], dtype=np.uint64)
        ids = np.array([i for i, _ in usable], dtype=np.int32)
        # a few tables, each holding what found its place taken in the one before
        self.tables = []
        bits = 18
        while len(keys):
            slot = (keys * _STEP) >> np.uint64(64 - bits)
            _, first = np.unique(slot, return_index=True)
            held, where = np.zeros(1 << bits, dtype=np.uint64), np.full(1 << bits, -1, dtype=np.int32)
            held[slot[first]], where[slot[first]] = keys[first], ids[first]
            self.tables.append((np.uint64(64 - bits), held, where))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ids, bits = keys[rest], ids[rest], bits - 1

    @staticmethod
    def _hash(piece: str) -> int:
        h = np.zeros(1, dtype=np.uint64)
        for m in _mixed(np.array([ord(c) for c in piece])):
            h = h * _STEP + m
        return int(h[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece numbers of substring hashes, -1 where there is none."""
        out = np.full(keys.shape, -1, dtype=np.int32)
        spread = keys * _STEP
        for shift, held, where in self.tables:
            slot = spread >> shift
            np.copyto(out, where[slot], where=(held[slot] == keys) & (where[slot] >= 0))
        return out

    def edges(self, codes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For words of equal length (n, length): per piece length, the piece number at every
        start; and the log weight of spelling the character at each place by bytes (0 if a piece
        covers it alone)."""
        n, length = codes.shape
        total = np.zeros((n, length + 1), dtype=np.uint64)
        mixed = _mixed(codes)
        for i in range(length):
            total[:, i + 1] = total[:, i] * _STEP + mixed[:, i]
        power = int(_STEP)
        found = []
        for size in range(1, min(self.longest, length) + 1):
            found.append(self.find(total[:, size:] - total[:, :length + 1 - size] * np.uint64(power)))
            power = power * int(_STEP) % (1 << 64)
        return found, found[0] < 0

    def by_bytes(self, codes: np.ndarray, unknown: np.ndarray) -> np.ndarray:
        out = np.zeros(codes.shape)
        for c in np.unique(codes[unknown]).tolist():
            out[unknown & (codes == c)] = sum(self.weight[self.byte_ids[b]] for b in chr(c).encode())
        return out

    def _long(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One long word, edge by edge (only the pieces that are there): start, end, piece (-1: by
        bytes) and weight of every edge, and the forward and backward log weights of every place."""
        length = codes.shape[1]
        found, unknown = self.edges(codes)
        spelled = self.by_bytes(codes, unknown)[0]
        starts = [np.flatnonzero(f[0] >= 0) for f in found]
        pieces = [f[0][at] for f, at in zip(found, starts)]
        bare = np.flatnonzero(unknown[0])
        start = np.concatenate([*starts, bare])
        end = start + np.concatenate([*[np.full(len(at), k + 1) for k, at in enumerate(starts)], np.ones(len(bare), int)])
        piece = np.concatenate([*pieces, np.full(len(bare), -1)]).astype(np.int64)
        weight = np.where(piece < 0, spelled[np.minimum(start, length - 1)], self.weight[piece])

        def recursion(source: np.ndarray, target: np.ndarray, first: int) -> np.ndarray:
            """Log sums over edges, in the order of the places they lead to."""
            value = [float("-inf")] * (length + 1)
            value[first] = 0.0
            order = np.argsort(target if first == 0 else -target, kind="stable")
            here, terms = -1, []
            for a, b, w in zip(source[order].tolist(), target[order].tolist(), weight[order].tolist()):
                if b != here:
                    if terms:
                        value[here] = _log_sum(terms)
                    here, terms = b, []
                terms.append(value[a] + w)
            if terms:
                value[here] = _log_sum(terms)
            return np.array(value)

        return start, end, piece, weight, recursion(start, end, 0), recursion(end, start, length)

    def _expected_long(self, codes: np.ndarray, count: float) -> np.ndarray:
        start, end, piece, weight, alpha, beta = self._long(codes)
        share = np.exp(alpha[start] + weight + beta[end] - alpha[-1]) * count
        uses = np.bincount(np.where(piece < 0, len(self.weight), piece), share, len(self.weight) + 1)[:-1]
        for at in np.flatnonzero(piece < 0).tolist():
            for b in chr(int(codes[0, start[at]])).encode():
                uses[self.byte_ids[b]] += share[at]
        return uses

    def forward(self, codes: np.ndarray, found=None, spelled=None) -> np.ndarray:
        """Log weight of all segmentations of each prefix (n, length + 1)."""
        n, length = codes.shape
        if length > LONG_WORD and found is None:
            return np.stack([self._long(row[None])[4] for row in codes])
        if found is None:
            found, unknown = self.edges(codes)
            spelled = self.by_bytes(codes, unknown) if unknown.any() else None
        weight = np.append(self.weight, -np.inf)  # number -1 is the last entry
        alpha = np.zeros((n, length + 1))
        for j in range(1, length + 1):
            terms = np.stack([alpha[:, j - k] + weight[found[k - 1][:, j - k]] for k in range(1, min(len(found), j) + 1)])
            if spelled is not None:
                terms[0] = np.where(found[0][:, j - 1] < 0, alpha[:, j - 1] + spelled[:, j - 1], terms[0])
            top = terms.max(axis=0)
            alpha[:, j] = top + np.log(np.exp(terms - np.where(np.isinf(top), 0, top)).sum(axis=0))
        return alpha

    def expected(self, codes: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in words of equal length that occur ``count``
        times, over all their segmentations."""
        n, length = codes.shape
        if length > LONG_WORD:
            return sum(self._expected_long(row[None], c) for row, c in zip(codes, count))
        found, unknown = self.edges(codes)
        spelled = self.by_bytes(codes, unknown) if unknown.any() else None
        alpha = self.forward(codes, found, spelled)
        weight = np.append(self.weight, -np.inf)
        uses = np.zeros(len(self.weight) + 1)
        beta = np.full((n, length + 1), -np.inf)
        beta[:, length] = 0
        whole = alpha[:, length]
        for i in range(length - 1, -1, -1):
            sizes = range(1, min(len(found), length - i) + 1)
            terms = np.stack([beta[:, i + k] + weight[found[k - 1][:, i]] for k in sizes])
            if spelled is not None:
                bare = found[0][:, i] < 0
                terms[0] = np.where(bare, beta[:, i + 1] + spelled[:, i], terms[0])
            share = np.exp(terms + (alpha[:, i] - whole)[None]) * count
            for k in sizes:
                uses += np.bincount(np.where(found[k - 1][:, i] < 0, len(self.weight), found[k - 1][:, i]), share[k - 1],
                                    len(uses))
            if spelled is not None:
                for c in np.unique(codes[bare, i]).tolist():
                    at = bare & (codes[:, i] == c)
                    for b in chr(c).encode():
                        uses[self.byte_ids[b]] += share[0][at].sum()
            top = terms.max(axis=0)
            beta[:, i] = top + np.log(np.exp(terms - np.where(np.isinf(top), 0, top)).sum(axis=0))
        return uses[:-1]


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum([math.exp(t - top) for t in terms])) if top > float("-inf") else top


def read_vocabulary(path: str) -> Pieces:
    """The pieces of a sentencepiece model with their own scores as log weights; one more weight,
    the smallest, for the end."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
    byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
    pieces = ["" if special[i] else sp.id_to_piece(i) for i in range(size)]
    score = np.array([sp.get_score(i) for i in range(size)])
    plain = [i for i in range(size) if pieces[i] and not sp.is_byte(i)]
    if score[plain].min() < -1000:  # merge ranks
        score = -np.log1p(np.maximum(-score, 0))
    low = score[plain].min()
    score[list(byte_ids.values())] = low
    return Pieces(pieces, byte_ids, _normal(np.append(np.where(np.array([bool(p) for p in pieces]), score, -np.inf), low)))


def _normal(log_weight: np.ndarray) -> np.ndarray:
    return log_weight - np.logaddexp.reduce(log_weight)


def batches_of(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, codes): words, with the word mark, in batches of equal length."""
    lengths = np.array([len(w) + 1 for w in words])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        size = int(lengths[order[at]])
        to = min(int(np.searchsorted(lengths[order], size, side="right")), at + max(1, CELLS // size))
        pick = order[at:to]
        text = "".join(MARK + words[i] for i in pick)
        yield pick, np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(len(pick), size).astype(np.int64)
        at = to


def word_scores(pieces: Pieces, words: list[str]) -> np.ndarray:
    """Log probability (natural) of spelling each word, over all segmentations."""
    out = np.zeros(len(words))
    for pick, codes in batches_of(words):
        out[pick] = pieces.forward(codes)[:, -1]
    return out


# --- Spark ----------------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, c): training counts of the words of (text, train) rows, summed within the task."""
    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "c"])

    held: Counter = Counter()
    for b in batches:
        for text, train in zip(utf8(b.column(0)), b.column(1).to_pylist()):
            words = text.lower().split()
            if train:
                held.update(words)
            else:
                held.update(dict.fromkeys(words, 0))
            if len(held) > HELD_WORDS:
                yield out(held)
                held = Counter()
    yield out(held)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of about ``BATCH_WORDS`` rows: words of one length then fill numpy batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= BATCH_WORDS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: Pieces = shared.value
        uses = np.zeros(len(pieces.weight))
        for b in _merged(batches):
            words = [w.decode() for w in b.column(0).to_pylist()]
            count = b.column(1).to_numpy().astype(float)
            for pick, codes in batches_of(words):
                uses += pieces.expected(codes, count[pick])
        at = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(uses[at])], names=["piece", "uses"])

    return run


def fit(counts: DataFrame, ends: int, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Fit the piece probabilities to the word counts (word, c) and ``ends`` texts.  A piece is
    smoothed by its first weight, as if it had been seen ``number of pieces`` times its share."""
    first = pieces.weight
    for _ in range(rounds if ends else 0):
        shared = counts.sparkSession.sparkContext.broadcast(pieces)
        rows = (counts.filter("c > 0").select("word", "c").mapInArrow(_expect(shared), "piece int, uses double")
                .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())
        uses = np.exp(first) * len(first)
        for r in rows:
            uses[r["piece"]] += r["uses"]
        uses[-1] += ends
        with np.errstate(divide="ignore"):
            pieces = Pieces(pieces.pieces, pieces.byte_ids, np.log(uses / uses.sum()))
        shared.unpersist()
    return pieces


def _score_words(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _merged(batches):
            score = word_scores(shared.value, [w.decode() for w in b.column(0).to_pylist()]) / np.log(10)
            yield from pa.table([b.column(0), b.column(1), pa.array(score)], names=["word", "c", "score"]).to_batches()

    return run


def _sum_frequent(shared, id_type: pa.DataType):
    """One row per text with the sums over its frequent words, and one per other word in it.  The
    text's own row has a key that no word can be (it begins with a space)."""
    names = ["row", "key", "n", "id", "held_out", "own", "base", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base, score = shared.value
        base, score = np.append(base, 0.0), np.append(score, 0.0)  # -1: not frequent
        get = index.get
        for b in batches:
            cols: list[list] = [[] for _ in names]

            def add(*row):
                for c, v in zip(cols, row):
                    c.append(v)

            def out() -> pa.RecordBatch:
                kinds = [pa.int64(), pa.binary(), pa.int64(), id_type, pa.bool_(), pa.int64(), pa.float64(), pa.float64()]
                rb = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
                for c in cols:
                    c.clear()
                return rb

            for row, key, held_out, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                                utf8(b.column(3))):
                words = text.lower().split()
                at = np.array([get(w, -1) for w in words], dtype=np.int64)
                other = Counter([w for w, i in zip(words, at.tolist()) if i < 0])
                add(row, b" " + str(row).encode(), len(words) + 1, key, held_out, int((at >= 0).sum()),
                    float(base[at].sum()), float(score[at].sum()))
                n = len(other)
                for c, v in zip(cols, ([row] * n, other.keys(), other.values(), [None] * n, [None] * n, [None] * n,
                                       [None] * n, [None] * n)):
                    c.extend(v)
                if len(cols[0]) > 100_000:
                    yield out()
            yield out()

    return run


def score_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``df``: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = df.sparkSession
    importable(spark)
    docs = df.select(F.col(id_col).alias("id"), (crc32_mod(id_col, FOLDS) == HELD_OUT).alias("held_out"),
                     F.col(text_col).alias("text"))
    counts = materialise(docs.select("text", ~F.col("held_out")).mapInArrow(_count_words, "word binary, c long")
                         .groupBy("word").agg(F.sum("c").alias("c")))
    ends = docs.filter(~F.col("held_out")).count()
    known = counts.filter("c > 0").agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n, v = known["n"] + ends, known["v"] + (ends > 0)
    whole = n + 0.5 * (v + 1)
    pieces = fit(counts, ends, read_vocabulary(vocabulary), rounds)
    shared = spark.sparkContext.broadcast(pieces)
    words = materialise(counts.mapInArrow(_score_words(shared), "word binary, c long, score double")
                        .withColumn("base", F.log10((F.col("c") + 0.5) / whole)))
    top = words.filter((F.col("c") > 0) & (F.col("c") * frequent >= n)).select("word", "base", "score").toArrow()
    table = ({w: i for i, w in enumerate(top.column("word").to_pylist())}, top.column("base").to_numpy(),
             top.column("score").to_numpy())
    common = spark.sparkContext.broadcast(table)
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema["id"].dataType
    parts = (docs.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text")
             .mapInArrow(_sum_frequent(common, to_arrow_type(id_type)),
                         f"row long, key binary, n long, id {id_type.simpleString()}, held_out boolean, own long, "
                         "base double, score double"))
    rest = words.select(F.col("word").alias("key"), F.col("c"), F.col("base").alias("word_base"),
                        F.col("score").alias("word_score"))
    joined = parts.join(rest, "key", "left")
    own = F.col("own").isNotNull()
    sums = joined.groupBy("row").agg(
        F.max("id").alias(id_col), F.max("held_out").alias("held_out"), F.sum(F.when(own, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(own, F.col("own")).when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(own, F.col("base")).otherwise(F.col("n") * F.col("word_base"))).alias("base_score"),
        F.sum(F.when(own, F.col("score")).otherwise(F.col("n") * F.col("word_score"))).alias("score"))
    end_base, end_score = float(np.log10((ends + 0.5) / whole)), float(pieces.weight[-1] / np.log(10))
    return sums.select(id_col, "held_out", "n_tokens", (F.col("n_known") + (1 if ends else 0)).alias("n_known"),
                       F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + end_base).alias("base_score"),
                       (F.col("score") + end_score).alias("score"))
