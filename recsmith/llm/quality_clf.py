"""Quality classifier: supervised subword embeddings.

Words and character n-grams of a text are hashed into one table of vectors; their mean is the
document's vector, and a softmax over it gives the class probabilities.  Vectors and output
weights are learned together by stochastic gradient descent in numpy from a bounded sample of
labelled rows (``MAX_SAMPLE``, one row per id, those of smallest id hash), inside one task; the
sample itself is found and written by distributed tasks.  For two classes
the trained model collapses to one number per bucket, so scoring a text is a mean of looked-up
numbers, over the whole text.

Defined results: a null or empty text has no features, its score is the model's bias; rows
without a usable label (0 or 1) or id are not learned from; without rows of both classes every
score is the share of label 1 (0.5 if there are no labels).  Repeated rows are scored alike;
repeated labels of one id count once (the largest); an empty table gives no rows; an input
column named like an output column is replaced.  A very long text is scored whole, in time
linear in its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.llm.common import add_columns, crc32_mod, importable, row_udf, structs, utf8
from recsmith.session import materialise

BUCKET_BITS = 17
DIM = 8
GRAMS = (3, 4)          # bytes of a character n-gram, word ends included
MAX_SAMPLE = 6_000      # labelled rows that the model is fitted on, at most
EPOCHS = 8
BATCH = 32
THRESHOLD = 0.7

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def bucket_features(text: bytes) -> np.ndarray:
    """Bucket numbers of every word and every n-gram occurrence of a text."""
    words = text.split()
    if not words:
        return np.empty(0, dtype=np.int64)
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint64)
    shift = np.uint64(64 - BUCKET_BITS)
    out = []
    for n in GRAMS:
        if len(joined) >= n:
            key = np.full(len(joined) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                key = (key << np.uint64(8)) | joined[k:len(joined) - n + 1 + k]
            out.append((key * _MULTIPLIER) >> shift)
    # words: a polynomial in the base, made free of the word's place by the base's inverse
    power = np.cumprod(np.full(len(joined), _BASE))
    back = np.cumprod(np.full(len(joined), _INVERSE))
    total = np.concatenate([[np.uint64(0)], np.cumsum((joined + np.uint64(1)) * power)])
    gaps = np.flatnonzero(joined == 32)
    start, end = gaps[:-1] + 1, gaps[1:]
    out.append((((total[end] - total[start]) * back[start]) * _MULTIPLIER + _BASE) * _MULTIPLIER >> shift)
    return np.concatenate(out).astype(np.int64)


class Model:
    """``table``: the score difference of label 1 and label 0 per bucket; ``bias``."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias

    def score(self, text: bytes) -> float:
        f = bucket_features(text)
        logit = self.bias + (float(self.table[f].mean()) if len(f) else 0.0)
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def train(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, dim: int = DIM, rate: float = 40.0,
          seed: int = 7) -> Model:
    """Mini-batch stochastic gradient descent on the softmax loss."""
    y = np.array(labels, dtype=np.int64)
    size = 1 << BUCKET_BITS
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    if len(set(labels)) < 2:
        return Model(np.zeros(size, dtype=np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    feats, weights = [], []
    for t in texts:
        f, n = np.unique(bucket_features(t), return_counts=True)
        feats.append(f.astype(np.int32))
        weights.append((n / max(1, n.sum())).astype(np.float32))
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim)).astype(np.float32)
    out = np.zeros((dim, 2), dtype=np.float32)
    out[:, 0], out[:, 1] = -1, 1
    out *= rng.uniform(0.5, 1, (dim, 1)).astype(np.float32)
    bias = np.log(np.array([1 - share, share]))
    order = np.arange(len(y))
    steps, step = epochs * -(-len(y) // BATCH), 0
    for _ in range(epochs):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            rows = [i for i in order[at:at + BATCH] if len(feats[i])]
            lr = 1 - step / steps
            step += 1
            if not rows:
                continue
            idx = np.concatenate([feats[i] for i in rows])
            w = np.concatenate([weights[i] for i in rows])
            lengths = np.array([len(feats[i]) for i in rows])
            doc = np.add.reduceat(vectors[idx] * w[:, None], np.cumsum(lengths) - lengths, axis=0)
            z = doc @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            grad = (p @ out.T).astype(np.float32)
            out -= (0.02 * lr * doc.T @ p).astype(np.float32)
            bias -= 0.02 * lr * p.sum(axis=0)
            cells, inverse = np.unique(idx, return_inverse=True)
            change = np.repeat(grad, lengths, axis=0) * w[:, None]
            for d in range(dim):
                vectors[cells, d] -= rate * lr * np.bincount(inverse, change[:, d], len(cells)).astype(np.float32)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    rows: int = MAX_SAMPLE) -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled ids outside the held-out fold: those of the
    smallest id hash.  Only these ids, a bounded number, are broadcast.  One row per id: of repeated
    rows the largest text, found where the rows are, so a hot id sends one row per task onward."""
    ids = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc32_mod(id_col, 4) != 2))
           .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
           .orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (texts.join(F.broadcast(ids), "id").groupBy("id")
            .agg(F.max("text").alias("text"), F.max("label").alias("label")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows: int = MAX_SAMPLE) -> Model:
    """Train in one task on the bounded sample, which distributed tasks have written before; only
    the bucket table comes to the driver."""
    importable(docs.sparkSession)
    sample = materialise(labelled_sample(docs, labels, id_col, text_col, label_col, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[object, tuple[bytes, int]] = {}
        for b in batches:
            for i, t, y in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist()):
                seen[i] = (t, y)
        keys = sorted(seen)
        m = train([seen[k][0] for k in keys], [seen[k][1] for k in keys])
        yield pa.RecordBatch.from_arrays([pa.array([m.table.tobytes()], pa.binary()), pa.array([m.bias], pa.float64())],
                                         names=["weights", "bias"])

    row = sample.coalesce(1).mapInArrow(run, "weights binary, bias double").collect()
    if not row:
        return Model(np.zeros(1 << BUCKET_BITS, dtype=np.float32), 0.0)
    return Model(np.frombuffer(bytes(row[0]["weights"]), dtype=np.float32), row[0]["bias"])


def score(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (probability of label 1) and ``predicted``."""
    shared = df.sparkSession.sparkContext.broadcast((model.table, model.bias))

    def fn(m: Model, texts: pa.Array) -> pa.Array:
        values = [m.score(t) for t in utf8(texts)]
        return structs({"score": (values, pa.float64()), "predicted": ([int(v >= threshold) for v in values], pa.int32())})

    return add_columns(df, row_udf(fn, "score double, predicted int", lambda: Model(*shared.value))(F.col(text_col)),
                       ["score", "predicted"])
