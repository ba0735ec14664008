"""Benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken, 2003).

Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters.  What counts
is a *window*: ``window`` (10) consecutive words of a benchmark item, or the whole item where it
has fewer words.  A document word inside any occurrence of a window is hit.

* Fingerprints: every ``gram`` (5) words are hashed; of the hashes inside a window the smallest
  (the rightmost of equals) is kept.  Two texts that share a window keep the same hash in it, so
  a shared span of ``window`` words or more always shares a fingerprint, while only about two in
  seven hashes are kept.  Items of fewer words form a level of their own length, with windows of
  that length; documents are winnowed once for each level that the benchmark has (ten at most).
* Join: a bitmap of the benchmark's fingerprints (built by ``bitmap_construct_agg``; its size is
  bounded by ``MAX_BITS``, whatever the benchmark's size) lets each task drop most document
  fingerprints at once; those left are joined with the benchmark's fingerprints.  A full bitmap
  only means that more of them reach the join.
* Extension: a hit is widened to all windows of the document that kept this fingerprint, and
  these are joined, as words, with the benchmark's distinct windows.  Pairs exist only for equal
  windows.
* Items: windows that the same items have are one kind, and the documents that hold the same kinds
  are one class.  Items are looked up once per class, so a phrase of many items that many documents
  repeat makes one list of them, not one for each document.  Kinds and classes are known by exclusive
  ors of 128-bit hashes.

Words are cut and hashed by numpy over whole chunks of texts; a long text is worked off in
segments of ``CHUNK`` bytes that overlap by one window less a word, so memory depends on the
longest word, not on the longest text (time is linear in the text).

Defined results: a null or empty text has no words, is not hit, and an item without words has no
windows.  Repeated document rows are judged each on their own; repeated item ids count once, a
null item id as the empty string; a null doc_id stays null.  Without documents there are no
rows; without items nothing is hit.  Other columns are ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from recsmith.llm.common import importable, utf8
from recsmith.session import materialise

WINDOW = 10          # words of a window
GRAM = 5             # words of a fingerprint
CHUNK = 1 << 20      # bytes worked off together
LONG_WORD = 64       # bytes; longer words are hashed one by one
MIN_BITS, MAX_BITS = 1 << 16, 1 << 27  # of the bitmap of fingerprints
BITS_EACH = 64       # bits per benchmark fingerprint, within these bounds
BUCKET = 32768       # bits of one row of bitmap_construct_agg
_SALT = "items"      # of the second half of a hash

# A-Z become a-z; bytes outside words become zero.  Bytes from 0x80 on are parts of non-ASCII characters.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256))
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)  # the first n bytes
_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * j + 1) | 1) & (1 << 64) - 1 for j in range(WINDOW)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(29)
    return x


class Words:
    """The words of several texts: byte places and hashes, and the first word of each text."""

    def __init__(self, folded: list[bytes]):
        self.bytes = b"\0".join(folded) + bytes(8)
        inside = np.frombuffer(self.bytes, np.uint8) != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[::2], edges[1::2]
        text_at = np.cumsum([0, *(len(t) + 1 for t in folded)])
        self.first = np.searchsorted(self.starts, text_at)
        self.count = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(folded)), self.count)

    def hashes(self) -> np.ndarray:
        n = self.ends - self.starts
        eight = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        out = n.astype(np.uint64)
        for at in range(0, LONG_WORD, 8):
            live = np.flatnonzero(n > at)
            if not len(live):
                break
            part = eight[self.starts[live] + at] & _KEEP[np.minimum(n[live] - at, 8)]
            out[live] = _mix(out[live] ^ part)
        for i in np.flatnonzero(n > LONG_WORD).tolist():
            out[i] = xxhash.xxh64_intdigest(self.bytes[self.starts[i]:self.ends[i]])
        return out

    def text(self, i: int, j: int) -> list[str]:
        return [self.bytes[a:b].decode() for a, b in zip(self.starts[i:j].tolist(), self.ends[i:j].tolist())]


def winnow(hashes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every ``gram`` words, smallest of them in every window of ``length`` words)."""
    if len(hashes) < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    n = len(hashes) - gram + 1
    grams = np.zeros(n, np.uint64)
    for j in range(gram):
        grams += hashes[j:j + n] * _ODD[j]
    grams = _mix(grams + np.uint64(length))  # levels have hashes of their own
    m = len(hashes) - length + 1
    least = grams[:m].copy()
    for j in range(1, length - gram + 1):
        np.minimum(least, grams[j:j + m], out=least)
    return grams, least


def _in_bitmap(values: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = (values & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0


def _selected(grams: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """Place of the rightmost smallest of the ``width`` hashes of each window."""
    return windows + width - 1 - np.argmin(grams[windows[:, None] + np.arange(width)[::-1]], axis=1)


class Winnower:
    """Fingerprints of many texts: ``rows`` gets (row, fingerprint, length, start, words), one for
    each fingerprint kept, with the words of all windows that kept it."""

    def __init__(self, levels: list[int], window: int, gram: int, bitmap: np.ndarray | None):
        self.levels, self.window, self.gram, self.bitmap = levels, window, gram, bitmap
        self.rows: list[tuple] = []

    def texts(self, keys: list[int], texts: list[bytes]) -> list[int]:
        """Word counts of ``texts``; their fingerprints go to ``rows``."""
        counts, held, size = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            if len(text) > CHUNK:
                counts[i] = self._long(keys[i], text)
                continue
            held.append(i)
            size += len(text)
            if size >= CHUNK or i == len(texts) - 1:
                self._held(keys, texts, held, counts)
                held, size = [], 0
        self._held(keys, texts, held, counts)
        return counts

    def _held(self, keys, texts, held, counts) -> None:
        if held:
            words = Words([texts[i].translate(FOLD) for i in held])
            self._windows(words, [keys[i] for i in held])
            for i, n in zip(held, words.count.tolist()):
                counts[i] = n

    def _long(self, key: int, text: bytes) -> int:
        folded = text.translate(FOLD)
        inside = np.frombuffer(folded, np.uint8) != 0
        total = int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[0])
        at = end = seen = carried = 0
        while end < len(folded):
            end = folded.find(b"\0", end + CHUNK)
            end = len(folded) if end < 0 else end
            words = Words([folded[at:end]])
            n = len(words.starts)
            self._windows(words, [key], seen - carried, carried, total)
            seen += n - carried
            carried = min(n, self.window - 1)
            at = at + int(words.starts[n - carried]) if carried else end
        return total

    def _windows(self, words: Words, keys: list[int], base: int = 0, carried: int = 0,
                 total: int | None = None) -> None:
        """``base``: words of the text before these; no window within the first ``carried`` words
        is new.  Without a bitmap (items), a text (of ``total`` words) has windows of its own level only."""
        hashes = words.hashes()
        for length in self.levels:
            gram = min(self.gram, length)
            grams, least = winnow(hashes, length, gram)
            found = words.text_of[:len(least)] == words.text_of[length - 1:] if len(least) else np.empty(0, bool)
            if self.bitmap is None:
                n = words.count if total is None else np.array([total])
                found &= (np.minimum(n, self.window) == length)[words.text_of[:len(least)]]
            else:
                found &= _in_bitmap(least, self.bitmap)
            at = np.flatnonzero(found)
            at = at[at + length - 1 >= carried]
            if not len(at):
                continue
            place = _selected(grams, at, length - gram + 1)
            run = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))  # windows that kept the same one
            last = at[np.append(run[1:], len(at)) - 1]
            value = least[at[run]].view(np.int64)
            for s, e, v in zip(at[run].tolist(), last.tolist(), value.tolist()):
                text = int(words.text_of[s])
                self.rows.append((keys[text], v, length, base + s - int(words.first[text]), words.text(s, e + length)))


def _winnow_partition(levels, window, gram, bitmap, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        kind = schema.field("id").type

        def table(ids, rows):
            cols = [[r[0] for r in rows], ids, *([r[i] for r in rows] for i in range(1, len(schema) - 1))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            keys = list(range(key, key + len(texts)))
            key += len(texts)
            worker = Winnower(levels, window, gram, bits)
            counts = worker.texts(keys, texts)
            yield table(ids.cast(kind), [(k, None, None, None, None, n) for k, n in zip(keys, counts)])
            for i in range(0, len(worker.rows), 20_000):
                rows = [(*r, None) for r in worker.rows[i:i + 20_000]]
                of = pa.array([r[0] - keys[0] for r in rows])
                yield table(ids.take(of).cast(kind), rows)

    return run


def fingerprints(df: DataFrame, id_col: str, text_col: str, levels: list[int], window: int = WINDOW, gram: int = GRAM,
                 bitmap: bytes | None = None) -> DataFrame:
    """Two kinds of rows (row, id, fp, length, start, words, n_words): one per text, with its
    ``n_words``, and one per fingerprint kept, with the words of the windows that kept it.  With
    ``bitmap`` only fingerprints that may be in it; without, the windows of each text's own level."""
    importable(df.sparkSession)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType
    schema = pa.schema([("row", pa.int64()), ("id", to_arrow_type(kind)), ("fp", pa.int64()), ("length", pa.int32()),
                        ("start", pa.int64()), ("words", pa.list_(pa.string())), ("n_words", pa.int64())])
    return texts.mapInArrow(_winnow_partition(levels, window, gram, bitmap, schema),
                            f"row long, id {kind.simpleString()}, fp long, length int, start long, words array<string>, "
                            "n_words long")


def bitmap_of(fps: DataFrame, n: int) -> bytes:
    """Bitmap of the low bits of ``fp``, of ``MIN_BITS`` to ``MAX_BITS`` bits."""
    bits = MIN_BITS
    while bits < MAX_BITS and bits < BITS_EACH * n:
        bits *= 2
    value = F.col("fp").bitwiseAND(F.lit(bits - 1)) + 1
    rows = (fps.select(F.bitmap_bucket_number(value).alias("b"), F.bitmap_bit_position(value).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect())  # bits / BUCKET rows at most
    out = bytearray(bits // 8)
    for r in rows:
        out[(r["b"] - 1) * BUCKET // 8:r["b"] * BUCKET // 8] = r["m"]
    return bytes(out)


def _windows(fps: DataFrame) -> DataFrame:
    """The windows (words joined by spaces) of each fingerprint row, with their places."""
    each: Column = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("length")),
                               lambda i: F.array_join(F.slice("words", i + 1, F.col("length")), " "))
    return (fps.select("*", F.posexplode(each).alias("_i", "span"))
            .select("row", "id", "length", (F.col("start") + F.col("_i")).alias("start"), "span"))


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: row, id, n_words; occurrences: row, start, length, span; spans: span, item).

    An occurrence is one place of a window in a document row; ``spans`` tells which items have
    that window."""
    named = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         F.col(item_text_col).alias("item_text"))
    levels = list(range(1, window + 1))
    test = materialise(fingerprints(named, "item", "item_text", levels, window, gram).filter("fp is not null"))
    used = [r["length"] for r in test.groupBy("length").count().collect()]  # at most ``window`` rows
    bitmap = bitmap_of(test, test.count())
    train = materialise(fingerprints(docs, id_col, text_col, used, window, gram, bitmap))
    hits = train.filter("fp is not null").join(test.select("fp", "length").distinct(), ["fp", "length"], "left_semi")
    spans = materialise(_windows(test).select("span", F.col("id").alias("item")).distinct())
    places = _windows(hits).join(spans.select("span").distinct(), "span", "left_semi")
    return train.filter("fp is null").select("row", "id", "n_words"), places.select("row", "start", "length", "span"), spans


def _set_hash(*members: str) -> list[Column]:
    """Aggregates ``a`` and ``b``: the 128-bit hash of a group's distinct rows of ``members``."""
    return [F.bit_xor(F.xxhash64(*members)).alias("a"), F.bit_xor(F.xxhash64(F.lit(_SALT), *members)).alias("b")]


def items_by_class(places: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents: row, a, b; classes: a, b, n_items, items): the class of each document row that has
    occurrences, and the items of a class, sorted as strings, comma-joined."""
    kind_of = materialise(spans.groupBy("span").agg(*_set_hash("item")).select("span", F.struct("a", "b").alias("kind")))
    one = kind_of.groupBy("kind").agg(F.min("span").alias("span"))  # any window of a kind has its items
    held = materialise(places.select("row", "span").distinct().join(kind_of, "span").select("row", "kind").distinct())
    of = materialise(held.groupBy("row").agg(*_set_hash("kind")))
    kinds = of.groupBy("a", "b").agg(F.min("row").alias("row")).join(held, "row").select("a", "b", "kind")
    items = kinds.join(one, "kind").join(spans, "span").select("a", "b", "item").distinct()
    lists = items.groupBy("a", "b").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    return of, lists.select("a", "b", "n_items", F.array_join("items", ",").alias("items"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """Per document row: id, n_words, n_hit (words inside occurrences), n_items and items_sha256
    (ids of the items with occurring windows, sorted as strings, comma-joined), contaminated."""
    rows, places, spans = occurrences(docs, items, id_col, text_col, item_col, item_text_col, window, gram)
    places = materialise(places)
    w = Window.partitionBy("row").orderBy("start", "end")
    end = F.col("start") + F.col("length")
    before = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (places.select("row", "start", end.alias("end")).distinct()
               .withColumn("n", F.greatest(F.col("end") - F.greatest("start", before), F.lit(0)))
               .groupBy("row").agg(F.sum("n").alias("n_hit")))
    of, lists = items_by_class(places, spans)
    hashed = lists.select("a", "b", "n_items", F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"))
    named = of.join(hashed, ["a", "b"]).select("row", "n_items", "items_sha256")
    out = rows.join(covered, "row", "left").join(named, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))
