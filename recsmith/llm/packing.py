"""Hierarchical multi-length packing of documents into training sequences.

Each document becomes its token ids and one end id.  Whole windows of the longest tier are cut
off; the rest of a document is routed to the shortest tier (context size) that holds it.  The
tiers are packed from long to short: a piece opens a window of its tier, the gap is filled with
the longest fitting pieces of shorter tiers, and the last bit of it with the head of one more
piece.  Where the shorter pieces cannot fill the gap, the piece itself is cut to the next
shorter context size.  So every window is exactly full; only the tail of a task can end in
padding.  Sequences are dealt into step groups of ``STEP_TOKENS`` tokens each: of equal length as
long as a tier fills a group, and the rest of a task, long ones first, in mixed groups.  So all
groups are equal, but for one short group that a task may end with.

Token ids come from a byte-level encoder that cuts texts by the file's pattern.  Its matcher has a
bounded stack, which a run of a million white-space characters exceeds; such a run (all of it
at the end of a text, all but the last character otherwise) is one pre-token by the pattern, so
texts are cut around runs of ``LONG_RUN`` characters or more and a run is merged as a whole.

Packing is a map over the input partitions, without a shuffle: a task holds ``HELD_TOKENS``
tokens at most (and one document), packs them, and carries what is left over to the next ones.
Sequence ids hold the partition number, so a task that is run again gives the same ids.

Defined results: a null or empty text is its end id alone; repeated rows are packed each on
their own; a null doc_id stays null; an empty table gives no rows; other columns are ignored.  A
very long text is encoded in time linear in its length but for its longest pre-token.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.llm.bpe_count import PATTERN, byte_alphabet
from recsmith.llm.common import importable, strings

TIERS = (2048, 1024, 512, 256)
END_ID = 1
STEP_TOKENS = 16 * 2048
HELD_TOKENS = 1 << 22
LAST_TIER = 32  # a task's tail is cut to powers of two down to this
LONG_RUN = 100_000  # white-space characters of a run that is cut out of its text

# Fixed value: the characters with the Unicode property White_Space.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_RUN = re.compile(f"(?<!{_SPACE}){_SPACE}{{{LONG_RUN},}}")


class Encoder:
    """The byte-level BPE of a ``tokenizers`` JSON file: same ids, encoded one text at a time
    (tests compare it with the ``tokenizers`` library, special strings included)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bytes_of = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(bytes_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        make = lambda pattern: tiktoken.Encoding(f"json:{path}", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.texts, self.whole = make(PATTERN), make(r"[\s\S]+")  # by pre-tokens; as one pre-token
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def _parts(self, text: str) -> Iterator[np.ndarray]:
        for part in self.special.split(text) if self.special else [text]:
            at = 0
            for run in _RUN.finditer(part):
                start, end = run.start(), run.end() - (run.end() < len(part))  # the last character starts the next pre-token
                yield self.texts.encode_to_numpy(part[at:start], allowed_special="all")
                yield self.whole.encode_to_numpy(part[start:end], allowed_special="all")
                at = end
            yield self.texts.encode_to_numpy(part[at:], allowed_special="all")

    def ids(self, text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and _RUN.search(text):
            return np.concatenate(list(self._parts(text)))
        return self.texts.encode_to_numpy(text, allowed_special="all")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    return Encoder(path)


def token_ids(enc: Encoder, text: str, end_id: int = END_ID) -> np.ndarray:
    return np.append(enc.ids(text), np.uint32(end_id)).astype("<u4")


class Pool:
    """Pieces (document, start, length) by length."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.lengths: list[int] = []  # sorted, those with pieces
        self.total = 0

    def add(self, doc, start: int, length: int) -> None:
        if length not in self.by_length:
            bisect.insort(self.lengths, length)
            self.by_length[length] = []
        self.by_length[length].append((doc, start))
        self.total += length

    def take(self, length: int) -> tuple:
        held = self.by_length[length]
        doc, start = held.pop()
        if not held:
            del self.by_length[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))
        self.total -= length
        return doc, start, length

    def longest(self, limit: int) -> int:
        """The longest length up to ``limit``; 0 if there is none."""
        at = bisect.bisect_right(self.lengths, limit)
        return self.lengths[at - 1] if at else 0

    def total_up_to(self, limit: int) -> int:
        return sum(n * len(self.by_length[n]) for n in self.lengths[:bisect.bisect_right(self.lengths, limit)])


class Packer:
    """Packs pieces into full windows; ``emit(tier, pieces)`` takes each finished window."""

    def __init__(self, emit, tiers: tuple[int, ...] = TIERS):
        self.emit, self.tiers, self.pool = emit, tuple(sorted(tiers, reverse=True)), Pool()

    def add(self, doc, n: int) -> None:
        top = self.tiers[0]
        for start in range(0, n - n % top, top):
            self.emit(top, [(doc, start, top)])
        if n % top:
            self.pool.add(doc, n - n % top, n % top)

    def _fill(self, window: list, gap: int, most: int) -> None:
        """Fill ``gap`` with pieces of up to ``most`` tokens, cutting the last one."""
        while gap:
            n = self.pool.longest(min(gap, most))
            if not n:
                whole = self.pool.lengths[bisect.bisect_right(self.pool.lengths, gap)]
                doc, start, n = self.pool.take(whole)
                window.append((doc, start, gap))
                self.pool.add(doc, start + gap, n - gap)
                return
            window.append(self.pool.take(n))
            gap -= n

    def pack(self) -> None:
        """Pack the pool down to pieces of the shortest tier, then those into the longest
        windows; less than one such window stays in the pool."""
        pool = self.pool
        for tier, shorter in zip(self.tiers, self.tiers[1:]):
            spare = pool.total_up_to(shorter)
            while (n := pool.longest(tier)) > shorter:
                piece = pool.take(n)
                if spare >= tier - n:
                    window = [piece]
                    self._fill(window, tier - n, shorter)
                    spare -= tier - n
                    self.emit(tier, window)
                else:  # too little to fill the gap: cut the piece itself
                    doc, start, _ = piece
                    self.emit(shorter, [(doc, start, shorter)])
                    pool.add(doc, start + shorter, n - shorter)
                    spare += n - shorter
        while pool.total >= self.tiers[0]:
            window = []
            self._fill(window, self.tiers[0], self.tiers[-1])
            self.emit(self.tiers[0], window)

    def finish(self, last: int = LAST_TIER) -> None:
        """Empty the pool: windows of falling powers of two, the last one padded."""
        self.pack()
        size = self.tiers[0]
        while self.pool.total:
            while size > last and size > self.pool.total:
                size //= 2
            window: list = []
            self._fill(window, min(size, self.pool.total), self.tiers[0])
            self.emit(self.tiers[0] if sum(p[2] for p in window) < last else size, window)


def _pack_partition(path: str, tiers: tuple[int, ...], held_tokens: int, step_tokens: int, keep_ids: bool,
                    schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 40
        enc = encoder(path)
        rows: list[tuple] = []
        made = steps = 0
        open_groups: dict[int, list] = {}  # by tier: the sequences of a group that is not full yet

        def close(group: list) -> None:
            nonlocal steps
            rows.extend((*r[:8], part + steps, *r[8:]) for _, pieces in group for r in pieces)
            steps += 1
            group.clear()

        def emit(tier: int, window: list) -> None:
            nonlocal made
            pieces, at = [], 0
            for (doc_id, ids), start, n in window:
                own = ids[start:start + n]
                pieces.append((doc_id, start, n, zlib.crc32(own.tobytes()), len(ids), part + made, at, tier,
                               *([own.astype(np.int32)] if keep_ids else [])))
                at += n
            made += 1
            group = open_groups.setdefault(tier, [])
            group.append((tier, pieces))
            if len(group) * tier >= step_tokens:
                close(group)

        def close_all() -> None:
            rest, size = [], 0
            for tier in sorted(open_groups, reverse=True):  # powers of two, long ones first: groups fill up exactly
                for sequence in open_groups[tier]:
                    rest.append(sequence)
                    size += tier
                    if size >= step_tokens:
                        close(rest)
                        size = 0
            if rest:
                close(rest)

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * len(schema)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        packer = Packer(emit, tiers)
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                ids = token_ids(enc, text)
                packer.add((doc_id, ids), len(ids))
                held += len(ids)
                if held >= held_tokens:
                    packer.pack()
                    held = 0
                if len(rows) >= 20_000:
                    yield out()
        packer.finish()
        close_all()
        yield out()

    return run


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS,
         held_tokens: int = HELD_TOKENS, step_tokens: int = STEP_TOKENS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: its document, start, length and place in a sequence, the sequence's
    context size (``tier``) and step group; with ``keep_ids`` also the piece's token ids."""
    importable(df.sparkSession)
    docs = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = docs.schema[0].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    schema = pa.schema([(id_col, to_arrow_type(kind)), *((n, pa.int64()) for n in longs),
                        *([("ids", pa.list_(pa.int32()))] if keep_ids else [])])
    ddl = f"`{id_col}` {kind.simpleString()}, " + ", ".join(f"{n} long" for n in longs) + (", ids array<int>" if keep_ids else "")
    return docs.mapInArrow(_pack_partition(path, tiers, held_tokens, step_tokens, keep_ids, schema), ddl)
