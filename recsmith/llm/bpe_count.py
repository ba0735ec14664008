"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pre-tokens, and the bytes of each pre-token into a linked list of symbols.  A
heap holds the adjacent pairs that have a merge rank; the lowest rank (leftmost first) is popped
and merged, its new neighbours are pushed, and stale entries are skipped.  The count is the
number of initial symbols minus the number of merges: token ids are never formed.

The merge table is read from a ``tokenizers`` JSON file of a byte-level BPE (its path is a
parameter).  As in that library, an added token's string inside a text counts as one token and
cuts the text.  Counts of short pre-tokens are kept in a bounded table per Python worker.

Defined results: a null or empty text has no bytes and no tokens; repeated rows are counted
each on their own; an empty table gives no rows; an input column named like an output column is
replaced.  A very long text takes time linear in its length, times the logarithm of its longest
pre-token.
"""

from __future__ import annotations

import functools
import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.llm.common import add_columns, row_udf, strings, structs

LIMIT = 1024            # tokens of the over_limit flag
KEPT_COUNTS = 400_000   # pre-tokens whose counts a worker keeps
KEPT_LENGTH = 48        # characters of the longest pre-token kept

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class MergeCounter:
    """Counts the tokens of texts under the merges of one byte-level BPE file."""

    def __init__(self, path: str, kept: int = KEPT_COUNTS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bytes_of = byte_alphabet()
        model = spec["model"]
        # a symbol is known by the bytes it covers: numbered as they first occur
        number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (bytes(bytes_of[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            new = number.setdefault(left + right, len(number))
            self.merges.setdefault((number[left], number[right]), (rank, new))
        self.find = regex.compile(PATTERN).findall
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.kept = kept
        self.counts: dict[str, int] = {}

    def pre_token(self, word: bytes) -> int:
        """Initial symbols minus merges of one pre-token."""
        n = len(word)
        if n < 2:
            return n
        merges = self.merges
        symbols = list(word)
        after = list(range(1, n + 1))  # linked list; n is the end
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        count = n
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = merges.get((symbols[i], symbols[j]))
            if found is None or found[0] != rank:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            count -= 1
            if k < n:
                before[k] = i
                found = merges.get((new, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], new))
                if found:
                    heapq.heappush(heap, (found[0], h, found[1]))
        return count

    def _plain(self, text: str) -> int:
        words = self.find(text)
        counts = self.counts
        try:
            return sum([counts[w] for w in words])
        except KeyError:
            pass
        total = 0
        for w in words:
            n = counts.get(w)
            if n is None:
                n = self.pre_token(w.encode())
                if len(w) <= KEPT_LENGTH:
                    if len(counts) >= self.kept:
                        counts.clear()
                    counts[w] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        parts = self.added.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


@functools.lru_cache(maxsize=2)
def merge_counter(path: str) -> MergeCounter:
    """One counter per file and Python worker."""
    return MergeCounter(path)


def _count(state, texts: pa.Array, *, limit: int) -> pa.Array:
    counter: MergeCounter = state
    rows = strings(texts)
    n = [counter.count(t) for t in rows]
    return structs({"n_bytes": ([len(t.encode()) for t in rows], pa.int64()), "n_tokens": (n, pa.int64()),
                    "over_limit": ([x > limit for x in n], pa.bool_())})


def token_counts(df: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``df`` with n_bytes, n_tokens and over_limit of every whole text."""
    fn = row_udf(lambda state, texts: _count(state, texts, limit=limit),
                 "n_bytes long, n_tokens long, over_limit boolean", lambda: merge_counter(path))
    return add_columns(df, fn(F.col(text_col)), ["n_bytes", "n_tokens", "over_limit"])
