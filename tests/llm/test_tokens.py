import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recsmith.llm import bpe_count, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab cdé\n\t  '  1２٣🙂\u0085\xa0ßé漢字\x1c\x00’s'll"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(3)
    out = ["".join(rng.choice([*ALPHABET, "<|endoftext|>"]) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return out + ["", "a" * 5000, "ab" * 3000, " " * 1000, "x <|endoftext|>  <|endoftext|>y", "<|endoftext"]


def test_counts_equal_the_library(tokenizer, texts):
    counter = bpe_count.MergeCounter(PATH, kept=50)
    rows = odd_texts() + list(texts.values())
    want = [len(e.ids) for e in tokenizer.encode_batch(rows, add_special_tokens=False)]
    assert [counter.count(t) for t in rows] == want


def test_count_query(spark, sf, texts, tokenizer):
    rows = queries.QUERIES["op3_token_counts"](spark, sf).collect()
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == \
        {i: (len(texts[i].encode()), n, n > 1024) for i, n in want.items()}


def test_count_odd_rows(odd_docs, no_docs):
    rows = bpe_count.token_counts(odd_docs, PATH).collect()
    assert [(r["n_bytes"], r["n_tokens"]) for r in rows if not r["text"]] == [(0, 0)] * 3
    assert len(rows) == odd_docs.count()
    assert bpe_count.token_counts(no_docs, PATH).count() == 0


def test_encoder_equals_the_library(tokenizer):
    enc = packing.encoder(PATH)
    rows = odd_texts()
    for t, e in zip(rows, tokenizer.encode_batch(rows, add_special_tokens=False)):
        assert packing.token_ids(enc, t).tolist() == e.ids + [1]


@pytest.mark.parametrize("run", [" " * 5_000_000, "\n" * 5_000_000, "\t" * 5_000_000, " \n\t\u3000\r" * 1_000_000])
def test_long_runs_of_white_space(tokenizer, run):
    """Runs that a backtracking matcher cannot take: at the end, before a word, before a special string."""
    enc = packing.encoder(PATH)
    for text in ("word" + run, run[:1_200_000] + "x y", "a " + run[:300_000] + "<|endoftext|>" + run[:1_100_001] + "'s"):
        want = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        got = packing.token_ids(enc, text)
        assert len(got) == len(want) and (got == np.array(want)).all()


def test_runs_of_any_length_are_cut_alike(tokenizer, monkeypatch):
    import re
    monkeypatch.setattr(packing, "LONG_RUN", 1)
    monkeypatch.setattr(packing, "_RUN", re.compile(f"(?<!{packing._SPACE}){packing._SPACE}{{3,}}"))
    enc = packing.encoder(PATH)
    rows = odd_texts() + [" \n" * 7, "a   b", "a \n  ", "\x1c\x1c\x1c \x85\x85\x85x", "   <|endoftext|>   's"]
    for t, e in zip(rows, tokenizer.encode_batch(rows, add_special_tokens=False)):
        assert packing.token_ids(enc, t).tolist() == e.ids + [1]


def test_step_groups_are_equal(spark, docs):
    """Every step group holds the same number of tokens, but for one group of each task."""
    rows = packing.pack(docs.repartition(3), PATH, step_tokens=8192).collect()
    size, task = {}, {}
    for r in {(r["sequence_id"], r["step_group"], r["tier"]) for r in rows}:
        size[r[1]] = size.get(r[1], 0) + r[2]
    for group, n in size.items():
        task.setdefault(group >> 40, []).append(n)
    assert len(task) == 3 and all(sum(n != 8192 for n in sizes) <= 1 and max(sizes) == 8192 for sizes in task.values())


def check_pieces(rows, want):
    """``want``: the ids of each document key; rows are its pieces."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            ids = want[key][at:at + p["length"]]
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(want[key])
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
            at += p["length"]
        assert at == len(want[key])
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_packing_query_is_an_exact_round_trip(spark, sf, texts, tokenizer):
    rows = queries.QUERIES["op6_packing"](spark, sf).collect()
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    assert {r["doc_id"] for r in rows} == set(want)
    assert check_pieces(rows, want) < 0.02
    full = {}
    for r in rows:
        full[r["step_group"]] = full.get(r["step_group"], 0) + r["length"]
    assert max(full.values()) <= packing.STEP_TOKENS


@pytest.mark.parametrize("lengths", [[], [1], [2048], [2049, 5], [300] * 200, [1] * 5000, [1500, 700, 700, 100] * 50,
                                     [1025] * 40])
def test_packer_fills_every_window(lengths):
    windows = []
    packer = packing.Packer(lambda tier, pieces: windows.append((tier, pieces)))
    for i, n in enumerate(lengths):
        packer.add(i, n)
    packer.finish()
    seen = {}
    for tier, pieces in windows:
        assert sum(n for _, _, n in pieces) <= tier
        for doc, start, n in pieces:
            seen.setdefault(doc, []).append((start, n))
    assert {d: sum(n for _, n in p) for d, p in seen.items()} == dict(enumerate(lengths))
    for pieces in seen.values():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
    assert sum(sum(n for _, _, n in p) != t for t, p in windows) <= 1


def test_packing_odd_rows_and_ids(odd_docs, no_docs):
    rows = packing.pack(odd_docs, PATH, keep_ids=True).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 1
    assert all(zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert any(r["doc_id"] is None for r in rows)
    assert packing.pack(no_docs, PATH).count() == 0
