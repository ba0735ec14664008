import re

import numpy as np
import xxhash

from recsmith.llm import queries, simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, max_bits=2):
    """Smallest index reachable over pairs within ``max_bits`` bits."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(values))]


def test_query_equals_brute_force(spark, sf, texts):
    rows = queries.QUERIES["op1_simhash_dedup"](spark, sf).collect()
    ids = sorted(texts)
    want = [brute_fingerprint(texts[i]) for i in ids]
    comp = brute_components(want)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == \
        [(i, f"{v:016x}", ids[c]) for i, v, c in zip(ids, want, comp)]


def clustered(n, rng):
    """Values in chains: each differs from an earlier one in one to three bits, or is new."""
    out = [int(rng.integers(0, 1 << 63))]
    while len(out) < n:
        v = out[rng.integers(max(0, len(out) - 5), len(out))]
        if rng.random() < 0.2:
            v = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for b in rng.choice(64, rng.integers(1, 4), replace=False):
            v ^= 1 << int(b)
        if v not in out:
            out.append(v)
    return out


def check_components(spark, values, node_limit):
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), node_limit=node_limit).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    got = simhash.forest(len(values), np.array([at[r["u"]] for r in links], dtype=int),
                         np.array([at[r["v"]] for r in links], dtype=int))
    assert got.tolist() == brute_components(values)


def test_trie_join_finds_all_links(spark):
    check_components(spark, clustered(400, np.random.default_rng(1)), 1024)


def test_hot_nodes_are_walked_further(spark):
    rng = np.random.default_rng(2)
    center = 0x0123456789ABCDEF
    near = {center ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (300, 3))}
    check_components(spark, sorted(near) + clustered(50, rng), 8)


def test_large_pairs_with_one_empty_side(spark):
    """Leaves crowded below one node: most of its neighbour nodes are empty, and links across a
    step's border are found all the same."""
    rng = np.random.default_rng(4)
    crowd = {0xABCDE << 44 | int(x) for x in rng.integers(0, 1 << 12, 250)}
    across = {v ^ 1 << 42 for v in list(crowd)[:5]} | {v ^ 3 << 30 for v in list(crowd)[5:9]} | {v ^ 7 << 30 for v in list(crowd)[9:12]}
    check_components(spark, sorted(crowd | across), 16)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by[1] == by[2] and {c for _, c in by[1]} == {1}
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 3, 6, 7, 8]
    assert simhash.one_per_group(no_docs).count() == 0
