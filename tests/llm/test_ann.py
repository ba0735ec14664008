import numpy as np
import pytest

from recsmith.llm import ann, queries


def brute(ids, vectors, k=20, every=20):
    x = np.array(vectors, dtype=float)
    ids = np.array(ids)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hit = total = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(want[q]) + 1))
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hit += len({f[1] for f in found} & {w[0] for w in want[q]})
        total += len(want[q])
    return hit / total


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_query_recall(spark, folder):
    sf = f"/root/testdata/{folder}"
    data = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = brute([r[0] for r in data], [r[1] for r in data])
    rows = queries.QUERIES["op2_nearest_neighbours"](spark, sf).collect()
    assert recall(rows, want) >= 0.95
    scores = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(abs(scores.get((r["query_id"], r["vec_id"]), r["score"]) - r["score"]) < 1e-12 for r in rows)


def test_many_cells_vectors_of_any_length_and_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 6)) * rng.uniform(0.2, 3, (600, 1))
    x[100:400] = x[7]  # a large group of copies, queries among them
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    rows = ann.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), stop=0.9999, cell_rows=32).collect()
    want = brute(range(600), x)
    assert recall(rows, want) >= 0.99
    copies = [r for r in rows if r["query_id"] == 120]
    assert [r["vec_id"] for r in sorted(copies, key=lambda r: r["rank"])] == [w[0] for w in want[120]]


def test_cells_and_blocks_of_queries_and_points(spark):
    """64 cells, larger ones in several blocks of points, and several blocks of queries for each."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(900, 8)), rng.normal(size=(300, 8)) * 0.02 + 1])  # one crowded cell
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, every=4, stop=0.9999, cell_rows=9, max_cells=64, query_block=100, projected=8).collect()
    assert recall(rows, brute(range(1200), x, every=4)) >= 0.99
    assert len({r["query_id"] for r in rows}) == 300


def test_search_stops_by_the_test(spark):
    """Unit vectors near a plane: most points are never scored, and the nearest ones are found."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3)) @ rng.normal(size=(3, 40)) + 0.01 * rng.normal(size=(3000, 40))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, cell_rows=100).collect()
    assert recall(rows, brute(range(3000), x)) >= 0.9
    assert np.mean([r["n_verified"] for r in rows]) < 0.35 * 3000


def test_share_of_verified_points(spark):
    rows = queries.QUERIES["op2_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect()
    assert np.mean([r["n_verified"] for r in rows]) < 0.7 * 2000


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-1, 2, size=(400, 6)).astype(float)
    x[(x == 0).all(axis=1)] = 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(range(400), x)
    rows = ann.nearest(df, stop=0.999999, cell_rows=50).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == want


def test_odd_rows(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
            (5, [None, 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (20, [0.0, 2.0]),
            (9, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<double>, score string, rank int")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(df).collect()}
    assert got == {(0, 1): (1, 0.5), (0, 2): (9, 0.5), (0, 3): (20, 0.0),
                   (20, 1): (1, 1.0), (20, 2): (9, 1.0), (20, 3): (0, 0.0)}
    assert ann.nearest(df.limit(0)).count() == 0


def test_chi_square_quantile():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert ann.chi_square_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-4)


def test_cells_cover_the_space():
    points = np.random.default_rng(1).normal(size=(500, 3))
    tree = ann.KdCells(points, 16)
    cell = tree.cell(points)
    dist = tree.distance(points)
    assert (dist[np.arange(500), cell] == 0).all() and len(set(cell.tolist())) == 16
    for q in range(0, 500, 50):
        for c in range(16):
            inside = points[cell == c]
            assert ((inside - points[q]) ** 2).sum(axis=1).min() >= dist[q, c] - 1e-12
