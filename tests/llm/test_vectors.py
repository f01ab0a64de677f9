import numpy as np
import pytest
from reverbkit.llm import neighbours, vectors


@pytest.fixture(scope="module")
def table(spark):
    """Random vectors with near copies, exact copies, scaled ones and odd rows."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 16))
    x[50:90] = x[:40] + 0.05 * rng.standard_normal((40, 16))
    x[90:120] = x[0] + 0.08 * rng.standard_normal((30, 16))
    x[120:125], x[125] = x[7], 3 * x[8]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] + [1.0] * 15, 1), (304, [], 1), (305, [1.0, 2.0], 1), (306, [float("inf")] * 16, 1), (320, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS n", "2 AS node", "3 AS cell", "4 AS size", "5 AS row")
    return x, odd, df


@pytest.mark.parametrize("block", [vectors.BLOCK, 7])
def test_near_vectors_brute_force(table, monkeypatch, block):
    x, odd, df = table
    monkeypatch.setattr(vectors, "BLOCK", block)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([label[row].min() for row in near])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()}
    want = {i: (int(near[i].sum()) - 1, int(label[i]), bool(label[i] == i)) for i in range(len(x))}
    want |= {i: (0, i, True) for i, *_ in odd} | {305: (1, 305, True), 320: (1, 305, False)}
    assert got == want


def test_neighbours_recall_and_order(table):
    x, _, df = table
    got = {}
    for r in neighbours.nearest(df, df["vec_id"] % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    found = 0
    for q in range(0, 300, 20):
        score = x @ x[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        found += len({i for i, _ in got[q]} & set(order))
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        assert all(abs(s - score[i]) < 1e-9 for i, s in got[q])
    assert found >= 0.9 * 300
    assert got.pop(320) == [(305, 10.0)] and sorted(got) == list(range(0, 300, 20))


def test_chi_square():
    assert abs(neighbours.chi2_cdf(15.507, 8) - 0.95) < 1e-4 and neighbours.chi2_cdf(0.0) == 0


def test_odd_vectors(spark, table):
    df = table[2]
    assert vectors.near_vectors(df.limit(0)).count() == 0 == neighbours.nearest(df.limit(0), df["vec_id"] == 0).count()
    only = df.where("vec_id in (300, 301, 302)")
    assert {tuple(r) for r in vectors.near_vectors(only).collect()} == {(i, 0, i, True) for i in (300, 301, 302)}
    twice = df.where("vec_id = 5").unionByName(df.where("vec_id = 5"))
    assert [tuple(r) for r in vectors.near_vectors(twice).collect()] == [(5, 1, 5, True)] * 2


def test_neighbours_cells_ruled_out(spark, monkeypatch):
    """Clusters: most cells are ruled out, and what is nearest is found."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((32, 24))
    x = centres[rng.integers(0, 32, 2000)] + 0.05 * rng.standard_normal((2000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    met = []
    plain = neighbours.block_groups

    def counted(left, right, *rest):
        met.append((left.select("key").distinct().count(), right.count()))
        return plain(left, right, *rest)

    monkeypatch.setattr(neighbours, "CELL", 64)
    monkeypatch.setattr(neighbours, "block_groups", counted)
    got = {}
    for r in neighbours.nearest(df, df["vec_id"] % 20 == 0, k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    found = 0
    for q in range(0, 2000, 20):
        score = x @ x[q]
        score[q] = -2
        found += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert found >= 0.95 * 2000
    cells = met[0][0]
    assert cells == 32 and sum(n for _, n in met) < 0.3 * 100 * cells


def test_neighbours_equal_vectors(spark, monkeypatch):
    """A third of all rows are one vector: ties go to the smaller ids, whatever the cells and blocks."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 8))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "CELL", 100)
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "CONFIDENCE", 0.9999)
    got = {}
    for r in neighbours.nearest(df, df["vec_id"] == 300, k=20).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    score = np.einsum("ij,j->i", x, x[300])
    want = [int(i) for i in np.lexsort((np.arange(600), -score)) if i != 300][:20]
    assert [i for i, _ in got[300]] == want
