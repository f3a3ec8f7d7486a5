import numpy as np
import pytest

from tidemark.llm.nearest import Tree, chi_square, directions, radius, search, searched


def exact(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    good = [(i, np.array(v)) for i, v in sorted({(i, tuple(x)) for i, x in good})]  # rows that repeat id and vector count once
    out, done = {}, set()
    for q, x in good:
        if q % every == 0 and q not in done:
            done.add(q)
            near = sorted((-float(x @ y), i) for i, y in good if i != q and len(y) == len(x))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((12, 24))
    rows = [(k, (centers[k % 12] + 0.5 * rng.standard_normal(24)).astype(np.float32).tolist()) for k in range(1500)]
    rows += [(2000 + k, rows[40][1]) for k in range(60)]
    return rows + [(3000, None), (3020, [0.0] * 24), (3040, [float("nan")] * 24), (3060, [None] + [1.0] * 23), (3080, [float("inf")] * 24), (None, [1.0] * 24), (4000, [1.0, 2.0]), (4001, [3.0, 1.0]), (4020, []), (5, rows[5][1])]


def test_recall_and_scores(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block", "2 AS rank")
    want = exact(rows, 20, 20)
    got = {}
    for r in search(df, leaf_rows=100, query_rows=33).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    vectors = {i: np.array(v, float) for i, v in rows if v and i is not None}
    hits = total = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i]), rel=1e-12) and i != q for _, i, s in found)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        worst = want[q][-1][1]
        hits, total = hits + sum(s >= worst - 1e-9 for _, _, s in found), total + len(found)
    assert hits / total >= 0.9
    assert got[4000] == [(1, 4001, 5.0)]


def test_sure_search_is_exact(spark, rows):
    want = exact(rows, 20, 20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in search(df, sure=1.1).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.score)
    assert all(np.allclose(got[q], [s for _, s in want[q]]) for q in want)


def test_few_vectors_are_verified(spark):
    rng = np.random.default_rng(5)
    centers = 3 * rng.standard_normal((40, 64))
    rows = [(k, (centers[k % 40] + rng.standard_normal(64)).tolist()) for k in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, share = searched(df, leaf_rows=150)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    v = np.array([x for _, x in rows])
    hits = sum(len(found[q] & set(np.argsort(-(v @ v[q]) + 1e9 * (np.arange(len(v)) == q))[:20])) for q in found)
    assert len(found) == 300 and hits >= 0.9 * 20 * 300
    r = share.first()
    assert r.pairs == 300 * 6000 and r.verified < 0.3 * r.pairs


def test_a_third_of_all_rows_alike(spark):
    rng = np.random.default_rng(6)
    same = rng.standard_normal(16).tolist()
    rows = [(k, same if k % 3 == 0 else rng.standard_normal(16).tolist()) for k in range(1200)]
    want = exact(rows, 20, 20)
    got = {}
    for r in search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leaf_rows=64, sure=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in x] for q, x in want.items()}


def test_parts(spark):
    assert chi_square(np.array([0.0, 7.344, 1e9]), 8) == pytest.approx([0, 0.5, 1], abs=1e-3)
    assert radius(0.5, 8) == pytest.approx(7.344, abs=1e-3) and radius(1.0, 8) == np.inf
    m = directions(20, 6)
    assert m.T @ m == pytest.approx(21 * np.eye(6), abs=1e-9)
    points = np.random.default_rng(0).standard_normal((4000, 6))
    assert np.bincount(Tree.fit(points, 4).leaf_of(points), minlength=16) == pytest.approx(np.full(16, 250), abs=8)
    assert search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tree_and_stop_work_with_the_query_s_parameters(spark):
    """Clustered vectors, as many as the smaller tables have: under half of all pairs are verified, recall stays."""
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((25, 64))
    rows = [(k, (centers[k % 25] + 0.4 * rng.standard_normal(64)).tolist()) for k in range(2000)]
    got, share = searched(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    v = np.array([x for _, x in rows])
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & set(np.argsort(-(v @ v[q]) + 1e9 * (np.arange(len(v)) == q))[:20])) for q in found)
    r = share.first()
    assert len(found) == 100 and hits >= 0.9 * 2000 and r.pairs == 200_000 and r.verified < 0.5 * r.pairs
