import numpy as np
import pytest

import __spark_entry__ as repo
from tillroll.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, component string, x string"


def plain(rows, most=8):
    """By the library's symmetric eigenvectors; signs are left open."""
    kept = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    wide = max((len(v) for _, v in kept), default=0)
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] + [100000] * (wide - len(v)) for _, v in kept], dtype=np.int64).reshape(-1, wide)
    n, sums = len(x), x.sum(axis=0)
    apart = (n * x - sums) / max(n, 1)
    values, vectors = np.linalg.eigh(apart.T @ apart / max(n, 1)) if wide else (np.zeros(0), np.zeros((0, 0)))
    rank = int((values > 1e-9 * max(values.sum(), 1e-300)).sum())
    keep = np.argsort(-values)[: min(most, rank)]
    return {
        "ids": [i for i, _ in kept],
        "n": n,
        "deviation": [int(sum(int(t) ** 2 for t in n * r - sums)) for r in x],
        "values": values[keep],
        "trace": values.sum(),
        "whitened": apart @ vectors[:, keep] / np.sqrt(values[keep]),
        "x": x,
    }


def check(rows, want):
    count = len(want["values"])
    assert len(rows) == len(want["ids"]) * count
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == want["n"] and 0 <= r.identity_error < 1e-9
        assert abs(r.explained / (want["values"][r.component - 1] / want["trace"]) - 1) < 1e-9
    got = np.array([[by_id[i][k + 1].whitened for k in range(count)] for i in want["ids"]])
    assert [by_id[i][1].deviation for i in want["ids"]] == want["deviation"]
    sign = np.sign((got * want["whitened"]).sum(axis=0))
    assert np.abs(got - sign * want["whitened"]).max() < 1e-8
    # The definition, free of signs: covariance of the result, and x's share of it.
    assert np.abs(got.T @ got / len(got) - np.eye(count)).max() < 1e-9


@pytest.mark.parametrize("n, rank", [(1, 1), (5, 5), (8, 3), (33, 33), (64, 20)])
def test_cholesky_and_jacobi_on_the_factor(n, rank):
    rng = np.random.default_rng(n)
    root = rng.standard_normal((n, rank)) * 10.0 ** rng.integers(-4, 4, rank)
    m = root @ root.T
    factor = wh.pivoted_cholesky(m)
    assert factor.shape[1] <= n and np.abs(factor @ factor.T - m).max() <= 1e-12 * np.abs(m).max() * n
    turned = wh.rotated(factor)
    assert np.abs(turned @ turned.T - m).max() <= 1e-12 * np.abs(m).max() * n
    norms = np.sqrt((turned**2).sum(axis=0))
    assert np.abs(turned.T @ turned / np.outer(norms, norms) - np.eye(len(norms))).max() < 1e-13
    assert np.allclose(np.sort(norms**2)[::-1][:3], np.linalg.eigvalsh(m)[::-1][: min(3, len(norms))], rtol=1e-9)


def test_factor_of_nothing():
    assert wh.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    assert wh.rotated(np.zeros((3, 0))).shape == (3, 0)


@pytest.mark.parametrize("n", [1, 2, 3, 6, 9])
def test_every_pair_meets_once(n):
    met = [tuple(sorted(p)) for a, b in wh.tournament(n) for p in zip(a.tolist(), b.tolist())]
    assert sorted(met) == [(i, j) for i in range(n) for j in range(i + 1, n)]
    assert all(len({*a.tolist(), *b.tolist()}) == 2 * len(a) for a, b in wh.tournament(n))


@pytest.mark.parametrize("dim, n", [(12, 200), (64, 90), (5, 50), (20, 6)])
def test_rows_equal_the_library(session, dim, n):
    rng = np.random.default_rng(dim)
    spread = 2.0 ** -np.arange(dim) if dim < 15 else 1 / (1 + np.arange(dim))
    rows = [(k, [float(x) for x in (rng.standard_normal(dim) * spread * 50).astype(np.float32)]) for k in range(n)]
    df = session.createDataFrame([(*r, "c", "x") for r in rows], SCHEMA).repartition(3)
    check(wh.whiten(df).collect(), plain(rows))


def test_odd_vectors_copies_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [(8, [0.5, 1.0, 0.0]), (9, [-0.5, 2.0, 0.0]), (10, [0.25, -3.0, 1.0]), (11, [0.5, 1.0]), (12, [])]
    rows = [(1, None), (4, [1.0, None]), (5, [1.0, nan]), (6, [1.0, inf]), *good]
    df = spark.createDataFrame([(*r, "c", "x") for r in rows], SCHEMA)
    got = wh.whiten(df)
    check(got.collect(), plain(rows))
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.columns == columns
    twice = wh.whiten(df.union(df).union(spark.createDataFrame([(None, [0.0, 0.0, 7.0], "c", "x")] * 2, SCHEMA)), components=2)
    assert twice.count() == 2 * (2 * len(good) + 2) and twice.where("vec_id is null").count() == 4
    # No spread, no component.
    for none in (df.limit(0), df.where("vec_id < 7"), df.where("vec_id = 8"), df.where("vec_id = 8").union(df.where("vec_id = 11")), df.where("vec_id = 12")):
        empty = wh.whiten(none)
        assert empty.count() == 0 and empty.dtypes == got.dtypes
    with pytest.raises(ValueError):
        wh.whiten(spark.createDataFrame([(1, [1e30], "c", "x")], SCHEMA))


def test_a_deviation_beyond_a_long_is_null(session):
    assert wh.squares(np.array([[2**32, 2**32], [3, 4], [2**31, 0]])) == [None, 25, 2**62]


def test_query_equals_the_library(session):
    rows = [(r.vec_id, r.embedding) for r in session.read.parquet(f"{repo.SMALL}/embeddings.parquet").collect()]
    check(repo.queries()["op13_whitening"](session, repo.SMALL).collect(), plain(rows))
