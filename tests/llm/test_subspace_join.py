import duckdb
import numpy as np
import pytest

import __spark_entry__ as repo
from tillroll.llm import subspace_join as sj

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def plain(rows, cosine):
    """Brute force over all pairs."""
    ok = [
        (i, np.array(v, dtype=np.float32).astype(float), lab)
        for i, v, lab in rows
        if v and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, group = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}
    pairs = []
    for n, (i, x, a) in enumerate(ok):
        for j, y, b in ok[:n]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if group[i] != group[j]:
                group[i] = group[j] = min(group[i], group[j])
                changed = True
    return {i: (links[i], group[i], i == group[i]) for i, *_ in rows}


def clustered(seed, dim, n):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0, 0.1, 0.25, 0.4, 2])
        out.append((i, [float(x) for x in v.astype(np.float32) * rng.choice([1, 3])], int(rng.integers(3))))
    return out


@pytest.mark.parametrize("dim, tile", [(64, 2048), (64, 7), (10, 16), (3, 2048), (1, 9)])
def test_links_and_groups_equal_all_pairs(session, monkeypatch, dim, tile):
    monkeypatch.setattr(sj, "TILE", tile)
    rows = clustered(dim, dim, 220)
    df = session.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in sj.near_duplicates(df, 0.93).collect()}
    assert got == plain(rows, 0.93) and any(v[0] for v in got.values())


def test_odd_vectors_copies_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [1.0, inf], 1),
        (7, [1.0, 1.0], None), (8, [1.0, 1.0], None), (20, [1.0, 1.0], 1), (21, [1.0, 1.0], 1), (22, [2.0, 2.0], 1),
        (23, [1.0, 1.0], 2), (24, [1.0, 1.0, 0.0], 1), (25, [-1.0, -1.0], 1), (26, [1e-30, 1e-30], 1), (27, [-0.0, 1.0], 2), (28, [0.0, 1.0], 2),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = sj.near_duplicates(df, 0.93)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == plain(rows, 0.93)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sj.near_duplicates(df.limit(0), 0.93).count() == 0


def test_query_equals_its_sql(session):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{repo.SMALL}/embeddings.parquet'")
    got = repo.queries()["op6_subspace_join"](session, repo.SMALL)
    order = "vec_id, n_links, component_id, kept"
    want = con.execute(f"select {order} from ({repo.oracle_sql()['op6_subspace_join']})").fetchall()
    assert sorted(tuple(r) for r in got.selectExpr(*order.split(", ")).collect()) == sorted(want)
