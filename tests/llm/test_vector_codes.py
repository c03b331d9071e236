import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as repo
from tillroll.llm import vector_codes as vc
from tillroll.llm.integer_vectors import matrix

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Brute force with Python's integers."""
    kept = [(i, [float(c) for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    wide = max(-(-max((len(v) for _, v, _ in kept), default=0) // parts), 1) * parts
    ints = [[int(np.floor(np.float64(scale) * np.float64(np.float32(c)))) for c in v] + [0] * (wide - len(v)) for _, v, _ in kept]
    step = wide // parts
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, ints[k]))
    books = [[ints[k][p * step : (p + 1) * step] for k in order[:entries]] for p in range(parts)]

    def near(x, p):
        apart = [sum((a - b) ** 2 for a, b in zip(x[p * step : (p + 1) * step], c)) for c in books[p]]
        return apart.index(min(apart)), min(apart)

    for _ in range(rounds):
        found = [[near(x, p)[0] for p in range(parts)] for x in ints]
        for p in range(parts):
            for e in range(len(books[p])):
                some = [x[p * step : (p + 1) * step] for x, f in zip(ints, found) if f[p] == e]
                if some:
                    books[p][e] = [sum(c) // len(some) for c in zip(*some)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    last = [[near(x, p) for p in range(parts)] for x in ints]
    errors = [sum(d for _, d in f) for f in last]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted(
        ((i, "".join(f"{e:02x}" for e, _ in f), err, by_label[lab], sha) for (i, _, lab), f, err in zip(kept, last, errors)), key=repr
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bits", [3, 12, 20, 24, 25])
@pytest.mark.parametrize("length", [1, 8, 300])
def test_dots_of_limbs_are_exact(bits, length):
    rng = np.random.default_rng(bits * length)
    a, b = (rng.integers(-(1 << bits), (1 << bits) + 1, (m, length)) for m in (40, 16))
    a[0], b[0], b[1] = -(1 << bits), 1 << bits, -(1 << bits)
    want = a.astype(object) @ b.T.astype(object)
    assert (vc.exact_dots(a, b) == want).all()
    used = vc.limb_bits(length)
    assert length * (1 << 2 * used) < 2**53
    for part in (vc.limbs(a, used), vc.limbs(a, 2)):
        assert all((abs(x) <= 1 << 25).all() for x in part)
    halves = vc.limbs(a, 2)
    assert (sum(x.astype(np.int64) << 2 * i for i, x in enumerate(halves)) == a).all()
    assert all((abs(x) <= 4).all() for x in halves)


def test_ties_go_to_the_first_entry():
    index, apart = vc.nearest(np.array([[1, 0], [5, 5]]), np.array([[0, 0], [2, 0], [0, 0], [5, 5]]))
    assert index.tolist() == [0, 3] and apart.tolist() == [1, 0]


def test_rows_of_different_lengths_are_filled_up():
    assert matrix(pa.array([[1], [], [2, 3]], pa.list_(pa.int64())), 3).tolist() == [[1, 0, 0], [0, 0, 0], [2, 3, 0]]


@pytest.mark.parametrize("dim, n, scale", [(16, 150, 1), (64, 60, 1000), (10, 40, 1), (8, 5, 1)])
def test_codes_equal_plain_integers(session, dim, n, scale):
    rng = np.random.default_rng(dim)
    rows = [(int(k), [float(x) for x in (rng.standard_normal(dim) * scale).astype(np.float32)], int(k % 3) if k % 5 else None) for k in rng.permutation(n)]
    df = session.createDataFrame([(*r, "c", "x") for r in rows], SCHEMA).repartition(3)
    assert found(vc.with_codes(df)) == plain(rows)


def test_odd_vectors_copies_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [1.0, inf], 1), (None, [1.0, -1.0], None), (7, [-0.3] * 9, None)]
    rows += [(8, [0.5] * 8, 2)] * 30 + [(9, [-0.5] * 8, 2)] * 3 + [(9, [0.25] * 8, 3)]
    df = spark.createDataFrame([(*r, "c", "x") for r in rows], SCHEMA)
    got = vc.with_codes(df)
    assert found(got) == plain(rows)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    for none in (df.limit(0), df.where("vec_id in (1, 4, 5)")):
        empty = vc.with_codes(none)
        assert empty.count() == 0 and empty.dtypes == got.dtypes
    with pytest.raises(ValueError):
        vc.with_codes(spark.createDataFrame([(1, [1e30], 1, "c", "x")], SCHEMA))


def test_query_equals_its_sql_and_plain_integers(session):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{repo.SMALL}/embeddings.parquet'")
    got = found(repo.queries()["op12_vector_codes"](session, repo.SMALL))
    order = "vec_id, code, error, label_error, codebooks_sha256"
    assert got == sorted(con.execute(f"select {order} from ({repo.oracle_sql()['op12_vector_codes']})").fetchall(), key=repr)
    assert got == plain(con.execute("select vec_id, embedding, label from embeddings").fetchall())
