import random

import duckdb
import numpy as np
import pytest

import __spark_entry__ as repo
from tillroll.llm import decontamination as dc


def shingles(text, words=5):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def plain(docs, items, containment=0.8):
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            words = min(5, len((item or "").encode().split()))
            have, want = shingles(text, words), shingles(item, words)
            if want and len(want & have) >= containment * len(want) - 1e-9:
                out.append((doc_id, item_id, len(want & have), len(want)))
    return sorted(out, key=repr)


def corpus(seed):
    """Items of 1 to 60 words inside documents of up to 5,000, whole and damaged."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 30, 60])))) for k in range(40)]
    docs = []
    for k in range(120):
        body = [word() for _ in range(rng.choice([0, 5, 40, 400, 5000]))]
        for _, item in rng.sample(items, rng.randint(0, 3)):
            cut = item.upper().split()
            for _ in range(rng.choice([0, 0, 1, 4])):
                cut[rng.randrange(len(cut))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = cut
        docs.append((k, rng.choice([" ", "\n", " \t "]).join(body)))
    return docs, items


@pytest.mark.parametrize("block", [1 << 18, 60])
def test_pairs_equal_exact_containment(session, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK", block)
    docs, items = corpus(block)
    d, i = session.createDataFrame(docs, "doc_id long, text string"), session.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in dc.contaminated(d, i).collect()), key=repr)
    assert got == plain(docs, items) and got


def test_sketches_miss_rarely():
    rng = np.random.default_rng(8)
    for n, size in [(1, 50), (4, 3000), (20, 700), (60, 20_000)]:
        missed = 0
        for _ in range(60):
            item = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            kept = rng.choice(item, max(1, int(np.ceil(0.8 * n))), replace=False)
            doc = np.unique(np.concatenate([kept, rng.integers(0, 2**63, size).astype(np.uint64)]))
            missed += not len(dc.Items([(1, item)], 0.8).candidates(doc))
        assert missed == 0
    doc = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    assert len(dc.minima(doc, dc.bins_of(5000, 4.0))) < 2100


def test_nulls_repeats_clashes_and_empty_tables(spark):
    long = "filler words go on " * 30_000 + "one two three four five six"
    docs = [(1, None), (2, ""), (3, "One two THREE four five six"), (3, "One two THREE four five six"), (4, long), (None, "one two three four five six"), (5, "clean text here only ok yes")]
    items = [(7, "one two three four five six"), (7, "one two three four five six"), (8, None), (9, " "), (None, "one two three four five six")]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contaminated(d, i)
    assert got.columns == ["doc_id", "item_id", "n_shared", "n_shingles"]
    assert sorted(r.doc_id or 0 for r in got.collect()) == [0] * 3 + [3] * 6 + [4] * 3
    kept = dc.decontaminate(d, i)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert dc.contaminated(d, i.limit(0)).count() == 0 == dc.contaminated(d.limit(0), i).count()
    assert dc.decontaminate(d, i.limit(0)).count() == len(docs)


def test_short_items_and_items_without_id(session):
    docs = [(1, "what is The capital\tof France now said he to me"), (2, "the capital of a france"), (3, "the capital of france"), (4, "yes"), (5, "no yes"), (6, "yesterday france")]
    items = [(1, " the capital of france "), (2, "yes"), (None, "france now said he to me")]
    d, i = session.createDataFrame(docs, "doc_id long, text string"), session.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in dc.contaminated(d, i).collect()), key=repr)
    assert got == plain(docs, items) and {r[:2] for r in got} == {(1, 1), (3, 1), (4, 2), (5, 2), (1, None)}
    kept = dc.decontaminate(d, i.where("item_id is null"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6]


def test_query_equals_its_sql(session):
    folder = repo.SMALL.replace("0.001", "0.01")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    sql = repo.oracle_sql()["op10_benchmark_decontamination"]
    want = con.execute(f"select doc_id, item_id, n_shared, n_shingles from ({sql})").fetchall()
    got = repo.queries()["op10_benchmark_decontamination"](session, folder).collect()
    assert sorted(tuple(r) for r in got) == sorted(want) and want
