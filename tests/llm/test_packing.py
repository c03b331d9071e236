import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as repo
from tillroll.llm import packing
from tillroll.llm.packing_plan import _Packing, best_configuration, grouped, groups_of, plan
from tillroll.llm.texts import tokenizer_path

PATH = tokenizer_path(packing.VOCABULARY)
ODD = ["a", "B", "é", "é", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "1", "23", "'s", "'", "!", "##", "<|endoftext|>", "字", "🙂", "́", "\x00", " ", "\n", " ", "w"]


def ids(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def checked(counts, capacity):
    """The plan's sequences, after every rule of a packing is tested."""
    used, runs = plan(counts, capacity)
    placed, fill = np.zeros(capacity + 1, dtype=int), defaultdict(list)
    for length, rank, n, first, offset in zip(runs.length, runs.rank, runs.count, runs.first, runs.offset):
        assert rank == placed[length]
        placed[length] += n
        for j in range(n):
            fill[first + j].append((offset, length))
    assert (placed == counts).all() and set(fill) == set(range(used))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return used


@pytest.mark.parametrize("low, high", [(1, 100), (30, 50), (34, 60), (60, 100), (100, 100), (1, 4)])
def test_plans_are_packings_close_to_the_bound(low, high):
    lengths = np.random.default_rng(low).integers(low, high + 1, 3000)
    counts = np.bincount(lengths, minlength=101)
    used = checked(counts, 100)
    alone = _Packing(counts, 100)
    alone.best_fit()
    assert -(-int(lengths.sum()) // 100) <= used <= alone.used


def test_configurations_beat_best_fit_where_thirds_meet():
    counts = np.zeros(101, dtype=int)
    counts[[51, 27, 26, 23]] = [600, 600, 600, 1200]
    assert checked(counts, 100) <= 915


def test_no_pieces():
    assert checked(np.zeros(11, dtype=int), 10) == 0


def test_knapsack_is_exact():
    sizes, worth = np.array([50, 34, 21]), np.array([0.5, 0.36, 0.2])
    value, column = best_configuration(sizes, worth, 100)
    best = max(a * 0.5 + b * 0.36 + c * 0.2 for a in range(3) for b in range(3) for c in range(5) if 50 * a + 34 * b + 21 * c <= 100)
    assert value == pytest.approx(best) and column @ sizes <= 100


def test_groups_have_about_equal_cardinality():
    counts = np.bincount(np.random.default_rng(5).integers(1, 101, 5000), minlength=101)
    groups = groups_of(counts, 20, 8)
    assert sum(n for _, _, n in groups) == counts[21:].sum()
    assert max(n for _, _, n in groups) < 2 * counts[21:].sum() / 8
    assert grouped(counts, 100, 8, 8).used >= counts @ np.arange(101) / 100


def test_ids_of_parts_are_the_ids_of_the_text():
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(4000)]
    got = packing.encode_batch(texts, PATH)
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == ids(texts)


def verify(rows, docs, capacity):
    """Brute force: each document's ids, cut as told, checksummed and placed."""
    want = Counter()
    for (doc_id, text), found in zip(docs, ids([t or "" for _, t in docs])):
        found = np.array(found + [0], dtype="<u4")
        first = (len(found) - 1) % capacity + 1
        cuts = [0, *range(first, len(found) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc_id, k, a, b - a, zlib.crc32(found[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    fill = defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(fill)


def test_nulls_long_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    docs = [(1, None), (2, ""), (3, "some words " * 40), (3, "some words " * 40), (None, "x")] + [(9, "same")] * 20
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, length int")
    rows = packing.pack(df, PATH, capacity=16).collect()
    verify(rows, docs, 16)
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_query_packs_every_document_close_to_the_bound(session):
    docs = [(r.doc_id, r.text) for r in session.read.parquet(f"{repo.SMALL}/documents.parquet").collect()]
    rows = repo.queries()["op9_best_fit_packing"](session, repo.SMALL).collect()
    used = verify(rows, docs, 2048)
    assert used <= 1.02 * sum(r.length for r in rows) / 2048 + 1
