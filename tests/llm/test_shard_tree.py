import math
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as repo
from tillroll.llm import shard_tree as st

SCHEMA = "doc_id long, text string, shard string, task int"


def plain_shard(row_id, tree):
    """Descent in plain Python, with the XXH64 of the library."""

    def draw(child, weight):
        seed = 42 if row_id is None else xxhash.xxh64_intdigest(str(row_id).encode(), 42)
        bits = xxhash.xxh64_intdigest(child.encode(), seed) >> 11
        return -math.log((bits + 0.5) * 2.0**-53) / weight

    left, node = [s for s in tree if s.weight > 0], None
    for name in (lambda s: s.region, lambda s: f"{s.region}/{s.rack}", lambda s: str(s.number)):
        weights = defaultdict(float)
        for s in left:
            weights[name(s)] += s.weight
        node = min(weights, key=lambda c: draw(c, weights[c]))
        left = [s for s in left if name(s) == node]
    return int(node)


def shards(session, tree, n=4000):
    return [r.s for r in session.range(n).select(st.shard_of(F.col("id"), tree).alias("s")).collect()]


def test_descent_equals_plain_python(spark):
    tree = [replace(s, weight=1 + s.number % 3) for s in st.even_tree(11, 2, 3)]
    got = spark.range(300).select("id", st.shard_of(F.col("id"), tree).alias("s")).collect()
    assert [r.s for r in got] == [plain_shard(r.id, tree) for r in got]


def test_one_more_shard_takes_rows_only_into_itself(session):
    tree = st.even_tree(40)
    old, new = shards(session, tree, 8000), shards(session, st.grown(tree), 8000)
    moved = [b for a, b in zip(old, new) if a != b]
    assert set(moved) == {40} and 8000 / 41 * 0.7 < len(moved) < 8000 / 41 * 1.3
    assert set(old) == set(range(40)) and max(Counter(old).values()) < 1.5 * 8000 / 40


def test_weights_decide_the_shares(session):
    tree = [st.Shard(0, "a", "r", 1.0), st.Shard(1, "a", "r", 3.0), st.Shard(2, "a", "s", 2.0), st.Shard(3, "b", "r", 4.0), st.Shard(4, "b", "r", 0.0)]
    found = Counter(shards(session, tree, 20000))
    assert 4 not in found
    for k, w in ((0, 1), (1, 3), (2, 2), (3, 4)):
        assert abs(found[k] - 2000 * w) < 5 * math.sqrt(2000 * w)


@pytest.mark.parametrize("weight", [0.0, 0.25, 4.0])
def test_movement_stays_in_subtrees_whose_weights_change(session, weight):
    tree = st.even_tree(40)
    changed = tree[13]
    other = [replace(s, weight=weight) if s is changed else s for s in tree]
    old, new = shards(session, tree), shards(session, other)
    home = {s.number: (s.region, s.rack) for s in tree}
    moved = [(a, b) for a, b in zip(old, new) if a != b]
    assert moved
    for a, b in moved:
        ends = {home[a][0], home[b][0]}
        # Out of or into the changed region; inside it, the changed rack; inside that, the shard.
        assert changed.region in ends
        if ends == {changed.region}:
            assert (changed.region, changed.rack) in (home[a], home[b])
            if home[a] == home[b]:
                assert changed.number in (a, b)


def test_trees_that_make_no_sense(session):
    for tree in ([], [st.Shard(0, "a", "r", 0.0)], [st.Shard(0, "a", "r", -1.0)], [st.Shard(0, "a", "r", float("nan"))], [st.Shard(0, "a", "r"), st.Shard(0, "b", "r")]):
        with pytest.raises(ValueError):
            st.shard_of(F.lit(1), tree)


def check(rows, want):
    """Sizes and checksums of the rows, plain shards, gapless slots in order."""
    tree = st.even_tree(40)
    keys = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows)
    assert keys == Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), plain_shard(k, tree), plain_shard(k, st.grown(tree))) for k, t in want
    )
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append((r.slot, (r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32)))
    for found in by_shard.values():
        found.sort()
        assert [slot for slot, _ in found] == list(range(len(found)))
        assert [k for _, k in found] == sorted(k for _, k in found)
    assert {r.law for r in rows} <= {"key"}


def test_odd_rows_repeats_and_empty_tables(spark):
    rows = [(1, "a"), (1, "a"), (1, None), (None, "b"), (None, None), (2, ""), (3, "ä😀" * 100_000), (-5, "x")] + [(7, "same")] * 300
    df = spark.createDataFrame([(k, t, "s", 0) for k, t in rows], SCHEMA).repartition(7)
    tree = st.even_tree(40)
    got = st.with_shards(df, tree, st.grown(tree))
    check(got.collect(), rows)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {r.grown_shard for r in st.with_shards(df, tree).collect()} == {None}
    assert st.with_shards(df.limit(0), tree, st.grown(tree)).count() == 0


def test_an_id_of_many_rows_is_spread_over_tasks(session):
    df = session.range(40_000).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text")).repartition(8)
    got = st.with_shards(df, st.even_tree(40))
    assert sorted(r.slot for r in got.select("slot").collect()) == list(range(40_000))
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_query_equals_plain_python(session):
    docs = session.read.parquet(f"{repo.SMALL}/documents.parquet").collect()
    check(repo.queries()["op11_hash_tree_shards"](session, repo.SMALL).collect(), [(r.doc_id, r.text) for r in docs])
