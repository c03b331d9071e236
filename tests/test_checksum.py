import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillroll.operators import audit
from tillroll.operators import checksum as cs
from tillroll.session import scratch_path
from tillroll.sources import writers

SCHEMA = "k int, p string, s string, v double, d date"


def layer(r, n):
    return [
        (r.choice([*range(30), None]), r.choice(["a", "b", None]), r.choice(["x", "", None]), r.choice([0.0, 1.5, None]), r.choice([dt.date(2024, 1, 1), None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("most", [cs.MOST_NAMED, 1])
@pytest.mark.parametrize("partition", [(), ("p",)])
def test_differences_equal_those_of_all_rows(spark, monkeypatch, most, partition):
    monkeypatch.setattr(cs.narrowed, "__defaults__", ((), cs.BUCKETS, most))
    r = random.Random(most)
    old = layer(r, 60)
    new = [x if r.random() < 0.8 else layer(r, 1)[0] for x in old] + layer(r, 3)
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (old, new))
    want = rows(audit.row_differences(a, b, ["k", "p"], ["s", "v", "d"]))
    assert want and rows(cs.row_differences(a, b, ["k", "p"], ["s", "v", "d"], partition, buckets=16)) == want


def test_checksums_do_not_depend_on_order_or_tasks(session):
    data = layer(random.Random(3), 500)
    a = session.createDataFrame(data, SCHEMA).repartition(3)
    b = session.createDataFrame(data[::-1], SCHEMA).repartition(7)
    args = (["k", "p"], ["s", "v", "d"])
    assert cs.same_layer(a, b, *args)
    assert not cs.same_layer(a, b.limit(499), *args)
    assert not cs.same_layer(a, b.union(b.limit(1)), *args)
    assert cs.same_layer(a.limit(0), b.limit(0), *args)
    assert not cs.same_layer(a, b.limit(0), *args)
    one = "k int, a string, b string"
    pair = [session.createDataFrame([x], one) for x in ((1, None, "x"), (1, "x", None))]
    assert not cs.same_layer(*pair, ["k"], ["a", "b"])
    swapped = [session.createDataFrame(x, one) for x in ([(1, "x", "y"), (2, "z", "y")], [(1, "z", "y"), (2, "x", "y")])]
    assert not cs.same_layer(*swapped, ["k"], ["a", "b"])


def test_rows_of_equal_buckets_do_not_reach_the_join(session):
    old = session.range(5000).selectExpr("id as k", "id % 7 as v")
    new = old.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v")))
    left, right = cs.narrowed(old, new, ["k"], ["v"])
    assert left.count() < 20 and right.count() == left.count()
    assert rows(cs.row_differences(old, new, ["k"], ["v"])) == [(77, "both", "v", "0", "-1")]
    assert cs.narrowed(old, old, ["k"], ["v"])[0].count() == 0
    assert cs.row_differences(old, old, ["k"], ["v"]).count() == 0
    assert cs.row_differences(old, new.limit(0), ["k"], ["v"]).count() == 5000


def test_partitions_that_are_the_same_are_not_scanned_again(session):
    data = [(k, f"2024-01-{k % 9 + 1:02}", k % 4) for k in range(300)]
    frames = []
    for change in (0, 1):
        path = scratch_path(session, "layer")
        df = session.createDataFrame([(k, d, v + change * (k == 4)) for k, d, v in data], "k int, day string, v int")
        writers.overwrite_partitions(df, path, ("day",))
        frames.append(session.read.schema(df.schema).parquet(path))
    found = cs.differing_partitions(*frames, ["day"], ["k", "day"], ["v"])
    assert rows(found.select("day", "n_buckets")) == [("2024-01-05", 1)]
    left, _ = cs.narrowed(*frames, ["k", "day"], ["v"], ["day"])
    filters = left._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "2024-01-05" in filters and "2024-01-04" not in filters
    with pytest.raises(ValueError):
        cs.narrowed(*frames, ["k"], ["v"], ["day"])
