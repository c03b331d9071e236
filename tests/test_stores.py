import datetime as dt
import random
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillroll.plans import gold_store as gs
from tillroll.plans import publish as pub
from tillroll.plans.incremental import GoldSpec, build_gold, last_days
from tillroll.session import scratch_path
from tillroll.sources import partitions as parts
from tillroll.sources import writers

SCHEMA = "data string, code string, value string, year int, month int, day int"
COLUMNS = ["DATA", "CODE", "VALUE", "INGESTION_DATE"]


def spec(**more):
    return GoldSpec(keys=("CODE", "DATA"), look_back=last_days(7), touched_by="DATA", **more)


def feed(r, n, first, last):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(first, last)]
    return [
        (r.choice(["2024-01-01", "2024-01-02", "01/02/2024", "5", "", None, "a/b=c"]), r.choice("ab"), r.choice("xyz"), d.year, d.month, d.day)
        for d in (r.choice(days) for _ in range(n))
    ]


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("one_row", [False, True])
@pytest.mark.parametrize("most", [0, gs.MOST_TOUCHED])
def test_runs_on_partitions_equal_runs_on_the_whole(session, one_row, most):
    r, s = random.Random(most), spec(first_load_one_row=one_row)
    loads = [feed(r, 60, 0, 5), feed(r, 4, 8, 9), feed(r, 5, 12, 14)]
    path, gold = scratch_path(session, "t"), None
    for k, load in enumerate(loads):
        silver = session.createDataFrame([x for some in loads[: k + 1] for x in some], SCHEMA)
        asof = dt.date(2024, 1, 9 + 3 * k)
        gold = session.createDataFrame(build_gold(silver, s, asof, gold).select(COLUMNS).collect(), "DATA string, CODE string, VALUE string, INGESTION_DATE date")
        named = gs.merge_into_gold(session, silver, s, asof, path, most_touched=most)
        assert (named is None) == (k == 0 or most == 0)
        assert rows(gs.read_gold(session, path).select(COLUMNS)) == rows(gold)


def test_untouched_partitions_are_neither_read_nor_written(session):
    s, path = spec(), scratch_path(session, "t")
    old = [(f"2024-01-{d:02}", "a", "x", 2024, 1, 1) for d in range(1, 10)]
    new = [("2024-01-03", "a", "y", 2024, 1, 20), (None, "a", "y", 2024, 1, 20), ("2024-01-04", "a", "z", None, None, None)]
    gs.merge_into_gold(session, session.createDataFrame(old, SCHEMA), s, dt.date(2024, 1, 2), path)
    before = files(path)
    named = gs.merge_into_gold(session, session.createDataFrame(old + new, SCHEMA), s, dt.date(2024, 1, 20), path)
    assert named == ["none", "v2024-01-03"]
    after = files(path)
    changed = {f.split("/")[0] for f in {*before, *after} if before.get(f) != after.get(f)}
    assert changed == {"gold_partition=v2024-01-03", "gold_partition=none"}
    # A run with nothing new changes nothing.
    assert gs.merge_into_gold(session, session.createDataFrame(old, SCHEMA), s, dt.date(2024, 1, 20), path) == []
    assert files(path) == after
    scan = gs.gold_rows(session, path, gs.read_gold(session, path).schema, named)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "gold_partition" in filters and "v2024-01-03" in filters
    assert {x.gold_partition for x in parts.partition_files(session, path).collect()} == {"none", *(f"v2024-01-{d:02}" for d in range(1, 10))}


def test_a_key_without_its_date_is_refused(session):
    with pytest.raises(ValueError):
        gs.merge_into_gold(session, session.createDataFrame([], SCHEMA), GoldSpec(keys=("CODE",), look_back=last_days(1)), dt.date(2024, 1, 1), "x")


def test_a_failed_check_leaves_gold(session):
    s, path = spec(), scratch_path(session, "t")
    old = [("2024-01-01", "a", "x", 2024, 1, 1)]
    gs.merge_into_gold(session, session.createDataFrame(old, SCHEMA), s, dt.date(2024, 1, 2), path)
    before = files(path)
    two = session.createDataFrame([("2024-01-01", "a", v, 2024, 1, 9) for v in "yz"], SCHEMA)
    with pytest.raises(pub.CheckFailed) as error:
        gs.merge_into_gold(session, two, s, dt.date(2024, 1, 9), path, [pub.no_duplicates(s.keys), pub.at_least(1)])
    assert list(error.value.failed.values()) == [1] and files(path) == before


def fact(session, data):
    typed = session.createDataFrame(data, "d date, k int, q int, p string")
    return typed.withColumn("q", F.col("q").cast("decimal(10,2)"))


def test_checks_and_publishing(session):
    path = scratch_path(session, "t")
    day = [dt.date(2024, 1, k) for k in range(1, 6)]
    good = fact(session, [(day[0], 1, 1, "a"), (day[1], 2, 2, "b"), (day[2], 3, None, None)])
    pub.publish(good, path, [pub.no_missing_days("d"), pub.no_duplicates(["k"]), pub.no_nulls("k"), pub.at_least(3)], ("p",))
    pub.publish(good, path, [pub.same_totals(good, {"d": "d"}, {"q": "q"})], ("p",))
    before = files(path)
    bad = fact(session, [(day[0], 1, 1, "a"), (day[2], 1, 3, "a"), (day[2], None, 4, "b")])
    with pytest.raises(pub.CheckFailed) as error:
        pub.publish(
            bad, path,
            [pub.no_missing_days("d"), pub.no_duplicates(["k"]), pub.no_nulls("k", "d"), pub.at_least(4), pub.same_totals(good, {"d": "d"}, {"q": "q"})],
            ("p",),
        )
    assert list(error.value.failed.values()) == [1, 1, 1, 1, 2]
    assert files(path) == before
    # Read from the target and written back to it: only the partition it has changes.
    again = session.read.schema(good.schema).parquet(path).where("p = 'a'").withColumn("k", F.lit(9))
    pub.publish(again, path, partition=("p",))
    assert rows(session.read.schema(good.schema).parquet(path).select("k", "p")) == [(2, "b"), (3, None), (9, "a")]
    assert not list(Path(path).parent.glob("staging-*"))


def test_newest_values_come_from_the_listing(session):
    path = scratch_path(session, "t")
    # A folder name does not tell no value from an odd one: both are null days.
    data = [(k, 2024, 1, k % 5 + 1) for k in range(20)] + [(99, 2024, 2, None), (98, 2024, 2, 31)]
    writers.append_partitioned(session.createDataFrame(data, "k int, year int, month int, day int"), path)
    # The newest folder has a file without rows.
    session.createDataFrame([], "k int").coalesce(1).write.parquet(f"{path}/year=2025/month=1/day=1")
    day = F.expr("try_to_date(concat_ws('-', year, month, day), 'yyyy-M-d')")
    newest = parts.newest_partition_values(session, path, day, 3)
    assert newest == [dt.date(2024, 1, d) for d in (5, 4, 3)]
    got = parts.rows_of_newest(session, path, day, 3)
    assert {r.k % 5 for r in got.collect()} == {2, 3, 4} and got.count() == 12
    assert "PartitionFilters: [" in (plan := got._jdf.queryExecution().executedPlan().toString())
    assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(parts.newest_partition_values(session, path, day, 50)) == 5
    listed = {(r.year, r.month, r.day): r.n_files for r in parts.partition_files(session, path).collect()}
    assert len(listed) == 8 and listed[2025, 1, 1] == 1
    assert parts.partition_columns(session, path) == ["year", "month", "day"]
    assert parts.path_exists(session, path) and not parts.path_exists(session, path + "x")


def test_newest_values_of_nothing(session):
    path = scratch_path(session, "t")
    session.createDataFrame([], "k int, year int").write.partitionBy("year").parquet(path)
    schema = session.createDataFrame([], "k int, year int").schema
    day = F.lit(None).cast("date")
    assert parts.newest_partition_values(session, path, day, 3, schema) == []
    assert parts.rows_of_newest(session, path, day, 3, schema).count() == 0
