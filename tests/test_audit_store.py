import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillroll.operators import audit, sketch
from tillroll.plans import audit_store as st
from tillroll.plans.layer_audit import audit_layer
from tillroll.session import remove_path, scratch_path
from tillroll.sources import writers

SCHEMA = "d date, shop string, file string, code string, q decimal(10,2), n int, part int"


def lines(r, n):
    days = [dt.date(2024, 1, k) for k in range(1, 28)]
    return [
        (r.choice([*days, None]), r.choice(["s1", "s2", None]), r.choice(["f", "g", None]), r.choice(["1", "2", None, ""]),
         r.choice([Decimal("1.25"), Decimal("-3"), None]), r.choice([1, 2, None]), r.choice([1, 2, 3]))
        for _ in range(n)
    ]


def spec(**more):
    given = {"partition": {"p": "part"}, "day": F.col("d"), "keys": ("d", "code"), "sums": {"q": "q", "n": F.col("n")},
             "store": {"store": F.upper("shop")}, "source_file": "file"}
    return st.AuditSpec(**{**given, **more})


def plain(df, s):
    return audit_layer(df, dict(s.partition), s.day, list(s.keys), dict(s.sums), dict(s.store) or None, s.source_file)


def same(found, want):
    for name, frame in found.items():
        assert frame.columns == want[name].columns, name
        assert rows(frame) == rows(want[name]), name
        if name != "columns":
            assert frame.dtypes == want[name].dtypes or name.startswith("totals"), name


@pytest.mark.parametrize("n", [0, 200])
def test_frames_after_one_scan_equal_the_separate_ones(spark, n):
    df = spark.createDataFrame(lines(random.Random(n), n), SCHEMA)
    for s in (spec(), spec(partition={}, store={}, source_file=None)):
        found, want = st.audit_once(df, s), plain(df, s)
        assert set(want) - set(found) == {"columns"} and set(found) <= set(want)
        same(found, want)


def test_one_scan_in_the_plan(session):
    path = scratch_path(session, "t")
    session.createDataFrame(lines(random.Random(1), 50), SCHEMA).write.parquet(path)
    plan = st.audit_cells(session.read.parquet(path), spec())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def test_a_sum_beyond_its_type_is_null(spark):
    top = [(dt.date(2024, 1, 1), k, 2**63 - 1) for k in "ab"] + [(dt.date(2024, 1, 2), "a", 1), (dt.date(2024, 1, 3), "a", None)]
    df = spark.createDataFrame(top, "d date, shop string, v bigint")
    s = st.AuditSpec(partition={"shop": "shop"}, day=F.col("d"), keys=("d",), sums={"v": "v"})
    same(st.audit_once(df, s), plain(df, s))
    same(st.audit_once(df.union(df), s), plain(df.union(df), s))


def write(session, path, data):
    writers.overwrite_partitions(session.createDataFrame(data, SCHEMA), path, ("part",))


@pytest.mark.parametrize("keys", [("d", "code"), ("d", "code", "part")], ids=["keys span partitions", "keys hold the partition"])
def test_a_rerun_scans_what_changed(session, keys):
    r, s = random.Random(5), spec(keys=keys)
    path, store = scratch_path(session, "layer"), scratch_path(session, "store")

    def audited(scanned):
        got = st.audit_partitions(session, path, s, store)
        assert got.scanned == [f"in/part={p}" for p in scanned]
        now = session.read.parquet(path)
        same({k: v for k, v in got.frames.items() if k != "columns"}, plain(now, s))
        columns = {c.column: (c.n_rows, c.n_nulls, c.n_distinct) for c in got.frames["columns"].collect()}
        # Few values: the estimates are exact.
        assert columns == {c.column: (c.n_rows, c.n_nulls, c.n_distinct) for c in audit.column_profile(now).collect()}

    write(session, path, lines(r, 150))
    audited([1, 2, 3])
    audited([])
    write(session, path, [x for x in lines(r, 150) if x[6] == 2])
    audited([2])
    session.createDataFrame([(*x[:6], p) for x in lines(r, 20) for p in (3, 4)], SCHEMA).write.mode("append").partitionBy("part").parquet(path)
    audited([3, 4])
    remove_path(session, f"{path}/part=1")
    audited([])
    # Another spec has a store of its own.
    other = spec(keys=keys, sums={"q": "q"})
    assert len(st.audit_partitions(session, path, other, store).scanned) == 3


def test_a_rerun_reads_only_the_changed_partitions(session):
    path = scratch_path(session, "layer")
    write(session, path, lines(random.Random(5), 50))
    changed = session.read.parquet(path).where(st._part_name(["part"]).isin(["in/part=2"]))
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "in/part=2" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_a_run_that_broke_off_is_done_again(session):
    path, store, s = scratch_path(session, "layer"), scratch_path(session, "store"), spec()
    write(session, path, lines(random.Random(5), 90))
    st.audit_partitions(session, path, s, store)
    # The cells were stored, the mark that they are complete was not.
    remove_path(session, f"{store}/{s.digest()}/columns/audit_part=in%2Fpart%3D2")
    got = st.audit_partitions(session, path, s, store)
    assert got.scanned == ["in/part=2"]
    same({"totals_per_day": got.frames["totals_per_day"]}, plain(session.read.parquet(path), s))


def test_sketches_of_splits_merge_into_the_whole(session):
    n = 40_000
    df = session.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("few"), F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).alias("t"),
        F.array((F.col("id") % 3)).alias("list"), F.lit(None).cast("date").alias("none"), F.encode(F.when(F.col("id") % 2 == 0, "").otherwise("x"), "utf-8").alias("bytes"), F.col("id").cast("int").alias("odd.name"),
    )
    exact = {r.column: r for r in audit.column_profile(df).collect()}
    by = sketch.column_sketches(df, {"s": F.col("k") % 5})
    assert by.count() == 5 * 7
    whole = sketch.estimated_profile(sketch.merge_sketches(by))
    half = sketch.estimated_profile(sketch.merge_sketches(by.where("s < 2"))).where("column = 'k'").collect()[0]
    assert half.n_rows == 2 * n // 5 and abs(half.n_distinct / half.n_rows - 1) < 4 * sketch.standard_error()
    for profile in (whole, audit.column_profile(df, exact=False)):
        assert profile.columns == audit.column_profile(df).columns
        found = {r.column: r for r in profile.collect()}
        assert set(found) == set(exact)
        for c, want in exact.items():
            got = found[c]
            assert (got.kind, got.n_rows, got.n_nulls) == (want.kind, want.n_rows, want.n_nulls)
            assert abs(got.n_distinct - want.n_distinct) <= 4 * sketch.standard_error() * want.n_distinct
    assert found["few"].n_distinct == 7 and found["bytes"].n_distinct == 2 and found["none"].n_distinct == 0
    assert audit.column_profile(df.limit(0), exact=False).count() == 0


def test_sketches_shuffle_a_row_for_each_task(session):
    plan = audit.column_profile(session.range(1000), exact=False)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan.split("Exchange")[-1]
