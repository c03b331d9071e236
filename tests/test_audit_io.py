import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import audit
from tillroll.plans import backfill as bf
from tillroll.plans.layer_audit import audit_layer
from tillroll.session import cut_lineage, scratch_path, shared_folder
from tillroll.sources import readers, writers

D = [dt.date(2024, 1, d) for d in range(1, 7)]


def test_counts_ranges_totals(spark):
    df = spark.createDataFrame([(D[0], "1,5"), (D[0], "2"), (D[2], None)], "d date, v string")
    value = F.translate(F.coalesce("v", F.lit("0")), ",", ".").try_cast("decimal(38,6)")
    assert rows(audit.count_by(df, day="d")) == [(D[0], 2), (D[2], 1)]
    assert rows(audit.range_profile(df, "d")) == [(D[0], D[2], 3)]
    assert rows(audit.control_totals(df, {"day": "d"}, {"t": value})) == [
        (D[0], 2, Decimal("3.500000")), (D[2], 1, Decimal("0.000000")),
    ]
    assert rows(audit.missing_days(df, "d")) == [(D[1],)]
    assert rows(audit.share_of_total(df.select("v"), "v")) == [("1,5", 1, 3), ("2", 1, 3), (None, 1, 3)]


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5), (None, 1)], "k string, v int")
    b = spark.createDataFrame([("x", 3), ("z", 4), (None, 1)], "k string, v int")
    got = audit.reconcile(a, b, {"k": "k"}, {"t": F.col("v").cast("decimal(38,6)")})
    shown = got.select("k", "difference_n_rows", F.col("difference_t").cast("int"))
    assert rows(shown) == [("x", 1, 0), ("y", 1, 5), ("z", -1, -4), (None, 0, 0)]


def test_row_differences(spark):
    a = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "a", 1), (2, "x", None), (4, "d", 4)], "k int, s string, n int")
    assert rows(audit.row_differences(a, b, ["k"], ["s", "n"])) == [
        (2, "both", "s", "b", "x"), (3, "left", "n", "3", None), (3, "left", "s", "c", None),
        (4, "right", "n", None, "4"), (4, "right", "s", None, "d"),
    ]
    assert rows(audit.row_equality(a, b, ["k"], ["s", "n"])) == [(1, True, True), (2, False, True)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "n int, s string")
    got = audit.column_profile(df)
    assert rows(got) == [("n", "int", 3, 0, 2), ("s", "string", 3, 2, 1)]


def test_layer_audit_is_lazy_and_complete(session):
    df = session.createDataFrame([(D[0], "s1", 1), (D[0], "s1", 1)], "d date, s string, v int")
    checks = audit_layer(
        df, {"p": "s"}, F.col("d"), ["s"], {"t": "v"}, store={"store": "s"}, source_file="s"
    )
    assert rows(checks["duplicate_keys"]) == [("s1", 2)]
    assert rows(checks["totals_per_store"]) == [("s1", 2, 2)]
    assert rows(checks["rows_per_file"]) == [("s1", "s1", 2)]


def test_required_table(session, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_required_table(session, "no_such_table")
    empty = session.createDataFrame([], "a int")
    readers.register_view(empty, "empty_view")
    with pytest.raises(ValueError):
        readers.read_required_table(session, "empty_view")
    readers.register_view(session.range(2).toDF("a"), "full_view")
    assert readers.read_required_table(session, "full_view").count() == 2
    assert readers.read_table(session, "full_view").count() == 2


def test_files_with_drifting_columns(session, tmp_path):
    root = str(tmp_path)
    session.createDataFrame([(1, "a")], "k int, old string").write.parquet(f"{root}/2021_x")
    session.createDataFrame([(2, "b")], "k int, new string").write.parquet(f"{root}/2022_x")
    years = readers.read_years(session, [f"{root}/2021*", f"{root}/2022*"])
    assert rows(years.select("k", "old", "new")) == [(1, "a", None), (2, None, "b")]
    both = readers.read_files(session, [f"{root}/2021_x", f"{root}/2022_x"], merge_schema=True)
    assert rows(both.select("k", "old", "new")) == rows(years.select("k", "old", "new"))
    assert readers.read_zone(session, root, "2021_x", "").count() == 1
    assert readers.read_path_sql(session, f"{root}/2021_x").count() == 1
    assert readers.inline_rows(session, [(1,)], ["a"]).count() == 1


def test_replacing_partitions_leaves_the_others(session, tmp_path):
    path = str(tmp_path / "fact")
    part = ("ano_partition", "mes_partition", "dia_partition")
    cols = "v string, ano_partition int, mes_partition int, dia_partition int"
    writers.overwrite_partitions(
        session.createDataFrame([("a", 2024, 1, 1), ("b", 2024, 1, 2)], cols), path
    )
    again = session.createDataFrame([("c", 2024, 1, 2)], cols)
    writers.overwrite_partitions(again, path)
    writers.overwrite_partitions(again, path)
    assert rows(session.read.parquet(path).select("v", *part)) == [
        ("a", 2024, 1, 1), ("c", 2024, 1, 2),
    ]
    writers.append_partitioned(again, path, part)
    assert session.read.parquet(path).count() == 3


def test_tables(session, tmp_path):
    session.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path / 'shop'}'")
    cols = "v string, ano_partition int, mes_partition int, dia_partition int"
    first = session.createDataFrame([("a", 2024, 1, 1), ("b", 2024, 1, 2)], cols)
    writers.overwrite_partitions_of_table(first, "shop.fact")
    writers.overwrite_partitions_of_table(
        session.createDataFrame([("c", 2024, 1, 2)], cols), "shop.fact"
    )
    assert rows(readers.read_table(session, "shop.fact").select("v")) == [("a",), ("c",)]
    writers.overwrite_table(first, "shop.plain")
    writers.overwrite_table(first.limit(1), "shop.plain")
    assert readers.read_required_table(session, "shop.plain").count() == 1
    session.sql("DROP DATABASE shop CASCADE")


def history(spark):
    return spark.createDataFrame(
        [
            ("01/07/2024", "f1", "2024-07-02", "", "x"), ("01/07/2024", "f2", "2024-07-02", "", "x"),
            ("05/07/2024", "f1", "2024-07-06", "", "x"), ("01/07/2024", "f1", "2024-07-16", "2024", "x"),
        ],
        "DATA string, filename string, createdDate string, updatedDate string, lastReceived string",
    )


def test_backfill(spark, tmp_path):
    source, bronze, silver = (str(tmp_path / n) for n in ("source", "bronze", "silver"))
    history(spark).write.parquet(source)
    spec = bf.HISTORIES["sales_by_day_2024_07_04"]
    bf.backfill(spark, source, spec, bronze, silver)
    for path in (bronze, silver):
        back = spark.read.parquet(path)
        assert sorted(back.columns) == ["data", "day", "month", "year"]
        assert rows(back.groupBy("day").count()) == [(16, 1), (2, 2)]


def test_backfill_variants(session, tmp_path):
    current = bf.shape_history(history(session), bf.HISTORIES["current_stock_2024_09_19"])
    assert current.columns == ["year", "month", "day"] and current.count() == 3
    catalogue = bf.HISTORIES["current_catalogue"]
    bf.write_history(bf.shape_history(history(session), catalogue), catalogue, str(tmp_path / "c"))
    assert session.read.parquet(str(tmp_path / "c")).columns == ["DATA"]
    iso = session.createDataFrame(
        [("2023-05-15", "f1"), ("2023-05-15", "f2"), ("2023-05-16", "f1"), ("2024-01-01", "f1")],
        "DATA string, filename string",
    )
    half = bf.shape_history(iso, bf.HISTORIES["half_months"])
    assert rows(half) == [("2023-05-15", 2023, 5, 1), ("2023-05-16", 2023, 5, 16)]


def test_shared_folder(session):
    assert shared_folder(session) == shared_folder(session)
    assert scratch_path(session, "a") != scratch_path(session, "a")
    assert cut_lineage(session.range(3)).count() == 3


def test_steps_are_stored_and_removed(session):
    from pathlib import Path

    from tillroll.session import cut_lineage, remove_steps, shared_folder

    folder = Path(shared_folder(session).removeprefix("file:"))
    remove_steps(session)
    before = set(folder.glob("step-*"))
    assert cut_lineage(session.range(5)).count() == 5
    assert len(set(folder.glob("step-*")) - before) == 1
    remove_steps(session)
    assert set(folder.glob("step-*")) == before


def test_years_as_declared(spark):
    root = scratch_path(spark, "years")
    first = [("1", "1,5", "2024-01-01", "x"), ("two", "bad", None, "x"), (None, None, "?", "x"), (str(2**40), "-2", "2024-01-02 10:00", "x")]
    spark.createDataFrame(first, "K string, v string, d string, extra string").write.parquet(f"{root}/2021_x")
    second = spark.createDataFrame([(2**40, 2.25, [1]), (7, float("nan"), None)], "k long, v double, d array<int>")
    second.drop("d").write.parquet(f"{root}/2022_x")
    third = spark.createDataFrame([(dt.date(2024, 1, 3), Decimal("123456.78"))], "d date, v decimal(10,2)")
    third.write.parquet(f"{root}/2023_x")
    schema = T.StructType.fromDDL("k int, v decimal(6,2), d date, n string")
    globs = [f"{root}/{y}*" for y in (2021, 2022, 2023)]
    got = readers.read_years_as(spark, globs, schema, from_text={"v": lambda c: F.translate(c, ",", ".")})
    assert got.columns == ["k", "v", "d", "n", "misfits"] and got.drop("misfits").dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    assert rows(got) == sorted(
        [
            (1, Decimal("1.50"), dt.date(2024, 1, 1), None, []), (None, None, None, None, ["k", "v"]), (None, None, None, None, ["d"]),
            (None, Decimal("-2.00"), dt.date(2024, 1, 2), None, ["k"]), (None, Decimal("2.25"), None, None, ["k"]), (7, None, None, None, ["v"]),
            (None, None, dt.date(2024, 1, 3), None, ["v"]),
        ],
        key=repr,
    )
    assert rows(readers.count_misfits(got)) == [("d", 1), ("k", 3), ("v", 3)]
    assert readers.undeclared_columns(spark, globs, schema) == {globs[0]: ["extra"]}


def test_table_partitions_are_replaced_in_a_session_of_their_own(session):
    name = "fact_of_a_test"
    data = session.createDataFrame([(1, 2024), (2, 2025)], "k int, year int")
    session.conf.set("spark.sql.session.timeZone", "America/Recife")
    session.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        seen = []
        writers.overwrite_partitions_of_table(data, name, ("year",))
        plain, child = writers._session_with, None

        def watched(*args):
            nonlocal child
            child = plain(*args)
            seen.append((session.conf.get(writers.OVERWRITE_MODE), child.conf.get(writers.OVERWRITE_MODE), child.conf.get("spark.sql.session.timeZone")))
            return child

        writers._session_with = watched
        writers.overwrite_partitions_of_table(session.createDataFrame([(2025, 9)], "year int, k int"), name, ("year",))
        assert seen == [("STATIC", "dynamic", "America/Recife")] and session.conf.get(writers.OVERWRITE_MODE) == "STATIC"
        assert rows(readers.read_table(session, name)) == [(1, 2024), (9, 2025)]
    finally:
        writers._session_with = plain
        session.conf.set("spark.sql.session.timeZone", "UTC")
        session.sql(f"DROP TABLE IF EXISTS {name}")
