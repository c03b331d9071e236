import datetime as dt

import pytest
from helpers import rows, values
from pyspark.sql import functions as F

from tillroll.operators import filters, shape


def test_known_code_keeps_long_codes(spark):
    df = spark.createDataFrame([("7891000000017",), ("0",), ("x",), (None,)], "c string")
    assert rows(filters.known_code(df, "c")) == [("7891000000017",)]


def test_rolling_window(spark):
    days = [dt.date(2024, 8, 20), dt.date(2024, 6, 21), dt.date(2024, 6, 20), dt.date(2024, 8, 21)]
    df = spark.createDataFrame([(d,) for d in days], "DATA date")
    assert filters.rolling_window(df, "DATA", dt.date(2024, 8, 1)).count() == 4
    kept = filters.rolling_window(df, "DATA", dt.date(2024, 8, 20))
    assert rows(kept) == [(dt.date(2024, 6, 21),), (dt.date(2024, 8, 20),)]
    assert filters.rolling_window(df, "DATA", dt.date(2024, 8, 20), None).count() == 4


def test_header_rows_and_nulls_go(spark):
    df = spark.createDataFrame([("Dia",), (None,), ("2024-01-01",)], "DIA string")
    assert rows(filters.without_header_rows(df, "DIA", "Dia")) == [("2024-01-01",)]


def test_sold_or_stocked_is_numeric(spark):
    df = spark.createDataFrame(
        [("0,00", "-1,00"), ("0", "0"), ("0.00", "-1"), ("10", "-5"), ("9", "x")], "s string, t string"
    )
    assert rows(filters.sold_or_stocked(df, "s", "t")) == [("0", "0"), ("10", "-5"), ("9", "x")]


def test_last_ingestions(spark):
    data = [(dt.date(2024, 1, d), n) for d in (1, 2, 3) for n in range(2)] + [(None, 9)]
    df = spark.createDataFrame(data, "ing date, n int")
    kept = filters.last_ingestions(df, "ing", 2)
    assert sorted({r["ing"].day for r in kept.collect()}) == [2, 3]
    assert kept.count() == 4


def test_backfill_filters(spark):
    df = spark.createDataFrame(
        [("03/07/2024", ""), ("04/07/2024", ""), ("01/01/2024", "2024-02-01"), ("junk", "")],
        "data string, updatedDate string",
    )
    cut = dt.date(2024, 7, 4)
    assert filters.before_day(df, "data", "dd/MM/yyyy", cut).count() == 2
    assert rows(filters.current_version(filters.before_day(df, "data", "dd/MM/yyyy", cut))) == [("03/07/2024", "")]


def test_complete_rows(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b")], "x string, y string")
    assert filters.complete_rows(df, ("y",)).count() == 2


def test_point_lookup_reaches_the_scan(session, tmp_path):
    path = str(tmp_path / "t")
    session.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    df = filters.point_lookup(session.read.parquet(path), {"k": 2, "v": "b"})
    plan = df._jdf.queryExecution().toString()
    assert "EqualTo(k,2)" in plan and "EqualTo(v,b)" in plan
    assert rows(df) == [(2, "b")]


def test_half_month(spark):
    days = [dt.date(2024, 1, 15), dt.date(2024, 1, 16)]
    assert values(spark, days, shape.half_month, "date") == [1, 16]


def test_names_and_columns(spark):
    df = spark.createDataFrame([(1, "x", "f")], "` a` int, B string, filename string")
    assert shape.upper_names(df).columns == ["A", "B", "FILENAME"]
    assert shape.lower_names(df).columns == ["a", "b", "filename"]
    assert shape.drop_audit_columns(df).columns == [" a", "B"]
    assert shape.all_except(df, ["b", "missing"]).columns == [" a", "filename"]
    assert shape.rename(df, {"B": "c"}).columns == [" a", "c", "filename"]
    assert shape.keep_original(df, "B").columns[-1] == "B_ORIGINAL"


def test_row_id_is_stable(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    once = rows(shape.with_row_id(df, "id", ["k"]))
    assert once == rows(shape.with_row_id(df.repartition(3), "id", ["k"]))
    assert len({r[2] for r in once}) == 2


@pytest.mark.parametrize("text,hit", [("Loja e-Commerce", True), ("loja", False)])
def test_like_upper(session, text, hit):
    assert values(session, [text], lambda c: filters.like_upper(c, "%COMMERC%")) == [hit]


def test_year_and_days(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),)], "d date")
    assert filters.up_to_year(df, "d", 2023).count() == 1
    assert filters.between_days(df, "d", dt.date(2024, 1, 1), dt.date(2024, 2, 1)).count() == 1
    assert filters.is_null(df, "d").count() == 0
    assert filters.not_null(df.withColumn("d", F.lit(None)), "d").count() == 0
