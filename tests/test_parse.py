import datetime as dt
from decimal import Decimal

from helpers import rows, values
from pyspark.sql import functions as F

from tillroll.functions import parse as p


def test_locale_decimal(spark):
    assert values(spark, ["1,5", None, "1.234,50", "abc"], p.locale_decimal) == [
        Decimal("1.500000"), Decimal("0.000000"), None, None,
    ]


def test_bigint_or_zero(spark):
    inputs = ["NaN", " 12 ", None, "12.7", "7891991002608.0", ""]
    assert values(spark, inputs, p.bigint_or_zero) == [0, 12, 0, 12, 7891991002608, 0]


def test_text_or_default(spark):
    assert values(spark, ["a", None], p.text_or_default) == ["A", "NAO INFORMADO"]


def test_day_formats(spark):
    iso, slash, junk = "2024-06-28", "28/06/2024", "junk"
    day, epoch = dt.date(2024, 6, 28), dt.date(1900, 1, 1)
    inputs = [iso, slash, junk, None, "2024-06-28 10:00:00", "2024-6-3"]
    assert values(spark, inputs, p.day_any_format) == [
        day, day, epoch, epoch, day, dt.date(2024, 6, 3),
    ]
    assert values(spark, [iso, "20240628", None, junk], p.day_compact) == [day, day, epoch, None]
    assert values(spark, [slash, iso, None], p.day_slashed) == [day, None, None]
    assert values(spark, [slash, " 28/06/2024 ", None, iso], p.day_slashed_or_default) == [
        day, day, epoch, None,
    ]


def test_ingestion_day(spark):
    df = spark.createDataFrame([(2024, 9, 3), (2024, 13, 1)], "year int, month int, day int")
    assert [r[0] for r in df.select(p.ingestion_day()).collect()] == [dt.date(2024, 9, 3), None]


def test_unpadded_dates_compare_as_dates(spark):
    df = spark.createDataFrame([("2024-9-30",), ("2024-10-01",)], "d string")
    assert df.agg(F.max(p.day_text("d", "yyyy-M-d"))).first()[0] == dt.date(2024, 10, 1)


def test_nan_text(spark):
    df = spark.createDataFrame([("NaN", "NaN", 1), (None, "x", 2), ("a", "y", 3)], "a string, b string, n int")
    assert rows(p.nan_text_to_null(df, keep=("b",))) == rows(
        spark.createDataFrame([(None, "NaN", 1), (None, "x", 2), ("a", "y", 3)], df.schema)
    )


def test_multiplier_and_per_pack(spark):
    inputs = ["12 X 2", "12", "0 X 2", None]
    assert values(spark, inputs, lambda c: p.multiplier_part(c, 1)) == [
        Decimal("2.000000"), None, Decimal("2.000000"), None,
    ]
    packs = values(
        spark, inputs,
        lambda c: p.per_pack(
            F.lit(100).cast(p.MEASURE), p.multiplier_part(c, 0), p.multiplier_part(c, 1)
        ),
    )
    assert packs == [Decimal("4.166667"), None, None, None]


def test_flags_and_labels(spark):
    assert values(spark, ["Sim", "nao", None], lambda c: p.yes_no(p.equals_upper(c, "SIM"))) == [
        "S", "N", "N",
    ]
    assert values(
        spark, ["Concorrente", "x", None], lambda c: p.relabel(c, {"CONCORRENTE": "OUTRO"})
    ) == ["OUTRO", "X", None]


def test_single_space(spark):
    assert values(spark, ["  a   b  c ", "a"], p.single_space) == ["a b c", "a"]


def test_fill_when(spark):
    assert values(spark, [None, "2"], lambda c: p.fill_when(c, F.lit(True), "1")) == ["1", "2"]
    assert values(spark, [None, "2"], lambda c: p.fill_when(c, F.lit(False), "1")) == [None, "2"]
