import dataclasses
import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillroll.operators.skew import HotRule
from tillroll.plans import incremental as inc
from tillroll.plans import presellout as pre

HOT = HotRule(min_rows=0)
SILVER = (
    "data string, cnpj string, codigobarras string, descproduto string, valor string, "
    "year int, month int, day int"
)
ASOF = dt.date(2024, 1, 20)
# The small feed below has not all the columns the gold table selects.
SALE = dataclasses.replace(inc.VIRTUAL_SALE_GOLD, select=None)


def silver(spark):
    return spark.createDataFrame(
        [
            ("2024-01-01", "1", "7", "A", "old", 2024, 1, 1),
            ("2024-01-01", "1", "7", "A", "new", 2024, 1, 15),
            ("2024-01-01", "2", "7", "A", "only", 2024, 1, 2),
            ("2024-01-01", "3", "7", "A", "late", 2024, 1, 19),
            ("2024-01-01", "4", "7", "A", "bad day", 2024, 13, 1),
        ],
        SILVER,
    )


@pytest.mark.parametrize("rule", [None, HOT], ids=["plain", "hot"])
def test_gold_is_the_same_when_built_again(spark, rule):
    spec = SALE
    first = inc.build_gold(silver(spark).where("day < 10 and month = 1"), spec, ASOF, rule=rule)
    assert {r["VALOR"] for r in first.collect()} == {"old", "only"}
    second = inc.build_gold(silver(spark), spec, ASOF, first, rule)
    assert {r["VALOR"] for r in second.collect()} == {"new", "only", "late"}
    third = inc.build_gold(silver(spark), spec, ASOF, second, rule)
    assert rows(third) == rows(second)


def test_untouched_dates_skip_the_merge(spark):
    """The same gold with and without the split, NULL dates included."""
    other = [
        ("2023-05-05", "9", "7", "A", "kept", 2023, 5, 6),
        (None, "9", "7", "A", "null old", 2024, 1, 3),
        (None, "9", "7", "A", "null new", 2024, 1, 16),
    ]
    df = silver(spark).unionByName(spark.createDataFrame(other, SILVER))
    spec = SALE
    gold = inc.build_gold(df.where("day < 10"), spec, ASOF)
    split = inc.build_gold(df, spec, ASOF, gold, gold_is_clean=True)
    whole = inc.build_gold(df, spec, ASOF, gold)
    assert rows(split) == rows(whole)
    assert {r["VALOR"] for r in split.collect()} == {"new", "only", "late", "kept", "null new"}


@pytest.mark.parametrize("one_row", [True, False])
def test_unclean_gold_is_cleaned_on_all_dates(spark, one_row):
    """Stale and equal gold rows of a date the snapshot does not have."""
    spec = dataclasses.replace(SALE, first_load_one_row=one_row)
    old = [
        ("2023-05-05", "9", "7", "A", "stale", 2023, 5, 6),
        ("2023-05-05", "9", "7", "A", "newest", 2023, 5, 8),
        ("2023-05-05", "9", "7", "A", "newest", 2023, 5, 8),
    ]
    gold = inc.read_silver(spark.createDataFrame(old, SILVER), spec, ASOF, full_load=True)
    got = inc.build_gold(silver(spark), spec, ASOF, gold)
    assert sorted(r["VALOR"] for r in got.collect()) == ["late", "new", "newest"]


def test_a_merge_with_gold_shuffles_once_per_row(session, tmp_path):
    paths = [str(tmp_path / name) for name in ("silver", "gold")]
    silver(session).write.parquet(paths[0])
    inc.build_gold(silver(session), SALE, ASOF).write.parquet(paths[1])
    frames = [session.read.parquet(path) for path in paths]
    got = inc.build_gold(frames[0], SALE, ASOF, frames[1])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_gold_selects_its_columns(spark):
    names = [*inc.VIRTUAL_SALE_COLUMNS, "other"]
    row = tuple("2024-01-01" if n == "data" else n for n in names)
    kinds = ", ".join(f"`{n}` string" for n in names) + ", year int, month int, day int"
    df = spark.createDataFrame([(*row, 2024, 1, 15)], kinds)
    got = inc.build_gold(df, inc.VIRTUAL_SALE_GOLD, ASOF)
    assert got.columns == [*[c.upper() for c in inc.VIRTUAL_SALE_COLUMNS], "INGESTION_DATE"]


def test_gold_meets_silver_by_name(session):
    spec = SALE
    gold = inc.build_gold(silver(session).where("month = 1"), spec, ASOF)
    shuffled = gold.select(*sorted(gold.columns))
    assert rows(inc.build_gold(silver(session), spec, ASOF, shuffled).select(*gold.columns)) == rows(
        inc.build_gold(silver(session), spec, ASOF, gold)
    )


def test_a_silver_look_back_prunes_partitions(session, tmp_path):
    path = str(tmp_path / "silver")
    silver(session).write.partitionBy("year", "month", "day").parquet(path)
    df = inc.read_silver(session.read.parquet(path), SALE, ASOF, full_load=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(" in plan
    assert "PartitionFilters: []" not in plan
    assert {r["VALOR"] for r in df.collect()} == {"new", "late"}


def test_gold_shuffles_once_per_row(session, tmp_path):
    """Newest version and whole-row dedup share one partitioning."""
    path = str(tmp_path / "silver")
    silver(session).write.parquet(path)
    spec = inc.GoldSpec(keys=("CNPJ", "DATA"), look_back=inc.last_days(7))
    gold = inc.build_gold(session.read.parquet(path), spec, ASOF)
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_banner_rows_are_cleaned(spark):
    df = spark.createDataFrame(
        [
            ("v", "Dia", "1", "7", "A", "1", "1", 2024, 1, 1),
            ("v", "28/06/2024", "1", "7", "A", "0,00", "-1,00", 2024, 1, 1),
            ("v", "28/06/2024", "1", "7", "A", "1,5", "x", 2024, 1, 1),
            ("v", "2024-06-28", "1", "7", "A", "1,5", "x", 2024, 1, 1),
            ("v", "junk", "1", "7", "A", "0", "0", 2024, 1, 1),
        ],
        "codigo_varejo string, dia string, cnpj string, ean_produto_varejo string, "
        "descricao_produto_varejo string, quantidade_venda_unidade string, "
        "quantidade_estoque_unidade string, year int, month int, day int",
    )
    got = inc.build_gold(df, inc.BANNER_GOLD, ASOF).select("DIA", "QUANTIDADE_VENDA_UNIDADE")
    assert rows(got) == [(dt.date(1900, 1, 1), "0"), (dt.date(2024, 6, 28), "1,5")]


def sale_feed(spark):
    return spark.createDataFrame(
        [
            ("2024-06-28", "1", "bebida", "Skol", "7891.0", "1,5", "10,0", "Sim", None, "Concorrente"),
            ("2024-06-28", "1", "bebida", "skol", "7891", "2", "junk", "sim", "3", "concorrente"),
            (None, "NaN", None, None, "x", None, None, None, "1,25", "Outro"),
            ("junk", "1", "a", "b", "1", "1", "1", "nao", "1", "x"),
        ],
        "DATA string, CNPJ string, SECAO string, DESCPRODUTO string, CODIGOBARRAS string, "
        "QUANTIDADEVENDA string, VALORVENDA string, VENDAVIRTUAL string, QUANTIDADEESTOQUE string, "
        "TIPO string",
    )


def test_standard_fact(spark):
    fact = pre.standardise(sale_feed(spark), pre.VIRTUAL_SALE_FEED, dt.date(2024, 8, 1))
    assert [(f.name, f.dataType) for f in fact.schema] == list(pre.FACT_TYPES.items())
    got = {r["DATA"]: r for r in fact.collect()}
    assert set(got) == {dt.date(2024, 6, 28), dt.date(1900, 1, 1)}
    sale = got[dt.date(2024, 6, 28)]
    assert sale["SALES_VOLUME_SELLOUT"] == Decimal("3.5") and sale["REVENUE_SELLOUT"] == 10
    assert sale["COMPANY"] == "OUTRO FABRICANTE" and sale["ID_PDV_ECOMMERCE"] == "S"
    assert sale["PRODUCT_SOURCE_CODE"] == 7891 and sale["dia_partition"] == 28
    empty = got[dt.date(1900, 1, 1)]
    assert empty["CATEGORY"] == "NAO INFORMADO" and empty["CNPJ_PDV"] == 0
    assert empty["CXA"] is None and empty["CHECKOUT"] == 0


def test_the_fact_keeps_totals(session):
    fact = pre.standardise(sale_feed(session), pre.VIRTUAL_SALE_FEED, dt.date(2024, 8, 1))
    assert fact.agg(F.sum("QUANTITY_STOCK_UNIT")).first()[0] == Decimal("4.25")


def test_window_of_the_fact(session):
    fact = pre.standardise(sale_feed(session), pre.VIRTUAL_SALE_FEED, dt.date(2024, 7, 2))
    assert [r["DATA"] for r in fact.collect()] == [dt.date(2024, 6, 28)]
    every = pre.standardise(sale_feed(session), pre.VIRTUAL_SALE_FEED, dt.date(2024, 7, 2), None)
    assert every.count() == 2


def test_own_company_feed_is_not_summed(spark):
    df = spark.createDataFrame(
        [("28/06/2024", "1", "7", "a", "1", "2", "3", "c", "Ambev", "b")] * 2
        + [("28/06/2024", "1", "7", "a", "1", "2", "3", "c", None, "b")],
        "DATA_VENDA string, CNPJ_LOJA string, EAN string, PRODUCT_SOURCE_NAME string, "
        "VOLUME_UNIT string, PACK_QUANTITY string, FATURAMENTO string, CATEGORY string, "
        "COMPANY string, BRAND_ID string",
    )
    fact = pre.standardise(df, pre.OWN_COMPANY_FEED, dt.date(2024, 7, 1))
    assert fact.count() == 2
    assert rows(fact.select("ID_PDV_ECOMMERCE", "PDV_COMPANY_NAME").distinct()) == [("N", "AMBEV")]


def test_the_fact_reads_only_its_columns(session, tmp_path):
    path = str(tmp_path / "feed")
    sale_feed(session).withColumn("unused", F.lit(1)).write.parquet(path)
    fact = pre.standardise(session.read.parquet(path), pre.VIRTUAL_SALE_FEED, dt.date(2024, 8, 1))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan
    assert plan.count("Exchange") == 1 and "partial_try_sum" in plan or "partial_sum" in plan
