"""Incremental gold build: newest ingestion wins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.parse import (
    day_any_format,
    ingestion_day,
    locale_decimal,
    nan_text_to_null,
)
from tillroll.operators import filters as keep
from tillroll.operators.dedup import first_per_key, newest_per_key, split_repeated, total_order
from tillroll.operators.shape import INGESTION_PARTITION, drop_columns, upper_names
from tillroll.operators.skew import DEFAULT_RULE, HotRule
from tillroll.session import cut_lineage

INGESTION = "INGESTION_DATE"


@dataclass(frozen=True)
class GoldSpec:
    """What differs between the gold tables.

    ``look_back`` narrows the silver snapshot of an incremental run and
    ``prepare`` cleans it. ``first_load_one_row`` keeps one row per key on the
    silver side instead of all rows of the newest ingestion. The rows kept in
    gold are those of the newest ingestion per key, without equal rows.
    ``touched_by`` is a key column with few values in one run, a date.
    """

    keys: tuple[str, ...]
    look_back: Callable[[DataFrame, dt.date], DataFrame]
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df
    first_load_one_row: bool = False
    select: tuple[str, ...] | None = None
    touched_by: str | None = None


def with_ingestion_day(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_date", ingestion_day())


def read_silver(
    silver: DataFrame, spec: GoldSpec, asof: dt.date, full_load: bool
) -> DataFrame:
    dated = with_ingestion_day(silver)
    if not full_load:
        dated = spec.look_back(dated, asof)
    if spec.select is not None:
        dated = dated.select(*spec.select, "ingestion_date")
    return spec.prepare(upper_names(drop_columns(dated, INGESTION_PARTITION)))


def build_gold(
    silver: DataFrame,
    spec: GoldSpec,
    asof: dt.date,
    gold: DataFrame | None = None,
    rule: HotRule | None = DEFAULT_RULE,
    gold_is_clean: bool = False,
    silver_is_stored: bool = False,
) -> DataFrame:
    """First load without ``gold``; else silver merged into it.

    The newest version of each key is taken over all gold and fresh rows, and
    equal rows collapse. ``gold_is_clean`` is the caller's statement that gold
    is an earlier result of this function: its rows of dates the snapshot does
    not have then skip the merge (where the spec names the date). On gold of any
    other origin that would keep stale and repeated rows. ``silver_is_stored`` is the
    statement that silver is a table, which costs little to read more than once.

    The result replaces the gold table: running again on it changes nothing.
    """
    keys = list(spec.keys)
    fresh = read_silver(silver, spec, asof, full_load=gold is None)
    if gold is None:
        if spec.first_load_one_row:
            alone, rest = split_repeated(fresh, keys) if silver_is_stored else (None, fresh)
            first = first_per_key(rest, keys, [F.col(INGESTION).desc_nulls_last()])
            return first if alone is None else alone.unionByName(first)
        return newest_per_key(fresh, keys, INGESTION, distinct=True, rule=rule)
    if spec.first_load_one_row and not silver_is_stored:
        fresh = cut_lineage(fresh)
    if not gold_is_clean or spec.touched_by is None:
        return merge_newest(gold, fresh, spec, rule)
    values = fresh.select(F.col(spec.touched_by).alias("_touched")).distinct()
    same = F.col(spec.touched_by).eqNullSafe(F.col("_touched"))
    touched = gold.join(values, same, "left_semi")
    untouched = gold.where(F.col(INGESTION).isNotNull()).join(values, same, "left_anti")
    return untouched.unionByName(merge_newest(touched, fresh, spec, rule))


def merge_newest(
    gold: DataFrame, fresh: DataFrame, spec: GoldSpec, rule: HotRule | None
) -> DataFrame:
    """The newest version of each key over both sides, equal rows once.

    Where the fresh side counts with one row per key, both sides are stored tables, and
    a row whose key no other row of either side has is taken as it is: most of gold is
    not shuffled. Of the others, the fresh row is chosen among
    its rows of the newest ingestion: the windows and the dedup then share the one
    partitioning by key, and ranks are cut per task before the shuffle. For that cut a
    task sorts its rows. A stored split may unpack to many times its size, so they are
    rebalanced first: a task sorts about as many bytes, however large gold is.
    """
    keys = list(spec.keys)
    if not spec.first_load_one_row:
        return newest_per_key(
            gold.unionByName(fresh), keys, INGESTION, distinct=True, rule=rule
        )
    order = total_order(fresh, [], keys)
    both = gold.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)))
    alone, rest = split_repeated(both.where(F.col(INGESTION).isNotNull()), keys)
    newest = newest_per_key(rest.hint("rebalance"), keys, INGESTION, rule=None)
    one = Window.partitionBy(*keys, "_fresh").orderBy(*order)
    merged = (
        newest.withColumn("_n", F.row_number().over(one))
        .where("not _fresh or _n = 1")
        .drop("_fresh", "_n")
        .dropDuplicates()
    )
    return merged if alone is None else alone.drop("_fresh").unionByName(merged)


def last_days(days: int) -> Callable[[DataFrame, dt.date], DataFrame]:
    return lambda df, asof: keep.ingested_since(df, "ingestion_date", asof, days)


def last_snapshots(n: int) -> Callable[[DataFrame, dt.date], DataFrame]:
    return lambda df, _asof: keep.last_ingestions(df, "ingestion_date", n)


def _clean_banner_rows(df: DataFrame) -> DataFrame:
    rows = keep.without_header_rows(df, "DIA", "Dia")
    rows = rows.withColumn("DIA", day_any_format("DIA"))
    return keep.sold_or_stocked(rows, "QUANTIDADE_VENDA_UNIDADE", "QUANTIDADE_ESTOQUE_UNIDADE")


def _clean_pack_rows(df: DataFrame) -> DataFrame:
    return nan_text_to_null(df)


def _decimal_measures(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: locale_decimal(c) for c in ("VOLUME_UNIT", "PACK_QUANTITY", "FATURAMENTO")}
    )


# The four gold tables. Keys, look-backs and columns are fixed values. ---------
VIRTUAL_SALE_COLUMNS = (
    "data", "cnpj", "desc", "secao", "descproduto", "codigobarras", "quantidadevenda",
    "valorvenda", "vendavirtual", "quantidadeestoque", "tipo",
)
VIRTUAL_SALE_GOLD = GoldSpec(
    keys=("CNPJ", "CODIGOBARRAS", "DESCPRODUTO", "DATA"),
    look_back=last_days(7),
    first_load_one_row=True,
    select=VIRTUAL_SALE_COLUMNS,
    touched_by="DATA",
)
OWN_COMPANY_GOLD = GoldSpec(
    keys=(
        "DATA_VENDA", "CNPJ_LOJA", "EAN", "PRODUCT_SOURCE_NAME", "VOLUME_UNIT", "MEA_UNIT",
        "PACK_QUANTITY",
    ),
    look_back=last_days(10),
    prepare=_decimal_measures,
    first_load_one_row=True,
    touched_by="DATA_VENDA",
)
BANNER_GOLD = GoldSpec(
    keys=("CODIGO_VAREJO", "DIA", "CNPJ", "EAN_PRODUTO_VAREJO", "DESCRICAO_PRODUTO_VAREJO"),
    look_back=last_days(7),
    prepare=_clean_banner_rows,
    touched_by="DIA",
)
PACK_UNIT_GOLD = GoldSpec(
    keys=("DATA", "CNPJ", "CODIGO_BARRA", "DESCRICAO"),
    look_back=last_snapshots(4),
    prepare=_clean_pack_rows,
    touched_by="DATA",
)
