"""Incremental gold tables, newest versions, look-backs and feed clean-up."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from tillroll.functions import parse as p
from tillroll.operators import audit, dedup, filters, shape
from tillroll.plans import incremental as plan
from tillroll.session import cut_lineage
from tillroll.workload import feeds
from tillroll.workload.feeds import CODE_BASE, comma_text, text, with_ingestion
from tillroll.workload.tables import comma, day, dec, spread, table

# The small feed below has not all the columns the gold table selects.
SALE_GOLD = dataclasses.replace(plan.VIRTUAL_SALE_GOLD, select=None)
GOLD_CUT = dt.date(2000, 6, 1)
ASOF = dt.date(2001, 8, 1)


def _stored(silver, spec, asof, silver_is_stored=False):
    """The gold table of an earlier run, as stored."""
    return cut_lineage(plan.build_gold(silver, spec, asof, silver_is_stored=silver_is_stored))


# Virtual-sale feed: few products and months, so keys come back often. --------
def _sale_silver(spark, folder):
    lines = spread(table(spark, folder, "lineitem")).join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    rows = lines.select(
        F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("data"),
        text("l_linenumber").alias("cnpj"),
        F.col("o_orderpriority").alias("secao"),
        F.col("l_returnflag").alias("descproduto"),
        feeds.code_text("l_linenumber").alias("codigobarras"),
        comma_text("l_quantity").alias("quantidadevenda"),
        "o_orderdate",
    )
    return with_ingestion(rows, F.col("o_orderdate")).drop("o_orderdate")


_SALE_SILVER = f"""
  select strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') as "DATA",
         cast(l_linenumber as varchar) as CNPJ,
         o_orderpriority as SECAO,
         l_returnflag as DESCPRODUTO,
         cast({CODE_BASE} + l_linenumber as varchar) as CODIGOBARRAS,
         {comma('l_quantity')} as QUANTIDADEVENDA,
         cast(o_orderdate as date) as INGESTION_DATE
  from lineitem join orders on l_orderkey = o_orderkey
"""
_SALE_KEYS = "CNPJ, CODIGOBARRAS, DESCPRODUTO, DATA"
_SALE_REST = "SECAO nulls first, QUANTIDADEVENDA nulls first, INGESTION_DATE nulls first"
_SALE_FIRST = (
    f"qualify row_number() over (partition by {_SALE_KEYS} "
    f"order by INGESTION_DATE desc nulls last, {_SALE_REST}) = 1"
)


def _newest(keys: str) -> str:
    return (
        f"qualify INGESTION_DATE = max(INGESTION_DATE) over (partition by {keys})"
    )


def gold_first_load(spark, folder):
    return plan.build_gold(_sale_silver(spark, folder), SALE_GOLD, ASOF)


def gold_incremental_latest(spark, folder):
    """A first load up to a cut, then a later run over the last days."""
    silver = _sale_silver(spark, folder)
    early = silver.where(p.ingestion_day() < F.lit(GOLD_CUT))
    gold = _stored(early, SALE_GOLD, GOLD_CUT)
    return plan.build_gold(silver, SALE_GOLD, ASOF, gold, gold_is_clean=True)


def gold_unclean_history(spark, folder):
    """Gold loaded by appending history, twice: stale and repeated rows of all dates.

    The silver side has a column the gold table does not select.
    """
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    rows = lines.select(
        F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("data"),
        text("l_linenumber").alias("cnpj"),
        F.col("l_linestatus").alias("desc"),
        F.col("o_orderpriority").alias("secao"),
        F.col("l_returnflag").alias("descproduto"),
        feeds.code_text("l_linenumber").alias("codigobarras"),
        comma_text("l_quantity").alias("quantidadevenda"),
        comma_text("l_extendedprice").alias("valorvenda"),
        F.lit("nao").alias("vendavirtual"),
        comma_text("l_tax").alias("quantidadeestoque"),
        F.col("o_orderstatus").alias("tipo"),
        text("l_partkey").alias("not_selected"),
        "o_orderdate",
    )
    silver = with_ingestion(rows, F.col("o_orderdate")).drop("o_orderdate")
    spec = plan.VIRTUAL_SALE_GOLD
    early = silver.where(p.ingestion_day() < F.lit(GOLD_CUT))
    history = plan.read_silver(early, spec, GOLD_CUT, full_load=True)
    gold = cut_lineage(history.unionByName(history))
    return plan.build_gold(silver, spec, ASOF, gold)


_WIDE_SILVER = f"""
  select strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') as "DATA",
         cast(l_linenumber as varchar) as CNPJ, l_linestatus as "DESC", o_orderpriority as SECAO,
         l_returnflag as DESCPRODUTO, cast({CODE_BASE} + l_linenumber as varchar) as CODIGOBARRAS,
         {comma('l_quantity')} as QUANTIDADEVENDA, {comma('l_extendedprice')} as VALORVENDA,
         'nao' as VENDAVIRTUAL, {comma('l_tax')} as QUANTIDADEESTOQUE, o_orderstatus as TIPO,
         cast(o_orderdate as date) as INGESTION_DATE
  from lineitem join orders on l_orderkey = o_orderkey
"""
_WIDE_FIRST = (
    f"qualify row_number() over (partition by {_SALE_KEYS} order by INGESTION_DATE desc nulls last, "
    '"DESC" nulls first, SECAO nulls first, QUANTIDADEVENDA nulls first, VALORVENDA nulls first, '
    "VENDAVIRTUAL nulls first, QUANTIDADEESTOQUE nulls first, TIPO nulls first) = 1"
)


# Banner feed -----------------------------------------------------------------
def _banner_silver(spark, folder):
    feed = feeds.banner_feed(spark, folder)
    any_day = p.day_any_format("DIA")
    return with_ingestion(feed, F.add_months(any_day, 1)).withColumn(
        "EAN_PRODUTO_VAREJO", F.lit("1")
    ).drop("BANDEIRA", "DESCRICAO_LOCAL").withColumn(
        "DIA",
        F.when(F.col("DIA") == "Dia", "Dia").otherwise(
            F.date_format(F.trunc(any_day, "year"), "yyyy-MM-dd")
        ),
    )


_ANY_DAY = (
    f"coalesce({day('DIA', '%Y-%m-%d')}, {day('DIA', '%d/%m/%Y')}, date '1900-01-01')"
)
_BANNER_KEYS = "CODIGO_VAREJO, DIA, CNPJ, EAN_PRODUTO_VAREJO, DESCRICAO_PRODUTO_VAREJO"
_BANNER_SILVER = f"""
  select * exclude (DIA, EAN_PRODUTO_VAREJO, BANDEIRA, DESCRICAO_LOCAL),
         case when DIA = 'Dia' then 'Dia'
              else strftime(date_trunc('year', {_ANY_DAY}), '%Y-%m-%d') end as DIA,
         '1' as EAN_PRODUTO_VAREJO,
         cast({_ANY_DAY} + interval 1 month as date) as INGESTION_DATE
  from ({feeds.BANNER_SQL})
"""
_BANNER_CLEAN = f"""
  select * exclude (DIA), {_ANY_DAY} as DIA from ({_BANNER_SILVER})
  where DIA <> 'Dia'
    and ({dec('QUANTIDADE_VENDA_UNIDADE')} > 0 or {dec('QUANTIDADE_ESTOQUE_UNIDADE')} >= 0)
"""


def gold_banner_load(spark, folder):
    return plan.build_gold(_banner_silver(spark, folder), plan.BANNER_GOLD, ASOF)


def gold_banner_incremental(spark, folder):
    silver = _banner_silver(spark, folder)
    early = silver.where(p.ingestion_day() < F.lit(GOLD_CUT))
    gold = _stored(early, plan.BANNER_GOLD, GOLD_CUT)
    return plan.build_gold(silver, plan.BANNER_GOLD, ASOF, gold, gold_is_clean=True)


# Pack-unit feed: the last four snapshots of events. ----------------------------
def _snapshot_silver(spark, folder):
    rows = table(spark, folder, "events").select(
        F.lit("01/01/2024").alias("data"),
        text("user_id").alias("cnpj"),
        F.when(F.col("event_type") == "error", "NaN").otherwise(F.col("event_type")).alias(
            "codigo_barra"
        ),
        F.col("event_type").alias("descricao"),
        F.when(F.col("value") < 5, "NaN").otherwise(F.col("props")).alias("mult"),
        "ts",
    )
    return with_ingestion(rows, F.col("ts")).drop("ts")


_SNAPSHOT_SILVER = """
  select '01/01/2024' as DATA,
         cast(user_id as varchar) as CNPJ,
         nullif(case when event_type = 'error' then 'NaN' else event_type end, 'NaN')
           as CODIGO_BARRA,
         event_type as DESCRICAO,
         nullif(case when value < 5 then 'NaN' else props end, 'NaN') as MULT,
         cast(ts as date) as INGESTION_DATE
  from events
"""


def gold_pack_snapshots(spark, folder):
    silver = _snapshot_silver(spark, folder)
    cut = dt.date(2024, 1, 20)
    early = silver.where(p.ingestion_day() < F.lit(cut))
    gold = _stored(early, plan.PACK_UNIT_GOLD, cut)
    return plan.build_gold(silver, plan.PACK_UNIT_GOLD, ASOF, gold)


# Own-company feed --------------------------------------------------------------
def gold_own_company(spark, folder):
    """Both runs read silver as stored."""
    feed = feeds.own_company_feed(spark, folder)
    silver = cut_lineage(with_ingestion(feed, F.last_day(p.day_slashed("DATA_VENDA"))))
    cut = dt.date(2001, 6, 1)
    early = silver.where(p.ingestion_day() < F.lit(cut))
    gold = _stored(early, plan.OWN_COMPANY_GOLD, cut, silver_is_stored=True)
    return plan.build_gold(silver, plan.OWN_COMPANY_GOLD, dt.date(2001, 8, 5), gold, silver_is_stored=True)


_OWN_KEYS = (
    "DATA_VENDA, CNPJ_LOJA, EAN, PRODUCT_SOURCE_NAME, VOLUME_UNIT, MEA_UNIT, PACK_QUANTITY"
)
_OWN_FIRST = (
    f"qualify row_number() over (partition by {_OWN_KEYS} order by INGESTION_DATE desc nulls last, "
    "FATURAMENTO nulls first, CATEGORY nulls first, COMPANY nulls first, BRAND_ID nulls first) = 1"
)
_OWN_SILVER = f"""
  select * exclude (VOLUME_UNIT, PACK_QUANTITY, FATURAMENTO),
         {dec('VOLUME_UNIT')} as VOLUME_UNIT,
         {dec('PACK_QUANTITY')} as PACK_QUANTITY,
         {dec('FATURAMENTO')} as FATURAMENTO,
         last_day({day('DATA_VENDA', '%d/%m/%Y')}) as INGESTION_DATE
  from ({feeds.OWN_COMPANY_SQL})
"""


# Versions, look-backs, clean-up ------------------------------------------------
def rank_latest_version(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate")
    return dedup.newest_versions(orders, ["o_custkey"], "o_orderdate")


def newest_ingestion_rows(spark, folder):
    """All rows of the newest day of each user, ties kept."""
    rows = table(spark, folder, "events").withColumn("ingested", F.to_date("ts"))
    return dedup.newest_per_key(rows, ["event_type", "user_id"], "ingested")


def latest_per_full_row(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_type", "user_id", F.to_date("ts").alias("ingested")
    )
    return dedup.newest_of_equal_rows(rows, "ingested")


def lookback_last_n_ingestions(spark, folder):
    rows = table(spark, folder, "events").withColumn("ingested", F.to_date("ts"))
    return filters.last_ingestions(rows, "ingested", 4)


def lookback_days(spark, folder):
    rows = table(spark, folder, "events").withColumn("ingested", F.to_date("ts"))
    return filters.ingested_since(rows, "ingested", dt.date(2024, 1, 30), 7)


def nan_header_cleanup(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "signup", "Dia")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("DIA"),
        F.when(F.col("value") > 100, "NaN").otherwise(F.col("event_type")).alias("kind"),
        F.when(F.col("event_type") == "click", "0,00")
        .otherwise(comma_text("value"))
        .alias("sold"),
        F.when(F.col("event_type") == "view", "0").otherwise("-1,00").alias("stock"),
    )
    rows = filters.without_header_rows(rows, "DIA", "Dia")
    return p.nan_text_to_null(filters.sold_or_stocked(rows, "sold", "stock"), keep=("DIA",))


def multi_format_date(spark, folder):
    d = F.col("o_orderdate")
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(d, "yyyyMMdd"))
        .alias("raw"),
        F.year(d).alias("year"),
        (F.month(d) + 1).alias("month"),
        F.dayofmonth(d).alias("day"),
    )
    return raw.select(
        "o_orderkey",
        p.day_any_format("raw").alias("any_format"),
        p.day_compact("raw").alias("compact"),
        p.day_slashed_or_default("raw").alias("slashed_or_default"),
        p.day_slashed("raw").alias("slashed"),
        p.ingestion_day().alias("ingestion"),
    )


def half_month_partition(spark, folder):
    rows = shape.with_half_month_parts(table(spark, folder, "lineitem"), "l_shipdate")
    return audit.count_by(rows, year="year", month="month", day="day")


QUERIES = {
    "gold_first_load": (gold_first_load, f"select * from ({_SALE_SILVER}) {_SALE_FIRST}"),
    "gold_incremental_latest": (
        gold_incremental_latest,
        f"""
        with silver as ({_SALE_SILVER}),
        gold as (select * from silver where INGESTION_DATE < date '2000-06-01' {_SALE_FIRST}),
        fresh as (select * from silver where INGESTION_DATE >= date '2001-07-25' {_SALE_FIRST}),
        merged as (select * from gold union all by name select * from fresh),
        newest as (select * from merged {_newest(_SALE_KEYS)})
        select distinct * from newest
        """,
    ),
    "gold_unclean_history": (
        gold_unclean_history,
        f"""
        with silver as ({_WIDE_SILVER}),
        history as (select * from silver where INGESTION_DATE < date '2000-06-01'),
        fresh as (select * from silver where INGESTION_DATE >= date '2001-07-25' {_WIDE_FIRST}),
        merged as (select * from history union all by name select * from history
                   union all by name select * from fresh),
        newest as (select * from merged {_newest(_SALE_KEYS)})
        select distinct * from newest
        """,
    ),
    "gold_banner_load": (
        gold_banner_load,
        f"""
        with clean as ({_BANNER_CLEAN}), newest as (select * from clean {_newest(_BANNER_KEYS)})
        select distinct * from newest
        """,
    ),
    "gold_banner_incremental": (
        gold_banner_incremental,
        f"""
        with clean as ({_BANNER_CLEAN}),
        gold as (select distinct * from (select * from clean
                 where INGESTION_DATE < date '2000-06-01' {_newest(_BANNER_KEYS)})),
        fresh as (select * from clean where INGESTION_DATE >= date '2001-07-25'),
        merged as (select * from gold union all by name select * from fresh),
        newest as (select * from merged {_newest(_BANNER_KEYS)})
        select distinct * from newest
        """,
    ),
    "gold_pack_snapshots": (
        gold_pack_snapshots,
        f"""
        with silver as ({_SNAPSHOT_SILVER}),
        gold as (select distinct * from (select * from silver
                 where INGESTION_DATE < date '2024-01-20'
                 {_newest('DATA, CNPJ, CODIGO_BARRA, DESCRICAO')})),
        fresh as (select * from silver where INGESTION_DATE in
                  (select distinct INGESTION_DATE from silver order by 1 desc limit 4)),
        merged as (select * from gold union all by name select * from fresh),
        newest as (select * from merged {_newest('DATA, CNPJ, CODIGO_BARRA, DESCRICAO')})
        select distinct * from newest
        """,
    ),
    "gold_own_company": (
        gold_own_company,
        f"""
        with silver as ({_OWN_SILVER}),
        gold as (select * from silver where INGESTION_DATE < date '2001-06-01' {_OWN_FIRST}),
        fresh as (select * from silver where INGESTION_DATE >= date '2001-07-26' {_OWN_FIRST}),
        merged as (select * from gold union all by name select * from fresh),
        newest as (select * from merged {_newest(_OWN_KEYS)})
        select distinct * from newest
        """,
    ),
    "rank_latest_version": (
        rank_latest_version,
        """
        select distinct o_custkey, o_orderdate from orders
        qualify rank() over (partition by o_custkey order by o_orderdate desc) = 1
        """,
    ),
    "newest_ingestion_rows": (
        newest_ingestion_rows,
        """
        select *, cast(ts as date) as ingested from events
        qualify cast(ts as date) = max(cast(ts as date)) over (partition by event_type, user_id)
        """,
    ),
    "latest_per_full_row": (
        latest_per_full_row,
        """
        select event_type, user_id, max(cast(ts as date)) as ingested
        from events group by 1, 2
        """,
    ),
    "lookback_last_n_ingestions": (
        lookback_last_n_ingestions,
        """
        select *, cast(ts as date) as ingested from events
        where cast(ts as date) in
          (select distinct cast(ts as date) as d from events order by d desc limit 4)
        """,
    ),
    "lookback_days": (
        lookback_days,
        """
        select *, cast(ts as date) as ingested from events
        where cast(ts as date) >= date '2024-01-23'
        """,
    ),
    "nan_header_cleanup": (
        nan_header_cleanup,
        f"""
        with feed as (
          select event_id,
                 case when event_type = 'signup' then 'Dia' else strftime(ts, '%Y-%m-%d') end as DIA,
                 case when value > 100 then 'NaN' else event_type end as kind,
                 case when event_type = 'click' then '0,00' else {comma('value')} end as sold,
                 case when event_type = 'view' then '0' else '-1,00' end as stock
          from events)
        select event_id, DIA, nullif(kind, 'NaN') as kind, nullif(sold, 'NaN') as sold,
               nullif(stock, 'NaN') as stock
        from feed where DIA <> 'Dia' and ({dec('sold')} > 0 or {dec('stock')} >= 0)
        """,
    ),
    "multi_format_date": (
        multi_format_date,
        f"""
        with feed as (
          select o_orderkey,
                 case when o_orderstatus = 'F' then strftime(o_orderdate, '%d/%m/%Y')
                      when o_orderstatus = 'O' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                      else strftime(o_orderdate, '%Y%m%d') end as raw,
                 year(o_orderdate) || '-' || (month(o_orderdate) + 1) || '-' || day(o_orderdate)
                   as ymd
          from orders)
        select o_orderkey,
               coalesce({day("split_part(raw, ' ', 1)", '%Y-%m-%d')}, {day('raw', '%d/%m/%Y')},
                        date '1900-01-01') as any_format,
               {day("coalesce(trim(replace(raw, '-', '')), '19000101')", '%Y%m%d')} as compact,
               {day("coalesce(trim(raw), '01/01/1900')", '%d/%m/%Y')} as slashed_or_default,
               {day('raw', '%d/%m/%Y')} as slashed,
               {day('ymd', '%Y-%m-%d')} as ingestion
        from feed
        """,
    ),
    "half_month_partition": (
        half_month_partition,
        """
        select year(l_shipdate) as year, month(l_shipdate) as month,
               case when day(l_shipdate) < 16 then 1 else 16 end as day, count(*) as n_rows
        from lineitem group by 1, 2, 3
        """,
    ),
}
