"""Counts, totals, duplicates and comparisons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import parse as p
from tillroll.operators import audit, checksum, dedup, filters, shape
from tillroll.workload.feeds import comma_text, text
from tillroll.workload.tables import big, comma, dec, spread, table


def scan_preview(spark, folder):
    return table(spark, folder, "supplier")


def audit_partition_counts(spark, folder):
    return audit.count_by(
        table(spark, folder, "events"), year=F.year("ts"), month=F.month("ts"), day=F.dayofmonth("ts")
    )


def audit_business_date_counts(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("DATA")
    )
    return audit.count_by(orders, day=p.day_text("DATA", "dd/MM/yyyy"))


def audit_source_partition_counts(spark, folder):
    return audit.count_by(
        table(spark, folder, "documents"), source_file="source", partition="lang"
    )


def audit_global_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


def audit_range_profile(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-M-d").alias("DATA"),
        comma_text("o_totalprice").alias("VALOR"),
    )
    return audit.range_profile(
        orders, p.day_text("DATA", "yyyy-M-d"), {"total": p.locale_decimal("VALOR")}
    )


def audit_range_by_store(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("d"), comma_text("l_quantity").alias("q")
    )
    return audit.range_profile_by(rows, ["l_suppkey"], "d", {"total": p.locale_decimal("q")})


def audit_control_totals(spark, folder):
    rows = spread(table(spark, folder, "lineitem")).select(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("DATA"),
        comma_text("l_quantity").alias("QTD"),
        comma_text("l_extendedprice").alias("VALOR"),
    )
    return audit.control_totals(
        rows,
        {"day": p.day_text("DATA", "dd/MM/yyyy")},
        {"quantity": p.locale_decimal("QTD"), "revenue": p.locale_decimal("VALOR")},
    )


def audit_store_totals(spark, folder):
    """Totals per store of coded lines; text goes to a number in two steps."""
    rows = spread(table(spark, folder, "lineitem")).select(
        text("l_suppkey").alias("CNPJ"),
        F.when(F.col("l_linenumber") == 7, "0").otherwise(text("l_partkey")).alias("CODIGO"),
        comma_text("l_extendedprice").alias("VALOR"),
    )
    rows = filters.known_code(rows, "CODIGO").join(
        table(spark, folder, "supplier").select("s_suppkey", "s_name"),
        p.bigint_or_zero("CNPJ") == F.col("s_suppkey"),
    )
    return audit.control_totals(
        rows,
        {"store": "s_name"},
        {"revenue": p.locale_decimal("VALOR"), "codes": p.safe_cast("CODIGO", "bigint")},
    )


def audit_date_retailer_totals(spark, folder):


    rows = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.to_date("o_orderdate").alias("DIA"),
            "c_mktsegment",
            F.when(F.col("o_orderstatus") != "P", comma_text("o_totalprice")).alias("VALOR"),
        )
    )
    return audit.control_totals(
        rows,
        {"day": "DIA", "retailer": "c_mktsegment"},
        {"total": p.locale_decimal("VALOR", T.DecimalType(36, 6))},
    )


def audit_source_share(spark, folder):
    return audit.share_of_total(table(spark, folder, "documents"), "source")


def audit_distinct_days(spark, folder):
    return audit.distinct_values(table(spark, folder, "lineitem"), day=F.to_date("l_shipdate"))


def newest_days(spark, folder):
    return audit.newest_values(
        table(spark, folder, "events"), F.to_date("ts"), 4, name="day"
    )


def ordered_partition_counts(spark, folder):
    """Counts per month, listed in order."""
    counts = audit.count_by(
        table(spark, folder, "lineitem"), year=F.year("l_shipdate"), month=F.month("l_shipdate")
    )
    return audit.listing(counts, "year", "month")


def largest_orders(spark, folder):
    """A short listing: the ten dearest orders."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return audit.listing(orders, F.col("o_totalprice").desc(), "o_orderkey", n=10)


def duplicate_keys(spark, folder):
    return dedup.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_rows_detail(spark, folder):
    return dedup.duplicate_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def distinct_rows(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag")
    return dedup.distinct_rows(rows)


def first_row_per_key(spark, folder):
    rows = table(spark, folder, "lineitem")
    return dedup.first_per_key(
        rows, ["l_suppkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()]
    )


_LINE_REST = ", ".join(
    f"{c} nulls first"
    for c in (
        "l_orderkey l_partkey l_quantity l_extendedprice l_discount l_tax l_returnflag "
        "l_linestatus l_shipdate"
    ).split()
)


def layer_reconcile(spark, folder):
    """Lines against order headers, per order date."""
    orders = table(spark, folder, "orders")
    headers = orders.select(
        F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(38,6)").alias("v")
    )
    lines = (
        table(spark, folder, "lineitem")
        .where(F.col("l_linestatus") == "F")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.to_date("o_orderdate").alias("day"),
            F.col("l_extendedprice").cast("decimal(38,6)").alias("v"),
        )
    )
    return audit.reconcile(headers, lines, {"day": "day"}, {"total": "v"})


def missing_dates(spark, folder):
    urgent = filters.equals(table(spark, folder, "orders"), "o_orderpriority", "1-URGENT")
    return audit.missing_days(urgent, F.to_date("o_orderdate"))


def column_profile(spark, folder):
    return audit.column_profile(table(spark, folder, "customer"))


def _snapshots(spark, folder):
    """Orders as they are, and as a later load that changed and lost some."""
    orders = table(spark, folder, "orders")
    later = orders.where(F.col("o_orderpriority") != "5-LOW").withColumns(
        {
            "o_orderstatus": F.when(F.col("o_orderpriority") == "2-HIGH", "F").otherwise(
                F.col("o_orderstatus")
            ),
            "o_custkey": F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")),
        }
    )
    return orders.where("o_orderpriority <> '3-MEDIUM'"), later


_LATER = """
  select o_orderkey,
         case when o_orderpriority = '2-HIGH' then 'F' else o_orderstatus end as o_orderstatus,
         case when o_orderpriority <> '1-URGENT' then o_custkey end as o_custkey
  from orders where o_orderpriority <> '5-LOW'
"""


def row_diff(spark, folder):
    before, after = _snapshots(spark, folder)
    return audit.row_differences(before, after, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


def row_diff_by_checksum(spark, folder):
    """The same differences; rows meet only in buckets whose checksums differ."""
    before, after = _snapshots(spark, folder)
    return checksum.row_differences(before, after, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


def differing_partitions(spark, folder):
    """Months in which orders and a later load of two of them are not the same."""
    orders = table(spark, folder, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    changed = F.col("month").isin(dt.date(1998, 2, 1), dt.date(1999, 7, 1)) & (F.col("o_orderstatus") == "F")
    later = orders.where(~changed | (F.col("o_orderkey") % 2 == 0))
    columns = ["o_custkey", "o_orderstatus", "o_totalprice"]
    return checksum.differing_partitions(orders, later, ["month"], ["o_orderkey", "month"], columns).select(
        "month", (F.col("left_rows") - F.col("right_rows")).alias("rows_lost")
    )


def row_equality(spark, folder):
    before, after = _snapshots(spark, folder)
    return audit.row_equality(before, after, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


def filter_predicates(spark, folder):
    """Year, day range, LIKE, inequality and complete rows in one pass over orders."""
    rows = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    rows = filters.up_to_year(rows, "day", 2000)
    rows = filters.between_days(rows, "day", dt.date(1996, 1, 1), dt.date(1999, 12, 31))
    rows = rows.where(filters.like_upper("o_orderpriority", "%SPECIFIED%"))
    rows = filters.differs(rows, "o_orderstatus", "P")
    rows = rows.withColumn("note", F.nullif(F.col("o_orderstatus"), F.lit("F")))
    rows = rows.withColumn("may_miss", F.nullif(F.col("o_orderkey") % 3, F.lit(0)))
    return filters.complete_rows(rows, ("o_custkey", "may_miss"))


def null_cause(spark, folder):
    rows = table(spark, folder, "documents").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    return filters.is_null(rows, "quality").select("doc_id", "lang", "source")


def point_lookup(spark, folder):
    return filters.point_lookup(
        table(spark, folder, "part"), {"p_name": "blue ring", "p_brand": "Brand#7"}
    )


def column_shaping(spark, folder):
    """Drop, rename, constants, typed nulls, partition columns, id, name style."""
    rows = shape.drop_columns(table(spark, folder, "orders"), ["o_orderpriority", "filename"])
    rows = shape.rename(rows, {"o_orderdate": "data_venda"})
    rows = shape.keep_original(rows, "o_orderstatus", "_original")
    rows = shape.with_constants(rows, {"company": "OWN", "checkout": 0})
    rows = shape.with_day_parts(rows, "data_venda")
    rows = shape.all_except(rows, ["O_TOTALPRICE"])
    rows = shape.upper_names(rows)
    return rows


def row_ids(spark, folder):
    """Ids of rows that differ only in where a NULL stands: as many as there are rows."""
    orders = table(spark, folder, "orders")
    key, none = F.col("o_orderkey").cast("string"), F.lit(None).cast("string")
    sides = [orders.select(key.alias("a"), none.alias("b")), orders.select(none.alias("a"), key.alias("b"))]
    ids = shape.with_row_id(sides[0].unionByName(sides[1]), "id", ["a", "b"])
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


QUERIES = {
    "scan_preview": (scan_preview, "select * from supplier"),
    "audit_partition_counts": (
        audit_partition_counts,
        "select year(ts) as year, month(ts) as month, day(ts) as day, count(*) as n_rows "
        "from events group by 1, 2, 3",
    ),
    "audit_business_date_counts": (
        audit_business_date_counts,
        "select cast(o_orderdate as date) as day, count(*) as n_rows from orders group by 1",
    ),
    "audit_source_partition_counts": (
        audit_source_partition_counts,
        "select source as source_file, lang as partition, count(*) as n_rows "
        "from documents group by 1, 2",
    ),
    "audit_global_count": (audit_global_count, "select count(*) as n_rows from lineitem"),
    "audit_range_profile": (
        audit_range_profile,
        "select cast(min(o_orderdate) as date) as min_value, cast(max(o_orderdate) as date) "
        "as max_value, count(*) as n_rows, "
        f"cast(sum({dec(comma('o_totalprice'))}) as decimal(38,6)) as total from orders",
    ),
    "audit_range_by_store": (
        audit_range_by_store,
        "select l_suppkey, cast(min(l_shipdate) as date) as min_value, "
        "cast(max(l_shipdate) as date) as max_value, count(*) as n_rows, "
        f"cast(sum({dec(comma('l_quantity'))}) as decimal(38,6)) as total "
        "from lineitem group by 1",
    ),
    "audit_control_totals": (
        audit_control_totals,
        "select cast(l_shipdate as date) as day, count(*) as n_rows, "
        f"cast(sum({dec(comma('l_quantity'))}) as decimal(38,6)) as quantity, "
        f"cast(sum({dec(comma('l_extendedprice'))}) as decimal(38,6)) as revenue "
        "from lineitem group by 1",
    ),
    "audit_store_totals": (
        audit_store_totals,
        f"""
        with feed as (
          select cast(l_suppkey as varchar) as CNPJ,
                 case when l_linenumber = 7 then '0' else cast(l_partkey as varchar) end as CODIGO,
                 {comma('l_extendedprice')} as VALOR from lineitem)
        select s_name as store, count(*) as n_rows,
               cast(sum({dec('VALOR')}) as decimal(38,6)) as revenue,
               cast(sum(try_cast(CODIGO as bigint)) as bigint) as codes
        from feed join supplier on {big('CNPJ')} = s_suppkey
        where {big('CODIGO')} <> 0 group by 1
        """,
    ),
    "audit_date_retailer_totals": (
        audit_date_retailer_totals,
        f"""
        select cast(o_orderdate as date) as day, c_mktsegment as retailer, count(*) as n_rows,
               cast(sum({dec("case when o_orderstatus <> 'P' then " + comma('o_totalprice') + " end")})
                    as decimal(38,6)) as total
        from orders join customer on o_custkey = c_custkey group by 1, 2
        """,
    ),
    "audit_source_share": (
        audit_source_share,
        "select source, count(*) as n_rows, (select count(*) from documents) as n_rows_total "
        "from documents group by 1",
    ),
    "audit_distinct_days": (
        audit_distinct_days,
        "select distinct cast(l_shipdate as date) as day from lineitem",
    ),
    "newest_days": (
        newest_days,
        "select distinct cast(ts as date) as day from events order by day desc limit 4",
    ),
    "ordered_partition_counts": (
        ordered_partition_counts,
        "select year(l_shipdate) as year, month(l_shipdate) as month, count(*) as n_rows "
        "from lineitem group by 1, 2 order by 1, 2",
    ),
    "largest_orders": (
        largest_orders,
        "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
    ),
    "duplicate_keys": (
        duplicate_keys,
        "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem "
        "group by 1, 2 having count(*) > 1",
    ),
    "duplicate_rows_detail": (
        duplicate_rows_detail,
        "select *, count(*) over (partition by l_orderkey, l_linenumber) as n_rows "
        "from lineitem qualify n_rows > 1",
    ),
    "distinct_rows": (
        distinct_rows,
        "select distinct l_suppkey, l_linenumber, l_returnflag from lineitem",
    ),
    "first_row_per_key": (
        first_row_per_key,
        "select * from lineitem qualify row_number() over (partition by l_suppkey, l_linenumber "
        f"order by l_shipdate desc nulls last, {_LINE_REST}) = 1",
    ),
    "layer_reconcile": (
        layer_reconcile,
        """
        with s as (
          select cast(o_orderdate as date) as day, count(*) as n_rows,
                 sum(cast(o_totalprice as decimal(38,6))) as total from orders group by 1),
        t as (
          select cast(o_orderdate as date) as day, count(*) as n_rows,
                 sum(cast(l_extendedprice as decimal(38,6))) as total
          from lineitem join orders on l_orderkey = o_orderkey
          where l_linestatus = 'F' group by 1)
        select coalesce(s.day, t.day) as day,
               coalesce(s.n_rows, 0) as source_n_rows, coalesce(t.n_rows, 0) as target_n_rows,
               coalesce(s.n_rows, 0) - coalesce(t.n_rows, 0) as difference_n_rows,
               cast(coalesce(s.total, 0) as decimal(38,6)) as source_total,
               cast(coalesce(t.total, 0) as decimal(38,6)) as target_total,
               cast(coalesce(s.total, 0) - coalesce(t.total, 0) as decimal(38,6))
                 as difference_total
        from s full outer join t on s.day = t.day
        """,
    ),
    "missing_dates": (
        missing_dates,
        """
        with days as (select distinct cast(o_orderdate as date) as d from orders
                      where o_orderpriority = '1-URGENT'),
        span as (select unnest(generate_series(min(d), max(d), interval 1 day)) as d from days)
        select cast(d as date) as missing_day from span
        where cast(d as date) not in (select d from days)
        """,
    ),
    "column_profile": (
        column_profile,
        " union all ".join(
            f"select '{c}' as \"column\", '{kind}' as kind, cast(count(*) as bigint) as n_rows, "
            f"cast(count(*) - count({c}) as bigint) as n_nulls, "
            f"cast(count(distinct {c}) as bigint) as n_distinct from customer"
            for c, kind in {
                "c_custkey": "bigint",
                "c_name": "string",
                "c_nationkey": "int",
                "c_acctbal": "double",
                "c_mktsegment": "string",
            }.items()
        ),
    ),
    "row_diff": (
        row_diff,
        f"""
        with b as ({_LATER}),
        pair as (
          select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
                 case when b.o_orderkey is null then 'left' when a.o_orderkey is null then 'right'
                      else 'both' end as found_in,
                 a.o_orderstatus as s1, b.o_orderstatus as s2,
                 cast(a.o_custkey as varchar) as c1, cast(b.o_custkey as varchar) as c2
          from (select * from orders where o_orderpriority <> '3-MEDIUM') a
          full join b on a.o_orderkey = b.o_orderkey),
        cells as (
          select o_orderkey, found_in, 'o_orderstatus' as column_name, s1 as left_value,
                 s2 as right_value from pair
          union all
          select o_orderkey, found_in, 'o_custkey', c1, c2 from pair)
        select o_orderkey, found_in,
               column_name, left_value, right_value
        from cells where left_value is distinct from right_value
        """,
    ),
    "row_equality": (
        row_equality,
        f"""
        select a.o_orderkey,
               a.o_orderstatus is not distinct from b.o_orderstatus as o_orderstatus_equal,
               a.o_custkey is not distinct from b.o_custkey as o_custkey_equal
        from orders a join ({_LATER}) b on a.o_orderkey = b.o_orderkey
        where a.o_orderpriority <> '3-MEDIUM'
        """,
    ),
    "filter_predicates": (
        filter_predicates,
        """
        select *, cast(o_orderdate as date) as day, o_orderstatus as note,
               nullif(o_orderkey % 3, 0) as may_miss
        from orders
        where o_orderstatus <> 'F' and year(o_orderdate) <= 2000
          and cast(o_orderdate as date) between date '1996-01-01' and date '1999-12-31'
          and upper(o_orderpriority) like '%SPECIFIED%' and o_orderstatus <> 'P'
        """,
    ),
    "null_cause": (
        null_cause,
        "select d.doc_id, lang, source from documents d left join labels l on d.doc_id = l.doc_id "
        "where quality is null",
    ),
    "point_lookup": (
        point_lookup,
        "select * from part where p_name = 'blue ring' and p_brand = 'Brand#7'",
    ),
    "column_shaping": (
        column_shaping,
        """
        select o_orderkey as O_ORDERKEY, o_custkey as O_CUSTKEY, o_orderstatus as O_ORDERSTATUS,
               o_orderdate as DATA_VENDA, o_orderstatus as O_ORDERSTATUS_ORIGINAL,
               'OWN' as COMPANY, 0 as CHECKOUT, year(o_orderdate) as ANO_PARTITION,
               month(o_orderdate) as MES_PARTITION, day(o_orderdate) as DIA_PARTITION
        from orders
        """,
    ),
    "row_ids": (row_ids, "select 2 * count(*) as n_rows, 2 * count(*) as n_ids from orders"),
}
QUERIES["row_diff_by_checksum"] = (row_diff_by_checksum, QUERIES["row_diff"][1])
QUERIES["differing_partitions"] = (
    differing_partitions,
    """
    select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as rows_lost from orders
    where date_trunc('month', o_orderdate) in (date '1998-02-01', date '1999-07-01')
      and o_orderstatus = 'F' and o_orderkey % 2 <> 0
    group by 1
    """,
)
