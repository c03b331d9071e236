"""History backfills, written and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import parse as p
from tillroll.operators import audit, filters, shape
from tillroll.plans import backfill as plan
from tillroll.plans import layer_audit
from tillroll.session import cut_lineage, scratch_path
from tillroll.sources import readers, writers
from tillroll.workload import feeds
from tillroll.workload.feeds import comma_text
from tillroll.workload.tables import big, comma, dec, table


def _history(spark, folder):
    """Orders as a history zone: text dates and the audit columns, loaded monthly."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("DATA"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("data_venda"),
        comma_text("o_totalprice").alias("VALOR"),
        F.col("o_orderpriority").alias("filename"),
        F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("createdDate"),
        F.when(F.col("o_orderstatus") == "P", "2002-01-01").otherwise("").alias("updatedDate"),
        F.lit("").alias("lastReceived"),
    )


_HISTORY = f"""
  select o_orderkey as "order", strftime(o_orderdate, '%d/%m/%Y') as data,
         strftime(o_orderdate, '%d/%m/%Y') as data_venda,
         {comma('o_totalprice')} as valor, o_orderstatus <> 'P' as current,
         cast(o_orderdate as date) as d,
         last_day(o_orderdate) as created
  from orders"""


def _written(spark, name, df, spec):
    path = scratch_path(spark, name)
    plan.write_history(plan.shape_history(df, spec), spec, path)
    return readers.read_files(spark, path)


def backfill_roundtrip(spark, folder):
    """Rows before a cut date, appended by the day they were created."""
    spec = plan.BackfillSpec(
        keep=plan.before("DATA", dt.date(2001, 7, 4), plan.SLASHED), day=plan.created, lower=True
    )
    return _written(spark, "backfill", _history(spark, folder), spec)


def backfill_current_versions(spark, folder):
    """Current rows only; the second layer is read back."""
    spec = plan.BackfillSpec(
        keep=plan.current_before(dt.date(2001, 5, 19)),
        day=plan.created,
        lower=True,
        extra_drop=("data_venda",),
    )
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows = plan.shape_history(_history(spark, folder), spec)
    plan.write_history(rows, spec, bronze, silver)
    return readers.read_path_sql(spark, silver)


def backfill_half_months(spark, folder):
    """Yearly files with drifting columns, half-month partitions, replaced twice."""
    orders = table(spark, folder, "orders").withColumn("y", F.year("o_orderdate"))
    root = scratch_path(spark, "years")
    old = orders.where("y <= 1997").select("o_orderkey", "o_orderdate", "o_orderpriority", "y")
    new = orders.where("y > 1997").select("o_orderkey", "o_orderdate", "y")
    for part, name in ((old, "a"), (new, "b")):
        part.withColumnRenamed("o_orderpriority", "note").write.partitionBy("y").parquet(
            f"{root}/{name}"
        )
    history = readers.read_years(spark, [f"{root}/a/y=*", f"{root}/b/y=*"]).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATA"), "note"
    )
    spec = plan.BackfillSpec(
        keep=plan.up_to_year("DATA", 2000, plan.ISO),
        day=lambda: p.day_text("DATA", plan.ISO),
        half_months=True,
        whole_row_distinct=True,
        replace=True,
    )
    path = scratch_path(spark, "half")
    rows = plan.shape_history(history, spec)
    plan.write_history(rows, spec, path)
    plan.write_history(rows, spec, path)
    return audit.count_by(
        readers.read_files(spark, path), year="year", month="month", day="day", note="note"
    )


def fact_partitions_replaced(spark, folder):
    """A fact written by business day, then one month of it written again."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.last_day("l_shipdate").alias("DATA"), "l_returnflag"
    )
    fact = shape.with_day_parts(rows.withColumn("load", F.lit(1)), "DATA")
    path = scratch_path(spark, "fact")
    writers.overwrite_partitions(fact, path)
    again = filters.between_days(fact, "DATA", dt.date(2000, 3, 1), dt.date(2000, 3, 31))
    writers.overwrite_partitions(again.withColumn("load", F.lit(2)), path)
    return audit.count_by(
        readers.read_files(spark, path),
        year="ano_partition",
        month="mes_partition",
        load="load",
        flag="l_returnflag",
    )


def yearly_union(spark, folder):
    """Files of each source system read by glob and united by name."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars", "source")
    root = scratch_path(spark, "zone")
    docs.write.partitionBy("lang").parquet(f"{root}/br/docs")
    zone = readers.read_zone(spark, root, "br", "docs")
    # One folder per value; whatever values there are.
    folders = sorted({r[0] for r in zone.select(F.col("_metadata.file_path")).distinct().select(
        F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)).distinct().collect()})
    united = readers.read_years(spark, folders)
    readers.register_view(zone, "zone_documents")
    total = spark.sql("SELECT source, count(*) AS zone_rows FROM zone_documents GROUP BY source")
    return (
        united.groupBy("source")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars"))
        .join(total, "source")
    )


def history_validation(spark, folder):
    return plan.validate_history(_history(spark, folder), p.day_slashed("DATA"))


def _history_preset(name):
    """A preset of the history sources over orders dated 8,600 days later, with the
    creation date plain on some rows and with a time on others."""

    def run(spark, folder):
        later = F.date_add("o_orderdate", 8600)
        rows = table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("ORDER"),
            F.date_format(later, "dd/MM/yyyy").alias("DATA"),
            F.lit("f").alias("filename"),
            F.when(F.col("o_orderkey") % 2 == 0, F.date_format(later, "yyyy-MM-dd"))
            .otherwise(F.concat(F.date_format(later, "yyyy-MM-dd"), F.lit(" 10:00:00")))
            .alias("createdDate"),
            F.when(F.col("o_orderstatus") == "P", "2025-01-01").otherwise("").alias("updatedDate"),
            F.lit("").alias("lastReceived"),
        )
        return _written(spark, name, rows, plan.HISTORIES[name])

    return run


_PRESET = """
  select {columns}, year(d) as year, month(d) as month, day(d) as day
  from (select o_orderkey as "order", strftime(o_orderdate + interval 8600 day, '%d/%m/%Y') as data,
               cast(o_orderdate + interval 8600 day as date) as d, o_orderstatus from orders)
  where d < date '2024-09-19' and o_orderstatus <> 'P'
"""


def table_written(spark, folder):
    """A catalogue table overwritten whole, read back by the guarded read."""
    name = f"supplier_{uuid.uuid4().hex}"
    rows = table(spark, folder, "supplier")
    writers.overwrite_table(rows.limit(0), name)
    writers.overwrite_table(rows, name)
    return _read_and_dropped(spark, name)


def _read_and_dropped(spark, name):
    """The rows of a catalogue table that is not left behind."""
    try:
        return cut_lineage(readers.read_required_table(spark, name))
    finally:
        spark.sql(f"DROP TABLE {name}")


def fact_table_partitions_replaced(spark, folder):
    """A fact table by business day, one month of it written again."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.last_day("l_shipdate").alias("DATA"), F.lit(1).alias("load")
    )
    fact, name = shape.with_day_parts(rows, "DATA"), f"fact_{uuid.uuid4().hex}"
    writers.overwrite_partitions_of_table(fact, name)
    again = filters.between_days(fact, "DATA", dt.date(2000, 3, 1), dt.date(2000, 3, 31))
    writers.overwrite_partitions_of_table(again.where("l_linenumber > 1").withColumn("load", F.lit(2)), name)
    return audit.count_by(_read_and_dropped(spark, name), day="DATA", load="load")


#: What the yearly feed is to be, whatever the years hold.
YEARLY = T.StructType(
    [
        T.StructField("line", T.LongType()),
        T.StructField("qty", T.DecimalType(38, 6)),
        T.StructField("note", T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)


def _drifting_years(spark, folder):
    """Three years of one feed: the quantity as text, as a decimal, as a double; the day
    as text, then a date; a note only in the first and an undeclared column in the last."""
    lines = table(spark, folder, "lineitem").withColumn("y", F.year("l_shipdate"))
    some_bad = F.when(F.col("l_linenumber") == 3, "n/a").otherwise(comma_text("l_quantity"))
    root = scratch_path(spark, "drift")
    years = {
        1997: [F.col("l_orderkey").cast("string").alias("LINE"), some_bad.alias("QTY"), F.col("l_returnflag").alias("note"),
               F.when(F.col("l_linenumber") == 4, "?").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("DAY")],
        1998: [F.col("l_orderkey").cast("int").alias("line"), F.col("l_quantity").cast("decimal(12,2)").alias("qty"), F.to_date("l_shipdate").alias("day")],
        1999: [F.col("l_orderkey").alias("line"), F.col("l_quantity").alias("qty"), F.to_date("l_shipdate").alias("day"), F.col("l_tax").alias("extra")],
    }
    for year, columns in years.items():
        lines.where(F.col("y") == year).select(*columns).write.parquet(f"{root}/{year}_feed")
    globs = [f"{root}/{year}*" for year in years]
    return readers.read_years_as(spark, globs, YEARLY, from_text={"qty": lambda c: F.replace(c, F.lit(","), F.lit("."))})


def yearly_declared(spark, folder):
    return _drifting_years(spark, folder).groupBy("day", "note").agg(
        F.count(F.lit(1)).alias("n_rows"), F.try_sum("qty").cast("decimal(38,6)").alias("qty"), F.sum(F.size("misfits")).alias("misfits")
    )


def yearly_misfits(spark, folder):
    return readers.count_misfits(_drifting_years(spark, folder))


def _preset_source(spark, folder, iso=False):
    """Orders dated 8,600 days later as a history zone, loaded at the end of their month."""
    later = F.date_add("o_orderdate", 8600)
    text = F.date_format(later, "yyyy-MM-dd" if iso else "dd/MM/yyyy")
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ORDER"),
        text.alias("DATA"),
        text.alias("data_venda"),
        F.col("o_orderpriority").alias("filename"),
        F.concat(F.date_format(F.last_day(later), "yyyy-MM-dd"), F.lit(" 10:00:00")).alias("createdDate"),
        F.when(F.col("o_orderstatus") == "P", "2025-01-01").otherwise("").alias("updatedDate"),
        F.lit("").alias("lastReceived"),
        F.col("o_orderstatus").alias("status"),
        F.last_day(later).alias("_day"),
    )
    return shape.with_day_parts(rows, "_day").drop("_day")


def _preset(name, iso=False, drop=shape.BUSINESS_PARTITION, twice=False):
    """A preset run from files to files; ``twice`` where a rerun must change nothing."""

    def run(spark, folder):
        spec = plan.HISTORIES[name]
        source, target = scratch_path(spark, "source"), scratch_path(spark, name)
        rows = _preset_source(spark, folder, iso).drop(*drop)
        (rows.unionByName(rows) if spec.whole_row_distinct else rows).write.parquet(source)
        for _ in range(2 if twice else 1):
            plan.backfill(spark, source, spec, target)
        return readers.read_files(spark, target)

    return run


def _preset_sql(where="true", columns='"order", data, data_venda, status', fmt="%d/%m/%Y", day="last_day(d)"):
    return f"""
    select {columns}, year({day}) as year, month({day}) as month, day({day}) as day from (
      select o_orderkey as "order", strftime(o_orderdate + interval 8600 day, '{fmt}') as data,
             strftime(o_orderdate + interval 8600 day, '{fmt}') as data_venda, o_orderstatus as status,
             cast(o_orderdate + interval 8600 day as date) as d from orders)
    where {where}
    """


_ISO_SQL = "%Y-%m-%d"
_UPPER = '"order" as "ORDER", data as "DATA", data_venda, status'


def _audited(frame):
    """One frame of the audit of one feed."""

    def run(spark, folder):
        feed = feeds.virtual_sale_feed(spark, folder)
        return layer_audit.audit_layer(
            feed,
            {"secao": "SECAO"},
            p.day_compact("DATA"),
            ["CNPJ", "CODIGOBARRAS", "DATA"],
            {"quantity": p.locale_decimal("QUANTIDADEVENDA")},
            store={"store": p.bigint_or_zero("CNPJ")},
            source_file="TIPO",
        )[frame]

    return run


_DAY = (
    "cast(try_strptime(coalesce(trim(replace(DATA, '-', '')), '19000101'), '%Y%m%d') as date)"
)

QUERIES = {
    "backfill_roundtrip": (
        backfill_roundtrip,
        f"""
        select "order", data, data_venda, valor, year(created) as year, month(created) as month,
               day(created) as day
        from ({_HISTORY}) where d < date '2001-07-04'
        """,
    ),
    "backfill_current_versions": (
        backfill_current_versions,
        f"""
        select "order", data, valor, year(created) as year, month(created) as month,
               day(created) as day
        from ({_HISTORY}) where created < date '2001-05-19' and current
        """,
    ),
    "backfill_half_months": (
        backfill_half_months,
        """
        select year, month, day, note, count(*) as n_rows from (
          select distinct o_orderkey, cast(o_orderdate as date) as d,
                 year(o_orderdate) as year, month(o_orderdate) as month,
                 case when day(o_orderdate) < 16 then 1 else 16 end as day,
                 case when year(o_orderdate) <= 1997 then o_orderpriority end as note
          from orders where year(o_orderdate) <= 2000)
        group by 1, 2, 3, 4
        """,
    ),
    "fact_partitions_replaced": (
        fact_partitions_replaced,
        """
        select year(l_shipdate) as year, month(l_shipdate) as month,
               case when date_trunc('month', l_shipdate) = date '2000-03-01' then 2 else 1 end as load,
               l_returnflag as flag, count(*) as n_rows
        from lineitem group by 1, 2, 3, 4
        """,
    ),
    "yearly_union": (
        yearly_union,
        "select source, count(*) as n_rows, cast(sum(n_chars) as bigint) as n_chars, "
        "count(*) as zone_rows from documents group by 1",
    ),
    "history_validation": (
        history_validation,
        "select cast(min(o_orderdate) as date) as min_value, cast(max(o_orderdate) as date) "
        "as max_value, count(*) as n_rows from orders",
    ),
    "layer_audit_totals": (
        _audited("totals_per_day"),
        f"""
        select {_DAY} as day,
               count(*) as n_rows, cast(sum({dec('QUANTIDADEVENDA')}) as decimal(38,6)) as quantity
        from ({feeds.VIRTUAL_SALE_SQL}) group by 1
        """,
    ),
    "layer_audit_partitions": (
        _audited("rows_per_partition"),
        f"select SECAO as secao, count(*) as n_rows from ({feeds.VIRTUAL_SALE_SQL}) group by 1",
    ),
    "layer_audit_days": (
        _audited("rows_per_day"),
        f"select {_DAY} as day, count(*) as n_rows from ({feeds.VIRTUAL_SALE_SQL}) group by 1",
    ),
    "layer_audit_range": (
        _audited("range"),
        f"select min({_DAY}) as min_value, max({_DAY}) as max_value, count(*) as n_rows "
        f"from ({feeds.VIRTUAL_SALE_SQL})",
    ),
    "layer_audit_duplicates": (
        _audited("duplicate_keys"),
        f"select CNPJ, CODIGOBARRAS, DATA, count(*) as n_rows from ({feeds.VIRTUAL_SALE_SQL}) "
        "group by 1, 2, 3 having count(*) > 1",
    ),
    "layer_audit_stores": (
        _audited("totals_per_store"),
        f"""
        select {big('CNPJ')} as store, count(*) as n_rows,
               cast(sum({dec('QUANTIDADEVENDA')}) as decimal(38,6)) as quantity
        from ({feeds.VIRTUAL_SALE_SQL}) group by 1
        """,
    ),
    "layer_audit_files": (
        _audited("rows_per_file"),
        f"select TIPO as source_file, SECAO as secao, count(*) as n_rows "
        f"from ({feeds.VIRTUAL_SALE_SQL}) group by 1, 2",
    ),
    "history_current_sales": (
        _history_preset("current_sales_2024_09_19"),
        _PRESET.replace("{columns}", '"order", data'),
    ),
    "history_current_stock": (
        _history_preset("current_stock_2024_09_19"),
        _PRESET.replace("{columns}", '"order" as "ORDER"'),
    ),
    "table_written": (table_written, "select * from supplier"),
}
QUERIES |= {
    "history_sales_july_4": (_preset("sales_by_day_2024_07_04"), _preset_sql("d < date '2024-07-04'")),
    "history_stock_may_13": (_preset("stock_by_day_2024_05_13"), _preset_sql("d < date '2024-05-13'")),
    "history_sales_july_8": (_preset("sales_by_day_2024_07_08"), _preset_sql("d < date '2024-07-08'")),
    "history_sales_august_20": (_preset("sales_by_day_2024_08_20"), _preset_sql("d < date '2024-08-20'", _UPPER)),
    "history_created_day": (_preset("created_day"), _preset_sql(columns=_UPPER)),
    "history_created_up_to_2023": (
        _preset("created_up_to_2023", iso=True, twice=True), _preset_sql("year(d) <= 2023", _UPPER, _ISO_SQL)
    ),
    "history_half_months": (
        _preset("half_months", iso=True, twice=True),
        _preset_sql("year(d) <= 2023", _UPPER, _ISO_SQL, "case when day(d) < 16 then date_trunc('month', d) else date_trunc('month', d) + interval 15 day end"),
    ),
    "history_fact_by_business_day": (
        _preset("fact_by_business_day", drop=(), twice=True),
        _preset_sql(columns=_UPPER).replace("as year", "as ano_partition").replace("as month", "as mes_partition").replace("as day", "as dia_partition"),
    ),
    "history_current_catalogue": (
        _preset("current_catalogue"),
        """
        select o_orderkey as "ORDER", strftime(o_orderdate + interval 8600 day, '%d/%m/%Y') as "DATA",
               strftime(o_orderdate + interval 8600 day, '%d/%m/%Y') as data_venda, o_orderstatus as status
        from orders where o_orderstatus <> 'P'
        """,
    ),
    "fact_table_partitions_replaced": (
        fact_table_partitions_replaced,
        """
        select last_day(l_shipdate) as day,
               case when date_trunc('month', l_shipdate) = date '2000-03-01' then 2 else 1 end as load, count(*) as n_rows
        from lineitem where l_linenumber > 1 or date_trunc('month', l_shipdate) <> date '2000-03-01' group by 1, 2
        """,
    ),
    "yearly_declared": (
        yearly_declared,
        """
        select case when y = 1997 and l_linenumber = 4 then null else cast(l_shipdate as date) end as day,
               case when y = 1997 then l_returnflag end as note, count(*) as n_rows,
               cast(sum(case when y <> 1997 or l_linenumber <> 3 then cast(l_quantity as decimal(38,6)) end) as decimal(38,6)) as qty,
               cast(sum(case when y = 1997 and l_linenumber in (3, 4) then 1 else 0 end) as bigint) as misfits
        from (select *, year(l_shipdate) as y from lineitem) where y between 1997 and 1999 group by 1, 2
        """,
    ),
    "yearly_misfits": (
        yearly_misfits,
        """
        select case when l_linenumber = 3 then 'qty' else 'day' end as "column", count(*) as n_rows
        from lineitem where year(l_shipdate) = 1997 and l_linenumber in (3, 4) group by 1
        """,
    ),
}
