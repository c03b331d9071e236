"""Tables on disk that grow: merged by partition, published in stages, listed, audited."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from tillroll.functions import parse as p
from tillroll.operators import audit, filters, shape, sketch
from tillroll.plans import audit_store, gold_store, publish
from tillroll.session import scratch_path
from tillroll.sources import partitions, readers, writers
from tillroll.workload import feeds, gold, history
from tillroll.workload.feeds import with_ingestion
from tillroll.workload.tables import big, dec, table


def _merged_gold(spark, folder):
    """The path of a gold loaded up to a cut and merged with the last days, and the
    partitions the merge replaced."""
    silver = gold._sale_silver(spark, folder)
    early = silver.where(p.ingestion_day() < F.lit(gold.GOLD_CUT))
    path = scratch_path(spark, "gold")
    one_row = publish.no_duplicates(gold.SALE_GOLD.keys)
    gold_store.merge_into_gold(spark, early, gold.SALE_GOLD, gold.GOLD_CUT, path, [one_row])
    return path, gold_store.merge_into_gold(spark, silver, gold.SALE_GOLD, gold.ASOF, path)


def gold_partition_merge(spark, folder):
    """The incremental gold run on a partitioned gold."""
    path, _ = _merged_gold(spark, folder)
    return gold_store.read_gold(spark, path)


def gold_partitions_touched(spark, folder):
    """The partitions of gold, and which of them the second run replaced."""
    path, touched = _merged_gold(spark, folder)
    return partitions.partition_files(spark, path).select(
        F.substring(gold_store.PARTITION, 2, 10).alias("day"), F.col(gold_store.PARTITION).isin(touched).alias("touched")
    )


def _monthly_fact(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.last_day("l_shipdate").alias("DATA"), F.col("l_quantity").cast("decimal(38,6)").alias("q")
    )
    return shape.with_day_parts(rows, "DATA")


def staged_publish(spark, folder):
    """Three loads of a fact: all of it, a month twice over, and that month mended.

    The second fails its checks and leaves no trace; the third replaces its month.
    """
    fact, path = _monthly_fact(spark, folder), scratch_path(spark, "published")
    month = filters.between_days(fact, "DATA", dt.date(2000, 3, 1), dt.date(2000, 3, 31))
    by_day, q = {"DATA": "DATA"}, {"q": "q"}
    publish.publish(fact, path, [publish.no_nulls("DATA"), publish.same_totals(fact, by_day, q)])
    failed = 0
    try:
        publish.publish(month.unionByName(month), path, [publish.same_totals(month, by_day, q), publish.at_least(1)])
    except publish.CheckFailed as error:
        failed = len(error.failed)
    mended = month.withColumn("q", (F.col("q") + 1).cast("decimal(38,6)"))
    publish.publish(mended, path, [publish.at_least(1)])
    stored = readers.read_files(spark, path)
    return audit.control_totals(stored, {"day": "DATA"}, {"q": "q"}).withColumn("failed_checks", F.lit(failed))


def newest_snapshots_listed(spark, folder):
    """The last four ingestion days of a partitioned tree, found by its listing."""
    path = scratch_path(spark, "snapshots")
    writers.append_partitioned(with_ingestion(table(spark, folder, "events"), F.col("ts")), path)
    rows = partitions.rows_of_newest(spark, path, p.ingestion_day(), 4)
    return rows.withColumn("ingested", p.ingestion_day()).drop("year", "month", "day")


def _feed_frames(spark, folder):
    spec = audit_store.AuditSpec(
        partition={"secao": "SECAO"},
        day=p.day_compact("DATA"),
        keys=("CNPJ", "CODIGOBARRAS", "DATA"),
        sums={"quantity": p.locale_decimal("QUANTIDADEVENDA")},
        store={"store": p.bigint_or_zero("CNPJ")},
        source_file="TIPO",
    )
    return audit_store.audit_once(feeds.virtual_sale_feed(spark, folder), spec)


def layer_audit_one_scan(spark, folder):
    """All counts, ranges and totals of a feed after one scan, as one long table."""
    frames = _feed_frames(spark, folder)

    def long(name, first, second=None, quantity=None):
        text = [F.lit(None).cast("string") if c is None else F.col(c).cast("string") for c in (first, second)]
        total = F.lit(None).cast("decimal(38,6)") if quantity is None else F.col(quantity)
        return frames[name].select(
            F.lit(name).alias("frame"), text[0].alias("first"), text[1].alias("second"), "n_rows", total.alias("quantity")
        )

    parts = [
        long("rows_per_partition", "secao"),
        long("rows_per_day", "day"),
        long("range", "min_value", "max_value"),
        long("totals_per_day", "day", quantity="quantity"),
        long("totals_per_store", "store", quantity="quantity"),
        long("rows_per_file", "source_file", "secao"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def layer_audit_one_scan_keys(spark, folder):
    return _feed_frames(spark, folder)["duplicate_keys"]


def _rerun(spark, folder):
    """A layer in months, audited, then grown by some months and one month written
    again without its returned lines, and audited again."""
    lines = table(spark, folder, "lineitem").withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    spec = audit_store.AuditSpec(
        partition={"flag": "l_returnflag"},
        day=F.to_date("l_shipdate"),
        keys=("l_orderkey", "l_linenumber"),
        sums={"quantity": F.col("l_quantity").cast("decimal(38,6)")},
    )
    path, store = scratch_path(spark, "layer"), scratch_path(spark, "audits")
    months = ("year", "month")
    writers.append_partitioned(lines.where("year < 2001"), path, months)
    audit_store.audit_partitions(spark, path, spec, store)
    writers.append_partitioned(lines.where("year >= 2001"), path, months)
    again = lines.where("year = 1999 and month = 5 and l_returnflag <> 'R'")
    writers.overwrite_partitions(again, path, months)
    return audit_store.audit_partitions(spark, path, spec, store)


def layer_audit_rerun(spark, folder):
    """Totals of the grown layer; the second audit scanned only what was new."""
    second = _rerun(spark, folder)
    return second.frames["totals_per_day"].withColumn("partitions_scanned", F.lit(len(second.scanned)))


def layer_audit_rerun_keys(spark, folder):
    return _rerun(spark, folder).frames["duplicate_keys"]


def column_profile_estimated(spark, folder):
    """Distinct counts from merged sketches of each line status, beside the exact ones."""
    rows = table(spark, folder, "lineitem")
    by_status = sketch.column_sketches(rows, {"status": F.col("l_linestatus")})
    profile = sketch.estimated_profile(sketch.merge_sketches(by_status))
    exact = audit.column_profile(rows).select("column", F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    return profile.join(exact, "column").select(
        "column", "kind", "n_rows", "n_nulls", "exact", (off <= 4 * sketch.standard_error()).alias("within_error")
    )


_LINES_AFTER = """
  select *, cast(l_shipdate as date) as d from lineitem
  where not (year(l_shipdate) = 1999 and month(l_shipdate) = 5 and l_returnflag = 'R')
"""
_FEED = f"(select *, {history._DAY} as d, {dec('QUANTIDADEVENDA')} as q from ({feeds.VIRTUAL_SALE_SQL}))"

QUERIES = {
    "layer_audit_one_scan": (
        layer_audit_one_scan,
        f"""
        with feed as {_FEED},
        sets as (
          select SECAO, d, {big('CNPJ')} as store, TIPO, count(*) as n, sum(q) as q,
                 grouping(SECAO) as gs, grouping(d) as gd, grouping({big('CNPJ')}) as gc, grouping(TIPO) as gt
          from feed group by grouping sets ((SECAO), (d), ({big('CNPJ')}), (TIPO, SECAO)))
        select 'rows_per_partition' as frame, SECAO as first, null as second, n as n_rows,
               cast(null as decimal(38,6)) as quantity from sets where gs = 0 and gt = 1
        union all select 'rows_per_day', cast(d as varchar), null, n, null from sets where gd = 0
        union all select 'totals_per_day', cast(d as varchar), null, n, cast(q as decimal(38,6)) from sets where gd = 0
        union all select 'totals_per_store', cast(store as varchar), null, n, cast(q as decimal(38,6)) from sets where gc = 0
        union all select 'rows_per_file', TIPO, SECAO, n, null from sets where gt = 0
        union all select 'range', cast(min(d) as varchar), cast(max(d) as varchar), count(*), null from feed
        """,
    ),
    "layer_audit_one_scan_keys": (layer_audit_one_scan_keys, history.QUERIES["layer_audit_duplicates"][1]),
    "layer_audit_rerun": (
        layer_audit_rerun,
        f"""
        select d as day, count(*) as n_rows, cast(sum(cast(l_quantity as decimal(38,6))) as decimal(38,6)) as quantity,
               (select count(distinct date_trunc('month', d)) + 1 from ({_LINES_AFTER}) where year(d) >= 2001)
                 as partitions_scanned
        from ({_LINES_AFTER}) group by 1
        """,
    ),
    "layer_audit_rerun_keys": (
        layer_audit_rerun_keys,
        f"select l_orderkey, l_linenumber, count(*) as n_rows from ({_LINES_AFTER}) group by 1, 2 having count(*) > 1",
    ),
    "column_profile_estimated": (
        column_profile_estimated,
        " union all ".join(
            f"select '{c}' as \"column\", '{kind}' as kind, cast(count(*) as bigint) as n_rows, "
            f"cast(count(*) - count({c}) as bigint) as n_nulls, "
            f"cast(count(distinct {c}) as bigint) as exact, true as within_error from lineitem"
            for c, kind in {
                "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
            }.items()
        ),
    ),
    "gold_partition_merge": (gold_partition_merge, gold.QUERIES["gold_incremental_latest"][1]),
    "gold_partitions_touched": (
        gold_partitions_touched,
        """
        with silver as (
          select strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') as day, o_orderdate as d
          from lineitem join orders on l_orderkey = o_orderkey)
        select day, bool_or(d >= date '2001-07-25') as touched from silver
        where d < date '2000-06-01' or d >= date '2001-07-25' group by 1
        """,
    ),
    "staged_publish": (
        staged_publish,
        """
        select last_day(l_shipdate) as day, count(*) as n_rows,
               cast(sum(cast(l_quantity as decimal(38,6))
                 + case when date_trunc('month', l_shipdate) = date '2000-03-01' then 1 else 0 end)
                 as decimal(38,6)) as q,
               1 as failed_checks
        from lineitem group by 1
        """,
    ),
    "newest_snapshots_listed": (newest_snapshots_listed, gold.QUERIES["lookback_last_n_ingestions"][1]),
}
