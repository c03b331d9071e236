import datetime as dt
import random
import time

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillroll.operators import dedup
from tillroll.operators.skew import DEFAULT_RULE, HotRule, fits, hot_keys, lookup_join, split_hot
from tillroll.operators.vocab import repair_typos
from tillroll.session import cut_lineage

EAGER = HotRule(min_rows=20)


def feed(spark, n=600, hot_share=0.4, seed=3):
    """Random versions of random keys; one key, NULL among them, holds many rows."""
    r = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if r.random() < hot_share else r.choice(["a", "b", "c", "d", None, str(i)])
        day = None if r.random() < 0.05 else dt.date(2024, 1, r.randint(1, 5))
        data.append((key, r.randint(0, 2), day, r.randint(0, 3)))
    return data, spark.createDataFrame(data, "k string, k2 int, ing date, v int")


def newest(data):
    best = {}
    for k, k2, day, _ in data:
        if day is not None:
            best[k, k2] = max(best.get((k, k2), day), day)
    return [row for row in data if row[2] is not None and best[row[0], row[1]] == row[2]]


def test_hot_keys_are_found_and_bounded(session):
    data, df = feed(session)
    assert len(hot_keys(df, ["k"], EAGER)) >= 1
    assert hot_keys(df, ["k"], DEFAULT_RULE) == []
    assert hot_keys(df.limit(0), ["k"], EAGER) == []
    assert len(hot_keys(df, ["k"], HotRule(min_rows=0, limit=3))) == 3
    cold, hot, _ = split_hot(df, ["k"], EAGER)
    assert cold.count() + hot.count() == len(data)
    assert hot.where("k = 'hot'").count() == sum(r[0] == "hot" for r in data)


@pytest.mark.parametrize("rule", [None, DEFAULT_RULE, EAGER], ids=["plain", "default", "hot"])
def test_newest_per_key(spark, rule):
    data, df = feed(spark)
    want = newest(data)
    got = dedup.newest_per_key(df, ["k", "k2"], "ing", rule=rule)
    assert rows(got) == sorted(want, key=repr)
    got = dedup.newest_per_key(df, ["k", "k2"], "ing", distinct=True, rule=rule)
    assert rows(got) == sorted(set(want), key=repr)


def test_ties_and_missing_dates(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = spark.createDataFrame(
        [("a", d2, 1), ("a", d2, 2), ("a", d1, 3), ("a", None, 4), ("b", None, 5)],
        "k string, ing date, v int",
    )
    assert rows(dedup.newest_per_key(df, ["k"], "ing")) == [("a", d2, 1), ("a", d2, 2)]
    first = dedup.first_per_key(df, ["k"], [F.col("ing").desc_nulls_last()])
    assert rows(first) == [("a", d2, 1), ("b", None, 5)]
    versions = dedup.newest_versions(df, ["k"], "ing")
    assert rows(versions) == [("a", d2), ("b", None)]


def test_first_per_key_does_not_depend_on_order(session):
    data, df = feed(session)
    a = rows(dedup.first_per_key(df, ["k"], [F.col("ing").desc_nulls_last()]))
    b = rows(dedup.first_per_key(df.repartition(3, "v"), ["k"], [F.col("ing").desc_nulls_last()]))
    assert a == b and len(a) == len({r[0] for r in data})


def test_first_per_key_is_cut_before_the_shuffle(session):
    _, df = feed(session)
    plan = dedup.first_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("rule", [None, DEFAULT_RULE, EAGER], ids=["plain", "default", "hot"])
def test_duplicate_rows(spark, rule):
    data, df = feed(spark)
    count = {}
    for r in data:
        count[r[0], r[1]] = count.get((r[0], r[1]), 0) + 1
    want = [(*r, count[r[0], r[1]]) for r in data if r[0] is not None and count[r[0], r[1]] > 1]
    got = dedup.duplicate_rows(df, ["k", "k2"], rule=rule).select("k", "k2", "ing", "v", "n_rows")
    assert rows(got) == sorted(want, key=repr)
    keys = dedup.duplicate_keys(df, ["k", "k2"])
    assert rows(keys) == sorted([(*k, n) for k, n in count.items() if n > 1], key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rule", [None, DEFAULT_RULE, EAGER], ids=["plain", "default", "hot"])
def test_lookup_join(session, how, rule):
    _, df = feed(session)
    lookup = session.createDataFrame([("hot", 1), ("a", 2), (None, 3)], "k string, w int")
    want = rows(df.join(lookup, ["k"], how))
    assert rows(lookup_join(df, lookup, ["k"], how, rule)) == want
    assert rows(lookup_join(df, lookup, ["k"], how, rule, broadcast_rows=0)) == want


def test_newest_of_equal_rows(spark):
    data, df = feed(spark)
    best = {}
    for k, k2, day, v in data:
        old = best.get((k, k2, v))
        best[k, k2, v] = day if old is None else max(old, day or old)
    got = dedup.newest_of_equal_rows(df, "ing")
    assert rows(got) == sorted([(*k, day) for k, day in best.items()], key=repr)


def test_a_lookup_is_measured_before_it_is_broadcast(session):
    wide = cut_lineage(session.range(10).withColumn("text", F.repeat(F.lit("x"), 1000)))
    assert fits(wide, 10) and not fits(wide, 9)
    assert fits(wide, 10, 20_000) and not fits(wide, 10, 9_000)
    assert fits(wide.limit(0), 0)


@pytest.mark.parametrize("rule", [None, DEFAULT_RULE], ids=["plain", "default"])
def test_a_large_lookup_is_not_broadcast_by_the_size_of_its_files(session, rule):
    wide = [F.lit("x" * 50).alias(f"w{i}") for i in range(40)]
    stored = cut_lineage(session.range(300_000).select(F.col("id").alias("k"), *wide))
    got = lookup_join(session.range(1_000_000).withColumnRenamed("id", "k"), stored.select("k"), ["k"], "inner", rule)
    assert got.count() == 300_000
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_no_text_is_a_join_key_of_typo_repair(session):
    df = session.createDataFrame([(1, "alimentacao saudavel"), (2, "alimentcao saudavel"), (3, ""), (4, None), (2, "alimentcao saudavel")], "k int, t string")
    words = session.createDataFrame([("alimentacao",), ("saudavel",)], "word string")
    got = repair_typos(df, "t", words, "out")
    assert rows(got) == [(1, "alimentacao saudavel", "alimentacao saudavel"), *[(2, "alimentcao saudavel", "alimentacao saudavel")] * 2, (3, "", None), (4, None, None)]
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x]
    assert joins and all("_text1" in x and "_text2" in x for x in joins)


def test_gold_is_rebalanced_before_a_task_sorts_it(session):
    from tillroll.plans import incremental as plan

    spec = plan.GoldSpec(keys=("K",), look_back=plan.last_days(7), first_load_one_row=True)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    gold = session.createDataFrame([("a", 1, d1), ("a", 1, d1), ("b", 2, d2), ("b", 2, d2), ("c", 3, None)], "K string, V int, INGESTION_DATE date")
    fresh = session.createDataFrame([("a", 5, d2), ("a", 4, d2), ("b", 0, d1)], "K string, V int, INGESTION_DATE date")
    got = plan.merge_newest(gold, fresh, spec, None)
    assert "RebalancePartitions" in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got) == [("a", 4, d2), ("b", 2, d2)]


def test_rows_of_keys_that_repeat_are_told_from_the_others(spark):
    data, df = feed(spark)
    counts = {key: sum(row[:2] == key for row in data) for key in {row[:2] for row in data}}
    alone, rest = dedup.split_repeated(df, ["k", "k2"])
    assert rows(alone) == sorted([row for row in data if counts[row[:2]] == 1], key=repr) and alone.count() > 0
    assert rows(rest) == sorted([row for row in data if counts[row[:2]] > 1], key=repr)
    assert dedup.split_repeated(df, ["k", "k2"], most=3) == (None, df)
    assert [x.count() for x in dedup.split_repeated(df.limit(0), ["k"])] == [0, 0]


@pytest.mark.parametrize("stored", [True, False])
def test_gold_rows_of_single_keys_skip_the_merge(spark, stored):
    from tillroll.plans import incremental as plan

    spec = plan.GoldSpec(keys=("K", "K2"), look_back=lambda df, asof: df, first_load_one_row=True)
    data, df = feed(spark)
    later, _ = feed(spark, n=200, seed=5)
    gold = cut_lineage(df.toDF("K", "K2", "INGESTION_DATE", "V"))
    silver = spark.createDataFrame([(k, k2, v, *((d.year, d.month, d.day) if d else (None,) * 3)) for k, k2, d, v in later], "k string, k2 int, v int, year int, month int, day int")
    first = {}
    for k, k2, d, v in later:
        if d is not None and ((k, k2) not in first or (d, -v) > (first[k, k2][0], -first[k, k2][1])):
            first[k, k2] = d, v
    fresh = [(*k, *x) for k, x in first.items()]
    got = plan.build_gold(silver, spec, dt.date(2024, 1, 9), gold, silver_is_stored=stored)
    assert rows(got.select("K", "K2", "INGESTION_DATE", "V")) == sorted(set(newest(data + fresh)), key=repr)
    assert "LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()
    loaded = plan.build_gold(silver, spec, dt.date(2024, 1, 9), silver_is_stored=stored)
    assert rows(loaded.where("INGESTION_DATE is not null").select("K", "K2", "INGESTION_DATE", "V")) == sorted(fresh, key=repr)
    assert loaded.count() == len({row[:2] for row in later})


def test_what_was_shuffled_for_a_step_goes_when_it_is_stored(session):
    from tillroll.session import CLEAN_UP

    disk = session._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.length())}

    before = kept(), session.conf.get(CLEAN_UP)
    step = cut_lineage(session.range(10_000).groupBy(F.col("id") % 100).count())
    until = time.time() + 20
    while (left := {x for x in kept() - before[0] if x.startswith("shuffle_")}) and time.time() < until:
        time.sleep(0.2)
    assert not left and step.count() == 100 and session.conf.get(CLEAN_UP) == before[1]
