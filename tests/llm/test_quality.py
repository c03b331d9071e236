import itertools
import math
import random

import numpy as np

import __spark_entry__ as repo
from tillroll.llm import gam, quality
from tillroll.llm.texts import held_out


def auc(y, p):
    good, bad = p[y == 1], p[y == 0]
    return ((good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2)


def test_model_learns_curves_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (6000, 4))
    chance = 1 / (1 + np.exp(-(3 * np.abs(x[:, 0]) - 1.5 + 4 * np.sign(x[:, 1] * x[:, 2]))))
    y = (rng.uniform(size=6000) < chance).astype(float)
    model = gam.fit(x[:4000], y[:4000])
    assert (1, 2) in model.pairs
    assert auc(y[4000:], model.score(x[4000:])) > auc(y[4000:], chance[4000:]) - 0.02


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(2)
    x, y = rng.uniform(size=(500, 3)), rng.integers(0, 2, 500).astype(float)
    model = gam.fit(x, y)
    row = x[7]
    total = model.intercept + sum(t[(e <= v).sum()] for t, e, v in zip(model.tables, model.edges, row))
    for (i, j), t in zip(model.pairs, model.pair_tables):
        total += t[(model.pair_edges[i] <= row[i]).sum(), (model.pair_edges[j] <= row[j]).sum()]
    assert model.score(row[None])[0] == np.float64(1 / (1 + math.exp(-total))) or abs(model.score(row[None])[0] - 1 / (1 + math.exp(-total))) < 1e-12


def test_best_cut_equals_trying_all():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, h = rng.standard_normal(12), rng.uniform(1, 6, 12)
        worth = lambda a, b: a.sum() ** 2 / (b.sum() + gam.RIDGE) if b.sum() >= gam.LEAST else -np.inf
        tried = [worth(g[:c], h[:c]) + worth(g[c:], h[c:]) for c in range(1, 12)]
        cut, more = gam.best_cut(g, h)
        assert np.isclose(tried[cut - 1], max(tried)) and np.isclose(more, max(tried) - g.sum() ** 2 / (h.sum() + gam.RIDGE))


def test_nothing_to_learn_from():
    model = gam.fit(np.zeros((0, 3)), np.zeros(0))
    assert model.score(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_nulls_long_texts_repeats_clashes_and_empty_tables(spark):
    rng = random.Random(5)
    good = [" ".join(rng.choices(["plain", "words", "of", "prose,"], k=60)) + "." for _ in range(60)]
    junk = [" ".join(rng.choices(["buy!!!", "now###", "$$$"], k=60)) for _ in range(60)]
    docs = [(k, t, "x") for k, t in enumerate(itertools.chain(good, junk))]
    df = spark.createDataFrame(docs + [(500, None, "x"), (501, " ", "x"), (502, "long text " * 60_000, "x"), (0, good[0], "x"), (None, "solo", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(120)] + [(3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    model = quality.learn(df, labels)
    rows = quality.with_quality(df, model).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.predicted for r in rows}
    assert all(by[k] == (k < 60) for k in range(120))
    assert quality.with_quality(df.limit(0), model).count() == 0
    assert {r.score for r in quality.with_quality(df, quality.learn(df, labels.limit(0))).collect()} == {0.5}


def test_held_out_rows_teach_nothing(session):
    df = session.createDataFrame([(k, "text " * (k % 7 + 1)) for k in range(200)], "doc_id long, text string")
    labels = df.selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    changed = labels.withColumn("quality", quality.F.when(held_out(), 1 - labels.quality).otherwise(labels.quality))
    a, b = (quality.learn(df, x) for x in (labels, changed))
    assert all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_query_on_held_out_labels(session):
    folder = repo.SMALL.replace("0.001", "0.1")
    got = repo.queries()["op5_quality_classifier"](session, folder)
    labels = session.read.parquet(f"{folder}/labels.parquet").where("quality is not null")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert auc(y, p) > 0.99
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.98
    assert got.count() == session.read.parquet(f"{folder}/documents.parquet").count()
