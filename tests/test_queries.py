"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as repo  # noqa: E402
from check import rows_of  # noqa: E402
from tillroll.workload import all_queries  # noqa: E402

FOLDER = Path(repo.SMALL)
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in sorted(FOLDER.glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(session, con, name):
    df = repo.queries()[name](session, str(FOLDER))
    got = rows_of(df.columns, df.collect())
    sql = repo.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry(session):
    assert repo.entry(session).limit(1).count() == 1


def test_typo_repair_equals_brute_force_on_whole_documents(session):
    """No SQL twin: every word of every text against the standard library."""
    from pyspark.sql import functions as F
    from test_vocab import brute

    from tillroll.workload import matching as m
    from tillroll.workload.tables import table

    before = {r["doc_id"]: r["text"] for r in m._misspelt(session, str(FOLDER)).collect()}
    known = table(session, str(FOLDER), "benchmark").select(
        F.regexp_replace(F.lower("text"), "[^a-z ]+", " ").alias("text")
    )
    words = {r[0] for r in m.vocab.vocabulary(known, "text").collect()}
    fixes = brute({w for text in before.values() for w in text.split(" ")}, words)
    after = repo.queries()["typo_repair"](session, str(FOLDER)).select("doc_id", "repaired")
    assert fixes
    assert {r[0]: r[1] for r in after.collect()} == {
        k: " ".join(fixes.get(w, w) for w in text.split(" ")) if text else None
        for k, text in before.items()
    }


def test_predict_input_equals_brute_force(session):
    """The repaired description of every unmatched product."""
    from test_vocab import brute

    words = {r[0] for r in repo.queries()["vocabulary"](session, str(FOLDER)).collect()}
    got = repo.queries()["predict_input"](session, str(FOLDER)).collect()
    fixes = brute({w for r in got for w in r["product_treated"].split(" ")}, words)
    assert got
    for r in got:
        text = " ".join(fixes.get(w, w) for w in r["product_treated"].split(" "))
        want = text if "unidade" in text else text + " 1unidade"
        assert r["product_description_treated"] == want


def test_the_cascade_stores_no_ids(session):
    """No query on the stored tables returns the id, so its hashes are not made."""
    from tillroll.workload import matching as m

    products, treated = m._stored(session, str(FOLDER))
    assert "id" not in treated.columns
    assert "id" in m._treated_products(session, str(FOLDER), products).columns
