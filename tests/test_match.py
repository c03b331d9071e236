import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillroll.operators import match
from tillroll.operators.skew import HotRule
from tillroll.plans import predict_input as predict
from tillroll.plans import products as treat

HOT = HotRule(min_rows=1)
CATALOGUE = (
    "EAN array<bigint>, PRODUCT_SOURCE_NAME array<string>, PRODUCT_DESCRIPTION string, "
    "VOLUME_TOTAL string, PACK_QUANTITY string, VOLUME_UNIT string, ID int, FRIENDLY_NAME string, "
    "year int, month int, day int"
)
NOISE = (1, "f", 2024, 1, 1)


@pytest.fixture
def master(spark):
    data = [
        ([11, 12], ["SKOL", "SKOL LT"], "skol 350ml", "350", "1", "350", *NOISE),
        ([12], ["SKOL LT"], "askol 350ml", "350", "1", "350", *NOISE),
        ([13], ["BRAHMA"], "brahma 600ml", "600", "1", "600", *NOISE),
    ]
    df = spark.createDataFrame(data, CATALOGUE)
    return df.withColumn("AUTO_FILL_SELLIN", F.lit("S")).withColumn(
        "MATCH_INTERNAL_PRODUCT", F.lit(None).cast(match.INTERNAL_PRODUCT)
    )


@pytest.fixture
def generic(spark):
    data = [
        ([11, 21], ["GENERIC", "BRAHMA"], "generic 1l", "1000", "1", "1000", *NOISE),
    ]
    return spark.createDataFrame(data, CATALOGUE)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [
            ("1", "ST", "SRC", "B", "SKOL", 11, None, None),  # code in both: main wins
            ("2", "ST", "SRC", "B", "BRAHMA", 21, None, None),  # generic code before main name
            ("3", "ST", "SRC", "B", "BRAHMA", 0, None, None),  # name in both: main wins
            ("4", "ST", "SRC", "B", "GENERIC", 99, None, None),  # generic name
            ("5", "ST", "SRC", "B", "skol dirty", 0, None, None),  # treated
            ("6", "ST", "SRC", "B", "nothing", 0, None, None),  # none
            ("7", "DIAFULL", "SCANNTECH", "B", "x", 12, "700", None),  # own volume
            ("8", "DIAFULL", "SCANNTECH", "B", "x", 13, None, "0"),  # own volume, no units
        ],
        "PRODUCT_ID string, SUBSOURCE_NAME string, SOURCE_NAME string, BRAND string, "
        "PRODUCT_SOURCE_NAME string, PRODUCT_SOURCE_CODE bigint, MED_CANT_CONTENIDO string, "
        "UNIDADES_CONTENIDO string",
    )


@pytest.fixture
def treated(products):
    lower = {new: old for old, new in match.TREATED_NAMES.items()}
    return products.withColumnsRenamed(lower).withColumn(
        "product_treated",
        F.when(F.col("product_id").isin("5", "1"), "skol clean").otherwise(F.col("product_id")),
    )


@pytest.fixture
def master_treated(spark):
    return spark.createDataFrame(
        [("skol clean", "not in the catalogue"), ("skol clean", "skol 350ml"), ("3", "brahma 600ml")],
        "product_treated string, product_description string",
    )


@pytest.mark.parametrize("rule", [None, HOT], ids=["plain", "hot"])
def test_cascade(products, master, generic, treated, master_treated, rule):
    got = match.match_products(products, master, generic, treated, master_treated, rule)
    shown = got.select(
        "PRODUCT_ID", "PRODUCT_MATCH_TYPE", "PRODUCT_DESCRIPTION", "VOLUME_TOTAL", "PACK_QUANTITY",
        "VOLUME_UNIT",
    )
    assert rows(shown) == [
        ("1", "EAN", "skol 350ml", "350", "1", "350"),
        ("2", "EAN", "generic 1l", "1000", "1", "1000"),
        ("3", "DESCRICAO", "brahma 600ml", "600", "1", "600"),
        ("4", "DESCRICAO", "generic 1l", "1000", "1", "1000"),
        ("5", "DESCRICAO_TRATADA", "skol 350ml", "350", "1", "350"),
        ("7", "EAN", "askol 350ml", "700", "1", "700"),
        ("8", "EAN", "brahma 600ml", "1", "0", None),
    ]
    left = match.remove_matched(products, got, ["PRODUCT_ID"])
    assert rows(left.select("PRODUCT_ID")) == [("6",)]


@pytest.mark.parametrize("rule", [None, HOT], ids=["plain", "hot"])
def test_single_stages(products, master, rule):
    by_code = match.match_one_key(products, master, by_code=True, rule=rule)
    assert [r[0] for r in rows(by_code.select("PRODUCT_ID"))] == ["1", "7", "8"]
    by_name = match.match_one_key(products, master, by_code=False, rule=rule)
    assert [r[0] for r in rows(by_name.select("PRODUCT_ID"))] == ["1", "2", "3"]


def test_many_catalogue_rows_of_one_key_do_not_multiply(session):
    data = [([5], ["A"], f"d{i}", "1", "1", "1", *NOISE) for i in range(50)]
    master = session.createDataFrame(data, CATALOGUE).withColumn(
        "AUTO_FILL_SELLIN", F.lit("S")
    ).withColumn("MATCH_INTERNAL_PRODUCT", F.lit(None).cast(match.INTERNAL_PRODUCT))
    products = session.createDataFrame(
        [(str(i), "s", "t", "b", "A", 5, None, None) for i in range(200)],
        "PRODUCT_ID string, SUBSOURCE_NAME string, SOURCE_NAME string, BRAND string, "
        "PRODUCT_SOURCE_NAME string, PRODUCT_SOURCE_CODE bigint, MED_CANT_CONTENIDO string, "
        "UNIDADES_CONTENIDO string",
    )
    got = match.match_one_key(products, master, by_code=True)
    assert got.count() == 200
    assert rows(got.select("PRODUCT_DESCRIPTION").distinct()) == [("d0",)]


def test_matched_and_unmatched_make_the_whole(products, master, generic, treated, master_treated):
    matched = match.match_products(products, master, generic, treated, master_treated)
    rest = predict.unmatched_products(treated, matched)
    ids = [r[0] for r in rows(matched.select("PRODUCT_ID"))]
    assert len(ids) == len(set(ids))
    assert sorted(ids + [r[0] for r in rows(rest.select("product_id"))]) == [
        str(i) for i in range(1, 9)
    ]


def test_predict_input(spark, treated):
    catalogue = spark.createDataFrame(
        [("antarctica 350ml", "b", "n"), ("antarctica 350ml", "b", "n"), ("skol lt 6unidade", "b", "n")],
        "product_description_treated string, brand_description string, number_description string",
    )
    matched = spark.createDataFrame([(str(i),) for i in range(3, 9)], "PRODUCT_ID string")
    texts = treated.withColumn("brand_id", F.lit("b")).withColumn(
        "product_treated",
        F.when(F.col("product_id") == "1", "antartica lt 350ml").otherwise("skol 2unidade"),
    )
    got = predict.predict_input(texts, catalogue, matched)
    assert "brand_id" not in got.columns
    assert rows(
        got.select("product_id", predict.DESCRIPTION, "number_description", "brand_description")
    ) == [
        ("1", "antarctica lt 350ml 1unidade", "lt 350ml 1unidade", "antarctica lt"),
        ("2", "skol 2unidade", "2unidade", "skol"),
    ]


def test_treat_products(spark):
    products = spark.createDataFrame(
        [
            ("1", "S", "STORE", "Outra Marca", "Suco DO BEM 350 lt lt", 7, None, None),
            ("2", "S", "X AUDIT", "b", "Cerv. 12x600", 7, "1", "2"),
            ("3", "S", "FABRICA", "b", "x", 7, None, None),
            ("4", "S", "STORE", None, "x", 7, None, None),
            ("1", "S", "STORE", "Outra Marca", "Suco DO BEM 350 lt lt", 7, None, None),
        ],
        "PRODUCT_ID string, SOURCE_NAME string, SUBSOURCE_NAME string, BRAND string, "
        "PRODUCT_SOURCE_NAME string, PRODUCT_SOURCE_CODE bigint, MED_CANT_CONTENIDO string, "
        "UNIDADES_CONTENIDO string",
    )
    volumes = spark.createDataFrame([("350",), (None,), ("600",)], "volume_unit string")
    got = treat.treat_products(products, volumes)
    shown = got.select(
        "product_id", "brand_id", "product_source_code", "product_treated", "unidades_contenido"
    )
    assert rows(shown) == [
        ("1", "OUTRAMARCA", 7, "suco dobem 350000ml", ""),
        ("2", "b", 0, "cerveja 12unidade 600ml", "2"),
    ]
    assert got.select("id").distinct().count() == 2


@pytest.mark.parametrize("most", [0, 10], ids=["joined", "inlined"])
def test_volume_mark_both_ways(spark, most):
    df = spark.createDataFrame(
        [(1, "a 350 b"), (2, "350 600"), (3, "350 350"), (4, "x"), (5, "")], "id int, t string"
    )
    volumes = spark.createDataFrame([(350,), (600,), (None,)], "volume_unit int")
    got = treat.add_volume_mark(df, "id", "t", volumes, most=most)
    assert rows(got.select("id", "t")) == [
        (1, "a 350ml b"), (2, "350 600"), (3, "350 350"), (4, "x"), (5, ""),
    ]
