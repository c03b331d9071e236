"""Products against the master catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import fixed_values as fixed
from tillroll.functions.parse import fill_when, safe_cast
from tillroll.operators.dedup import first_per_key
from tillroll.operators.shape import drop_columns, with_typed_nulls
from tillroll.operators.skew import DEFAULT_RULE, HotRule, lookup_join, shuffled
from tillroll.session import cut_lineage

# Fixed values -------------------------------------------------------------
INTERNAL_PRODUCT = T.ArrayType(
    T.StructType(
        [
            T.StructField("COD_PROD", T.IntegerType(), True),
            T.StructField("COD_ABREV_PROD", T.IntegerType(), True),
            T.StructField("NOM_PROD", T.StringType(), False),
            T.StructField("CESTA_OFICIAL", T.IntegerType(), False),
            T.StructField("EAN_PACK", T.LongType(), False),
            T.StructField("EAN_UNIT", T.LongType(), False),
            T.StructField("INNOVATION", T.StringType(), False),
            T.StructField("FUTURE_BEVS", T.StringType(), False),
            T.StructField("COD_PROD_GERENCIAL_VENDAS", T.IntegerType(), False),
            T.StructField("NOM_PROD_GERENCIAL_VENDAS", T.StringType(), False),
        ]
    )
)
CATALOGUE_NOISE = ("year", "month", "day", "ID", "FRIENDLY_NAME")
PRODUCT_COLUMNS = (
    "PRODUCT_ID",
    "SUBSOURCE_NAME",
    "SOURCE_NAME",
    "BRAND",
    "PRODUCT_SOURCE_NAME",
    "PRODUCT_SOURCE_CODE",
    "MED_CANT_CONTENIDO",
    "UNIDADES_CONTENIDO",
)
TREATED_NAMES = {
    "product_id": "PRODUCT_ID",
    "source_table": "SUBSOURCE_NAME",
    "source_name": "SOURCE_NAME",
    "brand_original": "BRAND",
    "product_original": "PRODUCT_SOURCE_NAME",
    "product_source_code": "PRODUCT_SOURCE_CODE",
    "med_cant_contenido": "MED_CANT_CONTENIDO",
    "unidades_contenido": "UNIDADES_CONTENIDO",
}
# ---------------------------------------------------------------------------

STAGE_LABELS = {
    1: fixed.MATCH_EAN,
    2: fixed.MATCH_EAN,
    3: fixed.MATCH_NAME,
    4: fixed.MATCH_NAME,
    5: fixed.MATCH_TREATED,
}


def catalogue(master: DataFrame) -> DataFrame:
    return drop_columns(master, CATALOGUE_NOISE).withColumnRenamed(
        "PRODUCT_SOURCE_NAME", "PRODUCT_SOURCE_NAME_MASTER"
    )


def generic_catalogue(master: DataFrame) -> DataFrame:
    """The generic catalogue lacks two columns of the other one."""
    return with_typed_nulls(
        catalogue(master),
        {"AUTO_FILL_SELLIN": T.StringType(), "MATCH_INTERNAL_PRODUCT": INTERNAL_PRODUCT},
    )


def _own_volume() -> Column:
    return (F.col("SOURCE_NAME") == fixed.OWN_VOLUME_SOURCE) & (
        F.col("SUBSOURCE_NAME") == fixed.OWN_VOLUME_SUBSOURCE
    )


def fill_own_volume(products: DataFrame) -> DataFrame:
    """The source with its own volumes leaves out the ones."""
    return products.withColumns(
        {
            c: fill_when(c, _own_volume(), "1")
            for c in ("UNIDADES_CONTENIDO", "MED_CANT_CONTENIDO")
        }
    )


def update_match_columns(matched: DataFrame) -> DataFrame:
    """Volume, pack and unit volume of that source replace the catalogue's."""
    volume = safe_cast("MED_CANT_CONTENIDO", "int")
    units = safe_cast("UNIDADES_CONTENIDO", "int")
    per_unit = F.round(F.try_divide(volume, units), 0).try_cast("bigint")

    def pick(own: Column, name: str) -> Column:
        kind = matched.schema[name].dataType
        return F.when(_own_volume(), own.cast("string").try_cast(kind)).otherwise(F.col(name))

    return matched.withColumns(
        {
            "VOLUME_TOTAL": pick(F.col("MED_CANT_CONTENIDO"), "VOLUME_TOTAL"),
            "PACK_QUANTITY": pick(F.col("UNIDADES_CONTENIDO"), "PACK_QUANTITY"),
            "VOLUME_UNIT": pick(per_unit, "VOLUME_UNIT"),
        }
    ).drop("MED_CANT_CONTENIDO", "UNIDADES_CONTENIDO")


def master_keys(master: DataFrame, array: str, stage: int, attributes: list[str]) -> DataFrame:
    """``(key, stage, entry)`` for each element of an array of keys."""
    return master.select(
        F.explode(F.col(array).cast("array<string>")).alias("key"),
        F.lit(stage).alias("stage"),
        F.struct(*attributes).alias("entry"),
    ).where(F.col("key").isNotNull())


def best_per_key(entries: DataFrame) -> DataFrame:
    """One entry per key: the earliest stage, then the least entry.

    After this a product meets one entry per key, however many share it.
    """
    return first_per_key(entries, ["key_type", "key"], [F.col("stage")])


def remove_matched(
    df: DataFrame, matched: DataFrame, keys: list[str], rule: HotRule | None = None
) -> DataFrame:
    """Rows whose key is not in ``matched``. Give a rule when keys repeat in ``df``."""
    return lookup_join(
        df, matched.select(*keys).distinct(), keys, "left_anti", rule, broadcast_rows=0
    )


def _product_keys(products: DataFrame, treated: DataFrame | None) -> DataFrame:
    ean = F.when(
        F.col("PRODUCT_SOURCE_CODE") != 0, F.col("PRODUCT_SOURCE_CODE").cast("string")
    )
    pairs = F.array(
        F.struct(F.lit("ean").alias("key_type"), ean.alias("key")),
        F.struct(F.lit("name").alias("key_type"), F.col("PRODUCT_SOURCE_NAME").alias("key")),
    )
    keys = products.select("PRODUCT_ID", F.explode(pairs).alias("k")).select(
        "PRODUCT_ID", "k.key_type", "k.key"
    )
    if treated is not None:
        keys = keys.unionByName(
            treated.select(
                "PRODUCT_ID", F.lit("treated").alias("key_type"), F.col("product_treated").alias("key")
            )
        )
    return keys.where(F.col("key").isNotNull())


def _treated_entries(
    master: DataFrame, master_treated: DataFrame, attributes: list[str]
) -> DataFrame:
    """Treated text -> description -> entry of the main catalogue."""
    links = master_treated.select(
        F.col("product_treated").alias("key"),
        F.col("product_description").alias("PRODUCT_DESCRIPTION"),
    ).distinct()
    # One entry per description, so equal descriptions do not multiply.
    entries = first_per_key(master.select(*attributes), ["PRODUCT_DESCRIPTION"])
    return links.join(entries, "PRODUCT_DESCRIPTION").select(
        "key", F.lit(5).alias("stage"), F.struct(*attributes).alias("entry")
    )


def match_products(
    products: DataFrame,
    master: DataFrame,
    generic: DataFrame,
    treated: DataFrame | None = None,
    master_treated: DataFrame | None = None,
    rule: HotRule | None = DEFAULT_RULE,
) -> DataFrame:
    """Code, then name, then treated text; main catalogue before generic.

    One row per matched product, with the entry of its earliest stage. All
    catalogue keys meet all product keys in one join and the earliest stage is
    picked by an aggregate, so no stage waits for, or repeats, the one before.
    """
    main, other = catalogue(master), generic_catalogue(generic)
    attributes = [
        c for c in main.columns if c not in ("EAN", "PRODUCT_SOURCE_NAME_MASTER")
    ]

    kinds = {c: main.schema[c].dataType for c in attributes}
    other = other.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})

    def typed(entries: DataFrame, key_type: str) -> DataFrame:
        return entries.withColumn("key_type", F.lit(key_type))

    tables = [
        typed(master_keys(main, "EAN", 1, attributes), "ean"),
        typed(master_keys(other, "EAN", 2, attributes), "ean"),
        typed(master_keys(main, "PRODUCT_SOURCE_NAME_MASTER", 3, attributes), "name"),
        typed(master_keys(other, "PRODUCT_SOURCE_NAME_MASTER", 4, attributes), "name"),
    ]
    named_treated = None
    if treated is not None:
        named_treated = treated.withColumnsRenamed(TREATED_NAMES)
        tables.append(typed(_treated_entries(main, master_treated, attributes), "treated"))
    best_entries = best_per_key(reduce(DataFrame.unionByName, tables))
    # Numbered in the order of the entries: numbers, not entries, travel with products.
    entries = cut_lineage(best_entries.orderBy("entry").withColumn("number", F.monotonically_increasing_id()))

    filled = fill_own_volume(products).select(*PRODUCT_COLUMNS)
    keys = _product_keys(filled, named_treated)
    found = lookup_join(keys, entries.drop("entry"), ["key_type", "key"], "inner", rule)
    # Entries of one stage are ordered too: equal stages never depend on row order.
    chosen = (
        found.groupBy("PRODUCT_ID")
        .agg(F.min(F.struct("stage", "number")).alias("first"))
        .select("PRODUCT_ID", "first.stage", "first.number")
    )
    best = lookup_join(chosen, entries.select("number", "entry"), ["number"], "inner", rule).drop("number")

    rows = first_per_key(filled, ["PRODUCT_ID"]).withColumn("_treated", F.lit(False))
    if named_treated is not None:
        rows = rows.unionByName(
            first_per_key(
                named_treated.select(
                    *[F.col(c).cast(filled.schema[c].dataType).alias(c) for c in PRODUCT_COLUMNS]
                ),
                ["PRODUCT_ID"],
            ).withColumn("_treated", F.lit(True))
        )
    label = reduce(
        lambda other, item: F.when(F.col("stage") == item[0], item[1]).otherwise(other),
        STAGE_LABELS.items(),
        F.lit(None).cast("string"),
    )
    matched = (
        rows.join(shuffled(best), "PRODUCT_ID")
        .where(F.col("_treated") == (F.col("stage") == 5))
        .select(*PRODUCT_COLUMNS, "entry.*", label.alias("PRODUCT_MATCH_TYPE"))
    )
    return update_match_columns(matched)


def match_one_key(
    products: DataFrame,
    master: DataFrame,
    by_code: bool,
    rule: HotRule | None = DEFAULT_RULE,
) -> DataFrame:
    """A single stage: products against one catalogue, by code or by name."""
    main = catalogue(master)
    array = "EAN" if by_code else "PRODUCT_SOURCE_NAME_MASTER"
    attributes = [c for c in main.columns if c not in ("EAN", "PRODUCT_SOURCE_NAME_MASTER")]
    label = fixed.MATCH_EAN if by_code else fixed.MATCH_NAME
    entries = master_keys(main, array, 1, attributes).withColumn("key_type", F.lit("one"))
    best = cut_lineage(best_per_key(entries).select("key", "entry"))
    key = F.col("PRODUCT_SOURCE_CODE") if by_code else F.col("PRODUCT_SOURCE_NAME")
    rows = products.select(*PRODUCT_COLUMNS)
    if by_code:
        rows = rows.where(F.col("PRODUCT_SOURCE_CODE") != 0)
    rows = rows.withColumn("key", key.cast("string"))
    found = lookup_join(rows, best, ["key"], "inner", rule)
    return first_per_key(
        found.select(*PRODUCT_COLUMNS, "entry.*", F.lit(label).alias("PRODUCT_MATCH_TYPE")),
        ["PRODUCT_ID"],
    )
