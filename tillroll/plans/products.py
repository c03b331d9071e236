"""Distinct products -> treated product text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions import text as t
from tillroll.operators.filters import complete_rows, differs
from tillroll.operators.shape import keep_original, with_row_id
from tillroll.operators.skew import lookup_join
from tillroll.session import cut_lineage

# Fixed values -------------------------------------------------------------
TREATED_COLUMNS = {
    "BRAND": "brand_id",
    "BRAND_ORIGINAL": "brand_original",
    "MED_CANT_CONTENIDO": "med_cant_contenido",
    "UNIDADES_CONTENIDO": "unidades_contenido",
    "PRODUCT_SOURCE_NAME": "product",
    "PRODUCT_SOURCE_NAME_ORIGINAL": "product_original",
    "PRODUCT_ID": "product_id",
    "PRODUCT_SOURCE_CODE": "product_source_code",
    "SOURCE_NAME": "source_name",
    "SUBSOURCE_NAME": "source_table",
}
MAY_BE_NULL = ("unidades_contenido", "med_cant_contenido")
# ---------------------------------------------------------------------------

# Up to this many distinct volumes go into the plan as constants.
MOST_VOLUMES = 5_000


def select_products(products: DataFrame, use_brand: bool = False) -> DataFrame:
    """Named, distinct, complete products of real sources."""
    code = F.when(F.col("SUBSOURCE_NAME").contains(fixed.AUDIT_MARK), F.lit(0).cast("bigint"))
    kept = keep_original(keep_original(products, "PRODUCT_SOURCE_NAME"), "BRAND")
    named = kept.withColumns(
        {
            "PRODUCT_SOURCE_CODE": code.otherwise(F.col("PRODUCT_SOURCE_CODE")),
            "BRAND": t.protect_phrases("BRAND", fixed.BRAND_PHRASES),
            "PRODUCT_SOURCE_NAME": t.protect_phrases(
                "PRODUCT_SOURCE_NAME", fixed.PRODUCT_PHRASES
            ),
        }
    ).select(*[F.col(old).alias(new) for old, new in TREATED_COLUMNS.items()])
    joined = F.concat_ws(" ", "product", "brand_id") if use_brand else F.col("product")
    rows = differs(named, "source_table", fixed.FACTORY_SOURCE)
    rows = complete_rows(rows.withColumn("product_aggregated", joined), MAY_BE_NULL)
    return rows.distinct()


def volume_test(
    volumes: DataFrame, most: int = MOST_VOLUMES
) -> Callable[[Column], Column] | None:
    """A constant-set test of volume words, or None when there are too many.

    Reads at most ``most + 1`` values to the driver, whatever the table holds.
    """
    few = [r[0] for r in volumes.limit(most + 1).collect()]
    if len(few) > most:
        return None
    return lambda w: w.isin(few) if few else F.lit(False)


def add_volume_mark(
    df: DataFrame,
    key: str,
    column: str,
    master: DataFrame,
    volume: str = "volume_unit",
    most: int = MOST_VOLUMES,
) -> DataFrame:
    """``ml`` after the one word of a text that is a volume of the catalogue.

    A short volume list becomes part of the expression. A long one is joined
    to the words of each row, counted, and the single hit comes back by key.
    """
    volumes = (
        master.select(F.col(volume).cast("string").alias("_volume"))
        .where(F.col("_volume").isNotNull())
        .distinct()
    )
    test = volume_test(volumes, most)
    if test is not None:
        return df.withColumn(column, t.mark_volume(column, test))
    tokens = df.select(key, F.explode(t.words(column)).alias("_volume"))
    hits = (
        lookup_join(tokens, volumes, ["_volume"], "inner", broadcast_rows=0)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_hits"), F.min("_volume").alias("_hit"))
        .where("_hits = 1")
    )
    marked = F.replace(
        F.col(column), F.col("_hit"), F.concat(F.col("_hit"), F.lit(fixed.VOLUME_SUFFIX))
    )
    return (
        df.join(hits, key, "left")
        .withColumn(column, F.coalesce(marked, F.col(column)))
        .drop("_hits", "_hit")
    )


def treat_products(
    products: DataFrame, master_treated: DataFrame, use_brand: bool = False
) -> DataFrame:
    """Select, id, unique words, description treatment, volume mark.

    Names repeat across stores, so each distinct one is treated once and comes
    back by name. The id is hashed as the stored rows are read, so a caller that
    drops it does not pay for it.
    """
    rows = cut_lineage(select_products(products, use_brand))
    rows = with_row_id(rows, "id", rows.columns).fillna("")
    names = rows.select("product_aggregated").distinct()
    treated = t.description_treatment(t.unique_words("product_aggregated"))
    done = add_volume_mark(
        names.withColumn("product_treated", treated),
        "product_aggregated",
        "product_treated",
        master_treated,
    )
    return lookup_join(rows, cut_lineage(done), ["product_aggregated"], "inner").select(
        *rows.columns, "product_treated"
    )
