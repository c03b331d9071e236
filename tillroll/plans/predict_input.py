"""Feature text for the products no direct match was found for."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.functions import text as t
from tillroll.operators.dedup import first_per_key
from tillroll.operators.match import remove_matched
from tillroll.operators.skew import DEFAULT_RULE, HotRule
from tillroll.operators.vocab import repair_typos, vocabulary

DESCRIPTION = "product_description_treated"


def unmatched_products(treated: DataFrame, matched: DataFrame) -> DataFrame:
    """``product_id`` is unique on both sides, so no key is hot."""
    return remove_matched(
        treated, matched.select(matched["PRODUCT_ID"].alias("product_id")), ["product_id"]
    )


def prepare_master(master_treated: DataFrame) -> DataFrame:
    """One row per treated description, each with a unit count."""
    rows = master_treated.drop("brand_description", "number_description")
    return first_per_key(rows, [DESCRIPTION]).withColumn(DESCRIPTION, t.add_unit(DESCRIPTION))


def with_feature_text(df: DataFrame) -> DataFrame:
    """Unit count, number description and brand description of ``DESCRIPTION``."""
    with_unit = df.withColumn(DESCRIPTION, t.add_unit(DESCRIPTION))
    return with_unit.withColumns(
        {
            "number_description": t.number_words(DESCRIPTION),
            "brand_description": t.brand_words(DESCRIPTION),
        }
    )


def predict_input(
    treated: DataFrame,
    master_treated: DataFrame,
    matched: DataFrame,
    unmatched: str = "keep",
    rule: HotRule | None = DEFAULT_RULE,
) -> DataFrame:
    rows = unmatched_products(treated, matched)
    words = vocabulary(prepare_master(master_treated), DESCRIPTION)
    repaired = repair_typos(
        rows, "product_treated", words, DESCRIPTION, unmatched, rule
    )
    return with_feature_text(repaired).drop("brand_id")
