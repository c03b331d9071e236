"""Retailer feeds -> the canonical 22-column sell-out fact.

One function; what differs between feeds is a ``FeedSpec``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import parse as p
from tillroll.operators.filters import like_upper, not_null, rolling_window
from tillroll.operators.shape import with_day_parts

# Fixed values -------------------------------------------------------------
ECOMMERCE_PATTERN = "%COMMERC%"
ECOMMERCE_BANNER = "E-COMMERCE"
VIRTUAL_SALE = "SIM"
MAKER_LABELS = {"CONCORRENTE": "OUTRO FABRICANTE"}
OWN_COMPANY = "AMBEV"
# ---------------------------------------------------------------------------

MEASURES = (
    "SALES_VOLUME_SELLOUT",
    "SALES_VOLUME_QUANTITY",
    "REVENUE_SELLOUT",
    "QUANTITY_STOCK_UNIT",
)

FACT_TYPES: dict[str, T.DataType] = {
    "CATEGORY": T.StringType(),
    "COMPANY": T.StringType(),
    "BRAND": T.StringType(),
    "PRODUCT_SOURCE_CODE": T.LongType(),
    "PRODUCT_SOURCE_NAME": T.StringType(),
    "DATA": T.DateType(),
    "SOURCE_NAME": T.StringType(),
    "SUBSOURCE_NAME": T.StringType(),
    "CNPJ_PDV": T.LongType(),
    "CHECKOUT": T.IntegerType(),
    "SALES_VOLUME_SELLOUT": p.MEASURE,
    "SALES_VOLUME_QUANTITY": p.MEASURE,
    "REVENUE_SELLOUT": p.MEASURE,
    "QUANTITY_STOCK_UNIT": p.MEASURE,
    "PDV_COMPANY_NAME": T.StringType(),
    "ID_PDV_ECOMMERCE": T.StringType(),
    "PDV_TYPE": T.StringType(),
    "CXA": p.MEASURE,
    "PACK": p.MEASURE,
    "ano_partition": T.IntegerType(),
    "mes_partition": T.IntegerType(),
    "dia_partition": T.IntegerType(),
}

FACT_COLUMNS = list(FACT_TYPES)


DEFAULT_TEXTS = ("CATEGORY", "BRAND", "PDV_COMPANY_NAME", "PDV_TYPE", "ID_PDV_ECOMMERCE")


@dataclass(frozen=True)
class FeedSpec:
    """How one feed's raw columns become canonical ones.

    ``columns`` maps a canonical name to a builder; names left out are the same
    in every row and take the constants below. ``aggregate`` sums the measures
    per remaining column.
    """

    source: str
    subsource: str
    columns: dict[str, Callable[[], Column]]
    aggregate: bool = True
    keep: Callable[[], Column] | None = None

    def projection(self) -> list[Column]:
        return [build().alias(name) for name, build in self.columns.items()]

    def constants(self) -> dict[str, Column]:
        given = {
            **{c: F.lit(p.NOT_INFORMED) for c in DEFAULT_TEXTS},
            **{c: F.lit(0).cast(p.MEASURE) for c in MEASURES},
            "COMPANY": F.lit(OWN_COMPANY),
            "CXA": F.lit(None).cast(p.MEASURE),
            "PACK": F.lit(None).cast(p.MEASURE),
            "SOURCE_NAME": F.lit(self.source),
            "SUBSOURCE_NAME": F.lit(self.subsource),
            "CHECKOUT": F.lit(0),
        }
        return {name: c for name, c in given.items() if name not in self.columns}


def standardise(
    feed: DataFrame, spec: FeedSpec, asof: dt.date, window_days: int | None = 60
) -> DataFrame:
    """Typed projection, date filters, sums per key, constants, partition columns.

    Constants come after the sums, so they are neither grouped nor shuffled.
    """
    typed = not_null(feed.select(*spec.projection()), "DATA")
    if spec.keep is not None:
        typed = typed.where(spec.keep())
    typed = rolling_window(typed, "DATA", asof, window_days)
    if spec.aggregate:
        measures = [c for c in typed.columns if c in MEASURES]
        keys = [c for c in typed.columns if c not in MEASURES]
        typed = typed.groupBy(*keys).agg(*[F.try_sum(m).alias(m) for m in measures])
    fact = with_day_parts(typed.withColumns(spec.constants()), "DATA")
    return fact.select(*[F.col(name).cast(kind).alias(name) for name, kind in FACT_TYPES.items()])


# The four feeds. Raw column names and labels are fixed values. --------------
VIRTUAL_SALE_FEED = FeedSpec(
    source="DIRECTSELLOUT",
    subsource="REDE_MATEUS",
    columns={
        "DATA": lambda: p.day_compact("DATA"),
        "CNPJ_PDV": lambda: p.bigint_or_zero("CNPJ"),
        "PRODUCT_SOURCE_CODE": lambda: p.bigint_or_zero("CODIGOBARRAS"),
        "PRODUCT_SOURCE_NAME": lambda: p.text_or_default("DESCPRODUTO"),
        "CATEGORY": lambda: p.text_or_default("SECAO"),
        "COMPANY": lambda: p.relabel("TIPO", MAKER_LABELS),
        "SALES_VOLUME_SELLOUT": lambda: p.locale_decimal("QUANTIDADEVENDA"),
        "SALES_VOLUME_QUANTITY": lambda: p.locale_decimal("QUANTIDADEVENDA"),
        "REVENUE_SELLOUT": lambda: p.locale_decimal("VALORVENDA"),
        "QUANTITY_STOCK_UNIT": lambda: p.locale_decimal("QUANTIDADEESTOQUE"),
        "ID_PDV_ECOMMERCE": lambda: p.yes_no(p.equals_upper("VENDAVIRTUAL", VIRTUAL_SALE)),
    },
)

PACK_UNIT_FEED = FeedSpec(
    source="ATACADAO",
    subsource="ATACADAO",
    columns={
        "DATA": lambda: p.day_slashed("DATA"),
        "CNPJ_PDV": lambda: p.bigint_or_zero("CNPJ"),
        "PRODUCT_SOURCE_CODE": lambda: p.bigint_or_zero("CODIGO_BARRA"),
        "PRODUCT_SOURCE_NAME": lambda: p.text_or_default("DESCRICAO"),
        "CXA": lambda: p.multiplier_part("MULT", 0),
        "PACK": lambda: p.multiplier_part("MULT", 1),
        "SALES_VOLUME_SELLOUT": lambda: p.per_pack(
            p.locale_decimal("QTDE_VENDA_UNIDADE"),
            p.multiplier_part("MULT", 0),
            p.multiplier_part("MULT", 1),
        ),
        "SALES_VOLUME_QUANTITY": lambda: p.locale_decimal("QTDE_VENDA_UNIDADE"),
        "QUANTITY_STOCK_UNIT": lambda: p.per_pack(
            p.locale_decimal("ESTOQUE_BRUTO"),
            p.multiplier_part("MULT", 0),
            p.multiplier_part("MULT", 1),
        ),
    },
)

BANNER_FEED = FeedSpec(
    source="NEOGRID DIRETA",
    subsource="NEOGRID DIRETA",
    columns={
        "DATA": lambda: p.day_compact("DIA"),
        "CNPJ_PDV": lambda: p.bigint_or_zero("CNPJ"),
        "PRODUCT_SOURCE_CODE": lambda: p.bigint_or_zero("EAN_PRODUTO_VAREJO"),
        "PRODUCT_SOURCE_NAME": lambda: p.text_or_default("DESCRICAO_PRODUTO_VAREJO"),
        "CATEGORY": lambda: p.text_or_default("CATEGORIA_NIELSEN"),
        "BRAND": lambda: p.text_or_default("MARCA_NIELSEN"),
        "SALES_VOLUME_SELLOUT": lambda: p.locale_decimal("QUANTIDADE_VENDA_UNIDADE"),
        "SALES_VOLUME_QUANTITY": lambda: p.locale_decimal("QUANTIDADE_VENDA_UNIDADE"),
        "REVENUE_SELLOUT": lambda: p.locale_decimal("VALOR_DE_VENDA"),
        "QUANTITY_STOCK_UNIT": lambda: p.locale_decimal("QUANTIDADE_ESTOQUE_UNIDADE"),
        "PDV_COMPANY_NAME": lambda: p.text_or_default("BANDEIRA"),
        "PDV_TYPE": lambda: p.text_or_default("TIPO_LOCAL"),
        "ID_PDV_ECOMMERCE": lambda: p.yes_no(
            like_upper("DESCRICAO_LOCAL", ECOMMERCE_PATTERN)
            | p.equals_upper("BANDEIRA", ECOMMERCE_BANNER)
        ),
    },
)

OWN_COMPANY_FEED = FeedSpec(
    source="CONDOR",
    subsource="CONDOR",
    aggregate=False,
    keep=lambda: F.col("PDV_COMPANY_NAME") == OWN_COMPANY,
    columns={
        "DATA": lambda: p.day_slashed_or_default("DATA_VENDA"),
        "CNPJ_PDV": lambda: p.bigint_or_zero("CNPJ_LOJA"),
        "PRODUCT_SOURCE_CODE": lambda: p.bigint_or_zero("EAN"),
        "PRODUCT_SOURCE_NAME": lambda: p.text_or_default("PRODUCT_SOURCE_NAME"),
        "CATEGORY": lambda: p.text_or_default("CATEGORY"),
        "COMPANY": lambda: p.text_or_default("COMPANY"),
        "BRAND": lambda: p.text_or_default("BRAND_ID"),
        "SALES_VOLUME_SELLOUT": lambda: p.locale_decimal("VOLUME_UNIT"),
        "SALES_VOLUME_QUANTITY": lambda: p.locale_decimal("PACK_QUANTITY"),
        "REVENUE_SELLOUT": lambda: p.locale_decimal("FATURAMENTO"),
        "PDV_COMPANY_NAME": lambda: p.text_or_default("COMPANY"),
        "ID_PDV_ECOMMERCE": lambda: F.lit("N"),
    },
)
