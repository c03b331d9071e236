"""Feeds standardised to the canonical fact."""

from __future__ import annotations

import datetime as dt

from tillroll.plans import presellout as plan
from tillroll.workload import feeds
from tillroll.workload.tables import big, day, dec, upper_or

FULL_RELOAD = dt.date(2001, 8, 1)
MID_MONTH = dt.date(2001, 8, 15)
NOT_INFORMED = "'NAO INFORMADO'"
NO_MEASURE = "cast(null as decimal(38,6))"
ZERO = "cast(0 as decimal(38,6))"


def _typed_sql(feed: str, columns: dict[str, str]) -> str:
    merged = {
        "CATEGORY": NOT_INFORMED,
        "COMPANY": "'AMBEV'",
        "BRAND": NOT_INFORMED,
        "PDV_COMPANY_NAME": NOT_INFORMED,
        "PDV_TYPE": NOT_INFORMED,
        "ID_PDV_ECOMMERCE": NOT_INFORMED,
        "REVENUE_SELLOUT": ZERO,
        "QUANTITY_STOCK_UNIT": ZERO,
        "CXA": NO_MEASURE,
        "PACK": NO_MEASURE,
        **columns,
    }
    select = ",\n".join(f"{x} as {name}" for name, x in merged.items())
    return f"with feed as ({feed}), typed as (select {select} from feed)"


def _fact_sql(
    feed: str,
    source: str,
    subsource: str,
    columns: dict[str, str],
    where: str = "",
    aggregate: bool = True,
) -> str:
    out = []
    for name in plan.FACT_COLUMNS:
        if name in plan.MEASURES:
            out.append(f"cast(sum({name}) as decimal(38,6)) as {name}" if aggregate else name)
        elif name == "SOURCE_NAME":
            out.append(f"'{source}' as {name}")
        elif name == "SUBSOURCE_NAME":
            out.append(f"'{subsource}' as {name}")
        elif name == "CHECKOUT":
            out.append("cast(0 as integer) as CHECKOUT")
        elif name.endswith("_partition"):
            part = {"ano": "year", "mes": "month", "dia": "day"}[name[:3]]
            out.append(f"cast({part}(DATA) as integer) as {name}")
        else:
            out.append(name)
    keys = [
        c
        for c in plan.FACT_COLUMNS
        if c not in plan.MEASURES
        and c not in ("SOURCE_NAME", "SUBSOURCE_NAME", "CHECKOUT")
        and not c.endswith("_partition")
    ]
    group = f"group by {', '.join(keys)}" if aggregate else ""
    return (
        f"{_typed_sql(feed, columns)} select {', '.join(out)} from typed "
        f"where DATA is not null {where} {group}"
    )


_VIRTUAL_SALE = {
    "DATA": day("coalesce(trim(replace(DATA, '-', '')), '19000101')", "%Y%m%d"),
    "CNPJ_PDV": big("CNPJ"),
    "PRODUCT_SOURCE_CODE": big("CODIGOBARRAS"),
    "PRODUCT_SOURCE_NAME": upper_or("DESCPRODUTO"),
    "CATEGORY": upper_or("SECAO"),
    "COMPANY": "case when upper(TIPO) = 'CONCORRENTE' then 'OUTRO FABRICANTE' else upper(TIPO) end",
    "SALES_VOLUME_SELLOUT": dec("QUANTIDADEVENDA"),
    "SALES_VOLUME_QUANTITY": dec("QUANTIDADEVENDA"),
    "REVENUE_SELLOUT": dec("VALORVENDA"),
    "QUANTITY_STOCK_UNIT": dec("QUANTIDADEESTOQUE"),
    "ID_PDV_ECOMMERCE": "case when upper(VENDAVIRTUAL) = 'SIM' then 'S' else 'N' end",
}


def _multiplier(i: int) -> str:
    return f"try_cast(string_split(MULT, ' X ')[{i}] as decimal(38,6))"


def _per_pack(x: str) -> str:
    # Exact: scaled integers, rounded half up to six places.
    units = f"cast({_multiplier(1)} as hugeint) * cast({_multiplier(2)} as hugeint)"
    cents = f"cast({dec(x)} * 100 as hugeint)"
    scaled = f"({cents} * 20000 + ({units})) // (nullif({units}, 0) * 2)"
    return f"cast(cast({scaled} as decimal(38,0)) / 1000000 as decimal(38,6))"


_PACK_UNIT = {
    "DATA": day("DATA", "%d/%m/%Y"),
    "CNPJ_PDV": big("CNPJ"),
    "PRODUCT_SOURCE_CODE": big("CODIGO_BARRA"),
    "PRODUCT_SOURCE_NAME": upper_or("DESCRICAO"),
    "CXA": _multiplier(1),
    "PACK": _multiplier(2),
    "SALES_VOLUME_SELLOUT": _per_pack("QTDE_VENDA_UNIDADE"),
    "SALES_VOLUME_QUANTITY": dec("QTDE_VENDA_UNIDADE"),
    "QUANTITY_STOCK_UNIT": _per_pack("ESTOQUE_BRUTO"),
}
_BANNER = {
    "DATA": day("coalesce(trim(replace(DIA, '-', '')), '19000101')", "%Y%m%d"),
    "CNPJ_PDV": big("CNPJ"),
    "PRODUCT_SOURCE_CODE": big("EAN_PRODUTO_VAREJO"),
    "PRODUCT_SOURCE_NAME": upper_or("DESCRICAO_PRODUTO_VAREJO"),
    "CATEGORY": upper_or("CATEGORIA_NIELSEN"),
    "BRAND": upper_or("MARCA_NIELSEN"),
    "SALES_VOLUME_SELLOUT": dec("QUANTIDADE_VENDA_UNIDADE"),
    "SALES_VOLUME_QUANTITY": dec("QUANTIDADE_VENDA_UNIDADE"),
    "REVENUE_SELLOUT": dec("VALOR_DE_VENDA"),
    "QUANTITY_STOCK_UNIT": dec("QUANTIDADE_ESTOQUE_UNIDADE"),
    "PDV_COMPANY_NAME": upper_or("BANDEIRA"),
    "PDV_TYPE": upper_or("TIPO_LOCAL"),
    "ID_PDV_ECOMMERCE": "case when upper(DESCRICAO_LOCAL) like '%COMMERC%' "
    "or upper(BANDEIRA) = 'E-COMMERCE' then 'S' else 'N' end",
}
_OWN_COMPANY = {
    "DATA": day("coalesce(trim(DATA_VENDA), '01/01/1900')", "%d/%m/%Y"),
    "CNPJ_PDV": big("CNPJ_LOJA"),
    "PRODUCT_SOURCE_CODE": big("EAN"),
    "PRODUCT_SOURCE_NAME": upper_or("PRODUCT_SOURCE_NAME"),
    "CATEGORY": upper_or("CATEGORY"),
    "COMPANY": upper_or("COMPANY"),
    "BRAND": upper_or("BRAND_ID"),
    "SALES_VOLUME_SELLOUT": dec("VOLUME_UNIT"),
    "SALES_VOLUME_QUANTITY": dec("PACK_QUANTITY"),
    "REVENUE_SELLOUT": dec("FATURAMENTO"),
    "PDV_COMPANY_NAME": upper_or("COMPANY"),
    "ID_PDV_ECOMMERCE": "'N'",
}


def presellout_standard(spark, folder):
    feed = feeds.virtual_sale_feed(spark, folder)
    return plan.standardise(feed, plan.VIRTUAL_SALE_FEED, FULL_RELOAD)


def presellout_window(spark, folder):
    feed = feeds.virtual_sale_feed(spark, folder)
    return plan.standardise(feed, plan.VIRTUAL_SALE_FEED, MID_MONTH)


def presellout_pack_units(spark, folder):
    feed = feeds.pack_unit_feed(spark, folder)
    return plan.standardise(feed, plan.PACK_UNIT_FEED, FULL_RELOAD)


def presellout_ecommerce_flag(spark, folder):
    feed = feeds.banner_feed(spark, folder)
    return plan.standardise(feed, plan.BANNER_FEED, FULL_RELOAD)


def presellout_own_company(spark, folder):
    feed = feeds.own_company_feed(spark, folder)
    return plan.standardise(feed, plan.OWN_COMPANY_FEED, FULL_RELOAD)


def _labels(spec):
    return spec.source, spec.subsource


QUERIES = {
    "presellout_standard": (
        presellout_standard,
        _fact_sql(feeds.VIRTUAL_SALE_SQL, *_labels(plan.VIRTUAL_SALE_FEED), _VIRTUAL_SALE),
    ),
    "presellout_window": (
        presellout_window,
        _fact_sql(
            feeds.VIRTUAL_SALE_SQL,
            *_labels(plan.VIRTUAL_SALE_FEED),
            _VIRTUAL_SALE,
            "and DATA between date '2001-06-16' and date '2001-08-15'",
        ),
    ),
    "presellout_pack_units": (
        presellout_pack_units,
        _fact_sql(feeds.PACK_UNIT_SQL, *_labels(plan.PACK_UNIT_FEED), _PACK_UNIT),
    ),
    "presellout_ecommerce_flag": (
        presellout_ecommerce_flag,
        _fact_sql(feeds.BANNER_SQL, *_labels(plan.BANNER_FEED), _BANNER),
    ),
    "presellout_own_company": (
        presellout_own_company,
        _fact_sql(
            feeds.OWN_COMPANY_SQL,
            *_labels(plan.OWN_COMPANY_FEED),
            _OWN_COMPANY,
            "and PDV_COMPANY_NAME = 'AMBEV'",
            aggregate=False,
        ),
    ),
}
