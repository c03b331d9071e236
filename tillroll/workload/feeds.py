"""The given tables dressed up as raw retailer feeds: all text, some of it dirty.

Each feed comes as a DataFrame builder and as a SQL body with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.workload.tables import comma, spread, table

CODE_BASE = 7_890_000_000_000


def comma_text(c: str) -> Column:
    return F.replace(F.col(c).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def text(c: str) -> Column:
    return F.col(c).cast("string")


def code_text(c: str) -> Column:
    return (F.lit(CODE_BASE) + F.col(c)).cast("string")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spread(table(spark, folder, "lineitem"))
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


LINES = "lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"


def virtual_sale_feed(spark: SparkSession, folder: str) -> DataFrame:
    ship = F.date_format("l_shipdate", "yyyy-MM-dd")
    return _lines(spark, folder).select(
        F.when(F.col("l_linenumber") == 7, None)
        .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"), "sem data")
        .otherwise(ship)
        .alias("DATA"),
        F.when(F.col("l_linenumber") == 5, "NaN").otherwise(text("l_suppkey")).alias("CNPJ"),
        F.when(F.col("p_size") > 1, F.lower("p_type")).alias("SECAO"),
        F.col("p_name").alias("DESCPRODUTO"),
        F.concat(
            code_text("l_partkey"), F.when(F.col("l_linenumber") == 4, ".0").otherwise("")
        ).alias("CODIGOBARRAS"),
        comma_text("l_quantity").alias("QUANTIDADEVENDA"),
        F.when((F.col("l_linenumber") == 3) & (F.col("l_returnflag") == "N"), "1.234,50")
        .otherwise(comma_text("l_extendedprice"))
        .alias("VALORVENDA"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Sim").otherwise("nao").alias("VENDAVIRTUAL"),
        F.when(F.col("l_linestatus") == "F", comma_text("l_tax")).alias("QUANTIDADEESTOQUE"),
        F.when(F.col("o_orderstatus") == "F", "Concorrente").otherwise("Fabricante").alias("TIPO"),
    )


VIRTUAL_SALE_SQL = f"""
  select case when l_linenumber = 7 then null
              when l_linenumber = 6 and l_returnflag = 'R' then 'sem data'
              else strftime(l_shipdate, '%Y-%m-%d') end as DATA,
         case when l_linenumber = 5 then 'NaN' else cast(l_suppkey as varchar) end as CNPJ,
         case when p_size > 1 then lower(p_type) end as SECAO,
         p_name as DESCPRODUTO,
         cast({CODE_BASE} + l_partkey as varchar)
           || case when l_linenumber = 4 then '.0' else '' end as CODIGOBARRAS,
         {comma('l_quantity')} as QUANTIDADEVENDA,
         case when l_linenumber = 3 and l_returnflag = 'N' then '1.234,50'
              else {comma('l_extendedprice')} end as VALORVENDA,
         case when o_orderpriority = '1-URGENT' then 'Sim' else 'nao' end as VENDAVIRTUAL,
         case when l_linestatus = 'F' then {comma('l_tax')} end as QUANTIDADEESTOQUE,
         case when o_orderstatus = 'F' then 'Concorrente' else 'Fabricante' end as TIPO
  from {LINES}
"""


def pack_unit_feed(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread(table(spark, folder, "lineitem")).join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.select(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("DATA"),
        F.concat(F.lit(" "), text("l_suppkey"), F.lit(" ")).alias("CNPJ"),
        code_text("l_partkey").alias("CODIGO_BARRA"),
        F.col("p_name").alias("DESCRICAO"),
        F.when(F.col("l_linenumber") == 1, text("p_size"))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("0 X "), text("p_size")))
        .otherwise(F.concat(text("p_size"), F.lit(" X "), text("l_linenumber")))
        .alias("MULT"),
        comma_text("l_extendedprice").alias("QTDE_VENDA_UNIDADE"),
        F.when(F.col("l_returnflag") != "A", comma_text("l_quantity")).alias("ESTOQUE_BRUTO"),
    )


PACK_UNIT_SQL = f"""
  select strftime(l_shipdate, '%d/%m/%Y') as DATA,
         ' ' || l_suppkey || ' ' as CNPJ,
         cast({CODE_BASE} + l_partkey as varchar) as CODIGO_BARRA,
         p_name as DESCRICAO,
         case when l_linenumber = 1 then cast(p_size as varchar)
              when l_linenumber = 2 then '0 X ' || p_size
              else p_size || ' X ' || l_linenumber end as MULT,
         {comma('l_extendedprice')} as QTDE_VENDA_UNIDADE,
         case when l_returnflag <> 'A' then {comma('l_quantity')} end as ESTOQUE_BRUTO
  from lineitem join part on l_partkey = p_partkey
"""


def banner_feed(spark: SparkSession, folder: str) -> DataFrame:
    rows = (
        spread(table(spark, folder, "orders"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        text("c_nationkey").alias("CODIGO_VAREJO"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Dia")
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("DIA"),
        text("o_custkey").alias("CNPJ"),
        code_text("c_nationkey").alias("EAN_PRODUTO_VAREJO"),
        F.col("o_orderpriority").alias("DESCRICAO_PRODUTO_VAREJO"),
        F.when(F.col("o_orderstatus") == "O", "0,00")
        .otherwise(comma_text("o_totalprice"))
        .alias("QUANTIDADE_VENDA_UNIDADE"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "-1,00")
        .otherwise("0")
        .alias("QUANTIDADE_ESTOQUE_UNIDADE"),
        comma_text("o_totalprice").alias("VALOR_DE_VENDA"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Loja e-commerce")
        .otherwise("Loja")
        .alias("DESCRICAO_LOCAL"),
        F.when(F.col("n_regionkey") == 0, "E-commerce").otherwise(F.col("n_name")).alias("BANDEIRA"),
        F.col("c_mktsegment").alias("TIPO_LOCAL"),
        F.lower("c_mktsegment").alias("CATEGORIA_NIELSEN"),
        F.when(F.col("n_regionkey") != 1, F.col("n_name")).alias("MARCA_NIELSEN"),
    )


BANNER_SQL = f"""
  select cast(c_nationkey as varchar) as CODIGO_VAREJO,
         case when o_orderpriority = '5-LOW' then 'Dia'
              when o_orderstatus = 'F' then strftime(o_orderdate, '%d/%m/%Y')
              else strftime(o_orderdate, '%Y-%m-%d') end as DIA,
         cast(o_custkey as varchar) as CNPJ,
         cast({CODE_BASE} + c_nationkey as varchar) as EAN_PRODUTO_VAREJO,
         o_orderpriority as DESCRICAO_PRODUTO_VAREJO,
         case when o_orderstatus = 'O' then '0,00' else {comma('o_totalprice')} end
           as QUANTIDADE_VENDA_UNIDADE,
         case when c_mktsegment = 'MACHINERY' then '-1,00' else '0' end
           as QUANTIDADE_ESTOQUE_UNIDADE,
         {comma('o_totalprice')} as VALOR_DE_VENDA,
         case when c_mktsegment = 'HOUSEHOLD' then 'Loja e-commerce' else 'Loja' end
           as DESCRICAO_LOCAL,
         case when n_regionkey = 0 then 'E-commerce' else n_name end as BANDEIRA,
         c_mktsegment as TIPO_LOCAL,
         lower(c_mktsegment) as CATEGORIA_NIELSEN,
         case when n_regionkey <> 1 then n_name end as MARCA_NIELSEN
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def own_company_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select(
        F.when(F.col("l_linenumber") == 7, None)
        .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy"))
        .alias("DATA_VENDA"),
        text("l_suppkey").alias("CNPJ_LOJA"),
        code_text("l_partkey").alias("EAN"),
        F.col("p_name").alias("PRODUCT_SOURCE_NAME"),
        comma_text("l_quantity").alias("VOLUME_UNIT"),
        F.col("o_orderpriority").alias("MEA_UNIT"),
        text("l_linenumber").alias("PACK_QUANTITY"),
        comma_text("l_extendedprice").alias("FATURAMENTO"),
        F.lower("p_type").alias("CATEGORY"),
        F.when(F.col("o_orderstatus") == "O", "Ambev").otherwise(F.col("p_brand")).alias("COMPANY"),
        F.col("p_brand").alias("BRAND_ID"),
    )


OWN_COMPANY_SQL = f"""
  select case when l_linenumber = 7 then null
              else strftime(l_shipdate, '%d/%m/%Y') end as DATA_VENDA,
         cast(l_suppkey as varchar) as CNPJ_LOJA,
         cast({CODE_BASE} + l_partkey as varchar) as EAN,
         p_name as PRODUCT_SOURCE_NAME,
         {comma('l_quantity')} as VOLUME_UNIT,
         o_orderpriority as MEA_UNIT,
         cast(l_linenumber as varchar) as PACK_QUANTITY,
         {comma('l_extendedprice')} as FATURAMENTO,
         lower(p_type) as CATEGORY,
         case when o_orderstatus = 'O' then 'Ambev' else p_brand end as COMPANY,
         p_brand as BRAND_ID
  from {LINES}
"""


def with_ingestion(df: DataFrame, day: Column) -> DataFrame:
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
