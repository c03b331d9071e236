"""Products of the lines matched to a catalogue made from the parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import text as t
from tillroll.operators import audit, match, vocab
from tillroll.operators.match import INTERNAL_PRODUCT
from tillroll.plans import predict_input as predict
from tillroll.plans import products as treat
from tillroll.session import cut_lineage
from tillroll.workload.feeds import CODE_BASE
from tillroll.workload.tables import spread, table
from tillroll.workload.texts import (
    sql_brand,
    sql_number,
    sql_treatment,
    sql_unique_words,
    sql_unit,
)

# Types in the main catalogue, in the generic one, and (the rest) in none by code.
MAIN_TYPES = ["STANDARD", "ECONOMY", "SMALL"]
GENERIC_TYPES = ["MEDIUM", "SMALL"]


def _sql_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# The catalogue ---------------------------------------------------------------
def _catalogue(spark, folder, types: list[str], main: bool) -> DataFrame:
    part = table(spark, folder, "part").where(F.col("p_type").isin(types))
    name = F.upper(F.concat_ws(" ", "p_name", "p_brand"))
    extra = (
        [
            F.lit("S").alias("AUTO_FILL_SELLIN"),
            F.lit(None).cast(INTERNAL_PRODUCT).alias("MATCH_INTERNAL_PRODUCT"),
        ]
        if main
        else []
    )
    return part.select(
        F.array(F.lit(CODE_BASE) + F.col("p_partkey"), F.col("p_partkey")).alias("EAN"),
        F.array(name, F.concat(name, F.lit(" CX"))).alias("PRODUCT_SOURCE_NAME"),
        F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.concat("p_size", F.lit("ml")))).alias(
            "PRODUCT_DESCRIPTION"
        ),
        (F.col("p_size") * 10).cast("string").alias("VOLUME_TOTAL"),
        F.lit("10").alias("PACK_QUANTITY"),
        F.col("p_size").cast("string").alias("VOLUME_UNIT"),
        *extra,
        F.col("p_partkey").alias("ID"),
        F.col("p_name").alias("FRIENDLY_NAME"),
        F.lit(2024).alias("year"),
        F.lit(1).alias("month"),
        F.lit(1).alias("day"),
    )


def main_catalogue(spark, folder) -> DataFrame:
    return _catalogue(spark, folder, MAIN_TYPES, main=True)


def generic_catalogue(spark, folder) -> DataFrame:
    return _catalogue(spark, folder, GENERIC_TYPES, main=False)


def master_treated(spark, folder) -> DataFrame:
    """Treated catalogue text next to the description it stands for."""
    part = table(spark, folder, "part").where(F.col("p_type").isin(MAIN_TYPES))
    return part.select(
        t.description_treatment(F.concat_ws(" ", "p_name", "p_type")).alias("product_treated"),
        F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.concat("p_size", F.lit("ml")))).alias(
            "product_description"
        ),
        F.col("p_size").cast("string").alias("volume_unit"),
    ).withColumn("product_description_treated", t.description_treatment("product_description"))


# The products: each part as each kind of store spells it -----------------------
def distinct_products(spark, folder) -> DataFrame:
    pairs = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_partkey", "s_nationkey")
        .distinct()
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    nation = F.col("s_nationkey")
    plain = F.upper(F.concat_ws(" ", "p_name", "p_brand"))
    return pairs.select(
        F.concat_ws("-", "s_nationkey", "l_partkey").alias("PRODUCT_ID"),
        F.when(nation < 8, "SCANNTECH").otherwise("NATION").alias("SOURCE_NAME"),
        F.when(nation < 8, "DIAFULL")
        .when(nation == 24, "FABRICA")
        .when(nation == 23, "STORE AUDIT")
        .otherwise("STORE")
        .alias("SUBSOURCE_NAME"),
        F.col("p_brand").alias("BRAND"),
        F.when(nation < 12, F.concat(plain, F.lit(" CX")))
        .when(nation < 18, plain)
        .otherwise(F.concat(F.lit("Atcd "), F.initcap("p_name"), F.lit(" -  "), F.col("p_type")))
        .alias("PRODUCT_SOURCE_NAME"),
        F.when(nation.between(5, 9) | (nation > 13), F.lit(0).cast("bigint"))
        .when(nation < 5, F.lit(CODE_BASE) + F.col("p_partkey"))
        .otherwise(F.col("p_partkey"))
        .alias("PRODUCT_SOURCE_CODE"),
        F.when(F.col("p_size") > 5, (F.col("p_size") * 12).cast("string")).alias(
            "MED_CANT_CONTENIDO"
        ),
        F.when(F.col("p_size") > 9, F.lit("7")).alias("UNIDADES_CONTENIDO"),
    )


_PRODUCTS = f"""
  products as (
    select s_nationkey || '-' || l_partkey as PRODUCT_ID,
           case when s_nationkey < 8 then 'SCANNTECH' else 'NATION' end as SOURCE_NAME,
           case when s_nationkey < 8 then 'DIAFULL' when s_nationkey = 24 then 'FABRICA'
                when s_nationkey = 23 then 'STORE AUDIT' else 'STORE' end as SUBSOURCE_NAME,
           p_brand as BRAND,
           case when s_nationkey < 12 then upper(p_name || ' ' || p_brand) || ' CX'
                when s_nationkey < 18 then upper(p_name || ' ' || p_brand)
                else 'Atcd ' || (select string_agg(upper(w[1]) || w[2:], ' ' order by i)
                      from (select unnest(string_split(p_name, ' ')) as w,
                                   generate_subscripts(string_split(p_name, ' '), 1) as i))
                     || ' -  ' || p_type end as PRODUCT_SOURCE_NAME,
           case when s_nationkey between 5 and 9 or s_nationkey > 13 then 0
                when s_nationkey < 5 then {CODE_BASE} + p_partkey
                else p_partkey end as PRODUCT_SOURCE_CODE,
           case when p_size > 5 then cast(p_size * 12 as varchar) end as MED_CANT_CONTENIDO,
           case when p_size > 9 then '7' end as UNIDADES_CONTENIDO
    from (select distinct l_partkey, s_nationkey
          from lineitem join supplier on l_suppkey = s_suppkey)
    join part on l_partkey = p_partkey),
  filled as (
    select * replace (
      case when SOURCE_NAME = 'SCANNTECH' and SUBSOURCE_NAME = 'DIAFULL'
           then coalesce(MED_CANT_CONTENIDO, '1') else MED_CANT_CONTENIDO end
        as MED_CANT_CONTENIDO,
      case when SOURCE_NAME = 'SCANNTECH' and SUBSOURCE_NAME = 'DIAFULL'
           then coalesce(UNIDADES_CONTENIDO, '1') else UNIDADES_CONTENIDO end
        as UNIDADES_CONTENIDO)
    from products)"""

_ATTRIBUTES = "PRODUCT_DESCRIPTION, VOLUME_TOTAL, PACK_QUANTITY, VOLUME_UNIT, AUTO_FILL_SELLIN"


def _sql_catalogue(name: str, types: list[str], auto_fill: str) -> str:
    return f"""
  {name} as (
    select p_partkey, upper(p_name || ' ' || p_brand) as source_name,
           lower(p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_size || 'ml')
             as PRODUCT_DESCRIPTION,
           cast(p_size * 10 as varchar) as VOLUME_TOTAL, '10' as PACK_QUANTITY,
           cast(p_size as varchar) as VOLUME_UNIT, {auto_fill} as AUTO_FILL_SELLIN
    from part where p_type in ({_sql_list(types)}))"""


_CATALOGUES = (
    _sql_catalogue("main", MAIN_TYPES, "'S'")
    + ","
    + _sql_catalogue("generic", GENERIC_TYPES, "cast(null as varchar)")
)


def _sql_stage(stage: int, kind: str, catalogue: str) -> str:
    key = (
        f"unnest([{CODE_BASE} + p_partkey, p_partkey])"
        if kind == "ean"
        else "unnest([source_name, source_name || ' CX'])"
    )
    return (
        f"select {stage} as stage, '{kind}' as kind, cast({key} as varchar) as key, {_ATTRIBUTES} "
        f"from {catalogue}"
    )


_BEST_ORDER = (
    "stage, PRODUCT_DESCRIPTION, VOLUME_TOTAL, PACK_QUANTITY, VOLUME_UNIT, "
    "AUTO_FILL_SELLIN nulls first"
)
_LABEL = (
    "case when stage <= 2 then 'EAN' when stage <= 4 then 'DESCRICAO' "
    "else 'DESCRICAO_TRATADA' end as PRODUCT_MATCH_TYPE"
)
_OWN = "SOURCE_NAME = 'SCANNTECH' and SUBSOURCE_NAME = 'DIAFULL'"
_UPDATED = f"""
  select PRODUCT_ID, SUBSOURCE_NAME, SOURCE_NAME, BRAND, PRODUCT_SOURCE_NAME,
         PRODUCT_SOURCE_CODE, PRODUCT_DESCRIPTION, AUTO_FILL_SELLIN, PRODUCT_MATCH_TYPE,
         case when {_OWN} then MED_CANT_CONTENIDO else VOLUME_TOTAL end as VOLUME_TOTAL,
         case when {_OWN} then UNIDADES_CONTENIDO else PACK_QUANTITY end as PACK_QUANTITY,
         case when {_OWN} then cast(cast(round(cast(MED_CANT_CONTENIDO as double) /
                cast(UNIDADES_CONTENIDO as double), 0) as bigint) as varchar)
              else VOLUME_UNIT end as VOLUME_UNIT
  from matched
"""


def _sql_one_key(kind: str) -> str:
    code = "cast(PRODUCT_SOURCE_CODE as varchar)" if kind == "ean" else "PRODUCT_SOURCE_NAME"
    known = "where PRODUCT_SOURCE_CODE <> 0" if kind == "ean" else ""
    label = "EAN" if kind == "ean" else "DESCRICAO"
    return f"""
    with {_PRODUCTS}, {_CATALOGUES},
    entries as (select * from ({_sql_stage(1, kind, 'main')})
                qualify row_number() over (partition by key order by {_BEST_ORDER}) = 1)
    select p.*, PRODUCT_DESCRIPTION, VOLUME_TOTAL, PACK_QUANTITY, VOLUME_UNIT, AUTO_FILL_SELLIN,
           '{label}' as PRODUCT_MATCH_TYPE
    from products p join entries e on {code} = e.key {known}
    """


# C5 and its SQL ------------------------------------------------------------------
def _treated_products(spark, folder, products: DataFrame | None = None) -> DataFrame:
    if products is None:
        products = distinct_products(spark, folder)
    return treat.treat_products(products, master_treated(spark, folder))


def products_treated(spark, folder):
    """Everything but the hashed id (``treated_ids`` checks that)."""
    return _treated_products(spark, folder).drop("id")


def treated_ids(spark, folder):
    """Ids of the treated products: as many as there are rows."""
    rows = _treated_products(spark, folder)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


def products_treated_with_brand(spark, folder):
    """The text of name and brand together."""
    products = distinct_products(spark, folder)
    rows = treat.treat_products(products, master_treated(spark, folder), use_brand=True)
    return rows.select("product_id", "source_table", "product_aggregated")


_SELECTED = """
  picked as (
    select replace(BRAND, 'OUTRA MARCA', 'OUTRAMARCA') as brand_id, BRAND as brand_original,
           coalesce(MED_CANT_CONTENIDO, '') as med_cant_contenido,
           coalesce(UNIDADES_CONTENIDO, '') as unidades_contenido,
           PRODUCT_SOURCE_NAME as product, PRODUCT_SOURCE_NAME as product_original,
           PRODUCT_ID as product_id,
           case when contains(SUBSOURCE_NAME, 'AUDIT') then 0 else PRODUCT_SOURCE_CODE end
             as product_source_code,
           SOURCE_NAME as source_name, SUBSOURCE_NAME as source_table,
           PRODUCT_SOURCE_NAME as product_aggregated
    from products where SUBSOURCE_NAME <> 'FABRICA'),
  names as (select distinct product_aggregated as text from picked)"""
_unique = sql_unique_words("names", "text", "text", "words")
_names_treated, _names_done = sql_treatment("n", "uniq", "words")
_TREATED = f"""
  {_SELECTED},
  uniq as ({_unique}),
  {_names_treated},
  vols as (select distinct cast(p_size as varchar) as v from part
           where p_type in ({_sql_list(MAIN_TYPES)})),
  vhits as (select text, count(*) as n, min(v) as v
            from (select text, unnest(string_split(words, ' ')) as w from {_names_done})
            join vols on w = v group by text),
  marked as (select s.text,
                    case when n = 1 then replace(words, v, v || 'ml') else words end as product_treated
             from {_names_done} s left join vhits h on s.text = h.text),
  treated as (select p.*, product_treated from picked p join marked m on p.product_aggregated = m.text)"""

# The treated catalogue text, per catalogue name.
_master_treated, _master_done = sql_treatment("m", "mnames", "words")
_TREATED_CATALOGUE = f"""
  mnames as (select distinct p_name || ' ' || p_type as text, p_name || ' ' || p_type as words
             from part where p_type in ({_sql_list(MAIN_TYPES)})),
  {_master_treated},
  mlinks as (select distinct words as key,
                    lower(p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_size || 'ml')
                      as PRODUCT_DESCRIPTION
             from part join {_master_done} on text = p_name || ' ' || p_type
             where p_type in ({_sql_list(MAIN_TYPES)}))"""

_CASCADE = f"""
  with {_PRODUCTS}, {_CATALOGUES}, {_TREATED}, {_TREATED_CATALOGUE},
  described as (select * from main qualify row_number() over (partition by PRODUCT_DESCRIPTION
                  order by VOLUME_TOTAL, PACK_QUANTITY, VOLUME_UNIT, AUTO_FILL_SELLIN) = 1),
  entries as (
    select * from (
      {_sql_stage(1, 'ean', 'main')} union all {_sql_stage(2, 'ean', 'generic')} union all
      {_sql_stage(3, 'name', 'main')} union all {_sql_stage(4, 'name', 'generic')} union all
      select 5, 'treated', key, {', '.join('d.' + a.strip() for a in _ATTRIBUTES.split(','))}
      from mlinks l join described d on l.PRODUCT_DESCRIPTION = d.PRODUCT_DESCRIPTION)
    qualify row_number() over (partition by kind, key order by {_BEST_ORDER}) = 1),
  keys as (
    select PRODUCT_ID, 'ean' as kind, cast(PRODUCT_SOURCE_CODE as varchar) as key
    from filled where PRODUCT_SOURCE_CODE <> 0
    union all select PRODUCT_ID, 'name', PRODUCT_SOURCE_NAME from filled
    union all select product_id, 'treated', product_treated from treated),
  best as (select k.PRODUCT_ID as pid, e.* from keys k join entries e
             on k.kind = e.kind and k.key = e.key
           qualify row_number() over (partition by k.PRODUCT_ID order by stage) = 1),
  spelled as (
    select PRODUCT_ID, SUBSOURCE_NAME, SOURCE_NAME, BRAND, PRODUCT_SOURCE_NAME,
           PRODUCT_SOURCE_CODE, MED_CANT_CONTENIDO, UNIDADES_CONTENIDO, false as late from filled
    union all
    select product_id, source_table, source_name, brand_original, product_original,
           product_source_code, med_cant_contenido, unidades_contenido, true from treated),
  matched as (select s.*, b.*, {_LABEL} from spelled s join best b on s.PRODUCT_ID = b.pid
              where late = (stage = 5))
"""


# Queries ---------------------------------------------------------------------
def match_ean(spark, folder):
    found = match.match_one_key(
        distinct_products(spark, folder), main_catalogue(spark, folder), by_code=True
    )
    return found.drop("MATCH_INTERNAL_PRODUCT")


def match_description(spark, folder):
    found = match.match_one_key(
        distinct_products(spark, folder), main_catalogue(spark, folder), by_code=False
    )
    return found.drop("MATCH_INTERNAL_PRODUCT")


def _stored(spark, folder) -> tuple[DataFrame, DataFrame]:
    """The products and the treated products without their id, each as a stored table."""
    products = cut_lineage(distinct_products(spark, folder))
    return products, cut_lineage(_treated_products(spark, folder, products).drop("id"))


def _cascade(spark, folder, products: DataFrame, treated: DataFrame) -> DataFrame:
    return match.match_products(
        products,
        main_catalogue(spark, folder),
        generic_catalogue(spark, folder),
        treated,
        master_treated(spark, folder),
    )


def match_cascade(spark, folder):
    return _cascade(spark, folder, *_stored(spark, folder)).drop("MATCH_INTERNAL_PRODUCT")


def match_rate(spark, folder):
    return audit.match_rate(_cascade(spark, folder, *_stored(spark, folder)))


def unmatched_input(spark, folder):
    """Feature text of the unmatched products, before any typo repair."""
    products, treated = _stored(spark, folder)
    rows = predict.unmatched_products(treated, _cascade(spark, folder, products, treated))
    rows = rows.withColumn(predict.DESCRIPTION, F.col("product_treated"))
    return predict.with_feature_text(rows).select(
        "product_id",
        "product_treated",
        predict.DESCRIPTION,
        "number_description",
        "brand_description",
    )


def vocabulary(spark, folder):
    return vocab.vocabulary(
        predict.prepare_master(master_treated(spark, folder)), predict.DESCRIPTION
    )


_vocab_treated, _vocab_done = sql_treatment("w", "wnames", "words")


def predict_input(spark, folder):
    """The whole last step, with typo repair."""
    products, treated = _stored(spark, folder)
    rows = predict.predict_input(
        treated, master_treated(spark, folder), _cascade(spark, folder, products, treated)
    )
    return rows


def _misspelt(spark, folder) -> DataFrame:
    """Document words with one letter lost, next to the words as they are."""
    lost = F.regexp_replace(F.lower("text"), "(?<=[a-z]{5})n(?=[a-z])", "")
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", lost.alias("text"))


def typo_repair(spark, folder):
    """Documents that lost letters, repaired with the words of the benchmark."""
    known = table(spark, folder, "benchmark").select(
        F.regexp_replace(F.lower("text"), "[^a-z ]+", " ").alias("text")
    )
    words = vocab.vocabulary(known, "text")
    return vocab.repair_typos(_misspelt(spark, folder), "text", words, "repaired")


def typo_repair_dropped(spark, folder):
    """The same, without the unknown words that have no close match."""
    known = table(spark, folder, "benchmark").select(
        F.regexp_replace(F.lower("text"), "[^a-z ]+", " ").alias("text")
    )
    words = vocab.vocabulary(known, "text")
    return vocab.repair_typos(_misspelt(spark, folder), "text", words, "repaired", "drop")


# Typo repair in SQL ------------------------------------------------------------
_NEXT_BLOCK = (
    "list_max(list_filter(flatten(list_transform(range(1, length({a}) + 1), lambda i: "
    "list_transform(range(1, length({a}) - i + 2), lambda k: "
    "{{'k': k, 'first': -i, 'j': instr({b}, substr({a}, i, k))}}))), lambda x: x.j > 0))"
)


def _sql_removed(word: str) -> str:
    """The words left when any one letter goes."""
    return (
        f"list_distinct(list_transform(range(1, length({word}) + 1), lambda i: "
        f"substr({word}, 1, i - 1) || substr({word}, i + 1)))"
    )


def _sql_repairs(words: str, vocab: str) -> str:
    """CTEs up to ``fixes(word, repaired)`` for the relations of words and vocabulary.

    Words of up to two removals meet on what is left; longer pairs meet by length.
    The ratio is the recursive longest common block of the standard library.
    """

    def lefts(relation: str) -> str:
        return f"""
        select word, unnest(list_distinct(list_concat([{{'t': word, 'd': 0}}],
          list_transform(one, lambda x: {{'t': x, 'd': 1}}),
          case when length(word) >= 11 then flatten(list_transform(one, lambda y:
            list_transform({_sql_removed('y')}, lambda x: {{'t': x, 'd': 2}}))) else [] end))) as l
        from (select word, {_sql_removed('word')} as one from {relation} where length(word) <= 15)"""

    return f"""
  unknown as (select distinct word from {words} where length(word) >= 5
              and not contains(word, 'ml') and not regexp_full_match(word, '[0-9]*')
              and word not in (select word from {vocab})),
  left_w as ({lefts('unknown')}),
  left_v as ({lefts(vocab)}),
  pairs as (
    select distinct w.word, v.word as cand from left_w w join left_v v on w.l.t = v.l.t
    where w.l.d + v.l.d <= (length(w.word) + length(v.word)) // 10
    union
    select w.word, v.word from unknown w join {vocab} v
      on length(v.word) between length(w.word) * 9 // 11 and length(w.word) * 11 // 9 + 1
    where length(w.word) + length(v.word) >= 30),
  blocks as (
    select word, cand, cand as a, word as b, {_NEXT_BLOCK.format(a='cand', b='word')} as n from pairs
    union all
    select word, cand, s.a, s.b, {_NEXT_BLOCK.format(a='s.a', b='s.b')} from (
      select word, cand, unnest([
        {{'a': substr(a, 1, -n.first - 1), 'b': substr(b, 1, n.j - 1)}},
        {{'a': substr(a, -n.first + n.k), 'b': substr(b, n.j + n.k)}}]) as s
      from blocks where n is not null)
    where s.a <> '' and s.b <> ''),
  ratios as (select word, cand, 2.0 * sum(n.k) / (length(word) + length(cand)) as r
             from blocks where n is not null group by word, cand),
  fixes as (select word, cand as repaired from ratios where r >= 0.9
            qualify row_number() over (partition by word order by r desc, cand desc) = 1)"""


# Letters are lost inside the pieces between single spaces.
_LOST = """
  with recursive pieces as (
    select doc_id, unnest(string_split(lower(text), ' ')) as w,
           generate_subscripts(string_split(lower(text), ' '), 1) as p from documents),
  lost_of as (
    select w, coalesce(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda p:
        not (p > 5 and l[p] = 'n' and p < len(l)
             and regexp_full_match(array_to_string(l[p - 5:p - 1], ''), '[a-z]{5}')
             and regexp_full_match(l[p + 1], '[a-z]'))), lambda p: l[p]), ''), '') as word
    from (select w, string_split(w, '') as l from (select distinct w from pieces))),
  vocab as (select distinct word from (
      select unnest(string_split(regexp_replace(lower(text), '[^a-z ]+', ' ', 'g'), ' ')) as word
      from benchmark
      union all
      select unnest(['do bem', 'ln', 'ow', 'budweiser', 'bohemia', 'brahma', 'skol',
                     'antarctica', 'wals', 'beats', 'pilsen', 'ml', 'misto', 'garrafa']))
    where length(word) > 1)"""
_TYPO_SQL = f"""{_LOST}, {_sql_repairs('lost_of', 'vocab')}
  select doc_id, string_agg(o.word, ' ' order by p) as text,
         nullif(string_agg(coalesce(repaired, o.word), ' ' order by p), '') as repaired
  from pieces join lost_of o using (w) left join fixes f on f.word = o.word group by doc_id"""
_TYPO_DROPPED_SQL = f"""{_LOST}, {_sql_repairs('lost_of', 'vocab')},
  parts as (
    select doc_id, p, o.word, case when repaired is null and o.word not in (select word from vocab)
        and not contains(o.word, 'ml') and not regexp_full_match(o.word, '[0-9]*')
      then null else coalesce(repaired, o.word) end as kept
    from pieces join lost_of o using (w) left join fixes f on f.word = o.word)
  select doc_id, string_agg(word, ' ' order by p) as text,
         case when string_agg(word, ' ' order by p) <> '' then coalesce(string_agg(kept, ' ' order by p), '') end as repaired
  from parts group by doc_id"""


_VOCABULARY_SQL = f"""
  wnames as (
    select distinct lower(p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_size || 'ml')
      as words from part where p_type in ({_sql_list(MAIN_TYPES)})),
  {_vocab_treated},
  unit_names as (select {sql_unit('words')} as words from {_vocab_done}),
  vocab as (select distinct word from (
    select unnest(string_split(words, ' ')) as word from unit_names
    union all
    select unnest(['do bem', 'ln', 'ow', 'budweiser', 'bohemia', 'brahma', 'skol',
                   'antarctica', 'wals', 'beats', 'pilsen', 'ml', 'misto', 'garrafa']))
    where length(word) > 1)"""
_PREDICT_SQL = f"""{_CASCADE.replace('with ', 'with recursive ', 1)}, {_VOCABULARY_SQL},
  rest as (select * from treated where product_id not in (select PRODUCT_ID from matched)),
  named as (select distinct product_treated from rest),
  parts as (select product_treated, unnest(string_split(product_treated, ' ')) as word,
                   generate_subscripts(string_split(product_treated, ' '), 1) as p from named),
  {_sql_repairs('parts', 'vocab')},
  mended as (select product_treated, nullif(string_agg(coalesce(repaired, parts.word), ' ' order by p), '') as text
             from parts left join fixes on fixes.word = parts.word group by product_treated),
  united as (select r.* exclude (brand_id), {sql_unit('m.text')} as d
             from rest r join mended m on r.product_treated = m.product_treated)
  select * exclude (d), d as product_description_treated, {sql_number('d')} as number_description,
         {sql_brand('d')} as brand_description
  from united"""


QUERIES = {
    "match_ean": (match_ean, _sql_one_key("ean")),
    "match_description": (match_description, _sql_one_key("name")),
    "products_treated": (
        products_treated,
        f"with {_PRODUCTS}, {_TREATED} select * from treated",
    ),
    "treated_ids": (
        treated_ids,
        f"with {_PRODUCTS}, {_TREATED} select count(*) as n_rows, count(*) as n_ids from treated",
    ),
    "products_treated_with_brand": (
        products_treated_with_brand,
        f"""with {_PRODUCTS}, {_TREATED}
        select product_id, source_table, product_aggregated || ' ' || brand_id as product_aggregated
        from treated""",
    ),
    "match_cascade": (match_cascade, f"{_CASCADE} {_UPDATED}"),
    "match_rate": (
        match_rate,
        f"{_CASCADE} select PRODUCT_MATCH_TYPE, count(*) as n_rows from matched group by 1",
    ),
    "unmatched_input": (
        unmatched_input,
        f"""{_CASCADE},
        rest as (select product_id, product_treated, {sql_unit('product_treated')} as d from treated
                 where product_id not in (select PRODUCT_ID from matched))
        select product_id, product_treated, d as product_description_treated,
               {sql_number('d')} as number_description, {sql_brand('d')} as brand_description
        from rest""",
    ),
    "vocabulary": (
        vocabulary,
        f"""
        with wnames as (
          select distinct lower(p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_size || 'ml')
            as words from part where p_type in ({_sql_list(MAIN_TYPES)})),
        {_vocab_treated},
        u as (select {sql_unit('words')} as words from {_vocab_done})
        select distinct word from (
          select unnest(string_split(words, ' ')) as word from u
          union all
          select unnest(['do bem', 'ln', 'ow', 'budweiser', 'bohemia', 'brahma', 'skol',
                         'antarctica', 'wals', 'beats', 'pilsen', 'ml', 'misto', 'garrafa']))
        where length(word) > 1
        """,
    ),
    "predict_input": (predict_input, _PREDICT_SQL),
    "typo_repair": (typo_repair, _TYPO_SQL),
    "typo_repair_dropped": (typo_repair_dropped, _TYPO_DROPPED_SQL),
}
