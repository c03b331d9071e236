"""Product text treatment, over whole documents and product names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions import parse as p
from tillroll.functions import text as t
from tillroll.plans.products import add_volume_mark
from tillroll.workload.tables import spread, table


def _documents(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def _treated(name, build):
    def run(spark, folder):
        return _documents(spark, folder).select("doc_id", build(F.col("text")).alias(name))

    return run


# SQL pieces --------------------------------------------------------------------
def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql_rules(x: str, rules) -> str:
    """The same ordered patterns in the SQL engine's notation."""
    for pattern, replacement in rules:
        back = replacement.replace("$", "\\")
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(back)}, 'g')"
    return x


# What the folding leaves of the non-ASCII letters an accent strip does not cover.
SQL_FOLD = (
    "regexp_replace(translate(strip_accents(lower({x})), 'ºª²³¹', 'oa231'), "
    "'[^\\x00-\\x7F]', '', 'g')"
)


def sql_fold(x: str) -> str:
    return SQL_FOLD.replace("{x}", x)


def sql_litres(source: str, column: str, target: str) -> str:
    """A CTE body: litres -> ml for one column of a named relation."""
    pattern = quoted(fixed.LITRE_PATTERN)
    word, ml = fixed.LITRE_WORDS
    return f"""
      select * exclude (found_, number_, {column}),
             regexp_replace(
               case when found_ <> '' then
                 coalesce(regexp_replace({column}, found_, ' ' || number_ || 'ml ', 'g'), {column})
               else {column} end, {quoted(word)}, {quoted(ml)}, 'g') as {target}
      from (select *, regexp_extract({column}, {pattern}, 0) as found_,
                   cast(try_cast(trunc(try_cast(regexp_extract({column}, {pattern}, 1) || '.' ||
                     regexp_extract({column}, {pattern}, 3) as double) * 1000.0) as hugeint)
                     as varchar) as number_
            from {source})"""


def sql_volume(prefix: str, source: str, column: str) -> tuple[str, str]:
    """CTEs that apply the volume rules to ``column``; the last relation's name."""
    a, b, c = f"{prefix}_u", f"{prefix}_l", f"{prefix}_v"
    glue = [*fixed.ML_RULES, *fixed.UNIT_GLUE_RULES]
    ctes = f"""
    {a} as (select * replace ({sql_rules(column, fixed.UNIT_RULES)} as {column}) from {source}),
    {b} as ({sql_litres(a, column, column)}),
    {c} as (select * replace ({sql_rules(column, glue)} as {column}) from {b})"""
    return ctes, c


ABBREVIATION_MAP = (
    "MAP {"
    + ", ".join(
        f"{quoted(a)}: {quoted(full)}"
        for full, short in fixed.ABBREVIATIONS.items()
        for a in short
    )
    + "}"
)
STOP_LIST = "[" + ", ".join(quoted(w) for w in fixed.STOP_WORDS) + "]"


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '')"


def sql_full_words(x: str) -> str:
    return (
        f"list_filter(list_transform({sql_words(x)}, "
        f"lambda w: coalesce({ABBREVIATION_MAP}[w], w)), "
        f"lambda w: not list_contains({STOP_LIST}, w))"
    )


def sql_treatment(prefix: str, source: str, column: str) -> tuple[str, str]:
    """CTEs of the whole description treatment; the last relation's name."""
    first, after_first = sql_volume(f"{prefix}1", f"{prefix}_f", column)
    second, after_second = sql_volume(f"{prefix}2", f"{prefix}_b", column)
    done = f"{prefix}_t"
    ctes = f"""
    {prefix}_f as (select * replace ({sql_fold(column)} as {column}) from {source}),
    {first},
    {prefix}_b as (select * replace ({sql_rules(column, fixed.BRAND_RULES)} as {column})
                   from {after_first}),
    {second},
    {done} as (select * replace (array_to_string({sql_full_words(column)}, ' ') as {column})
               from {after_second})"""
    return ctes, done


def sql_unique_words(source: str, key: str, column: str, target: str) -> str:
    """Each word once, by first position."""
    return f"""
      select {key}, string_agg(word, ' ' order by pos) as {target}
      from (select {key}, word, min(pos) as pos
            from (select {key}, unnest(string_split({column}, ' ')) as word,
                         generate_subscripts(string_split({column}, ' '), 1) as pos
                  from {source})
            group by {key}, word)
      group by {key}"""


_DOCS = "docs as (select doc_id, text from documents)"
_volume, _volume_done = sql_volume("v", "docs", "text")
_treatment, _treatment_done = sql_treatment("d", "docs", "text")


# Queries -------------------------------------------------------------------------
def add_ml(spark, folder):
    """Volumes of the catalogue marked in the sentence that names them."""
    part = table(spark, folder, "part")
    names = part.select(
        "p_partkey",
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), "p_brand", "p_type").alias("text"),
    )
    large = part.where(F.col("p_type") == "LARGE").select(F.col("p_size").alias("volume_unit"))
    return add_volume_mark(names, "p_partkey", "text", large)


def add_ml_by_join(spark, folder):
    """The same with the volumes joined instead of inlined."""
    part = table(spark, folder, "part")
    names = part.select(
        "p_partkey",
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), "p_brand", "p_type").alias("text"),
    )
    large = part.where(F.col("p_type") == "LARGE").select(F.col("p_size").alias("volume_unit"))
    return add_volume_mark(names, "p_partkey", "text", large, most=0)


_ADD_ML = """
  with vols as (select distinct cast(p_size as varchar) as v from part where p_type = 'LARGE'),
  names as (select p_partkey, p_name || ' ' || p_size || ' ' || p_brand || ' ' || p_type as text
            from part),
  hits as (select p_partkey, count(*) as n, min(v) as v
           from (select p_partkey, unnest(string_split(text, ' ')) as w from names)
           join vols on w = v group by 1)
  select p.p_partkey, case when n = 1 then replace(text, v, v || 'ml') else text end as text
  from names p left join hits h on p.p_partkey = h.p_partkey
"""


def protected_phrases(spark, folder):
    """Two-word phrases kept as one word, in names that carry them."""
    names = table(spark, folder, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_name", F.lit("Do Bem"), "p_type", F.lit("JOTA efe")).alias("product"),
        F.concat_ws(" ", F.lit("Outra Marca"), "p_brand").alias("brand"),
    )
    return names.select(
        "p_partkey",
        t.protect_phrases("product", fixed.PRODUCT_PHRASES).alias("product"),
        t.protect_phrases("brand", fixed.BRAND_PHRASES).alias("brand"),
    )


def feature_words(spark, folder):
    """Unit count, number words and brand words of treated documents."""
    docs = _documents(spark, folder).select(
        "doc_id", t.add_unit(t.description_treatment("text")).alias("treated")
    )
    return docs.select(
        "doc_id",
        "treated",
        t.number_words("treated").alias("number_description"),
        t.brand_words("treated").alias("brand_description"),
    )


PACKAGE_LIST = "[" + ", ".join(quoted(w) for w in fixed.PACKAGE_WORDS) + "]"


def sql_unit(x: str) -> str:
    return f"case when contains({x}, 'unidade') then {x} else {x} || ' 1unidade' end"


def sql_number(x: str) -> str:
    return (
        f"case when {x} <> '' then array_to_string(list_filter({sql_words(x)}, lambda w: "
        f"regexp_matches(w, '\\d') or list_contains({PACKAGE_LIST}, w)), ' ') end"
    )


def sql_brand(x: str) -> str:
    return (
        f"case when {x} <> '' then array_to_string(list_filter({sql_words(x)}, lambda w: "
        f"not regexp_matches(w, '(ml|unidades?)$')), ' ') end"
    )


QUERIES = {
    "unique_words": (
        _treated("words", t.unique_words),
        sql_unique_words("documents", "doc_id", "text", "words"),
    ),
    "single_space": (
        _treated("words", p.single_space),
        "select doc_id, trim(regexp_replace(text, ' +', ' ', 'g'), ' ') as words from documents",
    ),
    "accent_fold": (
        _treated("folded", t.fold_accents),
        f"select doc_id, {sql_fold('text')} as folded from documents",
    ),
    "volume_rules": (
        _treated("treated", t.volume_rules),
        f"with {_DOCS}, {_volume} select doc_id, text as treated from {_volume_done}",
    ),
    "brand_rules": (
        _treated("treated", t.brand_rules),
        f"select doc_id, {sql_rules('text', fixed.BRAND_RULES)} as treated from documents",
    ),
    "abbrev_stopwords": (
        _treated("treated", lambda c: F.array_join(t.full_words(F.lower(c)), " ")),
        f"select doc_id, array_to_string({sql_full_words('lower(text)')}, ' ') as treated "
        "from documents",
    ),
    "description_treatment": (
        _treated("treated", t.description_treatment),
        f"with {_DOCS}, {_treatment} select doc_id, text as treated from {_treatment_done}",
    ),
    "feature_words": (
        feature_words,
        f"with {_DOCS}, {_treatment}, u as (select doc_id, {sql_unit('text')} as treated "
        f"from {_treatment_done}) select doc_id, treated, "
        f"{sql_number('treated')} as number_description, "
        f"{sql_brand('treated')} as brand_description from u",
    ),
    "add_ml": (add_ml, _ADD_ML),
    "add_ml_by_join": (add_ml_by_join, _ADD_ML),
    "protected_phrases": (
        protected_phrases,
        "select p_partkey, p_name || ' DOBEM ' || p_type || ' JOTAEFE' as product, "
        "'OUTRAMARCA ' || p_brand as brand from part",
    ),
}
