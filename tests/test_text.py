import random
import re
import unicodedata

import pytest
from helpers import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions import text as t

SAMPLES = [
    "CERV. BRAHMA 12X250 ML c/ 6un", "agua 1,5 l", "600 lt", "litrao", "pack com 3 unidades",
    "Refrig. Guaraná Antárctica 2,5L PET s/ açúcar", "cx 12 un skol lata 350ml", "beck's long neck",
    "Coca cola zero 2l", "SERRA MALTE 600 ml retornável", "sixpack bud 269m", "150 bpm gf 0,0",
    "#1234 promo# antarcti 1l", "transf. de mesa 12 chopp", "agua s/ gas 500 ml 6 unidade",
    "caixa com 24 un ln 355 ml", "one way 300m", "x", "", "jesus guarana n/a", "06unidade 5 unidade",
    "2.3 l e 2x3 l", "1.5 l 125 l", "12 x 2 x 3", "coca", "nao informado zr", "l n stela 0 alcool",
]


def python_rules(s, rules):
    for pattern, replacement in rules:
        s = re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", replacement), s)
    return s


def ascii_lower(s):
    return unicodedata.normalize("NFKD", s.lower()).encode("ascii", "ignore").decode()


def test_unique_words(spark):
    assert values(spark, ["a b a c b", "", None, "a  b "], t.unique_words) == [
        "a b c", "", None, "a  b",
    ]


def test_unique_words_twice_changes_nothing(session):
    once = values(session, SAMPLES, t.unique_words)
    assert values(session, once, t.unique_words) == once


def test_fold_examples(spark):
    folded = values(spark, ["ç ã é º ª ½ ß ² ø", "™ ﬁ İ …", None], t.fold_accents)
    assert folded == ["c a e o a 12  2 ", "TM fi i ...", None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=40))
def test_fold_equals_the_standard_library(session, texts):
    texts = [x.replace("\x00", "") for x in texts]
    assert values(session, texts, t.fold_accents) == [ascii_lower(x) for x in texts]


@pytest.mark.parametrize(
    "rules", [fixed.UNIT_RULES, fixed.ML_RULES, fixed.UNIT_GLUE_RULES, fixed.BRAND_RULES],
    ids=["unit", "ml", "glue", "brand"],
)
def test_patterns_mean_the_same_in_both_regex_dialects(session, rules):
    texts = [ascii_lower(s) for s in SAMPLES]
    got = values(session, texts, lambda c: t.apply_rules(c, rules))
    assert got == [python_rules(s, rules) for s in texts]


def test_units(spark):
    got = values(spark, ["12x250", "c/ 6un", "pack com 3 unidades", "cx6"], t.unit_rules)
    assert got == ["12unidade 250", " com  6unidade ", "3unidades", "6unidade "]


def test_litres(spark):
    got = values(
        spark, ["agua 1,5 l", "600 lt", "litrao", "1.005 l", "2.3 l", "1.5 l 125 l", None],
        t.litres_to_ml,
    )
    assert got == [
        "agua  1500ml ", " 600000ml ", "  1000ml ".replace("  ", " "), f" {int(1.005 * 1000)}ml ",
        f" {int(2.3 * 1000)}ml ", " 1500ml 125 l", None,
    ]


def test_description_examples(spark):
    inputs = [
        "Cerv. Brahma Chopp 12x350ml", "Refri Guaraná Antartica 2 L", "Água min. s/ gás 500 ml",
        "BECK'S LONG NECK", "Cerveja Itpv lata 350 ML beb gelada",
    ]
    got = values(spark, inputs, t.description_treatment)
    assert got == [
        "cerveja brahma 12unidade 350ml", "refrigerante guarana antarctica 2000ml",
        "agua mineral semgas 500ml", "becks ln", "cerveja itaipava lt 350ml",
    ]


def test_volume_mark(spark):
    inputs = ["skol 350 lt", "skol 350 600", "skol 350 350", "3500 350", "skol", None]
    got = values(spark, inputs, lambda c: t.mark_volume(c, lambda w: w.isin("350", "600")))
    assert got == ["skol 350ml lt", "skol 350 600", "skol 350 350", "350ml0 350ml", "skol", None]


def test_feature_words(spark):
    assert values(spark, ["a 6unidade", "a", None], t.add_unit) == ["a 6unidade", "a 1unidade", None]
    text = "beer lt 350ml 6unidade 2unidades"
    assert values(spark, [text, "", None, "beer"], t.number_words) == [
        "lt 350ml 6unidade 2unidades", None, None, "",
    ]
    assert values(spark, [text, "", None, "1unidade"], t.brand_words) == ["beer lt", None, None, ""]


# Written out by hand from the rules, so that a wrong table cannot agree with itself.
SPELLED = {
    "refri refrig refr ref refriger": "refrigerante refrigerante refrigerante refrigerante refrigerante",
    "cerv cervej cer cerve": "cerveja cerveja cerveja cerveja",
    "chop ton tonic": "chopp tonica tonica",
    "itpv itaip db": "itaipava itaipava do bem",
    "h2o h20h h20": "h2oh h2oh h2oh",
    "antartica ant antar antart antartc antarct antarctic antarc antartic": " ".join(["antarctica"] * 9),
    "schw guar guara guarah": "schweppes guarana guarana guarana",
    "heinek lar laran lja lim": "heineken laranja laranja laranja limao",
    "malizbier": "maCZbier",
    "pil pils bud budweis": "pilsen pilsen budweiser budweiser",
    "alc brama ahma": "alcool brahma brahma",
    "orig origina origin ori": "original original original original",
    "ag cocacola pespi sprit min stela": "agua coca cola pepsi sprite mineral stella",
    "cx cxa": "caixa caixa",
    "un uni unidad und": "unidade unidade unidade unidade",
    "lata latao latagelada latas lat lta": "lt lt lt lt lt lt",
    "gf gfa grfa grf": "garrafa garrafa garrafa garrafa",
    "lneck longnec lnk long lon": "ln ln ln ln ln",
    "sacucar pmalte sense sens litrinho": "zero puro malte senses senses garrafa 300ml",
    "atac beb irrelevante cl retornavel retorn gelada atcd skol": "skol",
}


def test_every_abbreviation_by_hand(spark):
    got = values(spark, list(SPELLED), lambda c: F.array_join(t.full_words(c), " "))
    assert got == list(SPELLED.values())


def test_litres_of_any_size(spark):
    got = values(spark, ["agua 1,5 l", "agua 4,35 l", "x 12345678901234567890 l"], t.litres_to_ml)
    assert [" ".join(g.split()) for g in got] == ["agua 1500ml", "agua 4350ml", "x 12345678901234568000000ml"]


def test_faster_patterns_give_what_the_rules_give(session):
    """On random strings of pieces of the rules, and without touching plain words."""
    r = random.Random(5)
    bits = ["n/a", "n", "/", "a", "#", "12 ", "1", " ", "  ", "|", "é", "x", " x 3", "un", "unid", "caixa", "cx", "cxa com", "\n",
            "jesus guarana", "brahma chop", "proibida pilsen", "150 bpm", "nao informado", "zer", "zr", "-", "_", " unidade", "0"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 12))) for _ in range(4000)]
    df = session.createDataFrame([(x,) for x in texts], "x string")
    rules = [x for x in [*fixed.UNIT_RULES, *fixed.UNIT_GLUE_RULES, *fixed.BRAND_RULES] if x[0] in fixed.FASTER]
    assert len(rules) == len(fixed.FASTER)
    pairs = [(F.regexp_replace("x", f"(?d){p}", to), t.apply_rules(F.col("x"), [(p, to)])) for p, to in rules]
    same = [a.eqNullSafe(b).alias(str(i)) for i, (a, b) in enumerate(pairs)]
    assert all(df.select(*[F.min(c) for c in same]).first())
    space = next(p for p in fixed.FASTER if p.startswith("n/a"))
    assert session.range(1).select(F.regexp_count(F.lit("so two words|c"), F.lit(fixed.FASTER[space]))).first()[0] == 0
