"""Product text treatment as native column expressions: no Python worker runs."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions import fixed_values as fixed
from tillroll.functions.parse import as_column

_PAIR, _SIDE = "\x01", "\x02"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def literal_map(pairs: dict[str, str]) -> Column:
    """A constant map as one literal, so a plan stays small."""
    text = _PAIR.join(f"{k}{_SIDE}{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit(_PAIR), F.lit(_SIDE))


def apply_rules(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Fold ordered ``(pattern, replacement)`` rules over a column.

    ``(?d)`` makes only a line feed end a line, whatever else the text holds.
    """
    for pattern, replacement in rules:
        c = F.regexp_replace(c, f"(?d){fixed.FASTER.get(pattern, pattern)}", replacement)
    return c


def words(c: Column | str) -> Column:
    """Words between runs of white space; no empty ones."""
    return F.filter(F.split(as_column(c), r"\s+"), lambda w: w != "")


def unique_words(c: Column | str) -> Column:
    """Each word once, in order of first occurrence."""
    return F.array_join(F.array_distinct(F.split(as_column(c), " ")), " ")


@cache
def ascii_folds() -> tuple[str, str, dict[str, str]]:
    """``(from, to, longer)``: what stays of a character when only the ASCII
    part of its compatibility decomposition is kept."""
    source, target, longer = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if not unicodedata.decomposition(ch):
            continue
        kept = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(kept) == 1:
            source.append(ch)
            target.append(kept)
        elif kept:
            longer[ch] = kept
    return "".join(source), "".join(target), longer


def fold_accents(c: Column | str) -> Column:
    """Lower case, accents folded, all other non-ASCII characters dropped."""
    source, target, longer = ascii_folds()
    latin = "".join(ch for ch in longer if ch <= "\xff")
    other = "".join(ch for ch in longer if ch > "\xff")
    # The first test of the intersection passes over plain text quickly.
    any_longer = rf"[{latin}[\x{{100}}-\x{{10FFFF}}&&[{other}]]]"
    parts = literal_map(longer)

    def spell_out(text: Column) -> Column:
        one = F.transform(
            F.split(text, ""),
            lambda ch: F.when(ch <= "\x7f", ch).otherwise(
                F.coalesce(F.try_element_at(parts, ch), ch)
            ),
        )
        return F.when(text.rlike(any_longer), F.array_join(one, "")).otherwise(text)

    spelled = let(F.lower(as_column(c)), spell_out)
    return F.regexp_replace(F.translate(spelled, source, target), r"[^\x00-\x7F]", "")


def unit_rules(c: Column | str) -> Column:
    return apply_rules(as_column(c), fixed.UNIT_RULES)


def litres_to_ml(c: Column | str) -> Column:
    """The first litre amount gives the number; each text that matches it as a
    pattern is replaced."""
    pattern = f"(?d){fixed.LITRE_PATTERN}"

    def convert(text: Column) -> Column:
        found = F.regexp_extract(text, pattern, 0)
        litres = F.concat(
            F.regexp_extract(text, pattern, 1), F.lit("."), F.regexp_extract(text, pattern, 3)
        )
        exact = litres.try_cast("double") * F.lit(1000.0)
        # Above 2**53 a double is whole and may not fit a bigint.
        amount = F.when(exact < 9e15, exact.try_cast("bigint").cast("string")).otherwise(
            exact.try_cast("decimal(38,0)").cast("string")
        )
        replaced = F.regexp_replace(text, found, F.concat(F.lit(" "), amount, F.lit("ml ")))
        return F.when(found != "", F.coalesce(replaced, text)).otherwise(text)

    return apply_rules(let(as_column(c), convert), [fixed.LITRE_WORDS])


def ml_rules(c: Column | str) -> Column:
    return apply_rules(as_column(c), fixed.ML_RULES)


def volume_rules(c: Column | str) -> Column:
    return apply_rules(ml_rules(litres_to_ml(unit_rules(c))), fixed.UNIT_GLUE_RULES)


def brand_rules(c: Column | str) -> Column:
    return apply_rules(as_column(c), fixed.BRAND_RULES)


def full_words(c: Column | str) -> Column:
    """Abbreviations expanded and stop words removed, as an array.

    A map is searched from its start, so only words of the hashed set look in it.
    """
    pairs = {a: full for full, short in fixed.ABBREVIATIONS.items() for a in short}
    full = literal_map(pairs)
    expanded = F.transform(
        words(c), lambda w: F.when(w.isin(list(pairs)), F.try_element_at(full, w)).otherwise(w)
    )
    return F.filter(expanded, lambda w: ~w.isin(fixed.STOP_WORDS))


def description_treatment(c: Column | str) -> Column:
    text = volume_rules(brand_rules(volume_rules(fold_accents(c))))
    return F.array_join(full_words(text), " ")


def protect_phrases(c: Column | str, phrases: list[tuple[str, str]]) -> Column:
    return apply_rules(as_column(c), phrases)


def mark_volume(c: Column | str, is_volume: Callable[[Column], Column]) -> Column:
    """``ml`` after the volume, when the text has exactly one volume word."""
    text = as_column(c)

    def mark(hits: Column) -> Column:
        value = F.get(hits, 0)
        marked = F.replace(text, value, F.concat(value, F.lit(fixed.VOLUME_SUFFIX)))
        return F.when(F.size(hits) == 1, marked).otherwise(text)

    return let(F.filter(words(text), is_volume), mark)


def add_unit(c: Column | str) -> Column:
    text = as_column(c)
    return F.when(text.contains(fixed.UNIT_WORD), text).otherwise(
        F.concat(text, F.lit(fixed.DEFAULT_UNIT))
    )


def _keep_words(c: Column | str, test: Callable[[Column], Column]) -> Column:
    text = as_column(c)
    return F.when(text != "", F.array_join(F.filter(words(text), test), " "))


def number_words(c: Column | str) -> Column:
    """Words with a digit and packaging words; NULL for an empty text."""
    return _keep_words(c, lambda w: w.rlike(r"\d") | w.isin(fixed.PACKAGE_WORDS))


def brand_words(c: Column | str) -> Column:
    """Words that are no volume and no unit count; NULL for an empty text."""
    return _keep_words(c, lambda w: ~w.rlike("(ml|unidades?)$"))
