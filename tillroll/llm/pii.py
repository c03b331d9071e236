"""Personal data replaced by format-preserving Feistel pseudonyms.

A value is found by its form, validated (check digits, ranges, the calendar) and
replaced by its keyed permutation within the same form (``feistel``), so equal
values stay linked across documents and spellings. Kinds, in the order in which
they are tried at a place of the text:

* e-mail addresses: letters and digits of the part before the ``@``;
* account numbers (IBAN, mod 97): the account, with new check digits;
* card numbers (13 to 19 digits, Luhn): all but the check digit, which follows;
* social security numbers (ddd-dd-dddd with an assigned range);
* dates from 1900 to 2099: year first, or day and month first with ``/``, ``.``
  or ``-`` (where both orders are possible ``/`` puts the month first);
* internet addresses, versions 4 and 6;
* telephone numbers of 8 to 15 digits that begin with ``+`` or a bracket, in groups
  of any length, or written ddd-ddd-dddd: the last ten digits, or all after the
  country code if there are fewer.

Work is one pass over each text; nothing is looked up or shuffled.
"""

from __future__ import annotations

import datetime as dt
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.feistel import FIRST_YEAR, YEARS, Permuter, iban_rest, luhn_digit
from tillroll.llm.texts import slices, unused
from tillroll.workload.tables import table

#: The session setting that holds the key, and the key where it is unset (tests).
SETTING, TEST_KEY = "spark.tillroll.pseudonym.key", "a key for tests, not for use"

EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64}+)@((?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24})(?![A-Za-z0-9])")
NUMBERS = re.compile(
    r"(?<![0-9A-Za-z])(?:"
    r"(?P<iban>[A-Za-z]{2}[0-9]{2}(?:[ ]?[A-Za-z0-9]{4}){2,7}(?:[ ]?[A-Za-z0-9]{1,3})?)(?![0-9A-Za-z])"
    r"|(?P<card>[0-9]{13,19}+|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{4}(?P<gap2>[ -])[0-9]{6}(?P=gap2)[0-9]{5})(?![0-9A-Za-z])"
    r"|(?P<social>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z-])"
    r"|(?P<iso>[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2})(?![0-9A-SU-Za-z])"
    r"|(?P<day>[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4})(?![0-9A-Za-z])"
    r"|(?P<v4>(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9A-Za-z]|\.[0-9])"
    r"|(?P<v6>(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
    r"|(?P<phone>\+[0-9](?:[ .-]?[0-9]){0,24}(?:[ .-]?\([0-9]{1,5}\)(?:[ .-]?[0-9]){4,24})?"
    r"|\([0-9]{2,5}\)(?:[ .-]?[0-9]){4,24}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]))"
    r")"
)
MAYBE = re.compile(r"[0-9@]")


def respelled(pattern: str, characters: str) -> str:
    """``characters`` in the places of the letters and digits of ``pattern``."""
    new = iter(characters)
    return "".join(next(new) if c.isalnum() else c for c in pattern)


def _calendar(kind: str, text: str) -> tuple[list[int], list[int]] | None:
    """The numbers of a date as written, and where year, month and day stand."""
    parts = [int(p) for p in re.split("[-/.]", text)]
    if kind == "iso":
        order = [0, 1, 2]
    elif parts[0] > 12 or parts[1] <= 12 and "/" not in text:
        order = [2, 1, 0]
    else:
        order = [2, 0, 1]
    year, month, day = (parts[k] for k in order)
    try:
        dt.date(year, month, day)
    except ValueError:
        return None
    return (parts, order) if FIRST_YEAR <= year < FIRST_YEAR + YEARS else None


def _date(permuter: Permuter, kind: str, text: str) -> str | None:
    found = _calendar(kind, text)
    if not found:
        return None
    parts, order = found
    new = dict(zip(order, permuter.date(*(parts[k] for k in order))))
    pieces = re.split("([-/.])", text)
    wide = any(p[0] == "0" for p in pieces[::2])
    for k in range(3):
        pieces[2 * k] = f"{new[k]:02d}" if wide else str(new[k])
    return "".join(pieces)


def dialled(text: str) -> str:
    """The longest run of whole groups that can be a number; groups that follow it in
    the text, or a last single digit, are not part of it. Only the form decides."""
    for group in reversed(list(re.finditer("[0-9]{2,}", text))):
        # A group in brackets is not the end of a number.
        if sum(c.isdigit() for c in text[: group.end()]) <= 15 and not text.startswith(")", group.end()):
            return text[: group.end()]
    return ""


def _phone(permuter: Permuter, text: str) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    code = len(re.match(r"\+([0-9]{1,3})(?![0-9])|", text)[1] or "")
    own = min(10, len(digits) - code)
    return respelled(text, digits[:-own] + permuter.characters("phone", digits[-own:]))


def _iban(permuter: Permuter, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_rest(plain.upper()) != 1:
        return None
    return respelled(text, permuter.iban(plain.upper()))


def _card(permuter: Permuter, text: str) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    return respelled(text, permuter.card(digits)) if luhn_digit(digits[:-1]) == digits[-1] else None


def _social(permuter: Permuter, text: str) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    return "{:03d}-{:02d}-{:04d}".format(*permuter.social(area, group, serial))


def _address(permuter: Permuter, kind: str, text: str) -> str | None:
    try:
        found = ipaddress.ip_address(text)
    except ValueError:
        return None
    return str(type(found)(permuter.rank(kind, int(found), 1 << found.max_prefixlen)))


def pseudonym(permuter: Permuter, kind: str, text: str) -> str | None:
    """What replaces a found value; None if it is not valid."""
    if kind in ("iso", "day"):
        return _date(permuter, kind, text)
    if kind in ("v4", "v6"):
        return _address(permuter, kind, text)
    return {"iban": _iban, "card": _card, "social": _social, "phone": _phone}[kind](permuter, text)


KINDS = ("iban", "card", "social", "iso", "day", "v4", "v6", "phone")


def replace(text: str, permuter: Permuter) -> tuple[str, int]:
    """``text`` with pseudonyms, and how many values were replaced."""
    if not MAYBE.search(text):
        return text, 0
    found = 0

    def email(m: re.Match) -> str:
        nonlocal found
        found += 1
        return f"{permuter.characters('email', m[1])}@{m[2]}"

    out: list[str] = []
    at = 0
    if "@" in text:
        # Numbers inside an address belong to it, so the parts between are searched.
        for m in EMAIL.finditer(text):
            out += [text[at : m.start()], email(m)]
            at = m.end()
    out.append(text[at:])
    for k in range(0, len(out), 2):
        part, pieces, start, search = out[k], [], 0, 0
        while m := NUMBERS.search(part, search):
            kind = next(name for name in KINDS if m[name])
            value = dialled(m[kind]) if kind == "phone" else m[kind]
            new = pseudonym(permuter, kind, value)
            if new is None:
                # Not valid: what begins later inside it may be another value.
                search = m.start() + 1
                continue
            found += 1
            pieces += [part[start : m.start()], new]
            start = search = m.start() + len(value)
        out[k] = "".join([*pieces, part[start:]])
    return "".join(out), found


def replacer(key: str, back: bool):
    @F.arrow_udf("struct<text: string, found: long>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        permuter = Permuter(key.encode(), back)
        for batch in batches:
            rows = [replace(t, permuter) if t else (t, 0) for part in slices(batch) for t in part]
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
                ["text", "found"],
            )

    return of


def session_key(spark: SparkSession) -> str:
    """The key of the session; only a local one may go without, with a key that anybody
    can read here and turn pseudonyms back."""
    key = spark.conf.get(SETTING, None)
    if not key and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a secret of 1 to 64 bytes")
    return key or TEST_KEY


def with_pseudonyms(
    docs: DataFrame, key: str, text: str = "text", found: str = "n_pseudonyms", back: bool = False
) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and how many values were.

    ``key`` has 1 to 64 bytes. ``back`` undoes an earlier call with the same key.
    Null and empty texts stay as they are with 0 values. Rows stay, repeats too;
    other columns pass through, ``found`` replaces a column of its name. An empty
    table gives no rows.
    """
    made = unused(docs, "made")
    out = docs.withColumn(made, replacer(key, back)(F.col(f"`{text}`")))
    order = [F.col(f"`{c}`") if c != text else F.col(f"{made}.text").alias(c) for c in docs.columns if c != found]
    return out.select(*order, F.col(f"{made}.found").alias(found))


def op1_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_pseudonyms(docs, session_key(spark))


QUERIES = {"op1_pii_pseudonyms": (op1_pii_pseudonyms, None)}
