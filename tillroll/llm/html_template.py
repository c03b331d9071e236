"""Main text of pages by equivalence-class template deduction.

The pages of a host come from one template. A token is a start or end tag or a
whole text block, told apart by the path of elements it stands in. Its occurrence
vector says how often each page of the host holds it. Tokens with equal vectors
form an equivalence class. A class is valid if it has more than one token and
occurs on enough pages; its tokens belong to the template if the elements around
them do, so valid classes nest. What lies between template tokens are the slots.
A text in a valid class is template as well. Of the slots, those whose words are
mostly links over the host's pages are menus, and those in elements that are named
for something else (navigation, adverts, comments) are left out. If ``article`` or ``main`` elements hold half of the words that remain, the text
is theirs; else all remaining slots are the page's text, however short a block is.

Pages with equal html count once, so a page that was fetched many times is no
template. A host with fewer than ``PAGES`` different pages has none: there names decide,
and a group of blocks in one place that are mostly links is a menu.

A vector is never stored: the exclusive or of a hash of (page, count) over the
pages stands for it. So a host with a third of all pages is summed in every task
before the shuffle, and its template stays as small as a page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.html_blocks import Block, Element, parse
from tillroll.llm.texts import slices, unused
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

#: A class occurs on at least this many different pages, and on this share of the host's.
PAGES, SHARE = 5, 0.5
#: From this share of linked words on, a slot is a menu.
LINKED = 0.5

# Names of elements that are not the article, and words that names of
# classes, ids and roles have for such elements.
OUTSIDE = frozenset("head nav header footer aside form button select option dialog menu object video audio canvas".split())
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer header masthead comment comments commentlist discussion disqus reply replies respond cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup share sharing social related recommended recommendation recommendations widget widgets popup modal overlay login search "
    "pagination pager toolbar copyright skip hidden complementary contentinfo dialog".split()
)
#: Of these, what is also found around the whole of a page.
MAY_WRAP = frozenset("<form> header hidden login masthead modal notice overlay popup search sidebar social subscribe toolbar widget widgets".split())
#: Parts of a name: it tells a state of the page; it is no more than a box.
STATES = frozenset("has have no not with without hide show".split())
BOXES = frozenset(
    "area bar block body bottom box button buttons container content group holder inner item items left link links list outer panel right row "
    "section slot thread top unit wrap wrapper".split()
)
INSIDE = frozenset({"article", "main"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
#: What they are called says how a page looks, not what it holds.
WHOLE = frozenset({"html", "body"})

Path = tuple[Element, ...]


def about(name: str) -> str | None:
    """What a name like ``user-comments`` or ``ad-slot-left`` is about: its last part that
    is no box. ``has-sidebar`` and ``comments-open`` are about neither."""
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    left = [p for p in parts if p not in BOXES]
    return left[-1] if left and not STATES.intersection(parts) else None


@lru_cache(maxsize=4096)
def outside(element: Element) -> frozenset[str]:
    """What says that an element is not part of an article; usually nothing."""
    if element.name in WHOLE:
        return frozenset()
    kind = {f"<{element.name}>"} if element.name in OUTSIDE else set()
    return frozenset(kind | NOT_TEXT.intersection(map(about, element.called)))


def wrappers(blocks: list[Block]) -> frozenset[int]:
    """Elements (by their number in the page) that are named for something else but stand around the page's text: at
    least half of the words, with all first-level headings, or, without any, all words.

    Only names in ``MAY_WRAP`` can be mistaken so; what other names leave out is not counted.
    """
    total = headings = 0
    held: dict[int, list[int]] = {}
    for block in blocks:
        named = [(k, why) for k, e in zip(block.opened, block.path) if (why := outside(e))]
        if any(why - MAY_WRAP for _, why in named):
            continue
        heading = any(e.name == "h1" for e in block.path)
        total, headings = total + block.words, headings + heading
        for k, _ in named:
            sums = held.setdefault(k, [0, 0])
            sums[0] += block.words
            sums[1] += heading
    whole = lambda words, h1: 2 * words >= total if headings and h1 == headings else words == total
    return frozenset(k for k, sums in held.items() if whole(*sums))


def left_out(block: Block, around: frozenset[int] = frozenset()) -> bool:
    """Whether any element the block stands in, wrappers apart, says so; for a heading in
    an article's header none does."""
    article = False
    for k, element in zip(block.opened, block.path):
        why = outside(element)
        heads = article and block.path[-1].name in HEADINGS and why <= {"<header>", "header"}
        if why and not heads and k not in around:
            return True
        article |= element.name in INSIDE
    return False


def number(*parts: str) -> int:
    """A signed 64-bit number for a token."""
    digest = xxhash.xxh64_intdigest("\x00".join(parts))
    return digest - (1 << 64) if digest >> 63 else digest


@lru_cache(maxsize=1 << 14)
def place(path: Path) -> int:
    return number("<", *map(str, path))


def text_token(block: Block) -> int:
    return number("text", str(place(block.path)), block.text)


TOKENS = "array<struct<token: long, around: long, text: boolean, n: int, words: int, linked: int>>"
TOKENS_ARROW = pa.list_(
    pa.struct(
        [
            ("token", pa.int64()), ("around", pa.int64()), ("text", pa.bool_()), ("n", pa.int32()),
            ("words", pa.int32()), ("linked", pa.int32()),
        ]
    )
)


def tokens_of(source: str | None) -> list[dict]:
    """Every token of a page: its count, and for start tags the text right inside."""
    blocks, tags = parse(source)
    starts, ends, texts = Counter(), Counter(), Counter()
    around: dict[int, int] = {}
    for path, starting in tags:
        inner, outer = place(path), place(path[:-1])
        token = inner if starting else number(">", str(inner))
        around[token] = outer if starting else inner
        (starts if starting else ends)[token] += 1
    inside: dict[int, list[int]] = {}
    for block in blocks:
        token = text_token(block)
        around[token] = place(block.path)
        texts[token] += 1
        sums = inside.setdefault(around[token], [0, 0])
        sums[0] += block.words
        sums[1] += block.linked
    out = []
    for token, n in (starts + ends + texts).items():
        held = inside.get(token, (0, 0)) if token in starts else (0, 0)
        row = {"token": token, "around": around[token], "text": token in texts, "n": n}
        out.append(row | dict(zip(("words", "linked"), held)))
    return out


def tokens():
    @F.arrow_udf(TOKENS)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([tokens_of(s) for part in slices(batch) for s in part], TOKENS_ARROW)

    return of


def host_of(url: Column) -> Column:
    """The host of an address; without one, the empty text."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame) -> DataFrame:
    """(host, fixed, linking): the template's tokens, and its slots that are lists of links.

    ``pages`` has host, page (distinct numbers) and html. Of pages of a host with equal
    html one is counted.
    """
    content = F.unhex(F.md5("html")).alias("content")
    read = cut_lineage(pages.select("host", "page", content, tokens()("html").alias("tokens")))
    different = read.groupBy("host", "content").agg(F.min("page").alias("page"))
    # Stored, their size is known: where there are few, no page is shuffled.
    copies = cut_lineage(read.select("page").join(different.select("page"), "page", "left_anti"))
    counted = read.join(copies, "page", "left_anti").select("host", "page", F.inline("tokens"))
    per_token = counted.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
        F.count("*").alias("pages"),
        F.min("around").alias("around"),
        F.first("text").alias("text"),
        *[F.sum(c).alias(c) for c in ("words", "linked")],
    )
    stored = cut_lineage(per_token)
    on_host = different.groupBy("host").agg(F.count("*").alias("of"))
    classes = stored.groupBy("host", "vector").agg(F.count("*").alias("size"), F.first("pages").alias("pages"))
    enough = (F.col("size") > 1) & (F.col("pages") >= PAGES) & (F.col("pages") >= SHARE * F.col("of"))
    valid = classes.join(on_host, "host").where(enough).select("host", "vector")
    members = stored.join(valid, ["host", "vector"])
    element = members.select("host", F.col("token").alias("around"), F.lit(True).alias("inner"))
    nested = members.join(element, ["host", "around"], "left").where(F.col("inner") | (F.col("around") == place(())))
    linking = (F.col("words") > 0) & (F.col("linked") >= LINKED * F.col("words"))
    return nested.groupBy("host").agg(
        F.collect_set(F.when(F.col("text"), F.col("token"))).alias("fixed"),
        F.collect_set(F.when(linking, F.col("token"))).alias("linking"),
    )


def menus(blocks: list[Block]) -> set[int]:
    """Of one page, the places of more than one block whose words are mostly links."""
    sums: dict[Path, list[int]] = {}
    for block in blocks:
        held = sums.setdefault(block.path, [0, 0, 0])
        for k, x in enumerate((1, block.words, block.linked)):
            held[k] += x
    return {place(path) for path, (n, words, linked) in sums.items() if n > 1 and linked >= LINKED * words}


def main_text(source: str | None, fixed: set[int], linking: set[int]) -> str:
    """The text in a page's remaining slots."""
    blocks = [b for b in parse(source)[0] if text_token(b) not in fixed]
    around = wrappers(blocks)
    blocks = [b for b in blocks if not left_out(b, around)]
    lists = linking or menus(blocks)
    within = {b.path: any(e.name in INSIDE for e in b.path) for b in blocks}

    def listed(path: Path) -> bool:
        """Whether the block is a link of a menu; a linked title is none."""
        own = path[-1].name if path else ""
        if own == "h1" or own in HEADINGS and within[path]:
            return False
        return any(place(path[:n]) in lists for n in range(1, len(path) + 1))

    if lists:
        blocks = [b for b in blocks if not listed(b.path)]
    inside = [b for b in blocks if within[b.path]]
    if 2 * sum(b.words for b in inside) >= sum(b.words for b in blocks):
        blocks = inside
    return "\n".join(b.text for b in blocks)


def extractor():
    @F.arrow_udf("string")
    def of(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for sources, fixed, linking in batches:
            out, at = [], 0
            for part in slices(sources):
                lists = zip(fixed.slice(at, len(part)).to_pylist(), linking.slice(at, len(part)).to_pylist())
                for source, (f, k) in zip(part, lists):
                    out.append(main_text(source, set(f or ()), set(k or ())))
                at += len(part)
            yield pa.array(out, pa.string())

    return of


def with_main_text(
    pages: DataFrame, url: str = "url", html: str = "html", names: tuple[str, str] = ("text", "n_chars")
) -> DataFrame:
    """``pages`` with the main text of each page and its code points.

    A null or empty page has an empty text. Pages without a host form one group.
    A host with fewer than ``PAGES`` different pages has no template; element names
    decide there alone. Equal pages of a host count once for its template and get the
    same text. Rows stay, repeats too; other columns pass through, the two names are
    replaced. An empty table gives no rows.
    """
    text, n_chars = names
    known = pages.select(
        host_of(F.col(f"`{url}`")).alias("host"), F.monotonically_increasing_id().alias("page"), F.col(f"`{html}`").alias("html")
    )
    key, fixed, linking = (unused(pages, n) for n in ("host_key", "fixed_tokens", "linking_slots"))
    # Stored, its size is known: a small table of templates is broadcast by the
    # engine, and the pages are not shuffled.
    found = cut_lineage(templates(known).toDF(key, fixed, linking))
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in names]
    joined = pages.withColumn(key, host_of(F.col(f"`{url}`"))).join(found, key, "left")
    made = joined.select(*kept, extractor()(F.col(f"`{html}`"), F.col(fixed), F.col(linking)).alias(text))
    return made.withColumn(n_chars, F.length(F.col(f"`{text}`")).cast("long"))


def op3_template_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", "n_chars")


QUERIES = {"op3_template_extraction": (op3_template_extraction, None)}
