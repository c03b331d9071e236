import html
import random
import re

import __spark_entry__ as repo
from tillroll.llm import html_template as ht
from tillroll.llm.html_blocks import parse


def blocks(source):
    return [(".".join(map(str, b.path)), b.text) for b in parse(source)[0]]


def test_blocks_of_loose_markup():
    got = blocks('<body><p>One <b>two<br>three<p>four&nbsp;&amp; five\n six<ul><li>a<li>b</ul>tail<script>"</p>"</script> end<!-- x > y')
    assert got == [("body.p", "One two three"), ("body.p", "four & five six"), ("body.ul.li", "a"), ("body.ul.li", "b"), ("body", "tail end")]
    assert blocks(None) == blocks("") == [] and blocks("a < b &lt; c") == [("", "a < b < c")]
    assert blocks("<div class='x 7' id=Main>t</div></p>u") == [("div.0.main.x", "t"), ("", "u")]
    assert [b.linked for b in parse("<li><a href=x>one two</a> three")[0]] == [2]


def test_scanning_stays_linear():
    for bad in ('<a "' * 50_000, "<!--" * 50_000, "<p" * 100_000, "<script>" * 20_000, "</b>" * 50_000):
        parse(bad)


def page(rng, k):
    word = lambda n: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega", "&eacute;t&eacute;"], k=n))
    title, paragraphs = word(4), [word(rng.randint(12, 40)) + f" {k}" for _ in range(rng.randint(1, 5))]
    gold = "\n".join(html.unescape(x) for x in [title, *paragraphs])
    body = "".join(f"<p>{p}" for p in paragraphs)
    plain = (
        f"<html><head><title>{title}</title></head><body><div class=top><p>Welcome to our pages of very many long and constant words here</div>"
        f"<div class=links>{''.join(f'<p><a href=/{i}>{word(9)}</a></p>' for i in range(rng.randint(2, 6)))}</div>"
        f"<div class=text><h1>{title}</h1>{body}</div><div class='user-comments'><p>{word(20)}</div>"
        f"<form><p>{word(20)}</form><footer>&copy; {word(10)}</footer></body></html>"
    )
    return plain, gold


def test_template_text_and_link_slots_go_without_an_article_element(session):
    rng = random.Random(3)
    made = [page(rng, k) for k in range(40)]
    rows = [(k, f"http://u@Host.example:80/{k}", m[0]) for k, m in enumerate(made)]
    got = ht.with_main_text(session.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {k: m[1] for k, m in enumerate(made)}


def test_nulls_small_hosts_clashes_and_empty_tables(spark):
    article = "<html><body><nav>menu</nav><article><h1>T</h1><p>One &lt;b&gt;</p><div class=ad>buy</div><p>two</article><p>no</body></html>"
    rows = [(1, None, None, "x"), (2, "", "", "x"), (3, "//a.b/c", article, "x"), (3, "//a.b/c", article, "x"), (4, "odd", "plain text of more than eight words stands here alone", "x"), (5, "//a.b", "<p>" + "long " * 100_000, "x"), (None, "//c.d", "<nav>x</nav>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = ht.with_main_text(df)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    out = [(r.page_id, r.text, r.n_chars) for r in got.collect()]
    assert sorted(x for x in out if x[0] == 3) == [(3, "T\nOne <b>\ntwo", 13)] * 2
    by = {x[0]: x[1:] for x in out}
    assert by[1] == by[2] == by[None] == ("", 0) and by[4][0].startswith("plain") and by[5][1] == 499_999
    assert len(out) == len(rows) and ht.with_main_text(df.limit(0)).count() == 0


def test_vectors_tell_classes_apart(session):
    rows = [(k, "//h.x/", f"<body><p>same</p><div><i>{k}</i></div>" + "<ul><li>v</ul>" * (k % 2)) for k in range(10)]
    pages = session.createDataFrame(rows, "page long, host string, html string")
    made = ht.templates(pages).collect()[0]
    assert ht.text_token(parse(rows[0][2])[0][0]) in made.fixed and len(made.fixed) == 2


ARTICLE = "<article><h1>Title</h1><p>The text of the page.</article>"
GOLD = "Title\nThe text of the page."
ONE_PAGE = {
    "state of the body": (f"<body class='home has-sidebar'><nav>menu</nav>{ARTICLE}</body>", GOLD),
    "state of a wrapper": (f"<div class='single comments-open'>{ARTICLE}<div class=comments><p>nice</div></div>", GOLD),
    "name of the article": (ARTICLE.replace("<article", "<article class=widget-page"), GOLD),
    "name of a paragraph": (ARTICLE.replace("<p>", "<p id=search-algorithms>"), GOLD),
    "form around the page": (f"<body><form id=aspnetForm><nav>menu</nav>{ARTICLE}<footer>foot</footer></form>", GOLD),
    "form around a page without article": ("<form><h1>Title</h1><p>The text of the page.</form><form>Your mail</form>", GOLD),
    "teaser article": ("<div class=post><h1>Title</h1><p>The text of the page.</div><aside><article><p>Read this too, it is long, long and long</article></aside>", GOLD),
    "short teaser article outside": ("<div class=post><h1>Title</h1><p>The text of the page.</div><article>More</article>", GOLD + "\nMore"),
    "short blocks": ("<h1>T</h1><pre>a = 1</pre><table><tr><td>x<td>y</table><blockquote>Said</blockquote><ul><li>one<li>two</ul>", "T\na = 1\nx\ny\nSaid\none\ntwo"),
    "linked paragraph": ("<h1>T</h1><p><a href=x>See here for more</a></p><ul><li><a>Home</a><li><a>About</a></ul>", "T\nSee here for more"),
    "article's own header": ("<article><header class=entry-header><h1>Title</h1><p>by me</header><p>Text</article>", "Title\nText"),
    "boxes": ("<h1>T</h1><div class=ad-slot-left>Buy</div><div id=comments-list><p>nice</div><div class=site-footer>Us</div><p>Text", "T\nText"),
    "long comments": (f"<div class=post><p>Text</div><div class=comments>{'<p>nice and long' * 50}</div>", "Text"),
}


def test_single_pages_by_their_names():
    got = {name: ht.main_text(page, set(), set()) for name, (page, _) in ONE_PAGE.items()}
    assert got == {name: gold for name, (_, gold) in ONE_PAGE.items()}


def test_equal_pages_of_a_host_are_one(session):
    rows = [(k, "http://a.b/", f"<body><h1>Title</h1><p>Body</p>{'<p>again' * (k // 8)}") for k in range(16)]
    got = ht.with_main_text(session.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {k: "Title\nBody" + "\nagain" * (k // 8) for k in range(16)}


def test_template_decides_inside_articles(session):
    """Notices and link lists that all pages have go, texts of the same length that vary stay."""
    rows, gold = [], {}
    for k in range(30):
        body = "".join(f"<p>Line {k} {i}</p>" for i in range(1 + k % 3))
        links = "".join(f"<li><a href=/{i}>Next {k} {i}</a></li>" for i in range(1 + k % 4))
        rows.append((k, "//a.b/", f"<body><article><h1>Title {k}</h1>{body}<div>Read us daily</div><ul>{links}</ul><div><b>{k}</b></div></article>"))
        gold[k] = "\n".join([f"Title {k}", *[f"Line {k} {i}" for i in range(1 + k % 3)], str(k)])
    got = ht.with_main_text(session.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == gold
    assert all(ht.main_text(r[2], set(), set()) != gold[r[0]] for r in rows)


def test_a_host_without_articles_keeps_short_blocks(session):
    rows, gold = [], {}
    for k in range(20):
        cells = [f"c{k}{i}" for i in range(1 + k % 5)]
        row = "".join(f"<td>{c}" for c in cells)
        rows.append((k, "//a.b/", f"<body class=no-sidebar><div class=top>Our site</div><div class=box><h2>H{k}</h2><pre>{k}</pre><table><tr>{row}</table></div><div class=foot>All rights</div>"))
        gold[k] = "\n".join([f"H{k}", str(k), *cells])
    got = ht.with_main_text(session.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == gold


def test_query_equals_the_article_elements(session):
    folder = repo.SMALL.replace("0.001", "0.01")
    pages = {r.page_id: r for r in session.read.parquet(f"{folder}/pages.parquet").collect()}
    got = repo.queries()["op3_template_extraction"](session, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in re.split("</?(?:h1|p|br)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
