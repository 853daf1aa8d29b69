"""Main text of pages whose article is known."""

import html
import re
import time
import tracemalloc

import pytest

from tidemark.llm import main_text as M
from tidemark.llm import queries

SMALL = "/root/testdata/sf0.001"


def article(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", p))).strip() for p in parts]
    return " ".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in queries.op3_main_text(spark, SMALL).collect()}
    for p in pages.collect():
        wanted = article(p.html)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (wanted, len(wanted))
        assert got[p.page_id].url == p.url


LONG = "Some words of the story, told at length. " * 8
PAGE = f"""<html><head><title>x</title></head><body class="has-sidebar"><header><h1>Site</h1><nav><a href=1>Home</a></nav></header>
<div class="cookie-notice">We use cookies, is that fine?</div><div id=wrap><main><article><header class="entry-header">
<h1>Title &amp; more</h1></header><p>First, {LONG}</p><div class="ad">Buy this, now.</div><ul><li>one<li>two</ul>
<p>Second <b>bold</b>&nbsp;words<br>in a line.<p>Third one.<aside>Side, note.</aside><form><label>Mail, please</label></form>
<script>var a="<p>no</p>";</script><style>p {{}}</style></article><section id="comments"><h2>Comments</h2><p>I liked it, {LONG}</p>
</section></main><div class="sidebar"><p>Side text, {LONG}</p></div></div><footer>foot, {LONG}</footer></body></html>"""


def test_furniture_is_left_out():
    assert M.main_text(PAGE) == (
        f"Title & more First, {LONG.strip()} one two Second bold words in a line. Third one."
    )


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain & simple", "plain & simple"),
        ("<p>a &lt; b &am c", "a < b &am c"),
        ("<div>a < b and c</div>", "a < b and c"),
        ("<script>only", ""),
        ("<!-- never closed <p>x", ""),
        ("<nav><a href='/'>Home</a></nav>", ""),
        ("<p>cut off in a <b class=", "cut off in a"),
        ("<<<>>>", "<<<>>>"),
    ],
)
def test_small_and_broken_pages(page, text):
    assert M.main_text(page) == text


def test_pages_without_article_elements():
    body = f"<div class=menu><a href=1>A</a></div><div class=content><h2>Head</h2><div><p>{LONG}</p></div><div><p>{LONG}</p><p>Short.</p></div></div><div class=related><p>Other, {LONG}</p></div>"
    assert M.main_text(f"<body><div>{body}</div></body>") == f"Head {LONG.strip()} {LONG.strip()} Short."


def test_all_content_is_kept_however_it_is_divided():
    body, end = f"<p>{LONG}</p>" * 3, "<p>In the end, it was short, but not lost.</p>"
    text = " ".join([LONG.strip()] * 3)
    for tag in ("article", "div"):
        for inner in ("section", "div"):
            page = f"<body><{tag}><{inner}>{body}</{inner}><{inner}>{end}</{inner}></{tag}></body>"
            assert M.main_text(page) == f"{text} In the end, it was short, but not lost."
        page = f"<body><{tag}><h1>Title</h1><p>Lead</p><div>{body}</div></{tag}></body>"
        assert M.main_text(page) == f"Title Lead {text}"


@pytest.mark.parametrize(
    "before, after",
    [
        ("<div class='elementor-widget-container'>", "</div>"),
        ("<div id='content-sidebar-wrap'>", "</div>"),
        ("<div class='page no-sidebar'>", "</div>"),
        ("<div class='layout-right-sidebar'>", "</div>"),
        ("<div class='post-content comments-open'>", "</div>"),
        ("<form id='form1' action='/'>", "</form>"),
    ],
)
def test_names_of_wrappers_do_not_hide_the_article(before, after):
    for inner in (f"<p>{LONG}</p>", f"<article><p>{LONG}</p></article>"):
        page = f"<body>{before}<div class='sidebar'><p>Side text.</p></div>{inner}{after}</body>"
        assert M.main_text(page) == LONG.strip()
    divided = f"{before}<p>{LONG}</p>{after}" * 3
    assert M.main_text(f"<body>{divided}</body>") == " ".join([LONG.strip()] * 3)


def test_links_and_formulas_inside_the_article_are_kept():
    page = (
        f"<body><div><a href=0>Elsewhere</a></div><article><p>{LONG}</p><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> it is.</p>"
        "<svg><title>no</title><text>In a drawing</text></svg><noscript>No script.</noscript>"
        "<p><a href=1>See the whole linked sentence.</a></p><ul><li><a href=2>Source</a></ul></article><noscript>Out</noscript></body>"
    )
    assert M.main_text(page) == f"{LONG.strip()} So x=2 it is. In a drawing No script. See the whole linked sentence. Source"


def test_paths_without_content_are_left_out_whatever_their_names():
    junk = "<div>Buy now</div>"
    for inner in (f"<div><p>{LONG}</p><p>{LONG}</p></div>{junk}<div><p>{LONG}</p><p>And so on.</p></div>",):
        for tag in ("body", "article"):
            assert M.main_text(f"<{tag}>{inner}</{tag}>") == " ".join([LONG.strip()] * 3) + " And so on."
    page = f"<article><div><h2>Part</h2></div><div><p>{LONG}</p></div><div><span>12 readers</span></div><div><h2>Next</h2></div><div><p>{LONG}</p></div></article>"
    assert M.main_text(page) == f"Part {LONG.strip()} Next {LONG.strip()}"
    named = f"<article><p class='share'>Share it</p><p>{LONG}</p><p>Short.</p></article>"
    assert M.main_text(named) == f"{LONG.strip()} Short."


def test_threshold_and_smoothing_decide(monkeypatch):
    lead = f"<body><div>Of rivers, briefly.</div><div><p>{LONG}</p></div><div>And what came after it.</div></body>"
    monkeypatch.setattr(M, "PATH_SHARE", 0.0)
    everything = M.main_text(lead)
    assert everything == f"Of rivers, briefly. {LONG.strip()} And what came after it."
    monkeypatch.setattr(M, "PATH_SHARE", 0.2)
    assert M.main_text(lead) == LONG.strip()
    shares = []
    for smoothing in ((0.25, 0.5, 0.25), (0.0, 1.0, 0.0)):
        monkeypatch.setattr(M, "SMOOTHING", smoothing)
        tree, blocks = M._blocks(lead)
        shares.append(M._path_scores(blocks)[0])
    assert shares[0] > 2 * shares[1]


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 50_000 + "Deep, text.",
        "<div>x, " * 50_000,
        "<article>y " * 30_000,
        "<div>" * 20_000 + "</p>" * 20_000 + "z",
        "<div class=ad>t " * 20_000,
        "<b>" * 20_000 + "<p>x" * 5_000,
    ],
)
def test_deeply_nested_pages(page):
    tracemalloc.start()
    began = time.process_time()
    assert M.main_text(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and time.process_time() - began < 20


def test_rows_are_kept_with_awkward_values(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (2, "v", "<p>" * 20_000 + "deep, text.", "x"), (3, "w", "<a " * 5_000, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = M.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((repr(r.page_id), r.text, r.n_chars) for r in out.collect())
    assert got == sorted((repr(r[0]), M.main_text(r[2]), len(M.main_text(r[2]))) for r in rows)
    assert M.extract(pages.where("false")).isEmpty()
