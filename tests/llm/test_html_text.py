import time
import re

import pytest
from gaugeloft.llm.html_text import Lines, extract_text, main_text, smoothed

PROSE = "A long sentence of the article that goes on for a while, with commas, and says something. " * 3
MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("<html><body><script>var t = '<p>x</p>';</script></body></html>", ""),
        ("plain words only", "plain words only"),
        (f"<body>{MENU}<article><h1>Title</h1><p>One &amp; two&nbsp;\n three.</p><p>Hm.</p></article><footer>&copy; x</footer>", "Title\nOne & two three.\nHm."),
        (f"<body>{MENU}<article><p><b>Unclosed<br><p>Next</article>", "Unclosed\nNext"),
        (f"<div class='header'>Site</div><div id='content'><p>{PROSE}</p><p>Short.</p></div><div class='sidebar'><p>{PROSE}</p></div>", f"{PROSE.strip()}\nShort."),
        (f"<main><article><p>{PROSE}</p><aside>See also</aside><form><p>Mail</p><input></form></article><section class='comments'><p>{PROSE}</p></section></main>", PROSE.strip()),
        (f"<article><header><h1>Title</h1><p>by someone</p></header><p>{PROSE}</p><div class='cookie-notice'>We use cookies</div><div class='ad'>Buy</div></article>", f"Title\n{PROSE.strip()}"),
        (f"<article><p>{PROSE}</p></article><article class='comment'><p>{PROSE}{PROSE}</p></article>", PROSE.strip()),
        (f"<body class='has-sidebar'><div class='page'><p>{PROSE}</p><ul><li>first</li><li>second</li></ul></div></body>", f"{PROSE.strip()}\nfirst\nsecond"),
        ("<article><table><tr><td>a</td><td>b</td></tr></table><pre> x  y </pre>tail</article>", "a b\nx y\ntail"),
        ("<article><p>a<span hidden>no</span>b <span class='ad'>Buy</span>c</p></article>", "ab c"),
        ("<p>5 &lt; 6 &#x41;&unknown; &am", "5 < 6 A&unknown; &am"),
        ("<article><!-- note --><p>kept</p><![CDATA[x]]></article", "kept"),
    ],
)
def test_pages(html, want):
    assert main_text(html) == want


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body>{MENU}<div id=content><h1>T</h1><div class=lead><p>{PROSE}</p></div><div class=story><p>{PROSE}{PROSE}</p><p>{PROSE}{PROSE}</p></div></div>", f"T\n{PROSE.strip()}\n" + "\n".join([(PROSE * 2).strip()] * 2)),
        (f"<body>{MENU}<div id=content><h1>T</h1><div class=story><p>{PROSE}</p></div></div>", f"T\n{PROSE.strip()}"),
        (f"<div><section><h2>A</h2><p>A short one.</p></section><section><h2>B</h2><p>{PROSE}{PROSE}</p></section></div>", f"A\nA short one.\nB\n{(PROSE * 2).strip()}"),
        (f"<div class=top><h1>T</h1></div><div><div><p>{PROSE}</p></div><div><p>{PROSE}</p></div></div><div class=sidebar><h3>No</h3><p>{PROSE}</p></div>", f"T\n{PROSE.strip()}\n{PROSE.strip()}"),
    ],
)
def test_pages_without_an_article_element(html, want):
    assert main_text(html) == want


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<article><p><span class='share'><b>Share</b></span> {PROSE}</p></article>", PROSE.strip()),
        (f"<article><p><a class='related'><em>term</em></a> {PROSE}</p></article>", PROSE.strip()),
        ("<article><p>One <span class='ad'><b>Buy</b> <i>now</i></span> two.</p></article>", "One two."),
        ("<article><p>One <button><b>Share</b></button><b>two</b> three.</p></article>", "One two three."),
        ("<article><p><b>One</b> two <span class='ad'><b><i>Buy</i></b></span></p><p>Three</p></article>", "One two\nThree"),
        ("<article><span class='ad'><b>Buy<p>now</p></b></span><p>One</p></article>", "One"),
    ],
)
def test_marked_inline_elements(html, want):
    assert main_text(html) == want


def plain(html):
    """The same by cutting the known frame of the test pages with expressions."""
    from html import unescape

    inner = re.search(r"<article>(.*?)(?:</article>|$)", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_all_pages(table):
    pages = table("pages")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = extract_text(pages).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {k: plain(v) for k, v in html.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_long_pages_and_clashing_names(spark):
    page = "<article>" + "".join(f"<p>{PROSE}{i}</p>" for i in range(20_000)) + "</article>"
    df = spark.createDataFrame([(1, page, "old"), (2, None, "old"), (2, None, "old")], "page_id long, html string, TEXT string")
    rows = sorted(extract_text(df).collect(), key=lambda r: r["page_id"])
    assert rows[0]["text"].count("\n") == 19_999
    assert [r["text"] for r in rows[1:]] == ["", ""]
    assert "TEXT" not in rows[0].asDict()
    assert extract_text(df.limit(0)).collect() == []
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert main_text(deep) == "x"


def test_smoothing_keeps_the_mean_of_even_lines():
    import numpy as np

    assert np.allclose(smoothed(np.full(9, 3.0)), 3.0)
    page = Lines()
    page.feed("<p>a</p><p>b <a>c</a></p>")
    page.close()
    assert [("".join(t for _, t in pieces), linked) for _, pieces, _, linked in page.lines] == [("a", 0), ("b c", 1)]


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<article><p>{PROSE}</p></article><section id='comments'><article><p>{PROSE}{PROSE}</p></article></section>", PROSE.strip()),
        (f"<article><p>{PROSE}</p></article><div class='comments'><article><p>{PROSE}{PROSE}</p></article></div>", PROSE.strip()),
        (f"<article><p>{PROSE}</p><p>Before <span class='ad'>Buy <b>now</b></span>after</p></article>", f"{PROSE.strip()}\nBefore after"),
        (f"<article><p><span class='share'><b>Share</b></span> Long words here {PROSE}</p></article>", f"Long words here {PROSE.strip()}"),
        (f"<article><p class='share-price'>Up 3%</p><div class='text-widget'><p>{PROSE}</p></div><p class='alert-level'>High</p></article>", f"Up 3%\n{PROSE.strip()}\nHigh"),
        (f"<body><div class='form'><h1>T</h1><p>{PROSE}</p></div><div class='share'>Share</div></body>", f"T\n{PROSE.strip()}"),
        (f"<main><h1>T</h1><article><p>{PROSE}</p></article><p>tail</p></main>", f"T\n{PROSE.strip()}\ntail"),
        (f"<article><p>{PROSE}</p><div class='cookie-banner'>We</div><div class='ad-slot'>Buy</div><div class='relatedPosts'>More</div></article>", PROSE.strip()),
    ],
)
def test_marks_and_regions(html, want):
    assert main_text(html) == want


@pytest.mark.parametrize(
    "html",
    [
        "<article>" + "<span>" * 100_000 + "".join(f"<p>word {i}" for i in range(20_000)) + "</article>",
        "<div>x" * 100_000,
        "<p>" + "<b> </b>" * 100_000 + "text",
        "<ul>" + "<li><i>" * 50_000 + "end",
        "<table><tr><td>" + "<span>" * 50_000 + "</p>" * 50_000 + "x",
        "<section class='comments'>" * 30_000 + "remark" + "</section>" * 30_000 + "<p>text</p>",
    ],
)
def test_time_grows_with_the_page_only(html):
    begin = time.process_time()
    main_text(html)
    assert time.process_time() - begin < 6
