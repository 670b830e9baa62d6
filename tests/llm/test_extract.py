"""op12: page shapes the given tables don't hold, broken markup, cases."""

import pytest
from pyspark.sql import functions as F

from sitemerge.llm import extract

LONG = "The harbour was quiet that morning and the boats lay still while the old men mended their nets near the wall."
SECOND = ("Nobody remembered when the last ship had left, though everybody agreed that it must have been before the "
          "long winter, because the ice had closed the bay for more than two months that year.")

FULL = f"""<!DOCTYPE html><html class="no-js sidebar"><head><title>T &amp; U</title><style>p {{}}</style></head>
<body class="has-sidebar"><div id="cookie-banner"><p>{LONG} We use cookies.</p></div>
<header><a href=/>Home</a><p>{LONG}</p></header>
<nav><ul><li><a href=/a>One<li><a href=/b>Two</ul></nav>
<aside class="left"><article><p>{LONG} teaser</p></article></aside>
<form action="/s"><label>Search</label><input name=q><button>Go</button></form>
<main><article id="post-1"><header><h1>Title &ndash; here</h1></header>
<p>Short.</p><p>{LONG}</p><script>document.write("<p>no</p>")</script>
<div class="ad">Buy now</div><p>A <b>bo</b>ld&nbsp;word,<br>new line <a href="x">and a link</a>.</p>
<ul><li>first<li>second</ul><noscript>off</noscript><table><tr><td>x<td>y</table>
<!-- <p>comment</p> --><blockquote>{SECOND}</blockquote>
<footer>By someone</footer></article>
<section id="comments"><article class="comment"><p>{LONG} I agree!</p></article></section></main>
<div class="notice" role="alert">{LONG}</div><footer>&copy; 2024 {LONG}</footer></body></html>"""
FULL_TEXT = f"Title – here Short. {LONG} A bold word, new line and a link. first second x y {SECOND}"

PLAIN = f"""<body><div><a href=/>Home</a> <a href=/n>News</a></div><div><h2>Old harbour news</h2>
<p>{LONG}<p>{SECOND}<p>{LONG}</div>
<div class="comments"><p>{LONG}</p></div><div><a href=1>Next story about ships</a></div><div><a href=2>More</a></div>"""
PLAIN_TEXT = f"Old harbour news {LONG} {SECOND} {LONG}"


def text_of(page):
    blocks = extract.read_blocks(page)
    main = extract.train().predict(extract.features([b[:5] for b in blocks], [0, len(blocks)])) > 0.5
    return " ".join(b[5] for b, m in zip(blocks, main) if m)


@pytest.mark.parametrize("page, text", [
    (FULL, FULL_TEXT),
    (PLAIN, PLAIN_TEXT),
    (FULL.replace("<main>", "").replace("</main>", ""), FULL_TEXT),
    (FULL.upper().replace("&NBSP;", "&nbsp;").replace("&NDASH;", "&ndash;").replace("&AMP;", "&amp;"), FULL_TEXT.upper()),
    (f"<form id=aspnet><article><p>{LONG}</article></form>", LONG),
    (f"<article><p class=ad>{SECOND}<p>{LONG}</article>", LONG),
    (f"<article><p>{LONG} <span class=share>Share</span> end</article>", f"{LONG} end"),
    (f"<div class='entry-content'><p>Yes.</p></div><p>{LONG}", "Yes."),
    (f"<article><p>{LONG}</p><p>cut &am", f"{LONG} cut &am"),
    (f"<article><p>{LONG}</p><p>cut &amp", f"{LONG} cut &"),
    (f"<article><p>{LONG}</p><p>cut</arti", f"{LONG} cut"),
    (f"<article><p>{LONG}</p><!-- cut", LONG),
    (f"<article><p>{LONG}</p><script>cut", LONG),
    ("<article><p>a < b, 3 > 2 &lt;i&gt; &#65;&#x42;&copy &unknown; <a title='x > y' href=\"</p>\">l</a>",
     "a < b, 3 > 2 <i> AB© &unknown; l"),
    ("<article><p>x</b></i></div></p></p>y</article>z", "x y"),
    ("<article hidden><p>x</article>", ""),
    ("<p style='display: none'>x", ""),
    (f"{SECOND}", SECOND),
    ("", ""), (None, ""), ("<", ""), ("<article>   </article>", ""), ("</>", ""),
    ("<article><svg><text>no</text></svg>yes<textarea>no</textarea></article>", "yes"),
    ("<article>漢字かな</article><aside>漢字</aside>", "漢字かな"),
])
def test_pages(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages_stay_linear():
    deep = "<article>" + "<div><b><i>" * 20_000 + "x" + "</u>" * 20_000
    assert text_of(deep) == "x"
    many = "<article>" + "<p><b>word <i>more<br>" * 20_000
    assert text_of(many) == " ".join(["word more"] * 20_000)
    assert text_of("<article><p a=\"" * 3000) == ""


def test_tree_fits_its_table():
    x, y = extract.labelled_rows()
    assert ((extract.train().predict(x) > 0.5) == y).all() and len(y) < 200


def test_extract_cases(spark):
    rows = [(1, FULL, "old", 9), (1, FULL, "old", 9), (2, None, "old", 9), (3, "", "old", 9), (None, PLAIN, "old", 9)]
    df = spark.createDataFrame(rows, "id long, html string, text string, words int")
    got = extract.extract_text(df)
    assert got.columns == ["id", "html", "words", "text", "n_blocks"]
    assert [(r["id"], r["text"]) for r in got.orderBy(F.col("id").asc_nulls_last()).collect()] == [
        (1, FULL_TEXT), (1, FULL_TEXT), (2, ""), (3, ""), (None, PLAIN_TEXT)]
    assert extract.extract_text(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        extract.extract_text(df, html_col="text")
