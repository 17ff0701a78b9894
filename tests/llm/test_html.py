"""Main texts of written and of generated pages."""

import html as entities
import re
import time

import pytest

from orrery.llm import html

PAGE = """<html><head><title>No</title><style>p{}</style></head><body><div id="header">Top</div>
<ul class="menu"><li><a href=x>a</a><li><a href=y>b</a></ul>
<div class="wrap"><div class="content"><h2>Title &amp; more</h2>
<p>First para, with commas, and enough text to be counted as an article paragraph in any case.
<p>Second para<br>broken &lt;line&gt; here, it goes on and on, with words.
<ul><li>point one is text</li><li>point two is text</li></ul><ul><li><a href=1>link</a></li><li><a href=2>list</a></li></ul>
</div><div class="sidebar"><p>Buy now, buy this, buy that, and so on and so on, this is long enough, you know.</p></div></div>
<form><p>Enter, your, name, here, and, send, it, to, us, with, many, commas</p></form>
<section id="comments"><p>I think, that this, is a comment, with lots, of commas, that go on.</p></section>
<script>if (a<b) {"</p>"}</script><footer>End</footer></body></html>"""


def test_article_only():
    assert html.extract(PAGE) == ("Title & more\n\nFirst para, with commas, and enough text to be counted as an article "
                                  "paragraph in any case.\n\nSecond para broken <line> here, it goes on and on, with words."
                                  "\n\npoint one is text\n\npoint two is text")


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<", "a<"), ("<<>>&amp;<!-- x", "<<>>&"),
    ("<table><tr><td>x<td>y<tr><td>z</table>", "x\n\ny\n\nz"), ("<script>x</script>", ""),
    ('<p title="x > y">kept</p><p class="ad">no</p>', "kept"), ("<article></article>", ""),
    ("<div hidden>no</div><div style='display: none'>no</div><div>yes</div>", "yes"),
    ("<article><header><h1>T</h1></header><p>x</p></article><header>no</header>", "T\n\nx"),
])
def test_small_pages(page, text):
    assert html.extract(page) == text


LONG = "This is a long paragraph, with commas, and enough words, to count as text of the article."
TEN = f"<p>{LONG}</p>" * 10


@pytest.mark.parametrize("page, text", [
    (f"<article><h1>T</h1><div>{TEN}</div><div><p>End.</p></div></article>", ["T", *[LONG] * 10, "End."]),
    (f"<main>Bare<div>{TEN}</div><pre>code</pre><section><p>End.</p></section></main>",
     ["Bare", *[LONG] * 10, "code", "End."]),
    (f"<body><div><h2>T</h2><div>{TEN}</div><blockquote>Q</blockquote><table><tr><td>x</table></div></body>",
     ["T", *[LONG] * 10, "Q", "x"]),
    (f"<body><h1>T</h1><div>{TEN}</div><ul><li>point</li></ul><p>End.</p><ul><li><a href=x>links</a></ul></body>",
     ["T", *[LONG] * 10, "point", "End."]),
    (f"<body><div class='page has-sidebar'><article>{TEN}</article></div></body>", [LONG] * 10),
    (f"<body><div class='layout menu'><div>{TEN}</div><div class=ad>Buy</div></div><p>x</p></body>", [LONG] * 10),
    (f"<article>{TEN}<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul></article>", [*[LONG] * 10, "one", "two"]),
    (f"<article><p title='{'a > b ' * 2000}' lang=\"x > y\">kept</p></article>", ["kept"]),
])
def test_whole_articles(page, text):
    assert html.extract(page) == "\n\n".join(text)


@pytest.mark.parametrize("page, text", [
    (f'<article><h1 class="page-header">T</h1>{TEN}<h2 class="section-header">S</h2><p class="share-price">Up.</p>'
     '<p class="disclaimer-free">Free.</p><p id="comments-note">Note.</p></article>',
     ["T", *[LONG] * 10, "S", "Up.", "Free.", "Note."]),
    (f'<body><div class="stock share-price"><div>{TEN}</div></div></body>', [LONG] * 10),
    (f'<article><div class="entry-header"><h1>T</h1></div>{TEN}<div class="share-buttons">Share</div></article>',
     ["T", *[LONG] * 10]),
    (f"<article>{TEN}<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><label>Fig. 1</label></article>",
     [*[LONG] * 10, "Let x=1 be.", "Fig. 1"]),
    (f'<body><form action="/page.aspx"><div id="menu"><a href=x>Home</a></div><div>{TEN}</div><label>Search</label>'
     '<input name=q><button>Go</button></form></body>', [LONG] * 10),
    (f"<body><form action='/page.aspx'><article>{TEN}</article></form><footer>End</footer></body>", [LONG] * 10),
    (f"<body><article>{TEN}</article><form><p>Your name, please</p></form></body>", [LONG] * 10),
    (f"<body><article>{TEN}</article><h2>References</h2><ol><li><a href=1>One, a book</a></li><li><a href=2>Two</a></li></ol>"
     "<ul><li><a href=x>menu</a></li></ul></body>", [*[LONG] * 10, "References", "One, a book", "Two"]),
    (f"<body><div>{TEN}</div><div><h2>End</h2><p>A short last section.</p></div></body>",
     [*[LONG] * 10, "End", "A short last section."]),
    (f"<body><div>{TEN}</div><div>Between.</div><div>{TEN}</div></body>", [*[LONG] * 10, "Between.", *[LONG] * 10]),
    (f'<body><article>{TEN}</article><ol class="commentlist"><li>I, for one, do, not, agree.</li></ol></body>', [LONG] * 10),
    (f'<body><article>{TEN}</article><div id="discussion"><article>I, for one, do, not, agree.</article></div></body>',
     [LONG] * 10),
    (f'<body><article>{TEN}</article><div class="user-feedback"><p>{LONG}</p></div></body>', [LONG] * 10),
    (f'<article>{TEN}<section id="discussion"><h2>Discussion</h2><p>{LONG}</p></section></article>',
     [*[LONG] * 10, "Discussion", LONG]),
    (f'<body><div class="main-nav"><p>{LONG}</p></div><div class="post-content">{TEN}</div><div class="related-posts">'
     f'<p>{LONG}</p></div><div class="cookie-banner">{LONG}</div></body>', [LONG] * 10),
])
def test_whole_articles_of_other_templates(page, text):
    assert html.extract(page) == "\n\n".join(text)


def test_long_comments_do_not_replace_the_article():
    page = f"<body><div>{TEN}</div><div class=comments>{TEN * 9}</div></body>"
    assert html.extract(page) == "\n\n".join([LONG] * 10)


def test_quotes_without_end_take_linear_time():
    began = time.time()
    for page in ("<a b='>' " * 50_000, "<a b=\"x>" * 50_001, "<p class=ad>x" * 30_000, "<a b='" + "x > " * 200_000 + "'>y"):
        html.extract(page)
    assert time.time() - began < 30


def test_bad_markup_takes_linear_time():
    began = time.time()
    for page in ("<div>x" * 30_000, "<p><b>x" * 30_000 + "</i>" * 30_000, "<a title=\"x>" * 30_000, "<a " * 100_000,
                 "<!-- " * 50_000, "<p a='" + "x" * 500_000, "<td>" * 50_000):
        html.extract(page)
    assert time.time() - began < 60


def test_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html.extract_pages(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split())
                  for x in re.split(r"</?(?:p|h1)>", article)]
        text = "\n\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (text, len(text), p.url)


def test_awkward_rows(awkward, empty):
    rows = html.extract_pages(awkward, "text", "doc_id", "source").collect()
    assert len(rows) == awkward.count() and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.doc_id in (2, 3, 4)} == {""}
    assert html.extract_pages(empty, "text", "doc_id", "source").count() == 0
