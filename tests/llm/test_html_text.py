"""Main text: the article alone, on marked and unmarked pages, and on broken ones."""

import re

import pytest

from tillstream.llm import html_text
from tillstream.llm.queries import QUERIES

WORDS = "some words that make up a sentence of the article which goes on for a while"
JUNK = [
    '<nav><ul><li><a href="/x">Home</a></li><li><a>News</a></li></ul></nav>', '<header><h2>Site name</h2></header>', "<footer>&copy; 2020 someone</footer>",
    '<div class="ad">Buy this now and be happy with it</div>', '<aside><p>Most read stories of the week here</p></aside>', '<form><label>Mail</label><input name="m"><button>Go</button></form>',
    '<div id="cookie-notice"><p>We use cookies on this site, accept them</p></div>', "<script>var a = '<p>no text</p>';</script>", "<style>p{margin:0}</style>",
    '<section class="post-comments"><h3>Comments</h3><p>I like this article a lot, thanks for it</p></section>', '<div class="siteSidebar"><p>Weather and more of that kind</p></div>',
    '<div role="navigation"><a>one</a> <a>two</a></div>', "<!-- <p>not shown</p> -->", '<div style="display: none"><p>unseen words</p></div>', '<p class="notice">Subscribe to read more of this</p>',
]


@pytest.fixture(scope="module")
def weights(spark):
    return html_text.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def page(body, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>A title</title></head><body>{before}{body}{after}</body></html>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<div><div>{}</div></div>", "{}"])
def test_article_alone(weights, wrap):
    junk, within = "".join(JUNK), "".join(j for j in JUNK if not j.startswith("<header>"))  # an article's own header is part of it
    article = f"<h1>The head &amp; line</h1><p>First {WORDS}.</p>{JUNK[3]}<p>Second <b>bold</b>er {WORDS}<br>and  more.</p>{within}<ul><li>item one</li><li>item two</li></ul><p>Last &#233;nd {WORDS}."
    found = html_text.main_text(page(wrap.format(article), junk, junk), weights)
    assert found == "\n".join(["The head & line", f"First {WORDS}.", f"Second bolder {WORDS} and more.", "item one", "item two", f"Last énd {WORDS}."])


def test_unmarked_page_of_links_and_text(weights):
    links = "".join(f'<div><a href="/{k}">Link number {k}</a></div>' for k in range(30))
    body = "".join(f"<p>{WORDS} {k}.</p>" for k in range(6))
    assert html_text.main_text(page(body, links, links), weights) == "\n".join(f"{WORDS} {k}." for k in range(6))


SENTENCE = f"<p>{WORDS}.</p>"


@pytest.mark.parametrize(("body", "lines"), [
    (f"<article><h1>T</h1><table><tr><td>a</td><td>b</td></tr></table>{SENTENCE}</article>", ["T", "a", "b", f"{WORDS}."]),
    (f"<article>{SENTENCE}<blockquote>Said</blockquote></article>", [f"{WORDS}.", "Said"]),
    (f"<article>{SENTENCE}<figure><img src=x><figcaption>Seen</figcaption></figure></article>", [f"{WORDS}.", "Seen"]),
    (f'<article>{SENTENCE}<ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></article>', [f"{WORDS}.", "One", "Two"]),
    (f'<article><a href="/x"><p>{WORDS}</p></a></article>', [WORDS]),
    (f'<div class="share-prices-article">{SENTENCE}</div>', [f"{WORDS}."]),
    (f'<article>{SENTENCE}<h2 id="share-prices">Prices</h2>{SENTENCE}</article>', [f"{WORDS}.", "Prices", f"{WORDS}."]),
    (f'<article>{SENTENCE}<h2 id="privacy">Privacy</h2><section id="related-work">{SENTENCE}</section><p id="warning-signs">Signs</p></article>',
     [f"{WORDS}.", "Privacy", f"{WORDS}.", "Signs"]),
    (f'<article>{SENTENCE}<section id="comments"><p>kept, a place in the text</p></section><div id="comments"><p>gone</p></div></article>', [f"{WORDS}.", "kept, a place in the text"]),
    ("<table><tr><td>a</td><td>b</td></tr></table>", ["a", "b"]),
    (f"<div><h1>T</h1>{SENTENCE}<table><tr><td>a</td><td>b</td></tr></table></div>", ["T", f"{WORDS}.", "a", "b"]),
    (f"<main><article>{SENTENCE}</article><article class=comment><p>gone</p></article><p>further</p></main>", [f"{WORDS}."]),
    (f"<main><article><h2>A</h2><p>{WORDS}</p></article><article><h2>B</h2><p>{WORDS}</p></article></main>", ["A", WORDS, "B", WORDS]),
    (f"<article>{SENTENCE}<p>One <a href=x>link</a> in <i>it</i>, no more</p></article>", [f"{WORDS}.", "One link in it, no more"]),
])
def test_whole_articles(weights, body, lines):
    """Nothing of an article is cut but what is known to be no part of it."""
    links = "".join(f'<div><a href="/{k}">Link number {k}</a></div>' for k in range(9))
    for before in ("", JUNK[0], links):
        assert html_text.main_text(page(body, before, before + JUNK[9]), weights) == "\n".join(lines)


def test_broken_markup(weights):
    assert html_text.main_text(f"<article><p><b>One {WORDS}<p>Two {WORDS}<div>three a<", weights) == f"One {WORDS}\nTwo {WORDS}\nthree a<"
    assert html_text.main_text(f"<article><p>a < b &am {WORDS}</p><script>never closed <p>x</p>", weights) == f"a < b &am {WORDS}"
    assert html_text.main_text(f"just {WORDS}", weights) == f"just {WORDS}"
    assert html_text.main_text('<p title="a > b">x</p>' + f"<p>{WORDS}</p>", weights) == f"x\n{WORDS}"
    assert html_text.main_text(None, weights) == html_text.main_text("", weights) == html_text.main_text("<nav>a b</nav>", weights) == ""
    assert len(html_text.main_text("<article>" + f"<p>{WORDS}</p>" * 20_000, weights).split("\n")) == 20_000


def test_scan_finds_the_best_stretch(weights):
    found = html_text.tokens(page(f"<p>{WORDS}</p><p>{WORDS}</p>", '<div><a href="">a b c</a></div>' * 5))
    own = {html_text.feature(t, 0): 0.0 for t in found}
    own |= {k: 1.0 if " p" in k else -1.0 for k in own}
    seen = [0 if t.junk or (t.name is None and not t.words) else own[html_text.feature(t, 0)] * max(1, t.words) for t in found]
    begin, end = html_text.region(found, own)
    best = max(sum(seen[a:b]) for a in range(len(seen)) for b in range(a, len(seen) + 1))
    assert sum(seen[begin:end]) == pytest.approx(best)


def test_tables(spark, weights):
    rows = [(1, None, None), (1, "u", ""), (None, "u", f"<p>{WORDS}</p>"), (4, "u", f"<article><p>{WORDS} é</p></article>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in html_text.extract(pages, weights).collect()), key=repr)
    assert found == sorted([(1, None, "", 0), (1, "u", "", 0), (None, "u", WORDS, len(WORDS)), (4, "u", f"{WORDS} é", len(WORDS) + 2)], key=repr)
    empty = pages.where("false")
    assert html_text.extract(empty, html_text.train(empty)).count() == 0


def test_all_pages_of_the_table(spark, sf):
    """These pages have one form, so a pattern gives their articles."""
    import html

    for r in QUERIES["op10_html_text"](spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").drop("url"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part.replace("<br>", " "))).split()) for part in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(line for line in lines if line)
