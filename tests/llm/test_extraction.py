"""Main text of pages: given pages against a plain reading of their article, made pages of other shapes, odd rows."""

import html
import re

import pytest

from barloom.llm import extraction

PROSE = ["The river rose in the night and by morning the lower road was under water.", "Nobody had expected it, least of all the people of the mill, who had slept through it all.", "By noon the ferry was running again &amp; the market opened late."]
WANT = "\n".join(html.unescape(p) for p in PROSE)
P = "".join(f"<p>{p}</p>" for p in PROSE)
MENU = "<nav><ul>" + "".join(f'<li><a href="/{k}">Menu {k}</a></li>' for k in range(8)) + "</ul></nav>"
HEAD = "<!DOCTYPE html><html><head><title>A title</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body>"
SHAPES = {
    "article": (f"{HEAD}{MENU}<article><h1>High water</h1>{P}</article><footer>&copy; us</footer></body></html>", f"High water\n{WANT}"),
    "main": (f'{HEAD}<header class="top">Site name</header>{MENU}<main>{P}<form>Your name <input><button>Send</button></form></main><aside>More to read here today</aside>', WANT),
    "divs": (f'{HEAD}<div id="navbar">Home News Sport Weather</div><div class="content">{P}</div><div class="siteFooter footer">Terms and conditions apply to all of this</div>', WANT),
    "inside": (f'<body><article>{P[: P.index("<p>By")]}<div class="ad-box"><p>Buy now!</p></div><aside>Aside</aside>{P[P.index("<p>By") :]}<section id="comments"><p>I was there, too, and it was nothing like that at all!</p></section></article>', WANT),
    "notice": (f'<body><div class="cookie-notice">We use cookies to make this site better for all of our readers. <a href="#">Accept</a></div><div class="has-sidebar">{P}</div><div id="sidebar"><ul><li><a>One</a><li><a>Two</a></ul></div>', WANT),
    "upper": (f"<BODY><NAV><A HREF=/>Home</A></NAV><ARTICLE>{P.upper().replace('&AMP;', '&amp;')}</ARTICLE>", WANT.upper()),
    "cut": (f"{HEAD}{MENU}<article>{P[:-4]} <a href=", WANT),
    "comment": (f"<body><!-- <p>not this</p> --><article>{P}<!-- cut", WANT),
    "script": (f"<body><article>{P}<script>if (a < b) document.write('</p><p>x')</script><noscript>Turn it on</noscript></article>", WANT),
    "inline": ("<body><article><p>One <b>bold</b>\n\t  and&nbsp;<i>sla</i>nted<br>line, 3 &lt; 4 &#233; &eacute; a < b</p><ul><li>first<li>second <a href=x>link</a></ul><blockquote>said</blockquote></article>", "One bold and slanted line, 3 < 4 é é a < b\nfirst\nsecond link\nsaid"),
    "no markup": ("just  some\nwords", "just some words"),
    "open advert": (f'<body><div class="ad">Buy this<article>{P}</article><footer>end</footer>', WANT),
    "list page": (f"<body><article>{P}<ol><li>{PROSE[0]}</li><li>{PROSE[1]}</li></ol></article>", f"{WANT}\n{PROSE[0]}\n{PROSE[1]}"),
    "all beside": (f'<body><div class="widget">{P}</div>', WANT),
    "only menu": (f"<body>{MENU}<footer>end</footer>", ""),
    "empty": ("", ""),
    "null": (None, ""),
}


def plain(page):
    """The blocks of the one article of a page of the tables."""
    inside = page.split("<article>")[1].split("</article>")[0]
    blocks = re.split(r"</?p>|</?h1>|<br>", inside.replace("<b>", "").replace("</b>", ""))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


@pytest.fixture(scope="module")
def weights(spark):
    return extraction.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(weights, shape):
    page, want = SHAPES[shape]
    assert extraction.main_text(page, weights) == want
    assert extraction.main_text(page, extraction.Weights({}, 2.0)) == want  # without any labelled page


def test_given_pages(spark, weights):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extraction.extract(pages, weights).collect()}
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}
    # the same pages, their articles hidden behind plain elements: learned weights find the region
    right = words = 0
    for r in pages.collect():
        mine = extraction.main_text(re.sub(r"(</?)article>", r"\1div>", r["html"]), weights).split()
        own = want[r["page_id"]].split()
        right += mine == own
        words += abs(len(mine) - len(own))
    assert right >= 0.95 * len(want) and words <= 0.01 * sum(len(t.split()) for t in want.values())


def test_region_is_the_best_run():
    w = extraction.Weights({}, 1.0)
    found = extraction.tokens(f"<div>one two</div>{MENU}<div>{P}</div><hr><hr><p>tail words here</p>", hints=False)
    scores = [w.of(t) for t in found]
    start, stop = extraction.region(found, w)
    best = max(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))
    assert abs(sum(scores[start:stop]) - best) < 1e-9
    assert extraction.region([], w) == (0, 0)


def test_odd_rows(spark, weights):
    rows = [(1, SHAPES["article"][0], "x", 5), (1, SHAPES["article"][0], "x", 5), (None, None, None, None), (2, "", "", 0), (3, "<p>" + "word " * 200_000 + "</p>" + "<a><b>" * 20_000, "", 1)]
    pages = spark.createDataFrame(rows, "page_id int, html string, text string, n_chars int")
    got = extraction.extract(pages, weights)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in got.collect()) == [0, 0, *[len(SHAPES["article"][1])] * 2, 999_999]
    assert extraction.extract(pages.limit(0), extraction.fit(pages.limit(0))).count() == 0
    other = extraction.extract(pages.selectExpr("html AS text", "page_id"), weights, "text")
    assert other.columns == ["page_id", "text", "n_chars"] and other.count() == 5
