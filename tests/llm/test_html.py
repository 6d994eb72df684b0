import random

import numpy as np
import pytest
from helpers import rows

from ledgerloom.llm import html_extract
from ledgerloom.llm.html_extract import extract, main_text, smooth, threshold

MENU = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu {i}</a></li>" for i in range(8)) + "</ul></nav>"
PAGE = ("<!DOCTYPE html><html><head><title>Head</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header><h2>Site name of some length</h2></header>" + MENU + "<div class='ad-banner'>Buy this now, please</div>"
        "<div class='cookie-notice'>We use cookies on this site for many good reasons</div>{body}"
        "<aside class=x>Read our other stories too</aside><section id='comments'><p>A reader says a long thing that "
        "goes on and on for many words</p></section><form>Name <input> <button>Send</button></form>"
        "<footer>&copy; someone</footer></body></html>")
TEXT = "<h1>A  title &amp;amp; more</h1>\n<p>First\tparagraph with <b>bold</b> words and enough of them.</p><p>Be.</p>" \
       "<p>Third one, closing<br>here.<p>Unclosed <i>tail"
WANT = "A title &amp; more First paragraph with bold words and enough of them. Be. Third one, closing here. Unclosed tail"


@pytest.mark.parametrize("tag", ["article", "main", "div class='post'", "section"])
def test_article_without_boilerplate(tag):
    name = tag.split()[0]
    assert main_text(PAGE.replace("{body}", f"<{tag}>{TEXT}</{name}>")) == WANT


def test_truncated_page():
    page = PAGE.replace("{body}", f"<article>{TEXT}")
    assert main_text(page[:page.index("tail") + 4]) == WANT


def test_nested_parts_of_an_article():
    body = "<article><p>Some words of the article that are long enough.</p><aside>Aside text</aside>" \
           "<div class='share'>Share this</div><ul><li>point one</li><li>point two</li></ul></article>"
    assert main_text(PAGE.replace("{body}", body)) == "Some words of the article that are long enough. point one point two"


def test_odd_html():
    assert main_text("") == "" and main_text("plain text  only") == "plain text only"
    assert main_text("<p></p>") == "" and main_text("</div></p>x<<") .startswith("x")
    assert main_text("<article>" + "<p>word word word</p>" * 20_000 + "</article>").count("word") == 60_000
    assert main_text("<div>" * 3000 + "deep text" + "</div>" * 3000) == "deep text"


def test_smoothing_and_threshold():
    assert smooth([5.0] * 4) == pytest.approx([5.0] * 4)
    assert 1 < threshold([0.0, 0.1, 0.0, 9.0, 10.0]) < 9 and threshold([3.0, 3.0]) == 3.0


def test_extract(spark):
    data = [(1, "u", PAGE.replace("{body}", f"<article>{TEXT}</article>"), "x"), (None, None, None, "x"),
            (2, "v", "", "x"), (2, "v", "", "x"), (3, "w", "é漢\U0001f600", "x")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract(df).collect()), key=repr)
    want = [(1, "u", WANT, len(WANT)), (None, None, "", 0), (2, "v", "", 0), (2, "v", "", 0), (3, "w", "é漢\U0001f600", 3)]
    assert got == sorted(want, key=repr)
    assert extract(df.limit(0)).count() == 0


def test_teaser_is_not_the_content():
    """The region of the dense text decides; an article that holds none of it does not."""
    long = "One sentence of the main text that is long enough to read. " * 5
    assert main_text(f"<body><article><p>short teaser</p></article><div>{long}</div></body>") == long.strip()
    two = f"<article><h2>A</h2><p>{long}</p></article><article><h2>B</h2><p>{long}</p></article>"
    assert main_text(f"<body>{MENU}<div id=x>{two}</div></body>") == f"A {long.strip()} B {long.strip()}"


def test_short_blocks_between_long_ones_stay():
    long = "This block of the text is a long one, with some more words in it."
    for tag in ("div", "p", "td", "section"):
        body = f"<{tag}>{long}</{tag}><{tag}>Be.</{tag}><{tag}>{long}</{tag}>"
        outer = f"<table><tr>{body}</tr></table>" if tag == "td" else body
        assert main_text(f"<body>{MENU}<div class=post>{outer}</div></body>") == f"{long} Be. {long}"


def test_threshold_decides():
    a, b = "a text of some length " * 12, "b text of few words"
    page = f"<body><div><div>{a}</div><div>{a}</div></div><div>{f'<p>{b}</p>' * 10}</div></body>"
    dense, all_ = main_text(page, 60.0), main_text(page, 0.0)
    assert "b text" not in dense and dense.count("a text") == 24 and all_.count("b text") == 10
    assert main_text(page) == dense


def test_names_are_a_prior():
    """A page inside a container with a telling name keeps its text; a menu of links loses to any text."""
    page = PAGE.replace("{body}", f"<article>{TEXT}</article>")
    wrapped = page.replace("<body>", "<body><div class='widget'>").replace("</body>", "</div></body>")
    assert WANT in main_text(wrapped)
    assert main_text(f"<body>{MENU}<div>Hi there.</div></body>") == "Hi there."


def test_linear_in_open_tags():
    import time

    took = []
    for n in (10_000, 100_000):
        start = time.perf_counter()
        assert main_text("<div><b>x</b>" * n).count("x") == n
        took.append(time.perf_counter() - start)
    assert took[1] < 40 * took[0]


def brute_text(html):
    """The scoring again over a tree, with plain definitions: every region's share counted on its own."""
    parser = html_extract.Lines()
    parser.feed(html)
    parser.close()

    def around(i):
        out = [i]
        while i:
            i = parser.regions[i][1]
            out.append(i)
        return out

    lines = [(x, x.text, around(x.region)) for x in parser.lines if x.text]
    ratio = [(len(t) - x.link_chars if len(t) > x.link_chars else 0) / x.tags * (0.01 if x.asides else 1) for x, t, _ in lines]
    if not sum(ratio):
        ratio = [len(t) / x.tags * (0.01 if x.asides else 1) for x, t, _ in lines]
    if not sum(ratio):
        return ""
    kernel = {d: np.exp(-d * d / 2) for d in range(-3, 4)}
    level = [sum(ratio[i + d] * k for d, k in kernel.items() if 0 <= i + d < len(ratio))
             / sum(k for d, k in kernel.items() if 0 <= i + d < len(ratio)) for i in range(len(ratio))]
    cut = threshold(level)
    dense = [(len(t), up) for (_, t, up), v, r in zip(lines, level, ratio, strict=True) if r and v >= cut - 1e-9]
    total = sum(n for n, _ in dense)
    holding = [i for i in range(len(parser.regions)) if sum(n for n, up in dense if i in up) >= 0.8 * total]
    top = max(holding, key=lambda i: len(around(i)))
    top = next((i for i in around(top) if parser.regions[i][0] in ("article", "main")), top)
    return " ".join(t for (x, t, up), r in zip(lines, ratio, strict=True)
                    if top in up and (x.asides <= parser.regions[top][2] or r >= cut - 1e-9))


def test_matches_brute_force(spark):
    pages = rows("pages")
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(
        [(p["page_id"], p["url"], p["html"]) for p in pages], "page_id long, url string, html string")).collect()}
    assert got == {p["page_id"]: brute_text(p["html"] or "") for p in pages}
    rnd = random.Random(3)
    for _ in range(300):
        page = "".join(rnd.choice(["<div>", "</div>", "<article>", "</article>", "<p>", "<div class=ad>", "<section>", "<nav>",
                                   "</nav>", "</section>", "<a href=x>link</a>", "a few words ", "many more words " * 9, "<br>"])
                       for _ in range(rnd.randrange(40)))
        assert main_text(page) == brute_text(page), page
