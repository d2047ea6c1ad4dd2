"""Extraction on hand-made pages, the scan against all segments, whole tables against marked articles."""

import html
import re
import time
from itertools import combinations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from posefold.llm.html_text import best_region, counts, extract_text, main_text, read, weights

WORDS = "word:flow word:link word:footer word:hinted word:nav".split()
WEIGHT = weights({"word:flow": 5000, "tag:p": 300, "tag:/p": 300, "tag:br": 90, "tag:b": 40},
                 {"word:footer": 200, "word:hinted": 300, "word:nav": 200, "tag:a": 90, "tag:/a": 90, "tag:div": 60, "tag:li": 90})
LONG = "One sentence of plain words that goes on for a while."


@given(st.lists(st.integers(-5, 5), max_size=25))
def test_scan_finds_the_best_segment(scores):
    begin, end = best_region([float(s) for s in scores])
    best = max([0, *(sum(scores[i:j]) for i, j in combinations(range(len(scores) + 1), 2))])
    assert sum(scores[begin:end]) == best


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("plain words only", "plain words only"),
        (f"<nav><a>x y</a></nav><article><h1>T</h1><p>{LONG}<p>B &amp; C</article><footer>f f f f f</footer>", f"T\n{LONG}\nB & C"),
        (f"<body><div class='ad box'>buy now buy now</div><div><p>{LONG}</p><ul><li>a b</li><li>c d</li></ul><p>{LONG}</p></div></body>", f"{LONG}\na b\nc d\n{LONG}"),
        (f"<p>{LONG} <aside>side words here</aside>rest of it", f"{LONG}\nrest of it"),
        (f"<article><p>{LONG}</p><div id=comments>first! second!</div></article>", LONG),
        (f"<script>var a='</p>words words'</script><style>p{{}}</style><p>{LONG}<!-- gone -->", LONG),
        (f"<p>{LONG} <a href='x>y'>a link</a></p>", f"{LONG} a link"),
        (f"<p>a &lt;b&gt; 3 < 4 &#233;&nbsp;x\n\t y {LONG}", f"a <b> 3 < 4 é x y {LONG}"),
        (f"<p>{LONG}<br>next<form>name <input> send</form><p>end words", f"{LONG}\nnext\nend words"),
        (f"<p>{LONG}<script>never closed", LONG),
        (f"</div></p></a><p>{LONG}</article>", LONG),
    ],
)
def test_pages(page, want):
    assert main_text(page, WEIGHT) == want


@given(st.text(alphabet="<>/ab p=\"'!-&;\n", max_size=200))
def test_any_text_is_read(page):
    main_text(page, WEIGHT)
    assert all(p.times >= 0 for p in read(page)) and all(n > 0 for n in counts(page).values())


def truth(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
    return "\n".join(filter(None, blocks))


def test_whole_table_gives_the_articles(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op6_html_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == truth(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</article>", 1), (1, "u", None, 2), (None, None, "", 3), (3, "v", "<p>" + "w " * 50_000, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(extract_text(pages).collect(), key=lambda r: r.n_chars)
    assert [(r.page_id, r.n_chars) for r in got[2:]] == [(1, len(LONG)), (3, 99_999)]
    assert [r.text for r in got[:2]] == ["", ""]
    assert extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "inner,want",
    [
        ('<h2 id="related-work">Related work</h2>', "Related work"),
        ('<h2 id="comments">Comments</h2>', "Comments"),
        ('<p id="social-history">He smokes.</p>', "He smokes."),
        ('<p class="share-price">Up.</p>', "Up."),
        ('<section id="alert-levels"><p>Red.</p></section>', "Red."),
        ('<p data-id="share">Kept.</p>', "Kept."),
        ('<div class="box ad">Buy.</div>', ""),
        ("<ul><li>one<li class=ad>two<li>three</ul>", "one\nthree"),
        ("<ul><li class=ad>two<ul><li>in it</ul>still<li>three</ul>", "three"),
        ("<dl><dt class=ad>two<dd>three</dl>", "three"),
        ("<table><tr><td class=ad>two<td>three<tr class=ad><td>four<tr><td>five</table>", "three\nfive"),
    ],
)
def test_content_is_dropped_by_whole_names_only(inner, want):
    page = f"<article><p>{LONG}</p>{inner}<p>{LONG}</p></article>"
    assert main_text(page, WEIGHT) == "\n".join(filter(None, [LONG, want, LONG]))


AD = "<div class='ad'><a href=x>buy now</a> and again and again and again, much longer than what stands before or after it</div>"


@pytest.mark.parametrize("advert", [AD, AD.replace("div", "aside"), f"<nav>{AD * 3}</nav>"])
def test_an_advert_cuts_nothing_off_an_unmarked_page(advert):
    page = f"<body><h1>A title</h1>{advert}<p>{LONG}</p>{advert}<p>The end.</p></body>"
    assert main_text(page, WEIGHT) == f"A title\n{LONG}\nThe end."
    assert main_text(f"<body>{advert}<p>{LONG}</p>{advert}</body>", WEIGHT) == LONG


@pytest.mark.parametrize(
    "page",
    ["<a " * 300_000, '<a "' * 250_000, "<div>" * 100_000 + "</b>" * 100_000, "<div>" * 60_000 + "<li>x</li>" * 60_000, "<div>" * 60_000 + "</article>" * 60_000,
     "<script " * 100_000, "<!--" * 200_000, "<article>" * 60_000 + "<td>" * 60_000, "<" * 500_000],
)
def test_broken_pages_take_linear_time(page):
    begin = time.process_time()
    half = read(page[: len(page) // 2])
    middle = time.process_time()
    whole = read(page)
    assert len(whole) >= len(half) and time.process_time() - middle < 5 * (middle - begin) + 1


@pytest.mark.parametrize(
    "page,want",
    [("<p>a</p><script>if (a > b", "a"), ("<p>a</p><script>if (a > b) x", "a"), ("<p>a</p><!-- b > c", "a"), ("<p>a</p><!-- b", "a"), ("<p>a</p><!-- b --> c", "a c"),
     ("<p>a</p>b <p unfinished", "a b <p unfinished"), ("a < b", "a < b"), ("<p>a</p><script>x</script>b", "a b"), ("", "")],
)
def test_what_follows_the_last_tag(page, want):
    assert " ".join("".join(p.text or " " for p in read(page)).split()) == want
