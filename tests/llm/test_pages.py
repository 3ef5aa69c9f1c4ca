"""Main text of pages."""

import random
import re
import time
from html import unescape

import numpy as np
import pytest

from vitalgrid.llm import pages


def plain(html):
    """For the test table's pages: the blocks of the one article."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    blocks = [" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_real_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in pages.main_texts(table).collect()}
    for r in table.collect():
        assert got[r.page_id].text == plain(r.html)
        assert got[r.page_id].n_chars == len(plain(r.html)) and got[r.page_id].url == r.url


LONG = "This paragraph is long enough to make the sum of its window surge."


def test_without_marked_article():
    html = (
        "<body><div id='top-menu'><a href=/>Home</a> <a href=/x>News</a></div><ul><li><a href=1>One link</a><li><a href=2>Other link</a></ul>"
        "<div><a href=a>link</a></div><div><a href=a>link</a></div><div><a href=a>link</a></div>"
        f"<div class=story><h2>A title</h2><p>{LONG}<p>Short.<p>{LONG} <a href=z>linked words</a></div>"
        "<div><a href=a>link</a></div><div><a href=a>link</a></div><div><a href=a>link</a></div>"
        "<div>Terms apply</div></body>"
    )
    assert pages.main_text(html) == f"A title\n{LONG}\nShort.\n{LONG} linked words"


def test_parts_that_are_no_article():
    noise = [
        "<header><h1>Site</h1></header>", "<nav>menu</nav>", "<aside>more</aside>", "<form>name <input value=x><button>go</button></form>",
        "<div class='cookie-notice'>We use cookies.</div>", "<section id=comments><p>First!</p></section>", "<div role=banner>b</div>",
        "<div class='ad'>buy</div>", "<!-- <p>old</p> -->", "<script>var a = '<p>no</p>';</script>", "<style>p{}</style>", "<p hidden>h</p>",
        "<div style='display: none'>d</div>", "<noscript><p>turn on</p></noscript>", "<footer>&copy; all</footer>",
    ]
    body = "".join(noise) + "<main><article><header><h1>Ti&shy;tle &amp; &lt;b&gt;</h1></header>" + "".join(noise[1:]) + "<p>One<br>two\n three &eacute;&#8217;s</p>x<div>y<b>z</b></div></article></main>" + "".join(noise)
    assert pages.main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>") == "Ti\xadtle & <b>\nOne two three é’s\nx\nyz"


def test_odd_markup():
    assert pages.main_text("just text, no markup") == "just text, no markup"
    assert pages.main_text("<article><p>a<b>b<p>c</b>d</article><p>e") == "ab\ncd"
    assert pages.main_text("<article><p>a < b and 1 > 0</p><script>never closed <p>x") == "a < b and 1 > 0"
    assert pages.main_text("<article><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>") == "one\ntwo\n1\n2"
    assert pages.main_text("<p><a href=x>only</a></p>") == ""
    assert pages.main_text("<article title='a > b'>q</article>") == "q"


def test_nulls_empty_long_and_extra_columns(spark):
    schema = "TEXT string, html string, page_id int, url string, n_chars string"
    huge = "<article>" + "<p>word word</p>" * 30000 + "</article>"
    table = spark.createDataFrame([("a", None, 1, None, ""), ("b", "", 2, "u", ""), ("c", huge, None, "u", "")], schema)
    rows = {r.page_id: r for r in pages.main_texts(table).collect()}
    assert rows[1].text == rows[2].text == "" and rows[1].n_chars == 0
    assert rows[None].text == "\n".join(["word word"] * 30000)
    assert pages.extract(table).columns == ["html", "page_id", "url", "n_chars", "text"]
    assert pages.main_texts(table.limit(0)).count() == 0


LINKS = "".join(f"<li><a href={i}>Reference {i}</a>" for i in range(4))
REFERENCES = "\n".join(f"Reference {i}" for i in range(4))


def test_links_of_an_article_stay():
    html = f"<p>Out<article><ul>{LINKS}</ul><p>{LONG}<ul>{LINKS}</ul><p>Short.<ul>{LINKS}</ul></article>"
    assert pages.main_text(html) == f"{REFERENCES}\n{LONG}\n{REFERENCES}\nShort.\n{REFERENCES}"


def test_links_do_not_cut_text_in_two():
    html = f"<ul>{LINKS}</ul>" + f"<p>{LONG}" * 5 + f"<ul>{LINKS}</ul><p>{LONG}<ul>{LINKS}</ul>"
    assert pages.main_text(html) == "\n".join([LONG] * 5 + [REFERENCES, LONG])


FRAGMENTS = [
    "<section id='related-work'><p>{}</p></section>", "<p class='alert-threshold'>{}</p>", "<h2 id='search-strategy'>{}</h2>",
    "<section id='comments-on-method'><p>{}</p></section>", "<blockquote class='side note'>{}</blockquote>", "<p id='form-and-function'>{}</p>",
    "<p id='sharing'>{}</p>", "<p><math><mi>{}</mi></math></p>",
]


@pytest.mark.parametrize("fragment", FRAGMENTS)
def test_article_text_under_any_name_stays(fragment):
    html = f"<nav>menu</nav><article><p>{LONG}</p>{fragment.format('kept text')}<p>{LONG}</p></article><p>Out</p>"
    assert pages.main_text(html) == f"{LONG}\nkept text\n{LONG}"


def test_the_lines_outside_a_marked_article_part_it_and_are_not_kept():
    html = f"<p>Before<article><p>One</p></article><p>Between, and it is a long line of text that would surge</p><article><p>Two</article><p>After"
    assert pages.main_text(html) == "One\nTwo"


def test_without_its_marks_a_page_gives_the_same_text(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        plain_html = re.sub(r"(</?)(?:article|main)\b", r"\1div", r.html)
        assert pages.main_text(plain_html) == plain(r.html)


def brute_stretches(weight, surge):
    """From the definitions: a line lies in text if a window that holds it has weight;
    a run of such lines is text if one of its windows exceeds ``surge``."""
    n, w = len(weight), pages.WINDOW
    sums = [sum(weight[max(e - w + 1, 0) : e + 1]) for e in range(n)]  # windows that end at a line
    out, start = [], None
    for i in range(n + 1):
        alive = i < n and sums[i] > 0
        if alive and start is None:
            start = i
        if not alive and start is not None:
            if max(sums[start:i]) >= surge:
                last = max(k for k in range(start, i) if weight[k])
                out.append((start, last + 1))
            start = None
    return out


def test_window_sums_surge_and_dive():
    rng = random.Random(3)
    for _ in range(2000):
        weight = np.array([rng.choice([0, 0, 0, 1, 7, 30, 80]) for _ in range(rng.randrange(1, 40))], float)
        for surge in (1, 40):
            assert pages.stretches(weight, surge) == brute_stretches(weight.tolist(), surge)


@pytest.mark.parametrize(
    "piece", ["<a ", "<", "<a \"", "<a '\">", "</i>", "<div></i>", "<b>", "<b><p></p>", "<p><i>", "<!", "<!--", "<script>", "</script", "&amp", "<a href='>'", "\"'<a>", "<li>", "<a b=c d"]
)
def test_hostile_pages_take_linear_time(piece):
    for wrap in ("{}", "<script>{}", "{}>", "{}'>"):
        html = wrap.format(piece * 64_000)
        began = time.time()
        pages.main_text(html)
        assert time.time() - began < 2.5, wrap


def test_stray_tags_take_under_a_second():
    html = "<div>" * 64_000 + "</i>" * 64_000
    began = time.time()
    pages.main_text(html)
    assert time.time() - began < 1
