"""Main text of pages: markup cases, repeated strings against sets, both ways of looking up."""

import html
import random
import re

import numpy as np
import pytest

from seriesflow.llm import page_text
from seriesflow.llm.page_text import NEIGHBOURS, WINDOW

PROSE = "One day the harbour master counted all boats and wrote a long list of their names"
MENU = "<div><a href='/a'>Home</a> <span>Weather Sport Money Travel Health Science Culture Letters</span></div>"


def text_of(source, covered=None):
    page = page_text.Reader().read(source)
    marks = np.zeros(len(page.tokens), bool) if covered is None else covered
    return page_text.main_text(page, marks)


@pytest.mark.parametrize("source, expected", [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a<p>b<br>c<b>d</b>e<p> </p>", "a\n\nb cde"),
    ("<title>t</title><style>p{}</style><script>var t='</p>';</script><p>x &amp; y &lt;b&gt; &amp &am &#233;&nbsp;z", "x & y <b> & &am é z"),
    ("<nav>n</nav><header>h</header><article><header><h1>T</h1></header><p>b</p><footer>f</footer></article><footer>g", "T\n\nb"),
    ("<div>outside</div><article><p>in<div class='ad'>buy</div><p>more</article><p>after", "in\n\nmore"),
    ("<article><p>in</p><div id=comments><article><p>me too</p></article></div></article>", "in"),
    ("<body class='has-sidebar'><div class='with-sidebar'><p>kept</p></div><div class='left-sidebar'>x</div>", "kept"),
    ("<form id=page><input name=q><main><p>kept</p></main><p>gone</p></form>", "kept"),
    ("<p>a <span class=advert>buy <span>now</span></span> b</p>", "a\n\nb"),
    ("<p>one <!-- <p>two --> three <!-- open", "one three"),
    ("<p title=\"a > b\">q</p><p title='x>r</p>", "q\n\nr"),
    ("<ul><li>one<li class=promo>two<li>three</ul>", "one\n\nthree"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"),
    ("<head><meta charset=x><p>no end of head", "no end of head"),
    ("<ul><li><a href=x>only links</a></ul><p>prose with one <a href=y>link</a>", "prose with one link"),
    ("<article><p>1 < 2 and 3 <</p></article>", "1 < 2 and 3 <"),
    ("<ARTICLE><P>Upper</P></ARTICLE><script>never ends <p>x", "Upper"),
    ("<article><p>kept</p></article><p>cut <b", "kept"),
])
def test_markup(source, expected):
    assert text_of(source) == expected


def test_repeated_windows_equal_sets():
    rng = random.Random(5)
    common = [[rng.choice("abcdefgh") for _ in range(rng.randint(3, 30))] for _ in range(12)]
    streams, hosts, contents = [], [], []
    for i in range(120):
        streams.append([t for _ in range(rng.randrange(4)) for t in
                        (rng.choice(common) if rng.random() < 0.6 else [str(rng.random()) for _ in range(9)])])
        hosts.append(rng.choice(["x", "y", "z"]))
        contents.append(rng.choice([i, i, 7]))
    value, low, high = page_text.repeats_in(streams, hosts, np.array(contents, np.int64))
    order = np.argsort(page_text._signed(value))
    known = page_text._signed(value)[order][(low != high)[order]]
    marks = page_text.cover(streams, hosts, lambda v, _: page_text.is_in(known, page_text._signed(v)))

    def pages_with(host, run):
        return {c for s, h, c in zip(streams, hosts, contents) if h == host
                and any(s[k:k + len(run)] == run for k in range(len(s) - len(run) + 1))}

    long = WINDOW + NEIGHBOURS - 1
    for stream, host, mark in zip(streams, hosts, marks):
        for k in range(len(stream) - long + 1):  # strings of this length are covered but for their ends
            if len(pages_with(host, stream[k:k + long])) > 1:
                assert mark[k + NEIGHBOURS - 1:k + long - NEIGHBOURS + 1].all()
        for k in np.flatnonzero(mark):  # what is covered repeats, up to the end of its page
            runs = [stream[a:a + WINDOW] for a in range(max(0, k - WINDOW + 1), k + 1)]
            assert any(len(pages_with(host, run)) > 1 for run in runs)


def test_suffixes_are_sorted_by_their_tokens():
    tokens = np.random.default_rng(1).integers(0, 3, 500).astype(np.uint64)
    order, rank = page_text.suffix_array(tokens, 8)
    keys = [tuple(tokens[i:i + 8]) for i in range(500)]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(0, 500, 7) for j in range(500))


def unique(i):
    return " ".join(f"sail{i * 31 + k * k}" for k in range(20))


def page_rows():
    rows = [(i, f"https://one.example/{i}", f"{MENU}<div><p>{unique(i)}</p></div>"
             f"<div>All rights of this imaginary harbour company are kept by its one owner, thank you</div>")
            for i in range(30)]
    rows += [(40, "https://two.example/a", f"{MENU}<p>{PROSE}</p>")] * 3  # copies of a page are one page
    rows += [(50, None, None), (None, "", ""), (51, "no address", "<p>x</p>"), (None, None, "<p>" + "long text " * 50_000)]
    return rows


@pytest.mark.parametrize("known", [10**6, 0])
def test_unique_runs_stay(spark, known):
    pages = spark.createDataFrame(page_rows(), "page_id bigint, url string, html string").repartition(5)
    rows = page_text.extract(pages, ["page_id", "url"], known=known).collect()
    found = {r.page_id: r.text for r in rows if r.page_id is not None}
    assert len(rows) == len(page_rows())
    assert all(found[i] == unique(i) for i in range(30))
    assert found[40].endswith(PROSE) and found[40].startswith("Home")  # no other page has its strings
    assert found[50] == "" and found[51] == "x"
    assert sorted(r.n_chars for r in rows if r.page_id is None) == [0, 10 * 50_000 - 1]


NOTICE = "Readers of this harbour page get every new story by letter if they leave an address at the desk"


def article_rows():
    """Articles with a notice that no markup tells, with a quote, with and without near copies."""
    quote = f"<p>{PROSE}</p>"

    def article(i, more=""):
        return f"<article><h1>{unique(1000 + i)}</h1><p>{unique(i)}</p>{more}<div>{NOTICE}</div><p>{unique(500 + i)}</p></article>"

    rows = [(i, f"https://one.example/{i}", MENU + article(i, quote if i % 3 == 0 else "")) for i in range(30)]
    rows += [(i, f"https://one.example/{i}", "<p>no article here</p>") for i in range(30, 90)]
    # every article of the host is the same but for a few words: all of it stays
    rows += [(i, f"https://copies.example/{i}", f"<article><p>{unique(1)}</p><p>{unique(i)}</p><p>{unique(3)}</p><p>{unique(4)}</p></article>")
             for i in range(100, 120)]
    # copies of two articles are two kinds, whatever their number
    rows += [(i, f"https://two.example/{i}", article(i % 2)) for i in range(200, 230)]
    # what the articles of some pages say, others have outside of them
    rows += [(i, f"https://mixed.example/{i}", f"<p>{PROSE}</p>" if i == 300 else f"<article><p>{unique(i)}</p><p>{PROSE}</p><p>{unique(i + 50)}</p></article>")
             for i in range(300, 304)]
    return rows


@pytest.mark.parametrize("known", [10**6, 0])
def test_strings_of_most_articles_of_a_host_are_notices(spark, known):
    pages = spark.createDataFrame(article_rows(), "page_id bigint, url string, html string").repartition(5)
    found = {r.page_id: r.text.split("\n\n") for r in page_text.extract(pages, ["page_id"], known=known).collect()}
    for i in range(30):
        assert found[i] == [unique(1000 + i), unique(i), *([PROSE] if i % 3 == 0 else []), unique(500 + i)]
    assert all(found[i] == [unique(1), unique(i), unique(3), unique(4)] for i in range(100, 120))
    assert all(found[i] == [unique(1000 + i % 2), unique(i % 2), NOTICE, unique(500 + i % 2)] for i in range(200, 230))
    assert found[300] == [PROSE] and found[301] == [unique(301), PROSE, unique(351)]


def test_pages_of_a_window_are_counted_once():
    streams = [["a"] * 20, ["a"] * 9 + ["b"] * 9, ["c"] * 10, []]
    value, page, n, bits = page_text.spread_in(streams, ["h"] * 4, np.array([1, 1, 66, 3], np.int64))
    assert list(page) == sorted(page) and len(set(value)) == len(value)
    assert n.max() == 2 and set(bits[n == 2]) == {2} and set(bits[page == 2]) == {4}
    assert all(len(part) == 0 for part in page_text.spread_in([], [], np.array([], np.int64)))


def test_other_columns_and_empty_tables(spark):
    columns = "page_id bigint, url string, html string, text string, window string, row_ string"
    pages = spark.createDataFrame([(1, "http://h/", "<p>a b</p>", "t", "w", "r")] * 2, columns)
    for known in (10, -1):
        rows = page_text.extract(pages, [c for c in pages.columns if c != "row_"], known=known).collect()
        assert [(r.page_id, r.window, r.text, r.n_chars) for r in rows] == [(1, "w", "a b", 3)] * 2
    assert page_text.extract(spark.createDataFrame([], columns), ["page_id"]).count() == 0


def test_pages_of_the_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = page_text.extract(pages, ["page_id", "html"]).collect()
    assert len(rows) == pages.count()
    for r in rows:
        article = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)
