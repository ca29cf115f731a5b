import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from starmart.llm import pages


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(
            [(*row, "x", 1) for row in rows], "page_id long, url string, html string, text string, host int"
        )

    return make


def page(number, body, tail="</body></html>"):
    return (
        f'<!DOCTYPE html><html><head><title>T{number}</title><script>var a="</p>";x({number})</script></head>'
        f'<body><nav><ul><li><a href="/">Home page of us</a></li></ul></nav><!-- <p>no</p> -->{body}'
        f"<footer>&copy; all rights reserved by the owners of this site</footer>{tail}"
    )


@given(st.lists(st.lists(st.integers(0, 3), max_size=25), min_size=2, max_size=5), st.sampled_from([1, 2, 4]))
def test_covered_by_brute_force(streams, depth):
    expected = []
    for i, own in enumerate(streams):
        others = {
            tuple(s[k : k + depth])
            for j, s in enumerate(streams) if j != i
            for k in range(len(s) - depth + 1)
        }
        inside = [False] * len(own)
        for k in range(len(own) - depth + 1):
            if tuple(own[k : k + depth]) in others:
                inside[k : k + depth] = [True] * depth
        expected.append(inside)
    found = pages.covered([np.array(s, dtype=np.int64) for s in streams], depth)
    assert [run.tolist() for run in found] == expected


def test_blocks_of_broken_markup():
    html = '<p>One <b>two<br>three<p>Four &amp; &lt;five&#62;<li>six<li>seven<td title="a>b">eight<div'
    assert [" ".join(b.words) for b in pages.blocks(html)][:5] == [
        "One two three", "Four & <five>", "six", "seven", "eight",
    ]
    assert pages.blocks("") == [] and pages.blocks("<script>never closed <p>x</p>") == []


def test_articles_stay_whole(table):
    quoted = "<p>A passage that several pages of the host quote word by word.</p>"
    body = "<article><h1>Title {0}</h1><p>Own&nbsp;text  {0}\n here.</p>" + quoted + (
        '<aside>Read also</aside><section id="comments"><article class="comment">Nice!</article></section></article>'
        '<div class="cookie-notice">We use cookies</div><form>Search</form>'
    )
    rows = [(i, "http://a.example/x", page(i, body.format(i))) for i in range(4)]
    got = {r.page_id: r.text for r in pages.extract_main_text(table(rows)).collect()}
    said = "A passage that several pages of the host quote word by word."
    assert got == {i: f"Title {i}\nOwn text {i} here.\n{said}" for i in range(4)}


@pytest.mark.parametrize(
    "wrapper",
    [
        'class="with-sidebar"', "class=has-sidebar", 'class="page search-results"', "id='no-comments'",
        'class="entry share-enabled"', 'class="modal-open"', 'class="content related"', 'data-id="ad-12"',
        'title="x class=ad" class="widget"', 'class="" id="banner" role="search"',
    ],
)
def test_articles_stay_within_named_wrappers(table, wrapper):
    article = '<article><p>Own text.</p><p class="social-history">Their past.</p><p class="share">Share!</p></article>'
    menu = '<div class="sidebar-left"><p>Menu</p></div><div id="relatedPosts"><p>More</p></div>'
    html = f"<body>{menu}<div {wrapper}><div class='ad'>Buy</div>{article}</div>"
    row = pages.extract_main_text(table([(1, "http://w.example/", html)])).collect()[0]
    assert row.text == "Own text.\nTheir past."


def test_articles_beside_the_main_one_go(table):
    teaser = '<div class="related"><article><p>Teaser</p></article></div>'
    reader = '<div id="comments"><article><p>Nice!</p></article></div>'
    rows = [(1, "http://v.example/", f"<article><p>Own text.</p>{teaser}</article>{teaser}{reader}")]
    rows += [(2, "http://u.example/", f"<div class='pager'><main><p>Own text.</p></main></div>{reader}")]
    rows += [(3, "http://t.example/", f"<div><p>Own text.</p></div>{reader}")]
    got = {r.page_id: r.text for r in pages.extract_main_text(table(rows)).collect()}
    assert got == {i: "Own text." for i in (1, 2, 3)}


@pytest.mark.parametrize(
    "token, hint",
    [
        ("cookie-notice", "notice"), ("site__footer", "footer"), ("widget-area", "widget"), ("adsBox", "ads"),
        ("wrapper", None), ("loading", None), ("has-sidebar", None), ("12", None), ("head-line", None),
    ],
)
def test_hints(token, hint):
    assert pages._hint(token) == hint


def test_repeated_blocks_go_without_article_elements(table):
    menu = "<div><p>Products Services Careers Contact Imprint Privacy Terms Help Shop</p></div>"
    rows = [
        (i, f"https://b.example/{i}", f"<body>{menu}<div><p>" + " ".join(f"w{i}x{k}" for k in range(20)) + "</p></div>")
        for i in range(6)
    ]
    got = pages.extract_main_text(table(rows)).collect()
    assert {r.text for r in got} == {" ".join(f"w{i}x{k}" for k in range(20)) for i in range(6)}
    assert all(r.n_chars == len(r.text) for r in got)


def test_equal_pages_count_as_one(table):
    body = "<body><p>" + " ".join(f"word{k}" for k in range(30)) + "</p>"
    rows = [(i, "http://c.example/", body) for i in range(50)] + [(60, "http://d.example", body)]
    got = pages.extract_main_text(table(rows)).collect()
    assert len(got) == 51 and {r.text for r in got} == {" ".join(f"word{k}" for k in range(30))}


def test_nulls_empty_and_long_pages(table):
    rows = [(None, None, None), (1, None, ""), (1, "not a url", "<p>x</p>"), (2, "http://", "plain text")]
    rows += [(3, "http://e.example", "<article>" + "<p>long text here</p>" * 20_000 + "</article>")]
    got = {(r.page_id, r.url): r.text for r in pages.extract_main_text(table(rows)).collect()}
    assert got[None, None] == "" and got[1, None] == "" and got[1, "not a url"] == "x"
    assert got[2, "http://"] == "plain text"
    assert got[3, "http://e.example"].count("\n") == 19_999
    assert pages.extract_main_text(table([])).count() == 0


def test_hot_hosts_are_dealt(table, monkeypatch):
    monkeypatch.setattr(pages, "GROUP_PAGES", 20)
    body = "<article><p>own {0} words</p></article>"
    rows = [(i, "http://hot.example/", page(i, body.format(i))) for i in range(150)]
    frame = pages.extract_main_text(table(rows))
    assert {r.page_id: r.text for r in frame.collect()} == {i: f"own {i} words" for i in range(150)}


def own(i, count=20):
    return " ".join(f"own{i}x{k}" for k in range(count))


def test_hot_hosts_share_rare_notices(table, monkeypatch):
    """A notice on two pages in 150, in unnamed elements, and a page more than a group holds."""
    monkeypatch.setattr(pages, "GROUP_PAGES", 20)
    rows = [(i, "http://hot.example/", f"<body><div>{own(900 + i % 75, 11)}</div><p>{own(i)}</p>") for i in range(150)]
    menu = "<div>Products Services Careers Contact Imprint Privacy Terms Help Shop</div>"
    rows += [(i, "http://rest.example/", f"<body>{menu}<p>{own(i)}</p>") for i in range(200, 221)]
    got = {r.page_id: r.text for r in pages.extract_main_text(table(rows)).collect()}
    assert got == {row[0]: own(row[0]) for row in rows}


def test_a_page_behind_a_very_long_one_is_compared(table):
    menu = "<div>Products Services Careers Contact Imprint Privacy Terms Help Shop</div>"
    rows = [(1, "http://long.example/", f"<body>{menu}<p>{'a b c ' * 350_000}</p>")]
    rows += [(2, "http://long.example/", f"<body>{menu}<p>{own(2)}</p>")]
    got = {r.page_id: r.text for r in pages.extract_main_text(table(rows)).collect()}
    assert got[2] == own(2) and len(got[1]) == 350_000 * 6 - 1


def test_both_ways_give_the_same_texts(table, monkeypatch):
    random = np.random.default_rng(2)
    shared = [" ".join(f"s{n}w{k}" for k in range(random.integers(3, 14))) for n in range(30)]
    rows = []
    for i in range(120):
        parts = [f"<{e}>{shared[random.integers(30)]}</{e}>" for e in random.choice(["p", "div", "nav"], 4)]
        parts += [f"<article><p>{shared[i % 30]} {own(i, 3)}</p></article>"] * (i % 4 == 0) + [f"<p>{own(i, 9)}</p>"]
        rows.append((i, f"http://h{i % 3}.example/", "<body>" + "".join(parts)))
    rows += [(i + 500, *rows[i][1:]) for i in range(9)]
    found = []
    for most in (0, 10_000):
        monkeypatch.setattr(pages, "GROUP_PAGES", most)
        found.append(sorted(tuple(r) for r in pages.extract_main_text(table(rows)).collect()))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_query(spark):
    import re
    from html import unescape

    from starmart.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.page_id: r.text for r in QUERIES["op3_host_suffix_array"](spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        parts = [re.sub(r"<[^>]*>", " ", part) for part in re.split(r"</?(?:p|h1)>", article)]
        expected = [" ".join(unescape(part).split()) for part in parts]
        assert texts[row.page_id] == "\n".join(part for part in expected if part)


@pytest.mark.parametrize("most", [2, 10_000])
def test_an_article_that_all_pages_share_is_no_main_text(table, monkeypatch, most):
    """The suffix array decides on pages with an article too, alike for hosts of one lot and of many."""
    monkeypatch.setattr(pages, "GROUP_PAGES", most)
    promo = "<article><h2>Our shop of the year</h2><p>Visit us today and buy two for the price of one.</p></article>"
    rows = [(i, "http://p.example/", f"<body>{promo}<div><p>{own(i)}</p></div>") for i in range(9)]
    story = "<article><p>" + own(77, 30) + "</p></article>"
    rows += [(i, "http://p.example/", f"<body>{story}<div><p>Seen {i} times</p></div>") for i in (20, 21)]
    rows += [(30, "http://q.example/", f"<body>{promo}<div><p>{own(30)}</p></div>")]
    got = {r.page_id: r.text for r in pages.extract_main_text(table(rows)).collect()}
    assert got == {
        **{i: own(i) for i in range(9)},
        **{i: own(77, 30) for i in (20, 21)},
        30: "Our shop of the year\nVisit us today and buy two for the price of one.",
    }
