"""Main text of pages: made sites with known articles, hard markup, and the tree against brute force."""

import html as entities
import math
import re

import duckdb
import pytest

from ledgerlake.llm import queries, site_style
from ledgerlake.llm.site_style import Dom, extract, main_text, merge_rows, style_trees

from .conftest import SF


def text(html, tree=None):
    return main_text(Dom(html), tree or {})


def test_blocks_and_white_space():
    assert text("<body><p>one <b>two</b>\n\t three<p>four<br>five &amp; six&nbsp;seven</p><ul><li>a<li>b</ul>") \
        == "one two three\n\nfour five & six seven\n\na\n\nb"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>tail") == "a\n\nb\n\nc\n\ntail"
    assert text("") == text("<p> \n </p>") == text("<html><head><title>x</title></head><body></body></html>") == ""
    assert text("plain &lt;text&gt; 1 < 2") == "plain <text> 1 < 2"


@pytest.mark.parametrize("junk", [
    "<nav>x</nav>", "<header>x</header>", "<footer>x</footer>", "<aside>x</aside>", "<form><label>x</label><input></form>",
    "<script>var a = '<p>x</p>';</script>", "<style>p{}</style>", "<!-- <p>x</p> -->", '<div class="ad">x</div>',
    '<div id="cookie-notice"><p>x</div>', '<section class="comments"><article class="comment">x</article></section>',
    '<div role="navigation">x</div>', "<div hidden>x</div>", '<div style="display: none">x</div>', '<div class="siteSidebar">x</div>',
    "<noscript>x</noscript>", "<button>x</button>", "<textarea><p>x</textarea>", '<p class="share-links">x</p>', "<!--->", "<?php x ?>",
    '<div class=newsletter><p>x</p></div>', "<SCRIPT>x</SCRIPT >", '<dialog open>x</dialog>'])
def test_furniture_goes(junk):
    page = f"<html><head><title>t</title></head><body>{junk}<article><h1>Head</h1><p>one</p>{junk}<p>two</p></article>{junk}</body></html>"
    got = text(page)
    # a header inside the article is its headline
    want = "Head\n\none\n\nx\n\ntwo" if junk.startswith("<header") else "Head\n\none\n\ntwo"
    assert got == want


def test_names_around_the_article_do_not_remove_it():
    assert text('<body class="has-sidebar"><form><div class="content with-comments share"><article><p>kept</article></div></form>') == "kept"
    assert text("<article><p>a <span class='ad'>buy</span> b</p></article>") == "a b"


def test_broken_markup_is_linear_and_kept():
    assert text("<p>a</div></p></li>b<p c='>d") .startswith("a")
    assert text("<script>never closed <p>x") == ""
    assert text("<p>x<!-- never closed <p>y") == "x"
    n = 200_000
    assert text("<div>" * n + "deep") == "deep"
    assert text("<" * n) == "<" * n
    assert text("</div>" * n + "<a href='" * 1000 + "x") is not None
    assert len(text("<p>" + "word " * n)) == 5 * n - 1


def site(n, host, line="Follow us on all channels. Terms apply."):
    rows = []
    for i in range(n):
        body = "".join(f"<div><span>Story {host} {i} part {j} tells of {'x' * (i % 7)} things{i * 31 + j}.</span></div>" for j in range(2 + i % 3))
        rows.append((f"http://{host}/p/{i}", f"<body><div><div>{line}</div><div><a href='/a'>Start</a> <a href='/b'>Index</a></div></div>"
                                             f"<div>{body}<div>{line}</div></div><div>Made in {host}, 20{i:02d}</div></body>"))
    return rows


def test_repeated_branches_go_by_entropy_alone(spark):
    """No tag, class or id names anything here: only the merged tree tells menus from text."""
    many, few = site(40, "big.example.org"), site(5, "small.example.org")
    rows = [(i, u, h) for i, (u, h) in enumerate(many + few)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(df).collect()}
    for i in range(40):
        assert got[i].count("Story") == 2 + i % 3 and "Follow" not in got[i] and "Index" not in got[i] and "Made" not in got[i]
    # five pages are too little evidence
    assert all("Follow" in got[40 + i] and "Story" in got[40 + i] for i in range(5))


def test_copies_of_a_page_are_no_evidence(spark):
    page = "<body><p>The only article. Copied often.</p></body>"
    rows = [(i, f"http://c.example/{i}", page) for i in range(60)] + [(100, None, page), (101, "no url", page)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 62 and {r.text for r in got} == {"The only article. Copied often."}


def brute_tree(pages):
    """Importances by the formulas, from all pages of one host."""
    found = [merge_rows(Dom(h)) for h in sorted(set(pages))]
    m, tree, styles = len(found), {}, {}
    held = {}
    for rows in found:
        for r in rows:
            held[r] = held.get(r, 0) + 1
    for (e, x), n in held.items():
        if e == 0:
            if math.log(n) / math.log(m + 2) >= site_style.COMMON:
                tree[x] = 1 - math.log(n) / math.log(m + 2)
        else:
            styles.setdefault(e, []).append(n)
    for e, counts in styles.items():
        t = sum(counts)
        if math.log(t) / math.log(m + 2) >= site_style.COMMON:
            entropy = -sum(n / t * math.log(n / t) for n in counts)
            tree[e] = 1 - (math.log(t) - entropy) / math.log(t + 2) + 2 * len(counts)
    return tree


def test_tree_matches_brute_force(spark):
    rows = site(30, "a.example") + site(20, "b.example", "Another line") + site(3, "a.example")[:2]
    df = spark.createDataFrame([(i, u.upper(), h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.host: dict(r.tree) for r in style_trees(df).collect()}
    for host in ("a.example", "b.example"):
        want = brute_tree([h for u, h in rows if host in u])
        assert want and got[host].keys() == want.keys()
        assert all(abs(got[host][k] - v) < 1e-5 for k, v in want.items())


def test_query_gives_whole_articles(spark):
    html = dict(duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall())
    rows = queries.QUERIES["op12_site_style"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(html)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", html[r.page_id], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_edges(spark):
    rows = [(1, "http://h.example/", None, "c", 7, "k"), (1, "http://h.example/", "", "c", 7, "k"), (None, None, "<p>x", None, None, None),
            (2, "http://h.example/", "<p>" + "long " * 300_000, "c", 7, "k"), (2, "http://h.example/", "<p>x", "c", 7, "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, host string")
    got = extract(df)
    assert got.columns == ["page_id", "url", "host", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 1, 1, 1_499_999]
    assert extract(df.limit(0)).collect() == []
