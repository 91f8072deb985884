import random

import pytest

from commitlens.llm import pages


def texts(page):
    return [x.text for x in pages.lines(page) if not x.chrome]


def test_lines():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="article">
    <nav><ul><li><a href="/">Home</a><li>More</ul></nav><!-- <p>no</p> --><div class="top ad">Buy</div>
    <article><header><h1>Head &eacute;&#233;&nbsp;line</h1></header><p>one <b>two</b>
    three<br>four<p>five &lt;six&gt; &copy;<script>if (a<b) "</p>"</script><ul><li>x<li>y<ul><li>z</ul></ul>
    <aside>side</aside><form><input value="q"><p>field</form><div id='comments'><p>reader</div><p data-x="a>b" title=it's>last</article>
    <p>after<footer>&copy; foot</footer></body></html>"""
    assert texts(page) == ["Head éé line", "one two three", "four", "five <six> ©", "x", "y", "z", "last", "after"]
    assert pages.main_text(pages.lines(page), []) == "Head éé line\none two three\nfour\nfive <six> ©\nx\ny\nz\nlast"


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []), ("   ", []), ("plain text", ["plain text"]), ("<p>a", ["a"]), ("a < b > c <3", ["a < b > c <3"]), ("</p></div>x", ["x"]),
        ("<p>x<!-- open <p>y", ["x"]), ("<script>x", []), ("<p hidden>x</p>y", ["y"]), ("<p>a</b>b</p>", ["ab"]), ("<div><p>a</div>b", ["a", "b"]),
        ("<p><nav>m</p>n</nav>o", ["o"]), ('<div class="main"><div class="sidebar">s</div>t</div>', ["t"]), ("<p>&#x1F642;&bogus;&amp", ["🙂&bogus;&"]),
        ("<td>1<td>2<tr><td>3", ["1", "2", "3"]), ("<b>" * 3_000 + "deep", ["deep"]), ("<p>é</p>" * 2_000, ["é"] * 2_000), ("<" * 20_000, ["<" * 20_000]),
    ],
)
def test_odd_markup(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    "page",
    [
        '<div class="has-sidebar"><article><p>text</p></article></div>',
        '<article class="post comments-open"><p>text</p></article>',
        '<main class="related-layout"><p>text</p></main>',
        '<article><div title="the hidden truth"><p>text</p></div></article>',
        '<div class="no-sidebar social"><main><p>text</p></main></div>',
        '<article class="notice"><p>text</p><div class="sidebar">menu</div></article>',
        '<article><p data-hidden="x" alt=\'display: none\'>text</p><p hidden="">no</p><p style="color:red; display : none">no</p><p aria-hidden="true">no</p></article>',
        '<article><p>text</p><section class="comments"><article><p>reader</p></article></section></article>',
        '<nav><article>menu</article></nav><article>text</article><div class="related"><article>other page</article></div>',
    ],
)
def test_a_word_does_not_outrank_an_article(page):
    assert texts(page) == ["text"] and pages.main_text(pages.lines(page), []) == "text"


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abcde"[: rng.randrange(1, 6)]) for _ in range(rng.randrange(12))] for _ in range(2))
        places = pages.common(a, b)
        assert places == sorted(set(places)) and len(places) == length(a, b)
        picked, rest = [a[i] for i in places], iter(b)
        assert all(x in rest for x in picked)
    assert pages.common(["x"] * 3_000 + ["y"], ["z"] + ["x"] * 2_999) == list(range(2_999))


def site(n, host="site.example", wrap="div"):
    """Pages without an article element: menu and notice lines that all share, and some that two share."""
    out = []
    for i in range(n):
        body = "".join(f"<p>body {i} line {j} of the page</p>" for j in range(4))
        out.append((i, f"http://{host}/a/{i:04d}.html", f"<p>Welcome to the site</p><p>Menu one two</p><{wrap}>{body}</{wrap}><p>All rights of the site</p>"))
    return out


def test_shared_lines_of_the_nearest_page_are_deleted(spark):
    rows = site(300) + [(1_000, "https://SITE.example/a/0007.html?x=1", site(8)[7][2])] + site(1, "lonely.example")
    rows += [(2_000, None, "<p>no url</p>"), (2_001, "http://x.example/", None), (None, "http://x.example/b", ""), (1_000, "https://SITE.example/a/0007.html?x=1", site(8)[7][2])]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string").repartition(5)
    got = pages.page_texts(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    for r in got:
        assert r.n_chars == len(r.text)
        if r.url and "site.example" in r.url.lower() and r.page_id is not None:
            i = 7 if r.page_id == 1_000 else r.page_id
            assert r.text == "\n".join(f"body {i} line {j} of the page" for j in range(4))
    by_id = {r.page_id: r.text for r in got if r.url is None or "site" not in r.url.lower()}
    assert by_id[0].startswith("Welcome") and by_id[2_000] == "no url" and by_id[2_001] == by_id[None] == ""
    again = pages.page_texts(docs.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_quoted_passages_in_an_article_stay(spark):
    quote = "<p>" + "a passage that both pages quote " * 9 + "</p>"
    rows = [(i, f"http://h.example/{i}", f"<nav>m</nav><p>notice</p><article><p>own {i}</p>{quote}</article>") for i in range(4)]
    got = pages.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"own {i}\n{('a passage that both pages quote ' * 9).strip()}" for i in range(4)}


def test_neighbours_decide_what_markup_leaves_open():
    def page(i, body):
        return pages.lines(body.format(i=i))

    def text(body, *others):
        return pages.main_text(page(0, body), [page(i, b) for i, b in enumerate(others or [body] * 3, 1)])

    # Named by a class only: what several pages have goes, what one has stays.
    body = '<div class="content"><p>Subscribe today to our letter</p><p>own {i} is a long line of this page alone, as pages have</p></div>'
    assert text(body) == "own 0 is a long line of this page alone, as pages have"
    one = '<div class="content"><p>other {i}</p></div>'
    assert text(body, body, one, one).startswith("Subscribe")
    # Inside of an article all stays; beside it what no other page has stays, and nothing is said without several to ask.
    body = "<p>Welcome</p><h1>Headline {i}</h1><article><p>Welcome</p><p>text {i}</p></article><p>Go on reading</p>"
    assert text(body) == "Headline 0\nWelcome\ntext 0"
    assert text(body, body) == "Welcome\ntext 0"
    # Beside it, what others have at another place is theirs too.
    assert text(body, "<p>b {i}</p><p>Headline 0</p>", body, body) == "Welcome\ntext 0"
    # No part named: one neighbour that quotes a line does not take it away, two do.
    assert text("<p>own {i}</p><p>quoted</p>", "<p>x {i}</p><p>quoted</p>", "<p>y {i} and much more</p>") == "own 0\nquoted"
    assert text("<p>own {i}</p><p>quoted</p>", "<p>x {i}</p><p>quoted</p>", "<p>y {i}</p><p>quoted</p>") == "own 0"


def restated(rows):
    """The text of every page by the two nearest pages before and after it in its host that differ from it and among themselves."""
    found = sorted((u.split("/")[2], u[u.index("/", 8) :].split("?")[0], u, i, tuple(pages.lines(h))) for i, u, h in rows)
    out = {}
    for at, (host, _, _, i, own) in enumerate(found):
        near = []
        for side in (found[:at][::-1], found[at + 1 :]):
            unlike = dict.fromkeys(tuple(x.text for x in r[4]) for r in side if r[0] == host and [x.text for x in r[4]] != [x.text for x in own])
            near += list(unlike)[:2]
        out[i] = pages.main_text(list(own), [[pages.Line(t, False, False) for t in x] for x in dict.fromkeys(near)])
    return out


def test_a_small_section_of_a_large_host_and_neighbours_in_other_ranges(spark):
    rows = []
    for i in range(900):
        section = "legal" if 400 <= i < 412 else f"part{i // 40:02d}"
        own = "".join(f"<p>{section} page {i} line {j}</p>" for j in range(5))
        rows.append((i, f"http://big.example/{section}/{i:04d}", f"<p>The site</p><p>Notice of {section}</p>{own}<p>Imprint of {section}</p>"))
    got = {r.page_id: r.text for r in pages.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == restated(rows)
    assert all(got[i] == "\n".join(f"legal page {i} line {j}" for j in range(5)) for i in range(400, 412))
    assert not any("Notice" in t for t in got.values())


def test_runs_of_copies_and_short_pages(spark):
    """Pages of which menu and footer are most of the text, some in runs of copies, some with two copies in turn."""

    def page(i):
        return f"<p>Welcome to the site that has a long greeting for all</p><p>own {i}</p><p>All rights of the site are reserved to its owners</p>"

    rows = [(i, f"http://c.example/{i:03d}", page(i)) for i in range(30)]
    rows += [(1_000 + i, f"http://c.example/012?session={i}", page(12)) for i in range(300)]
    rows += [(2_000 + i, f"http://c.example/020/{i:03d}", page(100 + i % 2)) for i in range(200)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.page_texts(docs).collect()}
    want = {i: f"own {i if i < 1_000 else 12 if i < 2_000 else 100 + i % 2}" for i, _, _ in rows}
    assert got == want == restated(rows)


def test_ranges_of_copies_are_looked_beyond():
    key = lambda host, n, content: (host, "/", f"{n}", n, content)
    a, b, c, d = key("h", 1, b"a"), key("h", 2, b"b"), key("h", 9, b"c"), key("i", 1, b"a")
    copies = key("h", 4, b"b")
    firsts, lasts = [[a, b], [copies], [c], [d]], [[b, a], [copies], [c], [d]]
    assert pages._halo(firsts, lasts) == {b: [1], a: [1, 2], copies: [2, 0], c: [1, 0]}


def test_empty(spark):
    assert pages.page_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
