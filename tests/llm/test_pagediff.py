"""Page differencing against plain versions."""
import html
import random
import re
from os.path import commonprefix
from urllib.parse import urlsplit

from bidscope.llm import markup as M
from bidscope.llm import pagediff as P
from bidscope.llm.queries import QUERIES


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in "ab")
        got = sorted(P.shared_lines(a, b))
        assert len(got) == lcs(a, b)
        at = iter(b)
        assert all(a[i] in at for i in got)          # in order


def test_every_article_of_the_table(spark):
    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = QUERIES["op6_page_differencing"](spark, d).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_zones():
    page = """<head><title>t</title></head><body class="no-sidebar"><div id="site-nav">menu</div><header>top</header>
    <main><h1>A &amp; B</h1><p>one <b>two</b>&nbsp;three<p>four<div class="share">no</div><aside>no</aside><script>x("</p>")</script>
    <section class="comments"><p>me too</section><p>five</main><form>mail</form><p>late<footer>end"""
    assert [x for x, z in M.lines(page) if z == M.MAIN] == ["A & B", "one two three", "four", "five"]
    assert [x for x, z in M.lines(page) if z == M.OPEN] == ["late"]
    assert M.lines("") == [] and M.lines("<p") == [("<p", 0)] and M.lines("a<!-- b") == [("a", 0)]
    assert M.lines("<p>" * 20000 + "x") == [("x", 0)] and M.lines("a" * 200000)[0][0] == "a" * 200000


def plain_nearest(rows):
    """By sorting whole hosts."""
    urls = {}
    for key, url, page in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        url = url or ""
        parts = urlsplit(url)
        host = parts.netloc.lower()
        path = url.split("://", 1)[1][len(parts.netloc):] if host else url
        urls.setdefault((host, path), page)
    order = sorted(urls, key=lambda x: (x[0].encode(), x[1].encode()))
    out = {}
    for i, u in enumerate(order):
        near = [order[j] for j in (i - 1, i + 1) if 0 <= j < len(order) and order[j][0] == u[0]]
        near.sort(key=lambda x: -len(commonprefix([u[1], x[1]])))
        out[u] = urls[near[0]] if near else None
    return out


def test_nearest_and_deleted_lines(spark):
    rng = random.Random(2)
    rows = []
    for i in range(80):
        host = "big.org" if i % 3 == 0 else f"h{i % 7}.org"
        body = "".join(f"<p>{rng.choice('abcdefgh')} own {i}</p>" if rng.random() < 0.5 else f"<div>{rng.choice(['home', 'login', 'imprint'])}</div>" for _ in range(8))
        rows.append((i, f"https://{host}/{rng.choice('xyz')}/{rng.randrange(30)}?q={i % 2}", body))
    rows += [(100, None, "<p>n</p>"), (101, "", None), (102, rows[0][1], rows[0][2]), (102, rows[0][1], rows[0][2]), (None, "https://solo.net/a", "<p>s</p>"),
             (103, "https://Big.org", "<p>" + "long " * 50000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as host", "2 as nearest").repartition(5)
    near = plain_nearest(rows)
    want = []
    for key, url, page in rows:
        parts = urlsplit(url or "")
        path = (url or "").split("://", 1)[1][len(parts.netloc):] if parts.netloc else url or ""
        other = near[parts.netloc.lower(), path]
        text = P.main_text(M.lines(page or ""), None if other is None else P.line_hashes(M.lines(other)))
        want.append((key, url, text, len(text)))
    got = P.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))
    assert any("home" not in w[2] and "home" in r[2] for w, r in zip(want, rows) if r[2])
    assert P.extract(df.limit(0)).count() == 0


def test_lines_beside_an_article_are_decided_by_the_nearest_page():
    page = "<div>menu</div><p>one</p><article><p>teaser</p></article><p>two</p><div>imprint</div>"
    other = "<div>menu</div><p>else</p><article><p>teaser</p></article><div>imprint</div>"
    assert P.main_text(M.lines(page), P.line_hashes(M.lines(other))) == "one\nteaser\ntwo"
    assert P.main_text(M.lines(page), None) == "menu\none\nteaser\ntwo\nimprint"


def test_near_copies_of_a_host_keep_their_text(spark):
    menu, foot = "<div>menu</div>", "<div>imprint</div>"
    copy = lambda x: f"{menu}<h2>title</h2><p>first</p><p>{x}</p><p>last</p>{foot}"
    bodies = [copy("changed"), copy("as it was"), copy("mended")] + [f"{menu}<p>own {i}</p>{foot}" for i in range(5)]
    rows = [(i, f"https://h.org/a/{i}", b) for i, b in enumerate(bodies)] + [(90 + i, f"https://two.org/{i}", copy(i)) for i in range(2)]
    got = {r.page_id: r.text for r in P.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == ["title\nfirst\nchanged\nlast", "title\nfirst\nas it was\nlast", "title\nfirst\nmended\nlast", "own 0"]
    assert got[90] == "menu\ntitle\nfirst\n0\nlast\nimprint"          # no third page confirms a template


def test_an_article_inside_marked_containers():
    main = lambda page: [x for x, z in M.lines(page) if z == M.MAIN]
    assert main('<div class="content-sidebar-wrap"><article><p>a</article><section class="related"><article>card</article></section></div>') == ["a"]
    assert main('<div class="page no-sidebar"><article>a<div class="comments"><article>c</article></div></article></div>') == ["a"]
    assert main('<form id="aspnetForm"><div><article>a</article></div><div class="sidebar"><main>b</main></div></form>') == ["a", "b"]
    assert main('<article>a</article><aside><article>b</article></aside><footer><main>c</main></footer><div hidden><article>d</article></div>') == ["a"]
