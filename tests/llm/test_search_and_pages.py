"""Exact top-k search and HTML rendering."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import rendering, topk


def brute(rows, k):
    usable = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in usable if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("kind", "block"), [("clusters", 16), ("noise", 64), ("copies", 8)])
def test_topk_equals_brute_force(spark, kind, block):
    rng = np.random.default_rng(len(kind))
    if kind == "clusters":
        v = rng.normal(size=(8, 6))[rng.integers(0, 8, 300)] * 3 + rng.normal(size=(300, 6)) * 0.1
    elif kind == "noise":
        v = rng.normal(size=(300, 6))
    else:
        v = np.where(rng.random((300, 1)) < 0.5, np.ones((1, 6)), rng.normal(size=(300, 6)))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(1000, None), (1020, [None] * 6), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (1080, []), (1100, [1.0, 2.0]), (None, [1.0] * 6), (1120, [0.0] * 6)]
    table = spark.createDataFrame([(i, x, 1.0, 2) for i, x in rows], "vec_id long, embedding array<float>, r double, block int")
    got = topk.search(table, F.col("vec_id") % 20 == 0, k=7, block=block, query_block=5, pivots=6, sample=40)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7)


def test_topk_few_rows_and_large_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    empty = spark.createDataFrame([], schema)
    assert topk.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    big = spark.createDataFrame([(0, [2.0**22, 1.0]), (1, [2.0**22, 3.0]), (2, [2.0**22, 2.0])], schema)
    got = [(r["vec_id"], r["score"]) for r in topk.search(big, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(1, 2**56 + 64 * 192), (2, 2**56 + 64 * 128)]
    same = spark.createDataFrame([(20, [1.0]), (20, [1.0]), (3, [1.0])], schema)
    assert topk.search(same, F.col("vec_id") % 20 == 0).count() == 2


def test_topk_of_repeated_query_rows(spark):
    """Every query row twice, ids with differing vectors, copies in several blocks and annuli."""
    rng = np.random.default_rng(9)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(5000, 5)))]
    rows += [r for r in rows if r[0] % 100 == 0]
    rows += [(i, rng.normal(size=5).tolist()) for i in range(0, 5000, 500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search(table, F.col("vec_id") % 100 == 0, k=20, block=64, query_block=16, pivots=12, sample=200)
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float))
    ids = np.array([i for i, _ in rows])
    want = []
    for at in np.flatnonzero(ids % 100 == 0).tolist():
        score = x @ x[at]
        order = np.lexsort((ids, -score))
        order = order[ids[order] != ids[at]][:20]
        want += [(int(ids[at]), n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(order.tolist())]
    assert sorted(map(tuple, got.collect())) == sorted(want)


CASES = {
    "<p title=don't>hello</p><p>it's ok</p><p>end</p>": "hello\n\nit's ok\n\nend",
    '<div class="a"">text one</div><p class="b">two</p>': "text one\n\ntwo",
    '<a href=foo?a="b>c</a>': "c",
    "<p ='x'>a</p><p a = '>' b>c</p>": "a\n\nc",
    "a<!-->b<!--->c<!---->d<!-- > -- x --!>e": "abcde",
    "a</ p>b</>c</3>d": "abcd",
    '<p style="visibility:hidden">a<b style="visibility: visible">b</b>c<i>d</i></p>e': "b\n\ne",
    '<div style="visibility:hidden;visibility:visible">a</div>': "a",
    '<div style="x-display:none">a</div><div style="display:block;display:none">b</div>': "a",
    "<ol><li>a<li style=visibility:hidden>b<li>c</ol>": "1. a\n3. c",
    "a<dialog>b</dialog><dialog open>c</dialog>": "a\nc",
    "<details><summary>s</summary>x<p>y</details><details open><summary>t</summary>z</details>": "s\nt\nz",
    "<p>one<p>two": "one\n\ntwo",
    "a<div>b</div>c": "a\nb\nc",
    "x<br>y<br><br>z": "x\ny\n\nz",
    "<p>  a \n b <b> c</b> d</p>": "a b c d",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "* a\n* b\n  * c\n* d\n\ne",
    "<ol start=9><li>a<li value=20>b<li>c</ol>": "9. a\n20. b\n21. c",
    "<ol><li><p>a</p><p>b</p></li></ol>": "1. a\n\n   b",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<table><tr><th>k<th>v<tr><td>long key<td>1<tr><td>x<td>22</table>": "k         v\nlong key  1\nx         22",
    "<table><td>a<td>b</table>c": "a  b\n\nc",
    "<table><tr><td colspan=2>a b<td>c<tr><td>1<td>2<td>3</table>": "a b   c\n1  2  3",
    "<table><tr><td rowspan=2>r<td>a<tr><td>b</table>": "r  a\n   b",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i  j  k",
    "<pre>a\n  b</pre>c": "a\n  b\n\nc",
    "<head><title>t</title></head>b": "b",
    "<style>p{}</style><script>'</p>'</script>v": "v",
    "<div hidden>h</div><p style='DISPLAY : none'>i</p><input type=hidden>v": "v",
    "<template>a</template><noscript>b</noscript>c": "c",
    "&lt;b&gt; &amp; &copy; &#233; &notanentity;": "<b> & © é ¬anentity;",
    "<!-- c -->a<!-- open": "a",
    "a<b": "a",
    "a < b > c": "a < b > c",
    "</p></div>a</b>": "a",
    "<a title='x > y'>l</a>": "l",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<h1>a<h2>b</h2>": "a\n\nb",
    "<select><option>a<option>b</select>": "a\nb",
    "<p>a<table><tr><td>b</table>": "a\n\nb",
    "": "",
}


@pytest.mark.parametrize("source", CASES)
def test_rendering(source):
    assert rendering.render(source)[1] == CASES[source]


def test_titles_languages_and_depth():
    assert rendering.render("<html><head><title> A &amp;\n b </title><body>x")[0] == "A & b"
    assert rendering.render(None) == (None, "")
    assert rendering.render("<div>" * 5000 + "deep" + "</div>" * 9)[1] == "deep"
    assert rendering.render("<table><tr><td>" * 300 + "in")[1].strip() == "in"
    assert [rendering.language(h) for h in ("<HTML dir=x LANG='pt-BR'>", "<html>", None, "<p lang=en>", "<html lang=''>")] == ["pt", None, None, None, None]


def test_extract_odd_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", "t"), (2, None, "t"), (None, "", "t"), (3, "<i>x</i> " * 50_000, "t")], "page_id long, html string, title string")
    got = rendering.extract(pages).collect()
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 99_999)]
    assert rendering.extract(pages.limit(0)).count() == 0


def test_stray_quotes_lose_no_text():
    """Random markup: each word outside tags is emitted, in order, and nothing from inside tags."""
    rng = np.random.default_rng(3)
    pick = lambda xs: xs[rng.integers(len(xs))]
    junk = ["", " title=don't", ' class="a""', " '", ' "', " a='>'", ' b=">" c', " x=y'z\"", ' d = "q\'>"', " /", " k=/"]
    tags = ["p", "div", "b", "i", "span", "li", "ul", "h2", "em", "blockquote"]
    for _ in range(300):
        page, words = [], []
        for n in range(30):
            kind = rng.integers(4)
            if kind == 0:
                page.append(f"<{pick(tags)}{pick(junk)}{pick(junk)}>")
            elif kind == 1:
                page.append(f"</{pick(tags)}{pick(junk)}>")
            elif kind == 2:
                page.append(pick(["<!-- no -->", "<!-->", "<!--->", "<!doctype html>", "</>", "<br>"]))
            else:
                words.append(f"w{n}")
                page.append(f" w{n} ")
        _, text = rendering.render("".join(page))
        assert text.replace("*", " ").split() == words
