from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sightline.operators import dom
import dom_brute as B

PARTS = ["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<i>", "</i>", "<br>", "<ul>", "</ul>", "<li>", "</li>", "text ", " ", "x&amp;y", "<td>", "<tr>", "<table>", "</table>", "</td>",
         "<img alt=it's src=/a.png>", "<!-- c > -->", "<script>var t='</p>';</script>", "<a href='x>y'>", "</a>", "<h1>", "</h1>", "<x/>", "</br>", "<", "<article>", "</article>", "<DIV class=a>", "</DIV >"]
CODE = ["<div>", "<div>", "</div>", "</div>", "<pre>", "<pre>", "</pre>", "</pre>", "<code>", '<code class="hl language-py x">', "</code>", "</code>", "<span>", "<span class=line>", '<span class="line hl">', "</span>", "</span>", "</span>",
        "text", " ", "\n", "t &lt;", "<button>", "</button>", '<div class="x Copy-Button">', '<a class="clipboard">', "</a>", '<section role="region" aria-label="The Terminal">', "</section>", "<section>", '<div role="button">', "<b>", "</b>", "<em>", "</em>", "<i>", "</i>", "<svg>", "</svg>", "<p>", "</p>"]


def pages_of(spark, seed, parts, n=250, size=40):
    rnd = random.Random(seed)
    html = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, size))) for _ in range(n)] + [None, "", "<", "<p", "<!-- open", "<script>x"]
    return html, spark.createDataFrame(list(enumerate(html)), "page_id long, html string").repartition(4)


def nodes(root):
    return {n.pos: n for n in root.walk()}


@pytest.mark.parametrize("seed,parts", [(1, PARTS), (2, ["<p>", "<b>", "<li>", "<td>", "<tr>", "<ul>", "</ul>", "</b>", "</p>", "t"]), (3, CODE)])
def test_intervals_against_a_stack(spark, seed, parts):
    html, pages = pages_of(spark, seed, parts)
    t = dom.annotate(dom.tokens(pages))
    rows = t.collect()
    text = {(r.row, r.pos): r.mass for r in dom.masses(t, dom.is_element(), dom.text_length()).collect()}
    got = {}
    for r in rows:
        got.setdefault(r.id, {})[r.pos] = r
    for i, h in enumerate(html):
        root = B.tree(h)
        assert "".join(got[i][p].token for p in sorted(got[i])) == (h or "")
        want = nodes(root)
        for p, r in got[i].items():
            if r.kind == "close":
                continue
            n = want[p]
            assert (r.kind, r.name if r.kind != "stray" else n.name) == (n.kind, n.name)
            assert r.depth == sum(1 for _ in B.up(n)) - 1, (h, p)
            assert (r.parent.pos if r.parent else None) == (n.parent.pos if n.parent is not root else None), (h, p)
            if n.is_element:
                assert r.stop == n.stop and text[r.row, p] == n.length(), (h, p, r, n.stop)
                assert not r.parent or (r.parent.stop == n.parent.stop and r.parent.name == n.parent.name)


@pytest.mark.parametrize("step", range(len(B.STEPS) + 1))
def test_cleaning_steps_against_trees(spark, step):
    html, pages = pages_of(spark, 10 + step, CODE, n=300, size=60)
    steps, brute = (dom.STEPS, B.STEPS) if step == len(B.STEPS) else (dom.STEPS[step : step + 1], B.STEPS[step : step + 1])
    got = {r.id: r.html for r in dom.joined(dom.dom_cleanup(dom.annotate(dom.tokens(pages)), steps), "html").collect()}
    changed = 0
    for i, h in enumerate(html):
        root = B.tree(h)
        for do in brute:
            do(root)
        text = root.html()
        assert got[i] == text, (i, h)
        changed += text != (h or "")
    assert changed >= 5


def test_choice_of_content(spark):
    long = "long text " * 15
    html = [f"<article>short</article><main>{long}</main>", f"<body><article><p>{long}</article>", "<article>a</article><main>b</main><div>few<p>words</div><div>more words here</div>", "<body><article>a</article></body>", "just text", "",
            None, "<div></div>", f"<div>{long}</div><div>{long}</div>", f"<body><div id=x class='c d'>{long}</div>", f"<nav><article>{long}</article></nav><article>no</article>", f"<article>no</article><article>{long}</article>"]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    got = {r.id: (r.picked_by, r.pos, r.stop) for r in dom.pick_article(dom.annotate(dom.tokens(pages))).collect()}
    assert [got[i][0] for i in range(12)] == ["main", "article", "div", "body", "document", "document", "document", "document", "div", "div", "article", "document"]
    for i, h in enumerate(html):
        by, n = B.pick(B.tree(h))
        if by != "document":
            assert got[i] == (by, n.pos, n.stop)
    t = dom.annotate(dom.tokens(pages))
    inside = {r.id: r.html for r in dom.joined(dom.within(t, dom.pick_article(t)), "html").collect()}
    assert inside[2] == "<div>few<p>words</div>" and inside[4] == "just text" and inside[5] == ""
    assert {r.id: r.picked_by for r in dom.pick_article(t, "div.c#x").collect()}[9] == "selector"


def brute_select(root, parts):
    if not parts:
        return [root]
    tag, ids, classes = parts[-1]
    found = [n for n in root.elements() if (tag is None or n.name == tag) and all(n.attr("id") == i for i in ids) and set(classes) <= set(n.classes())]
    above = brute_select(root, parts[:-1])
    return [n for n in found if len(parts) == 1 or any(a in above for a in B.up(n.parent))]


@pytest.mark.parametrize("selector", ["p", "div p", ".a", "div.a b", "DIV.a  li", "ul li .x", "#one", "div #one", "*.x.y", "article * p"])
def test_selectors_against_trees(spark, selector):
    html, pages = pages_of(spark, 7, [*PARTS, "<b class='x y' id=one>", '<li class="x">'])
    rows = dom.matches(dom.annotate(dom.tokens(pages)), selector).where("matches").collect()
    got = {(r.id, r.pos) for r in rows}
    assert got == {(i, n.pos) for i, h in enumerate(html) for n in brute_select(B.tree(h), dom.compiled(selector))} and got


@pytest.mark.parametrize("selector", ["a > b", "a + b", "a, b", "a[x]", "a:hover", "", " ", "a..b", "#", "1a"])
def test_other_selectors_raise(selector):
    with pytest.raises(ValueError):
        dom.compiled(selector)


def test_best_div_takes_the_first_of_equal_ones(spark):
    html = ["<div>abc</div><div>abd</div>", "<div><p>x</p></div><div>" + "y" * 101 + "</div>", "<div> </div>", "<div><div>inner</div></div>"]
    t = dom.annotate(dom.tokens(spark.createDataFrame(list(enumerate(html)), "page_id long, html string")))
    ids = {r.row: r.id for r in t.collect()}
    got = {ids[r.row]: (r.pos, r.score) for r in dom.best_div(t).collect()}
    assert got == {0: (1, 3), 1: (1, 101), 3: (1, 5)}


def test_pages_with_one_id_stay_apart(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (1, "<p>a"), (1, "<p>c"), (None, "<p>b"), (None, "1\n<p>a")], "page_id long, html string")
    got = dom.joined(dom.annotate(dom.tokens(pages)), "html").collect()
    assert sorted((str(r.id), r.html) for r in got) == [("1", "<p>a"), ("1", "<p>c"), ("None", "1\n<p>a"), ("None", "<p>b")]


def test_long_pages(spark):
    """Many tags without an end, a deep page, one tag of 10 MB, and one without an end."""
    html = ["<p>x" * 30_000, "<div>" * 20_000 + "x", "<meta content='" + "x" * 10_000_000 + "'>end", "<meta content=" + "x" * 10_000_000, "<a b=c " * 100_000]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    rows = dom.annotate(dom.tokens(pages)).groupBy("id").agg(F.count("*").alias("n"), F.max("depth").alias("depth")).collect()
    assert {r.id: (r.n, r.depth) for r in rows} == {0: (60_001, 1), 1: (20_002, 20_000), 2: (3, 0), 3: (3, 0), 4: (200_001, 0)}


def test_no_python_in_the_plan(spark, sf_small):
    t = dom.dom_cleanup(dom.annotate(dom.tokens(spark.read.parquet(f"{sf_small}/pages.parquet"))))
    plan = dom.joined(t, "html")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_partitions_follow_the_bytes_of_html(spark):
    """What one task sorts does not grow with the input: one shuffle, of whole pages, about PIECE_BYTES each."""
    small = spark.range(60).selectExpr("id AS page_id", "concat('<p>', repeat('x', 100000)) AS html")
    large = spark.range(200).selectExpr("id AS page_id", "concat('<p>', repeat('x', 100000)) AS html")
    for pages, n in ((small, 3), (large, 10)):
        assert dom.pieces(pages) == n
        plan = dom.joined(dom.annotate(dom.tokens(pages)), "html")._jdf.queryExecution().executedPlan().toString()
        assert [x for x in plan.splitlines() if "Exchange" in x] == [x for x in plan.splitlines() if f", {n})" in x and "REPARTITION_BY_NUM" in x] and plan.count("Exchange") == 1
    assert dom.pieces(small.where("false")) == 1 and dom.pieces(small.selectExpr("page_id", "NULL AS html")) == 1
