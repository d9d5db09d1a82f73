"""Page metadata and markdown operators, on pages and texts of our own."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sightline.operators import page_meta as M
from sightline.operators import pages as PG


def row(spark, html, build):
    return spark.createDataFrame([(1, html)], "page_id long, html string").select(build(F.col("html")).alias("x")).first().x


HEAD = """<!doctype html><HTML  class=a lang='pt-BR'><head><title>
  Depot &lt;7&gt; &amp;amp; more </title>
<link rel="stylesheet" href="a.css"><link HREF=https://d.example/7 rel=Canonical>
<meta property="og:title" content=""><meta content='Depot "seven"' property='og:title'><meta name="twitter:title" content="T">
<meta name=Description content="a > b"><meta property="article:author" content="Ida"><meta name="author" content="Ole"></head>"""


def test_meta_tags_whatever_their_form(spark):
    got = [(c.source, c.key, c.value) for c in row(spark, HEAD, M.meta_candidates)]
    assert got == [("property", "title", 'Depot "seven"'), ("property", "author", "Ida"), ("name", "title", "T"), ("name", "description", "a > b"), ("name", "author", "Ole")]


def test_fallbacks(spark):
    got = {(c.source, c.key): c.value for c in row(spark, HEAD, M.fallback_candidates)}
    assert got == {("fallback", "title"): "Depot <7> &amp; more", ("fallback", "canonical_url"): "https://d.example/7", ("html_lang", "lang"): "pt-BR"}


@pytest.mark.parametrize("block,want", [
    ('{"@type":"NewsArticle","headline":"H","author":{"name":"Ida"},"url":"u"}', {"title": "H", "author": "Ida", "canonical_url": "u"}),
    ('[{"@type":"Person","headline":"no"},{"@type":["X","TechArticle"],"headline":"H","author":["Ida",{"name":"Ole"}]}]', {"title": "H", "author": "Ida, Ole"}),
    ('{"@type":"Product","headline":"no"}', {}), ("{oops", {}), ("", {}), ('{"@type":"Article","headline":"","description":"d"}', {"description": "d"}),
])
def test_jsonld(spark, block, want):
    html = f'<script>1</script><script type="application/ld+json">{{bad</script><script data-x type=\'application/ld+json\'>\n {block}\n</script>'
    assert {c.key: c.value for c in row(spark, html, M.jsonld_candidates)} == want


def test_merge_order(spark):
    html = HEAD.replace("</head>", '<meta property="og:locale" content="en"><script type="application/ld+json">{"@type":"Article","headline":"LD"}</script></head>')
    pages = spark.createDataFrame([(1, html), (2, HEAD), (3, None), (4, "<p>no head")], "page_id long, html string")
    got = {r.page_id: r for r in M.page_metadata(pages).collect()}
    assert (got[1].title, got[1].lang, got[1].author) == ("LD", "pt-BR", "Ida") and got[2].title == 'Depot "seven"'
    assert all(got[p][f] is None for p in (3, 4) for f in M.META_FIELDS)


def test_boilerplate_images_and_words(spark):
    html = ("<head><title>not counted</title></head><nav>skip <b>me</b></nav><NAV\n>x</NAV><svgx></svgx><button role=button>a</button><div role='button'>b</div>"
            "<p>four words &amp; sign</p><!-- not this --><script>var a = '<p>';</script>"
            "<img src='https://h.example/a/b.tar.gz?q#f'><img src=data:x><img alt=none><img src=pic>")
    assert row(spark, html, M.boilerplate_counts) == 5
    assert row(spark, html, lambda h: PG.word_count(M.content_text(h))) == 5  # the button by role is no strip tag
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = [(r.img_pos, r.src, r.local_name) for r in M.image_manifest(pages).orderBy("img_pos").collect()]
    assert got == [(0, "https://h.example/a/b.tar.gz?q#f", "https___h_example_a_b_tar_gz_q_f.gz"), (1, "pic", "pic.bin")]


@pytest.mark.parametrize("words,minutes", [(0, 1), (374, 1), (375, 2), (376, 2), (625, 2), (626, 3), (1000, 4)])
def test_reading_time(spark, words, minutes):
    assert spark.range(1).select(PG.reading_time(F.lit(words)).alias("m")).first().m == minutes


def test_metadata_job_has_no_shuffle_and_no_python(spark):
    pages = spark.createDataFrame([(1, HEAD)], "page_id long, html string")
    plan = M.page_metadata(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def md(spark, text, build):
    return spark.createDataFrame([(1, text)], "doc_id long, md string").select(build(F.col("md")).alias("x")).first().x


def test_steps_of_normalisation(spark):
    assert md(spark, "a\n```\n \n```\nb\n```py\nx\n```", PG.drop_empty_fences) == "a\n\nb\n```py\nx\n```"
    assert md(spark, " **Depot rules** \nx **B** \n**no**\n**abcd**", PG.promote_bold_headings) == "#### Depot rules\nx **B**\n**no**\n**abcd**"
    assert md(spark, "\n\n text", lambda c: PG.inject_h1(c, F.lit("T"))) == "# T\n\n\n\n text"
    assert md(spark, "\n\n# Own\ntext", lambda c: PG.inject_h1(c, F.lit("T"))) == "\n\n# Own\ntext"
    assert md(spark, "## Sub", lambda c: PG.inject_h1(c, F.lit(""))) == "## Sub"
    assert md(spark, "\n a\n\n\n\nb \n\n", PG.collapse_blank_lines) == "a\n\nb\n"
    assert md(spark, "x", lambda c: PG.front_matter(F.lit('a "b"'), F.lit(None).cast("string"), F.lit("d"), F.lit(""))) == '---\ntitle: "a \\"b\\""\ndate: "d"\n---'


def issues(spark, text, min_len=80):
    df = spark.createDataFrame([(1, text)], "doc_id long, md string")
    return [(r.type, r.line, r.find, r.detected) for r in PG.issue_report(PG.detect_issues(df, "md", min_len)).orderBy("issue_pos").collect()]


def test_fused_text_outside_zones_only(spark):
    run = "q" * 85
    assert issues(spark, f"one\n{run} two") == [("fused text", 2, f"one\\n{run} two", None)]
    for held in (f"```\n{run}\n```", f"[a](http://{run})", f"`{run}`", f"---\nk: {run}\n---\n"):
        assert not [x for x in issues(spark, held) if x[0] == "fused text"]
    assert len(issues(spark, f"{run} a {run}")) == 2 and issues(spark, "q" * 79) == []


def test_other_detectors(spark):
    text = "go\n```\nselect 1 from depots\n```\n<FORM><input id=1> role='x'\n```text\n\n```\nok 1\n```text\nshort\n```"
    got = issues(spark, text)
    assert [(t, line, d) for t, line, _, d in got] == [
        ("HTML leakage", 5, None), ("HTML leakage", 5, None), ("empty code block", 6, None), ("wrong language", 2, "sql"),
        ("suspicious tab label", 1, None), ("suspicious tab label", 11, None)]  # a closing fence counts as a fence too


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, md string")
    out = PG.section_map(PG.detect_issues(df, "md"), "md")
    assert [r.n_issues for r in PG.markdown_summary(out).collect()] == [0, 0]


def test_sections_against_a_model(spark):
    text = "before\n# A  \nx\n\n```\n# in a fence\n```\n###### B b\n#no\n## \n# C"
    lines, want = text.split("\n"), []
    heads = [i for i, x in enumerate(lines) if re.match(r"^#{1,6}\s+.+$", x)]
    for i, end in zip(heads, [*heads[1:], len(lines)]):
        want.append((re.match(r"^#{1,6}\s+(.+)$", lines[i])[1].strip(), i + 1, len("\n".join(lines[i + 1 : end])) // 4))
    df = spark.createDataFrame([(1, text)], "doc_id long, md string")
    got = [(r.title, r.line, r.tokens) for r in PG.sections_long(PG.section_map(df, "md")).orderBy("section_pos").collect()]
    assert got == want


def test_very_long_and_broken_tags(spark):
    long = "x" * 10_000_000
    rows = [(1, f'<meta name="author" content="{long}"><meta name="description" content="d">'), (2, f"<meta name=author content={long}"), (3, f'<meta name="author" content="Ida"><meta content="{long}'),
            (4, "<p>" + "<meta " * 50_000), (5, '<meta name="author" ' + "a=b " * 200_000 + 'content="Ole">')]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = {r.page_id: r.n for r in M.page_metadata(pages).selectExpr("page_id", "length(author) AS n").collect()}
    assert got == {1: 10_000_000, 2: None, 3: 3, 4: None, 5: 3}


def test_quotes_count_after_an_equals_sign_only(spark):
    html = """<img alt=it's src=/a.png><p title='>'>it's</p><img src = "/b.png" alt='x>y'><img data-src=no title=" src=/no.png" src='/c.png'><IMG SRC=/d.png/>"""
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.src for r in M.image_manifest(pages).orderBy("img_pos").collect()] == ["/a.png", "/b.png", "/c.png", "/d.png"]
