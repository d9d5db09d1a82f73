"""Registered queries over ``pages``: metadata, boilerplate, images, reading time.

The given pages have a title and a language but no other metadata, so every
page gets tags built from its own id and address (``rich_pages``), whole
table; the twins state what must be read back from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.langs import sniff_language_col
from sightline.operators import page_meta as M
from sightline.operators import pages as PG
from sightline.plans.catalog import register
from sightline.sources.tables import page_source_table, read_table

_LD = """'<script type="application/ld+json">[{"@type":"Person"},{"@type":["Thing","BlogPosting"],"headline":"LD ' || page_id || '","author":[{"name":"A"},"B ' || page_id || '"],"datePublished":"2024-01-01"}]</script><script type="application/ld+json">{bad</script>'"""
_HEAD = f"""'<link rel="canonical" href="' || url || '">'
  || CASE WHEN page_id % 2 = 0 THEN '<meta property="og:title" content="OG ' || page_id || ' &amp; co"><meta content="about ' || page_id || '" name="description">' ELSE '' END
  || CASE WHEN page_id % 3 = 0 THEN {_LD} ELSE '' END
  || CASE WHEN page_id % 5 = 0 THEN '<META NAME="author" CONTENT="meta author"><meta property="og:locale" content="xx">' ELSE '' END"""
_FOOT = """'<img src="https://cdn.example.com/a/' || page_id || '.png?x=1"><img alt="a > b"><img src="data:image/png;base64,x"><img src=/rel/pic-' || page_id || '>'
  || CASE WHEN page_id % 4 = 0 THEN '<div class="x" role="button">go</div>' ELSE '' END"""
_RICH = f"replace(replace(html, '</head>', {_HEAD} || '</head>'), '</article>', {_FOOT} || '</article>')"

_ENTITY_FIX = (
    "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), "
    "'&amp;', '&')"
)
_TITLE = ("regexp_replace(" + _ENTITY_FIX.format(x="regexp_extract(html, '<title>([^<]*)</title>', 1)")
          + ", '^\\s+|\\s+$', '', 'g')")
_LANG = "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)"


def rich_pages(spark, d) -> DataFrame:
    p = page_source_table(read_table(spark, d, "pages"))
    # a backslash or quote in these literals would mean something else in the two dialects; there is none
    return p.select("page_id", "url", F.expr(_RICH).alias("html"))


@register(
    "page_metadata",
    f"""SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN 'LD ' || page_id WHEN page_id % 2 = 0 THEN 'OG ' || page_id || ' & co'
               WHEN {_TITLE} <> '' THEN {_TITLE} END AS title,
        CASE WHEN page_id % 3 = 0 THEN 'A, B ' || page_id WHEN page_id % 5 = 0 THEN 'meta author' END AS author,
        CASE WHEN page_id % 3 = 0 THEN '2024-01-01' END AS date, CASE WHEN page_id % 2 = 0 THEN 'about ' || page_id END AS description,
        url AS canonical_url, CAST(NULL AS VARCHAR) AS og_image, CAST(NULL AS VARCHAR) AS site_name, {_LANG} AS lang FROM pages""",
)
def _metadata(spark, d):
    """The merged fields of each page."""
    return M.page_metadata(rich_pages(spark, d))


def _candidates(spark, d, build):
    x = rich_pages(spark, d).select("page_id", F.posexplode_outer(build(F.col("html"))).alias("pos", "c")).where("c IS NOT NULL")
    return x.select("page_id", "pos", "c.source", "c.key", "c.value")


@register(
    "meta_jsonld",
    """SELECT page_id, CAST(p AS INTEGER) AS pos, 'jsonld' AS source, k AS key, CASE k WHEN 'title' THEN 'LD ' || page_id WHEN 'date' THEN '2024-01-01' ELSE 'A, B ' || page_id END AS value
       FROM pages, (VALUES (0, 'title'), (1, 'date'), (2, 'author')) v(p, k) WHERE page_id % 3 = 0""",
)
def _meta_jsonld(spark, d):
    """JSON-LD article fields (in a list, with a list type; a broken block is skipped)."""
    return _candidates(spark, d, M.jsonld_candidates)


@register(
    "meta_tags",
    """SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY o) - 1 AS INTEGER) AS pos, source, key, value FROM (
         SELECT page_id, 0 AS o, 'property' AS source, 'title' AS key, 'OG ' || page_id || ' & co' AS value FROM pages WHERE page_id % 2 = 0
         UNION ALL SELECT page_id, 1, 'property', 'lang', 'xx' FROM pages WHERE page_id % 5 = 0
         UNION ALL SELECT page_id, 2, 'name', 'description', 'about ' || page_id FROM pages WHERE page_id % 2 = 0
         UNION ALL SELECT page_id, 3, 'name', 'author', 'meta author' FROM pages WHERE page_id % 5 = 0)""",
)
def _meta_tags(spark, d):
    """Meta tags, properties first, whatever the order and case of their attributes."""
    return _candidates(spark, d, M.meta_candidates)


@register(
    "meta_fallback",
    f"""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY o) - 1 AS INTEGER) AS pos, source, key, value FROM (
         SELECT page_id, 0 AS o, 'fallback' AS source, 'title' AS key, {_TITLE} AS value FROM pages
         UNION ALL SELECT page_id, 1, 'fallback', 'canonical_url', url FROM pages UNION ALL SELECT page_id, 2, 'html_lang', 'lang', {_LANG} FROM pages) WHERE value <> ''""",
)
def _meta_fallback(spark, d):
    """D3: ``<title>``, canonical link and ``<html lang>`` per page."""
    return _candidates(spark, d, M.fallback_candidates)


@register(
    "strip_boilerplate",
    "SELECT page_id, CAST(len(regexp_extract_all(lower(html), '<(script|style|button|svg|nav|footer|header|noscript)[\\s/>]')) "
    "+ 2 * (page_id % 3 = 0)::INT + (page_id % 4 = 0)::INT AS INTEGER) AS removed FROM pages",
)
def _strip_boilerplate(spark, d):
    """Boilerplate elements per page, by tag and by role."""
    return rich_pages(spark, d).select("page_id", M.boilerplate_counts(F.col("html")).alias("removed"))


@register(
    "image_manifest",
    """SELECT page_id, CAST(0 AS INTEGER) AS img_pos, 'https://cdn.example.com/a/' || page_id || '.png?x=1' AS src,
              right('https___cdn_example_com_a_' || page_id || '_png_x_1', 40) || '.png' AS local_name FROM pages WHERE html LIKE '%</article>%'
       UNION ALL SELECT page_id, 1, '/rel/pic-' || page_id, '_rel_pic_' || page_id || '.bin' FROM pages WHERE html LIKE '%</article>%'""",
)
def _images(spark, d):
    """Images of the pages; inline ones and those without a source are left out."""
    return M.image_manifest(rich_pages(spark, d))


def _text_sql() -> str:
    x = "html"
    for tag in M.STRIP_TAGS:
        x = f"regexp_replace({x}, '(?is)<{tag}\\b.*?</{tag}\\s*>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<!--.*?-->|<head\\b.*?</head\\s*>', ' ', 'g')"
    return _ENTITY_FIX.format(x=f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')")


@register(
    "reading_time",
    f"""SELECT page_id, n AS word_count, greatest(1, CAST(round_even(n / 250.0, 0) AS INTEGER)) AS reading_time_minutes
        FROM (SELECT page_id, CAST(len(regexp_extract_all({_text_sql()}, '\\S+')) AS INTEGER) AS n FROM pages)""",
)
def _reading_time(spark, d):
    """Words outside boilerplate and reading minutes per page."""
    pages = page_source_table(read_table(spark, d, "pages"))
    x = pages.select("page_id", PG.word_count(M.content_text(F.col("html"))).alias("word_count"))
    return x.withColumn("reading_time_minutes", PG.reading_time(F.col("word_count")))


# a snippet of each language, and one of none, by the document's id
_SNIPPETS = (
    ("toml", "'[tool.' || source || ']' || chr(10) || 'name = 1'"), ("bash", "'npm run ' || source"), ("json", "'  {\"id\": ' || doc_id || '}'"), ("tsx", "'return <Panel id=' || doc_id || ' />'"),
    ("sql", "'select ' || doc_id || ' from ' || source"), ("typescript", "'let a: number = ' || doc_id"), ("javascript", "'export default function f' || doc_id || '() {}'"),
    ("python", "'def f' || doc_id || '(a):' || chr(10) || '    return a'"), ("javascript", "'x => ' || doc_id"), ("css", "'body {' || chr(10) || '  margin: ' || doc_id"), ("text", "'words of ' || source"), ("text", "'  '"),
)


@register("code_language", f"SELECT doc_id, CASE doc_id % {len(_SNIPPETS)} " + " ".join(f"WHEN {i} THEN '{lang}'" for i, (lang, _) in enumerate(_SNIPPETS)) + " END AS lang FROM documents")
def _code_language(spark, d):
    """The native rule table on a snippet of every document, each rule in turn."""
    snippet = F.expr(f"CASE doc_id % {len(_SNIPPETS)} " + " ".join(f"WHEN {i} THEN {code}" for i, (_, code) in enumerate(_SNIPPETS)) + " END")
    return read_table(spark, d, "documents").select("doc_id", sniff_language_col(snippet).alias("lang"))


@register("code_language_counts")
def _code_language_counts(spark, d):
    """D22 over whole document texts: documents per sniffed language."""
    docs = read_table(spark, d, "documents")
    return docs.groupBy(sniff_language_col(F.col("text")).alias("lang")).agg(F.count(F.lit(1)).alias("docs"))
