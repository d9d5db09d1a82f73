"""Metadata, boilerplate and images of raw web pages (D1–D5, D17–D19), as native columns on ``html``.

Tags are found by regular expression and their attributes read from the tag
text; JSON-LD blocks are parsed by Spark's JSON functions.  Every value found is
a candidate ``(source, key, value)``, and the merge picks by priority, so the
whole job is one projection of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Must equal the reference's for the same results.
# ---------------------------------------------------------------------------
STRIP_TAGS = ("script", "style", "button", "svg", "nav", "footer", "header", "noscript")
JSONLD_ARTICLE_TYPES = ("Article", "BlogPosting", "NewsArticle", "TechArticle")
PROPERTY_FIELDS = {
    "og:title": "title",
    "og:description": "description",
    "og:url": "canonical_url",
    "og:image": "og_image",
    "og:site_name": "site_name",
    "og:locale": "lang",
    "article:author": "author",
    "article:published_time": "date",
}
NAME_FIELDS = {
    "twitter:title": "title",
    "twitter:description": "description",
    "twitter:image": "og_image",
    "author": "author",
    "description": "description",
}
JSONLD_FIELDS = {"title": "headline", "date": "datePublished", "description": "description", "canonical_url": "url"}
META_FIELDS = ("title", "author", "date", "description", "canonical_url", "og_image", "site_name", "lang")

CANDIDATES = "array<struct<source:string,key:string,value:string>>"
#: the inside of a tag up to its end: a quote counts only after an equals sign; possessive, so matching neither recurses nor goes back
IN_TAG = r"""(?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_PAIR = r"""(?s)([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+"""


def tags(html: Column, name: str) -> Column:
    """All opening tags of an element, as they stand."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b{IN_TAG}>"), F.lit(0))


def unescaped(text: Column) -> Column:
    """The five predefined entities, the ampersand last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def attributes(tag: Column) -> Column:
    """``array<struct<name, value>>`` of a tag, names in lower case, values unescaped and stripped (empty without one)."""
    inside = F.regexp_replace(tag, r"^</?[^\s/>]*+|/?>$", "")
    names, values = (F.regexp_extract_all(inside, F.lit(_PAIR), F.lit(k)) for k in (1, 2))
    bare = lambda v: F.trim(unescaped(F.regexp_replace(v, r"""(?s)^(?:"(.*)"|'(.*)')$""", "$1$2")))
    return F.zip_with(names, values, lambda n, v: F.struct(F.lower(n).alias("name"), bare(v).alias("value")))


def valued(found: Column, name: str) -> Column:
    """The first value of that name among :func:`attributes`; null without one."""
    return F.get(F.filter(found, lambda a: (a["name"] == name) & (a["value"] != "")), 0)["value"]


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, unescaped and stripped; null without it."""
    return F.when(F.lower(tag).contains(name), valued(attributes(tag), name))


def _candidate(source: str, key: Column, value: Column) -> Column:
    return F.struct(F.lit(source).alias("source"), key.alias("key"), value.cast("string").alias("value"))


def _known(fields: dict[str, str], name: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in fields.items() for x in pair)), F.lower(name))


def _useful(candidates: Column) -> Column:
    return F.filter(candidates, lambda c: c["key"].isNotNull() & c["value"].isNotNull() & (c["value"] != ""))


def meta_candidates(html: Column) -> Column:
    """Open Graph, article, Twitter, author and description tags: properties first, each in document order."""
    found = F.transform(tags(html, "meta"), attributes)
    by = lambda source, attr, fields: F.transform(found, lambda a: _candidate(source, _known(fields, valued(a, attr)), valued(a, "content")))
    return _useful(F.concat(by("property", "property", PROPERTY_FIELDS), by("name", "name", NAME_FIELDS)))


def _author(item: Column) -> Column:
    raw = F.get_json_object(item, "$.author")
    several = F.from_json(F.when(raw.startswith("["), raw), "array<string>")
    name = lambda a: F.when(a.startswith("{"), F.get_json_object(a, "$.name")).otherwise(a)
    return F.when(raw.startswith("["), F.array_join(F.filter(F.transform(several, name), lambda x: x != ""), ", ")).otherwise(name(raw))


def _is_article(item: Column) -> Column:
    raw = F.get_json_object(item, "$['@type']")
    kinds = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(F.array(raw))
    return F.coalesce(F.arrays_overlap(kinds, F.array(*(F.lit(x) for x in JSONLD_ARTICLE_TYPES))), F.lit(False))


def jsonld_candidates(html: Column) -> Column:
    """Fields of the first JSON-LD article; a block is an object or a list of them, one that can't be read is skipped."""
    blocks = F.regexp_extract_all(html, F.lit(r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json[^>]*>(.*?)</script\s*>"""), F.lit(1))
    items = F.flatten(F.transform(blocks, lambda b: F.coalesce(
        F.when(F.ltrim(b).rlike(r"^\s*\["), F.from_json(b, "array<string>")).otherwise(F.array(b)), F.array().cast("array<string>"))))
    article = F.get(F.filter(items, _is_article), 0)
    values = [_candidate("jsonld", F.lit(key), F.get_json_object(article, f"$.{field}")) for key, field in JSONLD_FIELDS.items()]
    return _useful(F.array(*values, _candidate("jsonld", F.lit("author"), _author(article))))


def fallback_candidates(html: Column) -> Column:
    """D3: the title element, the canonical link and the html element's language (which overrides others)."""
    title = F.trim(F.regexp_replace(unescaped(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)), r"(?U)^\s+|\s+$", ""))
    canonical = F.get(F.filter(tags(html, "link"), lambda t: F.lower(attribute(t, "rel")) == "canonical"), 0)
    return _useful(F.array(
        _candidate("fallback", F.lit("title"), title), _candidate("fallback", F.lit("canonical_url"), attribute(canonical, "href")),
        _candidate("html_lang", F.lit("lang"), attribute(F.get(tags(html, "html"), 0), "lang"))))


def candidates(html: Column) -> Column:
    """All of them, by falling priority."""
    html = F.coalesce(html, F.lit(""))
    return F.concat(jsonld_candidates(html), meta_candidates(html), fallback_candidates(html))


def merge_metadata(df: DataFrame, col: str = "candidates") -> DataFrame:
    """Per field the first candidate; the html element's language goes before any other."""
    first = lambda keep: F.get(F.filter(col, keep), 0)["value"]
    fields = {k: first(_key(k)) for k in META_FIELDS}
    fields["lang"] = F.coalesce(first(lambda c: c["source"] == "html_lang"), fields["lang"])
    return df.withColumns(fields)


def _key(name: str):
    return lambda c: c["key"] == name


def page_metadata(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the merged fields in place of the html."""
    found = pages.withColumn("candidates", candidates(F.col(html_col))).drop(html_col)
    return merge_metadata(found).drop("candidates")


def boilerplate_counts(html: Column) -> Column:
    """Elements that are no content, by tag and as buttons by role."""
    by_tag = F.regexp_count(html, F.lit(rf"(?i)<({'|'.join(STRIP_TAGS)})[\s/>]"))
    role = r"""\b[^>]*\srole\s*=\s*["']?button\b"""
    by_role = F.regexp_count(html, F.lit(rf"(?is)<[a-z][a-z0-9]*{role}")) - F.regexp_count(html, F.lit(rf"(?is)<({'|'.join(STRIP_TAGS)}){role}"))
    return F.coalesce(by_tag + by_role, F.lit(0)).cast("int")


def content_text(html: Column) -> Column:
    """The text without boilerplate elements, comments and tags."""
    for tag in STRIP_TAGS:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    html = F.regexp_replace(html, r"(?is)<!--.*?-->|<head\b.*?</head\s*>", " ")
    return unescaped(F.regexp_replace(html, r"(?s)<[^>]*>", " "))


def image_manifest(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per image with a source that is not inline: place, source, local file name."""
    sources = F.transform(tags(F.col(html_col), "img"), lambda t: attribute(t, "src"))
    shown = F.filter(sources, lambda s: s.isNotNull() & (s != "") & ~s.startswith("data:"))
    rows = pages.select(id_col, F.posexplode_outer(shown).alias("img_pos", "src")).where("img_pos IS NOT NULL")
    path = F.regexp_extract(F.regexp_replace("src", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"^([^?#]*)", 1)
    ext = F.regexp_extract(F.regexp_extract(path, r"([^/]*)$", 1), r"^.+(\.[^.]+)$", 1)
    local = F.concat(F.right(F.regexp_replace("src", r"[^a-zA-Z0-9]", "_"), F.lit(40)), F.when(ext == "", F.lit(".bin")).otherwise(ext))
    return rows.select(id_col, "img_pos", "src", local.alias("local_name"))
