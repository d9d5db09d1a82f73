"""Markdown texts → normalised text, issues, sections and summary (E1–E17), as native columns.

Texts are independent rows: normalisation, the detectors, the section map and
the summary add columns to them, without a shuffle.  Places and lines of regex matches come from
``functions.spans``, in time that grows with their number.  Page metadata is in ``operators.page_meta``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.langs import py_lstrip, py_rstrip, py_strip, sniff_language_col
from sightline.functions.spans import apart, let, spans


def word_count(text: Column) -> Column:
    """Whitespace-separated words."""
    s = py_strip(text)
    return F.when(s.isNull() | (s == ""), F.lit(0)).otherwise(F.size(F.split(s, r"(?U)\s+")))


def reading_time(words: Column) -> Column:
    """max(1, round-half-even(words / 250))."""
    return F.greatest(F.lit(1), F.bround(words / 250.0, 0).cast("int"))


# Fixed value: a line that stands for a heading.
_BOLD = r"^\*\*([A-Z][^*]{3,80})\*\*$"


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def front_matter(title: Column, author: Column, date: Column, source: Column) -> Column:
    """``---`` header with the fields that are present (title quotes escaped)."""
    def line(key: str, val: Column) -> Column:
        return F.when(_truthy(val), F.concat(F.lit(f'{key}: "'), val, F.lit('"')))

    return F.concat_ws(
        "\n", F.lit("---"),
        line("title", F.replace(title, F.lit('"'), F.lit('\\"'))),
        line("author", author), line("date", date), line("source", source),
        F.lit("---"),
    )


# Fixed value: an empty fenced block, as the reference finds it.
_EMPTY_FENCE = r"(?U)```[a-z]*\n\s*\n?```"


def drop_empty_fences(md: Column) -> Column:
    """Fenced blocks with only white space go."""
    return F.regexp_replace(md, _EMPTY_FENCE, "")


def promote_bold_headings(md: Column) -> Column:
    """A line that is only ``**Capitalised text**`` becomes ``#### …``; other lines are right-trimmed."""
    return F.array_join(F.transform(F.split(md, "\n", -1), lambda l: F.when(
        py_strip(l).rlike(_BOLD), F.concat(F.lit("#### "), F.regexp_extract(py_strip(l), _BOLD, 1))).otherwise(py_rstrip(l))), "\n")


def inject_h1(md: Column, title: Column) -> Column:
    """``# title`` in front, unless the first line with text is a ``# `` heading or there is no title."""
    first = F.coalesce(F.regexp_extract(py_lstrip(md), r"^([^\n]*)", 1), F.lit(""))
    return F.when(~first.startswith("# ") & _truthy(title), F.concat(F.lit("# "), title, F.lit("\n\n"), md)).otherwise(md)


def collapse_blank_lines(md: Column) -> Column:
    """E5: three or more line ends become two; stripped, with one line end."""
    return F.concat(py_strip(F.regexp_replace(md, r"\n{3,}", "\n\n")), F.lit("\n"))


def normalize_markdown(df: DataFrame, md_col: str, out_col: str = "markdown", title: str = "title", author: str = "author",
                       date: str = "date", source: str = "canonical_url") -> DataFrame:
    """E1–E5 on one markdown column.

    Successive columns on purpose: each intermediate text is used more than
    once, and a separate projection per step lets Catalyst compute it once.
    """
    x = df.withColumn("__1", drop_empty_fences(F.col(md_col)))
    x = x.withColumn("__2", promote_bold_headings(F.col("__1")))
    x = x.withColumn("__3", inject_h1(F.col("__2"), F.col(title)))
    head = front_matter(F.col(title), F.col(author), F.col(date), F.col(source))
    return x.withColumn(out_col, F.concat(head, F.lit("\n\n"), collapse_blank_lines(F.col("__3")))).drop("__1", "__2", "__3")


# -- detectors (E6–E12) ------------------------------------------------------

# Patterns that must equal the reference's for the same results.
FENCE_RE = (r"^```[^\n]*\n.*?^```", "MS")
FENCE_LANG_RE = (r"^```(\w*)\n(.*?)^```", "MS")
LINK_URL_RE = (r"\]\([^\)]+\)", "")
INLINE_CODE_RE = (r"`[^`]+`", "")
FRONT_MATTER_RE = (r"\A---\n.*?^---", "MS")
HTML_LEAK_RE = (r"<(svg|button|input|form)\b|role=[\"']", "")
EMPTY_FENCE_RE = (r"```[a-z]*\n\s*\n?```", "")


def line_of(md: Column, offset: Column) -> Column:
    """1-based line of a 0-based character offset."""
    pre = F.substring(md, F.lit(1), offset)
    return (F.length(pre) - F.length(F.replace(pre, F.lit("\n"), F.lit(""))) + 1).cast("int")


def context_around(md: Column, start: Column, end: Column, ctx: int = 40) -> Column:
    """Text from start-ctx to end+ctx, clipped, newlines shown as ``\\n``."""
    s = F.greatest(start - ctx, F.lit(0))
    e = F.least(F.length(md), end + ctx)
    return F.replace(F.substring(md, s + 1, e - s), F.lit("\n"), F.lit("\\n"))


def _found(pattern: tuple[str, str], md: Column, maybe: Column, groups: int = 0, context: int | None = None) -> Column:
    """Matches of ``pattern`` in texts where ``maybe`` (a cheap test that admits every text that could match) holds."""
    return spans(F.when(maybe, md), f"(?dU{pattern[1].lower()}){pattern[0]}", groups, context)


def exclusion_zones(md: Column) -> Column:
    """Spans (``start, end``) of fences, link URLs, inline code and front matter, in order of their starts."""
    kinds = ((FENCE_RE, md.contains("```")), (LINK_URL_RE, md.contains("](")), (INLINE_CODE_RE, md.contains("`")), (FRONT_MATTER_RE, md.startswith("---\n")))
    return F.array_sort(F.concat(*(F.transform(_found(pattern, md, maybe), lambda s: F.struct(s["start"], s["end"])) for pattern, maybe in kinds)))


ISSUES = "array<struct<type:string,line:int,find:string,detected:string,fix:string>>"


def _issue(type_: str, line: Column, find: Column | None, detected: Column | None, fix: Column) -> Column:
    return F.struct(
        F.lit(type_).alias("type"), line.alias("line"),
        (find if find is not None else F.lit(None).cast("string")).alias("find"),
        (detected if detected is not None else F.lit(None).cast("string")).alias("detected"),
        fix.alias("fix"),
    )


def _located(found: Column, type_: str, fix: str) -> Column:
    return F.transform(found, lambda s: _issue(type_, s["line"], s["find"], None, F.lit(fix)))


def fused_text(df: DataFrame, md_col: str, min_len: int = 80) -> DataFrame:
    """Adds ``fused``: runs of ``min_len`` non-space characters outside the exclusion zones."""
    md = F.col(md_col)
    long = md.rlike(rf"(?U)\S{{{min_len},}}")  # zones matter only where there is a run
    runs = _found((rf"\S{{{min_len},}}", ""), md, long, context=40)
    free = let(runs, lambda r: F.when(F.size(r) == 0, r).otherwise(apart(r, exclusion_zones(md))))
    return df.withColumn("fused", _located(free, "fused text", "verify whitespace between tokens"))


def html_leaks(df: DataFrame, md_col: str) -> DataFrame:
    """Adds ``leaks``: HTML that is left in the text."""
    md = F.col(md_col)
    found = _found(HTML_LEAK_RE, md, md.contains("<") | md.contains("role="), context=40)
    return df.withColumn("leaks", _located(found, "HTML leakage", "remove or convert to markdown"))


def empty_fences(df: DataFrame, md_col: str) -> DataFrame:
    """Adds ``empties``: fenced blocks without text."""
    md = F.col(md_col)
    return df.withColumn("empties", _located(_found(EMPTY_FENCE_RE, md, md.contains("```"), context=20), "empty code block", "remove empty fence"))


def wrong_languages(df: DataFrame, md_col: str) -> DataFrame:
    """Adds ``mislabelled``: unlabelled or ``text`` fences of 8 characters or more whose rules name a language."""
    md = F.col(md_col)
    df = df.withColumn("__fences", F.transform(_found(FENCE_LANG_RE, md, md.contains("```"), groups=2), lambda s: F.struct(
        s["line"], s["g1"].alias("lang"), py_strip(s["g2"]).alias("body"))))
    named = F.transform(F.filter("__fences", lambda f: f["lang"].isin("", "text") & (F.length(f["body"]) >= 8)),
                        lambda f: f.withField("sniffed", sniff_language_col(f["body"])))
    found = F.transform(F.filter(named, lambda f: f["sniffed"] != "text"), lambda f: _issue(
        "wrong language", f["line"], None, f["sniffed"], F.concat(F.lit("change fence to ```"), f["sniffed"])))
    return df.withColumn("mislabelled", found).drop("__fences")


def tab_labels(df: DataFrame, md_col: str) -> DataFrame:
    """Adds ``labels``: lines of 2–15 letters directly before a fence."""
    md = F.col(md_col)
    df = df.withColumn("__lines", F.when(md.contains("```"), F.split(md, "\n", -1)))
    n = F.size("__lines")
    places = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    at = lambda i: py_strip(F.get(F.col("__lines"), i))
    found = F.transform(F.filter(places, lambda i: at(i).rlike(r"^(?i)[a-z]{2,15}$") & at(i + 1).startswith("```")), lambda i: _issue(
        "suspicious tab label", (i + 1).cast("int"), F.concat(at(i), F.lit("\\n"), at(i + 1)), None, F.lit("merge as prose prefix or remove")))
    return df.withColumn("labels", found).drop("__lines")


def detect_issues(df: DataFrame, md_col: str = "markdown", min_len: int = 80) -> DataFrame:
    """Adds ``issues``: those of all five detectors, in their fixed order."""
    df = fused_text(df, md_col, min_len)
    for detector in (html_leaks, empty_fences, wrong_languages, tab_labels):
        df = detector(df, md_col)
    names = ("fused", "leaks", "empties", "mislabelled", "labels")
    return df.withColumn("issues", F.concat(*(F.coalesce(n, F.array().cast(ISSUES)) for n in names))).drop(*names)


_HEADING = r"(?dU)^(#{1,6})\s+(.+)$"

def section_map(df: DataFrame, md_col: str = "markdown") -> DataFrame:
    """``sections`` = headings with 1-based line and tokens = len(body) // 4.

    Per-row array work (no explode/shuffle): the body of a section is the
    lines after its heading up to the next heading; ``#`` lines inside code
    fences count as headings, as in the reference.
    """
    lines = F.split(F.col(md_col), "\n", -1)
    df = df.withColumn("__l", lines)
    df = df.withColumn(
        "__h",
        F.filter(F.transform(F.col("__l"), lambda l, i: F.struct(i.alias("i"), l.alias("l"))),
                 lambda x: x["l"].rlike(_HEADING)),
    )
    nh = F.size("__h")

    def section(h: Column, k: Column) -> Column:
        start = h["i"] + 1
        end = F.when(k + 1 < nh, F.get(F.col("__h"), k + 1)["i"]).otherwise(F.size("__l"))
        body = F.slice(F.col("__l"), start + 1, end - start)
        text_len = F.aggregate(body, F.lit(0), lambda acc, l: acc + F.length(l)) + F.greatest(F.size(body) - 1, F.lit(0))
        return F.struct(
            py_strip(F.regexp_extract(h["l"], _HEADING, 2)).alias("title"),
            start.cast("int").alias("line"),
            F.floor(text_len / 4).cast("int").alias("tokens"),
        )

    return df.withColumn("sections", F.transform(F.col("__h"), section)).drop("__l", "__h")


def markdown_summary(processed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Total tokens, sections, issues and the next action of each text."""
    tokens = F.aggregate(F.col("sections"), F.lit(0), lambda a, s: a + s["tokens"])
    n_issues = F.size("issues")
    return processed.select(
        id_col, tokens.cast("int").alias("tokens"), F.size("sections").alias("n_sections"), n_issues.alias("n_issues"),
        F.when(n_issues > 0, F.lit("fix")).otherwise(F.lit("clean")).alias("next"))


def issue_report(processed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """E12 long form: one row per issue, ``issue_pos`` keeps the detector order."""
    # posexplode_outer + filter: a plain posexplode makes Catalyst infer a
    # size(issues) > 0 filter and push it below the projections, which would
    # evaluate the whole detector chain twice.
    return processed.select(id_col, F.posexplode_outer("issues").alias("issue_pos", "i")).where(
        F.col("issue_pos").isNotNull()).select(id_col, "issue_pos", "i.type", "i.line", "i.find", "i.detected", "i.fix")


def sections_long(processed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """E15 long form: one row per section."""
    return processed.select(id_col, F.posexplode_outer("sections").alias("section_pos", "s")).where(
        F.col("section_pos").isNotNull()).select(id_col, "section_pos", "s.title", "s.line", "s.tokens")
