"""Registered queries over documents and conversations (E on plain text, F, G)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from sightline.operators import pages as PG
from sightline.operators import workitems as W
from sightline.plans.catalog import register
from sightline.session import checkpoint_dir
from sightline.sources import feedback as FB
from sightline.sources.tables import read_table
from sightline.streaming import feedback_stream as FS

_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# Markdown made of every whole document: header, a bold line, blank lines, fences of all kinds, leftover HTML, status
# marks and sections around the text, from the row's own columns.  The same expression stands in the twins.
_MD = """'---' || chr(10) || 'title: "' || source || ' ' || doc_id || '"' || chr(10) || 'version: "1.' || doc_id % 10 || '.0"' || chr(10) || '---' || chr(10) || chr(10)
  || '**Notes from source ' || source || '**  ' || chr(10) || chr(10) || chr(10) || chr(10) || text || chr(10) || chr(10)
  || CASE WHEN doc_id % 3 = 0 THEN '```' || chr(10) || ' ' || chr(10) || '```' || chr(10) || 'Then on.' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 4 = 0 THEN '```' || chr(10) || 'SELECT doc_id FROM ' || source || chr(10) || '```' || chr(10) || 'Then on.' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 5 = 0 THEN 'bash' || chr(10) || '```bash' || chr(10) || 'npm run ' || source || chr(10) || '```' || chr(10) || 'Then on.' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 6 = 0 THEN '```mermaid' || chr(10) || 'flowchart TD' || chr(10) || 'A --> B' || chr(10) || '```' || chr(10) || 'Then on.' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 7 = 0 THEN '<svg role="img"> ' || doc_id || chr(10) || '<button>' || chr(10) ELSE '' END
  || '## Status' || chr(10) || '[DECIDED] ' || lang || ' [OPEN] [OPEN]' || chr(10) || '## End ' || doc_id || chr(10) || '- [PROPOSED] done' || chr(10)"""
_RAW = f"(SELECT doc_id, source, {_MD} AS md FROM documents)"


def prepared(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", "source", F.expr(_MD).alias("md"))


def _located(pattern: str) -> str:
    """Line of each match of a pattern, from the pieces between matches."""
    lines = "list_sum(list_transform({x}, lambda p: length(p) - length(replace(p, chr(10), ''))))"
    return (f"SELECT doc_id, CAST(1 + {lines.format(x='ps[1:k]')} + coalesce({lines.format(x='ms[1:k - 1]')}, 0) AS INTEGER) AS line, ms[k] AS hit FROM ("
            f"SELECT *, unnest(generate_series(1, len(ms))) AS k FROM (SELECT doc_id, regexp_extract_all(md, '{pattern}') AS ms, regexp_split_to_array(md, '{pattern}') AS ps FROM {_RAW}))")


_BOLD_DUCK = "'^\\*\\*([A-Z][^*]{3,80})\\*\\*$'"
_FENCE = "```[a-z]*\\n\\s*\\n?```"
_LEAK = "<(?:svg|button|input|form)\\b|role=[\"'']"
_E1 = f"regexp_replace(md, '{_FENCE}', '', 'g')"
_E2 = ("array_to_string(list_transform(string_split({x}, chr(10)), lambda l: CASE WHEN regexp_matches(" + _STRIP.format(x="l") + f", {_BOLD_DUCK}) "
       "THEN '#### ' || regexp_extract(" + _STRIP.format(x="l") + f", {_BOLD_DUCK}, 1) ELSE regexp_replace(l, '\\s+$', '') END), chr(10))")
_E5 = _STRIP.format(x="regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')") + " || chr(10)"


def _whole(out):
    return F.sha2(out, 256).alias("sha256"), F.length(out).alias("n_chars")


def _whole_sql(out: str) -> str:
    return f"SELECT doc_id, sha256(o) AS sha256, CAST(length(o) AS INTEGER) AS n_chars FROM (SELECT doc_id, {out} AS o FROM {_RAW})"


@register("drop_empty_fences", _whole_sql(_E1))
def _drop_empty(spark, d):
    """The whole text after empty fences went, by hash."""
    return prepared(spark, d).select("doc_id", *_whole(PG.drop_empty_fences(F.col("md"))))


@register("promote_bold_headings", _whole_sql(_E2.replace("{x}", "md")))
def _bold(spark, d):
    """The whole text with bold lines as headings, by hash."""
    return prepared(spark, d).select("doc_id", *_whole(PG.promote_bold_headings(F.col("md"))))


@register("inject_h1", _whole_sql("'# ' || source || chr(10) || chr(10) || md"))
def _inject(spark, d):
    """The whole text under its title (no text starts with a heading), by hash."""
    return prepared(spark, d).select("doc_id", *_whole(PG.inject_h1(F.col("md"), F.col("source"))))


@register("collapse_blank_lines", _whole_sql(_E5.format(x="md")))
def _collapse(spark, d):
    """E5: the whole text with single blank lines, by hash."""
    return prepared(spark, d).select("doc_id", *_whole(PG.collapse_blank_lines(F.col("md"))))


_HEAD_SQL = "'---' || chr(10) || 'title: \"' || source || '\"' || chr(10) || 'source: \"s' || doc_id || '\"' || chr(10) || '---'"


@register("front_matter", _whole_sql(_HEAD_SQL))
def _header(spark, d):
    """The header of the fields that are present."""
    none = F.lit(None).cast("string")
    return prepared(spark, d).select("doc_id", *_whole(PG.front_matter(F.col("source"), none, F.lit(""), F.concat(F.lit("s"), F.col("doc_id").cast("string")))))


@register("normalize_markdown", _whole_sql(f"{_HEAD_SQL} || chr(10) || chr(10) || " + _E5.format(x="'# ' || source || chr(10) || chr(10) || " + _E2.replace("{x}", _E1))))
def _normalized(spark, d):
    """E1–E5 by the operator that composes them."""
    return _processed_md(spark, d).select("doc_id", *_whole(F.col("markdown")))


def _processed_md(spark, d):
    x = prepared(spark, d).withColumns({"author": F.lit(None).cast("string"), "date": F.lit(""), "src": F.concat(F.lit("s"), F.col("doc_id").cast("string"))})
    return PG.normalize_markdown(x, "md", title="source", source="src")


_SECTIONS = f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS section_pos,
  regexp_replace(regexp_extract(l, '^(#{{1,6}})\\s+(.+)$', 2), '\\s+$', '') AS title, CAST(i AS INTEGER) AS line,
  CAST(greatest(0, coalesce(list_sum(list_transform(ls[i + 1:e], lambda x: length(x))), 0) + greatest(len(ls[i + 1:e]) - 1, 0)) // 4 AS INTEGER) AS tokens
  FROM (SELECT *, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - 1, len(ls)) AS e FROM (
    SELECT doc_id, ls, unnest(ls) AS l, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, string_split(md, chr(10)) AS ls FROM {_RAW}))
    WHERE regexp_matches(l, '^(#{{1,6}})\\s+(.+)$'))"""


@register("section_map", _SECTIONS)
def _sections(spark, d):
    """Every section of the prepared texts."""
    return PG.sections_long(PG.section_map(prepared(spark, d), "md"))


def _hits(detector, column, *args):
    def run(spark, d):
        x = detector(prepared(spark, d), "md", *args).select("doc_id", F.explode_outer(column).alias("i")).where("i IS NOT NULL")
        return x.select("doc_id", "i.line", F.coalesce("i.detected", F.lit("")).alias("detected"), "i.fix")

    return run


def _hits_sql(pattern: str, fix: str) -> str:
    return f"SELECT doc_id, line, '' AS detected, '{fix}' AS fix FROM ({_located(pattern)})"


register("detect_fused_text", _hits_sql("\\S{20,}", "verify whitespace between tokens"))(_hits(PG.fused_text, "fused", 20))
register("detect_fused_text_80", _hits_sql("\\S{80,}", "verify whitespace between tokens"))(_hits(PG.fused_text, "fused"))
register("detect_html_leak", _hits_sql(_LEAK, "remove or convert to markdown"))(_hits(PG.html_leaks, "leaks"))
register("detect_empty_fence", _hits_sql(_FENCE, "remove empty fence"))(_hits(PG.empty_fences, "empties"))
register("detect_wrong_language", "SELECT doc_id, line, 'sql' AS detected, 'change fence to ```sql' AS fix FROM (" + _located("```\\nSELECT") + ")")(
    _hits(PG.wrong_languages, "mislabelled"))
register("detect_tab_label", "SELECT doc_id, line + 1 AS line, '' AS detected, 'merge as prose prefix or remove' AS fix FROM (" + _located("\\nbash\\n```bash") + ")")(
    _hits(PG.tab_labels, "labels"))


@register(
    "context_snippet",
    f"""SELECT doc_id, replace(substr(md, greatest(s - 40, 0) + 1, least(length(md), s + 10 + 40) - greatest(s - 40, 0)), chr(10), '\\n') AS find
        FROM (SELECT doc_id, md, strpos(md, '[PROPOSED]') - 1 AS s FROM {_RAW})""",
)
def _context(spark, d):
    """40 characters around a mark of each text."""
    md = F.col("md")
    start = F.instr(md, "[PROPOSED]") - 1
    return prepared(spark, d).select("doc_id", PG.context_around(md, start, start + 10).alias("find"))


def _placed(pattern: str) -> str:
    """Start and end of each match of a pattern, from the pieces between matches."""
    total = "coalesce(list_sum(list_transform({x}, lambda p: length(p))), 0)"
    return (f"SELECT doc_id, CAST({total.format(x='ps[1:k]')} + {total.format(x='ms[1:k - 1]')} AS INTEGER) AS s, CAST(length(ms[k]) AS INTEGER) AS n FROM ("
            f"SELECT *, unnest(generate_series(1, len(ms))) AS k FROM (SELECT doc_id, regexp_extract_all(md, '{pattern}') AS ms, regexp_split_to_array(md, '{pattern}') AS ps FROM {_RAW}))")


_ZONES = " UNION ALL ".join(_placed(p) for p in ("(?ms)^```[^\\n]*\\n.*?^```", "\\]\\([^\\)]+\\)", "`[^`]+`", "(?ms)\\A---\\n.*?^---"))


@register("exclusion_zones", f'SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s, n) - 1 AS INTEGER) AS zone_pos, s AS "start", s + n AS "end" FROM ({_ZONES})')
def _zones(spark, d):
    """All zones of the prepared texts, in order."""
    x = prepared(spark, d).select("doc_id", F.posexplode_outer(PG.exclusion_zones(F.col("md"))).alias("zone_pos", "z")).where("zone_pos IS NOT NULL")
    return x.select("doc_id", "zone_pos", "z.start", "z.end")


def _issues_md(spark, d):
    return PG.section_map(PG.detect_issues(prepared(spark, d), "md"), "md")


_COUNTS = f"""SELECT doc_id, CAST(len(regexp_extract_all(md, '\\S{{80,}}')) + 3 * (doc_id % 7 = 0)::INT + (doc_id % 3 = 0)::INT + (doc_id % 4 = 0)::INT
  + (doc_id % 5 = 0)::INT AS INTEGER) AS n_issues FROM {_RAW}"""


@register("markdown_summary", f"SELECT doc_id, tokens, n_sections, n_issues, CASE WHEN n_issues > 0 THEN 'fix' ELSE 'clean' END AS next FROM ({_COUNTS}) "
          f"JOIN (SELECT doc_id, CAST(sum(tokens) AS INTEGER) AS tokens, CAST(count(*) AS INTEGER) AS n_sections FROM ({_SECTIONS}) GROUP BY doc_id) USING (doc_id)")
def _md_summary(spark, d):
    """E16 on the prepared texts."""
    return PG.markdown_summary(_issues_md(spark, d))


_ALL_ISSUES = " UNION ALL ".join(f"SELECT doc_id, '{t}' AS type, line, {found} AS detected FROM ({q})" for t, q, found in (
    ("fused text", _located("\\S{80,}"), "''"), ("HTML leakage", _located(_LEAK), "''"), ("empty code block", _located(_FENCE), "''"),
    ("wrong language", _located("```\\nSELECT"), "'sql'"), ("suspicious tab label", _located("\\nbash\\n```bash").replace("CAST(1 +", "CAST(2 +"), "''")))


@register("issue_report", _ALL_ISSUES)
def _issues(spark, d):
    """Every issue of the prepared texts: type, line and detected language."""
    return PG.issue_report(PG.detect_issues(prepared(spark, d), "md")).select("doc_id", "type", "line", F.coalesce("detected", F.lit("")).alias("detected"))


@register("issue_rollup", f"SELECT source, type, CAST(count(*) AS BIGINT) AS issues, count(DISTINCT doc_id) AS n_docs FROM ({_ALL_ISSUES}) JOIN documents USING (doc_id) GROUP BY ROLLUP(source, type)")
def _rollup(spark, d):
    """Issues of all detectors by source and type, per source and overall."""
    x = PG.detect_issues(prepared(spark, d), "md").select("source", "doc_id", F.explode_outer("issues.type").alias("type")).where("type IS NOT NULL")
    return x.rollup("source", "type").agg(F.count("*").alias("issues"), F.count_distinct("doc_id").alias("n_docs"))


@register(
    "summary_line",
    "SELECT conv_id, turn, COALESCE(list_filter(list_transform(string_split(text, chr(10)), lambda l: "
    + _STRIP.format(x="l") + "), lambda l: l <> '' AND NOT regexp_matches(l, '^[#>*`-]'))[1], "
    "'" + W.SUMMARY_DEFAULT + "') AS summary FROM conversations",
)
def _summary_line(spark, d):
    """F11 on every conversation turn."""
    conv = read_table(spark, d, "conversations")
    return conv.select("conv_id", "turn", W.summary_line(F.col("text")).alias("summary"))


@register(
    "split_front_matter",
    f"""SELECT doc_id, '{{"title": "' || source || ' ' || doc_id || '", "version": "1.' || doc_id % 10 || '.0"}}' AS header_json,
        sha256(regexp_replace(substr(md, strpos(md, '.0"' || chr(10) || '---') + 7), '^\\n+', '')) AS body FROM {_RAW}""",
)
def _front_matter(spark, d):
    """header and body of the prepared texts."""
    return prepared(spark, d).select("doc_id", *W.split_front_matter(F.col("md"))).withColumn("body", F.sha2("body", 256))


@register(
    "fenced_blocks",
    f"""SELECT doc_id, CAST(line AS INTEGER) AS line, regexp_extract(hit, '^```(\\w*)\\n', 1) AS lang, sha256(regexp_extract(hit, '(?s)^```\\w*\\n(.*)```$', 1)) AS body
        FROM ({_located("(?ms)^```\\w*\\n.*?^```")})""",
)
def _fenced(spark, d):
    """every fenced block of the prepared texts: line, language and body (by hash)."""
    return W.fenced_blocks(prepared(spark, d), "md", "doc_id").select("doc_id", "line", "lang", F.sha2("body", 256).alias("body"))


def _feedback_entries(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select(
        "doc_id", "source", F.col("text").alias("body"), F.col("source").alias("skill"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                             F.col("doc_id") / 1000.0)).alias("ts"),
        F.col("text"),
    )


# entries of every document: some under names that are no single path part, some blank, every second one with sections
_ENTRY = {
    "skill": "CASE doc_id % 10 WHEN 3 THEN source || '/x' WHEN 4 THEN '..' ELSE source END",
    "text": """CASE WHEN doc_id % 7 = 0 THEN ' ' || chr(10) WHEN doc_id % 2 = 0 THEN '# Title ' || doc_id || chr(10) || '## Context' || chr(10) || text || chr(10) || '## Gap' || chr(10) || 'gap ' || doc_id || chr(10)
      || CASE WHEN doc_id % 3 = 0 THEN '## Impact' || chr(10) || 'high' || chr(10) ELSE '' END ELSE text END""",
}
_ENTRIES_SQL = f"(SELECT doc_id, {_ENTRY['skill']} AS skill, {_ENTRY['text']} AS text FROM documents)"
_GOOD = "skill NOT LIKE '%/%' AND skill <> '..' AND " + _STRIP.format(x="text") + " <> ''"
_MISSING = {"Context": "doc_id % 2 = 1", "Gap": "doc_id % 2 = 1", "Responsibility": "true", "Suggestion": "true", "Impact": "doc_id % 6 <> 0"}


def _appended(spark, d):
    """The store and the quarantine after all entries were appended."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/feedback-{uuid.uuid4().hex}"
    entries = _feedback_entries(spark, d).drop("skill", "text").withColumns({k: F.expr(v) for k, v in {**_ENTRY, "text": re.sub(r"\btext\b", "body", _ENTRY["text"])}.items()})
    FB.feedback_append(entries.drop("body", "source", "doc_id"), f"{root}/store", f"{root}/quarantine")
    return f"{root}/store", f"{root}/quarantine"


@register("feedback_roundtrip", f"SELECT skill, COUNT(*) AS entries, " + ", ".join(f"CAST(sum(({_MISSING[x]})::INT) AS BIGINT) AS missing_{x.lower()}" for x in FB.SECTIONS)
          + f" FROM {_ENTRIES_SQL} WHERE {_GOOD} GROUP BY skill")
def _feedback(spark, d):
    """A6 → A7 → G2 → G3: documents appended as feedback under their source, read back
    (a written table in the shared checkpoint folder), sections checked per skill."""
    back = FB.feedback_scan(spark, _appended(spark, d)[0])
    return FB.feedback_completeness(FB.feedback_sections(back, ["skill", "key"]))


@register("feedback_sections", f"""SELECT skill, 'Title ' || doc_id AS title, sha256(regexp_replace(d.text, '^ +| +$', '', 'g') || chr(10)) AS context, CASE WHEN doc_id % 3 = 0 THEN 'high' END AS impact
    FROM {_ENTRIES_SQL} e JOIN (SELECT doc_id, text FROM documents) d USING (doc_id) WHERE doc_id % 2 = 0 AND skill NOT LIKE '%/%' AND skill <> '..' AND doc_id % 7 <> 0""")
def _feedback_sections(spark, d):
    """The parts of every entry that has a title, read back from the store."""
    x = FB.feedback_sections(FB.feedback_scan(spark, _appended(spark, d)[0]), ["skill"]).where("title IS NOT NULL")
    return x.select("skill", "title", F.sha2("context", 256).alias("context"), F.regexp_replace("impact", r"\n+$", "").alias("impact"))


@register("feedback_quarantine", f"SELECT skill, count(*) AS entries FROM {_ENTRIES_SQL} WHERE NOT ({_GOOD}) GROUP BY skill")
def _feedback_quarantine(spark, d):
    """G1: entries under bad names and blank ones, read back from the quarantine."""
    return spark.read.parquet(_appended(spark, d)[1]).groupBy("skill").agg(F.count("*").alias("entries"))


@register(
    "feedback_stream",
    "SELECT source AS skill, COUNT(*) AS entries FROM documents WHERE " + _STRIP.format(x="text") + " <> '' GROUP BY source",
)
def _feedback_stream(spark, d):
    """A file stream of entries, each appended once (``availableNow``); re-running the same trigger adds nothing."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/feedback-stream-{uuid.uuid4().hex}"
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/_checkpoint"
    _feedback_entries(spark, d).select("skill", "ts", "text").write.parquet(src)
    for _ in range(2):  # the second run must find nothing new
        q = FS.start_feedback_sink(FS.keyed_entries(FS.entries_stream(spark, src)), out, ck)
        q.awaitTermination()
    return spark.read.parquet(out).groupBy("skill").agg(F.count(F.lit(1)).alias("entries"))


_URL = """CASE page_id % 5 WHEN 0 THEN url || '/issues/' || page_id WHEN 1 THEN url || '/issues/12x' WHEN 2 THEN url || '/issues/' || page_id || '#c9' WHEN 3 THEN url || '/pull/' || page_id ELSE url END"""


@register(
    "url_number",
    f"""SELECT page_id, CASE WHEN page_id % 5 IN (0, 2) THEN CAST(page_id AS INTEGER) END AS number,
        CASE WHEN page_id % 5 NOT IN (0, 2) THEN 'could not parse issue number from ' || {_URL} END AS error FROM pages""",
)
def _url_number(spark, d):
    """F10 over every page's address, with and without a number."""
    pages = read_table(spark, d, "pages").select("page_id", F.expr(_URL).alias("url"))
    return pages.select("page_id", *W.url_number(F.col("url")))


@register("extract_version", "SELECT doc_id, '1.' || doc_id % 10 || '.0' AS version FROM documents")
def _extract_version(spark, d):
    """H1: the ``version:`` header value of the prepared texts."""
    from sightline.operators import versions as V

    return prepared(spark, d).select("doc_id", V.extract_version(F.col("md")).alias("version"))


@register(
    "status_counts",
    "SELECT doc_id, " + ", ".join(
        f"CAST(len(regexp_extract_all(md, '\\[{m}\\]')) AS INTEGER) AS {m.lower()}"
        for m in ("DECIDED", "PROPOSED", "OPEN")) + f" FROM {_RAW}",
)
def _status_counts(spark, d):
    """Status markers of the prepared texts."""
    from sightline.operators import plan_docs as J

    return J.status_counts(prepared(spark, d).select("doc_id", F.col("md").alias("text"))).drop("text")


@register(
    "status_by_section",
    "SELECT doc_id, section, CAST((section = 'Status')::INT AS BIGINT) AS decided, CAST((section <> 'Status')::INT AS BIGINT) AS proposed, "
    "CAST(2 * (section = 'Status')::INT AS BIGINT) AS open FROM (SELECT doc_id, unnest(['Status', 'End ' || doc_id]) AS section FROM documents)",
)
def _status_by_section(spark, d):
    """J1 per section: markers of each ``## `` section of the prepared texts."""
    from sightline.operators import plan_docs as J

    x = J.status_by_section(prepared(spark, d).select("doc_id", F.col("md").alias("text")), ["doc_id"])
    return x.where("section IS NOT NULL").drop("section_no")


@register("diagram_inventory", "SELECT doc_id, 'flowchart' AS diagram_type, CAST(2 AS INTEGER) AS n_lines, false AS too_large FROM documents WHERE doc_id % 6 = 0")
def _diagrams(spark, d):
    """K1: diagrams of the prepared texts, typed by their first keyword."""
    from sightline.operators import plan_docs as J

    blocks = W.fenced_blocks(prepared(spark, d), "md", "doc_id")
    return J.diagram_inventory(blocks).select("doc_id", "diagram_type", "n_lines", "too_large")
