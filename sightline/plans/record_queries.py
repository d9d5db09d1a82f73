"""Registered queries of work items, versions, commits and plans, on records made of every row of the given tables.

The tables hold no drafts, versions, commits or plans, so each row gives one,
from its own columns; the same expressions stand in the twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import plan_docs as J
from sightline.operators import versions as V
from sightline.operators import workitems as W
from sightline.plans.catalog import register
from sightline.sources.tables import read_table


@register("derive_names", """SELECT doc_id, lang || '_' || source || '_Notes_on_' || doc_id AS slug, lang || '(' || source || '): Notes on ' || doc_id AS pr_title,
          'item/' || lang || '_' || source || '_Notes_on_' || doc_id AS branch FROM documents""")
def _names(spark, d):
    """slug, title and branch of an item for each document."""
    x = read_table(spark, d, "documents").withColumn("title", F.expr("' Notes_on ' || doc_id || ' '"))
    return x.select("doc_id", *W.derive_names(F.col("lang"), F.col("source"), F.col("title")))


_KIND = "CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN upper(lang) WHEN 2 THEN lang || chr(10) ELSE lang || doc_id END"


@register("valid_kind", f"SELECT doc_id, {_KIND} AS kind, regexp_full_match({_KIND}, '[a-z][a-z0-9]*') AS ok FROM documents")
def _kinds(spark, d):
    """F3 on kinds with capitals, a line end and digits."""
    x = read_table(spark, d, "documents").selectExpr("doc_id", f"{_KIND} AS kind")
    return x.withColumn("ok", W.valid_kind(F.col("kind")))


_DRAFT = "doc_id, CASE WHEN doc_id % 10 = 0 THEN 'old-' || source ELSE source END AS repo, CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS feature"


@register("valid_scope", f"""WITH r AS (SELECT DISTINCT source, lang FROM documents WHERE doc_id % 2 = 0), dr AS (SELECT {_DRAFT} FROM documents)
    SELECT doc_id, repo, feature, CASE WHEN repo NOT IN (SELECT source FROM r) THEN 'unknown repo' ELSE 'feature not registered' END AS violation
    FROM dr WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.source = dr.repo AND r.lang = dr.feature)""")
def _scopes(spark, d):
    """drafts of all documents against the sources and languages of every other one."""
    docs = read_table(spark, d, "documents")
    registry = docs.where("doc_id % 2 = 0").groupBy(F.col("source").alias("repo")).agg(F.collect_set("lang").alias("features"))
    return W.scope_violations(docs.selectExpr(*_DRAFT_COLUMNS), registry)


_DRAFT_COLUMNS = ["doc_id", "CASE WHEN doc_id % 10 = 0 THEN 'old-' || source ELSE source END AS repo", "CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS feature"]


@register("decode_content", "SELECT doc_id, sha256(text) AS content FROM documents")
def _decoded(spark, d):
    """whole texts, every second one in base64."""
    x = read_table(spark, d, "documents").withColumn("encoding", F.expr("CASE WHEN doc_id % 2 = 0 THEN 'base64' ELSE 'utf-8' END"))
    x = x.withColumn("content", F.when(F.col("encoding") == "base64", F.base64(F.encode("text", "UTF-8"))).otherwise(F.col("text")))
    return x.select("doc_id", F.sha2(W.decode_content(F.col("content"), F.col("encoding")), 256).alias("content"))


# --------------------------------------------------------------- templates

# each document is a file of its source's listing, and asks for a kind of its source
_FILES = """source AS repo, CASE doc_id % 7 WHEN 0 THEN 'Bug_report_' || doc_id || '.md' WHEN 1 THEN 'a_bug_' || lang || '.yml' WHEN 2 THEN 'FEATURE_request_' || doc_id || '.md'
  WHEN 3 THEN lang || '_docs.yaml' WHEN 4 THEN 'notes_' || doc_id || '.md' WHEN 5 THEN 'task_' || doc_id || '.yml' ELSE lang || '.txt' END AS name, doc_id AS pos"""
_ASKED = "source AS repo, CASE doc_id % 6 WHEN 0 THEN 'fix' WHEN 1 THEN 'feat' WHEN 2 THEN 'docs' WHEN 3 THEN lang WHEN 4 THEN 'chore' ELSE 'nothing' END AS kind"
_HINTS = ", ".join(f"('{k}', '{h}', {i})" for k, hints in W.KIND_HINTS.items() for i, h in enumerate(hints))
_MATCHED = f"""WITH t AS (SELECT {_FILES} FROM documents), q AS (SELECT DISTINCT {_ASKED} FROM documents), h AS (SELECT * FROM (VALUES {_HINTS}) v(kind, hint, i)),
qh AS (SELECT q.repo, q.kind, h.hint, h.i FROM q JOIN h USING (kind) UNION ALL SELECT repo, kind, kind, 0 FROM q WHERE kind NOT IN (SELECT kind FROM h)),
m AS (SELECT qh.repo, qh.kind, t.name, row_number() OVER (PARTITION BY qh.repo, qh.kind ORDER BY qh.i, (lower(t.name) NOT LIKE '%.yml' AND lower(t.name) NOT LIKE '%.yaml')::INT, t.pos) AS rn
      FROM qh JOIN t ON qh.repo = t.repo AND contains(lower(t.name), qh.hint)),
best AS (SELECT repo, kind, name AS template_name, 'p/' || name AS template_path FROM m WHERE rn = 1)"""


def _templates(spark, d):
    docs = read_table(spark, d, "documents")
    files = docs.selectExpr("source AS repo", _FILES.split(", ", 1)[1].rsplit(", ", 1)[0], "doc_id AS pos").withColumn("path", F.expr("'p/' || name"))
    asked = docs.selectExpr("source AS repo", _ASKED.split(", ", 1)[1]).distinct()
    return asked, W.match_template(asked, files)


@register("match_template", f"{_MATCHED} SELECT * FROM best")
def _match_template(spark, d):
    """the best template of each source and kind among the names of all its files."""
    return _templates(spark, d)[1]


@register("template_or_default", f"""{_MATCHED} SELECT q.repo, q.kind, template_name, template_path,
    CASE WHEN template_name IS NOT NULL THEN 'remote:' || template_name WHEN q.kind IN ('docs', 'chore') THEN 'builtin:' || q.kind ELSE 'builtin:_default' END AS template_origin
    FROM q LEFT JOIN best ON q.repo = best.repo AND q.kind = best.kind""")
def _template_or_default(spark, d):
    """the match, else the built-in of the kind, else the default."""
    return W.template_or_default(*_templates(spark, d), ["docs", "chore"])


# ---------------------------------------------------------------- versions

_V = "CASE o_orderkey % 4 WHEN 0 THEN 'v1.2.3' WHEN 1 THEN '1.' || o_custkey WHEN 2 THEN '1.2.3' || chr(10) ELSE (o_orderkey % 5) || '.' || o_custkey || '.' || o_orderkey END"


@register("parse_semver", "SELECT o_orderkey, CASE WHEN ok THEN o_orderkey % 5 END AS major, CASE WHEN ok THEN CAST(o_custkey AS BIGINT) END AS minor, "
          "CASE WHEN ok THEN CAST(o_orderkey AS BIGINT) END AS patch FROM (SELECT *, o_orderkey % 4 = 3 AS ok FROM orders)")
def _semver(spark, d):
    """H2 on versions of all orders, three of four of them none."""
    x = read_table(spark, d, "orders").selectExpr("o_orderkey", f"{_V} AS v").withColumn("s", V.parse_semver(F.col("v")))
    return x.select("o_orderkey", "s.major", "s.minor", "s.patch")


_BASE = ("1", "o_orderkey % 3", "o_orderkey % 4")
_NOW = ("1 + (o_custkey % 9 = 0)::INT", "o_orderkey % 3 + (o_custkey % 5 = 0)::INT", "o_orderkey % 4 + (o_custkey % 3 = 0)::INT - (o_custkey % 11 = 0)::INT")
_WANT = "CASE o_orderstatus WHEN 'F' THEN 'patch' WHEN 'O' THEN 'minor' ELSE 'major' END"
_PAIRS = f"""(SELECT o_orderkey, {', '.join(f'CAST({x} AS BIGINT) AS b{i}' for i, x in enumerate(_BASE))}, {', '.join(f'CAST({x} AS BIGINT) AS c{i}' for i, x in enumerate(_NOW))},
  {_WANT} AS want FROM orders)"""
_DIFF = "CASE WHEN (c0, c1, c2) < (b0, b1, b2) THEN 'error' WHEN c0 <> b0 THEN 'major' WHEN c1 <> b1 THEN 'minor' WHEN c2 <> b2 THEN 'patch' ELSE 'none' END"


def _pairs(spark, d):
    x = read_table(spark, d, "orders")
    dot = lambda parts: "concat_ws('.', " + ", ".join(f"CAST({p.replace('::INT', '')} AS STRING)" for p in parts) + ")"
    flag = lambda parts: tuple(p.replace("(o_custkey", "int(o_custkey") for p in parts)
    x = x.selectExpr("o_orderkey", f"{dot(_BASE)} AS base", f"{dot(flag(_NOW))} AS now", f"{_WANT} AS want")
    return x.withColumns({"b": V.parse_semver(F.col("base")), "c": V.parse_semver(F.col("now"))})


_FIRST = "b0 || '.' || b1 || '.' || b2"


@register("bump_version", f"SELECT o_orderkey, CASE want WHEN 'major' THEN (b0 + 1) || '.0.0' WHEN 'minor' THEN b0 || '.' || (b1 + 1) || '.0' ELSE b0 || '.' || b1 || '.' || (b2 + 1) END AS v FROM {_PAIRS}")
def _bump(spark, d):
    """H3: each order's base version bumped as its status asks."""
    return _pairs(spark, d).select("o_orderkey", V.fmt_semver(V.bump_version(F.col("b"), F.col("want"))).alias("v"))


@register("diff_kind", f"SELECT o_orderkey, CASE WHEN c2 < 0 THEN 'error' ELSE {_DIFF} END AS kind FROM {_PAIRS}")
def _diff(spark, d):
    """H4: what changed between two versions of each order; a negative part is no version."""
    return _pairs(spark, d).select("o_orderkey", V.diff_kind(F.col("b"), F.col("c")).alias("kind"))


_RANK = "CASE {x} WHEN 'major' THEN 3 WHEN 'minor' THEN 2 WHEN 'patch' THEN 1 ELSE 0 END"


@register("decide_bump", f"""SELECT o_orderkey, CASE WHEN kind <> 'error' AND {_RANK.format(x='want')} > {_RANK.format(x='kind')} THEN
      CASE want WHEN 'major' THEN (b0 + 1) || '.0.0' WHEN 'minor' THEN b0 || '.' || (b1 + 1) || '.0' ELSE b0 || '.' || b1 || '.' || (b2 + 1) END END AS v
      FROM (SELECT *, CASE WHEN c2 < 0 THEN 'error' ELSE {_DIFF} END AS kind FROM {_PAIRS})""")
def _decide(spark, d):
    """H5: the new version, if the change so far is not as great as the one asked for."""
    return _pairs(spark, d).select("o_orderkey", V.decide_bump(F.col("b"), F.col("c"), F.col("want")).alias("v"))


@register("version_consistency", "SELECT l_partkey AS component, count(DISTINCT l_linenumber) AS n_versions FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_linenumber) > 1")
def _consistent(spark, d):
    """H6: parts whose version differs between places."""
    x = read_table(spark, d, "lineitem").selectExpr("l_partkey AS component", "concat(l_returnflag, l_linestatus) AS place", "concat('1.0.', l_linenumber) AS version")
    return V.version_consistency(x).select("component", "n_versions")


# ----------------------------------------------------------------- commits

_TYPE = "CASE (conv_id + turn) % 5 WHEN 0 THEN 'feat' WHEN 1 THEN 'fix' WHEN 2 THEN 'Docs' WHEN 3 THEN 'odd' ELSE 'chore' END"
_SCOPE = "CASE WHEN turn % 3 = 0 THEN '' ELSE 'c' || conv_id % 3 END"
_MARK = "CASE WHEN conv_id % 8 = 0 THEN '!' ELSE '' END"
_DESC = "CASE WHEN conv_id % 2 = 0 THEN 'turn ' || turn || '.' ELSE 'Turn ' || turn || ' of a conversation with a rather long line to read, number ' || conv_id END"
_HEADER = f"({_TYPE}) || CASE WHEN turn % 3 = 0 THEN '' ELSE '(c' || conv_id % 3 || ')' END || ({_MARK}) || ': ' || ({_DESC})"
_FOOT = "CASE WHEN conv_id % 6 = 0 THEN 'BREAKING CHANGE: all' || chr(10) || 'of it' || chr(10) ELSE '' END || 'Reviewed-by: r' || conv_id || chr(10) || 'Refs #' || turn"
_MESSAGE = f"{_HEADER} || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) || {_FOOT}"
_BREAKS = "(conv_id % 8 = 0 OR conv_id % 6 = 0)"
_IMPACT = f"CASE WHEN {_BREAKS} THEN 'major' WHEN ({_TYPE}) = 'feat' THEN 'minor' WHEN ({_TYPE}) = 'fix' THEN 'patch' ELSE 'none' END"


def _commits(spark, d):
    x = read_table(spark, d, "conversations").selectExpr("conv_id", "turn", "role", f"{_MESSAGE} AS message")
    return x.select("conv_id", "turn", "role", "message", *V.parse_commit(F.col("message")))


@register("parse_commit_header", f"SELECT conv_id, turn, lower({_TYPE}) AS type, NULLIF({_SCOPE}, '') AS scope, {_DESC} AS description FROM conversations")
def _header(spark, d):
    """A commit message for each turn, around its whole text."""
    return _commits(spark, d).select("conv_id", "turn", "type", "scope", "description")


@register("parse_commit_footers", f"""SELECT conv_id, turn, CASE WHEN conv_id % 6 = 0 THEN 'BREAKING CHANGE=all' || chr(10) || 'of it;' ELSE '' END || 'Reviewed-by=r' || conv_id || ';Refs=' || turn AS footers FROM conversations""")
def _footers(spark, d):
    """The footers after the text, values over several lines included."""
    pairs = F.transform("footers", lambda f: F.concat(f["token"], F.lit("="), f["value"]))
    return _commits(spark, d).select("conv_id", "turn", F.array_join(pairs, ";").alias("footers"))


@register("breaking_flag", f"SELECT conv_id, turn, {_BREAKS} AS breaking, {_IMPACT} AS impact FROM conversations")
def _breaking(spark, d):
    """Breaking by mark or footer, and what a message means for the version."""
    return _commits(spark, d).select("conv_id", "turn", "breaking", V.semver_impact(F.col("type"), F.col("breaking")).alias("impact"))


_IMPACTS = f"(SELECT conv_id, role, {_RANK.format(x='(' + _IMPACT + ')')} AS r FROM conversations)"


@register("release_impact", f"""SELECT conv_id, CASE r WHEN 3 THEN 'major' WHEN 2 THEN 'minor' WHEN 1 THEN 'patch' ELSE 'none' END AS impact,
      CASE r WHEN 3 THEN '2.0.0' WHEN 2 THEN '1.' || (conv_id % 4 + 1) || '.0' WHEN 1 THEN '1.' || conv_id % 4 || '.8' ELSE '1.' || conv_id % 4 || '.7' END AS next_version
      FROM (SELECT conv_id, max(r) AS r FROM {_IMPACTS} GROUP BY conv_id)""")
def _release(spark, d):
    """The greatest impact in each conversation, and the version after it."""
    x = _commits(spark, d).withColumn("impact", V.semver_impact(F.col("type"), F.col("breaking")))
    x = x.withColumn("current", V.parse_semver(F.expr("concat('1.', conv_id % 4, '.7')")))
    return V.release_impact(x, ["conv_id"], F.col("current"))


@register("changelog", f"""SELECT type, scope, seq, description, count(*) OVER (PARTITION BY type, scope) AS n FROM (
      SELECT lower({_TYPE}) AS type, NULLIF({_SCOPE}, '') AS scope, CAST(conv_id * 1000 + turn AS BIGINT) AS seq, {_DESC} AS description FROM conversations)""")
def _changelog(spark, d):
    """All messages by type and scope."""
    return V.changelog(_commits(spark, d).withColumn("seq", F.expr("CAST(conv_id * 1000 + turn AS BIGINT)")))


@register("commit_lint", f"""SELECT conv_id, turn, lower({_TYPE}) <> 'odd' AS known_type, conv_id % 2 = 0 AS lowercase_start, conv_id % 2 <> 0 AS no_period,
      length({_HEADER}) <= 72 AS short_enough FROM conversations""")
def _lint(spark, d):
    """The rules on each message's header."""
    x = _commits(spark, d)
    return x.select("conv_id", "turn", *V.commit_lint(F.col("type"), F.col("description"), F.regexp_extract("message", r"^([^\n]*)", 1)))


# ------------------------------------------------------------------- plans

_READY = "CAST((conv_id * 7 + (turn // 4) * 30) % 101 AS INT)"


def _rounds(spark, d):
    ready = "CAST((conv_id * 7 + (turn DIV 4) * 30) % 101 AS INT)"
    head = f"CASE WHEN conv_id % 3 = 0 THEN 'no number' ELSE 'Readiness ' || ({ready} + CASE WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END) || '% so far' END"
    return read_table(spark, d, "conversations").selectExpr("conv_id AS plan_id", "turn AS round", f"{ready} AS readiness", f"{head} || chr(10) || coalesce(text, '') AS text")


_ROUNDS = f"(SELECT conv_id AS plan_id, turn AS round, {_READY} AS readiness FROM conversations)"
_BAND = "CASE " + " ".join(
    f"WHEN readiness >= {lo} AND (readiness < {hi} OR {hi} = 100 AND readiness <= 100) THEN {i}" for i, (lo, hi, _) in enumerate(J.BANDS)) + " END"


@register("readiness_band", f"SELECT plan_id, round, readiness, CAST({_BAND} AS INTEGER) AS band FROM {_ROUNDS}")
def _band(spark, d):
    """The band of each round."""
    return J.readiness_band(_rounds(spark, d)).select("plan_id", "round", "readiness", "band")


@register("round_delta", f"SELECT plan_id, round, readiness - lag(readiness) OVER (PARTITION BY plan_id ORDER BY round) AS delta FROM {_ROUNDS}")
def _delta(spark, d):
    """Change since the round before."""
    return J.round_delta(_rounds(spark, d)).select("plan_id", "round", "delta")


@register("stop_signal", f"""SELECT plan_id, round, readiness >= 95 OR row_number() OVER (PARTITION BY plan_id, island ORDER BY round) - 1 >= 3 AS stop FROM (
      SELECT *, sum(CASE WHEN before = readiness THEN 0 ELSE 1 END) OVER (PARTITION BY plan_id ORDER BY round) AS island FROM (
      SELECT *, lag(readiness) OVER (PARTITION BY plan_id ORDER BY round) AS before FROM {_ROUNDS}))""")
def _stop(spark, d):
    """Ready, or unchanged for three rounds."""
    return J.stop_signal(_rounds(spark, d)).select("plan_id", "round", "stop")


@register("header_sync", f"""SELECT plan_id, readiness AS latest_readiness, CASE WHEN plan_id % 3 <> 0 THEN CAST(readiness + (plan_id % 5 = 0)::INT AS DOUBLE) END AS header_readiness,
      plan_id % 3 <> 0 AND plan_id % 5 <> 0 AS in_sync FROM {_ROUNDS} QUALIFY row_number() OVER (PARTITION BY plan_id ORDER BY round DESC) = 1""")
def _sync(spark, d):
    """The number in the header against the latest round."""
    return J.header_sync(_rounds(spark, d))
