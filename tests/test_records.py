"""Work items (F), versions and commits (H, I), plans (J) — decision tables from FIXTURES.md."""
from __future__ import annotations

import base64

import pytest
from pyspark.sql import functions as F

from sightline.operators import plan_docs as J
from sightline.operators import versions as V
from sightline.operators import workitems as W
from sightline.sources.tables import registry_dim


def test_derive_names(spark):
    rows = [("feat", "tables", "support_julia"), ("fix", "pages", "handle empty body"), ("feat", "tables", "  julia support  ")]
    df = spark.createDataFrame(rows, "kind string, feature string, title string")
    got = [(r.slug, r.pr_title) for r in df.select(*W.derive_names(F.col("kind"), F.col("feature"), F.col("title"))).collect()]
    assert got == [("feat_tables_support_julia", "feat(tables): support julia"),
                   ("fix_pages_handle_empty_body", "fix(pages): handle empty body"),
                   ("feat_tables_julia_support", "feat(tables): julia support")]


@pytest.mark.parametrize("kind,ok", [("feat", True), ("fix", True), ("ci", True), ("Feat", False), ("FEAT", False),
                                     ("feat ", False), ("feat-x", False), ("1feat", False), ("", False),
                                     ("feat!", False), ("feat\n", False)])
def test_valid_kind(spark, kind, ok):
    df = spark.createDataFrame([(kind,)], "k string")
    assert df.select(W.valid_kind(F.col("k"))).first()[0] is ok


def test_scope_violations(spark):
    reg = registry_dim(spark, {"acme": {"owner": "o", "features": ["tables", "pages"]}, "empty": {}})
    drafts = spark.createDataFrame([("acme", "tables"), ("acme", "nope"), ("other", "tables"), ("empty", "x")],
                                   "repo string, feature string")
    got = {(r.repo, r.feature): r.violation for r in W.scope_violations(drafts, reg).collect()}
    assert got == {("acme", "nope"): "feature not registered", ("other", "tables"): "unknown repo",
                   ("empty", "x"): "feature not registered"}
    assert [r.repo for r in reg.collect()] == ["acme", "empty"] and reg.collect()[1].owner == ""


def test_match_template(spark):
    t = spark.createDataFrame(
        [("r", "bug_report.md", "p1", 0), ("r", "bug_report.yml", "p2", 1), ("r", "feature_request.md", "p3", 2),
         ("r", "config.yml", "p4", 3)], "repo string, name string, path string, pos int")
    req = spark.createDataFrame([("r", "fix"), ("r", "feat"), ("r", "docs")], "repo string, kind string")
    got = {r.kind: r.template_name for r in W.match_template(req, t).collect()}
    assert got == {"fix": "bug_report.yml", "feat": "feature_request.md"}
    full = {r.kind: r.template_origin for r in W.template_or_default(req, W.match_template(req, t), ["docs"]).collect()}
    assert full == {"fix": "remote:bug_report.yml", "feat": "remote:feature_request.md", "docs": "builtin:docs"}


def test_split_front_matter(spark):
    rows = [("---\ntitle: T\nlabels: [a]\n---\n\nBody\n",), ("No header\n",), ("---\ntitle: T\nno end",),
            ("---\n: [bad\n---\nB",), ("---\n- a\n- b\n---\nB",)]
    df = spark.createDataFrame(rows, "text string")
    got = [(r.header_json, r.body) for r in df.select(*W.split_front_matter(F.col("text"))).collect()]
    assert got[0] == ('{"labels": ["a"], "title": "T"}', "Body\n")
    assert got[1] == ("{}", "No header\n")
    assert got[2] == ("{}", "---\ntitle: T\nno end")
    assert got[3] == ("{}", "B")
    assert got[4] == ("{}", "---\n- a\n- b\n---\nB")


def test_form_sections(spark):
    field = lambda **attributes: {"type": "input", "attributes": attributes}
    import json

    forms = [
        {"labels": ["x", 7], "assignees": "kim", "body": [field(label=" Steps ", placeholder="one"), {"type": "markdown"}, "odd", field(label=""), field(label="Logs", description="paste")]},
        {"body": {"no": "list"}}, {},
    ]
    raw = [json.dumps(f) for f in forms] + ["- just\n- a list", "key: [broken", None]  # JSON is YAML
    got = [r.f for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, raw string").select("i", W.form_sections(F.col("raw")).alias("f")).orderBy("i").collect()]
    assert (got[0].labels, got[0].assignees, got[0].body) == (["x", "7"], ["kim"], "## Steps\n\none\n\n## Logs\n\npaste\n")
    assert [(g.labels, g.body) for g in got[1:3]] == [(None, "## Details\n")] * 2
    assert [(g.labels, g.body) for g in got[3:5]] == [(None, raw[3]), (None, raw[4])] and got[5].body == "## Details\n"


def test_draft_check(spark):
    text = ("---\nwork:\n  repo: acme\n  kind: feat\n  feature: tables\n  title: add_x\n  slug: feat_tables_add_x\n"
            "labels: [1, b]\n---\nBody")
    d = spark.createDataFrame([(1, text), (2, "plain")], "draft_id int, text string")
    r = {x.draft_id: x for x in W.draft_check(d, "acme").collect()}
    assert r[1].has_header and r[1].repo_matches and r[1].title == "feat(tables): add x" and r[1].labels == ["1", "b"]
    assert not r[2].has_header and not r[2].repo_matches


def test_url_number_summary_decode(spark):
    df = spark.createDataFrame([("https://g.com/o/r/issues/42", "# T\n> q\n\n  First line  \nx", base64.b64encode(b"hi").decode()),
                                ("https://g.com/o/r/pull/7", "- a\n* b", "plain")], "url string, plan string, c string")
    r = df.select(*W.url_number(F.col("url")), W.summary_line(F.col("plan")).alias("s"),
                  W.decode_content(F.col("c"), F.when(F.col("c") != "plain", "base64")).alias("d")).collect()
    assert (r[0].number, r[0].error) == (42, None) and r[1].number is None and "could not parse" in r[1].error
    assert r[0].s == "First line" and r[1].s == W.SUMMARY_DEFAULT
    assert r[0].d == "hi" and r[1].d == "plain"


def bumped(base, part):
    major, minor, patch = base
    return {"major": (major + 1, 0, 0), "minor": (major, minor + 1, 0), "patch": (major, minor, patch + 1)}[part]


def test_decide_bump_over_a_grid(spark):
    """The new version is the base bumped as asked, unless the current one is as far already."""
    text = lambda v: ".".join(map(str, v))
    rows = []
    for base in [(0, 0, 0), (0, 9, 1), (3, 0, 9), (10, 4, 0)]:
        for current in [base, *(bumped(base, p) for p in ("patch", "minor", "major"))]:
            for part in ("patch", "minor", "major"):
                rows.append((text(base), text(current), part, text(max(current, bumped(base, part)))))
    df = spark.createDataFrame(rows, "base string, current string, requested string, expected string")
    b, c = V.parse_semver(F.col("base")), V.parse_semver(F.col("current"))
    for r in df.select("expected", "current", V.decide_bump(b, c, F.col("requested")).alias("new")).collect():
        assert (r.new or r.current) == r.expected  # none: the current version stands
    again = df.select(V.decide_bump(b, V.parse_semver(F.col("expected")), F.col("requested")).alias("x")).collect()
    assert all(r.x is None for r in again)


def test_diff_kind_and_parse(spark):
    df = spark.createDataFrame([("1.2.3", "1.2.2"), ("1.2.3", "x"), ("1.2.3", "1.2.3")], "b string, c string")
    got = [r.k for r in df.select(V.diff_kind(V.parse_semver(F.col("b")), V.parse_semver(F.col("c"))).alias("k")).collect()]
    assert got == ["error", "error", "none"]
    t = spark.createDataFrame([('name: x\nversion: "1.4.0"\n',), ("none",)], "t string")
    assert [r.v for r in t.select(V.extract_version(F.col("t")).alias("v")).collect()] == ["1.4.0", None]


def test_commit_parsing(spark):
    msgs = [
        "feat: allow provided config object to extend other configs\n\nBREAKING CHANGE: `extends` key now used",
        "feat!: send an email to the customer when a product is shipped",
        "feat(api)!: send an email",
        "chore!: drop support for Node 6\n\nBREAKING CHANGE: use JavaScript features not available in Node 6.",
        "docs: correct spelling of CHANGELOG",
        "feat(lang): add Polish language",
        "fix: prevent racing of requests\n\nIntroduce a request id.\n\nReviewed-by: Z\nRefs: #123",
        "not a conventional header",
    ]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "seq int, message string")
    p = df.select("seq", *V.parse_commit(F.col("message"))).withColumn("impact", V.semver_impact(F.col("type"), F.col("breaking")))
    r = {x.seq: x for x in p.collect()}
    assert [r[i].impact for i in range(8)] == ["major", "major", "major", "major", "none", "minor", "patch", "none"]
    assert r[2].scope == "api" and r[5].scope == "lang" and r[7].type is None
    assert [(f.token, f.value) for f in r[6].footers] == [("Reviewed-by", "Z"), ("Refs", "#123")]
    rel = V.release_impact(p.withColumn("g", F.lit(1)), ["g"]).first()
    assert rel.impact == "major"
    lint = df.select(*V.commit_lint(F.lit("feat"), F.lit("Add x."), F.col("message"))).first()
    assert lint.known_type and not lint.lowercase_start and not lint.no_period


def test_plan_rules(spark):
    rows = [(1, 1, 10.0, "[OPEN] a [OPEN] b"), (1, 2, 45.0, "[DECIDED] x"), (1, 3, 45.0, ""), (1, 4, 45.0, ""),
            (1, 5, 45.0, "> **Status:** brainstorming — readiness 45%\n[DECIDED] y [PROPOSED] z"),
            (2, 1, 96.0, "readiness 90%")]
    df = spark.createDataFrame(rows, "plan_id int, round int, readiness double, text string")
    sc = {(r.plan_id, r.round): (r.decided, r.proposed, r.open) for r in J.status_counts(df).collect()}
    assert sc[(1, 1)] == (0, 0, 2) and sc[(1, 5)] == (1, 1, 0)
    bands = {(r.plan_id, r.round): r.band for r in J.readiness_band(df).collect()}
    assert bands[(1, 1)] == 0 and bands[(1, 2)] == 2 and bands[(2, 1)] == 5
    st = {(r.plan_id, r.round): (r.delta, r.stop) for r in J.stop_signal(df).collect()}
    assert st[(1, 2)] == (35.0, False) and st[(1, 4)][1] is False and st[(1, 5)] == (0.0, True) and st[(2, 1)][1]
    hs = {r.plan_id: r.in_sync for r in J.header_sync(df).collect()}
    assert hs == {1: True, 2: False}
    blocks = spark.createDataFrame([("mermaid", "\nflowchart LR\n A-->B\n"), ("python", "x")], "lang string, body string")
    inv = J.diagram_inventory(blocks).collect()
    assert len(inv) == 1 and inv[0].diagram_type == "flowchart" and inv[0].n_lines == 2


def test_changelog_and_consistency(spark):
    c = spark.createDataFrame([("feat", "api", 2, "b"), ("feat", "api", 1, "a"), ("fix", None, 3, "c")],
                              "type string, scope string, seq int, description string")
    rows = [(r.type, r.seq, r.n) for r in V.changelog(c).collect()]
    assert rows == [("feat", 1, 2), ("feat", 2, 2), ("fix", 3, 1)]
    v = spark.createDataFrame([("a", "skill", "1.0.0"), ("a", "py", "1.0.0"), ("b", "skill", "1.0.0"),
                               ("b", "py", "1.1.0")], "component string, place string, version string")
    assert [r.component for r in V.version_consistency(v).collect()] == ["b"]
