"""Release versions and commit logs (H1–H6, I1–I7), all native columns.

Versions are ``struct<major,minor,patch>``; Spark orders structs field by
field, which is exactly semantic-version order for release triples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Must equal the reference's for the same results.
# ---------------------------------------------------------------------------
VERSION_LINE = r'(?mU)^\s*version:\s*"?([^"\s]+)"?\s*$'
RANK = {"none": 0, "patch": 1, "minor": 2, "major": 3}
COMMIT_TYPES = ("feat", "fix", "docs", "refactor", "test", "perf", "build", "ci", "chore", "style", "revert")
HEADER = r"^(?i)([a-z]+)(?:\(([^()\r\n]*)\))?(!)?: (.+)$"


def extract_version(text: Column) -> Column:
    """H1: ``version:`` value of a document header, quotes optional; null when absent."""
    v = F.regexp_extract(text, VERSION_LINE, 1)
    return F.when(v != "", v)


def parse_semver(v: Column) -> Column:
    """H2: ``MAJOR.MINOR.PATCH`` → struct, null when not a release triple."""
    ok = F.coalesce(v.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\z"), F.lit(False))
    part = lambda i: F.regexp_extract(v, r"^([0-9]+)\.([0-9]+)\.([0-9]+)\z", i).try_cast("long")
    return F.when(ok, F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def fmt_semver(s: Column) -> Column:
    return F.concat_ws(".", s["major"].cast("string"), s["minor"].cast("string"), s["patch"].cast("string"))


def bump_version(s: Column, kind: Column) -> Column:
    """H3: major/minor/patch increment with reset of the lower fields."""
    return (
        F.when(kind == "major", F.struct((s["major"] + 1).alias("major"), F.lit(0).cast("long").alias("minor"),
                                        F.lit(0).cast("long").alias("patch")))
        .when(kind == "minor", F.struct(s["major"].alias("major"), (s["minor"] + 1).alias("minor"),
                                       F.lit(0).cast("long").alias("patch")))
        .otherwise(F.struct(s["major"].alias("major"), s["minor"].alias("minor"), (s["patch"] + 1).alias("patch")))
    )


def diff_kind(base: Column, current: Column) -> Column:
    """H4: none/patch/minor/major; ``error`` when current is below base or not a version."""
    return (
        F.when(base.isNull() | current.isNull(), F.lit("error"))
        .when(current < base, F.lit("error"))
        .when(current["major"] != base["major"], F.lit("major"))
        .when(current["minor"] != base["minor"], F.lit("minor"))
        .when(current["patch"] != base["patch"], F.lit("patch"))
        .otherwise(F.lit("none"))
    )


def rank(kind: Column) -> Column:
    m = F.create_map(*[x for k, v in RANK.items() for x in (F.lit(k), F.lit(v))])
    return m[kind]


def decide_bump(base: Column, current: Column, requested: Column) -> Column:
    """H5: new version text, or null when the existing change already wins (idempotent)."""
    dk = diff_kind(base, current)
    return F.when(dk == "error", F.lit(None).cast("string")).when(
        rank(requested) > rank(dk), fmt_semver(bump_version(base, requested))
    )


def version_consistency(versions: DataFrame) -> DataFrame:
    """H6: components whose version differs between places ``(component, place, version)``."""
    g = versions.groupBy("component").agg(
        F.count_distinct("version").alias("n_versions"),
        F.sort_array(F.collect_set(F.struct("place", "version"))).alias("found"),
    )
    return g.where(F.col("n_versions") > 1)


def parse_commit(message: Column) -> list[Column]:
    """Type, scope, breaking flag and description of a commit header; body and footers.

    Footers: ``Token: value`` or ``Token #value`` lines after the last blank
    line; tokens use ``-`` for spaces except ``BREAKING CHANGE``; a value runs
    until the next token line.
    """
    header = F.regexp_extract(message, r"^([^\n]*)", 1)
    typ = F.lower(F.regexp_extract(header, HEADER, 1))
    scope = F.regexp_extract(header, HEADER, 2)
    bang = F.regexp_extract(header, HEADER, 3) == "!"
    desc = F.regexp_extract(header, HEADER, 4)
    valid = F.coalesce(header.rlike(HEADER), F.lit(False))
    # Footer block = text after the last blank line, when its first line is a footer token.
    tail = F.regexp_extract(message, r"(?s)\n\n((?:(?!\n\n).)*)$", 1)
    token_line = r"^([A-Za-z0-9-]+|BREAKING CHANGE)(: | #)"
    has_footers = tail.rlike(token_line)
    pieces = F.split(F.regexp_replace(tail, r"(?m)\n(?=([A-Za-z0-9-]+|BREAKING CHANGE)(: | #))", "\u0001"), "\u0001")
    footers = F.when(has_footers, F.transform(pieces, lambda p: F.struct(
        F.regexp_extract(p, token_line, 1).alias("token"),
        F.regexp_replace(p, r"^([A-Za-z0-9-]+|BREAKING CHANGE)(: | #)", "").alias("value"),
    ))).otherwise(F.array().cast("array<struct<token:string,value:string>>"))
    breaking = bang | F.exists(footers, lambda f: f["token"].isin("BREAKING CHANGE", "BREAKING-CHANGE"))
    return [
        F.when(valid, typ).alias("type"),
        F.when(valid & (scope != ""), scope).alias("scope"),
        F.when(valid, breaking).otherwise(F.lit(False)).alias("breaking"),
        F.when(valid, desc).alias("description"),
        footers.alias("footers"),
    ]


def semver_impact(typ: Column, breaking: Column) -> Column:
    """I4: breaking → major, feat → minor, fix → patch, else none."""
    return F.when(breaking, "major").when(typ == "feat", "minor").when(typ == "fix", "patch").otherwise("none")


def release_impact(commits: DataFrame, group_cols: list[str], current_version: Column | None = None) -> DataFrame:
    """Highest impact per group (partial max aggregation); next version when a current one is given."""
    ranked = commits.withColumn("__r", rank(F.col("impact")))
    g = ranked.groupBy(*group_cols).agg(F.max("__r").alias("__r"), *(
        [F.max(current_version).alias("__v")] if current_version is not None else []))
    inv = F.create_map(*[x for k, v in RANK.items() for x in (F.lit(v), F.lit(k))])
    g = g.withColumn("impact", inv[F.col("__r")])
    if current_version is not None:
        g = g.withColumn("next_version", F.when(F.col("impact") == "none", fmt_semver(F.col("__v")))
                         .otherwise(fmt_semver(bump_version(F.col("__v"), F.col("impact")))))
        g = g.drop("__v")
    return g.drop("__r")


def changelog(commits: DataFrame) -> DataFrame:
    """Entries grouped by type and scope, in commit order.

    Long form (one row per entry, globally sorted by type, scope, seq — a
    range-partitioned sort) with the group size joined on; no group is
    gathered into one array, so a type holding most commits stays spread.
    """
    sizes = commits.groupBy(F.col("type").alias("__t"), F.col("scope").alias("__s")).agg(F.count(F.lit(1)).alias("n"))
    e = commits.select("type", "scope", "seq", "description")
    cond = e["type"].eqNullSafe(sizes["__t"]) & e["scope"].eqNullSafe(sizes["__s"])  # a missing scope is a group
    return e.join(sizes, cond).drop("__t", "__s").orderBy("type", "scope", "seq")


def commit_lint(typ: Column, description: Column, header: Column) -> list[Column]:
    """Known type, lowercase start, no final period, header ≤ 72 characters."""
    return [
        F.coalesce(typ.isin(*COMMIT_TYPES), F.lit(False)).alias("known_type"),
        F.coalesce(description.rlike(r"^[a-z]"), F.lit(False)).alias("lowercase_start"),
        (~F.coalesce(description.endswith("."), F.lit(False))).alias("no_period"),
        (F.length(header) <= 72).alias("short_enough"),
    ]
