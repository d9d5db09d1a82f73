"""Feedback log: append-only text records partitioned by skill.

Store layout: ``<root>/skill=<name>/part-*.parquet`` with columns
``key`` (``suggestion_%Y%m%d_%H%M%S_%f``, UTC), ``ts`` and ``text``
(newline-terminated).  Reads prune partitions on ``skill``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The five sections of a feedback entry, in order.
SECTIONS = ("Context", "Gap", "Responsibility", "Suggestion", "Impact")
KEY_FORMAT = "'suggestion_'yyyyMMdd_HHmmss_SSSSSS"


def valid_key(skill: Column) -> Column:
    """G1: a single path segment, not ``.`` or ``..``."""
    return F.coalesce(skill.rlike(r"^[^/\\]+$") & ~skill.isin(".", ".."), F.lit(False))


def valid_text(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, r"(?U)^\s+|\s+$", "") != "", F.lit(False))


def prepare(entries: DataFrame) -> DataFrame:
    """A6 record shape: key from the UTC timestamp, text newline-terminated, validity flag."""
    ts = F.coalesce(F.col("ts").cast("timestamp"), F.current_timestamp())
    text = F.when(F.col("text").endswith("\n"), F.col("text")).otherwise(F.concat(F.col("text"), F.lit("\n")))
    return entries.select(
        F.col("skill"),
        F.date_format(ts, KEY_FORMAT).alias("key"),
        ts.alias("ts"),
        text.alias("text"),
        (valid_key(F.col("skill")) & valid_text(F.col("text"))).alias("__ok"),
    )


def feedback_append(entries: DataFrame, root: str, quarantine: str | None = None) -> None:
    """Append valid entries under their skill partition; rejects go to ``quarantine``."""
    p = prepare(entries)
    p.where("__ok").drop("__ok").write.mode("append").partitionBy("skill").parquet(root)
    if quarantine:
        p.where(~F.col("__ok")).drop("__ok").write.mode("append").parquet(quarantine)


def feedback_scan(spark: SparkSession, root: str, skills: list[str] | None = None) -> DataFrame:
    """Read the store back; ``skill`` comes from the directory (partition pruning on filter)."""
    df = spark.read.parquet(root)
    if skills:
        df = df.where(F.col("skill").isin(skills))
    return df


def feedback_scan_files(spark: SparkSession, pattern: str) -> DataFrame:
    """A7 for plain-file stores ``<skill>/suggestion_<UTC µs>.md``: skill and time come from the path."""
    raw = spark.read.text(pattern, wholetext=True)
    path = F.col("_metadata.file_path")
    key = F.regexp_extract(path, r"(suggestion_\d{8}_\d{6}_\d{6})\.md$", 1)
    return raw.select(
        F.regexp_extract(path, r"([^/]+)/suggestion_[^/]+$", 1).alias("skill"),
        key.alias("key"),
        F.to_timestamp(key, KEY_FORMAT).alias("ts"),
        F.col("value").alias("text"),
    )


def feedback_sections(entries: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Title from ``# `` and the five ``## `` sections, one row per entry (pivot of section bodies).

    Per-row array work: split into lines, cut at ``## `` headings; no shuffle.
    """
    t = F.col(text_col)
    title = F.regexp_extract(t, r"(?m)^# (.+)$", 1)
    cols = []
    for name in SECTIONS:
        body = F.regexp_extract(t, rf"(?ms)^## {name}\s*\n(.*?)(?=^## |\z)", 1)
        cols.append(F.when(t.rlike(rf"(?m)^## {name}\s*$"), F.trim(body)).alias(name.lower()))
    return entries.select(*id_cols, F.when(title != "", title).alias("title"), *cols)


def feedback_completeness(sections: DataFrame, group_col: str = "skill") -> DataFrame:
    """Per group, entries and how many lack each of the five sections."""
    aggs = [F.count(F.lit(1)).alias("entries")] + [
        F.sum(F.col(n.lower()).isNull().cast("int")).alias(f"missing_{n.lower()}") for n in SECTIONS
    ]
    return sections.groupBy(group_col).agg(*aggs)
