"""Plan documents and diagram inventory (J1–J5, K1), native columns and windows.

``plans(plan_id, round, readiness, text)`` — one row per plan revision.
Windows are partitioned by ``plan_id``: a plan has a handful of rounds, so
no window group grows with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# ---------------------------------------------------------------------------
# Must equal the reference's for the same results.
# Status markers and readiness bands (lower bound inclusive, upper
# exclusive, last band closed at 100).
# ---------------------------------------------------------------------------
MARKERS = ("DECIDED", "PROPOSED", "OPEN")
BANDS = [
    (0, 20, "Idea + a few facts"),
    (20, 40, "Vision, problem, users clear"),
    (40, 60, "Requirements mostly decided"),
    (60, 80, "Architecture sketched"),
    (80, 95, "All decided except minor opens"),
    (95, 100, "Ready for implementation"),
]
DIAGRAM_KEYWORDS = (
    "flowchart", "graph", "sequenceDiagram", "classDiagram", "stateDiagram", "stateDiagram-v2", "erDiagram",
    "journey", "gantt", "pie", "quadrantChart", "requirementDiagram", "gitGraph", "C4Context", "mindmap",
    "timeline", "zenuml", "sankey-beta", "sankey", "xychart-beta", "xychart", "block-beta", "block", "packet-beta",
    "packet", "kanban", "architecture-beta", "architecture", "radar-beta", "radar", "treemap-beta", "treemap",
    "venn-beta", "venn",
)


def status_counts(plans: DataFrame, text_col: str = "text") -> DataFrame:
    """``[DECIDED]/[PROPOSED]/[OPEN]`` counts per document (one row per plan revision)."""
    t = F.col(text_col)
    return plans.select(
        "*", *[F.size(F.regexp_extract_all(t, F.lit(rf"\[{m}\]"), 0)).alias(m.lower()) for m in MARKERS]
    )


def status_by_section(plans: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """J1 per ``## `` section: lines exploded, section = running count of headings."""
    lines = plans.select(*id_cols, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    w = Window.partitionBy(*id_cols).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    is_head = F.col("line").startswith("## ")
    lines = lines.withColumn("section_no", F.sum(is_head.cast("int")).over(w)).withColumn(
        "section", F.last(F.when(is_head, F.expr("substring(line, 4)")), ignorenulls=True).over(w)
    )
    counts = [F.sum(F.size(F.regexp_extract_all("line", F.lit(rf"\[{m}\]"), 0))).alias(m.lower()) for m in MARKERS]
    return lines.groupBy(*id_cols, "section_no", "section").agg(*counts)


def bands(spark) -> DataFrame:
    return spark.createDataFrame(
        [(i, lo, hi, label) for i, (lo, hi, label) in enumerate(BANDS)], "band int, lo int, hi int, label string"
    )


def readiness_band(df: DataFrame, pct_col: str = "readiness") -> DataFrame:
    """Range join against the six bands (broadcast: six rows, fixed)."""
    b = F.broadcast(bands(df.sparkSession))
    x = F.col(pct_col)
    cond = (x >= b["lo"]) & ((x < b["hi"]) | ((b["hi"] == 100) & (x <= 100)))
    return df.join(b, cond, "left").drop("lo", "hi")


def round_delta(df: DataFrame, plan_col: str = "plan_id", round_col: str = "round", pct_col: str = "readiness") -> DataFrame:
    """Change since the previous round (may be negative; null for the first)."""
    w = Window.partitionBy(plan_col).orderBy(round_col)
    return df.withColumn("delta", F.col(pct_col) - F.lag(pct_col).over(w))


def stop_signal(df: DataFrame, plan_col: str = "plan_id", round_col: str = "round", pct_col: str = "readiness") -> DataFrame:
    """Stop at ≥ 95 % or after three consecutive rounds without change (gaps and islands)."""
    d = round_delta(df, plan_col, round_col, pct_col)
    w = Window.partitionBy(plan_col).orderBy(round_col)
    changed = F.coalesce(F.col("delta") != 0, F.lit(True))
    d = d.withColumn("__island", F.sum(changed.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wi = Window.partitionBy(plan_col, "__island").orderBy(round_col)
    d = d.withColumn("unchanged_run", F.row_number().over(wi) - 1)
    return d.withColumn(
        "stop", (F.col(pct_col) >= 95) | (F.col("unchanged_run") >= 3)
    ).drop("__island")


def header_sync(df: DataFrame, plan_col: str = "plan_id", round_col: str = "round",
                pct_col: str = "readiness", text_col: str = "text") -> DataFrame:
    """The ``readiness N%`` in the document header equals the latest round's value."""
    latest = df.groupBy(plan_col).agg(
        F.max_by(F.struct(pct_col, text_col), F.col(round_col)).alias("__l")
    )
    header = F.regexp_extract(F.col(f"__l.{text_col}"), r"(?i)readiness\s+([0-9]+(?:\.[0-9]+)?)%", 1)
    return latest.select(
        plan_col,
        F.col(f"__l.{pct_col}").alias("latest_readiness"),
        F.when(header != "", header.cast("double")).alias("header_readiness"),
    ).withColumn("in_sync", F.coalesce(F.col("header_readiness") == F.col("latest_readiness"), F.lit(False)))


def diagram_inventory(blocks: DataFrame, max_lines: int = 15) -> DataFrame:
    """K1: fenced ``mermaid`` blocks → diagram type (first keyword) and a size flag."""
    m = blocks.where(F.lower("lang") == "mermaid")
    first = F.get(F.filter(F.split("body", "\n"), lambda l: F.trim(l) != ""), 0)
    kw = F.regexp_extract(F.trim(first), r"^([A-Za-z0-9-]+)", 1)
    n_lines = F.size(F.filter(F.split("body", "\n"), lambda l: F.trim(l) != ""))
    return m.select(
        "*",
        F.when(kw.isin(*DIAGRAM_KEYWORDS), kw).otherwise(F.lit("unknown")).alias("diagram_type"),
        n_lines.alias("n_lines"),
        (n_lines > max_lines).alias("too_large"),
    )

