"""Table sources and sinks (inventory A1–A5, A8, A9)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A1: open one parquet file (or directory) as a lazy table."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, table_path(sf_dir, name))


def file_inventory(spark: SparkSession, patterns: str | Sequence[str]) -> DataFrame:
    """A2: expand glob(s) to files, sorted by path, one row per file.

    Listing goes through the Hadoop file system, so it works on object
    stores as well; only metadata columns are read (no file contents).
    A pattern that matches nothing raises ``PATH_NOT_FOUND``.
    """
    if isinstance(patterns, str):
        patterns = [patterns]
    listed = None
    for i, pattern in enumerate(patterns):
        part = (
            spark.read.format("binaryFile")
            .load(pattern)
            .select(
                F.lit(i).alias("pattern_pos"),
                F.col("path"),
                F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"),
                F.col("length"),
                F.col("modificationTime").alias("modified"),
            )
        )
        listed = part if listed is None else listed.unionByName(part)
    # the driver holds the whole listing while it plans the scan, so numbering it in one task adds no new limit
    order = Window.orderBy("pattern_pos", "path")
    return listed.withColumn("file_pos", F.row_number().over(order)).orderBy("file_pos")


def bind_tables(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """A3: register files as views ``t`` (= first), ``t1``, ``t2`` …"""
    names = ["t"]
    for i, path in enumerate(paths, 1):
        df = scan_parquet(spark, path)
        if i == 1:
            df.createOrReplaceTempView("t")
        df.createOrReplaceTempView(f"t{i}")
        names.append(f"t{i}")
    return names


def per_file_map(
    spark: SparkSession,
    paths: Sequence[str],
    op: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """A4: run ``op`` on each file separately, results kept apart and in path order.

    Files may have different schemas, so each file is its own scan; the
    long-format results are stacked with a leading ``file_name``/``file_pos``.
    Only the (short) path list lives on the driver.
    """
    out = None
    for pos, path in enumerate(sorted(paths), 1):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        res = op(scan_parquet(spark, path)).select(
            F.lit(pos).alias("file_pos"), F.lit(name).alias("file_name"), "*"
        )
        out = res if out is None else out.unionByName(res, allowMissingColumns=True)
    return out


def per_file_aggregate(spark: SparkSession, paths: str | Sequence[str], *aggs) -> DataFrame:
    """A4 for files that share a schema: ONE distributed scan of all files,
    grouped by the file each row came from (``_metadata.file_name``).

    Planning cost does not grow with the number of files (unlike a union
    of per-file scans); default aggregate is the row count.
    """
    if isinstance(paths, str):
        paths = [paths]
    df = spark.read.parquet(*paths)
    aggs = aggs or (F.count(F.lit(1)).alias("rows"),)
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(*aggs)


def page_source_binary(spark: SparkSession, pattern: str) -> DataFrame:
    """A5: raw HTML files → ``(page_id, url, html)``; bad bytes become U+FFFD."""
    raw = spark.read.format("binaryFile").load(pattern)
    return raw.select(
        F.xxhash64("path").alias("page_id"),
        F.col("path").alias("url"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("html"),
    )


def page_source_table(df: DataFrame) -> DataFrame:
    """A5 for a table of pages whose html may hold invalid UTF-8 (binary or string)."""
    html = F.col("html")
    if isinstance(df.schema["html"].dataType, T.BinaryType):
        html = html.cast("string")
    return df.withColumn("html", F.make_valid_utf8(html))


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("repo", T.StringType(), False),
        T.StructField("owner", T.StringType(), False),
        T.StructField("features", T.ArrayType(T.StringType(), False), False),
    ]
)


def registry_dim(spark: SparkSession, registry: dict[str, dict]) -> DataFrame:
    """Repo registry (a small config mapping) as rows sorted by repo.

    ``owner`` defaults to ``""`` and ``features`` to an empty list.  The table
    is configuration, bounded by the number of repositories, so joins may
    broadcast it.
    """
    rows = [
        (repo, str(conf.get("owner", "") or ""), [str(f) for f in conf.get("features", []) or []])
        for repo, conf in sorted(registry.items())
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA).orderBy("repo")


def registry_features(registry: DataFrame) -> DataFrame:
    """A8 long form: one row per (repo, feature); repos without features keep a null row."""
    return registry.select("repo", "owner", F.explode_outer("features").alias("feature"))


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: Sequence[str] | None = None) -> None:
    """Emit any result set as keyed records (parquet, json or csv)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)
