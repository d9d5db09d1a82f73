"""Session helpers: runtime settings that every job here relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings applied when a caller has not set them already.
# AQE re-plans joins from runtime sizes (broadcast only when the measured
# side is small), coalesces tiny shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python workers are cut by size as well as by rows:
    # pages can be megabytes each, so a fixed row count alone could hand one
    # worker gigabytes.  An executor's workers share its memory with the JVM.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply the defaults above where the session leaves them unset, and
    make the package importable in Python workers."""
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ship_code(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (once per context).

    Arrow UDFs and ``mapInPandas`` functions live in this package, so the
    workers must be able to import it; ``addPyFile`` sends a zip through
    Spark's own file distribution, which works the same on a cluster.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import os
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="sightline-py-")
    zpath = os.path.join(out_dir, "sightline.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local mode, no UI, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sightline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_FALLBACK_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    On a cluster the operator names it in ``spark.checkpoint.dir``; only when
    it is unset (local tests) a fresh temp folder is used, remembered per
    application.  (The setting itself is a core config and cannot be changed
    at runtime, so it is not written back.)
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.getConf().get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if sc.applicationId not in _FALLBACK_DIRS:
            _FALLBACK_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="sightline-ckpt-")
        path = _FALLBACK_DIRS[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Cut lineage through a written table in the shared checkpoint folder.

    One job writes the rows as parquet (columnar, compressed) and the result
    is a fresh scan of those files: later stages — and recomputation after a
    lost executor — read the files instead of re-running the plan.  (An RDD
    ``checkpoint()`` would run the plan a second time to write row-serialised
    files.)
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/sightline-cut-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)
