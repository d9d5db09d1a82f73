"""Continuous append of feedback entries, each once, partitioned by skill.

Structured Streaming: a file source and a sink per micro-batch.  A batch is
de-duplicated in itself and against the store, by an anti join on the entry, so
late entries of any age are kept, no state grows, and a batch that is run again
after a failure finds its rows in the store and adds none.  Of the store only
keys and hashes of texts are read, and only of the times that the batch spans
(an entry and its copy have one time), which Parquet's statistics prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sightline.sources.feedback import KEY_FORMAT, valid_key, valid_text

ENTRY_SCHEMA = T.StructType([
    T.StructField("skill", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("text", T.StringType()),
])


def entries_stream(spark: SparkSession, source_dir: str, schema: T.StructType = ENTRY_SCHEMA,
                   max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(source_dir))


STORE_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("skill", T.StringType()),
])
_ENTRY = ["skill", "key", "text_hash"]


def keyed_entries(stream: DataFrame) -> DataFrame:
    """Valid entries with their key and a final line end."""
    ts = F.col("ts").cast("timestamp")
    return stream.where(valid_key(F.col("skill")) & valid_text(F.col("text"))).select(
        "skill", ts.alias("ts"),
        F.date_format(ts, KEY_FORMAT).alias("key"),
        F.when(F.col("text").endswith("\n"), F.col("text")).otherwise(F.concat("text", F.lit("\n"))).alias("text"),
    )


def _in_store(batch: DataFrame, out_dir: str) -> DataFrame:
    """Keys of the store's entries of the times that the batch spans."""
    span = batch.agg(*(F.unix_micros(f("ts")).alias(n) for n, f in (("first", F.min), ("last", F.max)))).first()
    store, ts = batch.sparkSession.read.schema(STORE_SCHEMA).parquet(out_dir), F.col("ts")
    if span["first"] is None:
        return store.where(ts.isNull())
    return store.where(ts.isNull() | ts.between(F.timestamp_micros(F.lit(span["first"])), F.timestamp_micros(F.lit(span["last"]))))


def append_new(batch: DataFrame, out_dir: str) -> None:
    """Entries of the batch that the store doesn't have."""
    batch = batch.withColumn("text_hash", F.xxhash64("text"))
    store = _in_store(batch, out_dir).select(*(F.col(c).alias(f"__{c}") for c in _ENTRY))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in _ENTRY]
    new = batch.dropDuplicates(_ENTRY).join(store, same, "left_anti")
    new.repartition("skill", F.pmod(F.xxhash64("key"), F.lit(8))).write.mode("append").partitionBy("skill").parquet(out_dir)


def start_feedback_sink(stream: DataFrame, out_dir: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    spark = stream.sparkSession
    spark.createDataFrame([], STORE_SCHEMA).write.mode("append").partitionBy("skill").parquet(out_dir)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: append_new(batch, out_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
