"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import checkpoint_dir, configure, cut_lineage  # noqa: F401
from sightline.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return read_table(spark, sf_dir, name)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of text in all rows: what numbers of blocks and buckets follow from."""
    return docs.select(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0


def power_of_two(n: float) -> int:
    """The bits of the least power of two that is not under ``n``."""
    return max(0, (int(n) - 1).bit_length()) if n > 1 else 0


def held_out(doc_id: Column | str) -> Column:
    """Rows that no classifier learns from: crc32(doc_id as text) mod 5 is 0 (false for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))


def give_back() -> None:
    """Returns freed memory to the system: a worker process stays for other jobs, and shares its executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def trimmed(fn: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``fn`` for ``applyInArrow``, whose memory goes back after each group."""

    def run(group: pa.Table) -> pa.Table:
        out = fn(group)
        give_back()
        return out

    return run


def trimmed_pair(fn: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for cogroups."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = fn(left, right)
        give_back()
        return out

    return run


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` on every Arrow batch; empty batches and partitions give no rows."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out
        give_back()

    return df.mapInArrow(run, schema)


def batch_of(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], names=list(columns))


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    c = batch.column(name)
    if isinstance(c, pa.ChunkedArray):
        c = c.combine_chunks()
        if isinstance(c, pa.ChunkedArray):
            c = c.chunk(0) if c.num_chunks else pa.array([], c.type)
    return c


def _near(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``rows`` with ``__near``: whether the key is marked in a bitmap of 2^23 hashed keys (1 MB, whatever their number)."""
    bit = F.pmod(F.xxhash64(on), F.lit(1 << 23))
    marks = keys.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("__bits"))
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    near = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1, F.lit(False))
    return rows.join(F.broadcast(marks), F.bitmap_bucket_number(bit) == F.col("__bucket"), "left").withColumn("__near", near).drop("__bucket", "__bits")


def known_rows(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``rows`` joined to ``keys`` by ``on``; most rows without a key leave before they are shuffled.

    The join is a merge join at any size: one plan, whose cost follows the input.
    """
    return _near(rows, keys, on).where("__near").drop("__near").join(keys.hint("merge"), on)


def without(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``rows`` whose ``on`` is not in ``keys``; most of them are not shuffled."""
    marked = _near(rows, keys, on)
    kept = marked.where("__near").join(keys.hint("merge"), on, "left_anti")
    return marked.where("NOT __near").unionByName(kept).select(*rows.columns)
