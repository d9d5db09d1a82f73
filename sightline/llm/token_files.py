"""Token ids in files: frequency-ranked, byte-aligned variable-length codes with separate control bytes.

A file is a Parquet table (so Spark's committer writes it, whichever store holds
it, and a lost executor leaves no half file) whose rows are blocks of whole
documents, in ascending order of document id over (``shard``, ``block``):

* ``doc_ids`` int64, ``no_id`` (their null marks), ``counts`` uint32: the documents and how many ids each has;
* ``ids`` uint32: the block's ids by falling frequency, ties by id; a token's code is its place in this table;
* ``control``: 2 bits a code, four codes a byte from the low bits on: the code's bytes less one;
* ``data``: the codes' little-endian bytes without leading zeros.

All numbers are little-endian.  A block ranks the ids it holds, so a document is
tokenized once, blocks decode on their own, and an id's code is short where it
is frequent.  Reading looks the lengths of four codes up by control byte.

Documents are dealt by ranges of their ids, about ``SHARD_BYTES`` of text each,
and sorted within; rows that share an id are next to each other, by text.

Defined results: a null text is an empty one (the end id alone); a null document
id sorts first; an empty table gives no blocks and no rows; other columns are
not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

END_ID = 2
SHARD_BYTES = 32 << 20
BLOCK_TOKENS = 2 << 20
SLICE_BYTES = 1 << 20
#: pieces whose ids a worker remembers; beyond, it starts anew (no result depends on it)
REMEMBERED = 1_000_000
#: pieces given to the tokenizers library at once
ENCODED = 4096

_BLOCK = "shard int, block int, n_tokens long, doc_ids binary, no_id binary, counts binary, ids binary, control binary, data binary"
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)
#: codes packed or unpacked at once (a multiple of 4); bounds the temporary arrays
PART = 1 << 18


# ------------------------------------------------------------------ coding

def pack(codes: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit codes."""
    parts = [_packed(codes[a : a + PART].astype("<u4")) for a in range(0, len(codes), PART)]
    return b"".join(c for c, _ in parts), b"".join(d for _, d in parts)


def _packed(codes: np.ndarray) -> tuple[bytes, bytes]:
    size = 1 + (codes > 0xFF) + (codes > 0xFFFF).astype(np.int8) + (codes > 0xFFFFFF).astype(np.int8)
    data = codes.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    two = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    two[: len(codes)] = size - 1
    control = (two.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` codes of :func:`pack`."""
    raw, lengths = np.frombuffer(data, np.uint8), np.frombuffer(control, np.uint8)
    codes, at = np.empty(n, np.uint32), 0
    for a in range(0, n, PART):
        part = codes[a : a + PART]
        size = _LENGTHS[lengths[a // 4 : (a + PART) // 4]].reshape(-1)[: len(part)]
        start = at + np.cumsum(size, dtype=np.int64) - size
        part[:] = raw[start]
        for k in (1, 2, 3):
            more = np.flatnonzero(size > k)
            if not len(more):
                break
            part[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
        at += int(size.sum(dtype=np.int64))
    return codes


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids by falling frequency (ties by id), and each id's place among them."""
    counts = np.bincount(ids)
    table = np.flatnonzero(counts)
    table = table[np.argsort(-counts[table], kind="stable")]
    place = np.zeros(len(counts), np.uint32)
    place[table] = np.arange(len(table))
    return table.astype("<u4"), place[ids]


# -------------------------------------------------------------- tokenizing

#: bytes between which a word may be parted: ASCII letters (1), ASCII punctuation (2) but for ' < | >
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_KINDS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = 2

_TOKENIZERS: dict[int, Pieces] = {}


class Pieces:
    """Ids of texts, put together from those of their pieces.

    For tokenizers that drop white space and never join a token across it, nor
    across the border of a letter run and punctuation.  Each distinct piece is
    given to the tokenizers library once and remembered by its hash.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.flat = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids = []
        for k in range(0, len(pieces), ENCODED):  # an encoding is many times as large as its ids
            ids += [e.ids for e in self.tokenizer.encode_batch(pieces[k : k + ENCODED], add_special_tokens=False)]
        size = np.array([len(x) for x in ids], np.int64)
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))])
        where = np.searchsorted(self.known, hashes)
        self.known, self.at, self.size = (np.insert(a, where, b) for a, b in ((self.known, hashes), (self.at, at), (self.size, size)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and how many each text has."""
        found = A.words(texts, kinds=_KINDS)
        hashes, first, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        new = np.flatnonzero(~np.isin(hashes, self.known, assume_unique=True))
        if len(new):
            raw = found.buf.tobytes()
            self._learn(hashes[new], [raw[a:b].decode() for a, b in zip(found.starts[first[new]].tolist(), found.ends[first[new]].tolist())])
        place = np.searchsorted(self.known, hashes)[which]
        size = self.size[place]
        ends = np.cumsum(size, dtype=np.int64)
        flat = self.flat[np.repeat(self.at[place] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return flat, np.diff(np.concatenate([[0], ends])[found.first])


class Whole(Pieces):
    """Ids of texts from the tokenizers library, each text as it is."""

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        size = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum())), size


def _encoder(model: str, pieces: bool) -> Pieces:
    key = hash((model, pieces))
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = (Pieces if pieces else Whole)(model)
    return _TOKENIZERS[key]


def _blocks(model, pieces: bool, end_id: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, number, shard = [], 0, 0, 0

        def block() -> pa.RecordBatch:
            doc_ids, no_id, counts, flat = (np.concatenate(x) for x in zip(*held))
            table, codes = ranked(flat)
            control, data = pack(codes)
            return J.batch_of(shard=pa.array([shard], pa.int32()), block=pa.array([number], pa.int32()), n_tokens=pa.array([len(flat)], pa.int64()),
                              **{k: pa.array([v], pa.binary()) for k, v in dict(doc_ids=A.binary(doc_ids), no_id=A.binary(no_id), counts=A.binary(counts), ids=table.tobytes(), control=control, data=data).items()})

        for batch in batches:
            texts = J.column(batch, "text")
            for a, b in A.slices(texts, SLICE_BYTES):
                rows = batch.slice(a, b - a)
                shard = rows.column("shard")[0].as_py()
                flat, counts = _encoder(model.value, pieces).encode(rows.column("text"))
                flat = np.insert(flat, np.cumsum(counts), end_id).astype(np.uint32)
                ids = rows.column("id")
                held.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), ids.is_null().to_numpy(zero_copy_only=False), (counts + 1).astype("<u4"), flat))
                tokens += len(flat)
                if tokens >= block_tokens:
                    yield block()
                    held, tokens, number = [], 0, number + 1
                    J.give_back()
        if held:
            yield block()
            held = []
        J.give_back()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 pieces: bool = True, shard_bytes: int = SHARD_BYTES, block_tokens: int = BLOCK_TOKENS) -> str:
    """Writes the ids of ``docs`` to ``path``; ``end_id`` follows each document.

    ``pieces``: the tokenizer drops white space and parts words at ASCII
    punctuation (see :class:`Pieces`); otherwise whole texts are encoded.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary: its size is fixed
    shards = max(1, -(-J.text_bytes(docs, text_col) // shard_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(shards, "id").sortWithinPartitions("id", "text").withColumn("shard", F.spark_partition_id())
    rows.mapInArrow(_blocks(model, pieces, end_id, block_tokens), _BLOCK).write.parquet(path)
    return path


# ----------------------------------------------------------------- reading

def _documents(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for row in batch.to_pylist():
        ids = A.numbers(row["ids"], "<u4")[unpack(row["control"], row["data"], row["n_tokens"])]
        counts = A.numbers(row["counts"], "<u4").astype(np.int64)
        yield row, A.numbers(row["doc_ids"], "<i8"), A.numbers(row["no_id"], bool), counts, ids


def _digests(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for row, doc_ids, no_id, counts, ids in _documents(batch):
        start = np.cumsum(counts) - counts
        crc = [zlib.crc32(ids[a : a + n].astype("<u4").tobytes()) for a, n in zip(start.tolist(), counts.tolist())]
        n = len(doc_ids)
        yield J.batch_of(shard=pa.array([row["shard"]] * n, pa.int32()), block=pa.array([row["block"]] * n, pa.int32()), doc_id=pa.array(doc_ids, pa.int64(), mask=no_id),
                         at=pa.array(start, pa.int64()), n_tokens=pa.array(counts, pa.int64()), ids_crc32=pa.array(crc, pa.int64()))


def _lists(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for _, doc_ids, no_id, counts, ids in _documents(batch):
        edges = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        yield J.batch_of(doc_id=pa.array(doc_ids, pa.int64(), mask=no_id), ids=pa.ListArray.from_arrays(edges, pa.array(ids, pa.uint32()).cast(pa.int32())))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` (with the end id) of the files under ``path``."""
    return J.map_arrow(spark.read.parquet(path), _lists, "doc_id long, ids array<int>")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files: ``start`` counts the ids of all documents before."""
    files = spark.read.parquet(path)
    blocks = files.select("shard", "block", "n_tokens")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # one row a shard, of SHARD_BYTES of text each
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    in_shard = Window.partitionBy("shard").orderBy("block")
    starts = blocks.select("shard", "block", (F.sum("n_tokens").over(in_shard) - F.col("n_tokens")).alias("block_start")).join(shards, "shard")
    rows = J.map_arrow(files, _digests, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("shard_start") + F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Writes the token files (to the shared folder unless ``path`` is given) and returns their :func:`token_index`."""
    spark = docs.sparkSession
    path = path or f"{J.checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    return token_index(spark, write_tokens(docs, path, tokenizer_path, **options))
