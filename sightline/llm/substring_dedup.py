"""Substring dedup: passages that an earlier document already has are cut out.

Rabin-Karp hashes of every window of ``window`` words are counted in Spark; a
word goes if it lies in a window whose word sequence also starts in a document
with a smaller id, and neighbouring windows merge into maximal intervals.

How the windows meet without one row for each of them:

1. Documents are dealt into blocks by a hash of their id (about 8 MB of text).
   A block hashes all its windows and keeps each hash once, with the smallest
   document that has it: a passage in every document costs one entry a block.
2. The entries go, packed, to buckets by the top bits of the hash.  A bucket
   finds the hashes that several blocks have, and tells every block but the one
   with the smallest document.  A bucket holds at most one entry a block for a
   hash, so a very common passage cannot fill it.
3. Each block meets its answers and its texts again.  A window goes if its hash
   came back, or if an earlier document of the same block has it.

Blocks and buckets follow the bytes of text, so tasks stay the same size at any
input.  Hashes have 64 bits over independent byte tables: two different windows
among n meet with a chance of about n^2 / 2^65.

Defined results: null and empty texts have no words; documents of fewer words
than a window lose nothing; rows that share a document id are told apart in no
way, so they never remove each other's passages, and each is returned; a null id is
neither smaller nor greater than another, so a row without an id loses nothing and
takes nothing from others; ids are whole numbers, others raise; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

WINDOW = 50
BLOCK_BYTES = 8 << 20
BUCKET_WORDS = 1 << 20
_LAST = (1 << 63) - 1  # where rows without an id are sorted


def _hashed(texts: pa.Array, window: int):
    """Window hashes of whole texts with, for each, its text; and the words of each text."""
    counts, hashes, docs, starts = [], [], [], []
    done, words_before = 0, 0
    for a, b in A.slices(texts):
        w = A.words(texts.slice(a, b - a))
        n = len(w.hashes)
        ok = np.flatnonzero(A.window_starts(w.first, window, n))
        hashes.append(A.windows(w.hashes, window)[ok])
        docs.append(w.doc_of_word()[ok] + done)
        starts.append(ok + words_before)
        counts.append(w.counts)
        done, words_before = b, words_before + n
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.empty(0, kind)
    return cat(counts, np.int64), cat(hashes, np.uint64), cat(docs, np.int64), cat(starts, np.int64)


def _in_id_order(block: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Ids, marks of rows without one, and texts."""
    ids = J.column(block, "id")
    none, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
    order = np.lexsort((none, ids))
    return ids[order], none[order], J.column(block, "text").take(pa.array(order))


def _entries(window: int, bits: int):
    def run(block: pa.Table) -> pa.Table:
        ids, none, texts = _in_id_order(block)
        number = J.column(block, "block")[0].as_py()
        _, hashes, docs, _ = _hashed(texts, window)
        hashes, docs = hashes[~none[docs]], docs[~none[docs]]
        hashes, at = np.unique(hashes, return_index=True)  # the first place is in the smallest document
        docs = docs[at]
        bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(bucket)]
        rows = []
        for a, b in zip(edges, edges[1:]):
            by_doc = np.argsort(docs[a:b], kind="stable")  # ids and counts compress; the hashes don't in any order
            who, n = np.unique(docs[a:b], return_counts=True)
            rows.append((int(bucket[a]), number, A.binary(hashes[a:b][by_doc]), A.binary(ids[who]), A.binary(n.astype(np.int32))))
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                    names=["bucket", "block", "hashes", "ids", "counts"])

    return run


def _repeated(bucket: pa.Table) -> pa.Table:
    blocks = J.column(bucket, "block").to_numpy()
    parts = [(A.numbers(h, np.uint64), np.repeat(A.numbers(i, np.int64), A.numbers(n, np.int32)))
             for h, i, n in zip(*(J.column(bucket, c).to_pylist() for c in ("hashes", "ids", "counts")))]
    hashes = np.concatenate([h for h, _ in parts])
    ids = np.concatenate([i for _, i in parts])
    row = np.repeat(np.arange(len(parts)), [len(h) for h, _ in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, ids, row = hashes[order], ids[order], row[order]
    first = np.flatnonzero(np.diff(hashes, prepend=hashes[:1] ^ np.uint64(1)))
    least = np.minimum.reduceat(ids, first) if len(first) else ids
    later = ids > np.repeat(least, np.diff(np.append(first, len(hashes))))
    hashes, row = hashes[later], row[later]
    order = np.argsort(row, kind="stable")
    hashes, row = hashes[order], row[order]
    who, at = np.unique(row, return_index=True)
    edges = at.tolist() + [len(row)]
    return pa.table({"block": pa.array(blocks[who], pa.int64()),
                     "hashes": pa.array([A.binary(hashes[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())})


_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed_spans array<long>, kept_text string"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.string())


def _cut(window: int, with_text: bool):
    names = [c.split()[0] for c in _OUT.split(", ")]

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in _KINDS], names=names)
        ids, none, texts = _in_id_order(block)
        counts, hashes, docs, starts = _hashed(texts, window)
        told = [A.numbers(x, np.uint64) for x in J.column(answers, "hashes").to_pylist()] if answers.num_rows else []
        told = np.unique(np.concatenate(told)) if told else np.empty(0, np.uint64)
        own, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        gone = ids[docs] > ids[docs[at]][which] if len(own) else np.zeros(0, bool)
        if len(told):
            gone |= np.isin(own, told, assume_unique=True)[which]
        gone &= ~none[docs]
        total = int(counts.sum())
        edge = np.zeros(total + 1, np.int64)
        np.add.at(edge, starts[gone], 1)
        np.add.at(edge, starts[gone] + window, -1)
        removed = np.cumsum(edge[:-1]) > 0
        before = np.cumsum(counts) - counts
        n_removed, shas, spans, kept = [], [], [], []
        for d, text in enumerate(texts):
            found = (text.as_py() or "").encode().split()
            mask = removed[before[d] : before[d] + counts[d]]
            turns = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            if len(turns):
                keep, last = [], 0
                for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
                    keep += found[last:a]
                    last = b
                found = keep + found[last:]
            n_removed.append(int(mask.sum()))
            found = b" ".join(found)
            shas.append(hashlib.sha256(found).hexdigest())
            kept.append(found.decode() if with_text else None)
            spans.append(turns.tolist())
        out = pa.array(ids, pa.int64(), mask=none)
        cols = (out, counts, n_removed, shas, spans, kept)
        return pa.Table.from_arrays([c if c is out else pa.array(c, t) for c, t in zip(cols, _KINDS)], names=names)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, removed_spans, kept_text`` for each row of ``docs``.

    ``removed_spans`` holds the maximal intervals as word places, start and end
    in turn; ``kept_text`` (null unless asked for) the kept words, joined by one space.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    size = J.text_bytes(docs, text_col)
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    bits = J.power_of_two(size / 6 / BUCKET_WORDS)
    blocks = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    entries = blocks.groupBy("block").applyInArrow(_entries(window, bits), "bucket long, block long, hashes binary, ids binary, counts binary")
    answers = entries.groupBy("bucket").applyInArrow(_repeated, "block long, hashes binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _cut(window, with_text), _OUT)
