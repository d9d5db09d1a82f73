"""Quality classifier: a byte-level convolutional network in numpy.

A text is a row of bytes; ``FILTERS`` learned filters of ``WIDTH`` bytes slide
over all of it.  Filter outputs are max-pooled over chunks of ``2 * HALF`` bytes
that overlap by half and cover the whole text; a small dense layer sees each
chunk, and the mean over all chunks gives one probability.  (A convolution over
bytes is a sum of table rows, one table a filter place.)

Training: ``SAMPLE`` labelled rows at most, taken by the hash of their id while
their texts are within ``TRAIN_BYTES`` together (documented bounds, the same at any size; ids with
crc32 mod 5 = 0 are never learned from).  The driver gets their whole texts;
each step draws new chunks of each text in it, one from each of ``TRAIN_CHUNKS`` equal
stretches, so all parts of a text are learned from.  The driver broadcasts about
25,000 numbers.  Scoring is one map over the documents, whole texts, in slices of
bounded memory.

Defined results: a null or empty text is scored as one chunk of padding; label
rows without a label or a document are left out, rows that repeat an id, label and text are one; a
labelled text of more than ``TRAIN_BYTES`` is not learned from; with no rows to learn from the score
is 0.5, with one class only the model learns that class; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

FILTERS, WIDTH, HIDDEN, HALF = 16, 6, 16, 128  # WIDTH is even
SAMPLE = 6000
TRAIN_BYTES = 48 << 20
TRAIN_CHUNKS = 6
STEPS, BATCH, RATE, DECAY = 1500, 48, 0.006, 1e-4
THRESHOLD = 0.3
SLICE_BYTES = 1 << 17
#: stretches of HALF bytes that are convolved at once
HALVES = 1024
_SPAN = 2 * HALF + WIDTH - 1


class ByteCNN:
    """``tables`` (place, byte, filter), then dense layers (filter, hidden) and (hidden,)."""

    def __init__(self, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.w = {"tables": rnd.normal(0, 0.25, (WIDTH, 256, FILTERS)), "bias": np.zeros(FILTERS), "dense": rnd.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)),
                  "dense_bias": np.zeros(HIDDEN), "out": rnd.normal(0, HIDDEN**-0.5, HIDDEN), "out_bias": np.zeros(1)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.pairs = None

    def _convolved(self, data: np.ndarray) -> np.ndarray:
        """Filter outputs at each place of ``data`` (its last WIDTH - 1 bytes along the last axis excepted)."""
        return self._summed(data.astype(np.intp), data.shape[-1] - WIDTH + 1, self.w["tables"], 1)

    @staticmethod
    def _summed(data: np.ndarray, n: int, tables, step: int) -> np.ndarray:
        out = tables[0].take(data[..., :n], axis=0)
        more = np.empty_like(out)
        for k in range(1, len(tables)):
            out += tables[k].take(data[..., k * step : k * step + n], axis=0, out=more, mode="clip")
        return out

    def _convolved_pairs(self, data: np.ndarray) -> np.ndarray:
        """The same, by tables over two bytes: half the look-ups."""
        if self.pairs is None:
            t = self.w["tables"]
            self.pairs = [(t[k][:, None] + t[k + 1][None]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]
        wide = data.astype(np.intp)
        return self._summed(wide[:-1] * 256 + wide[1:], len(data) - WIDTH + 1, self.pairs, 2)

    def _dense(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.maximum(pooled + self.w["bias"], 0)
        return z, np.maximum(z @ self.w["dense"] + self.w["dense_bias"], 0)

    def _logit(self, mean: np.ndarray) -> np.ndarray:
        return mean @ self.w["out"] + self.w["out_bias"]

    def fit(self, texts: list[bytes], label: np.ndarray, steps: int = STEPS, seed: int = 1) -> ByteCNN:
        """Adam on the log loss of whole texts, from chunks drawn anew in each step."""
        rnd = np.random.default_rng(seed)
        size = np.array([max(len(t), 2 * HALF) for t in texts], np.int64)
        at = np.cumsum(size + WIDTH - 1) - size - WIDTH + 1
        flat = np.zeros(int((size + WIDTH - 1).sum()), np.uint8)
        for t, a in zip(texts, at.tolist()):
            flat[a : a + len(t)] = np.frombuffer(t, np.uint8)
        n_chunks = -(-size // HALF) - 1
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            pick = rnd.integers(0, len(label), min(BATCH, len(label)))
            size_of = np.minimum(n_chunks[pick], TRAIN_CHUNKS)
            of = np.repeat(np.arange(len(pick)), size_of)
            stretch = np.arange(len(of)) - np.repeat(np.cumsum(size_of) - size_of, size_of)
            chunk = ((stretch + rnd.random(len(of))) * (n_chunks[pick] / size_of)[of]).astype(np.int64)
            start = at[pick][of] + np.minimum(chunk * HALF, (size[pick] - 2 * HALF)[of])
            data = flat[start[:, None] + np.arange(_SPAN)]
            conv = self._convolved(data)
            best = conv.argmax(1)
            z, hidden = self._dense(np.take_along_axis(conv, best[:, None], 1)[:, 0])
            share = (1 / size_of)[of].astype(np.float32)[:, None]
            mean = np.zeros((len(pick), HIDDEN), np.float32)
            np.add.at(mean, of, hidden * share)
            p = 1 / (1 + np.exp(-self._logit(mean)))
            error = ((p - label[pick]) / len(pick)).astype(np.float32)
            g = {"out": mean.T @ error, "out_bias": error.sum(keepdims=True)}
            back = (error[of, None] * self.w["out"]) * share * (hidden > 0)
            g |= {"dense": z.T @ back, "dense_bias": back.sum(0)}
            back = (back @ self.w["dense"].T) * (z > 0)
            g |= {"bias": back.sum(0), "tables": np.zeros_like(self.w["tables"])}
            for k in range(WIDTH):
                np.add.at(g["tables"][k], (np.take_along_axis(data, best + k, 1), np.arange(FILTERS)[None]), back)
            for k, v in self.w.items():
                grad = g[k] + DECAY * v
                m, s = moment[k]
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                v -= RATE * min(1.0, 2 - 2 * step / steps) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
        return self

    def _pooled(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Greatest filter outputs of each stretch; between the stretches of two texts are bytes of neither."""
        edges = np.stack([start, end], 1).ravel()
        return np.maximum.reduceat(self._convolved_pairs(data), np.minimum(edges, len(data) - WIDTH)[: 2 * len(start) - 1], axis=0)[::2]

    def score(self, texts: pa.Array) -> np.ndarray:
        """The probability of label 1 for each text."""
        out = [np.empty(0)]
        for a, b in A.slices(texts, SLICE_BYTES):
            buf, offsets = A.utf8(texts.slice(a, b - a))
            size = np.diff(offsets)
            places = np.maximum(size, 1)
            at = np.cumsum(places + WIDTH - 1) - places - WIDTH + 1
            padded = np.zeros(int((places + WIDTH - 1).sum()), np.uint8)
            padded[np.repeat(at - offsets[:-1], size) + np.arange(len(buf))] = buf
            halves = -(-places // HALF)
            first = np.cumsum(halves) - halves
            start = np.repeat(at, halves) + (np.arange(int(halves.sum())) - np.repeat(first, halves)) * HALF
            end = np.minimum(start + HALF, np.repeat(at + places, halves))
            pooled = np.concatenate([self._pooled(padded[start[i] : end[min(i + HALVES, len(end)) - 1] + WIDTH - 1], start[i : i + HALVES] - start[i], end[i : i + HALVES] - start[i])
                                     for i in range(0, len(start), HALVES)])  # a very long text takes no more memory than this many
            last = np.zeros(len(start), bool)
            last[first + halves - 1] = True
            both = np.where(last[:, None], pooled, np.maximum(pooled, np.roll(pooled, -1, 0)))
            use = ~last | np.repeat(halves == 1, halves)  # chunks: each two halves, or the only one
            doc = np.repeat(np.arange(len(size)), halves)[use]
            _, hidden = self._dense(both[use])
            edge = np.searchsorted(doc, np.arange(len(size)))
            mean = np.add.reduceat(hidden, edge, axis=0) / np.bincount(doc)[:, None]
            out.append(1 / (1 + np.exp(-self._logit(mean).astype(float))))
        return np.concatenate(out)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> ByteCNN | None:
    """The network learned from ``sample`` rows of ``labels``; None if there are none."""
    picked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~J.held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(picked), "id").withColumns({"at": F.xxhash64("id"), "size": F.octet_length("text"), "hash": F.xxhash64("text")}).dropDuplicates(["id", "label", "hash"])
    order = ["at", "id", "label", "hash"]
    sizes = rows.where(F.col("size") <= TRAIN_BYTES).select(*order, F.sum("size").over(Window.orderBy(*order)).alias("before"))  # numbers of the sample's rows
    kept = sizes.where(F.col("before") <= TRAIN_BYTES).drop("before")
    found = rows.join(F.broadcast(kept), order).select(*order, "text").orderBy(*order).toArrow()
    if not found.num_rows:
        return None
    return ByteCNN().fit([t.encode() for t in found["text"].to_pylist()], found["label"].to_numpy().astype(float), steps)


def scored(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.score(batch.column("text")) if shared.value else np.full(batch.num_rows, 0.5)
        return J.batch_of(doc_id=batch.column("doc_id"), score=pa.array(scores, pa.float64()))

    out = J.map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", J.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: ByteCNN | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that the network rejects."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if shared.value is None:
            return batch
        return batch.filter(pa.array(shared.value.score(batch.column(text_col)) >= threshold))

    return J.map_arrow(docs, run, docs.schema)
