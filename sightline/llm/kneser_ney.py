"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary text, score the words of a document;
the difference of their log-likelihoods per word, through a fitted logistic
curve, is the score.  In both models

    P(w | v) = max(c(v, w) - D, 0) / c(v) + b(v) P(w)
    P(w)     = max(n(w) - D, 0) / n + b P0(w)

with c(v, w) the class's bigrams, n(w) how many different words come before w in
the class (n in all), and P0 the words' shares in *all* documents, labelled or
not: expressions too rare to tell the classes apart fall back on counts that
both classes share.  b and b(v) hold the mass that the discounts and the
left-out terms set free, so each distribution sums to one; the first word of a text, and
one after a word that no counted text has, has P(w).  A bigram counts once
a document, whatever the document repeats.  The larger class is brought to the
smaller one's size (its bigrams scaled, its kinds as expected in so many
documents), else the difference would measure how rare a word is.

Every word of the counted texts has its place, and every bigram its count.  Most differ
between the classes by chance only, and their differences together would drown the rest (of the
held-out toxic documents of sf0.1, 6 % are found with plain counts).  So a count c of a class
is drawn towards the classes' mean m by what speaks for a difference: c' = m + g (c - m), with
g = 1 / (1 + (``EVIDENCE`` / L)^``STEEP``).  L is the likelihood ratio statistic of the counts in the
classes, over 1 + their variance / ``SPREAD``; a bigram has its word's g if that is higher than its
own.  No size of the input changes these, and no count is left out.

Counts cover every document (P0) and every labelled row that may be learned
from, but for those that fit the logistic curve: of the ids with crc32 mod 5 = 1,
the ``CALIBRATION`` of least hash, or all if there are fewer.  Rows with crc32 mod 5 =
0 are never learned from.

A word or bigram whose counts are within the discount in both classes adds nothing to the
backoff: it gets the very same difference without an entry in the models.  So only the others are
kept, and one symbol stands for all words without an entry.

What is broadcast has a proven bound: the words and bigrams that reach a share of
``LEAST`` in a class, of which there are 1 / ``LEAST`` at most.  The rest, the
*tail*, stays in tables: a document's words and bigrams of the tail are joined to what
they add to its difference, so no result depends on ``LEAST``.  Two bitmaps of
fixed size keep most of what is not in the tail out of these joins.

Counting: batches of documents count their words and bigrams; words are packed
by hash into buckets, so what moves is one entry a batch for each different
word, and a very frequent word is no bottleneck.  All of it grows with the input.

Defined results: null and empty texts have no words, and a difference of 0; rows
without a label or a document are left out, repeated ones count as often as
they come; without rows of one class the score is 0.25 (only ordinary ones) or
0.75 (only toxic ones), without any labels 0.5; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

#: share in a class from which on a word or bigram is broadcast
LEAST = 2.0**-21
CALIBRATION = 20_000
#: what is taken off each count for the backoff
DISCOUNT = 0.8
#: of words and of bigrams (documents that are copies share all theirs): the evidence at which a count is half the class's own and half the classes' mean
EVIDENCE = (15.0, 200.0)
#: of both: the variance at which a count varies twice as much as by chance, as documents of one kind (say of one language) share their words
SPREAD = (2.0, 50.0)
#: how fast a count becomes the class's own around ``EVIDENCE``
STEEP = 4
_U = np.uint64
#: bits in the bitmaps of the tail's words and bigrams
_BITS = 23
#: bigrams that a task packs at once
_PACKED = 1 << 20


# ---------------------------------------------------------------- counting

def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, counts = np.unique(values, return_counts=True)
    return names, counts.astype(np.int64)


def _once(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The different values of each document: what one document says over and over counts once."""
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new]


def _batch_words(texts: pa.Array) -> np.ndarray:
    out = [np.empty(0, _U)]
    for a, b in A.slices(texts):
        found = A.words(texts.slice(a, b - a), A.NOT_ALNUM, fold=True)
        out.append(_once(found.hashes, found.doc_of_word()))
    return np.concatenate(out)


def _counted_words(bits: int):
    """Per batch: its different words with their counts, packed by bucket (label null: all documents)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, labels = [], batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False)
        for label in np.unique(labels).tolist():
            names, counts = _distinct(_batch_words(batch.column("text").filter(pa.array(labels == label))))
            bucket = (names >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
            ends = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(bucket)]
            rows += [(int(bucket[a]), label, A.binary(names[a:b]), A.binary(counts[a:b].astype(np.uint32)), int(counts[a:b].sum())) for a, b in zip(ends, ends[1:])]
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()))],
                                          names=["bucket", "label", "names", "counts", "n"])

    return run


def own_part(n0: np.ndarray, n1: np.ndarray, total0: float, total1: float, kind: int) -> np.ndarray:
    """How much of a count is the class's own, from 0 to 1: by the likelihood ratio statistic of the counts (0: of a word, 1: of a bigram) against one common share."""
    p = total1 / (total0 + total1)
    n = np.maximum(n0 + n1, 1e-9)
    part = lambda k, share: k * np.log(np.maximum(k, 1e-9) / (n * share))
    statistic = 2 * (part(n1, p) + part(n0, 1 - p)) / (1 + n * p * (1 - p) / SPREAD[kind])
    return 1 / (1 + (EVIDENCE[kind] / np.maximum(statistic, 1e-9)) ** STEEP)


def _known(totals: tuple[int, int], least: float):
    """Of a bucket: all words of the counted texts, with their number in all documents, how much of their counts is a class's own, and whether they reach a share of ``least`` in a class."""
    def run(bucket: pa.Table) -> pa.Table:
        labels = J.column(bucket, "label").to_numpy()
        names = [A.numbers(x, _U) for x in J.column(bucket, "names").to_pylist()]
        counts = [A.numbers(x, np.uint32) for x in J.column(bucket, "counts").to_pylist()]
        words, which = np.unique(np.concatenate(names), return_inverse=True)
        label, count = np.repeat(labels, [len(x) for x in names]), np.concatenate(counts)
        n0, n1, everywhere = (np.bincount(which, count * (label == k), len(words)) for k in (0, 1, -1))
        known = n0 + n1 > 0
        head = (n0 >= least * totals[0]) | (n1 >= least * totals[1])
        return pa.table({"word": pa.array(words[known].view(np.int64)), "n": pa.array(everywhere[known].astype(np.int64)), "seen": pa.array((n0 + n1)[known].astype(np.int64)),
                         "own": pa.array(own_part(n0, n1, *totals, 0)[known]), "bucket": pa.array(np.full(known.sum(), J.column(bucket, "bucket")[0].as_py())), "head": pa.array(head[known])})

    return run


def _bitmap(bits: DataFrame) -> np.ndarray:
    """2^_BITS bits, those of the column ``bit`` set, as bytes (1 MB, whatever the number of rows)."""
    place = F.col("bit") + 1  # Spark's bitmaps count from 1
    rows = bits.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros((1 << _BITS) // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * len(r.bits)
        out[at : at + len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _word_bits(words: np.ndarray) -> np.ndarray:
    return (words & _U((1 << _BITS) - 1)).astype(np.int64)


def _pair_bits(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _word_bits(A.mix(A.mix(before.astype(_U)) + words.astype(_U)))


def _near(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)


def _bigram_ids(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words before and of the words, each text's number of words, and the words' hashes.

    The last id is that of the place before a text and of words without an entry.
    """
    before, words, sizes, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, _U)]
    rare = len(vocabulary)
    for a, b in A.slices(texts):
        found = A.words(texts.slice(a, b - a), A.NOT_ALNUM, fold=True)
        at = np.searchsorted(vocabulary, found.hashes)
        ids = np.where(vocabulary[np.minimum(at, rare - 1)] == found.hashes, at, rare) if rare else np.full(len(found.hashes), rare)
        prev = np.concatenate([[rare], ids[:-1]])[: len(ids)]
        starts = found.first[:-1][found.counts > 0]
        prev[starts] = rare
        before.append(prev)
        words.append(ids)
        sizes.append(found.counts)
        hashes.append(found.hashes)
    return np.concatenate(before), np.concatenate(words), np.concatenate(sizes), np.concatenate(hashes)


def _pairs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different bigrams of some texts, by hashes (0: before a text), with the number of texts."""
    found = A.words(texts, A.NOT_ALNUM, fold=True)
    words, ids = np.unique(found.hashes, return_inverse=True)
    before = np.concatenate([[len(words)], ids[:-1]])[: len(ids)]
    before[found.first[:-1][found.counts > 0]] = len(words)
    pairs, counts = _distinct(_once((before << 32) | ids, found.doc_of_word()))
    return np.append(words, _U(0))[pairs >> 32], words[pairs & 0xFFFFFFFF], counts.astype(np.uint32)


def _counted_bigrams(bits: int, hot):
    """Per batch and label: its different bigrams, packed by bucket: all of one word in the bucket of the word, those of a hot one in many."""
    def pack(label: int, parts: list) -> pa.RecordBatch:
        v, w, n = (np.concatenate(x) for x in zip(*parts))
        key = np.where(np.isin(w, hot.value[0]), A.mix(v + A.mix(w)), w)
        bucket = (key >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
        order = np.lexsort((w, v, bucket))
        v, w, n, bucket = v[order], w[order], n[order], bucket[order]
        ends = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [len(bucket)]
        rows = [(int(bucket[a]), label, A.binary(v[a:b]), A.binary(w[a:b]), A.binary(n[a:b])) for a, b in zip(ends, ends[1:])]
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "label", "v", "w", "n"])

    def run(batch: pa.RecordBatch):
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for label in np.unique(labels).tolist():
            texts, parts = batch.column("text").filter(pa.array(labels == label)), []
            for a, b in A.slices(texts):
                parts.append(_pairs_of(texts.slice(a, b - a)))
                if sum(len(v) for v, _, _ in parts) >= _PACKED:
                    yield pack(label, parts)
                    parts = []
            if parts:
                yield pack(label, parts)

    return run


#: of a bucket of bigrams: sums by the word before (kind 0: context, left), by the word (kind 1: kinds, and whether a bigram has an entry), and entries (kind 2: count, left)
_SUMS = "kind int, v long, w long, x0 double, x1 double, left0 double, left1 double"


def _summed_bigrams(totals: tuple[int, int], hot):
    scale = [min(totals) / t for t in totals]

    def run(bucket: pa.Table, known: pa.Table) -> pa.Table:
        labels = J.column(bucket, "label").to_numpy()
        parts = [[np.empty(0, t)] + [A.numbers(x, t) for x in J.column(bucket, c).to_pylist()] for c, t in (("v", _U), ("w", _U), ("n", np.uint32))]
        label, (v, w, n) = np.repeat(labels, [len(x) for x in parts[0][1:]]), (np.concatenate(x) for x in parts)
        (vs, v), (ws, w) = (np.unique(x, return_inverse=True) for x in (v, w))
        pairs, which = np.unique((v << 32) | w, return_inverse=True)
        v, w = pairs >> 32, pairs & 0xFFFFFFFF
        counts = [np.bincount(which, n * (label == k), len(pairs)) for k in (0, 1)]
        names, own = np.append(hot.value[0], J.column(known, "word").to_numpy().view(_U)), np.append(hot.value[1], J.column(known, "own").to_numpy())
        names, first = np.unique(names, return_index=True)
        own = np.maximum(own[first][np.searchsorted(names, ws)][w], own_part(*counts, *totals, 1))
        scaled = [x * s for x, s in zip(counts, scale)]
        mean = (scaled[0] + scaled[1]) / 2
        c = [mean + own * (x - mean) for x in scaled]
        left = [np.maximum(x - DISCOUNT, 0) for x in c]
        inner = vs[v] != 0  # a text's first word has no context
        entry = np.flatnonzero(inner & ((left[0] > 0) | (left[1] > 0)))
        kinds = [1 - (1 - s) ** x for x, s in zip(counts, scale)]
        sums = lambda at, x, names: np.bincount(at, x, len(names))
        mine = np.flatnonzero(vs != 0)
        second = np.bincount(w[entry], minlength=len(ws))
        none = lambda x: np.zeros(len(x), _U)
        rows = [(0, vs[mine], none(mine), *(sums(v, x, vs)[mine] for x in (*c, *left))),
                (1, none(ws), ws, *(sums(w, x, ws) for x in kinds), second, second),
                (2, vs[v[entry]], ws[w[entry]], *(x[entry] for x in (*c, *left)))]
        columns = [np.concatenate([np.full(len(r[1]), r[0], np.int32) for r in rows])] + [np.concatenate([np.asarray(r[i]) for r in rows]) for i in range(1, 7)]
        columns[1:3] = [x.view(np.int64) for x in columns[1:3]]
        columns[3:] = [x.astype(float) for x in columns[3:]]
        return pa.table({name: pa.array(x) for name, x in zip(("kind", "v", "w", "x0", "x1", "left0", "left1"), columns)})

    return run


# ------------------------------------------------------------------- model

@dataclass
class ClassModel:
    word: np.ndarray  # P(w)
    context: np.ndarray  # c(v)
    backoff: np.ndarray  # b(v)
    pairs: np.ndarray  # kept bigrams, ascending
    counts: np.ndarray  # their c(v, w) - D

    def log_likelihood(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        p = self.backoff[before] * self.word[words]
        if len(self.pairs):
            key = (before << 32) | words
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = np.flatnonzero(self.pairs[at] == key)
            p[hit] += self.counts[at[hit]] / self.context[before[hit]]
        return np.log(p)


@dataclass
class Tail:
    """What is not broadcast."""

    words: DataFrame  # word, and what it adds to a difference beyond a word without an entry: own, and next for the word after it
    pairs: DataFrame  # v, w (ids, or hashes without one), and what the bigram adds to the difference by backoff
    word_marks: np.ndarray
    pair_marks: np.ndarray


@dataclass
class Toxicity:
    vocabulary: np.ndarray | None = None
    ordinary: ClassModel | None = None
    toxic: ClassModel | None = None
    slope: float = 1.0
    middle: float = 0.0
    constant: float | None = None
    tail: Tail | None = None

    def difference(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood under the toxic model less that under the ordinary one, per word."""
        out = []
        for a, b in A.slices(texts):
            before, words, sizes, _ = _bigram_ids(texts.slice(a, b - a), self.vocabulary)
            each = self.toxic.log_likelihood(before, words) - self.ordinary.log_likelihood(before, words)
            total = np.concatenate([[0.0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(sizes)])]
            out.append(np.diff(total) / np.maximum(sizes, 1))
        return np.concatenate(out) if out else np.empty(0)

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.difference(texts) - self.middle), -40, 40)))


def _models(sums: DataFrame, known: DataFrame, everywhere: float, totals: tuple[int, int], least: float) -> tuple[np.ndarray, ClassModel, ClassModel, Tail | None]:
    """Vocabulary and models from ``_SUMS`` and the words (``word, n, own, head``); what comes to the driver is bounded by 1 / ``least``."""
    size = min(totals)
    rest = sums.where("kind = 2").select("v", "w", F.col("x0").alias("c0"), F.col("x1").alias("c1"), F.col("left0").alias("n0"), F.col("left1").alias("n1"))
    v = sums.where("kind = 0").groupBy(F.col("v").alias("word")).agg(*(F.sum(f"x{k}").alias(f"context{k}") for k in (0, 1)), *(F.sum(f"left{k}").alias(f"left{k}") for k in (0, 1)))
    w = sums.where("kind = 1").groupBy(F.col("w").alias("word")).agg(*(F.sum(f"x{k}").alias(f"kinds{k}") for k in (0, 1)), (F.sum("left0") > 0).alias("second"))
    words = known.join(w, "word", "left").join(v, "word", "left").fillna(0.0).withColumn("second", F.coalesce("second", F.lit(False)))
    mean = (F.col("kinds0") + F.col("kinds1")) / 2
    words = J.cut_lineage(words.withColumns({f"kinds{k}": mean + F.col("own") * (F.col(f"kinds{k}") - mean) for k in (0, 1)}))
    free = words.agg(*(F.sum(f"kinds{k}") for k in (0, 1)), *(F.sum(F.greatest(F.col(f"kinds{k}") - DISCOUNT, F.lit(0.0))) for k in (0, 1))).first()
    total, free = free[:2], [1 - free[2 + k] / free[k] for k in (0, 1)]  # free: of P(w), for P0

    columns = ["word", (F.col("n") + 1).alias("n"), "head"]
    for k in (0, 1):
        context = F.greatest(F.col(f"context{k}"), F.lit(1e-9))
        columns += [(F.greatest(F.col(f"kinds{k}") - DISCOUNT, F.lit(0.0)) / total[k] + free[k] * (F.col("n") + 1) / everywhere).alias(f"word{k}"),
                    context.alias(f"context{k}"), F.greatest(1 - F.col(f"left{k}") / context, F.lit(1e-9)).alias(f"backoff{k}")]
    words = words.where(f"second OR left0 > 0 OR left1 > 0 OR kinds0 > {DISCOUNT} OR kinds1 > {DISCOUNT}").select(*columns)
    shares = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.bool_and("head"), F.lit(True)).alias("all")).first()
    head = words.where("head").toArrow()
    names = head["word"].to_numpy().view(_U)
    order = np.argsort(names)
    vocabulary, rare = names[order], len(names)
    often = F.greatest("c0", "c1") >= least * size
    place = lambda c: words.where("head").select(F.col("word").alias(c), F.lit(True).alias(f"_{c}"))
    rest = rest.join(place("v"), "v", "left").join(place("w"), "w", "left").withColumn("often", often & F.coalesce("_v", F.lit(False)) & F.coalesce("_w", F.lit(False)))
    rest = J.cut_lineage(rest.select("v", "w", "n0", "n1", "often"))
    kept = rest.where("often").toArrow()
    v, w = (np.searchsorted(vocabulary, kept[c].to_numpy().view(_U)) for c in ("v", "w"))
    pairs = (v.astype(np.int64) << 32) | w
    by, out = np.argsort(pairs), []
    for k in (0, 1):
        own = {c: head[f"{c}{k}"].to_numpy()[order] for c in ("word", "context", "backoff")}
        out.append(ClassModel(np.append(own["word"], free[k] * (everywhere - shares.n) / everywhere), np.append(own["context"], 1e-9), np.append(own["backoff"], 1.0),
                              pairs[by], kept[f"n{k}"].to_numpy()[by]))
    rest = rest.where("NOT often").select("v", "w", "n0", "n1")
    if shares.all and rest.isEmpty():
        return vocabulary, *out, None

    ids = _ids(sums.sparkSession, vocabulary)
    rest = rest.join(words.select(F.col("word").alias("v"), *(f"{c}{k}" for c in ("context", "backoff") for k in (0, 1))), "v").join(words.select(F.col("word").alias("w"), "word0", "word1"), "w")
    gain = [F.log1p(F.col(f"n{k}") / (F.col(f"context{k}") * F.col(f"backoff{k}") * F.col(f"word{k}"))) for k in (0, 1)]
    rest = rest.select("v", "w", (gain[1] - gain[0]).alias("adds"))
    for c in ("v", "w"):  # in the tail's tables ids stand for the words that have one
        rest = rest.join(ids.withColumnRenamed("word", c), c, "left").withColumn(c, F.coalesce("id", c)).drop("id")
    rest = J.cut_lineage(rest.select("v", "w", "adds"))
    more = lambda c: F.log(F.col(f"{c}1") / F.col(f"{c}0")) - float(np.log(getattr(out[1], c)[rare] / getattr(out[0], c)[rare]))
    words = J.cut_lineage(words.where("NOT head").select("word", more("word").alias("own"), more("backoff").alias("next")))
    bits = J.map_arrow(rest.select("v", "w"), lambda b: J.batch_of(bit=pa.array(_pair_bits(b.column("v").to_numpy(), b.column("w").to_numpy()), pa.int64())), "bit long")
    marks = _bitmap(words.select(F.col("word").bitwiseAND(F.lit((1 << _BITS) - 1)).alias("bit")))
    return vocabulary, *out, Tail(words, rest, marks, _bitmap(bits))


def _ids(spark, vocabulary: np.ndarray) -> DataFrame:
    """``word, id``: what stands for the words of the vocabulary in the tail's tables."""
    return spark.createDataFrame(pa.table({"word": pa.array(vocabulary.view(np.int64)), "id": pa.array(np.arange(len(vocabulary)))}))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the curve that fits labels best, by Newton's method with a weak pull to a flat one."""
    mean, width = x.mean(), max(x.std(), 1e-9)
    z = np.stack([np.ones(len(x)), (x - mean) / width], 1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag([1e-6, 1e-2])
        w += np.linalg.solve(hessian, z.T @ (y - p) - np.array([1e-6, 1e-2]) * w)
    slope = max(w[1], 1e-3) / width
    return float(slope), float(mean - w[0] / slope)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> Toxicity:
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = labels.where(F.col(label_col).isNotNull() & ~J.held_out(id_col)).select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("long").alias("label"))
    learned = J.cut_lineage(J.known_rows(texts, marked, "id").withColumn("key", F.monotonically_increasing_id()), "zstd")
    wanted = learned.where(F.crc32(F.col("id").cast("string")) % 5 == 1).select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(CALIBRATION)
    wanted = J.cut_lineage(wanted.withColumn("fit", F.lit(True)))
    learned = learned.join(F.broadcast(wanted), "id", "left").withColumn("fit", F.coalesce("fit", F.lit(False)))
    counted = learned.where("NOT fit").select("key", "label", "text")

    size = J.text_bytes(texts, "text")
    bits = J.power_of_two(size / 12 / (1 << 20))
    everything = texts.select(F.lit(None).cast("long").alias("label"), "text").unionByName(counted.drop("key"))
    packed = J.map_arrow(everything, _counted_words(bits), "bucket long, label long, names binary, counts binary, n long")
    packed = J.cut_lineage(packed, "zstd")
    length = {r.label: r.n for r in packed.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not (length.get(0) and length.get(1)):
        return Toxicity(constant=0.25 if length.get(0) else 0.75 if length.get(1) else 0.5)
    totals = (length[0], length[1])
    words = J.cut_lineage(packed.groupBy("bucket").applyInArrow(_known(totals, least), "word long, n long, seen long, own double, bucket long, head boolean"))
    known, others = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first(), length.get(-1, 0)
    everywhere = known.n + known.words + max(1.0, others - known.n) + 1

    hot = words.where(F.col("seen") * 1024 >= sum(totals)).select("word", "own").toArrow()
    hot = spark.sparkContext.broadcast((hot["word"].to_numpy().view(_U), hot["own"].to_numpy()))
    packed = J.map_arrow(counted.select("label", "text"), _counted_bigrams(bits, hot), "bucket long, label long, v binary, w binary, n binary")
    known_words = words.select("bucket", "word", "own").groupBy("bucket")
    sums = J.cut_lineage(packed.groupBy("bucket").cogroup(known_words).applyInArrow(_summed_bigrams(totals, hot), _SUMS), "zstd")
    vocabulary, ordinary, toxic, rest = _models(sums, words, everywhere, totals, least)
    model = Toxicity(vocabulary, ordinary, toxic, tail=rest)

    sample = differences(learned.where("fit").select("label", "text"), model).select("label", "x").toArrow()
    x, y = sample["x"].to_numpy(), sample["label"].to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        model.slope, model.middle = _logistic(x, y)
    return model


def _lists(doc: np.ndarray, size: int, **columns) -> pa.ListArray:
    """Of each text the different rows of ``columns`` (with the places ``doc``), and their number ``n``."""
    rows = np.stack([doc, *columns.values()])
    rows = rows[:, np.lexsort(rows[::-1])]
    first = np.flatnonzero(np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))[: len(doc)])
    offsets = np.searchsorted(rows[0][first], np.arange(size + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in (*rows[1:, first], np.diff(np.append(first, len(doc))))], [*columns, "n"]))


def _with_tail_differences(rows: DataFrame, model: Toxicity, text_col: str) -> DataFrame:
    """:func:`differences` of a model with a tail: sums over what is broadcast; what may be in the tail, not the texts, is joined to it."""
    spark, tail = rows.sparkSession, model.tail
    kept = [f for f in rows.schema.fields if f.name != text_col]
    rows = rows.select(*(F.col(f.name).alias(f"_{n}") for n, f in enumerate(kept)), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast((replace(model, tail=None), tail.word_marks, tail.pair_marks))

    def run(batch: pa.RecordBatch):
        (m, word_marks, pair_marks), texts = shared.value, batch.column("text")
        rare, pairs = len(m.vocabulary), m.toxic.pairs
        for a, b in A.slices(texts):
            v, w, sizes, hashes = _bigram_ids(texts.slice(a, b - a), m.vocabulary)
            each = m.toxic.log_likelihood(v, w) - m.ordinary.log_likelihood(v, w)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            total, doc = np.diff(np.concatenate([[0.0], np.cumsum(each)])[ends]), np.repeat(np.arange(len(sizes)), sizes)
            key, tails = (v << 32) | w, (w == rare) & _near(word_marks, _word_bits(hashes))
            last = np.zeros(len(w), bool)
            last[ends[1:][sizes > 0] - 1] = True
            at = np.flatnonzero(tails)
            found = _lists(doc[at], len(sizes), word=hashes.view(np.int64)[at], last=last[at].astype(np.int64))
            w = np.where(tails, hashes.view(np.int64), w)
            v = np.where(np.append(True, last[:-1])[: len(w)], rare, np.append(rare, w[:-1])[: len(w)])
            near = _near(pair_marks, _pair_bits(v, w)) & (v != rare) & (w != rare)
            if len(pairs):
                near &= pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] != key
            at = np.flatnonzero(near)
            part = batch.slice(a, b - a)
            yield J.batch_of(**{f"_{n}": part.column(f"_{n}") for n in range(len(kept))}, total=pa.array(total, pa.float64()), size=pa.array(sizes, pa.int64()),
                             words=found, pairs=_lists(doc[at], len(sizes), v=v[at], w=w[at]))

    types = "".join(f"_{n} {f.dataType.simpleString()}, " for n, f in enumerate(kept))
    parts = J.map_arrow(rows, run, f"{types}total double, size long, words array<struct<word:bigint,last:bigint,n:bigint>>, pairs array<struct<v:bigint,w:bigint,n:bigint>>")
    parts = J.cut_lineage(parts.withColumn("key", F.monotonically_increasing_id()))
    words = parts.select("key", F.inline("words")).join(tail.words.hint("merge"), "word")
    pairs = parts.select("key", F.inline("pairs")).join(tail.pairs.hint("merge"), ["v", "w"])
    found = words.select("key", (F.col("n") * (F.col("own") + (1 - F.col("last")) * F.col("next"))).alias("more")).unionByName(pairs.select("key", (F.col("n") * F.col("adds")).alias("more")))
    found = found.groupBy("key").agg(F.sum("more").alias("more"))
    x = (F.col("total") + F.coalesce(F.col("more"), F.lit(0.0))) / F.greatest(F.col("size"), F.lit(1))
    return parts.drop("words", "pairs").join(found.hint("merge"), "key", "left").select(*(F.col(f"_{n}").alias(f.name) for n, f in enumerate(kept)), x.alias("x"))


def differences(rows: DataFrame, model: Toxicity, text_col: str = "text") -> DataFrame:
    """``rows`` (without their text) with ``x``, the difference per word."""
    if model.tail is not None:
        return _with_tail_differences(rows, model, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in rows.schema.fields if f.name != text_col]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return J.batch_of(**{f.name: batch.column(f.name) for f in kept}, x=pa.array(shared.value.difference(batch.column(text_col)), pa.float64()))

    return J.map_arrow(rows, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", x double")


def scored(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model.tail is not None:
        x = F.least(F.greatest(model.slope * (F.col("x") - model.middle), F.lit(-40.0)), F.lit(40.0))
        out = differences(rows, model).select("doc_id", (1 / (1 + F.exp(-x))).alias("score"))
        return out.select("doc_id", J.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see LEAST

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return J.batch_of(doc_id=batch.column("doc_id"), score=pa.array(shared.value.score(batch.column("text")), pa.float64()))

    out = J.map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", J.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
