"""Language of web pages by Bayesian fusion of what text, markup and address say.

For a page and each language l,

    P(l | page)  ~  P(text | l)^t  *  P(declared | l)  *  P(l | host)

* Text: byte trigrams (A-Z lower-cased, other ASCII but letters as one space)
  under one distribution a language, counted over *all* labelled documents and
  hashed to ``SLOTS`` places.  Neighbouring trigrams say much the same, so n of
  them weigh as n * ``TEXT_WEIGHT`` / (n + ``TEXT_WEIGHT``).
* Declared: the primary tag of the html element's lang attribute, or none.
  P(declared | l) comes from all pages: how often pages of language l, as far as
  their text says, declare what.
* Host prior, smoothed by hierarchy: P(l | host) draws on the pages of the host,
  then on those with the same address suffix, then on all pages; each level adds
  ``PRIOR_WEIGHT`` pages' worth of the one above.  A page's own share is taken
  out of the counts first, so it doesn't vote for itself.

The counts are grouped aggregations of the pages' text posteriors over language,
which combine before the shuffle; pages are cut to a few numbers beforehand, so
a host that has a third of all pages moves little and its join is split by
adaptive execution.  The model's size is languages times ``SLOTS``; more than
``MOST_LANGUAGES`` are refused.

Defined results: a null page or one without text relies on markup and address; a
null address, or one without a host, is the host and suffix ''; an unknown
declared language counts as it is found to be used; null or empty language
labels teach nothing; without any labelled document the language is null and the
probability 0; repeated rows are pages each; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

SLOTS = 1 << 16
TEXT_WEIGHT = 40.0
PRIOR_WEIGHT = 5.0
MOST_LANGUAGES = 256

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


# -------------------------------------------------------------------- text

def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams within each text, and the text of each; runs of spaces say nothing."""
    buf, offsets = A.utf8(texts)
    if len(buf) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    b = _FOLD[buf]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    ok = (b[:-2] != 32) | (b[1:-1] != 32)
    for back in (1, 2):
        cut = offsets[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    at = np.flatnonzero(ok)
    slot = (A.mix(code[at].astype(np.uint64)) >> np.uint64(48)).astype(np.int64) % SLOTS
    return slot, np.searchsorted(offsets, at, "right") - 1


def _counted(batch: pa.RecordBatch):
    langs = batch.column("lang").to_numpy(zero_copy_only=False)
    for lang in sorted(set(langs)):
        total = np.zeros(SLOTS, np.int64)
        texts = batch.column("text").filter(pa.array(langs == lang))
        for a, b in A.slices(texts):
            total += np.bincount(_trigrams(texts.slice(a, b - a))[0], minlength=SLOTS)
        yield J.batch_of(lang=pa.array([lang]), counts=pa.array([A.binary(total.astype(float))], pa.binary()))


def _added(group: pa.Table) -> pa.Table:
    total = np.zeros(SLOTS)
    for blob in J.column(group, "counts"):
        total += A.numbers(blob.as_py(), np.float64)
    return pa.table({"lang": pa.array([J.column(group, "lang")[0].as_py()]), "counts": pa.array([A.binary(total)], pa.binary())})


class TextModel:
    """Log-probabilities of trigram slots by language."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        table = np.array([counts[x] for x in self.languages]).reshape(len(counts), SLOTS)
        pooled = table.sum(0) + 0.5
        pooled /= pooled.sum()
        table = table + 100 * pooled  # rare trigrams: as in all languages together
        self.logs = np.log(table / table.sum(1, keepdims=True)).astype(np.float32).T.copy()

    def log_likelihoods(self, texts: pa.Array) -> np.ndarray:
        """Weighted, by text and language."""
        out = []
        for a, b in A.slices(texts):
            slot, doc = _trigrams(texts.slice(a, b - a))
            n = np.bincount(doc, minlength=b - a).astype(float)
            total = np.stack([np.bincount(doc, self.logs[slot, k], b - a) for k in range(len(self.languages))], 1)
            out.append(total * (TEXT_WEIGHT / (n + TEXT_WEIGHT))[:, None])
        return np.concatenate(out) if out else np.empty((0, len(self.languages)))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", hold_out: bool = False) -> TextModel | None:
    """Counted over all labelled documents; with ``hold_out`` (to measure accuracy) without those whose id as text has crc32 mod 5 = 0."""
    kept = ~J.held_out(id_col) if hold_out else F.lit(True)
    rows = docs.where((F.col(lang_col) != "") & kept).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    n = rows.agg(F.count_distinct("lang")).first()[0]
    if n > MOST_LANGUAGES:
        raise ValueError(f"{n} languages; the model holds {MOST_LANGUAGES}")
    packed = J.map_arrow(rows, _counted, "lang string, counts binary")
    packed = packed.withColumn("salt", F.spark_partition_id() % 16)  # partial sums of a common language side by side
    part = packed.groupBy("lang", "salt").applyInArrow(_added, "lang string, counts binary")
    found = part.groupBy("lang").applyInArrow(_added, "lang string, counts binary").collect()  # a row a language
    return TextModel({r.lang: A.numbers(r.counts, np.float64) for r in found}) if found else None


# ------------------------------------------------------------------- pages

def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?\w{1,20};", " ")


def declared_language(html: Column) -> Column:
    """The primary tag, lower-cased, of the html element's lang attribute; '' without one."""
    return F.lower(F.coalesce(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,8})""", 1), F.lit("")))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+)\.?$", 1)


def _posteriors(pages: DataFrame, model: TextModel) -> DataFrame:
    """``page_id, declared, host, suffix, ll`` of pages; ``ll``: text log-likelihoods by language, the best at 0."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # at most MOST_LANGUAGES x SLOTS numbers

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ll = shared.value.log_likelihoods(batch.column("text"))
        ll -= ll.max(1, keepdims=True)
        edges = pa.array(np.arange(len(ll) + 1) * ll.shape[1], pa.int32())
        return J.batch_of(page_id=batch.column("page_id"), declared=batch.column("declared"), host=batch.column("host"),
                          ll=pa.ListArray.from_arrays(edges, pa.array(ll.ravel(), pa.float64())))

    kind = pages.schema["page_id"].dataType.simpleString()
    return J.map_arrow(pages, run, f"page_id {kind}, declared string, host string, ll array<double>").withColumn("suffix", suffix_of(F.col("host")))


def identify(pages: DataFrame, model: TextModel | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, lang, probability, text_lang, declared, host, suffix`` for each row."""
    html = F.col(html_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), declared_language(html).alias("declared"), host_of(F.col(url_col)).alias("host"), visible_text(html).alias("text"))
    if model is None:
        none = F.lit(None).cast("string")
        return rows.select("page_id", none.alias("lang"), F.lit(0.0).alias("probability"), none.alias("text_lang"), "declared", "host", suffix_of(F.col("host")).alias("suffix"))
    langs = range(len(model.languages))
    rows = J.cut_lineage(_posteriors(rows, model))
    total = F.aggregate("ll", F.lit(0.0), lambda a, x: a + F.exp(x))
    rows = rows.withColumn("p", F.transform("ll", lambda x: F.exp(x) / total))

    def shares(*by: str) -> DataFrame:
        """Pages by language (summed text posteriors) of each group, as an array ``n_<first column>``."""
        sums = rows.groupBy(*by).agg(*(F.sum(F.col("p")[k]).alias(f"s{k}") for k in langs))
        return sums.select(*by, F.array(*(f"s{k}" for k in langs)).alias(f"n_{by[0] if by else 'all'}"))

    tags = rows.agg(F.count_distinct("declared").alias("n_tags"))
    out = rows.withColumns({"n_all": shares().scalar(), "n_tags": tags.scalar()})
    out = out.join(shares("declared"), "declared").join(shares("suffix"), "suffix").join(shares("host"), "host")
    # one's own share leaves each count
    left = lambda n: F.zip_with(n, "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    mass = lambda n: F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
    out = out.withColumns({n: left(n) for n in ("n_all", "n_suffix", "n_host", "n_declared")})
    out = out.withColumn("prior", F.transform("n_all", lambda x: (x + 1) / (mass("n_all") + len(langs))))
    for level in ("n_suffix", "n_host"):
        out = out.withColumn("mass", mass(level))
        out = out.withColumn("prior", F.zip_with(level, "prior", lambda n, p: (n + PRIOR_WEIGHT * p) / (F.col("mass") + PRIOR_WEIGHT)))
    said = F.zip_with("n_declared", "n_all", lambda n, a: (n + 0.5) / (a + 0.5 * (F.col("n_tags") + 1)))
    fused = F.zip_with(F.zip_with("ll", said, lambda x, s: x + F.log(s)), "prior", lambda x, p: x + F.log(p))
    out = out.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    names = F.array(*(F.lit(x) for x in model.languages))
    best = lambda c, top: F.element_at(names, F.array_position(c, top).cast("int"))
    return out.select("page_id", best(F.col("fused"), F.col("top")).alias("lang"),
                      (1 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"),
                      best(F.col("ll"), F.array_max("ll")).alias("text_lang"), "declared", "host", "suffix")
