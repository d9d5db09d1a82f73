"""Quality rules as a bitmask ledger: measure once, decide by policy.

Each document is measured once and each rule evaluated once; the ledger keeps
the measurements and one bit for every rule that fails.  A policy is a set of
rules under a version, that is a mask; applying another version, or asking what
a rule alone removes, only needs the bits.

Defined results: null and empty texts have no words and fail what an empty text
fails; rows are judged one by one, so repeated rows get the same verdict each;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

#: a rule fails where its condition on the measurements holds; its bit is its place
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_phrases": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "100 * n_dup_lines > 75 * n_lines",
    "shouting": "100 * n_upper > 50 * n_letters",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 16 * n_words",
}
#: rules by policy version; a version never changes once it was used
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_phrases"),
    "1": ("few_words", "repeated_phrases", "symbols", "repeated_lines"),
    "2": ("few_words", "repeated_phrases", "symbols", "repeated_lines", "shouting", "short_words", "long_words"),
}
CURRENT = "2"

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
_SYMBOLS = A.separators(b"#*$%&|<>")
_UPPER = A.separators(bytes(range(65, 91)))
_LETTERS = A.separators(bytes([*range(65, 91), *range(97, 123)]))
_BLANK = b" \t\n\x0b\x0c\r"


def _in_texts(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks)])
    return np.diff(total[offsets])


def _measure(texts: pa.Array) -> dict[str, np.ndarray]:
    found = A.words(texts)
    buf, offsets, n = found.buf, found.offsets, len(found.hashes)
    ok = np.flatnonzero(A.window_starts(found.first, 3, n))
    window, doc = A.windows(found.hashes, 3)[ok], found.doc_of_word()[ok]
    order = np.lexsort((window, doc))
    same = (window[order][1:] == window[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    again = np.zeros(n + 1, bool)
    again[ok[order[1:][same]]] = again[ok[order[:-1][same]]] = True
    repeated = A.covered(again[:n], 3, n) if n else np.zeros(0, bool)
    raw, lines, dups = buf.tobytes(), [], []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        own = [x for x in raw[a:b].split(b"\n") if x.strip(_BLANK)]
        lines.append(len(own))
        dups.append(len(own) - len(set(own)))
    return {
        "n_words": found.counts, "word_chars": _in_texts(~A.SPACE[buf] & (buf & 0xC0 != 0x80), offsets), "n_symbols": _in_texts(_SYMBOLS[buf], offsets),
        "n_dup_lines": np.array(dups, np.int64), "n_repeat_words": _in_texts(repeated, found.first), "n_lines": np.array(lines, np.int64),
        "n_upper": _in_texts(_UPPER[buf], offsets), "n_letters": _in_texts(_LETTERS[buf], offsets),
    }


def _measured(batch: pa.RecordBatch):
    for a, b in A.slices(batch.column("text")):
        rows = batch.slice(a, b - a)
        yield J.batch_of(doc_id=rows.column("doc_id"), **{k: pa.array(v, pa.int64()) for k, v in _measure(rows.column("text")).items()})


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(version: str) -> int:
    return sum(bit(r) for r in POLICIES[version])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements, and ``failed``: the bits of the rules that fail."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = J.map_arrow(rows, _measured, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in _MEASURES))
    failed = F.lit(0).cast("long")
    for rule, condition in RULES.items():
        failed = failed + F.when(F.expr(condition), F.lit(bit(rule)).cast("long")).otherwise(F.lit(0).cast("long"))
    return measured.withColumn("failed", failed)


def kept(version: str = CURRENT) -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(version)).cast("long")) == 0


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", version: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` (the base policy's verdict) and ``kept`` (that of ``version``, and not failed by the base)."""
    return ledger(docs, id_col, text_col).withColumns({"base_failed": ~kept("base"), "kept": kept("base") & kept(version)})


def ablation(rows: DataFrame) -> DataFrame:
    """``version, rule, n_docs, n_kept, n_failed, n_only``: for each rule of each policy, over a ledger.

    ``n_failed`` documents fail the rule, ``n_only`` fail no other rule of the
    policy: so many more were kept without it.  One pass, whatever the number of rules.
    """
    sums = [F.count("*").alias("n_docs")]
    for v in POLICIES:
        sums.append(F.coalesce(F.sum(kept(v).cast("long")), F.lit(0)).alias(f"kept_{v}"))
        under = F.col("failed").bitwiseAND(F.lit(mask(v)).cast("long"))
        sums += [F.coalesce(F.sum((under == bit(r)).cast("long")), F.lit(0)).alias(f"only_{v}_{r}") for r in POLICIES[v]]
    sums += [F.coalesce(F.sum((F.col("failed").bitwiseAND(F.lit(bit(r)).cast("long")) != 0).cast("long")), F.lit(0)).alias(f"failed_{r}") for r in RULES]
    lines = F.array(*(F.struct(F.lit(v).alias("version"), F.lit(r).alias("rule"), F.col("n_docs"), F.col(f"kept_{v}").alias("n_kept"),
                               F.col(f"failed_{r}").alias("n_failed"), F.col(f"only_{v}_{r}").alias("n_only")) for v in POLICIES for r in POLICIES[v]))
    return rows.agg(*sums).select(F.inline(lines))
