"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts and items are normalised alike (A-Z lower-cased, words of letters, digits
and any non-ASCII bytes).  All items go into one suffix automaton over words; a
document's words are streamed through it, which gives, at each word, the length
of the longest run ending there that some item contains.  A window is
``window`` consecutive words of an item, or a whole shorter item; every word
inside an occurrence of a window is hit.

The automaton is built from at most ``BLOCK_BYTES`` of item text and broadcast;
a larger benchmark is dealt into such blocks, one pass over the documents each,
with a written table in the shared folder between passes, so memory is bounded
by a block and nothing is left out.  Documents never move: a pass is one map.

A stretch of a document is streamed only where its runs of ``g`` words (3, or
the shortest window) occur in the items and are long enough for a window:
elsewhere the automaton's length would stay under every window's.

Defined results: null and empty texts have no words and no hits; items without
words have no windows; equal item ids count once, a null id as an empty string;
an empty benchmark hits nothing; further columns pass through unread, also if
they are called like those of the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm import arrays as A
from sightline.llm import jobs as J

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: a document with a greater part of hit words than this goes as a whole
MAX_COVERAGE = 0.5
#: hit spans of fewer words than this stay (a window is the least there is)
MIN_SPAN = 1


class Automaton:
    """Suffix automaton of several word sequences. State 0 is the empty run."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary = np.empty(0, np.uint64)
        found = A.words(pa.array([t for _, t in items], pa.string()), A.NOT_ALNUM, fold=True)
        self.vocabulary, ids = np.unique(found.hashes, return_inverse=True)
        runs = [(name, ids[a:b].tolist()) for (name, _), a, b in zip(items, found.first, found.first[1:]) if b > a]
        self.shortest = min([window, *(len(r) for _, r in runs)]) if runs else 0
        self.gram = min(3, self.shortest)
        for _, run in runs:
            state = 0
            for w in run:
                state = self._extend(state, w)
        self._name(runs)
        grams = [A.windows(self.vocabulary[np.array(r)], self.gram) for _, r in runs]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.empty(0, np.uint64)

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _split(self, state: int, w: int) -> int:
        """The state of ``state``'s longest run followed by ``w``, parted from longer runs if need be."""
        there = self.next[state][w]
        if self.length[there] == self.length[state] + 1:
            return there
        own = self._state(self.length[state] + 1, self.link[there], dict(self.next[there]))
        self.link[there] = own
        while state >= 0 and self.next[state].get(w) == there:
            self.next[state][w] = own
            state = self.link[state]
        return own

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and w not in self.next[last]:
            self.next[last][w] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, w)
        return new

    def _name(self, runs: list[tuple[str, list[int]]]) -> None:
        """Which items hold a state's runs, and which short items are a suffix of them."""
        owners: list[set[str]] = [set() for _ in self.length]
        short: list[list[tuple[int, str]]] = [[] for _ in self.length]
        for name, run in runs:
            state = 0
            for w in run:
                state = at = self.next[state][w]
                while at > 0 and self.length[at] >= self.window and name not in owners[at]:
                    owners[at].add(name)
                    at = self.link[at]
            if len(run) < self.window:
                short[state].append((len(run), name))
        self.window_of, self.short = [-1] * len(owners), short
        for state in sorted(range(len(owners)), key=self.length.__getitem__):
            up = self.link[state]
            if up >= 0:
                short[state] = short[state] + short[up]
                if self.length[state] >= self.window:
                    self.window_of[state] = self.window_of[up] if self.length[up] >= self.window else state
        self.owners = [sorted(x) for x in owners]

    def stream(self, run: list[int], at: int, hit: np.ndarray, names: set[str]) -> None:
        """Feeds the words ``run``, from place ``at`` of ``hit`` on; marks the words of occurring windows."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        for i, w in enumerate(run, at + 1):
            while state and w not in moves[state]:
                state = link[state]
                matched = length[state]
            if w not in moves[state]:
                continue
            state = moves[state][w]
            matched += 1
            if matched >= self.window:
                hit[i - self.window : i] = True
                names.update(self.owners[self.window_of[state]])
            for n, name in self.short[state]:
                if n <= matched:
                    hit[i - n : i] = True
                    names.add(name)

    def scan(self, found: A.Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Hit words of a run of texts, and by text the items with occurring windows."""
        hit, names = np.zeros(len(found.hashes), bool), {}
        if not self.shortest:
            return hit, names
        grams = A.windows(found.hashes, self.gram)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = (self.grams[at] == grams) & A.window_starts(found.first, self.gram, len(found.hashes))
        before, after = np.zeros_like(known), np.zeros_like(known)
        before[1:], after[:-1] = known[:-1], known[1:]
        edge = found.first[(found.first > 0) & (found.first < len(known))]
        before[edge], after[edge - 1] = False, False
        begins, ends = np.flatnonzero(known & ~before), np.flatnonzero(known & ~after) + self.gram
        long = ends - begins >= self.shortest
        owner = np.searchsorted(found.first, begins, "right") - 1
        for a, b, d in zip(begins[long].tolist(), ends[long].tolist(), owner[long].tolist()):
            run = np.searchsorted(self.vocabulary, found.hashes[a:b]).tolist()
            self.stream(run, a, hit, names.setdefault(d, set()))
        return hit, names


def _spans(mask: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()


def mark(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES, finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """``docs`` with ``__n_words``, ``__spans`` (hit words: start and end in turn) and ``__items`` (ids as strings, sorted).

    ``finish``: makes rows of ``docs`` of each marked batch, in the last pass itself: two maps in a row would take two
    Python workers a core, all of which stay.
    """
    spark = docs.sparkSession
    n_blocks = max(1, -(-J.text_bytes(items, item_text) // block_bytes))
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).cast("string").alias("text"))
    out = docs.withColumns({"__n_words": F.lit(0).cast("long"), "__spans": F.array().cast("array<long>"), "__items": F.array().cast("array<string>")})
    marked = T.StructType(out.schema.fields)
    for block in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block) if n_blocks > 1 else items
        automaton = spark.sparkContext.broadcast(Automaton([(r.id, r.text) for r in part.collect()], window))

        last = finish if block == n_blocks - 1 else None

        def run(batch: pa.RecordBatch, automaton=automaton, last=last):
            texts, before, named = batch.column(text_col), batch.column("__spans"), batch.column("__items")
            for a, b in A.slices(texts):
                found = A.words(texts.slice(a, b - a), A.NOT_ALNUM, fold=True)
                hit, names = automaton.value.scan(found)
                spans, ids = [], []
                for d, (i, j) in enumerate(zip(found.first.tolist(), found.first[1:].tolist())):
                    mask, old = hit[i:j], before[a + d].as_py()
                    for x, y in zip(old[::2], old[1::2]):
                        mask[x:y] = True
                    spans.append(_spans(mask) if old or d in names else [])
                    ids.append(sorted({*named[a + d].as_py(), *names.get(d, ())}))
                new = {"__n_words": pa.array(found.counts, pa.int64()), "__spans": pa.array(spans, pa.list_(pa.int64())), "__items": pa.array(ids, pa.list_(pa.string()))}
                rows = pa.RecordBatch.from_arrays([new.get(c) if c in new else batch.column(c).slice(a, b - a) for c in batch.schema.names], names=batch.schema.names)
                yield last(rows) if last else rows

        out = J.map_arrow(out, run, docs.schema if last else marked)
        if n_blocks > 1:
            out = J.cut_lineage(out)
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans`` for each row."""
    marked = mark(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), items, "text", item_id, item_text, window, block_bytes)
    ends = F.filter("__spans", lambda x, i: i % 2 == 1)
    starts = F.filter("__spans", lambda x, i: i % 2 == 0)
    n_hit = F.aggregate(F.zip_with(ends, starts, lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return marked.select(
        "doc_id", F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"), (F.size("__spans") > 0).alias("contaminated"),
        F.col("__items").alias("items"), F.col("__spans").alias("spans"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without its hit spans of ``min_span`` words or more; documents of more than ``max_coverage`` hit words go.

    What is left of a text stays byte for byte; where a span was, its parts are joined by one space.
    """
    schema = docs.schema

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column(text_col), batch.column("__spans").to_pylist()
        keep, new = np.ones(batch.num_rows, bool), texts.to_pylist()
        for d, span in enumerate(spans):
            if not span:
                continue
            found = A.words(texts.slice(d, 1), A.NOT_ALNUM, fold=True)
            pairs = [(x, y) for x, y in zip(span[::2], span[1::2]) if y - x >= min_span]
            keep[d] = sum(y - x for x, y in zip(span[::2], span[1::2])) <= max_coverage * len(found.hashes)
            raw, pieces, last = found.buf.tobytes(), [], 0
            for x, y in pairs:
                pieces.append(raw[last : found.starts[x]].rstrip())
                last = int(found.ends[y - 1])
            pieces.append(raw[last:].lstrip() if pairs else raw)
            new[d] = b" ".join(p for p in pieces if p).decode()
        kept = pa.array(np.flatnonzero(keep))
        cols = [pa.array(new, pa.string()) if f.name == text_col else batch.column(f.name) for f in schema.fields]
        return pa.RecordBatch.from_arrays([c.take(kept) for c in cols], names=[f.name for f in schema.fields])

    return mark(docs, items, text_col, item_id, item_text, window, block_bytes, cut)
