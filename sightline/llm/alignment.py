"""Cross-tokenizer alignment by sparse products of token-byte incidence matrices.

Two tokenizers cut the bytes of a space and a text in two ways.  In matrices of
tokens x bytes, A and B, the product A Bᵀ holds for each pair of tokens how many bytes
they share: the overlap links.  Where, going along these links, both tokens
change at once, both end at one byte: there a group ends.  Products of token x
group matrices hold for each pair of ids how often it shares a group: the shared-group
links.  Matrices are compressed by rows (:class:`CSR`), and products are formed
row by row after Gustavson: a row of the product is the sum of the rows of the
second matrix that the row of the first one names.

Work on a text is cut where no token of either tokenizer reaches across: before a
space after a character that is no white space and before one that is none.  All
matrices are block diagonal there, so a worker aligns each different piece once
and remembers it by a 64-bit hash; texts are sums over their pieces.

How many documents hold a pair of ids linked is counted in Spark.  A block (a
batch of documents) keeps each document's different pairs in numbers and gives one
row for each of its pairs, with the number of its documents that hold it.  Those
are summed over the corpus, each first id's highest count is found, and the
answers go back to the blocks.  So what moves is a row for each block and pair,
neither texts nor a row a document, and a pair that is everywhere is summed
before it is shuffled.

Defined results: null and empty texts, and texts whose tokens don't spell space +
text (such as those with U+2581, which the second tokenizer reads as a space), have no tokens:
zeros and an empty text of groups.  Repeated rows, and rows that share
an id or have none, are documents of their own, each counted.  An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

_U = np.uint64
SLICE_BYTES = 1 << 19
#: text of a block: the documents whose pairs are counted and answered together
BLOCK_BYTES = 8 << 20
#: pieces that a worker remembers; beyond, it starts anew (no result depends on it)
REMEMBERED = 500_000
#: pieces that are aligned at once
LEARNED = 1 << 15
#: entries of a product that are formed at once
PRODUCT = 1 << 20


# --------------------------------------------------------- sparse matrices

@dataclass
class CSR:
    """A sparse matrix by rows: row r has ``values[indptr[r]:indptr[r + 1]]`` in the columns ``indices`` there, in rising order."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    @classmethod
    def of(cls, row: np.ndarray, column: np.ndarray, values: np.ndarray, rows: int, columns: int) -> CSR:
        """From entries in any order; those of one place are added up."""
        key = row.astype(np.int64) * columns + column
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, values = key[order], values[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        values = np.add.reduceat(values, new) if len(new) else values[:0]
        key = key[new]
        return cls(np.searchsorted(key, np.arange(rows + 1) * columns), key % columns if columns else key, values, columns)

    @classmethod
    def spans(cls, starts: np.ndarray, ends: np.ndarray, columns: int) -> CSR:
        """Incidence of rows that cover the columns from ``starts`` to ``ends``."""
        size = ends - starts
        indptr = np.concatenate([[0], np.cumsum(size)])
        indices = np.arange(indptr[-1]) - np.repeat(indptr[:-1] - starts, size)
        return cls(indptr, indices, np.ones(len(indices), np.int64), columns)

    def transposed(self) -> CSR:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return CSR(indptr, self.row_of_entry()[order], self.values[order], self.rows)


def product(a: CSR, b: CSR) -> CSR:
    """a b, by rows: of each row of ``a``, the rows of ``b`` that its entries name are scaled and added up."""
    if a.columns != b.rows:
        raise ValueError("the matrices don't fit")
    named = np.diff(b.indptr)[a.indices]
    work = np.concatenate([[0], np.cumsum(named)])[a.indptr]
    parts, row = [], 0
    while row < a.rows:  # whole rows, of about PRODUCT entries together
        stop = min(a.rows, max(row + 1, int(np.searchsorted(work, work[row] + PRODUCT, "right")) - 1))
        own = slice(a.indptr[row], a.indptr[stop])
        count, take = named[own], a.indices[own]
        ends = np.cumsum(count)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(b.indptr[take] - ends + count, count)
        rows = np.repeat(np.repeat(np.arange(stop - row), np.diff(a.indptr[row : stop + 1])), count)
        parts.append(CSR.of(rows, b.indices[at], np.repeat(a.values[own], count) * b.values[at], stop - row, b.columns))
        row = stop
    if not parts:
        return CSR(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), b.columns)
    shift = np.cumsum([0, *(len(p.indices) for p in parts)])
    indptr = np.concatenate([[0], *(p.indptr[1:] + s for p, s in zip(parts, shift))])
    return CSR(indptr, np.concatenate([p.indices for p in parts]), np.concatenate([p.values for p in parts]), b.columns)


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's group, from the ends of the tokens of both sides over the same bytes."""
    size = int(a_ends[-1]) if len(a_ends) else 0
    a = CSR.spans(np.concatenate([[0], a_ends[:-1]]), a_ends, size)
    b = CSR.spans(np.concatenate([[0], b_ends[:-1]]), b_ends, size)
    links = product(a, b.transposed())
    i, j = links.row_of_entry(), links.indices
    group = np.cumsum((np.diff(i, prepend=i[:1]) > 0) & (np.diff(j, prepend=j[:1]) > 0))
    a_group, b_group = np.empty(len(a_ends), np.int64), np.empty(len(b_ends), np.int64)
    a_group[i], b_group[j] = group, group
    return a_group, b_group


def shared_links(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece (``piece``: that of each group) its linked pairs of ids and how many links each has."""
    groups = len(piece)
    (a_names, a_row), (b_names, b_row) = (np.unique((piece[g] << 32) | ids, return_inverse=True) for ids, g in ((a_ids, a_group), (b_ids, b_group)))
    a = CSR.of(a_row, a_group, np.ones(len(a_row), np.int64), len(a_names), groups)
    b = CSR.of(b_row, b_group, np.ones(len(b_row), np.int64), len(b_names), groups)
    links = product(a, b.transposed())
    left, right = a_names[links.row_of_entry()], b_names[links.indices]
    low = (1 << 32) - 1
    return left >> 32, left & low, right & low, links.values


# -------------------------------------------------------------- tokenizing

def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenBytes:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[_runs(self.start[ids], self.size[ids])]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        of, named = _byte_level(), self.a.get_vocab(with_added_tokens=False)
        tokens = [b""] * (1 + max(named.values()))
        for token, i in named.items():
            tokens[i] = bytes(of[c] for c in token)
        self.bytes = TokenBytes(tokens), TokenBytes([self._piece(i) for i in range(self.b.get_piece_size())])

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """By each tokenizer: the ids of pieces, which are a space and more, one after the other, and how many each has."""
        sides = [], []
        for k in range(0, len(pieces), 4096):  # an encoding is many times as large as its ids
            some = pieces[k : k + 4096]
            sides[0].extend(e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False))
            sides[1].extend(self.b.encode([p[1:] for p in some], num_threads=1))  # which puts a space before
        return [(np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))) for ids in sides]


# white space characters of more than one byte
_WIDE_SPACE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WIDE_KEYS = np.array(sorted(int.from_bytes(chr(c).encode(), "big") for c in _WIDE_SPACE))


def _ends_space(buf: np.ndarray) -> np.ndarray:
    """Marks the last bytes of white space characters."""
    space = A.SPACE[buf].copy()
    space |= (buf >= 0x1C) & (buf <= 0x1F)
    high = np.flatnonzero(buf >= 0x80)
    if len(high):
        two = np.where(high > 0, buf[np.maximum(high - 1, 0)], 0).astype(np.int64)
        three = np.where(high > 1, buf[np.maximum(high - 2, 0)], 0).astype(np.int64)
        last = buf[high].astype(np.int64)
        wide = np.isin((three << 16) | (two << 8) | last, _WIDE_KEYS) | np.isin(((two << 8) | last), _WIDE_KEYS)
        space[high[wide]] = True
    return space


@dataclass
class Cut:
    buf: np.ndarray  # a space and the text, of each text
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # of each piece
    hashes: np.ndarray


def cut(texts: pa.Array) -> Cut:
    """The pieces of texts; empty texts have none."""
    buf, offsets = A.utf8(texts)
    size = np.diff(offsets)
    filled = np.flatnonzero(size)
    buf = np.insert(buf, offsets[:-1][filled], 32)
    begin = offsets[:-1][filled] + np.arange(len(filled))
    border = np.zeros(len(buf), bool)
    if len(buf):
        spaced = _ends_space(buf)
        plain = ~A.SPACE[buf]
        border[1:-1] = (buf[1:-1] == 32) & ~spaced[:-2] & plain[2:]
        border[begin[1:] - 1] = False  # the last byte of a text
        border[begin] = True
    starts = np.flatnonzero(border)
    ends = np.append(starts[1:], len(buf))[: len(starts)]
    length = ends - starts
    hashes, table, at = np.empty(len(starts), _U), A._byte_table(0, False), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + A.SLICE_BYTES)))
        own = length[at:stop]
        place = np.arange(int(own.sum())) - np.repeat(starts[at:stop] - starts[at], own)
        sums = np.add.reduceat(table[buf[starts[at] : ends[stop - 1]]] * A._powers(int(own.max()))[place], starts[at:stop] - starts[at])
        hashes[at:stop] = A.mix(sums + own.astype(_U))
        at = stop
    return Cut(buf, starts, ends, filled[np.searchsorted(begin, starts, "right") - 1], hashes)


class Aligner:
    """Aligned pieces, remembered: numbers, linked pairs and the written groups of each."""

    def __init__(self, byte_level: str, pieces: bytes):
        self.tokenizers = Tokenizers(byte_level, pieces)
        self.forget()

    def forget(self) -> None:
        self.known, self.slot = np.empty(0, _U), np.empty(0, np.int64)
        self.counts = np.empty((0, 4), np.int64)  # tokens of a, of b, groups, links; -1 where tokens don't spell the piece
        self.first = np.zeros(1, np.int64)  # pair, times: those of slot s from first[s] to first[s + 1]
        self.pair, self.times = np.empty(0, np.int64), np.empty(0, np.int64)
        self.written: list[bytes] = []

    def _learn(self, hashes: np.ndarray, raw: np.ndarray, size: np.ndarray) -> None:
        """Aligns pieces of ``size`` bytes each, which ``raw`` holds one after the other."""
        n, text, ends = len(size), raw.tobytes(), np.cumsum(size)
        edges = [0, *ends.tolist()]
        sides = self.tokenizers.encode([text[x:y].decode() for x, y in zip(edges, edges[1:])])
        spelt = np.ones(n, bool)
        for (ids, count), of in zip(sides, self.tokenizers.bytes):
            total = np.bincount(np.repeat(np.arange(n), count), of.size[ids], n).astype(np.int64)
            spelt &= total == size
        for (ids, count), of in zip(sides, self.tokenizers.bytes):
            wrong = of.joined(ids[np.repeat(spelt, count)]) != raw[np.repeat(spelt, size)]
            if wrong.any():
                spelt[np.repeat(np.flatnonzero(spelt), size[spelt])[wrong]] = False
        counts = np.full((n, 4), -1)
        counts[spelt] = 0
        written, pair, times, first = [b""] * n, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n + 1, np.int64)
        if spelt.any():
            (a, a_count), (b, b_count) = ((ids[np.repeat(spelt, count)], np.where(spelt, count, 0)) for ids, count in sides)
            a_group, b_group = groups_of(*(np.cumsum(of.size[ids]) for ids, of in zip((a, b), self.tokenizers.bytes)))
            piece = np.repeat(np.arange(n), a_count)[np.flatnonzero(np.diff(a_group, prepend=-1))]  # of each group
            row, left, right, times = shared_links(a, a_group, b, b_group, piece)
            pair = (left << 32) | right
            first = np.searchsorted(row, np.arange(n + 1))
            counts += np.where(spelt[:, None], np.stack([a_count, b_count, np.bincount(piece, minlength=n), np.bincount(row, times, n).astype(np.int64)], 1), 0)
            texts = self._write(a, a_group, b, b_group)
            edge = np.searchsorted(piece, np.arange(n + 1)).tolist()
            written = [";".join(texts[x:y]).encode() for x, y in zip(edge, edge[1:])]
        where = np.searchsorted(self.known, hashes)
        self.slot = np.insert(self.slot, where, len(self.counts) + np.arange(n))
        self.known = np.insert(self.known, where, hashes)
        self.counts = np.concatenate([self.counts, counts])
        self.first = np.concatenate([self.first, self.first[-1] + first[1:]])
        self.pair, self.times = np.concatenate([self.pair, pair]), np.concatenate([self.times, times])
        self.written += written

    @staticmethod
    def _write(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray) -> list[str]:
        """Each group as ``a1,a2|b1``."""
        sides = []
        for ids, group in ((a, a_group), (b, b_group)):
            text = list(map(str, ids.tolist()))
            edge = np.searchsorted(group, np.arange(int(group[-1]) + 2)).tolist()
            sides.append([text[x] if y - x == 1 else ",".join(text[x:y]) for x, y in zip(edge, edge[1:])])
        return list(map("|".join, zip(*sides)))

    def slots(self, found: Cut) -> np.ndarray:
        """The slot of each piece; new ones are aligned."""
        hashes, at, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(hashes, self.known, assume_unique=True))
        for k in range(0, len(new), LEARNED):
            some = at[new[k : k + LEARNED]]
            size = found.ends[some] - found.starts[some]
            self._learn(found.hashes[some], found.buf[_runs(found.starts[some], size)], size)
        return self.slot[np.searchsorted(self.known, hashes)][which]


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(models) -> Aligner:
    key = hash(models)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*models)
    return _ALIGNERS[key]


# ------------------------------------------------------------------ blocks

def _documents(aligner: Aligner, texts: pa.Array):
    """Of each text: the four numbers (-1: its tokens don't spell it), the written groups, and its linked pairs as (document, pair, times)."""
    n = len(texts)
    found = cut(texts)
    slots = aligner.slots(found)
    bad = np.zeros(n, bool)
    bad[found.text[aligner.counts[slots, 0] < 0]] = True
    good = ~bad[found.text]
    doc, slots = found.text[good], slots[good]
    numbers = np.stack([np.bincount(doc, aligner.counts[slots, k], n).astype(np.int64) for k in range(4)], 1)
    numbers[bad] = -1
    edge, listed = np.searchsorted(doc, np.arange(n + 1)).tolist(), slots.tolist()
    written = [b";".join([aligner.written[s] for s in listed[x:y]]) for x, y in zip(edge, edge[1:])]
    key, often = np.unique((doc << 32) | slots, return_counts=True)
    of = key & ((1 << 32) - 1)
    size = aligner.first[of + 1] - aligner.first[of]
    place, which = _runs(aligner.first[of], size), np.repeat(np.arange(len(of)), size)
    return numbers, written, *_summed((key >> 32)[which], aligner.pair[place], aligner.times[place] * often[which])


def _summed(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's pairs, once: they come from several of its pieces."""
    order = np.lexsort((pair, doc))
    doc, pair, times = doc[order], pair[order], times[order]
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
    return doc[new], pair[new], np.add.reduceat(times, new) if len(new) else times[:0]


def _segments(raw: bytes) -> Iterator[bytes]:
    """A long text in segments of about SLICE_BYTES, parted (and without the space) where :func:`cut` begins a piece too."""
    at = 0
    while at < len(raw):
        stop = raw.find(b" ", at + SLICE_BYTES)
        while 0 < stop < len(raw) - 1 and not (32 < raw[stop - 1] < 127 and raw[stop + 1] > 32):
            stop = raw.find(b" ", stop + 1)
        stop = stop if 0 < stop < len(raw) - 1 else len(raw)
        yield raw[at:stop]
        at = stop + 1


def _digested(aligner: Aligner, texts: pa.Array):
    """Like :func:`_documents`, with digests in place of the written groups, zeros where tokens don't spell a text, and one long text segment by segment."""
    if len(texts) > 1 or not texts[0].is_valid or (raw := texts[0].as_buffer().to_pybytes()) is None or len(raw) <= 2 * SLICE_BYTES:
        numbers, written, *pairs = _documents(aligner, texts)
        return np.maximum(numbers, 0), [hashlib.sha256(w).hexdigest() if w else "" for w in written], *pairs
    numbers, digest, pairs = np.zeros((1, 4), np.int64), hashlib.sha256(), (np.empty(0, np.int64),) * 3
    for k, segment in enumerate(_segments(raw)):
        more, written, *found = _documents(aligner, pa.array([segment], pa.string()))
        if more[0, 0] < 0:
            return np.zeros((1, 4), np.int64), [""], *((np.empty(0, np.int64),) * 3)
        numbers += more
        digest.update(b";" * (k > 0) + written[0])
        pairs = _summed(*(np.concatenate(x) for x in zip(pairs, found)))
        if len(aligner.known) > REMEMBERED:
            aligner.forget()
    return numbers, [digest.hexdigest()], *pairs


@dataclass
class Block:
    """Documents with their linked pairs, in numbers."""

    ids: list
    numbers: list
    digests: list
    docs: list
    pairs: list
    times: list
    rows: int = 0

    @classmethod
    def empty(cls) -> Block:
        return cls([], [], [], [], [], [])

    def add(self, ids: pa.Array, numbers, digests, doc, pair, times) -> None:
        self.ids.append(ids)
        self.numbers.append(numbers)
        self.digests += digests
        self.docs.append(doc + self.rows)
        self.pairs.append(pair)
        self.times.append(times)
        self.rows += len(ids)

    def row(self, part: int, number: int) -> pa.RecordBatch:
        ids, numbers = pa.concat_arrays(self.ids), np.concatenate(self.numbers)
        doc, pair, times = (np.concatenate(x) for x in (self.docs, self.pairs, self.times))
        names, index, held = np.unique(pair, return_inverse=True, return_counts=True)
        one = lambda v, t: pa.array([v], t)
        many = lambda v, t: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t))
        return J.batch_of(
            part=one(part, pa.int32()), block=one(number, pa.int32()), doc_ids=pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            numbers=one(A.binary(numbers.astype("<i8")), pa.binary()), digests=many(self.digests, pa.string()),
            sizes=one(A.binary(np.bincount(doc, minlength=self.rows).astype("<u4")), pa.binary()), index=one(A.binary(index.astype("<u4")), pa.binary()), times=one(A.binary(times.astype("<u4")), pa.binary()),
            a=many(names >> 32, pa.int32()), b=many(names & ((1 << 32) - 1), pa.int32()), held=many(held, pa.int32()))


_BLOCK = "part int, block int, doc_ids array<{kind}>, numbers binary, digests array<string>, sizes binary, index binary, times binary, a array<int>, b array<int>, held array<int>"


def _blocks(shared, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, size, number, part = _aligner(shared.value), Block.empty(), 0, 0, 0
        for batch in batches:
            texts = J.column(batch, "text")
            for x, y in A.slices(texts, SLICE_BYTES):
                rows = batch.slice(x, y - x)
                part = rows.column("part")[0].as_py()
                if len(aligner.known) > REMEMBERED:
                    aligner.forget()
                block.add(rows.column("id"), *_digested(aligner, rows.column("text")))
                size += len(A.utf8(rows.column("text"))[0])
                if size >= block_bytes:
                    yield block.row(part, number)
                    block, size, number = Block.empty(), 0, number + 1
                    J.give_back()
        if block.rows:
            yield block.row(part, number)
        J.give_back()

    return run


def _models(byte_level_path: str, pieces_path: str) -> tuple[str, bytes]:
    with open(byte_level_path, encoding="utf-8") as f, open(pieces_path, "rb") as g:
        return f.read(), g.read()


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``part, block, place, a, b, held``: the pairs of each block; and ``a, b, count, best``: how many documents hold a pair, and whether no pair of ``a`` is in more."""
    pairs = blocks.select("part", "block", F.posexplode(F.arrays_zip("a", "b", "held")).alias("place", "p")).select("part", "block", "place", "p.a", "p.b", "p.held")
    counts = pairs.groupBy("a", "b").agg(F.sum("held").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return pairs, counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def _answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of a block's documents."""
    blob = lambda c, t: A.numbers(b"".join(blocks.column(c).to_pylist()), t)  # noqa: E731  of one row
    place = J.column(answers, "place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = J.column(answers, "count").to_numpy(), J.column(answers, "best").to_numpy(zero_copy_only=False)
    index, times, sizes = (blob(c, "<u4").astype(np.int64) for c in ("index", "times", "sizes"))
    numbers = blob("numbers", "<i8").reshape(-1, 4)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    total = lambda v: pa.array(np.bincount(doc, v, len(sizes)).astype(np.int64))  # noqa: E731  below 2^53
    return pa.table({"doc_id": J.column(blocks, "doc_ids").flatten(), **{c: pa.array(numbers[:, k]) for k, c in enumerate(_NUMBERS[:4])},
                     "n_best": total(times * best[index]), "count_sum": total(times * count[index]), "groups_sha256": J.column(blocks, "digests").flatten()})


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def aligned(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row.

    ``count_sum`` adds up, over the links of a document, how many documents hold
    the link's pair of ids; ``n_best`` counts the links whose pair is in as many
    as any pair of its first id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_models(byte_level_path, pieces_path))  # the vocabularies: their size is fixed
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    blocks = J.cut_lineage(rows.mapInArrow(_blocks(shared, block_bytes), _BLOCK.format(kind=kind.simpleString())))
    pairs, counts = pair_counts(blocks)
    answers = pairs.drop("held").join(counts.hint("merge"), ["a", "b"]).select(F.col("part").alias("to_part"), F.col("block").alias("to_block"), "place", "count", "best")
    own = blocks.drop("a", "b", "held")
    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", groups_sha256 string"
    return own.groupBy("part", "block").cogroup(answers.groupBy("to_part", "to_block")).applyInArrow(J.trimmed_pair(_answered), schema)


def alignments(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, groups``: the alignment itself, the groups as ``a1,a2|b1;a3|b2,b3`` in ids of both tokenizers."""
    shared = docs.sparkSession.sparkContext.broadcast(_models(byte_level_path, pieces_path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value)
        for x, y in A.slices(batch.column("text"), SLICE_BYTES):
            part = batch.slice(x, y - x)
            if len(aligner.known) > REMEMBERED:
                aligner.forget()
            yield J.batch_of(doc_id=part.column("id"), groups=pa.array(_documents(aligner, part.column("text"))[1], pa.string()))

    return J.map_arrow(rows, run, f"doc_id {rows.schema['id'].dataType.simpleString()}, groups string")
