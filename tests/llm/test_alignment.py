from __future__ import annotations

import collections
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sightline.llm import alignment as AL
from sightline.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------ brute force

@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def chars_of_bytes():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, k = {}, 0
    for b in range(256):
        out[chr(b) if b in shown else chr(256 + k)] = b
        k += b not in shown
    return out


CHARS = chars_of_bytes()


def groups(both, text):
    """The groups of a whole text, without cutting it."""
    if not text:
        return []
    a, b = both
    raw = (" " + text).encode()
    ai, bi = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ab = [bytes(CHARS[c] for c in a.id_to_token(i)) for i in ai]
    bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in bi)]
    if b"".join(ab) != raw or b"".join(bb) != raw:
        return []
    ends = [dict(zip(np.cumsum([len(t) for t in side]).tolist(), range(1, len(side) + 1))) for side in (ab, bb)]
    cuts, out, i, j = sorted(ends[0].keys() & ends[1].keys()), [], 0, 0
    for c in cuts:
        out.append((ai[i : ends[0][c]], bi[j : ends[1][c]]))
        i, j = ends[0][c], ends[1][c]
    return out


def brute(both, rows):
    of = [groups(both, t) for _, t in rows]
    links = [[(x, y) for g in gs for x in g[0] for y in g[1]] for gs in of]
    count = collections.Counter(p for ls in links for p in set(ls))
    highest = collections.defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for (d, _), gs, ls in zip(rows, of, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((d, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(ls), sum(count[p] == highest[p[0]] for p in ls), sum(count[p] for p in ls),
                    hashlib.sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(out, key=str)


# ------------------------------------------------------------------ tests

@settings(max_examples=100, deadline=None)
@given(st.integers(0, 6), st.integers(1, 6), st.integers(1, 6), st.randoms(use_true_random=False), st.sampled_from([1, 3, 1 << 20]))
def test_product_of_sparse_matrices(n, m, k, rnd, at_once):
    dense = [np.array([[rnd.choice([0, 0, 1, 2]) for _ in range(c)] for _ in range(r)], np.int64).reshape(r, c) for r, c in ((n, m), (m, k))]
    sparse = [AL.CSR.of(*np.nonzero(d), d[np.nonzero(d)], *d.shape) for d in dense]
    old, AL.PRODUCT = AL.PRODUCT, at_once
    try:
        got = AL.product(*sparse)
    finally:
        AL.PRODUCT = old
    back = np.zeros((n, k), np.int64)
    back[got.row_of_entry(), got.indices] = got.values
    assert (back == dense[0] @ dense[1]).all() and got.rows == n
    t = sparse[1].transposed()
    assert t.rows == k and [t.indices[a:b].tolist() for a, b in zip(t.indptr, t.indptr[1:])] == [np.flatnonzero(c).tolist() for c in dense[1].T]


@pytest.fixture(scope="module")
def aligner():
    return AL.Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())


PARTS = st.sampled_from(["word", " ", " ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\u0085", "\x1c", "Straße", "naïve", "日本語", "😀", "don't", "'re", "...", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "é", "é", "▁", "123", "½", "\x00", "_", "aaaaaaa", "=====", "ﬁ"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=10).map("".join), min_size=1, max_size=4))
def test_pieces_give_the_groups_of_whole_texts(aligner, both, texts):
    written = AL._documents(aligner, pa.array(texts, pa.string()))[1]
    assert [w.decode() for w in written] == [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups(both, t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(PARTS, max_size=60).map("".join))
def test_long_texts_in_segments(aligner, text):
    old, AL.SLICE_BYTES = AL.SLICE_BYTES, 10
    try:
        short = AL._documents(aligner, pa.array([text], pa.string()))
        numbers, digests, *pairs = AL._digested(aligner, pa.array([text], pa.string()))
    finally:
        AL.SLICE_BYTES = old
    assert numbers.tolist() == np.maximum(short[0], 0).tolist() and digests == [hashlib.sha256(short[1][0]).hexdigest() if short[1][0] else ""]
    assert [x.tolist() for x in pairs] == [x.tolist() for x in short[2:]]


ROWS = [(1, "two words"), (2, None), (3, ""), (4, "two  words\nmore"), (4, "two  words\nmore"), (5, "bad ▁ text"), (None, "no id"), (6, " "), (7, "the cat " * 400), (8, "Straße 日本語 😀 naïve"), (9, "x" * 3000), (10, "two"), (11, "<|endoftext|> </s>")]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_against_brute_force(spark, both, block_bytes):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in ROWS], "doc_id long, text string, n_a int, block string").repartition(3)
    got = [tuple(r) for r in AL.aligned(docs, *PATHS, block_bytes=block_bytes).collect()]
    assert sorted(got, key=str) == brute(both, ROWS)


def test_written_groups(spark, both):
    docs = spark.createDataFrame([("a", "two words"), ("b", None), ("c", "▁")], "doc_id string, text string")
    got = {r.doc_id: r.groups for r in AL.alignments(docs, *PATHS).collect()}
    assert got["b"] == got["c"] == "" and got["a"] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups(both, "two words"))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert AL.aligned(docs, *PATHS).collect() == []


def test_query_on_whole_table(spark, sf_small, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_tokenizer_alignment"](spark, sf_small).collect()]
    assert sorted(got, key=str) == brute(both, rows)
