from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sightline.llm import token_files as TF
from sightline.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70000), st.integers(0, 2**32 - 1)), max_size=60))
def test_codes_round_trip(values):
    codes = np.array(values, np.uint32)
    assert TF.unpack(*TF.pack(codes), len(codes)).tolist() == values


def test_ranks_follow_frequency():
    table, codes = TF.ranked(np.array([5, 9, 9, 7, 5, 9]))
    assert table.tolist() == [9, 5, 7] and table[codes].tolist() == [5, 9, 9, 7, 5, 9]


@pytest.fixture(scope="module")
def pair():
    model = open(PATH, encoding="utf-8").read()
    return Tokenizer.from_str(model), TF.Pieces(model)


PARTS = st.sampled_from(["word", "IT'S", "don't", "'re", "é", "é", "≠", "«", "»", ".", "...", "<|endoftext|>", "<|startoftext|>", "|>", "x<|", "#", " ", "\n", "\t", " ", " ", "7", "½", "Σ", "İ", "日本", "-", "_", "‍", "\x00", "\x0b"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=9).map("".join), min_size=1, max_size=4))
def test_pieces_give_the_ids_of_whole_texts(pair, texts):
    whole, pieces = pair
    flat, counts = pieces.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def brute(rows):
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 200, "block_tokens": 20}, {"pieces": False}])
def test_files_against_brute_force(spark, options):
    rows = [(7, "A long  text, with\nlines."), (3, None), (-5, ""), (9, "tie"), (9, "tie"), (9, "other"), (None, "no id"), (12, "word " * 300)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in TF.tokenized(docs, PATH, **options).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert TF.tokenized(docs, PATH).collect() == []


def test_ids_are_read_back(spark, tmp_path):
    docs = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
    TF.write_tokens(docs, f"{tmp_path}/t", PATH)
    ids = {r.doc_id: r.ids for r in TF.read_tokens(spark, f"{tmp_path}/t").collect()}
    assert ids == {1: [*Tokenizer.from_file(PATH).encode("two words", add_special_tokens=False).ids, 2], 2: [2]}


def test_query_on_whole_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op4_token_files"](spark, sf_small).collect()), key=lambda r: r[1])
    assert got == brute(rows)


def test_coding_takes_little_memory_besides_the_codes():
    rnd = np.random.default_rng(3)
    codes = np.concatenate([rnd.integers(0, top, n) for top, n in ((1 << 8, 4 * TF.PART - 3), (1 << 16, 4 * TF.PART + 5), (1 << 24, 4 * TF.PART), (1 << 32, 4 * TF.PART))]).astype(np.uint32)
    tracemalloc.start()
    try:
        control, data = TF.pack(codes)
        packed = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        back = TF.unpack(control, data, len(codes))
        unpacked = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert (back == codes).all() and len(TF.unpack(b"", b"", 0)) == 0 and TF.pack(codes[:0]) == (b"", b"")
    assert packed <= 3 * codes.nbytes and unpacked <= 3 * codes.nbytes, (packed / codes.nbytes, unpacked / codes.nbytes)
