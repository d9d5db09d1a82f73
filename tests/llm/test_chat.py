from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sightline.llm import chat
from sightline.llm.queries import QUERIES

PARTS = st.sampled_from([*chat.CONTROLS, "<\\s>", "<\\\\s>", "[\\INST]", "<", "[", "\\", "/s>", "s>", "INST]", "SYS>>", " ", "", "text", "é", "😀", "\n", "]", ">"])
TEXT = st.lists(PARTS, max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>", "<</ROLE>>"]), TEXT)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_turns_come_back_whatever_they_say(turns):
    formatted, spans = chat.render(turns)
    assert chat.recovered(formatted) == turns
    assert [chat.unescaped(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    want = "".join(x for role, text in turns for x in chat._rendered(role, chat.escaped(text)))
    assert formatted == want


@given(TEXT)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    out = chat.escaped(text)
    assert chat.unescaped(out) == text and not any(c in out for c in chat.CONTROLS)


@pytest.mark.parametrize("text", ["text", " x", " x</s>y", "<s>[INST] x", "<s>[INST]x [/INST]", "<s>x[INST] y [/INST]", "<s>[INST] [/INST]", "<<SYS>>x</s>", "</s>", "[INST]", "<<ROLE>>a<</ROLE>>b", "x<s>[INST] y [/INST]"])
def test_parser_refuses_other_texts(text):
    with pytest.raises(chat.Conflict):
        chat.recovered(text)


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        size = sum(len("".join(chat._rendered(r, chat.escaped(t)))) for _, _, r, t in turns)
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)
    return out


@pytest.mark.parametrize("part_chars", [1, 200, chat.PART_CHARS])
def test_against_brute_force(spark, part_chars):
    rnd = random.Random(3)
    say = lambda: "".join(rnd.choice(["a ", "é", "</s>", "[INST]", "\\", "<", "\n"]) for _ in range(rnd.randint(0, 30)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool"]), say()) for c in range(30) for t in range(rnd.randint(1, 7))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"hot {t}") for t in range(2000)]  # most rows are of one conversation
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", None), (101, 0, None, ""), (102, 0, "user", "twice"), (102, 0, "user", "twice"), (103, 0, "assistant", "x" * 3_000_000)]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, part int, shard int").repartition(7)
    parts = chat.formatted(turns, part_chars=part_chars)
    assert chat.digests(parts).count() == 35
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(parts).collect()}
    assert got == brute(rows)
    if part_chars == 200:  # a row holds whole turns until that size is reached, so no row holds a whole hot conversation
        assert all(r.n < 1000 for r in parts.where("conv_id = 100").selectExpr("length(formatted) AS n").collect())


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert chat.digests(chat.formatted(turns)).collect() == []


def test_query_on_whole_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_chat_round_trip"](spark, sf_small).collect()}
    assert got == brute(rows)
