r"""Chat formatting, proved by a grammar round trip.

Turns are rendered by a template that a deterministic parser reads back:

    conversation = { turn }
    turn = "<s>[INST] " text " [/INST]"             a user
         | " " text "</s>"                          an assistant
         | "<<SYS>>" text "<</SYS>>"                a system message
         | "<<ROLE>>" name "<</ROLE>>" text "</s>"  any other role

Control strings (``CONTROLS``) stand between texts only; the parser needs no
lookahead beyond the next of them.  What is rendered is parsed again and its
turns are compared to the source; the turns that did not come back get their text escaped,
until all are identical.  Escaping puts one backslash after the
first character of a control string, and of a control string with backslashes in
that place; the parser takes one away.  So a text without either stands as it is,
and every text has just one escaped form.

A conversation is written as rows of ``PART_CHARS`` characters of whole turns or
a little more: rows are dealt by ranges of (conversation, turn), so a conversation of any
length is spread over tasks, and no row or task holds all of it.  The
loss mask of a row are the spans, in code points of its formatted text, of the
assistant's (escaped) texts.

:func:`digests` reads formatted rows back.  A digest of a whole conversation is
a stream: its rows pass one task in order, one at a time.

Defined results: null texts and null roles are empty ones (an empty role is another
role); rows without a conversation id are one conversation; rows without a turn
come first; rows of one turn follow each other by role, then by a hash of the
text, and repeated rows are turns of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import jobs as J

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
#: roles whose texts a model learns to write
LEARNED = ("assistant",)
#: characters of text after which a row ends
PART_CHARS = 1 << 20

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_REST = {first: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first) for first in dict.fromkeys(c[0] for c in CONTROLS)}
_ESCAPE = re.compile("|".join(rf"{re.escape(first)}(?=\\*(?:{rest}))" for first, rest in _REST.items()))
_UNESCAPE = re.compile("|".join(rf"(?<={re.escape(first)})\\(?=\\*(?:{rest}))" for first, rest in _REST.items()))

Turn = tuple[str, str]
Span = tuple[int, int]


class Conflict(ValueError):
    """The text is no conversation of the grammar."""


# ---------------------------------------------------------------- grammar

def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub("", text)


def _rendered(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text of a turn, the text, and what stands after it."""
    if role == "user":
        return "<s>[INST] ", text, " [/INST]"
    if role == "assistant":
        return " ", text, "</s>"
    if role == "system":
        return "<<SYS>>", text, "<</SYS>>"
    return f"<<ROLE>>{escaped(role)}<</ROLE>>", text, "</s>"


def parsed(formatted: str) -> Iterator[tuple[str, Span]]:
    """Role and span of the text of each turn."""
    at = 0

    def run(close: str | None = None) -> tuple[int, int, str]:
        """From here to the next control string, and past it."""
        nonlocal at
        m, start = _CONTROL.search(formatted, at), at
        if not m or close and m[0] != close:
            raise Conflict(f"no {close or 'control string'} after {at}")
        at = m.end()
        return start, m.start(), m[0]

    while at < len(formatted):
        start, end, mark = run()
        if mark == "</s>" and formatted.startswith(" ", start) and end > start:
            yield "assistant", (start + 1, end)
        elif start < end:
            raise Conflict(f"text outside a turn at {start}")
        elif mark == "<s>":
            if run("[INST]")[:2] != (at - 6, at - 6):
                raise Conflict(f"text outside a turn at {start}")
            start, end, _ = run("[/INST]")
            if end - start < 2 or formatted[start] != " " or formatted[end - 1] != " ":
                raise Conflict(f"no spaces around the text at {start}")
            yield "user", (start + 1, end - 1)
        elif mark == "<<SYS>>":
            yield "system", run("<</SYS>>")[:2]
        elif mark == "<<ROLE>>":
            start, end, _ = run("<</ROLE>>")
            yield unescaped(formatted[start:end]), run("</s>")[:2]
        else:
            raise Conflict(f"{mark} at {end}")


def recovered(formatted: str) -> list[Turn]:
    """The turns of a formatted text."""
    return [(role, unescaped(formatted[a:b])) for role, (a, b) in parsed(formatted)]


def _comes_back(role: str, text: str) -> bool:
    try:
        return recovered("".join(_rendered(role, text))) == [(role, text)]
    except Conflict:
        return False


def render(turns: list[Turn], learned: tuple[str, ...] = LEARNED) -> tuple[str, list[Span]]:
    """The formatted text, which parses to ``turns`` again, and its loss mask."""
    texts = [text for _, text in turns]
    while True:
        parts = [_rendered(role, text) for (role, _), text in zip(turns, texts)]
        formatted = "".join(x for part in parts for x in part)
        try:
            if recovered(formatted) == turns:
                break
        except Conflict:
            pass
        # a turn's controls end it whatever follows, so each turn shows by itself whether it is at fault
        faults = [i for i, (role, text) in enumerate(turns) if texts[i] == text and not _comes_back(role, text)]
        if not faults:
            raise Conflict("the turns can't be told apart")
        for i in faults:
            texts[i] = escaped(turns[i][1])
    spans, at = [], 0
    for (role, _), (before, text, after) in zip(turns, parts):
        if role in learned:
            spans.append((at + len(before), at + len(before) + len(text)))
        at += len(before) + len(text) + len(after)
    return formatted, spans


# ------------------------------------------------------------------- jobs

_FORMATTED = "conv_id {kind}, part long, formatted string, loss_starts array<int>, loss_ends array<int>"


def _formatter(part_chars: int, learned: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: list[Turn] = []
        conv, part, size, kind = None, 0, 0, None

        def row() -> pa.RecordBatch:
            formatted, spans = render(turns, learned)
            return J.batch_of(conv_id=pa.array([conv], kind), part=pa.array([part], pa.int64()), formatted=pa.array([formatted]),
                              loss_starts=pa.array([[a for a, _ in spans]], pa.list_(pa.int32())), loss_ends=pa.array([[b for _, b in spans]], pa.list_(pa.int32())))

        for batch in batches:
            kind = batch.column("conv_id").type
            for this, shard, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "shard", "role", "text"))):
                if turns and (this != conv or size >= part_chars):
                    yield row()
                    turns, size, part = [], 0, part + 1
                conv, part = this, part or shard << 32
                turns.append((role, text))
                size += len(text)
        if turns:
            yield row()

    return run


def formatted(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
              part_chars: int = PART_CHARS, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """``conv_id, part, formatted, loss_starts, loss_ends``; the rows of a conversation follow each other by ``part``."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", F.spark_partition_id().cast("long").alias("shard"), "role", "text")
    return rows.mapInArrow(_formatter(part_chars, tuple(learned)), _FORMATTED.format(kind=rows.schema["conv_id"].dataType.simpleString()))


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        for role, text in recovered(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for a, b in zip(starts, ends):
            text = unescaped(formatted[a:b])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, kind = None, None

    def out(rows: list[_Digest]) -> pa.RecordBatch:
        columns = zip(*(x.row() for x in rows))
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        return J.batch_of(**{n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})

    for batch in batches:
        kind, done = batch.column("conv_id").type, []
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_starts", "loss_ends"))):
            if now is None or now.conv != conv:
                done += [now] if now else []
                now = _Digest(conv)
            now.add(*row)
        if done:
            yield out(done)
    if now:
        yield out([now])


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation, read back from what :func:`formatted` returns.

    ``turns_sha256`` covers role, line feed, text, line feed of each turn, ``loss_sha256`` the unescaped texts under the loss mask.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.select("conv_id", "part", "formatted", "loss_starts", "loss_ends").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.mapInArrow(_digested, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
