"""Fill-in-middle: texts are cut at two ranks, found in an indexable skip list, and their parts put in another order.

A text is a row of units (code points, words with the white space after them, or
lines).  Its skip list lies over runs of ``RUN`` bytes: the lowest lane links
each run to the next; a run stands in the lane above with a chance of one in
``FAN``, drawn from its place, and the first of a text stands in all.  Every link
carries its widths: the units and the code points that begin between its ends.
A search starts at a text's head in the highest lane, follows links while the
units passed stay within the rank, goes down a lane, and walks the last run unit
by unit: so it ends exactly where the unit of that rank begins, with the code
points before it added up on the way.  The lists of a slice of texts are built and searched at
once, each lane being a few numpy arrays.

The cuts and the order are drawn from the document id: of the hex SHA-256 of
``<seed>:<id>`` the first four groups of 8 digits, h1 to h4.  The prefix ends
after the smaller, the middle after the larger of h1 % (n + 1) and h2 % (n + 1)
units.  Forms: ``plain``, the text as it is (empty texts, texts with a marker in them, and
a share of the others, by h3); ``psm``, prefix, suffix, middle; ``spm``, suffix,
prefix, middle (by h4), each part after its marker.

One pass over the rows, without a shuffle; memory is bounded by the longest text.

Defined results: a null text is an empty one, without units, in form plain; a
null id is drawn as the empty string; repeated rows, and rows that share an id,
each get their result, drawn alike; an empty table gives no rows; other columns
are not read.  Ids may be of any type that casts to a string.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J

#: bytes that the lowest links span
RUN = 64
#: links of a lane for one of the lane above, on average
FAN = 4
SLICE_BYTES = 1 << 20
#: before prefix, suffix and middle
MARKERS = ("<P>", "<S>", "<M>")
#: of 100 texts, those drawn from this number on stay plain
PLAIN_FROM = 90
#: of 100 others, those drawn below this number begin with the suffix
SPM_BELOW = 20


def _code_points(buf: np.ndarray) -> np.ndarray:
    return (buf & 0xC0) != 0x80


def _words(buf: np.ndarray) -> np.ndarray:
    space = A.SPACE[buf]
    begins = ~space
    begins[1:] &= space[:-1]
    return begins


def _lines(buf: np.ndarray) -> np.ndarray:
    begins = np.zeros(len(buf), bool)
    begins[1:] = buf[:-1] == 10
    return begins


#: the bytes at which units begin, besides the first of each text
UNITS = {"code_point": _code_points, "word": _words, "line": _lines}


# --------------------------------------------------------------- skip list

@dataclass
class Lane:
    first: np.ndarray  # the nodes of text t are first[t]:first[t + 1]
    units: np.ndarray  # widths of the link that leaves each node
    chars: np.ndarray
    down: np.ndarray  # each node's place in the lane below; in the lowest, the byte at which its run begins


@dataclass
class SkipLists:
    """One skip list a text."""

    offsets: np.ndarray
    unit: np.ndarray  # marks the bytes at which units begin
    char: np.ndarray
    lanes: list[Lane]

    @classmethod
    def of(cls, buf: np.ndarray, offsets: np.ndarray, unit: str = "code_point") -> SkipLists:
        begins, char = UNITS[unit](buf), _code_points(buf)
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        runs = -(-np.diff(offsets) // RUN)
        first = np.concatenate([[0], np.cumsum(runs)])
        place = np.arange(first[-1]) - np.repeat(first[:-1], runs)
        at = np.repeat(offsets[:-1], runs) + RUN * place
        width = lambda marks: np.add.reduceat(marks, at, dtype=np.int64) if len(at) else np.empty(0, np.int64)
        lanes, drawn = [Lane(first, width(begins), width(char), at)], A.mix(place.astype(np.uint64) + np.uint64(1))
        while len(drawn) and np.diff(lanes[-1].first).max() > 2 * FAN:
            low = lanes[-1]
            stands = np.flatnonzero((drawn % np.uint64(FAN) == 0) | (place == 0))
            drawn, place = drawn[stands] // np.uint64(FAN), place[stands]
            lanes.append(Lane(np.searchsorted(stands, low.first), np.add.reduceat(low.units, stands), np.add.reduceat(low.chars, stands), stands))
        return cls(offsets, begins, char, lanes)

    def units(self) -> np.ndarray:
        """Of each text, added up along its highest lane."""
        top = self.lanes[-1]
        total = np.concatenate([[0], np.cumsum(top.units)])
        return total[top.first[1:]] - total[top.first[:-1]]

    def find(self, text: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte at which the unit of ``rank`` of ``text`` begins (its end, for as many as it has), and the code points of the text before it."""
        units, chars = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        node = self.lanes[-1].first[text]
        for level, lane in reversed(list(enumerate(self.lanes))):
            end = lane.first[text + 1]
            moving = np.flatnonzero(node < end)
            while len(moving):
                at = node[moving]
                go = units[moving] + lane.units[at] <= rank[moving]
                moving, at = moving[go], at[go]
                units[moving] += lane.units[at]
                chars[moving] += lane.chars[at]
                node[moving] += 1
                moving = moving[node[moving] < end[moving]]
            if level:
                node = np.append(lane.down, self.lanes[level - 1].first[-1])[node]
        byte = self.offsets[text + 1].copy()
        inside = np.flatnonzero(node < end)
        start = self.lanes[0].down[node[inside]]
        place = start[:, None] + np.arange(RUN)
        real = place < byte[inside][:, None]
        place = np.where(real, place, 0)
        passed = np.cumsum(self.unit[place] & real, axis=1)
        steps = np.argmax(passed == (rank[inside] - units[inside] + 1)[:, None], axis=1)
        byte[inside] = start + steps
        chars[inside] += (self.char[place] & real & (np.arange(RUN) < steps[:, None])).sum(1)
        return byte, chars


# ------------------------------------------------------------------- forms

def checked(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """Three different markers that can't come about where a part and a marker meet, so that texts without them are restored exactly."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for a in markers:
        for b in markers:
            if any(a.endswith(b[:k]) for k in range(1, len(b))) or (a != b and a in b):
                raise ValueError(f"{a!r} and {b!r} may overlap")
    return markers


def _drawn(id_col: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _transformed(batch: pa.RecordBatch, unit: str, markers: tuple[bytes, bytes, bytes], plain_from: int, spm_below: int):
    for a, b in A.slices(batch.column("text"), SLICE_BYTES):
        rows = batch.slice(a, b - a)
        buf, offsets = A.utf8(rows.column("text"))
        h1, h2, h3, h4 = (rows.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
        raw, edges = buf.tobytes(), offsets.tolist()
        lists = SkipLists.of(buf, offsets, unit)
        n = lists.units()
        plain = (n == 0) | (h3 % 100 >= plain_from)
        plain |= np.array([any(raw.find(m, x, y) >= 0 for m in markers) for x, y in zip(edges, edges[1:])], bool)
        spm = ~plain & (h4 % 100 < spm_below)
        ranks = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
        cut = np.flatnonzero(~plain)
        (cut1, chars1), (cut2, chars2) = (lists.find(cut, r[cut]) for r in ranks)
        out = [raw[x:y] for x, y in zip(edges, edges[1:])]
        for i, x, y, last in zip(cut.tolist(), cut1.tolist(), cut2.tolist(), spm[cut].tolist()):
            parts = [markers[0] + raw[edges[i] : x], markers[1] + raw[y : edges[i + 1]]]
            out[i] = b"".join([*(parts[::-1] if last else parts), markers[2], raw[x:y]])
        prefix, middle = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        prefix[cut], middle[cut] = chars1, chars2 - chars1
        form = np.where(plain, 0, np.where(spm, 2, 1))
        yield J.batch_of(id=rows.column("id"), n=pa.array(n, pa.int64()), form=pa.array(["plain", "psm", "spm"]).take(pa.array(form)),
                         prefix_chars=pa.array(prefix, pa.int64(), mask=plain), middle_chars=pa.array(middle, pa.int64(), mask=plain), output=pa.array(out, pa.string()))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "code_point", seed: int = 1,
                   markers: tuple[str, str, str] = MARKERS, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for each row; the two numbers of code points are null in plain form."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    options = (unit, tuple(m.encode() for m in checked(tuple(markers))), plain_from, spm_below)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *_drawn(id_col, seed))
    kind = rows.schema["id"].dataType.simpleString()
    out = J.map_arrow(rows, lambda batch: _transformed(batch, *options), f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", "doc_id")


def restored(output: Column | str, form: Column | str, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made from."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, "|".join(re.escape(m) for m in markers), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
