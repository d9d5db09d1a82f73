"""All matches of a regular expression with their places (E6 helper), as native columns.

Spark's regex functions give matched text but no positions.  They follow from
the pieces between the matches: a match begins where all pieces and matches before
it end, and its line from their line ends.  Both are running sums over an array, which
:func:`running` forms in steps of a bounded length, so the work grows with the number of
matches (not with its square), and no text is cut from its start again for each match.

Offsets count characters from 0, ends exclusive.  Patterns are read with Unix
line ends and Unicode classes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: elements that are added up by walking; longer arrays are summed in pieces of so many
STEP = 128
_INTS = "array<int>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _walked(x: Column) -> Column:
    """Running sums of a short array."""
    return F.transform(x, lambda _, i: F.aggregate(F.slice(x, 1, i + 1), F.lit(0), lambda a, v: a + v))


def running(values: Column) -> Column:
    """Running sums of an array of ints, each with its own element."""
    def of_pieces(pieces: Column) -> Column:
        total = lambda p: F.aggregate(p, F.lit(0), lambda a, v: a + v)

        def based(totals: Column) -> Column:
            base = lambda k: F.aggregate(F.slice(totals, 1, k), F.lit(0), lambda a, v: a + v)
            return F.flatten(F.transform(pieces, lambda p, k: let(base(k), lambda b: F.transform(_walked(p), lambda v: v + b))))

        return let(F.transform(pieces, total), based)

    def cut(x: Column) -> Column:
        count = F.ceil(F.size(x) / STEP).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(x, k * STEP + 1, F.lit(STEP)))

    return let(values, lambda x: F.when(F.size(x) == 0, F.array().cast(_INTS)).when(F.size(x) <= STEP, _walked(x)).otherwise(let(cut(x), of_pieces)))


def _line_ends(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def _around(pieces: Column, found: Column, context: int) -> Column:
    """Each match with ``context`` characters on both sides, line ends shown as ``\\n``."""
    parts = F.flatten(F.zip_with(pieces, found, lambda p, m: F.array(p, F.coalesce(m, F.lit("")))))
    ends = F.transform(parts, lambda s: F.struct(F.left(s, F.lit(context)).alias("head"), F.right(s, F.lit(context)).alias("tail")))
    near = 2 * context  # a match has one character at least, so that many parts hold enough
    join = lambda x, field: F.array_join(F.transform(x, lambda s: s[field]), "")

    def each(e: Column) -> Column:
        before = lambda i: F.right(join(F.slice(e, F.greatest(F.lit(1), 2 * i + 2 - near), F.least(F.lit(near), 2 * i + 1)), "tail"), F.lit(context))
        after = lambda i: F.left(join(F.slice(e, 2 * i + 3, F.lit(near)), "head"), F.lit(context))
        return F.transform(found, lambda m, i: F.replace(F.concat(before(i), m, after(i)), F.lit("\n"), F.lit("\\n")))

    return let(ends, each)


def spans(text: Column, pattern: str, groups: int = 0, context: int | None = None) -> Column:
    """``array<struct<start, end, line, g1, g2, find>>`` of all matches; ``find`` is the match in its context; empty for a null text."""
    def group(k: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) if k <= groups else F.array().cast("array<string>")

    def of(found: Column) -> Column:
        def located(pieces: Column) -> Column:
            def starts(measure: Callable[[Column], Column]) -> Column:
                own, skipped = F.transform(F.slice(pieces, F.lit(1), F.size(found)), measure), F.concat(F.array(F.lit(0)), F.transform(found, measure))
                return running(F.zip_with(own, F.slice(skipped, F.lit(1), F.size(found)), lambda a, b: a + b))

            finds = _around(pieces, found, context) if context is not None else F.array().cast("array<string>")
            zipped = F.arrays_zip(found.alias("m"), starts(F.length).alias("start"), starts(_line_ends).alias("ends"), group(1).alias("g1"), group(2).alias("g2"), finds.alias("find"))
            return F.transform(zipped, lambda z: F.struct(z["start"], (z["start"] + F.length(z["m"])).alias("end"), (z["ends"] + 1).alias("line"), z["g1"], z["g2"], z["find"]))

        return let(F.split(text, pattern, -1), located)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(F.when(text.isNotNull(), let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(SPANS)).otherwise(of(m).cast(SPANS)))), F.array().cast(SPANS))


SPANS = "array<struct<start:int,end:int,line:int,g1:string,g2:string,find:string>>"


def apart(runs: Column, zones: Column) -> Column:
    """Those of ``runs`` that overlap none of ``zones`` (structs with ``start`` and ``end``); runs are apart and in order.

    A zone overlaps if it begins before the run's end and does not end by its start; both
    numbers are running counts over the places in order.
    """
    def count(marks: Column, places: Column, mark_first: int) -> Column:
        events = F.concat(F.transform(marks, lambda p: F.struct(p.alias("at"), F.lit(1 - mark_first).alias("order"), F.lit(1).alias("mark"))),
                          F.transform(places, lambda p: F.struct(p.alias("at"), F.lit(mark_first).alias("order"), F.lit(0).alias("mark"))))
        tally = lambda e: F.zip_with(e, running(F.transform(e, lambda x: x["mark"])), lambda x, n: F.struct(x["mark"].alias("mark"), n.alias("n")))
        return F.transform(F.filter(let(F.array_sort(events), tally), lambda x: x["mark"] == 0), lambda x: x["n"])

    begun = count(F.transform(zones, lambda z: z["start"]), F.transform(runs, lambda r: r["end"]), 0)
    over = count(F.transform(zones, lambda z: z["end"]), F.transform(runs, lambda r: r["start"]), 1)
    free = F.zip_with(F.zip_with(begun, over, lambda a, b: a == b), runs, lambda f, r: F.when(f, r))
    return F.filter(free, lambda r: r.isNotNull())
