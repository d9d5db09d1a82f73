"""Line dedup: runs of lines that came before are deleted, by a suffix array over line ids.

Only DataFrame operations.  A document is the sequence of its lines with a word;
a suffix starts at each line.  Prefix doubling: suffixes are ranked by their
first line, then, from the ranks at i and i + k, by their first 2k lines, until
no two share a rank or their documents end.  Ranks follow the order of the line ids:
a range shuffle sorts the different pairs and numbers them, without a global
window.  A suffix whose rank is its own leaves at once, so after the first round
only lines that repeat are moved, and each round they are fewer.

The ranks of all levels tell common prefixes: suffixes of one rank are an
interval of the suffix array with a common prefix of that many lines.  Of each interval
the earliest suffix (by document id, then place) is the original, the others are copies; a suffix
counts as a copy of the original in the deepest interval in which it is one.  Where neighbouring
suffixes copy neighbouring originals they are one run, and only the first of a
run needs its longest common prefix with its original: the depth of the interval and
what the lower levels add at its end, from one lookup a level.  Runs of
``min_run`` lines or more are the maximal repeated runs, whose lines are deleted.

Line ids are 128 bits of hash.  Counts and minima combine before the shuffle,
and joins on a very common line are split by adaptive execution.

Defined results: null and empty texts have no lines; lines without a word are
never deleted and do not part a run; a null document id comes after all others;
rows with equal id and text are one document, and each gets its result; rows
with one id and different texts follow each other by the hash of the text;
other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm import jobs as J

MIN_RUN = 2
_WORD = r"[^\x20\x09-\x0D]"


def _ranked(suffixes: DataFrame) -> DataFrame:
    """Of suffixes (``doc, key, seq, x, y``) those whose pair others have too, with its ``rank`` and ``least``, the earliest place of it."""
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "key", "seq")
    several = suffixes.groupBy("x", "y").agg(F.count("*").alias("n"), F.min(place).alias("least")).where("n > 1").drop("n")
    placed = J.cut_lineage(several.repartitionByRange("x", "y").sortWithinPartitions("x", "y").withColumn("rank", F.monotonically_increasing_id()))
    return J.cut_lineage(suffixes.join(placed.hint("merge"), ["x", "y"]).drop("x", "y"))


def _levels(first: DataFrame, min_run: int) -> list[tuple[int, DataFrame]]:
    """Number of lines and ranked suffixes of each level, until none is left; ``min_run`` lines are a level."""
    levels, k = [(1, first)], 1
    while True:
        step = min(k, min_run - k) if k < min_run else k  # the step to min_run may overlap
        there = Window.partitionBy("doc", "key").orderBy("seq").rangeBetween(step, step)
        pairs = levels[-1][1].select("doc", "key", "seq", F.col("rank").alias("x"), F.first("rank").over(there).alias("y")).where("y IS NOT NULL")
        ranks, k = _ranked(pairs), k + step
        if ranks.isEmpty():
            return levels
        levels.append((k, ranks))


def _runs(levels: list[tuple[int, DataFrame]], min_run: int) -> DataFrame:
    """``doc, key, seq, length, source``: runs of lines that are copies of the run at ``source``, as long as the two agree."""
    source = F.struct(F.col("least.doc").alias("doc"), F.col("least.key").alias("key"), F.col("least.seq").alias("seq"))
    is_copy = ~(F.col("least.doc").eqNullSafe(F.col("doc")) & (F.col("least.key") == F.col("key")) & (F.col("least.seq") == F.col("seq")))
    copies = [t.where(is_copy).select("doc", "key", "seq", F.lit(k).alias("k"), source.alias("source")) for k, t in levels if k >= min_run]
    if not copies:
        return levels[0][1].where("false").select("doc", "key", "seq", F.lit(0).alias("length"), source.alias("source"))
    deepest = reduce(DataFrame.unionByName, copies).groupBy("doc", "key", "seq").agg(F.max("k").alias("length"), F.max_by("source", "k").alias("source"))
    before = F.lag(F.struct("seq", "source")).over(Window.partitionBy("doc", "key").orderBy("seq"))
    runs = deepest.withColumn("before", before)
    goes_on = (F.col("before.seq") + 1 == F.col("seq")) & F.col("before.source.doc").eqNullSafe(F.col("source.doc")) & (F.col("before.source.key") == F.col("source.key")) & (F.col("before.source.seq") + 1 == F.col("source.seq"))
    runs = J.cut_lineage(runs.where(~F.coalesce(goes_on, F.lit(False))).drop("before"))
    for k, ranks in reversed(levels[:-1]):
        # both places after what the two are known to share, where that can be more by this level
        side = lambda at: F.struct(F.col(f"{at}doc").alias("d"), F.col(f"{at}key").alias("x"), (F.col(f"{at}seq") + F.col("length")).alias("s"))
        asked = runs.where(F.col("length") > k).select(F.struct("doc", "key", "seq").alias("run"), F.explode(F.array(side(""), side("source."))).alias("a")).select("run", "a.*")
        told = asked.join(ranks.select("doc", "key", "seq", "rank").hint("merge"), F.col("d").eqNullSafe(F.col("doc")) & (F.col("x") == F.col("key")) & (F.col("s") == F.col("seq")))
        more = told.groupBy("run").agg(F.count("*").alias("n"), F.min("rank").alias("low"), F.max("rank").alias("high")).where("n = 2 AND low = high")
        more = more.select(F.col("run.doc").alias("of_doc"), F.col("run.key").alias("of_key"), F.col("run.seq").alias("of_seq"), F.lit(k).alias("more"))
        same = F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("key") == F.col("of_key")) & (F.col("seq") == F.col("of_seq"))
        runs = J.cut_lineage(runs.join(more, same, "left").select("doc", "key", "seq", (F.col("length") + F.coalesce("more", F.lit(0))).alias("length"), "source"))
    return runs


def _first_level(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, key, seq, pos, rank, least`` of the lines that come more than once."""
    text = F.col(text_col).cast("string")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))), lambda s: s["line"].rlike(_WORD))
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(id_col), text).alias("key"), F.posexplode_outer(lines).alias("seq", "l")).where("l IS NOT NULL")
    first = _ranked(rows.select("doc", "key", "seq", F.col("l.pos").alias("pos"), F.xxhash64("l.line").alias("x"), F.xxhash64(F.lit(1), F.col("l.line")).alias("y")))
    return first.dropDuplicates(["doc", "key", "seq"])  # equal rows are one document


def _found(docs: DataFrame, id_col: str, text_col: str, min_run: int) -> tuple[DataFrame, DataFrame]:
    if min_run < 1:
        raise ValueError("a run has one line at least")
    first = J.cut_lineage(_first_level(docs, id_col, text_col))
    return first, _runs(_levels(first, min_run), min_run)


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``doc, key, seq, length, source``: the maximal runs that are copies; ``seq`` counts lines with a word from 0, ``key`` is the hash of id and text."""
    return _found(docs, id_col, text_col, min_run)[1]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``doc, key, pos``: the lines to delete; ``pos`` counts all lines of the text from 0."""
    first, runs = _found(docs, id_col, text_col, min_run)
    gone = runs.select("doc", "key", F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("length") - 1)).alias("seq")).distinct()
    same = gone["doc"].eqNullSafe(first["doc"]) & (gone["key"] == first["key"]) & (gone["seq"] == first["seq"])
    return first.join(gone.hint("merge"), same, "left_semi").select("doc", "key", "pos")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``doc_id, n_lines, n_deleted, kept_sha256, deleted, kept_text`` for each row; ``n_lines`` counts lines with a word."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("key"))
    # each deleted line with the kept ones before it, so that a text is parted in one walk along its lines
    gap = F.col("pos") - F.coalesce(F.lag("pos").over(Window.partitionBy("doc", "key").orderBy("pos")), F.lit(-1)) - 1
    gone = repeated_lines(docs, id_col, text_col, min_run).withColumn("gap", gap)
    gone = gone.groupBy("doc", F.col("key").alias("of")).agg(F.sort_array(F.collect_list(F.struct("pos", "gap"))).alias("gone"))
    joined = rows.join(gone.hint("merge"), (rows["key"] == F.col("of")) & rows["doc_id"].eqNullSafe(F.col("doc")), "left")
    marks = F.flatten(F.transform("gone", lambda g: F.concat(F.array_repeat(F.lit(False), g["gap"].cast("int")), F.array(F.lit(True)))))
    lines = F.split("text", "\n")
    kept = F.array_join(F.zip_with(lines, marks, lambda x, cut: F.when(F.coalesce(cut, F.lit(False)), F.lit(None)).otherwise(x)), "\n")
    deleted = F.coalesce(F.transform("gone", lambda g: g["pos"]), F.array().cast("array<int>"))
    n_lines = F.size(F.filter(lines, lambda x: x.rlike(_WORD))).cast("long")
    out = joined.select("doc_id", n_lines.alias("n_lines"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"), deleted.alias("deleted"))
    return out.select("doc_id", "n_lines", F.size("deleted").cast("long").alias("n_deleted"), F.sha2("kept_text", 256).alias("kept_sha256"), "deleted", "kept_text")
