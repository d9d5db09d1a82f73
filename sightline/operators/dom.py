"""Elements of web pages as intervals over tokens (D5–D16), in windows only.

A page is a row of tokens (tags, texts, comments) in order.  An element is the
interval from its opening tag on up to ``stop``, the place of the first token
after it; intervals are nested or apart.  So what trees are walked for becomes
set operations on one table:

* whatever lies in a marked element: the running maximum of the marked
  elements' ``stop`` is above the place (:func:`covered`);
* text in an element: the difference of two prefix sums (:func:`masses`);
* parents, siblings and nearest text: window functions over the depth or over the page.

Pages are annotated once; cleaning steps take away whole elements or put tokens in the place of
others, so the intervals of the rest stay true.

Where elements end (:func:`annotate`):

1. Void tags, tags that end in ``/>``, and ``script`` and ``style`` with all their content are one token.
2. End tags and opening tags of one name pair off by a running sum; an end tag
   without an opening one is no tag, an opening tag without an end tag is *open*.
3. Paired tags nest by depth, a running sum over all of them: with crossing
   tags, an element ends where the depth falls under its own.
4. An open element ends with the pair around it, or before: ``p``, list entries
   and parts of tables (``RANK``) end where a tag of their rank or a higher one
   begins in the same pair, unless another kind of open element lies
   between; blocks end an open ``p``.

Everything of a page is within one partition of one shuffle, whose partitions hold
about ``PIECE_BYTES`` of html: each window sorts there, no group is larger than a page,
and nothing is collected but the text of one page.  No frame looks ahead without bound (those are quadratic): such
windows run backwards.

Pages are told apart by a hash (MD5) of id and html, the same whenever a task runs again, so they may
share an id or have none; repeated rows are one page.
An empty or null page has one empty token.  Text is as the five predefined
entities say.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.operators.page_meta import IN_TAG, STRIP_TAGS, attribute, unescaped
from sightline.operators.pages import reading_time, word_count
from sightline.session import cut_lineage

# ---------------------------------------------------------------------------
# Must equal the reference's for the same results.
# ---------------------------------------------------------------------------
#: elements in a line of text
INLINE = ("span", "a", "em", "strong", "b", "i", "code", "abbr", "time", "small", "sub", "sup")
#: words in the label of a region that shows a terminal
TERMINAL_WORDS = ("terminal", "output", "console", "command", "shell")
#: classes of copy buttons beside code
COPY_CLASSES = ("copy", "copyicon", "copy-icon", "copy-button", "clipboard", "clipboard-copy", "copy-code")
#: parents of code whose other children stay, even without text
OPEN_CONTAINERS = ("body", "article", "main", "section")
#: an article of so many characters or fewer is passed over
SHORT_ARTICLE = 100
#: what a paragraph adds to the score of the div around it
PARAGRAPH = 100
CODE_CLASSES = ("language-", "lang-", "highlight-")

#: fixed by HTML
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCKS = ("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
          "main", "nav", "ol", "pre", "section", "table", "ul")
#: open elements that end where one of their rank or a higher one begins
RANK = {"p": 0, "li": 1, "dd": 1, "dt": 1, "option": 1, "td": 2, "th": 2, "tr": 3, "tbody": 4, "thead": 4, "tfoot": 4}

_TOKEN = rf"""(?is)<!--(?:.*?-->|.*)|<(script|style)\b{IN_TAG}>(?:.*?</\1\s*>|.*)|</?[a-z]{IN_TAG}>|<[!?][^<>]*+>|[^<]++|<"""
#: html in a partition: what the sorts of one task hold follows from it, whatever the size of the input
PIECE_BYTES = 2 << 20
_ALL = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def _in(column: Column, names) -> Column:
    return column.isin(*names)


def pieces(pages: DataFrame, html_col: str = "html") -> int:
    """Partitions that pages are dealt over, ``PIECE_BYTES`` of html each."""
    size = pages.agg(F.sum(F.octet_length(F.col(html_col).cast("string")))).first()[0] or 0
    return max(1, -(-size // PIECE_BYTES))


def tokens(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id, row, pos, token``: all of a page's html, in order; the first token, at 0, is empty.

    Pages are dealt whole, by hash, before they become tokens; every window and
    group by ``row`` that follows stays in these partitions.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.col(id_col).cast("string"), F.lit("\n")), F.lit("")), F.lit("\n"), html)))
    rows = pages.select(F.col(id_col).alias("id"), key.alias("row"), html.alias("html")).repartition(pieces(pages, html_col), "row")
    return rows.select("id", "row", F.posexplode(F.concat(F.array(F.lit("")), F.regexp_extract_all("html", F.lit(_TOKEN), F.lit(0)))).alias("pos", "token")).withColumn("pos", F.col("pos").cast("long"))


def _kind(token: Column, name: Column) -> Column:
    return (F.when(name == "", F.when(token.startswith("<!") | token.startswith("<?"), "other").otherwise("text"))
            .when(token.startswith("</"), F.when(_in(name, VOID), "other").otherwise("close"))
            .when(_in(name, ("script", "style")), "raw")
            .when(_in(name, VOID) | token.endswith("/>"), "void").otherwise("open"))


def stripped(token: Column) -> Column:
    """The text of a text token, without white space around it."""
    return F.regexp_replace(unescaped(token), r"(?U)^\s+|\s+$", "")


def text_length() -> Column:
    """Characters of text, each token without white space around it."""
    return F.when(F.col("kind") == "text", F.length(stripped(F.col("token")))).otherwise(0)


def annotate(tokens: DataFrame) -> DataFrame:
    """Tokens with what they are and, on the first token of each element, where it stops.

    Adds ``kind`` (open, void, raw: elements; close, stray, text, other), ``name``,
    ``stop`` (elements), ``depth`` (of elements around the token; an end tag has
    its element's) and ``parent`` (a struct ``pos, name, stop`` of the element around it).
    """
    name = F.lower(F.regexp_extract("token", r"^</?([a-zA-Z][^\s/>]*)", 1))
    t = tokens.withColumn("name", F.when(F.col("token").startswith("<"), name).otherwise("")).withColumn("kind", _kind(F.col("token"), F.col("name")))
    page, whole = Window.partitionBy("row").orderBy("pos"), Window.partitionBy("row")
    t = t.withColumn("_last", F.lag("pos").over(page)).where("_last IS NULL OR _last < pos")  # rows that come twice
    is_open, is_close = F.col("kind") == "open", F.col("kind") == "close"
    step = F.when(is_open, 1).when(is_close, -1).otherwise(0)

    # tags of one name: levels of a running sum that does not fall under 0
    same = Window.partitionBy("row", "name").orderBy("pos")
    t = t.withColumn("_sum", F.sum(step).over(same))
    t = t.withColumn("_floor", F.least(F.lit(0), F.coalesce(F.min("_sum").over(same.rowsBetween(*_BEFORE)), F.lit(0))))
    level = F.when(is_open, F.col("_sum") - F.col("_floor")).when(is_close, F.col("_sum") - F.col("_floor") + 1)
    t = t.withColumns({"kind": F.when(is_close & (F.col("_sum") < F.col("_floor")), "stray").otherwise(F.col("kind")), "_level": level})
    paired = is_close | (is_open & (F.lead("kind").over(Window.partitionBy("row", "name", "_level").orderBy("pos")) == "close"))
    t = t.withColumn("_pair", F.coalesce(paired, F.lit(False)))

    # pairs by depth (of a pair's tags: its own), and the pair around each token
    t = t.withColumn("_in", F.sum(F.when(F.col("_pair"), step).otherwise(0)).over(page) + (F.col("_pair") & is_close).cast("int"))
    end = F.when(F.col("_pair") & is_open, F.lead("pos").over(Window.partitionBy("row", "_pair", "_in").orderBy("pos")))
    t = t.withColumns({"_end": end, "_around": F.col("_in") - F.col("_pair").cast("int"), "_page_end": F.max("pos").over(whole) + 1})
    t = t.withColumn("_last", F.lag(F.struct("pos", F.col("_in").alias("depth"), (F.col("_pair") & is_open).alias("opens"), F.col("_end").alias("end"))).over(page))
    first_in = F.col("_last.opens") & (F.col("_last.depth") == F.col("_around"))
    inside = Window.partitionBy("row", "_around").orderBy("pos").rowsBetween(*_ALL)
    around = F.last(F.when(first_in, F.struct(F.col("_last.pos").alias("pos"), F.col("_last.end").alias("end"))), ignorenulls=True).over(inside)
    t = t.withColumn("_around", around).withColumn("_in_pair", F.coalesce(F.col("_around.pos"), F.lit(-1)))

    # open elements: what ends them, within the pair around them
    single = is_open & ~F.col("_pair")
    rank = reduce(lambda c, n: c.when(F.col("name") == n, RANK[n]), RANK, F.when(F.lit(False), 0))
    power = F.when(is_open | (F.col("kind") == "void"), F.coalesce(rank, F.when(_in(F.col("name"), BLOCKS), 0)))
    t = t.withColumns({"_rank": F.when(single, rank), "_power": power, "_blocks": single & rank.isNull()})
    ahead = Window.partitionBy("row", "_in_pair").orderBy(F.desc("pos")).rowsBetween(*_BEFORE)
    behind = Window.partitionBy("row", "_in_pair").orderBy("pos")
    ranks = sorted(set(RANK.values()))
    t = t.withColumns({**{f"_next{r}": F.min(F.when(F.col("_power") >= r, F.col("pos"))).over(ahead) for r in ranks}, "_next_block": F.min(F.when(F.col("_blocks"), F.col("pos"))).over(ahead)})
    ender = reduce(lambda c, r: c.when(F.col("_rank") == r, F.col(f"_next{r}")), ranks, F.when(F.lit(False), F.col("pos")))
    ender = F.when(F.col("_next_block").isNull() | (F.col("_next_block") >= ender), ender)
    stop = F.when(F.col("_pair") & is_open, F.col("_end") + 1).when(single, F.coalesce(ender, F.col("_around.end"), F.col("_page_end"))).when(_in(F.col("kind"), ("void", "raw")), F.col("pos") + 1)

    # how many open elements end at a token: those of its rank before a tag, all that are left before the pair's end tag
    previous = {f"_prev{r}": F.last(F.when(F.col("_power") >= r, F.struct("pos", F.coalesce(F.col("_rank") == r, F.lit(False)).alias("ends"))), ignorenulls=True).over(behind.rowsBetween(*_BEFORE)) for r in ranks}
    t = t.withColumns({"stop": stop, **previous, "_prev_block": F.max(F.when(F.col("_blocks"), F.col("pos"))).over(behind.rowsBetween(*_BEFORE))})
    ends = ((F.col("_power") >= r) & F.col(f"_prev{r}.ends") & (F.col("_prev_block").isNull() | (F.col("_prev_block") < F.col(f"_prev{r}.pos"))) for r in ranks)
    t = t.withColumn("_ended", reduce(lambda a, b: a + b, (F.coalesce(e, F.lit(False)).cast("int") for e in ends)))
    t = t.withColumn("_left", F.sum(single.cast("int") - F.col("_ended")).over(behind))
    left = F.when(F.col("_last.opens"), 0).otherwise(F.lag("_left").over(page))
    t = t.withColumn("_ended", F.when(F.col("_pair") & is_close, left + 1).otherwise(F.col("_ended")))
    t = t.withColumn("depth", F.sum(is_open.cast("int") - F.col("_ended")).over(page) - is_open.cast("int"))

    t = t.withColumn("_last", F.lag(F.struct("pos", "depth", "kind", "name", "stop")).over(page))
    first_in = (F.col("_last.kind") == "open") & (F.col("_last.depth") + 1 == F.col("depth"))
    parent = F.struct(F.col("_last.pos").alias("pos"), F.col("_last.name").alias("name"), F.col("_last.stop").alias("stop"))
    parent = F.last(F.when(first_in, parent), ignorenulls=True).over(Window.partitionBy("row", "depth").orderBy("pos").rowsBetween(*_ALL))
    return t.withColumn("parent", parent).select(*tokens.columns, "kind", "name", "stop", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent"))


def covered(marked: Column) -> Column:
    """Whether a token is one of a marked element, its tags included."""
    return F.coalesce(F.max(F.when(marked, F.col("stop"))).over(Window.partitionBy("row").orderBy("pos").rowsBetween(*_ALL)) > F.col("pos"), F.lit(False))


def is_element(kinds: tuple[str, ...] = ("open", "void", "raw")) -> Column:
    return _in(F.col("kind"), kinds)


def has_class(wanted) -> Column:
    """Whether an element has one of the classes (lower case)."""
    classes = F.split(F.lower(F.trim(F.coalesce(attribute(F.col("token"), "class"), F.lit("")))), r"\s+")
    return is_element() & F.arrays_overlap(classes, F.array(*(F.lit(c) for c in wanted)))


def role_is(role: str) -> Column:
    return is_element() & (attribute(F.col("token"), "role") == role)


def _kept(annotated: DataFrame, marked: Column) -> DataFrame:
    """Tokens outside the marked elements."""
    marked = annotated.withColumn("_gone", covered(F.coalesce(marked, F.lit(False)))).where("NOT _gone")
    return marked.select(*_COLUMNS)


_COLUMNS = ("id", "row", "pos", "token", "kind", "name", "stop", "depth", "parent")
#: places between two tokens that new ones may take
_ROOM = 4
_NEW = "struct<token:string,kind:string,name:string,stop:bigint,depth:bigint,parent:struct<pos:bigint,name:string,stop:bigint>>"


def _new(token: Column | str, kind: str = "text", name: str = "", stop: Column | None = None, depth: Column | None = None, parent: Column | None = None) -> Column:
    """A token in the place of another; ``stop`` and ``parent`` in places after :func:`_replaced`."""
    none = F.lit(None)
    return F.struct((F.lit(token) if isinstance(token, str) else token).alias("token"), F.lit(kind).alias("kind"), F.lit(name).alias("name"), (none if stop is None else stop).alias("stop"),
                    (F.col("depth") if depth is None else depth).alias("depth"), (none if parent is None else parent).alias("parent")).cast(_NEW)


def _as_it_is(token: Column | None = None) -> Column:
    parent = F.when(F.col("parent").isNotNull(), F.struct((F.col("parent.pos") * _ROOM).alias("pos"), F.col("parent.name").alias("name"), (F.col("parent.stop") * _ROOM).alias("stop")))
    return F.struct((F.col("token") if token is None else token).alias("token"), "kind", "name", (F.col("stop") * _ROOM).alias("stop"), "depth", parent.alias("parent")).cast(_NEW)


def _replaced(annotated: DataFrame, new: Column) -> DataFrame:
    """``new``: the tokens in place of each token, in order (``_ROOM`` at most); places grow by that factor."""
    rows = annotated.select("id", "row", "pos", F.posexplode(new).alias("_n", "_t"))
    return rows.select("id", "row", (F.col("pos") * _ROOM + F.col("_n")).alias("pos"), "_t.*").select(*_COLUMNS)


def _nothing() -> Column:
    return F.array().cast(f"array<{_NEW}>")


def _before(marked: Column) -> Column:
    """Whether a token lies in a marked element, whose first token it is not."""
    last = F.max(F.when(marked, F.col("stop"))).over(Window.partitionBy("row").orderBy("pos").rowsBetween(*_BEFORE))
    return F.coalesce(last > F.col("pos"), F.lit(False))


def _nearest_after(value: Column) -> Column:
    """``value`` (a struct or place) of the nearest token after this one that has it, this one included."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy("row").orderBy(F.desc("pos")).rowsBetween(*_ALL))


# ------------------------------------------------------------ cleaning steps

def terminal_regions(annotated: DataFrame) -> DataFrame:
    """A region labelled as a terminal becomes a code block of its texts, joined by spaces."""
    words = (F.col("kind") == "text") & (stripped(F.col("token")) != "")
    label = F.lower(attribute(F.col("token"), "aria-label"))
    region = (F.col("kind") == "open") & role_is("region") & reduce(lambda a, b: a | b, (label.contains(w) for w in TERMINAL_WORDS))
    t = annotated.withColumn("_word_at", _nearest_after(F.when(words, F.col("pos"))))
    t = t.withColumn("_region", F.coalesce(region & (F.col("_word_at") < F.col("stop")), F.lit(False))).withColumn("_inner", _before(F.col("_region")))
    t = t.withColumn("_starts", F.col("_region") & ~F.col("_inner"))
    page = Window.partitionBy("row").orderBy("pos")
    of = F.last(F.when(F.col("_starts"), F.struct("pos", "stop", "depth")), ignorenulls=True).over(page.rowsBetween(*_ALL))
    t = t.withColumn("_of", F.when(F.col("_starts") | F.col("_inner"), of)).withColumn("_at", F.col("_of.pos"))
    t = t.withColumns({"_nth": F.sum((words & F.col("_inner")).cast("int")).over(Window.partitionBy("row", "_at").orderBy("pos").rowsBetween(*_ALL)), "_then": F.lead("_at").over(page)})
    closes = F.col("_inner") & (F.col("_then").isNull() | (F.col("_then") != F.col("_at")))
    text = F.concat(F.when(F.col("_nth") > 1, " ").otherwise(""), F.regexp_replace("token", r"(?U)^\s+|\s+$", ""))
    stop, depth = F.col("stop") * _ROOM, F.col("_of.depth")
    pre = F.struct((F.col("pos") * _ROOM).alias("pos"), F.lit("pre").alias("name"), stop.alias("stop"))
    begin = F.array(F.struct(F.lit("<pre>").alias("token"), F.lit("open").alias("kind"), F.lit("pre").alias("name"), stop.alias("stop"), F.col("depth"), _as_it_is()["parent"].alias("parent")).cast(_NEW),
                    _new('<code class="language-text">', "open", "code", stop - 2, depth + 1, pre))
    inner = F.array(_new(F.when(words, text).otherwise(""), depth=depth + 2))
    new = F.when(F.col("_starts"), begin).when(closes, F.concat(inner, F.array(_new("</code>", "close", "code", depth=depth + 1), _new("</pre>", "close", "pre", depth=depth)))).when(F.col("_inner"), inner)
    return _replaced(t, F.coalesce(new, F.array(_as_it_is())))


def strip_boilerplate(annotated: DataFrame) -> DataFrame:
    """Without elements that are no content, and without buttons by role."""
    return _kept(annotated, (is_element() & _in(F.col("name"), STRIP_TAGS)) | role_is("button"))


def _beside_code(annotated: DataFrame) -> DataFrame:
    """Adds ``_beside``: whether the token is a child of an element that has a ``pre`` as a child."""
    t = annotated.withColumn("_parent", F.coalesce(F.col("parent.pos"), F.lit(-1)))
    t = t.withColumn("_beside", F.max(is_element() & (F.col("name") == "pre")).over(Window.partitionBy("row", "_parent")))
    return t.withColumn("_beside", F.col("_beside") & F.col("parent").isNotNull())


def strip_copy_ui(annotated: DataFrame) -> DataFrame:
    """Without copy buttons within the parent of a code block."""
    t = _beside_code(annotated).withColumn("_scope", covered(F.col("_beside") & is_element()))
    return _kept(t, F.col("_scope") & has_class(COPY_CLASSES))


def clean_code_chrome(annotated: DataFrame) -> DataFrame:
    """Without siblings of a code block that have no text and no code."""
    words = (F.col("kind") == "text") & (stripped(F.col("token")) != "")
    t = _beside_code(annotated).withColumns({"_word_at": _nearest_after(F.when(words | (is_element() & (F.col("name") == "pre")), F.col("pos")))})
    empty = F.col("_word_at").isNull() | (F.col("_word_at") >= F.col("stop"))
    return _kept(t, F.col("_beside") & is_element() & ~_in(F.col("parent.name"), OPEN_CONTAINERS) & ~_in(F.col("name"), ("code", "pre")) & empty)


def collapse_code_spans(annotated: DataFrame) -> DataFrame:
    """Highlighted code becomes plain text, of each ``span.line`` one line; white space between parts of a line goes."""
    name, kind = F.col("name"), F.col("kind")
    listed = F.split(F.trim(F.coalesce(attribute(F.col("token"), "class"), F.lit(""))), r"\s+")
    order = Window.partitionBy("row").orderBy("pos")
    page = order.rowsBetween(*_ALL)
    # the first code element of a pre: no other one begins between the two
    code_open, span_open = (name == "code") & (kind == "open"), (name == "span") & (kind == "open")
    t = annotated.withColumn("_codes", F.coalesce(F.sum(code_open.cast("int")).over(order.rowsBetween(*_BEFORE)), F.lit(0)))
    pre_stop = F.max(F.when((name == "pre") & (kind == "open"), F.col("stop"))).over(Window.partitionBy("row", "_codes").orderBy("pos").rowsBetween(*_ALL))
    t = t.withColumn("_code", F.coalesce(code_open & (pre_stop > F.col("pos")), F.lit(False)))
    t = t.withColumns({"_other": _before(F.col("_code")), "_span_at": _nearest_after(F.when(span_open, F.col("pos")))})
    t = t.withColumn("_code", F.col("_code") & ~F.col("_other") & (F.col("_span_at") < F.col("stop")))
    of = F.last(F.when(F.col("_code"), F.struct("pos", "stop", "depth")), ignorenulls=True).over(page)
    t = t.withColumn("_of", of).withColumn("_of", F.when(F.col("_of.stop") > F.col("pos"), F.col("_of"))).withColumn("_at", F.col("_of.pos"))
    # lines of the block, which don't nest
    t = t.withColumn("_line", F.coalesce(F.col("_at").isNotNull() & span_open & F.array_contains(listed, "line"), F.lit(False)))
    t = t.withColumn("_other", _before(F.col("_line"))).withColumn("_line", F.col("_line") & ~F.col("_other"))
    block = Window.partitionBy("row", "_at")
    t = t.withColumns({"_lines": F.max("_line").over(block), "_nth": F.sum(F.col("_line").cast("int")).over(block.orderBy("pos").rowsBetween(*_ALL)),
                       "_line_of": F.last(F.when(F.col("_line"), F.struct("pos", "stop")), ignorenulls=True).over(page)})
    own_tag = F.col("_code") | ((kind == "close") & (F.col("depth") == F.col("_of.depth")))
    blank = ~F.col("token").rlike(r"(?U)\S") & (F.col("parent.pos") == F.col("_line_of.pos"))
    text = (kind == "text") & (~F.col("_lines") | ((F.col("_line_of.stop") > F.col("pos")) & ~blank))
    classes = F.filter(listed, lambda c: reduce(lambda a, b: a | b, (c.startswith(x) for x in CODE_CLASSES)))
    code = F.when(F.size(classes) > 0, F.concat(F.lit('<code class="'), F.array_join(classes, " "), F.lit('">'))).otherwise(F.col("token"))
    new = (F.when(F.col("_at").isNull(), F.array(_as_it_is())).when(own_tag, F.array(_as_it_is(F.when(F.col("_code"), code).otherwise(F.col("token")))))
           .when(F.col("_line") & (F.col("_nth") > 1), F.array(_new("\n"))).when(text, F.array(_new(F.col("token")))))
    return _replaced(t, F.coalesce(new, _nothing()))


def inline_spacing(annotated: DataFrame) -> DataFrame:
    """A space between inline elements that touch, where neither has one there."""
    page = Window.partitionBy("row").orderBy("pos")
    text = F.when((F.col("kind") == "text") & (F.col("token") != ""), F.struct("pos", F.left("token", F.lit(1)).alias("first"), F.right("token", F.lit(1)).alias("last")))
    t = annotated.withColumns({"_parent": F.coalesce(F.col("parent.pos"), F.lit(-1)), "_starts": is_element()})
    sibling = F.lag(F.struct("pos", "name", "stop")).over(Window.partitionBy("row", "_parent", "_starts").orderBy("pos"))
    t = t.withColumns({"_ahead": _nearest_after(text), "_behind": F.last(text, ignorenulls=True).over(page.rowsBetween(*_ALL)), "_sibling": sibling, "_previous": F.lag("pos").over(page)})
    touches = F.col("_starts") & _in(F.col("name"), INLINE) & _in(F.col("_sibling.name"), INLINE) & (F.col("_previous") < F.col("_sibling.stop")) & (F.col("_sibling.stop") <= F.col("pos"))
    apart = ~_in(F.col("_behind.last"), (" ", "\n")) & ~_in(F.col("_ahead.first"), (" ", "\n"))
    both = (F.col("_behind.pos") > F.col("_sibling.pos")) & (F.col("_ahead.pos") < F.col("stop"))
    # the element moves one place on, within the room that its place has
    moved = F.array(_new(" "), _as_it_is())
    return _replaced(t, F.when(touches & apart & both, moved).otherwise(F.array(_as_it_is())))


#: The steps of cleaning, in order; those that flatten tabs (D6, D7) would come first and are not built
STEPS = (terminal_regions, strip_boilerplate, strip_copy_ui, clean_code_chrome, collapse_code_spans, inline_spacing)


def dom_cleanup(annotated: DataFrame, steps=STEPS) -> DataFrame:
    """D13 without the flattening of tabs (D6, D7): cleaned pages, from annotated ones."""
    return reduce(lambda t, step: step(t), steps, annotated)


# ------------------------------------------------------------------ choosing

_SIMPLE = re.compile(r"(\*|[a-zA-Z][a-zA-Z0-9-]*)?((?:[.#][A-Za-z_][\w-]*)*)")


def compiled(selector: str) -> list[tuple[str | None, list[str], list[str]]]:
    """Tag, ids and classes of each part of a descendant selector; any other syntax raises."""
    parts = []
    for word in selector.split():
        m = _SIMPLE.fullmatch(word)
        if not m or not word:
            raise ValueError(f"selector {selector!r}: only tags, .classes, #ids and descendants are supported")
        marks = re.findall(r"([.#])([\w-]+)", m[2])
        parts.append((None if m[1] in (None, "*") else m[1].lower(), [x for k, x in marks if k == "#"], [x for k, x in marks if k == "."]))
    if not parts:
        raise ValueError("the selector is empty")
    return parts


def matches(annotated: DataFrame, selector: str, into: str = "matches") -> DataFrame:
    """Adds whether the selector selects an element; each part must lie within one that the parts before it select."""
    t, before = annotated, None
    page = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    classes = F.split(F.trim(F.coalesce(attribute(F.col("token"), "class"), F.lit(""))), r"\s+")
    for tag, ids, wanted in compiled(selector):
        own = is_element()
        if tag:
            own &= F.col("name") == tag
        for i in ids:
            own &= F.coalesce(attribute(F.col("token"), "id") == i, F.lit(False))
        for c in wanted:
            own &= F.array_contains(classes, c)
        if before is not None:
            own &= F.coalesce(F.max(F.when(F.col(before), F.col("stop"))).over(page) > F.col("pos"), F.lit(False))
        t = t.withColumn("_selected" if before is None else f"{before}_", own)
        before = "_selected" if before is None else f"{before}_"
    return t.withColumn(into, F.col(before)).drop(*(c for c in t.columns if c.startswith("_selected")))


def masses(annotated: DataFrame, marked: Column, mass: Column) -> DataFrame:
    """``row, pos, mass``: of each marked element the sum of ``mass`` (of tokens) in it.

    The running sum where it stops less the one where it begins: the element's
    end is a row of its own, before the token in that place.
    """
    place = lambda at, end: F.struct(at.alias("at"), F.lit(end).alias("end"))
    t = annotated.withColumns({"_marked": F.coalesce(marked, F.lit(False)), "_mass": mass.cast("long")})
    t = t.withColumn("_place", F.explode(F.when(F.col("_marked"), F.array(place(F.col("pos"), 1), place(F.col("stop"), 0))).otherwise(F.array(place(F.col("pos"), 1)))))
    total = F.sum(F.when(F.col("_place.end") == 1, F.col("_mass")).otherwise(0)).over(Window.partitionBy("row").orderBy("_place.at", "_place.end").rowsBetween(*_ALL))
    return t.withColumn("_total", total).where("_marked").groupBy("row", "pos").agg((F.max("_total") - F.min("_total")).alias("mass"))


def div_scores(annotated: DataFrame) -> DataFrame:
    """``row, pos, stop, score`` of each div: its text length and ``PARAGRAPH`` for each paragraph that is its child."""
    children = annotated.where(is_element() & (F.col("name") == "p") & (F.col("parent.name") == "div")).groupBy("row", F.col("parent.pos").alias("pos")).agg((PARAGRAPH * F.count("*")).alias("score"))
    is_div = is_element() & (F.col("name") == "div")
    texts = masses(annotated, is_div, text_length()).select("row", "pos", F.col("mass").alias("score"))
    stops = annotated.where(is_div).select("row", "pos", "stop", F.lit(0).cast("long").alias("score"))
    parts = children.unionByName(texts).withColumn("stop", F.lit(None).cast("long")).unionByName(stops)
    return parts.groupBy("row", "pos").agg(F.max("stop").alias("stop"), F.sum("score").alias("score"))


def best_div(annotated: DataFrame) -> DataFrame:
    """``row, pos, stop, score`` of each page's div of the highest score above 0, the first of equal ones."""
    best = div_scores(annotated).where("score > 0").groupBy("row").agg(F.max_by(F.struct("pos", "stop", "score"), F.struct("score", -F.col("pos"))).alias("d"))
    return best.select("row", "d.pos", "d.stop", "d.score")


#: what an article is picked by, in order
PICKED_BY = ("selector", "article", "main", "div", "body", "document")


def pick_article(annotated: DataFrame, selector: str | None = None) -> DataFrame:
    """``id, row, picked_by, pos, stop``: the content of each page.

    That is the first element of ``selector``, else the first ``article`` if it has
    more than ``SHORT_ARTICLE`` characters, else the first ``main`` by the same
    rule, else the best div, else the body, else the whole page.
    """
    t = matches(annotated, selector, "_wanted") if selector else annotated.withColumn("_wanted", F.lit(False))
    spot = F.struct("pos", "stop")
    named = lambda n: is_element() & (F.col("name") == n)
    for n in ("article", "main"):  # the first of a page, and the text in it so far
        first = F.min(F.when(named(n), spot)).over(Window.partitionBy("row"))
        t = t.withColumn(f"_{n}", first)
    in_ = lambda n: (F.col("pos") >= F.col(f"_{n}.pos")) & (F.col("pos") < F.col(f"_{n}.stop"))
    long = lambda n: F.when(F.sum(F.when(in_(n), text_length()).otherwise(0)) > SHORT_ARTICLE, F.first(f"_{n}"))
    spots = {"selector": F.min(F.when(F.col("_wanted"), spot)), "article": long("article"), "main": long("main"), "body": F.min(F.when(named("body"), spot)),
             "document": F.struct(F.min("pos").alias("pos"), (F.max("pos") + 1).alias("stop"))}
    pages = t.groupBy("row").agg(F.first("id").alias("id"), *(c.alias(k) for k, c in spots.items()))
    pages = pages.join(best_div(annotated).select("row", F.struct("pos", "stop").alias("div")), "row", "left")
    ranked = F.array(*(F.when(F.col(k).isNotNull(), F.struct(F.lit(k).alias("picked_by"), F.col(f"{k}.pos").alias("pos"), F.col(f"{k}.stop").alias("stop"))) for k in PICKED_BY))
    return pages.withColumn("_pick", F.get(F.filter(ranked, lambda x: x.isNotNull()), 0)).select("id", "row", "_pick.*")


def within(tokens: DataFrame, spots: DataFrame) -> DataFrame:
    """Tokens that lie in the one spot (``row, pos, stop``) of their page."""
    spots = spots.select("row", F.col("pos").alias("_from"), F.col("stop").alias("_to"))
    return tokens.join(spots, "row").where((F.col("pos") >= F.col("_from")) & (F.col("pos") < F.col("_to"))).drop("_from", "_to")


def joined(tokens: DataFrame, into: str, token: Column | str = "token", sep: str = "") -> DataFrame:
    """``id, row`` and the page's tokens as one string, in order."""
    token = F.col(token) if isinstance(token, str) else token
    parts = F.array_sort(F.collect_list(F.struct("pos", token.alias("token"))))
    return tokens.groupBy("row").agg(F.first("id").alias("id"), F.array_join(F.transform(parts, lambda p: p["token"]), sep).alias(into)).select("id", "row", into)


def article_words(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", selector: str | None = None) -> DataFrame:
    """``id, row, picked_by, word_count, reading_time_minutes`` of the content of each cleaned page."""
    # written once: choice and count both read it
    t = cut_lineage(dom_cleanup(annotate(tokens(pages, id_col, html_col)))).repartition(pieces(pages, html_col), "row")
    spots = pick_article(t, selector)
    words = within(t, spots).groupBy("row").agg(F.sum(F.when(F.col("kind") == "text", word_count(unescaped(F.col("token")))).otherwise(0)).cast("int").alias("word_count"))
    return spots.join(words, "row").select("id", "row", "picked_by", "word_count").withColumn("reading_time_minutes", reading_time(F.col("word_count")))
