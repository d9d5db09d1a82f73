"""N-gram Jaccard join with a token-group matrix; documents get the component of their links.

Two documents link when their sets of word shingles have a Jaccard similarity
of ``percent`` or more.  The search is exact (see below for the hashes):

1. Equal sets collapse: a set's 128-bit fingerprint names its smallest document.
2. A set that links with another shares most of its shingles with it.  So sets
   with more shingles of their own, that no set of a like size has, than a link
   allows are left out at once (small sets by all their shingles, others by a
   fixed part of all shingles: those of a link can't be fewer).  Documents are
   dealt into blocks for this; a shingle is one entry a block.
3. Similar documents are partitioned into groups that no link leaves.  Sizes of
   linked sets differ by the threshold at most, so sets meet within their size
   band or the next.  There, sets of a link differ in at most d shingles.  The
   shingles are dealt by hash into ceil((d + 1) / 2) + 1 parts, so two parts
   differ in one shingle at most; of the three thirds of such a part two are
   equal, and pairs of thirds are the signatures.  Documents that share one are
   joined to its smallest (an edge, not all pairs), and the components of these
   edges, size band by size band, are the groups.  Thirds without shingles name no signature, but where
   a set has them in two parts or more: then they do.
4. Each group is opened by token-group matrix.  A document's overlap with the
   union of all others must reach the least overlap of a link, else it leaves
   (and its shingles with it, so this repeats).  What is left, in the order of
   its least shingles, forms small groups with the union of their shingles; a
   document's overlap with each union bounds its overlap with every member, and
   only small groups that reach the least overlap of a link are opened.
   Members that are connected already are passed over.
5. A group of more than ``CHUNK_TOKENS`` shingles or ``CHUNK_DOCS`` documents is
   cut into chunks, each with the same few of its documents as pivots.  What
   the chunks and pivots leave apart from the group's largest component then
   queries all its chunks, in blocks.  So a group of copies of any size costs a
   few passes over it, and no link is lost; only a huge group whose documents
   mostly do *not* link costs more (its blocks times its chunks).

Signatures are packed per block of documents, each with the smallest document
that has it, so a signature of very many documents is one entry a block.  Texts
are shuffled only if they are in a group of two sets or more, as far as a bitmap
of fixed size tells.

Shingles are 64-bit hashes of their words: different shingles of two documents
meet with a chance of about n^2 / 2^65 for n shingles of both.

Defined results: null and empty texts, and those without words, have an empty
set, link with nothing and are their own component; fewer words than a shingle
make one shingle of all words; rows with the same id are one node, with the
links of each; a null id is in no component (null); other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import jobs as J
from sightline.llm.graph import components, forest

SHINGLE = 3
PERCENT = 90
CHUNK_TOKENS = 1 << 20
CHUNK_DOCS = 10_000
GROUP_DOCS = 16
#: cells of a token-group matrix, a byte each
MATRIX_CELLS = 1 << 25
PIVOTS = 4
BUCKET_SIGNATURES = 1 << 19
BLOCK_BYTES = 4 << 20
#: sets of fewer shingles are searched for shingles of their own in full
SMALL = 256


# ------------------------------------------------------------ shingle sets

def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending: the texts' borders, and the hashes."""
    sizes, hashes = [], []
    for a, b in A.slices(texts):
        found = A.words(texts.slice(a, b - a), fold=True)
        n, counts = len(found.hashes), found.counts
        ok = np.flatnonzero(A.window_starts(found.first, k, n))
        sh, doc = A.windows(found.hashes, k)[ok], found.doc_of_word()[ok]
        for short in range(1, k):  # texts of fewer words: all of them are one shingle
            few = np.flatnonzero(counts == short)
            if len(few):
                sh = np.concatenate([sh, A.windows(found.hashes, short)[found.first[few]] + np.uint64(short)])
                doc = np.concatenate([doc, few])
        order = np.lexsort((sh, doc))
        sh, doc = sh[order], doc[order]
        new = np.ones(len(sh), bool)
        new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
        hashes.append(sh[new])
        sizes.append(np.bincount(doc[new], minlength=b - a))
    sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(hashes) if hashes else np.empty(0, np.uint64)


def _sums(values: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2^64 of ``values`` by ``place``."""
    low = np.bincount(place, (values & np.uint64(0xFFFFFFFF)).astype(float), n).astype(np.uint64)
    high = np.bincount(place, (values >> np.uint64(32)).astype(float), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def _profile(k: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, hashes = shingle_sets(batch.column("text"), k)
        doc, n = np.repeat(np.arange(batch.num_rows), np.diff(first)), batch.num_rows
        marks = [_sums(A.mix(hashes ^ np.uint64(seed)), doc, n).view(np.int64) for seed in (0x51ED270B, 0x9B97A3C5D1)]
        return J.batch_of(id=batch.column("id"), n=pa.array(np.diff(first), pa.int64()), f1=pa.array(marks[0], pa.int64()), f2=pa.array(marks[1], pa.int64()))

    return run


# -------------------------------------------------------------- signatures

def size_bands(percent: int, largest: int) -> np.ndarray:
    """Lower ends of the size bands; sets under the first link with equal sets only."""
    ends = [max(1, -(-percent // (100 - percent)))]
    ends.append(ends[0] + 1)
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, (ends[-1] - 1) * 100 // percent + 1))
    return np.array(ends)


def _parts(bands: np.ndarray, scheme: np.ndarray, percent: int) -> np.ndarray:
    """Parts that the sets of two neighbouring bands are dealt into; a scheme has the number of the lower one."""
    differ = (bands[scheme + 1] - 1) * (100 - percent) // percent
    return (differ + 2) // 2 + 1


def bucket_bits(sizes: dict[int, int], percent: int, per_bucket: int = BUCKET_SIGNATURES) -> np.ndarray:
    """How many bits of a signature deal each scheme's signatures to its buckets, by the numbers of sets of each size."""
    bands = size_bands(percent, max(sizes, default=1))
    load = np.zeros(len(bands))
    for size, n in sizes.items():
        band = int(np.searchsorted(bands, size, "right")) - 1
        for scheme in (band, band - 1):
            if scheme >= 0:
                load[scheme] += 3 * n * int(_parts(bands, np.array([scheme]), percent)[0])
    return np.array([J.power_of_two(x / per_bucket) for x in load], np.uint64)


def signatures(first: np.ndarray, hashes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of sets, the set of each, and the scheme of each."""
    size = np.diff(first)
    bands = size_bands(percent, int(size.max(initial=1)))
    band = np.searchsorted(bands, size, "right") - 1
    doc = np.repeat(np.arange(len(size)), size)
    third = (hashes >> np.uint64(40)) % np.uint64(3)
    out, owner, of_scheme = [], [], []
    for scheme in (band, band - 1):  # with its own band and the next; with the one before
        use = np.flatnonzero((band >= 0) & (scheme >= 0))
        parts = np.zeros(len(size), np.int64)
        parts[use] = _parts(bands, scheme[use], percent)
        base = np.cumsum(parts) - parts
        mine = parts[doc] > 0
        part = base[doc[mine]] + (hashes[mine] >> np.uint64(4)).astype(np.int64) % parts[doc[mine]] if mine.any() else np.empty(0, np.int64)
        total = int(parts.sum())
        place = part * 3 + third[mine].astype(np.int64)
        sums = _sums(A.mix(hashes[mine]), place, total * 3).reshape(-1, 3)
        count = np.bincount(place, minlength=total * 3).reshape(-1, 3)
        of = np.repeat(np.arange(len(size)), parts)
        name = A.mix((np.repeat(scheme + 1, parts).astype(np.uint64) << np.uint64(40)) + (np.arange(total) - base[of]).astype(np.uint64))
        empty = np.stack([count[:, a] + count[:, b] == 0 for a, b in ((0, 1), (1, 2), (0, 2))], 1)
        hollow = np.bincount(of, empty.any(1), len(size)) >= 2
        for j, (a, b) in enumerate(((0, 1), (1, 2), (0, 2))):
            keep = ~empty[:, j] | hollow[of]
            out.append(A.mix(A.mix(sums[:, a] + sums[:, b] * np.uint64(3)) + name + np.uint64(j))[keep])
            owner.append(of[keep])
            of_scheme.append(scheme[of[keep]])
    return np.concatenate(out), np.concatenate(owner), np.concatenate(of_scheme)


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return new


def _to_least(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For signatures in order, and by document: which come first, and edges from the others' documents to the first's."""
    new = _starts(sig)
    least = doc[np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))]
    edges = np.stack([doc[~new], least[~new]], 1)
    return new, forest(edges[edges[:, 0] != edges[:, 1]])


# ------------------------------------------------- shingles that no one else has

def _counted_shingles(first: np.ndarray, hashes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the shingles that are counted, the set of each, and whether they count for it.

    Small sets are counted whole; of others, those shingles whose hash divides
    by a fixed number.  Sets that may be linked across ``SMALL`` name their
    shingles in both ways, so that either kind meets all it may be linked to.
    """
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    thin = max(1, 60 // (100 - percent))
    own = size < SMALL
    low = (size * percent < SMALL * 100)[doc]  # whoever may be linked to a small set
    high = (size * 100 >= SMALL * percent)[doc] & (hashes % np.uint64(thin) == 0)  # whoever may be linked to another set
    names = np.concatenate([A.mix(hashes[low] ^ np.uint64(0xA5A5A5A5)), hashes[high]])
    return names, np.concatenate([doc[low], doc[high]]), np.concatenate([own[doc[low]], ~own[doc[high]]])


def _named(k: int, percent: int, bits: int):
    """Per block and bucket: the different counted shingles."""
    def run(block: pa.Table) -> pa.Table:
        names = np.unique(_counted_shingles(*shingle_sets(J.column(block, "text"), k), percent)[0])
        bucket = (names >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
        ends = np.flatnonzero(_starts(bucket)).tolist() + [len(bucket)]
        number = J.column(block, "block")[0].as_py()
        return pa.table({"bucket": pa.array([int(bucket[x]) for x in ends[:-1]], pa.int64()), "block": pa.array([number] * (len(ends) - 1), pa.int64()),
                         "names": pa.array([A.binary(names[x:y]) for x, y in zip(ends, ends[1:])], pa.binary())})

    return run


def _in_several(bucket: pa.Table) -> pa.Table:
    """For each block, its shingles that another block has too."""
    blocks, names = J.column(bucket, "block").to_numpy(), [A.numbers(x, np.uint64) for x in J.column(bucket, "names").to_pylist()]
    every = np.sort(np.concatenate(names))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = [x[np.isin(x, twice, assume_unique=True)] for x in names]
    return pa.table({"block": pa.array(blocks, pa.int64()), "names": pa.array([A.binary(x) for x in out], pa.binary())})


def _packed(k: int, percent: int, bits: np.ndarray):
    """Per block and bucket: signatures with the smallest document of each, and edges within the block.

    Sets with more shingles of their own than a link allows are left out.  A
    bucket holds signatures of one scheme, so copies meet in few buckets.
    """
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = J.column(block, "id").to_numpy(zero_copy_only=False), J.column(block, "text")
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first, hashes = shingle_sets(texts.take(pa.array(order)), k)
        size = np.diff(first)
        names, doc, counts = _counted_shingles(first, hashes, percent)
        told = [A.numbers(x, np.uint64) for x in J.column(answers, "names").to_pylist()] if answers.num_rows else []
        own, which, often = np.unique(names, return_inverse=True, return_counts=True)
        alone = (often == 1) & ~np.isin(own, np.concatenate(told) if told else np.empty(0, np.uint64))
        unshared = np.bincount(doc[alone[which] & counts], minlength=len(size))
        kept = np.flatnonzero((unshared <= size - -(-percent * size // 100)) & (size > 0))
        hashes = hashes[np.repeat(np.isin(np.arange(len(size)), kept), size)]
        ids, first = ids[kept], np.concatenate([[0], np.cumsum(size[kept])])
        sig, owner, scheme = signatures(first, hashes, percent)
        shift = np.uint64(64) - bits[scheme]
        bucket = (scheme << 32) | np.where(bits[scheme] > 0, sig >> np.minimum(shift, np.uint64(63)), np.uint64(0)).astype(np.int64)
        order = np.lexsort((owner, sig, bucket))
        sig, owner, bucket = sig[order], owner[order], bucket[order]
        ends, rows = np.flatnonzero(_starts(bucket)).tolist() + [len(bucket)], []
        for a, b in zip(ends, ends[1:]):
            new, edges = _to_least(sig[a:b], owner[a:b])
            by_doc = np.argsort(owner[a:b][new], kind="stable")
            who, n = np.unique(owner[a:b][new], return_counts=True)
            rows.append((int(bucket[a]), A.binary(sig[a:b][new][by_doc]), A.binary(ids[who]), A.binary(n.astype(np.int32)), A.binary(ids[edges])))
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.binary()] * 4))], names=["bucket", "sigs", "ids", "counts", "edges"])

    return run


def _met(bucket: pa.Table) -> pa.Table:
    """Edges that connect documents with a signature in common."""
    blobs = {c: J.column(bucket, c).to_pylist() for c in ("sigs", "ids", "counts", "edges")}
    sig = np.concatenate([A.numbers(x, np.uint64) for x in blobs["sigs"]])
    ids = np.concatenate([np.repeat(A.numbers(i, np.int64), A.numbers(n, np.int32)) for i, n in zip(blobs["ids"], blobs["counts"])])
    order = np.lexsort((ids, sig))
    edges = forest(np.concatenate([_to_least(sig[order], ids[order])[1], *(A.numbers(x, np.int64).reshape(-1, 2) for x in blobs["edges"])]))
    scheme = J.column(bucket, "bucket")[0].as_py() >> 32
    return pa.table({"a": pa.array(edges[:, 0], pa.int64()), "b": pa.array(edges[:, 1], pa.int64()), "scheme": pa.array(np.full(len(edges), scheme), pa.int64())})


# ------------------------------------------------------ token-group matrix

def _shared(hashes: np.ndarray, owner: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles, as numbers, that several sets have, of the sets that have enough of them for a link; and the set of each.

    The bound by the union of all other sets, applied until it removes no more.
    """
    ascending = np.sort(hashes)
    several = np.unique(ascending[1:][ascending[1:] == ascending[:-1]])
    if not len(several):
        return np.empty(0, np.int32), owner[:0]
    flat = np.minimum(np.searchsorted(several, hashes), len(several) - 1).astype(np.int32)
    keep, need = several[flat] == hashes, -(-percent * size // 100)
    del ascending
    while True:
        flat, owner = flat[keep], owner[keep]
        shared = np.bincount(flat, minlength=len(several))[flat] > 1
        keep = shared & (np.bincount(owner[shared], minlength=len(size)) >= need)[owner]
        if keep.all():
            break
    return np.unique(flat, return_inverse=True)[1].astype(np.int32), owner


def linked(first: np.ndarray, hashes: np.ndarray, known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets which links connect; ``known``: components so far, by set.

    Not every link is returned: those between sets connected already are not looked for.
    """
    size = np.diff(first)
    flat, owner = _shared(hashes, np.repeat(np.arange(len(size), dtype=np.int32), size), size, percent)
    if not len(flat):
        return []
    left = np.unique(owner)
    order = left[np.lexsort((size[left], hashes[first[:-1][left]]))]  # sets with the same least shingle are next to each other
    rank = np.zeros(len(size), np.int32)
    rank[order] = np.arange(len(order))
    owner = rank[owner]
    by_set = np.argsort(owner, kind="stable")
    flat, owner = flat[by_set], owner[by_set]
    size, comp = size[order], np.unique(known[order], return_inverse=True)[1]
    begin = np.searchsorted(owner, np.arange(len(size) + 1))
    tokens = int(flat.max()) + 1
    per = max(GROUP_DOCS, -(-len(size) * tokens // MATRIX_CELLS))
    group = np.arange(len(size)) // per
    matrix = np.zeros((int(group[-1]) + 1, tokens), bool)
    matrix[group[owner], flat] = True
    here, found = np.zeros(tokens, np.uint8), []
    for q in range(len(size) - 1):
        apart = comp[q + 1 :] != comp[q]
        if not apart.any():
            continue
        mine = flat[begin[q] : begin[q + 1]]
        bound = np.count_nonzero(matrix[group[q] :, mine], axis=1)
        opened = (bound >= -(-percent * int(size[q]) // 100))[group[q + 1 :] - group[q]]
        others = np.flatnonzero(apart & opened & (100 * size[q] >= percent * size[q + 1 :]) & (100 * size[q + 1 :] >= percent * size[q])) + q + 1
        if not len(others):
            continue
        here[mine] = 1
        a, b = begin[others[0]], begin[others[-1] + 1]
        overlap = np.add.reduceat(here[flat[a:b]], begin[others[0] : others[-1] + 1] - a, dtype=np.int64)[others - others[0]]
        here[mine] = 0
        for s in others[100 * overlap >= percent * (size[others] + size[q] - overlap)].tolist():
            if comp[s] != comp[q]:
                comp[comp == comp[s]] = comp[q]
                found.append((int(order[q]), int(order[s])))
    return found


def _opened(k: int, percent: int):
    def run(task: pa.Table) -> pa.Table:
        ids, known = (J.column(task, c).to_numpy() for c in ("id", "known"))
        keys = np.stack([J.column(task, c).to_numpy() for c in ("grp", "block", "chunk")])
        order = np.lexsort(keys[::-1])
        turn = np.flatnonzero(np.any(np.diff(keys[:, order], axis=1) != 0, axis=0)) + 1
        texts, out = J.column(task, "text"), []
        for part in np.split(order, turn):
            first, hashes = shingle_sets(texts.take(pa.array(part)), k)
            out += [(int(ids[part[x]]), int(ids[part[y]])) for x, y in linked(first, hashes, known[part], percent)]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _open(texts: DataFrame, rows: DataFrame, tokens: int, k: int, percent: int) -> DataFrame:
    """Links within each (grp, block, chunk) of ``rows``; small ones share a task."""
    tasks = max(1, -(-2 * tokens // CHUNK_TOKENS))
    dealt = J.known_rows(texts, rows, "id").withColumn("task", F.pmod(F.xxhash64("grp", "block", "chunk"), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(J.trimmed(_opened(k, percent)), "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                       chunk_tokens: int = CHUNK_TOKENS, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """``doc_id, n_shingles, component_id, set_id`` for each row; ``set_id`` is the smallest document with an equal set."""
    if not 50 <= percent < 100:
        raise ValueError("percent must be from 50 to 99")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    profile = J.cut_lineage(J.map_arrow(texts, _profile(shingle), "id long, n long, f1 long, f2 long"))
    nodes = profile.where("id IS NOT NULL AND n > 0")
    sets = nodes.groupBy("n", "f1", "f2").agg(F.min("id").alias("set_id"))
    texts = texts.where("id IS NOT NULL")

    sizes = {r.n: r.m for r in nodes.groupBy("n").agg(F.count("*").alias("m")).collect()}  # a row for each size of set
    size = J.text_bytes(texts)
    blocks = texts.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-size // BLOCK_BYTES)))))
    named = blocks.groupBy("block").applyInArrow(J.trimmed(_named(shingle, percent, J.power_of_two(size / 18 / BUCKET_SIGNATURES))), "bucket long, block long, names binary")
    several = named.groupBy("bucket").applyInArrow(J.trimmed(_in_several), "block long, names binary")
    packed = blocks.groupBy("block").cogroup(several.groupBy("block")).applyInArrow(
        J.trimmed_pair(_packed(shingle, percent, bucket_bits(sizes, percent))), "bucket long, sigs binary, ids binary, counts binary, edges binary")
    met = packed.groupBy("bucket").applyInArrow(J.trimmed(_met), "a long, b long, scheme long")
    groups = components(met.select(F.xxhash64("a", "scheme").alias("a"), F.xxhash64("b", "scheme").alias("b"))).withColumnRenamed("component", "grp")
    own = sets.select(F.col("set_id").alias("id"), "n")
    lower = size_bands(percent, max(sizes, default=1)).tolist()
    band = F.size(F.filter(F.array(*(F.lit(x) for x in lower)), lambda x: x <= F.col("n"))) - 1
    own = own.withColumn("scheme", F.explode(F.array(band, band - 1))).withColumn("node", F.xxhash64("id", F.col("scheme").cast("long")))
    members = groups.join(own, "node").groupBy("id", "grp").agg(F.sum("n").alias("n"))
    sizes = members.groupBy("grp").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")).where("docs > 1")
    sizes = sizes.select("grp", F.greatest(F.ceil(F.col("tokens") / chunk_tokens), F.ceil(F.col("docs") / chunk_docs)).cast("long").alias("chunks"))
    members = J.cut_lineage(members.join(sizes, "grp").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))))

    large = members.where("chunks > 1")
    rank = Window.partitionBy("grp").orderBy("id")
    pivots = large.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= PIVOTS)
    pivots = pivots.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).where("to != chunk")
    task = ["id", "grp", F.lit(0).cast("long").alias("block"), "chunk", F.col("id").alias("known")]
    rows = members.select(*task).union(pivots.drop("chunk").withColumnRenamed("to", "chunk").select(*task))
    tokens = members.agg(F.sum("n")).first()[0] or 0
    # a join of its own stage, so that adaptive execution can split a set that very many documents have
    equal = J.cut_lineage(nodes.join(sets, ["n", "f1", "f2"]).where("id != set_id").select(F.col("id").alias("a"), F.col("set_id").alias("b")))
    links = J.cut_lineage(equal.union(_open(texts, rows, tokens, shingle, percent)))
    found = components(links)

    if not large.isEmpty():  # what is still apart in cut groups queries all their chunks
        now = large.join(found, large.id == found.node, "left").select(large["*"], F.coalesce("component", "id").alias("known"))
        main = now.groupBy("grp", "known").count().groupBy("grp").agg(F.max(F.struct("count", "known")).alias("m")).select("grp", F.col("m.known").alias("main"))
        apart = now.join(main, "grp").where("known != main")
        blocks = apart.groupBy("grp").agg(F.greatest(F.ceil(F.sum("n") / chunk_tokens), F.ceil(F.count("*") / chunk_docs)).cast("long").alias("blocks"))
        queries = apart.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")))
        queries = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        against = now.join(blocks, "grp").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = J.cut_lineage(queries.select("id", "grp", "block", "chunk", "known", "n").union(against.select("id", "grp", "block", "chunk", "known", "n")))
        tokens = rows.agg(F.sum("n")).first()[0] or 0
        more = _open(texts, rows.drop("n").distinct(), tokens, shingle, percent)
        found = components(links.union(more))

    return (profile.join(sets, ["n", "f1", "f2"], "left").join(found, profile.id == found.node, "left")
            .select(profile.id.alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", profile.id).alias("component_id"),
                    F.when(F.col("n") > 0, F.col("set_id")).otherwise(profile.id).alias("set_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the smallest document of each component; rows without an id stay, and so do rows that share one."""
    found = jaccard_components(docs, id_col, text_col, shingle, percent)
    later = J.cut_lineage(found.where("doc_id != component_id").select(F.col("doc_id").alias(id_col)).distinct())
    return J.without(docs, later, id_col)


def one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, whether rows share an id or have none: the one of the smallest id (a null id is the largest).

    Rows are nodes of their own, by a number that is written with them; texts without words have no copies.
    """
    keyed = J.cut_lineage(docs.withColumn("__key", F.monotonically_increasing_id()))
    found = jaccard_components(keyed, "__key", text_col, shingle, percent).select(F.col("doc_id").alias("__key"), "component_id")
    found = J.cut_lineage(found.join(keyed.select("__key", F.col(id_col).alias("id")).hint("merge"), "__key"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "__key"))["__key"].alias("__key")
    stay = found.groupBy("component_id").agg(first).select("__key")
    later = J.cut_lineage(found.join(stay.hint("merge"), "__key", "left_anti").select("__key"))
    return J.without(keyed, later, "__key").drop("__key")
