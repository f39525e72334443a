"""Jaccard join of documents' word shingles with set-relation skipping.

The work falls into these steps:

1. Documents with equal shingle sets are one class; its smallest id stands for it.
2. Texts lie in slices of some megabytes, by id. A slice counts its shingles and
   sends each once, whatever number of its documents holds it, to the bucket of
   its hash; the bucket adds the slices' counts up and answers each slice with one
   byte a shingle. So a passage in a third of all documents gives its bucket one
   entry a slice, and each class learns which of its shingles another one holds
   too. A class that shares less than the threshold of its set can link with
   nothing and leaves.
3. The classes left order their shingles by rarity and index a prefix: two sets
   over the threshold share an indexed shingle. A list's entries lie in blocks of
   set size and position. An entry tells up to which position another one of its
   list may stand, and meets the blocks up to there only: the others are skipped
   whole, and entries that stand too late for each other never meet, however many
   a list has. Sizes and positions rule out more before any set is read.
4. A list's smallest set answers first: its exact overlap with each other set of
   the list is counted. The others' answers derive from it: sets it links with
   are one component and are not compared again, and a pair whose distances to
   it differ by more than the allowed distance can't link (Jaccard distance is a
   metric). Only the pairs that stay open are counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, staged, text_buffers, text_bytes, text_slices
from .components import components
from .substring_dedup import planes, unplanes
from .words import Words, constants, inside, mix, ngrams

SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])
SETS_DDL = "doc_id long, n long, d1 long, d2 long"
POSTINGS = pa.schema([("slice", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
POSTINGS_DDL = "slice int, bucket int, hashes binary, counts binary"
RANKS = pa.schema([("slice", pa.int32()), ("bucket", pa.int32()), ("ranks", pa.binary())])
RANKS_DDL = "slice int, bucket int, ranks binary"
PER_SLICE = 4 << 20  # bytes of text in a slice, on average
# a shingle's key: its bucket, chosen by the upper bits of its hash, and its lowest 40 bits, which are what the bucket
# gets. A bucket holds some million shingles, so few of one key differ; they count as shared, which adds candidates only
KEY_BYTES, KEY_BITS, KEY_MASK = 5, np.uint64(40), np.uint64((1 << 40) - 1)
MOST_BUCKETS = 1 << 24


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, as (text number, hash) sorted by both.

    A text of fewer words than ``size`` has its whole word sequence as its one shingle.
    """
    numbers, counts = w.numbers(lower=True), w.counts()
    ok = inside(w.offs, size, len(numbers))
    rows, hashes = [w.rows()[:len(ok)][ok]], [ngrams(numbers, size)[ok]]
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        total = np.full(len(short), k, np.uint64)
        for j, c in enumerate(constants(k, 17 + k)):
            total += numbers[w.offs[short] + j] * c
        rows.append(short)
        hashes.append(mix(total))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def set_digests(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two independent 64-bit digests of each of ``n`` sets."""
    ends = np.searchsorted(row, np.arange(n + 1))
    size = np.diff(ends)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
        return (sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)
    return size, total(mix(h ^ np.uint64(0x5851F42D4C957F2D))), total(mix(h ^ np.uint64(0x14057B7EF767814F)))


def describe(size: int):
    """(doc_id, text) -> size and digest of the document's shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            w = Words(*text_buffers(part.column("text")))
            n, d1, d2 = set_digests(*shingle_sets(w, size), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(d1),
                                              pa.array(d2)], schema=SETS)
    return run


def slice_shingles(group: pa.Table, size: int, buckets: int):
    """A slice's sets, of equal ones only the smallest id's, and the distinct keys of their shingles in order.

    Returns ids; size and digests of their sets; set number, hash and key number of each entry; the keys; where
    each bucket's begin.
    """
    docs = group.column("doc_id").to_numpy().astype(np.int64)
    row, h = shingle_sets(Words(*text_buffers(group.column("text"))), size)
    n, d1, d2 = set_digests(row, h, len(docs))
    order = np.lexsort((docs, d2, d1, n))
    first = np.ones(len(order), bool)
    first[1:] = np.any([k[order][1:] != k[order][:-1] for k in (n, d1, d2)], axis=0)
    stays = np.zeros(len(order), bool)
    stays[order[first]] = True
    stays &= n > 0
    row, h = np.cumsum(stays)[row[stays[row]]] - 1, h[stays[row]]
    keys, at = np.unique((((h >> KEY_BITS) % np.uint64(buckets)) << KEY_BITS) | (h & KEY_MASK), return_inverse=True)
    begins = np.searchsorted(keys >> KEY_BITS, np.arange(buckets + 1, dtype=np.uint64))
    return docs[stays], (n[stays], d1[stays], d2[stays]), row, h, at, keys, begins


def postings(size: int, buckets: int):
    """A slice (slice, doc_id, text) -> its distinct shingles by bucket, with the number of sets that hold each."""
    def run(group: pa.Table) -> pa.Table:
        _, _, _, _, at, keys, begins = slice_shingles(group, size, buckets)
        counts = np.bincount(at, minlength=len(keys)).astype(np.uint32)
        own = group.column("slice")[0].as_py()
        out = [(own, int(b), planes(keys[i:j], KEY_BYTES), planes(counts[i:j], 4))
               for b, i, j in ((b, begins[b], begins[b + 1]) for b in np.flatnonzero(np.diff(begins)))]
        return pa.Table.from_pylist([dict(zip(POSTINGS.names, x)) for x in out], POSTINGS)
    return run


def shared_shingles(group: pa.Table) -> pa.Table:
    """A bucket's postings -> a byte for each: 0 if no other set holds the shingle, else 1 + log2 of their number."""
    hashes = [unplanes(x, KEY_BYTES, np.uint64) for x in group.column("hashes").to_pylist()]
    h = np.concatenate(hashes)
    counts = np.concatenate([unplanes(x, 4, np.uint32) for x in group.column("counts").to_pylist()]).astype(np.int64)
    order = np.argsort(h)
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    starts = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], starts)
    rank = np.where(total > 1, 1 + np.log2(total).astype(np.uint8), 0).astype(np.uint8)
    ranks = np.empty(len(h), np.uint8)
    ranks[order] = np.repeat(rank, np.diff(np.append(starts, len(s))))
    cuts = np.append(0, np.cumsum([len(x) for x in hashes]))
    return pa.table([group.column("slice"), group.column("bucket"),
                     pa.array([ranks[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())], schema=RANKS)


ORDERED = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("alone", pa.int64()),
                     ("common", pa.float64()), ("tokens", pa.list_(pa.int64()))])
ORDERED_DDL = "rep long, n long, d1 long, d2 long, alone long, common double, tokens array<long>"


def ordered_sets(size: int, percent: int, buckets: int):
    """A slice and its answers -> the shared shingles of each set that shares enough, rarest first.

    ``alone``: how many others no set shares; ``common``: mean log2 count of all
    the set's shingles. Among near copies the text they were made from has the
    largest, since all of its shingles occur in most of them.
    """
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows or not answers.num_rows:
            return ORDERED.empty_table()
        docs, (n, d1, d2), row, h, at, _, _ = slice_shingles(group, size, buckets)
        ranks = np.frombuffer(b"".join(answers.sort_by("bucket").column("ranks").to_pylist()), np.uint8)[at]
        row, h, rank = row[ranks > 0], h[ranks > 0], ranks[ranks > 0] - 1
        shared = np.bincount(row, minlength=len(docs))
        common = np.bincount(row, rank, minlength=len(docs)) / n
        stays = shared * 100 >= n * percent
        keep = stays[row]
        row, h, rank = row[keep], h[keep], rank[keep]
        tokens = h[np.lexsort((h, rank, row))].view(np.int64)
        ends = np.append(0, np.cumsum(shared[stays])).astype(np.int32)
        return pa.table([docs[stays], n[stays], d1[stays], d2[stays], (n - shared)[stays], common[stays],
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens))], schema=ORDERED)
    return run


def _least(n: Column, percent: int) -> Column:
    """Smallest overlap with which a set of n can link."""
    return F.ceil(n * percent / 100.0 - 1e-9)


def _links(overlap: Column, n1: Column, n2: Column, percent: int) -> Column:
    return overlap * 100 >= (n1 + n2 - overlap) * percent


def _possible(x: str, y: str, percent: int) -> Column:
    """Sizes and positions of the first shingle that two sets share still allow a link.

    A pair over the threshold passes at its first shared shingle, which is one look more than needed of it.
    """
    bound = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
    return _links(bound, F.col(f"{x}.n"), F.col(f"{y}.n"), percent)


def _room(n: Column, pos: Column, percent: int) -> Column:
    """Up to which position another set's first shared shingle may stand, if this set's stands at ``pos``.

    The shingles before it are in one of the sets only, at most n - pos are in both.
    """
    return F.floor((n - pos) * (100 - percent) / percent - pos + 1e-9)


def _stretch(pos: Column) -> Column:
    """Block of a position: 0, 1-3, 4-15, 16-63 and so on."""
    return F.ceil(F.log(pos + 1) / math.log(4) - 1e-9).cast("int")


def meetings(entry: DataFrame) -> DataFrame:
    """Pairs x, y of entries of one list whose blocks may hold a pair over the threshold, x being the smaller set."""
    x = (entry.withColumn("block", F.explode(F.array("block", F.col("block") + 1)))
         .withColumn("stretch", F.explode(F.sequence(F.lit(0), _stretch(F.col("room"))))).alias("x"))
    return (x.join(entry.withColumn("stretch", _stretch(F.col("pos"))).alias("y"), ["token", "block", "stretch"])
            .where("struct(x.n, x.rep) < struct(y.n, y.rep)"))


def _counted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact overlap of each pair (a, b)."""
    def side(k: str) -> DataFrame:
        return sets.select(F.col("rep").alias(k), F.col("n").alias(f"n_{k}"), F.col("tokens").alias(f"t_{k}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("t_a", "t_b")).cast("long").alias("overlap")))


def link_classes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) for the sets (rep, n, alone, tokens) that link with a smaller one, directly or not."""
    # index: the rarest shingles of each set; those that no other set holds need no entry
    length = F.col("n") - _least(F.col("n"), percent) + 1 - F.col("alone")
    index = staged(sets.where(length > 0)
                   .select("rep", "n", "alone", "common", F.posexplode(F.slice("tokens", F.lit(1), length.cast("int"))))
                   .select(F.col("col").alias("token"), "rep", "n", "common", (F.col("pos") + F.col("alone")).alias("pos")), "index")
    # each list's most central set answers for all of the list
    lists = (index.groupBy("token")
             .agg(F.max(F.struct("common", (-F.col("rep")).alias("minus"), "n", "rep", "pos")).alias("lead"),
                  F.count("*").alias("size"))
             .where("size > 1").select("token", F.col("lead.rep").alias("rep"), F.col("lead.n").alias("n"),
                                       F.col("lead.pos").alias("pos")))
    first = (lists.alias("x").join(index.alias("y"), "token")
             .where("x.rep <> y.rep").where(_possible("x", "y", percent))
             .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())
    first = staged(_counted(first, sets), "first-answers")
    linked = _links(F.col("overlap"), F.col("n_a"), F.col("n_b"), percent)
    known = components(first.where(linked))

    # lists whose sets aren't all of one component are open
    named = (index.join(known.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")))
    open_lists = (named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .where("lo < hi").select("token"))
    # distance to the list's first set
    far = first.select(F.col("a").alias("lead"), F.col("b").alias("rep"),
                       (1 - F.col("overlap") / (F.col("n_a") + F.col("n_b") - F.col("overlap"))).alias("far"))
    entry = (named.join(open_lists, "token")
             .join(lists.select("token", F.col("rep").alias("lead")), "token")
             .join(far, ["lead", "rep"], "left")
             .withColumn("far", F.when(F.col("lead") == F.col("rep"), F.lit(0.0)).otherwise(F.col("far")))
             # sets of one block and the next are the only ones whose sizes may agree
             .withColumn("block", F.floor(F.log("n") / math.log(101.0 / percent)).cast("int"))
             .withColumn("room", _room(F.col("n"), F.col("pos"), percent)).where("room >= 0")
             .select("token", "block", "rep", "n", "pos", "room", "component", "lead", "far"))
    entry = staged(entry, "open-lists")
    allowed = 1 - percent / 100.0 + 1e-9
    pairs = (meetings(entry)
             .where("x.component <> y.component and x.pos <= y.room and y.pos <= x.room")
             .where("x.rep <> x.lead and y.rep <> y.lead")  # the first set's answers are known
             .where(F.coalesce(F.abs(F.col("x.far") - F.col("y.far")) <= allowed, F.lit(True)))
             .where(_possible("x", "y", percent))
             .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())
    second = staged(_counted(pairs, sets).where(linked).select("a", "b"), "open-answers")
    if second.isEmpty():
        return known
    return components(second.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
         percent: int = 75) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of ``percent`` % or more.

    Words are runs of characters other than the six ASCII blanks, A-Z
    lower-cased; a set holds the distinct ``size``-word shingles of the whole
    text, or the whole word sequence where there are fewer words. A null, empty
    or blank text has an empty set and links with nothing. Equal texts and texts
    with equal sets are one class. An empty table gives no rows; other columns
    are ignored. Rows without id are left out; rows
    that repeat an id and text get equal answers.

    Returns doc_id, n_shingles, component_id (smallest id reachable by links).
    """
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .where("doc_id is not null"))
    n_bytes = text_bytes(texts)
    buckets = min(bucket_count(n_bytes), MOST_BUCKETS)
    described = staged(texts.mapInArrow(describe(size), SETS_DDL), "shingle-sets")
    classes = (described.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep")))
    # one exchange of the texts serves both looks at a slice
    placed = texts.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(bucket_count(n_bytes, PER_SLICE))).cast("int"))
    ranks = (placed.groupBy("slice").applyInArrow(postings(size, buckets), POSTINGS_DDL)
             .groupBy("bucket").applyInArrow(shared_shingles, RANKS_DDL))
    shared = (placed.groupBy("slice").cogroup(ranks.groupBy("slice"))
              .applyInArrow(ordered_sets(size, percent, buckets), ORDERED_DDL))
    sets = staged(shared.join(classes, ["rep", "n", "d1", "d2"], "left_semi")
                  .select("rep", "n", "alone", "common", "tokens"), "shared-sets")
    linked = link_classes(sets, percent)
    # a table of its own, so that in the join with it Spark can split a class that holds most of the documents
    named = staged(classes.join(linked.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("n", "d1", "d2", F.coalesce("component", "rep").alias("component_id")), "class-components")
    return (described.join(named, ["n", "d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
