"""Deduplication of content-defined line chunks.

A rolling hash over the hashes of the last ``WINDOW`` lines ends a chunk where
it is divisible by ``every``, so the same run of lines is cut alike wherever it
stands, after insertions too. A chunk ends no earlier than after ``least`` lines,
and fewer lines left over at a text's end join the chunk before. Chunks of two
lines or more that occur more than once in the corpus stay only at their first
place; a later one goes only if its bytes equal the first one's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_slices

WINDOW = 2
EVERY = 4  # a boundary may fall after one line in so many
LEAST = 2  # lines in a chunk at least; with 1, one-line chunks arise, which are never removed
RADIX = 31


def chunks(text: str, every: int = EVERY, least: int = LEAST) -> list[list[str]]:
    """The lines of a text, grouped into chunks."""
    if not text:
        return []
    out, own, before = [], [], 0
    for line in text.split("\n"):
        here = int.from_bytes(hashlib.md5(line.encode()).digest()[:4])
        own.append(line)
        if len(own) >= least and (here + RADIX * before) % every == 0:
            out.append(own)
            own = []
        before = here
    if own and out and len(own) < least:
        out[-1] += own
    elif own:
        out.append(own)
    return out


def key_of(lines: list[str]) -> bytes:
    return hashlib.md5("\n".join(lines).encode()).digest()


KEYS_DDL = "key binary, doc_id long, place int"
KEYS = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("place", pa.int32())])


def chunk_keys(every: int, least: int):
    """(doc_id, text) -> key and place of every chunk of two lines or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = [(key_of(c), doc, i)
                    for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                    for i, c in enumerate(chunks(text, every, least)) if len(c) > 1]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, KEYS.types)],
                                             schema=KEYS)
    return run


BODIES_DDL = "key binary, doc_id long, place int, body string"


def chunk_bodies(every: int, least: int):
    """(doc_id, text, places) -> the chunks at those places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = []
            for doc, text, places in zip(*(part.column(k).to_pylist() for k in ("doc_id", "text", "places"))):
                own = chunks(text, every, least)
                rows += [(key_of(own[i]), doc, i, "\n".join(own[i])) for i in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, [*KEYS.types, pa.string()])],
                names=[*KEYS.names, "body"])
    return run


KEPT_DDL = "doc_id long, n_lines long, n_removed long, text string"


def without_chunks(every: int, least: int):
    """(doc_id, text, places) -> the text without the chunks at those places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            lines, removed, texts = [], [], []
            for text, places in zip(part.column("text").to_pylist(), part.column("places").to_pylist()):
                if not places:
                    lines.append(text.count("\n") + 1 if text else 0)
                    removed.append(0)
                    texts.append(text)
                    continue
                own, gone = chunks(text, every, least), set(places)
                lines.append(sum(map(len, own)))
                removed.append(sum(len(own[i]) for i in gone))
                texts.append("\n".join(line for i, c in enumerate(own) if i not in gone for line in c))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lines, pa.int64()),
                                              pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_lines", "n_removed", "text"])
    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY,
          least: int = LEAST) -> DataFrame:
    """Remove repeated multi-line chunks, all but the first place (smallest id, then place in the text).

    Lines end at line feeds. A null or empty text has no lines and stays as it
    is; a text whose chunks all go becomes empty; texts of one line stay; a
    chunk repeated within one text goes there too. An empty table gives no rows;
    other columns are ignored. Rows without id are left out; rows that repeat an
    id and text count as one document and get equal answers.

    Returns doc_id, n_lines, n_removed, text (the lines that stay).
    """
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .where("doc_id is not null"))
    keys = staged(texts.mapInArrow(chunk_keys(every, least), KEYS_DDL), "chunk-keys")
    # one row for each repeated key, with its first place; a table of its own, so that in
    # the joins with it Spark can split the partition of a key that holds most of the rows
    first = staged(keys.groupBy("key").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
                   .where("n > 1").select("key", "first"), "first-places")
    repeated = (keys.join(first, "key").groupBy("doc_id").agg(F.sort_array(F.collect_set("place")).alias("places")))
    placed = texts.repartition("doc_id")  # one exchange of the texts serves both look-ups
    bodies = staged(placed.join(repeated, "doc_id").mapInArrow(chunk_bodies(every, least), BODIES_DDL), "chunk-bodies")
    kept = (bodies.join(first, "key").where(F.struct("doc_id", "place") == F.col("first"))
            .select("key", "body").dropDuplicates(["key"]))
    gone = (bodies.alias("x").join(first, "key").where(F.struct("doc_id", "place") != F.col("first"))
            .join(kept.withColumnRenamed("body", "kept"), "key").where("body = kept")
            .groupBy("doc_id").agg(F.collect_set("place").alias("places")))
    return placed.join(gone, "doc_id", "left").mapInArrow(without_chunks(every, least), KEPT_DDL)
