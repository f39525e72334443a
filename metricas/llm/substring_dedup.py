"""Substring deduplication on difference-cover anchors.

Positions p of a document whose p mod 7 is in {0, 1, 3} form a difference
cover: whatever two positions i and j are, some k < 7 puts i+k and j+k both on
the cover. So two equal runs of 13 words, wherever they start, share an aligned
7-word window at cover positions, the anchor (7 + 7 - 1 = 13). Only anchors are
hashed and grouped over the whole corpus; a 13-word window is examined only if
an anchor inside it also occurs in another document. Those windows, the anchors'
extensions to the full length, are grouped by a 96-bit hash to find the
smallest document holding each.

Copies never meet as pairs: of the documents in one slice of an input partition
that share an anchor or window, only the smallest asks in the anchor's or
window's bucket; the answers of the others are settled on the spot and go back
in rows dealt by slice, past that bucket. What many documents of a slice hold is
asked once in a task, so that a passage in a third of all documents gives its
bucket one entry for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, gather, text_buffers, text_bytes, text_slices
from .words import Words, inside, mix, ngrams

PERIOD, COVER = 7, (0, 1, 3)  # differences of the cover give every residue modulo the period
MANY = 8  # holders in a slice, from which on a task remembers an anchor or window for its later slices

POSTINGS = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("at", pa.binary()), ("hashes", pa.binary()),
                      ("more", pa.binary()), ("places", pa.binary()), ("settled", pa.bool_())])
POSTINGS_DDL = "bucket int, docs binary, at binary, hashes binary, more binary, places binary, settled boolean"
ANSWERS = pa.schema([("doc_id", pa.int64()), ("found", pa.binary())])
ANSWERS_DDL = "doc_id long, found binary"


def cover_anchors(w: Words, numbers: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors at cover positions of texts of at least ``window`` words: places (word numbers), hashes."""
    length = window - PERIOD + 1
    n = len(numbers)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rows = w.rows()[:n - length + 1]
    at = np.arange(n - length + 1) - w.offs[rows]
    ok = inside(w.offs, length, n) & np.isin(at % PERIOD, COVER) & (w.counts()[rows] >= window)
    places = np.flatnonzero(ok)
    return places, ngrams(numbers, length)[places]


def by_bucket(bucket: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices) of entries sorted by ``order``."""
    b = bucket[order]
    cuts = np.flatnonzero(np.diff(b)) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def bucket_of_slice(docs: np.ndarray, buckets: int) -> int:
    """Where a slice's settled answers go: any bucket, but the same one whenever the slice is made again."""
    return int(mix(docs[:1].view(np.uint64))[0] % np.uint64(buckets))


def runs_of_equal(*keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours in sorted keys, with the total at the end."""
    n = len(keys[0])
    differs = np.zeros(n, bool)
    if n:
        differs[0] = True
    for k in keys:
        differs[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(differs), n)


def planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number, byte by byte: what repeats lies together."""
    return np.ascontiguousarray(values.astype(values.dtype.newbyteorder("<"))
                                .view(np.uint8).reshape(len(values), -1)[:, :width].T).tobytes()


def unplanes(packed: bytes, width: int, kind: type) -> np.ndarray:
    flat = np.frombuffer(packed, np.uint8).reshape(width, -1)
    out = np.zeros((flat.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = flat.T
    return out.view(np.dtype(kind).newbyteorder("<")).reshape(-1).astype(kind)


# an anchor's lowest 40 bits go to its bucket; the bits above choose the bucket.
# A bucket holds about a million anchors, so few differ and agree in 40 bits,
# and those only cost the look at a window that turns out to be alone
ANCHOR_BYTES, ANCHOR_BITS = 5, np.uint64(40)
ANCHOR_MASK = np.uint64((1 << 40) - 1)


def anchor_postings(window: int, buckets: int):
    """(doc_id, text) -> postings of anchors, one row per slice and bucket, plus answers settled within the slice.

    ``more`` marks a posting whose anchor other documents of the slice hold too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, np.uint64)  # anchors that many documents of an earlier slice hold
        for part in text_slices(batches):
            docs = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            w = Words(*text_buffers(part.column("text")))
            places, hashes = cover_anchors(w, w.numbers(), window)
            if not len(places):
                continue
            row = w.rows()[places]
            order = np.lexsort((docs[row], hashes))
            h, d = hashes[order], docs[row][order]
            keep = runs_of_equal(h, d)[:-1]  # a document counts once for an anchor
            h, d = h[keep], d[keep]
            ends = runs_of_equal(h)
            first, size = ends[:-1], np.diff(ends)
            asks = ~np.isin(h[first], known, assume_unique=True)
            settled = np.ones(len(h), bool)
            settled[first[asks]] = False
            known = np.union1d(known, h[first[asks & (size >= MANY)]])
            out = []
            at, more = first[asks], size[asks] > 1
            of = ((h[at] >> ANCHOR_BITS) % np.uint64(buckets)).astype(np.int32)
            for b, i in by_bucket(of, np.lexsort((d[at], of))):
                ids, index = np.unique(d[at[i]], return_inverse=True)
                out.append((b, ids.tobytes(), planes(index.astype(np.uint16), 2), planes(h[at[i]], ANCHOR_BYTES),
                            np.packbits(more[i]).tobytes(), b"", False))
            if settled.any():
                ids, index = np.unique(d[settled], return_inverse=True)
                out.append((bucket_of_slice(docs, buckets), ids.tobytes(), planes(index.astype(np.uint16), 2),
                            planes(h[settled], ANCHOR_BYTES), b"", b"", True))
            yield pa.RecordBatch.from_pylist([dict(zip(POSTINGS.names, x)) for x in out], POSTINGS)
    return run


def unpack(group: pa.Table, width: int = 1) -> dict[str, np.ndarray]:
    """The postings of a bucket's rows, one after the other."""
    out = {k: [np.zeros(0, t)] for k, t in
           (("doc", np.int64), ("hash", np.uint64), ("more", bool), ("place", np.uint32), ("extra", np.uint32))}
    for r in group.to_pylist():
        at = unplanes(r["at"], 2, np.uint16)
        out["doc"].append(np.frombuffer(r["docs"], np.int64)[at])
        out["hash"].append(unplanes(r["hashes"], ANCHOR_BYTES, np.uint64) if width == 1
                           else np.frombuffer(r["hashes"], np.uint64))
        if width == 1:
            more = r["more"]
            out["more"].append(np.unpackbits(np.frombuffer(more, np.uint8), count=len(at)).astype(bool)
                               if more else np.zeros(len(at), bool))
        else:
            out["extra"].append(np.frombuffer(r["more"], np.uint32))
            out["place"].append(unplanes(r["places"], 4, np.uint32))
    return {k: np.concatenate(v) for k, v in out.items()}


def answers(doc: np.ndarray, found: np.ndarray, width: int) -> pa.Table:
    """One row per document with its findings, packed ``width`` bytes each."""
    order = np.argsort(doc, kind="stable")
    doc, found = doc[order], found[order]
    cuts = runs_of_equal(doc)
    return pa.table([pa.array(doc[cuts[:-1]], pa.int64()),
                     pa.array([planes(found[a:b], width) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    schema=ANSWERS)


def shared_anchors(group: pa.Table) -> pa.Table:
    """Postings of a bucket -> for each document the anchors that another document holds too."""
    settled = group.column("settled").to_numpy()
    done = unpack(group.filter(pa.array(settled)))
    p = unpack(group.filter(pa.array(~settled)))
    order = np.argsort(p["hash"], kind="stable")
    h, d, more = p["hash"][order], p["doc"][order], p["more"][order]
    ends = runs_of_equal(h)
    size = np.diff(ends)
    shared = np.repeat(size > 1, size) | more
    return answers(np.concatenate([d[shared], done["doc"]]), np.concatenate([h[shared], done["hash"]]), ANCHOR_BYTES)


def window_postings(window: int, buckets: int):
    """(doc_id, text, found: shared anchors) -> postings of the windows that hold a shared anchor."""
    length = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # windows that many documents of an earlier slice hold, with the smallest holder
        known, known_extra, known_doc = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for part in text_slices(batches):
            docs = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            w = Words(*text_buffers(part.column("text")))
            numbers = w.numbers()
            places, hashes = cover_anchors(w, numbers, window)
            if not len(places):
                continue
            # the anchors of a document that were found shared, matched within that document
            found = part.column("found").to_pylist()
            salt = (np.arange(len(docs), dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
            marks = [unplanes(x, ANCHOR_BYTES, np.uint64) ^ salt[i] for i, f in enumerate(found) for x in f or ()]
            if not marks:
                continue
            hit = places[np.isin((hashes & ANCHOR_MASK) ^ salt[w.rows()[places]], np.concatenate(marks))]
            # every window that covers such an anchor
            m = len(numbers) - window + 1
            cover = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(cover, np.maximum(hit - (window - length), 0), 1)
            np.add.at(cover, hit + 1, -1)
            start = np.flatnonzero((np.cumsum(cover)[:m] > 0) & inside(w.offs, window, len(numbers)))
            if not len(start):
                continue
            key = ngrams(numbers, window, 11)[start]
            extra = (ngrams(w.numbers(2), window, 13)[start] >> np.uint64(32)).astype(np.uint32)
            row = w.rows()[start]
            place = (start - w.offs[row]).astype(np.uint32)
            doc = docs[row]
            order = np.lexsort((doc, extra, key))
            ends = runs_of_equal(key[order], extra[order])
            first, size = order[ends[:-1]], np.diff(ends)
            least = doc[first]
            asks = np.ones(len(first), bool)
            if len(known):
                at = np.minimum(np.searchsorted(known, key[first]), len(known) - 1)
                same = known[at] == key[first]
                asks = ~(same & (known_extra[at] == extra[first]) & (known_doc[at] < least))
                new = ~same & (size >= MANY)
            else:
                new = size >= MANY
            mine = np.zeros(len(order), bool)
            # the slice's smallest holder asks; the others have their answer
            mine[order] = np.repeat(asks, size) & (np.repeat(least, size) == doc[order])
            if new.any():
                joined = np.concatenate([known, key[first[new]]])
                known, at = np.unique(joined, return_index=True)
                known_extra = np.concatenate([known_extra, extra[first[new]]])[at]
                known_doc = np.concatenate([known_doc, least[new]])[at]
            out = []
            at = np.flatnonzero(mine)
            of = (key[at] % np.uint64(buckets)).astype(np.int32)
            for b, i in by_bucket(of, np.lexsort((place[at], doc[at], of))):
                i = at[i]
                ids, index = np.unique(doc[i], return_inverse=True)
                out.append((b, ids.tobytes(), planes(index.astype(np.uint16), 2), key[i].tobytes(), extra[i].tobytes(),
                            planes(place[i], 4), False))
            if not mine.all():
                ids, index = np.unique(doc[~mine], return_inverse=True)
                out.append((bucket_of_slice(docs, buckets), ids.tobytes(), planes(index.astype(np.uint16), 2), b"", b"",
                            planes(place[~mine], 4), True))
            yield pa.RecordBatch.from_pylist([dict(zip(POSTINGS.names, x)) for x in out], POSTINGS)
    return run


def later_windows(group: pa.Table) -> pa.Table:
    """Postings of a bucket -> for each document the places of windows that a smaller document holds."""
    settled = group.column("settled").to_numpy()
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for r in group.filter(pa.array(settled)).to_pylist():
        docs.append(np.frombuffer(r["docs"], np.int64)[unplanes(r["at"], 2, np.uint16)])
        places.append(unplanes(r["places"], 4, np.uint32))
    p = unpack(group.filter(pa.array(~settled)), 2)
    order = np.lexsort((p["doc"], p["extra"], p["hash"]))
    h, x, d, place = (p[k][order] for k in ("hash", "extra", "doc", "place"))
    ends = runs_of_equal(h, x)
    later = d != np.repeat(d[ends[:-1]], np.diff(ends))
    return answers(np.concatenate([*docs, d[later]]), np.concatenate([*places, place[later]]), 4)


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
KEPT_DDL = "doc_id long, n_words long, n_removed long, kept string"


def remove_windows(window: int):
    """(doc_id, text, found: places of windows) -> the words outside those windows, joined by a space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            data, offs = text_buffers(part.column("text"))
            w = Words(data, offs)
            n = len(w.starts)
            cover = np.zeros(n + 1, np.int64)
            for i, f in enumerate(part.column("found").to_pylist()):
                for x in f or ():
                    at = unplanes(x, 4, np.uint32).astype(np.int64) + w.offs[i]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover)[:n] > 0
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(w.offs[:-1], n))
            removed[w.counts() == 0] = 0
            keep = np.flatnonzero(~gone)
            # words and a following space each, as one buffer
            size = w.ends[keep] - w.starts[keep] + 1
            out = np.append(data, np.uint8(0x20))[np.minimum(gather(w.starts[keep], size), len(data))]
            out[np.cumsum(size) - 1] = 0x20
            per = np.append(0, np.cumsum(size))[np.searchsorted(keep, w.offs)]
            texts = [out[a:max(a, b - 1)].tobytes().decode() for a, b in zip(per[:-1], per[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(w.counts().astype(np.int64)), pa.array(removed),
                 pa.array(texts, pa.string())], schema=KEPT)
    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """Remove each word covered by a ``window``-word run that also starts in a document with a smaller id.

    Words are runs of characters other than space, tab, line feed, vertical tab,
    form feed and carriage return, compared unchanged. Windows are judged on the
    input. A null or empty text has no words; a text shorter than the window
    loses none; runs repeated only within one document stay; an empty table
    gives no rows; other columns are ignored. Ids are unique and not null (rows
    without id are left out, since order by id decides what stays).

    Returns doc_id, n_words, n_removed, kept (the remaining words joined by one
    space).
    """
    if window < 2 * PERIOD - 1:
        raise ValueError(f"window must be at least {2 * PERIOD - 1} words")
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .where("doc_id is not null"))
    buckets = bucket_count(text_bytes(texts))
    placed = texts.repartition("doc_id")  # one exchange of the texts serves both look-ups

    def per_document(found: DataFrame) -> DataFrame:
        return found.groupBy("doc_id").agg(F.collect_list("found").alias("found"))

    # a task that runs again must make the same slices, since their answers go to several buckets: rows in order of id
    anchors = (texts.sortWithinPartitions("doc_id").mapInArrow(anchor_postings(window, buckets), POSTINGS_DDL)
               .groupBy("bucket").applyInArrow(shared_anchors, ANSWERS_DDL))
    windows = (placed.join(per_document(anchors), "doc_id").sortWithinPartitions("doc_id")
               .mapInArrow(window_postings(window, buckets), POSTINGS_DDL)
               .groupBy("bucket").applyInArrow(later_windows, ANSWERS_DDL))
    return (placed.join(per_document(windows), "doc_id", "left")
            .mapInArrow(remove_windows(window), KEPT_DDL))


def sha256_text(column):
    return F.sha2(F.col(column).cast("binary"), 256)


def digest_rows(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", sha256_text("kept").alias("kept_sha256"))


