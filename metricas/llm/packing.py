"""Vector best-fit packing of token pieces into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared piece lengths). Pieces go, longest first, to the open sequence that
fits best under every constraint: the smallest weighted norm of what would be
left (``norm``), or the smallest weighted dot product of the piece's needs and
the sequence's residuals (``dot``); a new sequence opens when none fits.

Pieces are dealt at random into groups of bounded size and each group is packed
by one task. A group of tens of thousands of pieces fills its sequences almost
completely, so the loss is about one part-filled sequence per group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_buffers, text_slices
from .tokens import FragmentEncoder

GROUP_PIECES = 20_000


def pack(lengths: np.ndarray, capacities: Sequence[float], weights: Sequence[float],
         rule: str = "norm") -> np.ndarray:
    """The sequence number of each piece."""
    capacities = np.array(capacities, float)
    weights = np.array(weights, float)
    needs = np.stack([lengths.astype(float), np.ones(len(lengths)), lengths.astype(float) ** 2])
    if len(lengths) and (needs.max(axis=1) > capacities).any():
        raise ValueError("a piece alone exceeds a capacity")
    order = np.argsort(-lengths, kind="stable")
    least = needs.min(axis=1, initial=np.inf)
    out = np.empty(len(lengths), np.int64)
    room = np.empty((3, len(lengths)))  # of the open sequences
    number = np.empty(len(lengths), np.int64)
    n_open = made = 0
    scale = weights / capacities ** 2
    for step, i in enumerate(order):
        need = needs[:, i]
        best = -1
        if n_open:
            after = room[:, :n_open] - need[:, None]
            fits = (after >= 0).all(axis=0)
            if rule == "norm":
                score = scale @ (after * after)
            else:
                score = (scale * need) @ room[:, :n_open]
            score[~fits] = np.inf
            best = int(np.argmin(score))
            if not fits[best]:
                best = -1
        if best < 0:
            best = n_open
            room[:, best] = capacities
            number[best] = made
            n_open += 1
            made += 1
        room[:, best] -= need
        out[i] = number[best]
        if (room[:, best] < least).any():  # nothing fits any more: the last open one takes its place
            n_open -= 1
            room[:, best], number[best] = room[:, n_open], number[n_open]
    return out


PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])


def piece_cutter(spec, max_tokens: int, end_id: int, with_ids: bool):
    schema = PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = FragmentEncoder(spec.value, words=True)
        for part in text_slices(batches):
            ids, offs = encoder.encode(*text_buffers(part.column("text")))
            rows, values = [], []
            for doc, a, b in zip(part.column("doc_id").to_pylist(), offs[:-1], offs[1:]):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), max_tokens)):
                    cut = own[start:start + max_tokens]
                    rows.append((doc, piece, start, len(cut), zlib.crc32(cut.tobytes())))
                    if with_ids:
                        values.append(cut.astype(np.int32))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), PIECES.types)]
            if with_ids:
                columns.append(pa.array(values, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text: its ids, then ``end_id``, cut after every ``max_tokens`` ids.

    A null or empty text is one piece of ``end_id`` alone. Repeated rows give
    their pieces each; an empty table gives none; other columns are ignored.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(piece_cutter(spec, max_tokens, end_id, with_ids),
                        PIECES_DDL + (", ids array<int>" if with_ids else "")))


def best_fit(rows: DataFrame, max_tokens: int = 4096, max_docs: int | None = None, max_cost: float | None = None,
             weights: Sequence[float] = (1.0, 1e-3, 1e-3), rule: str = "norm",
             group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...) of at most ``max_tokens`` tokens.

    ``max_docs`` and ``max_cost`` bound the pieces and the summed squared
    lengths of a sequence; None leaves that to the token capacity (a sequence
    of n tokens holds at most n pieces and costs at most n squared). ``rows``
    is read twice: once to count, once to deal.
    """
    capacities = (max_tokens, max_docs or max_tokens, max_cost or float(max_tokens) ** 2)
    groups = max(1, -(-rows.count() // group_pieces))
    names = rows.columns

    def run(group: pa.Table) -> pa.Table:
        table = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        length = table.column("length").to_numpy()
        at = pack(length, capacities, weights, rule)
        order = np.argsort(at, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        new = np.ones(len(order), bool)
        new[1:] = at[order][1:] != at[order][:-1]
        offset = np.empty(len(order), np.int64)
        offset[order] = before - np.repeat(before[new], np.diff(np.append(np.flatnonzero(new), len(order))))
        first = table.column("pack_group")[0].as_py() if len(table) else 0
        return (table.select(names).append_column("sequence_id", pa.array(at * groups + first))
                .append_column("offset", pa.array(offset)))

    ddl = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return (rows.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("long"))
            .groupBy("pack_group").applyInArrow(run, f"{ddl}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1,
                   with_ids: bool = False, **options) -> DataFrame:
    """Tokenise, cut and pack whole documents (``pieces``, ``best_fit``)."""
    return best_fit(staged(pieces(docs, tokenizer_path, max_tokens, end_id, with_ids), "pieces"), max_tokens, **options)
