"""BPE encoding and decoding by forced-boundary splitting.

Byte pairs that occur inside no vocabulary token can never be merged across, so
they mark certain cuts (``tokens.forced_cuts``). The fragments between cuts are
encoded independently, each distinct one once per slice, and their ids
concatenated. Decoding lays the tokens' bytes side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gather, text_buffers, text_slices
from .tokens import FragmentEncoder

# fixed values: what may be asked for, with Spark and Arrow types
COLUMNS = {"ids": ("array<int>", pa.list_(pa.int32())), "n_tokens": ("long", pa.int64()),
           "ids_sha256": ("string", pa.string()), "decoded": ("string", pa.string()),
           "decoded_sha256": ("string", pa.string())}


class Joined:
    """Byte strings by number, laid side by side for any sequence of numbers."""

    def __init__(self, parts: list[bytes]):
        self.body = np.frombuffer(b"".join(parts), np.uint8)
        self.size = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def lay(self, ids: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """For the numbers between each two offsets, their strings as one."""
        lengths = self.size[ids]
        out = self.body[gather(self.first[ids], lengths)]
        at = np.append(0, np.cumsum(lengths))[offs]
        return [out[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


def coder(spec, columns: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = FragmentEncoder(spec.value, words=False)
        texts = Joined(encoder.tokens)
        decimals = Joined([b"%d," % i for i in range(len(encoder.tokens))])
        for part in text_slices(batches):
            ids, offs = encoder.encode(*text_buffers(part.column("text")))
            out = [part.column("doc_id")]
            decoded = texts.lay(ids, offs) if any(c.startswith("decoded") for c in columns) else []
            for c in columns:
                if c == "ids":
                    values = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids.astype(np.int32)))
                elif c == "n_tokens":
                    values = np.diff(offs)
                elif c == "ids_sha256":
                    values = [hashlib.sha256(x[:-1]).hexdigest() for x in decimals.lay(ids, offs)]
                elif c == "decoded":
                    values = [x.decode(errors="replace") for x in decoded]
                else:
                    values = [hashlib.sha256(x.decode(errors="replace").encode()).hexdigest() for x in decoded]
                out.append(values if isinstance(values, pa.Array) else pa.array(values, COLUMNS[c][1]))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", *columns])
    return run


def encode(docs: DataFrame, tokenizer_path: str, columns: Sequence[str] = ("ids", "decoded"),
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text with the byte-level BPE in ``tokenizer_path`` and decode it again.

    ``columns``: any of ids, n_tokens, ids_sha256 (decimal ids joined by
    commas), decoded, decoded_sha256. A null text counts as empty and has no
    ids; strings of special tokens in a text become those tokens, as in the
    tokenizers library; an empty table gives no rows; other columns are ignored,
    repeated rows are encoded each. The vocabulary file (a few MB) is read on
    the driver and broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)[id_col]
    ddl = ", ".join([f"doc_id {kind}", *(f"{c} {COLUMNS[c][0]}" for c in columns)])
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(coder(spec, tuple(columns)), ddl))
