"""Phrase collocation mining by prefix-free parsing.

A text is parsed into overlapping chunks of words: a chunk ends with the window of words whose hash is a
trigger, and the next one begins with that same window, so what a chunk holds depends on its words alone and
repeated passages give the same chunks wherever they stand. The distinct chunks are the dictionary, each with
its frequency in the parse; n-grams are counted inside the dictionary only, weighted by that frequency. The
overlap is one word shorter than the longest phrase, and an n-gram belongs to the chunk whose words before the
overlap it begins in, so that each occurrence counts once.

Most n-grams are rare. A first pass over the dictionary counts hashed word pairs, of which the frequent ones
set bits of a filter of bounded size; the second pass counts phrases by their words, leaving out those with a
pair that the filter shows to be rare. A false positive of the filter costs a row and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gather, staged, text_buffers, text_slices
from .words import LOWER, RADIX, RADIX_INVERSE, Words, constants, mix, powers

TRIGGER = 16  # words of a chunk before its overlap, on average
MOST_BITS = 27  # of the filter, as a power of two: 16 MB
BITS_EACH = 16  # of the filter for each frequent pair, while it has room
BLOCK_BITS = 16  # of the filter that one row holds
SLICE_BYTES = 4 << 20  # of the dictionary that a task counts phrases in at once
UNKNOWN = "und"
U = np.uint64

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
SPACED = np.where(BREAK, 0x20, LOWER).astype(np.uint8)  # as text of words only


FACTORS: dict[int, np.ndarray] = {}


def factors(base: int, n: int) -> np.ndarray:
    if base not in FACTORS or len(FACTORS[base]) < n:
        FACTORS[base] = powers(base, (n >> 20) + 1 << 20)
    return FACTORS[base]


def numbers_of(words: Words, seed: int) -> np.ndarray:
    """As ``words.numbers(seed)``; the powers, the same for every batch, are made once in a task."""
    n = len(words.data)
    sums = np.zeros(n + 1, U)
    np.cumsum(constants(256, seed)[words.data] * factors(RADIX, n)[:n], out=sums[1:])
    raw = (sums[words.ends] - sums[words.starts]) * factors(RADIX_INVERSE, n)[words.starts]
    return mix(raw + (words.ends - words.starts).astype(U) * U(RADIX))


def stream(data: np.ndarray, offs: np.ndarray, overlap: int) -> tuple[np.ndarray, ...]:
    """The texts as one stream of tokens: words, a break between pieces, ``overlap`` breaks at a text's end.

    Returns each token's first byte and end (a break has none of its own), its number (0 for a break), and the
    token that each text begins with.
    """
    words = Words(SPACED[data], offs)
    rows = words.rows()
    breaks = np.concatenate([[0], np.cumsum(BREAK[data])])
    apart = np.zeros(len(words.starts), bool)  # a break comes before the word, in its text
    if len(apart):
        apart[1:] = (rows[1:] == rows[:-1]) & (breaks[words.starts[1:]] > breaks[words.ends[:-1]])
    place = np.arange(len(rows)) + np.cumsum(apart) + overlap * rows
    n = len(rows) + int(apart.sum()) + overlap * (len(offs) - 1)
    starts, ends, number = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, U)
    starts[place], ends[place], number[place] = words.starts, words.ends, numbers_of(words, 13)
    tokens = words.counts() + np.bincount(rows[apart], minlength=len(offs) - 1) + overlap
    return starts, ends, number, np.cumsum(tokens) - tokens


def window_hash(number: np.ndarray, width: int) -> np.ndarray:
    """A number for the ``width`` tokens that begin at each place, the last ones lacking."""
    total = np.zeros(max(0, len(number) - width + 1), U)
    for k, c in enumerate(constants(width, 17)):
        total += mix(number[k:k + len(total)] + c) * c
    return mix(total)


def chunks_of(data: np.ndarray, offs: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of chunks in them, text of each chunk): a chunk is its tokens joined by a space, a break
    being a line feed."""
    starts, ends, number, first = stream(data, offs, overlap)
    close = np.append(first[1:], len(number)) - overlap  # the first of a text's closing breaks
    cut = np.zeros(len(number) + 1, bool)
    hashed = window_hash(number, overlap)
    cut[:len(hashed)] = hashed % U(TRIGGER) == 0
    for k in range(overlap):
        cut[close + k] = False  # a window that begins in the closing breaks is no trigger
    own = first < close
    cut[first[own]] = True
    begin = np.flatnonzero(cut[:-1])
    text = np.searchsorted(first, begin, "right") - 1
    end = np.append(begin[1:], len(number))
    end = np.minimum(end, close[text]) + overlap
    # the stream's bytes: every token and a space after it
    size = np.where(number == 0, 1, ends - starts) + 1
    after = np.cumsum(size)
    flat = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    word = np.flatnonzero(number != 0)
    lengths = ends[word] - starts[word]
    flat[gather(after[word] - size[word], lengths)] = LOWER[data[gather(starts[word], lengths)]]
    flat[(after - size)[number == 0]] = 0x0A
    left, right = (after - size)[begin], after[end - 1] - 1
    return flat[gather(left, right - left)], np.concatenate([[0], np.cumsum(right - left)]), text


def strings(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(offs.astype(np.int64).tobytes()),
                                            pa.py_buffer(data.tobytes()))


def parse(docs: DataFrame, text_col: str, lang_col: str, overlap: int) -> DataFrame:
    """The dictionary: (lang, chunk, n), n being how often the chunk occurs in the parse of the language's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            data, offs, text = chunks_of(*text_buffers(b.column("text")), overlap)
            table = pa.table({"lang": b.column("lang").cast(pa.large_string()).take(pa.array(text)),
                              "chunk": strings(data, offs)})
            counted = table.group_by(["lang", "chunk"]).aggregate([([], "count_all")]).combine_chunks()
            for part in counted.rename_columns(["lang", "chunk", "n"]).cast(
                    pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("n", pa.int64())])).to_batches():
                yield part
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    return staged(rows.mapInArrow(run, "lang string, chunk string, n long")
                  .groupBy("lang", "chunk").agg(F.sum("n").alias("n")), "parse")


class Chunks:
    """The tokens of some chunks: bytes, first byte and end of each, its number with its language's (0: a break)."""

    def __init__(self, batch: pa.RecordBatch, overlap: int):
        self.data, offs = text_buffers(batch.column("chunk"))
        blank = self.data == 0x20
        at = np.flatnonzero(blank)
        cut = np.concatenate([at, offs[1:]])
        cut.sort()
        self.ends = cut
        self.starts = np.concatenate([[0], cut[:-1] + blank[np.minimum(cut[:-1], len(blank) - 1)]])[:len(cut)]
        tokens = np.diff(np.searchsorted(cut, offs[1:], "right"), prepend=0)
        self.row = np.repeat(np.arange(len(tokens)), tokens)
        ahead = np.cumsum(tokens)[self.row] - np.arange(len(cut))  # tokens of the chunk from here on
        self.broken = self.data[self.starts] == 0x0A
        self.owned = ahead > overlap
        words = Words(np.where(self.data == 0x0A, 0x21, self.data).astype(np.uint8), offs)  # a break is a word here
        langs, lang = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        own = Words(*text_buffers(pa.array([f"{x}" for x in langs.tolist()])))
        salt = np.array([np.bitwise_xor.reduce(n) if len(n) else U(0) for n in
                         np.split(own.numbers(seed=19), own.offs[1:-1])], U)
        self.number = mix(numbers_of(words, 23) + mix(salt)[lang][self.row])
        self.lang = lang
        self.times = batch.column("n").to_numpy()

    def pairs(self) -> np.ndarray:
        """A number for each token and the next one."""
        c = constants(2, 29)
        return mix(self.number[:-1] * c[0] + self.number[1:] * c[1])

    def starts_of(self, n: int) -> np.ndarray:
        """Tokens that begin an n-gram of this chunk: n words of one piece that are not the next chunk's."""
        at = np.flatnonzero(self.owned[:len(self.owned) - n + 1])
        for k in range(n):
            at = at[~self.broken[at + k]]
        return at


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``limit`` bytes, made of the given ones."""
    held, size = [], 0

    def joined() -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield from joined()
            held, size = [], 0
    if held:
        yield from joined()


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def bits_of(keys: np.ndarray, power: int) -> np.ndarray:
    """Two places of the filter for each number, side by side."""
    mask = U((1 << power) - 1)
    return np.stack([keys & mask, (keys >> U(32)) & mask], 1).astype(np.int64)


def frequent_pairs(chunks: DataFrame, least: int, overlap: int) -> bytes:
    """The filter of word pairs that occur ``least`` times: no frequent pair's bits are clear."""
    spark = chunks.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, SLICE_BYTES):
            own = Chunks(b, overlap)
            at = own.starts_of(2)
            keys, times = summed(own.pairs()[at], own.times[own.row[at]])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], names=["pair", "n"])
    pairs = staged(chunks.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= least).select("pair"), "frequent-pairs")
    power = min(MOST_BITS, max(BLOCK_BITS, int(pairs.count() * BITS_EACH).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(bits_of(b.column("pair").to_numpy().view(U), power))
            yield pa.RecordBatch.from_arrays([pa.array((at >> BLOCK_BITS).astype(np.int32)),
                                              pa.array((at & ((1 << BLOCK_BITS) - 1)).astype(np.int32))],
                                             names=["block", "place"])

    def block(key: tuple, rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << BLOCK_BITS, bool)
        bits[rows.column("place").to_numpy()] = True
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                        names=["block", "bits"])
    size = 1 << BLOCK_BITS >> 3
    out = bytearray(1 << power >> 3)
    for r in (pairs.mapInArrow(places, "block int, place int").distinct()  # at most all places of a block
              .groupBy("block").applyInArrow(block, "block int, bits binary").collect()):  # 1 << power bits at most
        out[r["block"] * size:(r["block"] + 1) * size] = r["bits"]
    return bytes(out)


def phrase_counts(chunks: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, size, n): all words, and all longer phrases that occur ``least`` times."""
    overlap = longest - 1
    shared = chunks.sparkSession.sparkContext.broadcast(frequent_pairs(chunks, least, overlap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        power = len(bits).bit_length() + 2
        for b in gathered(batches, SLICE_BYTES):
            own = Chunks(b, overlap)
            langs = b.column("lang").to_pylist()
            pair = own.pairs()
            key = own.number
            place = bits_of(pair, power)
            common = ((bits[place >> 3] >> (7 - (place & 7))) & 1).all(1)
            for n in range(1, longest + 1):
                at = own.starts_of(n)
                if n > 1:
                    key = mix(key[:-1] * constants(2, 31)[0] + own.number[n - 1:])
                    for k in range(n - 1):
                        at = at[common[at + k]]
                order = at[np.argsort(key[at])]
                if not len(order):
                    continue
                first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
                times = np.add.reduceat(own.times[own.row[order]], first)
                some = order[first]  # one occurrence of each phrase stands for it
                left, length = own.starts[some], own.ends[some + n - 1] - own.starts[some]
                text = strings(own.data[gather(left, length)], np.concatenate([[0], np.cumsum(length)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[r] for r in own.row[some].tolist()], pa.string()), text.cast(pa.string()),
                     pa.array(np.full(len(some), n, np.int32)), pa.array(times)], names=["lang", "phrase", "size", "n"])

    counts = (chunks.mapInArrow(run, "lang string, phrase string, size int, n long")
              .groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")))
    return staged(counts.where((F.col("size") == 1) | (F.col("n") >= least)), "phrases")


def mine(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, top: int = 2000,
         text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The collocations of each language: phrases of 2 to ``longest`` words that occur ``least`` times or more.

    A-Z count as a-z. Texts fall into pieces at ``.,;:!?``, line feeds, vertical tabs, form feeds and carriage
    returns, pieces into words at spaces and tabs; phrases lie within pieces and may overlap. A null language is
    ``und``; null and empty texts, and texts without words, add nothing; rows count as often as they occur, of
    whatever id. A phrase's score is floor(10^6 a^2 / (l r)) at the cut into two parts where that is least (the
    earliest of equal ones): a, l and r are the occurrences of the phrase, the first and the second part. Phrases
    that lie inside a longer one that occurs ``inside`` percent as often or more are left out. Ties in rank go
    by occurrences, then phrase in the order of its bytes. No row comes of an empty table; other columns are
    ignored. Counts up to 10^15 are exact.

    Returns lang, rank, phrase, a, l, r, n (all words of the language) and score, the first ``top`` of each language.
    """
    counts = phrase_counts(parse(docs, text_col, lang_col, longest - 1), longest, least)
    f = counts.select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ").alias("tail"))
    cuts = (cuts.join(f.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
            .join(f.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"]))
    wide = {c: f"cast({c} as decimal(15,0))" for c in "alr"}
    cuts = cuts.withColumn("score", F.expr(f"cast(1000000 as decimal(7,0)) * ({wide['a']} * {wide['a']}) "
                                           f"div ({wide['l']} * {wide['r']})"))
    scored = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
              .select("lang", "phrase", "cut.*"))
    # every shorter phrase inside a longer one, with the most frequent such one
    shorter = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
                     "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")
    around = (found.where("size > 2").select("lang", F.col("a").alias("longer"), F.explode(shorter).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (scored.join(around, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))))
    totals = counts.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", F.col("score").cast("long").alias("score"))
