"""Language-model scoring with Brown class-based bigrams.

Every word belongs to a class, and a token's probability is that of its class after the class of the token
before it, times that of the word within its class. Classes come from exchange clustering: a unit moves to the
class that raises the likelihood of the training text's class bigrams most. The units are the VOCABULARY most
frequent training words, each by itself, and the remaining words in groups by their last three bytes, so that
a word never seen in training has a class too. Everything whose size is bounded by the units or the classes
(their bigram counts, the class of each) may be broadcast; the counts of single words, which grow with the
corpus, are a table that documents are joined with.

Texts are tokenised once into slices: a row holds the distinct words of some documents, the frequent ones first,
and each token's place among them, and later steps read these rows. They are some megabytes each, so places and
endings are compressed, and a row group of the table holds one row: what a task holds at once doesn't depend on
how much text it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_buffers, text_slices
from .words import LOWER, Words

VOCABULARY = 8192  # words that are clustered by themselves
ENDINGS = 2048  # groups of the others
CLASSES = 64  # class 0 holds the end of a text and nothing else
ROUNDS = 10  # of exchange at most; a round may move half of the units
ADDED = 0.5  # to every count
SLICE_BYTES = 8 << 20  # text of a slice, about
PAIRS = 1 << 20  # bigrams that a task counts before it sends them on, about
UNIT_ROWS = 128  # units read at once, each with all units that follow and precede it

END = 0  # the end token: its word number, its unit and its class
U = np.uint64
I64 = pa.int64()

TOKENS_DDL = ("slice long, doc_id array<long>, held_out array<boolean>, n_tokens array<long>, "
              "words binary, endings binary, codes binary")
TOKENS = pa.schema([("slice", I64), ("doc_id", pa.list_(I64)), ("held_out", pa.list_(pa.bool_())),
                    ("n_tokens", pa.list_(I64)), ("words", pa.binary()), ("endings", pa.binary()),
                    ("codes", pa.binary())])


def packed(numbers: np.ndarray) -> bytes:
    """The numbers' lowest bytes, then the next ones and so on, compressed."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize)
    return pa.compress(planes.T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    """``n`` numbers from ``packed``."""
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


def tokens_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, ending) of each token, every text closed by an end token, and tokens per text."""
    data, offs = text_buffers(batch.column("text"))
    words = Words(data, offs)
    numbers = words.numbers(seed=11, lower=True)
    low = LOWER[data].astype(np.int64)
    ending = np.zeros(len(numbers), np.int64)
    for back in (3, 2, 1):
        at = words.ends - back
        ending = ending * 256 + np.where(at >= words.starts, low[np.maximum(at, 0)], 0)
    ending = ending * 2654435761 % (1 << 32) % ENDINGS
    n = words.counts()
    last = np.cumsum(n + 1) - 1
    place = np.arange(len(numbers)) + words.rows()  # one end token for each text before
    number, end = np.full(len(numbers) + len(n), END, U), np.zeros(len(numbers) + len(n), np.int16)
    number[place], end[place] = numbers, ending
    number[last] = END
    return number, end, n + 1


def slice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text) -> slices."""
    part, made, parts, size = TaskContext.get().partitionId(), 0, [], 0

    def close() -> pa.RecordBatch:
        number = np.concatenate([p[0] for p in parts])
        words, first, codes, times = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # small places for frequent words compress well
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        endings = np.concatenate([p[1] for p in parts])[first[order]]
        lists = [pa.array([[v for p in parts for v in p[k]]], TOKENS.field(f).type)
                 for k, f in ((2, "doc_id"), (3, "held_out"), (4, "n_tokens"))]
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + made], I64), *lists,
             *[pa.array([x], pa.binary()) for x in (words[order].tobytes(), packed(endings), packed(place[codes]))]],
            schema=TOKENS)
    for b in text_slices(batches):
        number, ending, n = tokens_of(b)
        parts.append((number, ending, b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), n.tolist()))
        size += b.column("text").nbytes
        if size >= SLICE_BYTES:
            yield close()
            made, parts, size = made + 1, [], 0
    if parts:
        yield close()


def tokenise(docs: DataFrame, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return staged(rows.mapInArrow(slice_rows, TOKENS_DDL), "lm-tokens", rows_at_once=1)


def arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A slice's words, endings, codes and tokens per text."""
    words, n = np.frombuffer(row["words"], U), np.array(row["n_tokens"], np.int64)
    return words, unpacked(row["endings"], len(words), np.int16), unpacked(row["codes"], int(n.sum()), np.int32), n


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def training(row: dict, n: np.ndarray) -> np.ndarray:
    """Which tokens are training tokens."""
    return np.repeat(~np.array(row["held_out"], bool), n)


def count_words(tokens: DataFrame) -> DataFrame:
    """(word, ending, n) over all training tokens; the end token is word 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches):
            words, endings, codes, n = arrays(row)
            times = np.bincount(codes[training(row, n)], minlength=len(words))
            some = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays([pa.array(words[some].view(np.int64)), pa.array(endings[some]),
                                              pa.array(times[some], I64)], names=["word", "ending", "n"])
    return staged(tokens.mapInArrow(run, "word long, ending short, n long")
                  .groupBy("word").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")), "lm-words")


# ---- units and classes ----

class Units:
    """The unit of each word: 0 the end, then the frequent words, then the endings."""

    def __init__(self, frequent: list[int]):
        self.frequent = frequent
        words = np.array(frequent, np.int64).view(U)
        self.order = np.argsort(words)
        self.words = words[self.order]
        self.count = 1 + len(words) + ENDINGS

    def of(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        unit = 1 + len(self.words) + endings.astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            unit = np.where(self.words[at] == words, 1 + self.order[at], unit)
        return np.where(words == END, END, unit)


def unit_bigrams(tokens: DataFrame, units: Units) -> DataFrame:
    """(unit, outs, ins): how often which units follow and precede each unit in the training texts.

    At most units squared pairs in all, and twice the units in a row.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(units.frequent)  # plain values: executors have no copy of the package

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, held = Units(shared.value), []

        def counted() -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in held])).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            keys, n = counted()
            for at in range(0, len(keys), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + (1 << 18)]), pa.array(n[at:at + (1 << 18)])],
                                                 names=["pair", "n"])
        for row in slices(batches):
            words, endings, codes, n = arrays(row)
            unit = units.of(words, endings)[codes]
            before = np.concatenate([[END], unit[:-1]])  # a text's first token comes after the end of the one before
            keys, times = np.unique((before * units.count + unit)[training(row, n)], return_counts=True)
            held.append((keys, times))
            if sum(len(k) for k, _ in held) > 2 * PAIRS:
                held = [counted()]
                if len(held[0][0]) > PAIRS:
                    yield from out()
                    held = []
        if held:
            yield from out()

    n = units.count
    pairs = tokens.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = pairs.select(F.expr(f"int(pair div {n})").alias("a"), F.expr(f"int(pair % {n})").alias("b"), "n")
    both = staged(pairs, "lm-pairs").select(F.explode(F.array(
        F.struct(F.col("a").alias("unit"), F.lit(True).alias("out"), F.col("b").alias("other"), "n"),
        F.struct(F.col("b").alias("unit"), F.lit(False).alias("out"), F.col("a").alias("other"), "n"))).alias("x"))
    one = F.struct("x.other", "x.n")
    return staged(both.groupBy("x.unit").agg(F.collect_list(F.when(F.col("x.out"), one)).alias("outs"),
                                             F.collect_list(F.when(~F.col("x.out"), one)).alias("ins")),
                  "lm-units", rows_at_once=UNIT_ROWS)


def neighbours(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    flat = column.slice(k, 1).flatten()
    return tuple(flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(counts: np.ndarray) -> float:
    """The part of the log-likelihood of class bigrams that depends on the classes."""
    return float(xlogx(counts).sum() - xlogx(counts.sum(0)).sum() - xlogx(counts.sum(1)).sum())


def best_class(counts: np.ndarray, own: int, outs: np.ndarray, ins: np.ndarray, itself: float) -> int:
    """The class that a unit of class ``own`` should be in, all others staying where they are.

    ``outs`` and ``ins``: how often each class follows and precedes the unit, the unit itself apart.
    """
    rest = counts.copy()
    rest[own] -= outs
    rest[:, own] -= ins
    rest[own, own] -= itself
    rows, columns = rest.sum(1) + ins, rest.sum(0) + outs  # whichever class the unit joins
    every = np.arange(len(rest))
    gain_out = xlogx(rest + outs) - xlogx(rest)  # by class that the unit would join, and class that follows
    gain_in = (xlogx(rest + ins[:, None]) - xlogx(rest)).T
    diagonal = rest[every, every]
    gain = (gain_out.sum(1) - gain_out[every, every] + gain_in.sum(1) - gain_in[every, every]
            + xlogx(diagonal + outs + ins + itself) - xlogx(diagonal)
            - xlogx(rows + outs.sum() + itself) + xlogx(rows) - xlogx(columns + ins.sum() + itself) + xlogx(columns))
    gain[END] = -np.inf
    best = int(gain.argmax())
    return best if gain[best] > gain[own] + 1e-9 * abs(gain[own]) else own


def class_counts(bigrams: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    shared = bigrams.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            for i, unit in enumerate(b.column("unit").to_pylist()):
                other, n = neighbours(b.column("outs"), i)
                total[shared.value[unit]] += np.bincount(shared.value[other], n, k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at].astype(np.int64))], names=["at", "n"])
    counts = np.zeros(k * k)
    for r in bigrams.select("unit", "outs").mapInArrow(run, "at long, n long").groupBy("at").agg(
            F.sum("n").alias("n")).collect():  # k * k rows at most
        counts[r["at"]] = r["n"]
    return counts.reshape(k, k)


def exchange(bigrams: DataFrame, units: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit and the class bigram counts.

    A round looks at half of the units, each against the counts that the round began with. Moves of one round
    may undo one another, so a round that doesn't raise the likelihood is dropped; two such end the search.
    """
    spark = bigrams.sparkSession
    own = 1 + np.arange(units) % (classes - 1)
    own[END] = END
    counts = class_counts(bigrams, own, classes)
    stale = 0
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((own, counts, turn))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, counts, turn = shared.value
            for b in batches:
                moved = [], []
                for i, unit in enumerate(b.column("unit").to_pylist()):
                    if unit == END or (unit * 2654435761 >> 16) % 2 != turn % 2:
                        continue
                    sides = []
                    for name in ("outs", "ins"):
                        other, n = neighbours(b.column(name), i)
                        itself = float(n[other == unit].sum())
                        sides.append(np.bincount(own[other], np.where(other == unit, 0, n), len(counts)))
                    to = best_class(counts, int(own[unit]), *sides, itself)
                    if to != own[unit]:
                        moved[0].append(unit)
                        moved[1].append(to)
                yield pa.RecordBatch.from_arrays([pa.array(moved[0], pa.int32()), pa.array(moved[1], pa.int32())],
                                                 names=["unit", "class"])
        moves = bigrams.mapInArrow(run, "unit int, class int").collect()  # as many rows as units at most
        tried = own.copy()
        for r in moves:
            tried[r["unit"]] = r["class"]
        now = class_counts(bigrams, tried, classes) if moves else counts
        if moves and likelihood(now) > likelihood(counts):
            own, counts, stale = tried, now, 0
        else:
            stale += 1
            if stale == 2:
                break
    return own, counts


# ---- the model ----

@dataclass
class Model:
    """Sizes are bounded by the units and the classes; the words' own counts are ``words``, a table."""
    units: Units
    classes: np.ndarray  # of each unit
    transitions: np.ndarray  # log10 of P(class | class before)
    mass: np.ndarray  # of each class: its smoothed number of training tokens
    tokens: int  # N
    distinct: int  # V
    words: DataFrame


def train(tokens: DataFrame) -> Model:
    words = count_words(tokens)
    own = words.where(F.col("word") != END)
    units = Units([r["word"] for r in own.orderBy(F.desc("n"), "word").select("word").limit(VOCABULARY).collect()])
    bigrams = unit_bigrams(tokens, units)
    classes, counts = exchange(bigrams, units.count)
    # tokens and types of each unit: the frequent words by themselves, the others by ending
    shared = tokens.sparkSession.sparkContext.broadcast((units.frequent, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, classes = Units(shared.value[0]), shared.value[1]
        for b in batches:
            word, ending, n = (b.column(c).to_numpy() for c in ("word", "ending", "n"))
            klass = classes[units.of(word.view(U), ending)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(CLASSES), I64), pa.array(np.bincount(klass, n, CLASSES).astype(np.int64)),
                 pa.array(np.bincount(klass, minlength=CLASSES).astype(np.int64))], names=["class", "n", "types"])
    size, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in words.mapInArrow(run, "class long, n long, types long").groupBy("class").agg(
            F.sum("n").alias("n"), F.sum("types").alias("types")).collect():  # CLASSES rows
        size[r["class"]], types[r["class"]] = r["n"], r["types"]
    # Witten-Bell: a class that many classes follow gives more to those not seen after it
    follow = (counts > 0).sum(1, keepdims=True)
    alone = (size + ADDED) / (size.sum() + ADDED * CLASSES)
    transitions = np.where(follow > 0, (counts + follow * alone) / np.maximum(counts.sum(1, keepdims=True) + follow, 1), alone)
    return Model(units, classes, np.log10(transitions), size + ADDED * (types + 1), int(size.sum()), int(types.sum()), words)


SCORES_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")


def score(tokens: DataFrame, model: Model) -> DataFrame:
    """One row for each text of ``tokens``: its words' counts come from a join by word, once for each slice."""
    spark = tokens.sparkSession
    light = (model.units.frequent, model.classes, model.transitions, model.mass, model.tokens, model.distinct)
    shared = spark.sparkContext.broadcast(light)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches):
            words = np.frombuffer(row["words"], U).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), row["slice"])),
                                              pa.array(np.arange(len(words), dtype=np.int32)), pa.array(words)],
                                             names=["slice", "place", "word"])

    def run(key: tuple, texts: pa.Table, known: pa.Table) -> pa.Table:
        frequent, classes, transitions, mass, total, distinct = shared.value
        row = texts.to_pylist()[0]
        words, endings, codes, n = arrays(row)
        times = np.zeros(len(words))
        times[known.column("place").to_numpy()] = known.column("n").to_numpy()
        klass = classes[Units(frequent).of(words, endings)]
        emitted = np.where(words == END, 0.0, np.log10((times + ADDED) / mass[klass]))
        base = np.log10((times + ADDED) / (total + ADDED * (distinct + 1)))
        at = klass[codes]
        logs = transitions[np.concatenate([[END], at[:-1]]), at] + emitted[codes]
        first = np.cumsum(n) - n
        return pa.table(
            [pa.array(row["doc_id"], I64), pa.array(row["held_out"], pa.bool_()), pa.array(n),
             pa.array(np.add.reduceat((times > 0)[codes].astype(np.int64), first)),
             pa.array(np.full(len(n), total, np.int64)), pa.array(np.add.reduceat(base[codes], first)),
             pa.array(np.add.reduceat(logs, first))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    known = (tokens.select("slice", "words").mapInArrow(asked, "slice long, place int, word long")
             .join(model.words.select("word", "n"), "word").select("slice", "place", "n"))
    return tokens.groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(run, SCORES_DDL)


def held_out_of(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def evaluate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text by a model of the texts that are not held out.

    A text is held out if the CRC-32 of its id as text is 1 modulo 5; a null id counts as the empty text. A null
    or empty text, and one of white space, is one end token. Every row gives one row, repeated ids and texts
    too, and the texts of repeated training rows count each time. Words are compared by a 64-bit number.
    Without training texts all counts are zero and every token has the base probability 1. An empty table
    gives no rows; other columns are ignored.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigrams) and score
    (log10 probability of the text under the class model).
    """
    tokens = tokenise(docs, id_col, text_col, held_out_of(F.col(id_col)))
    return score(tokens, train(tokens))


def perplexity(scores: DataFrame, column: str = "score") -> DataFrame:
    """Perplexity of the training and of the held-out texts, as ``held_out``, ``perplexity``."""
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens")).alias("perplexity"))
