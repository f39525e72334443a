"""Language identification by multilingual mixture inference.

Training counts byte trigrams (ASCII letters lower-cased, hashed to a fixed
number of features) for each language over every training document. A document
is then taken as a mixture: each stretch of 64 bytes is in one of the learned
languages, and expectation-maximisation over the stretches' n-gram likelihoods
estimates the document's language proportions. Of the sets of its most probable
languages the one with the best penalised likelihood is chosen, and the
language with the largest share in it is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_buffers, text_slices
from .words import LOWER

FEATURES = 1 << 16
STRETCH = 64  # bytes
ROUNDS = 15
SMOOTHING = 0.5
TEMPER = 1 / 3  # a trigram shares its bytes with two neighbours
UNKNOWN = "und"

GRAMS_DDL = "lang string, grams array<int>, counts array<long>"
GRAMS = pa.schema([("lang", pa.string()), ("grams", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])


def trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of the trigram around each byte, texts having a space before and after; offsets in features."""
    n, rows = len(data), np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    padded = np.full(n + 2 * (len(offs) - 1) + 2, 0x20, np.uint32)
    padded[np.arange(n) + 2 * rows + 1] = LOWER[data]
    at = np.arange(n) + 2 * rows  # the byte before
    code = (padded[at] << np.uint32(16)) | (padded[at + 1] << np.uint32(8)) | padded[at + 2]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) % FEATURES, offs


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> trigram counts of each language in this partition."""
    totals: dict[str, np.ndarray] = {}
    for part in text_slices(batches):
        feature, offs = trigrams(*text_buffers(part.column("text")))
        names, code = np.unique(np.array(part.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        row = np.repeat(code, np.diff(offs))
        for k, name in enumerate(names.tolist()):
            n = np.bincount(feature[row == k], minlength=FEATURES)
            totals[name] = totals[name] + n if name in totals else n
    for name, n in totals.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([some.astype(np.int32)], GRAMS.field(1).type),
                                          pa.array([n[some]], GRAMS.field(2).type)], schema=GRAMS)


#: the learned languages, and the log-likelihood of each feature in each of them
Model = tuple[list[str], np.ndarray]


def model_of(counts: dict[str, np.ndarray]) -> Model:
    langs = sorted(counts)
    logp = [TEMPER * np.log((counts[k] + SMOOTHING) / (counts[k].sum() + SMOOTHING * FEATURES)) for k in langs]
    return langs, np.array(logp, np.float32).reshape(len(langs), FEATURES)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from every row with a language and a text. One language's counts, FEATURES numbers
    at most, come to the driver as one row; languages are taken to be some hundreds at most."""
    rows = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .where("lang is not null and text is not null")
            .mapInArrow(count_grams, GRAMS_DDL)
            .select("lang", F.explode(F.arrays_zip("grams", "counts")).alias("g"))
            .groupBy("lang", F.col("g.grams").alias("gram")).agg(F.sum("g.counts").alias("n"))
            .groupBy("lang").agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts")).collect())
    counts = {}
    for r in rows:
        counts[r["lang"]] = np.zeros(FEATURES, np.int64)
        counts[r["lang"]][r["grams"]] = r["counts"]
    return model_of(counts)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, axis=0)


def mixture(likelihood: np.ndarray, first: np.ndarray, text: np.ndarray,
            allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text, by EM over its stretches.

    ``likelihood``: stretches x languages (log); ``first``: each text's first
    stretch; ``text``: each stretch's text; ``allowed``: texts x languages.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    n = np.diff(np.append(first, len(text)))[:, None]
    for _ in range(ROUNDS):
        with np.errstate(divide="ignore"):
            joint = likelihood + np.log(share)[text]
        top = joint.max(axis=1, keepdims=True)
        weight = np.exp(joint - top)
        total = weight.sum(axis=1, keepdims=True)
        share = _per_text(weight / total, first) / n
    return share, _per_text((top + np.log(total))[:, 0], first)


def infer(logp: np.ndarray, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language number and its share in each text; texts must not be empty."""
    chosen, score, _ = infer_sets(logp, data, offs)
    return chosen, score


def infer_sets(logp: np.ndarray, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``infer``, and the proportions of the chosen set (texts x languages, 0 outside it)."""
    feature, offs = trigrams(data, offs)
    size = np.diff(offs)
    stretches = -(-size // STRETCH)
    first = np.cumsum(stretches) - stretches
    text = np.repeat(np.arange(len(size)), stretches)
    starts = offs[text] + (np.arange(len(text)) - first[text]) * STRETCH
    likelihood = np.stack([np.add.reduceat(p[feature], starts) for p in logp], axis=1).astype(float)
    everything = np.ones((len(size), len(logp)))
    share, _ = mixture(likelihood, first, text, everything)
    # nested sets: the k languages with the largest shares
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    single = _per_text(likelihood, first)
    sets, penalty = np.zeros_like(single), 0.5 * np.log(np.maximum(size, 2))
    sets[np.arange(len(size)), single.argmax(axis=1)] = 1
    best = single.max(axis=1) - penalty
    limit = most(likelihood, first, text, share)
    for k in range(2, len(logp) + 1):
        # a set of k or more languages can only win where this bound on every mixture allows it
        some = np.flatnonzero(limit - k * penalty > best)
        if not len(some):
            break
        n = stretches[some]
        begin = np.cumsum(n) - n
        own = likelihood[np.repeat(first[some] - begin, n) + np.arange(n.sum())]
        part, fit = mixture(own, begin, np.repeat(np.arange(len(some)), n), (rank[some] < k).astype(float))
        penalised = fit - k * penalty[some]
        better = penalised > best[some]
        best[some[better]], sets[some[better]] = penalised[better], part[better]
    chosen = sets.argmax(axis=1)
    return chosen, np.clip(share[np.arange(len(size)), chosen], 0.0, 1.0), sets


def most(likelihood: np.ndarray, first: np.ndarray, text: np.ndarray, share: np.ndarray) -> np.ndarray:
    """A bound that no mixture's log-likelihood exceeds, close where ``share`` is near the best one: by
    concavity the gain over it is at most n * log(the largest mean ratio of a language to the mixture)."""
    with np.errstate(divide="ignore"):
        joint = likelihood + np.log(share)[text]
    top = joint.max(axis=1, keepdims=True)
    fit = top + np.log(np.exp(joint - top).sum(axis=1, keepdims=True))
    n = np.diff(np.append(first, len(text)))
    ratio = _per_text(np.exp(np.minimum(likelihood - fit, 700)), first).max(axis=1) / n
    return np.minimum(_per_text(fit[:, 0], first) + n * np.log(ratio), _per_text(likelihood.max(axis=1), first)) + 1e-6


ADDED = ("lang_pred", "score", "languages")
MIXED = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def predictor(model, text_col: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp = model.value
        for part in text_slices(batches, text_col):
            column = part.column(text_col)
            ascii_letters = pa.compute.match_substring_regex(column, "[A-Za-z]").fill_null(False)
            letters = ascii_letters.to_numpy(zero_copy_only=False).astype(bool)
            for i in np.flatnonzero(~letters):
                letters[i] = any(map(str.isalpha, column[i].as_py() or ""))
            names, scores = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
            mixed: list[list] = [[] for _ in range(part.num_rows)]
            some = np.flatnonzero(letters)
            if len(some) and langs:
                lang, score, sets = infer_sets(logp, *text_buffers(column.take(pa.array(some))))
                names[some], scores[some] = np.array(langs, object)[lang], score
                for i, own in zip(some, sets):
                    mixed[i] = [{"lang": langs[k], "share": float(own[k])} for k in np.argsort(-own, kind="stable") if own[k] > 0]
            rest = part if keep_text else part.drop_columns([text_col])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(names, pa.string()), pa.array(scores),
                                              pa.array(mixed, MIXED)],
                                             names=[*rest.schema.names, *ADDED])
    return run


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
            keep_text: bool = False) -> DataFrame:
    """Add lang_pred, score (the language's share of the text, 0 to 1) and languages to the columns
    ``keep`` (with the text too if ``keep_text``). ``languages`` is the chosen set, of any size, as
    an array of lang and share, the largest share first; shares sum to 1.

    Only the text is looked at. A null text, or one without a letter, is
    ``und`` with score 0 and no languages, as is any text where no language was learned. Whole
    texts count, of any length; repeated rows get equal answers; an empty table
    gives no rows. Columns of ``docs`` named lang_pred, score or languages are not kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name in keep and f.name not in (text_col, *ADDED)]
    text = docs.schema[text_col]
    schema = T.StructType([*kept, *([text] if keep_text else []), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("languages", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()),
                                                                                T.StructField("share", T.DoubleType())])))])
    return (docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col(text_col))
            .mapInArrow(predictor(shared, text_col, keep_text), schema))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3: fold 1 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def identify(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Learn from the folds that aren't held out, then predict every document.

    A null id belongs to no fold: it is not learned from and not held out.
    """
    model = train(docs.where(fold(id_col) != 1))
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).cast(kind).alias("doc_id"), "text",
                       F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out"))
    return predict(rows, model, ("doc_id", "held_out")).drop("languages")
