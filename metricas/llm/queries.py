"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bpe, brown_lm, collocations, exact_dedup, hard_negatives, lang_id, line_dedup, ngram_join,
               packing, pii, substring_dedup, warc)
from .common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                      ("n_tokens", "ids_sha256", "decoded_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest_rows(substring_dedup.dedup(table(spark, sf_dir, "documents")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op11_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.evaluate(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = hard_negatives.relabelled(F.col("label"), F.col("vec_id"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_ngram_join": op2_ngram_join,
    "op3_pii": op3_pii,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_multi_index": op5_multi_index,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_line_dedup": op7_line_dedup,
    "op8_bpe": op8_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_brown_lm": op11_brown_lm,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}
