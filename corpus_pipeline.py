"""Corpus preparation: the stages that turn ``documents`` into packed training sequences.

Each stage works on every row its predecessor kept. All but the last return the
columns they were given (text, and n_chars where there is one, as they are after
the stage); the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricas.llm import lang_id, line_dedup, ngram_join, packing, pii
from metricas.llm.common import staged, table


def recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, n_chars being the length of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def apart(docs: DataFrame) -> DataFrame:
    """The columns but the text under names that no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c == "text" else f"_own_{i}") for i, c in enumerate(docs.columns)])


def together(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``apart`` with their own names again."""
    return rows.select(*[F.col("text" if c == "text" else f"_own_{i}").alias(c) for i, c in enumerate(columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 10: learn from every document with a language; documents without any language (``und``) go.

    Those are null and empty texts and texts without a letter, of any length. Where no document names a
    language there is nothing to learn and nothing is rejected. Repeated rows stay or go together; an empty
    table gives no rows; other columns stay as they are, whatever their names.
    """
    model = lang_id.train(docs)
    if not model[0]:
        return docs
    rows = apart(docs)
    return together(lang_id.predict(rows, model, tuple(rows.columns), keep_text=True).where(
        F.col("lang_pred") != lang_id.UNKNOWN), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: repeated multi-line chunks go; every document stays, if need be with an empty text.

    Null and empty texts, and rows without an id, stay as they are; rows that repeat an id and text get equal
    texts; an empty table gives no rows; other columns stay as they are, but for n_chars.
    """
    cut = line_dedup.dedup(docs).where("n_removed > 0").select("doc_id", "text").dropDuplicates(["doc_id"])
    cut = cut.select(F.col("doc_id").alias("_cut_id"), F.col("text").alias("_cut_text"))
    rows = apart(docs)
    own = F.col(f"_own_{docs.columns.index('doc_id')}").cast("long")
    out = rows.join(cut, own == F.col("_cut_id"), "left").withColumn(
        "text", F.when(F.col("_cut_id").isNull(), F.col("text")).otherwise(F.col("_cut_text")))
    return recounted(together(out, docs.columns), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: of each group of linked documents the one with the smallest id stays.

    Null, empty and blank texts link with nothing and stay, as do rows without an id; rows that repeat an id
    stay or go together; texts count whole; an empty table gives no rows; other columns stay as they are.
    """
    goes = ngram_join.join(docs).where("doc_id <> component_id").select("doc_id")
    return docs.join(goes, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3: each span of personal data becomes its kind in angle brackets.

    A null or empty text stays as it is; texts count whole; repeated rows get equal texts; an empty table gives
    no rows; other columns stay as they are, but for n_chars.
    """
    model = pii.fit(pii.find_candidates(docs))
    return recounted(pii.mask(docs, model), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 1: token pieces packed into sequences of at most 4096.

    A null or empty text is one piece of the end token; a text of more tokens is cut into pieces; repeated rows
    give their pieces each; an empty table gives no rows; columns but doc_id and text are left out.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# SQL cannot express the language and personal-data models; tests compare each
# stage with a brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each one's rows are written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
