"""Exact deduplication by a tree merge of sorted digest runs (DataFrame operations only).

Each input partition is a run of digests. In round r the runs whose numbers
agree after dropping r*b bits meet: their rows are placed together, sorted by
digest, and merged 2**b at a time, so that runs exchange rows along a binomial
tree. A merged row keeps the best document, its copies' count and a second,
independent key (length and a 64-bit hash of the normalised text); rows merge
only if both keys agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

# fixed values: the six white-space characters that normalising deletes
BLANKS = [" ", "\t", "\n", "\v", "\f", "\r"]
KEYS = ["digest", "norm_bytes", "norm_hash"]


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, length of the original text, digest, verification keys, run."""
    return (docs.select(F.col(id_col).alias("doc_id"),
                        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
                        normalised(F.col(text_col)).alias("norm"))
            .select("doc_id", "chars",
                    F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
                    F.octet_length("norm").alias("norm_bytes"),
                    F.xxhash64("norm").alias("norm_hash"),
                    F.spark_partition_id().alias("run")))


def merge_runs(runs: DataFrame, n_runs: int, bits: int = 4) -> DataFrame:
    """Merge all runs to one: best document and number of copies for each digest.

    ``bits``: 2**bits runs meet in each round. The longest original text wins,
    then the smallest id. Each round's partitions are (run group, leading digest
    byte), so the last rounds, with few groups left, stay spread over the digests.
    """
    # the largest struct wins: most characters, then smallest id
    out = runs.select(*KEYS, "run", F.struct("chars", (-F.col("doc_id")).alias("minus_id")).alias("best"),
                      F.lit(1).cast("long").alias("copies"))
    # rows meet the other copies in their own run before any of them is sent
    left = n_runs
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        out = (out.groupBy(*KEYS, "run")
               .agg(F.max("best").alias("best"), F.sum("copies").alias("copies")))
        if left <= 1:
            return out.select(*KEYS, (-F.col("best.minus_id")).alias("keep_id"),
                              F.col("copies").alias("group_size"))
        left = -(-left // (1 << bits))
        out = (out.withColumn("run", F.shiftright("run", bits))
               .repartition(parts, *KEYS, "run")
               .sortWithinPartitions(*KEYS, "run"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 4) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Texts are equal when identical after deleting space, tab, line feed,
    vertical tab, form feed and carriage return. Of equal texts the one with the
    most code points stays, then the smallest id. A null text counts as empty,
    and all empty texts are one group; a long text is hashed whole; an empty
    table gives no rows; other columns are ignored. Ids are expected unique; if
    an id repeats, each of its rows is a document of its own group.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = staged(digests(docs, id_col, text_col), "digests")
    n_runs = (rows.agg(F.max("run").alias("n")).first()["n"] or 0) + 1
    best = merge_runs(rows, n_runs, bits)
    return (rows.join(best, KEYS)
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
