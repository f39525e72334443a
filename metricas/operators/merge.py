"""Keyed merges as pure DataFrame functions (K1-K6).

``current`` is the table as stored, ``batch`` what one run produced. Each
function returns the table as it must be after the run; ``tables.KeyedTable``
writes that back for the touched partitions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.operators.deltas import ingest_deltas
from metricas.operators.shape import latest_by_key


def _columns(schema) -> list[str]:
    return [f.name for f in schema.fields]


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to a table schema, in table order; absent nullable columns are NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have or not f.nullable else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def upsert(current: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           seq_col: str = "seq") -> DataFrame:
    """Insert-or-overwrite on ``keys``, last write wins inside the batch (max ``seq``)."""
    new = latest_by_key(batch, keys, seq_col, drop_seq=True) if seq_col in batch.columns else batch
    if current is None:
        return new
    # stored rows go through no aggregation: those that the batch has a row for drop out by key
    again = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    kept = current.join(again, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys], "left_anti")
    return kept.unionByName(new.select(*current.columns))


def insert_ignore(current: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                  seq_col: str = "seq") -> DataFrame:
    """``ON CONFLICT DO NOTHING``: first write wins, stored rows are never changed.

    Keys may be NULL (T4's dimension columns): the anti-join is null-safe.
    """
    new = latest_by_key(batch, keys, seq_col, keep_first=True, drop_seq=True) \
        if seq_col in batch.columns else batch
    if current is not None:
        cond = [new[k].eqNullSafe(current[k]) for k in keys]
        new = new.join(current.select(*keys), cond, "left_anti")
        return current.unionByName(new.select(*current.columns))
    return new


def merge_versions(current: DataFrame | None, batch: DataFrame, keys: Sequence[str], run: tuple,
                   first: bool = False, seq_col: str = "seq") -> DataFrame:
    """K1, K3, K4, K6 on rows with a version, ``_run_date`` and ``_run_id``: a maximum (``first``: minimum) over
    versions, so that runs may be merged in any order."""
    rows = latest_by_key(batch, keys, seq_col, keep_first=first, drop_seq=True) \
        if seq_col in batch.columns else batch
    rows = rows.select("*", F.lit(run[0]).cast("date").alias("_run_date"), F.lit(run[1]).cast("string").alias("_run_id"))
    if current is None:
        return rows
    both = current.unionByName(rows).withColumn("_version", F.struct("_run_date", "_run_id"))
    return latest_by_key(both, keys, "_version", keep_first=first, drop_seq=True)


def merge_all_versions(batches: Sequence[tuple[DataFrame, tuple]], keys: Sequence[str], first: bool = False,
                       seq_col: str = "seq") -> DataFrame:
    """``merge_versions`` of every (batch, run), from an empty table, in one pass: the greatest version, then the
    last row of its batch (``first``: the smallest, the first)."""
    versions = sorted({run for _, run in batches}, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    rows = reduce(DataFrame.unionByName, [
        b.withColumns({"_run": F.lit(n), seq_col: F.struct(F.lit(n), *[c for c in b.columns if c == seq_col])})
        for b, n in ((b, versions.index(run)) for b, run in batches)])
    found = latest_by_key(rows, keys, seq_col, keep_first=first, drop_seq=True)

    def of(k: int, kind: str):
        return F.get(F.array(*[F.lit(v[k]).cast(kind) for v in versions]), F.col("_run"))
    return found.select(*[c for c in found.columns if c != "_run"], of(0, "date").alias("_run_date"),
                        of(1, "string").alias("_run_id"))


# ---- K1 ----

def post_rows(posts: DataFrame) -> DataFrame:
    """Normalised posts -> T1 columns (keeping ``seq`` when present, for last-wins)."""
    seq = ["seq"] if "seq" in posts.columns else []
    return posts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.T1_POSTS.fields], *seq)


def upsert_posts(current: DataFrame | None, posts: DataFrame) -> DataFrame:
    return upsert(None if current is None else conform(current, S.T1_POSTS), post_rows(posts), S.POST_KEY)


# ---- K2 ----

def upsert_daily_metrics(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Ingest deltas (D1) against ``current``, then overwrite on the four keys."""
    metric_cols = [f.name for f in S.T2_DAILY.fields if not f.name.startswith("delta_")]
    if "seq" in batch.columns:
        b = latest_by_key(batch.select(*metric_cols, "seq"), S.DAILY_KEY, drop_seq=True)
    else:
        b = batch.select(*metric_cols)
    with_deltas = conform(ingest_deltas(b, current), S.T2_DAILY)
    if current is None:
        return with_deltas
    kept = conform(current, S.T2_DAILY).join(with_deltas.select(*S.DAILY_KEY), S.DAILY_KEY, "left_anti")
    return kept.unionByName(with_deltas)


# ---- K3 ----

def weekly_stats_rows(weeks: DataFrame) -> DataFrame:
    """Rename a page-week row to T3. visualizaciones_pagina is fed from impresiones."""
    return weeks.select(
        "plataforma", "pagina_id", F.col("fecha_corte").alias("fecha_corte_semana"),
        F.coalesce(F.col("fans_total"), F.lit(0)).cast("bigint").alias("total_seguidores"),
        F.coalesce(F.col("alcance"), F.lit(0)).cast("bigint").alias("alcance_pagina"),
        F.coalesce(F.col("impresiones"), F.lit(0)).cast("bigint").alias("visualizaciones_pagina"),
        *(["seq"] if "seq" in weeks.columns else []),
    )


def upsert_weekly_stats(current: DataFrame | None, weeks: DataFrame) -> DataFrame:
    return upsert(current, weekly_stats_rows(weeks), S.WEEKLY_KEY)


# ---- K4 ----

def segment_rows(df: DataFrame, as_of_col: str, dim_col: str, key_col: str,
                 qty_col: str) -> DataFrame:
    """Bucket rows -> T4 columns; ``dim_col`` says which of genero/pais/ciudad gets the key."""
    dim = F.col(dim_col)
    key = F.col(key_col)
    return df.select(
        "plataforma", "pagina_id", F.col(as_of_col).alias("fecha_corte_semana"),
        F.when(dim == "genero", key).alias("genero"),
        F.when(dim == "pais", key).alias("pais"),
        F.when(dim == "ciudad", key).alias("ciudad"),
        F.lit(None).cast("string").alias("nivel_educacion"),
        F.col(qty_col).cast("bigint").alias("cantidad_seguidores"),
        *(["seq"] if "seq" in df.columns else []),
    )


def insert_ignore_segments(current: DataFrame | None, segments: DataFrame) -> DataFrame:
    return insert_ignore(current, segments, S.SEGMENT_KEY)


# ---- K5 is deltas.recompute_deltas ----

# ---- K6 ----

def upsert_campaigns(current: DataFrame | None, campaigns: DataFrame) -> DataFrame:
    return upsert(current, campaigns, S.CAMPAIGN_KEY)


def upsert_campaign_daily(current: DataFrame | None, days: DataFrame) -> DataFrame:
    return upsert(current, days, S.CAMPAIGN_DAILY_KEY)
