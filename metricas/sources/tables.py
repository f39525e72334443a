"""Keyed Parquet tables T1-T6: read, and merge rows into one table touching only affected partitions.

These are the sinks K1-K6 of a table that stands alone; the tables of runs, which change together, are in
``sources.warehouse``, and ``KeyedTable.read`` reads those too. A table is a partitioned Parquet folder, and its partition is a function of its
key, so the rows that a run can replace lie in the partitions of its own rows. A merge
  1. finds those partitions (their column values only, for static pruning);
  2. reads them and computes the merged rows with the pure functions of
     ``operators.merge``;
  3. writes the merged rows to the shared folder of ``spark.checkpoint.dir``, so
     the write never reads the folder it overwrites and a lost executor does not
     recompute from it, and removes that copy afterwards;
  4. overwrites just those partitions (``partitionOverwriteMode=dynamic``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricas import schemas as S
from metricas.operators import deltas as D
from metricas.operators import merge as K
from metricas.operators.shape import latest_by_key
from metricas.session import ensure_checkpoint_dir, pin_utc


PAGE_BUCKETS = 256  # of T1, for each platform


def page_bucket() -> Column:
    return F.pmod(F.xxhash64("plataforma", "pagina_id"), F.lit(PAGE_BUCKETS)).cast("int")


def _month(c: str) -> Callable[[], Column]:
    return lambda: F.trunc(F.col(c), "month")


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a Parquet copy in the shared checkpoint folder, removed at the end."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/merge-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


@dataclass
class KeyedTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    partitions: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    # ---- reading ----
    def _full_schema(self) -> T.StructType:
        kinds = {"mes": T.DateType(), "cubo": T.IntegerType()}
        extra = [T.StructField(p, kinds.get(p, T.StringType()), True)
                 for p in self.partitions if p not in self.schema.fieldNames()]
        return T.StructType(self.schema.fields + extra)

    def _of_runs(self):
        """The warehouse that this table belongs to, if runs were merged under its root."""
        from metricas.sources import warehouse
        return warehouse.snapshot(self.spark, os.path.dirname(self.path))

    def exists(self) -> bool:
        own = self._of_runs()
        if own is not None:
            return os.path.basename(self.path) in own.manifest.sets
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(jvm.org.apache.hadoop.fs.Path(self.path, "_SUCCESS")) or (
            fs.exists(jpath) and len(fs.listStatus(jpath)) > 0)

    def read(self, where: Column | None = None) -> DataFrame | None:
        """The stored rows; ``where`` may use partition columns (pruned at listing)."""
        own = self._of_runs()
        if own is not None:
            return own.read(os.path.basename(self.path), where)
        if not self.exists():
            return None
        df = self.spark.read.schema(self._full_schema()).parquet(self.path)
        if where is not None:
            df = df.where(where)
        return df.select(*self.schema.fieldNames())

    def _with_partitions(self, df: DataFrame) -> DataFrame:
        for p, expr in self.partitions.items():
            if p not in df.columns:
                df = df.withColumn(p, expr())
        return df

    def read_touched(self, batch: DataFrame) -> DataFrame | None:
        """The stored rows of the partitions that ``batch``'s rows belong to.

        The distinct values of each partition column (platforms, months, buckets)
        prune folders at listing time; a semi-join then leaves the very partitions.
        """
        if not self.exists():
            return None
        df = self.spark.read.schema(self._full_schema()).parquet(self.path)
        parts = list(self.partitions)
        touched = self._with_partitions(batch).select(*parts).distinct()
        values = touched.agg(*[F.collect_set(p).alias(p) for p in parts],
                             *[F.max(F.col(p).isNull()).alias(f"_{p}") for p in parts]).first()
        for p in parts:
            cond = F.col(p).isin(values[p]) if values[p] else F.lit(False)
            df = df.where(cond | F.col(p).isNull() if values[f"_{p}"] else cond)
        t = touched.select(*[F.col(p).alias(f"_t_{p}") for p in parts])
        return (df.join(t, [df[p].eqNullSafe(t[f"_t_{p}"]) for p in parts], "left_semi")
                .select(*self.schema.fieldNames()))

    # ---- writing ----
    def _alone(self) -> None:
        if self._of_runs() is not None:
            raise ValueError(f"{self.path} is a table of runs: use sources.warehouse")

    def write(self, rows: DataFrame) -> None:
        """Overwrite the partitions present in ``rows``."""
        self._alone()
        with kept(self._with_partitions(K.conform(rows, self.schema))) as out:
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*self.partitions).parquet(self.path))

    def merge(self, batch: DataFrame, how: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        """Merge ``batch`` with ``how(current_touched, batch)`` and write the touched partitions."""
        self._alone()
        self.write(how(self.read_touched(batch), batch))


# ---- the tables of the data model ----

def tables(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    return {
        # a bucket of the page is a function of the key: a run rewrites its own pages' buckets
        "publicaciones": KeyedTable(
            spark, os.path.join(root, "publicaciones"), S.T1_POSTS, S.POST_KEY,
            {"plataforma": lambda: F.col("plataforma"),
             "cubo": page_bucket}),
        "metricas_publicaciones_diarias": KeyedTable(
            spark, os.path.join(root, "metricas_publicaciones_diarias"), S.T2_DAILY, S.DAILY_KEY,
            {"plataforma": lambda: F.col("plataforma"), "mes": _month("fecha_descarga")}),
        "estadisticas_pagina_semanal": KeyedTable(
            spark, os.path.join(root, "estadisticas_pagina_semanal"), S.T3_WEEKLY, S.WEEKLY_KEY,
            {"plataforma": lambda: F.col("plataforma"), "mes": _month("fecha_corte_semana")}),
        "segmentacion_seguidores_semanal": KeyedTable(
            spark, os.path.join(root, "segmentacion_seguidores_semanal"), S.T4_SEGMENTS, S.SEGMENT_KEY,
            {"plataforma": lambda: F.col("plataforma"), "mes": _month("fecha_corte_semana")}),
        "campanias": KeyedTable(spark, os.path.join(root, "campanias"), S.T5_CAMPAIGNS, S.CAMPAIGN_KEY,
                                {"plataforma": lambda: F.col("plataforma")}),
        "metricas_campanias_diarias": KeyedTable(
            spark, os.path.join(root, "metricas_campanias_diarias"), S.T6_CAMPAIGN_DAILY,
            S.CAMPAIGN_DAILY_KEY, {"plataforma": lambda: F.col("plataforma"), "mes": _month("fecha_descarga")}),
    }


def merge_posts(t1: KeyedTable, posts: DataFrame) -> None:
    """K1: last write wins on (plataforma, pagina_id, publicacion_id)."""
    t1.merge(posts, lambda cur, b: K.upsert_posts(cur, b))


def merge_daily(t2: KeyedTable, batch: DataFrame) -> None:
    """K2: ingest deltas (D1) against the *whole* stored history of the batch's posts,
    then overwrite the touched month partitions.

    Only history dated up to the batch's latest date can be a previous row, so the
    read is pruned to the month partitions up to it (one scalar collected).
    """
    latest = batch.agg(F.max("fecha_descarga")).first()[0]
    if latest is None:
        return
    history = t2.read((F.col("mes") <= F.trunc(F.lit(latest), "month")) & (F.col("fecha_descarga") <= F.lit(latest)))
    metric_cols = [f.name for f in S.T2_DAILY.fields if not f.name.startswith("delta_")]
    if "seq" in batch.columns:
        b = latest_by_key(batch.select(*metric_cols, "seq"), S.DAILY_KEY, drop_seq=True)
    else:
        b = batch.select(*metric_cols)
    with_deltas = K.conform(D.ingest_deltas(b, history), S.T2_DAILY)

    def how(current, _batch):
        if current is None:
            return with_deltas
        rest = current.join(b.select(*S.DAILY_KEY), S.DAILY_KEY, "left_anti")
        return rest.unionByName(with_deltas)
    t2.merge(b, how)


def merge_weekly(t3: KeyedTable, rows: DataFrame) -> None:
    """K3: last write wins on (plataforma, pagina_id, fecha_corte_semana)."""
    t3.merge(rows, lambda cur, b: K.upsert(cur, b, S.WEEKLY_KEY))


def merge_segments(t4: KeyedTable, rows: DataFrame) -> None:
    """K4: first write wins; stored rows never change."""
    t4.merge(rows, lambda cur, b: K.insert_ignore(cur, b, S.SEGMENT_KEY))


def recompute_all_deltas(t2: KeyedTable) -> None:
    """K5 / L3: recompute every delta (first row NULL) and rewrite the table."""
    current = t2.read()
    if current is not None:
        t2.write(D.recompute_deltas(current))


def merge_campaign_daily(t6: KeyedTable, rows: DataFrame) -> None:
    """K6: last write wins on (plataforma, cuenta_id, campania_id, fecha_descarga)."""
    t6.merge(rows, lambda cur, b: K.upsert(cur, b, S.CAMPAIGN_DAILY_KEY))


def merge_campaigns(t5: KeyedTable, rows: DataFrame) -> None:
    """K6: last write wins on (campania_id, plataforma, cuenta_id)."""
    t5.merge(rows, lambda cur, b: K.upsert(cur, b, S.CAMPAIGN_KEY))


def merge_run(spark: SparkSession, root: str, outputs: Mapping[str, DataFrame], run: tuple | None = None,
              rejects: DataFrame | None = None) -> None:
    """Merge one run's outputs into the tables under ``root``, all or nothing (``sources.warehouse``)."""
    from metricas.sources import warehouse
    warehouse.merge_run(spark, root, outputs, run, rejects)
