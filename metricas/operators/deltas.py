"""Period-over-period deltas (J6/D1 at ingest, D2 full recompute).

Both are one ``Window`` keyed by the post: all six ``lag``s share a single
spec, so Catalyst plans one shuffle + sort for them. A post has at most one
row per day, so no window partition grows with the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricas import schemas as S

PK = S.POST_KEY
METRICS = S.DELTA_METRICS


def _post_window():
    return Window.partitionBy(*PK).orderBy("fecha_descarga")


def recompute_deltas(daily: DataFrame) -> DataFrame:
    """delta = value - previous row's value for the post; the first row gets NULL.

    The result *is* the updated table (no self-join back on the four keys).
    """
    w = _post_window()
    base = daily.drop(*[f"delta_{m}" for m in METRICS if f"delta_{m}" in daily.columns])
    return base.select(*base.columns,
                       *[(F.col(m) - F.lag(m).over(w)).alias(f"delta_{m}") for m in METRICS])


def repaired_deltas(daily: DataFrame) -> DataFrame:
    """K5 in part: the rows of ``daily`` whose deltas D2 changes, with the new ones.

    A post's deltas depend on its own rows only, so ``daily`` may be limited to the posts with new rows.
    """
    old = [F.col(f"delta_{m}").alias(f"_old_{m}") for m in METRICS]
    again = recompute_deltas(daily.select("*", *old))
    same = reduce(Column.__and__, [F.col(f"delta_{m}").eqNullSafe(F.col(f"_old_{m}")) for m in METRICS])
    return again.where(~same).select(*daily.columns)


def deltas_after(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """D1's deltas over a post's ``rows``: the value minus that of the row before, or the full value.

    With ``carry`` also which row that was: ``_prev_date`` and ``_prev<column>`` for each column named.
    """
    w = _post_window()
    came = {"_prev_date": "fecha_descarga", **{f"_prev{c}": c for c in carry}} if carry else {}
    return rows.select(*rows.columns, *[(F.col(m) - F.coalesce(F.lag(m).over(w), F.lit(0).cast("bigint")))
                                        .alias(f"delta_{m}") for m in METRICS],
                       *[F.lag(c).over(w).alias(name) for name, c in came.items()])


def ingest_deltas(batch: DataFrame, history: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Deltas of incoming rows against the latest stored row strictly before each date.

    Without a previous row the delta is the full value. Earlier dates of the same
    batch count as stored (the reference writes them first, in one transaction).
    Stored rows the batch overwrites (same four keys) are not candidates, and
    stored rows after a batch date are not revised. ``batch`` must be unique on
    the four keys (``merge.upsert_daily_metrics`` dedupes it first).

    The as-of lookup is a join of history to the batch's posts (only rows dated
    before that post's latest incoming date) plus the shared window: no per-row
    probe.

    ``carry``: columns of both sides that say where a row comes from; the result then also tells
    which row was the previous one, as ``_prev_date`` and ``_prev<column>``.
    """
    cols = [*PK, "fecha_descarga", *METRICS]
    extra = [c for c in batch.columns if c not in cols and not c.startswith("delta_")]
    b = batch.select(*cols, *extra, F.lit(1).alias("_src"))
    if history is not None:
        bounds = batch.groupBy(*PK).agg(F.max("fecha_descarga").alias("_maxd"))
        h = (history.select(*cols, *carry).join(bounds, PK, "inner")
             .where(F.col("fecha_descarga") < F.col("_maxd"))
             .select(*cols, *[F.col(c) if c in carry else F.lit(None).cast(batch.schema[c].dataType).alias(c)
                              for c in extra],
                     F.lit(0).alias("_src")))
        # one shuffle by the post key serves both windows below ((post, day) and post)
        u = h.unionByName(b).repartition(*PK)
        # a stored row at the same date as an incoming row is overwritten by it
        same_day = Window.partitionBy(*PK, "fecha_descarga")
        u = (u.withColumn("_has_new", F.max("_src").over(same_day))
             .where((F.col("_src") == 1) | (F.col("_has_new") == 0)).drop("_has_new"))
    else:
        u = b
    out = deltas_after(u, carry)
    came = ["_prev_date", *[f"_prev{c}" for c in carry]] if carry else []
    return out.where(F.col("_src") == 1).select(*cols, *extra, *[f"delta_{m}" for m in METRICS], *came)


def revise_after_late(stored: DataFrame, late: DataFrame, run: Sequence[str]) -> DataFrame:
    """Rows of later runs whose previous row turns out to be one of a run that lands late, with D1's new deltas.

    ``stored``: such rows with the columns that ``ingest_deltas`` adds for ``carry=run``; ``late``: the late run's
    rows of the same posts. A row's previous one has the greatest date before its own, and at that date the
    newest run up to its own; so a late row takes the place of the known one if it is greater by (date, run).
    """
    row = F.struct("fecha_descarga", *run, *METRICS)
    both = (stored.withColumn("_late", F.lit(None).cast(late.select(row.alias("r")).schema["r"].dataType))
            .unionByName(late.select(*PK, "fecha_descarga", row.alias("_late")), allowMissingColumns=True))
    before = (Window.partitionBy(*PK).orderBy(F.unix_date("fecha_descarga"))
              .rangeBetween(Window.unboundedPreceding, -1))
    both = both.withColumn("_last", F.max("_late").over(before)).where(F.col("_late").isNull() & F.col("_last").isNotNull())
    known = F.struct(F.col("_prev_date").alias("fecha_descarga"), *[F.col(f"_prev{c}").alias(c) for c in run])
    changed = both.where(F.struct("_last.fecha_descarga", *[f"_last.{c}" for c in run]) > known)
    new = {**{f"delta_{m}": F.col(m) - F.coalesce(F.col(f"_last.{m}"), F.lit(0).cast("bigint")) for m in METRICS},
           "_prev_date": F.col("_last.fecha_descarga"), **{f"_prev{c}": F.col(f"_last.{c}") for c in run}}
    return changed.select(*[new[c].alias(c) if c in new else F.col(c) for c in stored.columns])
