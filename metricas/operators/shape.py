"""Long -> wide reshaping and "latest point" reductions.

Every "last wins" rule of the reference is loop order; here it is the
maximum ``seq`` (a total order fixed at landing), so results do not depend
on partitioning and are identical when a task is recomputed.

All reductions are ``groupBy().agg()``; ``max_by``/``sum`` run a map-side
partial aggregation before the shuffle, so a page or post holding a large
share of the rows costs one partial row per task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricas.functions import exprs as E

# ---- fixed values: metric and reaction names as the platforms send them ----
FB_POST_DAY_METRICS = [  # (metric name, output column)
    ("post_impressions", "impresiones"),
    ("post_impressions_unique", "alcance"),
    ("post_clicks", "clics_enlace"),
    ("post_video_views", "visualizaciones"),
]
FB_PAGE_WEEK_METRICS = [
    ("page_impressions", "impresiones"),
    ("page_impressions_unique", "alcance"),
    ("page_video_views", "video_views"),
    ("page_fans", "fans_total"),
]
FB_REACTION_TYPES = [  # (reaction type, output column)
    ("LIKE", "me_gusta"),
    ("LOVE", "me_encanta"),
    ("HAHA", "me_divierte"),
    ("WOW", "me_asombra"),
    ("SAD", "me_entristece"),
    ("ANGRY", "me_enoja"),
]
IG_LIFETIME_METRICS = [("reach", "alcance"), ("saved", "guardados"), ("video_views", "video_views")]
IG_ACCOUNT_SERIES = [("reach", "reach"), ("follower_count", "follower_count"),
                     ("profile_views", "profile_views")]


def last_wins_pivot(df: DataFrame, keys: Sequence[str], name_col: str, value: Column,
                    mapping: Sequence[tuple[str, str]], seq_col: str = "seq",
                    where: Column | None = None) -> DataFrame:
    """One row per key; for each (name -> column) the value of the last row with that name, else 0.

    Rows with names outside ``mapping`` still create the key's row (with zeros),
    as an unknown metric does in the reference.
    """
    name = F.col(name_col) if where is None else F.when(where, F.col(name_col))
    # once for each row: the aggregates below would repeat these expressions, and Java compiles no method so long
    rows = df.select(*keys, name.alias("_name"), value.alias("_value"), F.col(seq_col).alias("_order"))
    aggs = []
    for metric, out in mapping:
        hit = F.col("_name") == F.lit(metric)
        aggs.append(F.coalesce(F.max_by(F.when(hit, F.col("_value")), F.when(hit, F.col("_order"))),
                               F.lit(0).cast("bigint")).alias(out))
    return rows.groupBy(*keys).agg(*aggs)


def latest_by_key(df: DataFrame, keys: Sequence[str], seq_col: str = "seq",
                  keep_first: bool = False, drop_seq: bool = False) -> DataFrame:
    """Deduplicate on ``keys`` keeping the row with the greatest (or smallest) ``seq``.

    One pass over ``df`` and one row per key whatever the ties: the whole row is
    carried by ``max_by``, which is partially aggregated before the shuffle, so
    a key holding a large share of the rows costs one row per task. Select the
    columns needed before calling, and say so (``drop_seq``) if ``seq`` is not: the rows
    that a task sorts then hold it once, not twice. Keys may be NULL.
    """
    pick = F.min_by if keep_first else F.max_by
    rest = [c for c in df.columns if c not in keys and not (drop_seq and c == seq_col)]
    return (df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), F.col(seq_col)).alias("_row"))
            .select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`") for c in df.columns if c in keys or c in rest]))


# ---- A1 / A2 / A3 / A4 ----

def daily_post_insights(points: DataFrame) -> DataFrame:
    """A1: post day-insight points -> one row per (post, day) with the four daily metrics."""
    df = points.withColumn("dia", E.iso_local_date("end_time"))
    df = df.where(F.col("dia").isNotNull() & F.col("publicacion_id").isNotNull())  # F3
    return last_wins_pivot(df, ["plataforma", "pagina_id", "publicacion_id", "dia"], "name",
                           E.int_or_zero("value"), FB_POST_DAY_METRICS)


def page_week_pivot(points: DataFrame) -> DataFrame:
    """A2: page week-insight points -> one row per (page, week end date)."""
    df = points.withColumn("dia", E.iso_local_date("end_time")).where(F.col("dia").isNotNull())  # F3
    return last_wins_pivot(df, ["plataforma", "pagina_id", "dia"], "name",
                           E.int_or_zero("value"), FB_PAGE_WEEK_METRICS)


def reaction_breakdown(reactions: DataFrame) -> DataFrame:
    """A3: per-type reaction totals (``tipo``, ``total_count``) -> six columns; other types ignored."""
    return last_wins_pivot(reactions, ["plataforma", "pagina_id", "publicacion_id"], "tipo",
                           E.int_or_zero("total_count"), FB_REACTION_TYPES)


def lifetime_last_value(insights: DataFrame) -> DataFrame:
    """A4: per media, the last element of ``values[]`` for reach/saved/video_views.

    An entry with an empty ``values`` leaves the metric as it was (0 if never set).
    """
    last = E.int_or_zero(F.try_element_at(F.col("values"), F.lit(-1)).getField("value"))
    return last_wins_pivot(insights, ["plataforma", "pagina_id", "publicacion_id"], "name", last,
                           IG_LIFETIME_METRICS, where=F.size("values") > 0)


# ---- A5: latest point per ISO week ----

def latest_per_iso_week(df: DataFrame, keys: Sequence[str], date_col: str,
                        payload: Sequence[str], seq_col: str = "seq") -> DataFrame:
    """A5: per key and ISO (year, week), the point with the greatest date (ties: last seen).

    The point is chosen first and its payload expanded afterwards, and its own
    date is emitted (not the week start). Values are the chosen day's, never a sum.
    With one point per date (``seq_col == date_col``) and numeric payload, each
    column is a ``max_by`` over the LONG day number (a hash aggregate); otherwise
    the (date, seq) struct decides (sort-based, still partially aggregated).
    """
    week = E.iso_week_monday(F.col(date_col)).alias("_week")
    types = dict(df.dtypes)
    if seq_col == date_col and all(types[c] in ("bigint", "int", "double") for c in payload):
        day = F.unix_date(F.col(date_col))
        return (df.groupBy(*keys, week)
                .agg(F.max(date_col).alias(date_col), *[F.max_by(F.col(c), day).alias(c) for c in payload])
                .select(*keys, date_col, *payload))
    chosen = F.max_by(F.struct(F.col(date_col).alias("_d"), *[F.col(c) for c in payload]),
                      F.struct(F.col(date_col), F.col(seq_col))).alias("_pt")
    return (df.groupBy(*keys, week).agg(chosen)
            .select(*keys, F.col("_pt._d").alias(date_col), *[F.col(f"_pt.{c}").alias(c) for c in payload]))


# ---- A6 / A7 / A8 / A9 ----

def latest_per_country(elements: DataFrame) -> DataFrame:
    """Per (org, country) the value of the point with the greatest end date (ties: last seen).

    Also returns ``first_seq``: when the country key was first seen, which
    decides the order rows are inserted (and so which case-variant wins later).
    """
    keys = ["plataforma", "pagina_id", "country"]
    return (elements.groupBy(*keys)
            .agg(F.max_by(F.col("valor"), F.struct("dia", "seq")).alias("valor"),
                 F.min("seq").alias("first_seq")))


def sum_by_bucket(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated bucket names are summed."""
    return points.groupBy(*keys).agg(F.sum(E.int_or_zero("valor")).cast("bigint").alias("cantidad"))


def last_by_bucket(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated bucket names: the last one wins (not summed)."""
    return points.groupBy(*keys).agg(F.max_by(E.int_or_zero("valor"), F.col("seq")).alias("cantidad"))


def last_by_day(points: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Repeated days: the last point of the day wins, all its fields together."""
    return points.groupBy(*keys, "dia").agg(
        *[F.max_by(F.col(v), F.col("seq")).alias(v) for v in values])


# ---- J5 ----

def merge_daily_series(points: DataFrame) -> DataFrame:
    """Tagged daily series (``serie``) -> one row per (page, day), absent series = 0.

    Equivalent to a full outer join of the series on the day, done as one
    grouped aggregation (one shuffle instead of two joins).
    """
    return last_wins_pivot(points, ["plataforma", "pagina_id", "dia"], "serie",
                           F.col("valor"), IG_ACCOUNT_SERIES)
