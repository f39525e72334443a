"""Per-platform jobs composed from the operators.

Each job takes item frames (as produced by ``metricas.sources``) and an
explicit ``as_of`` date, and returns target-table frames. Nothing is
collected; the caller decides whether to merge them into stored tables
(``metricas.sources.tables``) or inspect them.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.functions import exprs as E
from metricas.operators import deltas as D
from metricas.operators import joins as J
from metricas.operators import merge as K
from metricas.operators import normalize as N
from metricas.operators import shape as A

# ---- fixed values: follower-demographic series and the T4 column each fills ----
FB_AUDIENCE_SERIES = {"page_fans_gender_age": "genero", "page_fans_country": "pais",
                      "page_fans_city": "ciudad"}
BUCKET_COLUMN = {"city": "ciudad", "country": "pais", "gender": "genero", "age": "genero"}


def _date(d) -> _dt.date:
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


def _bucket_rows(df: DataFrame, as_of, dim_col: str = "dim", name_col: str = "name",
                 qty_col: str = "cantidad", seq_col: str | None = None) -> DataFrame:
    """(dim, name, qty) buckets -> T4 rows; age buckets go to ``genero`` as ``AGE.<k>``."""
    dim = F.col(dim_col)
    target = F.coalesce(*[F.when(dim == k, F.lit(v)) for k, v in BUCKET_COLUMN.items()])
    key = F.when(dim == "age", E.age_tag(F.col(name_col))).otherwise(F.col(name_col))
    rows = df.select("plataforma", "pagina_id", F.lit(_date(as_of)).alias("_as_of"),
                     target.alias("_dim"), key.alias("_key"), F.col(qty_col).alias("_qty"),
                     *([F.col(seq_col).alias("seq")] if seq_col else []))
    return K.segment_rows(rows.where(F.col("_dim").isNotNull()), "_as_of", "_dim", "_key", "_qty")


# ---------------- Facebook ----------------

def facebook_post_ingest(post_items: DataFrame, reaction_items: DataFrame,
                         insight_points: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """L1: posts since 1 January (F1) -> T1 rows and T2 rows (J1, before deltas).

    ``reaction_items``: (plataforma, pagina_id, publicacion_id, tipo, total_count, seq);
    ``insight_points``: (plataforma, pagina_id, publicacion_id, name, end_time, value, seq).
    """
    posts = N.year_to_date(N.facebook_posts(post_items), "dia", as_of)
    rx = A.reaction_breakdown(reaction_items)
    ins = A.daily_post_insights(insight_points)
    return posts, J.facebook_daily_metrics(posts, rx, ins)


def facebook_page_week(points: DataFrame) -> DataFrame:
    """Page week insights (A2) -> T3 rows, one per week end date sent by the API."""
    weeks = A.page_week_pivot(points).withColumnRenamed("dia", "fecha_corte")
    return K.conform(K.weekly_stats_rows(weeks), S.T3_WEEKLY)


def facebook_audience(points: DataFrame) -> DataFrame:
    """G1: three demographic series -> latest point per ISO week (A5) -> one T4 row per map entry.

    ``points``: (plataforma, pagina_id, serie, end_time, value MAP, seq). The week's
    latest point is chosen first; an empty map there yields no rows for the week.
    Rows are dated by the point's own date.
    """
    pts = points.withColumn("dia", E.iso_local_date("end_time")).where(F.col("dia").isNotNull())
    latest = A.latest_per_iso_week(pts, ["plataforma", "pagina_id", "serie"], "dia", ["value", "seq"])
    entries = latest.select("plataforma", "pagina_id", "serie", "dia", "seq",
                            F.explode(F.col("value")).alias("clave", "qty"))
    col = F.coalesce(*[F.when(F.col("serie") == k, F.lit(v)) for k, v in FB_AUDIENCE_SERIES.items()])
    rows = entries.select("plataforma", "pagina_id", "dia", "seq", col.alias("_dim"), "clave",
                          E.int_or_zero("qty").alias("qty"))
    return K.insert_ignore(None, K.segment_rows(rows.where(F.col("_dim").isNotNull()),
                                                "dia", "_dim", "clave", "qty"), S.SEGMENT_KEY)


# ---------------- Instagram ----------------

def instagram_media_ingest(media_items: DataFrame, insight_items: DataFrame,
                           as_of) -> tuple[DataFrame, DataFrame]:
    """L1 for IG: media since 1 January -> T1 rows and T2 rows (J2), dated by publication.

    ``insight_items``: (plataforma, pagina_id, publicacion_id, name, values, seq).
    """
    media = N.year_to_date(N.instagram_media(media_items), "dia", as_of)
    ins = A.lifetime_last_value(insight_items)
    return media, J.instagram_media_metrics(media, ins)


def instagram_account_week(points: DataFrame, as_of) -> DataFrame:
    """Reach / follower_count / profile_views daily series -> T3 rows.

    ``points``: (plataforma, pagina_id, serie, end_time, value, seq); ``value`` is an
    int or ``{"value": int}``. profile_views is merged but not stored.
    """
    lo, hi = N.lookback_window(as_of, "instagram")
    pts = points.select("plataforma", "pagina_id", "serie", "seq",
                        E.iso_local_date("end_time").alias("dia"),
                        E.scalar_or_value_struct("value").alias("valor"))
    days = A.merge_daily_series(N.lookback(pts, "dia", lo, hi))
    weeks = A.latest_per_iso_week(days, ["plataforma", "pagina_id"], "dia",
                                  ["reach", "follower_count"], seq_col="dia")
    return K.conform(weeks.select("plataforma", "pagina_id", F.col("dia").alias("fecha_corte_semana"),
                                  F.col("follower_count").alias("total_seguidores"),
                                  F.col("reach").alias("alcance_pagina"),
                                  F.lit(0).alias("visualizaciones_pagina")), S.T3_WEEKLY)


def instagram_audience(responses: DataFrame, as_of) -> DataFrame:
    """Follower demographics per requested dimension (``variant``) -> T4 rows dated ``as_of``.

    ``responses`` holds ``data[0]`` of each response: (plataforma, pagina_id, variant, seq,
    breakdowns, values). With breakdowns, entries of the matching dimension (F4) are
    read; otherwise the legacy map ``values[-1].value[dim]``. Repeated names are summed (A7)
    within the latest response of each (page, dimension): one response answers one request.
    """
    responses = A.latest_by_key(responses, ["plataforma", "pagina_id", "variant"])
    has_bk = F.size(F.coalesce(F.col("breakdowns"), F.array())) > 0
    bk = (responses.where(has_bk)
          .select("plataforma", "pagina_id", "variant", "seq", F.explode("breakdowns").alias("b"))
          .where(F.lower(F.coalesce(F.col("b.dimension"), F.lit(""))) == F.col("variant"))
          .select("plataforma", "pagina_id", "variant", "seq", F.explode("b.values").alias("v"))
          .select("plataforma", "pagina_id", "variant",
                  E.or_strings("v.name", "v.value").alias("name"),
                  E.scalar_or_value_struct("v.value").alias("valor")))
    legacy_map = F.try_element_at(F.col("values"), F.lit(-1)).getField("value")
    legacy = (responses.where(~has_bk)
              .select("plataforma", "pagina_id", "variant",
                      F.explode(F.try_element_at(legacy_map, F.col("variant"))).alias("name", "valor")))
    buckets = A.sum_by_bucket(bk.unionByName(legacy).where(F.col("name").isNotNull()),
                              ["plataforma", "pagina_id", "variant", "name"])
    return _bucket_rows(buckets, as_of, dim_col="variant")


# ---------------- LinkedIn ----------------

def linkedin_posts(post_items: DataFrame | None, ugc_items: DataFrame | None,
                   share_items: DataFrame | None, status: DataFrame, as_of) -> DataFrame:
    """P3-P5 + U2 + F1 + P7: LinkedIn items of the three sources -> T1-shaped rows
    (plus ``dia`` and ``activity_urn``)."""
    parts = []
    if post_items is not None:
        parts.append(N.linkedin_posts(post_items))
    if ugc_items is not None:
        parts.append(N.linkedin_ugc_posts(ugc_items))
    if share_items is not None:
        parts.append(N.linkedin_shares(share_items))
    li = reduce(DataFrame.unionByName, parts)
    li = N.linkedin_source_fallback(li, status)
    rows = N.linkedin_post_rows(li)
    return N.year_to_date(rows, "dia", as_of)


def linkedin_post_ingest(post_items, ugc_items, share_items, status: DataFrame,
                         social_actions: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """L1 for LinkedIn: -> T1 rows and T2 rows (J3), dated by the UTC publication date."""
    posts = linkedin_posts(post_items, ugc_items, share_items, status, as_of)
    counts = J.linkedin_social_counts(social_actions)
    return posts, J.linkedin_post_metrics(posts, counts)


def linkedin_account_week(elements: DataFrame, as_of) -> DataFrame:
    """Daily follower statistics -> T3 rows (followers only)."""
    lo, hi = N.lookback_window(as_of, "linkedin")
    end = F.col("timeRange.end")
    pts = elements.where(E.nonzero(end).isNotNull()).select(
        "plataforma", "pagina_id", "seq", E.utc_date_of_millis(end).alias("dia"),
        E.int_or_zero(F.coalesce(F.col("followerCounts.organicFollowerCount"),
                                 F.col("followerGains.organicFollowerGain"))).alias("valor"))
    days = A.last_by_day(N.lookback(pts, "dia", lo, hi), ["plataforma", "pagina_id"], ["valor"])
    weeks = A.latest_per_iso_week(days, ["plataforma", "pagina_id"], "dia", ["valor"], seq_col="dia")
    return K.conform(weeks.select("plataforma", "pagina_id", F.col("dia").alias("fecha_corte_semana"),
                                  F.col("valor").alias("total_seguidores"),
                                  F.lit(0).alias("alcance_pagina"),
                                  F.lit(0).alias("visualizaciones_pagina")), S.T3_WEEKLY)


def linkedin_audience(elements: DataFrame, as_of) -> DataFrame:
    """Followers by country -> latest per (org, country) (A6) -> T4 rows dated ``as_of``.

    The country is upper-cased after grouping, so ``us`` and ``US`` collide in
    the insert-ignore; the variant seen first in the input wins.
    """
    lo, hi = N.lookback_window(as_of, "linkedin")
    country = E.or_strings(F.col("followerCountsByCountry.country"), F.col("country"),
                           F.col("aggregations.country"))
    end = F.col("timeRange.end")
    pts = elements.select(
        "plataforma", "pagina_id", "seq", country.alias("country"),
        E.utc_date_of_millis(end).alias("dia"),
        F.coalesce(E.nonzero(E.int_or_none("followerCountsByCountry.followerCount")),
                   E.nonzero(F.col("followerCounts.organicFollowerCount")),
                   F.lit(0).cast("bigint")).alias("valor"),
    ).where(E.nonempty("country").isNotNull() & E.nonzero(end).isNotNull())
    latest = A.latest_per_country(N.lookback(pts, "dia", lo, hi))
    rows = latest.select("plataforma", "pagina_id", F.lit("country").alias("dim"),
                         F.upper("country").alias("name"), F.col("valor").alias("cantidad"), "first_seq")
    return K.insert_ignore(None, _bucket_rows(rows, as_of, seq_col="first_seq"), S.SEGMENT_KEY)


# ---------------- TikTok ----------------

def tiktok_video_ingest(video_items: DataFrame, insight_items: DataFrame,
                        as_of) -> tuple[DataFrame, DataFrame]:
    """L1 for TikTok: videos since 1 January (by create time) -> T1 rows and T2 rows.

    ``insight_items``: (plataforma, pagina_id, publicacion_id, views, likes, comments,
    shares, saves, reach, seq).
    """
    videos = N.year_to_date(N.tiktok_videos(video_items), "filter_dia", as_of)
    return videos, J.tiktok_video_metrics(videos, insight_items)


def tiktok_account_week(points: DataFrame, as_of) -> DataFrame:
    """Daily account values -> T3 rows: visualizaciones_pagina = views, followers, alcance 0.

    A point is dated by ``end_time or date or yesterday``; a later point of the
    same day replaces the whole day (A9).
    """
    lo, hi = N.lookback_window(as_of, "tiktok")
    when = E.or_strings("end_time", "date", F.lit(hi.isoformat()))
    pts = points.select("plataforma", "pagina_id", "seq", E.epoch_or_iso_date(when).alias("dia"),
                        E.int_or_zero("value.views").alias("views"),
                        E.int_or_zero("value.followers").alias("followers"))
    days = A.last_by_day(N.lookback(pts, "dia", lo, hi), ["plataforma", "pagina_id"],
                         ["views", "followers"])
    weeks = A.latest_per_iso_week(days, ["plataforma", "pagina_id"], "dia", ["views", "followers"],
                                  seq_col="dia")
    return K.conform(weeks.select("plataforma", "pagina_id", F.col("dia").alias("fecha_corte_semana"),
                                  F.col("followers").alias("total_seguidores"),
                                  F.lit(0).alias("alcance_pagina"),
                                  F.col("views").alias("visualizaciones_pagina")), S.T3_WEEKLY)


def tiktok_audience(buckets: DataFrame, as_of) -> DataFrame:
    """Audience buckets (dim, name, count, seq) -> last wins per name (A8) -> T4 rows."""
    last = A.last_by_bucket(buckets.withColumnRenamed("count", "valor"),
                            ["plataforma", "pagina_id", "dim", "name"])
    return _bucket_rows(last, as_of)


# ---------------- all platforms ----------------

def union_platforms(*frames: DataFrame) -> DataFrame:
    """Every job writes the same tables, told apart by ``plataforma``."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def recompute_daily_deltas(daily: DataFrame) -> DataFrame:
    """L3 / K5: recompute the six deltas over the whole daily table (first row NULL)."""
    return D.recompute_deltas(daily)
