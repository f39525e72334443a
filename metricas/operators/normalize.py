"""Per-platform item normalisers and filters.

Inputs are item frames as produced by ``metricas.sources`` (landing columns,
``seq`` and the item's fields as top-level columns). Outputs carry the T1
post columns plus the raw counters each platform supplies.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricas.functions import exprs as E

# ---- fixed values: LinkedIn post sources in the order they are tried ----
LINKEDIN_SOURCES = ["posts", "ugcPosts", "shares"]


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


# ---- F1 / F2 ----

def year_to_date(df: DataFrame, date_col: str, as_of) -> DataFrame:
    """keep rows dated on/after 1 January of ``as_of``'s year; a missing date drops the row."""
    return df.where(F.col(date_col) >= E.year_start(_lit_date(as_of)))


def lookback(df: DataFrame, date_col: str, lo, hi) -> DataFrame:
    """keep rows whose date is within [lo, hi] (both ends inclusive)."""
    return df.where(F.col(date_col).between(_lit_date(lo), _lit_date(hi)))


def lookback_window(as_of, platform: str) -> tuple[_dt.date, _dt.date]:
    """F2 bounds per platform: IG/TikTok as_of-29 .. as_of-1, LinkedIn as_of-60 .. as_of."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    if platform == "linkedin":
        return as_of - _dt.timedelta(days=60), as_of
    end = as_of - _dt.timedelta(days=1)
    return end - _dt.timedelta(days=28), end


# ---- P1: Facebook posts ----

def facebook_posts(items: DataFrame) -> DataFrame:
    first_att = F.get(F.col("attachments.data"), 0)
    return items.where(F.col("id").isNotNull()).select(  # F3
        "plataforma", "pagina_id", "seq",
        F.col("id").alias("publicacion_id"),
        F.col("permalink_url").alias("url_publicacion"),
        E.iso_instant("created_time").alias("fecha_hora_publicacion"),
        F.col("message").alias("texto_publicacion"),
        E.infer_format(first_att.getField("media_type"), F.col("status_type")).alias("formato"),
        E.iso_local_date("created_time").alias("dia"),
        E.int_or_zero("comments.summary.total_count").alias("comentarios"),
        E.int_or_zero("reactions.summary.total_count").alias("reacciones"),
        E.int_or_zero("shares.count").alias("compartidos"),
    )


# ---- P2: Instagram media ----

def instagram_media(items: DataFrame) -> DataFrame:
    """IG media rows; items without an id, or without a timestamp (the listing skips them), are dropped."""
    status = F.upper(F.coalesce(F.col("media_type"), F.lit("")))
    return items.where(E.nonempty("timestamp").isNotNull() & F.col("id").isNotNull()).select(
        "plataforma", "pagina_id", "seq",
        F.col("id").alias("publicacion_id"),
        F.col("permalink").alias("url_publicacion"),
        E.iso_instant("timestamp").alias("fecha_hora_publicacion"),
        F.col("caption").alias("texto_publicacion"),
        # no attachments.data for IG: only the status takes part in the format
        E.infer_format(F.lit(""), status).alias("formato"),
        E.iso_local_date("timestamp").alias("dia"),
        E.int_or_zero("like_count").alias("me_gusta"),
        E.int_or_zero("comments_count").alias("comentarios"),
        E.int_or_zero("video_view_count").alias("video_view_count"),
        E.int_or_zero("video_views").alias("video_views"),
    )


# ---- P3 / P4 / P5 / P7: LinkedIn ----

def _li_common(items: DataFrame, source: str, pid: Column, created: Column, text: Column,
               permalink: Column, media: Column, activity: Column) -> DataFrame:
    return items.select(
        "plataforma", "pagina_id", "seq", F.lit(source).alias("source"),
        pid.alias("publicacion_id"), created.cast("bigint").alias("created_ms"),
        text.alias("texto_publicacion"), permalink.alias("url_publicacion"),
        media.alias("media_type"), activity.alias("activity_urn"),
    ).where(E.nonzero("created_ms").isNotNull() & F.col("publicacion_id").isNotNull())  # F3


def linkedin_posts(items: DataFrame) -> DataFrame:
    """/posts items. id = urn or id; permalink = first of ``permalinks`` when it is a list."""
    plinks = F.col("permalinks")
    is_list = F.ltrim(plinks).startswith("[")
    return _li_common(
        items, "posts",
        E.or_strings("urn", "id"),
        F.coalesce(E.nonzero("createdAt.time"), F.col("lastModifiedAt.time")),
        F.col("commentary.text"),
        F.when(is_list, F.get_json_object(plinks, "$[0]")).otherwise(F.col("permalink")),
        E.or_strings(F.col("content.media.type"), F.lit("POST")),
        E.or_strings("associatedUrn", "activity", F.coalesce(F.col("urn"), F.lit(""))),
    )


def linkedin_ugc_posts(items: DataFrame) -> DataFrame:
    """/ugcPosts items. id = id or urn (reverse of P3); media = upper(media[0].status)."""
    sc = F.col("specificContent").getField("com.linkedin.ugc.ShareContent")
    first_media = F.get(sc.getField("media"), 0)
    media = F.when(F.size(F.coalesce(sc.getField("media"), F.array())) > 0,
                   F.upper(E.or_strings(first_media.getField("status"), F.lit("POST")))
                   ).otherwise(F.lit("POST"))
    return _li_common(
        items, "ugcPosts",
        E.or_strings("id", "urn"),
        F.coalesce(E.nonzero("created.time"), F.col("lastModifiedAt.time")),
        sc.getField("shareCommentary").getField("text"),
        F.lit(None).cast("string"),
        media,
        E.or_strings("lifecycleActivity", "activity", F.coalesce(F.col("urn"), F.lit(""))),
    )


def linkedin_shares(items: DataFrame) -> DataFrame:
    """P5: /shares items. Without an activity, a numeric id gives ``urn:li:activity:<id>``."""
    sid = F.coalesce(F.col("id"), F.lit(""))
    derived = F.when((sid != "") & E.is_digits(sid), F.concat(F.lit("urn:li:activity:"), sid)) \
        .otherwise(F.lit(""))
    return _li_common(
        items, "shares",
        E.or_strings("urn", "id"),
        F.coalesce(E.nonzero("created.time"), F.col("lastModified.time")),
        F.col("text.text"),
        F.col("permalink"),
        F.lit("POST"),
        F.coalesce(E.nonempty("activity"), derived),
    )


def linkedin_source_fallback(li_items: DataFrame, status: DataFrame) -> DataFrame:
    """Posts -> ugcPosts -> shares; the first source that completed ends the search.

    ``status`` has (pagina_id, source, ok). Rows of sources tried before the
    first successful one are kept (they were yielded before the failure);
    a page with no successful source yields nothing.
    """
    prio = F.array_position(F.array(*[F.lit(s) for s in LINKEDIN_SOURCES]), F.col("source"))
    cutoff = (status.where(F.col("ok")).groupBy("pagina_id")
              .agg(F.min(prio).alias("_cutoff")))
    # one row per page on the right: AQE broadcasts it where small, else splits a hot page
    return (li_items.join(cutoff, "pagina_id", "inner")
            .where(prio <= F.col("_cutoff")).drop("_cutoff"))


def linkedin_post_rows(li: DataFrame) -> DataFrame:
    """Normalised LinkedIn items -> T1 columns (+ UTC day, activity urn)."""
    status = F.upper(E.or_strings("media_type", F.lit("POST")))
    return li.select(
        "plataforma", "pagina_id", "seq", "publicacion_id", "url_publicacion",
        E.instant_of_millis("created_ms").alias("fecha_hora_publicacion"),
        "texto_publicacion",
        E.infer_format(F.lit(""), status).alias("formato"),
        E.utc_date_of_millis("created_ms").alias("dia"),
        "activity_urn",
    )


# ---- P6: TikTok videos ----

def tiktok_videos(items: DataFrame) -> DataFrame:
    """id = creative_id or id (dropped if neither). The year filter uses
    ``create_time or publish_time`` (``filter_time``) while the metric row is
    dated by ``publish_time or create_time`` (``dia``)."""
    vid = E.or_strings("creative_id", "id")
    dated_by = E.or_strings("publish_time", "create_time")
    return items.where(vid.isNotNull() & (vid != "")).select(
        "plataforma", "pagina_id", "seq",
        vid.alias("publicacion_id"),
        E.or_strings("share_url", "permalink").alias("url_publicacion"),
        E.epoch_or_iso_instant(dated_by).alias("fecha_hora_publicacion"),
        E.or_strings("caption", "title").alias("texto_publicacion"),
        F.lit("video").alias("formato"),
        E.epoch_or_iso_date(E.or_strings("create_time", "publish_time")).alias("filter_dia"),
        E.epoch_or_iso_date(dated_by).alias("dia"),
        E.int_or_zero("like_count").alias("like_count"),
        E.int_or_zero("comment_count").alias("comment_count"),
        E.int_or_zero("share_count").alias("share_count"),
        E.int_or_zero("view_count").alias("view_count"),
    )


# ---- P8: ad campaigns (inactive in the source system; kept for completeness) ----

def campaign_rows(items: DataFrame) -> DataFrame:
    return items.where(F.col("id").isNotNull()).select("plataforma", F.col("pagina_id").alias("cuenta_id"), "seq",
                        F.col("id").alias("campania_id"), F.col("name").alias("nombre_campania"))


def campaign_daily(points: DataFrame) -> DataFrame:
    """Daily ad insights; numbers come as text, NULL/empty -> 0. ``clicks`` is read, not stored.
    Days without a date or a campaign are dropped (F3)."""
    dated = E.iso_local_date("date_start").isNotNull() & F.col("campania_id").isNotNull()
    return points.where(dated).select(
        "plataforma", F.col("pagina_id").alias("cuenta_id"), "campania_id", "seq",
        E.iso_local_date("date_start").alias("fecha_descarga"),
        E.float_or_zero("spend").alias("presupuesto_invertido"),
        E.int_or_zero("impressions").alias("impresiones"),
        E.int_or_zero("reach").alias("alcance"),
        E.float_or_zero("cpm").alias("cpm"),
        E.float_or_zero("cpc").alias("cpc"),
        E.float_or_zero("ctr").alias("ctr"),
    )
