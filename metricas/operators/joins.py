"""Post x per-post counters -> daily metric rows.

The reference makes N+1 API/DB calls per post; here each lookup is one
equi-join on the post key. Lookup sides are reduced to one row per key
(last response wins) *before* the join, so no join multiplies rows, and
every join is keyed on the full post key so a hot page does not become a
hot join key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.functions import exprs as E
from metricas.operators.shape import latest_by_key

PK = S.POST_KEY


def daily_rows(df: DataFrame, **metrics: Column) -> DataFrame:
    """Project to the T2 column set (without deltas). Unnamed counters are 0, ctr NULL."""
    cols = [F.col(c) for c in PK] + [F.col("fecha_descarga")]
    for c in S.DAILY_COUNTERS[:3]:
        cols.append(metrics.get(c, F.lit(0)).cast("bigint").alias(c))
    cols.append(F.lit(None).cast("double").alias("tiempo_promedio_seg_numeric"))
    for c in S.DAILY_COUNTERS[3:]:
        cols.append(metrics.get(c, F.lit(0)).cast("bigint").alias(c))
    cols.append(metrics.get("ctr", F.lit(None)).cast("double").alias("ctr"))
    return df.select(*cols)


def _nz(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0).cast("bigint"))


def facebook_daily_metrics(posts: DataFrame, reactions: DataFrame, insights: DataFrame) -> DataFrame:
    """Post (P1) x reaction breakdown (A3, left) x daily insights (A1, inner).

    A post without insight days yields no row; post totals and reactions
    repeat on every day; guardados is 0; ctr from clicks / impressions.
    """
    p = latest_by_key(posts.select(*PK, "seq", "reacciones", "comentarios", "compartidos"), PK, drop_seq=True)
    df = (p.join(reactions, PK, "left")
          .join(insights.withColumnRenamed("dia", "fecha_descarga"), PK, "inner"))
    return daily_rows(
        df,
        visualizaciones=F.col("visualizaciones"), alcance=F.col("alcance"),
        impresiones=F.col("impresiones"),
        reacciones=F.col("reacciones"),
        me_gusta=_nz("me_gusta"), me_encanta=_nz("me_encanta"), me_divierte=_nz("me_divierte"),
        me_asombra=_nz("me_asombra"), me_entristece=_nz("me_entristece"), me_enoja=_nz("me_enoja"),
        comentarios=F.col("comentarios"), compartidos=F.col("compartidos"),
        clics_enlace=F.col("clics_enlace"),
        ctr=E.ctr(F.col("clics_enlace"), F.col("impresiones")),
    )


def instagram_media_metrics(media: DataFrame, insights: DataFrame) -> DataFrame:
    """Media (P2) left-join lifetime insights (A4); dated by the publication date."""
    m = latest_by_key(media.select(*PK, "seq", "dia", "me_gusta", "comentarios", "video_view_count", "video_views"), PK,
                      drop_seq=True)
    df = m.join(insights.withColumnRenamed("video_views", "ins_video_views"), PK, "left")
    views = E.or_numbers("video_view_count", "video_views", _nz("ins_video_views"))
    return daily_rows(
        df.withColumnRenamed("dia", "fecha_descarga"),
        visualizaciones=views, alcance=_nz("alcance"), impresiones=F.lit(0),
        reacciones=F.col("me_gusta"), me_gusta=F.col("me_gusta"),
        comentarios=F.col("comentarios"), compartidos=F.lit(0), guardados=_nz("guardados"),
    )


def linkedin_social_counts(actions: DataFrame) -> DataFrame:
    """Social-action responses -> (activity_urn, likes, comments, shares), last response wins.

    shares = totalShareStatistics or shares or 0; when any of the three is not
    a number (e.g. an object) all three are 0, as the reference fails before
    assigning any of them.
    """
    likes_raw = F.coalesce(F.col("likesSummary.totalLikes"), F.lit("0"))
    comments_raw = F.coalesce(F.col("commentsSummary.totalFirstLevelComments"), F.lit("0"))
    shares_raw = F.coalesce(_truthy_text("totalShareStatistics"), _truthy_text("shares"), F.lit("0"))
    read = actions.select("plataforma", F.col("entity_id").alias("activity_urn"), "seq",
                          E.int_or_none(likes_raw).alias("likes"), E.int_or_none(comments_raw).alias("comments"),
                          E.int_or_none(shares_raw).alias("shares"))
    return latest_by_key(_all_or_zero(read, ("likes", "comments", "shares")), ["plataforma", "activity_urn"],
                         drop_seq=True)


def _all_or_zero(df: DataFrame, counters) -> DataFrame:
    """Counters of a response, all 0 if one is NULL."""
    ok = reduce(Column.__and__, [F.col(c).isNotNull() for c in counters])
    return df.withColumns({c: F.when(ok, F.col(c)).otherwise(F.lit(0).cast("bigint")) for c in counters})


def _truthy_text(c: str) -> Column:
    """JSON text of a value that Python would treat as true (not null/0/""/{}/[]/false)."""
    v = F.trim(F.col(c))
    falsy = v.isin("0", "", "{}", "[]", "false", "null", "0.0") | v.isNull()
    return F.when(~falsy, v)


def linkedin_post_metrics(posts: DataFrame, counts: DataFrame) -> DataFrame:
    """LinkedIn posts (P7) left-join social counts on the activity urn (empty urn never matches).

    Posts without an activity urn join on a key that cannot match (built from
    the post id), so they spread over the join partitions instead of all
    hashing to one (a hot empty key).
    """
    p = latest_by_key(posts.select(*PK, "seq", "dia", "activity_urn"), PK, drop_seq=True)
    urn = F.coalesce(F.col("activity_urn"), F.lit(""))
    key = F.when(urn != "", urn).otherwise(F.concat(F.lit("\u0000none:"), F.col("pagina_id"),
                                                     F.lit("/"), F.col("publicacion_id")))
    c = counts.where(F.col("activity_urn") != "").withColumnRenamed("activity_urn", "_urn_key")
    df = p.withColumn("_urn_key", key).join(c, ["plataforma", "_urn_key"], "left")
    return daily_rows(
        df.withColumnRenamed("dia", "fecha_descarga"),
        reacciones=_nz("likes"), me_gusta=_nz("likes"),
        comentarios=_nz("comments"), compartidos=_nz("shares"),
    )


# ---- fixed values: counters of a video insights response ----
TT_INSIGHTS = ("views", "likes", "comments", "shares", "saves", "reach")


def tiktok_video_metrics(videos: DataFrame, insights: DataFrame) -> DataFrame:
    """Videos (P6) left-join video insights; each counter is the listing value if
    non-zero, else the insight value; reach and saves come from insights only.

    An insights response with any counter that is not a number counts as no
    response (all six 0), as the reference discards it whole.
    """
    v = latest_by_key(videos.select(*PK, "seq", "dia", "like_count", "comment_count", "share_count", "view_count"), PK,
                      drop_seq=True)
    read = insights.select(*PK, "seq", *[E.int_or_none(F.coalesce(_truthy_text(c), F.lit("0"))).alias(f"i_{c}")
                                         for c in TT_INSIGHTS])
    ins = latest_by_key(_all_or_zero(read, [f"i_{c}" for c in TT_INSIGHTS]), PK, drop_seq=True)
    df = v.join(ins, PK, "left")
    likes = E.or_numbers("like_count", _nz("i_likes"))
    return daily_rows(
        df.withColumnRenamed("dia", "fecha_descarga"),
        visualizaciones=E.or_numbers("view_count", _nz("i_views")),
        alcance=_nz("i_reach"),
        reacciones=likes, me_gusta=likes,
        comentarios=E.or_numbers("comment_count", _nz("i_comments")),
        compartidos=E.or_numbers("share_count", _nz("i_shares")),
        guardados=_nz("i_saves"),
    )
