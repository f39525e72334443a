"""Fixture rows -> API-shaped item frames, as ``metricas.sources`` would produce them.

Counters are passed as text, the way ``schemas`` declares them, so the
library's own parsing rules (int_or_zero, scalar_or_value_struct...) are what
the oracle checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricas.functions import exprs as E


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def fb_post_items(fc: DataFrame, pagina_id: str = "page_fb") -> DataFrame:
    return fc.select(
        F.lit("facebook").alias("plataforma"), F.lit(pagina_id).alias("pagina_id"), "seq",
        F.col("publicacion_id").alias("id"), "created_time", "message", "permalink_url", "status_type",
        F.struct(F.array(F.struct(F.col("media_type").alias("media_type"),
                                  F.lit(None).cast("string").alias("unshimmed_url"))).alias("data")
                 ).alias("attachments"),
        F.lit(None).cast("struct<count:string>").alias("shares"),
        F.struct(F.struct(_s("comentarios").alias("total_count")).alias("summary")).alias("comments"),
        F.struct(F.struct(_s("reacciones").alias("total_count")).alias("summary")).alias("reactions"),
    )


def fb_reaction_items(fd: DataFrame, pagina_id: str = "page_fb", platform: str = "facebook") -> DataFrame:
    return fd.select(F.lit(platform).alias("plataforma"), F.lit(pagina_id).alias("pagina_id"),
                     "publicacion_id", "tipo", _s("total_count").alias("total_count"), "seq")


def fb_insight_points(fb: DataFrame, pagina_id: str | None = None, rename=None) -> DataFrame:
    name = F.col("name") if rename is None else rename(F.col("name"))
    page = F.col("pagina_id") if pagina_id is None else F.lit(pagina_id)
    return fb.select(F.lit("facebook").alias("plataforma"), page.alias("pagina_id"), "publicacion_id",
                     name.alias("name"), "end_time", _s("value").alias("value"), "seq")


def ig_media_items(fc: DataFrame, pagina_id: str = "page_ig") -> DataFrame:
    return fc.select(
        F.lit("instagram").alias("plataforma"), F.lit(pagina_id).alias("pagina_id"), "seq",
        F.col("publicacion_id").alias("id"), F.col("message").alias("caption"),
        F.lower(F.coalesce("media_type", F.lit(""))).alias("media_type"),
        F.lit(None).cast("string").alias("media_url"), F.col("permalink_url").alias("permalink"),
        F.col("created_time").alias("timestamp"), _s("reacciones").alias("like_count"),
        _s("comentarios").alias("comments_count"), _s("video_view_count").alias("video_view_count"),
        _s("video_views").alias("video_views"))


IG_INSIGHT_NAME = {"LIKE": "reach", "LOVE": "saved", "HAHA": "video_views"}


def ig_insight_items(fd: DataFrame, pagina_id: str = "page_ig") -> DataFrame:
    name = F.coalesce(*[F.when(F.col("tipo") == k, F.lit(v)) for k, v in IG_INSIGHT_NAME.items()],
                      F.lit("other"))
    tc = F.col("total_count")
    values = F.when(tc % 10 == 0, F.array().cast("array<struct<value:string>>")).otherwise(
        F.array(F.struct(_s(F.floor(tc / 2)).alias("value")), F.struct(_s(tc).alias("value"))))
    return fd.select(F.lit("instagram").alias("plataforma"), F.lit(pagina_id).alias("pagina_id"),
                     "publicacion_id", name.alias("name"), values.alias("values"), "seq")


def _li_media_type(status: Column) -> Column:
    return F.when(status == "P", F.lit("VIDEO")).when(status == "F", F.lit("IMAGE"))


def li_items(fe: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F-E rows -> (posts items, ugcPosts items, shares items)."""
    base = [F.lit("linkedin").alias("plataforma"), "pagina_id", "seq"]
    text = F.concat(F.lit("texto "), F.col("id"))
    seq4 = F.col("seq") % 4
    permalinks = (F.when(seq4 <= 1, F.concat(F.lit('["https://www.linkedin.com/feed/update/'), F.col("id"),
                                              F.lit('"]')))
                  .when(seq4 == 2, F.lit("[]")))
    posts = fe.where(F.col("source") == "posts").select(
        *base, "urn", "id",
        F.struct(F.col("created_ms").alias("time")).alias("createdAt"),
        F.struct(F.col("modified_ms").alias("time")).alias("lastModifiedAt"),
        F.struct(text.alias("text")).alias("commentary"),
        permalinks.alias("permalinks"),
        F.concat(F.lit("https://lnkd.in/"), F.col("id")).alias("permalink"),
        F.struct(F.struct(_li_media_type(F.col("media_status")).alias("type")).alias("media")).alias("content"),
        F.col("activity").alias("associatedUrn"), F.lit(None).cast("string").alias("activity"))
    media = (F.when(F.col("media_status") == "O", F.array().cast("array<struct<status:string>>"))
             .when(F.col("media_status") == "F", F.array(F.struct(F.lit("ready").alias("status"))))
             .otherwise(F.array(F.struct(F.lit(None).cast("string").alias("status")))))
    ugc = fe.where(F.col("source") == "ugcPosts").select(
        *base, "id", "urn",
        F.struct(F.col("created_ms").alias("time")).alias("created"),
        F.struct(F.col("modified_ms").alias("time")).alias("lastModifiedAt"),
        F.struct(F.struct(F.struct(text.alias("text")).alias("shareCommentary"), media.alias("media"))
                 .alias("com.linkedin.ugc.ShareContent")).alias("specificContent"),
        F.col("activity").alias("lifecycleActivity"), F.lit(None).cast("string").alias("activity"))
    shares = fe.where(F.col("source") == "shares").select(
        *base, "urn", "id",
        F.struct(F.col("created_ms").alias("time")).alias("created"),
        F.struct(F.col("modified_ms").alias("time")).alias("lastModified"),
        F.struct(text.alias("text")).alias("text"),
        F.concat(F.lit("https://lnkd.in/"), F.col("id")).alias("permalink"), "activity")
    return posts, ugc, shares


def li_source_status(fe: DataFrame) -> DataFrame:
    """Which LinkedIn source completed per org: org k%3==0 posts; k%3==1 ugcPosts;
    else shares, except org 8 where every source failed."""
    k = F.substring(F.col("pagina_id"), 5, 10).cast("int")
    orgs = fe.select("pagina_id").distinct().select("pagina_id", k.alias("k"))
    src = orgs.select("pagina_id", "k", F.explode(F.array(F.lit("posts"), F.lit("ugcPosts"),
                                                          F.lit("shares"))).alias("source"))
    ok = (F.when(F.col("source") == "posts", F.col("k") % 3 == 0)
          .when(F.col("source") == "ugcPosts", F.col("k") % 3 == 1)
          .otherwise(F.col("k") != 8))
    return src.select("pagina_id", "source", ok.alias("ok"))


def li_social_actions(fd: DataFrame) -> DataFrame:
    tc = F.col("total_count")
    tss = (F.when(tc % 7 == 0, F.lit('{"shareCount": 2}')).when(tc % 7 == 1, F.lit(None).cast("string"))
           .otherwise(_s(tc % 5)))
    return fd.select(
        F.lit("linkedin").alias("plataforma"),
        F.concat(F.lit("urn:li:activity:"), F.substring(F.col("publicacion_id"), 6, 30)).alias("entity_id"),
        "seq",
        F.struct(_s(tc).alias("totalLikes")).alias("likesSummary"),
        F.struct(_s((tc * 3) % 11).alias("totalFirstLevelComments")).alias("commentsSummary"),
        tss.alias("totalShareStatistics"), F.lit("1").alias("shares"))


def tt_video_items(ff: DataFrame) -> DataFrame:
    return ff.select(
        F.lit("tiktok").alias("plataforma"), "pagina_id", "seq", "creative_id",
        F.lit(None).cast("string").alias("id"), "create_time", "publish_time",
        F.concat(F.lit("video "), F.col("seq").cast("string")).alias("caption"),
        F.lit(None).cast("string").alias("title"),
        F.concat(F.lit("https://tt.example/v/"), F.col("seq").cast("string")).alias("share_url"),
        F.lit(None).cast("string").alias("permalink"),
        _s("like_count").alias("like_count"), _s("comment_count").alias("comment_count"),
        _s("share_count").alias("share_count"), _s("view_count").alias("view_count"))


def tt_insight_items(ff: DataFrame) -> DataFrame:
    return ff.where(F.col("creative_id").isNotNull()).select(
        F.lit("tiktok").alias("plataforma"), "pagina_id", F.col("creative_id").alias("publicacion_id"), "seq",
        *[_s(f"insight_{c}").alias(c) for c in ("views", "likes", "comments", "shares", "saves", "reach")])


def ig_account_points(fg: DataFrame) -> DataFrame:
    value = F.when(F.col("serie") == "profile_views",
                   F.concat(F.lit('{"value": '), _s("valor"), F.lit("}"))).otherwise(_s("valor"))
    return fg.select(F.lit("instagram").alias("plataforma"), "pagina_id", "serie", "seq",
                     F.concat(_s("dia"), F.lit("T07:00:00+0000")).alias("end_time"), value.alias("value"))


def li_follower_elements(fg: DataFrame) -> DataFrame:
    end_ms = (F.unix_date("dia").cast("bigint") + 1) * E.MS_PER_DAY - 1
    return fg.select(
        F.lit("linkedin").alias("plataforma"), "pagina_id", "seq",
        F.struct(end_ms.alias("end")).alias("timeRange"),
        F.struct(F.when(F.col("serie") == "follower_count", F.col("valor")).alias("organicFollowerCount"))
        .alias("followerCounts"),
        F.struct(F.when(F.col("serie") == "reach", F.col("valor")).alias("organicFollowerGain"))
        .alias("followerGains"))


def tt_account_points(fg: DataFrame) -> DataFrame:
    even = F.col("seq") % 2 == 0
    return fg.select(
        F.lit("tiktok").alias("plataforma"), "pagina_id", "seq",
        F.when(even, F.concat(_s("dia"), F.lit("T00:00:00Z"))).alias("end_time"),
        F.when(~even, _s("dia")).alias("date"),
        F.struct(F.when(F.col("serie") == "reach", _s("valor")).alias("views"),
                 F.when(F.col("serie") == "follower_count", _s("valor")).alias("followers"),
                 F.when(F.col("serie") == "profile_views", _s("valor")).alias("profile_views")).alias("value"))


def ig_demographic_responses(fh: DataFrame) -> DataFrame:
    """One IG demographics response (``data[0]``) per (page, dimension asked): a
    breakdown whose values are the F-H rows. Every 10th entry is filed under another
    dimension (dropped by F4); even seq spells the dimension in upper case."""
    dimension = (F.when(F.col("seq") % 10 == 0, F.lit("other"))
                 .when(F.col("seq") % 2 == 0, F.upper("dim")).otherwise(F.col("dim")))
    entries = fh.select("pagina_id", F.col("dim").alias("variant"), "seq", dimension.alias("dimension"),
                        F.struct(F.col("name").alias("name"), _s("cantidad").alias("value")).alias("v"))
    # a real response groups entries per dimension; here each entry is a breakdown of its own.
    # A page has at most 200 rows of F-H, so a response is bounded
    breakdown = F.struct(F.col("dimension").alias("dimension"), F.array("v").alias("values"))
    return (entries.groupBy("pagina_id", "variant").agg(F.collect_list(breakdown).alias("breakdowns"),
                                                        F.max("seq").alias("seq"))
            .select(F.lit("instagram").alias("plataforma"), "pagina_id", "variant", "seq", "breakdowns",
                    F.lit(None).cast("array<struct<value:map<string,map<string,string>>>>").alias("values")))


def tt_audience_buckets(fh: DataFrame) -> DataFrame:
    return fh.select(F.lit("tiktok").alias("plataforma"), "pagina_id", "dim", "name",
                     _s("cantidad").alias("count"), "seq")


FB_SERIES_BY_DAY = ["page_fans_gender_age", "page_fans_country", "page_fans_city"]


def fb_demographic_points(fk: DataFrame) -> DataFrame:
    """F-K folded to one map per (page, day); the day picks the series (day-of-month % 3)."""
    serie = F.element_at(F.array(*[F.lit(s) for s in FB_SERIES_BY_DAY]),
                         (F.dayofmonth("dia") % 3 + 1).cast("int"))
    entry = F.when(F.col("clave").isNotNull(), F.struct(F.col("clave"), _s("cantidad")))
    pts = (fk.groupBy("pagina_id", "dia")
           .agg(F.map_from_entries(F.filter(F.collect_list(entry), lambda x: x.isNotNull())).alias("value"),
                F.max("seq").alias("seq")))
    return pts.select(F.lit("facebook").alias("plataforma"), "pagina_id", serie.alias("serie"),
                      F.concat(_s("dia"), F.lit("T08:00:00+0000")).alias("end_time"), "value", "seq")


def li_country_elements(fk: DataFrame) -> DataFrame:
    where = F.col("seq") % 3
    end_ms = (F.unix_date("dia").cast("bigint") + 1) * E.MS_PER_DAY - 1
    fcount = F.when(F.col("seq") % 4 == 0, F.lit("0")).otherwise(_s("cantidad"))
    return fk.select(
        F.lit("linkedin").alias("plataforma"), "pagina_id", "seq",
        F.struct(end_ms.alias("end")).alias("timeRange"),
        F.struct((F.col("cantidad") + 1).alias("organicFollowerCount")).alias("followerCounts"),
        F.struct(F.when(where == 0, F.col("clave")).alias("country"), fcount.alias("followerCount"))
        .alias("followerCountsByCountry"),
        F.when(where == 1, F.col("clave")).alias("country"),
        F.struct(F.when(where == 2, F.col("clave")).alias("country")).alias("aggregations"))
