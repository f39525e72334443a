"""Landed API pages -> job inputs -> table rows, per platform (L1, L2).

Landing conventions (``endpoint`` values of ``schemas.LANDED_PAGE``):

  facebook   posts (data[] of posts) | reactions (root summary; entity_id = post,
             variant = reaction type) | post_insights (data[] series; entity_id = post)
             | page_insights (data[] series) | page_demographics (data[] series of maps)
             | campaigns (data[]; pagina_id = ad account) | campaign_insights (data[] days;
             entity_id = campaign)
  instagram  media | media_insights (entity_id = media) | account_insights (data[] series)
             | demographics (data[0]; variant = breakdown dimension asked for)
  linkedin   posts | ugcPosts | shares (elements[]) | source_status (root {source, ok})
             | socialActions (root; entity_id = activity urn) | follower_statistics
             | follower_countries (elements[])
  tiktok     videos (data.creatives[] else data.items[]) | video_insights (data.insights;
             entity_id = video) | account_insights (data.values[]) | audience (data.by_*)

Every adapter returns a dict of frames named after the target tables (``only`` limits
which ones are built).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.operators import merge as K
from metricas.operators import normalize as N
from metricas.plans import jobs
from metricas.sources import landing as L

# ---- fixed values: TikTok audience lists and the bucket dimension of each ----
TT_AUDIENCE_LISTS = [("by_city", "city"), ("by_country", "country"), ("by_gender", "gender"),
                     ("by_age", "age")]


def _ep(pages: DataFrame, endpoint: str) -> DataFrame:
    return pages.where(F.col("endpoint") == endpoint)


POSTS, DAILY, WEEKLY, SEGMENTS = ("publicaciones", "metricas_publicaciones_diarias",
                                  "estadisticas_pagina_semanal", "segmentacion_seguidores_semanal")
CAMPAIGNS, CAMPAIGN_DAILY = "campanias", "metricas_campanias_diarias"  # Facebook only
TABLES = (POSTS, DAILY, WEEKLY, SEGMENTS)


def _wants(only):
    return lambda *names: only is None or any(n in only for n in names)


def facebook(pages: DataFrame, as_of, only=None) -> dict[str, DataFrame]:
    want, out = _wants(only), {}
    if want(POSTS, DAILY):
        post_items = L.graph_page_items(_ep(pages, "posts"), S.FB_POST)
        reactions = L.page_object(_ep(pages, "reactions"), S.FB_REACTION_SUMMARY).select(
            "plataforma", "pagina_id", F.col("entity_id").alias("publicacion_id"),
            F.upper("variant").alias("tipo"), F.col("summary.total_count").alias("total_count"), "seq")
        insights = L.series_points(L.graph_page_items(_ep(pages, "post_insights"), S.FB_SERIES)).select(
            "plataforma", "pagina_id", F.col("entity_id").alias("publicacion_id"), "name", "end_time",
            "value", "seq")
        posts, daily = jobs.facebook_post_ingest(post_items, reactions, insights, as_of)
        out.update({POSTS: K.post_rows(posts), DAILY: daily})
    if want(WEEKLY):
        page_pts = L.series_points(L.graph_page_items(_ep(pages, "page_insights"), S.FB_SERIES))
        out[WEEKLY] = jobs.facebook_page_week(page_pts)
    if want(SEGMENTS):
        demo = L.series_points(L.graph_page_items(_ep(pages, "page_demographics"), S.FB_DEMOGRAPHICS)) \
            .withColumnRenamed("name", "serie")
        out[SEGMENTS] = jobs.facebook_audience(demo)
    if want(CAMPAIGNS):
        out[CAMPAIGNS] = N.campaign_rows(L.graph_page_items(_ep(pages, "campaigns"), S.CAMPAIGN))
    if want(CAMPAIGN_DAILY):
        days = L.graph_page_items(_ep(pages, "campaign_insights"), S.CAMPAIGN_DAY)
        out[CAMPAIGN_DAILY] = N.campaign_daily(days.withColumnRenamed("entity_id", "campania_id"))
    return {k: v for k, v in out.items() if only is None or k in only}


def instagram(pages: DataFrame, as_of, only=None) -> dict[str, DataFrame]:
    want, out = _wants(only), {}
    if want(POSTS, DAILY):
        media = L.graph_page_items(_ep(pages, "media"), S.IG_MEDIA)
        ins = L.graph_page_items(_ep(pages, "media_insights"), S.IG_INSIGHT).select(
            "plataforma", "pagina_id", F.col("entity_id").alias("publicacion_id"), "name", "values", "seq")
        posts, daily = jobs.instagram_media_ingest(media, ins, as_of)
        out.update({POSTS: K.post_rows(posts), DAILY: daily})
    if want(WEEKLY):
        account = L.series_points(L.graph_page_items(_ep(pages, "account_insights"), S.IG_ACCOUNT_SERIES)) \
            .withColumnRenamed("name", "serie")
        out[WEEKLY] = jobs.instagram_account_week(account, as_of)
    if want(SEGMENTS):
        demo_first = L.page_object(_ep(pages, "demographics"), f"data ARRAY<STRUCT<{S.IG_DEMOGRAPHICS}>>")
        responses = demo_first.select("plataforma", "pagina_id", F.lower("variant").alias("variant"), "seq",
                                      F.get(F.col("data"), 0).alias("d")).where(F.col("d").isNotNull()) \
            .select("plataforma", "pagina_id", "variant", "seq", "d.breakdowns", "d.values")
        out[SEGMENTS] = jobs.instagram_audience(responses, as_of)
    return {k: v for k, v in out.items() if only is None or k in only}


def linkedin(pages: DataFrame, as_of, only=None) -> dict[str, DataFrame]:
    want, out = _wants(only), {}
    if want(POSTS, DAILY):
        items = {src: L.offset_page_items(_ep(pages, src), ddl) for src, ddl in
                 (("posts", S.LI_POST), ("ugcPosts", S.LI_UGC_POST), ("shares", S.LI_SHARE))}
        status = L.page_object(_ep(pages, "source_status"), "source STRING, ok BOOLEAN") \
            .select("pagina_id", "source", F.coalesce("ok", F.lit(False)).alias("ok"))
        social = L.page_object(_ep(pages, "socialActions"), S.LI_SOCIAL_ACTIONS)
        posts, daily = jobs.linkedin_post_ingest(items["posts"], items["ugcPosts"], items["shares"],
                                                 status, social, as_of)
        out.update({POSTS: K.post_rows(posts), DAILY: daily})
    if want(WEEKLY):
        followers = L.offset_page_items(_ep(pages, "follower_statistics"), S.LI_FOLLOWER_STAT)
        out[WEEKLY] = jobs.linkedin_account_week(followers, as_of)
    if want(SEGMENTS):
        countries = L.offset_page_items(_ep(pages, "follower_countries"), S.LI_FOLLOWER_STAT)
        out[SEGMENTS] = jobs.linkedin_audience(countries, as_of)
    return {k: v for k, v in out.items() if only is None or k in only}


def tiktok(pages: DataFrame, as_of, only=None) -> dict[str, DataFrame]:
    want, out = _wants(only), {}
    if want(POSTS, DAILY):
        videos = L.cursor_page_items(_ep(pages, "videos"), S.TT_VIDEO, "creatives")
        ins = L.page_object(_ep(pages, "video_insights"), f"insights STRUCT<{S.TT_VIDEO_INSIGHTS}>", at="data") \
            .select("plataforma", "pagina_id", F.col("entity_id").alias("publicacion_id"), "seq", "insights.*")
        posts, daily = jobs.tiktok_video_ingest(videos, ins, as_of)
        out.update({POSTS: K.post_rows(posts), DAILY: daily})
    if want(WEEKLY):
        acct = L.page_object(_ep(pages, "account_insights"), f"values ARRAY<STRUCT<{S.TT_ACCOUNT_POINT}>>",
                             at="data")
        out[WEEKLY] = jobs.tiktok_account_week(L.series_points(acct), as_of)
    if want(SEGMENTS):
        aud = L.page_object(_ep(pages, "audience"),
                            ", ".join(f"{lst} ARRAY<STRUCT<{S.TT_BUCKET}>>" for lst, _ in TT_AUDIENCE_LISTS),
                            at="data")
        buckets = reduce(DataFrame.unionByName, [
            L.series_points(aud.select("plataforma", "pagina_id", "seq", F.col(lst).alias("values")))
            .withColumn("dim", F.lit(dim)) for lst, dim in TT_AUDIENCE_LISTS])
        out[SEGMENTS] = jobs.tiktok_audience(buckets, as_of)
    return {k: v for k, v in out.items() if only is None or k in only}


PLATFORMS = {"facebook": facebook, "instagram": instagram, "linkedin": linkedin, "tiktok": tiktok}


# the endpoints of which a table's rows come; a table that a run has none of needs no plan
DRIVERS = {
    "facebook": {POSTS: ["posts"], DAILY: ["post_insights"], WEEKLY: ["page_insights"],
                 SEGMENTS: ["page_demographics"], CAMPAIGNS: ["campaigns"], CAMPAIGN_DAILY: ["campaign_insights"]},
    "instagram": {POSTS: ["media"], DAILY: ["media"], WEEKLY: ["account_insights"], SEGMENTS: ["demographics"]},
    "linkedin": {POSTS: ["posts", "ugcPosts", "shares"], DAILY: ["posts", "ugcPosts", "shares"],
                 WEEKLY: ["follower_statistics"], SEGMENTS: ["follower_countries"]},
    "tiktok": {POSTS: ["videos"], DAILY: ["videos"], WEEKLY: ["account_insights"], SEGMENTS: ["audience"]},
}


def all_platforms(pages: DataFrame | Mapping[str, DataFrame], as_of, only=None, platforms=None,
                  held=None) -> dict[str, DataFrame]:
    """Run every platform's adapter (or those named) on one run's pages and union per target table.

    ``pages``: one frame, or one for each platform, which keeps the others out of a platform's plan.
    ``held``: the (platform, endpoint) pairs that the pages have (``landing.contents``); only the tables that
    can get rows of them are planned.
    """
    outs = []
    for p, fn in PLATFORMS.items():
        if platforms is not None and p not in platforms or isinstance(pages, Mapping) and p not in pages:
            continue
        names = only
        if held is not None:
            names = {t for t, ends in DRIVERS[p].items()
                     if (only is None or t in only) and any((p, e) in held for e in ends)}
            if not names:
                continue
        own = pages[p] if isinstance(pages, Mapping) else pages.where(F.col("plataforma") == p)
        outs.append(fn(own, as_of, names))
    names = dict.fromkeys(t for o in outs for t in o)
    return {t: jobs.union_platforms(*[o[t] for o in outs if t in o]) for t in names}


MERGES = {POSTS: K.upsert_posts, DAILY: K.upsert_daily_metrics,
          WEEKLY: lambda cur, b: K.upsert(cur, b, S.WEEKLY_KEY), SEGMENTS: K.insert_ignore_segments,
          CAMPAIGNS: K.upsert_campaigns, CAMPAIGN_DAILY: K.upsert_campaign_daily}
KEYS = {POSTS: S.POST_KEY, WEEKLY: S.WEEKLY_KEY, SEGMENTS: S.SEGMENT_KEY, CAMPAIGNS: S.CAMPAIGN_KEY,
        CAMPAIGN_DAILY: S.CAMPAIGN_DAILY_KEY}


def _of_each_run(pages: DataFrame, runs: list[tuple], as_of, only, platforms) -> dict[str, list[tuple]]:
    """Each table's (rows, run), in the order of ``runs``; a run's own pages need not say of which run they are."""
    found: dict[str, list[tuple]] = {}
    for run in runs:
        own = L.of_run(pages, run).drop(*S.RUN)
        for t, rows in all_platforms(own, run[0] or as_of, only, platforms).items():
            found.setdefault(t, []).append((rows, run))
    return found


def _all_runs(pages: DataFrame, runs: list[tuple]) -> DataFrame:
    """The pages of ``runs``, whose number in the list stands for their ``run_id`` (and for all of ``seq`` before the page)."""
    n = F.lit(None).cast("int")
    for k, (day, name) in reversed(list(enumerate(runs))):
        n = F.when(F.col("run_date").eqNullSafe(F.lit(day)) & F.col("run_id").eqNullSafe(F.lit(name)), k).otherwise(n)
    return pages.withColumn("run_id", n).drop("run_date").where(F.col("run_id").isNotNull())


def fold_runs(pages: DataFrame, only=None, as_of=None, runs: list[tuple] | None = None,
              platforms=None) -> dict[str, DataFrame]:
    """All runs in ``pages`` (or those given, which saves looking), each by itself and in order, merged into
    tables that start empty; of all platforms or those given.

    A campaign's day depends on its own page alone and the latest stays, so T6's rows of all runs, with the run
    first in ``seq``, are one batch: none is computed again to drop the stored rows that it replaces.
    """
    runs = L.runs(pages) if runs is None else runs
    state: dict[str, DataFrame] = {}
    if len(runs) > 1 and (only is None or CAMPAIGN_DAILY in only):
        days = all_platforms(_all_runs(pages, runs), None, {CAMPAIGN_DAILY}, [p for p in ("facebook",) if platforms is None
                                                                              or p in platforms])
        state.update({t: MERGES[t](None, rows) for t, rows in days.items()})
        only = set(only or MERGES) - {CAMPAIGN_DAILY}
    if only is None or only:
        for t, batches in _of_each_run(pages, runs, as_of, only, platforms).items():
            for rows, _ in batches:
                state[t] = MERGES[t](state.get(t), rows)
    return state


def fold_versions(pages: DataFrame, runs: list[tuple], only, platforms=None) -> dict[str, DataFrame]:
    """As ``fold_runs``, for tables whose rows have versions: ``runs`` may be in any order, and the result is that
    of their own order. T2 needs stored deltas too and is merged by ``sources.warehouse`` only."""
    found = _of_each_run(pages, runs, None, only, platforms)
    return {t: K.merge_all_versions(batches, KEYS[t], first=t == SEGMENTS) for t, batches in found.items()}
