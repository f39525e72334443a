"""Registered queries: one Spark plan per operator group, and its DuckDB oracle.

Every query reads the driver tables of ``sf_dir`` (through ``fixtures``),
shapes them like the platform APIs would (``shapes``), runs the library's
jobs/operators, and returns a DataFrame. ``ORACLE`` holds, for the same key,
SQL that DuckDB runs on its pre-registered driver views; column names and
types match the Spark result.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.functions import exprs as E
from metricas.operators import deltas as D
from metricas.operators import joins as J
from metricas.operators import merge as K
from metricas.operators import normalize as N
from metricas.operators import shape as A
from metricas.plans import jobs, landed
from metricas.plans import shapes as SH
from metricas.plans.fixtures import duck, spark_fixture
from metricas.session import pin_utc
from metricas.sources import landing as L

# ---- run parameters of the registered queries ----
AS_OF_POSTS = "2001-08-01"      # year-to-date window over the order dates
AS_OF_ALL_POSTS = "1995-06-30"  # a year start before every order date
AS_OF_ACCOUNT = "2024-01-31"    # account series / audience run date over the event dates
AS_OF_ACCOUNT_EARLY = "2024-01-25"
SPLIT_DAY = "2024-01-16"        # incoming daily rows start here
STORED_UNTIL = "2024-01-20"     # stored daily rows end before here (plus every 3rd day)

RUN_DATES = {1: _dt.date(1995, 7, 1), 2: _dt.date(1995, 7, 2)}  # of the two-run queries
RUNS = [(day, f"run_{n}") for n, day in RUN_DATES.items()]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _ctes(fixtures: dict[str, str], *extra: tuple[str, str], final: str) -> str:
    parts = [f"{alias} AS ({duck(name)})" for alias, name in fixtures.items()]
    parts += [f"{alias} AS ({sql})" for alias, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + final


# ---- SQL helpers (DuckDB) ----

def sql_format(m: str, s: str) -> str:
    m = f"lower(coalesce({m}, ''))"
    s = f"lower(coalesce({s}, ''))"
    return (f"CASE WHEN strpos(CASE WHEN {m} <> '' THEN {m} ELSE {s} END, 'video') > 0 THEN 'video' "
            f"WHEN strpos({m}, 'photo') > 0 OR strpos({m}, 'image') > 0 THEN 'imagen' "
            f"WHEN strpos({m}, 'album') > 0 THEN 'carrusel' "
            f"WHEN strpos({m}, 'link') > 0 OR strpos({s}, 'shared_story') > 0 THEN 'link' "
            f"WHEN {s} <> '' THEN {s} ELSE 'desconocido' END")


def sql_t2(given: dict[str, str]) -> str:
    """The T2 column list (without deltas); counters not given are 0, ctr/tiempo NULL."""
    cols = []
    for f in S.T2_DAILY.fields:
        if f.name.startswith("delta_"):
            continue
        if f.name in given:
            expr = given[f.name]
        elif f.name in ("ctr", "tiempo_promedio_seg_numeric"):
            expr = "NULL"
        else:
            expr = "0"
        duck_type = {"string": "VARCHAR", "date": "DATE", "bigint": "BIGINT", "double": "DOUBLE"}[
            f.dataType.simpleString()]
        cols.append(f"CAST({expr} AS {duck_type}) AS {f.name}")
    return ", ".join(cols)


def sql_deltas(first_null: bool, window: str = "w") -> str:
    if first_null:
        return ", ".join(f"{m} - lag({m}) OVER {window} AS delta_{m}" for m in S.DELTA_METRICS)
    return ", ".join(f"{m} - coalesce(lag({m}) OVER {window}, 0) AS delta_{m}" for m in S.DELTA_METRICS)


POST_WINDOW = "WINDOW w AS (PARTITION BY plataforma, pagina_id, publicacion_id ORDER BY fecha_descarga)"
PK_MATCH = ("{a}.plataforma = {b}.plataforma AND {a}.pagina_id = {b}.pagina_id AND "
            "{a}.publicacion_id = {b}.publicacion_id AND {a}.fecha_descarga = {b}.fecha_descarga")
FA_METRICS = ["visualizaciones", "alcance", "impresiones", "reacciones", "comentarios", "compartidos",
              "guardados"]


def _fx(spark, sf_dir, name):
    return spark_fixture(spark, sf_dir, name)


# ====================== D2 / K5 ======================

@query("recompute_deltas", _ctes({"fa": "F_A"}, final=f"SELECT *, {sql_deltas(True)} FROM fa {POST_WINDOW}"))
def q_recompute_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.recompute_daily_deltas(_fx(spark, sf_dir, "F_A"))


# ====================== D1 / J6 / K2 ======================

def _stored_and_incoming(fa: DataFrame) -> tuple[DataFrame, DataFrame]:
    d = F.col("fecha_descarga")
    third = F.dayofmonth(d) % 3 == 0
    stored = fa.where((d < F.lit(STORED_UNTIL).cast("date")) | third)
    incoming = fa.where((d >= F.lit(SPLIT_DAY).cast("date")) & ~third).select(
        *S.POST_KEY, "fecha_descarga", *[(F.col(m) * 2).alias(m) for m in FA_METRICS])
    return stored, incoming


_SQL_STORED = (f"SELECT * FROM fa WHERE fecha_descarga < DATE '{STORED_UNTIL}' "
               f"OR extract(day FROM fecha_descarga) % 3 = 0")
_SQL_INCOMING = ("SELECT plataforma, pagina_id, publicacion_id, fecha_descarga, "
                 + ", ".join(f"{m} * 2 AS {m}" for m in FA_METRICS)
                 + f" FROM fa WHERE fecha_descarga >= DATE '{SPLIT_DAY}' "
                   f"AND extract(day FROM fecha_descarga) % 3 <> 0")
_SQL_UNION = ("SELECT *, 0 AS src FROM h WHERE NOT EXISTS (SELECT 1 FROM b WHERE "
              + PK_MATCH.format(a="b", b="h") + ") UNION ALL SELECT *, 1 AS src FROM b")
_SQL_BATCH_DELTAS = f"SELECT * FROM (SELECT *, {sql_deltas(False)} FROM u {POST_WINDOW}) WHERE src = 1"


@query("ingest_deltas", _ctes(
    {"fa": "F_A"}, ("h", _SQL_STORED), ("b", _SQL_INCOMING), ("u", _SQL_UNION), ("x", _SQL_BATCH_DELTAS),
    final="SELECT * EXCLUDE (src) FROM x"))
def q_ingest_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _stored_and_incoming(_fx(spark, sf_dir, "F_A"))
    return D.ingest_deltas(incoming, stored)


def _t2_from_fa(df: DataFrame) -> DataFrame:
    return J.daily_rows(df, **{m: F.col(m) for m in FA_METRICS})


_T2_FROM_FA = sql_t2({c: c for c in [*S.POST_KEY, "fecha_descarga", *FA_METRICS]})
_T2_DELTA_COLS = ", ".join(f"delta_{m}" for m in S.DELTA_METRICS)


@query("upsert_daily_metrics", _ctes(
    {"fa": "F_A"}, ("h", _SQL_STORED), ("b", _SQL_INCOMING), ("u", _SQL_UNION), ("x", _SQL_BATCH_DELTAS),
    ("hd", f"SELECT *, {sql_deltas(False)} FROM h {POST_WINDOW}"),
    final=(f"SELECT {_T2_FROM_FA}, {_T2_DELTA_COLS} FROM hd WHERE NOT EXISTS (SELECT 1 FROM b WHERE "
           + PK_MATCH.format(a="b", b="hd") + f") UNION ALL SELECT {_T2_FROM_FA}, {_T2_DELTA_COLS} FROM x")))
def q_upsert_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _stored_and_incoming(_fx(spark, sf_dir, "F_A"))
    current = K.conform(D.ingest_deltas(_t2_from_fa(stored)), S.T2_DAILY)
    return K.upsert_daily_metrics(current, _t2_from_fa(incoming))


# ====================== A1 / A2 / W1 / A3 ======================

def _max_by_filter(value: str, cond: str, alias: str, seq: str = "seq") -> str:
    return f"coalesce(max_by({value}, {seq}) FILTER (WHERE {cond}), 0) AS {alias}"


_SQL_A1_COLS = ", ".join(_max_by_filter("value", f"name = '{n}'", out) for n, out in A.FB_POST_DAY_METRICS)


@query("daily_post_insights", _ctes({"fb": "F_B"}, final=(
    "SELECT 'facebook' AS plataforma, pagina_id, publicacion_id, CAST(substr(end_time, 1, 10) AS DATE) AS dia, "
    f"{_SQL_A1_COLS} FROM fb GROUP BY 1, 2, 3, 4")))
def q_daily_post_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.daily_post_insights(SH.fb_insight_points(_fx(spark, sf_dir, "F_B")))


def _page_metric_name(name):
    return F.when(name == "post_clicks", F.lit("page_fans")).otherwise(F.replace(name, F.lit("post_"), F.lit("page_")))


@query("facebook_page_week", _ctes({"fb": "F_B"}, (
    "pts", "SELECT pagina_id, CAST(substr(end_time, 1, 10) AS DATE) AS dia, seq, value, "
           "CASE WHEN name = 'post_clicks' THEN 'page_fans' ELSE replace(name, 'post_', 'page_') END AS name FROM fb"),
    final=("SELECT 'facebook' AS plataforma, pagina_id, dia AS fecha_corte_semana, "
           + _max_by_filter("value", "name = 'page_fans'", "total_seguidores") + ", "
           + _max_by_filter("value", "name = 'page_impressions_unique'", "alcance_pagina") + ", "
           + _max_by_filter("value", "name = 'page_impressions'", "visualizaciones_pagina")
           + " FROM pts GROUP BY 1, 2, 3")))
def q_facebook_page_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.facebook_page_week(SH.fb_insight_points(_fx(spark, sf_dir, "F_B"), rename=_page_metric_name))


_SQL_A3_COLS = ", ".join(_max_by_filter("total_count", f"tipo = '{t}'", out) for t, out in A.FB_REACTION_TYPES)


@query("reaction_breakdown", _ctes({"fd": "F_D"}, final=(
    f"SELECT 'facebook' AS plataforma, 'page_fb' AS pagina_id, publicacion_id, {_SQL_A3_COLS} "
    "FROM fd GROUP BY 1, 2, 3")))
def q_reaction_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.reaction_breakdown(SH.fb_reaction_items(_fx(spark, sf_dir, "F_D")))


# ====================== J1 / P1 / E1 / F1 / K1 ======================

_SQL_FB_J1 = _ctes(
    {"fc": "F_C", "fd": "F_D", "fb": "F_B"},
    ("p", "SELECT publicacion_id, reacciones, coalesce(comentarios, 0) AS comentarios FROM fc "
          f"WHERE CAST(substr(created_time, 1, 10) AS DATE) >= DATE_TRUNC('year', DATE '{AS_OF_ALL_POSTS}')"),
    ("r", f"SELECT publicacion_id, {_SQL_A3_COLS} FROM fd GROUP BY 1"),
    ("i", "SELECT publicacion_id, CAST(substr(end_time, 1, 10) AS DATE) AS dia, "
          f"{_SQL_A1_COLS} FROM fb GROUP BY 1, 2"),
    final="SELECT " + sql_t2({
        "plataforma": "'facebook'", "pagina_id": "'page_fb'", "publicacion_id": "p.publicacion_id",
        "fecha_descarga": "i.dia", "visualizaciones": "i.visualizaciones", "alcance": "i.alcance",
        "impresiones": "i.impresiones", "reacciones": "p.reacciones",
        **{out: f"coalesce(r.{out}, 0)" for _, out in A.FB_REACTION_TYPES},
        "comentarios": "p.comentarios", "clics_enlace": "i.clics_enlace",
        "ctr": "CASE WHEN i.impresiones > 0 THEN i.clics_enlace / i.impresiones * 100.0 END",
    }) + " FROM p LEFT JOIN r ON r.publicacion_id = p.publicacion_id "
         "JOIN i ON i.publicacion_id = p.publicacion_id")


@query("facebook_daily_metrics", _SQL_FB_J1)
def q_facebook_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, daily = jobs.facebook_post_ingest(
        SH.fb_post_items(_fx(spark, sf_dir, "F_C")), SH.fb_reaction_items(_fx(spark, sf_dir, "F_D")),
        SH.fb_insight_points(_fx(spark, sf_dir, "F_B"), pagina_id="page_fb"), AS_OF_ALL_POSTS)
    return daily


def _sql_fb_posts(where: str, text: str = "message", src: str = "fc") -> str:
    return ("SELECT 'facebook' AS plataforma, 'page_fb' AS pagina_id, publicacion_id, "
            "permalink_url AS url_publicacion, "
            "CAST(substr(created_time, 1, 19) AS TIMESTAMP) AS fecha_hora_publicacion, "
            f"{text} AS texto_publicacion, {sql_format('media_type', 'status_type')} AS formato "
            f"FROM {src} WHERE {where}")


@query("facebook_posts", _ctes({"fc": "F_C"}, final=_sql_fb_posts(
    f"CAST(substr(created_time, 1, 10) AS DATE) >= DATE_TRUNC('year', DATE '{AS_OF_POSTS}')")))
def q_facebook_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = N.year_to_date(N.facebook_posts(SH.fb_post_items(_fx(spark, sf_dir, "F_C"))), "dia", AS_OF_POSTS)
    return K.upsert_posts(None, posts)


@query("infer_format", _ctes({"fc": "F_C"}, final=(
    f"SELECT publicacion_id, {sql_format('media_type', 'status_type')} AS formato FROM fc")))
def q_infer_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = _fx(spark, sf_dir, "F_C")
    return fc.select("publicacion_id", E.infer_format(F.col("media_type"), F.col("status_type")).alias("formato"))


@query("year_to_date", _ctes({"fc": "F_C"}, final=(
    "SELECT publicacion_id, CAST(substr(created_time, 1, 10) AS DATE) AS dia FROM fc "
    f"WHERE CAST(substr(created_time, 1, 10) AS DATE) >= DATE_TRUNC('year', DATE '{AS_OF_POSTS}')")))
def q_year_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = _fx(spark, sf_dir, "F_C").select("publicacion_id", E.iso_local_date("created_time").alias("dia"))
    return N.year_to_date(fc, "dia", AS_OF_POSTS)


@query("upsert_posts", _ctes(
    {"fc": "F_C"},
    ("r1", _sql_fb_posts("seq % 3 <> 0")),
    ("r2", _sql_fb_posts("seq % 2 = 0 OR seq % 3 = 0", text="message || ' (editado)'")),
    final=("SELECT * FROM r1 WHERE NOT EXISTS (SELECT 1 FROM r2 WHERE r2.publicacion_id = r1.publicacion_id) "
           "UNION ALL SELECT * FROM r2")))
def q_upsert_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = _fx(spark, sf_dir, "F_C")
    run1 = N.facebook_posts(SH.fb_post_items(fc.where(F.col("seq") % 3 != 0)))
    edited = fc.where((F.col("seq") % 2 == 0) | (F.col("seq") % 3 == 0)).withColumn("message", F.concat("message", F.lit(" (editado)")))
    run2 = N.facebook_posts(SH.fb_post_items(edited))
    return K.upsert_posts(K.upsert_posts(None, run1), run2)


# ====================== J2 / P2 / A4 ======================

_SQL_IG_INS = ("SELECT publicacion_id, "
               + _max_by_filter("total_count", "tipo = 'LIKE' AND total_count % 10 <> 0", "alcance") + ", "
               + _max_by_filter("total_count", "tipo = 'LOVE' AND total_count % 10 <> 0", "guardados") + ", "
               + _max_by_filter("total_count", "tipo = 'HAHA' AND total_count % 10 <> 0", "vv")
               + " FROM fd GROUP BY 1")


@query("instagram_media_metrics", _ctes(
    {"fc": "F_C", "fd": "F_D"}, ("i", _SQL_IG_INS),
    final="SELECT " + sql_t2({
        "plataforma": "'instagram'", "pagina_id": "'page_ig'", "publicacion_id": "m.publicacion_id",
        "fecha_descarga": "CAST(substr(created_time, 1, 10) AS DATE)",
        "visualizaciones": "coalesce(nullif(coalesce(video_view_count, 0), 0), nullif(coalesce(video_views, 0), 0), "
                           "coalesce(i.vv, 0))",
        "alcance": "coalesce(i.alcance, 0)", "reacciones": "reacciones", "me_gusta": "reacciones",
        "comentarios": "coalesce(comentarios, 0)", "guardados": "coalesce(i.guardados, 0)",
    }) + " FROM fc m LEFT JOIN i ON i.publicacion_id = m.publicacion_id "
         f"WHERE CAST(substr(created_time, 1, 10) AS DATE) >= DATE_TRUNC('year', DATE '{AS_OF_ALL_POSTS}')"))
def q_instagram_media_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, daily = jobs.instagram_media_ingest(SH.ig_media_items(_fx(spark, sf_dir, "F_C")),
                                           SH.ig_insight_items(_fx(spark, sf_dir, "F_D")), AS_OF_ALL_POSTS)
    return daily


# ====================== LinkedIn: P3-P5, P7, U2, J3 ======================

_SQL_LI = (
    "SELECT fe.*, CASE source WHEN 'posts' THEN 1 WHEN 'ugcPosts' THEN 2 ELSE 3 END AS prio, "
    "CASE source WHEN 'ugcPosts' THEN coalesce(nullif(id, ''), urn) ELSE coalesce(nullif(urn, ''), id) END "
    "AS publicacion_id, "
    "coalesce(nullif(created_ms, 0), modified_ms) AS cms, "
    "CASE source WHEN 'posts' THEN (CASE WHEN seq % 4 <= 1 THEN 'https://www.linkedin.com/feed/update/' || id "
    "WHEN seq % 4 = 2 THEN NULL ELSE 'https://lnkd.in/' || id END) WHEN 'ugcPosts' THEN NULL "
    "ELSE 'https://lnkd.in/' || id END AS url_publicacion, "
    "'texto ' || id AS texto_publicacion, "
    "CASE source WHEN 'posts' THEN coalesce(CASE media_status WHEN 'P' THEN 'VIDEO' WHEN 'F' THEN 'IMAGE' END, 'POST') "
    "WHEN 'ugcPosts' THEN (CASE media_status WHEN 'F' THEN 'READY' ELSE 'POST' END) ELSE 'POST' END AS status, "
    "CASE source WHEN 'shares' THEN coalesce(activity, 'urn:li:activity:' || id) "
    "ELSE coalesce(activity, urn, '') END AS activity_urn "
    "FROM fe")
_SQL_LI_CUT = ("SELECT pagina_id, CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 2 WHEN k <> 8 THEN 3 ELSE 0 END "
               "AS cutoff FROM (SELECT DISTINCT pagina_id, CAST(substr(pagina_id, 5) AS INTEGER) AS k FROM fe)")
_SQL_LI_KEPT = ("SELECT li.*, DATE '1970-01-01' + CAST(floor(cms / 86400000) AS INTEGER) AS dia FROM li "
                "JOIN cut ON cut.pagina_id = li.pagina_id WHERE prio <= cutoff AND cms IS NOT NULL AND cms <> 0 "
                f"AND DATE '1970-01-01' + CAST(floor(cms / 86400000) AS INTEGER) >= DATE_TRUNC('year', DATE '{AS_OF_ALL_POSTS}')")


@query("linkedin_posts", _ctes(
    {"fe": "F_E"}, ("li", _SQL_LI), ("cut", _SQL_LI_CUT), ("kept", _SQL_LI_KEPT),
    final=("SELECT 'linkedin' AS plataforma, pagina_id, publicacion_id, url_publicacion, "
           "epoch_ms(cms) AS fecha_hora_publicacion, texto_publicacion, "
           f"{sql_format(chr(39) * 2, 'status')} AS formato FROM kept")))
def q_linkedin_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fe = _fx(spark, sf_dir, "F_E")
    posts, ugc, shares = SH.li_items(fe)
    rows = jobs.linkedin_posts(posts, ugc, shares, SH.li_source_status(fe), AS_OF_ALL_POSTS)
    return K.upsert_posts(None, rows)


_SQL_LI_SOCIAL = (
    "SELECT activity_urn, CASE WHEN tc % 7 = 0 THEN 0 ELSE tc END AS likes, "
    "CASE WHEN tc % 7 = 0 THEN 0 ELSE (tc * 3) % 11 END AS comments, "
    "CASE WHEN tc % 7 = 0 THEN 0 WHEN tc % 7 = 1 THEN 1 WHEN tc % 5 = 0 THEN 1 ELSE tc % 5 END AS shares "
    "FROM (SELECT 'urn:li:activity:' || substr(publicacion_id, 6) AS activity_urn, max_by(total_count, seq) AS tc "
    "FROM fd GROUP BY 1)")


@query("linkedin_post_metrics", _ctes(
    {"fe": "F_E", "fd": "F_D"}, ("li", _SQL_LI), ("cut", _SQL_LI_CUT), ("kept", _SQL_LI_KEPT),
    ("sc", _SQL_LI_SOCIAL),
    final="SELECT " + sql_t2({
        "plataforma": "'linkedin'", "pagina_id": "kept.pagina_id", "publicacion_id": "kept.publicacion_id",
        "fecha_descarga": "kept.dia", "reacciones": "coalesce(sc.likes, 0)", "me_gusta": "coalesce(sc.likes, 0)",
        "comentarios": "coalesce(sc.comments, 0)", "compartidos": "coalesce(sc.shares, 0)",
    }) + " FROM kept LEFT JOIN sc ON sc.activity_urn = kept.activity_urn AND kept.activity_urn <> ''"))
def q_linkedin_post_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fe = _fx(spark, sf_dir, "F_E")
    posts, ugc, shares = SH.li_items(fe)
    _, daily = jobs.linkedin_post_ingest(posts, ugc, shares, SH.li_source_status(fe),
                                         SH.li_social_actions(_fx(spark, sf_dir, "F_D")), AS_OF_ALL_POSTS)
    return daily


# ====================== TikTok: P6, J4, E3, E4 ======================

_SQL_TT = ("SELECT *, CASE WHEN strpos(create_time, '-') = 0 THEN DATE '1970-01-01' + "
           "CAST(floor(CAST(create_time AS BIGINT) / 86400) AS INTEGER) "
           "ELSE CAST(substr(create_time, 1, 10) AS DATE) END AS cdate FROM ff WHERE creative_id IS NOT NULL")


@query("tiktok_video_metrics", _ctes(
    {"ff": "F_F"}, ("v", _SQL_TT),
    final="SELECT " + sql_t2({
        "plataforma": "'tiktok'", "pagina_id": "pagina_id", "publicacion_id": "creative_id",
        "fecha_descarga": "coalesce(CAST(substr(publish_time, 1, 10) AS DATE), cdate)",
        "visualizaciones": "coalesce(nullif(view_count, 0), insight_views)", "alcance": "insight_reach",
        "reacciones": "coalesce(nullif(like_count, 0), insight_likes)",
        "me_gusta": "coalesce(nullif(like_count, 0), insight_likes)",
        "comentarios": "coalesce(nullif(comment_count, 0), insight_comments)",
        "compartidos": "coalesce(nullif(share_count, 0), insight_shares)", "guardados": "insight_saves",
    }) + f" FROM v WHERE cdate >= DATE_TRUNC('year', DATE '{AS_OF_ALL_POSTS}')"))
def q_tiktok_video_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ff = _fx(spark, sf_dir, "F_F")
    _, daily = jobs.tiktok_video_ingest(SH.tt_video_items(ff), SH.tt_insight_items(ff), AS_OF_ALL_POSTS)
    return daily


# ====================== weekly account series: F2, J5, A9, A5, W2-W4 ======================

def _sql_latest_week(src: str, cols: str) -> str:
    return (f"SELECT pagina_id, dia, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY pagina_id, "
            f"date_trunc('week', dia) ORDER BY dia DESC) AS rn FROM {src}) WHERE rn = 1")


def _sql_ig_week(lo: str, hi: str) -> str:
    return (
        "SELECT 'instagram' AS plataforma, pagina_id, dia AS fecha_corte_semana, fc AS total_seguidores, "
        "reach AS alcance_pagina, CAST(0 AS BIGINT) AS visualizaciones_pagina FROM ("
        + _sql_latest_week(
            "(SELECT pagina_id, dia, "
            + _max_by_filter("valor", "serie = 'reach'", "reach") + ", "
            + _max_by_filter("valor", "serie = 'follower_count'", "fc")
            + f" FROM g WHERE dia BETWEEN DATE '{lo}' AND DATE '{hi}' GROUP BY 1, 2)", "reach, fc")
        + ")")


def _window(as_of: str, platform: str) -> tuple[str, str]:
    lo, hi = N.lookback_window(as_of, platform)
    return lo.isoformat(), hi.isoformat()


@query("instagram_account_week", _ctes({"g": "F_G"}, final=_sql_ig_week(*_window(AS_OF_ACCOUNT, "instagram"))))
def q_instagram_account_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.instagram_account_week(SH.ig_account_points(_fx(spark, sf_dir, "F_G")), AS_OF_ACCOUNT)


@query("upsert_weekly_stats", _ctes(
    {"g": "F_G"}, ("r1", _sql_ig_week(*_window(AS_OF_ACCOUNT_EARLY, "instagram"))),
    ("r2", _sql_ig_week(*_window(AS_OF_ACCOUNT, "instagram"))),
    final=("SELECT * FROM r1 WHERE NOT EXISTS (SELECT 1 FROM r2 WHERE r2.pagina_id = r1.pagina_id AND "
           "r2.fecha_corte_semana = r1.fecha_corte_semana) UNION ALL SELECT * FROM r2")))
def q_upsert_weekly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = SH.ig_account_points(_fx(spark, sf_dir, "F_G"))
    first = jobs.instagram_account_week(pts, AS_OF_ACCOUNT_EARLY)
    second = jobs.instagram_account_week(pts, AS_OF_ACCOUNT)
    return K.upsert(first, second, S.WEEKLY_KEY)


@query("linkedin_account_week", _ctes({"g": "F_G"}, final=(
    "SELECT 'linkedin' AS plataforma, pagina_id, dia AS fecha_corte_semana, v AS total_seguidores, "
    "CAST(0 AS BIGINT) AS alcance_pagina, CAST(0 AS BIGINT) AS visualizaciones_pagina FROM ("
    + _sql_latest_week(
        "(SELECT pagina_id, dia, max_by(CASE WHEN serie = 'profile_views' THEN 0 ELSE valor END, seq) AS v "
        "FROM g WHERE dia BETWEEN DATE '{}' AND DATE '{}' GROUP BY 1, 2)".format(
            *_window(AS_OF_ACCOUNT, "linkedin")), "v") + ")")))
def q_linkedin_account_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.linkedin_account_week(SH.li_follower_elements(_fx(spark, sf_dir, "F_G")), AS_OF_ACCOUNT)


@query("tiktok_account_week", _ctes({"g": "F_G"}, final=(
    "SELECT 'tiktok' AS plataforma, pagina_id, dia AS fecha_corte_semana, followers AS total_seguidores, "
    "CAST(0 AS BIGINT) AS alcance_pagina, views AS visualizaciones_pagina FROM ("
    + _sql_latest_week(
        "(SELECT pagina_id, dia, max_by(CASE WHEN serie = 'reach' THEN valor ELSE 0 END, seq) AS views, "
        "max_by(CASE WHEN serie = 'follower_count' THEN valor ELSE 0 END, seq) AS followers "
        "FROM g WHERE dia BETWEEN DATE '{}' AND DATE '{}' GROUP BY 1, 2)".format(
            *_window(AS_OF_ACCOUNT, "tiktok")), "views, followers") + ")")))
def q_tiktok_account_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.tiktok_account_week(SH.tt_account_points(_fx(spark, sf_dir, "F_G")), AS_OF_ACCOUNT)


# ====================== audience: A5-A8, G1-G4, K4, F3, F4 ======================

def _sql_bucket_cols(platform: str, qty: str) -> str:
    return (f"'{platform}' AS plataforma, pagina_id, DATE '{AS_OF_ACCOUNT}' AS fecha_corte_semana, "
            "CASE WHEN dim = 'gender' THEN name WHEN dim = 'age' THEN 'AGE.' || name END AS genero, "
            "CASE WHEN dim = 'country' THEN name END AS pais, CASE WHEN dim = 'city' THEN name END AS ciudad, "
            f"CAST(NULL AS VARCHAR) AS nivel_educacion, {qty} AS cantidad_seguidores")


@query("instagram_audience", _ctes({"h": "F_H"}, final=(
    "SELECT " + _sql_bucket_cols("instagram", "CAST(sum(coalesce(cantidad, 0)) AS BIGINT)")
    + " FROM h WHERE seq % 10 <> 0 GROUP BY pagina_id, dim, name")))
def q_instagram_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.instagram_audience(SH.ig_demographic_responses(_fx(spark, sf_dir, "F_H")), AS_OF_ACCOUNT)


_SQL_TT_AUD = "SELECT " + _sql_bucket_cols("tiktok", "max_by(coalesce(cantidad, 0), seq)") + \
    " FROM h {where} GROUP BY pagina_id, dim, name"


@query("tiktok_audience", _ctes({"h": "F_H"}, final=_SQL_TT_AUD.format(where="")))
def q_tiktok_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.tiktok_audience(SH.tt_audience_buckets(_fx(spark, sf_dir, "F_H")), AS_OF_ACCOUNT)


_NULL_SAFE_SEG = " AND ".join(f"a1.{c} IS NOT DISTINCT FROM a2.{c}" for c in S.SEGMENT_KEY)


@query("insert_ignore_segments", _ctes(
    {"h": "F_H"}, ("a1", _SQL_TT_AUD.format(where="WHERE seq % 3 <> 0")),
    ("a2", _SQL_TT_AUD.format(where="WHERE seq % 2 = 0 OR seq % 3 = 0").replace(
        "max_by(coalesce(cantidad, 0), seq)", "max_by(coalesce(cantidad, 0) + 1000, seq)")),
    final=f"SELECT * FROM a1 UNION ALL SELECT * FROM a2 WHERE NOT EXISTS (SELECT 1 FROM a1 WHERE {_NULL_SAFE_SEG})"))
def q_insert_ignore_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    fh = _fx(spark, sf_dir, "F_H")
    first = jobs.tiktok_audience(SH.tt_audience_buckets(fh.where(F.col("seq") % 3 != 0)), AS_OF_ACCOUNT)
    bumped = fh.where((F.col("seq") % 2 == 0) | (F.col("seq") % 3 == 0)).withColumn(
        "cantidad", F.coalesce(F.col("cantidad"), F.lit(0)) + 1000)
    second = jobs.tiktok_audience(SH.tt_audience_buckets(bumped), AS_OF_ACCOUNT)
    return K.insert_ignore_segments(first, second)


@query("facebook_audience", _ctes(
    {"k": "F_K"},
    ("pts", "SELECT pagina_id, dia, CASE extract(day FROM dia) % 3 WHEN 0 THEN 'page_fans_gender_age' "
            "WHEN 1 THEN 'page_fans_country' ELSE 'page_fans_city' END AS serie FROM k GROUP BY 1, 2"),
    ("latest", "SELECT pagina_id, serie, max(dia) AS dia FROM pts GROUP BY pagina_id, serie, date_trunc('week', dia)"),
    final=("SELECT 'facebook' AS plataforma, l.pagina_id, l.dia AS fecha_corte_semana, "
           "CASE WHEN l.serie = 'page_fans_gender_age' THEN k.clave END AS genero, "
           "CASE WHEN l.serie = 'page_fans_country' THEN k.clave END AS pais, "
           "CASE WHEN l.serie = 'page_fans_city' THEN k.clave END AS ciudad, "
           "CAST(NULL AS VARCHAR) AS nivel_educacion, k.cantidad AS cantidad_seguidores "
           "FROM latest l JOIN k ON k.pagina_id = l.pagina_id AND k.dia = l.dia WHERE k.clave IS NOT NULL")))
def q_facebook_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.facebook_audience(SH.fb_demographic_points(_fx(spark, sf_dir, "F_K")))


@query("linkedin_audience", _ctes(
    {"k": "F_K"},
    ("e", "SELECT pagina_id, clave AS country, dia, seq, coalesce(nullif(CASE WHEN seq % 4 = 0 THEN 0 ELSE cantidad END, 0), "
          "nullif(cantidad + 1, 0), 0) AS valor FROM k WHERE clave IS NOT NULL AND clave <> '' "
          "AND dia BETWEEN DATE '{}' AND DATE '{}'".format(*_window(AS_OF_ACCOUNT, "linkedin"))),
    ("a", "SELECT pagina_id, country, valor, min(seq) OVER (PARTITION BY pagina_id, country) AS first_seq, "
          "row_number() OVER (PARTITION BY pagina_id, country ORDER BY dia DESC, seq DESC) AS rn FROM e"),
    ("b", "SELECT pagina_id, upper(country) AS pais, valor, row_number() OVER (PARTITION BY pagina_id, "
          "upper(country) ORDER BY first_seq) AS rn2 FROM a WHERE rn = 1"),
    final=(f"SELECT 'linkedin' AS plataforma, pagina_id, DATE '{AS_OF_ACCOUNT}' AS fecha_corte_semana, "
           "CAST(NULL AS VARCHAR) AS genero, pais, CAST(NULL AS VARCHAR) AS ciudad, "
           "CAST(NULL AS VARCHAR) AS nivel_educacion, valor AS cantidad_seguidores FROM b WHERE rn2 = 1")))
def q_linkedin_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.linkedin_audience(SH.li_country_elements(_fx(spark, sf_dir, "F_K")), AS_OF_ACCOUNT)


# ====================== S1-S3 ======================

def _landed(fi: DataFrame, wrap) -> DataFrame:
    items = F.transform(F.sort_array(F.collect_list(F.struct("pos", "publicacion_id"))),
                        lambda x: F.struct(x["publicacion_id"].alias("id")))
    pages = fi.groupBy("page_seq").agg(items.alias("items"))
    return pages.select(F.lit("facebook").alias("plataforma"), F.lit("page_fb").alias("pagina_id"),
                        F.lit("posts").alias("endpoint"), F.lit(None).cast("string").alias("entity_id"),
                        F.lit(None).cast("string").alias("variant"), "page_seq",
                        F.to_json(wrap(F.col("items"), F.col("page_seq"))).alias("payload"))


_SQL_PAGE_ITEMS = _ctes({"fi": "F_I"}, final=(
    "SELECT page_seq, row_number() OVER (PARTITION BY page_seq ORDER BY pos) - 1 AS pos, publicacion_id FROM fi"))


@query("graph_page_items", _SQL_PAGE_ITEMS)
def q_graph_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed(_fx(spark, sf_dir, "F_I"), lambda items, _: F.struct(items.alias("data")))
    return L.graph_page_items(pages, "id STRING").select("seq.page_seq", "seq.pos", F.col("id").alias("publicacion_id"))


@query("offset_page_items", _SQL_PAGE_ITEMS)
def q_offset_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed(_fx(spark, sf_dir, "F_I"),
                    lambda items, _: F.struct(items.alias("elements"),
                                              F.struct(F.size(items).alias("count")).alias("paging")))
    return L.offset_page_items(pages, "id STRING").select("seq.page_seq", "seq.pos", F.col("id").alias("publicacion_id"))


def _cursor_wrap(items, page_seq):
    empty = F.array().cast("array<struct<id:string>>")
    kind = page_seq % 3
    data = (F.when(kind == 0, F.struct(items.alias("creatives"), F.lit(None).cast("array<struct<id:string>>").alias("items")))
            .when(kind == 1, F.struct(empty.alias("creatives"), items.alias("items")))
            .otherwise(F.struct(F.lit(None).cast("array<struct<id:string>>").alias("creatives"), items.alias("items"))))
    return F.struct(data.alias("data"))


@query("cursor_page_items", _SQL_PAGE_ITEMS)
def q_cursor_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed(_fx(spark, sf_dir, "F_I"), _cursor_wrap)
    return L.cursor_page_items(pages, "id STRING", "creatives").select("seq.page_seq", "seq.pos", F.col("id").alias("publicacion_id"))


# ====================== U1 / P8 / K6 ======================

@query("campaign_daily", _ctes({"j": "F_J"}, final=(
    "SELECT 'facebook' AS plataforma, 'act_1' AS cuenta_id, campania_id, CAST(date_start AS DATE) AS fecha_descarga, "
    "coalesce(TRY_CAST(spend AS DOUBLE), 0) AS presupuesto_invertido, "
    "coalesce(TRY_CAST(impressions AS BIGINT), 0) AS impresiones, coalesce(TRY_CAST(reach AS BIGINT), 0) AS alcance, "
    "coalesce(TRY_CAST(cpm AS DOUBLE), 0) AS cpm, coalesce(TRY_CAST(cpc AS DOUBLE), 0) AS cpc, "
    "CAST(0 AS DOUBLE) AS ctr FROM j")))
def q_campaign_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    fj = _fx(spark, sf_dir, "F_J")
    items = fj.select(F.lit("facebook").alias("plataforma"), F.lit("act_1").alias("pagina_id"), "campania_id",
                      "seq", "date_start", "impressions", "reach", "clicks", "spend", "cpm", "cpc",
                      F.lit(None).cast("string").alias("ctr"))
    return K.conform(K.upsert_campaign_daily(None, N.campaign_daily(items)), S.T6_CAMPAIGN_DAILY)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return QUERIES[name](spark, sf_dir)


@query("upsert_campaigns", _ctes({"j": "F_J"}, final=(
    "SELECT campania_id, 'facebook' AS plataforma, 'act_1' AS cuenta_id, "
    "max_by('Campaña ' || campania_id || ' #' || CAST(seq AS VARCHAR), date_start) AS nombre_campania "
    "FROM j GROUP BY campania_id")))
def q_upsert_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 (T5): one listing item per campaign-day row, the latest listing wins."""
    fj = _fx(spark, sf_dir, "F_J")
    order = E.iso_local_date("date_start")
    items = fj.select(F.lit("facebook").alias("plataforma"), F.lit("act_1").alias("pagina_id"),
                      F.col("campania_id").alias("id"),
                      F.concat(F.lit("Campaña "), F.col("campania_id"), F.lit(" #"), F.col("seq").cast("string"))
                      .alias("name"),
                      F.unix_date(order).cast("bigint").alias("seq"))
    return K.conform(K.upsert_campaigns(None, N.campaign_rows(items)), S.T5_CAMPAIGNS)


def _pages(df: DataFrame, endpoint: str, payload, entity=None, variant=None, page_seq="seq") -> DataFrame:
    return df.select(F.col("plataforma"), F.col("pagina_id"), F.lit(endpoint).alias("endpoint"),
                     (entity if entity is not None else F.lit(None).cast("string")).alias("entity_id"),
                     (variant if variant is not None else F.lit(None).cast("string")).alias("variant"),
                     F.col(page_seq).cast("bigint").alias("page_seq"), F.to_json(payload).alias("payload"),
                     *[c for c in S.RUN if c in df.columns])


def fb_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph-API-shaped JSON pages built from F-C (posts, 50 per page), F-B (one insight
    response per point) and F-D (one reactions response per row)."""
    posts = SH.fb_post_items(_fx(spark, sf_dir, "F_C"))
    post_obj = F.struct(*[c for c in posts.columns if c not in ("plataforma", "pagina_id", "seq")])
    by_page = (posts.groupBy("plataforma", "pagina_id", F.floor(F.col("seq") / 50).alias("page"))
               .agg(F.sort_array(F.collect_list(F.struct(F.col("seq"), post_obj.alias("p")))).alias("items")))
    post_pages = _pages(by_page, "posts", F.struct(F.transform("items", lambda x: x["p"]).alias("data")),
                        page_seq="page")
    ins = SH.fb_insight_points(_fx(spark, sf_dir, "F_B"), pagina_id="page_fb")
    series = F.array(F.struct(F.col("name"), F.array(F.struct("end_time", "value")).alias("values")))
    ins_pages = _pages(ins, "post_insights", F.struct(series.alias("data")), entity=F.col("publicacion_id"))
    rx = SH.fb_reaction_items(_fx(spark, sf_dir, "F_D"))
    rx_pages = _pages(rx, "reactions", F.struct(F.struct(F.col("total_count")).alias("summary")),
                      entity=F.col("publicacion_id"), variant=F.col("tipo"))
    return post_pages.unionByName(ins_pages).unionByName(rx_pages)


@query("facebook_daily_from_pages", _SQL_FB_J1)
def q_facebook_daily_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 from landed JSON pages: S1 explode -> P1 -> A1, A3 -> J1 (same result as facebook_daily_metrics)."""
    return landed.facebook(fb_landed_pages(spark, sf_dir), AS_OF_ALL_POSTS, only={landed.DAILY})[landed.DAILY]


def _item_pages(items: DataFrame, endpoint: str, wrap, group=("plataforma", "pagina_id"), size: int = 50) -> DataFrame:
    """Pack item rows into JSON pages of ``size`` items, keeping their ``seq`` order."""
    fields = [c for c in items.columns if c not in ("plataforma", "pagina_id", "seq", "source")]
    by_page = (items.groupBy(*group, F.floor(F.col("seq") / size).alias("page"))
               .agg(F.sort_array(F.collect_list(F.struct(F.col("seq"), F.struct(*fields).alias("it"))))
                    .alias("items")))
    return _pages(by_page, endpoint, wrap(F.transform("items", lambda x: x["it"]), F.col("page")),
                  page_seq="page")


def li_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fe = _fx(spark, sf_dir, "F_E")
    posts, ugc, shares = SH.li_items(fe)
    lists = [_item_pages(df, src, lambda items, _: F.struct(items.alias("elements")))
             for src, df in (("posts", posts), ("ugcPosts", ugc), ("shares", shares))]
    status = SH.li_source_status(fe).select(F.lit("linkedin").alias("plataforma"), "pagina_id", "source", "ok",
                                            F.lit(0).alias("seq"))
    status_pages = _pages(status, "source_status", F.struct("source", "ok"))
    social = SH.li_social_actions(_fx(spark, sf_dir, "F_D"))
    social_pages = _pages(social.withColumn("pagina_id", F.lit("org_0")), "socialActions",
                          F.struct("likesSummary", "commentsSummary", "totalShareStatistics", "shares"),
                          entity=F.col("entity_id"))
    out = status_pages
    for df in [*lists, social_pages]:
        out = out.unionByName(df)
    return out


@query("linkedin_daily_from_pages", ORACLE["linkedin_post_metrics"])
def q_linkedin_daily_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 for LinkedIn from landed JSON pages: S2 explode -> P3-P5 -> U2 -> P7 -> J3."""
    return landed.linkedin(li_landed_pages(spark, sf_dir), AS_OF_ALL_POSTS, only={landed.DAILY})[landed.DAILY]


def tt_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ff = _fx(spark, sf_dir, "F_F")
    videos = SH.tt_video_items(ff)

    def wrap(items, page):  # even pages under data.creatives, odd pages fall through to data.items
        return F.struct(F.when(page % 2 == 0, F.struct(items.alias("creatives"), F.lit(None).alias("items")))
                        .otherwise(F.struct(F.lit(None).alias("creatives"), items.alias("items"))).alias("data"))
    video_pages = _item_pages(videos, "videos", wrap)
    ins = SH.tt_insight_items(ff)
    ins_pages = _pages(ins, "video_insights",
                       F.struct(F.struct(F.struct("views", "likes", "comments", "shares", "saves", "reach")
                                         .alias("insights")).alias("data")),
                       entity=F.col("publicacion_id"))
    return video_pages.unionByName(ins_pages)


@query("tiktok_daily_from_pages", ORACLE["tiktok_video_metrics"])
def q_tiktok_daily_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 for TikTok from landed JSON pages: S3 cursor pages -> P6 -> J4."""
    return landed.tiktok(tt_landed_pages(spark, sf_dir), AS_OF_ALL_POSTS, only={landed.DAILY})[landed.DAILY]


def ig_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = SH.ig_media_items(_fx(spark, sf_dir, "F_C"))
    media_pages = _item_pages(media, "media", lambda items, _: F.struct(items.alias("data")))
    ins = SH.ig_insight_items(_fx(spark, sf_dir, "F_D"))
    ins_pages = _pages(ins, "media_insights", F.struct(F.array(F.struct("name", "values")).alias("data")),
                       entity=F.col("publicacion_id"))
    return media_pages.unionByName(ins_pages)


@query("instagram_daily_from_pages", ORACLE["instagram_media_metrics"])
def q_instagram_daily_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 for Instagram from landed JSON pages: S1 -> P2 -> A4 -> J2."""
    return landed.instagram(ig_landed_pages(spark, sf_dir), AS_OF_ALL_POSTS, only={landed.DAILY})[landed.DAILY]


_LI_NORM_COLS = ("pagina_id", "publicacion_id", "created_ms", "texto_publicacion", "url_publicacion",
                 "media_type", "activity_urn")


def _sql_li_source(source: str) -> str:
    media = {"posts": "CASE media_status WHEN 'P' THEN 'VIDEO' WHEN 'F' THEN 'IMAGE' ELSE 'POST' END",
             "ugcPosts": "CASE media_status WHEN 'F' THEN 'READY' ELSE 'POST' END",
             "shares": "'POST'"}[source]
    return _ctes({"fe": "F_E"}, ("li", _SQL_LI), final=(
        "SELECT pagina_id, publicacion_id, cms AS created_ms, texto_publicacion, url_publicacion, "
        f"{media} AS media_type, activity_urn FROM li WHERE source = '{source}' AND cms IS NOT NULL AND cms <> 0"))


def _li_source_query(source: str):
    def run_source(spark: SparkSession, sf_dir: str) -> DataFrame:
        posts, ugc, shares = SH.li_items(_fx(spark, sf_dir, "F_E"))
        fn = {"posts": (N.linkedin_posts, posts), "ugcPosts": (N.linkedin_ugc_posts, ugc),
              "shares": (N.linkedin_shares, shares)}[source]
        return fn[0](fn[1]).select(*_LI_NORM_COLS)
    return run_source


for _name, _src in (("linkedin_posts_source", "posts"), ("linkedin_ugc_posts_source", "ugcPosts"),
                    ("linkedin_shares_source", "shares")):
    query(_name, _sql_li_source(_src))(_li_source_query(_src))


@query("linkedin_source_fallback", _ctes(
    {"fe": "F_E"}, ("li", _SQL_LI), ("cut", _SQL_LI_CUT),
    final=("SELECT li.pagina_id, li.publicacion_id, li.source FROM li JOIN cut ON cut.pagina_id = li.pagina_id "
           "WHERE li.prio <= cut.cutoff AND li.cms IS NOT NULL AND li.cms <> 0")))
def q_linkedin_source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 alone: rows of the sources tried up to the first one that completed, per org."""
    fe = _fx(spark, sf_dir, "F_E")
    posts, ugc, shares = SH.li_items(fe)
    li = N.linkedin_posts(posts).unionByName(N.linkedin_ugc_posts(ugc)).unionByName(N.linkedin_shares(shares))
    return N.linkedin_source_fallback(li, SH.li_source_status(fe)).select("pagina_id", "publicacion_id", "source")


@query("page_week_pivot", _ctes({"fb": "F_B"}, (
    "pts", "SELECT pagina_id, CAST(substr(end_time, 1, 10) AS DATE) AS dia, seq, value, "
           "CASE WHEN name = 'post_clicks' THEN 'page_fans' ELSE replace(name, 'post_', 'page_') END AS name FROM fb"),
    final=("SELECT 'facebook' AS plataforma, pagina_id, dia, "
           + ", ".join(_max_by_filter("value", f"name = '{n}'", out) for n, out in A.FB_PAGE_WEEK_METRICS)
           + " FROM pts GROUP BY 1, 2, 3")))
def q_page_week_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 alone, including the page video views that T3 does not keep."""
    return A.page_week_pivot(SH.fb_insight_points(_fx(spark, sf_dir, "F_B"), rename=_page_metric_name))


@query("lifetime_last_value", _ctes({"fd": "F_D"}, final=(
    "SELECT 'instagram' AS plataforma, 'page_ig' AS pagina_id, publicacion_id, "
    + ", ".join(_max_by_filter("total_count", f"tipo = '{t}' AND total_count % 10 <> 0", out)
                for t, out in (("LIKE", "alcance"), ("LOVE", "guardados"), ("HAHA", "video_views")))
    + " FROM fd GROUP BY 1, 2, 3")))
def q_lifetime_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 alone: last element of each lifetime series per media; empty series keep the earlier value."""
    return A.lifetime_last_value(SH.ig_insight_items(_fx(spark, sf_dir, "F_D")))


@query("merge_daily_series", _ctes({"g": "F_G"}, final=(
    "SELECT 'instagram' AS plataforma, pagina_id, dia, "
    + ", ".join(_max_by_filter("valor", f"serie = '{n}'", n) for n, _ in A.IG_ACCOUNT_SERIES)
    + " FROM g GROUP BY 1, 2, 3")))
def q_merge_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 alone: three tagged daily series -> one row per (page, day), absent series 0."""
    pts = SH.ig_account_points(_fx(spark, sf_dir, "F_G")).select(
        "plataforma", "pagina_id", "serie", "seq", E.iso_local_date("end_time").alias("dia"),
        E.scalar_or_value_struct("value").alias("valor"))
    return A.merge_daily_series(pts)


# ====================== U1 and runs ======================

def all_landed_pages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    made = {"facebook": fb_landed_pages, "instagram": ig_landed_pages, "linkedin": li_landed_pages,
            "tiktok": tt_landed_pages}
    return {platform: pages(spark, sf_dir) for platform, pages in made.items()}


@query("union_platforms", " UNION ALL ".join(f"SELECT * FROM ({ORACLE[n]})" for n in (
    "facebook_daily_from_pages", "instagram_daily_from_pages", "linkedin_daily_from_pages", "tiktok_daily_from_pages")))
def q_union_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run's pages of all four platforms -> one daily table."""
    return landed.all_platforms(all_landed_pages(spark, sf_dir), AS_OF_ALL_POSTS, only={landed.DAILY})[landed.DAILY]


def _in_run(pages: DataFrame, run: int) -> DataFrame:
    return pages.select("*", F.lit(f"run_{run}").alias("run_id"), F.lit(RUN_DATES[run]).alias("run_date"))


_SQL_TWO_POST_RUNS = ORACLE["upsert_posts"]


@query("posts_two_runs", _SQL_TWO_POST_RUNS)
def q_posts_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over two runs with the same page numbers: the later run wins, though its pages' numbers are smaller."""
    return landed.fold_runs(_two_post_runs(spark, sf_dir), {landed.POSTS}, runs=RUNS, platforms=["facebook"])[landed.POSTS]


def _two_post_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = _fx(spark, sf_dir, "F_C")
    edited = fc.where((F.col("seq") % 2 == 0) | (F.col("seq") % 3 == 0)).withColumn(
        "message", F.concat("message", F.lit(" (editado)")))

    def listing(df: DataFrame) -> DataFrame:
        return _item_pages(SH.fb_post_items(df), "posts", lambda items, _: F.struct(items.alias("data")))
    first = listing(fc.where(F.col("seq") % 3 != 0).withColumn("seq", F.col("seq") + 100))
    return _in_run(first, 1).unionByName(_in_run(listing(edited), 2))


def _sql_ig_audience(run: int, qty: str) -> str:
    return ("SELECT " + _sql_bucket_cols("instagram", f"CAST(sum({qty}) AS BIGINT)")
            .replace(AS_OF_ACCOUNT, RUN_DATES[run].isoformat())
            + " FROM h WHERE seq % 10 <> 0 GROUP BY pagina_id, dim, name")


@query("instagram_audience_two_runs", _ctes({"h": "F_H"}, final=(
    _sql_ig_audience(1, "coalesce(cantidad, 0)") + " UNION ALL " + _sql_ig_audience(2, "coalesce(cantidad, 0) + 1"))))
def q_instagram_audience_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's repeated response replaces the earlier one, and each run's rows carry its own date."""
    fh = _fx(spark, sf_dir, "F_H")

    def asked(plus: int, run: int, page_seq: int) -> DataFrame:
        rows = SH.ig_demographic_responses(fh.withColumn("cantidad", F.coalesce("cantidad", F.lit(0)) + plus))
        return _in_run(_pages(rows.withColumn("seq", F.lit(page_seq)), "demographics",
                              F.struct(F.array(F.struct("breakdowns")).alias("data")), variant=F.col("variant")), run)
    pages = asked(1000, 1, 1).unionByName(asked(0, 1, 2)).unionByName(asked(1, 2, 1))
    return landed.fold_runs(pages, {landed.SEGMENTS}, runs=RUNS, platforms=["instagram"])[landed.SEGMENTS]


@query("linkedin_fallback_two_runs", ORACLE["linkedin_posts"].replace(
    "WHERE prio <= cutoff", "WHERE prio <= greatest(cutoff, 2)"))
def q_linkedin_fallback_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 per run: the second run's posts source fails everywhere and its ugcPosts source works."""
    pages = li_landed_pages(spark, sf_dir).where(F.col("endpoint") != "socialActions")
    orgs = pages.where(F.col("endpoint") == "source_status").select("plataforma", "pagina_id").distinct()
    status = orgs.select("*", F.explode(F.array(F.struct(F.lit("posts").alias("source"), F.lit(False).alias("ok")),
                                                F.struct(F.lit("ugcPosts").alias("source"), F.lit(True).alias("ok")))).alias("s"), F.lit(0).alias("seq"))
    again = (pages.where(F.col("endpoint") != "source_status")
             .unionByName(_pages(status, "source_status", F.col("s"))))
    return landed.fold_runs(_in_run(pages, 1).unionByName(_in_run(again, 2)), {landed.POSTS}, runs=RUNS,
                            platforms=["linkedin"])[landed.POSTS]


def _landed_query(name: str, adapter: str, pages, table: str, as_of: str, oracle: str) -> None:
    @query(name, oracle)
    def run_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = landed.PLATFORMS[adapter](pages(spark, sf_dir), as_of, only={table})[table]
        return landed.MERGES[table](None, rows)


_landed_query("instagram_posts_from_pages", "instagram", ig_landed_pages, landed.POSTS, AS_OF_ALL_POSTS, _ctes(
    {"fc": "F_C"}, final=(
        "SELECT 'instagram' AS plataforma, 'page_ig' AS pagina_id, publicacion_id, permalink_url AS url_publicacion, "
        "CAST(substr(created_time, 1, 19) AS TIMESTAMP) AS fecha_hora_publicacion, message AS texto_publicacion, "
        f"{sql_format(chr(39) * 2, 'upper(coalesce(media_type, ' + chr(39) * 2 + '))')} AS formato FROM fc")))


def campaign_pages(fj: DataFrame) -> DataFrame:
    """Ad-insight pages, one per (campaign, day), and a listing page per campaign-day."""
    ids = fj.select(F.lit("facebook").alias("plataforma"), F.lit("act_1").alias("pagina_id"), "*",
                    F.unix_date(E.iso_local_date("date_start")).alias("_day"))
    day = F.struct("date_start", "impressions", "reach", "clicks", "spend", "cpm", "cpc")
    name = F.concat(F.lit("Campaña "), F.col("campania_id"), F.lit(" #"), F.col("seq").cast("string"))
    listing = F.struct(F.array(F.struct(F.col("campania_id").alias("id"), name.alias("name"))).alias("data"))
    return (_pages(ids, "campaign_insights", F.struct(F.array(day).alias("data")), entity=F.col("campania_id"),
                   page_seq="_day").unionByName(_pages(ids, "campaigns", listing, page_seq="_day")))


def _two_campaign_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.when(F.col("seq") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    asked = _fx(spark, sf_dir, "F_J").select("*", F.explode(runs).alias("_run"))  # F-J is computed once for both runs
    later = F.col("_run") == 2
    return campaign_pages(asked.select(
        *[c for c in asked.columns if c not in ("spend", "_run")],
        F.when(later, F.concat("spend", F.lit(".5"))).otherwise(F.col("spend")).alias("spend"),
        F.when(later, "run_2").otherwise("run_1").alias("run_id"),
        F.when(later, RUN_DATES[2]).otherwise(RUN_DATES[1]).alias("run_date")))


@query("campaign_daily_two_runs", ORACLE["campaign_daily"].replace(
    "TRY_CAST(spend AS DOUBLE)", "TRY_CAST(CASE WHEN seq % 2 = 0 THEN spend || '.5' ELSE spend END AS DOUBLE)"))
def q_campaign_daily_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 / K6 from pages: the second run's days replace the stored ones."""
    out = landed.fold_runs(_two_campaign_runs(spark, sf_dir), {landed.CAMPAIGN_DAILY}, runs=RUNS, platforms=["facebook"])
    return K.conform(out[landed.CAMPAIGN_DAILY], S.T6_CAMPAIGN_DAILY)


@query("campaigns_two_runs", ORACLE["upsert_campaigns"])
def q_campaigns_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 (T5) from pages, over two runs."""
    out = landed.fold_runs(_two_campaign_runs(spark, sf_dir), {landed.CAMPAIGNS}, runs=RUNS, platforms=["facebook"])
    return K.conform(out[landed.CAMPAIGNS], S.T5_CAMPAIGNS)


def tt_account_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = SH.tt_account_points(_fx(spark, sf_dir, "F_G"))
    point = F.struct("end_time", "date", "value")
    return _pages(points, "account_insights", F.struct(F.struct(F.array(point).alias("values")).alias("data")))


_landed_query("tiktok_week_from_pages", "tiktok", tt_account_pages, landed.WEEKLY, AS_OF_ACCOUNT,
              ORACLE["tiktok_account_week"])


def tt_audience_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audience response per bucket, in the list of its dimension."""
    buckets = SH.tt_audience_buckets(_fx(spark, sf_dir, "F_H"))
    lists = [F.when(F.col("dim") == dim, F.array(F.struct("name", "count"))).alias(name)
             for name, dim in landed.TT_AUDIENCE_LISTS]
    return _pages(buckets, "audience", F.struct(F.struct(*lists).alias("data")))


_landed_query("tiktok_audience_from_pages", "tiktok", tt_audience_pages, landed.SEGMENTS, AS_OF_ACCOUNT,
              ORACLE["tiktok_audience"])


def _series_pages(points: DataFrame, endpoint: str, name: str = "name") -> DataFrame:
    """One Graph response with one series of one point for each point."""
    series = F.struct(F.col(name).alias("name"), F.array(F.struct("end_time", "value")).alias("values"))
    return _pages(points, endpoint, F.struct(F.array(series).alias("data")))


def _element_pages(elements: DataFrame, endpoint: str) -> DataFrame:
    fields = [c for c in elements.columns if c not in ("plataforma", "pagina_id", "seq")]
    return _pages(elements, endpoint, F.struct(F.array(F.struct(*fields)).alias("elements")))


def fb_week_pages(fb: DataFrame) -> DataFrame:
    return _series_pages(SH.fb_insight_points(fb, rename=_page_metric_name), "page_insights")


_landed_query("facebook_week_from_pages", "facebook", lambda spark, sf_dir: fb_week_pages(_fx(spark, sf_dir, "F_B")),
              landed.WEEKLY, AS_OF_ACCOUNT, ORACLE["facebook_page_week"])
_landed_query("instagram_week_from_pages", "instagram", lambda spark, sf_dir: _series_pages(
    SH.ig_account_points(_fx(spark, sf_dir, "F_G")), "account_insights", "serie"),
    landed.WEEKLY, AS_OF_ACCOUNT, ORACLE["instagram_account_week"])
_landed_query("linkedin_week_from_pages", "linkedin", lambda spark, sf_dir: _element_pages(
    SH.li_follower_elements(_fx(spark, sf_dir, "F_G")), "follower_statistics"),
    landed.WEEKLY, AS_OF_ACCOUNT, ORACLE["linkedin_account_week"])
_landed_query("facebook_audience_from_pages", "facebook", lambda spark, sf_dir: _series_pages(
    SH.fb_demographic_points(_fx(spark, sf_dir, "F_K")), "page_demographics", "serie"),
    landed.SEGMENTS, AS_OF_ACCOUNT, ORACLE["facebook_audience"])
_landed_query("linkedin_audience_from_pages", "linkedin", lambda spark, sf_dir: _element_pages(
    SH.li_country_elements(_fx(spark, sf_dir, "F_K")), "follower_countries"),
    landed.SEGMENTS, AS_OF_ACCOUNT, ORACLE["linkedin_audience"])

# The T1 columns of TikTok videos
_landed_query("tiktok_posts_from_pages", "tiktok", tt_landed_pages, landed.POSTS, AS_OF_ALL_POSTS, _ctes(
    {"ff": "F_F"}, ("v", _SQL_TT), final=(
        "SELECT 'tiktok' AS plataforma, pagina_id, creative_id AS publicacion_id, "
        "'https://tt.example/v/' || CAST(seq AS VARCHAR) AS url_publicacion, "
        "coalesce(CAST(substr(publish_time, 1, 19) AS TIMESTAMP), CASE WHEN strpos(create_time, '-') = 0 "
        "THEN make_timestamp(TRY_CAST(create_time AS BIGINT) * 1000000) ELSE CAST(substr(create_time, 1, 19) AS TIMESTAMP) END) "
        "AS fecha_hora_publicacion, 'video ' || CAST(seq AS VARCHAR) AS texto_publicacion, 'video' AS formato "
        f"FROM v WHERE cdate >= DATE_TRUNC('year', DATE '{AS_OF_ALL_POSTS}')")))


def ig_legacy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics in the older shape, values[-1].value[dim], a map of counts; an earlier value comes first."""
    fh = _fx(spark, sf_dir, "F_H").groupBy("pagina_id", "dim", "name").agg(F.max("cantidad").alias("cantidad"))
    # a page has at most 200 rows of F-H, so a map is bounded
    counts = F.map_from_entries(F.collect_list(F.struct("name", F.col("cantidad").cast("string"))))
    maps = fh.groupBy("pagina_id", "dim").agg(counts.alias("m"))
    earlier = F.transform_values("m", lambda _, v: F.lit("7"))
    value = [F.struct(F.create_map("dim", m).alias("value")) for m in (earlier, F.col("m"))]
    return _pages(maps.select("*", F.lit("instagram").alias("plataforma"), F.lit(1).alias("seq")), "demographics",
                  F.struct(F.array(F.struct(F.array(*value).alias("values"))).alias("data")), variant=F.col("dim"))


# The older shape
_landed_query("instagram_audience_legacy", "instagram", ig_legacy_pages, landed.SEGMENTS, AS_OF_ACCOUNT, _ctes(
    {"h": "F_H"}, final=("SELECT " + _sql_bucket_cols("instagram", "CAST(coalesce(max(cantidad), 0) AS BIGINT)")
                         + " FROM h GROUP BY pagina_id, dim, name")))


# ====================== runs that land late, unreadable pages, repaired deltas ======================

@query("posts_late_run", _SQL_TWO_POST_RUNS)
def q_posts_late_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on versions: the first run is merged after the second, and the second's rows stay."""
    out = landed.fold_versions(_two_post_runs(spark, sf_dir), RUNS[::-1], {landed.POSTS}, ["facebook"])
    return K.conform(out[landed.POSTS], S.T1_POSTS)


@query("weekly_late_run", ORACLE["facebook_page_week"].replace(
    "SELECT pagina_id, CAST(substr(end_time, 1, 10) AS DATE) AS dia, seq, value,",
    "SELECT pagina_id, CAST(substr(end_time, 1, 10) AS DATE) AS dia, seq, "
    "CASE WHEN extract(day FROM CAST(substr(end_time, 1, 10) AS DATE)) % 2 = 0 THEN value + 1 ELSE value END AS value,"))
def q_weekly_late_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 on versions: the second run has the even days only, one more each; the first one is merged after it."""
    fb = _fx(spark, sf_dir, "F_B")
    even = F.dayofmonth(E.iso_local_date("end_time")) % 2 == 0
    pages = _in_run(fb_week_pages(fb), 1).unionByName(
        _in_run(fb_week_pages(fb.where(even).withColumn("value", F.col("value") + 1)), 2))
    out = landed.fold_versions(pages, RUNS[::-1], {landed.WEEKLY}, ["facebook"])
    return K.conform(out[landed.WEEKLY], S.T3_WEEKLY)


@query("repair_deltas", _ctes(
    {"fa": "F_A"}, ("h", _SQL_STORED), ("b", _SQL_INCOMING),
    ("t", f"SELECT {_T2_FROM_FA} FROM h WHERE NOT EXISTS (SELECT 1 FROM b WHERE " + PK_MATCH.format(a="b", b="h")
     + f") UNION ALL SELECT {_T2_FROM_FA} FROM b"),
    final=f"SELECT *, {sql_deltas(True)} FROM t {POST_WINDOW}"))
def q_repair_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 in part: after a recompute and a run on top of it, only the run's posts are recomputed."""
    stored, incoming = _stored_and_incoming(_fx(spark, sf_dir, "F_A"))
    before = K.conform(D.recompute_deltas(_t2_from_fa(stored)), S.T2_DAILY)
    table = K.upsert_daily_metrics(before, _t2_from_fa(incoming))
    posts = incoming.select(*S.POST_KEY).distinct()
    changed = D.repaired_deltas(table.join(posts, S.POST_KEY, "left_semi").select(*table.columns))
    return K.conform(table.join(changed.select(*S.DAILY_KEY), S.DAILY_KEY, "left_anti").select(*table.columns)
                     .unionByName(changed), S.T2_DAILY)


@query("landing_rejects", _ctes({"fi": "F_I"}, (
    "p", "SELECT page_seq, page_seq % 5 = 0 OR page_seq % 7 = 0 AS bad, sum(CASE WHEN pos % 10 = 3 THEN 1 ELSE 0 END) AS n "
         "FROM fi GROUP BY page_seq"),
    final=("SELECT 'facebook' AS plataforma, 'page_fb' AS pagina_id, 'posts' AS endpoint, CAST(NULL AS VARCHAR) AS entity_id, "
           "CAST(NULL AS VARCHAR) AS variant, page_seq, CASE WHEN bad THEN 'ilegible' ELSE 'sin_clave' END AS motivo, "
           "CAST(CASE WHEN bad THEN 1 ELSE n END AS BIGINT) AS cantidad FROM p WHERE bad OR n > 0")))
def q_landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth page is cut in the middle, every seventh has no payload, some items have no id."""
    fi = _fx(spark, sf_dir, "F_I").withColumn("publicacion_id", F.when(F.col("pos") % 10 == 3, "").otherwise(
        F.col("publicacion_id")))
    pages = _landed(fi, lambda items, _: F.struct(items.alias("data")))
    n, text = F.col("page_seq"), F.col("payload")
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    return L.rejects(pages.withColumn("payload", F.when(n % 7 == 0, None).when(n % 5 == 0, half).otherwise(text)))
