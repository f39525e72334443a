"""Schemas: landed pages, item payloads (as read with ``from_json``) and target tables.

Counters that the platforms send as JSON numbers are declared STRING here and
converted with ``functions.int_or_zero`` so that ``5.7``, ``"12"`` or an object
in one field is handled by that field's rule and not by the JSON reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

# One landed API response page. ``entity_id``/``variant`` hold what only the
# request knew (post id asked about, reaction type, breakdown dimension...).
# ``page_seq`` is the page's position in its landing run, unique within the run:
# it fixes the arrival order every "last wins" rule uses. A run (``run_date``,
# ``run_id``) is one call of the ingest; ``run_date`` is its "today". Its last
# page has the endpoint RUN_END, which says that all of its pages have landed.
LANDED_PAGE = T.StructType([
    T.StructField("plataforma", T.StringType(), False),
    T.StructField("pagina_id", T.StringType(), False),
    T.StructField("endpoint", T.StringType(), False),
    T.StructField("entity_id", T.StringType(), True),
    T.StructField("variant", T.StringType(), True),
    T.StructField("page_seq", T.LongType(), False),
    T.StructField("payload", T.StringType(), True),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("run_date", T.DateType(), True),
])
RUN = ["run_date", "run_id"]
RUN_END = "run_end"

# ---- item payload schemas (DDL) ----
FB_POST = (
    "id STRING, created_time STRING, message STRING, permalink_url STRING, status_type STRING, "
    "attachments STRUCT<data: ARRAY<STRUCT<media_type: STRING, unshimmed_url: STRING>>>, "
    "shares STRUCT<count: STRING>, comments STRUCT<summary: STRUCT<total_count: STRING>>, "
    "reactions STRUCT<summary: STRUCT<total_count: STRING>>"
)
FB_SERIES = "name STRING, values ARRAY<STRUCT<end_time: STRING, value: STRING>>"
FB_REACTION_SUMMARY = "summary STRUCT<total_count: STRING>"
FB_DEMOGRAPHICS = "name STRING, values ARRAY<STRUCT<end_time: STRING, value: MAP<STRING, STRING>>>"

IG_MEDIA = (
    "id STRING, caption STRING, media_type STRING, media_url STRING, permalink STRING, "
    "timestamp STRING, like_count STRING, comments_count STRING, video_view_count STRING, video_views STRING"
)
IG_INSIGHT = "name STRING, values ARRAY<STRUCT<value: STRING>>"
IG_ACCOUNT_SERIES = "name STRING, values ARRAY<STRUCT<end_time: STRING, value: STRING>>"
IG_DEMOGRAPHICS = (
    "breakdowns ARRAY<STRUCT<dimension: STRING, values: ARRAY<STRUCT<name: STRING, value: STRING>>>>, "
    "values ARRAY<STRUCT<value: MAP<STRING, MAP<STRING, STRING>>>>"
)

LI_POST = (
    "urn STRING, id STRING, createdAt STRUCT<time: BIGINT>, lastModifiedAt STRUCT<time: BIGINT>, "
    "commentary STRUCT<text: STRING>, permalinks STRING, permalink STRING, "
    "content STRUCT<media: STRUCT<type: STRING>>, associatedUrn STRING, activity STRING"
)
LI_UGC_POST = (
    "id STRING, urn STRING, created STRUCT<time: BIGINT>, lastModifiedAt STRUCT<time: BIGINT>, "
    "specificContent STRUCT<`com.linkedin.ugc.ShareContent`: STRUCT<shareCommentary: STRUCT<text: STRING>, "
    "media: ARRAY<STRUCT<status: STRING>>>>, lifecycleActivity STRING, activity STRING"
)
LI_SHARE = (
    "urn STRING, id STRING, created STRUCT<time: BIGINT>, lastModified STRUCT<time: BIGINT>, "
    "text STRUCT<text: STRING>, permalink STRING, activity STRING"
)
LI_SOCIAL_ACTIONS = (
    "likesSummary STRUCT<totalLikes: STRING>, commentsSummary STRUCT<totalFirstLevelComments: STRING>, "
    "totalShareStatistics STRING, shares STRING"
)
LI_FOLLOWER_STAT = (
    "timeRange STRUCT<end: BIGINT>, followerCounts STRUCT<organicFollowerCount: BIGINT>, "
    "followerGains STRUCT<organicFollowerGain: BIGINT>, "
    "followerCountsByCountry STRUCT<country: STRING, followerCount: STRING>, country STRING, "
    "aggregations STRUCT<country: STRING>"
)

TT_VIDEO = (
    "creative_id STRING, id STRING, create_time STRING, publish_time STRING, caption STRING, "
    "title STRING, share_url STRING, permalink STRING, like_count STRING, comment_count STRING, "
    "share_count STRING, view_count STRING"
)
TT_VIDEO_INSIGHTS = (
    "views STRING, likes STRING, comments STRING, shares STRING, saves STRING, reach STRING"
)
TT_ACCOUNT_POINT = (
    "end_time STRING, date STRING, value STRUCT<views: STRING, followers: STRING, profile_views: STRING>"
)
TT_BUCKET = "name STRING, count STRING"

CAMPAIGN = "id STRING, name STRING"
CAMPAIGN_DAY = (
    "date_start STRING, impressions STRING, reach STRING, clicks STRING, spend STRING, "
    "cpm STRING, cpc STRING, ctr STRING"
)

# ---- target tables ----
POST_KEY = ["plataforma", "pagina_id", "publicacion_id"]
DAILY_KEY = POST_KEY + ["fecha_descarga"]
WEEKLY_KEY = ["plataforma", "pagina_id", "fecha_corte_semana"]
SEGMENT_KEY = ["plataforma", "pagina_id", "fecha_corte_semana", "genero", "pais", "ciudad",
               "nivel_educacion"]
CAMPAIGN_KEY = ["campania_id", "plataforma", "cuenta_id"]
CAMPAIGN_DAILY_KEY = ["plataforma", "cuenta_id", "campania_id", "fecha_descarga"]

T1_POSTS = T.StructType([
    T.StructField("plataforma", T.StringType(), False),
    T.StructField("pagina_id", T.StringType(), False),
    T.StructField("publicacion_id", T.StringType(), False),
    T.StructField("url_publicacion", T.StringType(), True),
    T.StructField("fecha_hora_publicacion", T.TimestampType(), True),
    T.StructField("texto_publicacion", T.StringType(), True),
    T.StructField("formato", T.StringType(), True),
])

# Metric columns of T2, in table order (fixed values).
DAILY_COUNTERS = [
    "visualizaciones", "alcance", "impresiones",
    "reacciones", "me_gusta", "me_encanta", "me_divierte", "me_asombra", "me_entristece", "me_enoja",
    "comentarios", "compartidos", "guardados", "clics_enlace",
]
# Metrics that get a delta column (there is no delta for impresiones).
DELTA_METRICS = ["visualizaciones", "alcance", "reacciones", "comentarios", "compartidos", "guardados"]

T2_DAILY = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in POST_KEY]
    + [T.StructField("fecha_descarga", T.DateType(), False)]
    + [T.StructField(c, T.LongType(), True) for c in DAILY_COUNTERS[:3]]
    + [T.StructField("tiempo_promedio_seg_numeric", T.DoubleType(), True)]
    + [T.StructField(c, T.LongType(), True) for c in DAILY_COUNTERS[3:]]
    + [T.StructField("ctr", T.DoubleType(), True)]
    + [T.StructField(f"delta_{c}", T.LongType(), True) for c in DELTA_METRICS]
)

T3_WEEKLY = T.StructType([
    T.StructField("plataforma", T.StringType(), False),
    T.StructField("pagina_id", T.StringType(), False),
    T.StructField("fecha_corte_semana", T.DateType(), False),
    T.StructField("total_seguidores", T.LongType(), True),
    T.StructField("alcance_pagina", T.LongType(), True),
    T.StructField("visualizaciones_pagina", T.LongType(), True),
])

T4_SEGMENTS = T.StructType([
    T.StructField("plataforma", T.StringType(), False),
    T.StructField("pagina_id", T.StringType(), False),
    T.StructField("fecha_corte_semana", T.DateType(), False),
    T.StructField("genero", T.StringType(), True),
    T.StructField("pais", T.StringType(), True),
    T.StructField("ciudad", T.StringType(), True),
    T.StructField("nivel_educacion", T.StringType(), True),
    T.StructField("cantidad_seguidores", T.LongType(), True),
])

T5_CAMPAIGNS = T.StructType([
    T.StructField("campania_id", T.StringType(), False),
    T.StructField("plataforma", T.StringType(), False),
    T.StructField("cuenta_id", T.StringType(), False),
    T.StructField("nombre_campania", T.StringType(), True),
])

T6_CAMPAIGN_DAILY = T.StructType([
    T.StructField("plataforma", T.StringType(), False),
    T.StructField("cuenta_id", T.StringType(), False),
    T.StructField("campania_id", T.StringType(), False),
    T.StructField("fecha_descarga", T.DateType(), False),
    T.StructField("presupuesto_invertido", T.DoubleType(), True),
    T.StructField("impresiones", T.LongType(), True),
    T.StructField("alcance", T.LongType(), True),
    T.StructField("cpm", T.DoubleType(), True),
    T.StructField("cpc", T.DoubleType(), True),
    T.StructField("ctr", T.DoubleType(), True),
])
