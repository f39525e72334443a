"""Inputs derived from the driver tables (FIXTURES.md section 2).

Each fixture is one SELECT that is valid in Spark SQL and in DuckDB. ``{events}``-style
placeholders name the driver tables; ``{days}`` is the engine's "days since
1970-01-01 of o_orderdate". Spark binds the placeholders to DataFrames read from
the scale-factor folder, DuckDB to its pre-registered views, so both sides
start from the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metricas.session import pin_utc

SPARK_DAYS = "datediff(cast(o_orderdate as date), date'1970-01-01')"
DUCK_DAYS = "date_diff('day', date'1970-01-01', cast(o_orderdate as date))"

F_A = """
select case user_id % 4 when 0 then 'facebook' when 1 then 'instagram' when 2 then 'linkedin' else 'tiktok' end as plataforma,
  concat('page_', cast(user_id % 10 as string)) as pagina_id,
  concat('post_', cast(user_id as string)) as publicacion_id,
  cast(ts as date) as fecha_descarga,
  count(*) filter (where event_type = 'view') as visualizaciones,
  count(*) filter (where event_type = 'signup') as alcance,
  count(*) as impresiones,
  count(*) filter (where event_type = 'click') as reacciones,
  count(*) filter (where event_type = 'error') as comentarios,
  count(*) filter (where event_type = 'purchase') as compartidos,
  count(*) filter (where value > 50) as guardados
from {events} group by 1, 2, 3, 4
"""

F_B = """
select event_id as seq,
  concat('page_', cast(user_id % 10 as string)) as pagina_id,
  concat('post_', cast(user_id as string)) as publicacion_id,
  concat(cast(cast(ts as date) as string), 'T08:00:00+0000') as end_time,
  case event_type when 'view' then 'post_impressions' when 'signup' then 'post_impressions_unique'
    when 'click' then 'post_clicks' when 'purchase' then 'post_video_views' else 'post_other' end as name,
  cast(floor(value) as bigint) as value
from {events}
"""

# F-C plus permalink/message and two video-view fields used by the Instagram job.
F_C = """
select o_orderkey as seq, concat('post_', cast(o_orderkey as string)) as publicacion_id,
  concat(cast(cast(o_orderdate as date) as string), 'T00:00:00Z') as created_time,
  case o_orderkey % 6 when 0 then 'photo' when 1 then 'video_inline' when 2 then 'album' when 3 then 'link' when 4 then 'IMAGE' end as media_type,
  case o_orderpriority when '1-URGENT' then 'added_video' when '2-HIGH' then 'added_photos' when '3-MEDIUM' then 'shared_story' when '5-LOW' then 'mobile_status_update' end as status_type,
  case when o_orderkey % 7 = 0 then null else cast(floor(o_totalprice) as bigint) % 500 end as comentarios,
  cast(floor(o_totalprice) as bigint) % 900 as reacciones,
  concat('https://social.example/p/', cast(o_orderkey as string)) as permalink_url,
  concat('pedido ', o_orderstatus, ' ', o_orderpriority) as message,
  case when o_orderkey % 4 = 0 then cast(floor(o_totalprice) as bigint) % 300 end as video_view_count,
  case when o_orderkey % 4 in (0, 1) then 0 when o_orderkey % 4 = 2 then cast(floor(o_totalprice) as bigint) % 200 end as video_views
from {orders}
"""

F_D = """
select concat('post_', cast(l_orderkey as string)) as publicacion_id,
  cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as bigint) as seq,
  case l_linenumber when 1 then 'LIKE' when 2 then 'LOVE' when 3 then 'HAHA' when 4 then 'WOW' when 5 then 'SAD' when 6 then 'ANGRY' else 'CARE' end as tipo,
  cast(floor(l_quantity) as bigint) as total_count
from {lineitem}
"""

# F-E plus a last-modified time (used when the created time is absent).
F_E = """
select o_orderkey as seq, concat('org_', cast(o_custkey % 10 as string)) as pagina_id,
  case o_orderkey % 3 when 0 then 'posts' when 1 then 'ugcPosts' else 'shares' end as source,
  case when o_orderkey % 5 = 0 then null else concat('urn:li:share:', cast(o_orderkey as string)) end as urn,
  cast(o_orderkey as string) as id,
  case when o_orderkey % 11 = 0 then null else cast({days} as bigint) * 86400000 end as created_ms,
  case when o_orderkey % 22 = 0 then null else cast({days} as bigint) * 86400000 + 3600000 end as modified_ms,
  case when o_orderkey % 2 = 0 then null else concat('urn:li:activity:', cast(o_orderkey as string)) end as activity,
  o_orderstatus as media_status
from {orders}
"""

# F-F plus a publish time, the other list counters, the insight counters and a page.
F_F = """
select o_orderkey as seq, case when o_orderkey % 13 = 0 then null else cast(o_orderkey as string) end as creative_id,
  concat('biz_', cast(o_custkey % 3 as string)) as pagina_id,
  case when o_orderkey % 2 = 0 then cast(cast({days} as bigint) * 86400 as string)
    else concat(cast(cast(o_orderdate as date) as string), 'T00:00:00Z') end as create_time,
  case when o_orderkey % 5 = 0 then concat(cast(extract(year from o_orderdate) - 1 as string), '-06-15T10:00:00Z') end as publish_time,
  case when o_orderkey % 4 = 0 then 0 else cast(floor(o_totalprice) as bigint) % 1000 end as view_count,
  case when o_orderkey % 3 = 0 then 0 else cast(floor(o_totalprice) as bigint) % 50 end as like_count,
  cast(floor(o_totalprice) as bigint) % 7 as comment_count,
  cast(0 as bigint) as share_count,
  cast(floor(o_totalprice) as bigint) % 777 as insight_views,
  cast(floor(o_totalprice) as bigint) % 61 as insight_likes,
  cast(floor(o_totalprice) as bigint) % 17 as insight_comments,
  cast(floor(o_totalprice) as bigint) % 13 as insight_shares,
  cast(floor(o_totalprice) as bigint) % 11 as insight_saves,
  cast(floor(o_totalprice) as bigint) % 1009 as insight_reach
from {orders}
"""

F_G = """
select concat('page_', cast(user_id % 10 as string)) as pagina_id, cast(ts as date) as dia,
  case event_type when 'view' then 'reach' when 'click' then 'follower_count' else 'profile_views' end as serie,
  max(event_id) as seq, cast(count(distinct user_id) as bigint) as valor
from {events} group by 1, 2, 3
"""

F_H = """
select c_custkey as seq, concat('page_', cast(cast(floor(c_custkey / 200) as bigint) as string)) as pagina_id,
  case c_custkey % 4 when 0 then 'country' when 1 then 'city' when 2 then 'gender' else 'age' end as dim,
  case c_custkey % 4 when 0 then concat('n', cast(c_nationkey as string)) when 1 then concat('City ', cast(c_nationkey as string))
    when 2 then substr(c_mktsegment, 1, 1) else case when c_acctbal < 0 then '13-17' when c_acctbal < 5000 then '18-24' else '25-34' end end as name,
  case when c_custkey % 17 = 0 then null else cast(floor(abs(c_acctbal)) as bigint) end as cantidad
from {customer}
"""

F_I = """
select cast(floor(o_orderkey / 50) as bigint) as page_seq, o_orderkey % 50 as pos,
  concat('post_', cast(o_orderkey as string)) as publicacion_id
from {orders}
"""

# F-J plus reach / cpm / cpc as an ads API returns them (text, sometimes missing).
F_J = """
select concat('camp_', cast(l_suppkey as string)) as campania_id, concat(cast(cast(l_shipdate as date) as string)) as date_start,
  cast(sum(cast(floor(l_quantity) as bigint)) as string) as impressions,
  cast(count(*) as string) as clicks,
  cast(sum(cast(floor(l_extendedprice) as bigint)) as string) as spend,
  case when count(*) > 1 then cast(count(*) * 3 as string) end as reach,
  concat(cast(sum(cast(floor(l_quantity) as bigint)) % 97 as string), '.25') as cpm,
  case when max(l_linenumber) > 3 then concat(cast(count(*) as string), '.5') end as cpc,
  min(l_suppkey) as seq
from {lineitem} group by 1, 2
"""

F_K = """
select concat('page_', cast(user_id % 10 as string)) as pagina_id, cast(ts as date) as dia,
  case when extract(day from ts) % 7 = 0 then null when event_id % 3 = 0 then upper(event_type) else event_type end as clave,
  max(event_id) as seq, count(*) as cantidad
from {events} group by 1, 2, 3
"""

FIXTURES = {"F_A": F_A, "F_B": F_B, "F_C": F_C, "F_D": F_D, "F_E": F_E, "F_F": F_F, "F_G": F_G,
            "F_H": F_H, "F_I": F_I, "F_J": F_J, "F_K": F_K}

DRIVER_TABLES = ["events", "orders", "lineitem", "customer"]


def duck(name: str) -> str:
    """The fixture as DuckDB SQL over the pre-registered driver views."""
    return FIXTURES[name].format(days=DUCK_DAYS, **{t: t for t in DRIVER_TABLES})


def spark_fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a Spark DataFrame over the parquet tables of ``sf_dir``."""
    pin_utc(spark)
    text = FIXTURES[name].replace("{days}", SPARK_DAYS)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **tables)
