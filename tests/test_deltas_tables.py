"""D1/D2 edge vectors (FIXTURES.md section 3, rows 19-22, 28) and table-level merge properties."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.operators import deltas as D
from metricas.operators import joins as J
from metricas.operators import merge as K
from metricas.sources import tables as TB

DAY = dt.date(2024, 1, 1)


def daily(spark, rows):
    """rows: (post, day offset, visualizaciones)."""
    df = spark.createDataFrame([("facebook", "pg", p, DAY + dt.timedelta(days=d), v) for p, d, v in rows],
                               "plataforma string, pagina_id string, publicacion_id string, fecha_descarga date, v bigint")
    return K.conform(J.daily_rows(df, visualizaciones=F.col("v"), alcance=F.col("v")), S.T2_DAILY)


def deltas_of(df):
    return sorted((r.fecha_descarga, r.visualizaciones, r.delta_visualizaciones) for r in df.collect())


def test_ingest_vs_recompute_first_row(spark):
    batch = daily(spark, [("p", 1, 10), ("p", 2, 13)])
    assert deltas_of(D.ingest_deltas(batch)) == [(DAY + dt.timedelta(1), 10, 10), (DAY + dt.timedelta(2), 13, 3)]
    assert deltas_of(D.recompute_deltas(batch)) == [(DAY + dt.timedelta(1), 10, None), (DAY + dt.timedelta(2), 13, 3)]


def test_late_arrival_then_recompute(spark):
    stored = K.conform(D.ingest_deltas(daily(spark, [("p", 1, 10), ("p", 3, 20)])), S.T2_DAILY)
    merged = K.upsert_daily_metrics(stored, daily(spark, [("p", 2, 12)]))
    d = lambda n: DAY + dt.timedelta(n)
    # Day 2 against day 1; day 3 keeps its stored delta (10)
    assert deltas_of(merged) == [(d(1), 10, 10), (d(2), 12, 2), (d(3), 20, 10)]
    # D2 repairs day 3
    assert deltas_of(D.recompute_deltas(merged)) == [(d(1), 10, None), (d(2), 12, 2), (d(3), 20, 8)]


def test_reingest_uses_previous_day_not_old_value(spark):
    stored = K.conform(D.ingest_deltas(daily(spark, [("p", 1, 10), ("p", 2, 13)])), S.T2_DAILY)
    merged = K.upsert_daily_metrics(stored, daily(spark, [("p", 2, 30)]))
    assert deltas_of(merged) == [(DAY + dt.timedelta(1), 10, 10), (DAY + dt.timedelta(2), 30, 20)]


def test_weekly_row_uses_impressions(spark):
    w = spark.createDataFrame([("facebook", "pg", DAY, 5, 9, 1, 2)],
                              "plataforma string, pagina_id string, fecha_corte date, impresiones bigint, "
                              "video_views bigint, alcance bigint, fans_total bigint")
    r = K.weekly_stats_rows(w).first()
    assert (r.visualizaciones_pagina, r.alcance_pagina, r.total_seguidores) == (5, 1, 2)


def test_result_does_not_depend_on_partitioning(spark):
    base = daily(spark, [(f"p{i % 7}", i % 11, i) for i in range(200)])
    base = K.latest_by_key(base.withColumn("seq", F.monotonically_increasing_id()), S.DAILY_KEY).drop("seq")
    a = deltas_of(D.recompute_deltas(base.repartition(1)))
    b = deltas_of(D.recompute_deltas(base.repartition(13, "fecha_descarga")))
    assert a == b


def test_insert_ignore_null_safe_and_first_wins(spark):
    seg = spark.createDataFrame(
        [("tiktok", "pg", DAY, None, "BO", None, None, 5, 2), ("tiktok", "pg", DAY, None, "BO", None, None, 7, 1)],
        "plataforma string, pagina_id string, fecha_corte_semana date, genero string, pais string, ciudad string, "
        "nivel_educacion string, cantidad_seguidores bigint, seq bigint")
    first = K.insert_ignore(None, seg, S.SEGMENT_KEY)
    assert [r.cantidad_seguidores for r in first.collect()] == [7]
    again = K.insert_ignore(first, seg.withColumn("cantidad_seguidores", F.lit(99)), S.SEGMENT_KEY)
    assert [r.cantidad_seguidores for r in again.collect()] == [7]


def _snapshot(df):
    return sorted(tuple(r) for r in df.collect())


def test_table_merge_is_idempotent_and_partition_scoped(spark):
    root = tempfile.mkdtemp(prefix="metricas-tables-")
    t2 = TB.tables(spark, root)["metricas_publicaciones_diarias"]
    jan = daily(spark, [("p", 1, 10), ("p", 3, 20), ("q", 2, 5)])
    TB.merge_daily(t2, jan)
    once = _snapshot(t2.read())
    TB.merge_daily(t2, jan)
    assert _snapshot(t2.read()) == once
    # a later run in February touches only the February partition; D1 still sees January history
    feb = daily(spark, [("p", 40, 25)])
    TB.merge_daily(t2, feb)
    rows = {(r.publicacion_id, r.fecha_descarga): r.delta_visualizaciones for r in t2.read().collect()}
    assert rows[("p", DAY + dt.timedelta(40))] == 5
    assert len(rows) == 4
    parts = sorted(os.listdir(os.path.join(root, "metricas_publicaciones_diarias", "plataforma=facebook")))
    assert parts == ["mes=2024-01-01", "mes=2024-02-01"]
    # K5 over the stored table: first rows become NULL
    TB.recompute_all_deltas(t2)
    rows = {(r.publicacion_id, r.fecha_descarga): r.delta_visualizaciones for r in t2.read().collect()}
    assert rows[("p", DAY + dt.timedelta(1))] is None and rows[("p", DAY + dt.timedelta(3))] == 10


def test_posts_table_upsert_last_wins(spark):
    root = tempfile.mkdtemp(prefix="metricas-tables-")
    t1 = TB.tables(spark, root)["publicaciones"]
    mk = lambda text, seq: spark.createDataFrame(
        [("facebook", "pg", "p1", "u", None, text, "video", seq)],
        "plataforma string, pagina_id string, publicacion_id string, url_publicacion string, "
        "fecha_hora_publicacion timestamp, texto_publicacion string, formato string, seq bigint")
    TB.merge_posts(t1, mk("a", 1).unionByName(mk("b", 2)))
    assert [r.texto_publicacion for r in t1.read().collect()] == ["b"]
    TB.merge_posts(t1, mk("c", 1))
    assert [r.texto_publicacion for r in t1.read().collect()] == ["c"]


def test_posts_table_rewrites_only_the_buckets_of_the_run(spark):
    root = tempfile.mkdtemp(prefix="metricas-tables-")
    t1 = TB.tables(spark, root)["publicaciones"]
    mk = lambda page, pid, text, seq: spark.createDataFrame(
        [("facebook", page, pid, "u", dt.datetime(2024, 1, 5), text, "video", seq)],
        "plataforma string, pagina_id string, publicacion_id string, url_publicacion string, "
        "fecha_hora_publicacion timestamp, texto_publicacion string, formato string, seq bigint")
    TB.merge_posts(t1, mk("pg1", "p1", "a", 1).unionByName(mk("pg2", "p2", "b", 2)))

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(t1.path) for f in names if f.startswith("part-")}
    before = files()
    TB.merge_posts(t1, mk("pg1", "p1", "c", 3))
    assert sorted((r.pagina_id, r.texto_publicacion) for r in t1.read().collect()) == [("pg1", "c"), ("pg2", "b")]
    assert len(before) == 2 and len(files() & before) == 1


def test_weekly_and_segment_tables_across_runs(spark):
    root = tempfile.mkdtemp(prefix="metricas-tables-")
    t = TB.tables(spark, root)
    wk = lambda d, fans, seq: spark.createDataFrame(
        [("instagram", "ig", d, fans, 1, 0, seq)],
        "plataforma string, pagina_id string, fecha_corte_semana date, total_seguidores bigint, "
        "alcance_pagina bigint, visualizaciones_pagina bigint, seq bigint")
    TB.merge_weekly(t["estadisticas_pagina_semanal"], wk(DAY, 10, 1))
    TB.merge_weekly(t["estadisticas_pagina_semanal"], wk(DAY, 12, 2).unionByName(wk(DAY + dt.timedelta(2), 13, 3)))
    assert sorted((r.fecha_corte_semana.day, r.total_seguidores)
                  for r in t["estadisticas_pagina_semanal"].read().collect()) == [(1, 12), (3, 13)]
    seg = lambda pais, n, seq: spark.createDataFrame(
        [("linkedin", "org", DAY, None, pais, None, None, n, seq)],
        "plataforma string, pagina_id string, fecha_corte_semana date, genero string, pais string, "
        "ciudad string, nivel_educacion string, cantidad_seguidores bigint, seq bigint")
    TB.merge_segments(t["segmentacion_seguidores_semanal"], seg("US", 4, 1))
    TB.merge_segments(t["segmentacion_seguidores_semanal"], seg("US", 6, 2).unionByName(seg("BO", 1, 3)))
    assert sorted((r.pais, r.cantidad_seguidores) for r in t["segmentacion_seguidores_semanal"].read().collect()) == [
        ("BO", 1), ("US", 4)]
