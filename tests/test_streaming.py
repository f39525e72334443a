"""Incremental ingest by run: complete runs only, whole, in order, once."""

import datetime as dt
import json
import os
import subprocess
import sys
import tempfile

from metricas.plans import landed
from metricas.sources import tables as TB
from metricas.streaming import process_runs, run_available

DAILY = "metricas_publicaciones_diarias"


def _drop(folder, name, rows, run_id="r1", run_date="2024-03-05"):
    with open(os.path.join(folder, name), "w") as f:
        for plataforma, pagina, endpoint, entity, variant, seq, payload in rows:
            f.write(json.dumps({"plataforma": plataforma, "pagina_id": pagina, "endpoint": endpoint,
                                "entity_id": entity, "variant": variant, "page_seq": seq, "run_id": run_id,
                                "run_date": run_date, "payload": json.dumps(payload)}) + "\n")


END = ("", "", "run_end", None, None, 99, {})
POST = {"id": "p1", "created_time": "2024-03-01T10:00:00+0000", "reactions": {"summary": {"total_count": 3}}}
POSTS = ("facebook", "pg", "posts", None, None, 1, {"data": [POST]})


def insights(day, value, seq=2):
    return ("facebook", "pg", "post_insights", "p1", None, seq, {"data": [{"name": "post_video_views", "values": [
        {"end_time": f"2024-03-0{day}T08:00:00+0000", "value": value}]}]})


def folders():
    return tempfile.mkdtemp(prefix="metricas-landing-"), tempfile.mkdtemp(prefix="metricas-tables-")


def daily(spark, root):
    return sorted((r.fecha_descarga.day, r.visualizaciones, r.delta_visualizaciones)
                  for r in TB.tables(spark, root)[DAILY].read().collect())


def test_runs_are_processed_once_complete_and_in_order(spark):
    landing, root = folders()
    _drop(landing, "a.json", [POSTS])
    assert run_available(spark, landing, root) == []  # the run's other pages are still to land
    _drop(landing, "b.json", [insights(2, 10), END])
    assert run_available(spark, landing, root) == [(dt.date(2024, 3, 5), "r1")]
    assert daily(spark, root) == [(2, 10, 10)]
    _drop(landing, "d.json", [POSTS, insights(4, 30), END], "r3", "2024-03-07")
    _drop(landing, "c.json", [POSTS, insights(3, 16), END], "r2", "2024-03-06")
    assert [r for _, r in run_available(spark, landing, root)] == ["r2", "r3"]
    assert daily(spark, root) == [(2, 10, 10), (3, 16, 6), (4, 30, 14)]
    assert [r.publicacion_id for r in TB.tables(spark, root)["publicaciones"].read().collect()] == ["p1"]
    # a new process finds the log and has nothing to do
    code = ("import sys; from metricas.session import local_session; from metricas.streaming import run_available;"
            "print('DID', run_available(local_session(2), *sys.argv[1:]))")
    out = subprocess.run([sys.executable, "-c", code, landing, root], capture_output=True, text=True, timeout=300,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "DID []" in out.stdout, out.stderr[-2000:]


def test_a_run_is_dated_by_itself_and_merging_it_twice_changes_nothing(spark):
    landing, root = folders()
    account = ("tiktok", "tt", "account_insights", None, None, 1, {"data": {"values": [
        {"end_time": "2023-12-30T00:00:00Z", "value": {"views": 5, "followers": 10}}, {"value": {"views": 1}}]}})
    nothing = [("facebook", "pg", "posts", None, None, 2, {"data": [{"created_time": POST["created_time"]}, POST]}),
               ("facebook", "pg", "post_insights", "p1", None, 3, {"data": [{"name": "post_clicks", "values": [{"value": 4}]}]}),
               ("facebook", "pg", "page_insights", None, None, 4, {"data": [{"name": "page_fans", "values": [{"value": 4}]}]}),
               ("tiktok", "tt", "audience", None, None, 5, {"data": {"by_gender": [{"name": "F", "count": 3}]}})]
    _drop(landing, "a.json", [account, *nothing, insights(2, 7, 6), END], run_date="2024-01-01")
    pages = landed.L.read_landed(spark, landing, "json")
    seen = []
    for _ in range(2):
        process_runs(spark, pages, root, landed.L.runs(pages))
        t = TB.tables(spark, root)
        seen.append({n: sorted(map(str, t[n].read().collect())) for n in
                     ("publicaciones", DAILY, "estadisticas_pagina_semanal", "segmentacion_seguidores_semanal")})
    assert seen[0] == seen[1]
    assert [len(v) for v in seen[0].values()] == [1, 1, 1, 1]


def test_two_runs_with_the_same_page_numbers(spark, pages):
    video = lambda day, views: {"data": {"creatives": [{"creative_id": "v1", "create_time": "2024-02-01T00:00:00Z",
                                                         "caption": day, "view_count": views}]}}
    d = dt.date(2024, 3, 1)
    pg = pages([("tiktok", "tt", "videos", None, None, 9, video("day1", 5), "r1", d),
                ("tiktok", "tt", "videos", None, None, 1, video("day2", 9), "r2", d + dt.timedelta(1))])
    out = landed.fold_runs(pg)
    assert [r.texto_publicacion for r in out["publicaciones"].collect()] == ["day2"]
    assert [(r.visualizaciones, r.delta_visualizaciones) for r in out[DAILY].collect()] == [(9, 9)]


def test_a_failing_run_leaves_the_tables_as_they_were(spark):
    landing, root = folders()
    _drop(landing, "a.json", [POSTS, insights(2, 10), END])
    run_available(spark, landing, root)
    from pyspark.sql import functions as F
    t = TB.tables(spark, root)
    good = t["publicaciones"].read().withColumn("texto_publicacion", F.lit("new"))
    bad = t[DAILY].read().withColumn("alcance", F.raise_error(F.lit("broken")).cast("bigint"))
    try:
        TB.merge_run(spark, root, {"publicaciones": good, DAILY: bad})
        raise AssertionError("the broken output went through")
    except Exception as e:
        assert "broken" in str(e)
    assert [r.texto_publicacion for r in t["publicaciones"].read().collect()] == [None]
    assert daily(spark, root) == [(2, 10, 10)]
