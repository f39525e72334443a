"""The command line on a small landed folder: ingest, then recompute deltas."""

import json
import os
import tempfile

import pytest

from metricas.__main__ import main
from metricas.sources import tables as TB


@pytest.fixture
def restore_conf(spark):
    before = dict(spark.conf.getAll)
    yield
    for k in set(spark.conf.getAll) - set(before):
        if spark.conf.isModifiable(k):
            spark.conf.unset(k)
    for k, v in before.items():
        if spark.conf.isModifiable(k) and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def test_ingest_and_recompute(spark, restore_conf):
    landing = tempfile.mkdtemp(prefix="metricas-landing-")
    root = tempfile.mkdtemp(prefix="metricas-tables-")
    pages = [
        {"plataforma": "tiktok", "pagina_id": "tt", "endpoint": "videos", "page_seq": 1,
         "payload": json.dumps({"data": {"creatives": [{"creative_id": "v1", "create_time": "2024-02-01T00:00:00Z",
                                                         "view_count": 5}]}})},
        {"plataforma": "tiktok", "pagina_id": "tt", "endpoint": "audience", "page_seq": 2,
         "payload": json.dumps({"data": {"by_gender": [{"name": "F", "count": 3}]}})},
    ]
    with open(os.path.join(landing, "p.json"), "w") as f:
        f.write("\n".join(json.dumps(p) for p in pages))
    main(["ingest", "--landing", landing, "--tables", root, "--platform", "tiktok", "--as-of", "2024-03-01"])
    t = TB.tables(spark, root)
    daily = t["metricas_publicaciones_diarias"].read().collect()
    assert [(r.publicacion_id, r.visualizaciones, r.delta_visualizaciones) for r in daily] == [("v1", 5, 5)]
    assert [(r.genero, r.cantidad_seguidores) for r in t["segmentacion_seguidores_semanal"].read().collect()] == [
        ("F", 3)]
    main(["recompute-deltas", "--tables", root])
    assert [r.delta_visualizaciones for r in t["metricas_publicaciones_diarias"].read().collect()] == [None]
