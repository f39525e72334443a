"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from metricas.plans import catalog
from tools.check_oracle import SPARK_TO_DUCK, TABLES, digest

SF_DIR = os.environ.get("METRICAS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())


def test_the_rest_works_without_the_optional_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/metricas", f"{tmp_path}/metricas", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(entry.__file__, tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [*catalog.QUERIES, *catalog.ORACLE], out.stderr[-2000:]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert s_types == {c[0]: str(c[1]) for c in res.description}
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "delta_visualizaciones" in df.columns


def test_queries_do_not_depend_on_the_callers_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/La_Paz")
    try:
        row = entry.queries()["facebook_posts"](spark, SF_DIR).orderBy("publicacion_id").first()
        # created_time 'YYYY-MM-DDT00:00:00Z' renders as midnight
        assert (row.fecha_hora_publicacion.hour, row.fecha_hora_publicacion.minute) == (0, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
