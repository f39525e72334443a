"""The registered queries: all of them and the pipeline, and those with SQL against DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from metricas.llm import oracle, queries
from tools.check_oracle import SPARK_TO_DUCK, digest

SF_DIR = os.environ.get("METRICAS_TEST_SF", "/root/testdata/sf0.001")


def test_all_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(oracle.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle.ORACLE[name])
    columns = {c[0]: str(c[1]) for c in res.description}
    rows = res.fetchall()
    assert {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields} == columns
    assert digest(df.columns, got)[0] == digest(list(columns), rows)[0]
