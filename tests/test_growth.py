"""Steps that must not be computed twice, or held twice, however large the tables get."""

import datetime as dt
import re

from metricas import schemas as S
from metricas.operators import joins as J
from metricas.operators import merge as K
from metricas.operators import shape as A
from metricas.plans import catalog, landed
from metricas.sources import landing as L

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_payload_is_parsed_once(spark, pages):
    pg = pages([("facebook", "pg", "reactions", "p1", "LIKE", 1, {"summary": {"total_count": 3}}),
                ("facebook", "pg", "reactions", "p2", "LIKE", 1, None)])
    rows = L.page_object(pg, S.FB_REACTION_SUMMARY)
    assert plan(rows).count("from_json(") == 1
    assert [(r.entity_id, r.summary and r.summary.total_count) for r in rows.orderBy("entity_id").collect()][0] == ("p1", "3")


def test_a_pivot_reads_a_value_once(spark):
    df = spark.createDataFrame([("f", "g", "p", "LIKE", "3", 1), ("f", "g", "p", "LIKE", "5", 2), ("f", "g", "p", "WOW", "x", 3)],
                               "plataforma string, pagina_id string, publicacion_id string, tipo string, total_count string, seq long")
    out = A.reaction_breakdown(df)
    assert plan(out).count("decimal(38,6)") == 1
    assert [(r.me_gusta, r.me_asombra, r.me_encanta) for r in out.collect()] == [(5, 0, 0)]


def test_social_counters_are_read_once_each(spark):
    df = spark.createDataFrame(
        [("l", "u1", 1, ("4",), ("5",), "6", "1"), ("l", "u1", 2, ("7",), ("8",), None, "1"), ("l", "u2", 1, ("4",), ("5",), "{\"a\": 1}", "1")],
        "plataforma string, entity_id string, seq long, likesSummary struct<totalLikes string>, "
        "commentsSummary struct<totalFirstLevelComments string>, totalShareStatistics string, shares string")
    out = J.linkedin_social_counts(df)
    assert plan(out).count("decimal(38,6)") == 3
    assert sorted(tuple(r) for r in out.collect()) == [("l", "u1", 7, 8, 1), ("l", "u2", 0, 0, 0)]


def test_versions_of_all_runs_are_merged_in_one_pass(spark, pages):
    def posts(text, *ids):
        return {"data": [{"id": i, "message": text, "created_time": "2024-02-01T00:00:00Z"} for i in ids]}
    pg = pages([("facebook", "pg", "posts", None, None, 9, posts("first", "a", "b"), "r1", D1),
                ("facebook", "pg", "posts", None, None, 1, posts("older", "a"), "r2", D2),
                ("facebook", "pg", "posts", None, None, 2, posts("second", "a", "c"), "r2", D2)])
    out = landed.fold_versions(pg, [(D2, "r2"), (D1, "r1")], {landed.POSTS}, ["facebook"])[landed.POSTS]
    assert plan(out).count("max_by(") == 1
    assert sorted((r.publicacion_id, r.texto_publicacion, r._run_date, r._run_id) for r in out.collect()) == [
        ("a", "second", D2, "r2"), ("b", "first", D1, "r1"), ("c", "second", D2, "r2")]


def test_campaign_days_of_all_runs_are_one_batch(spark, pages):
    def day(spend):
        return {"data": [{"date_start": "2024-02-01", "spend": spend}]}
    pg = pages([("facebook", "act", "campaign_insights", "c1", None, 9, day("1"), "r1", D1),
                ("facebook", "act", "campaign_insights", "c2", None, 9, day("2"), "r1", D1),
                ("facebook", "act", "campaign_insights", "c1", None, 1, day("3.5"), "r2", D2),
                ("facebook", "act", "campaign_insights", "c1", None, 1, day("9"), "r3", D2)])
    for only in ({landed.CAMPAIGN_DAILY}, None):
        out = landed.fold_runs(pg, only, runs=[(D1, "r1"), (D2, "r2")], platforms=["facebook"])[landed.CAMPAIGN_DAILY]
        assert " Join " not in plan(out) and plan(out).count("max_by(") == 1
        assert sorted((r.campania_id, r.presupuesto_invertido) for r in out.collect()) == [("c1", 3.5), ("c2", 2.0)]


def test_two_campaign_runs_compute_their_days_once(spark, tmp_path):
    rows = [(n, n, n % 3, 1, 2.0, 5.0, dt.datetime(2024, 1, 1 + n % 4)) for n in range(24)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = catalog.run("campaign_daily_two_runs", spark, str(tmp_path))
    assert len(re.findall(r"Relation \[", plan(out))) == 1
    found = {(r.campania_id, r.fecha_descarga.day): r.presupuesto_invertido for r in out.collect()}
    assert len(found) == 12 and found["camp_0", 1] == 10.5 and found["camp_1", 2] == 10.0


def test_the_order_is_held_once(spark, pages):
    pg = pages([("facebook", "act", "campaigns", None, None, n, {"data": [{"id": "c1", "name": f"n{n}"}]}, f"r{n}", D1)
                for n in (1, 2)])
    out = landed.fold_runs(pg, {landed.CAMPAIGNS}, runs=[(D1, "r1")], platforms=["facebook"])[landed.CAMPAIGNS]
    assert "seq" not in re.search(r"max_by\(struct\((.*?)\)", plan(out))[1] and out.collect()[0].nombre_campania == "n1"
    assert "run_id" not in re.search(r"struct\(page_seq.*?\)", plan(out))[0]
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "k string, seq long, v string")
    assert [tuple(r) for r in K.latest_by_key(rows, ["k"], drop_seq=True).collect()] == [("k", "b")]
    assert [tuple(r) for r in K.latest_by_key(rows, ["k"], keep_first=True).collect()] == [("k", 1, "a")]
