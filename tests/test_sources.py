"""S1-S3 on awkward pages: malformed JSON, missing lists, empty pages, order."""

import hashlib

from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.sources import landing as L


def test_malformed_and_empty_pages_yield_no_items(spark):
    rows = [("facebook", "pg", "posts", None, None, 1, '{"data": [{"id": "a"}, {"id": "b"}]}'),
            ("facebook", "pg", "posts", None, None, 2, "{not json"),
            ("facebook", "pg", "posts", None, None, 3, '{"data": []}'),
            ("facebook", "pg", "posts", None, None, 4, '{"paging": {}}'),
            ("facebook", "pg", "posts", None, None, 5, None),
            ("facebook", "pg", "posts", None, None, 6, '{"data": [{"id": "c"}]}')]
    pages = spark.createDataFrame([(*r, None, None) for r in rows], S.LANDED_PAGE)
    got = [((r.seq.page_seq, r.seq.pos), r.id) for r in L.graph_page_items(pages, "id STRING").orderBy("seq").collect()]
    assert got == [((1, 0), "a"), ((1, 1), "b"), ((6, 0), "c")]


def test_cursor_fallback_and_offset(spark):
    rows = [("tiktok", "t", "videos", None, None, 1, '{"data": {"creatives": [], "items": [{"id": "x"}]}}'),
            ("tiktok", "t", "videos", None, None, 2, '{"data": {"creatives": [{"id": "y"}], "items": [{"id": "z"}]}}'),
            ("tiktok", "t", "videos", None, None, 3, '{"data": {}}'),
            ("linkedin", "o", "posts", None, None, 4, '{"elements": [{"id": "e"}], "paging": {"total": 1}}')]
    pages = spark.createDataFrame([(*r, None, None) for r in rows], S.LANDED_PAGE)
    assert [r.id for r in L.cursor_page_items(pages.where("plataforma = 'tiktok'"), "id STRING", "creatives")
            .orderBy("seq").collect()] == ["x", "y"]
    assert [r.id for r in L.offset_page_items(pages.where("plataforma = 'linkedin'"), "id STRING").collect()] == ["e"]


def test_series_points_order(spark):
    rows = [("facebook", "pg", "post_insights", "p", None, 7,
             '{"data": [{"name": "m", "values": [{"end_time": "t1", "value": 1}, {"end_time": "t2", "value": 2}]}]}',
             "r", None)]
    pts = L.series_points(L.graph_page_items(spark.createDataFrame(rows, S.LANDED_PAGE), S.FB_SERIES))
    got = [(r.seq.page_seq, r.seq.pos, r.seq.vpos, r.end_time, r.value) for r in pts.orderBy("seq").collect()]
    assert got == [(7, 0, 0, "t1", "1"), (7, 0, 1, "t2", "2")]


def test_series_and_pages_of_any_length(spark):
    values = ", ".join(f'{{"end_time": "t{i}", "value": {i}}}' for i in range(6000))
    rows = [("facebook", "pg", "post_insights", "p", None, 1, f'{{"data": [{{"name": "m", "values": [{values}]}}]}}', None, None)]
    pts = L.series_points(L.graph_page_items(spark.createDataFrame(rows, S.LANDED_PAGE), S.FB_SERIES))
    assert [r.value for r in pts.orderBy("seq").collect()] == [str(i) for i in range(6000)]


def test_a_huge_page_feeds_many_tasks(spark):
    items = ", ".join(f'{{"id": "{i} {hashlib.sha256(str(i).encode()).hexdigest()}"}}' for i in range(100_000))
    rows = [("facebook", "pg", "posts", None, None, 1, f'{{"data": [{items}]}}', "r", None),
            ("facebook", "pg", "posts", None, None, 2, '{"data": [{"id": "x"}]}', "r", None)]
    pages = spark.createDataFrame(rows, S.LANDED_PAGE).coalesce(1)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "512k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        many = L.graph_page_items(L.spread(pages), "id STRING")
        by_task = many.groupBy(F.spark_partition_id()).agg(F.max("id"), F.count("*").alias("count")).collect()
        assert len(by_task) > 4 and max(r["count"] for r in by_task) < 50_000
        plain = L.graph_page_items(pages, "id STRING")
        assert many.columns == plain.columns and many.exceptAll(plain).count() == 0 == plain.exceptAll(many).count()
        assert L.contents(pages).largest > 2_000_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
