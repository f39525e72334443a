"""E1-E11 edge vectors (FIXTURES.md section 3, rows 1-8, 11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricas.functions import exprs as E


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("m,s,expected", [
    ("photo", "added_video", "imagen"),
    ("", "ADDED_VIDEO", "video"),
    ("", "IMAGE", "image"),
    ("", "CAROUSEL_ALBUM", "carousel_album"),
    ("album", "shared_story", "carrusel"),
    ("", "", "desconocido"),
    (None, None, "desconocido"),
    ("", "shared_story", "link"),
    ("link", "", "link"),
    ("video_inline", "added_photos", "video"),
])
def test_infer_format(spark, m, s, expected):
    assert one(spark, E.infer_format(F.col("m"), F.col("s")), m=m, s=s) == expected


def test_iso_date_keeps_written_offset(spark):
    assert one(spark, E.iso_local_date(F.col("t")), t="2024-01-01T23:00:00-08:00") == dt.date(2024, 1, 1)


def test_epoch_millis_is_utc_date(spark):
    df = spark.createDataFrame([(1704067199999,)], "ms bigint")
    assert df.select(E.utc_date_of_millis("ms")).first()[0] == dt.date(2023, 12, 31)


def test_epoch_or_iso(spark):
    assert one(spark, E.epoch_or_iso_date(F.col("t")), t="1704067200") == dt.date(2024, 1, 1)
    assert one(spark, E.epoch_or_iso_date(F.col("t")), t="2023-05-06T23:30:00-05:00") == dt.date(2023, 5, 6)


def test_ctr_null_without_impressions(spark):
    df = spark.createDataFrame([(3, 0), (3, 4)], "c bigint, i bigint")
    assert [r[0] for r in df.select(E.ctr("c", "i")).collect()] == [None, 75.0]


@pytest.mark.parametrize("raw,expected", [
    ("5", 5), ("5.7", 5), ("-5.7", -5), (None, 0), ("", 0), ("abc", 0), ('{"a": 1}', 0), (" 12 ", 12)])
def test_int_or_zero(spark, raw, expected):
    assert one(spark, E.int_or_zero(F.col("x")), x=raw) == expected


@pytest.mark.parametrize("raw,expected", [("7", 7), ('{"value": 9}', 9), ('{"value": null}', 0), (None, 0)])
def test_scalar_or_value_struct(spark, raw, expected):
    assert one(spark, E.scalar_or_value_struct(F.col("x")), x=raw) == expected


def test_python_or(spark):
    df = spark.createDataFrame([(0, None, 8), (3, 5, 8), (None, 0, 0)], "a bigint, b bigint, c bigint")
    assert [r[0] for r in df.select(E.or_numbers("a", "b", "c")).collect()] == [8, 3, 0]
    sdf = spark.createDataFrame([("", None, "z"), ("x", "y", "z")], "a string, b string, c string")
    assert [r[0] for r in sdf.select(E.or_strings("a", "b", "c")).collect()] == ["z", "x"]


def test_iso_week_monday(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 1, 5),), (dt.date(2025, 1, 6),)], "d date")
    assert [r[0] for r in df.select(E.iso_week_monday("d")).collect()] == [
        dt.date(2024, 12, 30), dt.date(2024, 12, 30), dt.date(2025, 1, 6)]
