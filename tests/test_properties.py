"""Randomised checks against brute-force models of the row-at-a-time semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.operators import deltas as D
from metricas.operators import joins as J
from metricas.operators import merge as K
from metricas.operators import shape as A

DAY0 = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(0, 9), st.integers(0, 50)),
                   min_size=1, max_size=12)


def model_ingest(stored: dict, batch: list) -> dict:
    """The reference loop: per row in ascending date order, previous = latest stored row
    strictly before the date (as the table is at that moment), then insert-or-overwrite."""
    table = dict(stored)
    for post, day, v in sorted(batch, key=lambda r: (r[0], r[1])):
        prev = [d for (p, d) in table if p == post and d < day]
        pv = table[(post, max(prev))][0] if prev else 0
        table[(post, day)] = (v, v - pv)
    return table


def frame(spark, rows):
    df = spark.createDataFrame([("facebook", "pg", p, DAY0 + dt.timedelta(days=d), v) for p, d, v in rows],
                               "plataforma string, pagina_id string, publicacion_id string, "
                               "fecha_descarga date, v bigint")
    return K.conform(J.daily_rows(df, visualizaciones=F.col("v")), S.T2_DAILY)


def dedupe(rows):
    out = {}
    for p, d, v in rows:
        out[(p, d)] = v  # last write wins inside a run
    return [(p, d, v) for (p, d), v in out.items()]


@SETTINGS
@given(stored=rows_st, batch=rows_st)
def test_ingest_deltas_matches_row_at_a_time_model(spark, stored, batch):
    stored, batch = dedupe(stored), dedupe(batch)
    stored_model = model_ingest({}, stored)
    current = frame(spark, stored).drop("delta_visualizaciones").join(
        spark.createDataFrame([(p, DAY0 + dt.timedelta(days=d), dv) for (p, d), (_, dv) in stored_model.items()],
                              "publicacion_id string, fecha_descarga date, delta_visualizaciones bigint"),
        ["publicacion_id", "fecha_descarga"])
    merged = K.upsert_daily_metrics(current, frame(spark, batch))
    got = {(r.publicacion_id, (r.fecha_descarga - DAY0).days): (r.visualizaciones, r.delta_visualizaciones)
           for r in merged.collect()}
    assert got == model_ingest(stored_model, batch)


points_st = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3),
                               st.sampled_from(["LIKE", "LOVE", "CARE"]), st.integers(0, 99)),
                     min_size=1, max_size=15)


@SETTINGS
@given(points=points_st)
def test_last_wins_pivot_matches_dict_model(spark, points):
    rows = [("facebook", "pg", post, tipo, str(v), i) for i, (post, _, tipo, v) in enumerate(points)]
    df = spark.createDataFrame(rows, "plataforma string, pagina_id string, publicacion_id string, tipo string, "
                                     "total_count string, seq bigint")
    got = {r.publicacion_id: (r.me_gusta, r.me_encanta) for r in A.reaction_breakdown(df.repartition(3)).collect()}
    model = {}
    for post, _, tipo, v in points:
        d = model.setdefault(post, {"LIKE": 0, "LOVE": 0})
        if tipo in d:
            d[tipo] = v
    assert got == {p: (d["LIKE"], d["LOVE"]) for p, d in model.items()}


def test_recompute_after_any_order_equals_sorted(spark):
    rows = [("p", d, (d * 7) % 11) for d in range(10)]
    first, second = rows[5:], rows[:5]
    a = K.upsert_daily_metrics(K.conform(D.ingest_deltas(frame(spark, first)), S.T2_DAILY), frame(spark, second))
    b = K.conform(D.ingest_deltas(frame(spark, rows)), S.T2_DAILY)
    key = lambda r: r.fecha_descarga
    ra = sorted(D.recompute_deltas(a).collect(), key=key)
    rb = sorted(D.recompute_deltas(b).collect(), key=key)
    assert [r.delta_visualizaciones for r in ra] == [r.delta_visualizaciones for r in rb]


week_pts_st = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.integers(0, 99)),
                       min_size=1, max_size=20)


@SETTINGS
@given(points=week_pts_st)
def test_latest_per_iso_week_matches_dict_model(spark, points):
    """The reference keeps, per ISO (year, week), the point with the greatest date,
    replacing on ties (>=), i.e. the last one seen wins among equal dates."""
    start = dt.date(2024, 12, 20)  # crosses the 2024/2025 ISO year boundary
    rows = [(page, start + dt.timedelta(days=d), v, i) for i, (page, d, v) in enumerate(points)]
    df = spark.createDataFrame(rows, "pagina_id string, dia date, valor bigint, seq bigint")
    got = {(r.pagina_id, r.dia, r.valor) for r in
           A.latest_per_iso_week(df.repartition(3), ["pagina_id"], "dia", ["valor"]).collect()}
    model = {}
    for page, day, v, _ in rows:
        key = (page, *day.isocalendar()[:2])
        if key not in model or day >= model[key][0]:
            model[key] = (day, v)
    assert got == {(k[0], d, v) for k, (d, v) in model.items()}


fallback_st = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["posts", "ugcPosts", "shares"]),
                                 st.booleans()), min_size=1, max_size=9)
items_st = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["posts", "ugcPosts", "shares"])),
                    min_size=0, max_size=12)


@SETTINGS
@given(status=fallback_st, items=items_st)
def test_source_fallback_matches_loop_model(spark, status, items):
    """posts -> ugcPosts -> shares: rows yielded by sources tried before the first one
    that completed are kept; nothing after it; an org with no completed source gets nothing."""
    from metricas.operators import normalize as N
    order = ["posts", "ugcPosts", "shares"]
    ok = {}
    for org, src, good in status:
        ok[(org, src)] = ok.get((org, src), False) or good
    st_df = spark.createDataFrame([(o, s, g) for (o, s), g in ok.items()], "pagina_id string, source string, ok boolean")
    it_df = spark.createDataFrame([(o, s, f"{o}-{i}") for i, (o, s) in enumerate(items)],
                                  "pagina_id string, source string, publicacion_id string")
    got = sorted(r.publicacion_id for r in N.linkedin_source_fallback(it_df, st_df).collect())
    kept = []
    for i, (org, src) in enumerate(items):
        done = [order.index(s) for s in order if ok.get((org, s))]
        if done and order.index(src) <= min(done):
            kept.append(f"{org}-{i}")
    assert got == sorted(kept)
