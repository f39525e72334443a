"""The tables of runs: versions, one switch for all tables, compaction, incremental deltas, rejects."""

import datetime as dt
import glob
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from metricas import schemas as S
from metricas.operators import joins as J
from metricas.plans import landed
from metricas.sources import landing as L
from metricas.sources import tables as TB
from metricas.sources import warehouse as W
from metricas.streaming import process_pages, run_available

DAY = dt.date(2024, 3, 1)
WEEKLY = "estadisticas_pagina_semanal"


def day(n):
    return DAY + dt.timedelta(days=n)


def run(n):
    return day(n), f"r{n:02d}"


def outputs(spark, n, rows, followers=None):
    """One run's frames: posts and daily rows of (post, day, value), one week and one segment."""
    posts = sorted({p for p, _, _ in rows})
    t1 = spark.createDataFrame([("facebook", f"pg{p}", f"p{p}", "u", None, f"text {n}", "video") for p in posts], S.T1_POSTS)
    d = spark.createDataFrame([("facebook", f"pg{p}", f"p{p}", day(x), v) for p, x, v in rows],
                              "plataforma string, pagina_id string, publicacion_id string, fecha_descarga date, v bigint")
    t3 = spark.createDataFrame([("facebook", "pg1", day(0), n, 0, 0)], S.T3_WEEKLY)
    t4 = spark.createDataFrame([("facebook", "pg1", day(0), None, "BO", None, None, n)], S.T4_SEGMENTS)
    return {"publicaciones": t1, W.DAILY: J.daily_rows(d, visualizaciones=F.col("v"), alcance=F.col("v") * 2),
            WEEKLY: t3, W.SEGMENTS: t4}


def merge(spark, root, runs, order):
    for n in order:
        W.merge_run(spark, root, outputs(spark, n, runs[n]), run(n))


def state(spark, root):
    own = W.snapshot(spark, root)
    return {t: sorted(map(str, own.read(t).collect())) for t in ("publicaciones", W.DAILY, WEEKLY, W.SEGMENTS)}


def model(runs):
    """The loop of the reference: runs in order, rows by date, each against the latest stored row before it."""
    stored = {}
    for n in sorted(runs):
        for p, x, v in sorted(runs[n], key=lambda r: r[1]):
            before = [d for q, d in stored if q == p and d < x]
            stored[p, x] = (v, v - (stored[p, max(before)][0] if before else 0))
    return sorted((f"p{p}", day(x), v, d) for (p, x), (v, d) in stored.items())


def daily(spark, root):
    return sorted((r.publicacion_id, r.fecha_descarga, r.visualizaciones, r.delta_visualizaciones)
                  for r in W.snapshot(spark, root).read(W.DAILY).collect())


def folder():
    return tempfile.mkdtemp(prefix="metricas-tables-")


def random_runs(seed, n=4):
    r = random.Random(seed)
    return {k: [(p, x, r.randrange(100)) for p in range(3) for x in range(-4, k + 1, 1) if r.random() < .35] or [(0, k, 1)]
            for k in range(n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_late_runs_leave_the_tables_as_if_they_had_come_in_time(spark, seed):
    runs = random_runs(seed)
    in_time, late = folder(), folder()
    merge(spark, in_time, runs, sorted(runs))
    assert daily(spark, in_time) == model(runs)
    order = random.Random(seed + 10).sample(sorted(runs), len(runs))
    merge(spark, late, runs, order[:3])
    W.compact(spark, late, fan=2)
    merge(spark, late, runs, [*order[3:], order[0]])  # and one run merged twice
    assert state(spark, late) == state(spark, in_time)


def test_a_run_that_lands_late_does_not_overwrite_newer_rows(spark):
    landing, root = tempfile.mkdtemp(prefix="metricas-landing-"), folder()

    def land(n, text):
        post = {"id": "p1", "created_time": "2024-02-01T10:00:00+0000", "message": text}
        rows = [("facebook", "pg", "posts", None, None, 1, json.dumps({"data": [post]}), *reversed(run(n)))]
        L.land_run(spark.createDataFrame(rows, S.LANDED_PAGE), landing, run(n))
    land(2, "new")
    assert run_available(spark, landing, root, fmt="parquet") == [run(2)]
    land(1, "old")
    assert run_available(spark, landing, root, fmt="parquet") == [run(1)]
    assert [r.texto_publicacion for r in TB.tables(spark, root)["publicaciones"].read().collect()] == ["new"]
    assert run_available(spark, landing, root, fmt="parquet") == []


def test_a_commit_that_fails_between_two_tables_changes_none(spark, monkeypatch):
    root = folder()
    merge(spark, root, {0: [(1, 0, 5)]}, [0])
    before, files = state(spark, root), set(glob.glob(f"{root}/**/part-*", recursive=True))
    write = W.Commit.add

    def add(self, name, rows, level=0):
        if name == WEEKLY:
            raise OSError("disk")
        return write(self, name, rows, level)
    monkeypatch.setattr(W.Commit, "add", add)
    with pytest.raises(OSError, match="disk"):
        W.merge_run(spark, root, outputs(spark, 1, [(1, 1, 9)]), run(1))
    assert state(spark, root) == before and W.done_runs(spark, root) == {run(0)}
    assert set(glob.glob(f"{root}/**/part-*", recursive=True)) == files
    monkeypatch.undo()
    # a reader that took its snapshot before a run sees nothing of it
    old = W.snapshot(spark, root)
    merge(spark, root, {1: [(1, 1, 9)]}, [1])
    assert old.read(W.DAILY).count() == 1 and old.read("publicaciones").first().texto_publicacion == "text 0"
    assert state(spark, root) != before


def test_two_writers_of_one_commit(spark):
    root = folder()
    with pytest.raises(Exception, match="exist"):
        with W.commit(spark, root) as c:
            W._add_keyed(c, WEEKLY, outputs(spark, 1, [(1, 1, 1)])[WEEKLY], run(1))
            merge(spark, root, {0: [(1, 0, 5)]}, [0])  # another writer publishes first
    assert W.done_runs(spark, root) == {run(0)}


def test_a_run_writes_what_it_has_and_compaction_changes_no_row(spark):
    root = folder()
    big = [(p, x, p + x) for p in range(400) for x in range(30)]
    W.merge_run(spark, root, outputs(spark, 0, big), run(0))

    def size():
        return sum(os.path.getsize(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True))
    first = size()
    for n in range(1, 9):
        W.merge_run(spark, root, outputs(spark, n, [(1, 29 + n, n)]), run(n))
    assert size() - first < first  # eight runs of one row each rewrite nothing of the first one
    sets = {t: len(s) for t, s in W.manifest(spark, root).sets.items()}
    before = state(spark, root)
    W.compact(spark, root)
    W.vacuum(spark, root, keep=1)
    after = W.manifest(spark, root).sets
    assert state(spark, root) == before
    assert all(len(after[t]) < n for t, n in sets.items() if n >= W.FAN)
    assert {d.split("conjunto=")[1].split("/")[0] for d in glob.glob(f"{root}/*/conjunto=*")} == {
        s for t in after.values() for s, _ in t}


def test_a_days_batch_reads_no_history_but_the_latest_rows(spark, monkeypatch):
    root = folder()
    W.merge_run(spark, root, outputs(spark, 0, [(p, x, 1) for p in range(5) for x in range(-70, 0, 7)]), run(0))
    asked = []
    raw = W.Snapshot.raw
    monkeypatch.setattr(W.Snapshot, "raw", lambda self, name, sets=None: asked.append(name) or raw(self, name, sets))
    W.merge_run(spark, root, outputs(spark, 1, [(p, 1, 4) for p in range(5)]), run(1))
    assert W.DAILY not in asked and W.LATEST in asked
    W.merge_run(spark, root, outputs(spark, 2, [(0, -3, 4)]), run(2))  # an earlier day: its post's history is needed
    assert W.DAILY in asked


def test_deltas_are_repaired_where_rows_were_added(spark):
    root, whole = folder(), folder()
    runs = random_runs(7, 4)
    for n in (0, 1, 3, 2):
        merge(spark, root, runs, [n])
        W.recompute_deltas(spark, root)
    merge(spark, whole, runs, [0, 1, 2, 3])
    W.recompute_deltas(spark, whole, full=True)
    assert state(spark, root) == state(spark, whole)
    sets = len(W.manifest(spark, root).sets[W.DAILY])
    W.recompute_deltas(spark, root)  # nothing was added since
    assert len(W.manifest(spark, root).sets[W.DAILY]) == sets
    # a row between two others changes its successor's delta; its own is right since the ingest
    W.merge_run(spark, root, outputs(spark, 5, [(9, 1, 10), (9, 20, 30), (9, 30, 31)]), run(5))
    W.recompute_deltas(spark, root)
    W.merge_run(spark, root, outputs(spark, 6, [(9, 10, 15)]), run(6))
    W.recompute_deltas(spark, root)
    own = W.snapshot(spark, root)
    last = own.raw(W.DAILY, own.manifest.sets[W.DAILY][-1:])
    assert sorted((r.fecha_descarga, r.delta_visualizaciones) for r in last.collect()) == [(day(20), 15)]
    # compaction keeps what is recomputed, and a later recompute still finds what is new
    W.compact(spark, root, fan=2)
    before = state(spark, root)
    W.recompute_deltas(spark, root)
    assert state(spark, root) == before


def test_a_run_too_late_is_an_error(spark):
    root = folder()
    merge(spark, root, {0: [(1, 0, 5)]}, [0])
    old = (day(0) - dt.timedelta(days=W.LATE_DAYS + 1), "r")
    with pytest.raises(ValueError, match="lands over"):
        W.merge_run(spark, root, outputs(spark, 1, [(1, 1, 9)]), old)


# ---- landing ----

def page(endpoint, payload, seq, platform="facebook"):
    return (platform, "pg", endpoint, None, None, seq, payload, "r01", day(1))


GOOD = json.dumps({"data": [{"id": "p1", "created_time": "2024-02-01T10:00:00+0000"}, {"message": "no id"}, {"id": ""}]})


def test_a_cut_page_fails_the_run_and_is_reported(spark):
    root = folder()
    pages = spark.createDataFrame([page("posts", GOOD, 1), page("posts", GOOD[:60], 2), page("posts", None, 3),
                                   page("videos", '{"data": {"creatives": [], "items": [{"creative_id": "", "id": null}, {"id": 5}]}}',
                                        4, "tiktok"), page("posts", '{"paging": {}}', 5), page("run_end", None, 6)], S.LANDED_PAGE)
    assert sorted((r.page_seq, r.motivo, r.cantidad) for r in L.rejects(pages).collect()) == [
        (1, "sin_clave", 2), (2, "ilegible", 1), (3, "ilegible", 1), (4, "sin_clave", 1)]
    with pytest.raises(L.UnreadablePages, match="2 of 5"):
        process_pages(spark, pages, root, day(1), run=run(1))
    assert W.snapshot(spark, root) is None  # nothing written, no run done
    process_pages(spark, pages, root, day(1), run=run(1), unreadable=0.4)
    own = W.snapshot(spark, root)
    assert [r.publicacion_id for r in own.read("publicaciones").where("plataforma = 'facebook'").collect()] == ["p1"]
    assert own.read(W.REJECTS).count() == 4 and W.done_runs(spark, root) == {run(1)}


def test_runs_in_their_own_folders(spark):
    landing = tempfile.mkdtemp(prefix="metricas-landing-")
    for n, run_id in ((2, "b"), (1, "a:1")):
        L.land_run(spark.createDataFrame([page("posts", GOOD, n), page("videos", GOOD, 9, "tiktok")], S.LANDED_PAGE),
                   landing, (day(n), run_id))
    os.makedirs(f"{landing}/run_date=2024-03-04/run_id=open")  # still landing
    assert L.complete_runs(spark, landing) == [(day(1), "a:1"), (day(2), "b")]
    pages = L.read_run(spark, landing, (day(1), "a:1"))
    assert [(r.page_seq, r.run_id, r.run_date) for r in pages.where("endpoint = 'posts'").collect()] == [(1, "a:1", day(1))]
    plan = L.of_run(L.read_landed(spark, landing), (day(2), "b")).where("endpoint = 'posts'")._jdf.queryExecution().toString()
    scan = [x for x in plan.splitlines() if "PartitionFilters" in x][-1]
    assert all(c in scan.split("PartitionFilters")[1].split("PushedFilters")[0] for c in ("run_date", "run_id", "endpoint"))


def test_only_what_a_run_holds_is_planned(spark):
    pages = spark.createDataFrame([page("posts", GOOD, 1), page("videos", "{}", 2, "tiktok")], S.LANDED_PAGE)
    held = L.contents(pages)
    assert held.pages == {("facebook", "posts"): 1, ("tiktok", "videos"): 1} and held.unreadable == 0
    some = landed.all_platforms(pages, day(1), held=set(held.pages))
    assert set(some) == {landed.POSTS, landed.DAILY}
    every = landed.all_platforms(pages, day(1))
    for t in every:
        want = sorted(map(str, every[t].collect()))
        assert (sorted(map(str, some[t].collect())) if t in some else []) == want
    # a table is planned wherever its endpoints are there, and the endpoints are those that the adapters read
    assert {t for ends in landed.DRIVERS.values() for t in ends} == set(every)


def test_one_exchange_by_post_serves_lookup_deltas_and_latest_rows(spark, monkeypatch):
    root = folder()
    merge(spark, root, {0: [(1, 0, 5), (2, 0, 7)]}, [0])
    plans = []
    write = W.Commit.add

    def add(self, name, rows, level=0):
        plans.append((name, "executedPlan:" + rows._jdf.queryExecution().executedPlan().toString()))
        return write(self, name, rows, level)
    monkeypatch.setattr(W.Commit, "add", add)
    W.merge_run(spark, root, {W.DAILY: outputs(spark, 1, [(1, 1, 9), (2, 1, 1)])[W.DAILY]}, run(1))
    plans = dict(plans)
    for t in (W.DAILY, W.LATEST):
        # a plan that has run shows its exchanges twice, as planned first and as run
        shown = plans[t].split("executedPlan:", 1)[1].split("Initial Plan")[0]
        assert shown.count("Exchange hashpartitioning") == 1, shown
    assert daily(spark, root) == model({0: [(1, 0, 5), (2, 0, 7)], 1: [(1, 1, 9), (2, 1, 1)]})
