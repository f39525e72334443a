"""Incremental runs: newly landed complete runs -> the same jobs -> merged tables.

The reference is a scheduled batch job: one call is one run with its own "today"
and reads all of its responses before it writes. So the unit here is the run, not
the file: a run is processed once it has landed whole, with its own ``run_date`` as
the date of all windows. A run's rows, the pages not used and its entry in the log
of the runs done are one commit: a run that failed has changed nothing and is
processed again. Runs are taken in their order, but one that lands late leaves the
same tables, since rows are chosen by their run and not by when it was processed.

Runs land in folders of their own, ``run_date=<d>/run_id=<r>/`` with the mark _SUCCESS
once whole (``landing.land_run``): one listing finds them, and a run reads its folder
only. A flat landing folder works too; a run is whole there when its RUN_END page is.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from metricas.plans import landed
from metricas.sources import landing as L
from metricas.sources import warehouse as W


def process_pages(spark: SparkSession, pages: DataFrame, tables_root: str, as_of, platforms=None,
                  run: tuple | None = None, unreadable: float = 0.0) -> None:
    """One run's pages through the platform adapters into the tables.

    Only what the run holds is planned. If a larger share than ``unreadable`` of its pages has no payload, or
    one that is no JSON, the run fails; what is left out otherwise is stored with its reason (``_rechazos``).
    """
    kept = pages = pages.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held = L.contents(pages)
        held.check(unreadable)
        if held.largest > L.LARGE_PAGE:
            pages = L.spread(pages)
        outputs = landed.all_platforms(pages, as_of, platforms=platforms, held=set(held.pages))
        W.merge_run(spark, tables_root, outputs, run, L.rejects(pages))
    finally:
        kept.unpersist()


def process_runs(spark: SparkSession, pages: DataFrame, tables_root: str, todo: list[tuple], as_of=None,
                 platforms=None, unreadable: float = 0.0) -> None:
    """The given runs in order; ``as_of`` dates a run that has no date of its own."""
    for run in todo:
        process_pages(spark, L.of_run(pages, run), tables_root, run[0] or as_of, platforms,
                      (run[0] or as_of, run[1]), unreadable)


def _landed(spark: SparkSession, landing_dir: str, fmt: str) -> Iterator[tuple[tuple, DataFrame]]:
    """The complete runs in order, each with its pages."""
    if L.landed_by_run(spark, landing_dir):
        for run in L.complete_runs(spark, landing_dir):
            yield run, L.read_run(spark, landing_dir, run, fmt)
        return
    pages = L.read_landed(spark, landing_dir, fmt)
    for run in L.runs(pages, complete=True):
        if run[0] is not None:
            yield run, L.of_run(pages, run)


def run_available(spark: SparkSession, landing_dir: str, tables_root: str, *, fmt: str = "json",
                  unreadable: float = 0.0) -> list[tuple]:
    """Process every complete run not processed before, in order; returns them.

    Runs without a date can't be ordered or dated and are left to ``ingest``.
    """
    done, todo = W.done_runs(spark, tables_root), []
    for run, pages in _landed(spark, landing_dir, fmt):
        if run not in done:
            process_pages(spark, pages, tables_root, run[0], run=run, unreadable=unreadable)
            todo.append(run)
    return todo
