"""Landed API response pages -> items.

A landed page is one API response, stored as one row of
``schemas.LANDED_PAGE``. Paginated endpoints are exploded here into one row
per item, carrying a total arrival order ``seq`` = (run_date, run_id, page_seq, pos),
and the point's place too for series, so that every later "last wins" rule is
deterministic (and so re-computed after a lost executor) however many items a
page or points a series has.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricas import schemas as S

LARGE_PAGE = 8 << 20  # characters of a payload whose items are spread over tasks
SPREAD = "_spread"  # a column that says so, for all pages of a frame
PAGE_COLS = ["plataforma", "pagina_id", "endpoint", "entity_id", "variant"]


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read landed pages (parquet or JSON lines) with the fixed landing schema.

    A landing folder laid out as ``plataforma=<p>/endpoint=<e>/`` lets every
    platform/endpoint filter of the jobs prune folders at listing time.
    """
    return spark.read.schema(S.LANDED_PAGE).format(fmt).load(path)


BY_RUN = "run_date=*/run_id=*"
DONE = "_SUCCESS"  # the mark in a run's folder that all of its pages have landed


def run_folder(spark: SparkSession, path: str, run: tuple) -> str:
    day = run[0].isoformat() if isinstance(run[0], dt.date) else run[0]
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run[1])
    return f"{path}/run_date={day}/run_id={name}"


def land_run(pages: DataFrame, path: str, run: tuple, fmt: str = "parquet") -> None:
    """Land one run's pages in its own folder, by platform and endpoint; the mark DONE comes last."""
    (pages.drop(*S.RUN).write.partitionBy("plataforma", "endpoint")
     .format(fmt).save(run_folder(pages.sparkSession, path, run)))


def complete_runs(spark: SparkSession, path: str) -> list[tuple]:
    """(run_date, run_id) of the runs landed whole in folders of their own, in order: one listing, no page is read."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(f"{path}/{BY_RUN}/{DONE}")
    found = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jpath) or []
    parents = [s.getPath().getParent() for s in found]
    return sorted((dt.date.fromisoformat(p.getParent().getName().partition("=")[2]),
                   unquote(p.getName().partition("=")[2])) for p in parents)


def landed_by_run(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(f"{path}/run_date=*")
    return bool(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jpath))


def read_run(spark: SparkSession, path: str, run: tuple, fmt: str = "parquet") -> DataFrame:
    """One run's pages, from its folder alone."""
    return (spark.read.schema(S.LANDED_PAGE).option("basePath", path).format(fmt)
            .load(run_folder(spark, path, run)))


# ---- what a run holds, and what of it can't be used ----

# the list of an endpoint's items and the fields of which one must identify an item
ITEM_KEYS = {("facebook", "posts"): (["$.data"], ["$.id"]), ("facebook", "campaigns"): (["$.data"], ["$.id"]),
             ("instagram", "media"): (["$.data"], ["$.id"]), ("linkedin", "posts"): (["$.elements"], ["$.urn", "$.id"]),
             ("linkedin", "ugcPosts"): (["$.elements"], ["$.id", "$.urn"]),
             ("linkedin", "shares"): (["$.elements"], ["$.urn", "$.id"]),
             ("tiktok", "videos"): (["$.data.creatives", "$.data.items"], ["$.creative_id", "$.id"])}
UNREADABLE, NO_KEY = "ilegible", "sin_clave"


class UnreadablePages(ValueError):
    """More pages of a run can't be read than is allowed."""


def _unreadable() -> Column:
    return (F.col("endpoint") != S.RUN_END) & F.try_parse_json("payload").isNull()


def _without_key() -> Column:
    found = F.lit(0)
    parsed = F.try_parse_json("payload")
    for (platform, endpoint), (lists, keys) in ITEM_KEYS.items():
        items = F.lit(None)
        for at in reversed(lists):  # an empty first list falls through, as in ``cursor_page_items``
            own = F.try_variant_get(parsed, at, "array<variant>")
            items = own if at == lists[-1] else F.when(F.size(own) > 0, own).otherwise(items)
        blank = F.filter(items, lambda x: F.concat(*[F.coalesce(F.try_variant_get(x, k, "string"), F.lit(""))  # noqa: B023
                                                     for k in keys]) == "")
        found = F.when((F.col("plataforma") == platform) & (F.col("endpoint") == endpoint), F.size(blank)).otherwise(found)
    return F.greatest(F.coalesce(found, F.lit(0)), F.lit(0))


def rejects(pages: DataFrame) -> DataFrame:
    """(plataforma, pagina_id, endpoint, entity_id, variant, page_seq, motivo, cantidad): pages whose payload is
    missing or no JSON, and how many items of a page have no key and are left out (F3)."""
    rows = pages.where(F.col("endpoint") != S.RUN_END).select(
        *PAGE_COLS, "page_seq", F.when(_unreadable(), UNREADABLE).otherwise(NO_KEY).alias("motivo"),
        F.when(_unreadable(), F.lit(1)).otherwise(_without_key()).cast("long").alias("cantidad"))
    return rows.where(F.col("cantidad") > 0)


@dataclass(frozen=True)
class Contents:
    """Pages of a run by (platform, endpoint), and how many of all can't be read."""
    pages: dict[tuple[str, str], int]
    unreadable: int
    largest: int = 0  # characters of the longest payload

    def check(self, allowed: float = 0.0) -> None:
        """An error if a larger share than ``allowed`` of the pages can't be read."""
        total = sum(self.pages.values())
        if self.unreadable > allowed * total:
            raise UnreadablePages(f"{self.unreadable} of {total} pages have no payload or one that is no JSON")


def contents(pages: DataFrame) -> Contents:
    """One small aggregation: a row for each endpoint."""
    rows = (pages.where(F.col("endpoint") != S.RUN_END).groupBy("plataforma", "endpoint")
            .agg(F.count("*").alias("n"), F.sum(_unreadable().cast("long")).alias("bad"),
                 F.max(F.length("payload")).alias("length")).collect())
    return Contents({(r["plataforma"], r["endpoint"]): r["n"] for r in rows}, sum(r["bad"] for r in rows),
                    max((r["length"] or 0 for r in rows), default=0))


def spread(pages: DataFrame) -> DataFrame:
    """The same pages, whose items S1-S3 deal evenly to tasks, however many one page has (the order of arrival is
    in ``seq``). It costs an exchange of the items, so it is for runs with a payload over LARGE_PAGE."""
    return pages.withColumn(SPREAD, F.lit(True))


def runs(pages: DataFrame, complete: bool = False) -> list[tuple]:
    """(run_date, run_id) of the runs in ``pages``, in order: one short row for each call of the ingest.

    ``complete``: only those whose RUN_END page has landed.
    """
    if complete:
        pages = pages.where(F.col("endpoint") == S.RUN_END)
    rows = pages.select(*S.RUN).distinct().collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))


def of_run(pages: DataFrame, run: tuple) -> DataFrame:
    return pages.where(F.col("run_date").eqNullSafe(F.lit(run[0])) & F.col("run_id").eqNullSafe(F.lit(run[1])))


def _item_seq(pages: DataFrame, pos: Column) -> Column:
    run = [F.col(c) for c in S.RUN if c in pages.columns]
    return F.struct(*run, F.col("page_seq"), pos.cast("bigint").alias("pos"))


def _explode_items(pages: DataFrame, items: Column) -> DataFrame:
    run = [c for c in S.RUN if c in pages.columns]
    exploded = pages.select(*PAGE_COLS, *run, "page_seq", F.posexplode_outer(items).alias("pos", "item"))
    found = exploded.where(F.col("item").isNotNull())
    if SPREAD in pages.columns:  # one page's items would stay in the one task that reads it
        found = found.hint("rebalance", F.col("page_seq"), F.col("pos"))
    return (found
            .select(*PAGE_COLS, _item_seq(pages, F.col("pos")).alias("seq"), "item.*"))


def graph_page_items(pages: DataFrame, item_ddl: str) -> DataFrame:
    """The ``data[]`` list of each Graph API response page, in page order."""
    parsed = F.from_json(F.col("payload"), f"data ARRAY<STRUCT<{item_ddl}>>")
    return _explode_items(pages.withColumn("_p", parsed), F.col("_p.data"))


def offset_page_items(pages: DataFrame, item_ddl: str) -> DataFrame:
    """The ``elements[]`` list of each offset-paginated (LinkedIn) response."""
    parsed = F.from_json(F.col("payload"), f"elements ARRAY<STRUCT<{item_ddl}>>")
    return _explode_items(pages.withColumn("_p", parsed), F.col("_p.elements"))


def cursor_page_items(pages: DataFrame, item_ddl: str, list_key: str) -> DataFrame:
    """S3: ``data.<list_key>``, else ``data.items``; an empty first list also falls through."""
    fields = item_ddl
    parsed = F.from_json(
        F.col("payload"),
        f"data STRUCT<`{list_key}`: ARRAY<STRUCT<{fields}>>, items: ARRAY<STRUCT<{fields}>>>")
    first = F.col(f"_p.data.`{list_key}`")
    chosen = F.when(F.size(first) > 0, first).otherwise(F.col("_p.data.items"))
    return _explode_items(pages.withColumn("_p", parsed), chosen)


def page_object(pages: DataFrame, ddl: str, at: str | None = None) -> DataFrame:
    """Non-paginated responses: one row per page with the object at ``at`` (root if None)."""
    fields = ddl
    if at is None:
        parsed = F.from_json(F.col("payload"), fields)
        obj = F.col("_p")
    else:
        parsed = F.from_json(F.col("payload"), f"`{at}` STRUCT<{fields}>")
        obj = F.col(f"_p.`{at}`")
    return (pages.withColumn("_p", parsed)
            # a filter on a plain column would be moved below it and parse each payload again
            .select(*PAGE_COLS, _item_seq(pages, F.lit(0)).alias("seq"), F.explode_outer(F.array(obj)).alias("item"))
            .where(F.col("item").isNotNull())
            .select(*PAGE_COLS, "seq", "item.*"))


def series_points(items: DataFrame, values_col: str = "values") -> DataFrame:
    """Metric series ``{name, values[]}`` -> one row per point, ordered by item, then place in the series."""
    other = [c for c in items.columns if c != values_col]
    ex = items.select(*other, F.posexplode(F.col(values_col)).alias("_vpos", "_point"))
    return ex.select(*[c for c in other if c != "seq"],
                     F.struct("seq.*", F.col("_vpos").alias("vpos")).alias("seq"), "_point.*")
