"""The tables of runs: versioned rows in file sets, all tables switched by one manifest.

Every stored row carries its version, the run that produced it and the commit that wrote it. A run appends one
file set to each table it has rows for; nothing is rewritten. A key's row is the one with the newest version
(T4: the oldest, as its first write wins), whatever order runs were processed in, so a run that lands late
leaves the tables as if it had come in time. ``compact`` merges sets, a table's eight of one level into one of
the next, so that a row is rewritten a logarithmic number of times.

A commit writes its sets first and then publishes a manifest, the list of the sets of all tables, by renaming
it to the next number. Readers take the greatest number: they see all of a run or nothing of it, and a commit
that fails changes nothing. One writer at a time; a second one finds its number taken and fails.

Layout: ``<root>/_manifiesto/<commit>.json`` and ``<root>/<table>/conjunto=<set>/<partitions>/part-*``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricas import schemas as S
from metricas.operators import deltas as D
from metricas.operators import merge as K
from metricas.operators.shape import latest_by_key
from metricas.session import pin_utc
from metricas.sources import tables as TB

POSTS, DAILY, SEGMENTS = "publicaciones", "metricas_publicaciones_diarias", "segmentacion_seguidores_semanal"
LATEST, RUNS, REJECTS = "_ultimas", "_corridas", "_rechazos"  # a post's latest row, runs done, pages not used
MANIFEST = "_manifiesto"
FAN = 8  # sets of a level that are merged into one
LATE_DAYS = 60  # a run may land this long after newer ones; compaction keeps what it needs

RUN = ["_run_date", "_run_id"]
VERSION = [T.StructField("_run_date", T.DateType()), T.StructField("_run_id", T.StringType()),
           T.StructField("_commit", T.LongType())]
PREVIOUS = [T.StructField("_prev_date", T.DateType()), T.StructField("_prev_run_date", T.DateType()),
            T.StructField("_prev_run_id", T.StringType())]
LATEST_ROW = T.StructType([f for f in S.T2_DAILY.fields if f.name in [*S.DAILY_KEY, *S.DELTA_METRICS]])
REJECT_ROW = T.StructType([*S.LANDED_PAGE.fields[:6], T.StructField("motivo", T.StringType()),
                           T.StructField("cantidad", T.LongType())])


# ---- manifest ----

@dataclass(frozen=True)
class Manifest:
    commit: int = 0
    sets: Mapping[str, list] = field(default_factory=dict)  # table -> [set, level], oldest first
    repaired: int = 0  # the commit up to which all deltas are recomputed
    newest: tuple = (None, None)  # the newest run


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, path: str) -> list[str]:
    _, fs, jpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest, or None where no run was merged yet."""
    numbers = [n for n in _names(spark, f"{root}/{MANIFEST}") if n.endswith(".json") and not n.startswith(".")]
    if not numbers:
        return None
    jvm, fs, jpath = _fs(spark, f"{root}/{MANIFEST}/{max(numbers)}")
    stream = fs.open(jpath)
    try:
        d = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    day, run_id = d["newest"]
    return Manifest(d["commit"], d["sets"], d["repaired"], (dt.date.fromisoformat(day) if day else None, run_id))


def _publish(spark: SparkSession, root: str, m: Manifest) -> None:
    day, run_id = m.newest
    text = json.dumps({"commit": m.commit, "sets": m.sets, "repaired": m.repaired,
                       "newest": [day.isoformat() if day else None, run_id]})
    name = f"{m.commit:08d}.json"
    jvm, fs, draft = _fs(spark, f"{root}/{MANIFEST}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # a rename that doesn't overwrite: of two writers of one number the second fails
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    nothing = spark.sparkContext._gateway.new_array(rename, 0)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        draft, jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFEST}/{name}"), nothing)


# ---- reading ----

def _specs(spark: SparkSession, root: str) -> dict[str, TB.KeyedTable]:
    own = TB.tables(spark, root)
    page = own[POSTS].partitions
    own[LATEST] = TB.KeyedTable(spark, f"{root}/{LATEST}", LATEST_ROW, S.POST_KEY, page)
    own[RUNS] = TB.KeyedTable(spark, f"{root}/{RUNS}", T.StructType([S.LANDED_PAGE["run_date"], S.LANDED_PAGE["run_id"]]), S.RUN)
    own[REJECTS] = TB.KeyedTable(spark, f"{root}/{REJECTS}", REJECT_ROW,
                                 ["plataforma", "pagina_id", "endpoint", "entity_id", "variant", "page_seq", "motivo", *RUN])
    return own


def _hidden(name: str) -> list[T.StructField]:
    return VERSION + (PREVIOUS if name == DAILY else [])


def _order(name: str) -> Column:
    """By which the row of a key is chosen."""
    return F.struct(*(["fecha_descarga"] if name == LATEST else []), *[f.name for f in VERSION])


@dataclass
class Snapshot:
    """All tables as of one manifest."""
    spark: SparkSession
    root: str
    manifest: Manifest

    def raw(self, name: str, sets: list | None = None) -> DataFrame | None:
        """All stored versions, with the hidden columns and the partition columns."""
        sets = self.manifest.sets.get(name, []) if sets is None else sets
        if not sets:
            return None
        spec = _specs(self.spark, self.root)[name]
        full = spec._full_schema()
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in full.fields] + _hidden(name)
                              + [T.StructField("conjunto", T.StringType())])
        return (self.spark.read.schema(schema).option("basePath", spec.path)
                .parquet(*[f"{spec.path}/conjunto={s}" for s, _ in sets]))

    def rows(self, name: str, where: Column | None = None) -> DataFrame | None:
        """Each key's row, with its hidden columns; ``where`` is on keys or partition columns only."""
        raw = self.raw(name)
        if raw is None:
            return None
        spec = _specs(self.spark, self.root)[name]
        if where is not None:
            raw = raw.where(where)
        return newest(raw.select(*spec.schema.fieldNames(), *[f.name for f in _hidden(name)]), spec.keys, name)

    def read(self, name: str, where: Column | None = None) -> DataFrame | None:
        rows = self.rows(name, where)
        return None if rows is None else rows.select(*_specs(self.spark, self.root)[name].schema.fieldNames())


def newest(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return latest_by_key(rows.withColumn("_version", _order(name)), keys, "_version",
                         keep_first=name == SEGMENTS).drop("_version")


def snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    m = manifest(spark, root)
    return None if m is None else Snapshot(spark, root, m)


# ---- writing ----

@dataclass
class Commit:
    """The file sets of one change, invisible until it is published."""
    before: Snapshot
    number: int
    sets: dict[str, list]
    repaired: int
    newest: tuple
    written: list[str] = field(default_factory=list)

    def add(self, name: str, rows: DataFrame, level: int = 0) -> bool:
        """Write ``rows``, which have the table's columns and their hidden ones, as a set; False if there are none."""
        spec = _specs(self.before.spark, self.before.root)[name]
        out = spec._with_partitions(rows.select(*spec.schema.fieldNames(), *[f.name for f in _hidden(name)]))
        own = f"{self.number:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{spec.path}/conjunto={own}"
        self.written.append(path)
        parts = list(spec.partitions)
        (out.hint("rebalance", *[F.col(p) for p in parts]) if parts else out.coalesce(1)).write.partitionBy(*parts).parquet(path)
        if not any(not n.startswith(("_", ".")) for n in _names(self.before.spark, path)):
            return False
        self.sets.setdefault(name, []).append([own, level])
        return True

    def versioned(self, rows: DataFrame, run: tuple) -> DataFrame:
        return rows.select("*", F.lit(run[0]).cast("date").alias("_run_date"), F.lit(run[1]).cast("string").alias("_run_id"),
                           F.lit(self.number).cast("long").alias("_commit"))


@contextmanager
def commit(spark: SparkSession, root: str) -> Iterator[Commit]:
    """One change of the tables: published at the end, or nothing of it."""
    pin_utc(spark)
    m = manifest(spark, root) or Manifest()
    c = Commit(Snapshot(spark, root, m), m.commit + 1, {t: list(s) for t, s in m.sets.items()}, m.repaired, m.newest)
    try:
        yield c
        if c.written:
            _publish(spark, root, Manifest(c.number, c.sets, c.repaired, c.newest))
    except BaseException:
        for path in c.written:
            TB._delete(spark, path)
        raise


def _after(run: tuple) -> Column:
    """Whether a row's run comes after ``run``."""
    return _run(*RUN) > _run_of(run)


def _run(*names: str) -> Column:
    return F.struct(F.col(names[0]).alias("d"), F.col(names[1]).alias("r"))


def _run_of(run: tuple) -> Column:
    return F.struct(F.lit(run[0]).cast("date").alias("d"), F.lit(run[1]).cast("string").alias("r"))


def _last(rows: DataFrame, schema: T.StructType, keys: list[str], first: bool = False) -> DataFrame:
    """A run's rows, one for each key: the last that arrived (or first)."""
    if "seq" in rows.columns:
        rows = latest_by_key(rows, keys, "seq", keep_first=first)
    return K.conform(rows, schema)


def _add_keyed(c: Commit, name: str, rows: DataFrame, run: tuple) -> None:
    """K1, K3, K4, K6."""
    spec = _specs(c.before.spark, c.before.root)[name]
    c.add(name, c.versioned(_last(rows, spec.schema, spec.keys, name == SEGMENTS), run))


def _add_daily(c: Commit, batch: DataFrame, run: tuple) -> None:
    """K2 with D1 and J6: the previous row of a post is looked up in LATEST, which has one row for each post.

    The batch and the latest rows of its pages meet in one exchange by post, which serves the lookup, the deltas
    and the posts' new latest rows. Only where a post's stored rows reach into the batch's days, or come from a
    later run, is its history in T2 needed; T2 isn't read at all if no post is like that. Rows of later runs
    whose previous row becomes one of the batch's are revised, so that a late run leaves the deltas that it would
    have left in time.
    """
    given = [f.name for f in S.T2_DAILY.fields if not f.name.startswith("delta_")]
    own = c.versioned(_last(batch, T.StructType([S.T2_DAILY[m] for m in given]), S.DAILY_KEY), run)
    with TB.kept(own) as b:
        met = b.withColumn("_new", F.lit(True))
        if LATEST in c.before.manifest.sets:
            known = c.before.raw(LATEST).where(_pages_of(b)).select(*LATEST_ROW.fieldNames(), *[f.name for f in VERSION])
            met = met.unionByName(known.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        met = met.repartition(*S.POST_KEY)
        post = Window.partitionBy(*S.POST_KEY)
        met = met.select(
            "*", F.min(F.when(F.col("_new"), F.col("fecha_descarga"))).over(post).alias("_lo"),
            F.max(F.when(F.col("_new"), F.col("fecha_descarga"))).over(post).alias("_hi"),
            F.max(F.when(~F.col("_new"), _order(LATEST))).over(post).alias("_last"))
        met = met.where(F.col("_lo").isNotNull() & (F.col("_new") | (_order(LATEST) == F.col("_last"))))
        late = F.col("_last").isNotNull() & ((F.col("_last.fecha_descarga") >= F.col("_lo"))
                                             | (_run("_last._run_date", "_last._run_id") > _run_of(run)))
        met = D.deltas_after(met.withColumn("_late", F.coalesce(late, F.lit(False))), RUN).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n, lo, hi = met.where("_late").agg(F.count("*"), F.min("_lo"), F.max("_hi")).first()
            columns = [*S.T2_DAILY.fieldNames(), *[f.name for f in _hidden(DAILY)]]
            rows = met.where("_new and not _late").select(*columns)
            if n:
                posts = met.where("_late").select(*S.POST_KEY, "_lo", "_hi").distinct()
                stored = c.before.raw(DAILY).join(posts, S.POST_KEY)
                # as of this run: what later runs wrote doesn't count
                past = newest(stored.where((F.col("mes") <= F.trunc(F.lit(hi), "month"))
                                           & (F.col("fecha_descarga") < F.col("_hi")) & ~_after(run))
                              .select(*S.DAILY_KEY, *S.DELTA_METRICS, *[f.name for f in VERSION]), S.DAILY_KEY, DAILY)
                again = b.join(posts.select(*S.POST_KEY), S.POST_KEY, "left_semi").select(*b.columns)
                rows = rows.unionByName(D.ingest_deltas(again, past.drop("_commit"), carry=RUN).select(*columns))
                newer = newest(stored.where((F.col("mes") >= F.trunc(F.lit(lo), "month"))
                                            & (F.col("fecha_descarga") > F.col("_lo"))).select(*columns), S.DAILY_KEY, DAILY)
                revised = D.revise_after_late(newer.where(_after(run)), again, RUN)
                rows = rows.unionByName(revised.withColumn("_commit", F.lit(c.number).cast("long")).select(*columns))
            if c.add(DAILY, rows):
                c.add(LATEST, met.where(F.col("_new") & (F.col("fecha_descarga") == F.col("_hi")))
                      .select(*LATEST_ROW.fieldNames(), *[f.name for f in VERSION]))
        finally:
            met.unpersist()


def _pages_of(batch: DataFrame) -> Column:
    """Partitions of the pages in ``batch``, to prune a table that has T1's: at most 256 buckets a platform."""
    bucket = TB.page_bucket()
    found = batch.select("plataforma", bucket.alias("cubo")).distinct().agg(
        F.collect_set("plataforma").alias("p"), F.collect_set("cubo").alias("c")).first()
    return F.col("plataforma").isin(found["p"]) & F.col("cubo").isin(found["c"])


def merge_run(spark: SparkSession, root: str, outputs: Mapping[str, DataFrame], run: tuple | None = None,
              rejects: DataFrame | None = None) -> None:
    """Merge one run's outputs (as returned by ``plans.landed``): one file set for each table with rows, one commit.

    ``run`` is (run_date, run_id); rows merged without one count as the newest run's, after what is stored. The
    run is logged in the same commit. A run older than the newest one by more than LATE_DAYS is an error, since
    compaction may have dropped the rows that its deltas need.
    """
    with commit(spark, root) as c:
        newest_run = c.before.manifest.newest
        if run is None:
            run = newest_run
        elif run[0] is not None and newest_run[0] is not None and (newest_run[0] - run[0]).days > LATE_DAYS:
            raise ValueError(f"run {run} lands over {LATE_DAYS} days after run {newest_run}")
        else:
            c.newest = max((run, newest_run), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
            done = spark.createDataFrame([run], T.StructType([S.LANDED_PAGE[x] for x in S.RUN]))
            c.add(RUNS, c.versioned(done, run))
        if rejects is not None:
            c.add(REJECTS, c.versioned(rejects, run))
        for name, rows in outputs.items():
            if name == DAILY:
                _add_daily(c, rows, run)
            else:
                _add_keyed(c, name, rows, run)


def done_runs(spark: SparkSession, root: str) -> set[tuple]:
    own = snapshot(spark, root)
    rows = own.read(RUNS) if own else None
    return {tuple(r) for r in rows.collect()} if rows is not None else set()


def recompute_deltas(spark: SparkSession, root: str, full: bool = False) -> None:
    """K5 / L3: recompute every delta (first row NULL), for the posts with rows added since the last time only.

    A post's deltas depend on its own rows, so the others' are right already; of the posts read only the rows
    whose deltas change are written. ``full``: all posts.
    """
    with commit(spark, root) as c:
        rows = c.before.rows(DAILY)
        if rows is None:
            return
        new = [s for s in c.before.manifest.sets[DAILY] if int(s[0].split("-")[0]) > c.before.manifest.repaired]
        if not full:
            if not new:
                return
            posts = c.before.raw(DAILY, new).select(*S.POST_KEY).distinct()
            rows = rows.join(posts, S.POST_KEY, "left_semi")
        c.add(DAILY, D.repaired_deltas(rows).withColumn("_commit", F.lit(c.number).cast("long")))
        c.repaired = c.number


def compact(spark: SparkSession, root: str, fan: int = FAN) -> None:
    """Merge ``fan`` sets of one level into one of the next, for every table and level that has so many.

    The tables read the same before and after. Of T2 the versions of the last LATE_DAYS stay, and the newest
    one before: a late run's deltas are computed as of that run.
    """
    with commit(spark, root) as c:
        for name in list(c.sets):
            level = 0
            while any(at >= level for _, at in c.sets[name]):
                some = [s for s in c.sets[name] if s[1] == level]
                if len(some) >= fan:
                    spec = _specs(spark, root)[name]
                    rows = c.before.raw(name, some).select(*spec.schema.fieldNames(), *[f.name for f in _hidden(name)])
                    c.sets[name] = [s for s in c.sets[name] if s not in some]
                    if name == DAILY and c.newest[0] is not None:
                        since = c.newest[0] - dt.timedelta(days=LATE_DAYS)
                        rows = newest(rows, [*spec.keys, *RUN], name)
                        recent = F.coalesce(F.col("_run_date") >= F.lit(since), F.lit(False))
                        rows = rows.where(recent).unionByName(newest(rows.where(~recent), spec.keys, name))
                    else:
                        rows = newest(rows, spec.keys, name)
                    c.add(name, rows, level + 1)
                level += 1
        if not c.written:
            return
        if c.repaired == c.before.manifest.commit:  # a merged set has this commit's number, but nothing new
            c.repaired = c.number


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete the file sets that none of the newest ``keep`` manifests names, and the manifests before them."""
    names = sorted(n for n in _names(spark, f"{root}/{MANIFEST}") if n.endswith(".json") and not n.startswith("."))
    used: set[str] = set()
    for n in names[-keep:]:
        jvm, fs, jpath = _fs(spark, f"{root}/{MANIFEST}/{n}")
        stream = fs.open(jpath)
        try:
            d = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        used |= {f"{t}/conjunto={s}" for t, sets in d["sets"].items() for s, _ in sets}
    for name, spec in _specs(spark, root).items():
        for n in _names(spark, spec.path):
            if n.startswith("conjunto=") and f"{name}/{n}" not in used:
                TB._delete(spark, f"{spec.path}/{n}")
    for n in names[:-keep]:
        TB._delete(spark, f"{root}/{MANIFEST}/{n}")
