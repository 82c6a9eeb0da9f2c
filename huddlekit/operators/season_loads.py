"""Loads of season-chunked tables: tables x seasons, each pair a job of its own.

``load_tables`` lists the pairs in registry order, leaves out what a resumed
run has done already, and runs the rest side by side. Every job reads,
conforms, checks and publishes one season of one table; what goes wrong in it
fails it alone, with the error in the run log. Derived tables run after their
inputs. On a resumed run a derived season is done only if no input season was
loaded after it, so a reload of one season rebuilds just what depends on it.

Jobs are submitted from several threads, each in the scheduler pool of its
table (``spark.scheduler.mode=FAIR`` shares the executors among them), so the
small seasons of one table fill the cores a large one leaves idle.
"""
from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit import __version__
from huddlekit.operators.contracts import align_to_schema
from huddlekit.operators.increment import gate, work_matrix
from huddlekit.operators.specs import TableSpec
from huddlekit.session import path_exists
from huddlekit.sources.store import (add_columns, append_run_log, create_table_if_missing, kept_copy,
                                     log_or_none, replace_season)
from huddlekit.sources.vintages import common_schema, footers

LOG_KEYS = ["table_name", "season"]
LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("season", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("dropped", T.LongType()), T.StructField("offending", T.ArrayType(T.LongType())),
    T.StructField("error", T.StringType()), T.StructField("run_at", T.TimestampType()),
    T.StructField("version", T.StringType())])


def contract_of(spark: SparkSession, spec: TableSpec, seasons: list[int]) -> T.StructType:
    """The declared schema, or that of the landed vintages under the overlay."""
    if spec.schema is not None:
        return spec.schema
    if spec.overlay is None:
        raise ValueError(f"{spec.name}: neither a schema nor an overlay")
    vintages = footers(spark, spec.path_for_season, [s for s in seasons if s >= spec.min_season])
    if not vintages:
        raise ValueError(f"{spec.name}: nothing has landed for the requested seasons")
    return spec.overlay.contract(common_schema(vintages), spec.name)


def ensure_table(spark: SparkSession, spec: TableSpec, table: str, contract: T.StructType) -> T.StructType:
    """Create the table, or add the columns it lacks; the schema to load by.
    A column keeps the type it was stored with first."""
    create_table_if_missing(spark, table, contract, partition_by=(spec.partition,), cluster_by=spec.cluster_by)
    stored = {f.name: f for f in spark.table(table).schema.fields}
    add_columns(spark, table, [f for f in contract.fields if f.name not in stored])
    fields = [T.StructField(f.name, stored[f.name].dataType if f.name in stored else f.dataType, f.nullable, f.metadata)
              for f in contract.fields]
    return T.StructType(fields + [f for f in stored.values() if f.name not in contract.fieldNames()])


def last_done(log: DataFrame | None) -> dict[tuple[str, int], int]:
    """(table, season) -> when it was last completed, in microseconds. One row
    per pair of the registry reaches the driver."""
    if log is None:
        return {}
    done = (log.where(F.col("status").isin("success", "empty")).groupBy(*LOG_KEYS)
            .agg(F.unix_micros(F.max("run_at")).alias("run_at")))
    return {(r["table_name"], r["season"]): r["run_at"] for r in done.collect()}


def is_stale(spec: TableSpec, season: int, done: dict[tuple[str, int], int]) -> bool:
    """Whether a season is to be loaded again on a resumed run."""
    own = done.get((spec.name, season))
    return own is None or any(done.get((i, season), own) > own for i in spec.inputs)


class _Run:
    """State the jobs of one ``load_tables`` share."""

    def __init__(self, spark: SparkSession, specs: list[TableSpec], table_of: Callable[[str], str], log_path: str,
                 quarantine: str | None, version: str, read: Callable[[SparkSession, str], DataFrame]):
        self.spark, self.table_of, self.log_path = spark, table_of, log_path
        self.quarantine, self.version, self.read = quarantine, version, read
        self.specs = {s.name: s for s in specs}
        self.contracts: dict[str, T.StructType | Exception] = {}
        self.done = last_done(log_or_none(spark, log_path))
        self.rows: dict[tuple[str, int], tuple] = {}
        self.unwritten: list[tuple] = []
        self.log_ok: dict[tuple, bool] = {}
        self.lock = threading.Lock()

    def prepare(self, spec: TableSpec, seasons: list[int]) -> None:
        try:
            contract = contract_of(self.spark, spec, seasons)
            self.contracts[spec.name] = ensure_table(self.spark, spec, self.table_of(spec.name), contract)
        except Exception as exc:  # noqa: BLE001 - a table without contract fails its own seasons
            self.contracts[spec.name] = exc

    def inputs_of(self, spec: TableSpec, season: int) -> dict[str, DataFrame]:
        """Stored rows of the season of each input that has it."""
        found = {}
        for name in spec.inputs:
            if name in self.specs and season < self.specs[name].min_season:
                continue
            if (name, season) not in self.done:
                raise ValueError(f"{spec.name}: input {name} has not been loaded for {season}")
            found[name] = self.spark.table(self.table_of(name)).where(F.col(spec.partition) == F.lit(season))
        return found

    def job(self, spec: TableSpec, season: int) -> None:
        sc = self.spark.sparkContext
        sc.setLocalProperty("spark.scheduler.pool", spec.name)
        sc.setJobDescription(f"{spec.name} {season}")
        status, written, dropped, offending, error = "success", None, None, None, None
        try:
            contract = self.contracts[spec.name]
            if isinstance(contract, Exception):
                raise contract
            path = spec.path_for_season(season)
            if not path_exists(self.spark, path):
                raise FileNotFoundError(f"{spec.name}: nothing has landed at {path}")
            raw = self.read(self.spark, path).withColumn("feed_season", F.lit(season).cast("long"))
            rows = (spec.derive(raw, self.inputs_of(spec, season), season) if spec.derive
                    else spec.transform(raw, season))
            if spec.partition not in rows.columns:
                rows = rows.withColumn(spec.partition, F.lit(season).cast("long"))
            result = replace_season(
                self.spark, self.table_of(spec.name), align_to_schema(rows, contract), season, column=spec.partition,
                required=tuple(f.name for f in contract.fields if not f.nullable), cluster_by=spec.cluster_by,
                quarantine=self.quarantine)
            written, dropped, offending = result.written, result.dropped, result.offending
        except Exception as exc:  # noqa: BLE001 - one season must not stop the others
            status, error = "failed", str(exc)
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
            sc.setJobDescription(None)
        self.record(spec, season, status, written, dropped, offending, error)

    def record(self, spec: TableSpec, season: int, status: str, written=None, dropped=None, offending=None,
               error: str | None = None) -> None:
        now = datetime.now(UTC)
        row = (spec.name, season, status, written, dropped, offending, error, now, self.version)
        with self.lock:
            self.rows[spec.name, season] = row
            self.unwritten.append(row)
            if status != "failed":
                self.done[spec.name, season] = int(now.timestamp() * 1_000_000)

    def flush(self) -> None:
        """Append the rows recorded so far to the run log."""
        with self.lock:
            rows, self.unwritten = self.unwritten, []
        if rows:
            ok = append_run_log(self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), self.log_path)
            self.log_ok.update({r[:2]: ok for r in rows})


def load_tables(spark: SparkSession, specs: list[TableSpec], seasons: list[int], log_path: str, *,
                table_of: Callable[[str], str] = str, resume: bool = False, quarantine: str | None = None,
                version: str = __version__, side_by_side: int = 4,
                read: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """Load the requested seasons of every table; the run-log rows of this
    run, in registry order (a pair left out by ``resume`` has none).

    ``status`` is ``empty`` for a season from before the table's first (never
    read), ``success`` (``rows`` written; ``dropped`` rows of the foreign
    seasons ``offending``, which go to ``quarantine``) or ``failed`` with the
    error; the stored season of a failed job stays. A season whose feed has no
    rows is cleared. ``table_of`` gives a table's name in the catalog.
    ``log_written`` says whether the row could be appended to the log; a row
    that could not be makes the next resumed run load the pair again."""
    run = _Run(spark, specs, table_of, log_path, quarantine, version,
               read or (lambda session, path: session.read.parquet(path)))
    seasons = list(dict.fromkeys(int(s) for s in seasons))
    pairs = _pairs(spark, specs, seasons)
    names = {s.name for s in specs}
    left = list(specs)
    while left:
        # tables whose inputs are loaded by now, or are not part of this run
        ready = [s for s in left if not ({i for i in s.inputs if i in names} & {t.name for t in left})]
        if not ready:
            raise ValueError(f"tables that wait for each other: {[s.name for s in left]}")
        left = [s for s in left if s not in ready]
        with ThreadPoolExecutor(side_by_side) as pool:
            list(pool.map(lambda s: run.prepare(s, seasons), ready))
            jobs = []
            for spec in ready:
                for season, gated in pairs[spec.name]:
                    if resume and not is_stale(spec, season, run.done):
                        continue
                    if gated:
                        run.record(spec, season, "empty", 0, 0, [])
                    else:
                        jobs.append(pool.submit(run.job, spec, season))
            for n, job in enumerate(jobs, 1):
                job.result()
                if n % (2 * side_by_side) == 0:
                    run.flush()
        run.flush()
    rows = [(*run.rows[s.name, season], run.log_ok[s.name, season])
            for s in specs for season, _ in pairs[s.name] if (s.name, season) in run.rows]
    log = spark.createDataFrame(rows, T.StructType([*LOG_SCHEMA.fields, T.StructField("log_written", T.BooleanType())]))
    return kept_copy(log.coalesce(1), "load-log")


def _pairs(spark: SparkSession, specs: list[TableSpec], seasons: list[int]) -> dict[str, list[tuple[int, bool]]]:
    """table -> (season, whether it is from before the table's first)."""
    if not seasons or not specs:
        return {s.name: [] for s in specs}
    work = gate(work_matrix(spark, {"table_name": [s.name for s in specs], "season": seasons}),
                min_season={s.name: s.min_season for s in specs}, source_col="table_name")
    # as many rows as arguments
    early = {(r["table_name"], r["season"]) for r in work.where("gated = 'empty'").collect()}
    return {s.name: [(season, (s.name, season) in early) for season in seasons] for s in specs}
