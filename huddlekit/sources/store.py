"""Idempotent, atomic writes to Parquet catalog tables (no MERGE-capable
format is assumed).

* ``upsert``: the MERGE as a plan over only the partitions the batch touches
  (dynamic partition pruning through a semi-join). A staged row replaces the
  stored row of its key, or with ``latest_by`` only if it is not older.
* ``replace_season``: keep the chunk's own season, set foreign and NULL
  seasons aside (counted, listed, and kept in a quarantine table where one is
  given), and put the season's rows in the place of the former ones. A season
  that became empty is cleared.

Nothing is overwritten in place. New rows go to a version folder of their own
below the table (``_versions/<id>``); when they are written whole, the catalog
is pointed at them, one partition at a time (``ALTER TABLE .. SET LOCATION``;
an unpartitioned table as a whole). A reader sees a partition before or after
a write, never in between; a failed write removes its folder and changes
nothing. The version just left stays until the next write of its partition,
so that running readers can finish; older ones are removed
(``drop_old_versions`` removes both). Tables are read through the catalog.

Batches are staged once below ``spark.checkpoint.dir`` (a shared folder on a
cluster), so all checks and a retry after a lost executor read a written copy;
staged folders are removed when the write ends, well or badly.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huddlekit import __version__
from huddlekit.operators.contracts import INGESTED_AT
from huddlekit.session import path_exists, remove_path, scratch_path, temporary_path


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


MAX_CLUSTER_COLUMNS = 4
_LAYOUT_TYPES = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType, T.DateType,
                 T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType)


def check_layout(schema: T.StructType, partition_by=(), cluster_by=(), *, table: str = "") -> None:
    """Layout guard: partition and clustering columns must be declared,
    of a type with exact equality (no floating point, no nested types), and
    there are at most four clustering columns. Raised at declaration time,
    before anything is written."""
    by_name = {f.name: f.dataType for f in schema.fields}
    if len(cluster_by) > MAX_CLUSTER_COLUMNS:
        raise ValueError(f"{table}: at most {MAX_CLUSTER_COLUMNS} clustering columns, got {list(cluster_by)}")
    for role, cols in (("partition", partition_by), ("clustering", cluster_by)):
        for c in cols:
            if c not in by_name:
                raise ValueError(f"{table}: {role} column {c!r} is not declared")
            if not isinstance(by_name[c], _LAYOUT_TYPES):
                raise ValueError(f"{table}: {role} column {c!r} has type "
                                 f"{by_name[c].simpleString()}, which cannot be a {role} key")


def create_table_if_missing(spark: SparkSession, name: str, schema: T.StructType, *,
                            partition_by: tuple[str, ...] = (), location: str | None = None,
                            cluster_by: tuple[str, ...] = ()) -> None:
    """Declared schema, Parquet, optional partition columns (a partition
    column keeps its declared type, unlike a path-inferred one). The layout
    is validated first (``check_layout``)."""
    check_layout(schema, partition_by, cluster_by, table=name)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({cols}) USING parquet"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def add_columns(spark: SparkSession, table: str, fields: list[T.StructField]) -> None:
    """Columns that a later vintage brought; NULL in the rows stored so far."""
    if fields:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {_ident(table)} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(table)


def clustered(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Cluster rows for writing without partitioning: range-partition on the
    clustering columns and sort within each task, so every written file
    covers a narrow key range and Parquet min/max statistics skip files and
    row groups for filters on those columns."""
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def check_keys(staged: DataFrame, keys: list[str] | tuple[str, ...], schema_cols=None) -> None:
    """Keys must exist; staged keys must be non-NULL and unique. One
    aggregate pass; only two numbers reach the driver."""
    cols = schema_cols if schema_cols is not None else staged.columns
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"merge keys not in schema: {missing}")
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    # NULL keys form their own groups, so one grouped pass yields both counts
    row = (staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.coalesce(F.sum(F.when(null_any, F.col("_n"))), F.lit(0)).alias("nulls"),
                F.count_if(F.col("_n") > 1).alias("dups"))
           .first())
    if row["nulls"]:
        raise ValueError(f"{row['nulls']} staged row(s) with a NULL key {list(keys)}")
    if row["dups"]:
        raise ValueError(f"{row['dups']} duplicated key(s) {list(keys)} in the staged rows")


def check_required(df: DataFrame, required: list[str] | tuple[str, ...]) -> None:
    """Fail the load when a REQUIRED column holds NULLs (Parquet does not
    enforce nullability), listing the count per column. One aggregation."""
    if not required:
        return
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    bad = {c: row[c] for c in required if row[c]}
    if bad:
        raise ValueError(f"NULL values in required columns: {bad}")


def merge_upsert(target: DataFrame, staged: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows after MERGE ... WHEN MATCHED UPDATE WHEN NOT MATCHED INSERT."""
    keys = list(keys)
    kept = target.join(staged.select(*keys), keys, "left_anti")
    return kept.unionByName(staged.select(*target.columns))


def merge_latest(target: DataFrame, staged: DataFrame, keys: list[str] | tuple[str, ...],
                 latest_by: str) -> DataFrame:
    """Rows after MERGE ... WHEN MATCHED AND the staged row is not older: of
    two rows of one key that with the larger ``latest_by`` stays (NULL is the
    oldest; ties by the remaining columns), so the order in which batches
    arrive does not matter and a replay changes nothing."""
    keys = list(keys)
    rest = [latest_by, *[c for c in target.columns if c != latest_by and c not in keys]]
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = staged.select(*keys, F.struct(*rest).alias("_new"))
    best = F.greatest("_old", "_new")
    return old.join(new, keys, "full_outer").select(*keys, best.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in target.columns])


@contextmanager
def staged_copy(spark: SparkSession, df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder and read back; removed at the
    end of the block."""
    path = scratch_path(spark, f"staging/{label}-{uuid.uuid4().hex}")
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def kept_copy(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, until the
    application ends."""
    path = temporary_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- versions -----------------------------------------------------------------

VERSIONS = "_versions"


def _described(spark: SparkSession, table: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {_ident(table)}{partition}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")   # a partition's own place stands before the table's


def _root(spark: SparkSession, table: str) -> str:
    """The table's own folder, whichever version it points at."""
    return _described(spark, table).split(f"/{VERSIONS}/")[0]


def _quoted(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_sql(columns: tuple[str, ...], values: Row) -> str:
    return " PARTITION (" + ", ".join(f"`{c}` = {_quoted(v)}" for c, v in zip(columns, values)) + ")"


def _partition_folder(spark: SparkSession, columns: tuple[str, ...], values: Row) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{escape(c)}={escape(str(v))}" for c, v in zip(columns, values))


def _children(spark: SparkSession, pattern: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return [str(f.getPath().toString()) for f in found or []]


def _same_folder(a: str, b: str) -> bool:
    """Whether two paths name one folder (``file:/x`` and ``/x`` do)."""
    return a.split(":", 1)[-1].replace("///", "/").rstrip("/") == b.split(":", 1)[-1].replace("///", "/").rstrip("/")


def publish(spark: SparkSession, table: str, rows: DataFrame, partition_by: tuple[str, ...] = (),
            partitions: list[Row] | None = None) -> None:
    """Put ``rows`` in the place of the given partitions (of the whole table,
    if it has none): written whole to a new version folder first, then pointed
    at. ``rows`` may read the table itself. Partitions without rows are
    cleared."""
    root = _root(spark, table)
    version = f"{root}/{VERSIONS}/{uuid.uuid4().hex}"
    columns = [c for c in spark.table(table).columns if c not in partition_by]
    try:
        writer = rows.select(*columns, *partition_by).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version)
        empty = rows.sparkSession.createDataFrame([], rows.select(*columns).schema)
        places = []
        for values in partitions or []:
            folder = f"{version}/{_partition_folder(spark, partition_by, values)}"
            if not _children(spark, folder):
                empty.write.parquet(folder)
            places.append((values, folder))
    except BaseException:
        remove_path(spark, version)
        raise
    if not partition_by:
        former = _described(spark, table)
        spark.sql(f"ALTER TABLE {_ident(table)} SET LOCATION {_quoted(version)}")
        _retire(spark, f"{root}/{VERSIONS}/*", version, former)
    for values, folder in places:
        at = _partition_sql(partition_by, values)
        known = spark.sql(f"SHOW PARTITIONS {_ident(table)}{at}").collect()
        if known:
            former = _described(spark, table, at)
            spark.sql(f"ALTER TABLE {_ident(table)}{at} SET LOCATION {_quoted(folder)}")
            if former.startswith(f"{root}/") and f"/{VERSIONS}/" not in former:
                remove_path(spark, former)   # a folder of the table, written without a version
            _retire(spark, f"{root}/{VERSIONS}/*/{_partition_folder(spark, partition_by, values)}", folder, former)
        else:
            spark.sql(f"ALTER TABLE {_ident(table)} ADD{at} LOCATION {_quoted(folder)}")
    spark.catalog.refreshTable(table)


def _retire(spark: SparkSession, pattern: str, *kept: str) -> None:
    for folder in _children(spark, pattern):
        if not any(_same_folder(folder, k) for k in kept):
            remove_path(spark, folder)


def drop_old_versions(spark: SparkSession, table: str) -> None:
    """Remove every version the catalog does not point at, those of writes
    that died included. Call it while no one reads or writes the table."""
    partition_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    root = _root(spark, table)
    kept = [_described(spark, table)]
    for row in spark.sql(f"SHOW PARTITIONS {_ident(table)}").collect() if partition_by else []:
        values = Row(*[unescape(part.split("=", 1)[1]) for part in row["partition"].split("/")])
        kept.append(_described(spark, table, _partition_sql(tuple(partition_by), values)))
    depth = "/*" * len(partition_by)
    _retire(spark, f"{root}/{VERSIONS}/*{depth}", *kept)
    for version in _children(spark, f"{root}/{VERSIONS}/*"):
        if partition_by and not _children(spark, f"{version}{depth}"):
            remove_path(spark, version)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop the table with all its versions."""
    root = _root(spark, table)
    spark.sql(f"DROP TABLE {_ident(table)}")
    remove_path(spark, root)


# --- writes -------------------------------------------------------------------

def upsert(spark: SparkSession, table: str, staged: DataFrame, keys: list[str] | tuple[str, ...],
           *, partition_by: tuple[str, ...] = (), required: tuple[str, ...] = (),
           cluster_by: tuple[str, ...] = (), latest_by: str | None = None) -> int:
    """Upsert ``staged`` into catalog table ``table``; returns rows staged.
    An empty batch is a no-op. With ``latest_by`` a stored row that is newer
    than the staged one stays (``merge_latest``). With ``cluster_by`` the
    rewritten rows are range-partitioned and sorted on (partition columns,
    cluster columns), so files cover narrow key ranges and a large partition
    is written by many tasks. Partition columns must be keys: otherwise a key
    whose row moves to another partition would stay behind in the old one."""
    target = spark.table(table)
    cols = target.columns
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"merge keys not in schema: {missing}")
    loose = [c for c in partition_by if c not in keys]
    if loose:
        raise ValueError(f"partition columns must be merge keys: {loose}")
    # stage once, then validate the written copy: the batch's lineage is
    # computed a single time however many checks run on it
    obs = Observation("staged")
    with staged_copy(spark, staged.select(*cols).observe(obs, F.count(F.lit(1)).alias("n")), "batch") as st:
        n = obs.get["n"]
        if n == 0:
            return 0
        check_keys(st, keys, cols)
        check_required(st, [c for c in required if c not in keys])
        scope, touched = target, None
        if partition_by:
            # one row per partition of the batch
            touched = st.select(*partition_by).distinct().collect()
            scope = target.join(st.select(*partition_by).distinct(), list(partition_by), "left_semi")
        scope = scope.select(*cols)
        rows = merge_latest(scope, st, keys, latest_by) if latest_by else merge_upsert(scope, st, keys)
        if cluster_by:
            rows = clustered(rows, [*partition_by, *cluster_by])
        publish(spark, table, rows, tuple(partition_by), touched)
    return n


@dataclass(frozen=True)
class WriteSeasonResult:
    written: int
    dropped: int
    offending: list   # the foreign seasons, sorted; a NULL season is not listed


QUARANTINE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("season", T.LongType()),
    T.StructField("reason", T.StringType()), T.StructField("row", T.StringType()),
    T.StructField("rejected_at", T.TimestampType())])
FOREIGN = "foreign season"


def replace_season(spark: SparkSession, table: str, df: DataFrame, season: int,
                   *, column: str = "season", required: tuple[str, ...] = (),
                   cluster_by: tuple[str, ...] = (), quarantine: str | None = None) -> WriteSeasonResult:
    """Replace partition ``column = season`` of ``table`` with the rows of
    ``df`` that belong to it. A frame without the season column is taken to
    be the chunk itself. Columns the frame lacks become typed NULLs.

    The rows are read once: that pass stages them with the reason why a row
    is rejected, if it is, and counts. Rows of a foreign or NULL season are
    left out. A NULL in a ``required`` column fails the season, and the stored
    one stays. ``quarantine`` names a folder to which rejected rows of both
    kinds are appended (``QUARANTINE_SCHEMA``, the row as JSON)."""
    schema = spark.table(table).schema
    chunk = df if column in df.columns else df.withColumn(column, F.lit(season))
    lacking = [F.when(F.col(c).isNull(), F.lit(c)) for c in required if c in df.columns]
    reason = F.when(~F.coalesce(F.col(column) == F.lit(season), F.lit(False)), F.lit(FOREIGN))
    if lacking:
        reason = reason.otherwise(F.nullif(F.concat_ws(", ", *lacking), F.lit("")))
    obs = Observation("season_guard")
    marked = chunk.withColumn("_reason", reason).observe(
        obs, F.count_if(F.col("_reason").isNull()).alias("written"),
        F.count_if(F.col("_reason") == FOREIGN).alias("dropped"),
        F.count_if(F.col("_reason") != FOREIGN).alias("refused"))
    with staged_copy(spark, marked, "season") as st:
        seen = obs.get
        rejected = st.where("_reason is not null")
        if quarantine and seen["dropped"] + seen["refused"]:
            rejected.select(
                F.lit(table).alias("table_name"), F.lit(season).cast("long").alias("season"),
                F.when(F.col("_reason") == FOREIGN, F.col("_reason"))
                .otherwise(F.concat(F.lit("NULL in "), "_reason")).alias("reason"),
                F.to_json(F.struct(*chunk.columns)).alias("row"), F.current_timestamp().alias("rejected_at"),
            ).write.mode("append").parquet(quarantine)
        if seen["refused"]:
            counts = rejected.where(F.col("_reason") != FOREIGN).groupBy("_reason").count().orderBy("_reason").collect()
            raise ValueError(f"NULL values in required columns: { {r['_reason']: r['count'] for r in counts} }")
        # one value per foreign season
        foreign = rejected.where(F.col(column).isNotNull()).agg(F.sort_array(F.collect_set(column))).first()[0]

        def value(f: T.StructField):
            if f.name in chunk.columns:
                return F.col(f.name)
            return F.current_timestamp() if f.name == INGESTED_AT else F.lit(None).cast(f.dataType)

        rows = st.where("_reason is null").select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields])
        if cluster_by:
            # the partition column first: the writer then takes the rows as they are sorted
            rows = clustered(rows, [column, *cluster_by])
        publish(spark, table, rows, (column,), [Row(season)])
        return WriteSeasonResult(int(seen["written"]), int(seen["dropped"]), [int(s) for s in foreign])


def replaced(existing: DataFrame, chunk: DataFrame, season: int, column: str = "season") -> DataFrame:
    """The table state after replacing one season, as a plan (no write)."""
    other = existing.where(F.col(column).isNull() | (F.col(column) != F.lit(season)))
    return other.unionByName(chunk.where(F.col(column) == F.lit(season)).select(*existing.columns))


# --- run logs -----------------------------------------------------------------

RUN_STATUSES = ("success", "empty", "failed")


def run_log_rows(chunks: DataFrame, status, rows=None, error=None, version: str = __version__) -> DataFrame:
    """Run-log rows for chunks: status, rows written, the whole error text,
    run time and code version. Each may be a value or a column."""
    def c(x):
        return x if not isinstance(x, (str, int, type(None))) else F.lit(x)
    return chunks.select("*", c(status).cast("string").alias("status"),
                         c(rows).cast("long").alias("rows"),
                         c(error).cast("string").alias("error"),
                         F.current_timestamp().alias("run_at"), F.lit(version).alias("version"))


def log_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The log written so far, if any."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def append_run_log(log_rows: DataFrame, path: str) -> bool:
    """Append run-log rows. A failed append is reported (False, and logged)
    but never raised: the data it describes is already written and the
    writes are idempotent, so a later rerun repairs the log."""
    import logging
    try:
        log_rows.write.mode("append").parquet(path)
        return True
    except Exception as exc:  # noqa: BLE001 - the load itself succeeded
        logging.getLogger(__name__).error("run-log append to %s failed: %s", path, exc)
        return False


def completed(log: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys with any success or empty run (a later failure does not undo it)."""
    return log.where(F.col("status").isin("success", "empty")).select(*keys).distinct()
