"""Raw zone: immutable artifacts per (source, dataset, day, run) and their manifest.

Artifacts are folders ``<root>/<source>/<dataset>/dt=YYYYMMDD/run_id=<run>`` so that
day and run are partition columns: a scan opens only the runs it is told to.  The
manifest is a dataset of its own, ``<root>/manifest``, partitioned by source and dataset,
one row per landed artifact; an artifact counts only once its manifest row is written.
Single-file artifacts (``<run>.parquet``) and JSON manifests of older zones are read by
the functions at the end of the module; ``raw_health`` checks both kinds of zone.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import quality as Q
from lakemart.operators.shaping import align, union_by_name
from lakemart.plans import schemas
from lakemart.plans.staging import latest_artifacts
from lakemart.session import remove

ARTIFACT_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("partition_date", T.DateType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("written_at", T.TimestampNTZType()),
        T.StructField("request_params_hash", T.StringType()),
        T.StructField("schema_hash", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Artifact formats and the data files each is made of.
FILES_OF = {"parquet": "*.parquet", "json": "*.json.gz"}

_SEGMENT = re.compile(r"^[A-Za-z0-9][A-Za-z0-9_.\-]*$")


class RunAlreadyLanded(RuntimeError):
    """The manifest holds this run for this day; a run lands once."""


def _segment(value: str, what: str) -> str:
    if not _SEGMENT.match(value):
        raise ValueError(f"{what} is not a plain path segment: {value!r}")
    return value


def dataset_path(root: str, source_id: str, dataset: str) -> str:
    return f"{root}/{_segment(source_id, 'source_id')}/{_segment(dataset, 'dataset')}"


def artifact_path(root: str, source_id: str, dataset: str, partition_date: date, run_id: str) -> str:
    base = dataset_path(root, source_id, dataset)
    return f"{base}/dt={partition_date:%Y%m%d}/run_id={_segment(run_id, 'run_id')}"


def manifest_path(root: str) -> str:
    return f"{root}/manifest"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet dataset, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Every landed artifact; empty before the first one.

    Rows that are equal in all fields are one entry: ``compact_manifest`` writes before it deletes.
    """
    rows = read_or_empty(spark, manifest_path(root), ARTIFACT_SCHEMA).select(*ARTIFACT_SCHEMA.fieldNames())
    plain = [c for c in ARTIFACT_SCHEMA.fieldNames() if c != "metadata"]
    # Maps cannot be compared, so equal rows are told by the text of theirs.
    return rows.withColumn("_m", F.to_json("metadata")).dropDuplicates([*plain, "_m"]).select(*ARTIFACT_SCHEMA.fieldNames())


def compact_manifest(spark: SparkSession, root: str) -> int:
    """Rewrites the manifest as one file a dataset; returns how many files went.

    The new files are written before the old ones are deleted, one by one, so a run that stops anywhere leaves
    every entry readable, some of them twice, which ``artifacts`` sees as one.  Landings may go on meanwhile: what they
    append is not among the files deleted.
    """
    old = read_or_empty(spark, manifest_path(root), ARTIFACT_SCHEMA).inputFiles()
    if len(old) > 1:
        _enter(artifacts(spark, root), root)
        for file in old:
            remove(spark, file)
    return len(old) if len(old) > 1 else 0


def list_artifacts(
    spark: SparkSession, root: str, source_id: str, dataset: str, partition_date: date | None = None
) -> DataFrame:
    """Artifacts of a dataset, oldest load first."""
    rows = artifacts(spark, root).where((F.col("source_id") == source_id) & (F.col("dataset") == dataset))
    if partition_date is not None:
        rows = rows.where(F.col("partition_date") == F.lit(partition_date))
    return rows.orderBy("written_at")


def _land(
    df: DataFrame,
    root: str,
    source_id: str,
    dataset: str,
    partition_date: date,
    run_id: str,
    file_format: str,
    request_hash: str | None,
    metadata: Mapping[str, Any] | None,
    written_at: datetime | None,
) -> None:
    spark = df.sparkSession
    path = artifact_path(root, source_id, dataset, partition_date, run_id)
    landed = list_artifacts(spark, root, source_id, dataset, partition_date).where(F.col("run_id") == run_id)
    if not landed.isEmpty():
        raise RunAlreadyLanded(f"{source_id}/{dataset}: run {run_id} of {partition_date} is in the manifest")
    counted = Observation()
    writer = df.observe(counted, F.count("*").alias("rows")).write.mode("overwrite")
    if file_format == "json":
        writer = writer.option("compression", "gzip")
    # Overwrite replaces what an unfinished earlier attempt left; the manifest comes last.
    writer.format(file_format).save(path)
    row = (
        source_id,
        dataset,
        partition_date,
        run_id,
        path,
        counted.get["rows"],
        written_at or datetime.now(timezone.utc).replace(tzinfo=None),
        request_hash or "",
        _schema_hash(df),
        {k: str(v) for k, v in {**(metadata or {}), "format": file_format}.items()},
    )
    _enter(spark.createDataFrame([row], ARTIFACT_SCHEMA), root)


def _enter(rows: DataFrame, root: str) -> None:
    """Appends manifest rows, one file a dataset; from here on their artifacts count."""
    rows.select(*ARTIFACT_SCHEMA.fieldNames()).coalesce(1).write.mode("append").partitionBy("source_id", "dataset").parquet(
        manifest_path(root)
    )


def _schema_hash(df: DataFrame) -> str:
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def params_hash(params: Mapping[str, Any] | None) -> str:
    """Stable hash of request parameters; empty when there are none."""
    if not params:
        return ""
    return hashlib.sha256(json.dumps(dict(params), sort_keys=True, default=str).encode()).hexdigest()


def write_raw(
    df: DataFrame,
    root: str,
    source_id: str,
    dataset: str,
    partition_date: date,
    run_id: str,
    request_params: Mapping[str, Any] | None = None,
    metadata: Mapping[str, Any] | None = None,
    written_at: datetime | None = None,
) -> None:
    """Land one Parquet artifact; a run id that already landed is refused."""
    _land(df, root, source_id, dataset, partition_date, run_id, "parquet", params_hash(request_params), metadata, written_at)


def write_raw_json(
    df: DataFrame,
    root: str,
    source_id: str,
    dataset: str,
    partition_date: date,
    run_id: str,
    request_params: Mapping[str, Any] | None = None,
    metadata: Mapping[str, Any] | None = None,
    written_at: datetime | None = None,
) -> None:
    """Land one gzip JSON artifact, one object per line."""
    _land(df, root, source_id, dataset, partition_date, run_id, "json", params_hash(request_params), metadata, written_at)


def new_artifacts(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """Incoming artifacts whose run id has not landed in their partition."""
    keys = ["source_id", "dataset", "partition_date", "run_id"]
    have = landed.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    return incoming.join(have, [incoming[k] == have[f"_h_{k}"] for k in keys], "left_anti")


def land_many(
    df: DataFrame, root: str, source_id: str, dataset: str, date_column: str, run_id: str,
    written_at: datetime | None = None,
    request_params: Mapping[str, Any] | None = None,
    metadata: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Land one artifact per day of ``date_column`` (YYYYMMDD text) in a single job; returns what was set aside.

    Rows are aligned to the dataset's declared schema.  A row whose day is no calendar date has
    no partition: it goes to the quarantine of the run, before any artifact is written, and the rest
    lands.  Days that already hold the run id are left out.  All artifacts of a call share
    one request scope.  The result has (fault, detail, row_count); see ``quarantined`` for the rows.
    """
    return _land_days(_with_faults(df, date_column), df, root, source_id, dataset, date_column, run_id, written_at, request_params, metadata)


def land_csv(
    spark: SparkSession, csv_path: str, root: str, source_id: str, dataset: str, date_column: str, run_id: str,
    written_at: datetime | None = None,
    request_params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Land a headed CSV corpus as raw partitions, one per day; returns what was set aside.

    All values are read as text.  Lines that do not have the header's fields go to the quarantine as
    they stand, so do rows without a calendar date; columns the dataset does not declare are
    counted in the result and do not land.
    """
    header = spark.read.option("header", True).csv(csv_path).columns
    declared = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _LINE]])
    # A line's number of fields is only seen where all columns are parsed.
    reader = spark.read.schema(declared).option("header", True).option("columnPruning", False)
    text = reader.option("columnNameOfCorruptRecord", _LINE).csv(csv_path)
    checked = _with_faults(text, date_column, [("malformed_line", F.col(_LINE).isNotNull(), F.col(_LINE))])
    return _land_days(checked, text.drop(_LINE), root, source_id, dataset, date_column, run_id, written_at, request_params, None)


#: A CSV line as it stands where it does not fit the header.
_LINE = "_line"
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("fault", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("record", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)


def _with_faults(df: DataFrame, date_column: str, more: Sequence[tuple[str, Column, Column]] = ()) -> DataFrame:
    """Adds ``_fault`` and ``_detail``: the first thing that keeps a row from landing."""
    day = F.trim(F.col(date_column).cast("string"))
    rules = [*more, ("no_calendar_date", ~Q.is_trade_date(F.coalesce(day, F.lit(""))), F.coalesce(day, F.lit("NULL")))]
    fault, detail = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, wrong, what in reversed(rules):
        fault, detail = F.when(wrong, name).otherwise(fault), F.when(wrong, what).otherwise(detail)
    return df.withColumns({"_fault": fault, "_detail": detail})


def quarantine_path(root: str, source_id: str, dataset: str) -> str:
    return f"{root}/quarantine/{_segment(source_id, 'source_id')}/{_segment(dataset, 'dataset')}"


def quarantined(spark: SparkSession, root: str, source_id: str, dataset: str) -> DataFrame:
    """Rows no run could land: the fault, the value it was seen in, and the whole record as JSON."""
    return read_or_empty(spark, quarantine_path(root, source_id, dataset), QUARANTINE_SCHEMA)


def _land_days(checked, df, root, source_id, dataset, date_column, run_id, written_at, request_params, metadata) -> DataFrame:
    spark = df.sparkSession
    _segment(run_id, "run_id")
    base = dataset_path(root, source_id, dataset)
    folder = f"{quarantine_path(root, source_id, dataset)}/run_id={run_id}"
    record = F.to_json(F.struct(*[c for c in checked.columns if not c.startswith("_")]))
    aside = checked.where(F.col("_fault").isNotNull())
    aside.select(F.col("_fault").alias("fault"), F.col("_detail").alias("detail"), record.alias("record")).write.mode("overwrite").parquet(folder)
    good = checked.where(F.col("_fault").isNull()).select(*[F.col(f"`{c}`") for c in df.columns])
    dated = good.withColumns({"dt": F.trim(F.col(f"`{date_column}`").cast("string")), "run_id": F.lit(run_id)})
    declared = align(dated, _with_partition(schemas.raw_schema(dataset)))
    done = list_artifacts(spark, root, source_id, dataset).where(F.col("run_id") == run_id)
    done = done.select(F.date_format("partition_date", "yyyyMMdd").alias("_dt"))
    fresh = declared.join(done, declared["dt"] == done["_dt"], "left_anti")
    # Repartitioning by day and a bounded salt keeps one file set per day without
    # sending a very large day through one task.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in schemas.RAW_COLUMNS[dataset]]), F.lit(max(1, width // 8)))
    options = {"partitionOverwriteMode": "dynamic"}
    fresh.repartition("dt", salt).write.mode("overwrite").options(**options).partitionBy("dt", "run_id").parquet(base)
    stamp = written_at or datetime.now(timezone.utc).replace(tzinfo=None)
    described = {k: str(v) for k, v in {**(metadata or {}), "format": "parquet"}.items()}
    written = read_raw(spark, root, source_id, dataset).where(F.col("run_id") == run_id)
    counts = written.groupBy("dt").agg(F.count("*").alias("row_count")).join(done, F.col("dt") == F.col("_dt"), "left_anti")
    rows = counts.select(
        F.lit(source_id).alias("source_id"),
        F.lit(dataset).alias("dataset"),
        F.to_date("dt", "yyyyMMdd").alias("partition_date"),
        F.lit(run_id).alias("run_id"),
        F.concat(F.lit(f"{base}/dt="), "dt", F.lit(f"/run_id={run_id}")).alias("path"),
        "row_count",
        F.lit(stamp).cast("timestamp_ntz").alias("written_at"),
        F.lit(params_hash(request_params)).alias("request_params_hash"),
        F.lit(_schema_hash(df)).alias("schema_hash"),
        F.create_map(*[F.lit(x) for pair in described.items() for x in pair]).alias("metadata"),
    )
    _enter(rows, root)
    return _set_aside(spark, folder, df, dataset)


def _set_aside(spark: SparkSession, folder: str, df: DataFrame, dataset: str) -> DataFrame:
    """(fault, detail, row_count): quarantined rows by fault, and undeclared columns with their number of values."""
    rows = spark.read.schema(QUARANTINE_SCHEMA).parquet(folder)
    faults = rows.groupBy("fault").agg(F.count("*").alias("row_count")).select("fault", F.lit(None).cast("string").alias("detail"), "row_count")
    extra = [c for c in df.columns if c not in schemas.RAW_COLUMNS[dataset]]
    if not extra:
        return faults
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in extra])
    columns = counted.unpivot([], [F.col(f"`{c}`") for c in extra], "detail", "row_count")
    return faults.unionByName(columns.select(F.lit("undeclared_column").alias("fault"), "detail", "row_count"))


# --------------------------------------------------------------- reading


def _with_partition(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dt", T.StringType()), T.StructField("run_id", T.StringType())])


def read_raw(
    spark: SparkSession, root: str, source_id: str, dataset: str, schema: T.StructType | None = None, file_format: str = "parquet"
) -> DataFrame:
    """All artifacts of a dataset and format under its declared schema; absent columns are NULL.

    A JSON value that does not fit its declared type ends the read with an error.
    """
    reader = spark.read.schema(_with_partition(schema or schemas.raw_schema(dataset))).option("pathGlobFilter", FILES_OF[file_format])
    if file_format == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(file_format).load(dataset_path(root, source_id, dataset))


def data_folders(spark: SparkSession, path: str) -> DataFrame:
    """(path) of every artifact folder below ``path`` that holds a data file, by listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    named = files.select(plain_path(F.col("path")).alias("file")).where(F.col("file").rlike(r"[.](parquet|json[.]gz)$"))
    folder = F.regexp_extract("file", r"^(.*/dt=[^/]+/run_id=[^/]+)/[^/]+$", 1)
    return named.select(folder.alias("path")).where(F.col("path") != "").distinct()


def plain_path(path: Column) -> Column:
    """A path without the local scheme, which readers add and manifests may lack."""
    return F.regexp_replace(path, "^file:/+", "/")


def _format(metadata: str = "metadata") -> Column:
    return F.coalesce(F.col(metadata)["format"], F.lit("parquet"))


def read_latest(spark: SparkSession, root: str, source_id: str, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the winning artifacts, Parquet and JSON alike, with ``source_run_id`` and ``raw_loaded_at``.

    Winners meet the data by a join on the partition columns, at any number of artifacts: at
    run time the scan opens the partitions of the winners only (dynamic partition pruning), and no
    list of paths passes through the driver.  A winner without a data file ends the query with an
    error: the join key of its row is an error expression, which is evaluated before anything is joined.
    """
    partitioned, request_scoped = schemas.selection_mode(dataset)
    declared = _with_partition(schema or schemas.raw_schema(dataset))
    landed = artifacts(spark, root).where((F.col("source_id") == source_id) & (F.col("dataset") == dataset))
    # One row a format: two at most.
    formats = sorted(r["format"] for r in landed.select(_format().alias("format")).distinct().collect())
    names = {"run_id": "source_run_id"}
    if not formats:
        return spark.createDataFrame([], declared).withColumn("raw_loaded_at", F.lit(None).cast("timestamp_ntz")).withColumnsRenamed(names).drop("dt")
    have = data_folders(spark, dataset_path(root, source_id, dataset)).withColumnRenamed("path", "_have")
    winners = latest_artifacts(landed, partitioned, request_scoped).withColumn("_path", plain_path(F.col("path")))
    missing = F.raise_error(F.concat(F.lit("the manifest names an artifact without data files: "), F.col("path"))).cast("string")
    winners = winners.join(have, winners["_path"] == have["_have"], "left").select(
        F.date_format("partition_date", "yyyyMMdd").alias("_dt"),
        F.when(F.col("_have").isNull(), missing).otherwise(F.col("run_id")).alias("_run"),
        F.col("written_at").alias("raw_loaded_at"),
        _format().alias("_format"),
    )
    found = []
    for kind in formats:
        rows = read_raw(spark, root, source_id, dataset, schema, kind)
        mine = winners.where(F.col("_format") == kind)
        found.append(rows.join(mine, (rows["dt"] == mine["_dt"]) & (rows["run_id"] == mine["_run"]), "inner"))
    return union_by_name(found).withColumnsRenamed(names).drop("_dt", "_run", "_format", "dt")


# --------------------------------------------------------------- older zones


def read_json_manifests(spark: SparkSession, paths: Sequence[str], names: str | None = None) -> DataFrame:
    """JSON manifests with their nested artifact list, one row per manifest.

    ``names`` is a pattern for the manifests among the files below ``paths``.  The reader hides names starting with
    ``_`` or ``.``; copy such manifests to a visible name first.
    """
    hidden = [p for p in [*paths, names or ""] if p.rsplit("/", 1)[-1].startswith(("_", "."))]
    if hidden:
        raise ValueError(f"hidden manifest names cannot be read: {hidden[:3]}")
    reader = spark.read.schema(schemas.MANIFEST_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", names) if names else reader).json(list(paths))


def explode_manifests(manifests: DataFrame) -> DataFrame:
    """One row per artifact entry, next to the header fields of its manifest."""
    return manifests.select(
        F.col("source_id").alias("manifest_source_id"),
        F.col("dataset").alias("manifest_dataset"),
        F.col("partition_date").alias("manifest_partition_date"),
        F.inline("artifacts"),
    )


def artifact_rows(entries: DataFrame) -> DataFrame:
    """Typed artifact rows for latest-artifact selection."""
    day = F.coalesce("partition_date", "manifest_partition_date").cast("date")
    return entries.select(
        F.coalesce("source_id", "manifest_source_id").alias("source_id"),
        F.coalesce("dataset", "manifest_dataset").alias("dataset"),
        day.alias("partition_date"),
        "run_id",
        "path",
        "row_count",
        utc_wall(F.col("written_at").cast("string")).alias("written_at"),
        "request_params_hash",
    )


def utc_wall(text: Column) -> Column:
    """UTC wall-clock time of an ISO time text, whatever the session's zone; a text without offset is UTC."""
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), shifted).otherwise(text.try_cast("timestamp_ntz"))


def read_single_files(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Artifacts stored as ``dt=YYYYMMDD/<run>.parquet``; the run id is the file name."""
    declared = T.StructType([*schema.fields, T.StructField("dt", T.StringType())])
    rows = spark.read.schema(declared).option("pathGlobFilter", "*.parquet").parquet(folder)
    return rows.select("*", F.regexp_extract(F.input_file_name(), r"([^/]+)[.]parquet$", 1).alias("run_id"))
