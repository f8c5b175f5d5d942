"""Published tables as versioned folders, and the manifests that make a version visible.

``<root>/<table>/v=<snapshot>`` holds one immutable version.  A publish writes every
table of its set first and appends one manifest row last, so readers, who start from
the manifest, see the whole set or nothing.  A failed publish leaves folders no
manifest names.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.quality import pairing_report
from lakemart.operators.shaping import matching, only
from lakemart.plans import contracts, manifests, marts, schemas
from lakemart.session import recorded, remove, shuffles_dropped, written
from lakemart.sources.raw_zone import plain_path, read_or_empty

MART_SPACE = "canonical_v2"
LINEAGE_SPACE = "canonical_lineage"

SET_SCHEMA = T.StructType(
    [
        T.StructField("set_id", T.LongType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField(
            "tables",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("snapshot_id", T.LongType()),
                        T.StructField("row_count", T.LongType()),
                        T.StructField("schema", T.StringType()),
                        T.StructField("month_of", T.StringType()),
                    ]
                ),
            ),
        ),
    ]
)


class SnapshotNotPublished(LookupError):
    """No manifest names the requested table or snapshot."""


class AlreadyPublished(RuntimeError):
    """The cycle has a publish manifest already."""


class PairingError(ValueError):
    """A mart and its lineage do not have the same keys."""


class EmptyResult(ValueError):
    """An empty table was about to be published."""


@dataclass(frozen=True)
class KeyDigest:
    """What a write tells about its keys: rows, rows with a NULL in the key, and two sums of key hashes.

    Tables with equal digests hold the same keys equally often: the sums of two independent 64-bit hashes do not
    agree otherwise, save with a chance of about 2^-100.
    """

    rows: int
    null_rows: int
    first: int
    second: int

    @staticmethod
    def columns(keys: Sequence[str]) -> list[Column]:
        key = [F.col(k) for k in keys]
        wide = lambda h: F.sum(h.cast("decimal(20,0)"))
        missing = F.greatest(*[k.isNull() for k in key], F.lit(False))
        return [
            F.count_if(missing).alias("null_rows"),
            wide(F.xxhash64(*key)).alias("first"),
            wide(F.xxhash64(F.lit("second"), *key)).alias("second"),
        ]


@dataclass(frozen=True)
class WriteResult:
    table: str
    snapshot_id: int
    row_count: int
    duration_ms: int
    digest: KeyDigest | None = None


def now_ntz() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _sets_path(root: str) -> str:
    return f"{root}/published_sets"


def _cycles_path(root: str) -> str:
    return f"{root}/published_cycles"


def snapshot_path(root: str, table: str, snapshot_id: int) -> str:
    return f"{root}/{table.replace('.', '/')}/v={snapshot_id}"


def published_sets(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, _sets_path(root), SET_SCHEMA)


def _newest_set(spark: SparkSession, root: str):
    """The one manifest row readers start from, or None."""
    rows = published_sets(spark, root).orderBy(F.desc("set_id")).limit(1).collect()
    return rows[0] if rows else None


def write_snapshot(
    df: DataFrame,
    root: str,
    table: str,
    snapshot_id: int,
    expected: T.StructType | None = None,
    allow_empty: bool = False,
    month_of: str | None = None,
    keys: Sequence[str] = (),
) -> WriteResult:
    """Writes one immutable version after the contract check; row count and key digest come from the same job.

    ``month_of`` names a date column whose month partitions the files, so readers that
    filter on ``trade_month`` skip whole months.  A folder that an unfinished attempt left is replaced;
    callers take ids that no manifest names.
    """
    contracts.require_contract(df.schema, expected, table, lineage=table.startswith(LINEAGE_SPACE))
    counted = Observation()
    started = time.monotonic()
    out = df.observe(counted, F.count("*").alias("rows"), *(KeyDigest.columns(keys) if keys else []))
    if month_of:
        out = out.withColumn("trade_month", F.date_format(month_of, "yyyyMM"))
    writer = out.write.mode("overwrite").option("compression", "zstd")
    if month_of:
        writer = writer.partitionBy("trade_month")
    writer.parquet(snapshot_path(root, table, snapshot_id))
    seen = counted.get
    rows = seen["rows"]
    if not rows and not allow_empty:
        raise EmptyResult(f"{table} has no rows")
    digest = KeyDigest(rows, seen["null_rows"], int(seen["first"] or 0), int(seen["second"] or 0)) if keys else None
    return WriteResult(table, snapshot_id, rows, int((time.monotonic() - started) * 1000), digest)


def require_pairing(mart: DataFrame, lineage: DataFrame, keys: Sequence[str], table: str) -> None:
    """Fails unless both sides have the same unique, non-NULL keys; one row reaches the driver."""
    report = pairing_report(mart, lineage, keys).first().asDict()
    problems = [
        name
        for name in ("null_key_rows", "left_duplicate_keys", "right_duplicate_keys", "missing_in_right", "extra_in_right")
        if report[name]
    ]
    if report["left_rows"] != report["right_rows"]:
        problems.append("row_count")
    if problems:
        raise PairingError(f"{table}: {', '.join(problems)}; coverage {report['coverage']:.1%}: {report}")


def _next_id(previous) -> int:
    return max(previous["set_id"] if previous else 0, int(time.time() * 1000) - 1) + 1


def _declared(name: str, expected: Mapping[str, T.StructType] | None) -> tuple[T.StructType | None, T.StructType | None]:
    """Schemas of a mart and its lineage: the given ones, else the declared ones, else (a mart of one's own) none."""
    if expected is not None:
        return expected.get(f"{MART_SPACE}.{name}"), expected.get(f"{LINEAGE_SPACE}.lineage_{name}")
    if name not in schemas.MART_COLUMNS:
        return None, None
    return schemas.mart_schema(name), schemas.lineage_schema(name)


def publish_pairs(
    spark: SparkSession,
    root: str,
    pairs: Mapping[str, tuple[DataFrame, DataFrame]],
    keys: Mapping[str, Sequence[str]] | None = None,
    loaded_at: datetime | None = None,
    allow_empty: bool = False,
    month_of: Mapping[str, str] | None = None,
    expected: Mapping[str, T.StructType] | None = None,
) -> list[WriteResult]:
    """Publishes marts with their lineage as one set.

    All schemas are checked before anything is written: the marts of this library against their
    declared columns (names, order, types, nullability), others against ``expected``, which replaces the declared
    ones where it is given.  Every table gets the same load time.  Row counts and key digests come from the writing
    jobs; a pair is accepted if its digests are equal, no key has a NULL and the keys of the written lineage are
    unique.  The manifest row that makes the set visible comes last; any failure leaves the previous set in force.
    """
    publishing = _Publishing(spark, root, keys, loaded_at, allow_empty, month_of, expected)
    planned = {name: publishing.checked(name, pair) for name, pair in pairs.items()}
    for name, pair in planned.items():
        publishing.write(name, pair)
    return publishing.finish(pairs)


class _Publishing:
    """A set in the making: its pairs are checked, written one after the other, and made visible at the end."""

    def __init__(self, spark, root, keys, loaded_at, allow_empty, month_of, expected):
        self._spark, self._root, self._allow_empty, self._expected = spark, root, allow_empty, expected
        self._keys, self._month_of = dict(keys or {}), dict(month_of or {})
        self._previous = _newest_set(spark, root)
        self._id = _next_id(self._previous)
        self._stamp = loaded_at or now_ntz()
        self._results: dict[str, list[WriteResult]] = {}
        self._entries: dict[str, tuple] = {}

    def checked(self, name: str, pair: Sequence[DataFrame]) -> list[tuple[str, DataFrame, T.StructType | None]]:
        """Table name, stamped rows and declared schema of a mart and its lineage; a schema that differs is an error."""
        loaded = F.lit(self._stamp).cast("timestamp_ntz").alias(contracts.LOADED_AT)
        stamp_field = T.StructField(contracts.LOADED_AT, T.TimestampNTZType())
        found = []
        for space, label, df, wanted in zip((MART_SPACE, LINEAGE_SPACE), (name, f"lineage_{name}"), pair, _declared(name, self._expected), strict=True):
            table = f"{space}.{label}"
            stamped = df.select(*[c for c in df.columns if c != contracts.LOADED_AT], loaded)
            if wanted is not None:
                names = [f for f in wanted.fields if f.name != contracts.LOADED_AT]
                wanted = T.StructType([*names, stamp_field])
                stamped = contracts.conformed(stamped, wanted, table)
            contracts.require_contract(stamped.schema, wanted, table, lineage=space == LINEAGE_SPACE)
            found.append((table, stamped, wanted))
        return found

    def write(self, name: str, pair: Sequence[tuple[str, DataFrame, T.StructType | None]]) -> None:
        """Writes a pair that was ``checked`` and holds its keys against each other."""
        key = list(self._keys.get(name) or schemas.mart_key(name))
        results = self._results[name] = []
        for table, stamped, wanted in pair:
            month = self._month_of.get(name)
            in_month = month if month and month in stamped.columns else None
            result = write_snapshot(stamped, self._root, table, self._id, wanted, self._allow_empty, in_month, key)
            results.append(result)
            self._entries[table] = (self._id, result.row_count, stamped.schema.json(), in_month)
        _require_equal_keys(self._spark, self._root, name, key, *results, self._entries)

    def finish(self, names: Sequence[str]) -> list[WriteResult]:
        """Makes the set visible; results in the order of ``names``."""
        carried = dict(self._previous["tables"].items()) if self._previous else {}
        tables = {t: tuple(v) for t, v in carried.items()}
        for name in names:
            tables |= {r.table: self._entries[r.table] for r in self._results[name]}
        _append_set(self._spark, self._root, self._id, self._stamp, tables)
        return [result for name in names for result in self._results[name]]


def _append_set(spark: SparkSession, root: str, set_id: int, stamp: datetime, tables: Mapping[str, tuple]) -> None:
    spark.createDataFrame([(set_id, stamp, dict(tables))], SET_SCHEMA).coalesce(1).write.mode("append").parquet(_sets_path(root))


def _require_equal_keys(spark, root, name, key, mart: WriteResult, lineage: WriteResult, entries) -> None:
    """Equal digests, no NULL, and unique keys, which are read back from the narrower of the two tables only."""
    if mart.digest != lineage.digest or mart.digest.null_rows:
        # The report that says what differs costs both scans; it is only made for the error.
        sides = [_read_version(spark, root, r.table, entries).select(*key) for r in (mart, lineage)]
        require_pairing(*sides, key, name)
        raise PairingError(f"{name}: key digests differ: {mart.digest} and {lineage.digest}")
    stored = _read_version(spark, root, lineage.table, entries)
    repeated = stored.groupBy(*key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise PairingError(f"{name}: duplicate key {repeated[0].asDict()}")


def publish_marts(
    spark: SparkSession,
    root: str,
    staged: Mapping[str, DataFrame],
    names: Sequence[str] | None = None,
    loaded_at: datetime | None = None,
    allow_empty: bool = False,
    month_of: Mapping[str, str] | None = None,
    complete_keys: bool = False,
) -> list[WriteResult]:
    """Builds and publishes the marts over staging tables, all of them or ``names``, as one set.

    Every intermediate is executed once: it is written to the shared folder, the marts and lineages
    projected from it read that table, and it is deleted before the next one is written, as is what its builder wrote and
    what was shuffled for it, so beside the published tables one intermediate lies on disk at a time.  All schemas are
    checked on projections without rows before anything is published.  A NULL in a key is an error; with ``complete_keys`` such
    rows are left out of the mart and its lineage alike.
    """
    names = list(dict.fromkeys(names or marts.MARTS))
    members: dict[Any, list[str]] = {}
    for name in names:
        members.setdefault(marts.MARTS[name][0], []).append(name)

    def pair_of(name: str, built: DataFrame) -> tuple[DataFrame, ...]:
        pair = marts.MARTS[name][1](built)
        return tuple(df.dropna(subset=schemas.mart_key(name)) for df in pair) if complete_keys else pair

    publishing = _Publishing(spark, root, None, loaded_at, allow_empty, month_of, None)
    with recorded() as folders, shuffles_dropped(spark):
        try:
            lazy = {build: build(staged) for build in members}
            for build, df in lazy.items():
                # Tables read back may hold NULLs in any column.
                empty = spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))
                for name in members[build]:
                    publishing.checked(name, pair_of(name, empty))
            for build in members:
                made = written(lazy.pop(build), compact=True)
                for name in members[build]:
                    publishing.write(name, publishing.checked(name, pair_of(name, made[0])))
                remove(spark, made[1])
        finally:
            for folder in folders:
                remove(spark, folder)
    return publishing.finish(names)


def _read_version(spark: SparkSession, root: str, table: str, entries: Mapping[str, Sequence]) -> DataFrame:
    snapshot_id, _, schema, month = entries[table]
    return _read(spark, root, table, snapshot_id, T.StructType.fromJson(json.loads(schema)), month)


def _read(spark, root, table, snapshot_id, schema: T.StructType, month: str | None) -> DataFrame:
    declared = schema if not month else T.StructType([*schema.fields, T.StructField("trade_month", T.StringType())])
    return spark.read.schema(declared).parquet(snapshot_path(root, table, snapshot_id))


def _entry(spark: SparkSession, root: str, table: str, snapshot_id: int | None):
    if snapshot_id is None:
        newest = _newest_set(spark, root)
        entry = newest["tables"].get(table) if newest else None
    else:
        hits = (
            published_sets(spark, root)
            .select(F.explode("tables").alias("table_name", "e"))
            .where((F.col("table_name") == table) & (F.col("e.snapshot_id") == snapshot_id))
            .limit(1)
            .collect()
        )
        entry = hits[0]["e"] if hits else None
    if entry is None:
        raise SnapshotNotPublished(f"{table} snapshot {snapshot_id or 'latest'}")
    return entry


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    snapshot_id: int | None = None,
    columns: Sequence[str] | None = None,
    filters: Sequence[tuple[str, str, Any]] | None = None,
) -> DataFrame:
    """A published table at its newest or a pinned snapshot, with the schema it was published with."""
    entry = _entry(spark, root, table, snapshot_id)
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    df = _read(spark, root, table, entry["snapshot_id"], schema, entry["month_of"])
    kept = only(matching(df, filters), columns)
    return kept.drop("trade_month") if columns is None else kept


def current_snapshot_id(spark: SparkSession, root: str, table: str) -> int:
    return _entry(spark, root, table, None)["snapshot_id"]


def stock_basic(spark: SparkSession, root: str, active_only: bool = True) -> DataFrame:
    """Listed securities under their former column names."""
    filters = [("is_active", "=", True)] if active_only else None
    df = read_table(spark, root, f"{MART_SPACE}.stock_basic", filters=filters)
    return df.withColumnsRenamed({"security_id": "ts_code", "display_name": "name"})


# --------------------------------------------------------------- evolution


def evolve_table(
    spark: SparkSession, root: str, table: str, target: T.StructType, dry_run: bool = True
) -> contracts.Evolution:
    """Plans, and unless ``dry_run`` applies, a schema change as a new snapshot.

    Older snapshots keep their files and schema.
    """
    current = read_table(spark, root, table)
    plan = contracts.plan_evolution(current.schema, target)
    if dry_run or plan.rejections or not plan.changes:
        return plan
    have = set(current.columns)
    evolved = current.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
    )
    _replace(spark, root, table, evolved)
    return plan


def _partner(table: str) -> tuple[str, str]:
    """The other table of a pair, and the mart's name."""
    space, name = table.split(".", 1)
    if space == MART_SPACE:
        return f"{LINEAGE_SPACE}.lineage_{name}", name
    return f"{MART_SPACE}.{name.removeprefix('lineage_')}", name.removeprefix("lineage_")


def _replace(spark: SparkSession, root: str, table: str, df: DataFrame) -> WriteResult:
    """A new version of one table in a new set; its keys must still be those of the table it is paired with."""
    previous = _newest_set(spark, root)
    tables = {t: tuple(v) for t, v in previous["tables"].items()}
    month = tables[table][3]
    snapshot_id = _next_id(previous)
    result = write_snapshot(df, root, table, snapshot_id, month_of=month)
    tables[table] = (snapshot_id, result.row_count, df.schema.json(), month)
    other, name = _partner(table)
    if other in tables and name in schemas.MART_KEYS:
        key = schemas.mart_key(name)
        require_pairing(*[_read_version(spark, root, t, tables).select(*key) for t in (table, other)], key, name)
    _append_set(spark, root, snapshot_id, now_ntz(), tables)
    return result


def backfill_from_select(
    spark: SparkSession, root: str, table: str, select_sql: str, dry_run: bool = False
) -> WriteResult | None:
    """Replaces a table's content by one read-only SELECT over registered views."""
    text = select_sql.strip()
    if not text:
        raise ValueError("backfill SELECT must not be empty")
    if ";" in text:
        raise ValueError("backfill SQL must be one SELECT without semicolons")
    if text.split(None, 1)[0].lower() not in ("select", "with", "("):
        raise ValueError("backfill SQL must be a read-only SELECT")
    wanted = read_table(spark, root, table).schema
    rows = spark.sql(f"select * from ({text})")
    payload = T.StructType([f for f in wanted.fields if f.name != contracts.LOADED_AT])
    missing = [f.name for f in payload.fields if f.name not in rows.columns]
    extra = [c for c in rows.columns if c not in payload.fieldNames()]
    if missing or extra:
        raise contracts.ContractError(f"{table}: missing {missing}, unexpected {extra}")
    if dry_run:
        return None
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in payload.fields])
    stamped = typed.select("*", F.lit(now_ntz()).cast("timestamp_ntz").alias(contracts.LOADED_AT))
    return _replace(spark, root, table, stamped)


# --------------------------------------------------------------- contracts and leftovers


def contract_violations(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, problem) for every way a published table differs from its declared schema; one row of metadata is read."""
    newest = _newest_set(spark, root)
    found = []
    for table, entry in (newest["tables"].items() if newest else ()):
        name = _partner(table)[1]
        if name in schemas.MART_COLUMNS:
            wanted = schemas.mart_schema(name) if table.startswith(f"{MART_SPACE}.") else schemas.lineage_schema(name)
            wanted = T.StructType([*wanted.fields, T.StructField(contracts.LOADED_AT, T.TimestampNTZType())])
            actual = T.StructType.fromJson(json.loads(entry["schema"]))
            found += [(table, p) for p in contracts.schema_differences(actual, wanted, nullability=True)]
    return spark.createDataFrame(found, "table_name string, problem string")


def named_versions(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, snapshot_id) of every version any manifest names, of any set and any cycle."""
    sets = published_sets(spark, root).select(F.explode("tables").alias("table_name", "_e")).select("table_name", F.col("_e.snapshot_id").alias("snapshot_id"))
    cycles = manifests.published_tables(published_cycles(spark, root)).select("table_name", "snapshot_id")
    return sets.union(cycles).distinct()


def stored_versions(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, snapshot_id, path, files, bytes, last_write) of every version folder, by a distributed listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        plain_path(F.col("path")).alias("file"), "length", "modificationTime"
    )
    version = r"^(.*/([^/]+)/([^/]+)/v=(\d+))/"
    part = lambda n: F.regexp_extract("file", version, n)
    named = files.where(F.col("file").rlike(version)).select(
        F.concat(part(2), F.lit("."), part(3)).alias("table_name"), part(4).cast("long").alias("snapshot_id"), part(1).alias("path"), "length", "modificationTime"
    )
    return named.groupBy("table_name", "snapshot_id", "path").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("last_write")
    )


def leftovers(spark: SparkSession, root: str, grace: timedelta = timedelta(days=7), now: datetime | None = None) -> DataFrame:
    """Versions no manifest names whose last file is older than ``grace``: what failed publishes left behind.

    Mark and sweep: all named versions are kept, pinned and carried ones included, whichever set they are from.
    ``grace`` protects a publish that is still writing.
    """
    stored = stored_versions(spark, root)
    kept = named_versions(spark, root).select(F.col("table_name").alias("_t"), F.col("snapshot_id").alias("_s"))
    edge = (F.current_timestamp() if now is None else F.lit(now)) - F.make_dt_interval(secs=F.lit(grace.total_seconds()))
    old = stored.where(F.col("last_write") < edge)
    return old.join(kept, (old["table_name"] == kept["_t"]) & (old["snapshot_id"] == kept["_s"]), "left_anti")


def vacuum(spark: SparkSession, root: str, grace: timedelta = timedelta(days=7)) -> int:
    """Deletes the ``leftovers``; returns how many versions went.

    The list is written first and read one folder at a time.  A run that stops half way is simply repeated.
    """
    table, folder = written(leftovers(spark, root, grace).select("path"))
    gone = 0
    try:
        for row in table.toLocalIterator():
            remove(spark, row["path"])
            gone += 1
    finally:
        remove(spark, folder)
    return gone


# --------------------------------------------------------------- formal objects


def published_cycles(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, _cycles_path(root), manifests.MANIFEST_ROWS)


def publish_formal(
    spark: SparkSession,
    root: str,
    cycle_id: str,
    objects: Mapping[str, DataFrame],
    snapshot_id: int,
    published_at: datetime | None = None,
) -> None:
    """Writes a cycle's formal objects, then its manifest row; a cycle publishes once.

    The four required objects must be present and none may reveal a source.  A publish that failed can
    be repeated with its id.
    """
    unknown = sorted(set(objects) - set(manifests.FORMAL_OBJECTS))
    missing = [n for n in manifests.REQUIRED_OBJECTS if n not in objects]
    if unknown or missing:
        raise ValueError(f"formal set: missing {missing}, unknown {unknown}")
    if not manifests.by_cycle(published_cycles(spark, root), cycle_id).isEmpty():
        raise AlreadyPublished(cycle_id)
    for name, df in objects.items():
        hidden = contracts.forbidden_formal_fields(df.schema)
        if hidden:
            raise contracts.ContractError(f"{name}: forbidden public fields {hidden}")
    taken = manifests.published_tables(published_cycles(spark, root)).where(F.col("snapshot_id") == snapshot_id)
    if not taken.isEmpty():
        raise AlreadyPublished(f"snapshot {snapshot_id}")
    # No manifest names the id, so what lies under it is left from an attempt that failed.
    for name, df in objects.items():
        df.write.mode("overwrite").parquet(snapshot_path(root, f"{manifests.FORMAL_NAMESPACE}.{name}", snapshot_id))
    entries = {f"{manifests.FORMAL_NAMESPACE}.{name}": (snapshot_id,) for name in objects}
    row = (cycle_id, published_at or now_ntz(), entries)
    spark.createDataFrame([row], manifests.MANIFEST_ROWS).coalesce(1).write.mode("append").parquet(_cycles_path(root))


def read_formal(
    spark: SparkSession, root: str, object_name: str, cycle_id: str | None = None, snapshot_id: int | None = None
) -> tuple[str, int, DataFrame]:
    """(cycle, snapshot, rows) of a formal object: newest, of a cycle, or at a published snapshot."""
    if object_name not in manifests.FORMAL_OBJECTS:
        raise ValueError(f"unknown formal object name: {object_name!r}")
    table = f"{manifests.FORMAL_NAMESPACE}.{object_name}"
    rows = published_cycles(spark, root)
    if snapshot_id is not None:
        hit = manifests.by_snapshot(rows, table, snapshot_id)
    else:
        chosen = manifests.by_cycle(rows, cycle_id) if cycle_id else manifests.latest_manifest(rows)
        hit = manifests.published_tables(chosen).where(F.col("table_name") == table)
    found = hit.limit(1).collect()
    if not found:
        raise SnapshotNotPublished(f"{table} cycle {cycle_id} snapshot {snapshot_id}")
    df = spark.read.parquet(snapshot_path(root, table, found[0]["snapshot_id"]))
    hidden = contracts.forbidden_formal_fields(df.schema)
    if hidden:
        raise contracts.ContractError(f"{table}: forbidden public fields {hidden}")
    return found[0]["published_cycle_id"], found[0]["snapshot_id"], df
