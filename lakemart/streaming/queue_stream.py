"""Structured Streaming over the candidate queue.

A batch is written to its own folder with overwrite, so a batch replayed after a
failure replaces itself; readers take the union of the folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakemart.plans.queue import IDEMPOTENCY_KEY, QUEUE_SCHEMA, validate, validation_counts, with_idempotency_key
from lakemart.session import shared_folder


def new_run_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/lakemart-streams/{label}-{uuid.uuid4().hex}"


def queue_source(
    spark: SparkSession, folder: str, schema: T.StructType = QUEUE_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    """Candidates arriving as JSON lines in a folder, oldest files first, so many files a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def file_source(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def append_candidates(candidates: DataFrame, folder: str) -> None:
    """Batch sink: append candidates to the folder a queue stream reads."""
    candidates.write.mode("append").json(folder)


def _started(stream: DataFrame, root: str, write, mode: str = "append") -> StreamingQuery:
    """Runs ``write`` on every batch of what has arrived by now."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _batch_folder(root: str, part: str, batch_id: int) -> str:
    return f"{root}/{part}/batch_id={batch_id}"


def read_part(spark: SparkSession, root: str, part: str, schema: T.StructType) -> DataFrame:
    """All batches of one output; ``batch_id`` comes from the folder name."""
    declared = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(declared).parquet(f"{root}/{part}")


def validate_stream(candidates: DataFrame, root: str) -> StreamingQuery:
    """Validates arriving candidates: accepted rows, rejected rows and counts per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate(batch).persist()
        try:
            for status in ("accepted", "rejected"):
                part = checked.where(F.col("validation_status") == status)
                part.write.mode("overwrite").parquet(_batch_folder(root, status, batch_id))
            validation_counts(checked).write.mode("overwrite").parquet(_batch_folder(root, "counts", batch_id))
        finally:
            checked.unpersist()

    return _started(candidates, root, write)


# --------------------------------------------------------------- idempotent submission
# The state store holds one small row per delta key, the submission that came first, dealt
# to its partitions by key.  It is the state of a streaming minimum over the time of the batch and
# the order within it, so no Python runs per key.  A batch looks up its own keys there and reads no
# earlier output.  Keys are never forgotten, so the store grows with the distinct deltas; with the
# session's RocksDB provider it lies on disk, and its changes in the checkpoint folder.

_KEY = list(IDEMPOTENCY_KEY)


def _arrival() -> Column:
    """Earliest batch first; within it the lowest ingest sequence, NULL last, then the lowest id."""
    return F.struct(
        F.current_timestamp().alias("batch_at"),
        F.col("ingest_seq").isNull().alias("no_seq"),
        "ingest_seq",
        F.col("id").isNull().alias("no_id"),
        "id",
    )


def dedup_stream(candidates: DataFrame, root: str) -> StreamingQuery:
    """Answers every submission with the first one of its delta, across batches and restarts.

    Writes ``first`` (rows without a delta id, and the first row of each delta) and
    ``receipts`` (submission_id, candidate_id, ingest_seq, replayed) per batch.  Within a
    batch the lowest ingest sequence comes first, NULL last; an earlier batch comes before a
    later one, by the time Spark notes for each batch in its checkpoint, which a replayed batch
    keeps.  A replayed batch finds the store as it was before that batch.
    """
    keyed = with_idempotency_key(candidates).select(*QUEUE_SCHEMA.fieldNames(), "delta_id")
    # In update mode a batch gets the keys it holds; ``known``: an earlier batch stored the key.
    firsts = (
        keyed.where(F.col("delta_id").isNotNull())
        .select(*_KEY, _arrival().alias("arrival"))
        .groupBy(*_KEY)
        .agg(F.min("arrival").alias("first"))
        .withColumn("known", F.col("first.batch_at") < F.current_timestamp())
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # Read more than once, and the state may be taken one step further only once a batch.
        arrived = batch.persist()
        try:
            rows = arrived.where(F.col("first").isNull()).drop("first", "known")
            stored = arrived.where(F.col("first").isNotNull()).select(
                *[F.col(k).alias(f"_{k}") for k in _KEY],
                F.col("first.id").alias("first_id"),
                F.col("first.ingest_seq").alias("first_seq"),
                "known",
                F.lit(True).alias("has_delta"),
            )
            answered = rows.join(stored, [rows[k].eqNullSafe(stored[f"_{k}"]) for k in _KEY], "left")
            is_first = F.col("has_delta").isNull() | (~F.col("known") & F.col("id").eqNullSafe(F.col("first_id")))
            # As in ``submission_receipts``, a key with a NULL is stored once but answers nobody else.
            told = F.col("has_delta").isNotNull()
            for k in _KEY:
                told = told & F.col(k).isNotNull()
            answered.select(
                F.col("id").alias("submission_id"),
                F.when(told, F.col("first_id")).otherwise(F.col("id")).alias("candidate_id"),
                F.when(told, F.col("first_seq")).otherwise(F.col("ingest_seq")).alias("ingest_seq"),
                (told & ~is_first).alias("replayed"),
            ).write.mode("overwrite").parquet(_batch_folder(root, "receipts", batch_id))
            answered.where(is_first).select(*rows.columns).write.mode("overwrite").parquet(_batch_folder(root, "first", batch_id))
        finally:
            arrived.unpersist()

    return _started(keyed.unionByName(firsts, allowMissingColumns=True), root, write, "update")


# --------------------------------------------------------------- windowed rates
# A batch adds its counts per window to a log; a window's value is the sum of its rows,
# so rows that come after their window was closed correct it instead of vanishing.

CLOCK_SCHEMA = T.StructType([T.StructField("newest", T.TimestampType())])
RATES_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("submitted_by", T.StringType()),
        T.StructField("accepted", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("closed", T.BooleanType()),
    ]
)


def rates_stream(
    validated: DataFrame, root: str, delay: str = "1 hour", width: str = "1 day", event_time: str = "submitted_at"
) -> StreamingQuery:
    """Accepted and total candidates per submitter and tumbling window, exact whatever order rows arrive in.

    A window is closed once event time (the newest of all earlier batches) has passed its end by
    ``delay``.  ``rates`` holds each batch's additions, marked ``closed`` where their window was; the
    rows behind such additions are written to ``late`` with the time their window ended and the
    watermark they missed.  ``clock`` holds the newest event time, one row per batch, of which
    a batch reads its predecessor's.  Rows without event time have no window and are written to ``late`` too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # F.window would drop rows without a time.
        timed = batch.withColumn("_window", F.window(F.coalesce(event_time, F.lit(0).cast("timestamp")), width))
        rows = timed.withColumn("_window", F.when(F.col(event_time).isNotNull(), F.col("_window"))).persist()
        try:
            before = None
            if batch_id > 0:
                before = spark.read.schema(CLOCK_SCHEMA).parquet(_batch_folder(root, "clock", batch_id - 1)).first()["newest"]
            mark = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
            closed = F.coalesce(F.col("_window.end") <= mark, F.lit(False))
            rows.where(F.col("_window").isNotNull()).groupBy("_window", "submitted_by").agg(
                F.count_if(F.col("validation_status") == "accepted").alias("accepted"), F.count("*").alias("total")
            ).select(
                F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "submitted_by",
                "accepted", "total", closed.alias("closed"),
            ).write.mode("overwrite").parquet(_batch_folder(root, "rates", batch_id))
            late = rows.where(closed | F.col("_window").isNull())
            late.select(*batch.columns, F.col("_window.end").alias("window_end"), mark.alias("watermark")).write.mode("overwrite").parquet(
                _batch_folder(root, "late", batch_id)
            )
            newest = rows.agg(F.greatest(F.max(event_time), F.lit(before).cast("timestamp")).alias("newest"))
            newest.coalesce(1).write.mode("overwrite").parquet(_batch_folder(root, "clock", batch_id))
        finally:
            rows.unpersist()

    return _started(validated, root, write)


def latest_rates(spark: SparkSession, root: str) -> DataFrame:
    """Every window's counts, late rows included, and how many of its rows came after it was closed."""
    log = read_part(spark, root, "rates", RATES_SCHEMA)
    return log.groupBy("window_start", "window_end", "submitted_by").agg(
        F.sum("accepted").alias("accepted"),
        F.sum("total").alias("total"),
        F.sum(F.when(F.col("closed"), F.col("total")).otherwise(0)).alias("late_rows"),
    )


def late_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that missed their window, with its end and the watermark they met."""
    added = [T.StructField("window_end", T.TimestampType()), T.StructField("watermark", T.TimestampType())]
    return read_part(spark, root, "late", T.StructType([*schema.fields, *added]))
