"""Candidate queue: envelope validation, idempotent submission, rejection counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.ordering import latest_per_key

QUEUE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("payload_type", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("submitted_by", T.StringType()),
        T.StructField("submitted_at", T.TimestampNTZType()),
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("validation_status", T.StringType()),
        T.StructField("rejection_reason", T.StringType()),
    ]
)

# Payload types, keys a producer may not send, envelope keys, and the wording
# of each rejection.
PAYLOAD_TYPES = ("Ex-0", "Ex-1", "Ex-2", "Ex-3")
DELTA_TYPE = "Ex-3"
FORBIDDEN_KEYS = (
    "dbt_log_path",
    "dsn",
    "ex_type",
    "ingest_seq",
    "layer_b_receipt_id",
    "produced_at",
    "provider_payload",
    "provider_response",
    "raw_payload",
    "raw_payload_path",
    "runtime_path",
    "submitted_at",
)
ENVELOPE_KEYS = ("payload_type", "submitted_by")
NOT_AN_OBJECT = "candidate payload must be a JSON object mapping"
FORBIDDEN_PRESENT = "producer payload must not include PostgreSQL ingest metadata fields: "
BAD_TYPE = "payload_type must be one of ['Ex-0', 'Ex-1', 'Ex-2', 'Ex-3']"
BAD_SUBMITTER = "submitted_by is required and must be a non-empty string"
TYPE_DIFFERS = "candidate payload_type does not match candidate_queue payload_type: "
SUBMITTER_DIFFERS = "candidate submitted_by does not match candidate_queue submitted_by: "
FORBIDDEN_ERROR = "ForbiddenIngestMetadataError"
VALIDATION_ERROR = "CandidateValidationError"


def _text_field(parsed: Column, key: str) -> Column:
    """A top-level field when it is a JSON string, else NULL."""
    value = F.try_variant_get(parsed, f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(parsed, f"$.{key}", "string"))


def _parsed_once(queue: DataFrame, *fields: Column) -> DataFrame:
    """Adds fields read from the payload (as ``_json``), evaluated once per row.

    Filters on what follows would otherwise be pushed below the parse and repeat it in
    every branch; a one-element inline keeps the parsed fields as plain columns.
    """
    parsed = queue.withColumn("_json", F.try_parse_json(F.col("payload")))
    return parsed.select(*queue.columns, F.inline(F.array(F.struct(*fields))))


def validate(queue: DataFrame) -> DataFrame:
    """Sets validation_status, rejection_reason and rejection_type from the payload envelope.

    The first failing rule gives the reason: JSON object, forbidden keys, payload type,
    submitter, then agreement of both with the queue row.  The reason is kept whole.
    """
    checked = _parsed_once(
        queue,
        F.json_object_keys("payload").alias("_keys"),
        _text_field(F.col("_json"), "payload_type").alias("_type"),
        _text_field(F.col("_json"), "submitted_by").alias("_by"),
    )
    forbidden = F.array_sort(F.array_distinct(F.filter("_keys", lambda k: k.isin(*FORBIDDEN_KEYS))))
    listed = F.concat(F.lit("['"), F.array_join(forbidden, "', '"), F.lit("']"))
    has_forbidden = F.coalesce(F.size(forbidden) > 0, F.lit(False))
    reason = (
        F.when(F.col("_keys").isNull(), F.lit(NOT_AN_OBJECT))
        .when(has_forbidden, F.concat(F.lit(FORBIDDEN_PRESENT), listed))
        .when(~F.coalesce(F.col("_type").isin(*PAYLOAD_TYPES), F.lit(False)), F.lit(BAD_TYPE))
        # (?U): white space of any script, not spaces alone.
        .when(~F.coalesce(F.col("_by").rlike(r"(?U)\S"), F.lit(False)), F.lit(BAD_SUBMITTER))
        .when(F.col("_type") != F.col("payload_type"), F.concat(F.lit(TYPE_DIFFERS), "_type", F.lit(" != "), "payload_type"))
        .when(F.col("_by") != F.col("submitted_by"), F.concat(F.lit(SUBMITTER_DIFFERS), "_by", F.lit(" != "), "submitted_by"))
    )
    return checked.withColumn("rejection_reason", reason).select(
        *[c for c in queue.columns if c not in ("validation_status", "rejection_reason")],
        F.when(F.col("rejection_reason").isNull(), "accepted").otherwise("rejected").alias("validation_status"),
        "rejection_reason",
        F.when(F.col("rejection_reason").startswith(FORBIDDEN_PRESENT), FORBIDDEN_ERROR)
        .when(F.col("rejection_reason").isNotNull(), VALIDATION_ERROR)
        .alias("rejection_type"),
    )


def pending(queue: DataFrame, limit: int | None = None) -> DataFrame:
    """Pending rows, optionally the first ``limit`` by ingest sequence."""
    rows = queue.where(F.col("validation_status") == "pending")
    if limit is None:
        return rows
    if limit < 1:
        raise ValueError("limit must be a positive integer")
    return rows.orderBy(F.col("ingest_seq").asc_nulls_last()).limit(limit)


def validation_counts(validated: DataFrame) -> DataFrame:
    """Rows per status, reason and reason type."""
    return validated.groupBy("validation_status", "rejection_reason", "rejection_type").agg(
        F.count("*").alias("row_count")
    )


def with_idempotency_key(queue: DataFrame) -> DataFrame:
    """Adds ``delta_id``: a delta row's non-empty JSON string id, else NULL."""
    found = F.nullif(_text_field(F.col("_json"), "delta_id"), F.lit(""))
    return _parsed_once(queue, F.when(F.col("payload_type") == DELTA_TYPE, found).alias("delta_id"))


IDEMPOTENCY_KEY = ("submitted_by", "payload_type", "delta_id")


def first_submissions(keyed: DataFrame) -> DataFrame:
    """Rows without a delta id, and the first row by ingest sequence of each delta."""
    firsts = latest_per_key(
        keyed.where(F.col("delta_id").isNotNull()),
        list(IDEMPOTENCY_KEY),
        [F.col("ingest_seq").asc_nulls_last(), F.col("id").asc_nulls_last()],
    )
    return keyed.where(F.col("delta_id").isNull()).unionByName(firsts)


def submission_receipts(queue: DataFrame) -> DataFrame:
    """What each submission is answered with: its stored row, and whether that is a replay."""
    keyed = with_idempotency_key(queue)
    firsts = (
        keyed.where(F.col("delta_id").isNotNull())
        .groupBy(*[F.col(k).alias(f"_{k}") for k in IDEMPOTENCY_KEY])
        .agg(F.min(F.struct("ingest_seq", "id")).alias("_first"))
    )
    joined = keyed.join(firsts, [keyed[k] == firsts[f"_{k}"] for k in IDEMPOTENCY_KEY], "left")
    return joined.select(
        F.col("id").alias("submission_id"),
        F.coalesce("_first.id", "id").alias("candidate_id"),
        F.coalesce("_first.ingest_seq", "ingest_seq").alias("ingest_seq"),
        F.coalesce(F.col("_first.id") != F.col("id"), F.lit(False)).alias("replayed"),
    )
