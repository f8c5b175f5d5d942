"""Daily cycles: freezing candidates, status history, current-cycle inputs, entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.operators.ordering import latest_per_key, newest_first
from lakemart.plans.queue import DELTA_TYPE, ENVELOPE_KEYS, PAYLOAD_TYPES

# Cycle statuses in order; any status before the last may fail.
STATUS_ORDER = ("pending", "phase0", "phase1", "phase2", "phase3", "published")
FAILED = "failed"


class CycleAlreadyFrozen(RuntimeError):
    """The cycle is no longer pending, so its selection may not be taken again."""


def allowed_steps() -> list[str]:
    steps = [f"{a}>{b}" for a, b in zip(STATUS_ORDER, STATUS_ORDER[1:])]
    return steps + [f"{a}>{FAILED}" for a in STATUS_ORDER[:-1]]


def illegal_transitions(history: DataFrame, cycle: str, status: str, order: str, stretch: Column | None = None) -> DataFrame:
    """History rows whose step from the cycle's previous status is not allowed.

    The first status of a cycle must be pending.  ``stretch``, which must not fall where ``order`` rises, cuts a
    long history into stretches that are stepped through in separate tasks.
    """
    stepped = with_previous_status(history, cycle, status, order, stretch)
    step = F.concat_ws(">", "previous_status", status)
    fine = F.when(F.col("previous_status").isNull(), F.col(status) == STATUS_ORDER[0]).otherwise(
        step.isin(allowed_steps())
    )
    return stepped.where(~F.coalesce(fine, F.lit(False)))


def with_previous_status(history: DataFrame, cycle: str, status: str, order: str, stretch: Column | None = None) -> DataFrame:
    """Adds ``previous_status``, by ``order``, NULL last.

    With ``stretch`` a row looks back inside its stretch; the first row of each takes the last status of the stretch
    before, which a second window finds over one row per cycle and stretch.
    """
    by = F.col(order).asc_nulls_last()
    if stretch is None:
        return history.withColumn("previous_status", F.lag(status).over(Window.partitionBy(cycle).orderBy(by)))
    cut = history.withColumn("_stretch", stretch)
    inside = Window.partitionBy(cycle, "_stretch").orderBy(by)
    near = cut.withColumns({"_before": F.lag(status).over(inside), "_first": F.row_number().over(inside) == 1})
    newest = F.max(F.struct(F.col(order).isNull().alias("n"), F.col(order).alias("o"), F.col(status).alias("s")))
    lasts = cut.groupBy(F.col(cycle).alias("_c"), F.col("_stretch").alias("_t")).agg(newest["s"].alias("_last"))
    along = Window.partitionBy("_c").orderBy(F.col("_t").asc_nulls_last())
    carried = lasts.select("_c", "_t", F.lag("_last").over(along).alias("_carried"))
    joined = near.join(carried, near[cycle].eqNullSafe(carried["_c"]) & near["_stretch"].eqNullSafe(carried["_t"]), "left")
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    return joined.withColumn("previous_status", previous).select(*history.columns, "previous_status")


def recent_cycles(cycles: DataFrame, limit: int = 50, status: str | None = None) -> DataFrame:
    if limit < 1:
        raise ValueError(f"limit must be at least 1: {limit!r}")
    if status is not None:
        cycles = cycles.where(F.col("status") == status)
    return cycles.orderBy(*newest_first("cycle_date", "cycle_id")).limit(limit)


def eligible_candidates(
    queue: DataFrame,
    selections: DataFrame,
    submitted_by: str | None = None,
    payload_type: str | None = None,
) -> DataFrame:
    """Accepted candidates no cycle has selected yet.

    ``queue`` and ``selections`` must be one committed version of each, so that rows
    arriving meanwhile wait for the next cycle.
    """
    accepted = queue.where(F.col("validation_status") == "accepted")
    if submitted_by is not None:
        if not submitted_by.strip():
            raise ValueError("submitted_by filter must be a non-empty string")
        accepted = accepted.where(F.col("submitted_by") == submitted_by)
    if payload_type is not None:
        if payload_type not in PAYLOAD_TYPES:
            raise ValueError(f"payload_type filter must be one of {list(PAYLOAD_TYPES)}")
        accepted = accepted.where(F.col("payload_type") == payload_type)
    taken = selections.select(F.col("candidate_id").alias("_taken"))
    return accepted.join(taken, accepted["id"] == taken["_taken"], "left_anti")


def freeze_cutoffs(selected: DataFrame) -> DataFrame:
    """One row: newest submission, highest sequence and size of a selection."""
    return selected.agg(
        F.max("submitted_at").alias("cutoff_submitted_at"),
        F.max("ingest_seq").alias("cutoff_ingest_seq"),
        F.count("*").alias("candidate_count"),
    )


def selected_rows(selected: DataFrame, cycle_id: str) -> DataFrame:
    return selected.select(F.lit(cycle_id).alias("cycle_id"), F.col("id").alias("candidate_id"))


def cycle_candidates(queue: DataFrame, selections: DataFrame, cycle_id: str) -> DataFrame:
    """Queue rows selected by a cycle, by ingest sequence."""
    chosen = selections.where(F.col("cycle_id") == cycle_id).select(F.col("candidate_id").alias("_c"))
    return queue.join(chosen, queue["id"] == chosen["_c"], "inner").drop("_c").orderBy("ingest_seq")


def without_envelope(payload: str):
    """The payload object without its queue envelope keys, as JSON text."""
    fields = F.from_json(payload, "map<string,variant>")
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*ENVELOPE_KEYS)))


def cycle_deltas(queue: DataFrame, selections: DataFrame, cycle_id: str) -> DataFrame:
    """Accepted delta payloads of a cycle, envelope keys removed."""
    rows = queue.where((F.col("payload_type") == DELTA_TYPE) & (F.col("validation_status") == "accepted"))
    chosen = cycle_candidates(rows, selections, cycle_id)
    return chosen.select("id", "ingest_seq", without_envelope("payload").alias("delta"))


def open_trade_date(calendar: DataFrame, day: str = "cal_date", flag: str = "is_open") -> DataFrame:
    """One row: the latest open trading day and its cycle id (NULL when none is open)."""
    return (
        calendar.where(S.is_open_day(flag))
        .agg(F.max(day).alias("trade_date"))
        .withColumn("cycle_id", S.cycle_id_of("trade_date"))
    )


def missing_symbols(
    symbols: DataFrame, calendar: DataFrame, daily: DataFrame, basics: DataFrame, code: str = "ts_code"
) -> DataFrame:
    """Requested symbols without a bar on the current trading day or without static facts."""
    today = open_trade_date(calendar).select("trade_date").scalar()

    def codes(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.upper(F.trim(code)).alias(name)).distinct()

    bars = codes(daily.where(F.col("trade_date") == today), "_bar")
    facts = codes(basics, "_fact")
    wanted = codes(symbols, "symbol")
    marked = wanted.join(bars, wanted["symbol"] == bars["_bar"], "left").join(
        facts, F.col("symbol") == facts["_fact"], "left"
    )
    return marked.where(F.col("_bar").isNull() | F.col("_fact").isNull()).select(
        "symbol", F.col("_bar").isNotNull().alias("has_bar"), F.col("_fact").isNotNull().alias("has_basic")
    )


def readiness(symbols: DataFrame, calendar: DataFrame, daily: DataFrame, basics: DataFrame) -> DataFrame:
    """One row: cycle, trading day, number of missing symbols, ready flag and reason."""
    count = missing_symbols(symbols, calendar, daily, basics).agg(F.count("*")).scalar()
    counted = open_trade_date(calendar).withColumn("missing_symbols", count)
    reason = F.when(F.col("trade_date").isNull(), "no_open_trade_date").when(
        F.col("missing_symbols") > 0, "missing_symbol_data"
    )
    return counted.withColumn("reason", reason).withColumn("ready", F.col("reason").isNull())


# --------------------------------------------------------------- entities


def alias_entities(aliases: DataFrame) -> DataFrame:
    """alias -> entity id, both trimmed; of several rows for one alias the newest wins."""
    trimmed = aliases.withColumns({c: S.clean_text(c) for c in ("alias", "canonical_entity_id")})
    filled = trimmed.dropna(subset=["alias", "canonical_entity_id"])
    newest = latest_per_key(filled, ["alias"], newest_first("created_at", "canonical_entity_id"))
    return newest.select("alias", "canonical_entity_id")


def existing_entities(candidates: DataFrame, entities: DataFrame, column: str) -> DataFrame:
    known = entities.select(F.col("canonical_entity_id").alias("_known"))
    return candidates.join(known, candidates[column] == known["_known"], "left_semi")


def resolve_candidates(
    candidates: DataFrame, entities: DataFrame, aliases: DataFrame, available: DataFrame
) -> DataFrame:
    """Each candidate's entity and the alias its rows are read by.

    A candidate is an entity id or an alias of a known entity; all ids and aliases are compared trimmed.
    Its own id is preferred, entity id or not, when ``available`` (aliases that have both a security and a
    price row) contains it, else the smallest available alias of the entity.  That alias is found once per
    entity by aggregation, so an entity with very many aliases costs one row, not one
    per candidate.  ``reason`` says why a candidate could not be resolved.
    """
    pairs = aliases.select(S.clean_text("alias").alias("alias"), S.clean_text("canonical_entity_id").alias("canonical_entity_id")).distinct()
    usable = available.select(S.clean_text("alias").alias("_usable")).distinct()
    best = (
        pairs.join(usable, pairs["alias"] == usable["_usable"], "left")
        .groupBy(F.col("canonical_entity_id").alias("_best_entity"))
        .agg(F.min("_usable").alias("_best_alias"))
    )
    owner = alias_entities(aliases).select(F.col("alias").alias("_owned"), F.col("canonical_entity_id").alias("_owner"))
    known = entities.select(S.clean_text("canonical_entity_id").alias("_known")).distinct()
    known_owner = known.withColumnRenamed("_known", "_known_owner")

    rows = candidates.select(F.trim(F.col("candidate_id").cast("string")).alias("candidate_id")).distinct()
    rows = rows.join(known, rows["candidate_id"] == known["_known"], "left")
    rows = rows.join(owner, rows["candidate_id"] == owner["_owned"], "left")
    rows = rows.join(known_owner, rows["_owner"] == known_owner["_known_owner"], "left")
    rows = rows.withColumn("entity_id", F.coalesce("_known", "_known_owner"))
    rows = rows.join(best, rows["entity_id"] == best["_best_entity"], "left")
    own = usable.withColumnRenamed("_usable", "_own")
    rows = rows.join(own, rows["candidate_id"] == own["_own"], "left")
    itself = F.col("_own")
    return rows.select(
        "candidate_id",
        "entity_id",
        F.when(F.col("entity_id").isNotNull(), F.coalesce(itself, F.col("_best_alias"))).alias("alias"),
        F.when(F.col("entity_id").isNull(), F.lit("canonical_entity_missing"))
        .when(itself.isNull() & F.col("_known").isNotNull() & F.col("_best_entity").isNull(), F.lit("canonical_entity_alias_missing"))
        .when(F.coalesce(itself, F.col("_best_alias")).isNull(), F.lit("canonical_candidate_rows_missing"))
        .alias("reason"),
    )


def current_cycle_inputs(
    cycle_id: str,
    selection_ref: str,
    candidates: DataFrame,
    entities: DataFrame,
    aliases: DataFrame,
    securities: DataFrame,
    bars: DataFrame,
    snapshot_ids: dict[str, int],
    alias_column: str = "security_id",
    pct_unit: float = 100.0,
) -> tuple[DataFrame, DataFrame]:
    """(input rows, unresolved candidates) of one frozen cycle.

    ``all_or_error`` gives the rows of a complete cycle or an error.
    """
    if not selection_ref.strip():
        raise ValueError("selection_ref must be a non-empty string")
    trade_date = S.cycle_date_of(F.lit(cycle_id))
    daily = bars.where((F.col("trade_date") == trade_date) & (F.lower(F.trim("freq")) == "daily")).select(
        F.trim(alias_column).alias("_price_alias"), "trade_date", "close", "pre_close", "pct_chg", "vol", "amount"
    )
    facts = securities.select(F.trim(alias_column).alias("_fact_alias"), "market", "industry")
    both = daily.join(facts, daily["_price_alias"] == facts["_fact_alias"], "inner")
    resolved = resolve_candidates(candidates, entities, aliases, both.select(F.col("_price_alias").alias("alias")))
    found = resolved.where(F.col("reason").isNull())
    rows = found.join(both, found["alias"] == both["_price_alias"], "inner")
    close, pre_close = F.col("close").cast("double"), F.col("pre_close").cast("double")
    datasets = list(snapshot_ids)
    refs = [F.lit(f"canonical:{d}@{i}") for d, i in snapshot_ids.items()]
    inputs = rows.select(
        "candidate_id",
        "entity_id",
        "trade_date",
        close.alias("close"),
        pre_close.alias("pre_close"),
        S.one_day_return(F.col("pct_chg"), close, pre_close, pct_unit).alias("return_1d"),
        F.col("vol").cast("double").alias("volume"),
        F.col("amount").cast("double").alias("amount"),
        S.clean_text("market").alias("market"),
        S.clean_text("industry").alias("industry"),
        F.array(*[F.lit(d) for d in datasets]).alias("canonical_dataset_refs"),
        F.create_map(*[x for d, i in snapshot_ids.items() for x in (F.lit(d), F.lit(i))]).alias("canonical_snapshot_ids"),
        F.array(
            F.lit(f"cycle:{cycle_id}"),
            F.lit(f"selection:{selection_ref.strip()}"),
            F.concat(F.lit("candidate:"), "candidate_id"),
            *refs,
        ).alias("lineage_refs"),
    )
    return inputs, resolved.where(F.col("reason").isNotNull())


def all_or_error(inputs: DataFrame, missing: DataFrame) -> DataFrame:
    """``inputs`` if ``missing`` is empty; otherwise every use of the result ends with an error that counts and names them.

    The check is part of the plan, as a condition on the rows, so that no use of the result can leave it out: rows pass
    a condition over the number of missing candidates, a subquery that runs once before them, and one more row,
    which exists only where something is missing, meets the same error if no input row is there to meet it.
    """
    lost = missing.agg(F.count("*").alias("n"), F.min(F.struct("candidate_id", "reason")).alias("first"))
    message = F.concat(
        F.lit("current-cycle inputs are incomplete: "), F.col("n").cast("string"), F.lit(" candidates cannot be resolved, first "),
        F.col("first.candidate_id"), F.lit(" ("), F.col("first.reason"), F.lit(")"),
    )
    text = lost.select(F.when(F.col("n") > 0, message).alias("text"))

    def complete(told, otherwise: bool):
        return F.when(told.isNotNull(), F.raise_error(told).cast("boolean")).otherwise(F.lit(otherwise))

    alarm = text.where(complete(F.col("text"), False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in inputs.schema])
    return inputs.where(complete(text.scalar(), True)).unionByName(alarm)
