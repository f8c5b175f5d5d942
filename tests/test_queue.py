from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.plans import cycle as C
from lakemart.plans import queue as K
from lakemart.streaming import queue_stream as Q


def candidate(i, payload, kind="Ex-3", by="u", at=None):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return (i, kind, text, by, at or datetime(2026, 4, 15, i % 24), i, "pending", None)


def delta(i, key, by="u", kind="Ex-3"):
    return candidate(i, {"payload_type": kind, "submitted_by": by, "delta_id": key}, kind, by)


def test_first_failing_rule_gives_the_reason(spark, rows):
    good = {"payload_type": "Ex-3", "submitted_by": "u"}
    cases = [
        candidate(1, good),
        candidate(2, "[1]"),
        candidate(3, "not json"),
        candidate(4, {**good, "payload_type": "Ex-9", "ingest_seq": 1, "dsn": None}),
        candidate(5, {**good, "payload_type": 3}),
        candidate(6, {**good, "submitted_by": "  "}),
        candidate(7, {**good, "payload_type": "Ex-1"}),
        candidate(8, {**good, "submitted_by": "v" * 2000}),
    ]
    out = K.validate(spark.createDataFrame(cases, K.QUEUE_SCHEMA)).orderBy("id").collect()
    reasons = [r["rejection_reason"] for r in out]
    assert reasons[:7] == [
        None, K.NOT_AN_OBJECT, K.NOT_AN_OBJECT, K.FORBIDDEN_PRESENT + "['dsn', 'ingest_seq']", K.BAD_TYPE, K.BAD_SUBMITTER,
        K.TYPE_DIFFERS + "Ex-1 != Ex-3",
    ]
    assert reasons[7] == K.SUBMITTER_DIFFERS + "v" * 2000 + " != u"
    assert [r["rejection_type"] for r in out][:4] == [None, K.VALIDATION_ERROR, K.VALIDATION_ERROR, K.FORBIDDEN_ERROR]


def test_receipts_replay_the_first_row(spark, rows):
    cases = [delta(1, "d1"), delta(2, "d1"), delta(3, "d1", by="v"), delta(4, ""), delta(5, ""), delta(6, 7), delta(7, "d1", kind="Ex-1")]
    got = K.submission_receipts(spark.createDataFrame(cases, K.QUEUE_SCHEMA))
    assert rows(got, "submission_id", "candidate_id", "replayed") == [
        (1, 1, False), (2, 1, True), (3, 3, False), (4, 4, False), (5, 5, False), (6, 6, False), (7, 7, False)
    ]


def test_pending_takes_the_lowest_sequences(spark, rows):
    df = spark.createDataFrame([delta(i, str(i)) for i in (3, 1, 2)], K.QUEUE_SCHEMA)
    assert rows(K.pending(df, 2), "id") == [(1,), (2,)]


def test_dedup_stream_survives_a_restart(spark, rows):
    root = Q.new_run_folder(spark, "restart")
    folder = f"{root}/in"
    def run():
        Q.dedup_stream(Q.queue_source(spark, folder), root).awaitTermination()
    Q.append_candidates(spark.createDataFrame([delta(1, "a"), delta(2, "a"), delta(3, "b")], K.QUEUE_SCHEMA), folder)
    run()
    Q.append_candidates(spark.createDataFrame([delta(4, "b"), delta(5, "c"), delta(6, "")], K.QUEUE_SCHEMA), folder)
    run()
    run()
    schema = K.with_idempotency_key(spark.createDataFrame([], K.QUEUE_SCHEMA)).schema
    assert rows(Q.read_part(spark, root, "first", schema), "id") == [(1,), (3,), (5,), (6,)]


def test_validate_stream_writes_both_outputs_and_counts(spark, rows):
    root = Q.new_run_folder(spark, "validate")
    Q.append_candidates(spark.createDataFrame([delta(1, "a"), candidate(2, "[]")], K.QUEUE_SCHEMA), f"{root}/in")
    Q.validate_stream(Q.queue_source(spark, f"{root}/in"), root).awaitTermination()
    schema = K.validate(spark.createDataFrame([], K.QUEUE_SCHEMA)).schema
    assert rows(Q.read_part(spark, root, "accepted", schema), "id") == [(1,)]
    assert rows(Q.read_part(spark, root, "rejected", schema), "id") == [(2,)]
    assert spark.read.parquet(f"{root}/counts").agg(F.sum("row_count")).first()[0] == 2


def test_submitter_of_white_space_alone_is_rejected(spark):
    rows = [(i, "Ex-1", by, json.dumps({"payload_type": "Ex-1", "submitted_by": by})) for i, by in enumerate(["\t", " \n", " a "])]
    queue = spark.createDataFrame(rows, "id long, payload_type string, submitted_by string, payload string")
    out = K.validate(queue.selectExpr("*", "cast(null as string) validation_status", "cast(null as string) rejection_reason"))
    assert [r["rejection_reason"] for r in out.orderBy("id").collect()] == [K.BAD_SUBMITTER, K.BAD_SUBMITTER, None]


def land_in_batches(spark, folder, *batches):
    for batch in batches:
        Q.append_candidates(spark.createDataFrame(batch, K.QUEUE_SCHEMA).coalesce(1), folder)


def test_receipts_are_the_same_over_three_batches_and_a_restart(spark, rows):
    hot = [delta(1000 + i, "hot") for i in range(3000)]
    batches = [
        [delta(3, "a"), delta(2, "a"), delta(5, ""), *hot[:1500]],
        [delta(1, "a"), delta(7, "b"), delta(8, "b", by="v"), *hot[1500:]],
        [delta(9, "b"), delta(10, 4), delta(11, "a"), delta(12, "c", kind="Ex-1")],
    ]
    schema = "submission_id long, candidate_id long, ingest_seq long, replayed boolean"
    answers, firsts = [], []
    for restart in (False, True):
        root = Q.new_run_folder(spark, "receipts")
        if not restart:
            land_in_batches(spark, f"{root}/in", *batches)
        for batch in batches if restart else [None]:
            if restart:
                land_in_batches(spark, f"{root}/in", batch)
            Q.dedup_stream(Q.queue_source(spark, f"{root}/in", files_per_batch=1), root).awaitTermination()
        answers.append(rows(Q.read_part(spark, root, "receipts", T.StructType.fromDDL(schema))))
        keyed = T.StructType([*K.QUEUE_SCHEMA.fields, T.StructField("delta_id", T.StringType())])
        firsts.append(rows(Q.read_part(spark, root, "first", keyed)))
    assert answers[0] == answers[1] and firsts[0] == firsts[1]
    by_id = {r[0]: r for r in answers[0]}
    # The first batch stored row 2; a lower id that comes later is a replay.
    assert by_id[2][:4] == (2, 2, 2, False) and by_id[3][1:4] == by_id[1][1:4] == by_id[11][1:4] == (2, 2, True)
    assert by_id[8][3] is False and by_id[9][1] == 7 and by_id[5][3] is by_id[10][3] is by_id[12][3] is False
    assert sum(r[1] == 1000 for r in answers[0]) == 3000
    kept = {r[0]: r for r in firsts[0]}
    assert sorted(kept) == [2, 5, 7, 8, 10, 12, 1000]
    assert json.loads(kept[2][2])["delta_id"] == "a" and kept[2][4] == datetime(2026, 4, 15, 2)


def test_first_submissions_need_no_python_per_key_and_keep_large_ids(spark, rows):
    big = 2**53 + 1
    no_seq = (None,) + delta(0, "a")[1:5] + (None,) + delta(0, "a")[6:]
    batches = [[no_seq, delta(big, "a"), delta(big, "a"), delta(5, "b", by=None)], [delta(1, "a"), delta(6, "b", by=None), delta(7, None)]]
    root = Q.new_run_folder(spark, "large")
    land_in_batches(spark, f"{root}/in", *batches)
    stream = Q.dedup_stream(Q.queue_source(spark, f"{root}/in", files_per_batch=1), root)
    stream.awaitTermination()
    assert [o["operatorName"] for o in stream.lastProgress["stateOperators"]] == ["stateStoreSave"]
    schema = "submission_id long, candidate_id long, ingest_seq long, replayed boolean"
    assert rows(Q.read_part(spark, root, "receipts", T.StructType.fromDDL(schema)).drop("batch_id")) == sorted(
        [(None, big, big, True), (big, big, big, False), (big, big, big, False), (1, big, big, True), (5, 5, 5, False), (6, 6, 6, False), (7, 7, 7, False)], key=repr
    )
    # Rows that repeat the id of the first one are firsts as well, and keep their payload.
    keyed = T.StructType([*K.QUEUE_SCHEMA.fields, T.StructField("delta_id", T.StringType())])
    firsts = Q.read_part(spark, root, "first", keyed).select("id", F.get_json_object("payload", "$.delta_id").alias("delta"))
    assert rows(firsts) == sorted([(5, "b"), (big, "a"), (big, "a"), (7, None)], key=repr)


def test_late_rows_correct_their_window_and_are_listed(spark, rows):
    at = lambda day, hour: datetime(2026, 4, day, hour)
    batches = [
        [(1, at(10, 1)), (2, at(12, 3))],
        [(3, at(10, 5)), (4, at(11, 23)), (5, at(12, 4)), (6, None)],  # the 10th and the 11th are closed: the clock stands at the 12th, 02:00
        [(7, at(10, 6)), (8, at(13, 0))],
    ]
    root = Q.new_run_folder(spark, "late")
    for batch in batches:
        land_in_batches(spark, f"{root}/in", [candidate(i, {"payload_type": "Ex-1", "submitted_by": "u"}, "Ex-1", "u", t)[:4] + (t, i, "pending", None) for i, t in batch])
    timed = K.validate(Q.queue_source(spark, f"{root}/in", files_per_batch=1)).withColumn("submitted_at", F.col("submitted_at").cast("timestamp"))
    Q.rates_stream(timed, root).awaitTermination()
    found = Q.latest_rates(spark, root).select(F.date_format("window_start", "dd").alias("day"), "accepted", "total", "late_rows")
    assert rows(found) == [("10", 3, 3, 2), ("11", 1, 1, 1), ("12", 2, 2, 0), ("13", 1, 1, 0)]
    late = Q.late_rows(spark, root, timed.schema).orderBy("id").collect()
    assert [(r["id"], r["batch_id"]) for r in late] == [(3, 1), (4, 1), (6, 1), (7, 2)]
    assert [r["watermark"] for r in late] == [at(12, 2)] * 3 + [at(12, 3)]


def cycle_tables(frame, *candidates):
    """Candidates against two entities: E1 with aliases a1, a2 and E2, which is also the name of a security; a3 has no entity."""
    entities = frame("canonical_entity_id string", (" E1 ",), ("E2",), ("E3",))
    aliases = frame("alias string, canonical_entity_id string, created_at int", (" a2 ", "E1", 1), ("a1", " E1", 1), ("a0", "E2", 1), ("a3", "gone", 1))
    names = ("a1", "a2 ", "a0", "E2", "a3")
    securities = frame("security_id string, market string, industry string", *[(n, f"m{n.strip()}", " ") for n in names])
    bars = frame(
        "security_id string, trade_date date, freq string, close double, pre_close double, pct_chg double, vol double, amount double",
        *[(n, datetime(2026, 4, 15).date(), " Daily", 2.0, 1.0, None, None, None) for n in names],
    )
    given = frame("candidate_id string", *[(c,) for c in candidates])
    return C.current_cycle_inputs("CYCLE_20260415", "sel", given, entities, aliases, securities, bars, {"security_master": 1})


def test_candidates_resolve_by_trimmed_names_and_their_own_id_first(frame, rows):
    inputs, missing = cycle_tables(frame, "a2", " E1", "E2", "a0", "E3", "a3", "x")
    # E2 is an entity id and a traded name of its own; E1 is read by its smallest alias.
    assert rows(inputs, "candidate_id", "entity_id", "market") == [
        ("E1", "E1", "ma1"), ("E2", "E2", "mE2"), ("a0", "E2", "ma0"), ("a2", "E1", "ma2")
    ]
    assert rows(missing, "candidate_id", "reason") == [
        ("E3", "canonical_entity_alias_missing"), ("a3", "canonical_entity_missing"), ("x", "canonical_entity_missing")
    ]


def test_all_inputs_or_an_error(frame, rows):
    assert rows(C.all_or_error(*cycle_tables(frame, "a2", "E1")), "candidate_id") == [("E1",), ("a2",)]
    for candidates in (("a2", "E1", "E3", "x"), ("x", "E3")):  # the second has no row at all
        strict = C.all_or_error(*cycle_tables(frame, *candidates))
        for use in (strict.collect, strict.count, lambda s=strict: s.write.format("noop").mode("overwrite").save()):
            with pytest.raises(Exception, match=r"2 candidates cannot be resolved, first E3"):
                use()


def test_a_history_in_stretches_steps_as_a_whole_one(frame, rows):
    names = ["pending", "phase0", "phase1", "failed", None]
    history = frame("c string, s string, o int", *[("ab"[i % 7 == 0], names[(i * i) % 5], None if i == 90 else i * 3) for i in range(91)], (None, "pending", 1), (None, "phase1", 2))
    for width in (1, 10, 1000):
        cut = C.illegal_transitions(history, "c", "s", "o", F.floor(F.col("o") / width))
        assert rows(cut) == rows(C.illegal_transitions(history, "c", "s", "o"))
