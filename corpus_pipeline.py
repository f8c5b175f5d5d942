"""A corpus from raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import mixing, neardup, packing, quality, toxicity
from lakemart.llm.common import table
from lakemart.llm.queries import LEAST_QUALITY, LEAST_TOXIC, tokenizer_path
from lakemart.session import materialize, recorded, remove, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders of tables that stages wrote for themselves.
_left: list[str] = []


def tidy(stage: Stage) -> Stage:
    """``stage``, which first deletes the tables earlier stages wrote for themselves.

    A stage is given rows read from its predecessor's written result, so those tables are read no more; one that
    ``docs`` does read from stays.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {file.rsplit("/", 2)[1] for file in docs.inputFiles()} if _left else set()
        for folder in [f for f in _left if f.rsplit("/", 1)[1] not in read]:
            _left.remove(folder)
            remove(spark, folder)
        with recorded() as folders:
            out = stage(spark, docs, sf_dir)
        _left.extend(folders)
        return out

    return run_stage


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, written once, so that every decision is taken for a row and not for an id."""
    return materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))


def by_row(rows: DataFrame) -> DataFrame:
    """Rows of ``keyed`` under their number in place of doc_id, which may be NULL or stand more than once."""
    return rows.select(F.col("row").alias("doc_id"), "text")


def keep_by_score(rows: DataFrame, scored: DataFrame, keep) -> DataFrame:
    """Rows of ``keyed`` whose own score passes."""
    return rows.join(scored.where(keep).select(F.col("doc_id").alias("row")), "row", "left_semi").select(*COLUMNS)


@tidy
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    raw = table(spark, sf_dir, "documents")
    model = quality.fit(raw, table(spark, sf_dir, "labels"))
    rows = keyed(docs)
    return keep_by_score(rows, quality.score(by_row(rows), model), F.col("score") >= LEAST_QUALITY)


@tidy
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity scorer does not reject."""
    raw = table(spark, sf_dir, "documents")
    model = toxicity.fit(raw, table(spark, sf_dir, "labels"))
    rows = keyed(docs)
    return keep_by_score(rows, toxicity.score(by_row(rows), model), F.col("score") < LEAST_TOXIC)


@tidy
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest id, at a similarity of 0.8 on five-word shingles."""
    rows = keyed(docs)
    groups = neardup.near_duplicates(by_row(rows), neardup.NearDup(percent=80))
    named = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    kept = named.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


@tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; one taken in part counts as taken, those without words are left out."""
    rows = keyed(docs)
    taken = mixing.mix(rows, carry="row").where("size > 0 and taken > 0")
    taken = taken.select("row", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    repeated = rows.join(taken, "row")
    return repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


@tidy
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents in sequences of 2048."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned scores and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read from there, its predecessor's then deleted."""
    folder = f"{shared_folder(spark)}/corpus-pipeline/{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return docs
