"""Document fingerprints by winnowing, in DataFrame functions only.

Words are hashed, every run of ``gram`` words makes a k-gram hash, and of every ``window`` consecutive
k-grams the smallest is chosen, the rightmost one of equal ones.  Texts that share ``window + gram - 1``
words in a row therefore share a chosen hash; the chosen positions are kept.  A text with fewer
than ``gram`` words has one gram of all its words, a text without words none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import materialize

GRAM = 4
WINDOW = 8
#: Rows of a range when documents are put in order.
RANGE_ROWS = 20_000


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """array<long> of the chosen k-grams by place: the 31-bit hash above, 2^31 - 1 minus the place below.

    Of such numbers the smallest is the smallest hash at its rightmost place, so a window's choice is one
    minimum, and minima of windows twice as wide are minima of two.  Places count words from 0.
    """
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")

    def numbered(values: Column) -> Column:
        rolled = F.transform(
            values,
            lambda h, i: F.shiftleft(F.xxhash64(h, *[F.get(values, i + j) for j in range(1, gram)]).bitwiseAND(2**31 - 1), 32)
            + (F.lit(2**31 - 1).cast("long") - i),
        )
        return F.slice(rolled, F.lit(1), F.greatest(F.size(values) - gram + 1, F.least(F.size(values), F.lit(1))))

    def chosen(numbers: Column) -> Column:
        def widened(lowest: Column, wide: int) -> Column:
            if wide == window:
                last = F.greatest(F.size(numbers) - window + 1, F.least(F.size(numbers), F.lit(1)))
                return F.array_distinct(F.slice(lowest, F.lit(1), last))
            step = min(wide, window - wide)
            return bound(
                lowest,
                lambda low: widened(F.transform(low, lambda x, i: F.least(x, F.get(low, i + step))), wide + step),
            )

        return widened(numbers, 1)

    return bound(bound(F.transform(words, lambda w: F.xxhash64(w)), numbered), chosen)


def places_of(chosen: Column) -> Column:
    """array<struct<place, hash>> of chosen k-grams, by place."""
    return F.transform(
        chosen,
        lambda c: F.struct(
            (F.lit(2**31 - 1) - c.bitwiseAND(2**31 - 1)).alias("place"), F.shiftright(c, 32).cast("int").alias("hash")
        ),
    )


def hashes_of(chosen: Column) -> Column:
    return F.sort_array(F.array_distinct(F.transform(chosen, lambda c: F.shiftright(c, 32).cast("int"))))


def likeness(left: Column, right: Column) -> Column:
    """Shared part of two sets of chosen hashes; two empty sets are alike, one empty set is unlike the other."""
    shared = F.size(F.array_intersect(left, right))
    every = F.size(left) + F.size(right) - shared
    return F.when(every > 0, shared / every).otherwise(1.0)


def written(hashes: Column) -> Column:
    """The chosen hashes as text: eight hex digits each, in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def following(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, mark, ...) with next_id, next_mark: the next row by falling doc_id, then mark.

    The last row is followed by the first.  Rows are dealt out by ranges written once, so only the
    ranges' sizes are looked at together.
    """
    spark = keys.sparkSession
    parts = max(1, -(-keys.count() // RANGE_ROWS))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark").asc()]
    ranged = materialize(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    placed = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    sizes = sorted((r["part"], r["count"]) for r in ranged.groupBy("part").count().collect())
    before, starts = 0, []
    for part, size in sizes:
        starts.append((part, before))
        before += size
    offsets = spark.createDataFrame(starts, "part int, before long")
    numbered = materialize(
        placed.join(F.broadcast(offsets), "part").withColumn("number", F.col("at") + F.col("before") - 1).drop("part", "at", "before")
    )
    ahead = numbered.select(
        F.pmod(F.col("number") - 1, F.lit(max(before, 1))).alias("number"),
        F.col("doc_id").alias("next_id"),
        F.col("mark").alias("next_mark"),
    )
    return numbered.join(ahead, "number").drop("number")


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every row's fingerprint, its edited text's, and their likeness, for ``docs`` (doc_id, text, ...).

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  The edited text has its last floor(n_chars / 3) code points
    replaced by the first as many (or all) of the next document by falling doc_id; the last is followed
    by the first.  NULL text is empty.  Rows that repeat a doc_id follow each other by a hash of the
    text; rows alike in both are one place in the order and get equal results.  A NULL doc_id comes last.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    marked = whole.withColumn("hashes", hashes_of(winnow(F.col("text"), gram, window)))
    keys = whole.groupBy("doc_id", "mark").agg(F.max(F.char_length("text")).alias("n_chars"))
    pairs = following(keys).withColumn("need", F.floor(F.col("n_chars") / 3).cast("int"))
    same = F.col("n.doc_id").eqNullSafe(F.col("p.next_id")) & (F.col("n.mark") == F.col("p.next_mark"))
    given = (
        pairs.alias("p")
        .join(marked.alias("n"), same)
        .select(
            F.col("p.doc_id").alias("doc_id"),
            F.col("p.mark").alias("mark"),
            "p.n_chars",
            "p.need",
            F.col("n.text").substr(F.lit(1), F.col("p.need")).alias("head"),
            F.col("n.hashes").alias("next_hashes"),
        )
        .dropDuplicates(["doc_id", "mark"])
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.mark") == F.col("g.mark"))
    both = (
        marked.alias("d")
        .join(given.alias("g"), same)
        .select(
            "d.doc_id",
            F.col("g.n_chars").cast("long").alias("n_chars"),
            "d.hashes",
            "g.next_hashes",
            F.concat(F.col("d.text").substr(F.lit(1), F.col("g.n_chars") - F.col("g.need")), "g.head").alias("edited"),
        )
    )
    return both.withColumn("edited_hashes", hashes_of(winnow(F.col("edited"), gram, window))).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        written(F.col("hashes")).alias("fingerprint"),
        written(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
