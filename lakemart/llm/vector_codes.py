"""Vector code compression: product codes whose codebooks are trained by active-entry Lloyd.

Vectors become whole numbers and are cut into equal parts; every part position has its own codebook.  A round
assigns all parts and moves each entry to the floored mean of its parts.  A part keeps its entry and the exact
distance to it.  If that entry stayed where it was in the last round, no other entry that stayed can have come
nearer, so only the moved ones are compared with the stored distance; a part whose entry moved compares all.
An equal distance goes to the lower index in both cases, so the codes equal those of full scans.

Each round reads the table written by the one before, in one pass without a shuffle: a task writes its rows and, for
the parts that changed, what is to be added to the entries' sums.  Codebooks (``entries`` times the width) are all
that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import materialize, remove, written


@dataclass(frozen=True)
class CodeSpec:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


#: Rows compared with all entries at once.
STEP = 8192
#: One row of a vector, or (``sums``) one entry's changes: code is then (part, entry), dist the number of parts.
STATE = "sums boolean, vec_id long, label string, whole array<long>, code array<int>, dist array<long>"


def finite(vector: str) -> Column:
    """Not NULL, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to entries."""
    width = max(points.shape[1], 1)
    largest = max((int(np.abs(a).max()) for a in (points, entries) if a.size), default=0)
    if width * (2 * largest) ** 2 < 1 << 53:
        # Every product and sum below is a whole number that doubles hold exactly.
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p**2).sum(1)[:, None] - 2 * p @ e.T + (e**2).sum(1)[None]).astype(np.int64)
    if width * (2 * largest) ** 2 >= 1 << 63:
        raise OverflowError(f"squared distances of components up to {largest} do not fit 64 bits")
    return reduce(np.add, ((points[:, i, None] - entries[None, :, i]) ** 2 for i in range(points.shape[1])))


def assign(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(codes, distances, comparisons): ``code`` -1 has no entry yet; ``dist`` holds for entries that have not moved."""
    code, dist = code.copy(), dist.copy()
    fixed = (code >= 0) & ~moved[code]
    active = np.flatnonzero(moved)
    compared = 0
    for rows, candidates in ((np.flatnonzero(fixed), active), (np.flatnonzero(~fixed), np.arange(len(entries)))):
        for at in range(0, len(rows) if len(candidates) else 0, STEP):
            some = rows[at : at + STEP]
            table = distances(points[some], entries[candidates])
            compared += table.size
            place = table.argmin(1)  # the first of equals: the lowest index
            nearest, near = candidates[place], table[np.arange(len(some)), place]
            better = ~fixed[some] | (near < dist[some]) | ((near == dist[some]) & (nearest < code[some]))
            code[some[better]], dist[some[better]] = nearest[better], near[better]
    return code, dist, compared


@dataclass
class Codebooks:
    """``entries[part]``: whole numbers, entry by position; ``sums`` and ``counts`` of the parts they hold."""

    entries: list[np.ndarray]
    moved: list[np.ndarray]
    sums: list[np.ndarray]
    counts: list[np.ndarray]

    @staticmethod
    def of(first: np.ndarray, spec: CodeSpec) -> Codebooks:
        entries = np.split(first, spec.parts, axis=1)
        return Codebooks(
            entries,
            [np.ones(len(first), bool) for _ in entries],
            [np.zeros_like(e) for e in entries],
            [np.zeros(len(first), np.int64) for _ in entries],
        )

    def move(self, changes: DataFrame) -> None:
        """Adds up the changes of all tasks and moves the entries; unused ones stay."""
        added = changes.select(
            F.col("code")[0].alias("part"), F.col("code")[1].alias("entry"), F.col("dist")[0].alias("many"), F.posexplode("whole").alias("at", "value")
        )
        total = added.groupBy("part", "entry", "at").agg(F.sum("value").alias("value"), F.sum("many").alias("many"))
        for row in total.collect():
            self.sums[row["part"]][row["entry"], row["at"]] += row["value"]
            if row["at"] == 0:
                self.counts[row["part"]][row["entry"]] += row["many"]
        for part, entries in enumerate(self.entries):
            used = self.counts[part] > 0
            means = entries.copy()
            means[used] = self.sums[part][used] // self.counts[part][used, None]
            self.moved[part] = (means != entries).any(1)
            self.entries[part] = means

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def assigned(state: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """``state`` with new codes and distances, and the changes of the entries' sums."""
    entries, moved = books.entries, books.moved
    parts = len(entries)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros_like(e) for e in entries]
        counts = [np.zeros(len(e), np.int64) for e in entries]
        for batch in batches:
            if batch.empty:
                continue
            points = np.stack(batch["whole"].to_numpy()).astype(np.int64).reshape(len(batch), width)
            codes = np.stack(batch["code"].to_numpy()).astype(np.int64)
            dists = np.stack(batch["dist"].to_numpy()).astype(np.int64)
            for part, mine in enumerate(np.split(points, parts, axis=1)):
                before = codes[:, part].copy()
                codes[:, part], dists[:, part], _ = assign(mine, entries[part], moved[part], before, dists[:, part])
                changed = np.flatnonzero(codes[:, part] != before)
                had = changed[before[changed] >= 0]
                for rows, held, sign in ((changed, codes[changed, part], 1), (had, before[had], -1)):
                    np.add.at(sums[part], held, sign * mine[rows])
                    np.add.at(counts[part], held, sign)
            batch["code"], batch["dist"] = list(codes.astype(np.int32)), list(dists)
            yield batch
        rows = [
            (True, None, None, sums[part][entry], [part, entry], [counts[part][entry]])
            for part in range(parts)
            for entry in np.flatnonzero((sums[part] != 0).any(1) | (counts[part] != 0)).tolist()
        ]
        if rows:
            yield pd.DataFrame(rows, columns=["sums", "vec_id", "label", "whole", "code", "dist"]).astype({"vec_id": "Int64"})

    return state.mapInPandas(task, STATE)


def compress(
    rows: DataFrame, spec: CodeSpec = CodeSpec(), id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, Codebooks | None]:
    """(<id_column>, <label> as text, code array, dist array) of every usable row, and the codebooks.

    Rows whose vector is NULL or holds NULL or non-finite components are left out; zero vectors stay.  A codebook
    starts from the ``entries`` smallest ids, NULL last, rows of one id by their components; fewer rows give
    fewer entries.  Rows that repeat an id are coded each.  A vector of another length than that of the smallest
    id, or all where that is no multiple of ``parts``, has NULL code and dist.  Without rows there are no codebooks.
    Components or distances beyond 64 bits end with an error.  Other columns are ignored.
    """
    spark = rows.sparkSession
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * spec.scale).cast("long"))
    kept = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    kept = kept.where(finite("v")).select("vec_id", "label", whole.alias("whole"))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "whole").select("whole").limit(spec.entries).collect()
    named = [F.col("vec_id").alias(id_column), F.col("label").alias(label), "code", "dist"]
    unset = [F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("array<long>").alias("dist")]
    width = len(first[0]["whole"]) if first else 0
    if not first or width % spec.parts:
        return kept.select("vec_id", "label", *unset).select(*named), None
    seeds = np.array([r["whole"] for r in first if len(r["whole"]) == width], np.int64).reshape(-1, width)
    books = Codebooks.of(seeds, spec)
    state = kept.where(F.size("whole") == width).select(
        F.lit(False).alias("sums"),
        "vec_id",
        "label",
        "whole",
        F.array_repeat(F.lit(-1), spec.parts).alias("code"),
        F.array_repeat(F.lit(0).cast("long"), spec.parts).alias("dist"),
    )
    before = None
    for _ in range(spec.rounds):
        table, folder = written(assigned(state, books, width))
        books.move(table.where("sums"))
        if before is not None:
            remove(spark, before)
        before, state = folder, table.where("not sums")
    # The last codes are read several times by what follows, the vectors no more.
    coded = materialize(assigned(state, books, width).where("not sums").select("vec_id", "label", "code", "dist"))
    if before is not None:
        remove(spark, before)
    others = kept.where(F.size("whole") != width).select("vec_id", "label", *unset)
    return coded.unionByName(others).select(*named), books


def report(spark: SparkSession, coded: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256 from ``compress``."""
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda total, d: total + d)
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = coded.select("vec_id", "label", code.alias("code"), error.alias("error"))
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    digest = books.sha256() if books else hashlib.sha256(b"").hexdigest()
    joined = rows.join(by_label, rows["label"].eqNullSafe(by_label["of"]), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
