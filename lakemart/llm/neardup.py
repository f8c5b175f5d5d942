"""Near-duplicate groups by MinHash bands, sequential Bayesian pruning and exact verification.

1. Every text becomes its set of hashed word shingles, a signature of ``hashes`` minima and a
   128-bit digest of the whole set.  Equal sets collapse to one class before anything is paired.
2. Signatures are cut into bands; classes that share a band meet in a bucket.  Each class is
   first compared with the smallest class of its buckets only, which is linear in the rows and
   joins tight groups whatever their size.
3. Buckets that still hold several components are compared completely, in blocks of bounded size,
   leaving out pairs already joined and pairs that an earlier band brings together.
4. Every comparison reads signatures batch by batch and stops when the posterior probability that
   the similarity reaches the threshold falls below ``miss``; survivors are verified on full sets.
   Blocks meet with signatures alone first, so only classes of surviving pairs travel with their sets.
5. Links go through alternating large-star / small-star rounds to connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import WordHashes, fold, materialize, text_or_empty, words_of


@dataclass(frozen=True)
class NearDup:
    """``percent``: least 100 * intersection / union of a link.

    ``bands`` * ``rows`` hashes make a signature; with 20 bands of 4 rows a pair at 0.85 meets in no
    band with probability 4e-7.  ``miss``: posterior probability below which a pair is
    given up.  ``batch``: hashes compared between two looks at it.  ``block``: classes of one
    bucket that a task holds at once, twice.
    """

    percent: int = 85
    shingle: int = 5
    bands: int = 20
    rows: int = 4
    batch: int = 20
    miss: float = 1e-7
    block: int = 512

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than ``size`` make one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    values = hashes.array(words, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, np.uint64(width), np.uint64)
    for i in range(width):
        total = fold(total) + values[i : i + count]
    return np.unique(fold(total))


@lru_cache(maxsize=4)
def multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(20_240_501).integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of each of ``count`` hash functions over the set."""
    factors = multipliers(count)[:, None]
    lowest = np.full(count, np.uint64(2**64 - 1))
    for start in range(0, len(shingles), 1024):
        np.minimum(lowest, (shingles[None, start : start + 1024] * factors).min(1), out=lowest)
    return (lowest >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=8)
def least_matches(hashes: int, batch: int, percent: int, miss: float) -> tuple[tuple[int, int], ...]:
    """(hashes seen, fewest matches to go on) for each look, from a uniform prior on the similarity."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    above = grid >= percent / 100
    looks = []
    for seen in range(batch, hashes + 1, batch):
        fewest = 0
        for matches in range(seen + 1):
            weight = matches * np.log(grid) + (seen - matches) * np.log1p(-grid)
            weight = np.exp(weight - weight.max())
            if weight[above].sum() < miss * weight.sum():
                fewest = matches + 1
        looks.append((seen, fewest))
    return tuple(looks)


def surviving(left: np.ndarray, right: np.ndarray, spec: NearDup) -> np.ndarray:
    """Positions of the signature pairs that no look rules out; each look reads one batch more."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    seen = 0
    for until, fewest in least_matches(spec.hashes, spec.batch, spec.percent, spec.miss):
        matches[alive] += (left[alive, seen:until] == right[alive, seen:until]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= fewest]
        seen = until
    return alive


def linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    small, large = (first, second) if len(first) <= len(second) else (second, first)
    if 100 * len(small) < percent * len(large):
        return False
    places = np.searchsorted(large, small)
    places[places == len(large)] = 0
    shared = int((large[places] == small).sum())
    return 100 * shared >= percent * (len(small) + len(large) - shared)


def digests(docs: DataFrame, spec: NearDup) -> DataFrame:
    """doc_id, n_shingles, key_a, key_b (digest of the whole set), sig; empty sets have no sig."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = shingle_set(words_of(text), spec.shingle, hashes)
                if len(found):
                    one = fold(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                    two = fold(fold(found) + np.uint64(len(found))).sum(dtype=np.uint64)
                    keys = int(one.astype(np.int64)), int(two.astype(np.int64))
                    rows.append((doc_id, len(found), *keys, signature(found, spec.hashes).tobytes()))
                else:
                    rows.append((doc_id, 0, None, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "key_a", "key_b", "sig"]).astype(
                {"doc_id": "Int64", "key_a": "Int64", "key_b": "Int64"}
            )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty()).mapInPandas(
        digest, "doc_id long, n_shingles long, key_a long, key_b long, sig binary"
    )


def sets_of(docs: DataFrame, wanted: DataFrame, spec: NearDup) -> DataFrame:
    """rep, shingles (sorted 64-bit hashes as bytes) of the wanted class representatives only."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(words_of(text), spec.shingle, hashes).tobytes() for text in batch["text"]]
            yield pd.DataFrame({"rep": batch["rep"], "shingles": found})

    picked = docs.select(F.col("doc_id").cast("long").alias("rep"), text_or_empty()).join(wanted, "rep", "left_semi")
    return picked.mapInPandas(sets, "rep long, shingles binary").distinct()


def pruned(pairs: DataFrame, spec: NearDup) -> DataFrame:
    """a, b of the pairs whose signatures sig_a, sig_b survive the looks."""

    def looks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                left = np.frombuffer(b"".join(batch["sig_a"]), np.uint32).reshape(len(batch), spec.hashes)
                right = np.frombuffer(b"".join(batch["sig_b"]), np.uint32).reshape(len(batch), spec.hashes)
                yield batch[["a", "b"]].iloc[surviving(left, right, spec)]

    return pairs.select("a", "b", "sig_a", "sig_b").mapInPandas(looks, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, spec: NearDup) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), spec.percent)
                for x, y in zip(batch["set_a"], batch["set_b"], strict=True)
            ]
            yield batch.loc[keep, ["a", "b"]]

    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInPandas(check, "a long, b long")


def _by_side(frame: pd.DataFrame, spec: NearDup) -> tuple[pd.DataFrame, np.ndarray]:
    frame = frame.sort_values(["side", "rep"], kind="stable")
    return frame, np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(len(frame), spec.hashes)


def _survivors(i: int, sigs: np.ndarray, side: np.ndarray, comps: np.ndarray, band: int, within: bool, spec: NearDup) -> np.ndarray:
    """Places of the classes of other components whose signatures survive against class ``i``, each pair once."""
    others = np.arange(i + 1, len(side)) if within else np.flatnonzero(side > side[i])
    others = others[comps[others] != comps[i]]
    if band and len(others):
        before = (sigs[others, : band * spec.rows] == sigs[i, : band * spec.rows]).reshape(len(others), band, -1)
        others = others[~before.all(2).any(1)]
    if len(others):
        others = others[surviving(np.broadcast_to(sigs[i], (len(others), spec.hashes)), sigs[others], spec)]
    return others


def open_classes(members: DataFrame, spec: NearDup) -> DataFrame:
    """bucket, pair, rep of the classes with a surviving pair; ``members`` as for ``block_links``, without shingles."""

    def survive(frame: pd.DataFrame) -> pd.DataFrame:
        frame, sigs = _by_side(frame, spec)
        side, comps = frame["side"].to_numpy(), frame["comp"].to_numpy()
        band, within = int(frame["band"].iloc[0]), bool(frame["within"].iloc[0])
        needed = np.zeros(len(frame), bool)
        for i in range(len(frame)):
            others = _survivors(i, sigs, side, comps, band, within, spec)
            if len(others):
                needed[i] = True
                needed[others] = True
        return frame.loc[needed, ["bucket", "pair", "rep"]]

    return members.groupBy("bucket", "pair").applyInPandas(survive, "bucket long, pair long, rep long")


def block_links(members: DataFrame, spec: NearDup) -> DataFrame:
    """Links between different components inside each (bucket, block pair), compared completely.

    ``members``: bucket, pair, side (0 or 1), within (the pair is one block with itself), rep, comp,
    sig, shingles.  A pair of classes whose components an earlier link of the task has joined
    is not compared again; a pair that shares an earlier band is left to that band.
    """

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame, sigs = _by_side(frame, spec)
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        reps, side = frame["rep"].to_numpy(), frame["side"].to_numpy()
        comps = frame["comp"].to_numpy().copy()
        band, within = int(frame["band"].iloc[0]), bool(frame["within"].iloc[0])
        found = []
        for i in range(len(frame)):
            for j in _survivors(i, sigs, side, comps, band, within, spec):
                if comps[i] != comps[j] and linked(sets[i], sets[j], spec.percent):
                    found.append((reps[i], reps[j]))
                    comps[comps == comps[j]] = comps[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return members.groupBy("bucket", "pair").applyInPandas(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, root of every node on a link; root is the smallest node reachable."""
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    )

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())

    before = None
    now = state(edges)
    while now[0] and now != before:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        small = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.toDF("u", "v"))
        edges = materialize(small.distinct())
        before, now = now, state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, spec: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id reachable over links, the document itself included.
    NULL or blank text: an empty set, linked with nothing.  Rows that repeat a doc_id are one
    document: links of any of its texts count for it, and its rows get the same component.  A NULL doc_id takes no part in groups:
    component_id is NULL and kept is true.  Other columns are ignored.
    """
    seen = materialize(digests(docs, spec))
    classes = materialize(
        seen.where("sig is not null and doc_id is not null")
        .groupBy("key_a", "key_b")
        .agg(F.min("doc_id").alias("rep"), F.max("sig").alias("sig"))
    )
    width = 4 * spec.rows
    bands = classes.select(
        "rep",
        F.posexplode(
            F.array(*[F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width)) for i in range(spec.bands)])
        ).alias("band", "bucket"),
    )
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("center")).where("size > 1")
    members = materialize(bands.join(sizes, "bucket"))

    star = members.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    sigs = classes.select("rep", "sig")
    near = pruned(
        star.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b"),
        spec,
    )
    # Written by itself, so that the planner sees the ids' own size and does not shuffle the texts to meet few of them.
    wanted = materialize(members.select("rep").distinct())
    sets = materialize(sets_of(docs, wanted, spec))
    first = materialize(verified(near, sets, spec))
    comps = components(first)

    placed = members.join(comps, members["rep"] == comps["node"], "left").select(
        "bucket", "band", "rep", "size", F.coalesce("root", "rep").alias("comp")
    )
    open_buckets = (
        placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    )
    rest = placed.join(open_buckets.select("bucket"), "bucket", "left_semi")
    # block of a member: its hash over the blocks of the bucket; it meets every block pair it is part of
    blocks = F.ceil(F.col("size") / spec.block).cast("int")
    rest = rest.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.hash("rep"), F.col("blocks")))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select(
        "bucket",
        "band",
        "rep",
        "comp",
        (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).alias("pair"),
        F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"),
        (F.col("mine") == F.col("other")).alias("within"),
    )
    rest = materialize(rest)
    signed = rest.join(sigs, "rep")
    needed = materialize(open_classes(signed, spec))
    second = block_links(signed.join(needed, ["bucket", "pair", "rep"], "left_semi").join(sets, "rep"), spec)
    roots = components(first.union(materialize(second)))

    labels = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "key_a", "key_b", F.coalesce("root", "rep").alias("component")
    )
    component = F.coalesce("component", "doc_id")
    return seen.join(labels, ["key_a", "key_b"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
