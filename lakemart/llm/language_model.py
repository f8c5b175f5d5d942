"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a log scale: an n-gram seen c times enters the filter
with the levels 1 to 1 + floor(log2 c).  A worker reads a count back by probing level after level until
one is missing, so an error can only raise a count, and each further level of error is as unlikely again.
Probabilities interpolate the pair's share with the word's smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import WordHashes, fold, materialize, remainder, text_or_empty, words_of

#: What stands for the end of a text; no word holds white space.
END = b" end"


@dataclass(frozen=True)
class BloomSpec:
    """``bits``: bits for each (n-gram, level) stored; ``probes``: hash functions (error about 0.8 % at 10 and 4).

    ``most_bytes`` bounds what is broadcast: a larger corpus gets fewer bits per entry, that is more
    error, and loses no entry.  ``heavy``: a word with at least total / heavy occurrences has its exact count
    broadcast, so at most ``heavy`` words have.  ``mix``: weight of the pair's share.
    Pairs seen less than ``least_pair`` times are left to the words' shares.
    """

    bits: int = 10
    probes: int = 4
    most_bytes: int = 1 << 28
    heavy: int = 200_000
    mix: float = 0.6
    least_pair: int = 2
    segment: int = 1 << 16


def entry_hash(grams: np.ndarray, level: int) -> np.ndarray:
    return fold(grams + np.uint64(level * 0xD6E8FEB86659FD93 % 2**64))


def segment_of(grams: np.ndarray, segments: int) -> np.ndarray:
    return fold(grams ^ np.uint64(0xE7037ED1A0B428DB)) & np.uint64(segments - 1)


def bit_places(entries: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """Place of the probe's bit in its segment, by double hashing; ``bits`` is a power of two."""
    step = fold(entries ^ np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    return (entries + step * np.uint64(probe)) & np.uint64(bits - 1)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return fold(fold(first) + second)


class Filter:
    """The filter's segments, one row each, and how to probe them; a gram's bits lie in one segment."""

    def __init__(self, data: np.ndarray, probes: int):
        self.data, self.probes = data, probes

    def has(self, segments: np.ndarray, entries: np.ndarray) -> np.ndarray:
        found = np.ones(len(entries), bool)
        for probe in range(self.probes):
            places = bit_places(entries, probe, self.data.shape[1] * 8)
            found &= (self.data[segments, places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Counts as the filter holds them: 0, 1, then the middle of each power of two."""
        levels = np.zeros(len(grams), np.int64)
        segments = segment_of(grams, len(self.data))
        alive = np.arange(len(grams))
        level = 0
        while len(alive):
            level += 1
            alive = alive[self.has(segments[alive], entry_hash(grams[alive], level))]
            levels[alive] = level
        return np.where(levels <= 1, levels, 1.5 * 2.0 ** (levels - 1))


def token_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of the words, A-Z lower-cased and split at ASCII white space, and of the end."""
    words = words_of(text)
    words.append(END)
    return hashes.array(words, len(words))


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """gram, count over all rows; a task adds up what a batch repeats before anything is shuffled."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            found = []
            for text in batch["text"]:
                tokens = token_hashes(text, hashes)
                found.append(tokens if order == 1 else pair_hash(np.append(tokens[-1:], tokens[:-1]), tokens))
            if found:
                grams, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"gram": grams.astype(np.int64), "count": counts})

    return docs.select("text").mapInPandas(counted, "gram long, count long").groupBy("gram").agg(F.sum("count").alias("count"))


def build_filter(counts: DataFrame, spec: BloomSpec) -> Filter:
    """Fills the filter segment by segment on the workers; the driver receives ``most_bytes`` at most."""
    entries = counts.agg(F.sum(F.floor(F.log2("count")).cast("long") + 1)).first()[0] or 0
    wanted = min(max(spec.bits * int(entries) // 8, 1), spec.most_bytes)
    segments = 1 << max(-(-wanted // spec.segment) - 1, 0).bit_length()
    while segments > 1 and segments * spec.segment > spec.most_bytes:
        segments //= 2

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            which = segment_of(batch["gram"].to_numpy().astype(np.int64).view(np.uint64), segments)
            yield pd.DataFrame({"segment": which.astype(np.int32), "gram": batch["gram"], "count": batch["count"]})

    def filled(rows: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(spec.segment * 8, np.uint8)
        grams = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
        highest = np.frexp(rows["count"].to_numpy().astype(np.float64))[1]
        for level in range(1, int(highest.max(initial=0)) + 1):
            some = entry_hash(grams[highest >= level], level)
            for probe in range(spec.probes):
                marks[bit_places(some, probe, spec.segment * 8)] = 1
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "packed": [np.packbits(marks, bitorder="little").tobytes()]})

    rows = (
        counts.select("gram", "count")
        .mapInPandas(placed, "segment int, gram long, count long")
        .groupBy("segment")
        .applyInPandas(filled, "segment int, packed binary")
    )
    data = np.zeros((segments, spec.segment), np.uint8)
    for row in rows.toLocalIterator():
        data[row["segment"]] = np.frombuffer(row["packed"], np.uint8)
    return Filter(data, spec.probes)


def score(docs: DataFrame, spec: BloomSpec = BloomSpec()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Learns from rows whose crc32 remainder of the id is not 2 of 7 (a NULL id has none and is not learned
    from; its held_out is NULL).  base_score adds log10((c + 1) / (N + V + 1)) over the tokens with exact
    counts c; score is the filter model's log10 probability of the text.  NULL or empty text is the end alone.
    Rows that repeat a doc_id are scored each; other columns are ignored.
    """
    spark = docs.sparkSession
    held = (remainder("doc_id", 7) == 2).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, text_or_empty())
    learned = rows.where(~F.col("held_out"))
    words = materialize(gram_counts(learned, 1))
    pairs = materialize(gram_counts(learned, 2).where(F.col("count") >= spec.least_pair))
    total, distinct = words.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    frequent = words.where(F.col("count") >= max(total / spec.heavy, 1)).select("gram", "count").toPandas()
    order = np.argsort(frequent["gram"].to_numpy().astype(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(
        {
            "filter": build_filter(words.unionAll(pairs), spec),
            "heavy": frequent["gram"].to_numpy().astype(np.int64).view(np.uint64)[order],
            "counts": frequent["count"].to_numpy().astype(np.int64)[order],
        }
    )
    base = float(np.log10(total + distinct + 1))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row a text with its sums over frequent words, and one for each of its rarer tokens."""
        model, hashes = shared.value, WordHashes()
        probe = model["filter"]
        heavy, exact = model["heavy"], model["counts"]
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                texts = [token_hashes(t, hashes) for t in part["text"]]
                sizes = np.array([len(t) for t in texts])
                tokens = np.concatenate(texts)
                before = np.concatenate([np.append(t[-1:], t[:-1]) for t in texts])
                unique, back = np.unique(tokens, return_inverse=True)
                seen = probe.counts(unique)
                grams, gram_back = np.unique(pair_hash(before, tokens), return_inverse=True)
                together = probe.counts(grams)[gram_back]
                single = (seen[back] + 1) / (total + distinct + 1)
                history = seen[np.searchsorted(unique, before)]
                share = np.minimum(together / np.maximum(history, 1), 1)
                chance = np.log10(np.where(history > 0, spec.mix * share + (1 - spec.mix) * single, single))
                edges = np.append(0, np.cumsum(sizes)[:-1])
                ids = row + np.arange(len(part))
                spot = np.minimum(np.searchsorted(heavy, unique), max(len(heavy) - 1, 0))
                common = heavy[spot] == unique if len(heavy) else np.zeros(len(unique), bool)
                value = np.zeros(len(unique))
                value[common] = np.log10(exact[spot[common]] + 1.0) if len(heavy) else 0
                part_ids = part["doc_id"].astype("Int64").reset_index(drop=True)
                nothing = np.zeros(len(part), np.int64)
                yield pd.DataFrame(
                    {
                        "row": ids,
                        "gram": nothing,
                        "many": nothing,
                        "doc_id": part_ids,
                        "held_out": part["held_out"].reset_index(drop=True).astype("boolean"),
                        "n_tokens": sizes,
                        "n_known": np.add.reduceat(common[back].astype(np.int64), edges),
                        "part": np.add.reduceat(value[back], edges),
                        "score": np.add.reduceat(chance, edges),
                    }
                )
                rarer = ~common[back]
                many = int(rarer.sum())
                none = np.zeros(many, np.int64)
                blank = np.ones(many, bool)
                yield pd.DataFrame(
                    {
                        "row": np.repeat(ids, sizes)[rarer],
                        "gram": tokens[rarer].view(np.int64),
                        "many": none + 1,
                        "doc_id": pd.arrays.IntegerArray(none, blank),
                        "held_out": pd.arrays.BooleanArray(none.astype(bool), blank),
                        "n_tokens": pd.arrays.IntegerArray(none, blank),
                        "n_known": none,
                        "part": none.astype(np.float64),
                        "score": pd.arrays.FloatingArray(none.astype(np.float64), blank),
                    }
                )
                row += len(part)

    parts = rows.mapInPandas(
        scored,
        "row long, gram long, many long, doc_id long, held_out boolean, n_tokens long, n_known long, part double, score double",
    )
    # Only rarer words meet the exact counts by a join; each stands in few rows.
    rare_words = words.where(F.col("count") < max(total / spec.heavy, 1))
    looked_up = parts.withColumn("key", F.when(F.col("many") > 0, F.col("gram"))).join(
        rare_words.select(F.col("gram").alias("key"), "count"), "key", "left"
    )
    c = F.coalesce("count", F.lit(0))
    return looked_up.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, F.col("many")).otherwise(0)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.sum(F.col("part") + F.col("many") * F.log10(c + 1)) - F.max("n_tokens") * base).alias("base_score"),
        F.max("score").alias("score"),
    ).drop("row")
