"""Small helpers shared by the operators: word hashing, input columns, written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import materialize, remove, written

__all__ = ["WordHashes", "fold", "materialize", "remainder", "remove", "table", "text_or_empty", "words_of", "written"]

#: Words a worker remembers before it starts over; bounds a worker's memory, not the result.
REMEMBERED_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; NULL ids have none."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % divisor


def words_of(text: str | None) -> list[bytes]:
    """Lower-cases A-Z and splits at ASCII white space; other letters stay as they are.

    ``bytes.lower`` and ``bytes.split`` touch ASCII only, which is the rule asked for.
    Lone surrogates, which UTF-8 cannot hold, are replaced.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: Iterable[bytes], count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, count)


def fold(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that sums and products of hashes can be hashed again."""
    mixed = values ^ (values >> np.uint64(31))
    mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))
