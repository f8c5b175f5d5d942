"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all benchmark items.

Items and documents are normalised alike: A-Z lower-cased, words joined by one space, with a space at both ends,
so that a window's key matches whole words only.  The automaton reads a normalised text once and names every
window that ends at a place, overlapping ones too; the places are mapped back to word numbers and to code points of
the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import materialize, text_or_empty
from lakemart.llm.licenses import words_only

#: Consecutive item words of a window.
WINDOW = 10
#: Characters of all windows in one automaton (each is a node at most, about 60 bytes); a larger benchmark is
#: dealt to several automata, read one after the other.
AUTOMATON_CHARS = 4_000_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
HITS = "hits array<struct<first:long,last:long>>"
SPANS = "spans array<struct<start:long,end:long>>"


def normalised(words: list[bytes]) -> str:
    return b" ".join([b"", *words, b""]).decode("utf-8", "replace")


def item_windows(items: DataFrame, id_column: str, window: int) -> DataFrame:
    """text (normalised window), words, ids (different items that hold it)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["id"].astype("Int64"), batch["text"], strict=True):
                words = words_only(text)
                many = min(window, len(words))
                keys = {normalised(words[i : i + many]) for i in range(len(words) - many + 1)} if words else ()
                rows += [(name, key, many) for key in keys]
            yield pd.DataFrame(rows, columns=["id", "text", "words"], dtype=object)

    picked = items.select(F.col(id_column).cast("long").alias("id"), text_or_empty())
    rows = picked.mapInPandas(cut, "id long, text string, words int")
    return rows.groupBy("text", "words").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def automaton_of(shared: dict[str, Any]):
    """The automaton of a broadcast block, built once a worker and kept beside the data."""
    if "automaton" not in shared:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for number, text in enumerate(shared["texts"]):
            automaton.add_word(text, number)
        automaton.make_automaton()
        shared["automaton"] = automaton
    return shared["automaton"]


def ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in edges.reshape(-1, 2)]


def places(words: list[bytes], matches: list[tuple[int, int]], lengths: np.ndarray, before) -> list[tuple[int, int]]:
    """Word ranges hit by windows that end at the matches' characters, together with ranges found ``before``."""
    ends = np.cumsum([len(w.decode("utf-8", "replace")) + 1 for w in words])
    last = np.searchsorted(ends, [end for end, _ in matches])
    first = last - lengths[[number for _, number in matches]] + 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last + 1, -1)
    for r in before:
        edge[r["first"]] += 1
        edge[r["last"] + 1] -= 1
    return ranges(np.cumsum(edge[:-1]) > 0)


def scan(docs: DataFrame, items: DataFrame, id_column: str = "item_id", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, hits, items, spans per row of ``docs`` (doc_id, text, ...) against ``items`` (<id_column>, text, ...).

    hits: ranges (first, last) of the words inside any occurrence of a window; items: the ids, ascending, of the
    items with occurring windows; spans: the same ranges as code points of the original text, end exclusive.  An
    item of fewer words than a window is one window.  NULL and empty texts have no words and no windows.  An item
    whose id is NULL hits words but is not listed; rows that repeat an item's id are one item; rows that repeat a
    doc_id are scanned each.  Other columns are ignored.  Whole texts are scanned, however long.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(items, id_column, window))
    blocks = 1 + int(windows.agg(F.sum(F.char_length("text"))).first()[0] or 0) // AUTOMATON_CHARS
    found = docs.select(
        F.col("doc_id").cast("long"),
        text_or_empty(),
        F.array().cast(HITS.split(" ", 1)[1]).alias("hits"),
        F.array().cast("array<long>").alias("items"),
    )
    for number in range(blocks):
        mine = windows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == number).toPandas()
        shared = spark.sparkContext.broadcast(
            {"texts": mine["text"].tolist(), "words": mine["words"].to_numpy(np.int64), "ids": [list(map(int, i)) for i in mine["ids"]]}
        )
        final = number == blocks - 1

        def matched(batches: Iterator[pd.DataFrame], shared=shared, final=final) -> Iterator[pd.DataFrame]:
            block = shared.value
            automaton = automaton_of(block)
            for batch in batches:
                rows = []
                for doc_id, text, hits, listed in zip(batch["doc_id"], batch["text"], batch["hits"], batch["items"], strict=True):
                    words = words_only(text)
                    matches = list(automaton.iter(normalised(words))) if words and block["texts"] else []
                    hits, spans = list(hits), []
                    if matches:
                        hits = places(words, matches, block["words"], hits)
                        numbers = {n for _, n in matches}
                        listed = sorted(set(listed).union(*(block["ids"][n] for n in numbers)))
                    else:
                        hits = [(r["first"], r["last"]) for r in hits]
                    if hits and final:
                        at = [m.span() for m in _WORD.finditer(text)]
                        spans = [(at[first][0], at[last][1]) for first, last in hits]
                    rows.append((doc_id, None if final else text, len(words), hits, list(listed), spans))
                names = ["doc_id", "text", "n_words", "hits", "items", "spans"]
                frame = pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "n_words": "int64"})
                yield frame.drop(columns="text") if final else frame

        shape = f"doc_id long, n_words long, {HITS}, items array<long>, {SPANS}"
        found = found.mapInPandas(matched, shape if final else shape.replace(", n_words", ", text string, n_words"))
        if not final:
            found = materialize(found)
            shared.unpersist()
    return found


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "item_id", window: int = WINDOW) -> DataFrame:
    """``scan`` as counts: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = scan(docs, items, id_column, window)
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, r: total + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "spans",
    )
