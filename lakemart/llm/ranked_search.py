"""Ranked lexical search: block-max MaxScore over an inverted index in shards.

``build_index`` makes one pass over the documents.  A task cuts its documents into shards of bounded size and
writes, for every term of a shard, its postings in blocks of ``BLOCK``: gaps of document numbers and term
frequencies in as few bytes as the block needs.  Beside each block stand, uncompressed, its last document and
its impacts: the (frequency, length) pairs no other posting of the block beats in both.  Any score that
rises with the frequency and falls with the length has its maximum over a block among them, so block maxima are
exact whatever the corpus statistics turn out to be.

``search`` weighs the query terms, sends them to the shards and keeps ``k`` documents a shard and query.  In a
shard, lists stand in order of their greatest possible contribution.  The lists whose bounds together cannot
reach the k-th best score so far are non-essential: they bring no candidates.  Candidates come from the
essential lists, and a block of a non-essential list is decompressed only for candidates which its block
maximum does not rule out.  The shards' heaps are merged by a window that keeps ``k`` rows a query on both
sides of its exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import materialize
from lakemart.llm.licenses import words_only

#: Postings of a block.
BLOCK = 128
#: A shard ends after this many documents or bytes of text, whichever comes first; a longer text ends it alone.
SHARD_DOCS = 4096
SHARD_BYTES = 4 << 20
#: Index rows handed to the JVM at once.
ROWS_AT_ONCE = 8192
#: Documents scored together; the k-th best score is raised between waves.
WAVE = 512
#: Bytes of query terms sent to the workers at once; more go in further rounds over the index.
QUERY_BYTES = 32 << 20

#: A row per shard without term (ids and sizes of its documents; df: documents with a term; total: all their
#: terms) and a row per shard and term (df: postings).
INDEX_SCHEMA = (
    "shard long, term string, df long, total long, last array<int>, at array<int>, width array<int>, blob binary, "
    "impact_at array<int>, impact_tf array<int>, impact_n array<int>, ids array<long>, sizes array<int>"
)
_LISTS = ("last", "at", "width", "impact_at", "impact_tf", "impact_n")


class Numbers(dict):
    """term -> number in order of first appearance."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


# ---------------------------------------------------------------- index


def bytes_needed(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def scatter(blob: np.ndarray, places: np.ndarray, values: np.ndarray, widths: np.ndarray) -> None:
    """Writes values little-endian, each in its own number of bytes."""
    for byte in range(4):
        wide = widths > byte
        blob[places[wide] + byte] = (values[wide] >> (8 * byte)) & 0xFF


def pack_postings(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks of postings sorted by (term, doc); terms are numbered without gaps.

    df, block_ends (blocks up to and with each term), last, at (first byte within the term), width (bytes a gap +
    8 * bytes a frequency), byte_ends, blob, impact_ends (by term), impact_at (first impact within the term),
    impact_tf, impact_n.
    """
    df = np.bincount(term)
    rank = np.arange(len(term)) - np.repeat(np.cumsum(df) - df, df)
    opens = np.flatnonzero(rank % BLOCK == 0)
    many = np.diff(np.append(opens, len(term)))
    block = np.repeat(np.arange(len(opens)), many)
    of_term = term[opens]
    last = doc[np.append(opens[1:], len(term)) - 1]
    gap = doc - np.where(rank == 0, -1, np.roll(doc, 1))
    gap_width = bytes_needed(np.maximum.reduceat(gap, opens))
    tf_width = bytes_needed(np.maximum.reduceat(tf, opens))
    size = many * (gap_width + tf_width)
    start = np.cumsum(size) - size
    inside = np.arange(len(term)) - opens[block]
    blob = np.zeros(int(size.sum()), np.uint8)
    scatter(blob, start[block] + inside * gap_width[block], gap, gap_width[block])
    scatter(blob, (start + many * gap_width)[block] + inside * tf_width[block], tf, tf_width[block])
    first_block = np.searchsorted(of_term, np.arange(len(df)))
    byte_ends = np.cumsum(np.bincount(of_term, size)).astype(np.int64)

    # Impacts: by falling frequency, the postings shorter than all before them.  A later block's lengths are
    # lowered by more than any length, so that one running minimum serves all blocks.
    n = sizes[doc].astype(np.int64)
    order = np.lexsort((n, -tf, block))
    lowered = n[order] + (len(opens) - block[order]) * (int(n.max()) + 1)
    least = np.minimum.accumulate(lowered)
    kept = order[np.append(True, lowered[1:] < least[:-1])]
    impacts = np.bincount(block[kept], minlength=len(opens))
    impact_start = np.cumsum(impacts) - impacts
    return {
        "df": df,
        "block_ends": np.cumsum(np.bincount(of_term)),
        "last": last,
        "at": start - start[first_block][of_term],
        "width": gap_width + 8 * tf_width,
        "byte_ends": byte_ends,
        "blob": blob,
        "impact_ends": np.cumsum(np.bincount(of_term, impacts)).astype(np.int64),
        "impact_at": impact_start - impact_start[first_block][of_term],
        "impact_tf": tf[kept],
        "impact_n": n[kept],
    }


def lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """One list a term, after a NULL for the shard's own row."""
    offsets = pa.array(np.concatenate([[0, 0], ends]), pa.int32(), mask=np.arange(len(ends) + 2) == 0)
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def shard_rows(shard: int, terms: list[bytes], numbers: np.ndarray, ids: list[int | None], sizes: np.ndarray) -> pa.RecordBatch:
    """Index rows of one shard: ``numbers`` are the term numbers of its documents, one document after the other."""
    many = len(sizes)
    key, tf = np.unique(numbers.astype(np.int64) * many + np.repeat(np.arange(many), sizes), return_counts=True)
    packed = pack_postings(key // many, key % many, tf, sizes)
    rows = len(terms) + 1
    own = np.arange(rows) > 0
    blob = pa.Array.from_buffers(
        pa.binary(),
        rows,
        [
            pa.array(own).buffers()[1],
            pa.py_buffer(np.concatenate([[0, 0], packed["byte_ends"]]).astype(np.int32)),
            pa.py_buffer(packed["blob"]),
        ],
    )
    per_shard = lambda values, kind: pa.array([values] + [None] * len(terms), kind)
    columns = {
        "shard": pa.array(np.full(rows, shard)),
        "term": pa.array([None, *terms], pa.binary()).view(pa.string()),
        "df": pa.array(np.append(many, packed["df"]), pa.int64()),
        "total": pa.array(np.append(int(sizes.sum()), np.zeros(len(terms), np.int64)), mask=own),
        "last": lists(packed["block_ends"], packed["last"]),
        "at": lists(packed["block_ends"], packed["at"]),
        "width": lists(packed["block_ends"], packed["width"]),
        "blob": blob,
        "impact_at": lists(packed["block_ends"], packed["impact_at"]),
        "impact_tf": lists(packed["impact_ends"], packed["impact_tf"]),
        "impact_n": lists(packed["impact_ends"], packed["impact_n"]),
        "ids": per_shard(ids, pa.list_(pa.int64())),
        "sizes": per_shard(sizes.tolist(), pa.list_(pa.int32())),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def build_index(docs: DataFrame) -> DataFrame:
    """``INDEX_SCHEMA`` rows over the whole text of every row of ``docs`` (doc_id, text, ...).

    Documents without terms (NULL, empty or without letters and digits) are not in the index.  Rows that repeat a
    doc_id are documents of their own, so are rows whose doc_id is NULL.  Other columns are ignored.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The number names a shard within the one table that is written; a task run again writes its own rows anew.
        shard = TaskContext.get().partitionId() << 33
        known, parts, ids, sizes, held = Numbers(), [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            rows = shard_rows(shard, list(known), np.concatenate(parts), ids, np.array(sizes))
            yield from (rows.slice(at, ROWS_AT_ONCE) for at in range(0, rows.num_rows, ROWS_AT_ONCE))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_only(text.as_py())
                if not words:
                    continue
                parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id)
                sizes.append(len(words))
                held += sum(map(len, words))
                if len(ids) >= SHARD_DOCS or held >= SHARD_BYTES:
                    yield from close()
                    shard += 1
                    known, parts, ids, sizes, held = Numbers(), [], [], [], 0
        if ids:
            yield from close()

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(shards, INDEX_SCHEMA)


# ---------------------------------------------------------------- search


def contribution(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A term's share of the score before its weight; ``length`` is the document's m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * length)


class Shard:
    """Postings of one shard, read from its index rows; blocks are decompressed when they are asked for."""

    def __init__(self, rows: pa.Table, documents: int, terms: int):
        own = rows.filter(pa.compute.is_null(rows["term"]))
        self.ids = own["ids"].combine_chunks().flatten()
        self.missing = np.asarray(self.ids.is_null())
        self.ids = self.ids.fill_null(0).to_numpy()
        sizes = own["sizes"].combine_chunks().flatten().to_numpy().astype(np.int64)
        self.m = 10 + (90 * sizes * documents) // terms
        rows = rows.filter(pa.compute.is_valid(rows["term"])).combine_chunks()
        self.terms = rows["term"].to_pylist()
        self.df = rows["df"].to_numpy()
        self.blob = rows["blob"].to_pylist()
        flat, ends = {}, {}
        for name in _LISTS:
            column = rows[name].combine_chunks()
            flat[name] = column.flatten().to_numpy().astype(np.int64)
            ends[name] = np.cumsum(column.value_lengths().to_numpy())
        self.block_start = np.append(0, ends["last"])[:-1]
        self.block_end = ends["last"]
        self.last, self.at, self.width = flat["last"], flat["at"], flat["width"]
        self.most = np.zeros(0, np.int64)
        if self.terms:
            value = contribution(flat["impact_tf"], 10 + (90 * flat["impact_n"] * documents) // terms)
            term_start = np.append(0, ends["impact_tf"])[:-1]
            opens = flat["impact_at"] + np.repeat(term_start, self.block_end - self.block_start)
            self.block_most = np.maximum.reduceat(value, opens)
            self.most = np.maximum.reduceat(self.block_most, self.block_start)
        self.read: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def block(self, row: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, contributions) of a term's block; kept for the queries that follow."""
        if (row, number) not in self.read:
            at = self.block_start[row] + number
            many = min(BLOCK, int(self.df[row]) - number * BLOCK)
            gap_width, tf_width = int(self.width[at]) & 7, int(self.width[at]) >> 3
            first = int(self.at[at])
            gaps = np.frombuffer(self.blob[row], f"<u{gap_width}", many, first)
            tf = np.frombuffer(self.blob[row], f"<u{tf_width}", many, first + many * gap_width).astype(np.int64)
            docs = np.cumsum(gaps, dtype=np.int64) + (self.last[at - 1] if number else -1)
            self.read[row, number] = docs, contribution(tf, self.m[docs])
        return self.read[row, number]

    def between(self, row: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The postings of a term for documents low to high - 1."""
        last = self.last[self.block_start[row] : self.block_end[row]]
        first, end = np.searchsorted(last, low), min(int(np.searchsorted(last, high - 1)) + 1, len(last))
        if first >= end:
            return _NOTHING
        found = [self.block(row, number) for number in range(first, end)]
        docs, values = found[0] if len(found) == 1 else map(np.concatenate, zip(*found, strict=True))
        inside = slice(*np.searchsorted(docs, [low, high]))
        return docs[inside], values[inside]

    def look_up(self, row: int, weight: int, docs: np.ndarray, scores: np.ndarray, rest: int, edge: int) -> tuple[np.ndarray, np.ndarray]:
        """Adds a non-essential term to candidates; those whose bound stays under ``edge`` are dropped unread."""
        last = self.last[self.block_start[row] : self.block_end[row]]
        number = np.searchsorted(last, docs)
        inside = number < len(last)
        bound = scores + rest
        bound[inside] += weight * self.block_most[self.block_start[row] + number[inside]]
        stay = bound >= edge
        docs, scores, number, inside = docs[stay], scores[stay], number[stay], inside[stay]
        for one in np.unique(number[inside]).tolist():
            held, values = self.block(row, one)
            here = np.flatnonzero(number == one)
            place = np.searchsorted(held, docs[here])
            hit = held[place] == docs[here]
            scores[here[hit]] += weight * values[place[hit]]
        return docs, scores

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the ``k`` best, scores above 0, equal scores by doc_id."""
        bounds = weights * self.most[rows]
        order = np.argsort(bounds, kind="stable")
        rows, weights = rows[order].tolist(), weights[order].tolist()
        reach = np.cumsum(bounds[order])  # the most the first lists give together
        top, top_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for low in range(0, len(self.ids), WAVE):
            high = min(low + WAVE, len(self.ids))
            edge = int(top_scores[-1]) if len(top) == k else 1
            essential = int(np.searchsorted(reach, edge))
            scores, met = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
            for i in range(essential, len(rows)):
                docs, values = self.between(rows[i], low, high)
                scores[docs - low] += weights[i] * values
                met[docs - low] = True
            docs = np.flatnonzero(met)
            scores, docs = scores[docs], docs + low
            for i in range(essential - 1, -1, -1):
                if not len(docs):
                    break
                docs, scores = self.look_up(rows[i], weights[i], docs, scores, int(reach[i - 1]) if i else 0, edge)
            some = scores >= edge
            if some.any():
                top, top_scores = np.append(top, docs[some]), np.append(top_scores, scores[some])
                first = np.lexsort((self.ids[top], self.missing[top], -top_scores))[:k]
                top, top_scores = top[first], top_scores[first]
        return top, top_scores


_NOTHING = np.zeros(0, np.int64), np.zeros(0, np.int64)


def item_terms(items: DataFrame, id_column: str) -> DataFrame:
    """item (row number), id, term: the different terms of every row of ``items``."""

    def different(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["term"] = [sorted({w.decode("utf-8", "replace") for w in words_only(text)}) for text in batch.pop("text")]
            yield batch.explode("term").dropna(subset="term").astype({"id": "Int64"})

    picked = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_column).cast("long").alias("id"), "text")
    return picked.mapInPandas(different, "item long, id long, term string")


def search(index: DataFrame, items: DataFrame, k: int = 10, id_column: str = "item_id") -> DataFrame:
    """<id_column>, rank, doc_id, score: the ``k`` best documents of every row of ``items`` (<id_column>, text, ...).

    ``index``: a written ``build_index`` table.  A term weighs floor(1000 ln((2N + 2) / (2 df + 1))) and gives a
    document 10^9 tf div (1000 tf + 8 m) times that, m = 10 + 90 n N div L, in whole numbers.  Documents without a
    positive score are not returned; equal scores stand by doc_id, NULL last.  Every row of ``items`` is a query of
    its own, whatever its id; items without terms, and terms in no document, find nothing.  Query terms are
    sent to the workers at most ``QUERY_BYTES`` at once.
    """
    spark = index.sparkSession
    out = f"`{id_column}` long, rank int, doc_id long, score long"
    totals = index.where("term is null").agg(F.sum("df").alias("n"), F.sum("total").alias("l")).first()
    if not totals["n"]:
        return spark.createDataFrame([], out)
    documents, terms = int(totals["n"]), int(totals["l"])
    asked = materialize(item_terms(items, id_column))
    wanted = asked.select("term").distinct()
    lists_of = index.where("term is not null").join(wanted, "term", "left_semi")
    ratio = F.lit(float(2 * documents + 2)) / (2 * F.sum("df") + 1)
    weights = lists_of.groupBy("term").agg(F.floor(1000 * F.log(ratio)).cast("long").alias("weight"))
    weighed = materialize(asked.join(weights.where("weight > 0"), "term"))
    rounds = 1 + int(weighed.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0) // QUERY_BYTES
    own = index.where("term is null")
    heaps = []
    for number in range(rounds):
        mine = weighed.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == number)
        queries = mine.orderBy("item", "term").toPandas()
        if queries.empty:
            continue
        shared = spark.sparkContext.broadcast(plain(queries))
        postings = lists_of if rounds == 1 else index.join(mine.select("term").distinct(), "term", "left_semi")
        heap_of = shard_search(shared, documents, terms, k)
        columns = [c for c in index.columns if c != "total"]
        everything = own.select(*columns).unionByName(postings.select(*columns))
        heaps.append(materialize(everything.groupBy("shard").applyInArrow(heap_of, HEAP)))
        shared.unpersist()
    if not heaps:
        return spark.createDataFrame([], out)
    merged = heaps[0]
    for heap in heaps[1:]:
        merged = merged.unionByName(heap)
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = merged.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(id_column), "rank", "doc_id", "score")


#: A shard's best documents of every query.
HEAP = "item long, id long, doc_id long, score long"


def shard_search(shared: Broadcast, documents: int, terms: int, k: int) -> Callable[[pa.Table], pa.Table]:
    """The task that ranks one shard's documents for all queries of a broadcast ``plain``."""

    def heaps(rows: pa.Table) -> pa.Table:
        shard = Shard(rows, documents, terms)
        asked = shared.value
        row_of = np.full(len(asked["terms"]), -1)
        for row, term in enumerate(shard.terms):
            row_of[asked["number"][term]] = row
        found = []
        for at, (item, name) in enumerate(asked["items"]):
            mine = slice(asked["starts"][at], asked["starts"][at + 1])
            here = row_of[asked["term"][mine]]
            docs, scores = shard.best(here[here >= 0], asked["weight"][mine][here >= 0], k)
            found += [
                (item, name, None if shard.missing[d] else int(shard.ids[d]), int(s)) for d, s in zip(docs, scores, strict=True)
            ]
        columns = zip(*found, strict=True) if found else ([], [], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item", "id", "doc_id", "score"])

    return heaps


def plain(queries: pd.DataFrame) -> dict[str, Any]:
    """Query rows (item, id, term, weight), sorted by item, as arrays and plain values that need no import to read."""
    names, term = np.unique(queries["term"].to_numpy(object), return_inverse=True)
    items, starts = np.unique(queries["item"].to_numpy(), return_index=True)
    ids = queries["id"].iloc[starts]
    return {
        "terms": names.tolist(),
        "number": {name: i for i, name in enumerate(names.tolist())},
        "term": term,
        "weight": queries["weight"].to_numpy(np.int64),
        "items": [(int(i), None if pd.isna(name) else int(name)) for i, name in zip(items, ids, strict=True)],
        "starts": [*starts.tolist(), len(queries)],
    }
