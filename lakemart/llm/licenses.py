"""License scans by diagonal voting.

All rolling word k-gram hashes of all texts are joined with the positions where the same k-gram stands
in a template.  A hit votes for its diagonal (place in the text minus place in the template); an
unchanged passage puts all its votes on one diagonal, and an inserted or missing word moves them to
a neighbouring one.  Neighbouring diagonals are merged; a merged passage is a candidate if it holds enough
different k-grams of the template, and counts as far as these follow each other in the template's order.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import WordHashes, fold, text_or_empty

# Phrases whose places are counted, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Opening or characteristic sentences of public license texts, with their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: Words of a gram.
GRAM = 2
#: Diagonals at most this far apart are one passage.
NEIGHBOURS = 3
#: Share of a template's grams a merged passage must cover.
COVER = 0.7

_SPACES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_only(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters."""
    return text.encode("utf-8", "replace").lower().translate(_SPACES).split() if text else []


def grams(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    values = hashes.array(words, len(words))
    count = max(len(words) - GRAM + 1, 0)
    total = np.zeros(count, np.uint64)
    for i in range(GRAM):
        total = fold(total) + values[i : i + count]
    return fold(total).astype(np.int64)


def template_rows(phrases: Mapping[str, str], templates: Mapping[str, str]) -> list[tuple]:
    """(gram, template, place, grams of the template, label, exact) of all templates; a few hundred rows."""
    hashes = WordHashes()
    rows = []
    listed = [(t, label, True) for t, label in phrases.items()] + [(t, label, False) for t, label in templates.items()]
    for number, (text, label, exact) in enumerate(listed):
        found = grams(words_only(text), hashes)
        if not len(found):
            raise ValueError(f"a template needs {GRAM} words or more: {text!r}")
        rows += [(int(g), number, place, len(found), label, exact) for place, g in enumerate(found)]
    return rows


def chains(places: np.ndarray, at: np.ndarray, of: int) -> list[tuple[int, int, float]]:
    """(first, last, cover) of the passages whose hits follow the template in order, best first, none overlapping.

    From one hit of a chain to the next, place and position in the template rise and the diagonal moves by
    ``NEIGHBOURS`` at most.  A hit has ``of`` predecessors times a few places, whatever the text's length.
    """
    order = np.lexsort((at, places))
    length: dict[tuple[int, int], tuple[int, int]] = {}  # (place, at): grams of the longest chain to it, its first place
    for place, spot in zip(places[order].tolist(), at[order].tolist(), strict=True):
        best = (1, place)
        for back in range(1, spot + 1):
            for drift in range(max(-NEIGHBOURS, 1 - back), NEIGHBOURS + 1):
                before = length.get((place - back - drift, spot - back))
                if before and (before[0] + 1, before[1]) > best:
                    best = (before[0] + 1, before[1])
        length[place, spot] = best
    found: list[tuple[int, int, float]] = []
    ends = [(-many, place - first, first, place) for (place, _), (many, first) in length.items() if many / of >= COVER]
    taken: set[int] = set()
    for many, _, first, last in sorted(ends):
        span = range(first, last + GRAM)
        if taken.isdisjoint(span):
            taken.update(span)
            found.append((first, last, -many / of))
    return found


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans per row of ``docs``.

    n_base counts the places of ``phrases``, first_word and last_word are their smallest and largest
    start.  spans: (label, start, end, cover) of every verified passage, ends exclusive; cover is the share of the
    template's grams that stand there in its order.  score: the largest cover, 0 without a passage.  NULL or empty text has no words and no labels.  Rows that repeat
    a doc_id are scanned each; other columns are ignored.
    """

    def rolled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        # A row's number in its task: the same again when a lost task is run again on its split.
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                split = [words_only(text) for text in part["text"]]
                found = [grams(words, hashes) for words in split]
                # Every text gives one row more, at place -1, for its number of words.
                sizes = np.array([len(g) + 1 for g in found])
                places = np.concatenate([np.arange(-1, len(g)) for g in found])
                yield pd.DataFrame(
                    {
                        "row": np.repeat(row + np.arange(len(part)), sizes),
                        "doc_id": part["doc_id"].astype("Int64").repeat(sizes).reset_index(drop=True),
                        "place": places,
                        "gram": np.concatenate([np.append(np.int64(0), g) for g in found]),
                        "n_words": np.repeat([len(words) for words in split], sizes),
                    }
                )
                row += len(part)

    spark = docs.sparkSession
    known = spark.createDataFrame(
        template_rows(phrases, templates),
        "gram long, template int, at int, of int, label string, exact boolean",
    )
    placed = docs.select(F.col("doc_id").cast("long"), text_or_empty()).mapInPandas(
        rolled, "row long, doc_id long, place long, gram long, n_words long"
    )
    placed = placed.withColumn("gram", F.when(F.col("place") >= 0, F.col("gram")))
    hits = placed.join(F.broadcast(known), "gram", "left").where("place < 0 or template is not null")
    diagonals = hits.groupBy("row", "doc_id", "template", "of", "label", "exact", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("at"),
        F.max(F.when(F.col("place") < 0, F.col("n_words"))).alias("n_words"),
    )
    # A passage of a template starts where the gap to the diagonal before is larger than allowed;
    # exact phrases are never merged.
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("exact"), 0).otherwise(NEIGHBOURS)
    passages = (
        diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("passage", F.sum("new").over(along))
        .groupBy("row", "doc_id", "template", "of", "label", "exact", "passage")
        .agg(
            F.flatten(F.collect_list(F.transform("at", lambda a: F.struct((F.col("diagonal") + a).alias("place"), a.alias("at"))))).alias("hits"),
            F.max("n_words").alias("n_words"),
        )
        .withColumn("votes", F.size(F.array_distinct("hits.at")))
        .where((F.col("votes") / F.col("of") >= F.when(F.col("exact"), 1.0).otherwise(COVER)) | F.col("template").isNull())
    )

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = []
            for places, at, of, exact in zip(batch["places"], batch["at"], batch["of"], batch["exact"], strict=True):
                if pd.isna(of):
                    spans.append([(None, None, None)])
                elif exact:
                    spans.append([(int(min(places)), int(max(places)), 1.0)])
                else:
                    spans.append(chains(np.asarray(places), np.asarray(at), int(of)))
            batch["span"] = spans
            rows = batch.explode("span").dropna(subset="span")
            for i, name in enumerate(("low", "high", "cover")):
                rows[name] = pd.array([span[i] for span in rows["span"]], "Float64" if name == "cover" else "Int64")
            yield rows[["row", "doc_id", "label", "exact", "n_words", "low", "high", "cover"]]

    passages = passages.select(
        "row", "doc_id", "label", "exact", "n_words", "of", F.col("hits.place").alias("places"), F.col("hits.at").alias("at")
    ).mapInPandas(
        verified, "row long, doc_id long, label string, exact boolean, n_words long, low long, high long, cover double"
    )
    base = F.col("exact")
    span = F.struct(F.col("label"), F.col("low").alias("start"), (F.col("high") + GRAM).alias("end"), F.col("cover"))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    return passages.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("low"))).alias("first_word"),
        F.max(F.when(base, F.col("low"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), span))).alias("spans"),
    ).drop("row")
