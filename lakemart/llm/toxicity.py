"""Toxicity of whole texts from their nearest labelled examples.

Examples are TF-IDF vectors over the words that tell the two labels apart (chi-square at fit time).
An inverted index over blocks of examples keeps, for each word and block, the largest weight.  A text
visits blocks in falling order of the bound these maxima give, a wave at a time, and stops once no
further block can hold a nearer example, so its neighbours are exact.  Their distance-weighted votes are calibrated
against the examples themselves, each scored without itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import remainder, text_or_empty
from lakemart.llm.quality import logistic, training_rows

#: Characters around a word that are no part of it.
EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Documents' scores a worker remembers by their words; bounds memory, not the result.
REMEMBERED = 50_000
#: Blocks read before the nearest so far are compared with the bounds again; each wave is twice the one before.
FIRST_WAVE = 8


def terms_of(text: str | None) -> Counter:
    """Counts of the words of the whole text, A-Z lower-cased and without marks at their edges."""
    words = Counter((text or "").encode("utf-8", "replace").lower().split())
    terms: Counter = Counter()
    for word, many in words.items():
        stripped = word.strip(EDGES)
        if stripped:
            terms[stripped] += many
    return terms


@dataclass
class ToxicityModel:
    """``ids``, ``idf``: the vocabulary.

    The postings of all words lie one after the other in ``examples`` and ``values``, examples ascending;
    those of word t in block b are ``starts[t, b]`` to ``starts[t, b + 1]``, and ``maxima[t, b]`` is their
    largest weight.
    """

    ids: dict[bytes, int]
    idf: np.ndarray
    examples: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    maxima: np.ndarray
    labels: np.ndarray
    block: int
    nearest: int
    prior: float
    calibration: tuple[float, float]

    @property
    def postings(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(examples, weights) of every word."""
        return [(self.examples[s[0] : s[-1]], self.values[s[0] : s[-1]]) for s in self.starts]

    def vector(self, terms: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary ids and unit-length weights; both empty where no word is known."""
        found = sorted((self.ids[w], many) for w, many in terms.items() if w in self.ids)
        ids = np.array([i for i, _ in found], np.int64)
        weights = (1 + np.log(np.array([m for _, m in found], np.float64))) * self.idf[ids]
        return ids, weights / np.sqrt((weights**2).sum()) if len(ids) else weights

    def neighbours(self, ids: np.ndarray, weights: np.ndarray, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples by exact cosine, ties to the smaller example; those at cosine 0 are no neighbours."""
        bounds = weights @ self.maxima[ids]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        found = np.empty(0, np.int64)
        near = np.empty(0)
        wave = FIRST_WAVE
        while len(order):
            blocks, order = order[:wave], order[wave:]
            wave *= 2
            low = self.starts[ids[:, None], blocks].ravel()
            sizes = self.starts[ids[:, None], blocks + 1].ravel() - low
            places = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            products = np.repeat(np.repeat(weights, len(blocks)), sizes) * self.values[places]
            cosines = np.bincount(self.examples[places], products, len(self.labels))
            if leave >= 0:
                cosines[leave] = 0
            inside = np.flatnonzero(cosines > 0)
            found = np.append(found, inside)
            near = np.append(near, cosines[inside])
            if len(near) >= self.nearest:
                edge = -np.partition(-near, self.nearest - 1)[self.nearest - 1]
                found, near = found[near >= edge], near[near >= edge]
                order = order[bounds[order] >= edge - 1e-12]
            best = np.lexsort((found, -near))[: self.nearest]
            found, near = found[best], near[best]
        return found, near

    def vote(self, found: np.ndarray, near: np.ndarray) -> float:
        """Share of label 1 among the neighbours, the nearer the heavier, with the prior as one weak vote."""
        weight = 1 / (1.05 - np.minimum(near, 1))
        return float(((weight * self.labels[found]).sum() + self.prior) / (weight.sum() + 1))

    def score(self, terms: Counter) -> tuple[float, list[int]]:
        found, near = self.neighbours(*self.vector(terms))
        slope, shift = self.calibration
        logit = slope * np.log(max(self.vote(found, near), 1e-6)) + shift
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))), found.tolist()


def train(
    texts: Sequence[str | None], labels: Sequence[int], nearest: int = 15, block: int = 64, least_chi2: float = 20.0
) -> ToxicityModel:
    """Index and calibration from labelled examples; without both labels every score is the smoothed share of 1."""
    counted = [terms_of(t) for t in texts]
    truth = np.asarray(labels, np.float64).reshape(-1)
    many, toxic = len(truth), float(truth.sum())
    prior = (toxic + 0.5) / (many + 1)
    df: Counter = Counter()
    df_toxic: Counter = Counter()
    for terms, label in zip(counted, truth, strict=True):
        df.update(terms.keys())
        if label:
            df_toxic.update(terms.keys())
    chosen = []
    if 0 < toxic < many:
        for word, seen in df.items():
            if 3 <= seen < many:
                a = df_toxic[word]
                gap = a * many - seen * toxic
                if gap**2 * many / (seen * (many - seen) * toxic * (many - toxic)) >= least_chi2:
                    chosen.append(word)
    chosen.sort()
    model = ToxicityModel(
        {w: i for i, w in enumerate(chosen)},
        np.array([np.log((many + 1) / (df[w] + 0.5)) for w in chosen]),
        np.empty(0, np.int64),
        np.empty(0),
        np.empty(0, np.int64),
        np.empty(0),
        truth,
        block,
        nearest,
        prior,
        (1.0, 0.0),
    )
    vectors = [model.vector(terms) for terms in counted]
    lengths = [len(ids) for ids, _ in vectors]
    words = np.concatenate([np.empty(0, np.int64), *(ids for ids, _ in vectors)])
    order = np.argsort(words, kind="stable")
    model.examples = np.repeat(np.arange(many), lengths)[order]
    model.values = np.concatenate([np.empty(0), *(weights for _, weights in vectors)])[order]
    blocks = -(-many // block)
    cells = words[order] * blocks + model.examples // block
    ends = np.searchsorted(cells, np.arange(len(chosen))[:, None] * blocks + np.arange(blocks + 1)[None])
    model.starts = ends
    largest = np.zeros(len(chosen) * blocks)
    np.maximum.at(largest, cells, model.values)
    model.maxima = largest.reshape(len(chosen), blocks)
    if 0 < toxic < many:
        votes = np.array([model.vote(*model.neighbours(*v, leave=i)) for i, v in enumerate(vectors)])
        slope, shift = logistic(np.log(np.maximum(votes, 1e-6))[:, None], truth, ridge=0.1)
        model.calibration = (max(float(slope), 0.0), float(shift))
    else:
        model.calibration = (0.0, float(np.log(prior / (1 - prior))))
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 6000) -> ToxicityModel:
    """Examples are a documented, bounded sample of ``sample`` labelled rows."""
    rows = training_rows(docs, labels, label, sample)
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, evidence (the neighbours' numbers in the sample) of every row of ``docs``.

    A text without known words (NULL and empty ones too) has no neighbours and gets the calibrated
    prior.  A NULL doc_id is scored too; its held_out is NULL.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        known: dict[tuple, tuple[float, list[int]]] = {}
        for batch in batches:
            values, evidence = [], []
            for text in batch["text"]:
                terms = Counter({w: n for w, n in terms_of(text).items() if w in model.ids})
                key = tuple(sorted(terms.items()))
                if key not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[key] = model.score(terms)
                values.append(known[key][0])
                evidence.append(known[key][1])
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": values, "evidence": evidence}
            )

    held = (remainder("doc_id", 4) == 2).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held, text_or_empty()).mapInPandas(
        scores, "doc_id long, held_out boolean, score double, evidence array<int>"
    )
