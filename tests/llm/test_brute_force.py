"""Parts of operators held against plain versions of themselves."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import licenses, mixing, packing, quality, winnowing

SCHEMA = "doc_id long, text string"

# ---------------------------------------------------------------- mixing


def best_flow(capacity, quota, costs):
    """(words sent, least cost) over all ways to deal whole words of patterns to their sources."""
    ways = [{}]
    for pattern, words in capacity.items():
        most = words * len(costs)
        splits = [s for s in itertools.product(range(most + 1), repeat=len(pattern)) if sum(s) <= most]
        ways = [{**w, pattern: s} for w in ways for s in splits]
    best = (0, 0)
    for way in ways:
        got = Counter()
        cost = 0
        for pattern, split in way.items():
            for source, words in zip(pattern, split):
                got[source] += words
            sent, words = sum(split), capacity[pattern]
            cost += sum(c * min(max(sent - k * words, 0), words) for k, c in enumerate(costs))
        if all(got[s] <= q for s, q in enumerate(quota)):
            best = max(best, (sum(got.values()), -cost))
    return best[0], -best[1]


def test_flow_is_the_cheapest_of_the_largest():
    rng = np.random.default_rng(1)
    for _ in range(60):
        patterns = [(0,), (1,), (0, 1)][: int(rng.integers(1, 4))]
        capacity = {p: int(rng.integers(0, 4)) for p in patterns}
        quota, costs = [int(q) for q in rng.integers(0, 7, 2)], [0, 1]
        flow = mixing.min_cost_flow(capacity, quota, costs)
        sent, got = Counter(), Counter()
        for (pattern, source), words in flow.items():
            assert source in pattern and words > 0
            sent[pattern] += words
            got[source] += words
        assert all(got[s] <= q for s, q in enumerate(quota))
        cost = sum(c * min(max(sent[p] - k * w, 0), w) for p, w in capacity.items() for k, c in enumerate(costs))
        assert all(sent[p] <= 2 * w for p, w in capacity.items())
        assert (sum(sent.values()), cost) == best_flow(capacity, quota, costs)


def test_targets_share_by_weight_up_to_the_cap():
    rng = np.random.default_rng(2)
    for _ in range(200):
        many = int(rng.integers(1, 7))
        sizes = rng.integers(0, 50, many).tolist()
        weights = rng.choice([5, 2, 1], many).tolist()
        targets = mixing.capped_targets(sizes, weights, 1.5, 2)
        # The level at which the capped shares add up, found by halving.
        low, high = 0.0, 1e6
        for _ in range(100):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(min(middle * w, 2 * s) for s, w in zip(sizes, weights)) < 1.5 * sum(sizes) else (low, middle)
        assert np.allclose(targets, [min(low * w, 2 * s) for s, w in zip(sizes, weights)], atol=1e-5)


def test_overlapping_sources_ties_and_reruns(spark):
    lists = [["a"], ["b"], ["a", "b"], ["b", "a", "a"], [], None, ["c", None]]
    rows = [(None if i % 11 == 0 else i % 40, "w " * (i % 5), lists[i % 7], i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>, row long")
    first = {r["row"]: r for r in mixing.mix(docs, carry="row").collect()}
    again = {r["row"]: r for r in mixing.mix(docs.repartition(7), carry="row").collect()}
    assert len(first) == 300 and {k: r["taken"] for k, r in first.items()} == {k: r["taken"] for k, r in again.items()}
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["size"] == i % 5 for i, r in first.items())
    words, taken = Counter(), Counter()
    for i, r in first.items():
        pattern = tuple(sorted({s or "-" for s in (lists[i % 7] or [None])}))
        words[pattern] += r["size"]
        taken[pattern] += r["taken"]
    names = sorted({n for p in words for n in p}, key=lambda n: (n == "-", n))
    sizes = [sum(w for p, w in words.items() if n in p) for n in names]
    share = 1.5 * sum(words.values()) / sum(sizes)
    targets = mixing.capped_targets(sizes, [5, 2, 1, 5][: len(names)], share, 2)
    capacity = {tuple(sorted(names.index(n) for n in p)): w for p, w in words.items()}
    flow = mixing.min_cost_flow(capacity, [int(t + 0.5) for t in targets], [0, 1])
    for pattern, amount in taken.items():
        key = tuple(sorted(names.index(n) for n in pattern))
        assert amount == sum(w for (p, _), w in flow.items() if p == key)


# ---------------------------------------------------------------- quality


def test_network_against_plain_loops():
    rng = np.random.default_rng(3)
    filters = rng.normal(size=(3, 256, 2)).astype(np.float32)
    bias = rng.normal(size=2).astype(np.float32)
    model = quality.QualityModel(filters, bias, rng.normal(size=7), np.full(7, 0.7), rng.normal(size=7), 0.2)
    for length in (0, 1, 2, 3, quality.STRIDE - 1, quality.STRIDE + 2, 3 * quality.STRIDE + 17):
        text = bytes(rng.integers(32, 127, length).astype(np.uint8)).decode()
        data = text.encode().ljust(3, b"\0")
        answers = [
            [max(0.0, sum(float(filters[j, data[at + j], f]) for j in range(3)) + float(bias[f])) for f in range(2)]
            for at in range(len(data) - 2)
        ]
        strides = [np.max(answers[at : at + quality.STRIDE], axis=0) for at in range(0, len(answers), quality.STRIDE)]
        chunks = [np.maximum(a, b) for a, b in zip(strides, strides[1:])] or strides
        features = np.concatenate([np.mean(chunks, 0), np.max(chunks, 0), np.min(chunks, 0), [np.log1p(len(text.encode()))]])
        logit = ((features - model.center) / model.scale) @ model.weights + model.intercept
        assert quality.probability(text, model) == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-4)


# ---------------------------------------------------------------- licenses


def test_base_columns_against_a_plain_scan(spark):
    rng = np.random.default_rng(4)
    vocabulary = "cc by CC BY general public license all rights reserved the Ünï".split()
    texts = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 60)))).replace(" the ", rng.choice([" - ", "\n", " the "]))) for i in range(80)]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(texts, SCHEMA)).collect()}
    for i, text in texts:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.encode().split()
            here = [at for at in range(len(words) - len(parts) + 1) if words[at : at + len(parts)] == parts]
            places += here
            labels |= {label} if here else set()
        row = found[i]
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(words), len(places), ",".join(sorted(labels)))
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(filter(None, row["labels"].split(",")))


# ---------------------------------------------------------------- fingerprints


def test_likeness_is_the_shared_part_of_the_fingerprints(spark):
    rng = np.random.default_rng(5)
    base = [f"w{j}" for j in rng.integers(0, 60, 200)]
    texts = [(i, " ".join(base[: int(rng.integers(0, 200))])) for i in range(30)]
    rows = {r["doc_id"]: r for r in winnowing.fingerprints(spark.createDataFrame(texts, SCHEMA)).collect()}

    def marks(text):
        return {text[i : i + 8] for i in range(0, len(text), 8)}

    def near(left, right):
        return len(left & right) / len(left | right) if left | right else 1.0

    for i, row in rows.items():
        mine = marks(row["fingerprint"])
        assert row["near_edited"] == pytest.approx(near(mine, marks(row["edited_fingerprint"])))
        assert row["near_next"] == pytest.approx(near(mine, marks(rows[i - 1 if i else 29]["fingerprint"])))


# ---------------------------------------------------------------- packing


def test_ids_are_the_same_whatever_is_remembered(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("word_bpe_49k.json")
    rng = np.random.default_rng(6)
    texts = [" ".join(f"word{int(j)}" + "x" * int(j % 90) for j in rng.integers(0, 300, 40)) for _ in range(30)] + ["", "a\nb  c", "y" * 5000]
    plain = packing.WordIds(path)
    whole = [plain.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 4000)
    small = packing.WordIds(path)
    for _ in range(2):
        assert [ids.tolist() for at in range(0, len(texts), 4) for ids in small.encode(texts[at : at + 4])] == whole
    assert all(len(w) <= packing.REMEMBERED_LENGTH for w in small.known)


def test_packing_digest_is_the_crc_of_the_ids(spark):
    public = pytest.importorskip("public_tokenizers")
    import zlib

    docs = spark.createDataFrame([(i, "some words here " * (i * 40)) for i in range(12)], SCHEMA)
    pieces = packing.pack(docs, public.path("word_bpe_49k.json")).withColumn("crc", F.crc32("ids")).collect()
    assert all(r["crc"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] for r in pieces)
