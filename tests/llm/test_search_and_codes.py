"""Ranked search, decontamination and vector codes against brute force and on odd input."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import decontamination, ranked_search, vector_codes
from lakemart.llm.common import materialize

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASHES = ("item", "term", "rank", "df", "n_words", "hits", "items", "whole", "code", "dist", "sums", "part")


def clash(df):
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


def lowered(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]


# ---------------------------------------------------------------- ranked search


def ranked(docs, items, k):
    """Brute force over (doc_id, text) and (item_id, text)."""
    counted = [(d, Counter(lowered(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    N, L = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            m = 10 + (90 * c.total() * N) // L
            score = 0
            for term in set(lowered(text)):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1)))
                    score += w * ((10**9 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(docs, items, k=10):
    index = materialize(ranked_search.build_index(docs))
    rows = ranked_search.search(index, items, k).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=repr)


def corpus(many, seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: " ".join(f"W{int(x)}" for x in rng.zipf(1.3, n) % 400)
    docs = [(i, draw(int(rng.integers(1, 60)))) for i in range(many)]
    docs += [(many + i, docs[i % 7][1]) for i in range(40)]  # ties
    return docs, [(i, draw(12)) for i in range(15)]


def test_search_against_brute_force(spark, monkeypatch):
    docs, items = corpus(900, 1)
    docs += [(None, docs[3][1]), (None, docs[3][1]), (3, "w1 w2 w2"), (5000, ""), (5001, None), (5002, "!?"), (5003, "w7 " * 70_000)]
    items += [(100, None), (101, ""), (102, "nowhere at all"), (0, "w3 W3 w4"), (None, "w5 w6"), (103, docs[3][1])]
    table = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = clash(spark.createDataFrame(items, "item_id long, text string"))
    expected = ranked(docs, items, 10)
    assert found(table, asked) == expected
    # The same rows whatever the size of shards, blocks, waves and rounds of queries.
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 1500)
    assert found(table, asked) == expected
    assert found(table, asked, 3) == [r for r in expected if r[1] <= 3]


@pytest.mark.parametrize("block, wave", [(1, 7), (5, 64), (128, 100_000)])
def test_a_shard_ranks_as_brute_force(block, wave, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "WAVE", wave)
    docs, items = corpus(700, block)
    shard, numbers = open_shard(docs)
    for item, text in items:
        rows, weights = weighed(shard, text)
        top, scores = shard.best(rows, weights, 10)
        assert [(item, i + 1, int(shard.ids[d]), int(s)) for i, (d, s) in enumerate(zip(top, scores))] == sorted(
            (r for r in ranked(docs, [(item, text)], 10)), key=lambda r: r[1]
        )


def open_shard(docs):
    import pyarrow as pa

    numbers = ranked_search.Numbers()
    words = [[w.encode() for w in lowered(t)] for _, t in docs]
    flat = np.array([numbers[w] for text in words for w in text], np.int32)
    rows = ranked_search.shard_rows(0, list(numbers), flat, [d for d, _ in docs], np.array([len(w) for w in words]))
    total = sum(map(len, words))
    return ranked_search.Shard(pa.Table.from_batches([rows]), len(docs), total), numbers


def weighed(shard, text):
    rows = [i for i, t in enumerate(shard.terms) if t in set(lowered(text))]
    df = shard.df[rows]
    weights = np.floor(1000 * np.log((2 * len(shard.ids) + 2) / (2 * df + 1))).astype(np.int64)
    return np.array(rows)[weights > 0], weights[weights > 0]


def test_blocks_are_rejected_before_they_are_read(monkeypatch):
    """A frequent term beside a rare one: candidates come from the rare list, few blocks of the other are read."""
    monkeypatch.setattr(ranked_search, "WAVE", 64)
    docs = [(i, "common " * (1 + i % 3) + ("rare " * 5 if i % 199 == 0 else "filler other")) for i in range(4000)]
    shard, _ = open_shard(docs)
    rows, weights = weighed(shard, "common rare")
    weights = np.where(np.array(shard.terms)[rows] == "common", 1, weights) if len(rows) == 2 else weights
    every = np.array([i for i, t in enumerate(shard.terms) if t in ("common", "rare")])
    top, _ = shard.best(every, np.where(np.array(shard.terms)[every] == "rare", 5000, 20), 10)
    assert set(top.tolist()) <= set(range(0, 4000, 199))
    blocks = sum(-(-int(n) // ranked_search.BLOCK) for n in shard.df[every])
    assert len(shard.read) < blocks


def test_postings_survive_packing():
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"t{int(x)}" for x in rng.integers(0, 30, 20)) + " big" * (300 if i == 5 else 70_000 if i == 900 else 0)) for i in range(1500)]
    shard, _ = open_shard([(i, t) for i, t in docs])
    for row, term in enumerate(shard.terms):
        ids, values = shard.between(row, 0, len(docs))
        expected = {i: lowered(t).count(term) for i, t in docs if term in lowered(t)}
        assert ids.tolist() == sorted(expected)
        assert values.tolist() == [10**9 * n // (1000 * n + 8 * int(shard.m[i])) for i, n in sorted(expected.items())]
        most = shard.block_most[shard.block_start[row] : shard.block_end[row]]
        parts = [values[i : i + ranked_search.BLOCK].max() for i in range(0, len(values), ranked_search.BLOCK)]
        assert most.tolist() == parts  # impacts hold each block's exact maximum


def test_search_of_nothing(spark, frame):
    none = frame("doc_id long, text string")
    items = frame("item_id long, text string", (1, "a b"))
    assert found(none, items) == []
    assert found(frame("doc_id long, text string", (1, "a b c"), (2, None), (3, "d")), frame("item_id long, text string")) == []


# ---------------------------------------------------------------- decontamination


def hits(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = lowered(text)
        many = min(window, len(words))
        for i in range(len(words) - many + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + many]), set()).add(item)
    out = []
    for doc_id, text in docs:
        words, hit, met = lowered(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                ids = windows.get(tuple(words[i : i + size]))
                if ids:
                    hit.update(range(i, i + size))
                    met |= ids
        met.discard(None)
        names = ",".join(sorted(map(str, met)))
        digest = hashlib.sha256(names.encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(met), digest, bool(hit)))
    return sorted(out, key=repr)


QUESTION = "What is the Capital of the very old land beyond the hills, and who lives there?"


def contaminated_texts():
    rng = np.random.default_rng(4)
    fill = lambda n: " ".join(f"f{int(x)}" for x in rng.integers(0, 50, n))
    part = " ".join(QUESTION.split()[:11])
    docs = [(i, fill(40)) for i in range(30)]
    docs += [
        (100, f"{fill(5)} {QUESTION.upper()} {fill(5)}"),
        (101, f"{part}\n\t{part}"),
        (102, "Ünï yes and yes cödé"),
        (103, " ".join(QUESTION.split()[:9])),
        (104, None),
        (105, ""),
        (106, "... !!"),
        (107, "the " * 60_000 + QUESTION + " yes" * 3),
        (107, "yesterday eyes"),
        (None, QUESTION),
        (108, "what-is/the capital_of THE very old land" + " beyond the hills"),
        (109, "a a a a a a a a a a a a a a"),
    ]
    items = [(1, QUESTION), (12, QUESTION), (3, "Yes!"), (4, None), (5, ""), (3, "cödé"), (None, "f1 f2"), (6, "a " * 12), (7, "the the")]
    return docs, items


@pytest.mark.parametrize("chars", [4_000_000, 120])
def test_hits_against_brute_force(spark, chars, monkeypatch):
    monkeypatch.setattr(decontamination, "AUTOMATON_CHARS", chars)  # several automata must tell the same as one
    docs, items = contaminated_texts()
    table = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = clash(spark.createDataFrame(items, "item_id long, text string"))
    rows = decontamination.contamination(table, asked).collect()
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == hits(docs, items)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 107}
    text = dict(docs)[100]
    (span,) = by_id[100]["spans"]
    assert text[span["start"] : span["end"]] == QUESTION.upper().rstrip("?")
    text = dict(docs)[102]
    assert [text[s["start"] : s["end"]] for s in by_id[102]["spans"]] == ["yes", "yes cödé"]
    assert by_id[103]["n_hit"] == 0 and by_id[108]["contaminated"]


def test_nothing_to_scan(frame):
    docs, items = "doc_id long, text string", "item_id long, text string"
    assert decontamination.contamination(frame(docs), frame(items, (1, "a b"))).count() == 0
    (row,) = decontamination.contamination(frame(docs, (1, "a b")), frame(items)).collect()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)


# ---------------------------------------------------------------- vector codes


def lloyd(rows, spec):
    """Plain Lloyd with full scans over (id, label, vector), ids different."""
    rows = [(i, label, [math.floor(1024 * x) for x in v]) for i, label, v in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(rows[0][2]) // spec.parts
    out = {r[0]: [[], 0] for r in rows}
    numbers = []
    for part in range(spec.parts):
        mine = [np.array(r[2][part * width : (part + 1) * width], object) for r in rows]
        book = [m.tolist() for m in mine[: spec.entries]]
        for turn in range(spec.rounds + 1):
            codes, near = [], []
            for m in mine:
                far = [sum((a - b) ** 2 for a, b in zip(m, e)) for e in book]
                codes.append(far.index(min(far)))
                near.append(min(far))
            if turn < spec.rounds:
                for e in range(len(book)):
                    held = [m for m, c in zip(mine, codes) if c == e]
                    if held:
                        book[e] = [sum(column) // len(held) for column in zip(*held)]
        for r, c, d in zip(rows, codes, near):
            out[r[0]][0].append(c)
            out[r[0]][1] += d
        numbers += [x for e in book for x in e]
    labels = Counter()
    for i, label, _ in rows:
        labels[label] += out[i][1]
    digest = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
    return {i: ("".join(f"{c:02x}" for c in out[i][0]), out[i][1], labels[label], digest) for i, label, _ in rows}


def coded(spark, df, spec):
    rows = vector_codes.report(spark, *vector_codes.compress(df, spec)).collect()
    return rows, {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in rows}


@pytest.mark.parametrize("entries, size", [(9, 1.0), (256, 1.0), (6, 3e5)])
def test_codes_equal_plain_lloyd(spark, entries, size):
    rng = np.random.default_rng(entries)
    # Few different values: many equal distances; size 3e5 leaves the range doubles hold exactly.
    rows = [(i, ["a", "b", None][i % 3], (rng.integers(-3, 4, 8) * 0.25 * size).tolist()) for i in range(120)]
    rows[7] = (7, "b", [0.0] * 8)
    spec = vector_codes.CodeSpec(entries=entries)
    schema = "vec_id long, label string, embedding array<double>"
    odd = [(900, "a", None), (901, "a", [None] + [1.0] * 7), (902, "b", [float("nan")] * 8), (903, "b", [float("inf")] * 8)]
    table = clash(spark.createDataFrame(rows + odd, schema)).repartition(5)
    assert coded(spark, table, spec)[1] == lloyd(rows, spec)


def test_active_scans_compare_less_and_tell_the_same():
    rng = np.random.default_rng(2)
    points, entries = rng.integers(-9, 9, (3000, 4)), rng.integers(-9, 9, (64, 4))
    everything = np.ones(64, bool)
    unset = np.full(3000, -1)
    code, dist, full = vector_codes.assign(points, entries, everything, unset, np.zeros(3000, np.int64))
    assert full == 3000 * 64
    later = entries.copy()
    moved = np.zeros(64, bool)
    moved[[3, 40]] = True
    later[[3, 40]] += [[1], [-2]]
    fast = vector_codes.assign(points, later, moved, code, dist)
    slow = vector_codes.assign(points, later, everything, unset, dist)
    assert (fast[0] == slow[0]).all() and (fast[1] == slow[1]).all() and fast[2] < 0.15 * full


def test_codes_of_odd_rows(spark, frame):
    schema = "vec_id long, label int, embedding array<float>"
    assert vector_codes.report(spark, *vector_codes.compress(frame(schema))).count() == 0
    rows, _ = coded(spark, frame(schema, (1, 1, [1.0, 2.0, 3.0])), vector_codes.CodeSpec())
    assert [(r["vec_id"], r["code"], r["error"]) for r in rows] == [(1, None, None)]
    same = [(5, 1, [0.5] * 4)] * 3 + [(None, None, [1.0] * 4), (6, 2, [0.0] * 8)]
    rows, _ = coded(spark, frame(schema, *same), vector_codes.CodeSpec())
    assert sorted((r["vec_id"] or 0, r["code"] or "", r["error"]) for r in rows if r["vec_id"] != 6) == [
        (0, "03030303", 0), *[(5, "00000000", 0)] * 3
    ]
    assert [(r["code"], r["error"], r["label_error"]) for r in rows if r["vec_id"] == 6] == [(None, None, None)]
