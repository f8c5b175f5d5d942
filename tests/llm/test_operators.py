"""Each operator against brute force, and on nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import (
    ann,
    extraction,
    language_model,
    licenses,
    mixing,
    neardup,
    packing,
    quality,
    toxicity,
    winnowing,
)

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "All rights reserved. Licensed under CC BY 4.0, see there"),
    (2, "one two three four five six seven eight nine ten"),
    (3, "one two three four five six seven eight nine ten"),
    (4, ""),
    (5, None),
    (6, LONG),
    (7, LONG + " more"),
    (8, "Ünï cödé\tand GNU General Public License"),
    (8, "the same id again"),
    (None, "no id at all"),
    (9, "x"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture
def docs(frame):
    """The odd texts, with columns whose names clash with those the operators use inside."""
    out = frame(SCHEMA, *TEXTS).withColumn("source", F.lit("s"))
    for name in ("row", "score", "gram", "token", "sig", "mark", "part", "size", "label", "held_out", "count"):
        out = out.withColumn(name, F.lit("clash"))
    return out


@pytest.fixture
def empty(frame):
    return frame(SCHEMA + ", source string")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[50:80] = vectors[49]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    found = ann.search(table, table.where("vec_id % 20 = 0")).collect()
    hits = 0
    for q in range(0, 400, 20):
        exact = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        exact[q] = np.inf
        best = np.lexsort((np.arange(400), exact))[:10].tolist()
        mine = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
        hits += len(set(best) & {v for _, v in mine})
        assert [r for r, _ in mine] == list(range(1, len(mine) + 1))
    assert hits >= 0.9 * 200
    assert {r["query_id"] for r in found} == set(range(0, 400, 20))
    tied = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 60]
    assert tied == list(range(49, 59))


def test_search_of_nothing(frame):
    none = frame("vec_id long, embedding array<float>")
    assert ann.search(none, none).count() == 0


def test_search_counts_an_id_once_and_fills_up(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(12, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1, vectors[1].tolist())] * 15 + [(2, (vectors[2] + 1e-3 * i).tolist()) for i in range(15)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    narrow = ann.CrossPolytope(tables=1, probes=1)
    for spec in (ann.CrossPolytope(), narrow):
        found = ann.search(table, table.where("vec_id = 0"), spec=spec).collect()
        least = {}
        for i, v in rows:
            if i:
                least[i] = min(least.get(i, np.inf), float(np.linalg.norm(np.array(v) - vectors[0])))
        mine = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])]
        assert len(mine) == len(set(mine)) == 10
        if spec == narrow:
            assert mine == sorted(least, key=least.get)[:10]
    few = table.where("vec_id < 6")
    assert ann.search(few, few, spec=narrow).count() == 6 * 5


def test_hadamard_keeps_lengths():
    values = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(ann.hadamard(values), axis=1), np.linalg.norm(values, axis=1))
    assert np.allclose(ann.hadamard(ann.hadamard(values)), values)


def test_fill_is_the_best_sum():
    rng = np.random.default_rng(3)
    for _ in range(50):
        counts = np.zeros(61, np.int64)
        for length in rng.integers(1, 60, 6):
            counts[length] += 1
        room = int(rng.integers(1, 60))
        reach = {0}
        for length in np.flatnonzero(counts):
            for _ in range(counts[length]):
                reach |= {r + int(length) for r in reach if r + length <= room}
        used = packing.fill(counts, room)
        assert sum(length * many for length, many in used) == max(reach)
        assert all(many <= counts[length] for length, many in used)


def test_packing_round_trip(docs, empty):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    rows = packing.pack(docs, path).collect()
    tokenizer = Tokenizer.from_file(path)
    expected = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in TEXTS)
    by_doc = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        by_doc.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], np.uint32))
    single = {d: np.concatenate(p).tolist() for d, p in by_doc.items() if d != 8}
    assert all(ids in expected for ids in single.values())
    assert sum(r["length"] for r in rows) == sum(map(len, expected))
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048
    assert packing.pack(empty, path).count() == 0


def test_full_pool_cuts_pieces_of_one_length():
    packer = packing.Packer(2048)
    for i in range(packing.POOL + 500):
        packer.add(i, np.full(1500, i, np.uint32))
    before = packer.sequence
    assert before > 0
    packer.finish()
    ends, cover = Counter(), Counter()
    for doc_id, start, ids, tokens, sequence, offset in packer.rows:
        assert offset == ends[sequence] and (ids == doc_id).all() and tokens == 1500
        ends[sequence] += len(ids)
        cover.update((doc_id, at) for at in (start, start + len(ids)))
    assert sum(ends.values()) == 1500 * (packing.POOL + 500)
    assert [s for s, n in ends.items() if n < 2048] in ([], [packer.sequence - 1])
    assert all(cover[d, 0] == cover[d, 1500] == 1 for d in range(packing.POOL + 500))


def test_extraction(frame):
    shared = "<div><p>Subscribe to our letter today</p></div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{shared}<div><p>Own text &amp; number {i}</p></div></body>") for i in range(8)]
    rows += [
        (20, "http://a.example/", "<nav>menu</nav><article><h1>T</h1><p>A <b>b</b>\n c<br>d</p></article><footer>f</footer>"),
        (21, None, None),
        (22, "x", ""),
        (23, "x", "<p>open <script>var a='<p>no</p>'</script><div class='ad'>buy</div>&lt;tag&gt;"),
        (24, "x", "<article><p>" + "long " * 50_000 + "</p><div id='comments'><p>first!</p></div></article>"),
    ]
    pages = frame("page_id long, url string, html string", *rows).withColumn("token", F.lit("clash"))
    found = {r["page_id"]: r["text"] for r in extraction.extract(pages).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == f"Own text & number {i}" for i in range(8))
    assert found[20] == "T A b c d"
    assert found[21] == found[22] == ""
    assert found[23] == "open <tag>"
    assert found[24] == ("long " * 50_000).strip()
    assert extraction.extract(frame("page_id long, url string, html string")).count() == 0


def test_extraction_takes_slots_from_tested_classes(frame):
    def page(i):
        notice = "<section><h4>Subscribe</h4><p>Every week</p></section>" if i % 3 else ""
        part = "<h2>Summary</h2>" if i % 2 else "<h2>Other</h2>"
        main = f"<article><p>Own {i}</p>{part}<div><b>Share this</b></div><p>More {i}</p></article>"
        return f"<html><body>{notice}<div><p>Top</p></div>{main}</body></html>"

    def plain(i):
        return f"<body><div><p>Top line</p></div><div><p>Text {i}</p></div>{'<section><p>Often</p></section>' if i % 4 else ''}</body>"

    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://b.example/{i}", "<body><p>One text</p><p>copied</p></body>") for i in range(9)]
    rows += [(200 + i, f"http://c.example/{i}", plain(i)) for i in range(8)]
    found = {r["page_id"]: r["text"] for r in extraction.extract(frame("page_id long, url string, html string", *rows)).collect()}
    # The template bounds an article too; a heading that many pages share is no class of its own.
    assert all(found[i] == f"Own {i} {'Summary' if i % 2 else 'Other'} More {i}" for i in range(12))
    # Copies of one page are no host of many pages.
    assert all(found[100 + i] == "One text copied" for i in range(9))
    # A part that stands on most pages is a class nested in the root's gap.
    assert all(found[200 + i] == f"Text {i}" for i in range(8))


def test_classes_are_ordered_and_nested():
    found = {r: (1, 3, 9) for r in (1, 2, 3)} | {r: (2, 3, 5) for r in (4, 5, 6)}
    ranks, crossed = extraction.tested([1, 4, 5, 6, 9, 2, 3, 4, 5, 6], found)
    assert not crossed and all(low == high == (role - 1) % 3 for role, (low, high) in ranks.items())
    assert extraction.tested([1, 4, 2, 5, 6, 3], found)[1] == {(2, 1)}
    assert extraction.tested([4, 1, 5, 2, 6, 3], found)[1] == {(2, 1)}
    assert extraction.tested([1, 2, 3, 2, 1, 3], found)[0][1] == (0, 1)
    assert extraction.tested([1, 2, 2, 3, 3, 1], found)[0][2][0] == -1
    valid = {1: (1, 0, 3), 2: (1, 1, 3), 3: (1, 2, 3)}
    first, second, third = (extraction.refined(r, valid) for r in ([1, 7, 2, 3], [1, 2, 7, 3], [1, 2, 3, 7]))
    assert len({first[1], second[2], third[3]}) == 3 and first[0] == 1


def test_licenses(docs, empty, frame):
    found = {r["doc_id"]: r for r in licenses.scan(docs).where("doc_id <> 8").collect()}
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["last_word"]) == (2, 0, 5)
    assert found[1]["base_labels"] == "cc-by,reserved"
    assert found[4]["n_words"] == found[5]["n_words"] == 0 and found[4]["first_word"] is None
    assert found[6]["n_words"] == 30_000 and found[6]["score"] == 0
    assert licenses.scan(docs).count() == len(TEXTS)
    near = frame(SCHEMA, (1, "This is licensed under the Apache software License, Version 2.0 now"), (2, "cc by cc by"))
    by_id = {r["doc_id"]: r for r in licenses.scan(near).collect()}
    assert by_id[1]["labels"] == "apache-2.0" and by_id[1]["n_base"] == 0
    assert by_id[2]["n_base"] == 2 and by_id[2]["last_word"] == 2
    assert licenses.scan(empty).count() == 0


def test_licenses_need_different_grams_in_order(frame):
    mit = "released under the mit license"
    shuffled = "mit license the mit under the released under"
    clean = [(1, "under the under the under the"), (2, "public license " * 10), (3, shuffled)]
    found = licenses.scan(frame(SCHEMA, *clean)).collect()
    assert all(r["labels"] == "" and r["score"] == 0 and r["spans"] == [] for r in found)
    real = [(4, f"under the under the {mit} under the {mit}"), (5, "it is released under the new mit license")]
    by_id = {r["doc_id"]: r for r in licenses.scan(frame(SCHEMA, *real)).collect()}
    assert [tuple(s) for s in by_id[4]["spans"]] == [("mit", 4, 9, 1.0), ("mit", 11, 16, 1.0)]
    assert [tuple(s) for s in by_id[5]["spans"]] == [("mit", 2, 8, 0.75)]


def test_language_model(docs, empty):
    rows = language_model.score(docs).collect()
    held = {d: None if d is None else zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in TEXTS}
    counts = Counter()
    for d, t in TEXTS:
        if held[d] is False:
            counts.update([*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (
            len(words(t)) + 1,
            sum(counts[w] > 0 for w in [*words(t), None]),
            round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in [*words(t), None]), 4),
        )
        for _, t in TEXTS
    )
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == expected
    assert all(r["train_tokens"] == total and r["held_out"] == held[r["doc_id"]] and r["score"] < 0 for r in rows)
    assert language_model.score(empty).count() == 0


def test_rare_words_meet_exact_counts_by_join(docs):
    few = language_model.score(docs, language_model.BloomSpec(heavy=10)).select("doc_id", F.round("base_score", 6)).collect()
    all_ = language_model.score(docs).select("doc_id", F.round("base_score", 6)).collect()
    assert sorted(few, key=repr) == sorted(all_, key=repr)


def test_filter_never_loses_a_count(spark):
    rng = np.random.default_rng(2)
    grams = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    counts = rng.integers(1, 500, 3000)
    table = spark.createDataFrame(list(zip(grams.astype(np.int64).tolist(), counts.tolist())), "gram long, count long")
    read = language_model.build_filter(table, language_model.BloomSpec()).counts(grams)
    assert (read >= counts / 1.5 - 1e-9).all()
    assert np.median(read / counts) < 1.6




def test_winnowing(spark, docs, empty, frame):
    rows = winnowing.fingerprints(docs.where("doc_id <> 8 or doc_id is null")).collect()
    texts = [(d, t or "") for d, t in TEXTS if d != 8]
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0)))
    found = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        many = len(t) // 3
        edited = t[: len(t) - many] + following[:many]
        assert found[d]["n_chars"] == len(t)
        assert found[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert found[2]["fingerprint"] == found[3]["fingerprint"] and found[3]["near_next"] == 1.0
    assert found[4]["fingerprint"] == "" and found[9]["fingerprint"] != ""
    assert winnowing.fingerprints(empty).count() == 0
    assert winnowing.fingerprints(docs).count() == len(TEXTS)


def test_winnowing_chooses_the_rightmost_smallest(frame):
    text = " ".join(f"w{i % 7}" for i in range(60)) + " " + " ".join(f"v{i}" for i in range(40))
    chosen = winnowing.places_of(winnowing.winnow(F.col("text")))
    numbers = winnowing.winnow(F.col("text"), winnowing.GRAM, 1)
    row = frame("text string", (text,)).select(chosen.alias("c"), winnowing.places_of(numbers).alias("all")).first()
    hashes = [c["hash"] for c in sorted(row["all"], key=lambda c: c["place"])]
    assert len(hashes) == 100 - winnowing.GRAM + 1
    expected = set()
    for start in range(len(hashes) - winnowing.WINDOW + 1):
        part = hashes[start : start + winnowing.WINDOW]
        expected.add(start + max(i for i, h in enumerate(part) if h == min(part)))
    assert {c["place"] for c in row["c"]} == expected


def test_exact_neighbours():
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        some = [f"c{j}" for j in rng.integers(0, 30, 20)] + [f"{'bad' if toxic else 'good'}{j}" for j in rng.integers(0, 6, 3)]
        texts.append(" ".join(some))
        labels.append(int(toxic))
    model = toxicity.train(texts, labels, block=16)
    for text in texts[:40]:
        ids, weights = model.vector(toxicity.terms_of(text))
        dense = np.zeros(len(labels))
        for t, w in zip(ids, weights):
            examples, values = model.postings[t]
            dense[examples] += w * values
        found, near = model.neighbours(ids, weights)
        assert np.allclose(near, np.sort(dense)[::-1][: model.nearest])
    assert model.score(toxicity.terms_of("bad1 bad2 c3"))[0] > 0.3 > model.score(toxicity.terms_of("good1 c3"))[0]


def labelled(frame):
    rows, labels = [], []
    rng = np.random.default_rng(6)
    for i in range(400):
        poor, toxic = i % 5 == 0, i % 7 == 0
        some = [f"word{j}" for j in rng.integers(0, 400, 60)] + (["idiot", "worthless"] if toxic else [])
        rows.append((i, " ".join(w.upper() + "!!" if poor else w for w in some)))
        labels.append((i, int(not poor), int(toxic)))
    return frame(SCHEMA, *rows), frame("doc_id long, quality int, toxic int", *labels)


@pytest.mark.parametrize("module, label, least", [(toxicity, "toxic", 0.3), (quality, "quality", 0.7)])
def test_classifiers_on_held_out_rows(frame, docs, empty, module, label, least):
    texts, labels = labelled(frame)
    model = module.fit(texts, labels)
    scored = module.score(texts, model).join(labels, "doc_id").where("held_out").collect()
    assert sum((r["score"] >= least) == bool(r[label]) for r in scored) >= 0.95 * len(scored)
    odd = module.score(docs, model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in odd)
    assert module.score(empty, model).count() == 0
    unlabelled = module.fit(empty, frame("doc_id long, quality int, toxic int"))
    assert all(r["score"] == 0.5 for r in module.score(docs, unlabelled).collect())


def test_network_reads_the_whole_text():
    filters = np.zeros((2, 256, 1), np.float32)
    filters[0, ord("#"), 0] = 1
    text = b"a" * (quality.STRIDE * quality.STRIDES_AT_ONCE + 5000) + b"#b"
    assert quality.pooled(text, filters, np.zeros(1, np.float32)).max() == 1


def test_near_duplicates_against_brute_force(spark, docs, empty):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    rows = []
    for i in range(60):
        some = list(base) if i % 2 else [f"w{j}" for j in rng.integers(0, 5000, 200)]
        for place in rng.integers(0, len(some), int(i % 6)):
            some[place] = f"x{i}y{place}"
        rows.append((i, " ".join(some)))
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert found == root
    odd = neardup.near_duplicates(docs).collect()
    assert len(odd) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in odd}
    assert by_id[3]["component_id"] == 2 and by_id[7]["component_id"] == 6 and by_id[5]["n_shingles"] == 0
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert neardup.near_duplicates(empty).count() == 0


def test_neardup_blocks_need_sets_of_surviving_pairs_only(frame):
    spec = neardup.NearDup()
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.integers(1, 2**63, 200, dtype=np.uint64)) for _ in range(60)]
    near = [np.sort(np.concatenate([s[:190], rng.integers(1, 2**63, 10, dtype=np.uint64)])) for s in sets[:5]]
    sets += [*near, *near[:2]]
    sigs = [neardup.signature(s, spec.hashes).tobytes() for s in sets]
    comps = [*range(65), 0, 1]
    rows = [(7, 0, i, comps[i], 0, True, 0, bytearray(sigs[i]), bytearray(s.tobytes())) for i, s in enumerate(sets)]
    schema = "bucket long, pair long, rep long, comp long, side int, within boolean, band int, sig binary, shingles binary"
    members = frame(schema, *rows)
    needed = neardup.open_classes(members.drop("shingles"), spec)
    found = {r["rep"] for r in needed.collect()}
    assert found == {*range(5), *range(60, 67)}
    some = members.join(needed, ["bucket", "pair", "rep"], "left_semi")
    whole, part = ({tuple(r) for r in neardup.block_links(m, spec).collect()} for m in (members, some))
    assert whole == part and len(whole) == 5


def test_mixing(frame, docs, empty):
    rows = [(i, " ".join(["w"] * (i % 9 + 1)), ["a", "b", "c", None][i % 4]) for i in range(200)]
    out = mixing.mix(frame("doc_id long, text string, source string", *rows)).collect()
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    target = {source[r["doc_id"]]: r["target"] for r in out}
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert mixing.mix(docs).count() == len(TEXTS)
    assert mixing.mix(empty).count() == 0


def test_pipeline_stages(spark, tmp_path, frame):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    texts, labels = labelled(frame)
    texts = texts.union(texts.where("doc_id < 50").selectExpr("doc_id + 1000", "text"))
    full = texts.selectExpr("doc_id", "text", "'en' lang", "concat('s', doc_id % 3) source", "length(text) n_chars")
    full.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "near_duplicates":
            assert docs.where("doc_id >= 1000").count() == 0
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[4] > sizes[3]


def test_pipeline_decides_for_rows(spark, frame, monkeypatch):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    prose = " ".join(f"w{i}" for i in range(40))
    pairs = [(None, f"good {prose}"), (None, "bad words"), (7, f"good {prose}"), (7, "bad seven"), (None, f"good {prose}")]
    docs = frame(schema, *[(i, t, "en", "s", len(t)) for i, t in pairs])

    def scored(rows, model):
        return rows.select("doc_id", F.when(F.col("text").startswith("good"), 1.0).otherwise(0.0).alias("score"))

    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    monkeypatch.setattr(corpus_pipeline.quality, "fit", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline.quality, "score", scored)
    monkeypatch.setattr(corpus_pipeline.toxicity, "fit", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline.toxicity, "score", lambda r, m: scored(r, m).withColumn("score", 1 - F.col("score")))
    for stage in (corpus_pipeline.good_quality, corpus_pipeline.not_toxic):
        kept = stage(spark, docs, "").collect()
        assert sorted(r["text"][:4] for r in kept) == ["good"] * 3
    one = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"][:4]) for r in one if r["doc_id"]) == [(7, "bad "), (7, "good")]
    assert [r["text"] for r in one if r["doc_id"] is None] == ["bad words"]
    # 3 of 4 words twice, the rest once: each row as often as it was taken itself.
    mixed = corpus_pipeline.mixed(spark, frame(schema, *[(None, "w " * 10, "en", "s", 20)] * 4), "").count()
    assert mixed == 6
