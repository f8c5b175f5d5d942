"""The operators as named queries over the driver tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    ann,
    decontamination,
    extraction,
    language_model,
    licenses,
    mixing,
    neardup,
    packing,
    quality,
    ranked_search,
    toxicity,
    vector_codes,
    winnowing,
)
from lakemart.llm.common import materialize, table

#: Least scores of label 1.
LEAST_TOXIC = 0.3
LEAST_QUALITY = 0.7


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 100 = 0"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(*[c for c in pieces.columns if c != "ids"], F.crc32("ids").alias("ids_crc32"))


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= LEAST_TOXIC).cast("int"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= LEAST_QUALITY).cast("int"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("pattern")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = materialize(ranked_search.build_index(table(spark, sf_dir, "documents")))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(spark, *vector_codes.compress(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ann,
        op2_packing,
        op3_extraction,
        op4_licenses,
        op5_language_model,
        op6_winnowing,
        op7_toxicity,
        op8_quality,
        op9_neardup,
        op10_mixing,
        op11_ranked_search,
        op12_decontamination,
        op13_vector_codes,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Sets of shingles compared by a join on equal shingles, and the smallest id reached over links.
NEARDUP_SQL = rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, case when len(w) >= 5 then w[i:i + 4] else w end as shingle
  from w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as p(i) where len(w) > 0
),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select l.doc_id as a, r.doc_id as b, count(*) as c from s l join s r on l.shingle = r.shingle and l.doc_id < r.doc_id group by all),
links as (
  select a, b from shared join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)
),
edges as (select a, b from links union all select b, a from links),
reached as (
  select doc_id, doc_id as least from documents
  union
  select b, least from reached join edges on a = doc_id where least < b
)
select documents.doc_id, coalesce(n, 0) as n_shingles, component_id, documents.doc_id = component_id as kept
from documents left join n using (doc_id) join (select doc_id, min(least) as component_id from reached group by doc_id) using (doc_id)
"""

#: A source is full if the level reached with all tighter ones full lies above its cap; the others share the rest by weight.
MIXING_SQL = r"""
with d as (
  select doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, source, md5('mix:' || doc_id) as place from documents
),
s as (
  select source, sum(size) as words, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3)::int + 1] as weight from d group by source
),
r as (
  select *, 1.5 * sum(words) over () as rest, sum(weight) over () as weights,
    coalesce(sum(2 * words) over tight, 0) as caps_before, coalesce(sum(weight) over tight, 0) as weights_before
  from s window tight as (order by 2 * words / weight, source rows between unbounded preceding and 1 preceding)
),
f as (select *, (rest - caps_before) / (weights - weights_before) * weight > 2 * words as is_full from r),
t as (
  select source, words, case when is_full then 2.0 * words
    else (rest - sum(case when is_full then 2 * words else 0 end) over ()) / sum(case when is_full then 0 else weight end) over () * weight end as target
  from f
),
q as (select *, least(floor(target + 0.5)::bigint, (2 * words)::bigint) as quota from t),
o as (
  select *, coalesce(sum(size) over (
    partition by source order by ('0x' || substr(place, 1, 6))::bigint % 4096, place, doc_id, size rows between unbounded preceding and 1 preceding), 0) as ahead
  from d
)
select doc_id, size, words::bigint as source_size, target::double as target,
  case when words = 0 then 0
    else ((quota // words) * size + greatest(0, least(quota % words - ahead, size)))::bigint end as taken
from o join q on o.source is not distinct from q.source
"""

RANKED_SEARCH_SQL = f"""
with words as (select doc_id, unnest({_WORDS}) as term from documents),
tf as (select doc_id, term, count(*) as tf from words group by all),
sizes as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
total as (select count(*) as nn, sum(n)::bigint as ll from sizes),
df as (select term, count(*) as df from tf group by term),
asked as (select distinct item_id, unnest({_WORDS}) as term from benchmark),
scored as (
  select item_id, doc_id,
    sum(floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::bigint
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll)))))::bigint as score
  from asked join tf using (term) join df using (term) join sizes using (doc_id) cross join total
  group by item_id, doc_id
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0
qualify rank <= 10
"""

DECONTAMINATION_SQL = f"""
with items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as size, w[i:i + least(10, len(w)) - 1] as words
  from items, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p(i)
  where len(w) > 0
),
docs as (select doc_id, coalesce({_WORDS}, []) as w from documents),
sizes as (select distinct size from windows),
places as (
  select doc_id, i, size, w[i:i + size - 1] as words
  from docs, sizes, unnest(range(1, len(w) - size + 2)) as p(i)
),
hits as (select doc_id, i, places.size, item_id from places join windows using (size, words)),
hit_words as (
  select doc_id, count(distinct i + k) as n_hit from hits, unnest(range(0, size)) as p(k) group by doc_id
),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, item_id::varchar as name from hits where item_id is not null) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


def vector_codes_sql(rounds: int = 4) -> str:
    """Plain Lloyd rounds over whole-number parts, one common table expression each."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} as (
  select vec_id, part, mine, min(
    (list_inner_product(mine, mine) - 2 * list_inner_product(mine, entry) + list_inner_product(entry, entry))::bigint * 256 + e) as best
  from parts join books{i} using (part) group by vec_id, part, mine
)""")
        if i < rounds:
            steps.append(f"""
means{i} as (
  select part, e, list(mean order by i) as entry from (
    select part, best % 256 as e, i, floor(sum(mine[i]) / count(*)) as mean
    from a{i}, unnest(range(1, len(mine) + 1)) as p(i) group by part, best % 256, i
  ) group by part, e
),
books{i + 1} as (
  select part, e, coalesce(means{i}.entry, books{i}.entry) as entry from books{i} left join means{i} using (part, e)
)""")
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as (
  select vec_id, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] as mine
  from kept, unnest(range(0, 4)) as p(part)
),
books0 as (
  select part, row_number() over (partition by part order by vec_id) - 1 as e, mine as entry
  from parts qualify e < 256
),{",".join(steps)},
digest as (
  select sha256(string_agg(one, ',' order by part, e)) as codebooks_sha256 from (
    select part, e, array_to_string(list_transform(entry, lambda x: x::bigint::varchar), ',') as one from books{rounds}
  )
),
coded as (
  select vec_id, string_agg(lpad(lower(to_hex(best % 256)), 2, '0'), '' order by part) as code, sum(best // 256)::bigint as error
  from a{rounds} group by vec_id
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join kept using (vec_id) cross join digest
"""


#: The other methods' own columns (scores, pieces, fingerprints) have no SQL; tests compare them with brute force.
ORACLES: dict[str, str] = {
    "op9_neardup": NEARDUP_SQL,
    "op10_mixing": MIXING_SQL,
    "op11_ranked_search": RANKED_SEARCH_SQL,
    "op12_decontamination": DECONTAMINATION_SQL,
    "op13_vector_codes": vector_codes_sql(),
}
