"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern), so the flow
network has one node a pattern and one a source, however many documents there are.  A pattern offers its
words once per allowed copy, every further copy at a higher cost (convex repetition costs); a source
asks for its quota.  Documents of a pattern are then taken in a seeded order: all of them as often as the
flow fills whole copies, and the first ones once more until the rest is used up.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import materialize

#: Parts of a pattern's seeded order; a window holds one part of one pattern.
PARTS = 4096
#: More membership patterns than this are refused, as the driver solves the flow over them.
MAX_PATTERNS = 100_000


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def capped_targets(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float) -> list[float]:
    """Splits ``share`` of all sizes by weight; what lies above ``cap`` times a size is shared again by weight."""
    rest = share * sum(sizes)
    targets = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if weights[i] > 0]
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if rest * weights[i] / total > cap * sizes[i]]
        if not full:
            for i in free:
                targets[i] = rest * weights[i] / total
            break
        for i in full:
            targets[i] = cap * sizes[i]
            rest -= targets[i]
        free = [i for i in free if i not in set(full)]
    return targets


def min_cost_flow(
    capacity: Mapping[tuple[int, ...], int], quota: Sequence[int], costs: Sequence[int]
) -> dict[tuple[tuple[int, ...], int], int]:
    """Words each pattern sends to each of its sources; fills as much quota as can be, as cheaply as can be.

    A pattern may send its capacity once at each of the non-decreasing ``costs``.  Successive cheapest
    augmenting paths over the residual network, with node potentials.
    """
    patterns = sorted(capacity)
    start, end = 0, 1
    node = {p: 2 + i for i, p in enumerate(patterns)}
    source = {s: 2 + len(patterns) + s for s in range(len(quota))}
    edges: list[list[int]] = []  # to, room, cost; the reverse edge is the neighbour with the lowest bit flipped
    out: list[list[int]] = [[] for _ in range(2 + len(patterns) + len(quota))]

    def connect(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, room, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    for p in patterns:
        for cost in costs:
            connect(start, node[p], capacity[p], cost)
    carried = {(p, s): connect(node[p], source[s], sum(quota), 0) for p in patterns for s in p}
    for s, room in enumerate(quota):
        connect(source[s], end, room, 0)

    height = [0] * len(out)
    while True:
        distance: list[float] = [float("inf")] * len(out)
        arrived = [-1] * len(out)
        distance[start] = 0
        queue = [(0.0, start)]
        while queue:
            far, a = heapq.heappop(queue)
            if far > distance[a]:
                continue
            for e in out[a]:
                b, room, cost = edges[e]
                reach = far + cost + height[a] - height[b]
                if room > 0 and reach < distance[b]:
                    distance[b], arrived[b] = reach, e
                    heapq.heappush(queue, (reach, b))
        if arrived[end] < 0:
            break
        for a, far in enumerate(distance):
            height[a] += int(min(far, distance[end]))
        path = []
        at = end
        while at != start:
            path.append(arrived[at])
            at = edges[arrived[at] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    return {key: edges[e ^ 1][1] for key, e in carried.items() if edges[e ^ 1][1]}


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_copies: int = 2,
    seed: str = "mix",
    sources: str = "source",
    carry: str | None = None,
) -> DataFrame:
    """doc_id, size, pattern, source_size, target, taken of every row of ``docs``.

    ``sources`` names a string column or, for overlapping sources, an array of strings.  Sources in
    code point order, NULL last, weigh ``weights`` in turn; ``share`` times all words are dealt out by weight,
    no source above ``max_copies`` times its own words.  source_size and target are sums over the row's
    sources.  taken: words of the document the mix takes, repeats counted, between 0 and ``max_copies``
    times its size; the last document taken of a pattern may be taken in part, so quotas are met
    to a word.  NULL or blank text has size 0 and is taken 0 times; a NULL or empty array
    is the NULL source; rows that repeat a doc_id count each; equal seeds give equal mixes.
    ``carry`` names a column that is passed on, to tell such rows apart.
    """
    carried = [carry] if carry else []
    listed = F.col(sources) if isinstance(docs.schema[sources].dataType, T.ArrayType) else F.array(F.col(sources))
    pattern = F.array_sort(F.array_distinct(F.transform(listed, lambda s: F.when(s.isNotNull(), F.concat(F.lit("="), s)))))
    pattern = F.when(F.size(listed) > 0, pattern).otherwise(F.array(F.lit(None).cast("string")))
    sized = materialize(
        docs.select(
            *carried,
            F.col("doc_id"),
            word_count().alias("size"),
            F.to_json(F.transform(pattern, lambda s: F.coalesce(s, F.lit("-")))).alias("pattern"),
            F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("place"),
        )
    )
    spark = docs.sparkSession
    totals = sized.groupBy("pattern").agg(F.sum("size").alias("words")).select(
        F.from_json("pattern", "array<string>").alias("names"), "pattern", "words"
    )
    found = totals.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    names = sorted({n for row in found for n in row["names"]}, key=lambda n: (n == "-", n))
    index = {n: i for i, n in enumerate(names)}
    sizes = [sum(row["words"] for row in found if n in row["names"]) for n in names] if len(found) < 2000 else None
    if sizes is None:
        sizes = [0] * len(names)
        for row in found:
            for n in row["names"]:
                sizes[index[n]] += row["words"]
    every = sum(row["words"] for row in found)
    targets = capped_targets(
        sizes, [weights[i % len(weights)] for i in range(len(names))], share * every / max(sum(sizes), 1), max_copies
    )
    capacity = {tuple(sorted(index[n] for n in row["names"])): row["words"] for row in found}
    flow = min_cost_flow(capacity, [int(t + 0.5) for t in targets], [2**k - 1 for k in range(max_copies)])
    sent: dict[tuple[int, ...], int] = {}
    for (members, _), amount in flow.items():
        sent[members] = sent.get(members, 0) + amount
    plan = []
    for row in found:
        members = tuple(sorted(index[n] for n in row["names"]))
        copies, rest = divmod(sent.get(members, 0), row["words"]) if row["words"] else (0, 0)
        plan.append(
            (row["pattern"], sum(sizes[m] for m in members), float(sum(targets[m] for m in members)), copies, rest)
        )
    planned = spark.createDataFrame(plan, "pattern string, source_size long, target double, copies long, rest long")

    part = F.pmod(F.conv(F.substring("place", 1, 6), 16, 10).cast("long"), F.lit(PARTS))
    parted = sized.withColumn("part", part)
    inside = Window.partitionBy("pattern", "part").orderBy("place", "doc_id", "size", *carried)
    before = parted.withColumn("ahead", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    across = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parted.groupBy("pattern", "part").agg(F.sum("size").alias("words"))
    offsets = offsets.select("pattern", "part", F.coalesce(F.sum("words").over(across), F.lit(0)).alias("earlier"))
    offsets = offsets.join(planned, "pattern")
    left = F.col("rest") - F.col("earlier") - F.coalesce("ahead", F.lit(0))
    return before.join(offsets, ["pattern", "part"]).select(
        *carried,
        "doc_id",
        "size",
        F.col("pattern"),
        "source_size",
        "target",
        (F.col("copies") * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))).alias("taken"),
    )
