"""Mixing documents of overlapping sources to target weights, by min-cost flow.

Documents are aggregated by membership pattern, the set of sources that hold them. A pattern can give its words to
the quota of any of its sources, up to ``MAX_COPIES`` times; the k-th copy costs k - 1, so the cost is convex and no
document is repeated while another that fits the same quota waits. The flow has one node per pattern and one per
source and is solved on the driver; their number is checked against ``MAX_PATTERNS``. The seeded order of a
pattern's documents, laid out once per copy, is then cut at the flows, and each copy of a document goes to the
source in whose stretch its middle lies: a source misses its flow by half a document at either end.

Positions in the seeded order are running sums in two levels, within and over ``BUCKETS`` hash buckets, so that a
source with a third of all documents is no single task's.

Defined cases: null and empty texts have size 0, and a null source is a source of its own, last in order. A document
without sources, with an empty or a null array, is not taken. A document
of size 0 counts as in a stretch like any other but adds nothing, so it takes 0 words. Rows that share a ``doc_id``
are documents of their own. The input row comes along in ``row``, so its columns may have any name. An empty table
gives an empty table. The same rows and seed give the same result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsforge.llm.text import packed
from obsforge.session import staged

#: Times a document may be taken.
MAX_COPIES = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: Most membership patterns, and so most rows, that the driver gets.
MAX_PATTERNS = 20_000
#: Hex digits of the seeded hash that name its bucket: 4096 buckets.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def in_order(sources: Iterable[str | None]) -> list[str | None]:
    return sorted(sources, key=lambda s: (s is None, s or ""))


def targets(sizes: dict[str | None, int], total: int, weights: tuple[int, ...] = WEIGHTS) -> dict[str | None, float]:
    """Shares of ``total`` by weight; what exceeds MAX_COPIES times a source's size goes to the others by weight."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(in_order(sizes))}
    full: set[str | None] = set()
    while len(full) < len(sizes):
        left = total - sum(MAX_COPIES * sizes[s] for s in full)
        share = left / sum(w for s, w in weight.items() if s not in full)
        above = {s for s, w in weight.items() if s not in full and share * w > MAX_COPIES * sizes[s]}
        if not above:
            break
        full |= above
    return {s: float(MAX_COPIES * sizes[s]) if s in full else share * w for s, w in weight.items()}


def route(sizes: dict[tuple, int], quotas: dict[str | None, int]) -> dict[tuple, dict[str | None, int]]:
    """Words that each pattern gives to each of its sources: as many as quotas take, at the least cost.

    All cost lies on the first step of a path, the copy, so cheapest paths first means all first copies, then all
    second ones: patterns are served copy by copy, each time by shortest augmenting paths, which may hand words
    already routed from a full source to another source of the same pattern.
    """
    flow: dict[tuple, dict[str | None, int]] = {p: dict.fromkeys(p, 0) for p in sizes}
    free = dict(quotas)
    # in the order in which they began to give, so that equal inputs have equal flows
    givers: dict[str | None, dict[tuple, None]] = {s: {} for s in quotas}
    for _ in range(MAX_COPIES):
        for pattern, capacity in sizes.items():
            while capacity > 0:
                came: dict[str | None, tuple[tuple, str | None] | None] = {}
                queue = deque()
                for s in pattern:
                    came[s] = None
                    queue.append(s)
                end = None
                while queue:
                    s = queue.popleft()
                    if free[s] > 0:
                        end = s
                        break
                    for other in givers[s]:
                        for t in other:
                            if t not in came:
                                came[t] = (other, s)
                                queue.append(t)
                else:
                    break
                amount, s = min(capacity, free[end]), end
                while came[s]:
                    other, s = came[s]
                    amount = min(amount, flow[other][s])
                free[end] -= amount
                capacity -= amount
                s = end
                while came[s]:
                    other, before = came[s]
                    flow[other][s] += amount
                    givers[s][other] = None
                    flow[other][before] -= amount
                    if not flow[other][before]:
                        givers[before].pop(other, None)
                    s = before
                flow[pattern][s] += amount
                givers[s][pattern] = None
    return flow


def mix(docs: DataFrame, members: Column, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, text, row, size, members, taken, and routes, the copies of the document that each source takes.

    ``members`` is an array of source names over the columns of ``docs``; sources has their sizes and targets.
    """
    spark = docs.sparkSession
    known = F.coalesce(members, F.array().cast("array<string>"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    sized = (
        packed(docs.withColumn("obsforge_members", F.array_sort(F.array_distinct(known))))
        .select("doc_id", "text", "row.obsforge_members", F.col("row").dropFields("obsforge_members").alias("row"))
        .withColumnRenamed("obsforge_members", "members")
        .withColumns({"size": word_count(F.col("text")), "pattern": F.to_json("members"), "place": order})
        .withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    )
    buckets = staged(
        sized.groupBy("pattern", "bucket").agg(F.first("members").alias("members"), F.sum("size").alias("words")), "buckets"
    )
    rows = buckets.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("words").alias("words")).take(MAX_PATTERNS + 1)
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; merge rare sources first")
    rows.sort(key=lambda r: r.pattern)
    names = {tuple(r.members): r.pattern for r in rows}
    sizes = {tuple(r.members): r.words for r in rows}
    of_source: dict[str | None, int] = {}
    for pattern, words in sizes.items():
        for s in pattern:
            of_source[s] = of_source.get(s, 0) + words
    target = targets(of_source, sum(sizes.values()), weights)
    flow = route(sizes, {s: int(t + 0.5) for s, t in target.items()})

    stretches = []
    for pattern, given in flow.items():
        at, cuts = 0, []
        for s in in_order(given):
            cuts.append((s, at, at + given[s], of_source[s], target[s]))
            at += given[s]
        stretches.append((names[pattern], sizes[pattern], cuts))
    schema = "pattern string, words_of_pattern long, cuts array<struct<source:string,low:long,high:long,size:long,target:double>>"
    routes = spark.createDataFrame(stretches, schema)  # MAX_PATTERNS rows at most

    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = buckets.select("pattern", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("pattern", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    # twice the middle of the document in its k-th copy, against twice the ends of a stretch
    middle = "2 * (k * words_of_pattern + start) + size"
    turns = f"filter(sequence(0, {MAX_COPIES - 1}), k -> {middle} >= 2 * c.low and {middle} < 2 * c.high)"
    return (
        sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(bases, ["pattern", "bucket"])
        .join(routes, "pattern")
        .withColumn("start", F.col("base") + F.col("inside"))
        .withColumn(
            "routes",
            F.expr(
                "transform(cuts, c -> named_struct('source', c.source, 'source_size', c.size, 'target', c.target,"
                f" 'copies', size({turns})))"
            ),
        )
        .withColumn("taken", F.expr("size * aggregate(routes, 0, (n, r) -> n + r.copies)").cast("long"))
        .select("doc_id", "text", "row", "size", "members", "taken", "routes")
    )
