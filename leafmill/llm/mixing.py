"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A flow network routes token
capacity from patterns to source quotas: a pattern offers its tokens once for nothing and again at growing cost (convex
repetition), up to a repeat limit. The flow fixes how many tokens each pattern gives to each source; documents are then
selected in a seeded order. The network has one node per pattern and source, so only those sums reach the driver.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.scratch import keep

_EPS = 1e-6


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and \\x09-\\x0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sizes: list[float], weights: list[float], limit: float) -> list[float]:
    """Targets in proportion to weights, none above limit times its size, the excess reshared until none is above."""
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in sorted(open_) if left * weights[i] / total > limit * sizes[i]]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / total
            break
        for i in full:
            target[i] = float(limit * sizes[i])
            open_.remove(i)
        left = sum(sizes) - sum(target[i] for i in range(len(sizes)) if i not in open_)
    return target


def min_cost_flow(
    supplies: list[float], routes: list[list[int]], quotas: list[float], costs: list[float]
) -> list[dict[tuple[int, int], float]]:
    """Tokens per pattern as {(source, repetition): amount}, filling the quotas at least cost.

    Pattern p may send supplies[p] tokens in each repetition r at costs[r] a token (growing) to the sources routes[p].
    Successive shortest paths with potentials; costs are the same for every pattern, so each augmentation takes the
    cheapest repetition that is still open anywhere on a path of shifts between sources. Quotas that the patterns
    cannot fill stay short.
    """
    n_p, n_s = len(supplies), len(quotas)
    start, end = 0, 1 + n_p + n_s
    graph: list[list[int]] = [[] for _ in range(end + 1)]
    to, room, price = [], [], []

    def arc(a: int, b: int, capacity: float, cost: float) -> int:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0.0, -cost)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
            price.append(w)
        return len(to) - 2

    supply_arcs = [[arc(start, 1 + p, s, c) for c in costs] for p, s in enumerate(supplies)]
    route_arcs = {(p, q): arc(1 + p, 1 + n_p + q, float("inf"), 0.0) for p, to_ in enumerate(routes) for q in to_}
    for q, amount in enumerate(quotas):
        arc(1 + n_p + q, end, amount, 0.0)
    height = [0.0] * (end + 1)
    while True:
        far, via, queue = [float("inf")] * (end + 1), [-1] * (end + 1), [(0.0, start)]
        far[start] = 0.0
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            for e in graph[x]:
                if room[e] > _EPS and (step := d + price[e] + height[x] - height[to[e]]) < far[to[e]] - 1e-12:
                    far[to[e]], via[to[e]] = step, e
                    heapq.heappush(queue, (step, to[e]))
        if far[end] == float("inf"):
            break
        height = [h + min(f, far[end]) for h, f in zip(height, far, strict=True)]
        path, x = [], end
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    out = []
    for p in range(n_p):
        given = {q: room[route_arcs[p, q] ^ 1] for q in routes[p]}
        flows = {}
        for r, e in enumerate(supply_arcs[p]):
            left = room[e ^ 1]
            for q in routes[p]:
                take = min(left, given[q])
                if take > _EPS:
                    flows[q, r] = take
                    given[q] -= take
                    left -= take
        out.append(flows)
    return out


def plan(stats: list[tuple[tuple, float]], weights: dict, limit: int) -> tuple[dict, dict, dict]:
    """From (pattern, tokens): source sizes, source targets, and per pattern {(source, repetition): tokens}."""
    size: dict = defaultdict(float)
    for pattern, tokens in stats:
        for s in pattern:
            size[s] += tokens
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    # A document of several sources is one supply, so the quotas share what there is, each token once.
    total, doubled = sum(t for _, t in stats), sum(size.values())
    target = water_fill([size[s] for s in sources], [weights[s] for s in sources], limit)
    quota = [t * (total / doubled if doubled else 0) for t in target]
    index = {s: i for i, s in enumerate(sources)}
    flows = min_cost_flow(
        [t for _, t in stats], [[index[s] for s in p] for p, _ in stats], quota, [4.0**r - 1 for r in range(limit)]
    )
    named = {p: {(sources[q], r): a for (q, r), a in f.items()} for (p, _), f in zip(stats, flows, strict=True)}
    return dict(size), dict(zip(sources, quota, strict=True)), named


def cycle_weights(sources: list, cycle: tuple[float, ...] = (1, 2, 3)) -> dict:
    """Weights repeating along the sources in code point order, null last."""
    return {s: cycle[i % len(cycle)] for i, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c), F.lit("null"))


def _pattern(members: Column | None) -> Column:
    return F.array_distinct(F.array_sort(F.array("source") if members is None else members))


def _order(seed: int) -> Column:
    """Place of a document in the seeded order, 52 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 12)


@dataclass
class Mixture:
    """What a mix takes: per membership pattern the whole copies, and the last place that gets one more."""

    cuts: DataFrame
    sources: DataFrame
    limit: int
    seed: int
    members: Column | None

    def copies(self, docs: DataFrame) -> DataFrame:
        """docs with size and copies (0 to limit), every row; one join with a row per pattern."""
        rows = docs.withColumns({"__size": word_count(F.col("text")), "__order": _order(self.seed), "__pattern": _pattern(self.members)})
        extra = (F.col("__order") <= F.col("__cut")).cast("int")
        copies = F.when(F.col("__size") > 0, F.least(F.lit(self.limit), F.col("__whole") + extra)).otherwise(0).cast("int")
        return rows.join(self.cuts, "__pattern").withColumns({"__copies": copies}).drop("__order", "__pattern", "__whole", "__cut")


def fit(docs: DataFrame, weights: dict | None = None, limit: int = 3, seed: int = 11, members: Column | None = None) -> Mixture:
    """Plan a mix of docs (doc_id, text, source); see mix()."""
    rows = keep(
        docs.select("source", word_count(F.col("text")).alias("size"), _pattern(members).alias("pattern"), _order(seed).alias("order")),
        "mix-sizes",
    ).withColumn("bin", F.shiftright("order", 52 - 12).cast("int"))
    stats = rows.groupBy("pattern").agg(F.sum("size").alias("tokens")).collect()  # one row per pattern
    stats = sorted(((tuple(r.pattern), float(r.tokens)) for r in stats), key=lambda x: str(x[0]))
    known = {s for p, _ in stats for s in p}
    size, target, flows = plan(stats, weights or cycle_weights(list(known)), limit)

    # Convex costs fill a repetition before the next, so a pattern gives whole copies and then a part of its documents.
    spark, wanted = docs.sparkSession, []
    for pattern, tokens in stats:
        amount = sum(flows[pattern].values())
        whole = int(amount / tokens + 1e-9) if tokens else 0
        wanted.append((list(pattern), whole, amount - whole * tokens))
    wanted = spark.createDataFrame(wanted, "pattern array<string>, whole int, part double")
    # At most 4096 sums per pattern; only the bin in which the part ends is ranked row by row.
    bins = rows.groupBy("pattern", "bin").agg(F.sum("size").alias("bin_size"))
    run = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(run), F.lit(0))).join(wanted, "pattern")
    inside = F.col("before") + F.col("bin_size") <= F.col("part")
    full = bins.where(inside).groupBy("pattern").agg((F.shiftleft(F.max("bin").cast("long") + 1, 40) - 1).alias("cut"))
    edge = bins.where(~inside & (F.col("part") > F.col("before"))).select("pattern", "bin", (F.col("part") - F.col("before")).alias("left"))
    reached = F.sum("size").over(
        Window.partitionBy("pattern", "bin").orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = (
        rows.join(edge, ["pattern", "bin"])
        .withColumn("reached", reached)
        .where(F.col("reached") - F.col("size") / 2 < F.col("left"))
        .groupBy("pattern")
        .agg(F.max("order").alias("last"))
    )
    cuts = (
        wanted.join(full, "pattern", "left")
        .join(last, "pattern", "left")
        .select(
            F.col("pattern").alias("__pattern"),
            F.col("whole").alias("__whole"),
            F.coalesce(F.greatest("cut", "last"), F.lit(-1)).alias("__cut"),
        )
    )
    sources = spark.createDataFrame(
        [("null" if s is None else f"={s}", int(size[s]), float(target[s])) for s in size],
        "__source string, source_size long, target double",
    )
    return Mixture(keep(cuts, "mix-cuts"), sources, limit, seed, members)


def mix(
    docs: DataFrame, weights: dict | None = None, limit: int = 3, seed: int = 11, members: Column | None = None
) -> DataFrame:
    """Every row of docs (doc_id, text, source) with the tokens that the mix takes of it.

    Gives doc_id, size (words of the whole text), source, source_size and target (of its source), copies (0 to limit) and
    taken = copies * size. weights are per source, by default 1, 2, 3 repeating in code point order; members is an array
    column of the sources of a document (default: its source), whose set is its membership pattern. The tokens taken
    of a pattern come within half a document of what the flow asks of it. The seeded order is by a hash of doc_id and
    text, so a rerun takes the same; repeated rows are taken alike. A null source is a source; empty or null texts have
    size 0 and no copies. An empty table gives no rows; other columns are ignored.
    """
    mixture = fit(docs, weights, limit, seed, members)
    rows = mixture.copies(docs).select("doc_id", "source", "__size", "__copies", _key(F.col("source")).alias("__source"))
    copies, size = F.col("__copies"), F.col("__size")
    return rows.join(mixture.sources, "__source").select(
        "doc_id", size.alias("size"), "source", "source_size", "target", copies.alias("copies"), (copies * size).alias("taken")
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of docs, all columns, each as often as the mix takes it."""
    rows = fit(docs, **options).copies(docs).where("__copies > 0")
    return rows.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
