"""Mixing sources to target weights as a min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. A network carries words from
the patterns to the sources: a pattern offers its words once at no cost, a second time at a cost, a third time at
a higher one (convex repetition costs), and a source takes up to its quota. The cheapest flow says how many words
of a pattern the mix takes, hence how often each of its documents is repeated: so many whole times, and once more
for documents chosen in a seeded order until the rest is reached.

Only sums by pattern and by slice of the seeded order reach the driver: their number depends on the number of
patterns, not on that of documents.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.session import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Cost of a pattern's first, second and third use; a document is never taken more often.
REPEAT_COSTS = (0, 1, 3)
#: Slices of the seeded order: so many at each of the levels that narrow down where the last document lies.
SLICES, LEVELS = 4096, 3


def words(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, limit: float) -> list[float]:
    """Shares of ``total`` by weight; none is above ``limit`` times its size, the excess is reshared by weight."""
    out, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while free:
        share = (total - sum(out[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        over = [i for i in free if share * weights[i] > limit * sizes[i]]
        if not over:
            for i in free:
                out[i] = share * weights[i]
            break
        for i in over:
            out[i] = float(limit * sizes[i])
        free = [i for i in free if i not in over]
    return out


def whole(values: Sequence[float]) -> list[int]:
    """Whole numbers with the rounded sum, by largest remainders, the first of equal ones before others."""
    floors = [int(v // 1) for v in values]
    short = round(sum(values)) - sum(floors)
    for i in sorted(range(len(values)), key=lambda i: (floors[i] - values[i], i))[: max(0, short)]:
        floors[i] += 1
    return floors


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], costs: Sequence[int] = REPEAT_COSTS) -> list[dict[int, int]]:
    """Cheapest flow from patterns (their sources, their words) to quotas: words by source, for each pattern.

    Successive cheapest paths in the residual network. It has an arc for each pattern and use, for each
    membership and for each source; a path fills at least one of them.
    """
    p, s = len(patterns), len(quotas)
    start, sink = p + s, p + s + 1
    heads: list[list[int]] = [[] for _ in range(p + s + 2)]
    to, room, price = [], [], []

    def arc(a: int, b: int, capacity: int, cost: int) -> int:
        for x, y, c, k in ((a, b, capacity, cost), (b, a, 0, -cost)):
            heads[x].append(len(to))
            to.append(y)
            room.append(c)
            price.append(k)
        return len(to) - 2

    member: list[dict[int, int]] = []
    for i, (sources, size) in enumerate(patterns):
        for cost in costs:
            arc(start, i, size, cost)
        member.append({j: arc(i, p + j, size * len(costs), 0) for j in sources})
    for j, quota in enumerate(quotas):
        arc(p + j, sink, quota, 0)
    while True:
        best, via, queue, queued = {start: 0}, {}, deque([start]), {start}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in heads[x]:
                if room[e] > 0 and best[x] + price[e] < best.get(to[e], 1 << 60):
                    best[to[e]], via[to[e]] = best[x] + price[e], e
                    if to[e] not in queued:
                        queue.append(to[e])
                        queued.add(to[e])
        if sink not in best:
            return [{j: room[e + 1] for j, e in arcs.items()} for arcs in member]
        path, x = [], sink
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


def _place(level: int) -> Column:
    """Slice of a row at a level of the seeded order."""
    return F.pmod(F.shiftrightunsigned("_llm_order", 12 * level), F.lit(SLICES)).cast("int")


def _cuts(rows: DataFrame, rest: dict[int, int]) -> dict[int, list[int]]:
    """For each pattern, the place in the seeded order up to which its words come nearest to ``rest``."""
    left = {p: r for p, r in rest.items() if r > 0}
    cuts: dict[int, list[int]] = {p: [] for p in left}
    going = set(cuts)
    for level in range(LEVELS):
        if not going:
            break
        inside = F.lit(False)
        for p in sorted(going):
            here = F.col("_llm_pattern") == p
            for k, value in enumerate(cuts[p]):
                here &= _place(k) == value
            inside |= here
        sums = (
            rows.filter(inside).groupBy("_llm_pattern", _place(level).alias("slice"))
            .agg(F.sum("_llm_size").alias("size"), F.count("*").alias("n")).orderBy("_llm_pattern", "slice").collect()
        )
        for p, slice_, size, n in sums:
            if p not in going or len(cuts[p]) > level:
                continue
            if size <= left[p]:
                left[p] -= size
                continue
            cuts[p].append(slice_)
            if n == 1 or level == LEVELS - 1:
                # The slice can't be divided: it is taken whole if that comes nearer.
                cuts[p][-1] += size - left[p] < left[p]
                going.discard(p)
    return cuts


@dataclass(frozen=True)
class Mix:
    """What a mix decided. ``sources``: name, size, target and words routed of each source, in order."""

    sources: list[dict]
    patterns: list[tuple]
    times: list[int]
    cuts: dict[int, list[int]]
    marked: DataFrame
    memberships: Column
    order: Column

    def pattern(self) -> Column:
        """Number of a document's membership pattern."""
        none = F.array().cast("array<string>")
        code = F.lit(None).cast("int")
        for i, p in enumerate(self.patterns):
            values = F.array(*[F.lit(s).cast("string") for s in p]) if p else none
            code = F.when(F.coalesce(self.memberships, none).eqNullSafe(values), i).otherwise(code)
        return code

    def copies(self) -> Column:
        """How often a row is taken, from its ``_llm_pattern`` and its ``_llm_order``."""
        out = F.lit(0)
        for i, times in enumerate(self.times):
            extra = F.lit(False)
            for k, cut in reversed(list(enumerate(self.cuts.get(i, [])))):
                extra = (_place(k) < cut) | ((_place(k) == cut) & extra)
            out = F.when(F.col("_llm_pattern") == i, F.lit(times) + F.when(extra, 1).otherwise(0)).otherwise(out)
        return out

    def repeated(self, docs: DataFrame) -> DataFrame:
        """``docs`` with each row as often as the mix takes it, and its own columns."""
        names = docs.columns
        counted = docs.withColumns({"_llm_order": self.order, "_llm_pattern": self.pattern()}).withColumn("_llm_copies", self.copies())
        return counted.filter("_llm_copies > 0").withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), "_llm_copies"))).select(*names)


def plan_mix(
    docs: DataFrame, sources: Column, weights: dict[str | None, float] | Sequence[float] = WEIGHTS, key: str = "doc_id",
    text: str = "text", share: float = 1.0, limit: int = 3, seed: int = 42,
) -> Mix:
    """Decide how often each document is taken.

    ``sources`` is the array of the sources a document belongs to (null is a source like any other); sources and
    patterns are few. Weights are given by source, or in turn to the sources by code point, null last. The mix has
    ``share`` of all words; a source's target is its share by weight, at most ``limit`` times its words.

    ``marked`` has a row per document: key, ``_llm_size`` in words, ``_llm_pattern``, ``_llm_order`` and ``_llm_copies``. The outcome
    depends on the documents and the seed alone, so it can be computed again. A null or empty text has size 0 and
    is taken as its place in the seeded order says. Rows with equal key and text share a place and are taken equally
    often. A document without any source isn't taken. An empty table gives an empty result. Other columns of
    ``docs`` are neither read nor returned by ``marked``, and ``repeated`` returns them as they are.
    """
    memberships = F.array_sort(F.array_distinct(sources))
    order = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    rows = written(
        docs.select(F.col(key).alias("key"), memberships.alias("members"), words(F.col(text)).alias("_llm_size"), order.alias("_llm_order")),
        "mix-rows",
    )
    sums = rows.groupBy("members").agg(F.sum("_llm_size").alias("size")).collect()
    found = {tuple(r["members"] or ()): 0 for r in sums}
    for r in sums:
        found[tuple(r["members"] or ())] += r["size"]
    names = sorted({s for p in found for s in p}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    number = {s: i for i, s in enumerate(names)}
    given = [weights[s] if isinstance(weights, dict) else weights[i % len(weights)] for i, s in enumerate(names)]
    patterns = sorted(found, key=lambda p: [number[s] for s in p])
    sizes = [sum(found[p] for p in patterns if s in p) for s in names]
    goal = targets(sizes, given, share * sum(found.values()), limit)
    flows = route([([number[s] for s in p], found[p]) for p in patterns], whole(goal), REPEAT_COSTS[:limit])
    taken = [sum(f.values()) for f in flows]
    times = [t // found[p] if found[p] else 0 for t, p in zip(taken, patterns, strict=True)]
    rest = {i: t - k * found[p] for i, (t, k, p) in enumerate(zip(taken, times, patterns, strict=True))}
    report = [
        {"source": s, "size": sizes[i], "target": goal[i], "routed": sum(f.get(i, 0) for f in flows)} for i, s in enumerate(names)
    ]
    plan = Mix(report, patterns, times, {}, rows, F.col("members"), F.col("_llm_order"))
    coded = rows.withColumn("_llm_pattern", plan.pattern())
    plan = replace(plan, cuts=_cuts(coded, rest))
    marked = coded.withColumn("_llm_copies", plan.copies()).withColumnRenamed("key", key).drop("members")
    return replace(plan, marked=marked, memberships=memberships, order=order)
