"""Mixing overlapping sources to target weights as a flow of least cost.

A document may belong to several sources. Documents are summed up by membership pattern (the set
of their sources); words flow from the patterns through their sources into the sources' quotas.
Taking a pattern's words once is cheap, each further repetition costs more, so the flow repeats
only where a quota can't be met with fresh words. The graph has patterns and sources as nodes, not
documents, and at most ``MOST_PATTERNS`` of them; beyond that the operator stops with an error.

What the flow takes of a pattern is dealt to its documents by a seeded hash: all documents are
taken a whole number of times, then those of the lower hash buckets once more, and the documents
of the last bucket share what is left. So a source's words come within a word for each document
of one bucket of the flow, and reruns agree.

Null and empty texts have size 0 and are taken 0 words. A null source is a source of its own, last
in order. Equal rows fall in one bucket and are treated alike. An empty table gives an empty
result; columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stardw.llm.frames import others
from stardw.session import cut_lineage, local_rows

MOST_PATTERNS = 100_000
BUCKETS = 4096
SEED = 10
# Weights of the sources in order, repeating; words to share, and most repetitions.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_TIMES = 2

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: dict[str | None, int], *, weights: Sequence[int] = WEIGHTS,
            share_percent: int = SHARE_PERCENT, times: int = MOST_TIMES) -> dict:
    """Words wanted of each source, by weight, none above ``times`` its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict = {}
    left, open_ = share_percent * sum(sizes.values()) / 100, list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > times * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: float(times * sizes[s]) for s in over}
        left -= sum(times * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


class Flow:
    """Flow by blocking flows of shortest paths. An arc is [to, capacity left, arc back]."""

    def __init__(self, nodes: int):
        self.arcs: list[list[list]] = [[] for _ in range(nodes)]

    def arc(self, a: int, b: int, capacity: int) -> list:
        forth, back = [b, capacity, None], [a, 0, None]
        forth[2], back[2] = back, forth
        self.arcs[a].append(forth)
        self.arcs[b].append(back)
        return forth

    def _levels(self, source: int, sink: int) -> list[int]:
        """Arcs from the source to each node, as far as the sink; -1 where it can't get."""
        level = [-1] * len(self.arcs)
        level[source], edge = 0, [source]
        while edge and level[sink] < 0:
            following = []
            for a in edge:
                for to, capacity, _ in self.arcs[a]:
                    if capacity > 0 and level[to] < 0:
                        level[to] = level[a] + 1
                        following.append(to)
            edge = following
        return level

    def send(self, source: int, sink: int) -> None:
        """As much as possible, besides what flows already."""
        while (level := self._levels(source, sink))[sink] > 0:
            tried, path, at = [0] * len(self.arcs), [], source
            while True:
                if at == sink:
                    amount = min(arc[1] for arc in path)
                    for arc in path:
                        arc[1] -= amount
                        arc[2][1] += amount
                    # Back to where the first full arc leaves from.
                    full = next(i for i, arc in enumerate(path) if not arc[1])
                    at = path[full][2][0]
                    del path[full:]
                    continue
                arcs = self.arcs[at]
                while tried[at] < len(arcs) and not (
                        arcs[tried[at]][1] > 0 and level[arcs[tried[at]][0]] == level[at] + 1):
                    tried[at] += 1
                if tried[at] < len(arcs):
                    path.append(arcs[tried[at]])
                    at = path[-1][0]
                elif at == source:
                    break
                else:
                    at = path.pop()[2][0]
                    tried[at] += 1


def route(patterns: dict[tuple, int], quotas: dict, times: int = MOST_TIMES) -> dict[tuple, int]:
    """Words to take of each pattern, as many as the quotas can hold. The n-th time costs 2n - 1: a
    convex cost.

    All costs lie on the patterns' words, and a path that adds words never leaves the source twice,
    so the least cost is that of the most words of the first time, then of the second, and so on:
    one flow for each. A source that shares no pattern with another needs none.
    """
    shared = {s for k in patterns if len(k) > 1 for s in k}
    taken = {k: min(round(quotas[s]), times * patterns[k]) for k in patterns
             for s in k if len(k) == 1 and s not in shared}
    keys = [k for k in patterns if k not in taken and k]
    # Patterns of one source first, so that words of several are left to the others.
    keys.sort(key=len)
    names = [s for s in quotas if s in shared]
    at = {s: 1 + len(keys) + i for i, s in enumerate(names)}
    sink = 1 + len(keys) + len(names)
    flow = Flow(sink + 1)
    ways = [[flow.arc(i, at[s], times * patterns[key]) for s in key] for i, key in enumerate(keys, 1)]
    last = {at[s]: flow.arc(at[s], sink, round(quotas[s])) for s in names}
    supply = []
    for _ in range(times):
        supply.append([flow.arc(0, i, patterns[key]) for i, key in enumerate(keys, 1)])
        # What fits is sent straight on; the flow then finds what has to go another way.
        for arc, out in zip(supply[-1], ways):
            for way in out:
                path = arc, way, last[way[0]]
                amount = min(one[1] for one in path)
                for one in path if amount else ():
                    one[1] -= amount
                    one[2][1] += amount
        flow.send(0, sink)
    for k, key in enumerate(keys):
        taken[key] = times * patterns[key] - sum(arcs[k][1] for arcs in supply)
    return taken


def mix(docs: DataFrame, *, sources: str = "sources", text: str = "text", id_column: str = "doc_id",
        weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT,
        times: int = MOST_TIMES, buckets: int = BUCKETS, seed: int = SEED,
        most_patterns: int = MOST_PATTERNS) -> DataFrame:
    """``docs`` without the text, with ``size``, ``taken`` and ``of``: the name, wanted words and
    size of each of its sources; ``sources`` is an array of source names, null included."""
    spark = docs.sparkSession
    clash = {"size", "taken", "of", "pattern", "bucket", "times", "rest", "last", "over",
             "last_words", text}
    pattern = F.array_sort(F.array_distinct(F.coalesce(F.col(sources), F.array().cast(
        "array<string>"))))
    sized = cut_lineage(docs.select(
        *others(docs, clash), pattern.alias("pattern"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
        .alias("size"),
        F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.lit(buckets)).alias("bucket")), "sizes")

    filled = sized.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    filled = cut_lineage(filled, "buckets")
    summed = filled.groupBy("pattern").agg(F.sum("words").alias("words"))
    found = summed.limit(most_patterns + 1).collect()
    if len(found) > most_patterns:
        raise ValueError(f"more than {most_patterns} combinations of sources")
    words = {tuple(r["pattern"]): r["words"] for r in found}
    sizes: dict = {}
    for key, n in words.items():
        for s in key:
            sizes[s] = sizes.get(s, 0) + n
    wanted = targets(sizes, weights=weights, share_percent=share_percent, times=times)
    taken = route({k: n for k, n in words.items() if k}, wanted, times)

    # One literal row for each pattern, at most ``most_patterns``.
    plan = local_rows(spark, [
        (list(k), taken.get(k, 0) // n if n else 0, taken.get(k, 0) % n if n else 0,
         [{"source": s, "wanted": wanted[s], "size": sizes[s]} for s in k])
        for k, n in words.items()],
        "pattern array<string>, times long, rest long, "
        "of array<struct<source:string,wanted:double,size:long>>")
    before = F.coalesce(F.sum("words").over(
        Window.partitionBy("pattern").orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = filled.withColumn("before", before).join(F.broadcast(plan), "pattern")
    # Where the rest of a pattern's words ends: the bucket, and what is left for it.
    last = (starts.filter("before <= rest AND rest < before + words")
            .select("pattern", F.col("bucket").alias("last"), (F.col("rest") - F.col("before"))
                    .alias("over"), F.col("words").alias("last_words")))
    plan = plan.join(last, "pattern", "left")
    more = (F.when(F.col("bucket") < F.col("last"), F.col("size"))
            .when(F.col("bucket") == F.col("last"), F.floor(
                F.col("size").cast("decimal(38,0)") * F.col("over") / F.col("last_words")))
            .otherwise(0))
    return (sized.join(F.broadcast(plan), "pattern", "left")
            .withColumn("taken", (F.col("times") * F.col("size") + more).cast("long"))
            .drop("pattern", "bucket", "times", "rest", "last", "over", "last_words"))


def mix_by_source(docs: DataFrame) -> DataFrame:
    """The mix of documents that each have one ``source``."""
    rows = docs.select("doc_id", F.array(F.col("source").cast("string")).alias("sources"), "text")
    return mix(rows).select("doc_id", "size", F.col("of")[0]["size"].alias("source_size"),
                            F.col("of")[0]["wanted"].alias("target"), "taken")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_by_source(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_mixing": op10_mixing}
