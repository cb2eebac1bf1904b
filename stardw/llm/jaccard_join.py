"""Exact similarity join of documents by the Jaccard distance of their shingle sets.

Two texts link when ``100 * |x ∩ y| >= percent * |x ∪ y|``. Jaccard distance is a metric, and the
join works by pivots and regions, in three spaces that get finer:

1. *Part spaces.* Unrelated texts share no shingle and lie at distance 1 from each other and from
   every pivot, so pivots of the whole space separate nothing. The shingles are therefore cut by a
   hash into parts, more of them than a linked pair can differ in. Then a linked pair agrees
   entirely on some part: there it is at distance 0. Every part value that occurs is a pivot and
   the documents with that value are its *cell*. Where a document fills too few parts for the
   argument to hold, each of its shingles is a cell. Cells with the same members are one.
2. *Count space.* The counts of a set's shingles in hash buckets, more for larger sets, are a point
   under the L1 metric; two sets differ at least by the distance of their points, also when
   neighbouring buckets are taken together to compare points of two widths. In each
   cell, documents whose points are near enough for a link are tied, and whatever is tied through
   any cells is a *region*: a linked pair always lies in one.
3. *The sets themselves.* In each region the pairs are checked on the whole sets.

In the last two spaces a cell or region that is too heavy for one task takes some of its members
as pivots. Each member goes home to the nearest pivot and is a guest of every pivot that a partner
may have as home: by the triangle inequality, one at most twice the greatest distance of a link
further away. These Voronoi regions are divided again until they are light. One that pivots don't
divide is joined in blocks, each pair of blocks a task. Inside a task the same is done down to
leaves, whose pairs are compared at once.

Copies collapse by the digest of their set first, and only sets with a partner in some cell are
shipped. Components come from the links by ``graph.connected``.

Null, empty and word-free texts have an empty set and link with nothing. Texts with fewer words
than a shingle have their whole sequence as one. Documents without id get the least id of their
component, or none where no member has one. Equal rows link; an empty table gives an empty
result; columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import narrowed, others, widened
from stardw.llm.graph import connected
from stardw.llm.words import blocks, mix, windows, words_of
from stardw.session import cut_lineage

WORDS, PERCENT = 4, 85
# Size classes grow by this ratio; a document has the cells of its own class, and of the next if a
# partner can be in it.
CLASS_RATIO = 1.5
# Parts beyond what a linked pair can differ in, as some stay empty.
SPARE = 1.15
# Shingles a task holds of one region, points it holds of one cell, and pivots of a heavier one.
HEAVY = 2_000_000
HEAVY_CELL = 20_000
PIVOTS = 16
LEVELS = 4
LEAF = 48
# Buckets of count space, for sets of up to so many shingles. Some six shingles a bucket keep
# unrelated sets further apart than linked ones.
BUCKETS = ((1_500, 256), (6_000, 1024), (2**62, 4096))
LEAST_BUCKETS = BUCKETS[0][1]
# Cells gathered in a task before they are sent on.
FLUSH = 1 << 20

_SEED = np.uint64(0xA0761D6478BD642F)
_ALL = np.uint64(0xE7037ED1A0B428DB)
_POINT = np.uint64(0x589965CC75374CC3)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The set of each row as sorted 64-bit hashes."""
    found = words_of(texts, fold=True)
    h = found.hashes()
    grams = windows(h, words)
    sets = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(grams[a:b - words + 1]))
        elif b > a:
            sets.append(mix(windows(h[a:b], b - a) + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def node(key: bytes) -> int:
    """A short name of a set. Two sets with one name would only share a region."""
    return int.from_bytes(key[:8], "little", signed=True)


def most_apart(size: int, percent: int) -> int:
    """Shingles that a set of ``size`` and a linked one, as large or larger, can differ in."""
    return (100 - percent) * size // percent


@lru_cache(maxsize=4096)
def schemes(size: int, percent: int) -> list[tuple[int, int]]:
    """Size classes a set of ``size`` takes part in, with their numbers of parts."""
    out, c, low = [], 0, 1
    while low <= 100 * size // percent:
        high = int(low * CLASS_RATIO)
        if high >= size:
            apart = most_apart(high, percent)
            out.append((c, 1 if apart == 0 else int(SPARE * (apart + 1)) + 1))
        c, low = c + 1, high + 1
    return out


def cells(own: np.ndarray, percent: int) -> np.ndarray:
    """The cells of a set, as hashes."""
    if not len(own):
        return own
    out, whole = [], True
    spread = mix(own + _SEED)
    for c, parts in schemes(len(own), percent):
        part = spread % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        part = part[order]
        heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        values = np.add.reduceat(mix(own ^ _SEED)[order], heads)
        out.append(mix(values + part[heads] * _ALL + np.uint64((c + 1) * int(_SEED) % 2 ** 64)))
        whole &= len(heads) > most_apart(len(own), percent)
    if not whole:
        out.append(mix(own ^ _ALL))
    return np.concatenate(out)


def point(own: np.ndarray) -> bytes:
    """The set in count space. Counts stop at 255, which only brings points nearer."""
    width = next(w for most, w in BUCKETS if len(own) <= most)
    bucket = mix(own ^ _POINT) >> np.uint64(65 - width.bit_length())
    return np.minimum(np.bincount(bucket.astype(np.int64), minlength=width), 255).astype(
        np.uint8).tobytes()


def _celler(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            cell, owner = (np.concatenate(p) for p in zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cell.view(np.int64)), pa.array(owner)], names=["cell", "node"])

        for batch in blocks(batches):
            for own in shingle_sets(batch.column("text"), words):
                name = node(digest(own)) if len(own) else None
                if name is not None and name not in seen:  # copies of the task count once
                    seen.add(name)
                    found = cells(own, percent)
                    held.append((found, np.full(len(found), name)))
                    n += len(found)
            if n >= FLUSH:
                yield flush()
                n = 0
        if held:
            yield flush()
    return run


def _keyer(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            sets = shingle_sets(batch.column("text"), words)
            keys = [digest(s) if len(s) else None for s in sets]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys, pa.binary()),
                 pa.array([node(k) if k else None for k in keys], pa.int64()),
                 pa.array([point(s) if len(s) else None for s in sets], pa.binary())],
                names=[*kept, "n_shingles", "_key", "_node", "_point"])
    return run


def _setter(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in blocks(batches):
            rows = [(region, digest(own), own) for region, own in zip(
                batch.column("region").to_pylist(), shingle_sets(batch.column("text"), words))]
            fresh = []
            for row in rows:
                if row[1] not in seen:
                    seen.add(row[1])
                    fresh.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in fresh], pa.int64()),
                 pa.array([r[1] for r in fresh], pa.binary()),
                 pa.array([len(r[2]) for r in fresh], pa.int64()),
                 pa.array([r[2].tobytes() for r in fresh], pa.binary())],
                names=["region", "key", "n", "content"])
    return run


class Forest:
    """Union-find over the members of a region."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def tie(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every pair of two short lists. Each set of ``a`` is looked up in all
    shingles of ``b`` at once, so the memory is that of the sets, however long they are."""
    order = np.argsort(shingles := np.concatenate(b), kind="stable")
    shingles = shingles[order]
    owner = np.repeat(np.arange(len(b)), [len(s) for s in b])[order]
    out = np.zeros((len(a), len(b)), np.int64)
    for i, own in enumerate(a):
        low = np.searchsorted(shingles, own, "left")
        n = np.searchsorted(shingles, own, "right") - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[i] = np.bincount(owner[at], minlength=len(b))
    return out


class Space:
    """Members of a region with their sizes; near pairs are those that may link."""

    def __init__(self, percent: int, content: list[bytes], size: list[int]):
        self.percent, self.size = percent, np.array(size, np.int64)
        self.items = self.load(content)

    def linked_sizes(self, a: list[int], b: list[int]) -> bool:
        """Whether sizes of two lists, each in order of size, leave room for a link."""
        return (100 * self.size[b[-1]] >= self.percent * self.size[a[0]]
                and 100 * self.size[a[-1]] >= self.percent * self.size[b[0]])


class Sets(Space):
    """Whole sets at their Jaccard distance."""

    def load(self, content: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(c, np.uint64) for c in content]

    def _union(self, a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
        common = shared([self.items[i] for i in a], [self.items[i] for i in b])
        return common, self.size[a][:, None] + self.size[b][None, :] - common

    def far(self, members: list[int], pivots: list[int]) -> np.ndarray:
        parts = [self._union(members[i:i + LEAF], pivots) for i in range(0, len(members), LEAF)]
        return np.concatenate([1 - common / union for common, union in parts])

    def near(self, a: list[int], b: list[int]) -> np.ndarray:
        common, union = self._union(a, b)
        return 100 * common >= self.percent * union

    def reach(self, members: list[int]) -> np.ndarray:
        """The greatest distance of a link."""
        return np.full(len(members), 1 - self.percent / 100)


class Points(Space):
    """Sets as points of count space. |x Δ y| is at least the L1 distance, and of a linked pair at
    most ``(1 - t) / (1 + t)`` times the sum of the sizes."""

    def load(self, content: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(c, np.uint8) for c in content]

    def _l1(self, a: list[int], b: list[int], width: int) -> np.ndarray:
        a, b = (np.stack([self.items[i].reshape(width, -1).sum(axis=1, dtype=np.int32) for i in x])
                for x in (a, b))
        return np.stack([np.abs(b - own).sum(axis=1, dtype=np.int64) for own in a])

    def far(self, members: list[int], pivots: list[int]) -> np.ndarray:
        # All in one width, so that the triangle inequality holds among them.
        return self._l1(members, pivots, LEAST_BUCKETS)

    def near(self, a: list[int], b: list[int]) -> np.ndarray:
        t = self.percent
        sizes = self.size[a][:, None] + self.size[b][None, :]
        width = min(len(self.items[i]) for i in (*a, *b))
        return (100 + t) * self._l1(a, b, width) <= (100 - t) * sizes

    def reach(self, members: list[int]) -> np.ndarray:
        t = self.percent / 100
        return (1 - t) / (1 + t) * (1 + 1 / t) * self.size[members]


SPACES = {"sets": Sets, "points": Points}


def link_blocks(a: list[int], b: list[int], space: Space, forest: Forest) -> None:
    """Tie the near pairs of two lists of members, leaf by leaf."""
    # In order of size, leaves whose sizes are too far apart hold no link.
    same = a is b
    a, b = (sorted(x, key=lambda i: space.size[i]) for x in (a, b))
    for i in range(0, len(a), LEAF):
        left = a[i:i + LEAF]
        for j in range(i if same else 0, len(b), LEAF):
            right = b[j:j + LEAF]
            if space.linked_sizes(left, right):
                for x, y in np.argwhere(space.near(left, right)).tolist():
                    forest.tie(left[x], right[y])


def homes(far: np.ndarray, reach: np.ndarray) -> list[np.ndarray]:
    """Members of each pivot's region: those at home, and guests up to twice their reach away."""
    most = far.min(axis=1) + 2 * reach + 1e-9
    return [np.flatnonzero(far[:, p] <= most) for p in range(far.shape[1])]


def link_region(members: list[int], space: Space, forest: Forest, level: int = 0) -> None:
    """Tie all near pairs among the members of a region that fits the task."""
    if len(members) > 8 * LEAF and level < LEVELS:
        step = len(members) // PIVOTS
        pivots = [members[p * step] for p in range(PIVOTS)]
        split = homes(space.far(members, pivots), space.reach(members))
        if sum(len(s) ** 2 for s in split) < 0.5 * len(members) ** 2:
            for own in split:
                if len(own) > 1:
                    link_region([members[i] for i in own], space, forest, level + 1)
            return
    link_blocks(members, members, space, forest)


def _joiner(kind: str, percent: int, two: bool):
    """Ties of each region as pairs (first of the component, member). ``two``: a region has two
    blocks, ``side`` 0 and 1, and only pairs across them, or within if there is one, count."""
    def solve(rows: list[dict]) -> list[tuple]:
        space = SPACES[kind](percent, [r["content"] for r in rows], [r["n"] for r in rows])
        forest = Forest(len(rows))
        sides = [[i for i, r in enumerate(rows) if two and r["side"] == s] for s in (0, 1)]
        if all(sides):
            link_blocks(*sides, space, forest)
        else:
            link_region(list(range(len(rows))), space, forest)
        return [(rows[forest.root(i)]["key"], r["key"]) for i, r in enumerate(rows)
                if forest.root(i) != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            key, pairs = batch.schema.field("key").type, []
            for row in batch.to_pylist():
                if held and row["region"] != held[0]["region"]:
                    pairs += solve(held)
                    held = []
                held.append(row)
            yield _pairs(pairs, key)
        if held:
            yield _pairs(solve(held), key)
    return run


def _pairs(pairs: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    pairs = list(dict.fromkeys(pairs))
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], key) for k in (0, 1)],
                                      names=["a", "b"])


def _diviser(kind: str, percent: int, level: int):
    """Rows of a (region, salt) come with its pivots first; every other row goes to its regions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: list[dict] = []
        for batch in batches:
            for part in range(0, batch.num_rows, LEAF):
                rows, out = batch.slice(part, LEAF).to_pylist(), []
                waiting: list[dict] = []

                def place() -> None:
                    if waiting:
                        both = pivots + waiting
                        space = SPACES[kind](percent, [r["content"] for r in both],
                                             [r["n"] for r in both])
                        own = list(range(len(pivots), len(both)))
                        split = homes(space.far(own, list(range(len(pivots)))), space.reach(own))
                        for p, at in enumerate(split):
                            name = f"{waiting[0]['region']} {level} {p}".encode()
                            region = node(hashlib.blake2b(name, digest_size=8).digest())
                            out.extend(waiting[i] | {"region": region,
                                                     "parent": waiting[i]["region"]} for i in at)
                        waiting.clear()
                for row in rows:
                    if row["pivot"] == 0:
                        if pivots and (pivots[0]["region"], pivots[0]["salt"]) != (
                                row["region"], row["salt"]) or waiting:
                            place()
                            pivots.clear()
                        pivots.append(row)
                    else:
                        waiting.append(row)
                place()
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                    [batch.schema.field(c) for c in _MEMBER] + [("parent", pa.int64())]))
    return run


_MEMBER = ["region", "key", "n", "content"]


def _divided(big: DataFrame, weight: DataFrame, kind: str, percent: int, level: int,
             heavy: int) -> DataFrame:
    """Members of heavy regions in the regions of pivots, with the ``parent`` region."""
    big = big.join(weight.select("region", F.ceil(F.col("weight") / heavy).cast("int").alias("salts")),
                   "region")
    # One pivot of each hash bucket: at most PIVOTS of a region, whatever its size.
    drawn = F.xxhash64(F.lit(level), "key")
    pivots = (big.groupBy("region", "salts", F.pmod(drawn, F.lit(PIVOTS)).alias("bucket"))
              .agg(F.min(F.struct(drawn.alias("h"), "key", "n", "content")).alias("p"))
              .select("region", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                      "p.key", "p.n", "p.content", F.lit(0).alias("pivot")))
    rows = big.select("region", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int").alias("salt"),
                      "key", "n", "content", F.lit(1).alias("pivot"))
    key = dict(big.dtypes)["key"]
    return (rows.unionByName(pivots).repartition("region", "salt")
            .sortWithinPartitions("region", "salt", "pivot")
            .mapInArrow(_diviser(kind, percent, level),
                        f"region long, key {key}, n long, content binary, parent long"))


def region_links(members: DataFrame, kind: str, percent: int, heavy: int, weigh: str | None,
                 ) -> DataFrame:
    """Near pairs ``a``, ``b`` of keys inside all regions, heavy ones divided first.

    A region weighs the sum of the column ``weigh``, or as many as it has members.
    """
    weigh = weigh or F.lit(1)
    links = []
    rest = members
    for level in range(LEVELS + 1):
        weight = rest.groupBy("region").agg(F.sum(weigh).alias("weight"))
        weight = cut_lineage(weight.filter(F.col("weight") > heavy), "heavy")
        if weight.isEmpty():
            links.append(_joined(rest, kind, percent, two=False))
            break
        links.append(_joined(rest.join(weight, "region", "left_anti"), kind, percent, two=False))
        big = rest.join(weight.select("region"), "region", "left_semi")
        if level == LEVELS:
            links.append(_in_blocks(big, kind, percent, heavy, weigh))
            break
        divided = cut_lineage(_divided(big, weight, kind, percent, level, heavy), "regions")
        # Regions that the pivots don't divide are joined in blocks.
        parts = divided.groupBy("parent", "region").agg(F.sum(weigh).alias("w"))
        stuck = (parts.groupBy("parent").agg(F.max("w").alias("most"), F.sum("w").alias("all"))
                 .join(weight.withColumnRenamed("region", "parent"), "parent")
                 .filter("most > 0.8 * weight OR all > 4 * weight"))
        stuck = cut_lineage(stuck.select(F.col("parent").alias("region")), "stuck")
        links.append(_in_blocks(big.join(stuck, "region", "left_semi"), kind, percent, heavy, weigh))
        rest = divided.join(stuck.withColumnRenamed("region", "parent"), "parent", "left_anti")
        rest = rest.select(*_MEMBER)
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _joined(members: DataFrame, kind: str, percent: int, two: bool) -> DataFrame:
    rows = members.repartition("region").sortWithinPartitions("region")
    key = dict(members.dtypes)["key"]
    return rows.mapInArrow(_joiner(kind, percent, two), f"a {key}, b {key}")


def _in_blocks(big: DataFrame, kind: str, percent: int, heavy: int, weigh: str) -> DataFrame:
    """Every pair of blocks of a region as a task of its own, each block half as heavy."""
    weight = big.groupBy("region").agg(
        F.ceil(2 * F.sum(weigh) / heavy).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    rows = (big.select(*_MEMBER).join(weight, "region").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select(F.xxhash64("region", low, high).alias("region"), "key", "n", "content",
                       (F.col("own") > F.col("other")).cast("int").alias("side"))
    return _joined(rows, kind, percent, two=True)


def components(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, text: str = "text",
               id_column: str = "doc_id", heavy: int = HEAVY, heavy_cell: int = HEAVY_CELL,
               ) -> DataFrame:
    """``docs`` without the text, with ``n_shingles``, ``component_id`` (the least id of the
    component) and ``_text`` (digest of the text) and ``_component`` (its name)."""
    prepare(docs.sparkSession)
    own = ("n_shingles", "component_id", "_key", "_node", "_point", "_text", "_component", text)
    rows = docs.select(*others(docs, own),
                       F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("_text"),
                       F.col(text).cast("string").alias("text"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    base = cut_lineage(rows.mapInArrow(_keyer(words), ", ".join(
        [*types, "n_shingles long", "_key binary", "_node long", "_point binary"])), "sets")

    # Cells of one document go; those of the same documents are one.
    found = rows.select("text").mapInArrow(_celler(words, percent), "cell long, node long")
    own = Window.partitionBy("cell")
    held = (found.withColumns({"low": F.min("node").over(own), "high": F.max("node").over(own),
                               "all": F.bit_xor(F.xxhash64("node")).over(own)})
            .filter("low != high")
            .select(F.xxhash64("all", "low", "high").alias("region"), F.col("node").alias("_node"))
            .distinct())
    points = base.filter("_key IS NOT NULL").select(
        "_node", F.col("n_shingles").alias("n"), F.col("_point").alias("content"))
    points = points.dropDuplicates(["_node", "n", "content"])
    held = cut_lineage(held.join(points, "_node").withColumnRenamed("_node", "key")
                       .select(*_MEMBER), "cells")
    near = region_links(held, "points", percent, heavy_cell, None)
    regions = connected(near).select(F.col("node").alias("_node"), F.col("label").alias("region"))

    # One text of each distinct set that shares a region.
    chosen = (base.join(regions, "_node").groupBy("_key")
              .agg(F.min("_text").alias("_text"), F.min("region").alias("region")).drop("_key"))
    members = (rows.select("_text", "text").join(chosen, "_text").select("region", "text")
               .mapInArrow(_setter(words), "region long, key binary, n long, content binary"))
    members = cut_lineage(members, "members")
    labels = connected(region_links(members, "sets", percent, heavy, "n"))

    keys = base.filter("_key IS NOT NULL").groupBy("_key").agg(F.min(id_column).alias("least"))
    keys = (keys.join(labels.withColumnRenamed("node", "_key"), "_key", "left")
            .withColumn("_component", F.coalesce("label", "_key")).drop("label"))
    least = keys.groupBy("_component").agg(F.min("least").alias("component_id"))
    keys = keys.drop("least").join(least, "_component")
    # Left joins of two shuffled sides: adaptive execution splits the rows of frequent copies.
    return (base.join(keys, "_key", "left")
            .withColumn("component_id", F.when(F.col("_key").isNull(), F.col(id_column))
                        .otherwise(F.col("component_id")))
            .drop("_key", "_node", "_point"))


def one_of_each(docs: DataFrame, *, words: int, percent: int, id_column: str = "doc_id",
                ) -> DataFrame:
    """``docs`` with one row of each component: that of the least id. Texts without words stay."""
    rows = narrowed(docs, id_column, "text")
    found = components(rows.select(id_column, "text"), words=words, percent=percent)
    same = F.col(id_column).eqNullSafe(F.col("component_id"))
    first = (found.filter(F.col("_component").isNotNull() & same).groupBy("_component")
             .agg(F.min(F.struct("_text", id_column)).alias("first"))
             .select(F.col("first._text").alias("_text"), F.col(f"first.{id_column}").alias("_id")))
    keyed = rows.withColumn("_text", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    kept = keyed.join(first, (keyed["_text"] == first["_text"])
                      & keyed[id_column].eqNullSafe(first["_id"])).select(keyed["*"])
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    out = (kept.filter(~wordless).dropDuplicates(["_text", id_column])
           .union(keyed.filter(wordless)))
    return widened(out, docs, id_column, "text")


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return components(docs).select("doc_id", "n_shingles", "component_id")


ORACLE = {"op5_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 4) - 1], ' ') AS g
  FROM w, unnest(range(1, len(ws) - least(len(ws), 4) + 2)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * i >= 85 * (a.n + b.n - i)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id, doc_id AS z FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.z)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(z) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""}
QUERIES = {"op5_jaccard_join": op5_jaccard_join}
