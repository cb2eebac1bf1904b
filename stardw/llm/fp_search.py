"""Ranked lexical search in trees of documents that share paths of frequent terms.

The documents are cut down to the terms of the items: a vector of terms and their numbers. A shard
of documents (about ``SHARD_ENTRIES`` entries) puts its vectors, terms in falling order of the
number of documents that hold them, into a tree: vectors with the same first terms share a path.
Every subtree knows the largest number of each of its terms and its least length part ``m``. The
score rises with the one and falls with the other, so these two give a score that no document of
the subtree exceeds. Each item goes down the tree depth first, the best subtree first, and leaves
out those that can't reach its ``k`` best so far, which it carries from shard to shard of a task.
Subtrees of at most ``BUCKET`` documents are leaves, whose documents are scored exactly.

At scale: one pass over the texts gives the vectors, which are written, with what the statistics
need; counts are summed by term with a map-side combine; one pass over the vectors searches, with
nothing shuffled but each task's best. The best of all tasks meet in two steps, so that no task
gets the rows of all. The items go to the tasks in parts of about ``PART_BYTES`` of text, and each
part's result is written before the next begins, so they may be of any number. The memory of a task
is that of a block of texts, or of a shard and of the best of a part's items. A lost task repeats its
own rows.

Terms are told apart by 64-bit hashes. Null texts, and texts without terms, have no terms: such
documents aren't counted and such items have no rows; an item whose terms no document holds has none
either. Items are told apart by their rows: two with one id, or without one, each have their rows.
Of equal scores the lower id comes first, a null id last, and documents that agree in both have
consecutive ranks in any order. Ids may be of any type that has an order. Further columns of either
table are ignored. Empty tables give empty results. A text of any length is read in whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stardw.llm.cluster import prepare
from stardw.llm.words import ALNUM, FOLD, blocks, words_of
from stardw.session import cut_lineage

BEST = 20
PART_BYTES = 4 << 20
SHARD_ENTRIES = 1 << 20
BUCKET = 128
# Rows of an item's result that one task ranks first: those of one in so many documents.
SPREAD = 16

# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, of which A-Z are folded to lower case.
TERM = ALNUM[FOLD]


@dataclass
class Items:
    """A part of the items: distinct terms by hash, and the terms of each with their repeats."""

    key: np.ndarray
    term: list[np.ndarray]
    times: list[np.ndarray]


def parsed(texts: list[str | None]) -> Items:
    words = words_of(pa.array(texts, pa.large_string()), TERM, fold=True)
    key, at = np.unique(words.hashes(), return_inverse=True)
    counted = [np.unique(at[a:b], return_counts=True)
               for a, b in zip(words.first[:-1], words.first[1:])]
    return Items(key, [t for t, _ in counted], [c for _, c in counted])


def restricted(words, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of a block: bounds in, and values of, its terms among ``key`` and their numbers."""
    rows = len(words.first) - 1
    if not len(key) or not len(words.start):
        return np.zeros(rows + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = words.hashes()
    at = np.minimum(np.searchsorted(key, h), len(key) - 1)
    found = key[at] == h
    pair, count = np.unique(words.row[found] * len(key) + at[found], return_counts=True)
    return np.searchsorted(pair // len(key), np.arange(rows + 1)), pair % len(key), count


def _vectors(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sent.value
        for batch in blocks(batches):
            words = words_of(batch.column("text"), TERM, fold=True)
            ptr, term, count = restricted(words, key)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.count, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(count, pa.int32()))],
                names=["doc_id", "n", "term", "tf"])
    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_part(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m: 75 and the length against the mean one."""
    if int(n.max(initial=0)) * 25 * documents < 1 << 63:
        return 75 + 25 * documents * n.astype(np.int64) // terms
    return np.array([75 + 25 * documents * int(x) // terms for x in n], np.int64)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


@dataclass
class Query:
    """An item for the search: its terms by rank, rising, and the weights of their repeats."""

    at: int
    term: np.ndarray
    weight: np.ndarray


class Shard:
    """The tree of a shard. Documents stand in the order of their vectors, so a subtree is a range.

    ``ptr``, ``term`` and ``tf`` are the vectors, terms as ranks by frequency; ``m`` the length
    parts. Node ``v`` has the documents ``low[v]:high[v]`` and the children ``kids[v]``, none if it
    is a leaf. ``key`` are node and term of all subtrees in order, ``most`` the largest numbers.
    """

    def __init__(self, ptr: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray,
                 terms: int, bucket: int = BUCKET):
        self.terms = max(1, terms)
        size = np.diff(ptr)
        row = np.repeat(np.arange(len(size)), size)
        by_rank = np.lexsort((term, row))
        term, tf = term[by_rank], tf[by_rank]
        big = term.astype(">u4").tobytes()
        paths = [big[4 * a:4 * b] for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
        self.order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        size = size[self.order]
        self.ptr = np.concatenate(([0], np.cumsum(size)))
        flat = np.arange(self.ptr[-1]) - np.repeat(self.ptr[:-1] - ptr[self.order], size)
        self.term, self.tf, self.m = term[flat], tf[flat], m[self.order]
        self.gain = gain(self.tf, np.repeat(self.m, size))
        self._grow(self._shared(), max(1, bucket))
        self._sum_up()

    def _shared(self) -> np.ndarray:
        """How many first terms each document shares with the one before it."""
        size, start = np.diff(self.ptr), self.ptr[:-1]
        shared = np.zeros(len(size), np.int64)
        going = np.arange(1, len(size))
        depth = 0
        while len(going):
            going = going[(size[going] > depth) & (size[going - 1] > depth)]
            going = going[self.term[start[going] + depth] == self.term[start[going - 1] + depth]]
            depth += 1
            shared[going] = depth
        return shared

    def _grow(self, shared: np.ndarray, bucket: int) -> None:
        self.low, self.high, self.kids, self.depth = [0], [len(shared)], [range(0)], [0]
        open_ = [0]
        while open_:
            v = open_.pop()
            low, high = self.low[v], self.high[v]
            if high - low <= bucket:
                continue
            # The path goes on as long as all share it, then it parts.
            inner = shared[low + 1:high]
            edges = [low, *(low + 1 + np.flatnonzero(inner == inner.min())).tolist(), high]
            first = len(self.low)
            for a, b in zip(edges, edges[1:]):
                # Small neighbours are one leaf.
                if len(self.low) > first and b - self.low[-1] <= bucket:
                    self.high[-1] = b
                else:
                    for grown, value in ((self.low, a), (self.high, b), (self.kids, range(0)),
                                         (self.depth, self.depth[v] + 1)):
                        grown.append(value)
            self.kids[v] = range(first, len(self.low))
            open_ += self.kids[v]

    def _sum_up(self) -> None:
        """Least ``m`` and largest numbers of each subtree, from the leaves up."""
        parent = np.zeros(len(self.low), np.int64)
        for v, kids in enumerate(self.kids):
            parent[kids.start:kids.stop] = v
        depth = np.array(self.depth)
        leaf = np.zeros(len(self.m), np.int64)
        for v, kids in enumerate(self.kids):
            if not kids:
                leaf[self.low[v]:self.high[v]] = v
        self.least = np.full(len(self.low), np.iinfo(np.int64).max)
        np.minimum.at(self.least, leaf, self.m)
        own = np.repeat(leaf, np.diff(self.ptr))
        keys, mosts = [], []
        key, most = _largest(own * self.terms + self.term, self.tf)
        above = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = depth[key // self.terms]
        for level in range(int(depth.max()), -1, -1):
            mine = at == level
            both = _largest(np.concatenate((key[mine], above[0])),
                            np.concatenate((most[mine], above[1])))
            keys.append(both[0])
            mosts.append(both[1])
            if level:
                node = both[0] // self.terms
                above = parent[node] * self.terms + both[0] % self.terms, both[1]
                nodes = np.flatnonzero(depth == level)
                np.minimum.at(self.least, parent[nodes], self.least[nodes])
        order = np.argsort(key := np.concatenate(keys))
        self.key, self.most = key[order], np.concatenate(mosts)[order]

    def bounds(self, nodes: np.ndarray, query: Query) -> np.ndarray:
        """Scores that no document of each subtree exceeds."""
        wanted = nodes[:, None] * self.terms + query.term
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        tf = np.where(self.key[at] == wanted, self.most[at], 0)
        return gain(tf, self.least[nodes][:, None]) @ query.weight

    def scores(self, v: int, weights: np.ndarray) -> np.ndarray:
        """Scores of the documents of a leaf; ``weights`` are the item's by term."""
        a, b = self.low[v], self.high[v]
        each = weights[self.term[self.ptr[a]:self.ptr[b]]] * self.gain[self.ptr[a]:self.ptr[b]]
        sums = np.concatenate(([0], np.cumsum(each)))
        return np.diff(sums[self.ptr[a:b + 1] - self.ptr[a]])

    def search(self, query: Query, weights: np.ndarray, best: Best) -> int:
        """Offer what can be among the best; gives the number of leaves scored."""
        if not len(self.key):
            return 0
        stack, seen = [(np.inf, 0)], 0
        while stack:
            bound, v = stack.pop()
            if bound < best.least:
                continue
            kids = self.kids[v]
            if kids:
                bounds = self.bounds(np.arange(kids.start, kids.stop), query)
                order = np.argsort(bounds, kind="stable")
                order = order[bounds[order] >= best.least]
                stack += zip(bounds[order].tolist(), (order + kids.start).tolist())
            else:
                seen += 1
                scores = self.scores(v, weights)
                found = np.flatnonzero(scores >= best.least)
                if len(found):
                    best.offer(scores[found].tolist(), self.order[found + self.low[v]].tolist())
        return seen


def _largest(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, rising, with its largest value."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.maximum.reduceat(value, first)


class Best:
    """The ``k`` best documents of an item so far; ``least`` is the score one more must reach."""

    def __init__(self, k: int):
        self.k, self.least, self.rows, self.ids = k, 1, [], None

    def offer(self, scores: list[int], places: list[int]) -> None:
        self.rows += [(-s, i is None, i) for s, i in zip(scores, map(self.ids.__getitem__, places))]
        self.rows.sort(key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
        del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


@dataclass
class Search:
    """What a task needs to search: ranks and weights of the terms, the items, the statistics."""

    rank: np.ndarray
    queries: list[Query]
    documents: int
    terms: int
    k: int


def prepared(items: Items, df: np.ndarray, documents: int, terms: int, k: int) -> Search:
    order = np.argsort(-df, kind="stable")
    rank = np.empty(len(df), np.int64)
    rank[order] = np.arange(len(df))
    weights = np.array([weight(documents, int(d)) for d in df], np.int64)
    queries = []
    for at, (term, times) in enumerate(zip(items.term, items.times)):
        term, times = term[df[term] > 0], times[df[term] > 0]
        by_rank = np.argsort(rank[term])
        if len(term):
            queries.append(Query(at, rank[term][by_rank], (weights[term] * times)[by_rank]))
    return Search(rank, queries, documents, terms, k)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, lengths and vectors of about ``SHARD_ENTRIES`` entries."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("term").flatten())
        if size >= SHARD_ENTRIES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _searcher(sent, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = sent.value
        found = [Best(search.k) for _ in search.queries]
        weights = np.zeros(len(search.rank), np.int64)
        for held in _shards(batches):
            table = pa.Table.from_batches(held)
            term, tf = table.column("term").combine_chunks(), table.column("tf").combine_chunks()
            size = np.asarray(term.value_lengths(), np.int64)
            shard = Shard(np.concatenate(([0], np.cumsum(size))),
                          search.rank[np.asarray(term.flatten())],
                          np.asarray(tf.flatten(), np.int64),
                          length_part(np.asarray(table.column("n")), search.documents, search.terms),
                          len(search.rank))
            ids = table.column("doc_id").to_pylist()
            for query, best in zip(search.queries, found):
                weights[query.term] = query.weight
                best.ids = ids
                shard.search(query, weights, best)
                weights[query.term] = 0
        rows = [(q.at, i, -s) for q, best in zip(search.queries, found) for s, _, i in best.rows]
        at, ids, scores = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
            names=["at", "doc_id", "score"])
    return run


def _top(rows: DataFrame, by: list, k: int) -> DataFrame:
    """The ``k`` best rows of each group, with their ``rank``."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return (rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
            .filter(F.col("rank") <= k))


def _part(docs: DataFrame, items: DataFrame, rows: list, k: int) -> DataFrame:
    """The best documents of the items ``rows``, as (id, text), of one part; written."""
    spark = docs.sparkSession
    parsed_items = parsed([text for _, text in rows])
    key = spark.sparkContext.broadcast(parsed_items.key)
    id_field = docs.schema["doc_id"]
    vectors = docs.mapInArrow(
        _vectors(key), docs.select("doc_id").schema.add("n", "long")
        .add("term", T.ArrayType(T.IntegerType())).add("tf", T.ArrayType(T.IntegerType())),
    ).filter("n > 0")
    vectors = cut_lineage(vectors, "vectors")
    documents, terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(parsed_items.key), np.int64)
    # As many rows as the part has terms.
    counted = vectors.select(F.explode("term").alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("df"))
    for row in counted.toLocalIterator():
        df[row.t] = row.df
    sent = spark.sparkContext.broadcast(
        prepared(parsed_items, df, documents, int(terms or 0), k))
    best = vectors.select("doc_id", "n", "term", "tf").filter(F.size("term") > 0).mapInArrow(
        _searcher(sent, to_arrow_type(id_field.dataType)),
        docs.select(F.lit(0).alias("at"), "doc_id", F.lit(0).cast("long").alias("score")).schema)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD))
    best = _top(_top(best.withColumn("_spread", spread), ["at", "_spread"], k), ["at"], k)
    names = spark.createDataFrame([(at, i) for at, (i, _) in enumerate(rows)],
                                  items.select(F.lit(0).alias("at"), "item_id").schema)
    return cut_lineage(best.join(F.broadcast(names), "at")
                       .select("item_id", "rank", "doc_id", "score"), "ranked")


def ranked(docs: DataFrame, items: DataFrame, *, k: int = BEST, part_bytes: int = PART_BYTES,
           ) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    made = []
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = [tuple(r) for r in own.toLocalIterator()]
        if rows or part == parts - 1 and not made:
            made.append(_part(docs, items, rows, k))
    out = made[0]
    for more in made[1:]:
        out = out.union(more)
    return out


def op13_fp_search(spark, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                  spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = {"op13_fp_search": r"""
WITH d AS (
  SELECT doc_id, t.term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents) AS t GROUP BY doc_id, t.term),
q AS (
  SELECT item_id, t.term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) AS t GROUP BY item_id, t.term),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM d GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM n),
m AS (SELECT doc_id, 75 + (25 * n * big_n) // big_l AS m FROM n, s),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM d GROUP BY term), s),
r AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN d USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM r WHERE score > 0) WHERE rank <= 20
"""}
QUERIES = {"op13_fp_search": op13_fp_search}
