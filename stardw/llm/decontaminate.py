"""Benchmark decontamination: test suffixes searched in suffix arrays of the training texts.

Each task sorts the word suffixes of a shard of documents (about ``SHARD_BYTES`` of text) by a hash
of their first ``window`` words. Suffixes that agree in that many words then stand side by side,
whatever the order of the rest, so a binary search with the head of a test suffix finds exactly the
places where the test text goes on for ``window`` words or more. From there the match is followed
word by word to its full length. The array of a shard lives only while its task runs; nothing is
shuffled, and a lost task repeats its own shard alone.

The test texts go to every task in parts of at most ``PART_BYTES``, so they may be of any size. Of
several parts one is sent at a time: the documents are written with a number each, each part gets a
job of its own that writes the hits by number, and these are put together by number at the end.

Nulls, empty texts and texts without words have no words: they hit nothing and are never hit. An
item shorter than the window is one window of all its words; an item without an id marks words but
is not listed. Ids may be of any type that has an order. A text of any length is read in whole. Of
the longest matches of an item, the first in the document stands for the others. Equal rows give equal results, an empty table gives an empty one, and columns of the
input that share a name with a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stardw.llm.cluster import prepare
from stardw.llm.frames import narrowed, others, widened
from stardw.llm.words import ALNUM, Words, blocks, covered, windows, words_of
from stardw.session import cut_lineage, scratch_dir

WINDOW = 10
SHARD_BYTES = 2 << 20
PART_BYTES = 16 << 20

RESULTS = ["n_words", "n_hit", "hit_spans", "item_ids", "longest"]


def _kinds(id_type: T.DataType) -> dict[str, T.DataType]:
    """Types of ``RESULTS`` for items with ids of ``id_type``."""
    longest = T.StructType([T.StructField("item_id", id_type), *[
        T.StructField(n, T.IntegerType()) for n in ("item_start", "doc_start", "words")]])
    return dict(zip(RESULTS, (T.LongType(), T.LongType(), T.ArrayType(T.IntegerType()),
                              T.ArrayType(id_type), T.ArrayType(longest))))


@dataclass
class Heads:
    """Distinct heads of test suffixes, sorted; ``at[ptr[k]:ptr[k + 1]]`` are those of head ``k``,
    one suffix for each item."""

    key: np.ndarray
    ptr: np.ndarray
    at: np.ndarray


@dataclass
class Test:
    """The test texts of one part as words, and their suffixes by the length of the head."""

    ids: list
    h: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    heads: dict[int, Heads]


def test_suffixes(items: list[tuple], window: int) -> Test:
    """Heads of all suffixes of ``window`` words, and the whole of each shorter item."""
    words = words_of(pa.array([text for _, text in items], pa.large_string()), ALNUM, fold=True)
    h, left, row, count = words.hashes(), words.left, words.row, words.count
    offset = np.arange(len(h)) - np.repeat(words.first[:-1], count)
    heads = {}
    for length in np.unique(np.minimum(count[count > 0], window)):
        fits = left >= window if length == window else (offset == 0) & (left == length)
        at = np.flatnonzero(fits)
        key = windows(h, int(length))[at]
        order = np.lexsort((at, row[at], key))
        key, at = key[order], at[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (row[at[1:]] != row[at[:-1]])
        key, at = key[fresh], at[fresh]
        distinct, ptr = np.unique(key, return_index=True)
        heads[int(length)] = Heads(distinct, np.append(ptr, len(key)), at)
    return Test([i for i, _ in items], h, row, offset, left, heads)


def members(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges ``low[i]:high[i]``, and the ``i`` each belongs to."""
    n = high - low
    which = np.repeat(np.arange(len(low)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def common_words(a: np.ndarray, i: np.ndarray, a_left: np.ndarray,
                 b: np.ndarray, j: np.ndarray, b_left: np.ndarray, sure: int) -> np.ndarray:
    """Words that the suffixes ``a[i:]`` and ``b[j:]`` share, knowing they share ``sure``."""
    most = np.minimum(a_left[i], b_left[j])
    length = np.minimum(most, sure)
    going = np.flatnonzero(length < most)
    while len(going):
        going = going[a[i[going] + length[going]] == b[j[going] + length[going]]]
        length[going] += 1
        going = going[length[going] < most[going]]
    return length


def search(words: Words, test: Test) -> tuple[np.ndarray, dict[int, list[tuple]]]:
    """Which words of a shard are hit, and for each row hit (item, item place, place, words)."""
    h, left, row = words.hashes(), words.left, words.row
    hit = np.zeros(len(h), bool)
    by_row: dict[int, list] = {}
    for length, heads in test.heads.items():
        places = np.flatnonzero(left >= length)
        keys = windows(h, length)[places]
        order = np.argsort(keys)  # the suffix array of the shard
        array = keys[order]
        which, place = members(np.searchsorted(array, heads.key, "left"),
                               np.searchsorted(array, heads.key, "right"))
        place = places[order[place]]
        if not len(place):
            continue
        hit |= covered(place, length, len(h))
        # The first place of a head in a document stands for the others.
        sort = np.lexsort((place, which, row[place]))
        which, place = which[sort], place[sort]
        fresh = np.ones(len(which), bool)
        fresh[1:] = (which[1:] != which[:-1]) | (row[place[1:]] != row[place[:-1]])
        which, place = which[fresh], place[fresh]
        pair, at = members(heads.ptr[which], heads.ptr[which + 1])
        i, j = place[pair], heads.at[at]
        size = common_words(h, i, left, test.h, j, test.left, length)
        for r, item, *match in zip(row[i].tolist(), test.item[j].tolist(), test.offset[j].tolist(),
                                   (i - words.first[row[i]]).tolist(), size.tolist()):
            known = test.ids[item]
            by_row.setdefault(r, []).append(None if known is None else (known, *match))
    return hit, by_row


def _merge(spans: list[int], more: list[int]) -> list[int]:
    """Two lists [start, end, start, end …] as one, ordered and without overlap."""
    out: list[int] = []
    for start, end in sorted(zip([*spans[::2], *more[::2]], [*spans[1::2], *more[1::2]])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _best(*found: list[tuple]) -> list[dict]:
    """The longest match of each item, the first of equal ones, by item."""
    best: dict = {}
    for m in (m for matches in found for m in matches if m):
        known = best.get(m[0])
        if known is None or (m[3], -m[2], -m[1]) > (known[3], -known[2], -known[1]):
            best[m[0]] = m
    return [dict(zip(("item_id", "item_start", "doc_start", "words"), best[i])) for i in sorted(best)]


def _searcher(sent, text: str, kinds: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = sent.value
        for batch in blocks(batches, text, SHARD_BYTES):
            words = words_of(batch.column(text), ALNUM, fold=True)
            hit, by_row = search(words, test)
            spans, longest = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for r, found in by_row.items():
                own = hit[words.first[r]:words.first[r + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(int)))
                spans[r], longest[r] = edges.tolist(), _best(found)
            values = (words.count, [sum(s[1::2]) - sum(s[::2]) for s in spans], spans,
                      [[m["item_id"] for m in ms] for ms in longest], longest)
            made = {n: pa.array(v, to_arrow_type(kinds[n])) for n, v in zip(RESULTS, values)}
            yield pa.RecordBatch.from_arrays(
                [made.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)],
                names=batch.schema.names)
    return run


def _together(kinds: dict):
    """Hits of one document from several parts, as rows of lists, made one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, longest = [], []
            for row in batch.select(["hit_spans", "longest"]).to_pylist():
                one: list[int] = []
                for more in row["hit_spans"]:
                    one = _merge(one, more)
                spans.append(one)
                longest.append(_best(*[[tuple(m.values()) for m in ms] for ms in row["longest"]]))
            values = (None, [sum(s[1::2]) - sum(s[::2]) for s in spans], spans,
                      [[m["item_id"] for m in ms] for ms in longest], longest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), *[pa.array(v, to_arrow_type(kinds[n]))
                                         for n, v in zip(RESULTS[1:], values[1:])]],
                names=["_row", *RESULTS[1:]])
    return run


def matches(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, text: str = "text",
            part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with the columns of ``RESULTS``; ``items`` has ``item_id`` and ``text``.

    ``hit_spans`` are the words hit, as [start, end, start, end …]. ``longest`` has, for each item
    with a window in the document, its longest match there, by the first place of each window.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    kinds = _kinds(items.schema["item_id"].dataType)
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))

    def searched(rows: DataFrame, part: int):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        test = test_suffixes([tuple(r) for r in own.toLocalIterator()], window)
        sent = spark.sparkContext.broadcast(test)
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()})
        return rows.mapInArrow(_searcher(sent, text, kinds), rows.schema), sent

    kept = docs.select(*others(docs, RESULTS))
    if parts == 1:
        return searched(kept, 0)[0]
    numbered = cut_lineage(kept.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    folder = scratch_dir(spark, "hits")
    for part in range(parts):
        found, sent = searched(numbered.select("_row", text), part)
        # All documents with the first part, for their number of words; then those that are hit.
        found = found.drop(text) if part == 0 else found.drop(text).filter("n_hit > 0")
        found.write.parquet(f"{folder}/part={part}")
        sent.unpersist()
    hits = spark.read.schema(found.schema).parquet(folder).drop("part")
    lists = hits.filter("n_hit > 0").groupBy("_row").agg(
        F.collect_list("hit_spans").alias("hit_spans"), F.collect_list("longest").alias("longest"))
    schema = T.StructType([found.schema["_row"], *[found.schema[n] for n in RESULTS[1:]]])
    hits_of = lists.mapInArrow(_together(kinds), schema)
    words = hits.filter("n_words IS NOT NULL").groupBy("_row").agg(F.max("n_words").alias("n_words"))
    none = {n: F.lit(0).cast("long") if n == "n_hit" else F.array().cast(kinds[n]) for n in RESULTS[1:]}
    return (numbered.join(words, "_row").join(hits_of, "_row", "left")
            .withColumns({n: F.coalesce(F.col(n), empty) for n, empty in none.items()})
            .select(*kept.columns, *RESULTS))


def remove(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of any item."""
    found = matches(narrowed(docs, "text"), items, window=window)
    return widened(found.filter("n_hit = 0"), docs, "text")


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    listed = F.array_join(F.array_sort(F.col("item_ids").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(listed, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = {"op8_decontaminate": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS t(i) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM w, ks, unnest(range(1, len(ws) - k + 2)) AS t(i) WHERE len(ws) >= k),
m AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM m GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""}
QUERIES = {"op8_decontaminate": op8_decontaminate}
