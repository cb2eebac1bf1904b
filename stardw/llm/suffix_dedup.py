"""Repeated passages by a sparse suffix array over all texts.

A passage counts when at least ``MIN_WORDS`` consecutive words come twice, in two texts or in one.

1. *Sparse suffixes.* Of the ``GRAM``-word starts in every window of ``MIN_WORDS`` words, the one
   with the least hash is retained. The choice depends on the window's words alone, so wherever
   a passage recurs, the same suffixes are retained in it.
2. Suffixes whose head occurs once are dropped; the others are given their neighbourhood of words.
3. *Sort and compare.* Suffixes are sorted by their words, and each is compared with its
   neighbour, which gives the words they share to the right and, between any two, the least of
   these along the way. For every split of a window into words left and right of the suffix,
   suffixes that share the right part stand in one run of the array; those that also share the
   left part hold the same window. So matches are extended both ways, and found exactly, not only
   between neighbours.
   A suffix answers for the windows of which it is the least.
4. Windows that recur are joined to passages. Of each recurring window the first by (digest of the
   text, place) stays; the others may be cut.

A head with more than ``HOT`` suffixes isn't sorted in one task: its windows are counted by their
hash, each task's part first, and joined back, which adaptive execution splits.

Copies of a whole text are one text throughout: all rows of it have its passages, and if it is long
enough all its words are repeated; the row with the least id keeps them. Null, empty and short
texts have no passages. Rows with the same id and text count as copies and none is cut for the
other. An empty table gives an empty result; columns of the input with the name of a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import narrowed, others, widened
from stardw.llm.words import blocks, covered, mix, windows, words_of
from stardw.session import cut_lineage

MIN_WORDS = 50
GRAM = 8
HOT = 100_000
# Suffixes of a task that are compared at once; runs of one head stay together.
RUN_ROWS = 20_000
# Suffixes with their words that are made at once.
OUT_ROWS = 4_096

_STEP = np.uint64(0x9E6C63D0876A9A47)
_CLASH = ("_text", "_node", "n_words", "n_repeated", "n_cut", "copies", "repeated", "cut")


def minimisers(grams: np.ndarray, left: np.ndarray, min_words: int, gram: int,
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the least gram of every window (the leftmost of equal ones), with the first and
    the last window of which each is the least. Windows between these are its own too."""
    n = min_words - gram + 1
    starts = np.flatnonzero(left >= min_words)
    if not len(starts):
        return starts, starts, starts
    best, reach = np.arange(len(grams)), 1

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)
    while 2 * reach <= n:
        best = least(best[:len(best) - reach], best[reach:])
        reach *= 2
    # The window is two overlapping stretches of ``reach`` starts.
    at, first, times = np.unique(least(best[starts], best[starts + n - reach]),
                                 return_index=True, return_counts=True)
    return at, starts[first], starts[first + times - 1]


def _node(keys: pa.Array) -> np.ndarray:
    """A short name of each text: the first half of its digest."""
    return np.array([int.from_bytes(k[:8], "big", signed=True) for k in keys.to_pylist()], np.int64)


def _fresh(batch: pa.RecordBatch, seen: set[bytes]) -> pa.RecordBatch:
    """The rows whose text the task hasn't met."""
    keep = []
    for key in batch.column("_text").to_pylist():
        keep.append(key not in seen)
        seen.add(key)
    return batch.filter(pa.array(keep, pa.bool_()))


def _header(min_words: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in blocks(batches):
            batch = _fresh(batch, seen)
            words = words_of(batch.column("text"))
            grams = windows(words.hashes(), gram)
            at, _, _ = minimisers(grams, words.left, min_words, gram)
            row = words.row[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), pa.array(_node(batch.column("_text"))[row]),
                 pa.array((at - words.first[row]).astype(np.int32))],
                names=["gram", "node", "pos"])
    return run


def _surrounder(min_words: int, gram: int):
    """Suffixes with the words before them (nearest first) and their own, four bytes each."""
    before, after = min_words - gram, min_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in blocks(batches):
            batch = _fresh(batch, seen)
            if not batch.num_rows:
                continue
            words = words_of(batch.column("text"))
            h = words.hashes()
            grams, left = windows(h, gram), words.left
            known, first, last = minimisers(grams, left, min_words, gram)
            marks = batch.column("marks")
            n = np.diff(marks.offsets.to_numpy())
            rows = np.repeat(np.arange(batch.num_rows), n)
            places = marks.flatten().field("pos").to_numpy().astype(np.int64)
            times = marks.flatten().field("n").cast(pa.int64())
            short = np.concatenate((np.zeros(before, np.uint32), (h >> np.uint64(32)).astype(np.uint32),
                                    np.zeros(after, np.uint32)))
            # In parts: a repetitive text has a suffix at every word.
            for part in range(0, len(places), OUT_ROWS):
                row, pos = rows[part:part + OUT_ROWS], places[part:part + OUT_ROWS]
                at = words.first[row] + pos
                own_windows = np.searchsorted(known, at)
                low, high = at - last[own_windows], at - first[own_windows]
                n_left, n_right = np.minimum(pos, before), np.minimum(left[at], after)
                own = short[(at + before)[:, None] + np.arange(after)]
                own[np.arange(after) >= n_right[:, None]] = 0
                back = short[(at + before - 1)[:, None] - np.arange(before)]
                back[np.arange(before) >= n_left[:, None]] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), batch.column("_text").take(pa.array(row)),
                     pa.array(pos.astype(np.int32)), pa.array(low.astype(np.int32)),
                     pa.array(high.astype(np.int32)), _binary(own), _binary(back),
                     times.slice(part, OUT_ROWS)],
                    names=["gram", "key", "pos", "low", "high", "own", "back", "n"])
    return run


def _binary(a: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(a.shape[1] * 4), len(a),
        [None, pa.py_buffer(a.astype(">u4").tobytes())]).cast(pa.binary())


# ``low`` to ``high``: how many words before the suffix the windows begin of which it is the least.
_SUFFIX = "gram long, key binary, pos int, low int, high int, own binary, back binary, n long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.uint32).reshape(-1, width)


def _places(batch: pa.RecordBatch) -> np.ndarray:
    """Rank of each suffix by (digest, place)."""
    keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u8").reshape(-1, 2)
    pos = batch.column("pos").to_numpy()
    order = np.lexsort((pos, keys[:, 1], keys[:, 0]))
    same = ((keys[order][1:] == keys[order][:-1]).all(axis=1)
            & (pos[order][1:] == pos[order][:-1]))
    rank = np.empty(len(pos), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(~same)))
    return rank


def _left_hash(back: np.ndarray) -> Iterator[np.ndarray]:
    """Hash of the 0, 1, 2 … words before each suffix."""
    h = np.zeros(len(back), np.uint64)
    yield h
    for o in range(back.shape[1]):
        h = mix(h * _STEP + back[:, o].astype(np.uint64) + np.uint64(1))
        yield h


def compare_suffixes(batch: pa.RecordBatch, min_words: int, gram: int) -> pa.RecordBatch:
    """Passages around the suffixes of some heads, sorted by (head, own words)."""
    before, after = min_words - gram, min_words
    rank = _places(batch)
    first = np.sort(np.unique(rank, return_index=True)[1])  # copies from other tasks
    batch, rank = batch.take(pa.array(first)), rank[first]
    heads = batch.column("gram").to_numpy()
    own, back = _matrix(batch.column("own"), after), _matrix(batch.column("back"), before)
    low_o, high_o = (batch.column(c).to_numpy() for c in ("low", "high"))
    differ = own[1:] != own[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), after)
    shared[heads[1:] != heads[:-1]] = 0
    shared = np.concatenate(([0], shared))

    n = len(heads)
    far, near = np.full(n, -1), np.full(n, before + 1)
    cut_far, cut_near = far.copy(), near.copy()
    for o, left in enumerate(_left_hash(back)):
        at = np.flatnonzero((low_o <= o) & (o <= high_o))
        run = np.cumsum(shared < min_words - o)[at].astype(np.uint64)
        key = mix(run * _STEP + left[at])
        order = np.lexsort((rank[at], key))
        key, at = key[order], at[order]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else at
        size = np.diff(np.append(head, len(key)))
        many = np.repeat(size > 1, size)
        stays = np.zeros(len(key), bool)
        stays[head] = True
        for mark, low, high in ((many, near, far), (many & ~stays, cut_near, cut_far)):
            low[at[mark]] = np.minimum(low[at[mark]], o)
            high[at[mark]] = np.maximum(high[at[mark]], o)
    found = np.flatnonzero(far >= 0)
    return _passages(batch.column("key").take(pa.array(found)),
                     batch.column("pos").to_numpy()[found], near[found], far[found],
                     cut_near[found], cut_far[found], min_words)


def _passages(key, pos, near, far, cut_near, cut_far, min_words: int) -> pa.RecordBatch:
    """From the window furthest left to the one furthest right; all hold the suffix's head."""
    cut = cut_far >= 0
    return pa.RecordBatch.from_arrays(
        [key, pa.array((pos - far).astype(np.int32)), pa.array((pos - near + min_words).astype(np.int32)),
         pa.array((pos - cut_far).astype(np.int32), mask=~cut),
         pa.array((pos - cut_near + min_words).astype(np.int32), mask=~cut)],
        names=["key", "start", "end", "cut_start", "cut_end"])


_PASSAGE = "key binary, start int, end int, cut_start int, cut_end int"


def _comparer(min_words: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def solve(table: pa.Table) -> pa.RecordBatch:
            return compare_suffixes(table.combine_chunks().to_batches()[0], min_words, gram)
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, more]) if held is not None else more
            if held.num_rows >= RUN_ROWS:
                heads = held.column("gram").to_numpy()
                whole = int(np.searchsorted(heads, heads[-1], "left"))  # the last may go on
                if whole:
                    yield solve(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield solve(held)
    return run


def _windower(min_words: int, gram: int):
    """The windows around hot suffixes, by the hash of their words."""
    before, after = min_words - gram, min_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                b = batch.slice(part, 1000)
                own, back = _matrix(b.column("own"), after), _matrix(b.column("back"), before)
                low, high = (b.column(c).to_numpy() for c in ("low", "high"))
                head = b.column("gram").to_numpy().view(np.uint64)
                right = [None] * (after + 1)
                right[0] = mix(head)
                for k in range(after):
                    right[k + 1] = mix(right[k] * _STEP + own[:, k].astype(np.uint64) + np.uint64(1))
                out = []
                for o, left in enumerate(_left_hash(back)):
                    at = np.flatnonzero((low <= o) & (o <= high))
                    win = mix(right[min_words - o][at] + left[at] * _STEP + np.uint64(o))
                    out.append((win.view(np.int64), at, np.full(len(at), o, np.int32)))
                win, at, o = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(win), b.column("key").take(pa.array(at)),
                     b.column("pos").take(pa.array(at)), pa.array(o)],
                    names=["win", "key", "pos", "o"])
    return run


def _hot_passages(suffixes: DataFrame, min_words: int, gram: int) -> DataFrame:
    wins = suffixes.mapInArrow(_windower(min_words, gram), "win long, key binary, pos int, o int")
    # Written, so that the join below has nothing between it and its shuffles and can be split.
    wins = cut_lineage(wins, "windows")
    # A text that several tasks hold has the same place in each.
    place = F.struct("key", "pos")
    first = wins.groupBy("win").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = cut_lineage(first.filter("first != last").drop("last"), "first-windows")
    cut = F.when(F.struct("key", "pos") != F.col("first"), F.col("o"))
    found = wins.join(first, "win").groupBy("key", "pos").agg(
        F.min("o").alias("near"), F.max("o").alias("far"),
        F.min(cut).alias("cut_near"), F.max(cut).alias("cut_far"))
    pos = F.col("pos")
    return found.select("key", (pos - F.col("far")).alias("start"),
                        (pos - F.col("near") + min_words).alias("end"),
                        (pos - F.col("cut_far")).alias("cut_start"),
                        (pos - F.col("cut_near") + min_words).alias("cut_end"))


def _merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of a text, joined where they touch, as [start, end, start, end …]."""
    def joined(spans: list[tuple]) -> list[int]:
        out: list[int] = []
        for start, end in sorted(s for s in spans if s[0] is not None):
            if out and start <= out[-1]:
                out[-1] = max(out[-1], end)
            else:
                out += [start, end]
        return out
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        both = [[joined([(s[a], s[b]) for s in own]) for own in spans]
                for a, b in (("start", "end"), ("cut_start", "cut_end"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), *[pa.array(s, pa.list_(pa.int32())) for s in both]],
            names=["_text", "repeated", "cut"])


def _texts(docs: DataFrame, text: str) -> DataFrame:
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(own.alias("text"), F.unhex(F.md5(own)).alias("_text"))


def passages(docs: DataFrame, *, text: str = "text", min_words: int = MIN_WORDS, gram: int = GRAM,
             hot: int = HOT) -> DataFrame:
    """``_text`` (digest), ``repeated`` and ``cut`` of each distinct text with passages."""
    prepare(docs.sparkSession)
    texts = _texts(docs, text)
    heads = texts.mapInArrow(_header(min_words, gram), "gram long, node long, pos int")
    many = heads.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"),
        F.min("pos").alias("c"), F.max("pos").alias("d")).filter("a != b OR c != d")
    many = cut_lineage(many.select("gram", "n"), "heads")
    marks = (heads.join(many, "gram").groupBy("node")
             .agg(F.collect_list(F.struct("pos", "n")).alias("marks")))
    node = F.conv(F.substring(F.hex("_text"), 1, 16), 16, -10).cast("long")
    suffixes = (texts.withColumn("node", node).join(marks, "node").select("text", "_text", "marks")
                .mapInArrow(_surrounder(min_words, gram), _SUFFIX))
    cold = suffixes.filter(F.col("n") <= hot).drop("n")
    found = (cold.repartition("gram").sortWithinPartitions("gram", "own")
             .mapInArrow(_comparer(min_words, gram), _PASSAGE))
    if not many.filter(F.col("n") > hot).isEmpty():
        found = found.union(_hot_passages(suffixes.filter(F.col("n") > hot), min_words, gram))
    spans = found.distinct().groupBy("key").agg(
        F.collect_list(F.struct("start", "end", "cut_start", "cut_end")).alias("spans"))
    return spans.mapInArrow(_merger, "_text binary, repeated array<int>, cut array<int>")


WORD = r"[^\x20\x09-\x0D]+"


def _words_in(spans: str):
    starts = F.filter(F.col(spans), lambda x, i: i % 2 == 0)
    ends = F.filter(F.col(spans), lambda x, i: i % 2 == 1)
    return F.aggregate(F.zip_with(starts, ends, lambda a, b: (b - a).cast("long")),
                       F.lit(0).cast("long"), lambda n, x: n + x)


def find(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id",
         min_words: int = MIN_WORDS, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The rows of ``docs`` with repeated passages, without the text, with ``n_words``,
    ``copies`` (rows with the same text), the spans ``repeated`` and ``cut`` as [start, end …]
    in words, and how many words these hold."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*others(docs, (*_CLASH, text)),
                       F.unhex(F.md5(own)).alias("_text"),
                       F.regexp_count(own, F.lit(WORD)).cast("long").alias("n_words"))
    copies = (rows.filter(F.col("n_words") >= min_words).groupBy("_text")
              .agg(F.count(F.lit(1)).alias("copies"), F.min(id_column).alias("_least"))
              .filter("copies > 1"))
    spans = cut_lineage(passages(docs, text=text, min_words=min_words, gram=gram, hot=hot), "spans")
    known = spans.join(copies, "_text", "full")
    whole = F.array(F.lit(0), F.col("n_words").cast("int"))
    copied = F.col("copies").isNotNull()
    later = copied & ~F.col(id_column).eqNullSafe(F.col("_least"))
    none = F.array().cast("array<int>")
    found = (rows.join(known, "_text")
             .withColumn("repeated", F.when(copied, whole).otherwise(F.col("repeated")))
             .withColumn("cut", F.when(later, whole).otherwise(F.coalesce("cut", none)))
             .withColumn("copies", F.coalesce("copies", F.lit(1)))
             .drop("_least"))
    return (found.withColumn("n_repeated", _words_in("repeated"))
            .withColumn("n_cut", _words_in("cut")))


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        texts = batch.column("text").to_pylist()
        words = words_of(batch.column("text"))
        for i, spans in enumerate(batch.column("cut").to_pylist()):
            if not spans:
                continue
            a, z = words.first[i:i + 2]
            start = (words.start[a:z] - words.bounds[i]).tolist()
            data = (texts[i] or "").encode()
            kept, at = [], 0
            for first, last in zip(spans[::2], spans[1::2]):
                kept.append(data[at:start[first]])
                at = start[last] if last < len(start) else len(data)
            texts[i] = b"".join([*kept, data[at:]]).decode()
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names],
            names=names)


def remove(docs: DataFrame, *, id_column: str = "doc_id", min_words: int = MIN_WORDS,
           gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with repeated passages cut from all places but one.

    A text that is cut has its ``n_chars`` counted anew; one of which nothing is left goes.
    """
    needed = [id_column, "text", *[c for c in docs.columns if c == "n_chars"]]
    found = find(docs.select(id_column, "text"), id_column=id_column, min_words=min_words,
                 gram=gram, hot=hot)
    # One row for each text and id; the rows of one id have the same spans.
    cuts = (found.filter("n_cut > 0").select("_text", F.col(id_column).alias("_id"), "cut")
            .dropDuplicates(["_text", "_id"]))
    keyed = narrowed(docs, *needed).withColumn(
        "_text", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    rows = keyed.join(cuts, (keyed["_text"] == cuts["_text"])
                      & keyed[id_column].eqNullSafe(cuts["_id"]), "left").select(
        *[keyed[c] for c in (*needed, "_rest")], cuts["cut"])
    done = rows.mapInArrow(_cutter, rows.schema)
    empty = F.col("cut").isNotNull() & ~F.coalesce(
        F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    if "n_chars" in needed:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("cut").isNull(), F.col("n_chars"))
                               .otherwise(counted))
    return widened(done.filter(~empty), docs, *needed)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    starts = F.filter("repeated", lambda x, i: i % 2 == 0)
    ends = F.filter("repeated", lambda x, i: i % 2 == 1)
    spans = F.array_join(F.zip_with(starts, ends, lambda a, b: F.concat_ws(
        "-", a.cast("string"), b.cast("string"))), ",")
    return find(docs).select("doc_id", "n_words", "copies", "n_repeated", "n_cut",
                             spans.alias("spans"))


ORACLE = {"op1_suffix_dedup": r"""
WITH d AS (
  SELECT doc_id, md5(coalesce(text, '')) AS k,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT k, any_value(ws) AS ws, count(*) AS copies, min(doc_id) AS least FROM d GROUP BY k),
w AS (SELECT k, i, array_to_string(ws[i + 1:i + 50], ' ') AS g
  FROM t, unnest(range(0, len(ws) - 49)) AS u(i) WHERE len(ws) >= 50),
m AS (SELECT k, i, row_number() OVER (PARTITION BY g ORDER BY k, i) AS nth,
  count(*) OVER (PARTITION BY g) AS n FROM w),
p AS (SELECT k, p, max(nth > 1) AS cut FROM
  (SELECT k, nth, unnest(range(i, i + 50)) AS p FROM m WHERE n > 1) GROUP BY k, p),
c AS (SELECT k, p FROM p UNION SELECT k, unnest(range(0, len(ws))) FROM t
  WHERE copies > 1 AND len(ws) >= 50),
s AS (SELECT k, min(p) AS a, max(p) + 1 AS z FROM
  (SELECT k, p, p - row_number() OVER (PARTITION BY k ORDER BY p) AS island FROM c) GROUP BY k, island),
r AS (SELECT k, sum(z - a) AS n_repeated, string_agg(a || '-' || z, ',' ORDER BY a) AS spans
  FROM s GROUP BY k),
x AS (SELECT k, count(*) AS n_cut FROM p WHERE cut GROUP BY k)
SELECT doc_id, len(d.ws)::BIGINT AS n_words,
  CASE WHEN len(d.ws) >= 50 THEN copies ELSE 1 END::BIGINT AS copies,
  n_repeated::BIGINT AS n_repeated,
  CASE WHEN copies > 1 AND doc_id <> least THEN len(d.ws) ELSE coalesce(n_cut, 0) END::BIGINT AS n_cut,
  spans
FROM d JOIN t USING (k) JOIN r USING (k) LEFT JOIN x USING (k)
"""}
QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
