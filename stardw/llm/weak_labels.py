"""Quality classifier without labels: heuristics vote, EM weighs them, a hashed scorer learns.

1. Every whole text gets the votes of overlapping heuristic labellers: good, bad or none. They look
   at its length, words, symbols, repetition, lines, letters and capitals. What can't be told of a
   text (where words end in scripts without spaces, capitals in scripts without them) is no vote.
2. Expectation-maximisation estimates how often each labeller votes what on good and on bad texts
   (they are taken as independent given the truth). It needs no texts, only how often each pattern
   of votes occurs, counted over all documents. Patterns are few, however many documents there are:
   at most ``3 ** labellers`` for each of the sets of labellers that can be told together.
3. The posterior of its pattern labels each text of a bounded sample, and a logistic scorer over
   hashed features is fitted to them: byte trigrams, and the steps of the statistics the labellers
   look at. A text counts the less the fewer labellers vote on it, so the scorer judges these by
   what it learnt of the others. The sample are the ``sample`` distinct texts of least hash, of any
   length, each whole and once, however often it is copied. Their features are made in the tasks.
   The driver holds those of the first texts by hash that come to ``sample_cells`` features: all of
   them, unless texts of over about 20 KB prevail; of the longest possible texts at least 488.
4. The scorer judges all documents. It carries what the labellers agree on over to texts on which
   they are silent.

Null and empty texts have no features but the bias and the steps of their zero counts. Equal rows
get equal scores; an empty table gives an empty result, and a table on which the labellers never
disagree gets the prior. So does every text if ``sample`` is 0. Columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import others
from stardw.llm.quality_rules import _per_row, _seen_before, base_counts
from stardw.llm.words import Words, blocks, mix, raw_bytes, words_of
from stardw.session import cut_lineage

BITS = 15
SAMPLE = 4_000
SAMPLE_CELLS = 16_000_000
FIT_CELLS = 1_000_000
ROUNDS, EPOCHS, RATE, DECAY = 200, 80, 0.5, 1e-5

# Fixed values, for each statistic: bad below, good from, good up to, bad above.
LABELLERS = {
    "words": (50, 80, 20_000, 100_000),
    "word_length": (2.5, 3.2, 9.0, 14.0),
    "symbols": (None, 0.0, 0.002, 0.10),
    "repeated": (None, 0.0, 0.08, 0.30),
    "dup_lines": (None, 0.0, 0.01, 0.25),
    "distinct": (0.12, 0.30, 1.0, None),
    "line_ends": (0.30, 0.70, 1.0, None),
    "letters": (0.70, 0.85, 1.0, None),
    "worded": (0.80, 0.95, 1.0, None),
    "capitals": (None, 0.0, 0.20, 0.50)}
# Steps of the statistics as features.
_STEPS = np.array([0, 0.002, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.7, 0.85, 1.5, 3, 5, 8, 14, 50, 80,
                   200, 1000, 20_000, 100_000])
_END = np.isin(np.arange(256), np.frombuffer(b".!?:\")", np.uint8))
# The bytes of other marks that end a line, the last three of each as one number.
_MARKS = np.array([int.from_bytes(m.encode()[-3:], "big") for m in (
    "…", "”", "’", "。", "！", "？", "」", "』", "）", "।", "።", "។")])
_SHORT_MARKS = np.array([int.from_bytes(m.encode(), "big") for m in ("»", "؟", "۔", "։")])
_LETTER = np.isin(np.arange(256), np.frombuffer(
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)) | (np.arange(256) >= 0x80)
_CAPITAL = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_CASED = _CAPITAL | ((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A))
_LINE = np.arange(256) != 0x0A
UNTOLD = 2
# Characters of scripts without spaces between words that make about one word.
CHARS_A_WORD = 2


def _unspaced(data: np.ndarray) -> np.ndarray:
    """First bytes of Han, Kana, Thai, Lao, Khmer and Burmese characters."""
    second = np.append(data[1:], np.uint8(0))
    return (((data >= 0xE3) & (data <= 0xE9))
            | ((data == 0xE0) & (second >= 0xB8) & (second <= 0xBB))
            | ((data == 0xE1) & (((second >= 0x80) & (second <= 0x82))
                                 | (second == 0x9E) | (second == 0x9F))))


def _ended(lines: Words) -> np.ndarray:
    """Which lines end with a mark that ends sentences or clauses."""
    at = lines.end - 1
    last = lines.data[at].astype(np.int64)
    before = np.where(at > lines.start, lines.data[np.maximum(at - 1, 0)], 0).astype(np.int64)
    third = np.where(at > lines.start + 1, lines.data[np.maximum(at - 2, 0)], 0).astype(np.int64)
    two = before << 8 | last
    return _END[lines.data[at]] | np.isin(two, _SHORT_MARKS) | np.isin(third << 16 | two, _MARKS)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row for each text, one column for each of ``LABELLERS``; NaN where one can't be told.

    Where most letters are of scripts without spaces, words are counted by their characters, and
    what depends on where words end is not told; nor is what no line or letter shows.
    """
    base = base_counts(texts)
    words, lines = words_of(texts), words_of(texts, _LINE)
    rows = len(texts)
    n = np.maximum(base["n_words"], 1)
    order, same = _seen_before(words.hashes(), words.row)
    distinct = np.bincount(words.row[order][~same], minlength=rows)
    inked = np.maximum(np.bincount(lines.row, minlength=rows), 1)
    ended = np.bincount(lines.row[_ended(lines)], minlength=rows)
    chars = np.maximum(base["word_chars"], 1)
    letter = _LETTER[words.data]
    letters = _per_row(letter & ((words.data & 0xC0) != 0x80), words.bounds)
    in_word = np.concatenate(([0], np.cumsum(letter, dtype=np.int64)))
    worded = np.bincount(words.row[in_word[words.end] > in_word[words.start]], minlength=rows)
    unspaced = _per_row(_unspaced(words.data), words.bounds)
    dense = 2 * unspaced > np.maximum(letters, 1)
    cased = _per_row(_CASED[words.data], words.bounds)
    capitals = _per_row(_CAPITAL[words.data], words.bounds)
    def unless(skipped: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.where(skipped, np.nan, values)
    return np.stack([
        np.where(dense, base["n_words"] + unspaced // CHARS_A_WORD, base["n_words"]),
        unless(dense, base["word_chars"] / n), base["n_symbols"] / chars,
        unless(dense, base["n_repeat_words"] / n), base["n_dup_lines"] / inked,
        unless(dense, distinct / n), unless(dense & (ended == 0), ended / inked), letters / chars,
        worded / n, unless(2 * cased <= letters, capitals / np.maximum(cased, 1))],
        axis=1).astype(float)


def votes(stats: np.ndarray) -> np.ndarray:
    """1 good, -1 bad, 0 none, ``UNTOLD`` without the statistic, for each text and labeller."""
    out = np.zeros(stats.shape, np.int8)
    for j, (low, good, to, high) in enumerate(LABELLERS.values()):
        x = stats[:, j]
        out[(x >= good) & (x <= to), j] = 1
        if low is not None:
            out[x < low, j] = -1
        if high is not None:
            out[x > high, j] = -1
        out[np.isnan(x), j] = UNTOLD
    return out


@dataclass
class Labels:
    """What EM found: the share of good texts, and P(vote | truth) of each labeller."""

    prior: float
    table: np.ndarray  # labeller, truth (bad, good), vote (-1, 0, 1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        told = np.where(votes == UNTOLD, 0, votes).astype(int)
        seen = np.log(self.table[np.arange(votes.shape[1]), :, told + 1])
        seen = (seen * (votes != UNTOLD)[:, :, None]).sum(axis=1)
        odds = seen[:, 1] - seen[:, 0] + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def expectation_maximisation(patterns: np.ndarray, times: np.ndarray,
                             rounds: int = ROUNDS) -> Labels:
    """Accuracies of the labellers from how often each pattern of votes occurs."""
    told = np.where(patterns == UNTOLD, 0, patterns)
    good = np.clip(0.5 + told.sum(axis=1) / (2 * patterns.shape[1]), 0.05, 0.95)
    good[(patterns < 0).any(axis=1)] = 0.25
    found = None
    for _ in range(rounds):
        weight = np.stack([(1 - good) * times, good * times], axis=1)
        table = np.stack([((patterns == v)[:, :, None] * weight[:, None, :]).sum(axis=0)
                          for v in (-1, 0, 1)], axis=2) + 0.1
        table /= table.sum(axis=2, keepdims=True)
        prior = float(np.clip(weight[:, 1].sum() / weight.sum(), 1e-3, 1 - 1e-3))
        found = Labels(prior, table)
        new = found.posterior(patterns)
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return found


def features(texts: pa.Array, stats: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams end to end with the bounds of each text, and hashed steps."""
    data, bounds = raw_bytes(texts, fold=True)
    wide = data.astype(np.uint64)
    grams = mix(wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]) \
        >> np.uint64(64 - bits) if len(data) > 2 else np.zeros(0, np.uint64)
    step = np.searchsorted(_STEPS, stats, "right")
    name = np.arange(stats.shape[1]) * 64 + step + (1 << 32)
    return (grams.astype(np.int64), np.minimum(bounds, len(grams)),
            (mix(name.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64))


def scores(texts: pa.Array, stats: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    """Log-odds: bias, mean weight of the trigrams, and the weights of the steps."""
    grams, bounds, steps = features(texts, stats, bits)
    sums = np.concatenate(([0.0], np.cumsum(weights[grams])))
    n = np.maximum(bounds[1:] - bounds[:-1], 1)
    return weights[-1] + SCALE * (sums[bounds[1:]] - sums[bounds[:-1]]) / n + weights[steps].sum(axis=1)


# Means of many small weights are stretched to the size of the steps' weights.
SCALE = 20.0


def _cells(grams: np.ndarray, steps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of one text that are not 0, and their values."""
    x = np.bincount(grams, minlength=1 << bits) * (SCALE / max(len(grams), 1))
    np.add.at(x, steps, 1.0)
    at = np.flatnonzero(x)
    return at.astype(np.int32), x[at].astype(np.float32)


def fit(cells: np.ndarray, values: np.ndarray, sizes: np.ndarray, good: np.ndarray,
        told: np.ndarray, bits: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of a logistic scorer, by gradient steps over the whole sample.

    ``cells`` and ``values`` are the features of all texts end to end, ``sizes`` of each text;
    ``told`` is how much a text counts.
    """
    size = 1 << bits
    ends = np.cumsum(sizes)
    parts, at = [], 0  # texts at a time, so that what is worked out for them has a bound
    while at < len(sizes):
        before = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, before + FIT_CELLS, "right")))
        parts.append((slice(at, to), slice(before, ends[to - 1]),
                      np.cumsum(sizes[at:to]) - sizes[at:to]))
        at = to
    weights, squares = np.zeros(size + 1), np.full(size + 1, 1e-6)
    told = told / max(told.sum(), 1e-9)
    for _ in range(epochs):
        slope = DECAY * weights
        for texts, span, starts in parts:
            z = np.add.reduceat(values[span] * weights[cells[span]], starts) + weights[-1]
            error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - good[texts]) * told[texts]
            slope[:-1] += np.bincount(cells[span], values[span] * np.repeat(error, sizes[texts]), size)
            slope[-1] += error.sum()
        squares += slope ** 2
        weights -= RATE * slope / np.sqrt(squares)
    return weights


def _voter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(map(bytes, (votes(statistics(batch.column("text"))) + 1).astype(np.uint8))),
                      pa.binary()), batch.column("hash")], names=["votes", "hash"])


def _sampler(bits: int):
    """Features of each text of a task, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in blocks(batches):
            new = [i for i, h in enumerate(batch.column("hash").to_pylist())
                   if h not in seen and not seen.add(h)]
            if not new:
                continue
            batch = batch.take(pa.array(new))
            texts = batch.column("text")
            stats = statistics(texts)
            for r in range(len(texts)):
                grams, _, steps = features(texts.slice(r, 1), stats[r:r + 1], bits)
                cells, values = _cells(grams, steps[0], bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("hash").slice(r, 1), pa.array([len(cells)], pa.int64()),
                     pa.array([cells.tobytes()], pa.binary()),
                     pa.array([values.tobytes()], pa.binary())],
                    names=["hash", "size", "cells", "values"])
    return run


def told_by(votes: np.ndarray) -> np.ndarray:
    """How much a text teaches: the square of the share of labellers that vote on it."""
    return (np.isin(votes, (-1, 1)).mean(axis=1)) ** 2


def _fitted(keyed: DataFrame, voted: DataFrame, labels: Labels, bits: int, sample: int,
            sample_cells: int) -> np.ndarray:
    """Weights from the sample of distinct texts."""
    least = voted.groupBy("hash").agg(F.min("votes").alias("votes")).orderBy("hash").limit(
        sample).collect()
    if not least:
        return np.append(np.zeros(1 << bits), np.log(labels.prior) - np.log1p(-labels.prior))
    known = {r["hash"]: np.array(list(r["votes"]), np.int64) - 1 for r in least}
    rows = keyed.select("text", F.xxhash64("text").alias("hash")).filter(F.col("hash") <= max(known))
    made = cut_lineage(rows.mapInArrow(
        _sampler(bits), "hash long, size long, cells binary, values binary"), "sample")
    taken, total = [], 0
    for r in made.groupBy("hash").agg(F.max("size").alias("size")).orderBy("hash").collect():
        total += r["size"]
        if taken and total > sample_cells:
            break
        taken.append(r["hash"])
    found = {r["hash"]: (np.frombuffer(r["cells"], np.int32), np.frombuffer(r["values"], np.float32))
             for r in made.filter(F.col("hash") <= taken[-1]).dropDuplicates(["hash"])
             .drop("size").toLocalIterator()}
    cells, values = (np.concatenate([found[h][i] for h in taken]) for i in (0, 1))
    sizes = np.array([len(found[h][0]) for h in taken])
    found.clear()
    own = np.stack([known[h] for h in taken])
    return fit(cells, values, sizes, labels.posterior(own), told_by(own), bits)


def _scorer(sent, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, labels = sent.value
        for batch in blocks(batches):
            texts = batch.column("text")
            stats = statistics(texts)
            odds = scores(texts, stats, weights, bits)
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept],
                 pa.array(1 / (1 + np.exp(-np.clip(odds, -50, 50)))),
                 pa.array(labels.posterior(votes(stats)))], names=[*kept, "score", "weak_label"])
    return run


def judge(docs: DataFrame, *, text: str = "text", bits: int = BITS, sample: int = SAMPLE,
          sample_cells: int = SAMPLE_CELLS) -> DataFrame:
    """``docs`` without the text, with ``score`` (that of a good text), ``weak_label`` (posterior
    of its votes) and ``kept``."""
    spark = docs.sparkSession
    prepare(spark)
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(*others(docs, (text, "score", "weak_label", "kept")), own.alias("text"))
    voted = cut_lineage(keyed.select("text", F.xxhash64("text").alias("hash")).mapInArrow(
        _voter, "votes binary, hash long"), "votes")
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        return keyed.drop("text").withColumns({
            "score": F.lit(0.0), "weak_label": F.lit(0.0), "kept": F.lit(False)})
    patterns = np.array([list(r["votes"]) for r in counted], np.int64) - 1
    times = np.array([r["n"] for r in counted], float)
    labels = expectation_maximisation(patterns, times)

    weights = _fitted(keyed, voted, labels, bits, sample, sample_cells)
    sent = spark.sparkContext.broadcast((weights, labels))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema if f.name != "text"]
    return (keyed.mapInArrow(_scorer(sent, bits), ", ".join([*types, "score double", "weak_label double"]))
            .withColumn("kept", F.col("score") >= 0.5))


def op4_weak_labels(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", "score", "weak_label", "kept")


QUERIES = {"op4_weak_labels": op4_weak_labels}
