"""Quality rules: how well public vocabularies fit a text, within bands of its language.

A vocabulary cuts prose of a language into pieces in much the same way: so many characters a
token, so few single bytes, so much variety among the tokens. Text that is cut far otherwise is
rarely prose. The three measures are taken of every whole text by each vocabulary, and all must be
within their bands. Bands are fences of the same
language (two-letter code, else the script most of its letters are of), for variety also of the
same length by powers of two. There are at most 676 codes, the scripts of ``SCRIPTS`` and 40
lengths, so the table of bands has a bound; it is made on the driver and broadcast.

Fences lie about the shortest interval that holds half of the votes, which junk below half doesn't
move to itself. A text has one vote in a language, however often it is copied. If there is a column
``source``, a source has at most half as many votes as all others of the language together, where
those come to ``LEAST`` texts. An interval narrower than is typical of the languages, or over
``WIDEST`` times as wide, takes that width about its middle. Only votes are bounded so: every
document is judged.

The base rules reject texts of under ``MIN_WORDS`` words, or with more than half of the words in
3-word windows that come twice.

Null and empty texts have no words and fail the base rules. A language of under ``LEAST`` distinct
texts is judged by the fences of all others together, or, if its middle is outside them (another
script), about its own middle; the variety of under ``LEAST`` texts of one length by that of all
languages. Junk that is most of a language and has no source to tell it by is taken for the
language. Equal rows get equal results, an empty table an empty one; columns of the input with the
name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import narrowed, others, widened
from stardw.llm.vocabularies import Vocabulary
from stardw.llm.words import NOT_SPACE, blocks, covered, mix, windows, words_of
from stardw.session import cut_lineage, local_rows

# One of pieces with bytes to fall back on, one of bytes for many languages.
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")
MIN_WORDS = 50
LEAST = 100
# Fences lie this many widths of the shortest half below and above it. Short pieces, single
# bytes and little variety speak against a text; their opposites only when they are extreme.
REACH = {"chars_per_token": (3.0, 6.0), "byte_share": (6.0, 3.0), "entropy": (3.0, 6.0)}
# The band of a measure is at least this wide on either side of that half, in its own unit.
LEAST_WIDTH = {"chars_per_token": 0.25, "byte_share": 0.02, "entropy": 0.5}
METRICS = tuple(LEAST_WIDTH)
# Votes are counted in steps of this size. A half is at most so many times as wide as is typical.
STEP = {"chars_per_token": 0.01, "byte_share": 0.001, "entropy": 0.01}
WIDEST = 2.0
# Quantiles that the shortest half is sought among, and the weight of a full vote.
GRID, VOTE = 40, 1000
# Variety grows with the length of a text; the other measures hardly do.
BY_LENGTH = ("entropy",)

# First and last code point of letters, by script.
SCRIPTS = {
    "Latin": (0x41, 0x24F), "Greek": (0x370, 0x3FF), "Cyrillic": (0x400, 0x52F),
    "Hebrew": (0x590, 0x5FF), "Arabic": (0x600, 0x6FF), "Devanagari": (0x900, 0x97F),
    "Thai": (0xE00, 0xE7F), "Kana": (0x3040, 0x30FF), "Han": (0x4E00, 0x9FFF),
    "Hangul": (0xAC00, 0xD7AF)}

_NEWLINE = np.arange(256) != 0x0A
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LEADING = (np.arange(256) & 0xC0) != 0x80
_SALT = np.uint64(0x9FB21C651E98DF25)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _seen_before(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, hash) as one key, and which entries of it equal the one before."""
    key = mix(h + row.astype(np.uint64) * _SALT)
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    return order, same


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rules for each row of a block."""
    words = words_of(texts)
    n, rows = len(words.start), len(texts)
    lines = words_of(texts, _NEWLINE)
    in_word = np.concatenate(([0], np.cumsum(NOT_SPACE[lines.data], dtype=np.int64)))
    told = in_word[lines.end] > in_word[lines.start]
    order, same = _seen_before(lines.hashes()[told], lines.row[told])
    dup_lines = np.bincount(lines.row[told][order][same], minlength=rows)
    row, left = words.row, words.left
    at = np.flatnonzero(left >= 3)
    order, same = _seen_before(windows(words.hashes(), 3)[at], row[at])
    twice = same.copy()
    twice[:-1] |= same[1:]
    repeated = covered(at[order[twice]], 3, n)
    return {"n_words": words.count,
            "word_chars": _per_row(NOT_SPACE[words.data] & _LEADING[words.data], words.bounds),
            "n_symbols": _per_row(_SYMBOL[words.data], words.bounds), "n_dup_lines": dup_lines,
            "n_repeat_words": np.bincount(row[repeated], minlength=rows)}


def token_measures(texts: list[str], vocabulary: Vocabulary) -> dict[str, list]:
    """Tokens, characters a token, share of single bytes, and entropy in bits, for each text."""
    out: dict[str, list] = {"n_tokens": [], **{m: [] for m in METRICS}}
    single = vocabulary.bytes_only
    for text, ids in zip(texts, vocabulary.encode(texts)):
        ids = np.asarray(ids, np.int64)
        n = len(ids)
        times = np.bincount(ids) if n else np.zeros(0)
        times = times[times > 0]
        out["n_tokens"].append(n)
        out["chars_per_token"].append(len(text) / n if n else 0.0)
        out["byte_share"].append(float(single[ids].mean()) if n else 0.0)
        out["entropy"].append(float(np.log2(n) - (times * np.log2(times)).sum() / n) if n else 0.0)
    return out


def script_of(text: str) -> str:
    """The script most letters of ``text`` are of, or "Other"."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = {name: int(((points >= low) & (points <= high)).sum())
         for name, (low, high) in SCRIPTS.items()}
    best = max(n, key=n.get)
    return best if n[best] else "Other"


def _measurer(sent, text: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            texts = batch.column(text)
            strings = [t or "" for t in texts.to_pylist()]
            made = {k: pa.array(v, pa.int64()) for k, v in base_counts(texts).items()}
            for i, vocabulary in enumerate(sent.value):
                for name, values in token_measures(strings, vocabulary).items():
                    made[f"{name}_{i}"] = pa.array(
                        values, pa.int64() if name == "n_tokens" else pa.float64())
            coded = [bool(c) for c in batch.column("_coded").to_pylist()]
            made["_script"] = pa.array([None if c else script_of(t)
                                        for c, t in zip(coded, strings)], pa.string())
            kept = [n for n in batch.schema.names
                    if n != "_coded" and (keep_text or n != text)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], *made.values()], names=[*kept, *made])
    return run


def measures(docs: DataFrame, vocabularies: list[Vocabulary], *, text: str = "text",
             lang: str = "lang", keep_text: bool = False) -> DataFrame:
    """``docs`` with the counts and measures, the group and the length class."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabularies)
    own = [f"{m}_{i}" for i in range(len(vocabularies)) for m in ("n_tokens", *METRICS)]
    clash = {*COUNTS, *own, "group", "length", "_coded", "_script", "_digest", text}
    kept = others(docs, clash)
    code = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    code = F.when(code.rlike("^[a-z]{2}$"), code)
    rows = docs.select(*kept, code.alias("group"), code.isNotNull().alias("_coded"),
                       F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_digest"),
                       F.col(text).cast("string").alias(text))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
             if f.name != "_coded" and (keep_text or f.name != text)]
    types += [f"{c} long" for c in COUNTS]
    types += [f"{c} {'long' if c.startswith('n_') else 'double'}" for c in own]
    out = rows.mapInArrow(_measurer(sent, text, keep_text), ", ".join([*types, "_script string"]))
    length = F.floor(F.log2(F.greatest(F.col("n_tokens_0"), F.lit(1)))).cast("int")
    return (out.withColumn("group", F.coalesce("group", "_script"))
            .withColumn("length", length).drop("_script"))


def _votes(texts: DataFrame, metric: str, measure: str, keys: tuple[str, ...], least: int) -> dict:
    """By ``keys``: how many texts, and the quantiles of ``measure`` over their votes."""
    step = STEP[metric]
    tally = texts.groupBy(*keys, "source", F.round(F.col(measure) / step).cast("long").alias(
        "bin")).agg(F.count(F.lit(1)).alias("n"))
    own = tally.groupBy(*keys, "source").agg(F.sum("n").alias("of_source"))
    all_ = own.groupBy(*keys).agg(F.sum("of_source").alias("of_all"))
    rest = F.col("of_all") - F.col("of_source")
    share = F.when(rest >= least, F.least(F.lit(1.0), rest / (2 * F.col("of_source")))).otherwise(1.0)
    own = own.join(all_, [*keys]).withColumn("share", share) if keys else \
        own.crossJoin(all_).withColumn("share", share)
    votes = F.greatest(F.lit(1), F.round(F.col("share") * VOTE * F.col("n"))).cast("long")
    tally = tally.join(own, [*keys, "source"]).withColumn("votes", votes)
    grid = ", ".join(str(i / GRID) for i in range(GRID + 1))
    found = tally.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.expr(f"percentile(bin, array({grid}), votes)").alias("q"))
    return {tuple(r[k] for k in keys): (r["n"], np.array(r["q"]) * step)
            for r in found.collect() if r["q"]}


def shortest_half(q: np.ndarray) -> tuple[float, float]:
    """The narrowest interval between quantiles that holds half; of equal ones the middle one."""
    half = GRID // 2
    width = np.round(q[half:] - q[:-half], 9)
    at = min(range(half + 1), key=lambda i: (width[i], abs(i - half // 2)))
    return float(q[at]), float(q[at + half])


def bands(measured: DataFrame, n: int, *, least: int = LEAST, reach: dict = REACH) -> DataFrame:
    """Fences of each measure by (group, length), from the distinct texts of all documents."""
    names = [f"{m}_{i}" for i in range(n) for m in METRICS]
    source = F.col("source").cast("string") if "source" in measured.columns else F.lit("")
    texts = cut_lineage(measured.select(
        "group", "length", "_digest", F.coalesce(source, F.lit("")).alias("source"), *names)
        .groupBy("group", "_digest").agg(
            F.min("source").alias("source"),
            *[F.min(c).alias(c) for c in ("length", *names)]), "distinct-measures")
    cells = [tuple(r) for r in texts.select("group", "length").distinct().collect()]
    fences: dict[tuple, list[float]] = {c: [] for c in cells}
    for i in range(n):
        for m in METRICS:
            by_length = m in BY_LENGTH
            own = _votes(texts, m, f"{m}_{i}", ("group", "length") if by_length else ("group",), least)
            any_ = _votes(texts, m, f"{m}_{i}", ("length",) if by_length else (), least)
            halves = {k: shortest_half(q) for k, (_, q) in own.items()}
            large = [k for k, (times, _) in own.items() if times >= least]
            typical = float(np.median([halves[k][1] - halves[k][0] for k in large])) if large else 0.0

            def about(half: tuple[float, float]) -> tuple[float, float]:
                middle, width = sum(half) / 2, half[1] - half[0]
                if large:
                    width = min(max(width, typical), max(WIDEST * typical, LEAST_WIDTH[m]))
                low, high = (max(r * width, LEAST_WIDTH[m]) for r in reach[m])
                return middle - width / 2 - low, middle + width / 2 + high
            known = [about(halves[k]) for k in large]
            for group, length in cells:
                key = (group, length) if by_length else (group,)
                if key in large:
                    band = about(halves[key])
                elif by_length or not large:
                    band = about(shortest_half(any_[key[1:]][1]))
                else:
                    band = min(b[0] for b in known), max(b[1] for b in known)
                    if not band[0] <= sum(halves[key]) / 2 <= band[1]:
                        band = about(halves[key])
                fences[group, length] += band
    types = ", ".join(f"{c}_{end} double" for c in names for end in ("low", "high"))
    return local_rows(measured.sparkSession, [(*c, *f) for c, f in sorted(fences.items())],
                      f"`group` string, length int, {types}")


def judge(docs: DataFrame, *, vocabularies: list[Vocabulary] | None = None, text: str = "text",
          lang: str = "lang", least: int = LEAST, reach: dict = REACH,
          keep_text: bool = False) -> DataFrame:
    """``docs`` with counts, measures, ``base_failed`` and ``kept``; the text only if asked for."""
    vocabularies = vocabularies or [Vocabulary.public(v) for v in VOCABULARIES]
    n = len(vocabularies)
    # Written, for the bands need all measures before the first document can be judged.
    measured = cut_lineage(measures(docs, vocabularies, text=text, lang=lang,
                                    keep_text=keep_text), "measures")
    table = bands(measured, n, least=least, reach=reach)
    inside = F.lit(True)
    for i in range(n):
        for m in METRICS:
            inside &= F.col(f"{m}_{i}").between(F.col(f"{m}_{i}_low"), F.col(f"{m}_{i}_high"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return (measured.join(F.broadcast(table), ["group", "length"], "left")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & F.coalesce(inside, F.lit(False)))
            .drop(*[f"{m}_{i}_{end}" for i in range(n) for m in METRICS
                    for end in ("low", "high")], "_digest"))


def keep(docs: DataFrame, **rules) -> DataFrame:
    """``docs`` without the documents that the rules reject."""
    needed = [c for c in ("text", "lang", "source") if c in docs.columns]
    judged = judge(narrowed(docs, *needed), keep_text=True, **rules)
    return widened(judged.filter("kept"), docs, *needed)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "lang", "source", "text")
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "kept",
                              "group", *[F.col(f"{m}_0").alias(m) for m in METRICS])


QUERIES = {"op2_quality_rules": op2_quality_rules}
