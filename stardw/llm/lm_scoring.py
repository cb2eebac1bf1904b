"""Language-model scoring with a sharded Elias-Fano n-gram trie.

Interpolated n-grams of order 2 up to ``len(mu) + 1`` with Dirichlet smoothing, by order
``P(w | c) = (n(c, w) + mu * P(w | c without its first word)) / (n(c) + mu)``, from
``P1(w) = (n(w) + 1) / (N + V + 1)``. The model is learnt from the training documents and gives
every document its log10 probability. Neither counts nor model are ever whole in one place:

1. Documents are packed into *blocks* of about ``BLOCK_TEXT`` bytes: their distinct words, most
   frequent first, and their tokens as places in that list. Blocks are written once.
2. Each block sends its distinct words to shards by hash; a shard sums up the counts of all
   blocks and answers every block with the counts of its words.
3. For each order, each block sends its distinct n-grams to the shard of their context. The shard
   sums up those of training documents and builds its part of the trie: contexts, pointers and
   successors as rising sequences in Elias-Fano code, with a quantised probability for each
   successor and weight for each context, in a memory-mapped file. All n-grams sent, learnt or not,
   are then sought there, each among the successors of its context, and answered by code and weight.
4. The answers, written once for each order, meet their block again, and each document's tokens
   are added up.

``learn`` stops after building and keeps counts and tries as two written tables, one row a shard;
``Model.score`` sends the n-grams of any documents to the stored shards. ``score`` does both at once
for one table, which spares a second shuffle of the training n-grams; scores are the same.

A block sends an n-gram once however often it holds it, so a frequent one costs one entry of each
block. Its n-grams are sorted, sent and added up by shard, so that beside a few numbers for each of
its tokens a task holds what one shard gets. Contexts with more than a quarter of a shard's usual tokens are spread over all shards by
their successors; their counts are known from the order below. A lost task repeats its own block or
shard. Words and contexts are told apart by 48 bits of their hashes.

Null and empty texts have one token, the end, and so do texts without words. A very long text is a
block of its own. Ids may be of any type, null or repeated; documents without id are training
documents in the registered query. Other columns are not carried. Without training documents every
probability is that of an empty model, 1 / (V + 1) = 1. Repeated rows are documents of their own; an
empty table gives an empty result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.elias_fano import Trie
from stardw.llm.words import blocks, mix, words_of
from stardw.session import cut_lineage

# One for each order from 2 on; the registered query's has trigrams.
MU = (50.0,)
TRIGRAMS = (50.0, 50.0)
BLOCK_TEXT = 12 << 20
# Shards are as many as the packed text needs for each to have about so many bytes of it.
LEAST_SHARDS = 16
SHARD_BYTES = 4 << 20
# Codes 1 … 255 stand for powers of ten from -15.24 up to 1 in even steps; 0 for none.
QUANTUM, LOWEST = 0.06, -15.24

_END = np.uint64(0x1D8E4E27C47D124F)
_BEGIN = np.uint64(0xEB44ACCAB455D165)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(16)


def quantised(p: np.ndarray) -> np.ndarray:
    steps = np.rint((np.log10(np.maximum(p, 1e-300)) - LOWEST) / QUANTUM)
    return (np.clip(steps, 0, 254) + 1).astype(np.uint8) * (p > 0).astype(np.uint8)


def probability(codes: np.ndarray) -> np.ndarray:
    table = 10.0 ** (LOWEST + QUANTUM * (np.arange(256) - 1))
    table[0] = 0
    return table[codes]


def packed(a: np.ndarray) -> bytes:
    """An array of integers, compressed by byte places: the high bytes of small ones vanish."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return len(a).to_bytes(8, "little") + pa.compress(
        np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(kind)


def joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def parted(data: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        parts.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return parts


def rising(a: np.ndarray) -> bytes:
    """Integers in order, by their steps."""
    return packed(np.diff(a, prepend=a.dtype.type(0)))


def risen(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def _heads(*by: np.ndarray) -> np.ndarray:
    """Where a new run of equal entries begins."""
    fresh = np.zeros(len(by[0]), bool)
    fresh[:1] = True
    for a in by:
        fresh[1:] |= a[1:] != a[:-1]
    return fresh


# --- Blocks -------------------------------------------------------------------------------

def _block_columns(id_type: str) -> str:
    return (f"block long, ids array<{id_type}>, held array<boolean>, sizes array<int>, "
            "words binary, tokens binary")


def _pack(block: int, ids: list[pa.Array], held: list, sizes: list, tokens: list) -> pa.RecordBatch:
    h = np.concatenate(tokens)
    tokens.clear()
    order = np.argsort(h)
    h = h[order]
    fresh = _heads(h)
    words, times = h[fresh], np.diff(np.append(np.flatnonzero(fresh), len(h)))
    del h
    by_times = np.argsort(-times, kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[by_times] = np.arange(len(words), dtype=np.uint32)
    place = np.empty(len(order), np.uint32)
    place[order] = np.repeat(rank, times)
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.ListArray.from_arrays([0, sum(map(len, ids))], pa.concat_arrays(ids)),
         pa.array([held], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32())),
         pa.array([packed(words[by_times])], pa.binary()),
         pa.array([packed(place)], pa.binary())],
        names=["block", "ids", "held", "sizes", "words", "tokens"])


def _packer(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held_bytes = 0, 0
        ids, held, sizes, tokens = [], [], [], []
        name = TaskContext.get().partitionId() << 32
        for batch in blocks(batches):
            words = words_of(batch.column("text"), fold=True)
            # The end of each text as a word after its last.
            h = np.insert(words.hashes(), words.first[1:], _END)
            ids.append(batch.column("id"))
            held += batch.column("held").to_pylist()
            sizes += (words.count + 1).tolist()
            tokens.append(h)
            held_bytes += len(words.data)
            if held_bytes >= limit:
                yield _pack(name + made, ids, held, sizes, tokens)
                made, held_bytes = made + 1, 0
                ids, held, sizes, tokens = [], [], [], []
        if ids:
            yield _pack(name + made, ids, held, sizes, tokens)
    return run


# Tokens that are worked on at once where that takes several arrays.
_STEP = 1 << 17


class Block:
    def __init__(self, row: dict):
        self.name, self.ids = row["block"], row["ids"]
        self.words = unpacked(row["words"], np.uint64)
        self.tokens = unpacked(row["tokens"], np.uint32)
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.learnt = np.repeat(~self.held, self.sizes)

    def _named(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of each token's context and of its word."""
        begin = _BEGIN >> _SHORT
        word = (self.words >> _SHORT)[self.tokens]
        context = np.concatenate((word[:1], word[:-1]))
        context[self.starts] = begin
        for _ in range(order - 2):
            begin = extended(np.array([begin]), np.array([_BEGIN >> _SHORT]))[0]
            # From the end, as each takes the place of the one after it.
            for to in range(len(word), 1, -_STEP):
                at = max(1, to - _STEP)
                context[at:to] = extended(context[at - 1:to - 1], word[at - 1:to - 1])
            context[self.starts] = begin
        return context, word

    def ngrams(self, order: int, hot: np.ndarray, bits: int) -> Iterator[tuple]:
        """Shard after shard its number, the context and word of the block's distinct n-grams by
        (context, word), and the tokens that have them with the place there of each.

        Only the tokens of one shard are sorted at once.
        """
        context, word = self._named(order)
        shard = np.empty(len(word), np.uint16 if bits <= 16 else np.uint32)
        for at in range(0, len(word), _STEP):
            own = slice(at, at + _STEP)
            shard[own] = shard_of(context[own], word[own], hot, bits)
        order_ = np.argsort(shard, kind="stable")
        ends = np.cumsum(np.bincount(shard))
        del shard
        at = 0
        for s, to in enumerate(ends.tolist()):
            if at < to:
                tokens = order_[at:to]
                c, w = context[tokens], word[tokens]
                own = np.lexsort((w, c))
                c, w = c[own], w[own]
                fresh = _heads(c, w)
                yield s, c[fresh], w[fresh], tokens[own], np.cumsum(fresh) - 1
            at = to


def extended(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Names of contexts that are longer by one word."""
    return mix(mix(context) + word * _ODD) >> _SHORT


def _among(names: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``names`` are in the sorted list ``hot``, and their places there."""
    if not len(hot):
        return np.zeros(len(names), bool), np.zeros(len(names), np.int64)
    at = np.searchsorted(hot, names)
    at[at == len(hot)] = 0
    return hot[at] == names, at


def shard_of(context: np.ndarray, word: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """Shards of n-grams: by context, those of hot contexts by their word too."""
    name = mix(context)
    spread, _ = _among(context, hot)
    name[spread] = mix(name[spread] ^ mix(word[spread] * _ODD))
    return (name >> np.uint64(64 - bits)).astype(np.int64)


def _shards(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of a sorted list of shards."""
    heads = np.flatnonzero(_heads(shard))
    yield from zip(shard[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(shard)])


# --- Words ----------------------------------------------------------------------------------

_ASKED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("a", pa.binary()),
                    ("b", pa.binary())])
_ASK = "shard int, block long, a binary, b binary"
# Answers have a block; what a shard says of itself, and stores as its part of the model, has none.
_ANSWERED = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("a", pa.binary()),
                       ("b", pa.binary()), ("n", pa.int64()), ("v", pa.int64()),
                       ("top", pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())])))])
_ANSWER = ("block long, shard int, a binary, b binary, n long, v long, "
           "top array<struct<word:long,n:long>>")


def _word_asker(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                times = np.bincount(block.tokens[block.learnt], minlength=len(block.words))
                order = np.argsort(block.words)
                words, times = block.words[order], times[order]
                shard = (words >> np.uint64(64 - bits)).astype(np.int64)
                yield pa.RecordBatch.from_pylist([
                    {"shard": s, "block": block.name, "a": packed(words[i:j]),
                     "b": packed(times[i:j])} for s, i, j in _shards(shard)], schema=_ASKED)
    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one shard after the other; the partition is sorted by shard."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["shard"] != held[0]["shard"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


# Words of a shard named for their frequency; only ever more than the frequent ones there can be.
_TOP = 256


def _counted(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Words of a shard in order, and how often training documents have them."""
    words, place = np.unique(np.concatenate([unpacked(r["a"], np.uint64) for r in rows]),
                             return_inverse=True)
    total = np.zeros(len(words), np.int64)
    np.add.at(total, place, np.concatenate([unpacked(r["b"], np.int64) for r in rows]))
    return words, total


def _word_counter(learning: bool, stored: bool):
    """Answers of a shard from what it counts or, ``stored``, has in its first row; only the counts
    if it is ``learning``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_shard(batches):
            shard, out = rows[0]["shard"], []
            if stored:
                own = [r for r in rows if r["block"] is None]
                rows = [r for r in rows if r["block"] is not None]
                words, total = _counted(own) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            else:
                words, total = _counted(rows)
                top = np.argsort(-total, kind="stable")[:_TOP]
                said = {"shard": shard, "n": int(total.sum()), "v": int((total > 0).sum()),
                        "top": [{"word": int(words[i].astype(np.int64)), "n": int(total[i])} for i in top]}
                if learning:
                    said |= {"a": packed(words), "b": packed(total)}
                out.append(said)
            for row in [] if learning else rows:
                asked = unpacked(row["a"], np.uint64)
                at = np.searchsorted(words, asked)
                at[at == len(words)] = 0
                found = np.where(words[at] == asked, total[at], 0) if len(words) else np.zeros(
                    len(asked), np.int64)
                out.append({"block": row["block"], "shard": shard, "a": packed(found)})
            yield pa.RecordBatch.from_pylist(out, schema=_ANSWERED)
    return run


# --- N-grams --------------------------------------------------------------------------------

# Bytes of rows that leave a task at once.
_SENT = 1 << 20


def _asker(order: int, sent, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value[0]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                out, size = [], 0
                for s, context, word, tokens, place in block.ngrams(order, hot, bits):
                    times = np.bincount(place[block.learnt[tokens]], minlength=len(word))
                    out.append({"shard": s, "block": block.name, "a": _contexts(context),
                                "b": _words_and_times(word, times)})
                    size += len(out[-1]["a"]) + len(out[-1]["b"])
                    if size >= _SENT:
                        yield pa.RecordBatch.from_pylist(out, schema=_ASKED)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_ASKED)
    return run


def _contexts(context: np.ndarray) -> bytes:
    """The distinct contexts, and how many n-grams each has."""
    heads = np.flatnonzero(_heads(context))
    return joined(rising(context[heads]), packed(np.diff(np.append(heads, len(context))).astype(np.uint32)))


def _words_and_times(word: np.ndarray, times: np.ndarray) -> bytes:
    """The distinct words, the place there of each n-gram's word, and its times."""
    words, place = np.unique(word, return_inverse=True)
    return joined(rising(words), packed(place.astype(np.uint32)), packed(times.astype(np.uint32)))


def _merged(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """The distinct n-grams of all rows by (context, word): these and how often training documents
    have them; the place there of each n-gram of each row, and the sizes of the rows."""
    sizes = []
    for r in rows:
        r["b"] = parted(r["b"])
        sizes.append(int.from_bytes(r["b"][2][:8], "little"))
    context, word = (np.empty(sum(sizes), np.uint64) for _ in range(2))
    times = np.empty(len(word), np.uint32)
    done = 0
    for r, size in zip(rows, sizes):
        (contexts, runs), (words, place, n) = parted(r.pop("a")), r.pop("b")
        own = slice(done, done + size)
        context[own] = np.repeat(risen(contexts, np.uint64), unpacked(runs, np.uint32))
        word[own] = risen(words, np.uint64)[unpacked(place, np.uint32)]
        times[own] = unpacked(n, np.uint32)
        done += size
    order = np.lexsort((word, context))
    context, word, times = context[order], word[order], times[order]
    fresh = _heads(context, word)
    place = np.empty(len(order), np.uint32)
    place[order] = np.cumsum(fresh, dtype=np.uint32) - np.uint32(1)
    del order
    total = np.add.reduceat(times, np.flatnonzero(fresh), dtype=np.int64)
    return context[fresh], word[fresh], total, place, sizes


def _built(context: np.ndarray, word: np.ndarray, total: np.ndarray, hot: np.ndarray,
           hot_times: np.ndarray, mu: float) -> Trie:
    """The part of the trie that the learnt n-grams of a shard make."""
    learnt = total > 0
    context, word, total = context[learnt], word[learnt], total[learnt]
    if not len(total):
        return Trie.of(context, word, total, total)
    # How often each context comes: its successors' sum, or as known where it is spread.
    heads = np.flatnonzero(_heads(context))
    seen = np.add.reduceat(total, heads).astype(float)
    spread, known = _among(context[heads], hot)
    seen[spread] = hot_times[known[spread]]
    seen = np.repeat(seen, np.diff(np.append(heads, len(context))))
    return Trie.of(context, word, quantised(total / (seen + mu)), quantised(mu / (seen + mu)))


_CERTAIN = 255  # the code of 1: a context that nothing was learnt of leaves all to the shorter one


def _trie_searcher(sent, mu: float, often: int | None, learning: bool, stored: bool):
    """Answers of a shard from the trie that it builds or, ``stored``, has in its first row; only
    the trie if it is ``learning``. N-grams more frequent than ``often`` are named as contexts of
    the next order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_times = sent.value
        hot_weights = quantised(mu / (hot_times + mu))
        for rows in _by_shard(batches):
            shard, out = rows[0]["shard"], []
            kept = [r["a"] for r in rows if r["block"] is None]
            rows = [r for r in rows if r["block"] is not None]
            if not rows:
                continue
            context, word, total, place, sizes = _merged(rows)
            if stored:
                trie = kept[0] if kept else _built(
                    context[:0], word[:0], total[:0], hot, hot_times, mu).store()
            else:
                trie = _built(context, word, total, hot, hot_times, mu).store()
                many = np.flatnonzero(total > often) if often is not None else []
                if len(many) or learning:
                    longer = extended(context[many], word[many]) if len(many) else []
                    out.append({"shard": shard, "a": trie if learning else None, "top": [
                        {"word": int(c), "n": int(t)} for c, t in zip(longer, total[many])]})
            if not learning:
                with tempfile.TemporaryDirectory() as folder:
                    path = Path(folder) / "trie"
                    path.write_bytes(trie)
                    found, weight = Trie.mapped(path).search(context, word, _CERTAIN)
                # A spread context may have no learnt successor in this shard.
                spread, at = _among(context, hot)
                weight[spread] = hot_weights[at[spread]]
                done = 0
                for row, size in zip(rows, sizes):
                    own = place[done:done + size]
                    out.append({"block": row["block"], "shard": shard,
                                "a": packed(found[own]), "b": packed(weight[own])})
                    done += size
            yield pa.RecordBatch.from_pylist(out, schema=_ANSWERED)
    return run


# --- Scores ---------------------------------------------------------------------------------

_SCORE = ("held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def _adder(sent: Sequence, bits: int, total: int, distinct: int):
    """``sent`` has the hot contexts of each order from 2 on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def solve(id_type: pa.DataType) -> pa.RecordBatch:
            block = Block(held[0])
            by_order = {k: [r for r in held if r["kind"] == k] for k in range(1, len(sent) + 2)}
            times = np.empty(len(block.words), np.int64)
            times[np.argsort(block.words)] = np.concatenate(
                [unpacked(r["a"], np.int64) for r in by_order[1]])
            base = (times + 1) / (total + distinct + 1)
            starts = block.starts
            n_known = np.add.reduceat((times > 0)[block.tokens], starts, dtype=np.int64)
            base_score = np.add.reduceat(np.log10(base)[block.tokens], starts)
            p = base[block.tokens]
            for k, hot in enumerate(sent, 2):
                found = {r["shard"]: r for r in by_order.pop(k)}
                for s, context, _, tokens, place in block.ngrams(k, hot.value[0], bits):
                    row = found.pop(s, None)
                    code, weight = (unpacked(row[c], np.uint8) if row else () for c in ("a", "b"))
                    if not len(code) == len(weight) == len(context):
                        raise RuntimeError(f"block {block.name}: {len(code)} of {len(context)} "
                                           f"answers of shard {s}")
                    p[tokens] = probability(code)[place] + probability(weight)[place] * p[tokens]
            np.log10(np.minimum(p, 1.0, out=p), out=p)  # the codes are rounded
            n = len(starts)
            return pa.RecordBatch.from_arrays(
                [pa.array(block.ids, id_type), pa.array(block.held), pa.array(block.sizes),
                 pa.array(n_known), pa.array(np.full(n, total, np.int64)), pa.array(base_score),
                 pa.array(np.add.reduceat(p, starts))],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                if held and row["block"] != held[0]["block"]:
                    yield solve(id_type)
                    held = []
                held.append(row)
        if held:
            yield solve(id_type)
    return run


# --- Jobs -----------------------------------------------------------------------------------

def _cut(rows: DataFrame, label: str) -> DataFrame:
    """``cut_lineage``, after which the shuffled rows that it was made from leave the disk."""
    conf, name = rows.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return cut_lineage(rows, label)
    finally:
        conf.set(name, before)


def _packed_blocks(docs: DataFrame, held_out, text: str, id_column: str, block_text: int) -> DataFrame:
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return _cut(rows.mapInArrow(_packer(block_text), _block_columns(
        docs.schema[id_column].dataType.simpleString())), "blocks")


def _at_shards(asks: DataFrame, bits: int, stored: DataFrame | None = None) -> DataFrame:
    if stored is not None:
        asks = asks.unionByName(stored.select("shard", "block", "a", "b"))
    return asks.repartition(1 << bits, "shard").sortWithinPartitions("shard", "block")


def _hot(spark, rows: list, begin: int, texts: int, short: bool):
    """Hot contexts and how often they come, sorted, sent to all tasks."""
    names = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    names = np.append(names >> _SHORT if short else names, np.uint64(begin))
    times = np.array([*[r["n"] for r in rows], texts], float)
    order = np.argsort(names)
    return spark.sparkContext.broadcast((names[order], times[order]))


@dataclass
class Model:
    """What documents were learnt: ``words`` and, by order from 2 on, ``tries`` have a row a shard."""

    words: DataFrame
    tries: list[DataFrame]
    hot: list
    bits: int
    total: int
    distinct: int
    mu: Sequence[float]

    def score(self, docs: DataFrame, *, text: str = "text", id_column: str = "doc_id",
              block_text: int = BLOCK_TEXT) -> DataFrame:
        """Rows as ``score`` gives them, for documents of any table; all are held out."""
        packs = _packed_blocks(docs, F.lit(True), text, id_column, block_text)
        answers = [_at_shards(packs.mapInArrow(_word_asker(self.bits), _ASK), self.bits,
                              self.words).mapInArrow(_word_counter(False, True), _ANSWER)]
        for order, (trie, sent, mu) in enumerate(zip(self.tries, self.hot, self.mu), 2):
            asks = packs.mapInArrow(_asker(order, sent, self.bits), _ASK)
            answers.append(_at_shards(asks, self.bits, trie).mapInArrow(
                _trie_searcher(sent, mu, None, False, True), _ANSWER))
        return _added(packs, answers, self, id_column)


def _added(packs: DataFrame, answers: Sequence[DataFrame], model: Model, id_column: str) -> DataFrame:
    kinds = packs.withColumns({"kind": F.lit(0), "shard": F.lit(-1),
                               "a": F.lit(None).cast("binary"), "b": F.lit(None).cast("binary")})
    for k, rows in enumerate(answers, 1):
        kinds = kinds.unionByName(rows.filter("block IS NOT NULL").select(
            "block", F.lit(k).alias("kind"), "shard", "a", "b"), allowMissingColumns=True)
    # As many tasks as blocks, so that what a task reads doesn't grow with the table.
    together = kinds.repartition(max(1, packs.count()), "block").sortWithinPartitions("block", "kind", "shard")
    id_type = packs.schema["ids"].dataType.elementType.simpleString()
    return together.mapInArrow(
        _adder(model.hot, model.bits, model.total, model.distinct),
        f"id {id_type}, {_SCORE}").withColumnRenamed("id", id_column)


def _learnt(packs: DataFrame, mu: Sequence[float], shard_bytes: int, learning: bool,
            ) -> tuple[Model, list[DataFrame]]:
    """The model of the blocks' training documents, and unless only ``learning`` the answers for
    all blocks by order."""
    spark = packs.sparkSession
    texts, size = packs.agg(
        F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0)),
        F.coalesce(F.sum(F.octet_length("words") + F.octet_length("tokens")), F.lit(0))).first()
    bits = (max(LEAST_SHARDS, -(-size // shard_bytes)) - 1).bit_length()
    counts = _cut(_at_shards(packs.mapInArrow(_word_asker(bits), _ASK), bits).mapInArrow(
        _word_counter(learning, False), _ANSWER), "words")
    sums = counts.filter("block IS NULL")
    total, distinct = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    model = Model(sums, [], [], bits, total, distinct, mu)
    answers = [counts]
    # At most four contexts for each shard can hold so many of the tokens.
    often = max(1, total >> (bits + 2))
    begin, found = _BEGIN >> _SHORT, counts
    for order, one in enumerate(mu, 2):
        many = (found.filter("block IS NULL").select(F.explode("top").alias("t")).select("t.*")
                .filter(F.col("n") > often).collect())
        sent = _hot(spark, many, begin, texts, order == 2)
        last = order == len(mu) + 1
        found = _cut(_at_shards(packs.mapInArrow(_asker(order, sent, bits), _ASK), bits).mapInArrow(
            _trie_searcher(sent, one, None if last else often, learning, False), _ANSWER), "ngrams")
        model.hot.append(sent)
        model.tries.append(found.filter("block IS NULL"))
        answers.append(found)
        begin = extended(np.array([begin], np.uint64), np.array([_BEGIN >> _SHORT], np.uint64))[0]
    return model, answers


def learn(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id", mu: Sequence[float] = MU,
          block_text: int = BLOCK_TEXT, shard_bytes: int = SHARD_BYTES) -> Model:
    """The model of all ``docs``, stored by shards."""
    packs = _packed_blocks(docs, F.lit(False), text, id_column, block_text)
    return _learnt(packs, mu, shard_bytes, True)[0]


def score(docs: DataFrame, held_out, *, text: str = "text", id_column: str = "doc_id",
          mu: Sequence[float] = MU, block_text: int = BLOCK_TEXT, shard_bytes: int = SHARD_BYTES,
          ) -> DataFrame:
    """One row for each document: its id, ``held_out`` and the columns of ``_SCORE``.

    ``held_out`` is a condition on ``docs``; where it doesn't hold the document is learnt from.
    """
    packs = _packed_blocks(docs, held_out, text, id_column, block_text)
    model, answers = _learnt(packs, mu, shard_bytes, False)
    return _added(packs, answers, model, id_column)


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score(docs, held_out, mu=TRIGRAMS)


QUERIES = {"op9_lm_scoring": op9_lm_scoring}
