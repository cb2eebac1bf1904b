"""Byte-level BPE as a monoid: encodings of halves are joined up a tree, and so are decodings.

A text of more than ``LEAF`` characters is encoded in halves. Two neighbours are joined in two
steps, and in both only a window about the cut is worked out anew, which grows until what lies
outside is proven to stay:

* Matches of the pattern. A match looks at ``LOOK`` characters behind it at most, so those of the
  left half that end earlier stay. What follows a place depends on the text from there on only, so
  as soon as a match of the window ends, with as much to look at, where one of the right half
  begins, all further ones stay.
* Tokens of a match that both halves share. A sequence of tokens is the encoding of its bytes if
  and only if each neighbouring pair is the encoding of its own bytes: whether a merge crosses the
  border of two tokens is decided between these two, since merges elsewhere don't touch them. So
  the window is right when the pairs at its two edges are, and grows on the side that is not.

The tree is within a row, a row is one task's, and nothing is shuffled: a lost task repeats its own
rows. A text of any length is read in whole; memory is that of the text and its tokens, and a run
of one letter, where joins may go to the end, costs a factor of the logarithm more. Pieces met
before are looked up in a memory of bounded size.

Null texts are empty ones and have no tokens. Equal rows give equal results, an empty table an empty
one; columns of the input that share a name with a result, in any case of letters, are replaced.
Special strings inside texts are text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import others
from stardw.llm.vocabularies import Vocabulary
from stardw.llm.words import blocks

VOCABULARY = "byte_bpe_50k.tiktoken"
# Characters of a text that are matched at once, bytes of a match that are merged at once.
LEAF = 4096
SHORT = 24
# Characters that a match of the pattern looks at behind its end, at most.
LOOK = 2
# Pieces remembered by a process, and the longest of them in characters.
MEMORY = 1 << 19
REMEMBERED = 48


@dataclass
class Node:
    """Matches of a stretch of text, and the packed tokens of each."""

    pieces: list[str]
    ids: list[bytes]


class Tree:
    """Encodes and decodes with the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF, short: int = SHORT,
                 pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.none = max(ranks.values(), default=0) + 1
        self.leaf, self.short = max(1, leaf), max(1, short)
        self.find = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    # --- tokens of one match -----------------------------------------------------------------

    def merged(self, data: bytes) -> list[int]:
        """All merges of lowest rank first, the leftmost of equal ones."""
        if len(data) > 4 * self.short:
            return self._merged_long(data)
        get, none = self.ranks.get, self.none
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            at = ranks.index(low)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], none)
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], none)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap of possible merges and a chain of the parts that are left."""
        n, ranks = len(data), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and end[at] < n:
                rank = ranks.get(data[at:end[end[at]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, end[end[at]]))

        for at in range(n - 1):
            offer(at)
        gone = bytearray(n + 1)
        while heap:
            _, at, to = heapq.heappop(heap)
            # A merge that was offered before one of its parts changed has another end now.
            if gone[at] or end[at] == n or end[end[at]] != to:
                continue
            gone[end[at]] = 1
            end[at] = to
            if to < n:
                before[to] = at
            offer(at)
            offer(before[at])
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at:end[at]]])
            at = end[at]
        return out

    def _stays(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of two neighbouring tokens."""
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= MEMORY:
                self._pairs.clear()
            known = self.merged(self.token[a] + self.token[b]) == [a, b]
            self._pairs[a, b] = known
        return known

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two neighbouring stretches of one match, each already encoded."""
        if not left or not right:
            return left or right
        on_left = on_right = 1
        while True:
            i, j = max(0, len(left) - on_left), min(len(right), on_right)
            window = self.merged(b"".join(map(self.token.__getitem__, left[i:] + right[:j])))
            left_stays = i == 0 or self._stays(left[i - 1], window[0])
            right_stays = j == len(right) or self._stays(window[-1], right[j])
            if left_stays and right_stays:
                return left[:i] + window + right[j:]
            on_left *= 1 if left_stays else 2
            on_right *= 1 if right_stays else 2

    def tokens(self, data: bytes) -> list[int]:
        """Tokens of a stretch inside a match."""
        if len(data) <= self.short:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.tokens(data[:half]), self.tokens(data[half:]))

    def _packed(self, piece: str, parts: list[bytes] | None = None) -> bytes:
        """Packed tokens of a whole match; ``parts`` are those of the stretches it is made of."""
        known = self._known.get(piece)
        if known is not None:
            return known
        data = piece.encode()
        # A match that is a token as a whole is not merged.
        whole = self.ranks.get(data)
        if whole is not None:
            ids = [whole]
        elif parts and len(data) > self.short:
            ids = []
            for part in parts:
                ids = self.joined(ids, self._inside(unpacked(part)))
        else:
            ids = self.tokens(data)
        made = packed(ids)
        if len(piece) <= REMEMBERED:
            if len(self._known) >= MEMORY:
                self._known.clear()
            self._known[piece] = made
        return made

    def _inside(self, ids: list[int]) -> list[int]:
        """Tokens as merges give them: a match that was a token as a whole may differ inside a
        longer one."""
        return self.tokens(self.token[ids[0]]) if len(ids) == 1 else ids

    # --- matches of a text -------------------------------------------------------------------

    def node(self, text: str) -> Node:
        if len(text) <= self.leaf:
            pieces = self.find(text)
            known = self._known
            return Node(pieces, [known.get(p) or self._packed(p) for p in pieces])
        half = len(text) // 2
        return self.join(self.node(text[:half]), self.node(text[half:]))

    def join(self, left: Node, right: Node) -> Node:
        """The matches of both texts end to end."""
        if not left.pieces or not right.pieces:
            return left if left.pieces else right
        cut, behind = len(left.pieces), 0
        while cut and behind < LOOK:
            cut -= 1
            behind += len(left.pieces[cut])
        taken = 1
        while True:
            old = left.pieces[cut:] + right.pieces[:taken]
            window = "".join(old)
            found = self.find(window)
            borders = [0, *accumulate(map(len, old))]
            if taken >= len(right.pieces):
                taken = len(right.pieces)
                break
            # Where matches of the right half begin, as far as a match before can be sure.
            begins = {at: k for k, at in enumerate(borders[len(left.pieces) - cut:])
                      if at <= len(window) - LOOK}
            ends = list(accumulate(map(len, found)))
            meet = next((i for i, at in enumerate(ends) if at in begins), None)
            if meet is not None:
                found, taken = found[:meet + 1], begins[ends[meet]]
                break
            taken *= 2
        ids = left.ids[cut:] + right.ids[:taken]
        place = {at: k for k, at in enumerate(borders)}
        made, at = [], 0
        for piece in found:
            first, last = place.get(at), place.get(at + len(piece))
            at += len(piece)
            made.append(self._packed(
                piece, None if first is None or last is None else ids[first:last]))
        return Node(left.pieces[:cut] + found + right.pieces[taken:],
                    left.ids[:cut] + made + right.ids[taken:])

    def encode(self, text: str) -> bytes:
        """Tokens of a whole text, packed as little-endian unsigned 32-bit integers."""
        return b"".join(self.node(text).ids)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of tokens: those of the halves end to end."""
        if len(ids) <= self.leaf:
            return b"".join(map(self.token.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def _tree(vocabulary: Vocabulary) -> Tree:
    """The tree of a vocabulary, made once in each process."""
    if "tree" not in vocabulary._made:
        vocabulary._made["tree"] = Tree(vocabulary._ranks())
    return vocabulary._made["tree"]


def _appended(batch: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:-1], pa.array(values, pa.large_binary()).cast(batch.columns[-1].type)],
        names=[*batch.schema.names[:-1], name])


def _encoder(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree(sent.value)
        for batch in blocks(batches, "_bpe_text"):
            texts = batch.column("_bpe_text").to_pylist()
            drop = batch.schema.get_field_index("_bpe_text")
            yield _appended(batch.remove_column(drop), "ids", [tree.encode(t) for t in texts])
    return run


def _decoder(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree(sent.value)
        for batch in blocks(batches, "ids"):
            ids = batch.column("ids").to_pylist()
            yield _appended(batch, "decoded",
                            [None if i is None else tree.decode(unpacked(i)) for i in ids])
    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids``: its tokens, four bytes each."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(*others(docs, {text, "ids", "_bpe_text"}),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_bpe_text"),
                       F.lit(None).cast("binary").alias("ids"))
    return rows.mapInArrow(_encoder(sent), rows.drop("_bpe_text").schema)


def decode(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``coded`` with ``decoded``, the bytes of ``ids``; null where they are null.

    An id that the vocabulary doesn't have is an error.
    """
    spark = coded.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(vocabulary)
    rows = coded.select(*others(coded, {"ids", "decoded"}), "ids",
                        F.lit(None).cast("binary").alias("decoded"))
    return rows.mapInArrow(_decoder(sent), rows.schema)


def op12_bpe_tree(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vocabulary = Vocabulary.public(VOCABULARY)
    coded = decode(encode(docs, vocabulary), vocabulary)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op12_bpe_tree": op12_bpe_tree}
