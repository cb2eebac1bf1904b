"""Elias-Fano sequences, and an n-gram trie of them that is stored as bytes and mapped from a file."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import numpy as np

# Values decoded at once; every such many a place in the upper bits is noted.
CHUNK = 1 << 14


@dataclass
class EliasFano:
    """A sequence that never falls: low bits as whole bytes, high bits as gaps in unary.

    Of ``n`` values below ``u`` it takes about ``log2(u / n) + 2`` bits each, and up to 7 more as
    the low part is rounded up to bytes.
    """

    n: int
    low_bytes: int
    low: np.ndarray
    upper: np.ndarray
    starts: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        ratio = (int(values[-1]) + 1) // n if n else 1
        low_bytes = -(-max(0, ratio.bit_length() - 1) // 8)
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low_bytes].copy()
        places = (values >> np.uint64(8 * low_bytes)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, low_bytes, low, np.packbits(bits), np.append(places[::CHUNK], len(bits)))

    def chunk(self, k: int) -> np.ndarray:
        """Values ``k * CHUNK`` and following."""
        first, end = int(self.starts[k]), int(self.starts[k + 1])
        a, b = k * CHUNK, min(self.n, (k + 1) * CHUNK)
        bits = np.unpackbits(self.upper[first // 8:-(-end // 8)])[first % 8:][:end - first]
        high = np.flatnonzero(bits)[:b - a] + first - np.arange(a, b)
        low = np.zeros((b - a, 8), np.uint8)
        low[:, :self.low_bytes] = self.low[a:b]
        return (high.astype(np.uint64) << np.uint64(8 * self.low_bytes)) | low.view("<u8")[:, 0]

    @property
    def chunks(self) -> int:
        return len(self.starts) - 1

    def values(self) -> np.ndarray:
        return np.concatenate([self.chunk(k) for k in range(self.chunks)] or [np.zeros(0, np.uint64)])

    def slice(self, a: int, b: int) -> np.ndarray:
        """Values ``a`` to ``b``, decoding only the chunks they are in."""
        if a >= b:
            return np.zeros(0, np.uint64)
        k = a // CHUNK
        return np.concatenate([self.chunk(i) for i in range(k, (b - 1) // CHUNK + 1)])[
            a - k * CHUNK:b - k * CHUNK]


class Trie:
    """Contexts with the weight left to shorter ones, and below each its successors with a code.

    Contexts and the words of the shard are rising ids. The pointers from contexts to successors
    rise too. Successors rise only within a context; their place in the shard's vocabulary plus a
    base that grows from context to context rises throughout, so all four are Elias-Fano. Stored as
    one run of bytes, and mapped from a file that holds them, so that it takes no memory of the
    process.
    """

    SEQUENCES = ("contexts", "vocabulary", "pointers", "successors")
    BYTES = ("codes", "weights")

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, code: np.ndarray, weight: np.ndarray) -> Trie:
        """``context`` and ``word`` of each n-gram, ordered by both; ``code`` one byte each;
        ``weight`` one byte for each n-gram, the same for all of a context."""
        made = cls()
        contexts, first = np.unique(context, return_index=True)
        vocabulary, place = np.unique(word, return_inverse=True)
        rank = np.repeat(np.arange(len(contexts)), np.diff(np.append(first, len(context))))
        made.contexts, made.vocabulary = EliasFano.encode(contexts), EliasFano.encode(vocabulary)
        made.pointers = EliasFano.encode(np.append(first, len(context)))
        made.successors = EliasFano.encode(rank * max(1, len(vocabulary)) + place)
        made.codes, made.weights = code.astype(np.uint8), weight[first].astype(np.uint8)
        return made

    def store(self) -> bytes:
        """The lengths of all arrays, then the arrays."""
        arrays, sizes = [], []
        for name in self.SEQUENCES:
            one = getattr(self, name)
            arrays += [one.low, one.upper, one.starts.astype("<i8")]
            sizes += [one.n, one.low_bytes, len(one.upper), len(one.starts)]
        for name in self.BYTES:
            arrays.append(getattr(self, name))
            sizes.append(len(arrays[-1]))
        return b"".join([np.array(sizes, "<i8").tobytes(), *[
            np.ascontiguousarray(a).tobytes() for a in arrays]])

    @classmethod
    def mapped(cls, path: Path) -> Trie:
        """The trie that a file holds."""
        data = np.memmap(path, np.uint8, "r")
        head = 4 * len(cls.SEQUENCES) + len(cls.BYTES)
        sizes = data[:8 * head].view("<i8").tolist()
        made, at = cls(), 8 * head

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return data[at - n:at]

        for k, name in enumerate(cls.SEQUENCES):
            n, low_bytes, upper, starts = sizes[4 * k:4 * k + 4]
            low, high = take(n * low_bytes).reshape(n, low_bytes), take(upper)
            setattr(made, name, EliasFano(n, low_bytes, low, high, np.frombuffer(
                take(8 * starts).tobytes(), "<i8")))
        for name, n in zip(cls.BYTES, sizes[4 * len(cls.SEQUENCES):]):
            setattr(made, name, take(n))
        return made

    def search(self, context: np.ndarray, word: np.ndarray, unknown: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Codes of n-grams ordered by (context, word), 0 where the trie has none; and the weights
        of their contexts, ``unknown`` where it has none.

        The words are sought among the successors of their context: relative to its base, in the
        chunks its pointers lead to.
        """
        out, weight = np.zeros(len(context), np.uint8), np.full(len(context), unknown, np.uint8)
        if not self.contexts.n or not len(context):
            return out, weight
        contexts, vocabulary = self.contexts.values(), self.vocabulary.values()
        rank = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        place = np.minimum(np.searchsorted(vocabulary, word), len(vocabulary) - 1)
        here = contexts[rank] == context
        weight[here] = self.weights[rank[here]]
        known = np.flatnonzero(here & (vocabulary[place] == word))
        target = (rank[known] * len(vocabulary) + place[known]).astype(np.uint64)
        if not len(known):
            return out, weight
        # From the first successor of the first context sought to the last of the last.
        a = int(self.pointers.slice(rank[known[0]], rank[known[0]] + 1)[0])
        b = int(self.pointers.slice(rank[known[-1]] + 1, rank[known[-1]] + 2)[0])
        for k in range(a // CHUNK, (b - 1) // CHUNK + 1):
            chunk = self.successors.chunk(k)
            low, high = np.searchsorted(target, chunk[0]), np.searchsorted(target, chunk[-1], "right")
            if low < high:
                found = np.searchsorted(chunk, target[low:high])
                hit = chunk[found] == target[low:high]
                out[known[low:high][hit]] = self.codes[k * CHUNK + found[hit]]
        return out, weight
