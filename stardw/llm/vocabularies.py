"""Public tokenizers as values that travel to the tasks."""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass, field
from functools import cached_property
from importlib.metadata import version
from pathlib import Path

import numpy as np
import public_tokenizers

_LIBRARY = {".json": "tokenizers", ".model": "sentencepiece", ".tiktoken": "tiktoken"}


@dataclass
class Vocabulary:
    """The bytes of a vocabulary file. The encoder is made once in each process that uses it."""

    name: str
    data: bytes
    _made: dict = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, path: str | Path) -> Vocabulary:
        return cls(Path(path).name, Path(path).read_bytes())

    @classmethod
    def public(cls, name: str) -> Vocabulary:
        return cls.load(public_tokenizers.path(name))

    def __getstate__(self):
        return {"name": self.name, "data": self.data, "_made": {}}

    @property
    def library(self) -> str:
        return _LIBRARY[Path(self.name).suffix]

    @cached_property
    def digest(self) -> str:
        """Tells one tokenizer version from another: the file and the library that reads it."""
        known = f"{self.library} {version(self.library)}".encode()
        return hashlib.sha256(known + b"\0" + self.data).hexdigest()

    @property
    def encoder(self):
        if "encoder" not in self._made:
            if self.library == "sentencepiece":
                import sentencepiece
                made = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            elif self.library == "tokenizers":
                import tokenizers
                made = tokenizers.Tokenizer.from_str(self.data.decode())
                made.no_truncation()
                made.no_padding()
            else:
                import tiktoken
                made = tiktoken.Encoding(self.name, pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=self._ranks(), special_tokens={})
            self._made["encoder"] = made
        return self._made["encoder"]

    def _ranks(self) -> dict[bytes, int]:
        return {base64.b64decode(token): int(rank)
                for token, rank in map(bytes.split, self.data.splitlines())}

    def encode(self, texts: list[str]) -> list:
        """Token ids of each whole text, without begin, end or added special tokens."""
        if self.library == "sentencepiece":
            return self.encoder.encode(texts, num_threads=1)
        if self.library == "tokenizers":
            return [e.ids for e in self.encoder.encode_batch(texts, add_special_tokens=False)]
        return [self.encoder.encode_ordinary(t) for t in texts]

    @property
    def bytes_only(self) -> np.ndarray:
        """By token id: whether it stands for one byte of a character that has no token."""
        if "bytes" not in self._made:
            if self.library == "sentencepiece":
                n = self.encoder.get_piece_size()
                found = [self.encoder.is_byte(i) for i in range(n)]
            elif self.library == "tiktoken":
                ranks = self._ranks()
                found = np.zeros(max(ranks.values()) + 2, bool)
                found[[r for t, r in ranks.items() if len(t) == 1 and t[0] >= 0x80]] = True
            else:  # byte-level: the pieces of one character that stand for bytes beyond ASCII
                vocabulary = self.encoder.get_vocab(with_added_tokens=False)
                found = np.zeros(max(vocabulary.values()) + 2, bool)
                found[[i for t, i in vocabulary.items() if len(t) == 1 and ord(t) > 0x7E]] = True
            self._made["bytes"] = np.asarray(found, bool)
        return self._made["bytes"]
