"""Token ids of whole texts by the tokenizers library, encoding what was met before only once."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

from clickloom.llm.token_transducer import PATTERN, PLAIN, byte_letters

#: The most white-space chunks and the most pieces that a worker remembers, of each half old ones.
CHUNKS = 800_000
PIECES = 450_000
# Longer ones are rare and would fill the cache.
_LONGEST = 100


class Recent(dict):
    """What ``make`` gave for the keys met last. When half of ``size`` is full it becomes the older
    half, from which keys that are met again come back; so frequent keys are made only once."""

    def __init__(self, make: Callable, size: int) -> None:
        super().__init__()
        self.make, self.half, self.older = make, max(size // 2, 1), {}

    def __missing__(self, key):
        made = self.older.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= _LONGEST:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = made
        return made


class ChunkEncoder:
    """Encodes texts chunk by chunk, with bounded caches of chunks and of their pieces.

    This holds for tokenizers that drop white space, normalise each character by itself and
    split by :data:`PATTERN`: the ids of a text are those of its white-space chunks in a row,
    and those of a chunk are the library model's ids of its pieces. Chunks with unusual
    characters or with special strings go to the library whole, and so do all texts of
    tokenizers of another kind.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        added = [t["content"] for t in spec["added_tokens"]]
        self.local = (
            split.get("pattern") == {"Regex": PATTERN} and kinds == ["NFC", "Replace", "Lowercase"]
            and all("<|" in t and not any(c.isspace() for c in t) for t in added)
        )
        self.split = regex.compile(PATTERN)
        self.letters = byte_letters()
        self.pieces = Recent(self._piece, PIECES)
        self.chunks = Recent(self._chunk, CHUNKS)

    def vocabulary(self) -> int:
        """Number of ids, added ones too."""
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(spelt)], "<u4").tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        if text.isascii() and text.isalpha():  # one piece
            return self.pieces[text.lower()]
        if "<|" in text or not (text.isprintable() and (text.isascii() or max(text) < chr(PLAIN))):
            return self._whole(text)
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text.lower())))

    def ids(self, text: bytes) -> np.ndarray:
        """The ids of a whole text as unsigned 32-bit integers."""
        if not self.local:
            return np.frombuffer(self._whole(text.decode("utf-8")), "<u4")
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split())), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker process."""
    return ChunkEncoder(path)
