"""Count tokens with a tokenizer compiled to deterministic finite-state transducers.

Two machines in a row stand for a word tokenizer of the kind "lower case, split by pattern, byte
pairs with a word end":

* The **splitter** reads character classes and emits where pieces begin. It has seven states
  (outside, in letters, in other signs, and four that wait to see whether an apostrophe begins
  a contraction). Text is cut into chunks of equal length; each chunk's map from entry state to
  exit state is found for all chunks at once, the maps compose by a parallel prefix scan, and
  with its entry state then known every chunk emits its beginnings.
* The **counter** reads the bytes of one piece and the word end; every transition carries the
  change in the number of tokens. Its states are built when first met: a state is the longest
  suffix read so far that could still grow into a token, with the last token and relative count
  of the best division at each place in it. The next division is the one token that ends here
  and stays whole beside the token before it, so the machine needs no search and no library.

Both are built from the tokenizer's own file; only character classes and the normal form of
unusual characters are asked of the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import _BASES, _BYTES, mix, powers, slices

CHUNK = 128
#: Bounds on what a worker remembers; beyond them it starts again from nothing.
MAX_TRANSITIONS = 400_000
MAX_PIECES = 400_000
# Below this all characters are alone in their normal form.
PLAIN = 0x300
# Fixed value: the split pattern that the splitter's states stand for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Character classes: space, letter, number, other sign, apostrophe, then the letters of contractions.
_SPACE, _LETTER, _NUMBER, _OTHER, _QUOTE, _SHORT, _R, _V, _L, _E = range(10)
# States: outside, in letters, in signs, after an opening apostrophe, and after it and r, v, l.
_OUT, _WORD, _SIGNS, _MAYBE, _MAYBE_R, _MAYBE_V, _MAYBE_L = range(7)
_HERE, _BEFORE = 1, 2  # a piece begins at this character; at the one before


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by (state, class)."""
    to = np.zeros((7, 10), np.int8)
    emit = np.zeros((7, 10), np.int8)
    letters = [_LETTER, _SHORT, _R, _V, _L, _E]
    for state in range(7):
        to[state, _SPACE] = to[state, _NUMBER] = _OUT
        to[state, letters] = _WORD
        to[state, _OTHER], to[state, _QUOTE] = _SIGNS, _MAYBE
        emit[state, 1:] = _HERE
    emit[_WORD, letters] = 0
    for state in (_SIGNS, _MAYBE):
        to[state, _QUOTE] = _SIGNS
        emit[state, [_OTHER, _QUOTE]] = 0
    to[_MAYBE, [_SHORT, _R, _V, _L]] = [_OUT, _MAYBE_R, _MAYBE_V, _MAYBE_L]
    emit[_MAYBE, [_SHORT, _R, _V, _L]] = 0
    for state, last in ((_MAYBE_R, _E), (_MAYBE_V, _E), (_MAYBE_L, _L)):
        # No contraction: the letter before began a word.
        to[state], emit[state] = to[_WORD], emit[_WORD] | _BEFORE
        to[state, last], emit[state, last] = _OUT, 0
    return to, emit


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of state maps (rows in order, a column for each entry state)."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        step *= 2
    return maps


class Counter:
    """The byte-pair machine of one tokenizer, built as it is used."""

    END = "\n"

    def __init__(self, model: dict) -> None:
        suffix = model["end_of_word_suffix"]

        def own(token: str) -> str:
            return token[: -len(suffix)] + self.END if token.endswith(suffix) else token

        self.tokens = {own(t) for t in model["vocab"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(own(a), own(b)): i for i, (a, b) in enumerate(merges)}
        self.growing = {t[:i] for t in self.tokens for i in range(len(t))}
        self.clear()

    def clear(self) -> None:
        start = ("", ("",), (0,))
        self.states, self.number = [start], {start: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}
        self.whole: dict[tuple[str, str], bool] = {}

    def _encode(self, text: str) -> list[str]:
        units = list(text)
        if units[-1] == self.END:
            units[-2:] = [units[-2] + self.END]
        while len(units) > 1:
            best = min(zip(units, units[1:]), key=lambda p: self.rank.get(p, 1 << 30))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(units):
                if tuple(units[i : i + 2]) == best:
                    out.append(units[i] + units[i + 1])
                    i += 2
                else:
                    out.append(units[i])
                    i += 1
            units = out
        return units

    def _beside(self, a: str, b: str) -> bool:
        """Whether two tokens in a row stay as they are."""
        if not a:
            return True
        known = self.whole.get((a, b))
        if known is None:
            known = self.whole[a, b] = self._encode(a + b) == [a, b]
        return known

    def move(self, state: int, sign: str) -> tuple[int, int]:
        """Next state and change in tokens; built on first use."""
        read, last, count = self.states[state]
        text = read + sign
        for size in range(len(text), 0, -1):
            token = text[-size:]
            if token in self.tokens and self._beside(last[len(text) - size], token):
                change = count[len(text) - size] + 1
                break
        else:
            raise ValueError(f"the vocabulary cannot spell {text!r}")
        if sign == self.END:
            made = (0, change)
        else:
            while text not in self.growing:
                text = text[1:]
            keep = len(text) + 1
            new = (
                text, (*last, token)[-keep:], tuple(c - change for c in (*count, change)[-keep:]),
            )
            at = self.number.get(new)
            if at is None:
                at = self.number[new] = len(self.states)
                self.states.append(new)
            made = (at, change)
        self.moves[state, sign] = made
        return made

    def count(self, piece: str) -> int:
        """Tokens of one piece, given in the tokenizer's byte letters."""
        if len(self.moves) > MAX_TRANSITIONS or len(self.whole) > MAX_TRANSITIONS:
            self.clear()
        state, total, moves = 0, 0, self.moves
        for sign in (*piece, self.END):
            found = moves.get((state, sign))
            if found is None:
                found = self.move(state, sign)
            state, change = found
            total += change
        return total


def byte_letters() -> str:
    """The letter that stands for each byte: itself if printable, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in set(plain) else next(rest)) for b in range(256))


class TokenCounter:
    """Token counts of whole texts for one tokenizer file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if split["pattern"] != {"Regex": PATTERN} or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("the transducers are for tokenizers of another kind")
        library = Tokenizer.from_file(path)
        self.normal, self.splits = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.counter = Counter(spec["model"])
        self.letters = byte_letters()
        self.to, self.emit = _splitter()
        self.classes = np.full(0x110000, -1, np.int8)
        self.pieces: dict[int, int] = {}

    def _class(self, char: str) -> int:
        short = {"'": _QUOTE, "s": _SHORT, "t": _SHORT, "m": _SHORT, "d": _SHORT, "r": _R, "v": _V, "l": _L, "e": _E}
        if char in short:
            return short[char]
        around = [p for p, _ in self.splits(f"a{char}")]
        if len(around) == 1:
            return _SPACE if around[0] == "a" else _LETTER
        return _NUMBER if len(self.splits(char * 2)) == 2 else _OTHER

    def _normalised(self, text: str) -> str:
        if text.isascii() or max(text) < chr(PLAIN):
            return text.lower()
        return self.normal(text)

    def begins(self, classes: np.ndarray) -> np.ndarray:
        """Where pieces begin in a text given by classes; it must end in a space."""
        n = len(classes)
        lanes = -(-n // CHUNK)
        grid = np.zeros(lanes * CHUNK, np.int8)
        grid[:n] = classes
        grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
        maps = np.tile(np.arange(7, dtype=np.int8), (lanes, 1))
        flat = self.to.reshape(-1)
        for column in grid:
            maps = flat[maps.astype(np.intp) * 10 + column[:, None]]
        state = np.concatenate([[_OUT], compose(maps)[:-1, _OUT]]).astype(np.intp)
        out = np.empty((CHUNK, lanes), np.int8)
        emits = self.emit.reshape(-1)
        for i, column in enumerate(grid):
            at = state * 10 + column
            out[i] = emits[at]
            state = flat[at].astype(np.intp)
        out = out.T.reshape(-1)[:n]
        begin = (out & _HERE) > 0
        begin[:-1] |= (out[1:] & _BEFORE) > 0
        return begin

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        extra = np.zeros(len(texts), np.int64)
        normal = []
        for i, text in enumerate(texts):
            if self.special and "<|" in text:
                text, extra[i] = self.special.subn(" ", text)
            # The space ends every piece, so texts can stand in one row.
            normal.append(self._normalised(text) + " ")
        joined = "".join(normal)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[codes]
        if (classes < 0).any():
            for code in np.unique(codes[classes < 0]).tolist():
                self.classes[code] = self._class(chr(code))
            classes = self.classes[codes]
        begin = self.begins(classes)
        start = np.flatnonzero(begin)
        if not len(start):
            return extra
        edge = np.flatnonzero(begin | (classes == _SPACE))
        end = edge[np.searchsorted(edge, start, "right")]
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.concatenate([[0], np.cumsum(width)])
        raw = joined.encode("utf-8")
        tokens = self._tokens(np.frombuffer(raw, np.uint8), raw, at[start], at[end])
        ends = np.cumsum([len(t) for t in normal])
        return extra + np.bincount(np.searchsorted(ends, start, "right"), tokens, len(texts)).astype(np.int64)

    def _tokens(self, data: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each piece; each different piece runs through the counter once."""
        span = np.diff(np.append(start, len(data)))
        place = np.arange(start[0], len(data)) - np.repeat(start, span)
        value = _BYTES[data[start[0] :]] * powers(_BASES[0], span.max())[place]
        value[place >= np.repeat(end - start, span)] = 0
        key = mix(np.add.reduceat(value, start - start[0]) ^ (end - start).astype(np.uint64) * _BASES[1])
        unique, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.pieces) + len(unique) > MAX_PIECES:
            self.pieces.clear()
        known, letters, count = self.pieces, self.letters, self.counter.count
        out = np.empty(len(unique), np.int64)
        for i, (h, a, b) in enumerate(zip(unique.tolist(), start[first].tolist(), end[first].tolist())):
            n = known.get(h)
            if n is None:
                n = known[h] = count(raw[a:b].decode("latin-1").translate(letters))
            out[i] = n
        return out[which]


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """The compiled tokenizer of this worker process."""
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every document; NULL counts as the empty text.

    Special strings inside a text count as the one token that the library makes of them.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    schema = rows.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(tokenizer)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.column(1).slice(a, b - a)
                counts = made.counts(part.to_pylist())
                size = pa.compute.binary_length(part).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), size, pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return rows.mapInArrow(run, schema)
