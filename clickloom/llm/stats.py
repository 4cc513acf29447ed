"""Statistics of whole documents for quality models, in numpy."""

from __future__ import annotations

import numpy as np

from clickloom.llm.words import LOWER, Texts, mix, spread

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
REPEAT_WIDTH = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share",
    "upper_share", "digit_share", "punctuation_share", "exclamation_share", "pipe_share",
    "wide_share", "distinct_share", "words_per_line", "longest_word", "space_share", "top_word_share",
)


def _kind(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL = _kind(SYMBOLS)
_UPPER = _kind(bytes(range(65, 91)))
_DIGIT = _kind(b"0123456789")
_PUNCT = _kind(bytes(c for c in range(33, 127) if not chr(c).isalnum()))


def duplicate_lines(text: bytes) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def repeated_words(texts: Texts, hashes: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in an 8-word window found twice or more in it."""
    window = texts.windows(hashes, REPEAT_WIDTH)
    place = np.flatnonzero(texts.whole(REPEAT_WIDTH))
    owner = texts.text_of_word()
    key = mix(window[place] ^ mix(owner[place].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    twice = same[1:] | same[:-1]
    inside = spread(np.sort(place[order[twice]]), REPEAT_WIDTH, len(hashes))
    return np.bincount(owner[inside], minlength=len(texts))


def base_counts(texts: Texts, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The integer statistics named in :data:`BASE`, per text."""
    data = texts.data
    edge = texts.offsets.tolist()
    raw = data.tobytes()
    return {
        "n_words": texts.n_words,
        "word_chars": texts.count(texts.inside & ((data & 0xC0) != 0x80)),
        "n_symbols": texts.count(_SYMBOL[data]),
        "n_dup_lines": np.array([duplicate_lines(raw[a:b]) for a, b in zip(edge, edge[1:])], np.int64),
        "n_repeat_words": repeated_words(texts, hashes),
    }


def features(texts: Texts, hashes: np.ndarray, base: dict[str, np.ndarray]) -> np.ndarray:
    """One row of :data:`FEATURES` per text; all shares are 0 for a text without words."""
    data, words = texts.data, np.maximum(texts.n_words, 1)
    size = np.maximum(np.diff(texts.offsets), 1)
    owner = texts.text_of_word()
    lower = mix(texts.hashes(LOWER) ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    # Counts of each different word of each text, by sorting (text, word).
    value, at, count = np.unique(lower, return_index=True, return_counts=True)
    distinct = np.bincount(owner[at], minlength=len(texts)) if len(at) else np.zeros(len(texts))
    top = np.zeros(len(texts))
    np.maximum.at(top, owner[at], count)
    longest = np.zeros(len(texts))
    np.maximum.at(longest, owner, texts.ends - texts.starts)
    lines = texts.count(data == 10) + 1
    chars = np.maximum(base["word_chars"], 1)
    return np.column_stack([
        np.log1p(base["n_words"]), base["word_chars"] / words, base["n_symbols"] / words,
        base["n_dup_lines"] / lines, base["n_repeat_words"] / words,
        texts.count(_UPPER[data]) / chars, texts.count(_DIGIT[data]) / chars,
        texts.count(_PUNCT[data]) / chars, texts.count(data == 33) / words,
        texts.count(data == 124) / words, texts.count(data >= 0xC0) / chars, distinct / words,
        base["n_words"] / lines, np.log1p(longest), texts.count(~texts.inside) / size, top / words,
    ]).astype(float)
