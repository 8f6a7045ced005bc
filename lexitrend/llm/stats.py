"""Document statistics over whole texts, shared by the quality rules and the quality classifier.

Words are maximal runs of bytes outside space and \\x09-\\x0D (what ``bytes.split()``
splits on); every count runs over the whole text, null counting as empty.
"""

from __future__ import annotations

import numpy as np

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
ENDS = b".!?"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the models see: ratios, so that a feature does not depend on the length alone.
FEATURES = ["log_words", "word_len", "symbols_per_word", "dup_lines", "repeat_words", "upper", "digits",
            "bangs_per_word", "distinct_words", "lines_per_word", "ends_per_word", "bars_per_word",
            "long_words", "top_word", "wide_chars"]
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _count(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word sequence found twice or more in ``words``."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * _MIX
    key = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        key = key * _MULT + h[k:k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(b: bytes) -> tuple[list[int], list[float]]:
    """(BASE counts, FEATURES) of one text."""
    words = b.split()
    n = len(words)
    n_points = len(b.decode("utf-8", "replace"))
    word_chars = n_points - _count(b, SPACES)
    symbols = _count(b, SYMBOLS)
    lines = [x for x in b.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    per = 1.0 / max(n, 1)
    chars = 1.0 / max(word_chars, 1)
    upper, lower = _count(b, UPPER), _count(b, LOWER)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    feats = [float(np.log1p(n)), word_chars * per, symbols * per, dup / max(len(lines), 1), repeat * per,
             upper / max(upper + lower, 1), _count(b, DIGITS) * chars, b.count(b"!") * per,
             len(counts) * per, len(lines) * per, _count(b, ENDS) * per, b.count(b"|") * per,
             sum(1 for w in counts if len(w) > 20) / max(len(counts), 1),
             max(counts.values(), default=0) * per, (len(b) - n_points) * chars]
    return [n, word_chars, symbols, dup, repeat], feats
