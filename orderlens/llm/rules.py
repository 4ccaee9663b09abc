"""Quality rules by repetition coverage.

Words become numbers, and n-grams of several lengths rolling polynomial hashes over them, each
length extended from the one before in numpy. Measured are the characters that lie inside n-grams
and lines which already occurred in the text. The measures follow published corpus work (Gopher);
the limits are somewhat wider, for a short clean text in which one line occurs twice exceeds the
published ones."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows

#: Largest share of word characters in the most frequent n-gram, by n.
TOP_NGRAM = {2: 0.20, 3: 0.20, 4: 0.20}
#: Largest share of word characters inside n-grams that occurred before, by n.
DUP_NGRAM = {5: 0.22, 6: 0.22, 7: 0.22, 8: 0.20, 9: 0.20, 10: 0.20}
#: Largest shares of lines, and of characters, in lines that occurred before; a single such line passes.
DUP_LINES, DUP_LINE_CHARS = 0.30, 0.20
#: Symbols for each word.
SYMBOLS = 0.10
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WIDE = 1 << 21


def _points(data: bytes) -> int:
    """Characters (code points) of UTF-8 bytes."""
    return len(data.decode())


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 of word numbers."""
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _covered(windows: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in one of the windows (of n words) marked true."""
    edge = np.zeros(len(windows) + n, np.int32)
    at = np.flatnonzero(windows)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of each window, windows of each group, whether the window's key occurred before)."""
    _, first, group, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return group, count, again


def measure(text: str | None) -> dict:
    """All counts and shares of a text; zero for null and for a text without words."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n, in_words = len(words), sum(map(len, words))
    out = {"n_words": n, "word_chars": len(text) - (len(data) - in_words),
           "n_symbols": len(data) - len(data.translate(None, _SYMBOLS))}
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen = Counter(lines)
    out["n_dup_lines"] = len(lines) - len(seen)
    points = len if len(data) == len(text) else _points
    line_chars = sum(map(points, lines))
    out["dup_line_share"] = out["n_dup_lines"] / max(1, len(lines))
    out["dup_line_char_share"] = sum((c - 1) * points(x) for x, c in seen.items() if c > 1) / max(1, line_chars)
    out["n_repeat_words"] = 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.uint64, n)
    chars = np.fromiter(map(points, words), np.int64, n)
    total = max(1, out["word_chars"])
    shares = {k: 0.0 for k in (*TOP_NGRAM, *DUP_NGRAM)}
    if n >= 3:
        three = (ids[:-2], ids[1:-1], ids[2:])
        if len(numbers) <= _WIDE:  # three numbers fit in 63 bits, so equal keys are equal windows
            keys = (three[0] << np.uint64(42)) | (three[1] << np.uint64(21)) | three[2]
        else:
            pair = np.unique((three[0] << np.uint64(32)) | three[1], return_inverse=True)[1].astype(np.uint64)
            keys = (pair << np.uint64(32)) | three[2]
        group, count, again = _groups(keys)
        if again.any():
            out["n_repeat_words"] = int(_covered(count[group] > 1, 3).sum())
    if len(numbers) < n:  # a text of distinct words repeats nothing
        mixed = _mixed(ids)
        rolling = mixed
        for k in range(2, max(DUP_NGRAM) + 1):
            if n < k:
                break
            rolling = rolling[:-1] * _BASE + mixed[k - 1:]
            group, count, again = _groups(rolling)
            if not again.any():  # longer ones cannot repeat either
                break
            if k in TOP_NGRAM:
                top = int(np.argmax(count))
                if count[top] > 1:
                    shares[k] = float(chars[_covered(group == top, k)].sum() / total)
            elif k in DUP_NGRAM:
                shares[k] = float(chars[_covered(again, k)].sum() / total)
    return out | {"shares": shares}


def base_failed(m: dict) -> bool:
    return m["n_words"] < MIN_WORDS or 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]


def verdict(m: dict) -> bool:
    """Whether no rule of the method speaks against the text."""
    return not (
        any(m["shares"][k] > most for k, most in (TOP_NGRAM | DUP_NGRAM).items())
        or m["n_dup_lines"] > 1 and (m["dup_line_share"] > DUP_LINES or m["dup_line_char_share"] > DUP_LINE_CHARS)
        or m["n_symbols"] > SYMBOLS * m["n_words"]
    )


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SHARES = ("dup_line_share", "dup_line_char_share", "top_ngram_share", "dup_ngram_share")


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the five counts, ``base_failed``, ``kept`` and the
    largest shares. Null and empty texts have no words and fail; repeated rows come out as often as
    they go in; extra columns are ignored."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for key, text in items:
            m = measure(text)
            failed = base_failed(m)
            yield (key, *(m[c] for c in _COUNTS), failed, not failed and verdict(m), m["dup_line_share"], m["dup_line_char_share"],
                   max(m["shares"][k] for k in TOP_NGRAM), max(m["shares"][k] for k in DUP_NGRAM)), 96

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return map_rows(docs, typed, run, pa.schema(
        [("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
         *((c, pa.float64()) for c in _SHARES)]))
