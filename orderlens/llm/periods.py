"""Runs (maximal periodic stretches of words) found through a grammar of each document.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new nonterminal until no pair
repeats; what is left is paired up level by level, so that every text has one root. A run that is
looked for holds at least four periods, so at the boundary of the lowest nonterminal that contains it
two whole periods lie on one side. Each nonterminal is therefore searched once, at its boundary, for
the periods of the squares that end or begin there, and what is found is extended within the
nonterminal's own text. The places of a nonterminal in the derivation turn its runs into those of the
document, and stretches inside a longer one of the same period go.

Before the grammar, stretches that cannot belong to any run are cut out: in a run of at least e
periods every word occurs e times in the document, and every window of three words e - 1 times (or
often enough for the least length, where the period is one word).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows

#: A run has at least so many words, and at least so many periods (four or more).
LEAST_LENGTH, LEAST_EXPONENT = 6, 4


def words_of(text: str | None) -> list[bytes]:
    """Words between the six ASCII white-space characters; other white space belongs to words."""
    return (text or "").encode().split()


def grammar(ids: list[int]) -> tuple[list[tuple[int, int]], list[int], list[int], int]:
    """(rules, sizes, places, first nonterminal) of a sequence. Symbol ``first + k`` derives to the two
    symbols of ``rules[k]``, ``sizes[symbol]`` words, and stands at word ``places[k]``; the last rule is
    the root. A pair's frequency counts overlapping occurrences too; ties go to the pair seen first."""
    n, base = len(ids), max(ids) + 1
    symbol, before, after = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))
    where: dict[int, list[int]] = defaultdict(list)
    for i in range(n - 1):
        where[ids[i] << 32 | ids[i + 1]].append(i)
    count = {pair: len(at) for pair, at in where.items()}
    buckets: dict[int, list[int]] = defaultdict(list)
    for pair, c in count.items():
        if c > 1:
            buckets[c].append(pair)
    rules, sizes, places = [], [1] * base, []
    for c in range(max(buckets, default=0), 1, -1):
        for pair in buckets.get(c, ()):  # grows while it is worked through
            now = count.get(pair, 0)
            if now != c:
                if 1 < now < c:
                    buckets[now].append(pair)
                continue
            a, b = pair >> 32, pair & 0xFFFFFFFF
            found, end = [], -1
            for i in where.pop(pair):
                j = after[i]
                if symbol[i] == a and j < n and symbol[j] == b and i != end:
                    found.append(i)
                    end = j
            del count[pair]
            if len(found) < 2:
                continue
            new, fresh = base + len(rules), {}
            rules.append((a, b))
            sizes.append(sizes[a] + sizes[b])
            places.append(found[0])
            for i in found:
                j = after[i]
                left, right = before[i], after[j]
                if left >= 0:
                    x = symbol[left]
                    old = x << 32 | a
                    if old in count:
                        count[old] -= 1
                    pair = x << 32 | new
                    where[pair].append(left)
                    count[pair] = count.get(pair, 0) + 1
                    fresh[pair] = None
                if right < n:
                    y = symbol[right]
                    old = b << 32 | y
                    if old in count:
                        count[old] -= 1
                    pair = new << 32 | y
                    where[pair].append(i)
                    count[pair] = count.get(pair, 0) + 1
                    fresh[pair] = None
                    before[right] = i
                symbol[i], symbol[j], after[i] = new, -1, right
            for pair in fresh:
                if count.get(pair, 0) > 1:
                    buckets[count[pair]].append(pair)
        buckets.pop(c, None)
    level, i = [], 0
    while i < n:
        level.append((symbol[i], i))
        i = after[i]
    while len(level) > 1:
        above = []
        for k in range(0, len(level) - 1, 2):
            (a, i), (b, _) = level[k], level[k + 1]
            above.append((base + len(rules), i))
            rules.append((a, b))
            sizes.append(sizes[a] + sizes[b])
            places.append(i)
        level = above + level[len(level) & ~1:]
    return rules, sizes, places, base


class Sequence:
    """A sequence of word ids, with fast comparison of stretches and links between equal words."""

    def __init__(self, ids: list[int], least_length: int, least_exponent: int):
        self.ids, self.data = ids, np.array(ids, "<u4").tobytes()
        self.least_length, self.least_exponent = least_length, least_exponent
        seen: dict[int, int] = {}
        self.last, self.next = [-1] * len(ids), [len(ids)] * len(ids)
        for i, x in enumerate(ids):
            j = seen.get(x, -1)
            self.last[i] = j
            if j >= 0:
                self.next[j] = i
            seen[x] = i

    def same(self, i: int, j: int, n: int) -> bool:
        return self.data[4 * i:4 * (i + n)] == self.data[4 * j:4 * (j + n)]

    def up(self, i: int, q: int, end: int) -> int:
        """The first place from ``i`` to before ``end`` whose word is not the one ``q`` before it."""
        step = 4
        while i < end:
            n = min(step, end - i)
            if self.same(i, i - q, n):
                i, step = i + n, step * 2
                continue
            while n > 1:  # the first difference lies in the next n words
                half = n // 2
                if self.same(i, i - q, half):
                    i, n = i + half, n - half
                else:
                    n = half
            return i
        return end

    def down(self, i: int, q: int, start: int) -> int:
        """The least place such that all words from there to before ``i`` equal those ``q`` after."""
        step = 4
        while i > start:
            n = min(step, i - start)
            if self.same(i - n, i - n + q, n):
                i, step = i - n, step * 2
                continue
            while n > 1:
                half = n // 2
                if self.same(i - half, i - half + q, half):
                    i, n = i - half, n - half
                else:
                    n = half
            return i
        return start

    def crossing(self, start: int, middle: int, end: int) -> set[tuple[int, int, int]]:
        """(start, end, period) of the runs inside ``start`` .. ``end`` that have words on both sides of
        ``middle``, cut off at the two ends. Periods are tried in ascending order; once one is found
        the next that can be a smallest period is over half as long as its stretch on that side."""
        out, ids = set(), self.ids
        most, least = (end - start) // self.least_exponent, 1
        limit = min(most, (middle - start) // 2)
        j = self.last[middle - 1]
        while j >= 0 and (q := middle - 1 - j) <= limit:
            if q >= least and ids[middle - q] == ids[middle - 2 * q] and self.same(middle - q, middle - 2 * q, q):
                a = self.down(middle - 2 * q, q, start)
                self.keep(out, a, self.up(middle, q, end), q, middle)
                least = (middle - a) // 2 + 1
            j = self.last[j]
        limit, least = min(most, (end - middle) // 2), 1
        j = self.next[middle]
        while j < end and (q := j - middle) <= limit:
            if q >= least and ids[middle + q - 1] == ids[middle + 2 * q - 1] and self.same(middle, middle + q, q):
                b = self.up(middle + 2 * q, q, end)
                self.keep(out, self.down(middle, q, start), b, q, middle)
                least = (b - middle) // 2 + 1
            j = self.next[j]
        return out

    def keep(self, out: set, a: int, b: int, q: int, middle: int) -> None:
        if a < middle < b and b - a >= max(self.least_length, self.least_exponent * q):
            out.add((a, b, q))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start and period."""
        rules, sizes, places, base = grammar(self.ids)
        own: list[set] = []
        holds = [False] * (base + len(rules))
        for k, ((a, b), at) in enumerate(zip(rules, places)):
            size = sizes[base + k]
            found = self.crossing(at, at + sizes[a], at + size) if size >= self.least_length else set()
            own.append({(s - at, e - at, q) for s, e, q in found})
            holds[base + k] = bool(found) or holds[a] or holds[b]
        if not holds[-1]:
            return []
        at: dict[int, list[int]] = {base + len(rules) - 1: [0]}
        stretches: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k in range(len(rules) - 1, -1, -1):  # a nonterminal's places are complete before its turn
            here = at.pop(base + k, None)
            if here is None:
                continue
            for s, e, q in own[k]:
                stretches[q] += [(p + s, p + e) for p in here]
            a, b = rules[k]
            if holds[a]:
                at.setdefault(a, []).extend(here)
            if holds[b]:
                at.setdefault(b, []).extend([p + sizes[a] for p in here])
        out = []
        for q, found in stretches.items():
            reach = -1
            for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
                if e > reach:
                    out.append((s, e - s, q))
                    reach = e
        return sorted(out, key=lambda x: (x[0], x[2]))


def candidates(words: list[bytes], least_length: int, least_exponent: int) -> Iterator[tuple[int, list[int]]]:
    """(start, word ids) of the stretches that may hold runs."""
    if len(words) < least_length:
        return
    number: dict[bytes, int] = {}
    for w, c in Counter(words).items():
        if c >= least_exponent:
            number[w] = len(number)
    if not number:
        return
    ids = np.array([number.get(w, -1) for w in words], np.int64)
    known = ids >= 0
    # pairs are numbered first, so that the number of a window of three fits into 64 bits
    pair = np.unique(ids[:-1] * (len(number) + 1) + ids[1:], return_inverse=True)[1]
    whole = known[:-2] & known[1:-1] & known[2:]
    if not whole.any():
        return
    _, window, times = np.unique((pair[:-1] * (len(number) + 1) + ids[2:])[whole], return_inverse=True, return_counts=True)
    often = np.zeros(len(whole), bool)
    often[whole] = times[window] >= min(least_exponent - 1, max(least_length, least_exponent) - 2)
    kept = np.zeros(len(ids) + 2, np.int8)
    for shift in (1, 2, 3):
        kept[shift:shift + len(often)] |= often
    edges = np.flatnonzero(np.diff(kept))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a >= least_length:
            yield a, ids[a:b].tolist()


def runs_of(words: list[bytes], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal periodic stretches, by start and period."""
    return [(start + s, n, q) for start, ids in candidates(words, least_length, least_exponent)
            for s, n, q in Sequence(ids, least_length, least_exponent).runs()]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, but for those after the first period of a run, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, n, q in runs:
        edge[start + q] += 1
        edge[start + n] -= 1
    return b" ".join([w for w, deep in zip(words, np.cumsum(edge).tolist()) if not deep])


_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    ("collapsed", pa.string())])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
              least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``runs`` (start, length, period by start, then
    period; numbered in words from 0) and ``collapsed``, the text with one period left of each run.

    Null and empty texts, and texts of white space, have no words, no runs and an empty ``collapsed``.
    Rows need no key: repeated rows come out as often as they go in, null ids stay null. Extra
    columns are ignored. A document is worked on whole, in time and memory about linear in its words."""
    if least_exponent < 4 or least_length < 3:
        raise ValueError("a run has at least four periods and three words")

    def run(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for key, text in rows:
            words = words_of(text)
            found = runs_of(words, least_length, least_exponent)
            left = collapsed(words, found).decode()
            yield (key, len(words), [{"start": s, "length": n, "period": q} for s, n, q in found], left), len(left) + 100 * len(found)

    return map_rows(docs, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")], run, _FOUND)
