"""BPE encoding and decoding of whole texts, with tree concatenation for long unsplit text.

A text longer than ``leaf`` is halved, wherever the middle falls, until its parts are leaves, and the
parts' encodings are joined in pairs. At a join the text around the cut is encoded again: a window that
reaches on both sides to a place where the vocabulary's own splitting can never join across (before a
single space), and grows until the tokens that it replaces are exactly those that end the left part
and begin the right one. A leaf is cut at such places too, and each distinct chunk is encoded once per
worker. Where a vocabulary's ids ascend in merge order, plain text goes through a rank engine over the
same merges, which gives the same ids sooner.

A run without any such place that is longer than ``leaf`` is one piece to BPE itself. It goes by the
same concatenation over tokens: leaves are encoded in parallel, and at every join a window of tokens to
both sides is encoded again and grows until its first and last tokens equal those that stood there.
Then every adjacent pair of tokens is one that BPE itself leaves standing, which makes the whole
sequence the BPE encoding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm.common import map_rows

#: Characters of a text, or of a piece without a place to cut, above which it is halved.
LEAF = 4096
#: Characters that a join looks at on either side of its cut, at first.
AROUND = 32
#: Distinct chunks, and distinct words, that a worker keeps.
KEPT_CHUNKS = 1 << 17
#: A text longer than this is worked through in slices cut at chunk bounds.
SLICE = 1 << 20
#: A space between two other white-space characters (or before the end): not a place to cut.
_UNSAFE = re.compile(r"\s(?= (?:\s|\Z))")


#: Characters that every Unicode version classes alike, so that the rank engine's splitting and the
#: tokenizer's cannot differ. A text or chunk with any other goes to the tokenizer itself.
_ODD = re.compile("[^\\t\\n\\r -~\u00a1-\u012f\u0132-\u017f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]")
_ODD_LATIN = re.compile("[^ -~\u00a1-\u012f\u0132-\u017f]")
#: Fixed value: how a byte-level vocabulary with word ends splits lower-cased text.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Stands for the word-end mark in rank-engine bytes; it occurs in no UTF-8 text.
_END = b"\xff"


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def rank_engine(spec: dict) -> tiktoken.Encoding | None:
    """The same merges by rank, for a vocabulary whose ids ascend in merge order; else None."""
    model, symbols = spec["model"], _byte_of_symbol()
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merged = [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    base = [i for t, i in vocab.items() if len(t.removesuffix(suffix) if suffix else t) == 1]
    if merged != sorted(merged) or len(base) != (512 if suffix else 256) or max(base) > merged[0]:
        return None
    if len(set(merged)) + len(base) != len(vocab) or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
        return None
    ranks = {}
    for token, i in vocab.items():
        stem = token.removesuffix(suffix) if suffix else token
        ranks[bytes(symbols[c] for c in stem) + (_END if len(stem) < len(token) else b"")] = i
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens={t["content"]: t["id"] for t in spec["added_tokens"]})


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f) | {"truncation": None, "padding": None}


class Encoder:
    """ids of whole texts, equal to the tokenizer's own with add_special_tokens=False."""

    def __init__(self, path: str, leaf: int = LEAF):
        spec = read_spec(path)
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.path, self.leaf, self.kept, self.trees = path, leaf, {}, None
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        first = (spec["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        #: white space is dropped and splits: spaces and line ends are one kind of cut
        self.drops_space = first.get("behavior") == "Removed" and first.get("invert", False)
        self.ranks = rank_engine(spec)
        self.core = self.ranks._core_bpe if self.ranks and self.drops_space else None
        self.words: dict[str, bytes] = {}
        #: windows encoded again so far
        self.joins = 0

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(text) <= self.leaf:
            return self._slice(text)
        if not self._unsplit(text):
            return self._halved(text, 0, len(text))
        out, at = [], 0
        while at < len(text):
            end = self._place(text, at + SLICE, 1)
            out.append(self._slice(text[at:end]))
            at = end
        return b"".join(out)

    @staticmethod
    def _place(text: str, at: int, way: int) -> int:
        """The first place from ``at`` on (``way`` 1) or back (-1) before a space between two other
        characters; an end of the text if there is none."""
        while 0 < at < len(text) - 1:
            at = text.find(" ", at) if way > 0 else text.rfind(" ", 0, at + 1)
            if at > 0 and at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
                return at
            if at < 0:
                break
            at += way
        return len(text) if way > 0 else 0

    def _halved(self, text: str, start: int, end: int) -> bytes:
        """ids of ``text[start:end]`` from those of its halves."""
        if end - start <= self.leaf:
            return self._slice(text[start:end])
        cut = (start + end) // 2
        return self._joined(text[start:end], cut - start, self._halved(text, start, cut), self._halved(text, cut, end))

    def _joined(self, text: str, cut: int, left: bytes, right: bytes) -> bytes:
        """ids of ``text`` from those of its parts before and after ``cut``."""
        around = AROUND
        while True:
            a, b = self._place(text, cut - around, -1), self._place(text, cut + around, 1)
            tail, head = self._slice(text[a:cut]), self._slice(text[cut:b])
            agree = left.endswith(tail) and right.startswith(head)
            self.joins += 1
            if agree or a == 0 and b == len(text):  # a window of the whole text replaces all there is
                out = self._slice(text[a:b])
                return left[:len(left) - len(tail)] + out + right[len(head):] if agree else out
            around *= 4

    def _unsplit(self, text: str) -> bool:
        """Whether a run without white space is long enough for the tree."""
        return len(text) > self.leaf and max(map(len, text.split()), default=0) > self.leaf

    def _slice(self, text: str) -> bytes:
        if self.drops_space:
            chunks = text.replace("\n", " ").split(" ")
        elif self.ranks and not self._unsplit(text) and not _ODD.search(text):
            return self.ranks.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        elif _UNSAFE.search(text):
            chunks = [text]
        else:
            first, *rest = text.split(" ")
            chunks = [first, *[" " + x for x in rest]]
        kept = self.kept
        try:
            return b"".join([kept[x] for x in chunks])
        except KeyError:
            pass
        new = [x for x in dict.fromkeys(chunks) if x not in kept]
        if len(kept) + len(new) > KEPT_CHUNKS:
            kept.clear()
            new = list(dict.fromkeys(chunks))
        own, rest = {}, []
        for x in new:
            if self._unsplit(x):
                own[x] = self._long(x)
            elif self.core is not None and not _ODD_LATIN.search(x) and "<|" not in x:
                kept[x] = self._by_words(x)
            else:
                rest.append(x)
        for x, e in zip(rest, self.whole.encode_batch_fast(rest, add_special_tokens=False)):
            kept[x] = np.array(e.ids, "<u4").tobytes()
        return b"".join([own[x] if x in own else kept[x] for x in chunks])

    def _by_words(self, chunk: str) -> bytes:
        """Word by word through the rank engine; each distinct word is encoded once."""
        out, words = [], self.words
        for w in _WORDS.findall(chunk.lower()):
            ids = words.get(w)
            if ids is None:
                if len(words) >= KEPT_CHUNKS:
                    words.clear()
                ids = words[w] = np.array(self.core.encode_single_piece(w.encode() + _END), "<u4").tobytes()
            out.append(ids)
        return b"".join(out)

    def _long(self, chunk: str) -> bytes:
        """A chunk with no safe cut: added tokens first, then the vocabulary's own splitting, then
        the tree for each piece that is still long."""
        out: list[int] = []
        marks = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        for part in re.split(f"({marks})", chunk) if marks else [chunk]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                if self.whole.normalizer is not None:
                    part = self.whole.normalizer.normalize_str(part)
                for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(part):
                    out += self.tree().encode(piece)
        return np.array(out, "<u4").tobytes()

    def tree(self) -> Tree:
        self.trees = self.trees or Tree(read_spec(self.path), self.leaf)
        return self.trees


class Tree:
    """BPE of one unsplit piece (in the vocabulary's own characters) by halves and windows."""

    def __init__(self, spec: dict, leaf: int):
        def bare(suffix: str | None) -> Tokenizer:
            model = spec["model"] | {"end_of_word_suffix": suffix}
            return Tokenizer.from_str(json.dumps(spec | {"model": model, "normalizer": None, "pre_tokenizer": None, "added_tokens": [], "decoder": None, "post_processor": None}))

        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.last = bare(self.suffix or None)  # ends the piece
        self.inner = bare(None) if self.suffix else self.last  # more follows
        self.surface = {i: t for t, i in spec["model"]["vocab"].items()}
        self.leaf = max(1, leaf)

    def encode(self, piece: str) -> list[int]:
        if len(piece) <= self.leaf:
            return self.last.encode(piece, add_special_tokens=False).ids
        cuts = [piece[i:i + self.leaf] for i in range(0, len(piece), self.leaf)]
        level = [e.ids for e in self.inner.encode_batch(cuts[:-1], add_special_tokens=False)]
        level.append(self.last.encode(cuts[-1], add_special_tokens=False).ids)
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1], i + 2 == len(level)) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0]

    def text(self, ids: list[int], ends: bool) -> str:
        out = "".join(self.surface[i] for i in ids)
        return out.removesuffix(self.suffix) if ends else out

    def join(self, a: list[int], b: list[int], ends: bool, window: int = 4) -> list[int]:
        """``ends``: ``b`` ends the piece."""
        while True:
            i, j = min(window, len(a)), min(window, len(b))
            to_end = ends and j == len(b)
            old = a[len(a) - i:] + b[:j]
            new = (self.last if to_end else self.inner).encode(self.text(old, to_end), add_special_tokens=False).ids
            if (i == len(a) or new[0] == old[0]) and (j == len(b) or new[-1] == old[-1]):
                return a[:len(a) - i] + new + b[j:]
            window *= 2


class Decoder:
    """Text of ids, equal to the tokenizer's own with skip_special_tokens=False."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.pieces = None
        if self.whole.decoder is None:  # tokens joined by spaces; ids outside the vocabulary vanish
            self.pieces = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
            self.whole = None

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        if self.pieces is None:
            return self.whole.decode(numbers, skip_special_tokens=False)
        try:
            return " ".join([self.pieces[i] for i in numbers])
        except KeyError:
            return " ".join([self.pieces[i] for i in numbers if i in self.pieces])


@lru_cache(maxsize=4)
def encoder(path: str, leaf: int = LEAF) -> Encoder:
    return Encoder(path, leaf)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit).

    Null texts count as empty and have no ids. Repeated rows come out as often as they go in; the
    rows need no key. Extra columns are ignored. ``path`` must be readable on every executor."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        own = encoder(path, leaf)
        for key, text in items:
            ids = own.encode(text)
            yield (key, len(ids) // 4, ids), len(ids)

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return map_rows(docs, typed, run, pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to rows of :func:`encode`. Null ids decode to the empty text."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        own = decoder(path)
        for key, n, ids in items:
            text = own.decode(ids)
            yield (key, n, ids, text), len(ids or b"") + len(text)

    return map_rows(encoded, ["doc_id", "n_tokens", "ids"], run, pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())]))
