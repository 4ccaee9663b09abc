"""Secret scans: keyword automaton, anchored expressions at its hits, embedded checksums.

One Aho-Corasick pass over the lower-cased bytes finds every keyword; an expression is tried only
where its keyword starts, left to right and without overlap within a kind. Long hexadecimal runs
have no keyword of their own: their class is mapped to one symbol and 32 of that symbol are the
keyword. GitHub and npm tokens carry a CRC-32 in base 62, which must hold; the header of a JWT
must decode. A run of token characters is tried as a JWT's header once, at the first place in it where
one can start, so a text takes time in proportion to its length."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "private_key")
_EXPR = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "private_key": re.compile(rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
}
_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "private_key": ("-----begin ",),
}
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LONG_HEX, _HEX_RUN = 32, re.compile(rb"[0-9a-f]+")
_HEX_CLASS = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
_TOKEN_RUN = re.compile(rb"[A-Za-z0-9_-]+")
_WORD = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    kinds: dict[str, list[str]] = {}
    for kind, words in _KEYWORDS.items():
        for w in words:
            kinds.setdefault(w, []).append(kind)
    out = ahocorasick.Automaton()
    for w, k in kinds.items():
        out.add_word(w, (len(w), tuple(k)))
    out.make_automaton()
    return out


def base62_crc(body: bytes) -> bytes:
    """CRC-32 of ``body`` as six base-62 digits."""
    n, out = zlib.crc32(body), []
    for _ in range(6):
        n, d = divmod(n, 62)
        out.append(_DIGITS[d])
    return bytes(reversed(out))


def _holds(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= 8
    if kind == "access":
        return len(m[0]) >= 16
    if kind in ("github", "npm"):
        return base62_crc(m[1]) == m[2]
    if kind == "jwt":
        try:
            head = json.loads(base64.urlsafe_b64decode(m[1] + b"=" * (-len(m[1]) % 4)))
        except (binascii.Error, ValueError, RecursionError):
            return False
        return isinstance(head, dict) and "alg" in head
    return True


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed; empty for null."""
    if not text:
        return []
    data = text.encode()
    found: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    # the automaton reports by end; keywords of one kind may nest, so go on by start
    hits = sorted((end + 1 - n, kinds) for end, (n, kinds) in _automaton().iter(data.lower().decode("latin-1")))
    for start, kinds in hits:
        for kind in kinds:
            if start < done[kind] or kind not in BASE and start and data[start - 1] in _WORD:
                continue
            if kind == "jwt":
                done[kind] = _TOKEN_RUN.match(data, start).end() if data.startswith(b"eyJ", start) else start + 1
            if m := _EXPR[kind].match(data, start):
                if holds := _holds(kind, m):
                    found.append((start, KINDS.index(kind), m.end()))
                if holds or kind in BASE:
                    done[kind] = m.end()
    marked, key, at = data.translate(_HEX_CLASS), b"x" * _LONG_HEX, 0
    while (at := marked.find(key, at)) >= 0:
        end = _HEX_RUN.match(data, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = end
    found.sort()
    if len(data) == len(text):
        return [(KINDS[k], a, b) for a, k, b in found]
    place, last, points = {}, 0, 0
    for at in sorted({x for a, _, b in found for x in (a, b)}):
        points += len(data[last:at].decode())
        place[at], last = points, at
    return [(KINDS[k], place[a], place[b]) for a, k, b in found]


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each stretch of spans, overlapping ones together, replaced by ``mark``."""
    if not (found := spans(text)):
        return text
    out, end = [], 0
    for _, a, b in found:
        if a >= end:
            out += [text[end:a], mark]
        end = max(end, b)
    return "".join(out) + text[end:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``found`` (array of kind, start, end in code points).

    Null and empty texts have no spans; repeated rows come out as often as they go in; extra
    columns are ignored."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for key, text in items:
            got = spans(text)
            yield (key, [{"kind": k, "start": a, "end": b} for k, a, b in got]), 40 + 40 * len(got)

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return map_rows(docs, typed, run, pa.schema([("doc_id", pa.int64()), ("found", pa.list_(_SPAN))]))
