"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces of 2048 and then of the powers of two in the binary form
of what is left, largest first. Each piece is a sequence by itself, so no sequence crosses
documents and none needs padding; sequences of one length form a bucket from which batches are
drawn (write the result partitioned by ``length``)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.bpe import LEAF, encoder
from orderlens.llm.common import map_rows

MAX_TOKENS = 2048


def cuts(n: int, most: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; ``most`` is a power of two."""
    out = [(k * most, most) for k in range(n // most)]
    at = n - n % most
    for bit in range(most.bit_length() - 2, -1, -1):
        if n >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack(docs: DataFrame, path: str, end_id: int, most: int = MAX_TOKENS, id_col: str = "doc_id",
         text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset``.

    Null and empty texts are the end id alone. Each input row is cut for itself, so repeated rows
    and null ids need no key. ``sequence_id`` is unique and differs between runs that are
    partitioned differently; materialise the result before reading it twice."""
    if most < 1 or most & (most - 1):
        raise ValueError("the longest piece must be a power of two")

    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        own, end = encoder(path, leaf), end_id.to_bytes(4, "little")
        for key, text in items:
            ids = own.encode(text) + end
            n = len(ids) // 4
            for start, length in cuts(n, most):
                yield (key, start, length, ids[4 * start:4 * (start + length)], n), 4 * length + 40

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    pieces = map_rows(docs, typed, run, pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]))
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
