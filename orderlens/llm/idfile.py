"""Token ids in binary files: Simple-8b words in blocks, in ascending document order.

A word of 64 bits holds a selector in its top four bits and as many ids as fit into the other 60 at
one width. The writer takes the largest count that fits, so frequent small ids share a word. Selector
15 stands for 240 zeros. Selector 0 is the escape: such a word holds no id of its own but the bits
above the 60th of the id in the next word, so ids of up to 64 bits can be written and every word is
read by the same rule. A block holds ``BLOCK`` ids and starts with a word of its own; the word offset
of each block is kept, so any block is decoded alone and all words of a block at once.

A file is one range of document ids. Its rows are segments, each of about ``SEGMENT`` ids and of whole
documents: the words, the block offsets, and the ids and lengths of the documents. The table of files
(how many ids lie before each) is written last; readers go by it, so a write that was cut short
is not taken for a whole one. Everything is written and read by Spark, in any store that it reaches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm import bpe
from orderlens.llm.common import map_rows

#: Ids of a word by selector: 0 is the escape, 15 a run of zeros, the others share 60 bits evenly.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 240])
ESCAPE, SINGLE, ZEROS, PAYLOAD = 0, 14, 15, 60
WIDTHS = [0 if s in (ESCAPE, ZEROS) else PAYLOAD // int(c) for s, c in enumerate(COUNTS)]
#: Ids of a block, and ids after which a segment is closed.
BLOCK, SEGMENT = 4096, 1 << 18


_NARROW = np.array([k.bit_length() for k in range(1 << 16)], np.uint8)
_POWERS = np.array([1 << k for k in range(64)], np.uint64)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs; 0 needs none."""
    return _NARROW[ids] if ids.max() < len(_NARROW) else np.searchsorted(_POWERS, ids, "right").astype(np.uint8)


def _all_in_window(fits: np.ndarray, n: int) -> np.ndarray:
    """Along each row, whether ``n`` places from here on fit (fewer near the end: not)."""
    out, have = fits, 1
    while have < n:  # windows double, the last step overlaps
        step = min(have, n - have)
        out = out[:, :out.shape[1] - step] & out[:, step:]
        have += step
    return out


def pack_ids(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block) of unsigned ids. No ids give no words and no blocks."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n, most = len(ids), int(COUNTS.max())
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # one row per block; the room behind the last id takes whatever is missing
    bits = np.zeros((-(-n // block), block + most), np.uint8)
    flat = np.zeros(bits.shape[0] * block, np.uint8)
    flat[:n] = _bits(ids)
    bits[:, :block] = flat.reshape(-1, block)
    chosen = np.full((len(bits), block), ESCAPE, np.uint8)
    for s in [*range(SINGLE, 0, -1), ZEROS]:  # the largest count that fits is set last
        fits = _all_in_window(bits <= WIDTHS[s], int(COUNTS[s]))[:, :block]
        if not fits.any():
            break  # nor does any larger count at a smaller width
        chosen[fits] = s
    chosen = chosen.ravel()[:n]
    held = COUNTS[chosen]
    held[chosen == ESCAPE] = 1
    step, starts = held.tolist(), []
    for at in range(0, n, block):
        end = min(at + block, n)
        while at < end:
            starts.append(at)
            at += step[at]
    first = np.array(starts)
    kind = chosen[first]
    escaped = kind == ESCAPE
    place_of = np.cumsum(1 + escaped) - 1  # of the word that holds the ids
    words = np.zeros(int(place_of[-1]) + 1, np.uint64)
    padded = np.concatenate([ids, np.zeros(most, np.uint64)])
    ends = np.minimum((first // block + 1) * block, n)
    for s in range(1, ZEROS):
        mine = np.flatnonzero((kind == s) | escaped if s == SINGLE else kind == s)
        if len(mine):
            at, width, end = first[mine], WIDTHS[s], ends[mine]
            whole = at + COUNTS[s] <= end
            word = np.full(len(mine), s << PAYLOAD, np.uint64)
            for k in range(COUNTS[s]):
                own = padded[at + k] & np.uint64((1 << PAYLOAD) - 1)
                if not whole.all():
                    own = np.where(at + k < end, own, np.uint64(0))
                word |= own << np.uint64(k * width)
            words[place_of[mine]] = word
    words[place_of[kind == ZEROS]] = np.uint64(ZEROS << PAYLOAD)
    words[place_of[escaped] - 1] = ids[first[escaped]] >> np.uint64(PAYLOAD)
    return words, (place_of - escaped)[first % block == 0]


def unpack_ids(words: np.ndarray, blocks: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of :func:`pack_ids`, or of a slice of whole blocks whose offsets are given
    relative to the slice."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    kind = (words >> np.uint64(PAYLOAD)).astype(np.int8)
    held = COUNTS[kind]
    before = np.cumsum(held) - held
    own = np.repeat(np.arange(len(blocks)), np.diff(np.append(blocks, len(words))))
    first = own * block + before - before[blocks][own]
    ends = np.minimum((own + 1) * block, n)
    for s in range(1, ZEROS):
        mine = np.flatnonzero(kind == s)
        if len(mine):
            at, word, end = first[mine], words[mine], ends[mine]
            whole = (at + COUNTS[s] <= end).all()  # the last word of a block may have room left
            for k in range(COUNTS[s]):
                ids = word >> np.uint64(k * WIDTHS[s]) & np.uint64((1 << WIDTHS[s]) - 1)
                inside = slice(None) if whole else at + k < end
                out[at[inside] + k] = ids[inside]
    high = np.flatnonzero(kind == ESCAPE)
    out[first[high + 1]] |= words[high] << np.uint64(PAYLOAD)
    return out


def unpack_range(words: np.ndarray, blocks: np.ndarray, n: int, start: int, stop: int, block: int = BLOCK) -> np.ndarray:
    """The ids from ``start`` to before ``stop``; only the blocks that hold them are decoded."""
    a, b = start // block, -(-stop // block)
    if start >= stop:
        return np.zeros(0, np.uint64)
    to = blocks[b] if b < len(blocks) else len(words)
    ids = unpack_ids(words[blocks[a]:to], blocks[a:b] - blocks[a], min(n, b * block) - a * block, block)
    return ids[start - a * block:stop - a * block]


_SEGMENT = pa.schema([
    ("file", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("words", pa.binary()),
    ("blocks", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64()))])


def _write(dealt: DataFrame, out: str, segment: int, ids_of: Callable[[], Callable[[object], bytes]]) -> None:
    """Write the rows (document id, what ``ids_of`` turns into ids) of each partition as one file."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        file, number, before, own = TaskContext.get().partitionId(), 0, 0, ids_of()
        docs, sizes, held, total = [], [], [], 0

        def close() -> tuple[tuple, int]:
            words, blocks = pack_ids(np.frombuffer(b"".join(held), "<u4"))
            row = (file, number, before, total, words.astype("<u8").tobytes(), blocks.astype("<u4").tobytes(), docs, sizes)
            return row, 8 * len(words) + 16 * len(docs)

        for key, value in rows:
            ids = own(value)
            docs.append(key)
            sizes.append(len(ids) // 4)
            held.append(ids)
            total += len(ids) // 4
            if total >= segment or len(docs) >= segment:
                yield close()
                number, before = number + 1, before + total
                docs, sizes, held, total = [], [], [], 0
        if docs:
            yield close()

    spark, base = dealt.sparkSession, out.rstrip("/")
    map_rows(dealt, dealt.columns, run, _SEGMENT).write.parquet(f"{base}/segments")
    # one row per file: as many as Spark has dealt partitions
    files = spark.read.parquet(f"{base}/segments").groupBy("file").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("doc_ids")).alias("n_docs"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0))).write.parquet(f"{base}/files")


def _dealt(rows: DataFrame, id_col: str, value: Column) -> DataFrame:
    """Ascending ids over the partitions, null ids first; rows of one id by the value's hash and then as
    they came, so that copies of one row, however many, are spread like others."""
    keyed = rows.select(F.col(id_col).cast("long").alias("key"), value.alias("value"), F.xxhash64(value).alias("sum"),
                        F.monotonically_increasing_id().alias("row"))
    order = [F.col(c).asc_nulls_first() for c in ("key", "sum", "row")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "value")


def write_ids(encoded: DataFrame, out: str, ids_col: str = "ids", id_col: str = "doc_id", segment: int = SEGMENT) -> None:
    """Write rows of (document id, ids as little-endian unsigned 32-bit) below the new folder ``out``.

    Documents lie in ascending id order over the files, null ids first; rows of one id by the hash of
    their ids, so a repeated row is written as often as it occurs. A row whose ids are null keeps its
    place with length 0. No rows give a table of no files. A document is never divided, so a segment is
    larger than ``segment`` where a document is. Other columns are not written. ``encoded`` is read
    twice (Spark samples the ranges)."""
    _write(_dealt(encoded, id_col, F.col(ids_col)), out, segment, lambda: lambda ids: ids or b"")


def write_documents(docs: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                    segment: int = SEGMENT) -> None:
    """Encode whole texts with the tokenizer at ``path``, append ``end_id`` to each document and write
    the ids as :func:`write_ids` does; rows of one id come by the hash of their texts. Texts are shuffled,
    which are smaller than their ids, and encoded by the task that writes them. Null and empty texts
    are the end id alone."""
    def ids_of():
        own, end = bpe.encoder(path), end_id.to_bytes(4, "little")
        return lambda text: own.encode(text) + end

    _write(_dealt(docs, id_col, F.col(text_col).cast("string")), out, segment, ids_of)


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """One row per written document: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids``, from the files alone."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for file, first, n, words, blocks, docs, sizes in rows:
            data = unpack_ids(np.frombuffer(words, "<u8"), np.frombuffer(blocks, "<u4").astype(np.int64), n).astype("<u4").tobytes()
            at = 0
            for key, size in zip(docs, sizes):
                yield (file, key, first + at, size, data[4 * at:4 * (at + size)]), 4 * size + 40
                at += size

    base = out.rstrip("/")
    files = spark.read.parquet(f"{base}/files").select("file", "ids_before")
    docs = map_rows(spark.read.parquet(f"{base}/segments"), ["file", "first_id", "n_ids", "words", "blocks", "doc_ids", "doc_tokens"], run, pa.schema(
        [("file", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]))
    # as many rows as files
    return docs.join(F.broadcast(files), "file").select("doc_id", (F.col("ids_before") + F.col("at")).alias("start"), "n_tokens", "ids")


def read_window(spark: SparkSession, out: str, start: int, stop: int) -> DataFrame:
    """The ids at places ``start`` to before ``stop`` of the whole sequence, as rows (``start``,
    ``ids``) of one segment each. Files and segments outside are skipped by their counts, and only
    the blocks that hold the places are decoded."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for first, n, words, blocks in rows:
            a, b = max(start - first, 0), min(stop - first, n)
            ids = unpack_range(np.frombuffer(words, "<u8"), np.frombuffer(blocks, "<u4").astype(np.int64), n, a, b)
            yield (first + a, ids.astype("<u4").tobytes()), 4 * len(ids)

    base = out.rstrip("/")
    files = spark.read.parquet(f"{base}/files").filter((F.col("ids_before") < stop) & (F.col("ids_before") + F.col("n_ids") > start))
    first = (F.col("ids_before") + F.col("first_id")).alias("first")
    segments = spark.read.parquet(f"{base}/segments").join(F.broadcast(files.select("file", "ids_before")), "file")
    asked = segments.select(first, "n_ids", "words", "blocks").filter((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    return map_rows(asked, ["first", "n_ids", "words", "blocks"], run, pa.schema([("start", pa.int64()), ("ids", pa.binary())]))
