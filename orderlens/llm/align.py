"""Alignment of two tokenizers over the same bytes, by pointer jumping.

The tokens of both vocabularies tile the bytes of a text. A token points to the farthest-right token
of the other vocabulary that overlaps it, the one that covers its last byte; a token of the second
vocabulary that ends where one of the first does points to itself. Doubling the successors of all
tokens of a batch of documents until nothing changes leads every token to the last one of its
component, whose number is the label of the group; groups end where both vocabularies have a bound.

Every pair of tokens in a group is a link. How many documents hold a pair of ids linked is counted
over the corpus: tasks count what they hold, then the sums are shuffled. The counts come back to the
documents in two ways. The most frequent pairs, ``HEAD`` at most, are sent to all tasks; each other
pair holds less than 2 in ``HEAD`` of all rows, so the join that finds its count has no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import bpe
from orderlens.llm.common import map_rows, rows, ship, stage
from orderlens.session import drop_stage

#: Tokens after which a batch of documents is aligned.
BATCH_TOKENS = 1 << 18
#: Pairs whose counts are sent to every task, at most.
HEAD = 1 << 18
#: Links of one group that are listed at once, and pairs of a document that go into one row.
SMALL, ROW_PAIRS = 64, 1 << 20
#: Codes that a task gathers before it counts them.
GATHERED = 1 << 22


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the printed ids."""

    def __init__(self, path_a: str, path_b: str):
        spec = bpe.read_spec(path_a)
        self.whole = Tokenizer.from_file(path_a)
        self.whole.encode_special_tokens = True
        self.ranks = bpe.rank_engine(spec)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        symbols, added = bpe._byte_of_symbol(), {t["id"] for t in spec["added_tokens"]}
        self.bytes_a = [b""] * self.whole.get_vocab_size()
        for token, i in self.whole.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = token.encode() if i in added else bytes(symbols[c] for c in token)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size()))]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: every id with what may follow it: first vocabulary "," or "|", second "," or ";" or nothing
        self.printed = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_a)) for end in ",|"] +
                                [f"{i}{end}".encode() for i in range(len(self.bytes_b)) for end in (",", ";", "")], object)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both token sequences of a space and the text; none for a text that either does not give back."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        spaced = " " + text
        if self.ranks is not None and not bpe._ODD.search(text):
            a = self.ranks.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        else:
            a = np.array(self.whole.encode(spaced, add_special_tokens=False).ids, np.int64)
        b = self.pieces.encode(text)
        data = spaced.encode()
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return none, none
        return a, np.array(b, np.int64)


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token, numbered from 0 in text order. ``ends_*``: ascending byte offsets
    where tokens end; the last of both are equal."""
    n = len(ends_a)
    cover_a, cover_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    last = ends_a[cover_b] == ends_b if n else np.zeros(0, bool)
    after = np.concatenate([n + cover_a, np.where(last, n + np.arange(len(ends_b)), cover_b)])
    while True:
        twice = after[after]
        if (twice == after).all():
            break
        after = twice
    number = np.cumsum(last) - 1
    return number[after[:n] - n], number[after[n:] - n]


def _linked(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
            many_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, pair code, times) of all links, in portions; a group of many links first folds equal ids."""
    from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    few = n_a * n_b <= SMALL
    mine = few[in_a]
    own, group = a[mine], in_a[mine]
    each = n_b[group]
    step = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    group = np.repeat(group, each)
    code = np.repeat(own, each) * many_b + b[from_b[group] + step]
    yield group, code, np.ones(len(code), np.int64)
    for g in np.flatnonzero(~few).tolist():
        left, times_left = np.unique(a[from_a[g]:from_a[g] + n_a[g]], return_counts=True)
        right, times_right = np.unique(b[from_b[g]:from_b[g] + n_b[g]], return_counts=True)
        portion = max(1, GATHERED // len(right))
        for at in range(0, len(left), portion):
            code = (left[at:at + portion, None] * many_b + right).ravel()
            yield np.full(len(code), g), code, (times_left[at:at + portion, None] * times_right).ravel()


def align_batch(own: Vocabularies, docs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int, int, bytes, np.ndarray, np.ndarray]]:
    """For each document (token ids of both): numbers of tokens, groups and links, the printed groups,
    the codes of its distinct pairs in ascending order and how many links each has."""
    a, b = (np.concatenate([d[k] for d in docs]) if docs else np.zeros(0, np.int64) for k in (0, 1))
    many_a, many_b = len(own.bytes_a), len(own.bytes_b)
    in_a, in_b = groups_of(np.cumsum(own.sizes_a[a]), np.cumsum(own.sizes_b[b]))
    count = int(in_a[-1]) + 1 if len(a) else 0
    n_a, n_b = np.bincount(in_a, minlength=count), np.bincount(in_b, minlength=count)
    to_a, to_b = (np.cumsum([0] + [len(d[k]) for d in docs]) for k in (0, 1))
    ends_doc = np.zeros(len(b) + 1, bool)
    ends_doc[to_b] = True
    # printed: the groups in order, in each the tokens of the first vocabulary, then the second's
    more_a, more_b = np.append(in_a[1:] == in_a[:-1], False)[:len(a)], np.append(in_b[1:] == in_b[:-1], False)[:len(b)]
    ahead_a, ahead_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
    codes = np.zeros(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + ahead_b[in_a]] = 2 * a + ~more_a
    codes[np.arange(len(b)) + ahead_a[in_b + 1]] = 2 * many_a + 3 * b + np.where(more_b, 0, 1 + ends_doc[1:])
    printed = own.printed[codes]
    of_group = np.searchsorted(to_b, np.searchsorted(in_b, np.arange(count)), "right") - 1  # its document
    links = np.append(0, np.cumsum(n_a * n_b))
    groups = np.searchsorted(of_group, np.arange(len(docs) + 1))
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for group, code, times in _linked(a, b, in_a, in_b, n_a, n_b, many_b):
        keys, at = np.unique(of_group[group] * (many_a * many_b) + code, return_inverse=True)
        parts.append((keys, np.bincount(at, times, len(keys)).astype(np.int64)))
    keys, times = parts[1] if len(parts) == 2 else (np.concatenate(x) for x in zip(*parts))
    if len(parts) > 2:
        keys, at = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, times)
        times = sums
    from_key = np.searchsorted(keys, np.arange(len(docs) + 1) * (many_a * many_b))
    for d, (own_a, own_b) in enumerate(docs):
        g, h, k = groups[d], groups[d + 1], slice(from_key[d], from_key[d + 1])
        text = b"".join(printed[to_a[d] + to_b[d]:to_a[d + 1] + to_b[d + 1]].tolist())
        yield len(own_a), len(own_b), int(h - g), int(links[h] - links[g]), text, keys[k] - d * (many_a * many_b), times[k]


_ALIGNED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", printed: bool = True) -> DataFrame:
    """The groups of every text preceded by a space, which the second tokenizer adds by itself.

    Columns: ``row`` (unique per input row), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``; null unless ``printed``), ``groups_sha256`` (``''`` where there are
    no tokens), ``pairs`` (the distinct linked id pairs as ascending little-endian 64-bit codes, first id
    times the size of the second vocabulary plus second id) and ``times`` (links of each, 64-bit). A
    document with very many pairs goes on in further rows of the same ``row``, null but for the pairs.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens.
    Repeated rows are rows of their own; null ids stay null; extra columns are ignored. Strings of
    special tokens inside texts are plain text."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        own = vocabularies(path_a, path_b)
        held: list[tuple] = []

        def done() -> Iterator[tuple[tuple, int]]:
            for (row, key, _), (n_a, n_b, n, links, text, codes, times) in zip(held, align_batch(own, [h[2] for h in held])):
                sha = hashlib.sha256(text).hexdigest() if n_a else ""
                first = (row, key, n_a, n_b, n, links, sha, text.decode() if printed else None)
                for at in range(0, max(len(codes), 1), ROW_PAIRS):
                    part = [x[at:at + ROW_PAIRS].astype("<i8").tobytes() for x in (codes, times)]
                    yield (*first, *part), 100 + 2 * len(part[0]) + (len(text) if printed else 0)
                    first = (row, *[None] * 7)

        size = 0
        for row, key, text in items:
            held.append((row, key, own.encode(text)))
            size += len(held[-1][2][0]) + 100
            if size >= BATCH_TOKENS:
                yield from done()
                held, size = [], 0
        yield from done()

    typed = [F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return map_rows(docs, typed, run, _ALIGNED)


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(codes, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)


def count_pairs(aligned: DataFrame) -> DataFrame:
    """(``pair``, ``docs``): how many rows of :func:`align` hold the pair linked. Tasks add up what they
    meet, in bounded portions, before the sums are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(codes, counts):
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["pair", "docs"])

        own, new, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for (pairs,) in rows(batches):
            new.append(np.frombuffer(pairs, "<i8"))
            size += len(new[-1])
            if size >= GATHERED:
                fresh = np.concatenate(new)
                own = _summed(np.concatenate([own[0], fresh]), np.concatenate([own[1], np.ones(len(fresh), np.int64)]))
                new, size = [], 0
                if len(own[0]) >= GATHERED:
                    yield batch(*own)
                    own = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        fresh = np.concatenate([np.zeros(0, np.int64), *new])
        yield batch(*_summed(np.concatenate([own[0], fresh]), np.concatenate([own[1], np.ones(len(fresh), np.int64)])))

    ship(aligned.sparkSession)
    return aligned.select("pairs").mapInArrow(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


def head_bound(counts: DataFrame, most: int = HEAD) -> int:
    """The least power of two such that at most ``most`` pairs are held by so many documents."""
    classes = counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()  # 64 at most
    held, bound = 0, max((r["power"] for r in classes), default=0) + 1
    for power, n in sorted(((r["power"], r["n"]) for r in classes), reverse=True):
        held += n
        if held > most:
            break
        bound = power
    return 1 << bound


def score_links(aligned: DataFrame, many_b: int, head: int = HEAD) -> DataFrame:
    """Written rows of :func:`align` with ``n_best`` (links whose pair is held by as many documents as any
    pair of its first id) and ``count_sum`` (documents of the pair, added up over the links); 0 where a
    document has no links. ``many_b``: size of the second vocabulary. The pairs' own columns are left out."""
    spark = aligned.sparkSession
    counts = stage(count_pairs(aligned), "pair-counts")
    bound = head_bound(counts, head)
    first = F.floor(F.col("pair") / many_b)
    best = counts.groupBy(first.alias("id")).agg(F.max("docs").alias("docs")).collect()  # one row per id of the first vocabulary
    frequent = counts.filter(F.col("docs") >= bound).orderBy("pair").collect()  # ``head`` rows at most
    table_best = np.zeros(max((r["id"] for r in best), default=0) + 1, np.int64)
    for r in best:
        table_best[r["id"]] = r["docs"]
    sent = spark.sparkContext.broadcast((table_best, *(np.array([r[c] for r in frequent], np.int64) for c in ("pair", "docs"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, codes, docs = sent.value
        names = ["row", "pair", "times", "best", "n_best", "count_sum"]
        for batch in batches:
            out = [[] for _ in names]
            for row, pairs, times in rows([batch]):
                pairs, times = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i8")
                at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
                known = codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)
                found, top = docs[at[known]], best[pairs // many_b]
                rest, n = ~known, int((~known).sum())
                # one row of what is known, under a code that no pair has, and one for each other pair
                for column, own, others in zip(out, (row, -1 - row, 0, 0, times[known][found == top[known]].sum(), (times[known] * found).sum()),
                                               (np.full(n, row), pairs[rest], times[rest], top[rest], np.zeros(n), np.zeros(n))):
                    column += [np.array([own], np.int64), others.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for c in out], names=names)

    ship(spark)
    parts = aligned.select("row", "pairs", "times").mapInArrow(run, "row long, pair long, times long, best long, n_best long, count_sum long")
    tail = parts.join(counts.filter(F.col("docs") < bound), "pair", "left")
    docs = F.coalesce(F.col("docs"), F.lit(0))
    sums = tail.groupBy("row").agg(F.sum(F.col("n_best") + F.when(docs == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("count_sum") + F.col("times") * docs).alias("count_sum"))
    return aligned.filter("n_a IS NOT NULL").drop("pairs", "times").join(sums, "row")


def link_report(docs: DataFrame, path_a: str, path_b: str, head: int = HEAD) -> DataFrame:
    """:func:`align` and :func:`score_links` over a whole table: a row per document, without the printed
    groups."""
    many_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return score_links(stage(align(docs, path_a, path_b, printed=False), "aligned"), many_b, head)
