"""Bounded training samples for the positive-unlabelled classifiers.

Only the samples are bounded (``most_positive`` labelled positives and ``most_unlabelled`` texts,
chosen by a hash of the id); scoring always covers every row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import fold

MOST_POSITIVE, MOST_UNLABELLED = 3000, 6000
_RANGE = 1 << 30


@dataclass(frozen=True)
class Fold:
    """Rows whose crc32(id as text) modulo ``parts`` is ``held`` are never learnt from."""

    parts: int
    held: int

    def held_out(self, id_col: str = "doc_id") -> Column:
        return F.coalesce(fold(id_col, self.parts) == self.held, F.lit(False))


def _chosen(id_col: str, most: int, of: int, salt: int) -> Column:
    share = _RANGE if of <= most else int(_RANGE * 0.95 * most / of)
    return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.lit(_RANGE)) < share


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: Fold, id_col: str, text_col: str,
           most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> tuple[DataFrame, float]:
    """(rows (``positive``, ``text``), class prior). The prior is the share of positives among the
    labelled ids of the learning folds, each id once; an id labelled both ways counts as positive.
    Unlabelled texts are drawn from all ids of those folds, whatever their label; an id with several
    texts gives the smallest."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~folds.held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label) == 1).alias("positive")))
    n, positives = known.agg(F.count("*"), F.coalesce(F.sum(F.col("positive").cast("long")), F.lit(0))).first()
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .where(F.col("id").isNotNull() & ~folds.held_out("id")))
    total = docs.count()
    # about `most_positive` ids at most: small by construction, so the documents are not shuffled for them
    picked = known.where(F.col("positive") & _chosen("id", most_positive, positives, 1)).select("id").limit(most_positive)
    rows = texts.join(F.broadcast(picked), "id", "left_semi").select(F.lit(True).alias("positive"), "id", "text")
    other = texts.where(_chosen("id", most_unlabelled, total, 2)).select(F.lit(False).alias("positive"), "id", "text")
    # one text an id: rows that repeat an id cannot swell the sample, and it is dealt out before it is worked on
    drawn = rows.unionByName(other).groupBy("positive", "id").agg(F.min("text").alias("text"))
    return drawn.select("positive", "text"), (positives / n if n else 0.0)
