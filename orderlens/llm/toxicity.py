"""Toxicity by non-negative positive-unlabelled learning over hashed words and word beginnings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows, stage
from orderlens.llm.pu import fit
from orderlens.llm.pusample import MOST_POSITIVE, MOST_UNLABELLED, Fold, sample

FOLDS = Fold(5, 0)
BITS = 20
#: Features that the model may use, chosen by how far their rate among positives lies above that among
#: unlabelled texts, and sampled positives that a feature must occur in (defaults of :func:`train`).
MOST_FEATURES, LEAST_POSITIVES = 1 << 12, 3
#: Unlabelled texts in the sample; four times as many as for quality, for a toxic word is rare among them.
#: Chosen on a validation fold out of the learning folds.
UNLABELLED = 4 * MOST_UNLABELLED
#: Distinct words whose weight a worker keeps.
KEPT_WORDS = 1 << 19
_BEGINNINGS = (4, 5, 6)
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@lru_cache(maxsize=1 << 17)
def word_features(word: str) -> frozenset[int]:
    """Hashes of a lower-cased word without outer punctuation and of its first 4, 5 and 6 letters."""
    word = word.strip(_EDGE)
    keys = {f"={word}"} | {f"^{word[:k]}" for k in _BEGINNINGS if len(word) >= k}
    return frozenset(zlib.crc32(k.encode("utf-8", "replace")) >> (32 - BITS) for k in keys) if word else frozenset()


def features(text: str | None) -> list[int]:
    out: set[int] = set()
    for w in set((text or "").lower().split()):
        out |= word_features(w)
    return sorted(out)


class Scorer:
    """Sum of the weights of a text's distinct words."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias, self.kept = weights, bias, {}

    def word(self, word: str) -> float:
        if len(self.kept) >= KEPT_WORDS:
            self.kept.clear()
        w = self.kept[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return w

    def score(self, text: str | None) -> float:
        kept, z = self.kept, self.bias
        for w in set((text or "").lower().split()):
            v = kept.get(w)
            z += self.word(w) if v is None else v
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, z)))))


def train(docs: DataFrame, labels: DataFrame, folds: Fold = FOLDS, id_col: str = "doc_id", text_col: str = "text",
          most_positive: int = MOST_POSITIVE, most_unlabelled: int = UNLABELLED,
          most_features: int = MOST_FEATURES, least_positives: int = LEAST_POSITIVES) -> Scorer:
    """Fit on bounded samples of the learning folds. Without positives every score is near 0. The four
    bounds limit the model and its samples, never the rows that it scores."""
    rows, prior = sample(docs, labels, "toxic", folds, id_col, text_col, most_positive, most_unlabelled)

    def hashed(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for positive, text in items:
            f = features(text)
            yield (positive, f), 4 * len(f)

    schema = pa.schema([("positive", pa.bool_()), ("features", pa.list_(pa.int32()))])
    drawn = stage(map_rows(rows, ["positive", "text"], hashed, schema), "toxicity-sample")
    n = dict(drawn.groupBy("positive").count().collect())
    if not n.get(True) or not n.get(False):
        return Scorer({}, -60.0)
    p, u = F.col("p") / n[True], F.col("u") / n[False]
    rates = (drawn.select("positive", F.explode("features").alias("feature")).groupBy("feature")
             .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")))
    apart = (p - u) / F.sqrt(F.greatest(u, F.lit(1.0 / n[False])))
    best = rates.where((F.col("p") >= least_positives) & (apart > 0)).orderBy(apart.desc(), "feature").limit(most_features).select("feature")
    number = {f: i for i, (f,) in enumerate(best.collect())}

    def narrowed(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for positive, f in items:
            own = np.array([number[x] for x in f if x in number], "<i4")
            yield (positive, own.tobytes()), 4 * len(own)

    got = map_rows(drawn, ["positive", "features"], narrowed, pa.schema([("positive", pa.bool_()), ("features", pa.binary())])).collect()
    sets = {flag: [np.frombuffer(f, "<i4") for x, f in got if x == flag] for flag in (True, False)}
    w, b = fit(sets[True], sets[False], max(1, len(number)), prior, sparsity=1.5e-4, rising=True)
    return Scorer({f: float(w[i]) for f, i in number.items() if w[i]}, b)


def score(docs: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text", folds: Fold = FOLDS) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null and empty texts get the model's bias. A null id is not held out. Repeated rows come out as
    often as they go in; extra columns are ignored."""
    weights, bias = model.weights, model.bias

    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        own = Scorer(weights, bias)
        for key, text in items:
            yield (key, own.score(text)), 16

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    out = map_rows(docs, typed, run, pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))
    return out.select("doc_id", folds.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
