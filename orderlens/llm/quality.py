"""Text quality by non-negative positive-unlabelled learning: trusted positives against unlabelled
web text, over binned measures of a text's shape."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows
from orderlens.llm.pu import fit
from orderlens.llm.pusample import MOST_POSITIVE, MOST_UNLABELLED, Fold, sample

FOLDS = Fold(3, 1)
#: An overstated prior holds the risk of unlabelled texts at its floor; the estimate is lowered by this.
PRIOR_MARGIN = 0.02
_LETTERS = bytes(c for c in range(256) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
_DIGITS, _SYMBOLS = b"0123456789", b"#*$%&|<>{}[]\\^~_=+@"
_MARKS = b".,;:!?'\"()-"


def measures(text: str | None) -> list[float]:
    """Shape of a text; all zero without words. No measure grows with the text but its log length."""
    data = (text or "").encode()
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * 14
    low = [w.lower() for w in words]
    kinds = len(set(low))
    beside = sum(a == b for a, b in zip(low, low[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda chars: (size - len(data.translate(None, chars))) / size
    capitals = sum(w[:1].isupper() for w in words)
    bare = sum(not w.strip(_SYMBOLS + _MARKS) for w in words)
    tail = sum(w[-1:] in (b".", b"!", b"?") for w in words)
    # distinct words against what a text of this length has on average: log-log, so length drops out
    variety = math.log(kinds + 1) / math.log(n + 1)
    pairs = len(set(zip(low, low[1:]))) / max(1, n - 1)
    return [math.log(n), variety, kinds / n, beside / max(1, n - 1), pairs, sum(map(len, words)) / n, share(_LETTERS), share(_DIGITS),
            share(_SYMBOLS), share(_MARKS), capitals / n, bare / n, tail / n, len(set(lines)) / len(lines)]


class Model:
    """Weights by measure and bin."""

    def __init__(self, edges: list[np.ndarray], w: np.ndarray, b: float):
        self.edges, self.w, self.b = edges, w, b

    def places(self, m: list[float]) -> np.ndarray:
        return np.array([i * (len(CUTS) + 1) + int(np.searchsorted(e, x, "right")) for i, (e, x) in enumerate(zip(self.edges, m))])

    def score(self, text: str | None) -> float:
        z = self.b + (float(self.w[self.places(measures(text))].sum()) if self.edges else 0.0)
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, z)))))


#: Shares of the trusted positives at which bins end: fine in the tails, beyond which texts are suspect.
CUTS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.25, 0.5, 0.75, 0.9, 0.97, 0.99, 0.997, 0.999)


def train(docs: DataFrame, labels: DataFrame, folds: Fold = FOLDS, id_col: str = "doc_id", text_col: str = "text",
          most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """Fit on bounded samples of the learning folds. Without positives every score is near 0."""
    rows, prior = sample(docs, labels, "quality", folds, id_col, text_col, most_positive, most_unlabelled)

    def shaped(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for positive, text in items:
            yield (positive, measures(text)), 120

    got = map_rows(rows, ["positive", "text"], shaped, pa.schema([("positive", pa.bool_()), ("m", pa.list_(pa.float64()))])).collect()
    sets = {flag: [m for x, m in got if x == flag] for flag in (True, False)}
    if not sets[True] or not sets[False]:
        return Model([], np.zeros(1), -60.0)
    model = Model([np.quantile(c, CUTS) for c in np.array(sets[True]).T], np.zeros(1), 0.0)
    size = len(model.edges) * (len(CUTS) + 1)
    model.w, model.b = fit([model.places(m) for m in sets[True]], [model.places(m) for m in sets[False]], size,
                           max(0.01, prior - PRIOR_MARGIN), steps=400, rate=0.05, ridge=1e-4, gamma=0.1)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: Fold = FOLDS) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null texts count as empty. A null id is not held out. Repeated rows come out as often as they
    go in; extra columns are ignored."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for key, text in items:
            yield (key, model.score(text)), 16

    typed = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    out = map_rows(docs, typed, run, pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))
    return out.select("doc_id", folds.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
