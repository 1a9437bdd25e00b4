"""Toxicity by a classifier chain of linear models.

The categories are predicted in a fixed order. Each model is a logistic regression over the
presence of words and word beginnings, and over the log odds of every earlier category. While it
is trained those odds come from models that had not seen the row (out-of-fold predictions), so a
later model meets odds as good as those it gets when scoring. The rejection threshold is chosen on
out-of-fold predictions of the last category as well.

The chain is fitted on a bounded sample of the labelled rows: at most ``SAMPLE`` for each value of
the last category, those of least hash. Scoring reads every text whole, in Arrow batches.

Cases: NULL and empty texts have no features and get the models' base rates. A NULL label leaves
the row out of that category's training. Without labels of both kinds a category's model is its
base rate (0 without labels), and then nothing is rejected. NULL ``doc_id`` and repeated rows are
scored like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import slices

#: Labelled rows for each value of the last category that the chain is fitted on.
SAMPLE = 4000
FOLDS = 3
#: Features that a model keeps at most: those whose share among the category's rows differs from that
#: among the others by the most standard errors, and by ``ERRORS`` at least.
SELECTED = 512
ERRORS = 6.0
SPACE = 1 << 20
PREFIXES = (3, 4, 5)
STEPS = 300
#: Out-of-fold precision that a threshold must have.
PRECISION = 0.95
RIDGE = 1e-3
#: Distinct words that one Python worker remembers.
CACHE = 100_000

_EDGES = ".,;:!?\"'()[]{}|*#$%&_-"


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of one word: the word and its beginnings."""
    word = word.lower().strip(_EDGES)
    if not word:
        return ()
    names = [f"w{word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) > n)]
    return tuple(zlib.crc32(n.encode()) % SPACE for n in names)


def text_features(text: str) -> set[int]:
    found: set[int] = set()
    for word in set(text.split()):
        found.update(word_features(word))
    return found


@dataclass
class Linear:
    """A logistic regression over selected features and earlier categories' log odds."""

    features: dict[int, float] = field(default_factory=dict)
    odds: list[float] = field(default_factory=list)
    bias: float = -30.0


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]
    threshold: float


def _largest_square(x) -> float:
    """The square of the largest singular value of ``x`` or a little more, by power iteration."""
    import numpy as np

    v = np.ones(x.shape[1], np.float32)
    for _ in range(30):
        v = x.T @ (x @ (v / np.linalg.norm(v)))
    return 1.1 * float(np.linalg.norm(v))


def _fit(rows: list, labels, odds) -> Linear:
    """One model; ``rows`` are arrays of features, ``odds`` the earlier categories' columns."""
    import numpy as np

    known = np.flatnonzero(~np.isnan(labels))
    y = labels[known]
    if not len(y):
        return Linear(odds=[0.0] * odds.shape[1])
    rate = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    if y.min() == y.max():
        return Linear(odds=[0.0] * odds.shape[1], bias=float(np.log(rate / (1 - rate))) * 2)
    own = [rows[i] for i in known]
    lengths = np.array([len(r) for r in own])
    flat = np.concatenate(own) if lengths.sum() else np.zeros(0, np.int64)
    line = np.repeat(np.arange(len(own)), lengths)
    with_it = np.bincount(flat, weights=y[line], minlength=SPACE)
    without = np.bincount(flat, weights=1 - y[line], minlength=SPACE)
    a, b = with_it / y.sum(), without / (1 - y).sum()
    mean = (with_it + without) / len(y)
    error = np.sqrt(np.maximum(mean * (1 - mean), 1.0 / len(y)) * (1 / y.sum() + 1 / (1 - y).sum()))
    score = np.abs(a - b) / error
    best = np.argsort(-score, kind="stable")[:SELECTED]
    best = best[score[best] >= ERRORS]
    column = np.full(SPACE, -1)
    column[best] = np.arange(len(best))
    x = np.zeros((len(own), len(best) + odds.shape[1] + 1), np.float32)
    used = column[flat] >= 0
    x[line[used], column[flat][used]] = 1.0
    x[:, len(best) : -1] = odds[known]
    x[:, -1] = 1.0
    weights, pull = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    rate_of_step = 4.0 * len(y) / _largest_square(x)
    ridge = np.full(x.shape[1], RIDGE, np.float32)
    ridge[-1] = 0.0
    for step in range(1, STEPS + 1):
        ahead = weights + (step - 1) / (step + 2) * pull
        error = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - y.astype(np.float32)
        moved = ahead - rate_of_step * (x.T @ error / len(y) + ridge * ahead)
        pull, weights = moved - weights, moved
    kept = {int(f): float(w) for f, w in zip(best, weights[: len(best)], strict=True) if w}
    return Linear(kept, [float(w) for w in weights[len(best) : -1]], float(weights[-1]))


def _log_odds(model: Linear, rows: list, odds):
    import numpy as np

    base = np.array([sum(model.features.get(f, 0.0) for f in r.tolist()) for r in rows])
    return np.clip(base + odds @ np.array(model.odds) + model.bias, -30, 30)


def _best_threshold(probabilities, labels) -> float:
    """The middle of the range of thresholds with the best F1 among those of ``PRECISION`` or more; over 1 if there is none."""
    import numpy as np

    known = ~np.isnan(labels)
    p, y = probabilities[known], labels[known]
    if not len(y) or y.min() == y.max():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    taken = np.arange(1, len(y) + 1)
    below = np.append(p[order][1:], 0.0)
    f1 = np.where((hits >= PRECISION * taken) & (p[order] > below), 2 * hits / (taken + y.sum()), 0.0)
    last = len(f1) - 1 - int(np.argmax(f1[::-1] >= f1.max() - 1e-12))
    return float((p[order][last] + below[last]) / 2) if f1[last] > 0 else 2.0


def fit_chain(rows: list, labels: dict, folds) -> Chain:
    """The chain over ``rows`` (arrays of features); ``labels`` maps categories in order to 0, 1 or NaN."""
    import numpy as np

    models, odds, threshold = [], np.zeros((len(rows), 0), np.float32), 2.0
    for values in labels.values():
        unseen = np.zeros(len(rows))
        for k in range(FOLDS):
            out = np.flatnonzero(folds == k)
            kept = np.flatnonzero(folds != k)
            part = _fit([rows[i] for i in kept], values[kept], odds[kept])
            unseen[out] = _log_odds(part, [rows[i] for i in out], odds[out])
        models.append(_fit(rows, values, odds))
        threshold = _best_threshold(1 / (1 + np.exp(-unseen)), values)
        odds = np.column_stack([odds, unseen]).astype(np.float32)
    return Chain(list(labels), models, threshold)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE) -> Chain:
    """Fit on at most ``sample`` labelled rows for each value of the last category.

    ``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id`` and a column of 0, 1 or NULL for
    each category. The chosen labels, at most twice ``sample`` rows, are broadcast to the documents.
    """
    import numpy as np

    last = categories[-1]
    order = F.xxhash64(F.col("doc_id").cast("long"), F.lit(17))
    known = labels.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"), *categories, order.alias("_order")
    )
    chosen = [known.filter(F.col(last) == value).orderBy("_order", "_id").limit(sample) for value in (0, 1)]
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    frame = rows.join(F.broadcast(chosen[0].unionAll(chosen[1])), "_id").toPandas()
    frame = frame.sort_values(["_order", "_id"], kind="stable").reset_index(drop=True)
    features = [np.fromiter(text_features(t or ""), np.int32) for t in frame.pop("text")]
    values = {c: frame[c].to_numpy(np.float64, na_value=np.nan) for c in categories}
    return fit_chain(features, values, frame["_order"].to_numpy(np.int64) % FOLDS)


class Hits(dict):
    """Word -> those of its features that some model selected."""

    def __init__(self, selected: set[int]):
        super().__init__()
        self.selected = selected

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = tuple(f for f in word_features(word) if f in self.selected)
        return value


def _probabilities(chain: Chain, hits: Hits, text: str | None) -> list[float]:
    import math

    found: set[int] = set()
    for own in filter(None, map(hits.__getitem__, set((text or "").split()))):
        found.update(own)
    odds: list[float] = []
    for model in chain.models:
        value = model.bias + sum(w * o for w, o in zip(model.odds, odds, strict=True))
        value += math.fsum(model.features.get(f, 0.0) for f in found)
        odds.append(max(-30.0, min(30.0, value)))
    return [1 / (1 + math.exp(-o)) for o in odds]


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id``, the probability ``p_<category>`` of each category and ``toxic`` (by the last), for every row."""
    names = [f"p_{c}" for c in chain.categories]
    schema = "doc_id long, " + "".join(f"{n} double, " for n in names) + "toxic boolean"

    def compute(batches):
        import pyarrow as pa

        hits = Hits(set().union(*(m.features for m in chain.models)))
        for batch in slices(batches):
            rows = [_probabilities(chain, hits, t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(names))]
            toxic = pa.array([r[-1] >= chain.threshold for r in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, toxic], names=["doc_id", *names, "toxic"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(compute, schema)


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` (all columns) that the chain does not reject; no row is shuffled."""
    place = docs.columns.index("text")

    def compute(batches):
        import pyarrow as pa

        hits = Hits(set().union(*(m.features for m in chain.models)))
        for batch in slices(batches):
            clean = [_probabilities(chain, hits, t)[-1] < chain.threshold for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(compute, docs.schema)


def table_categories(labels: DataFrame) -> DataFrame:
    """``doc_id, low_quality, toxic``: the two categories that the labels table knows, in the chain's order."""
    return labels.select(
        "doc_id",
        (1 - F.col("quality")).cast("double").alias("low_quality"),
        F.col("toxic").cast("double").alias("toxic"),
    )


CATEGORIES = ["low_quality", "toxic"]
