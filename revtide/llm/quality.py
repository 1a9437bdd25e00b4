"""Quality by logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

A text's features are its words and neighbouring pairs of words (words of letters and digits, runs
of other marks; case counts), hashed into ``SPACE`` places, with 1 + ln(tf), scaled to length 1. The
model is fitted by follow-the-regularised-leader with one learning rate per place; its L1 term
keeps the weights sparse. Scoring is a sparse dot product over the whole text.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled ids for each value of the label,
those of least hash, and one text for each of them. The sample's features are stored once; every
epoch streams them in hash order through one task that holds nothing but the two state arrays. The
share of the labels among all labelled ids then moves the bias, so that 0.5 means even odds.

Cases: NULL and empty texts have no features and get the bias. An id that has several texts trains
with that of least hash; several labels of one id all count. NULL labels and NULL ids train nothing. Without
labels of both kinds every score is the smoothed share of the label. NULL ``doc_id`` is never held
out. Repeated rows are scored like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import slices, written

#: Labelled ids for each value of the label that the model is fitted on.
SAMPLE = 4000
SPACE = 1 << 20
EPOCHS = 3
#: FTRL-proximal: learning rate and its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.5
#: Words that one Python worker remembers, and the longest of them.
CACHE, CACHE_CHARS = 200_000, 32

WORD = re.compile(r"\w+|[^\w\s]+")
FEATURES = "_order long, _id long, label double, places binary, amounts binary"
STATE = "z binary, n binary"
SCORES = "doc_id long, held_out boolean, score double, predicted int"


class Hashes(dict):
    """Word -> its hash; long words are not remembered, so the memory is bounded in bytes."""

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.encode())
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value


def text_features(hashes: Hashes, text: str | None):
    """(places ascending, amounts) of one whole text."""
    import numpy as np

    words = np.array([hashes[w] for w in WORD.findall(text or "")], np.uint64)
    pairs = (words[:-1] * np.uint64(0x9E3779B1) + words[1:] + np.uint64(1)) * np.uint64(0x85EBCA6B)
    both = np.concatenate([words * np.uint64(0xC2B2AE35), pairs]) & np.uint64(0xFFFFFFFF)
    places, times = np.unique((both >> np.uint64(12)).astype(np.int32), return_counts=True)
    amounts = 1 + np.log(times)
    return places, (amounts / (np.linalg.norm(amounts) or 1.0)).astype(np.float32)


@dataclass
class Model:
    places: object
    weights: object
    bias: float

    def dense(self):
        import numpy as np

        table = np.zeros(SPACE, np.float64)
        table[self.places] = self.weights
        return table


def _weights(z, n):
    """The regularised leader's weights for sums ``z`` and squared sums ``n``."""
    import numpy as np

    pull = np.maximum(np.abs(z) - L1, 0.0)
    return -np.sign(z) * pull / ((BETA + np.sqrt(n)) / ALPHA + L2)


def learn(z, n, places, amounts, label: float) -> None:
    """One FTRL-proximal step in place; the last place of the state is the bias."""
    import numpy as np

    at = np.append(places, SPACE)
    x = np.append(amounts, np.float32(1.0)).astype(np.float64)
    own_z, own_n = z[at].astype(np.float64), n[at].astype(np.float64)
    w = _weights(own_z, own_n)
    p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ x)))))
    g = (p - label) * x
    grown = own_n + g * g
    z[at] = own_z + g - (np.sqrt(grown) - np.sqrt(own_n)) / ALPHA * w
    n[at] = grown


def is_held_out(doc_id: Column) -> Column:
    """Ids whose crc32 as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Features of the chosen labelled documents, stored; one row for each label of an id."""
    order = F.xxhash64("_id", F.lit(29))
    known = labels.withColumn("_order", order)
    chosen = [known.filter(F.col("label") == v).orderBy("_order", "_id").limit(sample) for v in (0.0, 1.0)]
    texts = docs.filter(~is_held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")
    )
    # At most twice ``sample`` labels go to every task.
    rows = texts.join(F.broadcast(chosen[0].unionAll(chosen[1])), "_id")

    def compute(batches):
        import pyarrow as pa

        hashes = Hashes()
        for batch in slices(batches):
            found = [text_features(hashes, t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array([p.tobytes() for p, _ in found], pa.binary()),
                    pa.array([a.tobytes() for _, a in found], pa.binary()),
                ],
                names=["_order", "_id", "label", "places", "amounts"],
            )

    features = rows.select("_order", "_id", "label", "text").mapInArrow(compute, FEATURES)
    one = features.groupBy("_order", "_id", "label").agg(
        F.min_by(F.struct("places", "amounts"), F.xxhash64("places", "amounts")).alias("_f")
    )
    return written(one.select("_order", "_id", "label", "_f.*"), "quality")


def _kinds(rows: DataFrame):
    return rows.agg(F.count_if(F.col("label") == 0.0).alias("bad"), F.count_if(F.col("label") == 1.0).alias("good")).first()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> Model:
    """Fit on the labelled documents that are not held out.

    ``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id`` and ``label``, 0, 1 or NULL.
    """
    import numpy as np

    own = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("label").cast("double").alias("label")
    )
    counts = _kinds(own)
    shares = math.log((counts.good + 1) / (counts.bad + 1))
    nothing = Model(np.zeros(0, np.int32), np.zeros(0), shares)
    if not counts.good or not counts.bad:
        return nothing
    rows = _sample(docs, own, sample)
    taken = _kinds(rows)
    if not taken.good or not taken.bad:
        return nothing
    context = docs.sparkSession.sparkContext
    z, n = np.zeros(SPACE + 1, np.float32), np.zeros(SPACE + 1, np.float32)
    for _ in range(epochs):
        state = context.broadcast((z.tobytes(), n.tobytes()))

        def epoch(batches, state=state):
            import pyarrow as pa

            z, n = (np.frombuffer(b, np.float32).copy() for b in state.value)
            for batch in slices(batches, 64):
                for label, places, amounts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    learn(z, n, np.frombuffer(places, np.int32), np.frombuffer(amounts, np.float32), label)
            yield pa.RecordBatch.from_pydict({"z": [z.tobytes()], "n": [n.tobytes()]})

        ordered = rows.repartition(1).sortWithinPartitions("_order", "_id", "label").select("label", "places", "amounts")
        last = ordered.mapInArrow(epoch, STATE).filter(F.octet_length("z") > 0).first()
        z, n = (np.frombuffer(bytes(b), np.float32) for b in (last.z, last.n))
        state.destroy()
    weights = _weights(z.astype(np.float64), n.astype(np.float64))
    places = np.flatnonzero(weights[:SPACE]).astype(np.int32)
    sampled = math.log((taken.good + 1) / (taken.bad + 1))
    return Model(places, weights[places], float(weights[SPACE]) + shares - sampled)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id``, ``text``)."""
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )

    def compute(batches):
        import pyarrow as pa

        weights, bias, hashes = shared.value.dense(), shared.value.bias, Hashes()
        for batch in slices(batches):
            odds = []
            for text in batch.column(2).to_pylist():
                places, amounts = text_features(hashes, text)
                odds.append(bias + float(weights[places] @ amounts.astype(np.float64)))
            scores = 1 / (1 + np.exp(-np.clip(np.array(odds), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(compute, SCORES)
