"""Toxicity by multiple-instance learning: sentences combined by noisy-or, trained on documents."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import no_columns_missing, plain_words, share

# The model is fitted on at most this many labelled rows, those with the smallest key hashes.
SAMPLE_ROWS = 6_000
MOST_FEATURES = 4_096
LEAST_DOCUMENTS = 3
STEPS, RATE, DECAY = 250, 0.1, 5e-5
THRESHOLD = 0.7
# A sentence offends when it is at least as likely toxic as not.
SENTENCE_THRESHOLD = 0.5
# A word stands for itself and its beginnings, so unseen endings of a known stem count.
STEMS = (4, 5, 6)
_ENDS = re.compile(r"[.!?\n]+")


def held_out(key: Column) -> Column:
    return (F.crc32(key.cast("string").cast("binary")) % 3 == 1).alias("held_out")


def features_of(word: bytes) -> list[bytes]:
    return [word, *[word[:n] + b"*" for n in STEMS if len(word) > n]]


def sentences(text: str | None) -> list[tuple[int, int, list[bytes]]]:
    """Start and end (in characters, without its end mark) and words of every sentence that has words."""
    found, start = [], 0
    for end in _ENDS.finditer(text or ""):
        found.append((start, end.start(), plain_words(text[start : end.start()])))
        start = end.end()
    found.append((start, len(text or ""), plain_words((text or "")[start:])))
    return [(at, end, words) for at, end, words in found if words]


@dataclass
class Model:
    """Weights of features in the log-odds of a sentence, and the log-odds without any."""

    weights: dict[bytes, float]
    bias: float


class WordWeights(dict):
    """Summed weights of a word's features, remembered per task up to a bound."""

    MOST = 500_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.MOST:
            self.clear()
        get = self.model.weights.get
        value = self[word] = sum(get(f, 0.0) for f in features_of(word))
        return value


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Maximises the likelihood of document labels: 1 - P = product of (1 - p) over sentences."""
    toxic = toxic.astype(float)
    if not 0 < toxic.sum() < len(toxic):
        return Model({}, -20.0 if not toxic.sum() else 20.0)
    # Words are shared objects, and features are only counted: memory follows the vocabulary.
    shared: dict[bytes, bytes] = {}
    bags = [[[shared.setdefault(w, w) for w in words] for *_, words in sentences(text)] for text in texts]
    inside, hit = Counter(), Counter()
    for bag, label in zip(bags, toxic):
        present = {f for word in {w for words in bag for w in words} for f in features_of(word)}
        inside.update(present)
        if label:
            hit.update(present)
    chosen = []
    total, positive = len(toxic), toxic.sum()
    for feature, docs in inside.items():
        if docs < LEAST_DOCUMENTS:
            continue
        hits = hit[feature]
        odds = np.log((hits + 0.5) / (positive + 1)) - np.log((docs - hits + 0.5) / (total - positive + 1))
        spread = np.sqrt(1 / (hits + 0.5) + 1 / (docs - hits + 0.5))
        chosen.append((abs(odds) / spread, feature))
    del inside, hit
    names = [f for _, f in sorted(chosen, reverse=True)[:MOST_FEATURES]]
    number = {f: i for i, f in enumerate(names)}
    rows, cols, owner = [], [], []
    for d, bag in enumerate(bags):
        for words in bag:
            found = {number[f] for w in words for f in features_of(w) if f in number}
            rows.extend([len(owner)] * len(found))
            cols.extend(found)
            owner.append(d)
    rows_, cols_, owner_ = np.array(rows, int), np.array(cols, int), np.array(owner, int)
    weights, bias = np.zeros(len(names)), -4.0
    moments = [np.zeros(len(names) + 1), np.zeros(len(names) + 1)]
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(rows_, weights[cols_], len(owner_))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(owner_, np.log1p(-np.minimum(p, 1 - 1e-12)), total))
        dirty = np.maximum(1 - clean, 1e-9)
        pull = np.where(toxic == 1, -clean / dirty, 1.0)
        slope = p * pull[owner_]
        gradient = np.append(np.bincount(cols_, slope[rows_], len(names)), slope.sum()) / total
        gradient[:-1] += DECAY * weights
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights -= change[:-1]
        bias -= change[-1]
    kept = np.abs(weights) > 1e-3
    return Model({f: float(w) for f, w, k in zip(names, weights, kept) if k}, float(bias))


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fits on a bounded sample of labelled rows outside the held-out part.

    Labels that contradict each other, or are null, are left out.
    """
    known = (
        no_columns_missing(labels, doc_id="long", toxic="int")
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .filter("toxic = _most")
        .drop("_most")
        .filter(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Both sides of the join are bounded by ``rows``: the labels are broadcast, the texts found
    # are the sample the model is fitted on.
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    found = sample.orderBy("doc_id").select("text", "toxic").toPandas()
    return fit(found["text"].tolist(), found["toxic"].to_numpy())


_OFFENDING = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
)


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = pickle.loads(shared.value)
        weight = WordWeights(model).__getitem__
        for batch in batches:
            scores, counts, starts, worst, offending = [], [], [], [], []
            for text in batch.column("text"):
                found = sentences(text.as_py())
                z = np.array([sum(map(weight, words)) for *_, words in found]) + model.bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                scores.append(float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())))
                counts.append(len(found))
                top = int(p.argmax()) if len(p) else None
                starts.append(None if top is None else found[top][0])
                worst.append(None if top is None else float(p[top]))
                offending.append(
                    [(*found[i][:2], float(p[i])) for i in np.flatnonzero(p >= SENTENCE_THRESHOLD)]
                )
            names = [n for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array(counts, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(worst, pa.float64()),
                    pa.array(offending, _OFFENDING),
                ],
                [*names, "score", "n_sentences", "worst_start", "worst_score", "offending"],
            )

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row with ``score``, ``predicted`` and the offending sentences.

    A sentence's log-odds are the bias plus the weights of its words; the document's score is the
    noisy-or of its sentences. ``offending`` lists every sentence whose probability reaches
    ``SENTENCE_THRESHOLD``, in order, as ``start``, ``end`` (in characters, the end mark left out)
    and ``probability``; it is empty where no sentence does. ``worst_start`` and ``worst_score``
    give the most toxic sentence of any text, offending or not; both are null for null, empty and
    wordless texts, whose score is 0. Rows are
    scored one by one, whatever else repeats; other columns stay. The model has at most
    ``MOST_FEATURES`` weights and is broadcast.
    """
    kept = docs.drop("score", "n_sentences", "worst_start", "worst_score", "offending", "predicted")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    shared = share(docs.sparkSession, model)
    scored = kept.mapInArrow(
        _scorer(shared),
        f"{schema}, score double, n_sentences long, worst_start long, worst_score double, "
        "offending array<struct<start: long, end: long, probability: double>>",
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
