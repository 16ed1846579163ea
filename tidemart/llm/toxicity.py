"""Toxicity of whole texts, learned from confirmed toxic examples and unlabelled text by
the non-negative positive-unlabelled risk.

Features are the words of a text and its runs of GRAM bytes (letters in lower case, all
else a space), each present or not. Those that confirmed examples hold more often than
unlabelled text are chosen by their likelihood ratio, and a linear classifier over them
minimises

    prior * risk(positives as positive)
    + max(0, risk(unlabelled as negative) - prior * risk(positives as negative)),

with logistic losses; where the second part falls below zero its gradient is reversed,
which keeps a flexible classifier from calling every unlabelled text negative. The class
prior is the share of toxic rows among the labelled rows that may be learned from.

The classifier is fitted on bounded samples: POSITIVES and UNLABELLED rows, those with the
least hash of their id. Scores cover every text whole.

Results for odd input: a null or empty text has no feature and gets the score of the bias;
labels without id, toxic mark or document are not learned from, repeated ones count once;
with no confirmed example every score is 0; repeated rows are scored alike; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.rows import may_train
from tidemart.llm.words import LETTERS, LOWER, PIECE_BYTES, U64, mix, text_bytes, word_hashes

GRAM = 5
POSITIVES, UNLABELLED = 3000, 6000
FEATURES = 4000
# A feature must be in so many confirmed examples.
LEAST_SEEN = 5
# Steps, rate and penalty of the training.
STEPS, RATE, PENALTY = 400, 0.1, 1e-4

_MASK_BITS = 20
_FOLD = np.where(LETTERS, LOWER, 32).astype(np.uint8)


def _gram_pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the runs of GRAM bytes, piece by piece."""
    for at in range(0, max(len(text) - GRAM + 1, 0), PIECE_BYTES):
        folded = _FOLD[text[at : at + PIECE_BYTES + GRAM - 1]].astype(U64)
        h = np.zeros(len(folded) - GRAM + 1, dtype=U64)
        for k in range(GRAM):
            h = (h << U64(8)) | folded[k : len(folded) - GRAM + 1 + k]
        yield mix(h)


def features(text: np.ndarray | None) -> Iterator[np.ndarray]:
    """64-bit features of a text in some pieces, repeats included."""
    if text is None or not len(text):
        return
    yield word_hashes(text, LETTERS)[0] ^ U64(0x5BD1E995)
    yield from _gram_pieces(text)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the chosen features, sorted by feature."""

    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def mask(self) -> np.ndarray:
        """Which low bits a chosen feature has: most others are told apart by them."""
        mask = np.zeros(1 << _MASK_BITS, dtype=bool)
        mask[self.chosen & U64((1 << _MASK_BITS) - 1)] = True
        return mask

    def present(self, text: np.ndarray | None, mask: np.ndarray) -> np.ndarray:
        """The places of the chosen features that occur in a text."""
        if not len(self.chosen):
            return np.zeros(0, dtype=np.int64)
        found = np.zeros(len(self.chosen), dtype=bool)
        for h in features(text):
            near = h[mask[h & U64((1 << _MASK_BITS) - 1)]]
            at = np.minimum(np.searchsorted(self.chosen, near), len(self.chosen) - 1)
            found[at[self.chosen[at] == near]] = True
        return np.flatnonzero(found)

    def score(self, present: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[present].sum(), -40, 40))))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float) -> tuple[np.ndarray, float]:
    """(weights, bias) of least non-negative positive-unlabelled risk, by Adam."""
    rows = positive + unlabelled
    lengths = np.array([len(r) for r in rows])
    at = np.concatenate([*rows, np.zeros(0, dtype=np.int64)])
    row = np.repeat(np.arange(len(rows)), lengths)
    n_p, n_u = len(positive), len(unlabelled)
    is_p = np.arange(len(rows)) < n_p
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        f = np.bincount(row, weights=w[at], minlength=len(rows)) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        as_negative = np.logaddexp(0, f)
        rest = as_negative[~is_p].sum() / max(n_u, 1) - prior * as_negative[is_p].sum() / n_p
        # Derivatives by the row's value: of log(1 + e^-f) and of log(1 + e^f).
        g_rest = np.where(is_p, -prior * s / n_p, s / max(n_u, 1))
        g = np.where(is_p, prior * (s - 1) / n_p, 0.0) + g_rest if rest >= 0 else -g_rest
        grad = np.append(np.bincount(at, weights=g[row], minlength=size)[:size], g.sum())
        grad[:-1] += PENALTY * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _distinct_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic) once per text of the sample."""
    for batch in batches:
        marks = batch.column("toxic").to_pylist()
        for text, mark in zip(text_bytes(batch.column("text")), marks):
            found = np.unique(np.concatenate([*features(text), np.zeros(0, dtype=U64)]))
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(np.full(len(found), mark))], names=["feature", "toxic"]
                )


def _sampled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The sampled texts; at most POSITIVES + UNLABELLED ids are broadcast."""
    return docs.join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "text")


def train(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    n_features: int = FEATURES,
) -> ToxicityModel:
    """Learn from the rows that `may_train`. The driver holds a list of chosen features
    per sampled row, the tasks hold one text each."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(may_train(F.col("doc_id")))
    marked = labels.where(may_train(F.col("doc_id")) & F.col("toxic").isNotNull())
    share = marked.agg(F.avg(F.col("toxic").cast("double")).alias("p")).first()["p"]
    nothing = ToxicityModel(np.zeros(0, dtype=U64), np.zeros(0), -40.0)
    if not share:
        return nothing
    prior = min(float(share), 0.99)
    place = F.xxhash64("doc_id")
    toxic = marked.where("toxic = 1").select("doc_id").distinct().orderBy(place, "doc_id").limit(positives)
    others = texts.select("doc_id").distinct().orderBy(place, "doc_id").limit(unlabelled)
    # One text may be in both samples: unlabelled text holds positives too.
    ids = toxic.withColumn("toxic", F.lit(True)).unionByName(others.withColumn("toxic", F.lit(False)))
    rows = _sampled(texts, ids)
    seen = rows.mapInArrow(_distinct_features, "feature bigint, toxic boolean").groupBy("feature").agg(
        F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("u")
    )
    n_p, n_u = toxic.count(), others.count()
    p, u = (F.col("p") + 0.5) / (n_p + 1.0), (F.col("u") + 0.5) / (n_u + 1.0)
    ratio = F.col("p") * F.log(p / u) + (n_p - F.col("p")) * F.log((1 - p) / (1 - u))
    best = (
        seen.where((F.col("p") >= min(LEAST_SEEN, max(1, n_p // 20))) & (p > u))
        .orderBy(ratio.desc(), "feature")
        .limit(n_features)
        .select("feature")
    )
    chosen = np.sort(np.array([r["feature"] for r in best.toLocalIterator()], dtype=np.int64).view(U64))
    blank = ToxicityModel(chosen, np.zeros(len(chosen)), 0.0)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = blank.mask()
        for batch in batches:
            found = [blank.present(t, mask).astype(np.int32).tobytes() for t in text_bytes(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "at"])

    id_field = texts.schema["doc_id"]
    schema = T.StructType([id_field, T.StructField("toxic", T.BooleanType()), T.StructField("at", T.BinaryType())])
    held: tuple[list, list] = ([], [])
    for r in rows.mapInArrow(present, schema).orderBy("doc_id", "at").toLocalIterator():
        held[r["toxic"]].append(np.frombuffer(r["at"], dtype=np.int32).astype(np.int64))
    if not held[1]:
        return nothing
    weights, bias = fit(held[1], held[0], len(chosen), prior)
    return ToxicityModel(chosen, weights, bias)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        mask = known.mask()
        for batch in batches:
            scores = [known.score(known.present(t, mask)) for t in text_bytes(batch.column("text"))]
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))
