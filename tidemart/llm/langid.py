"""Language of whole texts: a sparse multinomial logistic regression on TF-IDF weights of
character n-grams, trained by follow-the-regularised-leader with an elastic net, its
probabilities calibrated by a temperature.

N-grams of one to three letters (other characters count as a space) are hashed into
BUCKETS features. Document frequencies cover all training documents. The weights are
fitted on a bounded sample, SAMPLE rows spread evenly over the languages; a fifth of it
only fits the temperature.

Results for odd input: a text that is null or has no letter is `und` with score 0; rows
without language or id are never learned from; with nothing to learn from every text is
`und`; repeated rows count as they stand; an empty table gives an empty result. Only the
text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemart.llm.rows import may_train

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE = 4000
EPOCHS = 3
UNKNOWN = "und"
PIECE_CHARS = 1 << 18

# The learner's rates and penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_PREDICTED = (T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()))
_SPACE = 32
_PLANE = np.array([chr(c).isalpha() for c in range(1 << 16)])


def _letters(text: str) -> np.ndarray:
    """Code points in lower case, with a space for whatever is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _PLANE[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        letter[far] = [chr(c).isalpha() for c in points[far]]
    return np.where(letter, points, _SPACE)


def counts(text: str) -> tuple[np.ndarray, bool]:
    """(how often each bucket's n-grams occur, whether there is a letter at all)."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    any_letter, longest = False, max(ORDERS)
    for at in range(0, len(text), PIECE_CHARS):
        # The next characters complete the n-grams that begin in this piece.
        points = _letters(text[at : at + PIECE_CHARS + longest - 1])
        own = min(PIECE_CHARS, len(points))
        any_letter = any_letter or bool((points[:own] != _SPACE).any())
        h = np.zeros(len(points), dtype=np.uint32)
        for order in range(1, longest + 1):
            h = (h[: len(points) - order + 1] * np.uint32(0x01000193)) ^ points[order - 1 :]
            h = h * np.uint32(0x9E3779B1)
            if order in ORDERS and len(h):
                out += np.bincount((h[:own] >> np.uint32(18)).astype(np.int64), minlength=BUCKETS)
    return out, any_letter


@dataclass(frozen=True)
class LanguageModel:
    """`weights`: a row per bucket and one for the bias, a column per language."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        seen, letters = counts(text)
        if not letters:
            return UNKNOWN, 0.0
        at, values = weighted(seen, self.idf)
        p = softmax((values @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def weighted(seen: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur and their TF-IDF weights, of length 1 together."""
    at = np.flatnonzero(seen)
    values = (1 + np.log(seen[at])) * idf[at]
    norm = np.sqrt((values**2).sum())
    return at, values / norm if norm > 0 else values


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal over (features, weights, class) in the order given."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def current(at: np.ndarray) -> np.ndarray:
        over = np.maximum(np.abs(z[at]) - L1, 0) * np.sign(z[at])
        return -over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for at, values, label in rows:
            at, values = np.append(at, BUCKETS), np.append(values, 1.0)
            w = current(at)
            p = softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    return current(np.arange(BUCKETS + 1))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section between 1/50 and 20."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text in batch.column("text"):
            seen += counts(text.as_py() or "")[0] > 0
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ats, values = [], []
        for text in batch.column("text"):
            seen = counts(text.as_py() or "")[0]
            at = np.flatnonzero(seen)
            ats.append(at.astype(np.uint16).tobytes())
            values.append(seen[at].astype(np.uint32).tobytes())
        columns = [batch.column("lang"), batch.column("place"), pa.array(ats, pa.binary()), pa.array(values, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "place", "at", "seen"])


def sample_rows(docs: DataFrame, sizes: dict[str, int], per_language: int) -> DataFrame:
    """At most `per_language` rows of each language, those with the least hash of id and
    text. Most rows go by a threshold before any are ranked."""
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, 2.0 * per_language / v + 50.0 / v))])
    place = F.xxhash64("doc_id", F.xxhash64("text"))
    unit = (F.shiftrightunsigned(place, 11) / F.lit(float(1 << 53)))
    near = docs.withColumn("place", place).where(unit < share[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    return near.withColumn("_k", rank).where(F.col("_k") <= per_language).drop("_k")


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> LanguageModel:
    """Learn from the documents that `may_train`; `sample` bounds what the driver holds:
    a vector of at most BUCKETS counts per sampled row."""
    known = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    ).where(may_train(F.col(id_col)) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.ones(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0)
    total = sum(sizes.values())
    seen = known.select("text").mapInArrow(_document_frequencies, "bucket bigint, n bigint")
    idf = np.full(BUCKETS, np.log(1.0 + total) + 1)
    for r in seen.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():  # BUCKETS rows at most
        idf[r["bucket"]] = np.log((1.0 + total) / (1.0 + r["n"])) + 1
    per_language = max(20, sample // len(languages))
    chosen = sample_rows(known, sizes, per_language)
    vectors = chosen.select("lang", "place", "text").mapInArrow(
        _vectors, "lang string, place bigint, at binary, seen binary"
    )
    rows = []
    for r in sorted(vectors.toLocalIterator(), key=lambda r: (r["place"], r["lang"], bytes(r["at"]))):
        at = np.frombuffer(r["at"], dtype=np.uint16).astype(np.int64)
        values = (1 + np.log(np.frombuffer(r["seen"], dtype=np.uint32))) * idf[at]
        norm = np.sqrt((values**2).sum())
        rows.append((at, values / norm if norm > 0 else values, languages.index(r["lang"])))
    weights = fit([r for k, r in enumerate(rows) if k % 5], len(languages))
    apart = rows[::5]
    scores = np.array([values @ weights[at] + weights[-1] for at, values, _ in apart]).reshape(-1, len(languages))
    temperature = fit_temperature(scores, np.array([label for _, _, label in apart]))
    return LanguageModel(languages, idf, weights, temperature)


def predict(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(row, text) of `packed`, with lang_pred and score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(text.as_py()) for text in batch.column("text")]
            columns = [
                *batch.columns,
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*rows.schema.fields, *_PREDICTED])
    return rows.mapInArrow(run, schema)
