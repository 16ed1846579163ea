"""Exact search for the greatest inner products, by length and rotated partial sums.

Candidates are processed by descending length, in waves that grow by a factor: the first
holds the FIRST longest vectors and gives every query a threshold, the score it must reach
to matter; each wave raises the thresholds for the next. No candidate shorter than
threshold / length of the query can reach it. Of the others, vectors are rotated onto the
principal axes of a sample (SVD), which moves most of their length into the leading
components: the inner product of the leading parts plus the product of the lengths of the
rests bounds the whole one (Cauchy-Schwarz). Only what passes all bounds is multiplied out,
in whole numbers. Bounds are kept in 32-bit floats with a margin above their rounding error,
so nothing is lost; the sample decides speed and never results.

Queries go through in blocks of BLOCK_BYTES, each broadcast with its thresholds and held
against all candidates where those lie. A task returns k + 1 rows a query at most, fewer
where thresholds prune. Equal vectors have equal scores: of each, the k + 1 rows with the
least ids can be in an answer, so a vector that a third of all rows share is compared k + 1
times, and equal queries are answered once.

Results for odd input: vectors that are null or hold null or non-finite components take no
part; shorter vectors are filled up with zeros, and an empty one scores 0; rows that repeat
id and vector are one row; a query is no candidate for itself, but another vector under its
id is; a row without id is no query and is listed last among ties; scores beyond 64 bits
stop at the greatest or least 64-bit number; other columns are not looked at; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.components import written
from tidemart.llm.vectors import extent, integers, smallest_type, usable_vectors
from tidemart.session import work_dir

FIRST, GROWTH = 4096, 8
BLOCK_BYTES = 32 << 20
SAMPLE = 8192
TASK_ROWS = 1 << 16
# Candidates and queries that are compared at once, and pairs that are multiplied at once.
CHUNK, LANE, PAIRS = 4096, 1024, 1 << 16
# Leading parts of the rotated vectors, and the share of pairs above which a whole tile is
# cheaper than its pairs one by one.
PARTS = (0.25, 0.5, 0.75)
DENSE = 0.02
_NONE = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


# Inside tasks ----------------------------------------------------------------------------


def _packed(dims: int, factor: float, kind: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch.column("vector"), factor, dims)
            codes = [row.tobytes() for row in whole.astype(kind)]
            length = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
            columns = [batch.column("vec_id"), pa.array(codes, pa.binary()), pa.array(length)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "code", "length"])

    return run


def unpacked(codes: list[bytes], dims: int, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(codes), dtype=kind).reshape(len(codes), dims).astype(np.int64)


class Rotated:
    """Vectors of length one on the principal axes, with the lengths of their rests."""

    def __init__(self, whole: np.ndarray, axes: np.ndarray, cuts: list[int]) -> None:
        real = whole.astype(np.float64)
        self.length = np.sqrt((real**2).sum(axis=1))
        unit = (real / np.where(self.length > 0, self.length, 1)[:, None]) @ axes
        self.unit = unit.astype(np.float32)
        self.rest = {c: np.sqrt((unit[:, c:] ** 2).sum(axis=1)).astype(np.float32) for c in cuts}


def products(left: np.ndarray, right: np.ndarray, top: float) -> np.ndarray:
    """Inner products of all rows, exact; `top` is the product of the greatest lengths."""
    if top < 2.0**52:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if top < 2.0**62:
        return left @ right.T
    return np.clip(left.astype(object) @ right.astype(object).T, _LEAST, _NONE).astype(np.int64)


def pair_products(left: np.ndarray, right: np.ndarray, top: float) -> np.ndarray:
    """Inner products of the rows side by side."""
    if top < 2.0**62:
        return np.einsum("ij,ij->i", left, right)
    return np.clip((left.astype(object) * right.astype(object)).sum(axis=1), _LEAST, _NONE).astype(np.int64)


class Search:
    """One block of queries against candidates as they come."""

    def __init__(self, queries: np.ndarray, thresholds: np.ndarray, axes: np.ndarray, keep: int) -> None:
        dims = queries.shape[1]
        self.keep, self.axes = keep, axes
        self.cuts = sorted({c for share in PARTS if 0 < (c := int(dims * share)) < dims})
        self.margin = (dims + 8) * 2.0**-22
        self.queries, self.turned = queries, Rotated(queries, axes, self.cuts)
        self.least = thresholds.copy()
        self.found = [np.zeros((0, 4), dtype=np.int64) for _ in range(0, len(queries), LANE)]

    def offer(self, whole: np.ndarray, ids: np.ndarray) -> None:
        turned = Rotated(whole, self.axes, self.cuts)
        for lane, low in enumerate(range(0, len(self.queries), LANE)):
            self._lane(lane, np.arange(low, min(low + LANE, len(self.queries))), whole, ids, turned)

    def _lane(self, lane: int, rows: np.ndarray, whole: np.ndarray, ids: np.ndarray, turned: Rotated) -> None:
        longest = turned.length.max(initial=0)
        reach = self.turned.length[rows] * longest * (1 + self.margin)
        rows = rows[reach >= self.least[rows]]
        if not len(rows):
            return
        top = float(self.turned.length[rows].max() * longest)
        open_ = np.ones((len(rows), len(whole)), dtype=bool)
        if (self.least[rows] > _LEAST).any():
            open_ = self._bounded(rows, turned)
        share = open_.mean() if open_.size else 0.0
        if share > DENSE:
            scores = products(self.queries[rows], whole, top)
            least = self.least[rows]
            if scores.shape[1] > self.keep:
                place = scores.shape[1] - self.keep
                least = np.maximum(least, np.partition(scores, place, axis=1)[:, place])
            q, c = np.nonzero(scores >= least[:, None])
            values = scores[q, c]
        else:
            q, c = np.nonzero(open_)
            parts = [
                pair_products(self.queries[rows[q[k : k + PAIRS]]], whole[c[k : k + PAIRS]], top)
                for k in range(0, len(q), PAIRS)
            ]
            values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
            good = values >= self.least[rows[q]]
            q, c, values = q[good], c[good], values[good]
        if len(q):
            same = (self.queries[rows[q]] == whole[c]).all(axis=1)
            self._merge(lane, np.stack([rows[q], values, ids[c], same.astype(np.int64)], axis=1))

    def _bounded(self, rows: np.ndarray, turned: Rotated) -> np.ndarray:
        """Pairs whose bound reaches the query's threshold, by longer and longer leading parts."""
        own = self.turned.length[rows]
        need = (self.least[rows] / np.where(own > 0, own, 1)).astype(np.float64)
        sums = np.zeros((len(rows), len(turned.length)), dtype=np.float32)
        passed = np.ones(sums.shape, dtype=bool)
        done = 0
        for cut in self.cuts:
            sums += self.turned.unit[rows, done:cut] @ turned.unit[:, done:cut].T
            bound = sums + self.turned.rest[cut][rows, None] * turned.rest[cut] + np.float32(self.margin)
            passed = bound * turned.length >= need[:, None]
            done = cut
            if passed.mean() <= DENSE:
                break
        return passed

    def _merge(self, lane: int, fresh: np.ndarray) -> None:
        both = np.concatenate([self.found[lane], fresh])
        # By query, then score from the greatest, then id. ~x reverses whole numbers of any size.
        both = both[np.lexsort((both[:, 2], ~both[:, 1], both[:, 0]))]
        place = np.arange(len(both)) - np.searchsorted(both[:, 0], both[:, 0])
        both = both[place < self.keep]
        last = place[place < self.keep] == self.keep - 1
        self.least[both[last, 0]] = np.maximum(self.least[both[last, 0]], both[last, 1])
        self.found[lane] = both


def _searched(shared, dims: int, kind: np.dtype, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, least, axes = shared.value
        search = Search(unpacked(codes, dims, kind), least, axes, keep)
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                part = batch.slice(low, CHUNK)
                ids = part.column("vec_id").fill_null(_NONE).to_numpy()
                search.offer(unpacked(part.column("code").to_pylist(), dims, kind), ids)
        for found in search.found:
            columns = [pa.array(found[:, k]) for k in range(3)]
            same = pa.array(found[:, 3].astype(bool))
            yield pa.RecordBatch.from_arrays([*columns, same], names=["place", "score", "vec_id", "same"])

    return run


# The operator ----------------------------------------------------------------------------


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Directions of the sample from the one with most of its length to the least."""
    real = sample.astype(np.float64)
    real /= np.maximum(np.sqrt((real**2).sum(axis=1)), 1)[:, None]
    return np.linalg.svd(real.T @ real)[0]


def _waves(candidates: DataFrame, n: int) -> Column:
    """The wave of a candidate by its `size`."""
    shares, reached = [], FIRST
    while reached < n:
        shares.append(1 - reached / n)
        reached += FIRST * GROWTH ** len(shares)
    if not shares:
        return F.lit(0)
    bounds = candidates.agg(F.percentile_approx("size", shares, 10_000)).first()[0]
    return sum((F.when(F.col("size") < b, 1).otherwise(0) for b in bounds), F.lit(0))


def _best(rows: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    factor: float = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k greatest inner products of every query row
    with all other rows, in the whole numbers floor(factor * x); ties to the smaller id.

    `is_query` is a condition on the column `vec_id`, the id as a number.
    """
    spark = vectors.sparkSession
    root = work_dir(spark, "innerproduct")
    keep = k + 1
    usable = usable_vectors(vectors, F.col(f"`{vector_col}`"), F.col(f"`{id_col}`").cast("bigint").alias("vec_id"))
    dims, top = extent(usable)
    if dims < 0:
        shape = "query_id bigint, rank int, vec_id bigint, score bigint"
        return spark.createDataFrame([], shape)
    kind = smallest_type(top * factor)
    whole = usable.mapInArrow(_packed(dims, factor, kind), "vec_id bigint, code binary, length double")
    rows = written(whole.dropDuplicates(["vec_id", "code"]), f"{root}/rows")

    # Candidates, longest first; lengths that are equal are told apart by a hash.
    place = Window.partitionBy("code").orderBy(F.asc_nulls_last("vec_id"))
    few = rows.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= keep).drop("_n")
    jitter = F.pmod(F.xxhash64("code", "vec_id"), F.lit(1 << 20)) * F.lit(2.0**-60)
    few = written(few.withColumn("size", F.col("length") * (1 - jitter)), f"{root}/few")
    n = few.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    dealt = few.withColumn("wave", _waves(few, n)).repartitionByRange(parts, F.desc("size"), "code")
    dealt.sortWithinPartitions("wave", F.desc("size")).select("vec_id", "code", "wave").write.partitionBy(
        "wave"
    ).parquet(f"{root}/candidates")
    candidates = spark.read.schema("vec_id bigint, code binary, wave int").parquet(f"{root}/candidates")
    waves = sorted(r["wave"] for r in candidates.select("wave").distinct().collect())
    sample = few.orderBy(F.xxhash64("code"), "code").limit(SAMPLE).select("code").collect()
    axes = principal_axes(unpacked([bytes(r["code"]) for r in sample], dims, kind))

    # Different queries in blocks of bounded size.
    asked = rows.where(is_query & F.col("vec_id").isNotNull()).select("vec_id", "code")
    different = written(asked.select("code").distinct(), f"{root}/different")
    blocks = -(-different.count() // max(1, BLOCK_BYTES // (8 * max(dims, 1))))
    block = F.pmod(F.xxhash64("code"), F.lit(max(blocks, 1))).cast("int")
    order = Window.partitionBy("block").orderBy("code")
    numbered = different.withColumn("block", block).withColumn("place", F.row_number().over(order).cast("bigint") - 1)
    numbered = written(numbered, f"{root}/numbered")
    shape = "place bigint, score bigint, vec_id bigint, same boolean"
    for b in range(blocks):
        held = numbered.where(F.col("block") == b).orderBy("place").select("code").collect()
        codes = [bytes(r["code"]) for r in held]
        least = np.full(len(codes), _LEAST, dtype=np.int64)
        best = spark.createDataFrame([], shape)
        for wave in waves:
            shared = spark.sparkContext.broadcast((codes, least, axes))
            fresh = candidates.where(F.col("wave") == wave).select("vec_id", "code")
            fresh = fresh.mapInArrow(_searched(shared, dims, kind, keep), shape)
            path = f"{root}/best/wave={wave}/block={b}"
            best = written(_best(best.unionByName(fresh), keep), path)
            for r in best.where(F.col("rank") == keep).select("place", "score").collect():
                least[r["place"]] = r["score"]
            best = best.drop("rank")
            shared.unpersist()

    # Every query row takes the answers of its vector, without itself.
    if not blocks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    last = spark.read.schema(f"{shape}, rank int, block int").parquet(f"{root}/best/wave={waves[-1]}")
    answers = last.groupBy("block", "place").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score", "same"))).alias("found")
    )
    by_code = answers.join(numbered, ["block", "place"]).select("code", "found")
    told = asked.join(by_code, "code").select(F.col("vec_id").alias("query_id"), "found")
    others = F.filter("found", lambda x: ~(x["same"] & (x["vec_id"] == F.col("query_id"))))
    each = told.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "hit"))
    vec_id = F.when(F.col("hit.vec_id") != _NONE, F.col("hit.vec_id"))
    return each.select("query_id", (F.col("rank") + 1).alias("rank"), vec_id.alias("vec_id"), "hit.score")
