"""Fingerprints of documents as invertible Bloom lookup sketches of their paragraphs.

A paragraph is a line, cut further before words whose hash says so (every eighth on the
average), so that a long line has many and an edit changes few. Its digest goes into one
cell of each of three tables; a cell holds how many digests fell into it, their exclusive
or, and that of their check values. Subtracting the sketches of two versions leaves the
digests that differ; cells with a single one give it away and are peeled until nothing is
left. If something is left, larger sketches are made of both. The digests that differ and
the sizes of both sets give the likeness of two texts.

Results for odd input: a null text is the empty text; an empty text has no paragraph, is
wholly like another empty one and wholly unlike any other text; repeated paragraphs count
once; a single document is followed by itself; rows of one id follow each other in an
order that depends on their texts; rows without id come last; an empty table gives an
empty result. Columns other than the ones named are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.words import AS_IS, NOT_SPACE, U64, mix, word_hashes

TABLES = 3
CELLS = 24
CUT = 8
SLICE_CHARS = 1 << 21

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=U64)
_LINE_END = 10


def paragraphs(text: bytes) -> np.ndarray:
    """The distinct paragraph digests of a text."""
    data = np.frombuffer(text, dtype=np.uint8)
    words, starts = word_hashes(data, NOT_SPACE, AS_IS)
    if not len(words):
        return words
    ends = np.flatnonzero(data == _LINE_END)
    first = (words >> U64(32)) % U64(CUT) == 0
    first[np.minimum(np.searchsorted(starts, ends), len(words) - 1)] |= True
    first[0] = True
    begins = np.flatnonzero(first)
    inside = np.arange(len(words)) - np.repeat(begins, np.diff(begins, append=len(words)))
    return np.unique(mix(np.add.reduceat(mix(words + inside.astype(U64) * _ODD[0]), begins)))


class Sketches:
    """The sketches of several sets side by side, each with its own number of cells."""

    def __init__(self, sizes: np.ndarray) -> None:
        self.sizes = np.asarray(sizes, dtype=np.int64) // TABLES  # cells per table
        self.begins = np.concatenate([[0], np.cumsum(self.sizes * TABLES)])
        self.count = np.zeros(self.begins[-1], dtype=np.int32)
        self.key = np.zeros(self.begins[-1], dtype=U64)
        self.check = np.zeros(self.begins[-1], dtype=np.uint32)

    def cells(self, owner: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        out = []
        for t in range(TABLES):
            at = (mix(keys * _ODD[t]) >> U64(16)) % self.sizes[owner].astype(U64)
            out.append(self.begins[owner] + t * self.sizes[owner] + at.astype(np.int64))
        return out

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        checks = check_values(keys)
        for at in self.cells(owner, keys):
            np.add.at(self.count, at, np.broadcast_to(np.asarray(sign, dtype=np.int32), at.shape))
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.sizes * TABLES)
        out.count = self.count - other.count
        out.key = self.key ^ other.key
        out.check = self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, sign) of what can be peeled, and whether each sketch is empty then.

        A sketch has fewer digests than cells if it can be peeled at all, so the rounds end.
        """
        owner_of = np.repeat(np.arange(len(self.sizes)), self.sizes * TABLES)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.flatnonzero(np.abs(self.count) == 1)
        budget = self.sizes * TABLES
        while len(look):
            single = (np.abs(self.count[look]) == 1) & (self.check[look] == check_values(self.key[look]))
            look = look[single]
            owner, keys, sign = owner_of[look], self.key[look], self.count[look]
            order = np.lexsort((keys, owner))
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (np.diff(owner[order]) != 0) | (np.diff(keys[order]) != 0)
            pick = order[fresh]
            owner, keys, sign = owner[pick], keys[pick], sign[pick]
            budget = budget - np.bincount(owner, minlength=len(budget))
            alive = budget[owner] >= 0
            owner, keys, sign = owner[alive], keys[alive], sign[alive]
            if not len(keys):
                break
            found.append((owner, keys, sign))
            self.add(owner, keys, -sign)
            look = np.unique(np.concatenate(self.cells(owner, keys)))
        rest = (self.count != 0) | (self.key != 0)
        empty = np.bincount(owner_of[rest], minlength=len(self.sizes)) == 0
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none.astype(U64), none, empty
        return (*(np.concatenate(x) for x in zip(*found)), empty)

    def text(self, i: int) -> str:
        """One sketch as text."""
        a, b = self.begins[i], self.begins[i + 1]
        raw = self.count[a:b].astype("<i4").tobytes() + self.key[a:b].astype("<u8").tobytes()
        return base64.b64encode(raw + self.check[a:b].astype("<u4").tobytes()).decode()


def check_values(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ U64(0x27D4EB2F165667C5)) >> U64(32)).astype(np.uint32)


def sketches(sets: list[np.ndarray], sizes: np.ndarray) -> Sketches:
    out = Sketches(sizes)
    out.add(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([*sets, np.zeros(0, dtype=U64)]))
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets the digests only the first has, and those only the second has."""
    out: list = [None] * len(a)
    todo = np.arange(len(a))
    sizes = np.full(len(a), cells, dtype=np.int64)
    while len(todo):
        left, right = [a[i] for i in todo], [b[i] for i in todo]
        owner, keys, sign, empty = sketches(left, sizes).minus(sketches(right, sizes)).peel()
        order = np.argsort(owner, kind="stable")
        owner, keys, sign = owner[order], keys[order], sign[order]
        cuts = np.searchsorted(owner, np.arange(len(todo) + 1))
        for k in np.flatnonzero(empty).tolist():
            own, signs = keys[cuts[k] : cuts[k + 1]], sign[cuts[k] : cuts[k + 1]]
            out[todo[k]] = (own[signs > 0], own[signs < 0])
        # A larger try: for all that can differ, and twice as large again after that.
        most = np.array([len(x) + len(y) for x, y in zip(left, right)], dtype=np.int64)
        sizes = np.maximum(TABLES * (most // 2 + 4), 2 * sizes)[~empty]
        todo = todo[~empty]
    return out


def likeness(n_a: int, n_b: int, differing: int) -> float:
    """Share of common paragraphs in all paragraphs, from the sizes and the difference."""
    return (n_a + n_b - differing) / (n_a + n_b + differing) if n_a + n_b else 1.0


# The order of documents --------------------------------------------------------------------

_NO_ID = -(1 << 63)


def _bucket(key: Column, splits: list[int]) -> Column:
    """How many of the sorted splits are at most the key, by binary search."""
    table = F.split(F.lit(",".join(map(str, splits))), ",").cast("array<bigint>")
    bits = max(len(splits).bit_length(), 1)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])

    def halve(at: Column, step: Column) -> Column:
        ahead = at + step
        return F.when((ahead <= len(splits)) & (F.get(table, ahead - 1) <= key), ahead).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def in_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(bucket, carried, doc_id, text) by descending id: each partition holds a range of
    ids in order, and after them, carried, the document that follows its last one.

    Ranges come from approximate quantiles; the driver sees one id per range.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("_key", F.coalesce("doc_id", F.lit(_NO_ID)))
    shares = [k / n for k in range(1, n)]
    splits = sorted(set(keyed.agg(F.percentile_approx("_key", shares, 10_000)).first()[0] or ())) if shares else []
    bucket = _bucket(F.col("_key"), splits) if splits else F.lit(0)
    heads = keyed.groupBy(bucket.alias("b")).agg(F.max("_key").alias("head")).orderBy(F.desc("b")).collect()
    # The head of a range follows the last document of the range above it; the first of
    # all follows the last of all.
    after = [(heads[i]["head"], heads[i - 1]["b"]) for i in range(len(heads))]
    carried = F.broadcast(spark.createDataFrame(after, "_key bigint, _above int"))
    rows = keyed.withColumn("_own", bucket).join(carried, "_key", "left")
    spread = rows.select("_key", "doc_id", "text", F.posexplode(F.array_compact(F.array("_own", "_above"))))
    dealt = spread.select(
        F.col("col").alias("bucket"), (F.col("pos") == 1).alias("carried"), "doc_id", "text", "_key"
    )
    # Equal ids lie in one range, in an order that their texts decide.
    return (
        dealt.repartitionById(len(splits) + 1, "bucket")
        .sortWithinPartitions("bucket", "carried", F.desc("_key"), F.xxhash64("text"))
        .drop("_key")
    )


def _followers(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (bucket, carried, id, text) in order; the last of a list opens the next one."""
    run: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "carried", "doc_id")]
        for i, row in enumerate(zip(*columns)):
            text = batch.column("text")[i].as_py() or ""
            run.append((*row, text))
            size += len(text)
            if size >= SLICE_CHARS and len(run) > 1:
                yield run
                run, size = run[-1:], len(text)
    if len(run) > 1:
        yield run


_OUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("n_paragraphs", T.LongType()),
    ]
)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _followers(batches):
        sets = [paragraphs(text.encode()) for *_, text in run]
        # A carried row only follows others, and ranges do not follow each other here.
        own = [i for i in range(len(run) - 1) if not run[i][1] and run[i][0] == run[i + 1][0]]
        if not own:
            continue
        edited = []
        for i in own:
            text, half = run[i][3], len(run[i][3]) // 2
            edited.append((text[: len(text) - half] + run[i + 1][3][:half]).encode())
        mine, theirs = [sets[i] for i in own], [sets[i + 1] for i in own]
        changed = [paragraphs(e) for e in edited]
        near = lambda other: [
            likeness(len(a), len(b), len(x) + len(y)) for a, b, (x, y) in zip(mine, other, differences(mine, other))
        ]
        sizes = np.full(len(own), CELLS)
        prints, edited_prints = sketches(mine, sizes), sketches(changed, sizes)
        columns = [
            [run[i][2] for i in own],
            [len(run[i][3]) for i in own],
            [hashlib.sha256(e).hexdigest() for e in edited],
            [prints.text(k) for k in range(len(own))],
            [edited_prints.text(k) for k in range(len(own))],
            near(changed),
            near(theirs),
            [len(s) for s in mine],
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_OUT.names)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of every text, of its edited text (its second half replaced by the
    start of the next document, by descending id), and how near the edited text and the
    next document are. One shuffle of the texts."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return in_order(rows).mapInArrow(_fingerprinted, _OUT)
