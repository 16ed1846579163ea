"""Near-duplicate documents by HyperMinHash.

A document is the set of its word shingles. Its sketch has REGISTERS buckets; a bucket
keeps the least hash that falls into it, compressed to the number of leading zeros (6
bits) and the MANTISSA bits after the leading one. A bucket without a shingle takes the
register of another bucket, chosen by a fixed random order. Registers are compared in
bands: documents that agree in a whole band are candidates. The share of equal registers,
less the share that agrees by chance, estimates the Jaccard similarity; candidates that
are too far off (by six standard errors) go, and the others are confirmed on their full
sets. With 50 bands of 6 registers a pair at similarity 0.8 is missed with a probability
of 2.5e-7.

Equal sets are one class and are compared once. Candidates are not all pairs of a bucket:
each member first meets one representative, links are turned into components, and only
members of different components meet again: first one representative of the bucket's
least component, in the end each other, inside the task that holds the bucket: their
registers are compared first, each pair in the first band it agrees in, and only members
that may be near one of another component are sent their full sets. So a large group of
near copies costs a few pairs per member, and no link between two components is lost.

The full sets of all classes that share a band with another are built once and kept by
class in a written table; every later step joins them from there. Nothing is broadcast by
a size of its own choosing, so there is one plan at every size.

Results for odd input: a text without words, or null, has the empty set, is linked with
nothing and is kept; repeated rows are copies of each other; a row without id belongs to
the component of its text, whose id is the least id there is (null if none); an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import components, written
from tidemart.llm.rows import packed, unpacked
from tidemart.llm.words import NOT_SPACE, U64, mix, shingle_hashes, text_bytes, word_hashes
from tidemart.session import work_dir

BANDS, ROWS = 50, 6
REGISTERS = BANDS * ROWS
MANTISSA = 10
ERRORS = 6.0
PROBES = 64
# Members of a bucket that are compared at once, and cells of the matrix that does it.
BLOCK = 1024
MATRIX_CELLS = 4_000_000

_CELL = (1 << 64) // REGISTERS
_BOUNDS = (np.arange(REGISTERS, dtype=U64)) * U64(_CELL)
_PROBE = (mix(np.arange(PROBES * REGISTERS, dtype=U64) + U64(77)) % U64(REGISTERS)).astype(np.int64)
_PROBE = _PROBE.reshape(PROBES, REGISTERS)


def shingle_set(text: np.ndarray | None, shingle: int, word_bytes: np.ndarray) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    if text is None or not len(text):
        return np.zeros(0, dtype=U64)
    return np.unique(shingle_hashes(word_hashes(text, word_bytes)[0], shingle))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set of sorted hashes that is not empty."""
    first = np.searchsorted(shingles, _BOUNDS)
    full = np.diff(first, append=len(shingles)) > 0
    rest = (shingles[first[full]] - _BOUNDS[full]).astype(np.float64) / _CELL
    part, power = np.frexp(rest)
    zeros = np.where(rest > 0, np.clip(-power, 0, 63), 63).astype(np.uint16)
    tail = np.clip((part * 2 - 1) * (1 << MANTISSA), 0, (1 << MANTISSA) - 1).astype(np.uint16)
    out = np.zeros(REGISTERS, dtype=np.uint16)
    out[full] = (zeros << MANTISSA) | tail
    empty = np.flatnonzero(~full)
    for probe in _PROBE:
        if not len(empty):
            return out
        source = probe[empty]
        hit = full[source]
        out[empty[hit]] = out[source[hit]]
        empty = empty[~hit]
    where = np.flatnonzero(full)
    out[empty] = out[where[np.searchsorted(where, empty) % len(where)]]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of registers; the bands' keys differ by their number."""
    rows = sketch.astype(U64).reshape(ROWS, BANDS)
    h = np.arange(BANDS, dtype=U64)
    for row in rows:
        h = mix(h * U64(0x9E3779B97F4A7C15) + row)
    return h.view(np.int64)


def _chance_table() -> np.ndarray:
    """By log2 of shingles per bucket, from -10 to 30: how likely two registers of
    unrelated sets are equal. The least of x uniform hashes lies in a cell [a, b) with
    probability exp(-x a) - exp(-x b)."""
    tops = 2.0 ** -np.arange(0, 64)
    cells = (tops[:, None] / 2) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
    width = tops[:, None] / 2 / (1 << MANTISSA)
    out = []
    for power in range(-10, 31):
        x = 2.0**power
        p = np.exp(-x * cells) * -np.expm1(-x * width)
        out.append(float((p**2).sum() / p.sum() ** 2))
    return np.array(out)


_CHANCE = _chance_table()


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, float]:
    """(Jaccard estimate corrected for chance agreement, its standard error at 0.8)."""
    x = np.log2(max(n_a, n_b) / REGISTERS)
    chance = _CHANCE[int(np.clip(round(x) + 10, 0, len(_CHANCE) - 1))]
    agree = float(np.count_nonzero(a == b)) / REGISTERS
    # Only as many registers are independent as there are full buckets.
    independent = REGISTERS * -np.expm1(-min(n_a, n_b) / REGISTERS)
    return (agree - chance) / (1 - chance), float(np.sqrt(0.16 / max(independent, 1.0)))


# Inside tasks ----------------------------------------------------------------------------


def _sketches(shingle: int, word_bytes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for text in text_bytes(batch.column("text")):
                found = shingle_set(text, shingle, word_bytes)
                sizes.append(len(found))
                digests.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sketches.append(registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "sketch"],
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [band_keys(np.frombuffer(s.as_py(), dtype=np.uint16)) for s in batch.column("sketch")]
        repeat = lambda c: pa.array(np.repeat(batch.column(c).to_numpy(), BANDS), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [repeat("node"), repeat("label"), pa.array(np.concatenate(keys), pa.int64())],
            names=["node", "label", "key"],
        )


def _near_enough(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_sketch", "b_sketch")]
            for n_a, n_b, a, b in zip(*columns):
                near, error = estimate(np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16), n_a, n_b)
                keep.append(
                    100 * min(n_a, n_b) >= threshold * max(n_a, n_b)
                    and near >= threshold / 100 - ERRORS * error
                )
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _confirmed(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set")):
                set_a, set_b = (np.frombuffer(x.as_buffer(), dtype=U64) for x in (a, b))
                shared = len(np.intersect1d(set_a, set_b, assume_unique=True))
                keep.append(100 * shared >= threshold * (len(set_a) + len(set_b) - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _digested_sets(shingle: int, word_bytes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, shingle, word_bytes).tobytes() for text in text_bytes(batch.column("text"))]
            digests = [blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], names=["digest", "shingles"]
            )

    return run


def near_members(
    labels: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, threshold: int, band: int | None = None
) -> np.ndarray:
    """The members that by their registers may be near one of another label: the same rule as
    for pairs, `estimate` and ERRORS standard errors, for all pairs of a group at once. With
    a band, only pairs whose first band in common it is."""
    most = np.maximum(sizes[:, None], sizes[None, :])
    least = np.minimum(sizes[:, None], sizes[None, :])
    place = np.clip(np.rint(np.log2(most / REGISTERS)) + 10, 0, len(_CHANCE) - 1).astype(np.int64)
    chance = _CHANCE[place]
    independent = np.maximum(REGISTERS * -np.expm1(-least / REGISTERS), 1.0)
    near = np.zeros(len(labels), dtype=bool)
    for i in range(len(labels) - 1):
        j = slice(i + 1, None)
        equal = sketches[j] == sketches[i]
        agree = np.count_nonzero(equal, axis=1) / REGISTERS
        likely = (agree - chance[i, j]) / (1 - chance[i, j])
        hit = likely >= threshold / 100 - ERRORS * np.sqrt(0.16 / independent[i, j])
        hit &= (labels[j] != labels[i]) & (100 * least[i, j] >= threshold * most[i, j])
        if band is not None and hit.any():
            which = np.flatnonzero(hit)
            hit[which] = equal[which].reshape(-1, ROWS, BANDS).all(axis=1).argmax(axis=1) == band
        if hit.any():
            near[i] = True
            near[j] |= hit
    return near


def bucket_forest(
    nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], threshold: int
) -> list[tuple[int, int]]:
    """Links between members of different labels, no more than join them all: of two
    members that earlier links join already, no link is needed."""
    tops = {x: x for x in labels.tolist()}

    def top(x: int) -> int:
        while tops[x] != x:
            tops[x] = x = tops[tops[x]]
        return x

    sizes = np.array([len(s) for s in sets])
    # Only shingles that two members have can be shared, and a link needs enough of them.
    flat, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = often[place] > 1
    enough = 100 * np.bincount(row[shared], minlength=len(sets)) >= threshold * sizes
    use = np.flatnonzero(enough)
    if len(use) < 2:
        return []
    rank = np.full(len(sets), -1)
    rank[use] = np.arange(len(use))
    shared &= enough[row]
    _, column = np.unique(place[shared], return_inverse=True)
    row = rank[row[shared]]
    common = np.zeros((len(use), len(use)), dtype=np.float32)
    # Products over slices of the shingles keep the matrix small: whole numbers, so exact.
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, MATRIX_CELLS // len(use))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        held = np.zeros((len(use), width), dtype=np.float32)
        held[row[a:b], column[a:b] - low] = 1
        common += held @ held.T
    n = sizes[use].astype(np.int64)
    hits = 100 * common >= threshold * (n[:, None] + n[None, :] - common)
    left, right = np.nonzero(np.triu(hits, 1))
    out = []
    for i, j in zip(use[left].tolist(), use[right].tolist()):
        a, b = top(int(labels[i])), top(int(labels[j]))
        if a != b:
            tops[max(a, b)] = min(a, b)
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows sorted by key and part, as ((key, part), rows of the columns)."""
    group, last = [], None
    for batch in batches:
        values = [batch.column(c).to_pylist() for c in ("key", "part", *columns)]
        for key, part, *row in zip(*values):
            if (key, part) != last:
                if len(group) > 1:
                    yield last, group
                group, last = [], (key, part)
            group.append(tuple(row))
    if len(group) > 1:
        yield last, group


def _likely(threshold: int):
    """Of the members of a bucket, those whose registers are near one of another label's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, part), group in _groups(batches, ("node", "label", "n", "sketch")):
            nodes, labels, sizes = (np.array([g[k] for g in group], dtype=np.int64) for k in range(3))
            sketches = np.frombuffer(b"".join(g[3] for g in group), dtype=np.uint16).reshape(-1, REGISTERS)
            band = np.flatnonzero(band_keys(sketches[0]) == key)
            near = near_members(labels, sizes, sketches, threshold, int(band[0]) if len(band) else None)
            if near.any():
                k = int(near.sum())
                columns = [np.full(k, key), np.full(k, part), nodes[near], labels[near]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_MEMBER)

    return run


def _bucket_links(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _groups(batches, ("node", "label", "shingles")):
            nodes, labels = (np.array([g[k] for g in group], dtype=np.int64) for k in range(2))
            yield _pairs(bucket_forest(nodes, labels, [np.frombuffer(g[2], dtype=U64) for g in group], threshold))

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


# The operator --------------------------------------------------------------------------

_MEMBER = ["key", "part", "node", "label"]
_NO_ID = -(1 << 63)


class _Search:
    """One search: where its tables lie, and what a pair has to pass."""

    def __init__(self, docs: DataFrame, root: str, shingle: int, threshold: int, word_bytes: np.ndarray) -> None:
        self.root, self.shingle, self.threshold, self.word_bytes = root, shingle, threshold, word_bytes
        self.docs = docs  # (doc_id, text)
        self.sets: DataFrame | None = None  # of the candidates, once there are any
        self.spark = docs.sparkSession
        self.sketches = written(
            docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
                _sketches(shingle, word_bytes),
                "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, sketch binary",
            ),
            f"{root}/sketches",
        )
        same = self.sketches.where("digest is not null").groupBy("digest")
        self.classes = written(
            same.agg(
                F.min("doc_id").alias("least_id"),
                F.min(F.coalesce("doc_id", F.lit(_NO_ID))).alias("key"),
                F.first("n_shingles").alias("n"),
                F.first("sketch").alias("sketch"),
            ).withColumn("node", F.monotonically_increasing_id()),
            f"{root}/classes",
        )

    def bands(self, labels: DataFrame | None = None) -> DataFrame:
        """(node, label, key): a row per class and band."""
        rows = self.classes.select("node", "sketch")
        if labels is None:
            rows = rows.withColumn("label", F.col("node"))
        else:
            rows = rows.join(labels, "node", "left").select(
                "node", "sketch", F.coalesce("label", "node").alias("label")
            )
        return rows.mapInArrow(_bands, "node bigint, label bigint, key bigint")

    def candidates(self, ends: DataFrame) -> DataFrame:
        """(node, n, sketch, shingles) of the classes named in `ends` (node, repeats allowed).

        A class is built from the texts of its key's documents. The texts are the left side
        of a shuffled join with the unique keys, at every size: a repeated id is split.
        """
        nodes = self.classes.select("node", "key", "digest", "n", "sketch")
        nodes = nodes.join(ends.select("node").distinct(), "node", "left_semi")
        nodes = written(nodes, f"{self.root}/candidate-classes")
        texts = self.docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("key"), "text")
        keys = nodes.select("key").distinct().hint("shuffle_hash")
        sets = texts.join(keys, "key", "left_semi").mapInArrow(
            _digested_sets(self.shingle, self.word_bytes), "digest binary, shingles binary"
        )
        known = nodes.select("node", "digest", "n", "sketch")
        # A class whose key is one document has one row; texts under a repeated id may be copies.
        return written(
            sets.join(known, "digest").select("node", "n", "sketch", "shingles").dropDuplicates(["node"]),
            f"{self.root}/candidates",
        )

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) of candidates that are near enough on their full sets."""
        side = lambda p, *cols: self.sets.select(
            F.col("node").alias(p), *[F.col(c).alias(f"{p}_{o}") for c, o in cols]
        )
        pairs = pairs.select("a", "b")
        sketch = (("n", "n"), ("sketch", "sketch"))
        near = (
            pairs.join(side("a", *sketch), "a")
            .join(side("b", *sketch), "b")
            .mapInArrow(_near_enough(self.threshold), "a bigint, b bigint")
        )
        near = written(near, f"{self.root}/near-{name}")
        full = (("shingles", "set"),)
        both = near.join(side("a", *full), "a").join(side("b", *full), "b")
        sure = both.select("a", "b", "a_set", "b_set").mapInArrow(_confirmed(self.threshold), "a bigint, b bigint")
        return written(sure, f"{self.root}/links-{name}")

    def labels(self, links: DataFrame, name: str) -> DataFrame:
        return components(self.spark, links, f"{self.root}/components-{name}")

    def run(self) -> DataFrame:
        # Every member of a bucket and the bucket's least class.
        bands = self.bands()
        least = bands.groupBy("key").agg(F.min("node").alias("rep"), F.max("node").alias("_m")).where("rep < _m")
        first = bands.join(least, "key").where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
        first = written(first.distinct(), f"{self.root}/pairs-first")
        # Every class that shares a band with another is in a pair here.
        self.sets = self.candidates(first.select(F.explode(F.array("a", "b")).alias("node")))
        links = self.links(first, "first")
        labels = self.labels(links, "first")
        # Buckets that still hold several components: a representative of the least one.
        mixed = written(self._mixed(self.bands(labels)), f"{self.root}/mixed")
        order = F.xxhash64("node", "key")
        reps = (
            mixed.where("label = low")
            .groupBy("key")
            .agg(F.min_by("node", order).alias("rep"))
        )
        second = (
            mixed.where("label <> low")
            .join(reps, "key")
            .select(F.least("rep", "node").alias("a"), F.greatest("rep", "node").alias("b"))
            .distinct()
        )
        links = links.unionByName(self.links(written(second, f"{self.root}/pairs-second"), "second"))
        labels = self.labels(links, "second")
        # What is left: members of different components, compared inside their buckets.
        left = mixed.select("node", "key").join(labels, "node", "left")
        left = self._mixed(left.select("node", "key", F.coalesce("label", "node").alias("label")))
        third = self._inside_buckets(written(left, f"{self.root}/left"))
        # They were found on full sets.
        links = links.unionByName(written(third.distinct(), f"{self.root}/links-third"))
        return self.result(self.labels(links, "third"))

    @staticmethod
    def _mixed(rows: DataFrame) -> DataFrame:
        """The rows of the buckets with more than one label, with the least label."""
        several = rows.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("_h"), F.count("*").alias("n_rows")
        )
        return rows.join(several.where("low < _h").drop("_h"), "key")

    def _inside_buckets(self, left: DataFrame) -> DataFrame:
        """Pairs (a, b) that link all members of a bucket that can be linked, as a forest.

        Members meet in blocks of BLOCK rows; a bucket of several blocks is dealt as pairs
        of blocks. Only registers are dealt so; full sets go to the members that registers
        leave. Each group is compared where it lies and only its links leave the task.
        """
        candidates = self.candidates(left) if self.sets is None else self.sets
        blocks = F.ceil(F.col("n_rows") / F.lit(BLOCK)).cast("int")
        own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
        # A block meets every other one, and itself where it is alone.
        part = F.transform(
            F.sequence(F.lit(0), F.greatest(F.col("_blocks") - 1, F.lit(0))),
            lambda i: F.when(
                (F.col("_blocks") == 1) | (i != F.col("_own")),
                F.least(i, F.col("_own")).cast("bigint") * F.col("_blocks") + F.greatest(i, F.col("_own")),
            ),
        )
        rows = (
            left.withColumn("_blocks", blocks)
            .withColumn("_own", own)
            .select("key", "node", "label", F.explode(F.array_compact(part)).alias("part"))
            .join(candidates.select("node", "n", "sketch"), "node")
        )
        dealt = lambda df, *cols: (
            df.select(*_MEMBER, *cols).repartition("key", "part").sortWithinPartitions("key", "part", "node")
        )
        likely = written(
            dealt(rows, "n", "sketch").mapInArrow(
                _likely(self.threshold), "key bigint, part bigint, node bigint, label bigint"
            ),
            f"{self.root}/likely",
        )
        sets = likely.join(candidates.select("node", "shingles"), "node")
        return dealt(sets, "shingles").mapInArrow(_bucket_links(self.threshold), "a bigint, b bigint")

    def result(self, labels: DataFrame) -> DataFrame:
        known = self.classes.select("node", "digest", "least_id").join(labels, "node", "left")
        known = known.select("digest", "least_id", F.coalesce("label", "node").alias("label"))
        least = known.groupBy("label").agg(F.min("least_id").alias("component_id"))
        classes = written(
            known.join(least, "label").select("digest", "component_id", "label"), f"{self.root}/members"
        )
        rows = self.sketches.select("doc_id", "n_shingles", "digest", "text_hash").join(classes, "digest", "left")
        component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return rows.select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            "label",
            "text_hash",
        )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    threshold: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    word_bytes: np.ndarray = NOT_SPACE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, label, text_hash) of every row of `docs`.

    Two documents are linked if 100 * |A and B| >= threshold * |A or B|; component_id is
    the least id reachable, and kept says that it is the row's own. label numbers the
    components, also where ids are missing or repeated (null for the empty set), and
    text_hash is the `xxhash64` of the text.
    """
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return _Search(narrow, work_dir(docs.sparkSession, "neardup"), shingle, threshold, word_bytes).run()


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = 80) -> DataFrame:
    """One document of every component, with all its columns: the one with the least id,
    and of several texts under that id the one with the least hash. Rows that repeat both
    id and text are one document. A document with the empty set stays."""
    groups = near_duplicates(docs, shingle, threshold)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID))
    rows = groups.select("label", F.struct(key.alias("_key"), F.col("text_hash").alias("_hash")).alias("_r"))
    first = rows.where("label is not null").groupBy("label").agg(F.min("_r").alias("_r")).select("_r.*")
    empty = rows.where("label is null").select("_r.*").distinct()
    own = F.coalesce(F.col("row.doc_id").cast("bigint"), F.lit(_NO_ID))
    keyed = packed(docs).withColumns({"_key": own, "_hash": F.xxhash64("text")})
    kept = keyed.join(first.unionByName(empty), ["_key", "_hash"], "left_semi")
    return unpacked(kept.dropDuplicates(["_key", "_hash"]), docs.columns)
