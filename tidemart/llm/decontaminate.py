"""Passages of benchmark items found in documents by Wu-Manber search over words.

The test strings are the windows of every item: `size` words in a row, or the whole item
where it has fewer. Strings of one length share a shift table from blocks of two words to
the number of words that can be skipped. Where the shift is zero, the bucket of the block
that ends there holds the strings to compare, and comparing them word by word decides.

Results for odd input: a null or empty text has no words, so nothing is hit; an item
without words has no window and is never found; an item without id makes words hit but is
not named; repeated items and repeated documents count as they stand; no benchmark at all
leaves every document clean. Columns other than the ones named are not looked at.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import packed, unpacked
from tidemart.llm.words import ALNUM, split_table

# Fixed value: what a word is, here as in the contract of the query.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Windows in one set of tables: some 100 MB of Python objects in a task at most.
BLOCK_WINDOWS = 100_000

_SPLIT = split_table(ALNUM)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, words): one row per different window of an item; words joined by spaces."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"),
        F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD), F.lit(0)).alias("_w"),
    ).where(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - F.lit(size), F.lit(0))
    start = F.explode(F.sequence(F.lit(1), last + 1)).alias("_s")
    return (
        words.select("item", "_w", start)
        .select("item", F.array_join(F.slice("_w", F.col("_s"), F.lit(size)), " ").alias("words"))
        .distinct()
    )


class WordSearch:
    """Wu-Manber tables over sequences of words."""

    def __init__(self, strings: dict[tuple[bytes, ...], list[str]]) -> None:
        """`strings`: the items of each test string."""
        self.items = strings
        by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for words in strings:
            by_length[len(words)].append(words)
        self.tables = [self._table(length, group) for length, group in sorted(by_length.items())]

    @staticmethod
    def _table(length: int, group: list[tuple[bytes, ...]]) -> tuple:
        block = min(2, length)
        shift: dict = {}
        buckets: dict = defaultdict(list)
        for words in group:
            for end in range(block, length + 1):
                key = words[end - block : end]
                shift[key] = min(shift.get(key, length), length - end)
            buckets[words[-block:]].append(words)
        return length, block, shift, dict(buckets)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(start, end, items) of every occurrence, in order of length and place."""
        n = len(words)
        for length, block, shift, buckets in self.tables:
            skip, at, look = length - block + 1, length, shift.get
            while at <= n:
                key = (words[at - 2], words[at - 1]) if block == 2 else (words[at - 1],)
                step = look(key, skip)
                if step:
                    at += step
                    continue
                found = tuple(words[at - length : at])
                for string_ in buckets.get(key, ()):
                    if string_ == found:
                        yield at - length, at, self.items[string_]
                at += 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _searcher(strings: dict[tuple[bytes, ...], list[str]], text: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = WordSearch(strings)
        for batch in batches:
            rest = [c for c in batch.schema.names if c not in ("n_words", "spans", "items")]
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            texts = batch.column(text).cast(pa.binary())
            counts, spans, items = [], [], []
            for i, (old_spans, old_items) in enumerate(before):
                raw = texts[i].as_py()
                words = raw.translate(_SPLIT).split() if raw else []
                hits = [(s["start"], s["end"]) for s in old_spans or ()]
                named = set(old_items or ())
                for start, end, names in tables.find(words):
                    hits.append((start, end))
                    named.update(names)
                counts.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in _merged(hits)])
                items.append(sorted(named))
            columns = [
                *[batch.column(c) for c in rest],
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(_SPAN)),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "n_words", "spans", "items"])

    return search


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, n_words, spans, items) of every row of `docs`; spans of hit words are
    merged, counted from 0, end excluded.

    The windows are the query set. They reach the tasks in blocks of `block_windows`, by
    hash, and the documents pass through one search per block, with no shuffle.
    """
    windows = item_windows(benchmark, size)
    total = windows.count()
    blocks = max(1, -(-total // block_windows))
    out = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = out.schema
    for k in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k) if blocks > 1 else windows
        strings: dict[tuple[bytes, ...], list[str]] = {}
        for item, words in part.toLocalIterator():
            names = strings.setdefault(tuple(words.encode().split(b" ")), [])
            if item is not None:
                names.append(item)
        out = out.mapInArrow(_searcher(strings, "text"), schema)
    return out


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    found = find_items(packed(docs), benchmark, size, id_col="row").where(F.size("spans") == 0)
    return unpacked(found.withColumnRenamed("doc_id", "row"), docs.columns)
