"""Words of whole texts as numpy arrays, inside tasks.

A text is a run of UTF-8 bytes. Which bytes belong to words is a table of 256 flags, so
a word class is stated once and holds for every language: bytes above 127 are word bytes
or separators as a whole. Texts are read in pieces cut between words, so the memory of a
task does not grow with its longest text beyond one number per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
# A piece of text that is hashed at once.
PIECE_BYTES = 1 << 20

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    for first, last in ranges:
        flags[first : last + 1] = True
    return flags


# Word bytes: everything but white space; digits, letters and all beyond ASCII; letters only.
NOT_SPACE = ~_flags((9, 13), (32, 32))
ALNUM = _flags((48, 57), (65, 90), (97, 122), (128, 255))
LETTERS = _flags((65, 90), (97, 122), (128, 255))


def split_table(word_bytes: np.ndarray) -> bytes:
    """For `bytes.translate`: A-Z in lower case, separators as spaces."""
    return np.where(word_bytes, LOWER, 32).astype(np.uint8).tobytes()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, as long as the longest piece so far."""

    up = _powers(_BASE, 1)
    down = _powers(_BASE, 1)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, PIECE_BYTES)
            cls.up = _powers(_BASE, size)
            cls.down = _powers(pow(_BASE, -1, 1 << 64), size)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finalizer)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _piece_hashes(data: np.ndarray, word_bytes: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = word_bytes[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(fold[data].astype(U64) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)), starts


def word_hashes(
    data: np.ndarray, word_bytes: np.ndarray, fold: np.ndarray = LOWER
) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, byte where it starts); in lower case unless `fold` says
    otherwise."""
    if len(data) <= PIECE_BYTES:
        return _piece_hashes(data, word_bytes, fold)
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data):  # up to the next separator
            gap = np.flatnonzero(~word_bytes[data[end : end + PIECE_BYTES]])
            end += int(gap[0]) if len(gap) else min(PIECE_BYTES, len(data) - end)
            if len(gap):
                break
        h, s = _piece_hashes(data[at:end], word_bytes, fold)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    h = np.zeros(n - size + 1, dtype=U64)
    for k in range(size):
        h = mix(h ^ words[k : n - size + 1 + k]) + U64(k + 1)
    return h


def text_bytes(column: pa.Array):
    """The UTF-8 bytes of each text of an Arrow column as numpy views; None for null."""
    if len(column) == 0:
        return
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]] if valid[i] else None


def slices(batch: pa.RecordBatch, text: str, most: int = 8 << 20):
    """A batch in runs of rows with about `most` bytes of text, one row at least."""
    sizes = batch.column(text).cast(pa.large_string())
    offsets = np.frombuffer(sizes.buffers()[1], dtype=np.int64)[sizes.offset :][: len(sizes) + 1] if len(sizes) else []
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
