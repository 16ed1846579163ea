"""SentencePiece encoding and decoding by suffix-array matching.

A batch's new chunks of text (a run of spaces and the characters up to the next space;
no piece reaches further) are concatenated and their suffixes sorted, as deep as the
longest piece. Every piece of the vocabulary is found by binary search, which gives the
range of its occurrences: the edges. Edges are sorted by where they end within their
chunk and relaxed in that order, for all chunks at once.

The vocabulary is a byte-pair one: merging prefers the pair with the best score. Its
result is the only path on which every piece, and every two neighbours, stay as they are
when merged by themselves, since two pieces only ever meet at their common border. So an
edge is relaxed if its piece holds together with the last piece of the path that leads
to it, and each place is reached by one edge at most. Characters outside the vocabulary
are single edges and become byte pieces.

Results for odd input: a null or empty text has no pieces and decodes to the empty text;
a text holding the space mark itself decodes with spaces there, as in the format; bytes
that are no UTF-8 decode to the replacement character; copies are encoded alike; an empty
table gives an empty result. Other columns pass through as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm.words import slices
from tidemart.session import bounded_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Chunks and neighbours a task remembers, and characters indexed at once: some 150 MB.
KNOWN_CHUNKS = 200_000
KNOWN_NEIGHBOURS = 400_000
INDEX_CHARS = 200_000
SLICE_BYTES = 2 << 20
# Pieces that are decoded at once.
RUN_PIECES = 500_000


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: dict[str, float]
    byte_ids: list[int]
    byte_of: dict[int, int] = field(init=False)
    ids: dict[str, int] = field(init=False)
    sound: np.ndarray = field(init=False)
    longest: int = field(init=False)
    left_ends: dict[str, list[tuple[str, float]]] | None = field(init=False)
    right_ends: dict[str, list[tuple[str, float]]] | None = field(init=False)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, p in enumerate(self.pieces) if p in self.scores}
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.longest = max(map(len, self.scores), default=1)
        self.sound = np.zeros(len(self.pieces), dtype=bool)
        halves = {}
        for piece, i in self.ids.items():
            parts = self.merged(piece, 2)
            self.sound[i] = len(parts) <= 2
            if len(piece) > 1 and self.sound[i]:
                halves[piece] = parts
        self._end_pieces(halves)
        if any(SPACE in piece.lstrip(SPACE) for piece in self.scores):
            raise ValueError("a piece with a space inside needs another way to cut texts")
        if any("\n" in piece for piece in self.scores):
            raise ValueError("a piece with a line end needs another way to cut texts")
        if len(self.pieces) > 1 << 16:
            raise ValueError("more than 65536 pieces")

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merge characters pair by pair, the best score first, the leftmost among equals,
        until `least` parts are left."""
        parts = list(text)
        while len(parts) > least:
            scores = [self.scores.get(a + b) for a, b in zip(parts, parts[1:])]
            best = max((s for s in scores if s is not None), default=None)
            if best is None:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _end_pieces(self, halves: dict[str, list[str]]) -> None:
        """For every piece the pieces that stood at its left and right end while it was
        merged, from the whole one down to a character, each with the turn of its merge (its
        negative score; a character was there from the start). Only if every piece is merged
        after its halves, as in any vocabulary that was trained pair by pair."""
        turn = {c: -np.inf if len(c) == 1 else -s for c, s in self.scores.items()}
        self.left_ends, self.right_ends = {}, {}
        for piece in sorted(halves, key=len):
            left, right = halves[piece]
            if max(turn.get(left, -np.inf), turn.get(right, -np.inf)) > turn[piece]:
                self.left_ends = self.right_ends = None
                return
            own = [(piece, turn[piece])]
            self.left_ends[piece] = own + self.left_ends.get(left, [(left, -np.inf)])
            self.right_ends[piece] = own + self.right_ends.get(right, [(right, -np.inf)])

    def together(self, a: str, b: str) -> bool:
        """Whether two sound pieces stay as they are when their texts are merged as one.

        Inside, both are merged as if alone until a pair across the border wins. Such a pair
        stands side by side from the time its later half is there until one of its halves is
        merged on, and it wins if its turn comes before that; among equal turns the left
        merge is first. Going back in time from the whole pieces meets every such pair."""
        if self.left_ends is None:
            return self.merged(a + b) == [a, b]
        lefts = self.right_ends.get(a) or [(a, -np.inf)]
        rights = self.left_ends.get(b) or [(b, -np.inf)]
        i = j = 0
        until_left = until_right = np.inf
        while True:
            (x, since_left), (y, since_right) = lefts[i], rights[j]
            score = self.scores.get(x + y)
            if score is not None and -score < until_left and -score <= until_right:
                return False
            if since_left > since_right:
                until_left, i = since_left, i + 1
            elif since_right > -np.inf:
                until_right, j = since_right, j + 1
            else:
                return True


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    scores = {pieces[i]: model.get_score(i) for i in range(n) if not special(i)}
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary has no piece for every byte")
    return Vocabulary(pieces, scores, byte_ids)


def chunk_keys(text: str) -> list[str]:
    """The chunks of a text, in order. Their space mark is left out: a key is the text of
    a chunk after its first space, and one that begins with a line end has no space."""
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if "\n" in text:
        text = text.replace("\n", " \n")
    parts = text.split(" ")
    if "" not in parts:
        return parts
    out, spaces = [], 0
    for part in parts:
        if not part:
            spaces += 1
        elif part[0] == "\n":
            if spaces:
                out.append(" " * (spaces - 1))
            out.append(part)
            spaces = 0
        else:
            out.append(" " * spaces + part)
            spaces = 0
    if spaces:
        out.append(" " * (spaces - 1))
    return out


def chunk_text(key: str) -> str:
    return key if key[:1] == "\n" else SPACE + key.replace(" ", SPACE)


class Encoder:
    """Encodes texts of one task; remembers chunks and which neighbours hold together."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.chunks: dict[str, bytes] = {}
        self.holds: dict[int, bool] = {}
        self.names = list(vocabulary.pieces)  # unknown characters follow the pieces
        self.unknown: dict[int, int] = {}
        self.keys = sorted(vocabulary.ids)
        self.key_ids = np.array([vocabulary.ids[p] for p in self.keys])
        self.key_lengths = np.array([len(p) for p in self.keys])
        usable = vocabulary.sound[self.key_ids] if len(self.keys) else np.zeros(0, bool)
        self.keys = [p for p, ok in zip(self.keys, usable) if ok]
        self.key_ids, self.key_lengths = self.key_ids[usable], self.key_lengths[usable]
        points = [np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in self.keys]
        self.key_points = np.zeros((len(points), vocabulary.longest), dtype=np.uint32)
        for i, p in enumerate(points):
            self.key_points[i, : len(p)] = p
        # Characters are numbered from 1 over the whole vocabulary; all others share the number
        # behind, as no piece holds them. So the pieces' sort keys are made once.
        self.alphabet = np.unique(self.key_points[self.key_points > 0])
        self.kind = np.dtype(">u2") if len(self.alphabet) < 0xFFF0 else np.dtype(">u4")
        codes = np.searchsorted(self.alphabet, self.key_points) + 1
        inside = np.arange(vocabulary.longest) < self.key_lengths[:, None]
        self.key_codes = np.where(inside, codes, 0).astype(np.int64)
        top = (1 << (8 * self.kind.itemsize)) - 1
        self.key_low = self._as_key(np.where(inside, codes, 0))
        self.key_top = self._as_key(np.where(inside, codes, top))

    def _as_key(self, codes: np.ndarray) -> np.ndarray:
        rows = np.ascontiguousarray(codes.astype(self.kind))
        return rows.view(f"S{rows.shape[1] * self.kind.itemsize}").ravel()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        keys = [chunk_keys(t) if t else [] for t in texts]
        new = set().union(*keys).difference(self.chunks)
        if len(self.holds) > KNOWN_NEIGHBOURS:
            self.holds.clear()
        if len(self.chunks) + len(new) > KNOWN_CHUNKS:
            # What these texts need again stays: most chunks are seen once, and go.
            used = set().union(*keys) - new
            self.chunks = {key: self.chunks[key] for key in used}
        group, size = [], 0
        for key in sorted(new):
            group.append(key)
            size += len(key) + 2
            if size > INDEX_CHARS:
                self._learn(group)
                group, size = [], 0
        self._learn(group)
        known = self.chunks.__getitem__
        return [np.frombuffer(b"".join(map(known, k)), dtype=np.uint16) for k in keys]

    # One group of new chunks ---------------------------------------------------------

    def _learn(self, keys: list[str]) -> None:
        if not keys:
            return
        texts = [chunk_text(k) for k in keys]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(t) for t in texts])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        starts, ends, ids = self._edges(points, begins, lengths)
        last, back = self._relax(starts, ends, ids, begins, lengths)
        # Walk back from all ends at once; pieces end where the walk passes.
        passed = np.zeros(len(points) + 1, dtype=bool)
        at = begins + lengths
        origin = begins
        while len(at):
            passed[at] = True
            at = back[at]
            alive = at > origin
            at, origin = at[alive], origin[alive]
        places = np.flatnonzero(passed)
        found = last[places]
        cuts = np.searchsorted(places, begins + lengths, side="right")
        plain = found.astype(np.uint16).tobytes()
        strange = found >= len(self.v.pieces)
        odd = np.concatenate([[0], np.cumsum(strange)])
        low = 0
        for key, high in zip(keys, cuts.tolist()):
            if odd[high] > odd[low]:
                self.chunks[key] = b"".join(self._bytes(i) for i in found[low:high].tolist())
            else:
                self.chunks[key] = plain[2 * low : 2 * high]
            low = high

    def _bytes(self, piece: int) -> bytes:
        if piece < len(self.v.pieces):
            return np.uint16(piece).tobytes()
        raw = self.names[piece].encode("utf-8", "surrogatepass")
        return b"".join(np.uint16(self.v.byte_ids[b]).tobytes() for b in raw)

    def _edges(self, points: np.ndarray, begins: np.ndarray, lengths: np.ndarray):
        """(start, end, piece) of every occurrence of a piece, by suffix array."""
        at = np.minimum(np.searchsorted(self.alphabet, points), max(len(self.alphabet) - 1, 0))
        known = self.alphabet[at] == points if len(self.alphabet) else np.zeros(len(points), dtype=bool)
        codes = np.where(known, at + 1, len(self.alphabet) + 1)
        depth = self.v.longest
        # Chunks are parted by a code below all others, which no piece holds.
        shift = np.repeat(np.arange(len(lengths)), lengths)
        padded = np.zeros(len(points) + len(lengths) + depth, dtype=self.kind)
        where = np.arange(len(points)) + shift
        padded[where] = codes
        suffixes = self._as_key(np.lib.stride_tricks.sliding_window_view(padded, depth)[where])
        order = np.argsort(suffixes, kind="stable")
        sorted_suffixes = suffixes[order]
        # A piece with a character that is not here cannot occur.
        here = np.zeros(len(self.alphabet) + 2, dtype=bool)
        here[codes] = True
        here[0] = True
        use = np.flatnonzero(here[self.key_codes].all(axis=1))
        first = np.searchsorted(sorted_suffixes, self.key_low[use], side="left")
        count = np.searchsorted(sorted_suffixes, self.key_top[use], side="right") - first
        total = int(count.sum())
        piece = np.repeat(np.arange(len(use)), count)
        step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        starts = order[np.repeat(first, count) + step]
        ids, size = self.key_ids[use][piece], self.key_lengths[use][piece]
        # A character that is no piece is an edge of its own.
        strange = [c for c in np.unique(points).tolist() if not self._is_piece(c)]
        if strange:
            places = np.flatnonzero(np.isin(points, np.array(strange, dtype=np.uint32)))
            own = np.array([self._unknown(c) for c in points[places].tolist()], dtype=np.int64)
            starts = np.concatenate([starts, places])
            ids = np.concatenate([ids, own])
            size = np.concatenate([size, np.ones(len(places), dtype=np.int64)])
        return starts, starts + size, ids

    def _is_piece(self, point: int) -> bool:
        i = self.v.ids.get(chr(point))
        return i is not None and bool(self.v.sound[i])

    def _unknown(self, point: int) -> int:
        if point not in self.unknown:
            self.unknown[point] = len(self.names)
            self.names.append(chr(point))
        return self.unknown[point]

    def _relax(self, starts, ends, ids, begins, lengths):
        """(last piece, where it starts) for every place that a chunk's text can end at."""
        size = int(lengths.sum()) + 1
        chunk = np.repeat(begins, lengths)
        origin = chunk[starts]
        order = np.argsort(ends - origin, kind="stable")
        starts, ends, ids, origin = starts[order], ends[order], ids[order], origin[order]
        last = np.full(size, -1, dtype=np.int64)
        back = np.full(size, -1, dtype=np.int64)
        steps = np.flatnonzero(np.diff(ends - origin)) + 1
        for low, high in zip([0, *steps.tolist()], [*steps.tolist(), len(ids)]):
            s, i = starts[low:high], ids[low:high]
            fresh = s == origin[low:high]
            # A chunk's first place is another's last: only edges further in look back.
            good = fresh | self._together(np.where(fresh, -1, last[s]), i)
            e = ends[low:high][good]
            last[e], back[e] = i[good], s[good]
        return last, back

    def _together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the two pieces stay as they are when merged by themselves."""
        out = np.zeros(len(left), dtype=bool)
        some = np.flatnonzero(left >= 0)
        if not len(some):
            return out
        pairs, place = np.unique((left[some] << 32) | right[some], return_inverse=True)
        holds = self.holds
        answers = np.empty(len(pairs), dtype=bool)
        for k, pair in enumerate(pairs.tolist()):
            answer = holds.get(pair)
            if answer is None:
                a, b = self.names[pair >> 32], self.names[pair & 0xFFFFFFFF]
                answer = holds[pair] = self.v.together(a, b)
            answers[k] = answer
        out[some] = answers[place]
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.raw = [
            bytes([vocabulary.byte_of[i]]) if i in vocabulary.byte_of else p.encode().replace(SPACE.encode(), b" ")
            for i, p in enumerate(vocabulary.pieces)
        ]
        for i, p in enumerate(vocabulary.pieces):
            if p not in vocabulary.scores and i not in vocabulary.byte_of:
                self.raw[i] = b""  # control pieces have no text

        self.sizes = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.table = np.frombuffer(b"".join(self.raw) + b" ", dtype=np.uint8)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def decode_all(self, values: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of many rows: their bytes are taken from one table at once."""
        parts = []
        for low, high in runs(offsets, RUN_PIECES):
            ids, cuts = values[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            sizes = self.sizes[ids]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            taken = np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])
            data = self.table[taken]
            begins, stops = ends[cuts[:-1]], ends[cuts[1:]]
            # The mark before a text's first word is no part of it.
            some = stops > begins
            lead = np.zeros(len(begins), dtype=bool)
            lead[some] = data[begins[some]] == 32
            keep = np.ones(len(data), dtype=bool)
            keep[begins[lead]] = False
            places = np.concatenate([[0], np.cumsum(stops - begins - lead)]).astype(np.int64)
            buffers = [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data[keep].tobytes())]
            texts = pa.Array.from_buffers(pa.large_string(), len(begins), buffers)
            try:
                texts.validate(full=True)
            except pa.ArrowInvalid:  # bytes that are no UTF-8
                texts = pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:])], pa.large_string())
            parts.append(texts)
        return pa.chunked_array(parts, pa.large_string()).cast(pa.string()).combine_chunks() if parts else pa.array([], pa.string())


def runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows with about `most` values, one row at least."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


_IDS = T.StructField("pieces", T.ArrayType(T.IntegerType()))
_TEXT = T.StructField("text", T.StringType())


def encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows with a `text`, and its `pieces`. The vocabulary, a few MB, goes to every task."""
    shared = bounded_batches(rows.sparkSession).sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                found = encoder.encode(batch.column("text").to_pylist())
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "pieces"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, _IDS]))


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows with `pieces`, and the `text` they stand for. Only the table of the pieces' bytes
    goes to the tasks."""
    shared = bounded_batches(rows.sparkSession).sparkContext.broadcast(Decoder(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared.value
        for batch in batches:
            column = batch.column("pieces")
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            columns = [*batch.columns, decoder.decode_all(values, offsets.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, _TEXT]))
