"""Best-fit packing of token sequences.

Texts are tokenized where they are read, cut into pieces only where they exceed the capacity, spread by
content over tasks, and packed there by best-fit decreasing: a segment tree over remaining capacities
finds the tightest open sequence in logarithmic time. A task packs ``CHUNK`` pieces at a time, so its
memory is bounded whatever lands in it, and leaves at most one loose sequence a chunk.

Null text counts as empty and gives one piece, the end token alone. Each row is packed by itself, so
repeated rows are packed as often as they occur; an empty table gives an empty one. A text of any
length is tokenized whole and cut into as many pieces as it needs.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.batches import bounded, give_back

CAPACITY = 4096
END_ID = 1
CHUNK = 16_384  # pieces packed at a time
CHUNK_BYTES = 64 << 20
PIECES_KEPT = 1_000_000  # pieces whose ids a task remembers
SEGMENT = 1 << 20  # bytes of text looked at together
ROWS_OUT = 512

SPACE = re.compile(rb"[\t-\r ]")
LETTER, DIGIT, OTHER = 1, 2, 3
KINDS = np.full(256, OTHER, np.uint8)  # of a byte of plain text
KINDS[[*range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = LETTER
KINDS[0x30:0x3A] = DIGIT
KINDS[[*range(9, 14), 32]] = 0
FACTOR = 0x9E3779B97F4A7C15 | 1
COEFFICIENTS = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)


class PieceTokenizer:
    """Token ids by the ``tokenizers`` library, remembered by piece.

    Only for tokenizers that lower-case, drop white space, take runs of letters, single digits and runs
    of other signs as pieces, and mark the last token of a piece: a text's ids are then its pieces' ids
    in order. Texts of plain Latin letters and ASCII signs (where normal form C changes nothing) are
    cut into those pieces with numpy; of other texts the words go through the library's own steps.

    Pieces are looked up by a 64-bit polynomial hash from prefix sums, and every piece is compared byte by
    byte with the one its hash led to; a batch in which any differs goes to the library as it is. Ids of
    known pieces are gathered from one array; the library's model gets the new pieces of a batch at once.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.last = np.zeros(self.library.get_vocab_size(), bool)
        for token, number in self.library.get_vocab().items():
            self.last[number] = token.endswith("</w>")
        self.dtype = np.dtype(dtype)
        self.odd = re.compile("['\x80-©«-´¶-¹»-¿×÷İ\u0250-\U0010ffff]|<\\|").search
        self.split = re.compile(r"[^\W\d_]+|\d|[\W_]+").findall
        self.keys = np.zeros(0, np.uint64)  # ascending
        self.first, self.count, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, self.dtype)
        self.at, self.size = (np.zeros(0, np.int64) for _ in range(2))  # of a known piece's bytes
        self.bytes = np.zeros(0, np.uint8)
        self.batch = 0
        self.power = self.inverse = np.ones(1, np.uint64)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, self.dtype).tobytes() for e in found]

    def _model(self, pieces: list[str]) -> list[bytes]:
        joined = [" ".join(pieces[at : at + 1000]) for at in range(0, len(pieces), 1000)]
        found = self.model.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.array([i for e in found for i in e.ids], self.dtype)
        cuts = ((np.flatnonzero(self.last[ids]) + 1) * self.dtype.itemsize).tolist()
        raw = ids.tobytes()
        out = [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        if len(out) != len(pieces):
            raise ValueError("this tokenizer does not mark the last token of each piece")
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of texts that are not plain."""
        cut = [None if self.odd(w) else self.split(w.lower()) for w in words]
        pieces = list({p for ps in cut if ps for p in ps})
        known = dict(zip(pieces, self._model(pieces)))
        rest = iter(self._library([w for w, ps in zip(words, cut) if ps is None]))
        return [next(rest) if ps is None else b"".join([known[p] for p in ps]) for ps in cut]

    def _hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        while len(self.power) < len(data):
            n = np.uint64(len(self.power))
            step, back = pow(FACTOR, int(n), 1 << 64), pow(pow(FACTOR, -1, 1 << 64), int(n), 1 << 64)
            self.power = np.concatenate([self.power, self.power * np.uint64(step)])
            self.inverse = np.concatenate([self.inverse, self.inverse * np.uint64(back)])
        sums = np.zeros(len(data) + 1, np.uint64)
        np.multiply(COEFFICIENTS[data], self.power[: len(data)], out=sums[1:])
        np.cumsum(sums, out=sums)
        return (sums[end] - sums[start]) * self.inverse[start]

    def _learn(self, keys: np.ndarray, found: list[bytes], spelled: np.ndarray, size: np.ndarray) -> None:
        """Adds new ``keys``, ascending, with their pieces' bytes; beyond ``PIECES_KEPT`` those not used
        for longest go."""
        if len(self.keys) > PIECES_KEPT:
            kept = self.used >= np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
            if kept.all():
                kept = self.used == self.batch
            self.ids, self.first = _gather(self.ids, self.first[kept], self.count[kept])
            self.bytes, self.at = _gather(self.bytes, self.at[kept], self.size[kept])
            self.keys, self.count, self.used, self.size = self.keys[kept], self.count[kept], self.used[kept], self.size[kept]
        at = np.searchsorted(self.keys, keys)
        count = np.array([len(x) for x in found], np.int64) // self.dtype.itemsize
        first = len(self.ids) + np.cumsum(count) - count
        self.keys, self.first, self.count = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.count, at, count)
        self.used = np.insert(self.used, at, self.batch)
        begin = len(self.bytes) + np.cumsum(size) - size
        self.at, self.size = np.insert(self.at, at, begin), np.insert(self.size, at, size)
        self.bytes = np.concatenate([self.bytes, spelled])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), self.dtype)])

    def _batch(self, parts: list[bytes], plain: bool) -> list[bytes]:
        self.batch += 1
        raw = b"\n".join(parts) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        kind = (KINDS if plain else np.minimum(KINDS, 1))[data]
        single = kind == DIGIT if plain else np.zeros(len(kind), bool)
        changes = np.flatnonzero(kind[1:] != kind[:-1]) + 1 if not single.any() else np.flatnonzero((kind[1:] != kind[:-1]) | single[1:]) + 1
        bounds = np.concatenate([[0], changes, [len(data)]])
        inside = kind[bounds[:-1]] != 0
        start, end = bounds[:-1][inside], bounds[1:][inside]
        keys, where, inverse = np.unique(self._hashes(data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inner = at < len(self.keys)
        known[inner] = self.keys[at[inner]] == keys[inner]
        self.used[at[known]] = self.batch
        size = end - start
        same = _equal(data, start, size, data, start[where][inverse], size[where][inverse])
        if not same or not _equal(data, start[where[known]], size[where[known]], self.bytes, self.at[at[known]], self.size[at[known]]):
            return self._library([part.decode("utf-8", "surrogatepass") for part in parts])
        if not known.all():
            fresh = where[~known]
            texts = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[fresh].tolist(), end[fresh].tolist())]
            found = self._model(texts) if plain else self._words(texts)
            self._learn(keys[~known], found, _gather(data, start[fresh], size[fresh])[0], size[fresh])
            at = np.searchsorted(self.keys, keys)
        at = at[inverse]
        ids, first = _gather(self.ids, self.first[at], self.count[at])
        edges = np.cumsum([len(p) + 1 for p in parts])
        cuts = np.append(first, len(ids))[np.searchsorted(start, edges)].tolist()
        out, size = ids.tobytes(), self.dtype.itemsize
        return [out[a * size : b * size] for a, b in zip([0, *cuts], cuts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without an end, as bytes of ``dtype``."""
        found = [[] for _ in texts]
        for plain in (True, False):
            rows, parts, size = [], [], 0
            for row, text in enumerate(texts):
                strange = "'" in text or "<|" in text if text.isascii() else bool(self.odd(text))
                if strange == plain:
                    continue
                for part in _segments(text.lower().encode() if plain else text.encode("utf-8", "surrogatepass")):
                    rows.append(row)
                    parts.append(part)
                    size += len(part)
                    if size >= SEGMENT:
                        for r, ids in zip(rows, self._batch(parts, plain)):
                            found[r].append(ids)
                        rows, parts, size = [], [], 0
            if parts:
                for r, ids in zip(rows, self._batch(parts, plain)):
                    found[r].append(ids)
        return [b"".join(x) for x in found]


def _gather(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` one after another, and where each begins."""
    to = np.cumsum(count)
    at = to - count
    return values[np.repeat(first - at, count) + np.arange(to[-1] if len(to) else 0)], at


def _equal(ours: np.ndarray, at: np.ndarray, size: np.ndarray, theirs: np.ndarray, there: np.ndarray, length: np.ndarray) -> bool:
    """Whether the runs of ``ours`` equal those of ``theirs``, one by one."""
    if not np.array_equal(size, length):
        return False
    return np.array_equal(_gather(ours, at, size)[0], _gather(theirs, there, length)[0])


def _segments(data: bytes) -> list[bytes]:
    """Parts of about SEGMENT bytes at most, cut at white space where there is any."""
    parts, at = [], 0
    while len(data) - at > SEGMENT:
        space = SPACE.search(data, at + SEGMENT)
        if not space:
            break
        parts.append(data[at : space.start()])
        at = space.end()
    return [*parts, data[at:]]


def _width(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", dtype: str = "<u4"
) -> DataFrame:
    """(key, piece, start, length, ids): the token ids of each row, END_ID last, in pieces.

    ``ids`` is binary, little-endian unsigned of ``dtype``.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    size = np.dtype(dtype).itemsize
    end = np.asarray([END_ID], dtype).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceTokenizer(tokenizer, dtype)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(at, ROWS_OUT)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows, piece, start, length, ids = [], [], [], [], []
                for row, found in enumerate(encoder.encode(texts)):
                    found += end
                    total = len(found) // size
                    for nth, first in enumerate(range(0, total, capacity)):
                        last = min(first + capacity, total)
                        rows.append(row)
                        piece.append(nth)
                        start.append(first)
                        length.append(last - first)
                        ids.append(found[first * size : last * size])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=[key, "piece", "start", "length", "ids"],
                )
            batch = whole = None
        encoder = None
        give_back()

    return bounded(docs.select(key, F.col(text).alias("text"))).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, by best-fit decreasing.

    The tree's leaves are remaining capacities; a node counts the open sequences below it. The tightest
    fit is the first leaf at or after the length that has any.
    """
    leaves = 1 << capacity.bit_length()
    tree = [0] * (2 * leaves)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        node = leaves + length
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node > 1:
                node += 1
                while node < leaves:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
        if node > 1:
            left = node - leaves
            into = waiting[left].pop()
            while node:
                tree[node] -= 1
                node >>= 1
        else:
            into, left = opened, capacity
            opened += 1
        sequence[i] = into
        offset[i] = capacity - left
        left -= length
        if left:
            waiting[left].append(into)
            node = leaves + left
            while node:
                tree[node] += 1
                node >>= 1
    return sequence, offset


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, piece, start, length, ids, sequence_id, offset): every piece and its place.

    ``ids`` is binary, little-endian unsigned 32-bit. ``sequence_id`` holds the task in its high bits,
    so it is unique without any exchange.
    """
    dtype = _width(tokenizer)
    cut = pieces(docs, tokenizer, capacity, key, text, dtype)
    spread = cut.repartition(F.xxhash64(key, "piece", "ids"))
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36

        def packed(held: list[pa.RecordBatch], opened: int) -> Iterator[pa.RecordBatch]:
            lengths = np.concatenate([b.column(3).to_numpy() for b in held])
            sequence, offset = best_fit(lengths, capacity)
            at = 0
            for batch in held:
                to = at + batch.num_rows
                wide = [np.frombuffer(x, dtype).astype("<u4").tobytes() for x in batch.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:4],
                        pa.array(wide, pa.binary()),
                        pa.array(sequence[at:to] + opened),
                        pa.array(offset[at:to]),
                    ],
                    names=schema.names,
                )
                at = to

        held: list[pa.RecordBatch] = []
        rows = size = 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(at, ROWS_OUT)
                held.append(batch)
                rows += batch.num_rows
                size += int(np.sum(batch.column(3).to_numpy())) * np.dtype(dtype).itemsize
                if rows >= CHUNK or size >= CHUNK_BYTES:
                    yield from packed(held, opened)
                    opened += rows
                    held, rows, size = [], 0, 0
        if held:
            yield from packed(held, opened)
        batch = whole = held = None
        give_back()

    return bounded(spread).mapInArrow(place, schema)
