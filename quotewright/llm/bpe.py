"""Byte-level BPE encoding and decoding (operator 5).

Each match of the split pattern is merged by itself. A segment tree over its
byte positions holds at every node the smallest (rank, position) of the pairs
below, so its root is the leftmost pair of least rank; a merge changes three
leaves (the pair, its left neighbour, the removed position) and repairs their
paths. Short pieces of one length class are merged together, a numpy row for
each; long ones have a tree of their own.

Nulls and empty texts give no ids. A row is treated by itself, so repeated
rows get equal results, and other columns pass through untouched.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces of up to this many bytes are merged together.
WIDE = 64
#: Pieces a worker remembers before it starts anew.
REMEMBERED = 500_000
_NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder for one vocabulary and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self._slots(pairs)
        self.known: dict[str, tuple[int, ...]] = {}

    def _slots(self, pairs: dict[int, int]) -> None:
        """Open addressing with linear steps, in arrays."""
        bits = max(4, (4 * max(1, len(pairs))).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the joined tokens; _NONE where they do not join."""
        keys = left << 32 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def _encode_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Pieces of at most ``width`` (a power of two) bytes, one tree row each."""
        n, bits = len(pieces), width.bit_length() - 1
        length = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        ids = self.byte_ids[raw]
        place = np.arange(width)
        following = np.where(place + 1 < length[:, None], place + 1, width)
        previous = np.broadcast_to(place - 1, (n, width)).copy()
        alive = place < length[:, None]
        tree = np.full((n, 2 * width), _NONE, np.int64)
        if width > 1:
            rank = self._ranks_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
            real = (following[:, :-1] < width) & (rank != _NONE)
            tree[:, width : 2 * width - 1] = np.where(real, rank << bits | place[:-1], _NONE)
        for level in range(bits - 1, -1, -1):
            k = 1 << level
            below = tree[:, 2 * k : 4 * k]
            tree[:, k : 2 * k] = np.minimum(below[:, ::2], below[:, 1::2])
        live = np.flatnonzero(tree[:, 1] != _NONE)
        while len(live):
            best = tree[live, 1]
            at = best & (width - 1)
            gone = following[live, at]
            after = following[live, gone]
            ids[live, at] = best >> bits
            following[live, at] = after
            alive[live, gone] = False
            self._put(tree, bits, live, gone, np.full(len(live), _NONE, np.int64))
            more = after < width
            previous[live[more], after[more]] = at[more]
            value = np.full(len(live), _NONE, np.int64)
            value[more] = self._keyed(ids[live[more], at[more]], ids[live[more], after[more]], at[more], bits)
            self._put(tree, bits, live, at, value)
            before = previous[live, at]
            has = np.flatnonzero(before >= 0)
            rows, left = live[has], before[has]
            self._put(tree, bits, rows, left, self._keyed(ids[rows, left], ids[rows, at[has]], left, bits))
            live = live[tree[live, 1] != _NONE]
        flat = ids[alive].tolist()
        ends = np.cumsum(alive.sum(axis=1)).tolist()
        return [tuple(flat[i:j]) for i, j in zip([0, *ends], ends)]

    def _keyed(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        rank = self._ranks_of(left, right)
        return np.where(rank == _NONE, _NONE, rank << bits | at)

    @staticmethod
    def _put(tree: np.ndarray, bits: int, rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        """Set one leaf in each row and repair the path to the root."""
        node = at + (1 << bits)
        tree[rows, node] = value
        for _ in range(bits):
            value = np.minimum(value, tree[rows, node ^ 1])
            node = node >> 1
            tree[rows, node] = value

    def _encode_long(self, piece: bytes) -> tuple[int, ...]:
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        none, join = 1 << 62, self.pairs.get
        ids = [int(self.byte_ids[b]) for b in piece]
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * size)

        def key(left: int, right: int) -> int:
            rank = join(ids[left] << 32 | ids[right])
            return none if rank is None else rank * size + left

        def put(at: int, value: int) -> None:
            node = at + size
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                value = other if other < value else value
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        for i in range(n - 1):
            tree[size + i] = key(i, i + 1)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while (best := tree[1]) != none:
            rank, at = divmod(best, size)
            gone = following[at]
            after = following[gone]
            ids[at], following[at] = rank, after
            put(gone, none)
            put(at, key(at, after) if after < n else none)
            if after < n:
                previous[after] = at
            if previous[at] >= 0:
                put(previous[at], key(previous[at], at))
        found, p = [], 0
        while p < n:
            found.append(ids[p])
            p = following[p]
        return tuple(found)

    def _learn(self, pieces: set[str]) -> None:
        by_width: dict[int, list[str]] = {}
        for piece in pieces:
            n = len(piece.encode())
            width = 1 << (n - 1).bit_length()
            if width > WIDE:
                self.known[piece] = self._encode_long(piece.encode())
            else:
                by_width.setdefault(width, []).append(piece)
        for width, group in by_width.items():
            for i in range(0, len(group), 4096):
                part = group[i : i + 4096]
                self.known.update(zip(part, self._encode_rows([p.encode() for p in part], width)))

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        split = [self.split(text) for text in texts]
        self._learn(set(chain.from_iterable(split)) - self.known.keys())
        for pieces in split:
            yield list(chain.from_iterable(map(self.known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """One codec for each vocabulary and worker process."""
    key = (shared.id if hasattr(shared, "id") else id(shared), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value, pattern)
    return _codecs[key]


#: Characters encoded at a time, unless one text alone is longer.
_PART = 1 << 20


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > _PART:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _digest_batches(shared, pattern: str):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches):
        codec = _codec(shared, pattern)
        for batch in batches:
            out = []
            for part in _parts([t or "" for t in batch.column(1).to_pylist()]):
                for ids in codec.encode_batch(part):
                    joined = " ".join(map(codec.names.__getitem__, ids))
                    out.append(
                        (len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest())
                    )
            counts, first, second = zip(*out) if out else ((), (), ())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """All columns of ``docs`` plus ``token_ids array<int>`` of the whole ``text``.

    ``vocabulary`` is the path of a rank file on the driver; the ranks, of
    fixed size, are broadcast. A column named ``token_ids`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    @F.pandas_udf("array<int>")
    def ids_of(texts):
        import pandas as pd

        codec = _codec(shared, pattern)
        return pd.Series([ids for part in _parts([t or "" for t in texts]) for ids in codec.encode_batch(part)], dtype=object)

    return docs.withColumn("token_ids", ids_of(F.coalesce("text", F.lit(""))))


def decode(df: DataFrame, vocabulary: str) -> DataFrame:
    """All columns plus ``decoded binary``: the bytes that ``token_ids`` stand for (null: none)."""
    tokens = {rank: token for token, rank in read_ranks(vocabulary).items()}
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    @F.pandas_udf("binary")
    def bytes_of(ids):
        import pandas as pd

        known = shared.value
        return pd.Series([b"".join(known[i] for i in row) for row in ids], dtype=object)

    return df.withColumn("decoded", bytes_of(F.coalesce("token_ids", F.array().cast("array<int>"))))


def encode_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Ids of the whole texts and the decoded bytes, as counts and digests, in one pass without an exchange."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _digest_batches(shared, pattern),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
