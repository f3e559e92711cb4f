"""Byte-level BPE by the ranks of a public vocabulary: encode whole texts to ids and decode ids to bytes.

A text is cut by the vocabulary's pattern and every piece is merged on its own. Over the byte positions of a piece
stands a segment tree whose leaf p holds the rank of the pair that starts at p (with p in the lower bits, so the least
value is the leftmost pair of the least rank). The root names the next merge; a merge changes the leaves of the pair,
of its right half and of its left neighbour, each a point update up the tree. Pieces of one padded length are merged
side by side, one merge of each per step, with the trees as rows of an array.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.llm.text import by_slices

NONE = np.int64(1) << 62
ROWS_AT_ONCE = 1 << 19  # leaves in the trees that are merged side by side
CACHED = 1 << 17  # pieces in each of the two generations whose ids a Python worker keeps
GROUP = 1 << 19  # characters whose pieces are looked up together
BLOCK = 1 << 16  # pieces of one text handled at a time


class Encoder:
    """Ranks ready for merging, and the ids of pieces seen before."""

    def __init__(self, tokens: list[tuple[bytes, int]], pattern: str):
        self.ranks = dict(tokens)
        self.vocabulary = {r: t for t, r in tokens}
        self.find = regex.compile(pattern)
        pairs: dict[int, int] = {}
        for token, rank in tokens:
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], NONE)
        self.pair_ranks = np.append(np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))[order], 0)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values of the pairs (left, right) that start at the given positions."""
        key = left << 32 | right
        i = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[i] == key, self.pair_ranks[i] << 32 | at, NONE)

    def _merge(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Ids of pieces of at most ``leaves`` bytes, a power of two, four bytes each."""
        n, span = len(pieces), 2 * leaves
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        position = np.arange(leaves)
        filled = position < sizes[:, None]
        symbol = np.full((n, leaves), -1, dtype=np.int64)
        symbol[filled] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        after = np.tile(position + 1, (n, 1))
        before = np.tile(position - 1, (n, 1))
        tree = np.full((n, span), NONE, dtype=np.int64)
        paired = filled[:, 1:]
        tree[:, leaves:-1][paired] = self._leaves(symbol[:, :-1][paired], symbol[:, 1:][paired], np.broadcast_to(position[:-1], paired.shape)[paired])
        level = leaves // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        symbol, after, before, tree = symbol.ravel(), after.ravel(), before.ravel(), tree.ravel()
        rows = np.flatnonzero(tree[1::span] < NONE)
        while len(rows):
            best = tree[rows * span + 1]
            at, merged = best & 0xFFFFFFFF, best >> 32
            first, top = rows * leaves, rows * span
            gone = after[first + at]
            following = after[first + gone]
            symbol[first + at] = merged
            symbol[first + gone] = -1
            after[first + at] = following
            follows = following < sizes[rows]
            before[first[follows] + following[follows]] = at[follows]
            left = before[first + at]
            has_left = left >= 0
            tree[top + leaves + gone] = NONE
            value = np.full(len(rows), NONE, dtype=np.int64)
            value[follows] = self._leaves(merged[follows], symbol[first[follows] + following[follows]], at[follows])
            tree[top + leaves + at] = value
            lf, lt = first[has_left], top[has_left]
            tree[lt + leaves + left[has_left]] = self._leaves(symbol[lf + left[has_left]], merged[has_left], left[has_left])
            for base, leaf in ((top, gone), (top, at), (lt, left[has_left])):
                node = (leaf + leaves) >> 1
                for _ in range(leaves.bit_length() - 1):
                    tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])
                    node >>= 1
            rows = rows[tree[top + 1] < NONE]
        live = symbol >= 0
        flat = symbol[live].astype("<u4").tobytes()
        edges = np.append(0, 4 * np.cumsum(live.reshape(n, leaves).sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip(edges, edges[1:])]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece as little-endian unsigned 32-bit integers; a piece that is a token is that token."""
        out: list[bytes] = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            else:
                by_size.setdefault(1 << max(1, (len(p) - 1).bit_length()), []).append(i)
        for leaves, own in by_size.items():
            step = max(1, ROWS_AT_ONCE // leaves)
            for k in range(0, len(own), step):
                part = own[k : k + step]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _blocks(self, text: str) -> Iterator[list[str]]:
        if len(text) <= GROUP:
            yield self.find.findall(text)
            return
        found = self.find.finditer(text)
        while block := [m.group() for m in islice(found, BLOCK)]:
            yield block

    def _join(self, blocks: list[list[str]]) -> list[bytes]:
        wanted = set().union(*blocks)
        if len(self.cache) + len(wanted) > CACHED:  # what the last generation did not meet again is forgotten
            self.cache, self.older = {}, self.cache
        missing = wanted - self.cache.keys()
        again = missing & self.older.keys()
        self.cache.update((p, self.older[p]) for p in again)
        fresh = list(missing - again)
        self.cache.update(zip(fresh, self.encode_pieces([p.encode() for p in fresh])))
        get = self.cache.__getitem__
        return [b"".join(map(get, block)) for block in blocks]

    def forget(self) -> None:
        self.cache, self.older = {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, without special tokens; null is empty."""
        out: list[bytes] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            text = text or ""
            if held and (size + len(text) > GROUP):
                out += self._join(held)
                held, size = [], 0
            if len(text) > GROUP:
                out.append(b"".join(self._join([block])[0] for block in self._blocks(text)))
                continue
            held.append(next(self._blocks(text)))
            size += len(text)
        return out + self._join(held) if held else out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_encoders: dict[str, Encoder] = {}


def _encoder(tokens: Broadcast, pattern: str, mark: str) -> Encoder:
    if mark not in _encoders:
        _encoders.clear()
        _encoders[mark] = Encoder(tokens.value, pattern)
    return _encoders[mark]


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """Tokens and ranks of a rank file: a base64 token and its rank on every line."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(t), int(r)) for t, r in map(bytes.split, lines) if t]


class Tokenizer:
    """Encoding and decoding as columns. The ranks, of a vocabulary's fixed size, are read once and broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = read_ranks(path)
        self._tokens = spark.sparkContext.broadcast(ranks)
        self._pattern = pattern
        self._mark = hashlib.sha256(repr((len(ranks), path, pattern)).encode()).hexdigest()

    def encode(self, df: DataFrame, text_col: str = "text", out: str = "ids") -> DataFrame:
        """Adds the ids of the whole text (null: empty) as binary, each id four bytes, the least first."""
        tokens, pattern, mark = self._tokens, self._pattern, self._mark

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = _encoder(tokens, pattern, mark)
            for texts in batches:
                yield by_slices(texts, lambda rows: pa.array(encoder.encode(rows), type=pa.binary()))
            encoder.forget()  # a worker lives on after its task

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return df.withColumn(out, F.arrow_udf(run, T.BinaryType())(F.col(text_col)))

    def decode(self, df: DataFrame, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
        """Adds the bytes that the ids stand for; null ids are no ids."""
        tokens, pattern, mark = self._tokens, self._pattern, self._mark

        def run(ids: pa.Array) -> pa.Array:
            decode = _encoder(tokens, pattern, mark).decode
            return by_slices(ids, lambda rows: pa.array([decode(x or b"") for x in rows], type=pa.binary()))

        run.__annotations__ = {"ids": pa.Array, "return": pa.Array}
        return df.withColumn(out, F.arrow_udf(run, T.BinaryType())(F.col(ids_col)))
