"""Token counts of whole texts by a public piece vocabulary (BPE over characters with byte fallback).

Texts are cut into pre-tokens that no merge can cross: before the first space of a run of spaces, and around control
characters that no piece holds. The pre-tokens of a batch lie end to end in one array of symbols with the rank of the
pair that starts at every place beside it. A round takes the lowest rank of every pre-token at once, merges its pairs
and drops what was swallowed; pre-tokens without a pair left are counted and leave the arrays.

A pair of the lowest rank is merged in all its places in one round only if no pair with the merged piece could have a
rank as low; else the leftmost place alone is merged, as one merge after the other would do.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.llm.text import by_slices

MARK = "▁"  # stands for a space
CONTROL = "\t\n\r"
NONE = np.int32(1) << 30
CACHED = 1 << 17  # pre-tokens in each of the two generations whose counts a Python worker keeps
GROUP = 1 << 19  # characters whose pre-tokens are looked up together
BATCH = 1 << 19  # symbols merged side by side
LONG = 1 << 12  # a pre-token of more symbols is merged with a heap: it would take too many rounds


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces that merges can make, with their scores (higher merges earlier).

    Fails for a vocabulary with other rules than those used here: texts unchanged but for a mark in place of every space
    and one more in front, unknown characters as bytes, no unused pieces.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    if model.normalize(" a  ﬁ ") != f"{MARK * 2}a{MARK * 2}ﬁ{MARK}":
        raise ValueError("the vocabulary changes texts before they are cut")
    if any(model.is_unused(i) for i in ids) or sum(model.is_byte(i) for i in ids) != 256:
        raise ValueError("a vocabulary with all bytes and no unused pieces is needed")
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Counter:
    """Merge table of a vocabulary and the counts of pre-tokens seen before."""

    def __init__(self, pieces: list[tuple[str, float]]):
        names = dict.fromkeys(p for p, _ in pieces)
        for p, _ in pieces:
            names.update(dict.fromkeys(p))
        number = {p: i for i, p in enumerate(names)}
        known = {p for p, _ in pieces}
        first_unknown = len(number)  # four more symbols stand for unknown characters by their number of bytes
        self.weight = np.array([1 if p in known else len(p.encode()) for p in names] + [1, 2, 3, 4], dtype=np.int64)
        self.symbol = np.full(0x110000, first_unknown + 3, dtype=np.int32)
        for limit, size in ((0x10000, 3), (0x800, 2), (0x80, 1)):
            self.symbol[:limit] = first_unknown + size - 1
        for p, i in number.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.symbol[ord(" ")] = self.symbol[ord(MARK)]
        rank_of = {s: r for r, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        ranks = {p: rank_of[s] for p, s in pieces}
        merges: dict[int, tuple[int, int]] = {}
        bold = np.ones(first_unknown + 4, dtype=bool)  # pieces that no later pair of as low a rank can hold
        for p, r in ranks.items():
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in number and b in number:
                    merges[number[a] << 32 | number[b]] = (r, number[p])
                    for half in (a, b):
                        if len(half) > 1 and ranks[half] >= r:
                            bold[number[half]] = False
        self.bold = bold
        self._fill(merges)
        chars = set().union(*known) if known else set()
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in known):
            raise ValueError("pieces with a space inside are not handled")
        alone = "".join(c for c in CONTROL if c not in chars)
        inside = re.escape(" " + alone)
        self.find = re.compile(f"[{re.escape(alone)}]| +[^{inside}]*|[^{inside}]+" if alone else " +[^ ]*|[^ ]+")
        self.cache: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.merges: dict[int, tuple[int, int]] | None = None  # of the heap form, made when first needed

    def _fill(self, merges: dict[int, tuple[int, int]]) -> None:
        """Open hash table: a pair's key lies at most ``reach`` places after its hash."""
        keys = np.fromiter(merges, dtype=np.int64, count=len(merges))
        values = np.array(list(merges.values()), dtype=np.int32).reshape(-1, 2)
        self.bits = max(4, (8 * len(keys)).bit_length())
        size = (1 << self.bits) + len(keys) + 1
        self.keys = np.full(size, -1, dtype=np.int64)
        self.rank, self.made = np.full(size, NONE, dtype=np.int32), np.zeros(size, dtype=np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        self.reach = 0
        while len(left):
            self.reach += 1
            free = left[self.keys[at[left]] < 0]
            places, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[places], self.rank[places], self.made[places] = keys[won], values[won, 0], values[won, 1]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] += 1

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table places of the pairs (left, right); place -1, the last one, holds no pair."""
        key = left.astype(np.int64) << 32 | right
        at = self._place(key)
        found = np.where(self.keys[at] == key, at, -1)
        open_ = np.flatnonzero((found < 0) & (self.keys[at] >= 0))
        for step in range(1, self.reach):
            if not len(open_):
                break
            there = self.keys[at[open_] + step]
            hit = there == key[open_]
            found[open_[hit]] = at[open_[hit]] + step
            open_ = open_[~hit & (there >= 0)]
        return found

    def _one(self, symbols: list[int]) -> int:
        """Count for a single sequence, merged one pair after the other, the leftmost of the lowest rank first."""
        if self.merges is None:
            held = np.flatnonzero(self.keys >= 0)
            self.merges = dict(zip(self.keys[held].tolist(), zip(self.rank[held].tolist(), self.made[held].tolist())))
        table = self.merges
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (hit := table.get(symbols[i] << 32 | symbols[after[i]])):
                heapq.heappush(heap, (hit[0], i, symbols[i], symbols[after[i]], hit[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return int(sum(self.weight[s] for s in symbols if s >= 0))

    def _merge(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Counts of the sequences that lie end to end in ``symbols``."""
        counts = np.zeros(len(sizes), dtype=np.int64)
        own = np.repeat(np.arange(len(sizes)), sizes)
        at = np.full(len(symbols), -1, dtype=np.int64)
        joined = np.flatnonzero(own[1:] == own[:-1])
        at[joined] = self._lookup(symbols[joined], symbols[joined + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            rank = self.rank[at]
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            done = np.repeat(lowest >= NONE, lengths)
            if done.any():
                np.add.at(counts, own[done], self.weight[symbols[done]])
                going = ~done
                symbols, own, at, rank = symbols[going], own[going], at[going], rank[going]
                lengths, lowest = lengths[lowest < NONE], lowest[lowest < NONE]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
            made = self.made[at[hit]]
            new_row = np.append(True, own[hit[1:]] != own[hit[:-1]])
            # Of pairs that overlap, the first of each two; of pieces that are not bold, the leftmost of the row.
            run = np.append(True, np.diff(hit) != 1) | new_row
            place = np.arange(len(hit))
            odd = (place - np.maximum.accumulate(np.where(run, place, 0))) & 1
            timid = np.logical_or.reduceat(~self.bold[made], np.flatnonzero(new_row))
            take = np.where(np.repeat(timid, np.diff(np.append(np.flatnonzero(new_row), len(hit)))), new_row, odd == 0)
            hit, made = hit[take], made[take]
            symbols[hit] = made
            live = np.ones(len(symbols), dtype=bool)
            live[hit + 1] = False
            shift = np.cumsum(live) - 1
            symbols, own, at = symbols[live], own[live], at[live]
            hit = shift[hit]
            changed = np.zeros(len(symbols) + 1, dtype=bool)  # the entry past the end takes what lies before the start
            changed[hit] = changed[hit - 1] = True
            renew = np.flatnonzero(changed[:-1])
            at[renew] = -1
            renew = renew[:-1] if len(renew) and renew[-1] + 1 == len(symbols) else renew
            renew = renew[own[renew] == own[renew + 1]]
            at[renew] = self._lookup(symbols[renew], symbols[renew + 1])
        return counts

    def count_pieces(self, pieces: list[str]) -> list[int]:
        """Number of tokens of every pre-token, a space standing for the mark."""
        out = [0] * len(pieces)
        held: list[int] = []
        size = 0

        def flush() -> None:
            symbols = self.symbol[np.frombuffer("".join(pieces[i] for i in held).encode("utf-32-le"), dtype="<u4")]
            for i, n in zip(held, self._merge(symbols, np.array([len(pieces[i]) for i in held])).tolist()):
                out[i] = n

        for i, p in enumerate(pieces):
            n = len(p)
            if n > LONG:
                out[i] = self._one(self.symbol[np.frombuffer(p.encode("utf-32-le"), dtype="<u4")].tolist())
                continue
            if held and size + n > BATCH:
                flush()
                held, size = [], 0
            held.append(i)
            size += n
        if held:
            flush()
        return out

    def _counts(self, found: list[list[str]]) -> list[int]:
        wanted = set().union(*found)
        if len(self.cache) + len(wanted) > CACHED:  # what the last generation did not meet again is forgotten
            self.cache, self.older = {}, self.cache
        missing = wanted - self.cache.keys()
        again = missing & self.older.keys()
        self.cache.update((p, self.older[p]) for p in again)
        fresh = list(missing - again)
        self.cache.update(zip(fresh, self.count_pieces(fresh)))
        get = self.cache.__getitem__
        return [sum(map(get, f)) for f in found]

    def forget(self) -> None:
        self.cache, self.older = {}, {}

    def _long(self, text: str) -> int:
        total, held, size = 0, [], 0
        for m in self.find.finditer(text):
            held.append(m.group())
            size += len(held[-1])
            if size > GROUP:
                total += self._counts([held])[0]
                held, size = [], 0
        return total + (self._counts([held])[0] if held else 0)

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of whole texts; null and the empty text have none."""
        out: list[int] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            text = " " + text.replace(MARK, " ") if text else ""
            if held and size + len(text) > GROUP:
                out += self._counts(held)
                held, size = [], 0
            if len(text) > GROUP:
                out.append(self._long(text))
                continue
            held.append(self.find.findall(text))
            size += len(text)
        return out + self._counts(held) if held else out


_counters: dict[str, Counter] = {}


def _counter(pieces: Broadcast, mark: str) -> Counter:
    if mark not in _counters:
        _counters.clear()
        _counters[mark] = Counter(pieces.value)
    return _counters[mark]


def count_tokens(df: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of the whole text by the vocabulary at ``path``, without begin and end tokens.

    Null and empty texts have 0. Rows are independent, so repeated rows, missing ids and empty tables need no rule, and
    further columns stay as they are; a column named ``out`` is replaced. The pieces, of a vocabulary's fixed size, are
    read once and broadcast. A text is one Python string in its task, its pre-tokens are handled in groups.
    """
    spark: SparkSession = df.sparkSession
    pieces = read_pieces(path)
    sent = spark.sparkContext.broadcast(pieces)
    mark = hashlib.sha256(repr(pieces).encode()).hexdigest()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(sent, mark)
        for texts in batches:
            yield by_slices(texts, lambda rows: pa.array(counter.count(rows), type=pa.int64()))
        counter.forget()  # a worker lives on after its task

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(out, F.arrow_udf(run, T.LongType())(F.col(text_col)))
