"""Prefix trie of conversations from their sorted order.

Every conversation is one binary key: 20 bytes a turn, the MD5 of role and text and the words of the text. Equal keys are
one sequence. Sequences are sorted by range over the partitions; between neighbours stands an edge with the length of
their common prefix. A task joins its sequences by union-find over these edges in descending depth: the merge of two
components at depth d makes the branching node of depth d, or adds a child to it.

What a task cannot finish are the nodes on the paths of its first and its last sequence, which may go on in other tasks.
These paths, with sums over everything finished that hangs on them, are the contracted forest of the partition. Forests
of neighbouring partitions are merged in groups by union-find over the edges between them, again in descending depth, and
contracted to the two outer paths, until one forest is left. Its size depends on the depth of the trie, not on its nodes.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricecast.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
TURN = 20  # bytes of a key that stand for a turn
PER_TASK = 50_000  # conversations sorted in one task, at most about
FAN = 64  # neighbouring forests merged in one task
RUN = 1_000  # ids joined into one text before they are hashed

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
OPEN = "id long, up long, first boolean, last boolean, turn binary, prefix binary, above binary"
STATE = f"part long, kind string, {NODE}, {OPEN}"
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_token(role: Column, text: Column) -> Column:
    """20 bytes for a turn: equal for equal role and text (null: empty), with the number of words in the last four."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.lpad(F.lower(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long"))), 8, "0")
    return F.concat(F.md5(both.cast("binary")), words)


def as_sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the hexadecimal tokens of every conversation in order.

    Rows are ordered by turn, null first, and rows of one turn by their token. Rows without a conv_id take no part. A
    conversation is one row, with 40 bytes a turn and none of its text.
    """
    token = turn_token(F.col("role"), F.col("text"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), token.alias("token")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.col("t.token").alias("turns"))


def rebuilt(turns: DataFrame, share: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, turns) with the first h turns of every conversation c taken from conversation c - c % share.

    h is the unsigned CRC32 of the decimal id modulo ``most``; the remainder c % share has the sign of c. A base with fewer turns gives all it has, a missing one
    gives none, and a conversation loses its own first h turns.
    """
    own = materialise(as_sequences(turns), "conversations")
    heads = own.filter(F.col("conv_id") % share == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % share).withColumn("h", h).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    return both.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _shared(a: bytes, b: bytes) -> int:
    """Turns at the start that two keys have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // TURN


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to (key, conv_id, n, ids): up to RUN ids of one key joined by commas, the first named."""
    key, ids = None, []

    def row():
        return key, ids[0], len(ids), ",".join(map(str, ids))

    for batch in batches:
        out = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key or len(ids) >= RUN:
                if ids:
                    out.append(row())
                key, ids = k, []
            ids.append(c)
        yield _batch(out, ("key", "conv_id", "n", "ids"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))
    if ids:
        yield _batch([row()], ("key", "conv_id", "n", "ids"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))


def _batch(rows: list[tuple], names, types) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=list(names))


class Forest:
    """Nodes of a trie with their own numbers and sums over their subtrees, parents by number."""

    def __init__(self):
        self.up: list[int] = []
        self.depth: list[int] = []
        self.words: list[int] = []  # of the last text
        self.n: list[int] = []
        self.conv: list[int] = []
        self.children: list[int] = []
        self.leaves: list[int] = []
        self.saved: list[int] = []
        self.ends: list[str | None] = []

    def add(self, depth: int, words: int, n: int = 0, conv: int = 1 << 62, ends: str | None = None) -> int:
        self.up.append(-1)
        self.depth.append(depth)
        self.words.append(words)
        self.n.append(n)
        self.conv.append(conv)
        self.children.append(0)
        self.leaves.append(0)
        self.saved.append(0)
        self.ends.append(ends)
        return len(self.up) - 1

    def hang(self, child: int, parent: int) -> None:
        self.up[child] = parent
        self.n[parent] += self.n[child]
        self.conv[parent] = min(self.conv[parent], self.conv[child])

    def path(self, v: int) -> list[int]:
        """From the root down to v."""
        out = []
        while v >= 0:
            out.append(v)
            v = self.up[v]
        return out[::-1]

    def finish(self, is_open: set[int]) -> list[int]:
        """Sums over subtrees from the deepest node up; open nodes get only what is finished below them. Returns the order."""
        order = sorted(range(len(self.up)), key=lambda v: -self.depth[v])
        for v in order:
            if v in is_open:
                continue
            self.leaves[v] += not self.children[v]
            self.saved[v] += (self.n[v] - 1) * self.words[v]
            u = self.up[v]
            if u >= 0:
                self.children[u] += 1
                self.leaves[u] += self.leaves[v]
                self.saved[u] += self.saved[v]
        return order


def _words(key: bytes, depth: int) -> int:
    return int.from_bytes(key[depth * TURN - 4 : depth * TURN], "big") if depth else 0


def _grow(keys: list[bytes], counts: list[int], firsts: list[int], hashes: list[str]) -> Forest:
    """Trie of sorted distinct sequences; the first nodes are the sequences, in their order."""
    forest = Forest()
    tops = [forest.add(len(k) // TURN, _words(k, len(k) // TURN), n, c, h) for k, n, c, h in zip(keys, counts, firsts, hashes)]
    inside = list(keys)  # of every node, a sequence below it
    links = list(range(len(keys)))

    def find(i: int) -> int:
        while links[i] != i:
            links[i] = links[links[i]]
            i = links[i]
        return i

    edges = [_shared(a, b) for a, b in zip(keys, keys[1:])]
    for i in sorted(range(len(edges)), key=lambda i: -edges[i]):  # of equal depth, from the left
        d, left, right = edges[i], find(i), find(i + 1)
        top = tops[left]
        if forest.depth[top] > d:
            top = forest.add(d, _words(keys[i], d))
            inside.append(keys[i])
            forest.hang(tops[left], top)
        forest.hang(tops[right], top)
        links[right] = left
        tops[left] = top
    top = tops[find(0)]
    if forest.depth[top]:
        root = forest.add(0, 0)
        inside.append(b"")
        forest.hang(top, root)
    for v in range(len(forest.up)):  # nodes with one child only
        u = forest.up[v]
        below = v
        for d in range(forest.depth[v] - 1, forest.depth[u] if u >= 0 else forest.depth[v], -1):
            w = forest.add(d, _words(inside[v], d), forest.n[v], forest.conv[v])
            forest.up[below] = w
            below = w
        forest.up[below] = u
    return forest


_NAMES = [c.split(" ")[0] for c in STATE.split(", ")]
_TYPES = [{"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split(" ")[1]] for c in STATE.split(", ")]


def _rows(part: int, forest: Forest, first: list[int], last: list[int], marks: dict[int, tuple[bytes, bytes]]) -> Iterator[tuple]:
    """State rows. marks: of the nodes that are or were open, the last turn and the hash of the prefix."""
    starts, stops = set(first), set(last)
    is_open = starts | stops
    for v in forest.finish(is_open):
        u = forest.up[v]
        turn, prefix = marks.get(v, (None, None))
        above = marks[u][1] if u in is_open else None
        kind = "open" if v in is_open else "waits" if u in is_open else "done"
        own = (forest.conv[v], forest.depth[v], forest.conv[u] if u >= 0 and kind == "done" else None)
        sums = (forest.n[v], forest.children[v], forest.leaves[v], forest.saved[v], forest.ends[v] or (None if kind == "open" else EMPTY))
        yield (part, kind, *own, *sums, v, u, v in starts, v in stops, turn, prefix, above)


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of a partition to its finished nodes and its contracted forest."""
    keys, counts, firsts, hashes = [], [], [], []
    digest = None
    for batch in batches:
        for k, c, n, ids in zip(*(batch.column(x).to_pylist() for x in ("key", "conv_id", "n", "ids"))):
            if not keys or k != keys[-1]:
                if digest:
                    hashes.append(digest.hexdigest())
                keys.append(k)
                counts.append(0)
                firsts.append(c)
                digest = hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
            counts[-1] += n
    if not keys:
        return
    hashes.append(digest.hexdigest())
    forest = _grow(keys, counts, firsts, hashes)
    first, last = forest.path(0), forest.path(len(keys) - 1)
    marks = {}
    for path, key in ((first, keys[0]), (last, keys[-1])):
        so_far = hashlib.md5()
        for v in path:  # one node for every depth
            d = forest.depth[v]
            turn = key[max(0, d - 1) * TURN : d * TURN]
            so_far.update(turn)
            marks[v] = (turn, so_far.digest())
    held = []
    for row in _rows(TaskContext.get().partitionId(), forest, first, last, marks):
        held.append(row)
        if len(held) == 10_000:
            yield _batch(held, _NAMES, _TYPES)
            held = []
    yield _batch(held, _NAMES, _TYPES)


def _merge(final: bool):
    """Merges the contracted forests of neighbouring parts into one; all its nodes are finished if it is the final one."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["part", "depth"], kind="stable").to_dict("records")
        links = list(range(len(rows)))

        def find(i: int) -> int:
            while links[i] != i:
                links[i] = links[links[i]]
                i = links[i]
            return i

        place, starts, stops = {}, defaultdict(list), defaultdict(list)
        for i, r in enumerate(rows):
            place[r["part"], r["id"]] = i
            if r["first"]:
                starts[r["part"]].append(i)
            if r["last"]:
                stops[r["part"]].append(i)
        parts = list(starts)
        edges = []
        for before, behind in zip(parts, parts[1:]):
            for i, j in zip(stops[before], starts[behind]):  # both from the root down
                if rows[i]["turn"] != rows[j]["turn"]:
                    break
                edges.append((rows[i]["depth"], i, j))
        for _, i, j in sorted(edges, key=lambda e: -e[0]):
            i, j = find(i), find(j)
            links[max(i, j)] = min(i, j)

        forest, number, marks = Forest(), {}, {}
        for i, r in enumerate(rows):
            at = find(i)
            if at not in number:
                turn = bytes(r["turn"])
                v = number[at] = forest.add(int(r["depth"]), int.from_bytes(turn[-4:], "big"))
                marks[v] = (turn, bytes(r["prefix"]))
                forest.up[v] = number[find(place[r["part"], r["up"]])] if r["up"] >= 0 else -1
            v = number[at]
            forest.n[v] += int(r["n_convs"])
            forest.conv[v] = min(forest.conv[v], int(r["conv_id"]))
            forest.children[v] += int(r["n_children"])
            forest.leaves[v] += int(r["n_leaves"])
            forest.saved[v] += int(r["saved_tokens"])
            forest.ends[v] = forest.ends[v] or r["ends_sha256"]
        first = [] if final else [number[find(i)] for i in starts[parts[0]]]
        last = [] if final else [number[find(i)] for i in stops[parts[-1]]]
        out = list(_rows(int(parts[0]) // FAN, forest, first, last, marks))
        return pd.DataFrame(out, columns=_NAMES).astype({"parent_conv_id": "Int64"})

    return merge


def trie(sequences: DataFrame) -> DataFrame:
    """One row for every distinct prefix of the sequences (conv_id, turns), the empty prefix being the root.

    Returns conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Repeated rows of a conv_id count as further members. No rows give no nodes, not even a
    root. A task sorts about 50,000 conversations; equal ones are one sequence there, and their ids are hashed in sorted
    runs, so a group of copies of any size needs no more memory. A sequence of very many turns is one key in one task.
    """
    spark = sequences.sparkSession
    keyed = materialise(sequences.select(F.unhex(F.array_join("turns", "")).alias("key"), "conv_id"), "keys")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(keyed.count() / PER_TASK))
    sorted_ids = keyed.repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = materialise(sorted_ids.mapInArrow(_runs, "key binary, conv_id long, n long, ids string"), "runs")
    in_order = runs.repartitionByRange(tasks, "key").sortWithinPartitions("key", "conv_id")
    state = materialise(in_order.mapInArrow(_plant, STATE), "forest")
    opened = state.filter("kind = 'open'")
    parts = (opened.agg(F.max("part")).first()[0] or 0) + 1
    level, closed = opened, None
    while True:
        parts = math.ceil(parts / FAN)
        merged = level.groupBy(F.expr(f"part DIV {FAN}").alias("g")).applyInPandas(_merge(parts == 1), STATE)
        merged = materialise(merged, "merged")
        ended = merged.filter("kind <> 'open'")
        closed = ended if closed is None else closed.unionByName(ended)
        if parts == 1:
            break
        level = merged.filter("kind = 'open'")
    # Nodes below an open one learn its smallest member at the end: a part's own open nodes first, so that no key is hot.
    names = [c.split(" ")[0] for c in NODE.split(", ")]
    final = closed.select("prefix", F.col("conv_id").alias("parent_conv_id"))
    tops = opened.select("part", "prefix").join(final, "prefix").withColumnRenamed("prefix", "above")
    own = state.filter("kind = 'waits'").drop("parent_conv_id").join(tops, ["part", "above"])
    later = closed.filter("kind = 'waits'").drop("parent_conv_id").join(final.withColumnRenamed("prefix", "above"), "above")
    out = state.filter("kind = 'done'").select(*names)
    for more in (own, closed.filter("kind = 'done'"), later):
        out = out.unionByName(more.select(*names))
    return out
