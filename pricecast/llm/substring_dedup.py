"""Removal of passages of at least ``WINDOW`` words that begin in an earlier document.

Windows of equal words meet in one shard: the shard of a window is the least hash among its runs of GRAM words, which
depends on the window's words alone. A first pass keeps the least hashes that stand in more than one document. The
stretches of text around those go to their shards, equal stretches once with their least document. A shard holds a
compressed FM-index of its stretches; backward search gives every window's interval of equal windows and with it the
least document that has it. Where that is smaller than a document's own id, the window's words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecast.llm.fm_index import FMIndex
from pricecast.llm.text import Chunk, chunks, mix, rows_of, run_hashes
from pricecast.session import materialise

WINDOW = 50
GRAM = 8
LONGEST = 128  # windows in a stretch
SHARD_WORDS = 150_000  # words in one index
HOT = 1_000  # different stretches of one least hash beyond which its windows are matched by hash instead


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    least, covered = x, 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    return np.minimum(least[: len(x) - width + 1], least[width - covered :]) if covered < width else least


def _stretches(c: Chunk):
    """Runs of windows of one text and one least hash: text, first window, windows, hash; and the words' spans."""
    starts, ends, hashes, bounds = c.words()
    empty = np.zeros(0, dtype=np.int64)
    if len(hashes) < WINDOW:
        return (empty, empty, empty, empty.astype(np.uint64)), starts, ends, bounds
    at = np.arange(len(hashes) - GRAM + 1)
    least = _sliding_least(run_hashes(hashes, at, at + GRAM, "word"), WINDOW - GRAM + 1)
    words = np.diff(bounds)
    owner = np.repeat(np.arange(len(words)), words)[: len(least)]
    valid = np.arange(len(least)) + WINDOW <= bounds[owner + 1]
    first = np.flatnonzero(valid)
    if not len(first):
        return (empty, empty, empty, empty.astype(np.uint64)), starts, ends, bounds
    own, value = owner[first], least[first]
    fresh = np.ones(len(first), dtype=bool)
    fresh[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
    run = np.flatnonzero(fresh)
    size = np.diff(np.append(run, len(first)))
    pieces = -(-size // LONGEST)
    k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    run, size = np.repeat(run, pieces) + k * LONGEST, np.minimum(np.repeat(size, pieces) - k * LONGEST, LONGEST)
    return (own[run], first[run], size, value[run]), starts, ends, bounds


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least hashes of every document, each once."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        tags = batch.column(1).to_numpy(zero_copy_only=False)
        for c in chunks(rows_of(batch.column(2))):
            (owner, _, _, value), *_ = _stretches(c)
            pair = np.unique(np.stack([owner.astype(np.uint64), value]), axis=1) if len(owner) else np.zeros((2, 0), np.uint64)
            rows = c.first + pair[0].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[1].view(np.int64)), pa.array(ids[rows]), pa.array(tags[rows])], ["h", "id", "tag"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches whose least hash is among the document's repeated ones."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        tags = batch.column(1).to_numpy(zero_copy_only=False)
        repeated = batch.column(3).to_pylist()
        for c in chunks(rows_of(batch.column(2))):
            (owner, first, size, value), starts, ends, bounds = _stretches(c)
            mine = [np.array(repeated[c.first + i], dtype=np.int64).view(np.uint64) for i in range(len(c.blobs))]
            lot = np.concatenate([mix(m ^ mix(np.uint64([i + 1]))) for i, m in enumerate(mine)])
            hit = np.flatnonzero(np.isin(mix(value ^ mix(owner.astype(np.uint64) + np.uint64(1))), lot))
            raw = c.data.tobytes()
            text = [raw[a:b] for a, b in zip(starts[first[hit]].tolist(), ends[first[hit] + size[hit] + WINDOW - 2].tolist())]
            rows = c.first + owner[hit]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value[hit].view(np.int64)),
                    pa.array(ids[rows]),
                    pa.array(tags[rows]),
                    pa.array((first[hit] - bounds[owner[hit]]).astype(np.int32)),
                    pa.array(text, pa.binary()),
                ],
                ["h", "id", "tag", "at", "stretch"],
            )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least document of every window of every stretch; rows come sorted by least hash, an index ends between two."""
    held: list[tuple[int, int, int, int, list[bytes]]] = []
    size = 0

    def flush():
        index = FMIndex([x[4] for x in held], WINDOW)
        least = index.least(np.array([x[2] for x in held], dtype=np.int64))
        rows = [(h, c, least[groups]) for (h, c, _, most, _), groups in zip(held, index.classes(WINDOW)) if least[groups].min() < most]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].tolist() for r in rows], pa.list_(pa.int64()))],
            ["h", "c", "least"],
        )

    for batch in batches:
        for h, c, low, most, stretch in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if size >= SHARD_WORDS and held[-1][0] != h:
                yield flush()
                held, size = [], 0
            words = stretch.split()
            held.append((h, c, low, most, words))
            size += len(words)
    if held:
        yield flush()


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two independent hashes of every window of a stretch."""
    for batch in batches:
        h, c, low = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        for i, stretch in enumerate(batch.column(3).to_pylist()):
            _, _, hashes, _ = Chunk(0, [stretch]).words()
            at = np.arange(len(hashes) - WINDOW + 1)
            two = [run_hashes(x, at, at + WINDOW, "word").view(np.int64) for x in (hashes, mix(hashes + np.uint64(0x51ED270B)))]
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, h[i])), pa.array(np.full(n, c[i])), pa.array(np.full(n, low[i])), pa.array(at.astype(np.int32)), *map(pa.array, two)],
                ["h", "c", "low", "o", "w1", "w2"],
            )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, str, bytes]] = []
        for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = (text or b"").split()
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            at = np.unique(np.array(starts or [], dtype=np.int64))
            edge[at] += 1
            np.subtract.at(edge, at + WINDOW, 1)
            gone = np.cumsum(edge)[:-1] > 0
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if len(at) else b" ".join(words)
            out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """First word of every window that also begins in a document of smaller id: columns id, tag and starts (array).

    docs: columns doc_id, text. ``tag`` is a hash of the text, for tables in which an id repeats. Rows without an id
    neither lose words nor make others lose them.
    """
    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("tag"), F.col("text").cast("binary").alias("t"))
    seen = materialise(rows.mapInArrow(_hashes, "h long, id long, tag long"), "hashes")
    repeated = seen.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("h")
    mine = seen.join(repeated, "h").groupBy("id", "tag").agg(F.collect_set("h").alias("hs"))  # as many as the text has
    passages = rows.join(mine, ["id", "tag"]).select("id", "tag", "t", "hs").mapInArrow(_passages, "h long, id long, tag long, at int, stretch binary")
    passages = materialise(passages.withColumn("c", F.xxhash64("stretch")), "passages")
    single = passages.groupBy("h", "c", "stretch").agg(F.min("id").alias("low"), F.max("id").alias("most"))
    single = materialise(single.select("h", "c", "low", "most", "stretch"), "stretches")
    hot = materialise(single.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("h"), "hot")
    ready = single.join(hot, "h", "left_anti").repartition("h").sortWithinPartitions("h")
    least = ready.mapInArrow(_search, "h long, c long, least array<long>")
    windows = single.join(hot, "h", "left_semi").select("h", "c", "low", "stretch").mapInArrow(_window_hashes, "h long, c long, low long, o int, w1 long, w2 long")
    windows = materialise(windows, "windows")
    lows = windows.groupBy("w1", "w2").agg(F.min("low").alias("least"))
    joined = windows.join(lows, ["w1", "w2"]).groupBy("h", "c").agg(F.sort_array(F.collect_list(F.struct("o", "least"))).alias("x"))
    least = materialise(least.union(joined.select("h", "c", F.col("x.least"))), "least")
    at = F.filter(F.transform("least", lambda x, i: F.when(x < F.col("id"), F.col("at") + i)), lambda x: x.isNotNull())
    gone = passages.select("h", "c", "id", "tag", "at").join(least, ["h", "c"]).select("id", "tag", at.alias("starts")).filter(F.size("starts") > 0)
    return gone.groupBy("id", "tag").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (kept words joined by a space) of every row.

    Words are runs outside ``\\x20\\x09-\\x0D``; a null text has none. Windows are judged on the input, so a passage
    that is removed from one document still removes it from later ones.
    """
    gone = materialise(repeated_windows(docs), "starts")
    rows = docs.select("doc_id", F.xxhash64("text").alias("tag"), F.col("text").cast("binary").alias("t"))
    kept = rows.join(gone.withColumnRenamed("id", "doc_id"), ["doc_id", "tag"], "left").select("doc_id", "t", "starts")
    return kept.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
