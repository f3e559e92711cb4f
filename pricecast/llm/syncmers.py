"""Document fingerprints from closed syncmers.

A run of K bytes is an anchor when the least hash among its inner runs of S bytes stands at its first or last place.
Whether a run is an anchor depends on its own bytes alone, so the same passage gives the same anchors in any text. The
fingerprint holds the anchors whose hash is below a fixed threshold, one in RATE, and at least the SKETCH of least hash,
each with the place where it first occurs; it grows with the text. Likeness matches hashes of two fingerprints and counts
the longest chain of them that keeps its order in both texts, across passages put in or taken out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.llm.text import chunks, mix

S = 4  # bytes of an inner run
K = 3 * S  # bytes of an anchor
SKETCH = 64  # anchors kept at least
RATE = 16  # one anchor in so many is kept of a long text
THRESHOLD = (1 << 32) // RATE

Print = tuple[np.ndarray, np.ndarray]  # hashes (ascending) and places


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all anchors."""
    if len(data) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = mix(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, S)).view("<u4").ravel().astype(np.uint64))
    width = K - S + 1
    least, covered = inner, 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < width:
        least = np.minimum(least[: len(inner) - width + 1], least[width - covered :])
    at = np.flatnonzero((least == inner[: len(least)]) | (least == inner[width - 1 :]))
    third = np.uint64(0x9E3779B97F4A7C15)
    return at, mix(inner[at] + third * (inner[at + S] + third * inner[at + 2 * S]))


def sketches(blobs: list[bytes]) -> list[Print]:
    """Fingerprint of every text; a text shorter than an anchor is one anchor, an empty one has none."""
    out: list[Print] = []
    for c in chunks(blobs):
        at, hashes = anchors(c.data)
        low = np.searchsorted(at, c.text_starts)
        high = np.searchsorted(at, c.text_ends - K, side="right")
        for blob, start, a, b in zip(c.blobs, c.text_starts, low, high):
            if a >= b:
                whole = int.from_bytes(hashlib.sha256(blob).digest()[:4], "little")
                out.append((np.full(int(bool(blob)), whole, np.uint32), np.zeros(int(bool(blob)), np.int64)))
                continue
            short = (hashes[a:b] >> np.uint64(32)).astype(np.uint32)
            value, first = np.unique(short, return_index=True)
            keep = max(SKETCH, int(np.searchsorted(value, THRESHOLD)))
            out.append((value[:keep], at[a:b][first[:keep]] - start))
    return out


def _reach(hashes: np.ndarray) -> int:
    """Greatest hash up to which a fingerprint holds all anchors of its text."""
    return 0xFFFFFFFF if len(hashes) < SKETCH else max(int(hashes[-1]), THRESHOLD - 1)


def _in_order(px: np.ndarray, py: np.ndarray) -> int:
    """Matches of the longest chain that ascends in both texts, however often its shift changes on the way."""
    ends: list[int] = []  # least last place of a chain of every length
    for y in py[np.argsort(px)].tolist():
        at = bisect_left(ends, y)
        ends[at : at + 1] = [y]
    return len(ends)


def likeness(x: Print, y: Print) -> float:
    """Twice the shared share over one plus it (Dice), shared anchors being those matched in order.

    The share is taken over the hashes up to which both fingerprints hold all anchors. Two empty texts are alike (1), an
    empty and another are not (0).
    """
    (hx, px), (hy, py) = x, y
    if not len(hx) or not len(hy):
        return float(len(hx) == len(hy))
    reach = min(_reach(hx), _reach(hy))
    both, ix, iy = np.intersect1d(hx, hy, assume_unique=True, return_indices=True)
    m = int(np.searchsorted(both, reach, side="right"))
    if not m:
        return 0.0
    union = int(np.searchsorted(hx, reach, side="right") + np.searchsorted(hy, reach, side="right")) - m
    shared = _in_order(px[ix[:m]], py[iy[:m]]) / union
    return 2 * shared / (1 + shared)


def as_text(x: Print) -> str:
    """Sixteen hex digits an anchor: its hash and its place."""
    return "".join(f"{h:08x}{min(p, 0xFFFFFFFF):08x}" for h, p in zip(x[0].tolist(), x[1].tolist()))


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, own rows before the row that follows the bucket: each meets the next."""
    last = None  # bucket, id, text, print of a row whose next has not come yet
    for batch in batches:
        buckets, tails, ids, texts = (batch.column(k).to_pylist() for k in range(4))
        rows = [(b, i, t or "") for b, tail, i, t in zip(buckets, tails, ids, texts)]
        prints = sketches([t.encode() for _, _, t in rows])
        pairs = []
        for (b, i, t), tail, p in zip(rows, tails, prints):
            if last is not None and last[0] == b:
                pairs.append((last, t, p))
            last = None if tail else (b, i, t, p)
        if not pairs:
            continue
        edited = [(own[2][: len(own[2]) - len(own[2]) // 2] + t[: len(own[2]) // 2]).encode() for own, t, _ in pairs]
        made = sketches(edited)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([own[1] for own, _, _ in pairs], pa.int64()),
                pa.array([len(own[2]) for own, _, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array([as_text(own[3]) for own, _, _ in pairs]),
                pa.array([as_text(m) for m in made]),
                pa.array([likeness(own[3], m) for (own, _, _), m in zip(pairs, made)], pa.float64()),
                pa.array([likeness(own[3], p) for own, _, p in pairs], pa.float64()),
            ],
            schema=_SCHEMA,
        )


def _placed(bounds: list[int], heads: dict[int, tuple[int, int]] | None = None):
    """Buckets that a key belongs to: its own and, for the least key of a bucket, the bucket before it."""
    edges = np.array(bounds, dtype=np.int64)

    def run(keys: pa.Array) -> pa.Array:
        values = keys.to_numpy(zero_copy_only=False)
        own = np.searchsorted(edges, values, side="right").tolist()
        if heads is None:
            return pa.array([[b] for b in own], type=pa.list_(pa.int32()))
        return pa.array([[b, heads[b][1]] if heads[b][0] == v else [b] for b, v in zip(own, values.tolist())], type=pa.list_(pa.int32()))

    run.__annotations__ = {"keys": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.ArrayType(T.IntegerType()))


def against_edited_and_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint of every text, of its edited text and the likeness to that and to the next document.

    The edited text has the last floor(n/2) code points replaced by the first ones of the next document by ascending
    doc_id (after the last, the first). Rows without an id come first; rows of one id are taken in the order of their
    texts, so repeated rows follow each other. A null text is empty; the only row of a table is its own next.

    Texts are shuffled once, by ranges of ids. The first row of each range is also sent to the range before it, so
    every row meets its next without a global order in one task.
    """
    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id"), F.lit(-(2**63))).cast("long").alias("k"), "text")
    found = keyed.agg(F.percentile_approx("k", [i / n for i in range(1, n)], F.lit(20 * n))).first()[0] if n > 1 else []
    bounds = sorted(set(found or []))
    least = keyed.select("k", _placed(bounds)("k")[0].alias("b")).groupBy("b").agg(F.min("k").alias("k")).collect()  # a row a bucket
    heads = {}
    order = sorted((r.b, r.k) for r in least)
    for i, (b, k) in enumerate(order):
        heads[b] = (k, order[i - 1][0])
    dealt = keyed.withColumn("bs", _placed(bounds, heads)("k")).select("doc_id", "k", "text", F.posexplode("bs").alias("tail", "bucket"))
    ready = (
        dealt.select("bucket", (F.col("tail") == 1).alias("tail"), "doc_id", "text", "k")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "tail", "k", F.coalesce("text", F.lit("")))
    )
    return ready.select("bucket", "tail", "doc_id", "text").mapInArrow(_compare, COLUMNS)
