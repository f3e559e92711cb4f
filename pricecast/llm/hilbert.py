"""Nearest vectors by inner product along shifted Hilbert curves.

The inner product becomes a distance by one more coordinate that brings every vector to the largest length. For each
of several curves the vectors are projected to a few random orthogonal directions, shifted, put on a grid and numbered
along a Hilbert curve. Each curve is cut into blocks of some windows, which also get the window before and the one after
them; inside a sorted block every query is scored against the windows around it, and the best of all curves are merged.
Scores are inner products of the vectors as given.

The window comes from the table: for a sample of queries of fixed size the true neighbours are found by brute force, and
the window is as long as the places between a query and its neighbours, on the curve where they lie closest, ask for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricecast.session import materialise

CURVES = 32
AXES = 8
BITS = 7
WINDOW = 600  # least rows in a window; a query meets its own window and the one on either side
SAMPLE = 256  # queries from which the window is read
REACHED = 0.97  # share of their neighbours within a window
BLOCK = 8  # windows in a block
AT_ONCE = 1 << 22  # scores held at a time


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of every row of grid coordinates below 2**bits (Skilling's transform)."""
    x = [np.ascontiguousarray(c) for c in cells.astype(np.int64).T]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(hit, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | (((c ^ turn) >> b) & 1)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


class Curves:
    """Numbers of lifted vectors and queries along every curve."""

    def __init__(self, longest: float, dim: int, curves: int, seed: int):
        rng = np.random.default_rng(seed)
        axes = min(AXES, dim + 1)
        self.turns = [(np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0][:, :axes], rng.random(axes)) for _ in range(curves)]
        self.longest, self.reach = longest, 3.5 * longest / np.sqrt(dim + 1)

    def lifted(self, v: np.ndarray) -> np.ndarray:
        return np.column_stack([v, np.sqrt(np.maximum(self.longest**2 - (v * v).sum(axis=1), 0))])

    def asking(self, v: np.ndarray) -> np.ndarray:
        return np.column_stack([v * (self.longest / np.sqrt((v * v).sum(axis=1)))[:, None], np.zeros(len(v))])

    def keys(self, points: np.ndarray) -> Iterator[np.ndarray]:
        for turn, shift in self.turns:
            unit = np.clip((points @ turn) / (2 * self.reach) + 0.5, 0, 1) * 0.5 + shift * 0.5
            yield hilbert_index(np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors and flags of a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            v = _matrix(part.column(1))
            if len(v):
                yield part.column(0).to_numpy(zero_copy_only=False), v, part.column(2).to_numpy(zero_copy_only=False).astype(bool)


def _keyed(curves: Curves):
    """Number of every vector on every curve, as a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, v, _ in _parts(batches):
            for c, key in enumerate(curves.keys(curves.lifted(v))):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key)], ["curve", "key"])

    return run


def _numbered(curves: Curves, cuts: dict[int, np.ndarray]):
    """Rows of every curve and block: each vector as a candidate, there and in blocks that it borders, and, where asked for, as a query.

    Cuts are the numbers at which windows begin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gid, v, flags in _parts(batches):
            asked = np.flatnonzero(flags)
            points = np.concatenate([curves.lifted(v), curves.asking(v[asked])])
            which = np.concatenate([np.arange(len(v)), asked])
            query = np.arange(len(which)) >= len(v)
            raw = [x.tobytes() for x in v]
            for c, key in enumerate(curves.keys(points)):
                window = np.searchsorted(cuts[c], key, side="right")
                for step in (-1, 0, 1):  # the block before, the own one and the one after
                    block = window // BLOCK
                    at = np.flatnonzero(((window + step) // BLOCK == block + step) & ~query) if step else np.arange(len(key))
                    if not len(at):
                        continue
                    columns = [np.full(len(at), c, np.int32), (block[at] + step).astype(np.int32), key[at], gid[which[at]], query[at]]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, columns), pa.array([raw[i] for i in which[at]], pa.binary())], ["curve", "block", "key", "gid", "asked", "v"]
                    )

    return run


def _scan(queries: list[tuple[int, np.ndarray]], keep: int):
    """Best ``keep`` of a partition for every query, by brute force."""
    matrix = np.stack([q for _, q in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, v, _ in _parts(batches):
            scores = matrix @ v.T
            n = min(keep, len(v))
            top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
            rows = np.repeat(np.arange(len(matrix)), n)
            columns = (np.array([q for q, _ in queries])[rows], ids[top.ravel()], scores[rows, top.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns] + [pa.array([x.tobytes() for x in v[top.ravel()]], pa.binary())], ["q", "c", "score", "v"])

    return run


def _between(curves: Curves, marks: list[np.ndarray]):
    """How many vectors of a partition lie between the ascending marks of every curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(m) + 1, dtype=np.int64) for m in marks]
        for _, v, _ in _parts(batches):
            for c, key in enumerate(curves.keys(curves.lifted(v))):
                total[c] += np.bincount(np.searchsorted(marks[c], key, side="left"), minlength=len(total[c]))
        for c, t in enumerate(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), c, np.int32)), pa.array(np.arange(len(t))), pa.array(t)], ["curve", "at", "n"])

    return run


def window_for(points: DataFrame, curves: Curves, k: int, least: int) -> int:
    """Rows that a window needs so that REACHED of the true neighbours of a sample of queries are met, ``least`` at least."""
    picked = points.filter("asked").orderBy(F.xxhash64("gid"), "gid").select("gid", "v").limit(SAMPLE).collect()  # SAMPLE rows
    if not picked:
        return least
    queries = [(r.gid, np.array(r.v)) for r in picked]
    scanned = points.select("gid", "v", "asked").mapInArrow(_scan(queries, k + 1), "q long, c long, score double, v binary")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    true = scanned.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k + 1).select("q", "v").collect()  # k + 1 a query
    row = {q: i for i, (q, _) in enumerate(queries)}
    mine = np.array([row[r.q] for r in true])
    asking = list(curves.keys(curves.asking(np.stack([v for _, v in queries]))))
    near = list(curves.keys(curves.lifted(np.stack([np.frombuffer(r.v) for r in true]))))
    marks = [np.unique(np.concatenate([a, b])) for a, b in zip(asking, near)]
    counted = points.select("gid", "v", "asked").mapInArrow(_between(curves, marks), "curve int, at long, n long").groupBy("curve", "at").agg(F.sum("n").alias("n")).collect()
    inside = [np.zeros(len(m) + 1, dtype=np.int64) for m in marks]
    for r in counted:
        inside[r.curve][r.at] = r.n
    apart = []
    for c, m in enumerate(marks):
        upto = np.cumsum(inside[c])  # vectors at a mark or before
        a, b = np.searchsorted(m, asking[c])[mine], np.searchsorted(m, near[c])
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart.append(upto[high] - np.where(low > 0, upto[low - 1], 0))
    need = np.sort(np.min(apart, axis=0))
    return max(least, int(need[min(len(need) - 1, int(np.ceil(REACHED * len(need))))]))


def _windows(window: int, keep: int):
    """Best ``keep`` candidates of each query among its window and the two beside it."""

    def best(queries, blocks) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([b[0] for b in blocks])
        vectors = np.concatenate([b[1] for b in blocks])
        step = max(1, AT_ONCE // len(ids))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            scores = np.stack([q for _, q in part]) @ vectors.T
            out_q, out_c, out_s = [], [], []
            for (gid, _), row in zip(part, scores):
                n = min(keep, len(row))
                top = np.flatnonzero(row >= np.partition(row, len(row) - n)[len(row) - n])
                top = top[np.lexsort((ids[top], -row[top]))][:n]
                out_q.append(np.full(n, gid))
                out_c.append(ids[top])
                out_s.append(row[top])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_c, out_s)], ["q", "c", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = current = None  # full windows of the curve at hand: ids, vectors, queries
        place = None  # curve and block
        ids: list[int] = []
        vectors: list[np.ndarray] = []
        queries: list[tuple[int, np.ndarray]] = []

        def finish():
            full = (np.array(ids, dtype=np.int64), np.stack(vectors), queries) if ids else None
            if current is not None:
                late = [] if full else queries  # queries after the last candidate
                if current[2] or late:
                    yield from best(current[2] + late, [b for b in (before, current, full) if b is not None])
            if full is not None and queries:
                yield from best(queries, [b for b in (current, full) if b is not None])

        for batch in batches:
            curves, blocks, gids, flags, blobs = (batch.column(k).to_pylist() for k in range(5))
            for c, block, gid, asked, blob in zip(curves, blocks, gids, flags, blobs):
                if (c, block) != place:
                    yield from finish()
                    before, current, place, ids, vectors, queries = None, None, (c, block), [], [], []
                v = np.frombuffer(blob)
                if asked:
                    queries.append((gid, v))
                    continue
                ids.append(gid)
                vectors.append(v)
                if len(ids) == window:
                    full = (np.array(ids, dtype=np.int64), np.stack(vectors), queries)
                    if current is not None and current[2]:
                        yield from best(current[2], [b for b in (before, current, full) if b is not None])
                    before, current, ids, vectors, queries = current, full, [], [], []
        yield from finish()

    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, curves: int = CURVES, window: int = WINDOW, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id and score of the k vectors of largest inner product found for every queried vector.

    Queried are ids divisible by ``every``. ``window`` is the least; it grows where the table asks for more. Vectors that are null, zero, hold a null or a non-finite component, or are
    not of the table's commonest length take no part; nor do rows without an id. Equal vectors are one point that
    keeps its k + 1 least ids, so a vector that fills a third of the table costs no more than another. Ties go to the
    smaller id; an id that repeats counts once with each different vector's best.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    v = F.col("embedding").cast("array<double>")
    fine = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    fine = fine.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # one zero
    sizes = fine.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m"))
    common = sizes.orderBy(F.desc("n"), "dim").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, longest = common["dim"], float(np.sqrt(common["m"]))
    fine = materialise(fine.filter(F.size("v") == dim), "vectors")
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = fine.distinct().withColumn("rn", place).filter(F.col("rn") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = fine.groupBy("v").agg(F.max(F.col("id") % every == 0).alias("asked"))
    points = materialise(least.join(asked, "v").select(F.col("ids")[0].alias("gid"), "v", "ids", "asked"), "points")
    lines = Curves(longest, dim, curves, seed)
    window = window_for(points, lines, k, window)
    pieces = points.count() // window + 1
    cuts = {c: np.zeros(0, np.int64) for c in range(curves)}
    if pieces > 1:
        marks = F.percentile_approx("key", [i / pieces for i in range(1, pieces)], F.lit(20 * pieces))
        for r in points.select("gid", "v", "asked").mapInArrow(_keyed(lines), "curve int, key long").groupBy("curve").agg(marks.alias("cuts")).collect():
            cuts[r.curve] = np.unique(r.cuts)
    rows = points.select("gid", "v", "asked").mapInArrow(_numbered(lines, cuts), "curve int, block int, key long, gid long, asked boolean, v binary")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "curve", "block").sortWithinPartitions("curve", "block", "key", "gid")
    found = ordered.select("curve", "block", "gid", "asked", "v").mapInArrow(_windows(window, k + 1), "q long, c long, score double")
    once = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    best = materialise(once.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k + 1).select("q", "c", "score"), "found")
    ids = points.select(F.col("gid").alias("c"), F.explode("ids").alias("vec_id"))
    near = best.join(ids, "c")
    asking = fine.filter(F.col("id") % every == 0).distinct().join(points.select("v", F.col("gid").alias("q")), "v").select("q", F.col("id").alias("query_id"))
    pairs = asking.join(near, "q").filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
