"""Forests grown level by level over a distributed table: extremely randomised trees, and random forests.

In an extremely randomised tree a node draws one threshold for each of its drawn features, uniformly between the feature's least and largest value in the
node, and keeps the best of them; no threshold is searched. Two aggregations grow a level of all open nodes of a group
of trees: the ranges of the features, then, with the thresholds drawn from them, the sums left of every threshold. Tasks
combine their own rows first, Spark adds up, and the driver holds the open nodes only. A node with few rows is shuffled to
one task, which finishes its subtree; the bound on these rows is a parameter and does not change the trees.

A random forest searches its cuts among the bounds of quantile bins instead, on rows weighted by a Poisson draw for each
tree (a bootstrap that needs no count of the rows). Its levels take one aggregation: sums by feature and bin.

Draws are hashes of (seed, tree, node, feature) or (seed, tree, row), so a lost task repeats them and any other
implementation can.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.session import materialise

EQUAL = 1e-9  # gains that differ by a smaller share are equal
HUGE = 1e300  # infinite values count as this much
DEEPEST = 62  # node numbers are paths in 64 bits
OPEN_NODES = 10_000  # open nodes of a group of trees on the driver, at most about
TREES_AT_ONCE = 100
NODES = "tree int, node long, feature int, threshold double, value double, n long, gain double"
_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("threshold", pa.float64()), ("value", pa.float64()), ("n", pa.int64()), ("gain", pa.float64())])


@dataclass(frozen=True)
class ForestParams:
    """``max_depth`` None grows until nodes are pure, at most 62 levels; ``max_features`` as a share, a count, sqrt or log2."""

    n_estimators: int = 100
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: float | int | str | None = 1.0

    def depth(self) -> int:
        return DEEPEST if self.max_depth is None else min(self.max_depth, DEEPEST)

    def drawn(self, p: int) -> int:
        """Features drawn in a node, of those that are not constant there."""
        m = self.max_features
        if m is None:
            return p
        if isinstance(m, str):
            return max(1, int({"sqrt": math.sqrt, "log2": math.log2}[m](p)))
        return max(1, min(p, m if isinstance(m, int) else int(m * p)))


def uniform(seed: int, tree, node, feature, kind: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on nothing but the arguments (arrays of unsigned 64-bit integers, broadcast)."""
    as64 = lambda v: np.asarray(v, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = as64(seed) * np.uint64(0x9E3779B97F4A7C15) + as64(kind)
        for v in (tree, node, feature):
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + as64(v)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def thresholds(seed: int, tree, node: np.ndarray, lo: np.ndarray, hi: np.ndarray, drawn: int) -> np.ndarray:
    """Drawn thresholds by node and feature, NaN where a feature is constant or was not drawn."""
    feature = np.arange(lo.shape[1])
    tree, node = np.broadcast_to(np.asarray(tree), node.shape)[:, None], node[:, None]
    cut = lo + uniform(seed, tree, node, feature, 0) * (hi - lo)
    cut = np.where(cut >= hi, lo, cut)
    turn = np.where(hi > lo, uniform(seed, tree, node, feature, 1), 2.0)
    place = np.argsort(np.argsort(turn, axis=1, kind="stable"), axis=1, kind="stable")
    return np.where((place < drawn) & (hi > lo), cut, np.nan)


def best_cut(n: np.ndarray, s: np.ndarray, n_left: np.ndarray, s_left: np.ndarray, cut: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each node that lowers the squared error most, -1 where none is allowed, and the fall of the error.

    Of features equal but for rounding the first is taken, so the order in which sums are added does not matter.
    """
    n_right, s_right = n[:, None] - n_left, s[:, None] - s_left
    allowed = ~np.isnan(cut) & (n_left >= least) & (n_right >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, s_left**2 / n_left + s_right**2 / n_right, -1.0)  # no gain is negative
    top = gain.max(axis=1, keepdims=True)
    feature = np.where(allowed.any(axis=1), (gain >= top - EQUAL * np.abs(top)).argmax(axis=1), -1)
    return feature, np.where(feature >= 0, top[:, 0] - s**2 / n, 0.0)


def finish(x: np.ndarray, y: np.ndarray, tree: int, root: int, params: ForestParams, seed: int) -> dict[str, np.ndarray]:
    """All nodes of the subtree below ``root`` over its own rows, level by level."""
    drawn = params.drawn(x.shape[1])
    node = np.full(len(y), root, dtype=np.int64)
    out: list[tuple[np.ndarray, ...]] = []
    level = int(root).bit_length() - 1
    while len(y):
        order = np.argsort(node, kind="stable")
        x, y, node = x[order], y[order], node[order]
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        n = np.diff(np.append(starts, len(y)))
        own, s = node[starts], np.add.reduceat(y, starts)
        inner = (n >= params.min_samples_split) & (n >= 2 * params.min_samples_leaf) & (np.minimum.reduceat(y, starts) < np.maximum.reduceat(y, starts))
        if level >= params.depth():
            inner[:] = False
        cut = thresholds(seed, tree, own, np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts), drawn)
        segment = np.repeat(np.arange(len(own)), n)
        left = x <= cut[segment]
        n_left = np.add.reduceat(left.astype(np.int64), starts)
        s_left = np.add.reduceat(np.where(left, y[:, None], 0.0), starts)
        feature, gain = best_cut(n, s, n_left, s_left, cut, params.min_samples_leaf)
        feature = np.where(inner, feature, -1)
        at = cut[np.arange(len(own)), feature]
        out.append((own, feature, np.where(feature >= 0, at, np.nan), s / n, n, np.where(feature >= 0, gain, 0.0)))
        goes = feature[segment] >= 0
        right = ~left[np.arange(len(y)), feature[segment]]
        node = (2 * node + right)[goes]
        x, y = x[goes], y[goes]
        level += 1
    columns = [np.concatenate(c) for c in zip(*out)]
    return dict(zip(("node", "feature", "threshold", "value", "n", "gain"), columns))


def weights(seed: int, tree: int, key: np.ndarray) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson numbers of mean 1."""
    return np.searchsorted(_POISSON, uniform(seed, tree, key, 0, 2), side="right")


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def _by_segment_and_code(segment: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Order of rows by segment, then code; short integers are sorted by their digits, which is several times faster."""
    if segment[-1] >= 1 << 15:
        return np.lexsort((code, segment))
    by = np.argsort(code.astype(np.int16), kind="stable")
    return by[np.argsort(segment.astype(np.int16)[by], kind="stable")]


def finish_searched(codes: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, root: int, params: ForestParams, seed: int) -> dict[str, np.ndarray]:
    """All nodes of the subtree below ``root`` over its own rows, cuts searched among the codes of the bins.

    A row counts as often as it was drawn. Codes at or below a cut go left; of cuts that part the rows alike, the lowest.
    """
    p = codes.shape[1]
    drawn = params.drawn(p)
    node = np.full(len(y), root, dtype=np.int64)
    out: list[tuple[np.ndarray, ...]] = []
    level = int(root).bit_length() - 1
    while len(y):
        order = np.argsort(node, kind="stable")
        codes, y, w, node = codes[order], y[order], w[order], node[order]
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        sizes = np.diff(np.append(starts, len(y)))
        wy = w * y
        own, n, s = node[starts], np.add.reduceat(w, starts), np.add.reduceat(wy, starts)
        inner = (n >= params.min_samples_split) & (n >= 2 * params.min_samples_leaf) & (np.minimum.reduceat(y, starts) < np.maximum.reduceat(y, starts))
        if level >= params.depth():
            inner[:] = False
        allowed = ~np.isnan(thresholds(seed, tree, own, np.minimum.reduceat(codes, starts).astype(float), np.maximum.reduceat(codes, starts).astype(float), drawn))
        segment = np.repeat(np.arange(len(own)), sizes)
        gains, cuts = np.full((len(own), p), -1.0), np.zeros((len(own), p))
        for f in range(p):
            if not (allowed[:, f] & inner).any():
                continue
            asked = np.flatnonzero(allowed[:, f] & inner)  # nodes; the rows of others cost nothing
            its = sizes[asked]
            part = np.repeat(np.arange(len(asked)), its)
            begin = np.cumsum(its) - its
            rows = np.repeat(starts[asked] - begin, its) + np.arange(len(part))
            by = rows[_by_segment_and_code(part, codes[rows, f])]
            c, own_w, own_y = codes[by, f], w[by], wy[by]
            sums_w, sums_y = np.cumsum(own_w), np.cumsum(own_y)
            n_left = sums_w - np.repeat(sums_w[begin] - own_w[begin], its)
            s_left = sums_y - np.repeat(sums_y[begin] - own_y[begin], its)
            n_right, s_right = n[asked][part] - n_left, s[asked][part] - s_left
            ends = np.append((c[1:] != c[:-1]) & (part[1:] == part[:-1]), False)  # last row of a code, not of the node
            valid = ends & (n_left >= params.min_samples_leaf) & (n_right >= params.min_samples_leaf)
            gain = np.full(len(c), -1.0)
            gain[valid] = s_left[valid] ** 2 / n_left[valid] + s_right[valid] ** 2 / n_right[valid]
            top = np.maximum.reduceat(gain, begin)
            first = np.where(gain >= (top - EQUAL * np.abs(top))[part], np.arange(len(c)), len(c))
            gains[asked, f], cuts[asked, f] = top, c[np.minimum(np.minimum.reduceat(first, begin), len(c) - 1)]
        top = gains.max(axis=1)
        feature = np.where(inner & (top >= 0), (gains >= (top - EQUAL * np.abs(top))[:, None]).argmax(axis=1), -1)
        cut = cuts[np.arange(len(own)), feature]
        out.append((own, feature, np.where(feature >= 0, cut, np.nan), s / n, n, np.where(feature >= 0, top - s**2 / n, 0.0)))
        goes = feature[segment] >= 0
        right = codes[np.arange(len(y)), feature[segment]] > cut[segment]
        node = (2 * node + right)[goes]
        codes, y, w = codes[goes], y[goes], w[goes]
        level += 1
    columns = [np.concatenate(c) for c in zip(*out)]
    return dict(zip(("node", "feature", "threshold", "value", "n", "gain"), columns))


class _Splits:
    """Inner nodes of one tree so far, for finding the node a row has come to."""

    def __init__(self, nodes: np.ndarray, feature: np.ndarray, threshold: np.ndarray):
        order = np.argsort(nodes)
        self.nodes, self.feature, self.threshold = nodes[order], feature[order], threshold[order]

    def route(self, x: np.ndarray) -> np.ndarray:
        node = np.ones(len(x), dtype=np.int64)
        going = np.arange(len(x)) if len(self.nodes) else np.zeros(0, np.int64)
        while len(going):
            at = np.minimum(np.searchsorted(self.nodes, node[going]), len(self.nodes) - 1)
            inner = self.nodes[at] == node[going]
            going, at = going[inner], at[inner]
            node[going] = 2 * node[going] + (x[going, self.feature[at]] > self.threshold[at])
        return node


def _matrix(batch: pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray]:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return np.clip(flat.reshape(-1, p), -HUGE, HUGE), batch.column("y").to_numpy(zero_copy_only=False)


def _by_node(node: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that came to a wanted node, sorted by it; the places of those nodes in ``wanted`` and their first rows."""
    at = np.minimum(np.searchsorted(wanted, node), len(wanted) - 1)
    rows = np.flatnonzero(wanted[at] == node)
    rows = rows[np.argsort(at[rows], kind="stable")]
    places = at[rows]
    starts = np.flatnonzero(np.append(True, places[1:] != places[:-1])) if len(rows) else np.zeros(0, np.int64)
    return rows, places[starts], starts


def _ranges(splits: dict[int, _Splits], wanted: dict[int, np.ndarray], p: int):
    """(tree, node, feature, lo, hi) of a task's rows; feature p is the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = {t: np.full((len(w), p + 1), np.inf) for t, w in wanted.items()}
        high = {t: np.full((len(w), p + 1), -np.inf) for t, w in wanted.items()}
        for batch in batches:
            x, y = _matrix(batch, p)
            both = np.column_stack([x, y])
            for t, w in wanted.items():
                rows, places, starts = _by_node(splits[t].route(x), w)
                if len(rows):
                    low[t][places] = np.minimum(low[t][places], np.minimum.reduceat(both[rows], starts))
                    high[t][places] = np.maximum(high[t][places], np.maximum.reduceat(both[rows], starts))
        for t, w in wanted.items():
            seen = np.flatnonzero(low[t][:, p] <= high[t][:, p])
            if len(seen):
                columns = [np.full(len(seen) * (p + 1), t, np.int32), np.repeat(w[seen], p + 1), np.tile(np.arange(p + 1, dtype=np.int32), len(seen)), low[t][seen].ravel(), high[t][seen].ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tree", "node", "feature", "lo", "hi"])

    return run


def _lefts(splits: dict[int, _Splits], wanted: dict[int, np.ndarray], cuts: dict[int, np.ndarray], p: int):
    """(tree, node, feature, n, s) of a task's rows at or below the drawn thresholds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {t: np.zeros((len(w), p), np.int64) for t, w in wanted.items()}
        s = {t: np.zeros((len(w), p)) for t, w in wanted.items()}
        for batch in batches:
            x, y = _matrix(batch, p)
            for t, w in wanted.items():
                rows, places, starts = _by_node(splits[t].route(x), w)
                if len(rows):
                    left = x[rows] <= np.repeat(cuts[t][places], np.diff(np.append(starts, len(rows))), axis=0)
                    n[t][places] += np.add.reduceat(left.astype(np.int64), starts)
                    s[t][places] += np.add.reduceat(np.where(left, y[rows, None], 0.0), starts)
        for t, w in wanted.items():
            i, j = np.nonzero(n[t])
            if len(i):
                columns = [np.full(len(i), t, np.int32), w[i], j.astype(np.int32), n[t][i, j], s[t][i, j]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tree", "node", "feature", "n", "s"])

    return run


def _deal(splits: dict[int, _Splits], small: dict[int, np.ndarray], p: int):
    """(tree, node, rows): a task's rows of every small node, as one value for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch, p)
            both = np.column_stack([x, y])
            for t, w in small.items():
                rows, places, starts = _by_node(splits[t].route(x), w)
                if len(rows):
                    parts = [both[r].tobytes() for r in np.split(rows, starts[1:])]
                    columns = [pa.array(np.full(len(parts), t, np.int32)), pa.array(w[places]), pa.array(parts, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "rows"])

    return run


def _finish_groups(params: ForestParams, seed: int, p: int):
    def run(table: pa.Table) -> pa.Table:
        tree, root = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        z = np.concatenate([np.frombuffer(b.as_py()).reshape(-1, p + 1) for b in table.column("rows")])
        done = finish(z[:, :p], z[:, p], tree, root, params, seed)
        columns = {"tree": np.full(len(done["node"]), tree, np.int32), **done, "feature": done["feature"].astype(np.int32)}
        return pa.table({f.name: pa.array(columns[f.name], f.type, from_pandas=True) for f in _ARROW}, _ARROW)

    return run


@dataclass
class Forest:
    """A grown forest: its nodes as a table ``(tree, node, feature, threshold, value, n, gain)``, feature -1 in leaves.

    Node 1 is the root, 2k and 2k + 1 are the children of k; rows with a value at or below the threshold go to 2k.
    """

    nodes: DataFrame
    features: list[str]
    n_estimators: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``, the mean of the trees' leaf values; NULL where a feature is NULL.

        The nodes go to the tasks by groups of trees; their number is bounded by the parameters and the training rows.
        """
        sc = df.sparkSession.sparkContext
        p = len(self.features)
        ok = F.lit(True)
        for f in self.features:
            ok = ok & F.col(f"`{f}`").isNotNull()
        x = F.when(ok, F.array(*[F.col(f"`{f}`").cast("double") for f in self.features]))
        total = F.lit(0.0)
        for first in range(0, self.n_estimators, TREES_AT_ONCE):
            some = self.nodes.where((F.col("tree") >= first) & (F.col("tree") < first + TREES_AT_ONCE))
            total = total + F.arrow_udf(_leaf_sums(sc.broadcast(_pack(some.toArrow())), p), T.DoubleType())(x)
        return df.withColumn("prediction", total / F.lit(float(self.n_estimators)))


    def importance(self) -> DataFrame:
        """``(position, feature, score)``: each feature's share of a tree's falls of the error, averaged over the trees."""
        by_feature = self.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("g"))
        share = F.col("g") / F.sum("g").over(Window.partitionBy("tree"))
        scores = by_feature.select("feature", share.alias("share")).groupBy(F.col("feature").alias("position")).agg((F.sum("share") / self.n_estimators).alias("score"))
        names = self.nodes.sparkSession.createDataFrame(list(enumerate(self.features)), "position int, feature string")
        return names.join(scores, "position", "left").select("position", "feature", F.coalesce("score", F.lit(0.0)).alias("score"))


def _leaf_sums(packed: Broadcast, p: int):
    def run(rows: pa.Array) -> pa.Array:
        there = rows.is_valid().to_numpy(zero_copy_only=False)
        flat = np.clip(rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, p), -HUGE, HUGE)
        out = np.full(len(rows), np.nan)
        out[there] = _descend(packed.value, flat)
        return pa.array(out, mask=~there)

    run.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return run


def _pack(table: pa.Table) -> list[tuple[np.ndarray, ...]]:
    """Of every tree: feature, threshold, value and the place of the left child (the right one stands behind it)."""
    columns = [table.column(c).to_numpy() for c in ("tree", "node", "feature", "threshold", "value")]
    order = np.lexsort((columns[1], columns[0]))
    tree, node, feature, threshold, value = (c[order] for c in columns)
    bounds = np.flatnonzero(np.append(True, tree[1:] != tree[:-1])) if len(tree) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(bounds, np.append(bounds[1:], len(tree))):
        out.append((feature[a:b], threshold[a:b], value[a:b], np.searchsorted(node[a:b], 2 * node[a:b])))
    return out


def _descend(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """Sum of the trees' leaf values."""
    total = np.zeros(len(x))
    for feature, threshold, value, left in trees:
        at = np.zeros(len(x), dtype=np.int64)
        going = np.flatnonzero(feature[at] >= 0)
        while len(going):
            here = at[going]
            at[going] = left[here] + (x[going, feature[here]] > threshold[here])
            going = going[feature[at[going]] >= 0]
        total += value[at]
    return total


def _local_rows(n: int) -> int:
    """Rows of a node that one task finishes: more of them for larger tables, so that few nodes are open at once."""
    return min(1 << 18, max(1 << 14, n // 4096))


def grow_drawn_forest(train: DataFrame, features: list[str], label: str, params: ForestParams, seed: int = 42, local_rows: int | None = None) -> Forest:
    """Extremely randomised regression trees over all rows whose label and features are not NULL, without bootstrap.

    Rows at or below a threshold go left. Nodes of up to ``local_rows`` rows are finished in one task. An empty table
    is an error.
    """
    spark = train.sparkSession
    p = len(features)
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    rows = train.select(x.alias("x"), F.col(f"`{label}`").cast("double").alias("y")).where(F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    rows = materialise(rows, "forest_rows")
    n, s = rows.agg(F.count("*"), F.sum("y")).first()
    if not n:
        raise ValueError("no complete rows to grow trees on")
    local = local_rows or _local_rows(n)
    group = max(1, min(TREES_AT_ONCE, OPEN_NODES * local // n))
    parts = [_grow_group(spark, rows, p, range(a, min(a + group, params.n_estimators)), int(n), float(s), params, seed, local) for a in range(0, params.n_estimators, group)]
    nodes = parts[0]
    for more in parts[1:]:
        nodes = nodes.unionByName(more)
    return Forest(nodes, list(features), params.n_estimators)


def _grow_group(spark: SparkSession, rows: DataFrame, p: int, trees: range, n: int, s: float, params: ForestParams, seed: int, local: int) -> DataFrame:
    """Nodes of some trees, written to the shared folder."""
    drawn = params.drawn(p)
    done: list[tuple] = []  # (tree, node, feature, threshold, value, n) of the levels above the small nodes
    inner: dict[int, list[tuple[int, int, float]]] = {t: [] for t in trees}
    small: dict[int, list[int]] = {t: [] for t in trees}
    frontier: dict[tuple[int, int], tuple[int, float]] = {}

    def place(t: int, node: int, n: int, s: float) -> None:
        if n < params.min_samples_split or n < 2 * params.min_samples_leaf or node.bit_length() > params.depth():
            done.append((t, node, -1, None, s / n, n, 0.0))
        elif n <= local:
            small[t].append(node)
        else:
            frontier[t, node] = (n, s)

    def splits() -> dict[int, _Splits]:
        return {t: _Splits(*(np.array(c, dtype=k) for c, k in zip(list(zip(*v)) or [(), (), ()], (np.int64, np.int64, np.float64)))) for t, v in inner.items()}

    for t in trees:
        place(t, 1, n, s)
    while frontier:
        wanted: dict[int, np.ndarray] = {}
        for t in trees:
            if own := sorted(node for u, node in frontier if u == t):
                wanted[t] = np.array(own, dtype=np.int64)
        so_far = splits()
        ranges = rows.mapInArrow(_ranges(so_far, wanted, p), "tree int, node long, feature int, lo double, hi double")
        found = ranges.groupBy("tree", "node", "feature").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
        lo = {t: np.zeros((len(w), p + 1)) for t, w in wanted.items()}
        hi = {t: np.zeros((len(w), p + 1)) for t, w in wanted.items()}
        _scatter(found, wanted, (("lo", lo), ("hi", hi)))
        cuts = {t: thresholds(seed, t, w, lo[t][:, :p], hi[t][:, :p], drawn) for t, w in wanted.items()}
        lefts = rows.mapInArrow(_lefts(so_far, wanted, cuts, p), "tree int, node long, feature int, n long, s double")
        found = lefts.groupBy("tree", "node", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
        n_left = {t: np.zeros((len(w), p), np.int64) for t, w in wanted.items()}
        s_left = {t: np.zeros((len(w), p)) for t, w in wanted.items()}
        _scatter(found, wanted, (("n", n_left), ("s", s_left)))
        level, frontier = frontier, {}
        for t, w in wanted.items():
            totals = np.array([level[t, node] for node in w.tolist()])
            feature, gain = best_cut(totals[:, 0].astype(np.int64), totals[:, 1], n_left[t], s_left[t], cuts[t], params.min_samples_leaf)
            feature = np.where(lo[t][:, p] < hi[t][:, p], feature, -1)  # a constant target is not split
            for i, (node, f) in enumerate(zip(w.tolist(), feature.tolist())):
                own_n, own_s = level[t, node]
                if f < 0:
                    done.append((t, node, -1, None, own_s / own_n, own_n, 0.0))
                    continue
                done.append((t, node, f, float(cuts[t][i, f]), own_s / own_n, own_n, float(gain[i])))
                inner[t].append((node, f, float(cuts[t][i, f])))
                place(t, 2 * node, int(n_left[t][i, f]), float(s_left[t][i, f]))
                place(t, 2 * node + 1, own_n - int(n_left[t][i, f]), own_s - float(s_left[t][i, f]))
    out = spark.createDataFrame(done, NODES)
    if any(small.values()):
        waiting = {t: np.array(sorted(v), dtype=np.int64) for t, v in small.items() if v}
        dealt = rows.mapInArrow(_deal(splits(), waiting, p), "tree int, node long, rows binary")
        out = out.unionByName(_spread(dealt).groupBy("tree", "node").applyInArrow(_finish_groups(params, seed, p), NODES))
    return materialise(out, "forest_nodes")


def _spread(dealt: DataFrame) -> DataFrame:
    """Few bytes are much work here, so small partitions are not to be joined into a few tasks, nor to be far more than the cores."""
    spark = dealt.sparkSession
    return dealt.repartition(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), "tree", "node")


def _scatter(found: pa.Table, wanted: dict[int, np.ndarray], into) -> None:
    """Places rows (tree, node, feature, values) in arrays by tree."""
    tree, node, feature = (found.column(c).to_numpy() for c in ("tree", "node", "feature"))
    for t, w in wanted.items():
        own = tree == t
        at = np.searchsorted(w, node[own])
        for column, arrays in into:
            arrays[t][at, feature[own]] = found.column(column).to_numpy()[own]


# Random forests: cuts searched among bins.


def _coded(batch: pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = batch.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
    return codes, batch.column("y").to_numpy(zero_copy_only=False), batch.column("key").to_numpy(zero_copy_only=False)


def _bin_sums(splits: dict[int, _Splits], wanted: dict[int, np.ndarray], p: int, bins: int, seed: int):
    """(tree, node, v): weights and weighted sums of a task's rows by feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {t: np.zeros((len(w), p, bins, 2)) for t, w in wanted.items()}
        for batch in batches:
            codes, y, key = _coded(batch, p)
            for t, own in wanted.items():
                w = weights(seed, t, key)
                rows, places, starts = _by_node(splits[t].route(codes), own)
                rows_at = np.repeat(places, np.diff(np.append(starts, len(rows))))
                for f in range(p):
                    at = rows_at * bins + codes[rows, f]
                    total[t][:, f, :, 0] += np.bincount(at, w[rows], len(own) * bins).reshape(-1, bins)
                    total[t][:, f, :, 1] += np.bincount(at, (w * y)[rows], len(own) * bins).reshape(-1, bins)
        for t, own in wanted.items():
            flat = total[t].reshape(len(own), -1)
            offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * flat.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t, np.int32)), pa.array(own), pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))], names=["tree", "node", "v"])

    return run


def _drawn_rows(p: int) -> np.dtype:
    return np.dtype([("codes", np.int16, (p,)), ("y", np.float64), ("w", np.int16)])


def _deal_weighted(splits: dict[int, _Splits], small: dict[int, np.ndarray], p: int, seed: int):
    """(tree, node, rows): codes, target and weight of a task's drawn rows of every small node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, y, key = _coded(batch, p)
            for t, own in small.items():
                w = weights(seed, t, key)
                drawn = np.flatnonzero(w)
                rows, places, starts = _by_node(splits[t].route(codes[drawn]), own)
                if len(rows):
                    both = np.empty(len(rows), _drawn_rows(p))
                    at = drawn[rows]
                    both["codes"], both["y"], both["w"] = codes[at], y[at], w[at]
                    parts = [part.tobytes() for part in np.split(both, starts[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), t, np.int32)), pa.array(own[places]), pa.array(parts, pa.binary())], names=["tree", "node", "rows"])

    return run


def _finish_searched_groups(params: ForestParams, seed: int, p: int):
    def run(table: pa.Table) -> pa.Table:
        tree, root = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        z = np.concatenate([np.frombuffer(b.as_py(), _drawn_rows(p)) for b in table.column("rows")])
        done = finish_searched(z["codes"].astype(np.int32), z["y"].copy(), z["w"].astype(np.int64), tree, root, params, seed)
        columns = {"tree": np.full(len(done["node"]), tree, np.int32), **done, "feature": done["feature"].astype(np.int32)}
        return pa.table({f.name: pa.array(columns[f.name], f.type, from_pandas=True) for f in _ARROW}, _ARROW)

    return run


def _searched_cut(sums: np.ndarray, tree: int, node: int, params: ForestParams, seed: int) -> tuple[int, int, float, np.ndarray] | None:
    """(feature, bin, fall of the error, (weight, sum) left) of the best cut of one node by its sums, or None."""
    p, bins, _ = sums.shape
    held = sums[:, :, 0] > 0
    lo, hi = held.argmax(axis=1), bins - 1 - held[:, ::-1].argmax(axis=1)
    allowed = ~np.isnan(thresholds(seed, tree, np.array([node]), lo[None].astype(float), hi[None].astype(float), params.drawn(p)))[0]
    left = np.cumsum(sums, axis=1)
    whole = left[0, -1]
    right = whole - left
    valid = held & allowed[:, None] & (left[..., 0] >= params.min_samples_leaf) & (right[..., 0] >= max(1, params.min_samples_leaf))
    if not valid.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(valid, left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0], -1.0)
    by_feature = gain.max(axis=1)
    f = int((by_feature >= by_feature.max() * (1 - EQUAL)).argmax())
    b = int((gain[f] >= by_feature[f] * (1 - EQUAL)).argmax())
    fall = float(by_feature[f] - whole[1] ** 2 / whole[0])
    return (f, b, fall, left[f, b]) if fall > 0 else None


def grow_random_forest(train: DataFrame, features: list[str], label: str, params: ForestParams, seed: int = 42, max_bins: int = 256, local_rows: int | None = None) -> Forest:
    """Random regression forest over all rows whose label and features are not NULL.

    Cuts lie at quantiles of a feature, at most ``max_bins`` - 1 of them. A row counts as often as its tree drew it, in
    the least numbers of rows too. Nodes of up to ``local_rows`` rows are finished in one task. An empty table is an error.
    """
    from pricecast.operators.boost import cuts_of

    p = len(features)
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    rows = train.select(x.alias("x"), F.col(f"`{label}`").cast("double").alias("y")).where(F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    rows = materialise(rows.withColumn("key", F.monotonically_increasing_id()), "forest_rows")
    n = rows.count()
    if not n:
        raise ValueError("no complete rows to grow trees on")
    cuts = cuts_of(rows, p, max_bins)
    bins = max(len(c) for c in cuts) + 1

    def code(values: pa.Array) -> pa.Array:
        z = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
        flat = np.column_stack([np.searchsorted(c, z[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.int16).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * p), pa.array(flat))

    code.__annotations__ = {"values": pa.Array, "return": pa.Array}
    coded = materialise(rows.select(F.arrow_udf(code, T.ArrayType(T.ShortType()))("x").alias("codes"), "y", "key"), "forest_codes")
    local = local_rows or _local_rows(n)
    group = max(1, min(TREES_AT_ONCE, OPEN_NODES * local // n))
    parts = [_grow_searched(coded, p, bins, range(a, min(a + group, params.n_estimators)), n, params, seed, local) for a in range(0, params.n_estimators, group)]
    nodes = parts[0]
    for more in parts[1:]:
        nodes = nodes.unionByName(more)
    bounds = [(f, float(i), float(v)) for f, c in enumerate(cuts) for i, v in enumerate(c)]  # at most p * max_bins rows
    bounds = rows.sparkSession.createDataFrame(bounds, "feature int, threshold double, _bound double")
    nodes = nodes.join(F.broadcast(bounds), ["feature", "threshold"], "left").withColumn("threshold", F.col("_bound"))
    return Forest(materialise(nodes.select(*[f.name for f in _ARROW]), "forest"), list(features), params.n_estimators)


def _grow_searched(coded: DataFrame, p: int, bins: int, trees: range, rows: int, params: ForestParams, seed: int, local: int) -> DataFrame:
    """Nodes of some trees with bins as thresholds, written to the shared folder."""
    done: list[tuple] = []
    inner: dict[int, list[tuple[int, int, float]]] = {t: [] for t in trees}
    small: dict[int, list[int]] = {t: [] for t in trees}
    frontier: dict[int, list[int]] = {t: [] for t in trees}

    def place(t: int, node: int, n: float, s: float) -> None:
        if n < params.min_samples_split or n < 2 * params.min_samples_leaf or node.bit_length() > params.depth():
            done.append((t, node, -1, None, s / n, int(n), 0.0))
        else:
            (small if n <= local else frontier)[t].append(node)

    def splits() -> dict[int, _Splits]:
        return {t: _Splits(*(np.array(c, dtype=k) for c, k in zip(list(zip(*v)) or [(), (), ()], (np.int64, np.int64, np.float64)))) for t, v in inner.items()}

    for t in trees:
        (small if rows <= local else frontier)[t].append(1)
    while any(frontier.values()):
        wanted = {t: np.array(sorted(v), dtype=np.int64) for t, v in frontier.items() if v}
        frontier = {t: [] for t in trees}
        sums = coded.mapInArrow(_bin_sums(splits(), wanted, p, bins, seed), "tree int, node long, v array<double>")
        added = vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("v")).getField("sum"))
        for row in sums.groupBy("tree", "node").agg(added.alias("v")).toLocalIterator():  # a row an open node
            t, node = row["tree"], row["node"]
            each = np.asarray(row["v"], float).reshape(p, bins, 2)
            n, s = map(float, each[0].sum(axis=0))
            if not n:
                continue
            cut = None
            if n >= max(params.min_samples_split, 2 * params.min_samples_leaf) and node.bit_length() <= params.depth():
                cut = _searched_cut(each, t, node, params, seed)
            if cut is None:
                done.append((t, node, -1, None, s / n, int(n), 0.0))
                continue
            f, b, gain, (n_left, s_left) = cut
            done.append((t, node, f, float(b), s / n, int(n), gain))
            inner[t].append((node, f, float(b)))
            place(t, 2 * node, float(n_left), float(s_left))
            place(t, 2 * node + 1, float(n - n_left), float(s - s_left))
    out = coded.sparkSession.createDataFrame(done, NODES)
    if any(small.values()):
        waiting = {t: np.array(sorted(v), dtype=np.int64) for t, v in small.items() if v}
        dealt = coded.mapInArrow(_deal_weighted(splits(), waiting, p, seed), "tree int, node long, rows binary")
        out = out.unionByName(_spread(dealt).groupBy("tree", "node").applyInArrow(_finish_searched_groups(params, seed, p), NODES))
    return materialise(out, "forest_nodes")
