"""Gradient boosting on binned features, with early stopping by patience.

The table is binned once. Every tree grows level by level: a task adds up, for each open node, the residuals by feature
and bin, Spark adds the tasks' sums, and the driver picks the cuts from a few thousand numbers whatever the table's size.
Residuals are kept with the binned table: it is written again, with the trees so far taken off, every few rounds; between
that the tasks take off the latest trees themselves. A table that is one partition has no sums to add: its task runs all
rounds and returns the trees. Training ends when the validation error has not improved for
``patience`` rounds, and the model is cut back to the best round; the history keeps the rounds after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.session import materialise

ROWS_A_TASK = 50_000  # a smaller table is one partition: its passes are many and short
FEW_TASKS = 16  # the driver adds the sums of so many tasks itself; those of more are added up by Spark
REWRITE = 16  # rounds between two writings of the residuals
IMPROVES = 1e-6  # a lower validation error by less is no improvement: fixed value
_ROUND = "number int, epoch int, train_loss double, val_loss double, feature array<bigint>, cut array<double>, value array<double>, best int"


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    subsample: float = 1.0
    max_bins: int = 64
    patience: int | None = None


@dataclass
class Tree:
    """A tree by node number (1 is the root, 2k and 2k + 1 the children of k): feature (-1 in leaves), cut and value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def leaf(cls, depth: int, value: float) -> Tree:
        size = 1 << (depth + 1)
        return cls(np.full(size, -1), np.zeros(size), np.full(size, value))

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node every row ends in; values at or below a cut go left."""
        at = np.ones(len(x), dtype=np.int64)
        going = np.arange(len(x)) if self.feature[1] >= 0 else np.zeros(0, np.int64)
        while len(going):
            here = at[going]
            at[going] = 2 * here + (x[going, self.feature[here]] > self.cut[here])
            going = going[self.feature[at[going]] >= 0]
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(x)]


@dataclass
class BoostedTrees:
    """Base value plus the learning rate times the sum of the trees."""

    base: float
    rate: float
    trees: list[Tree]
    features: str | list[str]
    size: int
    history: list[tuple[int, float, float]] = field(default_factory=list)
    best_round: int = 0

    def transform(self, df: DataFrame, features: str | list[str] | None = None) -> DataFrame:
        """Adds ``prediction`` from the model's features, or others in their place; NULL where one is missing."""
        base, rate, p = self.base, self.rate, self.size
        sent = df.sparkSession.sparkContext.broadcast(self.trees)  # bounded by the number of rounds and the depth

        def run(rows: pa.Array) -> pa.Array:
            there = rows.is_valid().to_numpy(zero_copy_only=False)
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            out = np.full(len(rows), np.nan)
            out[there] = base + rate * sum((t.predict(x) for t in sent.value), np.zeros(len(x)))
            return pa.array(out, mask=~there)

        run.__annotations__ = {"rows": pa.Array, "return": pa.Array}
        x = feature_array(features or self.features)
        complete = F.when(F.forall(x, lambda v: v.isNotNull()), x)
        return df.withColumn("prediction", F.arrow_udf(run, T.DoubleType())(complete))

    def loss_history(self, spark: SparkSession) -> DataFrame:
        """``(epoch, train_loss, val_loss, is_best)`` of all rounds, those after the best one too."""
        rows = spark.createDataFrame(self.history, "epoch int, train_loss double, val_loss double")
        return rows.withColumn("is_best", F.col("epoch") == self.best_round)


def feature_array(features: str | list[str]) -> Column:
    return F.col(features) if isinstance(features, str) else F.array(*[F.col(f"`{f}`").cast("double") for f in features])


def _codes(batch: pa.RecordBatch, p: int) -> np.ndarray:
    """The codes of a batch: values of p bytes that lie end to end."""
    column = batch.column("codes")
    if not len(column):
        return np.zeros((0, p), np.uint8)
    start = int(np.frombuffer(column.buffers()[1], np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(column.buffers()[2], np.uint8, len(column) * p, start).reshape(-1, p)


def _residuals(batch: pa.RecordBatch, p: int, recent: list[Tree], rate: float) -> tuple[np.ndarray, np.ndarray]:
    codes = _codes(batch, p)
    r = batch.column("residual").to_numpy().copy()
    for t in recent:
        r -= rate * t.predict(codes)
    return codes, r


def _sampled(keys: np.ndarray, share: float, seed: int) -> np.ndarray:
    """The rows a round learns from, by a hash of their key and the round's seed."""
    with np.errstate(over="ignore"):
        x = (keys.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share


def _added(parts: Iterable[tuple[np.ndarray, ...]], p: int, bins: int, tree: Tree, opened: list[int], share: float, seed: int) -> np.ndarray:
    """The sums of :func:`_sums` over parts of codes, residuals, held-out marks and keys; a row for every open node."""
    total = np.zeros((len(opened), p, bins, 2))
    losses = np.zeros(4)
    where = np.full(len(tree.feature), -1)
    where[opened] = np.arange(len(opened))
    for codes, r, held, keys in parts:
        for i, rows in enumerate((~held, held)):
            losses[2 * i : 2 * i + 2] += rows.sum(), (r[rows] ** 2).sum()
        learn = ~held & _sampled(keys, share, seed) if share < 1 else ~held
        codes, r = codes[learn], r[learn]
        slot = where[tree.nodes(codes)]
        codes, r, slot = codes[slot >= 0], r[slot >= 0], slot[slot >= 0]
        for f in range(p):
            at = slot * bins + codes[:, f]
            total[:, f, :, 0] += np.bincount(at, minlength=len(opened) * bins).reshape(-1, bins)
            total[:, f, :, 1] += np.bincount(at, weights=r, minlength=len(opened) * bins).reshape(-1, bins)
    values = np.zeros((len(opened), p * bins * 2 + 4))
    values[:, :-4] = total.reshape(len(opened), -1)
    values[0, -4:] = losses
    return values


def _sums(p: int, bins: int, recent: list[Tree], rate: float, tree: Tree, opened: list[int], share: float, seed: int):
    """Of every open node: count and residual sum by feature and bin; and four sums of the losses, with the first node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((*_residuals(b, p, recent, rate), b.column("valid").to_numpy(zero_copy_only=False), b.column("key").to_numpy()) for b in batches)
        values = _added(parts, p, bins, tree, opened, share, seed)
        offsets = pa.array(np.arange(len(opened) + 1, dtype=np.int32) * values.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(opened, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], names=["node", "v"])

    return run


def _best_cut(sums: np.ndarray, least: int) -> tuple[int, int, np.ndarray, np.ndarray] | None:
    """(feature, bin, (count, sum) left, right) of the largest fall of the squared error, the first of equal ones."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    whole = sums[0].sum(axis=0)
    right = whole - left
    allowed = (left[..., 0] >= least) & (right[..., 0] >= least)
    if not allowed.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - whole[1] ** 2 / whole[0], -np.inf)
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    return (int(f), int(b), left[f, b], right[f, b]) if gain[f, b] > 1e-12 else None


def cuts_of(rows: DataFrame, p: int, max_bins: int) -> list[np.ndarray]:
    """Bin bounds of every feature of the array ``x``: its quantiles, equal ones once. One aggregation."""
    asked = F.array(*[F.lit((i + 1) / max_bins) for i in range(max_bins - 1)])
    found = rows.agg(*[F.percentile_approx(F.col("x")[f], asked, F.lit(100 * max_bins)).alias(f"f{f}") for f in range(p)]).first()
    return [np.unique(np.array(c if c is not None else [], dtype=float)) for c in found]


def fit_boosting(train: DataFrame, features: str | list[str], label: str, params: BoostParams, seed: int = 42, validation: str | None = None, size: int | None = None) -> BoostedTrees:
    """Boosted regression trees on squared error over the complete rows.

    ``features`` are columns, or the name of one array column of ``size`` entries. ``validation`` names a boolean column:
    its rows are never learnt from, and their error decides the best round; without it all rounds stay. An empty table
    is an error.
    """
    p = size if isinstance(features, str) else len(features)
    x = feature_array(features)
    held = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    rows = train.select(x.alias("x"), F.col(label).cast("double").alias("y"), held.alias("valid"))
    rows = rows.where(F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    rows = materialise(rows.withColumn("key", F.xxhash64("x", "y")), "boost_rows")
    base = rows.where(~F.col("valid")).agg(F.avg("y")).first()[0]
    if base is None:
        raise ValueError("no complete rows to learn from")
    cuts = cuts_of(rows.where(~F.col("valid")), p, params.max_bins)
    bins = max(len(c) for c in cuts) + 1

    def code(values: pa.Array) -> pa.Array:
        z = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
        codes = np.column_stack([np.searchsorted(c, z[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.uint8)
        flat = codes.tobytes()
        return pa.array([flat[i : i + p] for i in range(0, len(flat), p)], pa.binary())

    code.__annotations__ = {"values": pa.Array, "return": pa.Array}
    table = rows.select(F.arrow_udf(code, T.BinaryType())("x").alias("codes"), (F.col("y") - base).alias("residual"), "valid", "key")
    tasks = max(1, rows.count() // ROWS_A_TASK)
    table = materialise(table.coalesce(tasks), "boost_binned")
    model = BoostedTrees(float(base), params.learning_rate, [], features, p)
    if tasks == 1:
        _rounds_in_a_task(table, model, bins, params, seed)
    else:
        recent: list[Tree] = []

        def add(tree: Tree) -> None:
            nonlocal table, recent
            recent.append(tree)
            if len(recent) == REWRITE:
                table, recent = _rewritten(table, p, recent, params.learning_rate), []

        def found(tree: Tree, opened: list[int], number: int) -> dict[int, np.ndarray]:
            return _collected(table, p, bins, recent, params, tree, opened, seed + number, tasks <= FEW_TASKS)

        _rounds(model, bins, params, found, add)
    if validation:
        model.trees = model.trees[: model.best_round]
    else:
        model.best_round = len(model.trees)
    for tree in model.trees:  # cuts in values instead of bins
        for k in np.flatnonzero(tree.feature >= 0):
            tree.cut[k] = cuts[tree.feature[k]][int(tree.cut[k])]
    return model


def _rewritten(table: DataFrame, p: int, recent: list[Tree], rate: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, r = _residuals(batch, p, recent, rate)
            yield pa.RecordBatch.from_arrays([batch.column("codes"), pa.array(r), batch.column("valid"), batch.column("key")], names=["codes", "residual", "valid", "key"])

    return materialise(table.mapInArrow(run, table.schema), "boost_residuals")


def _rounds(model: BoostedTrees, bins: int, params: BoostParams, found: Callable, add: Callable[[Tree], None]) -> None:
    """Adds trees and the history of losses to the model. ``found`` gives the sums of a tree's open nodes, ``add`` takes off its predictions."""
    best = np.inf
    for number in range(1, params.n_estimators + 2):
        tree, losses = _grow(model.size, bins, params, lambda tree, opened: found(tree, opened, number), number > params.n_estimators)
        if number > 1:  # the losses are those of the rounds before
            train_loss, val_loss = losses
            model.history.append((number - 1, train_loss, val_loss))
            if val_loss < best - IMPROVES:
                best, model.best_round = val_loss, number - 1
            if params.patience and number - 1 - model.best_round >= params.patience:
                break
        if number > params.n_estimators:
            break
        model.trees.append(tree)
        add(tree)


def _rounds_in_a_task(table: DataFrame, model: BoostedTrees, bins: int, params: BoostParams, seed: int) -> None:
    """All rounds over a table of one partition, of fewer than twice ROWS_A_TASK rows; what comes back is a row for each round."""
    p, rate = model.size, model.rate

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(*_residuals(b, p, [], rate), b.column("valid").to_numpy(zero_copy_only=False), b.column("key").to_numpy()) for b in batches]
        own = BoostedTrees(0.0, rate, [], [], p)

        def add(tree: Tree) -> None:
            for codes, r, _, _ in parts:
                r -= rate * tree.predict(codes)

        def found(tree: Tree, opened: list[int], number: int) -> dict[int, np.ndarray]:
            return dict(zip(opened, _added(parts, p, bins, tree, opened, params.subsample, seed + number)))

        if parts:
            _rounds(own, bins, params, found, add)
        losses = [*own.history, *[(None, None, None)] * (len(own.trees) - len(own.history))]
        columns = [pa.array([x[i] for x in losses], t) for i, t in enumerate((pa.int32(), pa.float64(), pa.float64()))]
        columns += [pa.array([getattr(t, k) for t in own.trees], pa.list_(v)) for k, v in (("feature", pa.int64()), ("cut", pa.float64()), ("value", pa.float64()))]
        numbers = pa.array(range(1, len(own.trees) + 1), pa.int32())
        yield pa.RecordBatch.from_arrays([numbers, *columns, pa.array([own.best_round] * len(numbers), pa.int32())], names=[c.split()[0] for c in _ROUND.split(", ")])

    rounds = table.coalesce(1).mapInArrow(run, _ROUND).toArrow().sort_by("number").to_pylist()
    for x in rounds:
        model.trees.append(Tree(np.array(x["feature"]), np.array(x["cut"]), np.array(x["value"])))
        if x["epoch"] is not None:
            model.history.append((x["epoch"], x["train_loss"], x["val_loss"]))
        model.best_round = x["best"]


def _collected(table: DataFrame, p: int, bins: int, recent: list[Tree], params: BoostParams, tree: Tree, opened: list[int], seed: int, few_tasks: bool) -> dict[int, np.ndarray]:
    """The sums of the open nodes, added up over the tasks."""
    sums = table.mapInArrow(_sums(p, bins, recent, params.learning_rate, tree, opened, params.subsample, seed), "node int, v array<double>")
    if not few_tasks:
        added = Summarizer.metrics("sum").summary(array_to_vector("v")).getField("sum")
        sums = sums.groupBy("node").agg(vector_to_array(added).alias("v"))  # a row an open node
    found = dict.fromkeys(opened, 0.0)
    for batch in sums.toArrow().to_batches():
        for node, v in zip(batch.column("node").to_pylist(), batch.column("v")):
            found[node] = found[node] + v.values.to_numpy()
    return found


def _grow(p: int, bins: int, params: BoostParams, sums: Callable, losses_only: bool) -> tuple[Tree, tuple[float, float]]:
    """The next tree, and the mean squared errors before it (training's for both where nothing is held out)."""
    tree = Tree.leaf(params.max_depth, 0.0)
    opened = [1]
    losses = (np.nan, np.nan)
    for level in range(max(1, params.max_depth)):
        found = sums(tree, opened)
        if level == 0:
            n, e, held_n, held_e = found[1][-4:]
            losses = (float(e / n), float(held_e / held_n) if held_n else float(e / n))
            if losses_only:
                break
        following = []
        for node in opened:
            each = found[node][:-4].reshape(p, bins, 2)
            n, s = each[0].sum(axis=0)
            if level == 0:
                tree.value[1] = s / n if n else 0.0
            if level >= params.max_depth or n < params.min_samples_split or not (cut := _best_cut(each, params.min_samples_leaf)):
                continue
            f, b, left, right = cut
            tree.feature[node], tree.cut[node] = f, b
            for child, (child_n, child_s) in ((2 * node, left), (2 * node + 1, right)):
                tree.value[child] = child_s / child_n
                if child_n >= max(2, params.min_samples_split):
                    following.append(child)
        opened = following
        if not opened:
            break
    return tree, losses
