"""Quality by a sparse rule ensemble: tree paths become rules over text statistics, a lasso picks and weighs them.

A small forest is grown on the statistics of a bounded labelled sample. Every path from a root to a node is a rule, a
conjunction of bounds on statistics. A logistic lasso over the 0/1 values of all rules keeps few of them, and the rest
is a Spark column: the statistics of a text come from one Arrow function, the rules and the score are plain expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.llm.labelled import labelled_sample, logistic
from pricecast.llm.text import by_slices, chunks, mix, run_hashes
from pricecast.session import materialise

STATISTICS = (
    "n_words mean_word symbol_share upper_share digit_share short_share symbol_end_share distinct_share "
    "distinct_run_share mean_line repeat_share separator_share"
).split()
MAX_TRAIN = 20_000  # labelled rows used at most
RUN = 4  # words in a run of distinct_run_share

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*!|<>{}[]=+~^_\\/@`"]] = True
_SPACE_END = np.zeros(256, bool)
_SPACE_END[[ord(c) for c in "#$%&*!|"]] = True


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[ends] - total[starts]).astype(np.float64)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct values by owner."""
    _, at = np.unique(mix(values ^ mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(owner[at], minlength=n).astype(np.float64)


def statistics_of(blobs: list[bytes | None]) -> np.ndarray:
    """One row of STATISTICS for every text; shares of an empty text are 0."""
    out = np.zeros((len(blobs), len(STATISTICS)))
    for c in chunks(blobs):
        n = len(c.blobs)
        starts, ends, hashes, bounds = c.words()
        words = np.diff(bounds)
        owner = np.repeat(np.arange(n), words)
        at = lambda table: _sums(table[c.data], c.text_starts, c.text_ends)
        letters, some, any_letter = at(_LETTER), np.maximum(words, 1), None
        any_letter = np.maximum(letters, 1)
        size = (ends - starts).astype(np.float64)
        filled = np.bincount(owner, weights=size, minlength=n)
        last = c.data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        lines = _sums(c.data == 10, c.text_starts, c.text_ends) + 1
        grams = np.maximum(words - RUN + 1, 0)
        first = np.repeat(bounds[:-1], grams) + (np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams))
        runs = run_hashes(hashes, first, first + RUN, "word") if len(first) else np.zeros(0, np.uint64)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        cols = (
            np.minimum(words, 1e6),
            filled / some,
            at(_SYMBOL) / np.maximum(filled, 1),
            at(_UPPER) / any_letter,
            at(_DIGIT) / np.maximum(filled, 1),
            np.bincount(owner, weights=size <= 2, minlength=n) / some,
            np.bincount(owner, weights=_SPACE_END[last], minlength=n) / some,
            _distinct(hashes, owner, n) / some,
            np.where(grams > 0, _distinct(runs, np.repeat(np.arange(n), grams), n) / np.maximum(grams, 1), 1.0),
            words / lines,
            np.bincount(owner, weights=again, minlength=n) / some,
            np.bincount(owner, weights=(size == 1) & _SYMBOL[last], minlength=n) / some,
        )
        out[c.first : c.first + n] = np.stack(cols, axis=1)
    return out


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pa.Array) -> pa.Array:
    def rows(blobs: list) -> pa.Array:
        values = statistics_of(blobs)
        offsets = np.arange(len(values) + 1, dtype=np.int32) * len(STATISTICS)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return by_slices(texts, rows)


def with_statistics(df: DataFrame, text_col: str = "text", out: str = "_stats") -> DataFrame:
    """Adds an array of STATISTICS of the whole text (null: empty)."""
    return df.withColumn(out, _statistics(F.col(text_col).cast("binary")))


Rule = tuple[tuple[int, str, float], ...]  # bounds (statistic, "<=" or ">", value)


def paths(tree: str) -> list[Rule]:
    """Every path from the root to another node of a tree printed by Spark, bounds of one statistic merged."""
    found, stack = [], []
    for line in tree.splitlines():
        m = re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(line) - len(line.lstrip())
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (int(m[2]), m[3], float(m[4]))))
        best: dict[tuple[int, str], float] = {}
        for _, (k, op, v) in stack:
            best[k, op] = v if (k, op) not in best else (min if op == "<=" else max)(best[k, op], v)
        found.append(tuple(sorted((k, op, v) for (k, op), v in best.items())))
    return found


def rule_column(rule: Rule, stats: Column) -> Column:
    test = None
    for k, op, v in rule:
        one = stats[k] <= v if op == "<=" else stats[k] > v
        test = one if test is None else test & one
    return test.cast("double")


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[float, Rule]]

    def score(self, stats: Column) -> Column:
        return logistic(self.intercept, [(w, rule_column(r, stats)) for w, r in self.rules])

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[k]} {op} {v:.4g}" for k, op, v in r) for w, r in self.rules]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", max_train: int = MAX_TRAIN, trees: int = 24, depth: int = 3, penalty: float = 0.001) -> RuleModel:
    """Rule ensemble learned from the labelled rows that ``learn`` admits, about ``max_train`` of them at most.

    With no labelled row the score is one half; with rows of one label only it is their smoothed share.
    """
    sample = with_statistics(labelled_sample(docs, labels, "quality", learn, max_train, id_col)).select("y", "_stats")
    sample = materialise(sample, "sample")
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if ones in (0, n):
        share = (ones + 1) / (n + 2)
        return RuleModel(float(np.log(share / (1 - share))), [])
    train = sample.select(F.col("y").cast("double").alias("label"), "_stats", array_to_vector("_stats").alias("x"))
    forest = RandomForestClassifier(featuresCol="x", numTrees=trees, maxDepth=depth, seed=7, subsamplingRate=0.8, minInstancesPerNode=5).fit(train)
    rules = sorted({r for t in forest.trees for r in paths(t.toDebugString)})
    if not rules:
        return RuleModel(float(np.log(ones / (n - ones))), [])
    held = train.select("label", array_to_vector(F.array(*[rule_column(r, F.col("_stats")) for r in rules])).alias("x"))
    held = materialise(held, "rules")
    lasso = LogisticRegression(featuresCol="x", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60).fit(held)
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), [(float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6])


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of docs and the score between 0 and 1 (higher: better)."""
    return with_statistics(docs, text_col).withColumn(out, model.score(F.col("_stats"))).drop("_stats")
