"""Toxicity by weak supervision: voters, a label model of their accuracies and correlations, a linear classifier.

Voters are small lexicons and patterns that say toxic (1), clean (-1) or nothing (0). Lexicons are fixed lists by theme
and lists induced from the labelled rows that may be learned from: words, and beginnings of words, that stand in toxic
texts far more often than in others. The label model is a two-class mixture fitted by expectation maximisation; it
estimates each voter's accuracy in each class and the correlations that the class does not explain, and counts
correlated voters as the smaller number of independent ones that they are worth. Its posteriors are the soft labels of
a logistic regression over the voters' hit counts, which is then put on the scale of the known labels.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.llm.labelled import labelled_sample, logistic
from pricecast.llm.text import by_slices
from pricecast.session import materialise

# Words of abuse by theme.
THEMES = {
    "mind": "idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile imbeciles fool fools dimwit",
    "worth": "worthless loser losers pathetic useless nobody scumbag",
    "filth": "trash garbage scum filth filthy vermin pig pigs rat rats",
    "disgust": "disgusting disgrace vile revolting repulsive nasty",
    "mockery": "clown clowns freak freaks creep weirdo jerk jerks",
    "profane": "bastard bitch crap damn asshole shit fuck fucking bullshit",
    "german": "idiot trottel depp arschloch dummkopf blöd dumm abschaum versager scheiße",
    "french": "idiot imbécile crétin connard salaud débile merde ordure minable",
    "spanish": "idiota imbécil estúpido basura escoria cabrón mierda inútil asqueroso",
}
PATTERNS = {
    "address": r"\byou(?:'re| are)? (?:an? |such an? |all )?(?:idiot|moron|loser|clown|fool|trash|scum|stupid|pathetic|worthless|disgusting)",
    "threat": r"\b(?:kill|hurt|hate) (?:you|your\w*|them)\b|\bgo (?:die|to hell)\b",
    "masked": r"\b[a-z]+\*{2,}[a-z]*\b|\b(?:id10t|1diot|m0ron|l0ser|stup1d)\b",
    "shut": r"\bshut (?:the \w+ )?up\b",
}
WORD = re.compile(r"\w+")
MAX_TRAIN = 20_000  # labelled rows used at most
MAX_LEXICON = 1_000  # induced words, and as many beginnings, at most
SPLITS = 4  # induced words are dealt over so many voters
STEM = 5


@dataclass
class Voters:
    """Word lists by voter (with the pattern voters and the count voters after them)."""

    words: dict[str, int]
    stems: dict[str, int]

    @property
    def lexicons(self) -> int:
        return len(THEMES) + SPLITS

    @property
    def names(self) -> list[str]:
        return [*THEMES, *(f"induced{k}" for k in range(SPLITS)), "stems", *PATTERNS, "two", "three", "none"]

    def counts(self, text: str) -> list[int]:
        """Distinct words hit by lexicon, distinct stems hit, matches by pattern."""
        lower = text.lower()
        seen = set(WORD.findall(lower))
        out = [0] * (self.lexicons + 1)
        for w in seen & self.words.keys():
            for k in range(self.lexicons):
                if self.words[w] >> k & 1:
                    out[k] += 1
        out[-1] = len({w[:STEM] for w in seen if len(w) > STEM} & self.stems.keys())
        return out + [len(p.findall(lower)) for p in _patterns]


_patterns = [re.compile(p) for p in PATTERNS.values()]


def votes(counts: np.ndarray, lexicons: int) -> np.ndarray:
    """Votes of every voter from the hit counts."""
    words = counts[:, :lexicons].sum(axis=1)
    own = (counts > 0).astype(np.int8)
    two, three = (words >= 2).astype(np.int8), (words >= 3).astype(np.int8)
    none = -(counts.sum(axis=1) == 0).astype(np.int8)
    return np.column_stack([own, two, three, none])


def induce(sample: DataFrame, least: int = 3, times: float = 8.0) -> Voters:
    """Word lists of the voters: fixed themes, and what stands in toxic texts ``times`` as often as in others."""
    words: dict[str, int] = {}
    for k, theme in enumerate(THEMES.values()):
        for w in theme.split():
            words[w] = words.get(w, 0) | 1 << k

    def run(batches):
        for batch in batches:
            tally: Counter = Counter()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = set(WORD.findall((text or "").lower()))
                tally.update((w, "word", y) for w in seen)
                tally.update((w, "stem", y) for w in {w[:STEM] for w in seen if len(w) > STEM})
            keys = list(tally)
            yield pa.RecordBatch.from_pydict(
                {"term": [k[0] for k in keys], "kind": [k[1] for k in keys], "y": [k[2] for k in keys], "n": list(tally.values())},
                schema=pa.schema([("term", pa.string()), ("kind", pa.string()), ("y", pa.int32()), ("n", pa.int64())]),
            )

    texts = sample.groupBy("text").agg(F.max("y").alias("y"))  # copies count once
    texts = materialise(texts, "texts")
    toxic, clean = texts.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    if not toxic or not clean:
        return Voters(words, {})
    table = texts.select("text", "y").mapInArrow(run, "term string, kind string, y int, n long").groupBy("term", "kind")
    table = table.agg(F.sum(F.col("n") * F.col("y")).alias("a"), F.sum(F.col("n") * (1 - F.col("y"))).alias("b"))
    ratio = ((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1))
    strong = table.filter((F.col("a") >= least) & (ratio >= times)).withColumn("ratio", ratio)
    picked = {}
    for kind in ("word", "stem"):
        rows = strong.filter(F.col("kind") == kind).orderBy(F.desc(F.col("a") * F.log("ratio")), "term").limit(MAX_LEXICON).collect()
        picked[kind] = [r.term for r in rows]
    for i, w in enumerate(picked["word"]):
        words[w] = words.get(w, 0) | 1 << (len(THEMES) + i % SPLITS)
    return Voters(words, dict.fromkeys(picked["stem"], 1))


@dataclass
class LabelModel:
    """Two-class mixture over votes; weight is what a voter is worth beside those it is correlated with."""

    prior: float
    emit: np.ndarray  # class x voter x (clean, nothing, toxic)
    weight: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        logs = np.log(self.emit)
        z = np.log(self.prior / (1 - self.prior)) + sum(
            self.weight[j] * (logs[1, j, v[:, j] + 1] - logs[0, j, v[:, j] + 1]) for j in range(v.shape[1])
        )
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _worth(left: np.ndarray) -> np.ndarray:
    """Independent voters that each voter is worth, given correlations that its class does not explain."""
    left = np.maximum(left, 0)
    np.fill_diagonal(left, 0)
    return 1 / (1 + left.sum(axis=1))


def _correlation(v: np.ndarray, mass: np.ndarray) -> np.ndarray:
    total = max(mass.sum(), 1e-9)
    d = v - mass @ v / total
    cov = (d * mass[:, None]).T @ d / total
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    return cov / np.outer(sd, sd) * (np.outer(sd, sd) > 1e-4)


def fit_label_model(v: np.ndarray, prior: float = 0.1, rounds: int = 30) -> LabelModel:
    """Expectation maximisation from votes alone, started at the majority of the votes.

    Voters that all but repeat each other (correlation over 0.9) share one vote from the start; half way, what stays
    correlated within the classes is discounted too.
    """
    n, m = v.shape
    raw = _correlation(v, np.ones(n))
    worth = _worth(np.where(raw > 0.9, raw, 0.0))
    p = np.clip(prior + 0.4 * np.tanh((v > 0) @ worth - 0.5), 0.02, 0.98)
    for r in range(rounds):
        classes = np.stack([1 - p, p])
        mass = classes.sum(axis=1)
        emit = np.stack([[[classes[c] @ (v[:, j] == s) for s in (-1, 0, 1)] for j in range(m)] for c in (0, 1)])
        emit = (emit + 0.05) / (mass[:, None, None] + 0.15)
        if r == rounds // 2:
            worth = np.minimum(worth, _worth(np.maximum(_correlation(v, classes[0]), _correlation(v, classes[1]))))
        model = LabelModel(float(np.clip(mass[1] / n, 0.001, 0.999)), emit, worth)
        p = model.posterior(v)
    return model


@dataclass
class ToxicityModel:
    voters: Voters
    intercept: float
    weights: list[float]

    def score(self, counts: Column) -> Column:
        return logistic(self.intercept, [(w, F.log1p(counts[k].cast("double"))) for k, w in enumerate(self.weights)])


def with_counts(df: DataFrame, voters: Voters, text_col: str = "text", out: str = "_hits") -> DataFrame:
    """Adds the voters' hit counts of the whole text (null: empty)."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def hits(texts: pa.Array) -> pa.Array:
        return by_slices(texts, lambda rows: pa.array([voters.counts(t or "") for t in rows], type=pa.list_(pa.int32())))

    return df.withColumn(out, hits(F.col(text_col)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", max_train: int = MAX_TRAIN) -> ToxicityModel:
    """Model from the labelled rows that ``learn`` admits, about ``max_train`` of them at most.

    Without both labels there is nothing to learn and the score is the share of toxic rows, smoothed (one half
    without any).
    """
    sample = materialise(labelled_sample(docs, labels, "toxic", learn, max_train, id_col), "sample")
    voters = induce(sample)
    width = voters.lexicons + 1 + len(PATTERNS)
    held = materialise(with_counts(sample, voters).select("y", "_hits"), "hits")
    rows = held.groupBy("y", "_hits").agg(F.count("*").alias("n")).collect()  # bounded by max_train
    n, ones = sum(r.n for r in rows), sum(r.n for r in rows if r.y)
    if ones in (0, n):
        share = (ones + 1) / (n + 2)
        return ToxicityModel(voters, float(np.log(share / (1 - share))), [0.0] * width)
    counts = np.array([r._hits for r in rows], dtype=np.int64)
    repeat = np.repeat(np.arange(len(rows)), [r.n for r in rows])
    model = fit_label_model(votes(counts, voters.lexicons)[repeat])
    soft = model.posterior(votes(counts, voters.lexicons))
    spark = docs.sparkSession
    data = [(float(c), float(r.n * w), np.log1p(counts[i]).tolist()) for i, r in enumerate(rows) for c, w in ((1, soft[i]), (0, 1 - soft[i])) if w > 1e-6]
    train = spark.createDataFrame(data, "label double, weight double, a array<double>").withColumn("x", array_to_vector("a"))
    linear = LogisticRegression(featuresCol="x", weightCol="weight", regParam=0.002, maxIter=60).fit(train)
    z = linear.intercept + np.log1p(counts) @ linear.coefficients.toArray()
    scale = spark.createDataFrame([(float(r.y), float(r.n), [float(z[i])]) for i, r in enumerate(rows)], "label double, weight double, a array<double>")
    fitted = LogisticRegression(featuresCol="x", weightCol="weight", regParam=0.0005, maxIter=60).fit(scale.withColumn("x", array_to_vector("a")))
    slope = max(float(fitted.coefficients[0]), 1e-3)
    return ToxicityModel(voters, float(fitted.intercept + slope * linear.intercept), [slope * float(w) for w in linear.coefficients])


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of docs and the score between 0 and 1 (higher: toxic likelier)."""
    return with_counts(docs, model.voters, text_col).withColumn(out, model.score(F.col("_hits"))).drop("_hits")
