"""Mixing to target weights with soft membership, in DataFrame expressions only.

A naive Bayes classifier over counts of letter groups is learned from labelled rows and gives every document a
posterior over domains. Documents get nonnegative rates whose expected domain token totals,
``sum(rate x tokens x posterior)``, match the targets in the least-squares sense. Projected gradient steps touch the
documents only through sums by domain and by pair of domains, so a step is one aggregate and what travels is a few numbers.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricecast.session import materialise

#: Letter groups whose counts tell domains apart; the rest of a text's characters is one more group.
GROUPS = ("[äöüßÄÖÜ]", "[éèêàçôûîÉÈÊÀÇ]", "[ñóíáúÑÓÍÁÚ]", "th|wh|Th|Wh", "sch|ung|eit|Sch", "eau|eux|oi", "ción|ue|os", "[wkyWKY]")
TOKEN = r"[^\x20\x09-\x0D]+"
STRENGTH = 60.0  # a text weighs like so many characters, so posteriors stay soft
PASSES = 100  # aggregates at most, or a few more; targets not met by then are reported as such
HALVINGS = 30  # of a step, at most
SOFT = 1e-11  # weight of the distance to 1 against the squared relative misses
ENOUGH = 1e-6  # largest relative miss of targets that are met


def with_groups(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds _n (words of the whole text; null is empty) and _g (share of every letter group, then of the rest)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counts = [F.regexp_count(text, F.lit(g)).cast("double") for g in GROUPS]
    df = df.withColumn("_n", F.regexp_count(text, F.lit(TOKEN)).cast("double")).withColumn("_c", F.array(*counts)).withColumn("_size", F.length(text))
    size = F.greatest(F.col("_size"), F.lit(1)).cast("double")
    rest = F.col("_size") - F.aggregate("_c", F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("_g", F.transform(F.concat("_c", F.array(F.greatest(rest.cast("double"), F.lit(0.0)))), lambda x: x / size)).drop("_c", "_size")


def fit_posterior(labelled: DataFrame, domain_col: str, domains: Sequence[str]) -> list[Column]:
    """Posterior of every domain as a column over _g, from rows with _g and a known domain.

    A domain without labelled rows has the smoothed prior and the mean shares of all; without any labelled row the
    posteriors are equal.
    """
    k = len(GROUPS) + 1
    rows = labelled.filter(F.col(domain_col).isin(*domains)).groupBy(domain_col).agg(F.count("*"), *[F.sum(F.col("_g")[j]) for j in range(k)]).collect()
    seen = {r[0]: (r[1], [r[2 + j] for j in range(k)]) for r in rows}  # a row a domain
    n = sum(c for c, _ in seen.values())
    overall = [(sum(s[j] for _, s in seen.values()) + 0.01) / (n + 0.01 * k) for j in range(k)]
    scores = []
    for d in domains:
        count, sums = seen.get(d, (0, [0.0] * k))
        share = [(sums[j] + overall[j]) / (count + 1) for j in range(k)]
        total = sum(share)
        terms = [F.col("_g")[j] * F.lit(STRENGTH * math.log(s / total)) for j, s in enumerate(share)]
        scores.append(F.lit(math.log((count + 1) / (n + len(domains)))) + reduce(lambda a, b: a + b, terms))
    most = F.greatest(*scores) if len(scores) > 1 else scores[0]
    raised = [F.exp(s - most) for s in scores]
    return [e / reduce(lambda a, b: a + b, raised) for e in raised]


def with_posteriors(docs: DataFrame, labelled_ids: DataFrame, domains: Sequence[str], domain_col: str = "lang", id_col: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep``, the id, _n (words) and _p (array of posteriors in the order of ``domains``).

    Learns from rows whose id is labelled. Counts of letter groups are made once and written to the shared folder;
    the labelled rows are picked from those, so no text is shuffled.
    """
    columns = list(dict.fromkeys((*keep, id_col, domain_col)))
    ready = materialise(with_groups(docs).select(*columns, "_n", "_g"), "groups")
    ids = labelled_ids.select(F.col(id_col).alias("_id")).distinct()
    some = ready.select(F.col(id_col).alias("_id"), F.col(domain_col).alias("_d"), "_g").join(ids, "_id", "left_semi")
    return ready.select(*dict.fromkeys((*keep, id_col)), "_n", F.array(*fit_posterior(some, "_d", domains)).alias("_p"))


def rate_column(steps: Sequence[Sequence[float]]) -> Column:
    """Rate of a document after the given steps (one number a domain each), from 1 and never below 0."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    dot = lambda g: F.aggregate(F.zip_with("_p", g, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(moves, F.lit(1.0), lambda w, g: F.greatest(F.lit(0.0), w - dot(g)))


class Rates(NamedTuple):
    """Steps that lead to the rates, the targets, the totals reached, and whether these meet the targets."""

    steps: list[list[float]]
    targets: list[float]
    reached: list[float]
    converged: bool


def fit_rates(docs: DataFrame, weights: Mapping[str, float], total: float | None = None) -> Rates:
    """Rates of least squared miss, each miss against the domain's own total, and of these the ones nearest to 1.

    docs: columns _n and _p. Targets are the weights' shares of ``total`` expected tokens; without it, of the least
    total at which no domain shrinks. All rates lie on the projection ``max(0, 1 - p . step)`` of one step with a number
    a domain, whose gradient is the miss. The step is improved by the inverse of the domains' Gram matrix over documents
    with a rate above 0, shortened until the objective falls: convex in a handful of numbers, so the sums of a few passes
    settle it. ``converged`` is false where the targets are not met, as for a domain without tokens; the rates then come
    as near as nonnegative rates can. Without documents all totals are 0 and count as met.
    """
    domains = list(weights)
    k = len(domains)
    whole = sum(weights.values())
    docs = materialise(docs.select("_n", "_p"), "posteriors")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(step: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals by domain, the Gram matrix of the documents in use, and half their squared rates."""
        rated = docs.withColumn("_w", rate_column([step.tolist()]))
        mass, free = F.col("_n") * F.col("_w"), F.when(F.col("_w") > 0, F.col("_n")).otherwise(0.0)
        totals = [F.sum(mass * F.col("_p")[j]) for j in range(k)]
        row = rated.agg(*totals, *[F.sum(free * F.col("_p")[i] * F.col("_p")[j]) for i, j in pairs], F.sum(mass * F.col("_w")) / 2).first()
        values = np.array([float(x or 0.0) for x in row])
        gram = np.zeros((k, k))
        for (i, j), v in zip(pairs, values[k:-1]):
            gram[i, j] = gram[j, i] = v
        return values[:k], gram, values[-1]

    step = np.zeros(k)
    reached, gram, half = sums(step)
    if not reached.any():
        return Rates([], [0.0] * k, [0.0] * k, True)
    start = np.maximum(reached, 1e-9 * reached.max())
    if total is None:
        total = max((c * whole / weights[d] for c, d in zip(reached, domains) if weights[d] > 0), default=0.0)
    targets = np.array([total * weights[d] / whole for d in domains])
    soft = SOFT * start  # bounds the step where the targets cannot be met
    objective, passes, gains = half, 1, True
    while gains and passes < PASSES:
        slope = targets - reached + soft * step
        if np.abs(slope / start).max() < 1e-10:
            break
        move = np.linalg.solve(gram + np.diag(soft), -slope)
        share = 1.0
        for _ in range(HALVINGS):
            tried = step + share * move
            its_reached, its_gram, half = sums(tried)
            passes += 1
            its_objective = half + targets @ tried + 0.5 * soft @ np.square(tried)
            if its_objective <= objective + 1e-4 * share * slope @ move:
                break
            share /= 2
        else:
            break
        gains = objective - its_objective > 1e-12 * abs(objective)
        step, reached, gram, objective = tried, its_reached, its_gram, its_objective
    met = bool(np.abs((reached - targets) / start).max() <= ENOUGH)
    return Rates([step.tolist()], targets.tolist(), reached.tolist(), met)


def mix(docs: DataFrame, labelled_ids: DataFrame, weights: Mapping[str, float], total: float | None = None, domain_col: str = "lang") -> DataFrame:
    """Columns row (all columns of docs as a struct), n_tokens, share (posteriors in the order of ``weights``) and rate.

    A null text has no tokens and the prior as its posterior.
    """
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    packed = packed.select("row", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "text", domain_col)])
    ready = with_posteriors(packed, labelled_ids, list(weights), domain_col, keep=("row",))
    fitted = fit_rates(ready, weights, total)
    return ready.select("row", F.col("_n").cast("long").alias("n_tokens"), F.col("_p").alias("share"), rate_column(fitted.steps).alias("rate"))


def copies(rate: Column, *keys: Column) -> Column:
    """Times to take a document: the whole part of its rate, and once more with the chance of the rest, by a hash."""
    chance = F.pmod(F.xxhash64(*keys), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")
