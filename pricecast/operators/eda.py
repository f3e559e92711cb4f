"""Profiles of a panel: the tables behind the usual charts.

Exact quantiles hold the distinct values of one group in a task. Groups here are a series, or a series and
month, of daily bars, so they are bounded by the calendar.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.operators.evaluate import safe_corr
from pricecast.session import materialise

# Category levels in display order: fixed values.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
BAR_COLUMNS = ("price", "open", "high", "low", "vol", "change_pct")


def summary_row(df: DataFrame, keys=("series_id",)) -> DataFrame:
    """Rows, date span, mean, deviation and extremes of the price, mean volume."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.avg("price").alias("mean_price"),
        F.stddev_samp("price").alias("std_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("vol").alias("mean_volume"),
    )


def describe(df: DataFrame, columns=BAR_COLUMNS, keys=("series_id",)) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per key and column."""
    stats = []
    for c in columns:
        q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        stats.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).cast("double").alias("count_values"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                q[0].alias("q25"),
                q[1].alias("q50"),
                q[2].alias("q75"),
                F.max(c).alias("max"),
            ).alias(f"s_{c}")
        )
    wide = df.groupBy(*keys).agg(*stats)
    rows = F.explode(F.array(*[F.col(f"s_{c}") for c in columns])).alias("s")
    return wide.select(*keys, rows).select(*keys, "s.*")


QUANTILE_BINS = 1024


def exact_quantiles(df: DataFrame, c: str, qs: tuple[float, ...], keys=("series_id",), bins: int = QUANTILE_BINS) -> DataFrame:
    """``(keys, quantiles)``: linear-interpolation quantiles of the finite values, in the order of ``qs``.

    Exact selection in passes: counts by equal bins say which bin holds a rank, and the next pass cuts that bin, from its
    least to its largest value, into bins again until it holds one value. What is kept is the bins' counts, however many
    values a group has, and a thousandfold narrower range a pass. A group without values gets no row.
    """
    keys = list(keys)
    finite = F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = materialise(df.where(finite).select(*keys, F.col(c).cast("double").alias("_x")), "quantile_rows")
    groups = materialise(rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")), "quantile_groups")
    places = [F.lit(float(q)) * (F.col("_n") - 1) for q in qs]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in places for f in (F.floor, F.ceil)]))
    state = materialise(groups.select(*keys, F.explode(ranks).alias("_rank"), "_lo", "_hi", F.lit(0).cast("long").alias("_below")), "quantile_ranks")
    found = state.where("_lo = _hi")
    opened = state.where("_lo < _hi")
    by = [*keys, "_rank"]
    while not opened.isEmpty():
        inside = rows.join(opened, keys).where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
        place = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)
        counts = inside.groupBy(*by, F.least(place, F.lit(bins - 1)).alias("_bin")).agg(
            F.count("*").alias("_k"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.first("_below").alias("_below")
        )
        so_far = F.sum("_k").over(Window.partitionBy(*by).orderBy("_bin"))
        counts = counts.withColumn("_upto", F.col("_below") + so_far)
        holds = (F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_k") <= F.col("_rank"))
        state = materialise(counts.where(holds).select(*by, "_lo", "_hi", (F.col("_upto") - F.col("_k")).alias("_below")), "quantile_ranks")
        found = found.unionByName(state.where("_lo = _hi"))
        opened = state.where("_lo < _hi")
    values = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_v")).join(groups, keys)
    value = lambda p, f: F.element_at("_v", f(p).cast("long"))
    return values.select(*keys, F.array(*[value(p, F.floor) + (p - F.floor(p)) * (value(p, F.ceil) - value(p, F.floor)) for p in places]).alias("quantiles"))


def quantile(df: DataFrame, c: str, q: float, keys=("series_id",), out: str = "quantile") -> DataFrame:
    """Linear-interpolation quantile of the finite values."""
    return exact_quantiles(df, c, (q,), keys).select(*keys, F.col("quantiles")[0].alias(out))


def mean_by_level(df: DataFrame, c: str, level: Column, levels: tuple[str, ...], keys=("series_id",)) -> DataFrame:
    """Mean of ``c`` for every level, levels without rows kept. ``level`` is the 0-based level number."""
    df = df.withColumn("_level", level)
    means = [
        F.struct(
            F.lit(i).alias("level_no"), F.lit(name).alias("level_name"), F.avg(F.when(F.col("_level") == i, F.col(c))).alias("mean")
        ).alias(f"m{i}")
        for i, name in enumerate(levels)
    ]
    wide = df.groupBy(*keys).agg(*means)
    return wide.select(*keys, F.explode(F.array(*[f"m{i}" for i in range(len(levels))])).alias("m")).select(*keys, "m.*")


def box_stats(df: DataFrame, c: str, keys: list[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 times the quartile distance, and the number of values beyond them."""
    group = Window.partitionBy(*keys)
    df = df.withColumn("_q", F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(group))
    q1, med, q3 = (F.col("_q")[i] for i in range(3))
    inside = (F.col(c) >= q1 - 1.5 * (q3 - q1)) & (F.col(c) <= q3 + 1.5 * (q3 - q1))
    return df.groupBy(*keys).agg(
        F.count(c).alias("n_rows"),
        F.first(q1).alias("q1"),
        F.first(med).alias("median"),
        F.first(q3).alias("q3"),
        F.min(F.when(inside, F.col(c))).alias("whisker_low"),
        F.max(F.when(inside, F.col(c))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def correlation_matrix(df: DataFrame, columns=BAR_COLUMNS, keys=("series_id",)) -> DataFrame:
    """Pearson correlation of every ordered pair; each unordered pair is computed once."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.groupBy(*keys).agg(*[safe_corr(F.col(a), F.col(b)).alias(f"{a}|{b}") for a, b in pairs])
    cell = lambda a, b, v: F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), v.alias("correlation"))
    cells = [cell(c, c, F.lit(1.0)) for c in columns]
    for a, b in pairs:
        v = F.col(f"`{a}|{b}`")
        cells += [cell(a, b, v), cell(b, a, v)]
    return wide.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*")


def top_n(df: DataFrame, c: str, n: int, *ties: str) -> DataFrame:
    """The n rows with the highest value, missing values last."""
    return df.orderBy(F.col(c).desc_nulls_last(), *ties).limit(n)


def tail_n(df: DataFrame, n: int, keys=("series_id",)) -> DataFrame:
    """Last n rows of every key."""
    w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return df.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= n).drop("_back")


def histogram(df: DataFrame, c: str, bins: int, keys: list[str]) -> DataFrame:
    """Counts of equal-width bins from minimum to maximum, empty bins kept, last bin closed on the right."""
    group = Window.partitionBy(*keys)
    df = df.withColumns({"_lo": F.min(c).over(group), "_hi": F.max(c).over(group)})
    # A constant column gets one unit of width around its value.
    flat = F.col("_lo") == F.col("_hi")
    lo = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    hi = F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi"))
    df = df.withColumns({"_lo": lo, "_hi": hi})
    width = (F.col("_hi") - F.col("_lo")) / bins
    df = df.withColumn("_bin", F.least(F.floor((F.col(c) - F.col("_lo")) / width), F.lit(bins - 1)))
    counted = df.groupBy(*keys).agg(
        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.array(*[F.count_if(F.col("_bin") == i) for i in range(bins)]).alias("_counts"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(*keys, "_lo", width.alias("_width"), F.posexplode("_counts").alias("bin", "n_rows")).select(
        *keys, "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        "n_rows",
    )


#: Terms of the expansion of a kernel around the middle of a bin, half a bandwidth wide: exact to rounding.
EXPANSION = 14


def _hermite(order: int) -> list[list[int]]:
    """Coefficients, by rising power, of the Hermite polynomials that the derivatives of exp(-u^2 / 2) bring."""
    rows = [[1], [0, 1]]
    for k in range(1, order):
        up = [0, *rows[k]]
        rows.append([v - k * (rows[k - 1][j] if j < len(rows[k - 1]) else 0) for j, v in enumerate(up)])
    return rows[: order + 1]


def density(df: DataFrame, c: str, keys: list[str], grid: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid reaching three bandwidths past the data (Scott's rule).

    Values are summed up by bins of half a bandwidth as powers of their distance to the middle of the bin, in tasks first,
    so the shuffle carries one row a bin whatever the number of values; a bin then stands for all its kernels at once.
    """
    group = df.groupBy(*keys).agg(
        F.count(c).cast("double").alias("_n"), F.stddev_samp(c).alias("_sd"), F.min(c).alias("_lo"), F.max(c).alias("_hi")
    )
    group = group.withColumn("_bw", F.col("_sd") * F.pow("_n", F.lit(-0.2))).where("_bw > 0")
    stop, start = F.col("_hi") + 3 * F.col("_bw"), F.col("_lo") - 3 * F.col("_bw")
    group = group.withColumns({"_start": start, "_step": (stop - start) / (grid - 1)})
    half = F.col("_bw") / 2
    placed = df.where(F.col(c).isNotNull()).join(group.select(*keys, "_lo", "_bw"), keys)
    placed = placed.withColumn("_bin", F.floor((F.col(c) - F.col("_lo")) / half))
    middle = F.col("_lo") + (F.col("_bin") + 0.5) * half
    placed = placed.select(*keys, "_bin", ((F.col(c) - middle) / F.col("_bw")).alias("_t"))
    power, sums = F.lit(1.0), []
    for k in range(EXPANSION + 1):
        sums.append((F.sum(power) / math.factorial(k)).alias(f"_m{k}"))
        power = power * F.col("_t")
    bins = placed.groupBy(*keys, "_bin").agg(*sums).join(group, keys)
    rows = _hermite(EXPANSION)
    factors = [sum((F.lit(float(rows[k][j])) * F.col(f"_m{k}") for k in range(j, EXPANSION + 1, 2)), F.lit(0.0)).alias(f"_a{j}") for j in range(EXPANSION + 1)]
    bins = bins.select(*keys, "_n", "_bw", "_start", "_step", middle.alias("_middle"), *factors)
    bins = bins.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    x = F.col("_start") + F.col("point") * F.col("_step")
    bins = bins.withColumn("_x", x).withColumn("_u", (F.col("_x") - F.col("_middle")) / F.col("_bw"))
    total = F.col(f"_a{EXPANSION}")
    for j in range(EXPANSION - 1, -1, -1):
        total = total * F.col("_u") + F.col(f"_a{j}")
    part = F.exp(-0.5 * F.col("_u") * F.col("_u")) * total / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi))
    return bins.groupBy(*keys, "point").agg(F.first("_x").alias("x"), F.sum(part).alias("density"))
