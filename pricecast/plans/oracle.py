"""SQL twins of the catalogue queries, for checking results with another engine.

Shared common table expressions come first; :func:`sql` puts those a query needs in front of it.
"""

from __future__ import annotations

# name -> (names it reads, text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trades": (
        (),
        """SELECT l_returnflag AS series_id, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS p, l_quantity AS q,
        row_number() OVER (PARTITION BY l_returnflag, CAST(l_shipdate AS DATE)
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS up,
        row_number() OVER (PARTITION BY l_returnflag, CAST(l_shipdate AS DATE)
            ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS dn
        FROM lineitem WHERE isodow(l_shipdate) <= 5""",
    ),
    "day_bars": (
        ("trades",),
        """SELECT series_id, date, max(CASE WHEN dn = 1 THEN p END) AS price, max(CASE WHEN up = 1 THEN p END) AS open,
        max(p) AS high, min(p) AS low, sum(q) AS vol FROM trades GROUP BY series_id, date""",
    ),
    "bars": (
        ("day_bars",),
        """SELECT *, 100 * (price / lag(price) OVER w - 1) AS change_pct,
        row_number() OVER w AS rn, count(*) OVER (PARTITION BY series_id) AS n
        FROM day_bars WINDOW w AS (PARTITION BY series_id ORDER BY date)""",
    ),
    "rets": (
        ("bars",),
        """SELECT *, price / lag(price) OVER w - 1 AS ret, CASE WHEN n - rn < 252 THEN 'test' ELSE 'train' END AS split
        FROM bars WINDOW w AS (PARTITION BY series_id ORDER BY date)""",
    ),
    "raw": (
        (),
        """SELECT l_returnflag AS series_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        CASE WHEN l_linenumber = 7 AND day(l_shipdate) = 31 THEN '2024-13-40'
             WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y-%m-%d')
             ELSE strftime(l_shipdate, '%m/%d/%Y') END AS "Date",
        CASE WHEN l_linenumber = 5 AND l_tax = 0.08 THEN format('{:,.2f}', l_extendedprice)
             ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS "Price",
        CASE WHEN l_discount = 0.0 THEN ''
             WHEN l_discount <> 0.1 THEN CAST(CAST(l_extendedprice - l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS "Open",
        CAST(CAST(l_extendedprice + l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS "High",
        ' ' || CAST(CAST(l_extendedprice - 2 * l_quantity AS DECIMAL(18,2)) AS VARCHAR) || ' ' AS "Low",
        CASE WHEN l_quantity < 10 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'K'
             WHEN l_quantity < 20 THEN '1,0' || CAST(CAST(l_quantity AS INT) AS VARCHAR)
             WHEN l_quantity < 30 THEN '0.' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'm'
             WHEN l_quantity = 30 THEN '-' WHEN l_quantity = 31 THEN '' WHEN l_quantity = 32 THEN NULL
             WHEN l_quantity = 33 THEN '1.5KM'
             WHEN l_quantity >= 40 THEN ' 0.' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'B '
             ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS "Vol.",
        CASE WHEN l_tax = 0.0 THEN '' WHEN l_tax = 0.05 THEN '-1,2.5%'
             ELSE CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) || '.25%' END AS "Change %"
        FROM lineitem""",
    ),
    "parsed": (
        ("raw",),
        """SELECT series_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        COALESCE(CAST(try_strptime("Date", '%Y-%m-%d') AS DATE), CAST(try_strptime("Date", '%m/%d/%Y') AS DATE)) AS date,
        try_cast("Price" AS DOUBLE) AS price, try_cast(trim("Open") AS DOUBLE) AS open,
        try_cast(trim("High") AS DOUBLE) AS high, try_cast(trim("Low") AS DOUBLE) AS low,
        CASE WHEN "Vol." IS NULL OR "Vol." = '' THEN 0.0
             ELSE try_cast(regexp_replace(upper(trim(replace("Vol.", ',', ''))), '[KMB]$', '') AS DOUBLE)
             * CASE right(upper(trim("Vol.")), 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1.0 END END AS vol,
        try_cast(trim(replace(replace("Change %", '%', ''), ',', '')) AS DOUBLE) AS change_pct
        FROM raw""",
    ),
    "deduped": (
        ("parsed",),
        """SELECT series_id, date, price, open, high, low, vol, change_pct FROM parsed
        WHERE date IS NOT NULL AND price IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY series_id, date
            ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    ),
    "week": (("deduped",), "SELECT * REPLACE (COALESCE(vol, 0.0) AS vol) FROM deduped WHERE isodow(date) <= 5"),
    "clean": (
        ("week",),
        "SELECT series_id, date, "
        + ", ".join(
            f"COALESCE(last_value({c} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (PARTITION BY series_id "
            f"ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
            for c in ("price", "open", "high", "low", "vol", "change_pct")
        )
        + " FROM week",
    ),
    "lagroll": (
        ("bars",),
        "SELECT *, "
        + ", ".join(f"lag(price, {k}) OVER w AS price_lag_{k}" for k in (1, 2, 3, 5, 7, 14, 21, 30))
        + ", "
        + ", ".join(
            f"CASE WHEN count(price) OVER w{n} >= {n} THEN {f}(price) OVER w{n} END AS price_roll_{s}_{n}"
            for n in (7, 14, 30)
            for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
        )
        + " FROM bars WINDOW w AS (PARTITION BY series_id ORDER BY date), "
        + ", ".join(
            f"w{n} AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (7, 14, 30)
        ),
    ),
    "derived": (
        ("lagroll",),
        """SELECT d.*, CASE WHEN count(price_return_1) OVER v >= 14 THEN stddev_samp(price_return_1) OVER v END AS volatility_14
        FROM (SELECT *, price / price_lag_1 - 1 AS price_return_1, price / price_lag_7 - 1 AS price_return_7 FROM lagroll) d
        WINDOW v AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""",
    ),
    "emas": (
        ("bars",),
        """SELECT series_id, rn, date, CAST(price AS DOUBLE) AS e FROM bars WHERE rn = 1
        UNION ALL SELECT b.series_id, b.rn, b.date, CAST(13.0/15.0 AS DOUBLE) * r.e + CAST(2.0/15.0 AS DOUBLE) * b.price
        FROM emas r JOIN bars b ON b.series_id = r.series_id AND b.rn = r.rn + 1""",
    ),
    "features": (
        ("derived", "emas"),
        """SELECT d.*, e.e AS ema_14, isodow(d.date) - 1 AS day_of_week, day(d.date) AS day_of_month, week(d.date) AS week_of_year,
        month(d.date) AS month, quarter(d.date) AS quarter, year(d.date) AS year,
        CASE WHEN day(d.date) = 1 THEN 1 ELSE 0 END AS is_month_start,
        CASE WHEN d.date = last_day(d.date) THEN 1 ELSE 0 END AS is_month_end
        FROM derived d JOIN emas e ON e.series_id = d.series_id AND e.rn = d.rn - 1
        WHERE d.price_lag_30 IS NOT NULL AND d.price_roll_std_30 IS NOT NULL AND d.volatility_14 IS NOT NULL
        AND d.change_pct IS NOT NULL""",
    ),
    # Complete rows of the lag and rolling table, split by position: the base of all evaluation queries.
    "complete": (
        ("derived",),
        """SELECT *, CASE WHEN n - rn < 252 THEN 'test' ELSE 'train' END AS split FROM derived
        WHERE price_lag_30 IS NOT NULL AND volatility_14 IS NOT NULL""",
    ),
    "last_train": (
        ("complete",),
        "SELECT series_id, arg_max(price, date) AS last_price FROM complete WHERE split = 'train' GROUP BY series_id",
    ),
    "long": (
        ("complete", "last_train"),
        """SELECT c.series_id, c.date, m.model, c.price AS actual,
        CASE m.model WHEN 'naive' THEN c.price_lag_1 WHEN 'mean_7' THEN c.price_roll_mean_7 ELSE l.last_price END AS predicted
        FROM complete c JOIN last_train l USING (series_id), (VALUES ('naive'), ('mean_7'), ('last_train')) m(model)
        WHERE c.split = 'test'""",
    ),
    "scored": (
        ("long",),
        """SELECT series_id, model, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse, avg(abs(actual - predicted)) AS mae,
        avg(abs((actual - predicted) / CASE WHEN abs(actual) < 1e-8 THEN 1e-8 ELSE actual END)) AS mape,
        CASE WHEN var_pop(actual) = 0 THEN CASE WHEN avg((actual - predicted) * (actual - predicted)) = 0 THEN 1.0 ELSE 0.0 END
             ELSE 1 - avg((actual - predicted) * (actual - predicted)) / var_pop(actual) END AS r2
        FROM long GROUP BY series_id, model""",
    ),
    "vols": (
        ("rets",),
        """SELECT *, CASE WHEN count(ret) OVER v >= 14 THEN stddev_samp(ret) OVER v END AS vol14 FROM rets
        WINDOW v AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    ),
    "thresholds": (
        ("vols",),
        """SELECT series_id, COALESCE(quantile_cont(CASE WHEN split = 'train' THEN vol14 END, 0.75), 0.0) AS threshold
        FROM vols GROUP BY series_id""",
    ),
    "regime": (
        ("vols", "thresholds"),
        """SELECT v.series_id, v.date, v.vol14 AS volatility, t.threshold, COALESCE(v.vol14 >= t.threshold, false) AS is_high
        FROM vols v JOIN thresholds t USING (series_id) WHERE v.split = 'test'""",
    ),
    "rolled": (
        ("long",),
        """SELECT *, CASE WHEN count(*) OVER r >= 5 THEN sqrt(avg((actual - predicted) * (actual - predicted)) OVER r) END AS rolling_rmse
        FROM long WINDOW r AS (PARTITION BY series_id, model ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    ),
    "board": (
        ("rolled", "regime"),
        """SELECT r.series_id, r.model, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse, avg(abs(actual - predicted)) AS mae,
        avg(abs((actual - predicted) / CASE WHEN abs(actual) < 1e-8 THEN 1e-8 ELSE actual END)) AS mape,
        1 - avg((actual - predicted) * (actual - predicted)) / var_pop(actual) AS r2,
        sqrt(avg(CASE WHEN is_high THEN (actual - predicted) * (actual - predicted) END)) AS rmse_high_volatility,
        sqrt(avg(CASE WHEN NOT is_high THEN (actual - predicted) * (actual - predicted) END)) AS rmse_low_volatility,
        avg(rolling_rmse) AS rolling_rmse_mean, max(rolling_rmse) AS rolling_rmse_max,
        sum(abs(actual - predicted)) * 10000.0 AS procurement_abs_error_cost
        FROM rolled r JOIN regime g ON g.series_id = r.series_id AND g.date = r.date GROUP BY r.series_id, r.model""",
    ),
    "ewma": (
        ("rets",),
        """SELECT r.series_id, r.rn, r.ret, CAST(0.94 AS DOUBLE) * s.seed + CAST(0.06 AS DOUBLE) * p.ret * p.ret AS v
        FROM rets r JOIN rets p ON p.series_id = r.series_id AND p.rn = r.rn - 1
        JOIN (SELECT series_id, var_pop(ret) AS seed FROM rets WHERE split = 'train' GROUP BY series_id) s ON s.series_id = r.series_id
        WHERE r.n - r.rn = 251
        UNION ALL SELECT r.series_id, r.rn, r.ret, CAST(0.94 AS DOUBLE) * e.v + CAST(0.06 AS DOUBLE) * e.ret * e.ret
        FROM ewma e JOIN rets r ON r.series_id = e.series_id AND r.rn = e.rn + 1""",
    ),
}

CTES["feature_rows"] = (("features",), "SELECT *, CASE WHEN n - rn < 252 THEN 'test' ELSE 'train' END AS split FROM features")

RECURSIVE = {"emas", "ewma"}


def add_ridge(name: str, source: str, features: list[str], alpha: float) -> None:
    """Adds ``name (series_id, b0, b)``: ridge on standardised features, solved by elimination on lists."""
    p = len(features)
    cells = lambda f: ", ".join(f"{f}({c})" for c in features)
    rows = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in features) + "]" for a in features)
    CTES[f"{name}_sums"] = (
        (source,),
        f"""SELECT series_id, CAST(count(*) AS DOUBLE) AS n, [{cells('avg')}] AS mx, avg(price) AS my,
        list_transform([{cells('stddev_pop')}], lambda s: CASE WHEN s < 1e-12 THEN 0.0 ELSE 1.0 / s END) AS inv,
        [{', '.join(f'covar_pop({c}, price)' for c in features)}] AS c, [{rows}] AS cc
        FROM {source} WHERE split = 'train' GROUP BY series_id""",
    )
    CTES[f"{name}_steps"] = (
        (f"{name}_sums",),
        f"""SELECT series_id, 0 AS k, list_transform(cc, lambda r, i: list_append(list_transform(r, lambda x, j:
        n * x * inv[i] * inv[j] + CASE WHEN i = j THEN CAST({alpha} AS DOUBLE) ELSE 0.0 END), n * c[i] * inv[i])) AS a FROM {name}_sums
        UNION ALL SELECT series_id, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / a[k + 1][k + 1])
        ELSE list_transform(r, lambda x, j: x - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END) FROM {name}_steps WHERE k < {p}""",
    )
    CTES[name] = (
        (f"{name}_sums", f"{name}_steps"),
        f"""SELECT series_id, b, my - list_dot_product(b, mx) AS b0 FROM (SELECT series_id, my, mx,
        list_transform(a, lambda r, i: r[{p + 1}] * inv[i]) AS b FROM {name}_steps JOIN {name}_sums USING (series_id) WHERE k = {p})""",
    )
    RECURSIVE.add(f"{name}_steps")


def add_ridge_search(name: str, source: str, features: list[str], alphas: list[float], k: int) -> None:
    """Adds ``name (series_id, alpha_no, alpha, cv_rmse)``: ridge on standardised features by penalty, over k walk-forward folds."""
    p = len(features)
    cells = lambda f: ", ".join(f"{f}({c})" for c in features)
    rows = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in features) + "]" for a in features)
    points = ", ".join(f"({i}, CAST({a!r} AS DOUBLE))" for i, a in enumerate(alphas))
    CTES[f"{name}_folds"] = (
        (source,),
        f"""SELECT c.*, f.fold, CASE WHEN pos >= cn - ({k} - f.fold) * (cn // {k + 1}) THEN 'test' ELSE 'train' END AS role FROM
        (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS cn
        FROM {source} WHERE split = 'train') c CROSS JOIN range({k}) f(fold) WHERE pos < cn - ({k} - f.fold) * (cn // {k + 1}) + (cn // {k + 1})""",
    )
    CTES[f"{name}_sums"] = (
        (f"{name}_folds",),
        f"""SELECT series_id, fold, CAST(count(*) AS DOUBLE) AS n, [{cells('avg')}] AS mx, avg(price) AS my,
        list_transform([{cells('stddev_pop')}], lambda s: CASE WHEN s < 1e-12 THEN 0.0 ELSE 1.0 / s END) AS inv,
        [{', '.join(f'covar_pop({c}, price)' for c in features)}] AS c, [{rows}] AS cc
        FROM {name}_folds WHERE role = 'train' GROUP BY series_id, fold""",
    )
    CTES[f"{name}_steps"] = (
        (f"{name}_sums",),
        f"""SELECT series_id, fold, alpha_no, alpha, 0 AS k, list_transform(cc, lambda r, i: list_append(list_transform(r, lambda x, j:
        n * x * inv[i] * inv[j] + CASE WHEN i = j THEN alpha ELSE 0.0 END), n * c[i] * inv[i])) AS a
        FROM {name}_sums CROSS JOIN (VALUES {points}) t(alpha_no, alpha)
        UNION ALL SELECT series_id, fold, alpha_no, alpha, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / a[k + 1][k + 1])
        ELSE list_transform(r, lambda x, j: x - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END) FROM {name}_steps WHERE k < {p}""",
    )
    RECURSIVE.add(f"{name}_steps")
    CTES[name] = (
        (f"{name}_folds", f"{name}_sums", f"{name}_steps"),
        f"""SELECT series_id, alpha_no, alpha, avg(rmse) AS cv_rmse FROM (
        SELECT f.series_id, f.fold, b.alpha_no, b.alpha, sqrt(avg(pow(price - b0 - list_dot_product(b.b, [{', '.join(f'CAST({c} AS DOUBLE)' for c in features)}]), 2))) AS rmse
        FROM {name}_folds f JOIN (SELECT *, my - list_dot_product(b, mx) AS b0 FROM (SELECT s.series_id, s.fold, alpha_no, alpha, my, mx,
        list_transform(a, lambda r, i: r[{p + 1}] * inv[i]) AS b FROM {name}_steps s JOIN {name}_sums USING (series_id, fold) WHERE k = {p})) b
        ON b.series_id = f.series_id AND b.fold = f.fold WHERE f.role = 'test' GROUP BY ALL) GROUP BY ALL""",
    )


def add_least_squares(name: str, source: str, names: list[str], target: str) -> None:
    """Adds ``name (series_id, b)``: least squares without a constant over complete train rows, by elimination on lists."""
    p = len(names)
    rows = ", ".join("[" + ", ".join([*(f"sum({a} * {b})" for b in names), f"sum({a} * {target})"]) + "]" for a in names)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*names, target])
    CTES[f"{name}_steps"] = (
        (source,),
        f"""SELECT series_id, 0 AS k, [{rows}] AS a FROM {source} WHERE split = 'train' AND {complete} GROUP BY series_id
        UNION ALL SELECT series_id, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / a[k + 1][k + 1])
        ELSE list_transform(r, lambda x, j: x - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END) FROM {name}_steps WHERE k < {p}""",
    )
    CTES[name] = ((f"{name}_steps",), f"SELECT series_id, list_transform(a, lambda r: r[{p + 1}]) AS b FROM {name}_steps WHERE k = {p}")
    RECURSIVE.add(f"{name}_steps")


def add_differences(name: str, lags: int) -> None:
    """Adds ``name``: rows of ``rets`` with the price before, the difference ``d`` and its lags ``d_1`` ..."""
    w = "OVER (PARTITION BY series_id ORDER BY date)"
    more = ", ".join(f"lag(d, {k}) {w} AS d_{k}" for k in range(1, lags + 1))
    CTES[name] = (
        ("rets",),
        f"""SELECT *, {more} FROM (SELECT series_id, date, price, split, rn, lag(price) {w} AS before, price - lag(price) {w} AS d FROM rets)""",
    )


def add_smoothing(name: str, points: str) -> None:
    """Adds ``name``: the damped-trend recurrence of every row (series_id, no, alpha, beta, phi) of ``points``.

    ``ahead`` is the forecast of the row, ``sse`` the squared error of all rows before it.
    """
    level, trend = "p.ahead + p.alpha * (p.price - p.ahead)", "p.phi * p.trend + p.alpha * p.beta * (p.price - p.ahead)"
    CTES[name] = (
        ("rets", points),
        f"""SELECT g.series_id, g.no, g.alpha, g.beta, g.phi, b.rn, b.date, b.split, b.price, b.price - a.price AS trend,
        a.price + g.phi * (b.price - a.price) AS ahead, CAST(0 AS DOUBLE) AS sse
        FROM {points} g JOIN rets a ON a.series_id = g.series_id AND a.rn = 1 JOIN rets b ON b.series_id = g.series_id AND b.rn = 2
        UNION ALL SELECT p.series_id, p.no, p.alpha, p.beta, p.phi, x.rn, x.date, x.split, x.price, {trend},
        {level} + p.phi * ({trend}), p.sse + (p.price - p.ahead) * (p.price - p.ahead)
        FROM {name} p JOIN rets x ON x.series_id = p.series_id AND x.rn = p.rn + 1""",
    )
    RECURSIVE.add(name)


def sql(body: str, *needs: str) -> str:
    """``body`` behind the expressions it needs. Long ones are computed once."""
    order: list[str] = []

    def visit(name: str) -> None:
        for d in CTES[name][0]:
            visit(d)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS {'' if n in RECURSIVE else 'MATERIALIZED '}({CTES[n][1]})" for n in order]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
