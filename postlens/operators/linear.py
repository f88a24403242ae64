"""Linear models by normal equations: one aggregate, solved in columns.

``normal_equations`` sums the products of regressors and target in one partial
aggregate, so a group of any size sends one small row a task. ``solve``
eliminates the bordered matrix with array functions inside the plan: a
million groups are solved in parallel, and none passes the driver. A
penalty is added to the diagonal, which makes it ridge regression.
``newton_logistic`` repeats one such aggregate (gradient and Hessian) for a
fixed number of steps.

The ``*_sql`` functions write the same computation for DuckDB.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR, WEEK = 365.25, 7.0


# ---------------------------------------------------------------- least squares
def _known(rows: DataFrame, k: int) -> DataFrame:
    """Rows without nulls, one condition a column (the optimiser would rewrite
    a joint condition with every combination of the columns' names)."""
    for c in [*(f"x{i}" for i in range(k)), "y"]:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def normal_equations(rows: DataFrame, xs: list[Column], y: Column, by: list[str], penalty: list[float] | None = None) -> DataFrame:
    """(by..., n, m): the matrix [X'X + penalty | X'y] of each group. Rows
    with a null regressor or target are left out."""
    k = len(xs)
    used = _known(rows.select(*by, *[x.cast("double").alias(f"x{i}") for i, x in enumerate(xs)], y.cast("double").alias("y")), k)
    sums = {f"s{i}_{j}": F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(k) for j in range(i, k)}
    sums |= {f"t{i}": F.sum(F.col(f"x{i}") * F.col("y")) for i in range(k)}
    total = used.groupBy(*by).agg(F.count("*").alias("n"), *[v.alias(c) for c, v in sums.items()])
    extra = penalty or [0.0] * k
    row = lambda i: F.array(*[F.col(f"s{min(i, j)}_{max(i, j)}") + (extra[i] if i == j else 0.0) for j in range(k)], F.col(f"t{i}"))
    return total.select(*by, "n", F.array(*[row(i) for i in range(k)]).alias("m"))


def solve(m: Column, k: int) -> Column:
    """Solution of a bordered k x (k + 1) system by elimination, null entries
    where it has none (the matrices here are symmetric and not negative, so
    no rows need be exchanged)."""
    def step(matrix: Column, i: Column) -> Column:
        own = F.element_at(matrix, i + 1)
        pivot = F.element_at(own, i + 1)
        unit = F.transform(own, lambda x: F.try_divide(x, pivot))
        clear = lambda row: F.zip_with(row, unit, lambda a, b: a - F.element_at(row, i + 1) * b)
        return F.transform(matrix, lambda row, r: F.when(r == i, unit).otherwise(clear(row)))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), m, step)
    return F.transform(done, lambda row: F.element_at(row, k + 1))


def dot(weights: Column, xs: list[Column]) -> Column:
    return sum((F.element_at(weights, i + 1) * x.cast("double") for i, x in enumerate(xs[1:], 1)), F.element_at(weights, 1) * xs[0].cast("double"))


def normal_equations_sql(xs: list[str], y: str, penalty: list[float] | None = None) -> str:
    """The bordered matrix as a DuckDB expression over the rows of a group."""
    extra = penalty or [0.0] * len(xs)
    rows = [", ".join([*(f"sum({a} * {b})" + (f" + {extra[i]!r}E0" if i == j else "") for j, b in enumerate(xs)), f"sum({a} * {y})"]) for i, a in enumerate(xs)]
    return "[" + ", ".join(f"[{r}]" for r in rows) + "]"


def solve_sql(k: int, source: str, name: str) -> str:
    """CTEs ``name``0 .. ``name``k that eliminate column ``m`` of ``source``;
    the solution is the last entry of each row of ``m`` in the last one."""
    out = [f"{name}0 AS (SELECT * FROM {source})"]
    for i in range(1, k + 1):
        unit = f"(m[{i}][j] / nullif(m[{i}][{i}], 0))"
        out.append(f"{name}{i} AS (SELECT * REPLACE (list_transform(m, lambda row, r: CASE WHEN r = {i} THEN list_transform(row, lambda x, j: {unit}) "
                   f"ELSE list_transform(row, lambda a, j: a - row[{i}] * {unit}) END) AS m) FROM {name}{i - 1})")
    return ",\n".join(out)


# ---------------------------------------------------------------- trend and seasonality
def seasonal_terms(yearly: int = 5, weekly: int = 3) -> list[tuple[str, float, int]]:
    """(name, period, order) of the seasonal pairs of columns."""
    return [("yearly", YEAR, k) for k in range(1, yearly + 1)] + [("weekly", WEEK, k) for k in range(1, weekly + 1)]


def seasonal_design(date: str, first: Column, yearly: int = 5, weekly: int = 3) -> tuple[list[str], list[Column]]:
    """Names and columns of constant, trend (years since ``first``) and the
    sine and cosine of each seasonal term."""
    day = F.unix_date(F.col(date)).cast("double")
    names, xs = ["level", "trend_per_year"], [F.lit(1.0), (day - F.unix_date(first)) / YEAR]
    for name, period, k in seasonal_terms(yearly, weekly):
        angle = day * (2.0 * math.pi * k / period)
        names += [f"{name}_sin_{k}", f"{name}_cos_{k}"]
        xs += [F.sin(angle), F.cos(angle)]
    return names, xs


def seasonal_design_sql(date: str, first: str, yearly: int = 5, weekly: int = 3) -> list[str]:
    day = "cast(datediff('day', DATE '1970-01-01', {}) AS DOUBLE)".format
    xs = ["1.0E0", f"(({day(date)} - {day(first)}) / {YEAR}E0)"]
    for _, period, k in seasonal_terms(yearly, weekly):
        angle = f"{day(date)} * {2.0 * math.pi * k / period!r}E0"
        xs += [f"sin({angle})", f"cos({angle})"]
    return xs


def seasonal_penalty(yearly: int = 5, weekly: int = 3, weight: float = 1.0) -> list[float]:
    """No penalty on level and trend, ``weight`` on each seasonal column
    (short series then have a solution, too)."""
    return [0.0, 0.0] + [weight] * (2 * len(seasonal_terms(yearly, weekly)))


# ---------------------------------------------------------------- logistic regression
STEPS = 8


def newton_logistic(rows: DataFrame, xs: list[Column], y: Column, penalty: list[float], steps: int = STEPS) -> np.ndarray:
    """Weights minimising log loss plus half the penalised squares, by Newton
    steps: each is one aggregate of k + k (k + 1) / 2 sums. The weights start
    at zero; an empty frame leaves them there."""
    k, pen = len(xs), np.array(penalty)
    used = rows.select(*[x.cast("double").alias(f"x{i}") for i, x in enumerate(xs)], y.cast("double").alias("y"))
    used = _known(used, k)
    w = np.zeros(k)
    for _ in range(steps):
        z = dot(F.array(*[F.lit(float(v)) for v in w]), [F.col(f"x{i}") for i in range(k)])
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        seen = used.withColumn("p", p).withColumn("v", F.col("p") * (F.lit(1.0) - F.col("p")))
        cells = [(i, j) for i in range(k) for j in range(i, k)]
        got = seen.agg(*[F.sum(F.col("v") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in cells],
                       *[F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")) for i in range(k)]).first()
        if got[0] is None:
            break
        h = np.diag(pen).astype(float)
        for (i, j), value in zip(cells, got):
            h[i, j] += value
            if i != j:
                h[j, i] += value
        w = w + np.linalg.solve(h, np.array(got[len(cells):], float) - pen * w)
    return w


def newton_logistic_sql(frame: str, k: int, penalty: list[float], steps: int = STEPS) -> str:
    """CTEs w0 .. w``steps``, one row with the weights ``w`` each, over the
    rows (x DOUBLE[], y DOUBLE) of ``frame``."""
    out = [f"w0 AS MATERIALIZED (SELECT [{', '.join(['0.0E0'] * k)}] AS w)"]
    xs = [f"x[{i + 1}]" for i in range(k)]
    for s in range(1, steps + 1):
        rows = []
        for i, a in enumerate(xs):
            cells = [f"sum(v * {a} * {b})" + (f" + {penalty[i]!r}E0" if i == j else "") for j, b in enumerate(xs)]
            rows.append(f"[{', '.join(cells)}, sum((y - p) * {a}) - {penalty[i]!r}E0 * any_value(w)[{i + 1}]]")
        out.append(f"h{s} AS MATERIALIZED (SELECT any_value(w) AS w, [{', '.join(rows)}] AS m FROM (SELECT *, p * (1.0E0 - p) AS v FROM "
                   f"(SELECT x, y, w, 1.0E0 / (1.0E0 + exp(-list_dot_product(x, w))) AS p FROM {frame}, w{s - 1}) q) r)")
        out.append(solve_sql(k, f"h{s}", f"g{s}_"))
        out.append(f"w{s} AS MATERIALIZED (SELECT list_transform(w, lambda a, i: a + m[i][{k + 1}]) AS w FROM g{s}_{k})")
    return ",\n".join(out)
