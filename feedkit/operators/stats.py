"""Least squares: fit, coefficient table, forecast.

Spark reduces the table to counts, means and covariances in one aggregation; only that k by k summary reaches the
driver, where it is solved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.errors import EmptyInput, FeedkitError, TooFewRows
from feedkit.operators.filters import complete_rows
from feedkit.sources.writers import write_version

TABLE_SCHEMA = "variable string, beta double, stderr double, t_value double, prob_t double"


@dataclass(frozen=True)
class LinearModel:
    """Fitted coefficients, one entry per variable; ``intercept`` is the last one."""

    variables: tuple[str, ...]
    beta: tuple[float, ...]
    stderr: tuple[float, ...]
    observations: int
    df_resid: int

    def rows(self) -> list[tuple]:
        """``variable, beta, stderr, t_value, prob_t``; t and p are null where the standard error is zero."""
        out = []
        for name, b, se in zip(self.variables, self.beta, self.stderr, strict=True):
            t = b / se if se > 0 else None
            out.append((name, b, se, t, two_sided_p(t, self.df_resid) if t is not None else None))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """The coefficient table."""
        return spark.createDataFrame(self.rows(), TABLE_SCHEMA)


def as_list(names: str | Sequence[str]) -> list[str]:
    """One name or several, as a list."""
    return [names] if isinstance(names, str) else list(names)


def ols_fit(
    df: DataFrame,
    x: str | Sequence[str],
    y: str | Sequence[str],
    min_obs: int = 0,
    intcp: int = 0,
    dropna: bool = True,
) -> LinearModel:
    """Least squares of y on x, with an intercept if ``intcp`` is 1 and through the origin if it is 0.

    Rows with a null in a used column are left out; with ``dropna=False`` they are an error.
    """
    if intcp not in (0, 1):
        raise ValueError("intcp must be 0 or 1")
    xs, (target,) = as_list(x), as_list(y)
    names = [*xs, target]
    used = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    used = used.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in names])
    if not dropna and not used.filter(" or ".join(f"`{c}` is null" for c in names)).isEmpty():
        raise FeedkitError("missing values in the used columns")
    k = len(names)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = (
        complete_rows(used, names)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
            *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
        )
        .first()
    )
    n = row["n"]
    if n == 0:
        raise EmptyInput("no row has a value in every column of the model")
    mean = np.array([row[f"m{i}"] for i in range(k)])
    cov = np.empty((k, k))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    if n < min_obs:
        raise TooFewRows(f"the fit has {n} complete rows and was asked for {min_obs} at least")
    return _solve(xs, n, mean, cov, bool(intcp))


def _solve(xs: list[str], n: int, mean: np.ndarray, cov: np.ndarray, intercept: bool) -> LinearModel:
    # Centred moments with an intercept, raw ones without.
    moment = cov if intercept else cov + np.outer(mean, mean)
    xx, xy, yy = moment[:-1, :-1] * n, moment[:-1, -1] * n, moment[-1, -1] * n
    inverse = np.linalg.pinv(xx, hermitian=True)
    beta = inverse @ xy
    df_resid = n - int(np.linalg.matrix_rank(xx, hermitian=True)) - int(intercept)
    ssr = max(float(yy - beta @ xy), 0.0)
    var = ssr / df_resid if df_resid > 0 else math.nan
    se = np.sqrt(var * np.diag(inverse))
    at_zero = float(mean[-1] - beta @ mean[:-1]) if intercept else 0.0
    at_zero_se = math.sqrt(var * (1 / n + mean[:-1] @ inverse @ mean[:-1])) if intercept else 0.0
    return LinearModel(
        (*xs, "intercept"), (*map(float, beta), at_zero), (*map(float, se), at_zero_se), n, df_resid
    )


def two_sided_p(t: float, df: int) -> float:
    """Two-sided p-value of Student's t."""
    if df <= 0 or math.isnan(t):
        return math.nan
    return _beta_share(df / (df + t * t), df / 2, 0.5)


def _beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(1 - x, b, a)
    scale = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    total = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            total *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return scale * total / a


def forecast(model: LinearModel, columns: Sequence[str], sigma: float = 0) -> Column:
    """Prediction from the columns of a table, each coefficient moved by ``sigma`` of its standard errors."""
    shifted = {v: b + sigma * se for v, b, se in zip(model.variables, model.beta, model.stderr, strict=True)}
    lost = [v for v in shifted if v != "intercept" and v not in columns]
    if lost:
        raise FeedkitError(f"variables missing from the data: {lost}")
    total = F.lit(shifted.pop("intercept"))
    for name, coefficient in shifted.items():
        total = total + F.lit(coefficient) * F.col(name)
    return total


def load_model(spark: SparkSession, path: str) -> LinearModel:
    """A model that ``save_model`` wrote, ready for ``forecast``. Counts of rows are not stored and read as 0."""
    rows = spark.read.schema(TABLE_SCHEMA).parquet(path).select("variable", "beta", "stderr").collect()
    if not rows:
        raise EmptyInput(f"no coefficients in {path}")
    # The intercept is the last one.
    rows.sort(key=lambda r: r["variable"] == "intercept")
    names, beta, stderr = zip(*map(tuple, rows), strict=True)
    return LinearModel(names, beta, stderr, 0, 0)


def save_model(spark: SparkSession, model: LinearModel | None, path: str, force_dir: bool = False) -> str | None:
    """The coefficient table written to the next free version of ``path``; nothing without a model."""
    if model is None:
        return None
    return write_version(model.table(spark).coalesce(1), path, force_dir=force_dir)
