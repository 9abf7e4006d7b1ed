"""Delay probabilities as column expressions (minutes unless a name says seconds)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv


def _poly(x: Column, coefficients: Sequence[float]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def norm_cdf(z: Column) -> Column:
    """Standard normal CDF, absolute error near 1e-15."""
    return F.lit(0.5) + F.sign(z) * (0.5 - _upper_tail(F.abs(z)))


def _upper_tail(x: Column) -> Column:
    return F.exp(-x * x / 2) * _poly(x, fv.CDF_TOP) / _poly(x, fv.CDF_BOTTOM)


def norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF for p in (0, 1)."""
    def tail(mass: Column) -> Column:
        q = F.sqrt(-2.0 * F.log(mass))
        return _poly(q, fv.PPF_C) / _poly(q, fv.PPF_D + (1.0,))
    centred = p - 0.5
    r = centred * centred
    body = _poly(r, fv.PPF_A) * centred / _poly(r, fv.PPF_B + (1.0,))
    return F.when(p < fv.PPF_LOW, tail(p)).when(p > 1 - fv.PPF_LOW, -tail(1.0 - p)).otherwise(body)


def lognormal_cdf(x: Column, mu: Column, sigma: Column, mean: Column, offset: float = fv.LN_OFFSET) -> Column:
    shifted = x + F.lit(offset)
    return (
        F.when(shifted <= 0, 0.0)
        .when(sigma <= 0, F.when(x >= mean, 1.0).otherwise(0.0))
        .otherwise(norm_cdf((F.log(shifted) - mu) / sigma))
    )


def lognormal_ppf(p: Column, mu: Column, sigma: Column, mean: Column, offset: float = fv.LN_OFFSET) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1.0 - 1e-12))
    return F.when(sigma <= 0, mean).otherwise(F.exp(mu + sigma * norm_ppf(safe)) - F.lit(offset))


def _interpolate(x: Column, xs: Sequence[Column], ys: Sequence[Column]) -> Column:
    """Piecewise linear through (xs, ys) inside the grid; equal xs take the last segment start."""
    chain = F
    for i in range(len(xs) - 1):
        segment = ys[i] + (ys[i + 1] - ys[i]) * (x - xs[i]) / (xs[i + 1] - xs[i])
        chain = chain.when(x < xs[i + 1], segment)
    return chain.otherwise(ys[-1])


def _probs() -> list[Column]:
    return [F.lit(q) for q in fv.QUANTILES]


def delay_cdf(x: Column, qs: Sequence[Column], mu: Column, sigma: Column, mean: Column) -> Column:
    """P(delay <= x): interpolated quantiles between q05 and q95, lognormal at and outside both."""
    return F.when((x <= qs[0]) | (x >= qs[6]), lognormal_cdf(x, mu, sigma, mean)).otherwise(
        _interpolate(x, qs, _probs()))


def delay_quantile(p: Column, qs: Sequence[Column], mu: Column, sigma: Column, mean: Column) -> Column:
    """Inverse of :func:`delay_cdf` with the same splice points."""
    inside = (p > fv.QUANTILES[0]) & (p < fv.QUANTILES[6])
    return F.when(inside, _interpolate(p, _probs(), list(qs))).otherwise(lognormal_ppf(p, mu, sigma, mean))


def clamped_cdf(x: Column, qs: Sequence[Column]) -> Column:
    """Interpolated quantiles without tails: the end probabilities hold outside the grid."""
    return F.when(x < qs[0], fv.QUANTILES[0]).otherwise(_interpolate(x, qs, _probs()))


def _expected(values: Sequence[Column]) -> Column:
    """Trapezoid over the probability grid plus the two outer masses, clipped to [0, 1]."""
    ps = fv.QUANTILES
    # Each value's weight in the trapezoid sum, so that it is evaluated once.
    weights = [ps[0] + (ps[1] - ps[0]) / 2]
    weights += [(ps[i + 1] - ps[i - 1]) / 2 for i in range(1, len(ps) - 1)]
    weights += [(ps[-1] - ps[-2]) / 2 + (1.0 - ps[-1])]
    total = values[0] * weights[0]
    for value, weight in zip(values[1:], weights[1:]):
        total = total + value * weight
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))


def dist_columns(prefix: str = "") -> dict:
    """Quantiles and fit of a distribution held in columns with a common prefix."""
    return {"qs": [F.col(prefix + c) for c in fv.QUANTILE_COLS], "mu": F.col(prefix + "ln_mu"),
            "sigma": F.col(prefix + "ln_sigma"), "mean": F.col(prefix + "mean")}


def computed_once(value: Column) -> Column:
    """``value`` as a generated column: later filters read it instead of repeating its expression below."""
    return F.explode_outer(F.array(value))


def with_delay_cdf(df: DataFrame, points: dict[str, Column], prefix: str = "") -> DataFrame:
    """``df`` with P(delay <= x) for each named point x, by the distribution in the prefixed columns.

    Same values as :func:`delay_cdf`, computed in steps so that every logarithm and polynomial is evaluated once per
    point: as one expression the generated code would repeat them and outgrow the JVM's method limit.
    """
    d = dist_columns(prefix)
    step = df.select("*", *[x.cast("double").alias(f"_x_{n}") for n, x in points.items()])
    step = step.select("*", *[
        F.when(F.col(f"_x_{n}") + fv.LN_OFFSET > 0, (F.log(F.col(f"_x_{n}") + fv.LN_OFFSET) - d["mu"])
               / F.when(d["sigma"] > 0, d["sigma"])).alias(f"_z_{n}") for n in points])
    step = step.select("*", *[F.abs(f"_z_{n}").alias(f"_u_{n}") for n in points])
    step = step.select("*", *[_upper_tail(F.col(f"_u_{n}")).alias(f"_t_{n}") for n in points])

    def value(n: str) -> Column:
        x, z, tail = (F.col(f"_{k}_{n}") for k in "xzt")
        outside = (F.when(x + fv.LN_OFFSET <= 0, 0.0).when(d["sigma"] <= 0, F.when(x >= d["mean"], 1.0).otherwise(0.0))
                   .when(z > 0, 1.0 - tail).otherwise(tail))
        return F.when((x <= d["qs"][0]) | (x >= d["qs"][6]), outside).otherwise(_interpolate(x, d["qs"], _probs()))

    return step.select(*[F.col(c) for c in df.columns], *[value(n).alias(n) for n in points])


def _with_expectation(df: DataFrame, out: str, names: list[str]) -> DataFrame:
    return df.withColumn(out, _expected([F.col(n) for n in names])).drop(*names)


def with_p_connection(df: DataFrame, out: str, slack_sec: Column, arr_prefix: str, dep_prefix: str) -> DataFrame:
    """``df`` with P(arrival delay - departure delay <= slack): the arrival CDF averaged over departure quantiles.

    NULL where a distribution is missing.
    """
    slack = slack_sec / 60.0
    names = [f"_f{i}" for i in range(len(fv.QUANTILES))]
    points = {n: F.col(dep_prefix + q) + slack for n, q in zip(names, fv.QUANTILE_COLS)}
    out_df = _with_expectation(with_delay_cdf(df, points, arr_prefix), "_p", names)
    known = F.col(arr_prefix + "mean").isNotNull() & F.col(dep_prefix + "mean").isNotNull()
    return out_df.select("*", computed_once(F.when(known, F.col("_p"))).alias(out)).drop("_p")


def with_p_connection_clamped(df: DataFrame, out: str, slack_sec: Column, arr_prefix: str, dep_prefix: str) -> DataFrame:
    """As :func:`with_p_connection` with the end probabilities in place of the lognormal tails."""
    arr = [F.col(arr_prefix + c) for c in fv.QUANTILE_COLS]
    names = [f"_f{i}" for i in range(len(fv.QUANTILES))]
    step = df.select("*", *[(F.col(dep_prefix + q) + slack_sec / 60.0).alias(f"_x{n}")
                            for n, q in zip(names, fv.QUANTILE_COLS)])
    step = step.select("*", *[clamped_cdf(F.col(f"_x{n}"), arr).alias(n) for n in names])
    step = _with_expectation(step, "_p", names).drop(*[f"_x{n}" for n in names])
    return step.select("*", computed_once(F.col("_p")).alias(out)).drop("_p")


def p_connection_normal(slack_sec: Column, avg_sec: Column, std_sec: Column) -> Column:
    """Normal model of one stop and hour; certain where no statistics exist."""
    return (
        F.when(avg_sec.isNull(), 1.0)
        .when(std_sec <= 0, F.when(slack_sec >= avg_sec, 1.0).otherwise(0.0))
        .otherwise(norm_cdf((slack_sec - avg_sec) / std_sec))
    )


def p_transfer(q: Column, from_distribution: Column, from_normal: Column) -> Column:
    """Policy of the search: certain at Q = 0, else distribution model, else normal model, else certain."""
    return F.when(q == 0, 1.0).otherwise(F.coalesce(from_distribution, from_normal, F.lit(1.0)))
