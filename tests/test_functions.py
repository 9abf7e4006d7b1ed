import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.functions import fixed_values as fv
from headway.functions import probability as pr
from headway.functions import scalars as sc


def one(spark, rows, schema, **columns):
    return [r.asDict() for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_times_and_ids(spark):
    rows = [("08:05:09",), ("25:00:01",), ("",), ("7:xx:00",), ("12:30",), (None,)]
    got = one(spark, rows, "t string", s=sc.gtfs_seconds(F.col("t")))
    assert [r["s"] for r in got] == [29109, 90001, None, None, None, None]
    ids = one(spark, [("8501120:0:1",), ("Parent8501120",), ("8501120",)], "i string", n=sc.stop_number(F.col("i")))
    assert [r["n"] for r in ids] == [8501120, None, 8501120]
    hhmm = one(spark, [(90061,), (59,), (360000,)], "s bigint", t=sc.format_hhmm(F.col("s")))
    assert [r["t"] for r in hhmm] == ["25:01", "00:00", "100:00"]


def test_walk_rounding(spark):
    got = one(spark, [(50.0,), (51.0,), (0.4,)], "m double", up=sc.walk_seconds_stored(F.col("m")), down=sc.walk_seconds_search(F.col("m")))
    assert [(r["up"], r["down"]) for r in got] == [(60, 60), (62, 61), (1, 0)]


def test_normal_cdf_and_inverse(spark):
    zs = [float(z) for z in np.linspace(-9, 9, 181)]
    got = one(spark, [(z,) for z in zs], "z double", p=pr.norm_cdf(F.col("z")))
    for z, r in zip(zs, got):
        assert r["p"] == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=1e-14)
    ps = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.97, 0.98, 0.9999]
    back = one(spark, [(p,) for p in ps], "p double", q=pr.norm_cdf(pr.norm_ppf(F.col("p"))))
    for p, r in zip(ps, back):
        assert r["q"] == pytest.approx(p, abs=2e-9)


def brute_cdf(x, qs, mu, sigma, mean):
    if x <= qs[0] or x >= qs[6]:
        if x + 10 <= 0:
            return 0.0
        if sigma <= 0:
            return float(x >= mean)
        return 0.5 * (1 + math.erf((math.log(x + 10) - mu) / sigma / math.sqrt(2)))
    return float(np.interp(x, qs, fv.QUANTILES))


def test_connection_probability_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        qs = np.sort(np.round(rng.normal(1, 4, 8), 1 if i % 2 else 0))
        rows.append((*[float(q) for q in qs], float(rng.uniform(2, 3)), float(rng.uniform(0, 0.6)) if i % 9 else 0.0, float(rng.normal(1, 2)),
                     int(rng.integers(-400, 900))))
    schema = ", ".join(f"{c} double" for c in (*fv.QUANTILE_COLS, "ln_mu", "ln_sigma", "mean")) + ", slack int"
    df = spark.createDataFrame(rows, schema)
    got = pr.with_p_connection(df, "p", F.col("slack"), "", "").collect()
    clamped = pr.with_p_connection_clamped(df, "p", F.col("slack"), "", "").collect()
    ps = np.array(fv.QUANTILES)
    for r, c in zip(got, clamped):
        qs = np.array([r[q] for q in fv.QUANTILE_COLS])

        def total(fa):
            area = float(np.sum((fa[1:] + fa[:-1]) / 2 * np.diff(ps)))
            return min(max(area + fa[0] * ps[0] + fa[-1] * (1 - ps[-1]), 0), 1)
        fa = np.array([brute_cdf(d + r["slack"] / 60, qs, r["ln_mu"], r["ln_sigma"], r["mean"]) for d in qs])
        assert r["p"] == pytest.approx(total(fa), abs=1e-9)
        assert c["p"] == pytest.approx(total(np.interp(qs + r["slack"] / 60, qs, ps)), abs=1e-9)


def test_single_point_cdf_matches_stepwise(spark):
    schema = ", ".join(f"{c} double" for c in (*fv.QUANTILE_COLS, "ln_mu", "ln_sigma", "mean", "x"))
    df = spark.createDataFrame([(-2.0, -1.0, 0.0, 1.0, 1.0, 3.0, 6.0, 9.0, 2.4, 0.3, 1.1, x) for x in (-11.0, -2.0, 0.5, 1.0, 6.0, 20.0)], schema)
    a = [r["p"] for r in df.select(pr.delay_cdf(F.col("x"), **pr.dist_columns()).alias("p")).collect()]
    b = [r["p"] for r in pr.with_delay_cdf(df, {"p": F.col("x")}).collect()]
    assert a == pytest.approx(b, abs=1e-12)
