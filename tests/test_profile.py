"""Genome profiling against numpy on small fixtures."""
import random

import numpy as np

from allelic.operators import profile as P


def _pos(spark, rows):
    return spark.createDataFrame(rows, "g string, chromosome string, position int")


def test_single_row_std_is_one_million(spark):
    r = P.position_profile(_pos(spark, [("a", "1", 5)])).first()
    assert (r.n, r.std_position) == (1, 1e6)


def test_ecdf_knots(spark):
    df = _pos(spark, [("a", "1", p) for p in (40, 10, 30, 20)])
    got = [(r.position, r.ecdf) for r in P.position_ecdf(df).orderBy("position").collect()]
    assert got == [(10, 0.0), (20, 0.25), (30, 0.5), (40, 0.75)]


def test_quantile_matches_numpy_interp(spark):
    rnd = random.Random(11)
    rows = [("a", c, rnd.randint(1, 1000)) for c in ("1", "2") for _ in range(rnd.randint(1, 60))]
    rows += [("a", "3", 77)]  # single position
    us = [0.0, 0.05, 0.1, 0.33, 0.5, 0.9, 0.99, 1.0]
    got = {(r.chromosome, r.u): r.position for r in P.position_quantile(_pos(spark, rows), us).collect()}
    for c in ("1", "2", "3"):
        xs = sorted(p for _, cc, p in rows if cc == c)
        n = len(xs)
        knots = np.arange(n) / n
        for u in us:
            assert abs(got[(c, u)] - float(np.interp(u, knots, xs))) < 1e-3, (c, u)


def test_histogram_matches_numpy(spark):
    rnd = random.Random(2)
    vals = [rnd.randint(0, 10_000) for _ in range(2000)] + [10_000]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = [r["count"] for r in P.histogram(df, "x", bins=50).orderBy("bin").collect()]
    ref, _ = np.histogram(vals, bins=50)
    assert got == list(ref)
    dens = P.histogram(df, "x", bins=50, density=True).orderBy("bin").select("density").collect()
    refd, _ = np.histogram(vals, bins=50, density=True)
    assert np.allclose([r.density for r in dens], refd)


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(5,), (5,)], "x int")
    rows = P.histogram(df, "x", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 2, 0] and rows[0].bin_lo == 4.5


def test_boxplot_matches_numpy(spark):
    rnd = random.Random(9)
    vals = [rnd.gauss(0, 1) for _ in range(500)] + [8.0, -9.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, x double")
    for by in ([], ["g"]):
        r = P.boxplot_stats(df, "x", by=by).first()
        q1, med, q3 = np.percentile(vals, [25, 50, 75])
        iqr = q3 - q1
        inside = [v for v in vals if q1 - 1.5 * iqr <= v <= q3 + 1.5 * iqr]
        assert abs(r.q1 - q1) < 1e-4 and abs(r.median - med) < 1e-4 and abs(r.q3 - q3) < 1e-4
        assert abs(r.whisker_lo - min(inside)) < 1e-4 and abs(r.whisker_hi - max(inside)) < 1e-4
        assert r.outliers == len(vals) - len(inside)


def test_value_profile_and_shape(spark):
    df = spark.createDataFrame([("a", "AA"), ("a", "AA"), ("a", None), ("b", "AG")], "g string, genotype string")
    got = {(r.g, r.value): (r["count"], r.share) for r in P.value_profile(df, "genotype", by=["g"]).collect()}
    assert got == {("a", "AA"): (2, 1.0), ("b", "AG"): (1, 1.0)}
    nulls = P.null_counts(df).first()
    assert (nulls.g, nulls.genotype) == (0, 1)
    shape = {r.g: (r.rows, r.columns) for r in P.table_shape(df, ["g"]).collect()}
    assert shape == {"a": (3, 2), "b": (1, 2)}


def test_compare_chromosomes_pivot(spark):
    df = _pos(spark, [("a", "1", 1), ("a", "2", 1), ("b", "1", 1)])
    got = {r.chromosome: (r.a, r.b) for r in P.compare_chromosomes(df, "g", ["a", "b"]).collect()}
    assert got == {"1": (50.0, 100.0), "2": (50.0, None)}
