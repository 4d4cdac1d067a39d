"""Calibration, power and guards of the tests, and agreement with brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclemart.operators import resampling as rs
from cyclemart.operators.staging_area import materialise

TEST = [rs.SignFlipTest("m", "paired_sign_flip", "d", "d", "x", "y")]


def units(spark, x, y, by=None):
    rows = [(f"u{i:04d}", float(a), float(b), float(b - a)) for i, (a, b) in enumerate(zip(x, y))]
    return materialise(spark.createDataFrame(rows, "unit string, x double, y double, d double"), "units")


def one_sample(spark, values, null=0.5):
    rows = [(f"u{i:04d}", float(v), float(v - null)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "unit string, x double, c double")
    return frame, [rs.SignFlipTest("m", "one_sample_vs_0.5", "c", "x", "x")]


def run(frame, tests=TEST, **kwargs):
    return rs.sign_flip_tests(frame, tests, "unit", **kwargs).first()


def test_matches_brute_force(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(0.5, 0.03, 23)
    y = x + rng.normal(0.004, 0.01, 23)
    d, names, seed = y - x, [f"u{i:04d}" for i in range(23)], 5

    def word(*parts, number):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[8 * number:8 * number + 8], 16)

    def t(v):
        return v.mean() / (v.std(ddof=1) / math.sqrt(len(v)))

    null = []
    for p in range(1000):
        block, bit = divmod(p, 64)
        signs = [1 if word(seed, "flip", block, u, number=bit // 32) >> (bit % 32) & 1 else -1 for u in names]
        null.append(t(np.array(signs) * d))
    p_value = (1 + sum(abs(v) >= abs(t(d)) - 1e-12 for v in null)) / 1001
    order = sorted(names, key=lambda u: hashlib.md5(u.encode()).hexdigest())
    drawn = [d[names.index(u)] for u in order]
    means = [np.mean([drawn[word(seed, "boot", r // 4, j, number=r % 4) % 23] for j in range(23)]) for r in range(200)]
    low, high = np.quantile(means, [0.025, 0.975])

    got = run(units(spark, x, y), n_permutations=1000, n_bootstrap=200, seed=seed)
    assert got.observed == pytest.approx(t(d), rel=1e-9)
    assert got.p_value == pytest.approx(p_value)
    assert (got.ci_lower, got.ci_upper) == (pytest.approx(low, rel=1e-9), pytest.approx(high, rel=1e-9))
    assert got.effect_size_dz == pytest.approx(d.mean() / d.std(ddof=1))
    assert (got.mean_baseline, got.mean_comparison) == (pytest.approx(x.mean()), pytest.approx(y.mean()))


def test_real_shift_is_found(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0.5, 0.03, 137)
    got = run(units(spark, x, x + 0.02 + rng.normal(0, 0.01, 137)), statistic="mean_diff", n_permutations=4000, n_bootstrap=1000, seed=7)
    assert got.n_units == 137 and got.p_value < 0.01 and got.effect_size_dz > 0.5 and 0 < got.ci_lower < got.ci_upper


def test_close_to_the_parametric_p_value(spark):
    """For 90 Gaussian differences t has 89 degrees of freedom; the normal tail is within 0.01."""
    rng = np.random.default_rng(3)
    x = rng.normal(0.5, 0.04, 90)
    y = x + rng.normal(0.004, 0.02, 90)
    got = run(units(spark, x, y), n_permutations=20000, n_bootstrap=100, seed=11)
    d = y - x
    t = d.mean() / (d.std(ddof=1) / math.sqrt(90))
    assert got.observed == pytest.approx(t, rel=1e-9)
    assert got.p_value == pytest.approx(math.erfc(abs(t) / math.sqrt(2)), abs=0.02)


def test_p_value_floor(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0.5, 0.01, 50)
    got = run(units(spark, x, x + 1.0), statistic="mean_diff", n_permutations=1000, n_bootstrap=100)
    assert got.p_value == pytest.approx(1 / 1001)


def test_same_seed_same_result_whatever_the_layout(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0.5, 0.03, 60)
    frame = units(spark, x, x + rng.normal(0.002, 0.02, 60))
    first = run(frame, n_permutations=1500, n_bootstrap=300, seed=42)
    second = run(frame.repartition(5).orderBy(F.rand()), n_permutations=1500, n_bootstrap=300, seed=42)
    other = run(frame, n_permutations=1500, n_bootstrap=300, seed=43)
    assert first.p_value == second.p_value and first.ci_lower == pytest.approx(second.ci_lower, abs=1e-12)
    assert first.ci_lower != other.ci_lower


def test_one_sample(spark):
    rng = np.random.default_rng(6)
    near, tests = one_sample(spark, rng.normal(0.5, 0.02, 100))
    far, _ = one_sample(spark, rng.normal(0.56, 0.02, 100))
    a = run(near, tests, n_permutations=4000, n_bootstrap=500)
    b = run(far, tests, n_permutations=4000, n_bootstrap=500)
    assert a.p_value > 0.10 and b.p_value < 0.01
    assert a.ci_lower < a.mean_baseline < a.ci_upper and a.mean_comparison is None


def test_false_positive_rate(spark):
    """Two hundred data sets without an effect, in one job."""
    rng = np.random.default_rng(0)
    rows = [(rep, f"{rep}|{i}", float(d)) for rep in range(200) for i, d in enumerate(rng.normal(0, 0.01, 80))]
    frame = spark.createDataFrame(rows, "rep int, unit string, d double").withColumns({"x": F.col("d"), "y": F.col("d")})
    sums = rs.sign_flip_sums(frame, TEST, "unit", 500, 1, ["rep"])
    p = rs.permutation_p_values(sums, rs.describe_tests(frame, TEST, ["rep"], "mean_diff"), 500, "mean_diff", ["rep"])
    rate = p.agg(F.avg((F.col("p_value") < 0.05).cast("double"))).first()[0]
    assert 0.01 <= rate <= 0.11


def test_no_spread_gives_zero_statistic(spark):
    got = run(units(spark, [0.5, 0.5, 0.5], [0.5, 0.5, 0.5]), n_permutations=1000, n_bootstrap=50)
    assert got.observed == 0 and got.effect_size_dz == 0 and got.p_value == 1


@pytest.mark.parametrize("d", [
    [0.02 + 1e-9 * k for k in range(6)],      # spread far below the mean: cancellation in the short formula
    [0.3, 0.3, -0.3, 0.3, -0.3],              # equal sizes: some permutations have no spread
    [0.1, 0.2, 0.3, 0.4, 0.0, -0.2],
])
def test_small_samples_against_plain_arithmetic(spark, d):
    values, names = np.array(d), [f"u{i:04d}" for i in range(len(d))]

    def t(v):
        sd = v.std(ddof=1) if len(set(v)) > 1 else 0.0
        return v.mean() / (sd / math.sqrt(len(v))) if sd > 0 else 0.0

    hits = 0
    for p in range(1000):
        block, bit = divmod(p, 64)
        words = [hashlib.md5(f"5|flip|{block}|{u}".encode()).hexdigest() for u in names]
        signs = [1 if int(w[8 * (bit // 32):8 * (bit // 32) + 8], 16) >> (bit % 32) & 1 else -1 for w in words]
        hits += abs(t(np.array(signs) * values)) >= abs(t(values)) * (1 - 1e-9) - 1e-12
    got = run(units(spark, np.zeros(len(d)), values), n_permutations=1000, n_bootstrap=50, seed=5)
    assert got.p_value == pytest.approx((1 + hits) / 1001)


@pytest.mark.parametrize("d, message", [([], "0 unit"), ([0.1], "1 unit"), ([0.1, None, 0.2], "non-finite"), ([0.1, float("nan")], "non-finite"), ([0.1, float("inf")], "non-finite")])
def test_guards(spark, d, message):
    frame = spark.createDataFrame([(f"u{i}", v) for i, v in enumerate(d)], "unit string, d double").withColumns({"x": F.lit(1.0), "y": F.lit(1.0)})
    with pytest.raises(rs.UnitsError, match=message):
        rs.check_units(frame, TEST)


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        rs.describe_tests(units(spark, [1.0], [2.0]), TEST, statistic="median")


def test_holm(spark):
    p = [0.01, 0.04, 0.03, 0.5]
    frame = spark.createDataFrame([(f"m{i}", "t", v) for i, v in enumerate(p)] + [("z", "other", 0.001)], "metric string, test string, p_value double")
    got = {r.metric: (r.p_value_adjusted, r.adjustment) for r in rs.holm(frame, F.col("test") == "t").collect()}
    assert [got[f"m{i}"][0] for i in range(4)] == pytest.approx([0.04, 0.09, 0.09, 0.5])
    assert got["m0"][1] == "holm-bonferroni" and got["z"] == (None, None)


def test_unit_index_is_a_permutation_of_the_units(spark):
    frame = spark.range(5000).select(F.col("id").cast("string").alias("unit"))
    found = rs.index_units(frame, "unit")
    assert found.agg(F.count("*"), F.countDistinct("unit_index"), F.min("unit_index"), F.max("unit_index")).first()[:] == (5000, 5000, 0, 4999)
