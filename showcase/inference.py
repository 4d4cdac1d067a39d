"""Resampling tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.operators import resampling as rs
from cyclemart.plans import analysis
from showcase import tables as t
from showcase.registry import query, rounded
from showcase.sql import rounded as r
from showcase.sql import with_ctes

A = t.SETTINGS.analysis
TESTS = analysis.analysis_tests(A)


def _units(spark, sf) -> DataFrame:
    return analysis.analysis_units(t.paired(spark, sf), A)


def _labelled(df: DataFrame) -> DataFrame:
    """Test numbers replaced by metric and test name."""
    names = F.array(*[F.struct(F.lit(x.metric).alias("metric"), F.lit(x.test).alias("test")) for x in TESTS])
    label = F.get(names, F.col("test_no"))
    rest = [c for c in df.columns if c != "test_no"]
    return df.select(label["metric"].alias("metric"), label["test"].alias("test"), *rest)


@query("test_units", with_ctes(f"SELECT metric, test, unit, {r('value', 'interval_value', 'x', 'y')} FROM long_units", "long_units"))
def test_units(spark, sf):
    return rounded(_labelled(rs.unit_values(_units(spark, sf), TESTS, ["unit"])))


@query("observed_statistics", with_ctes(f"""
SELECT metric, test, n_units, {r('observed', 'effect_size_dz', 'mean', 'sd', 'mean_baseline', 'mean_comparison')} FROM described""", "described"))
def observed_statistics(spark, sf):
    described = _labelled(rs.describe_tests(_units(spark, sf), TESTS))
    return rounded(described.select(
        "metric", "test", "n_units", "observed", "effect_size_dz", "mean", "sd", "mean_baseline", "mean_comparison"
    ))


@query("mean_difference_statistics", with_ctes("""
SELECT metric, test, round(mean, 9) AS observed FROM described""", "described"))
def mean_difference_statistics(spark, sf):
    described = rs.describe_tests(_units(spark, sf), TESTS, statistic="mean_diff")
    return rounded(_labelled(described.select("test_no", "observed")))


@query("sign_flip_null", with_ctes(f"SELECT metric, test, permutation, {r('flipped_sum')} FROM flips", "flips"))
def sign_flip_null(spark, sf):
    return rounded(_labelled(rs.sign_flip_sums(_units(spark, sf), TESTS, "unit", A.n_permutations, A.seed)))


@query("permutation_p_values", with_ctes(f"SELECT metric, test, exceedances, {r('p_value')} FROM p_values", "p_values"))
def permutation_p_values(spark, sf):
    units = _units(spark, sf)
    sums = rs.sign_flip_sums(units, TESTS, "unit", A.n_permutations, A.seed)
    return rounded(_labelled(rs.permutation_p_values(sums, rs.describe_tests(units, TESTS), A.n_permutations, "t_stat")))


@query("unit_index", with_ctes("SELECT unit, unit_index FROM indexed", "indexed"))
def unit_index(spark, sf):
    return rs.index_units(_units(spark, sf).select("unit"), "unit")


@query("bootstrap_intervals", with_ctes(f"SELECT metric, test, {r('ci_lower', 'ci_upper')} FROM intervals", "intervals"))
def bootstrap_intervals(spark, sf):
    means = rs.bootstrap_means(_units(spark, sf), TESTS, "unit", A.n_bootstrap, A.seed)
    return rounded(_labelled(rs.percentile_intervals(means, A.ci_level)))


SUITE = f"""SELECT metric, test, statistic, n_units, {r('observed', 'p_value', 'p_value_adjusted')}, adjustment,
  {r('effect_size_dz', 'ci_lower', 'ci_upper', 'ci_level', 'mean_baseline', 'mean_comparison')}, n_permutations FROM suite"""


@query("analysis_suite", with_ctes(SUITE, "suite"))
def analysis_suite(spark, sf):
    return rounded(analysis.run_analysis(t.paired(spark, sf), A))


@query("paired_test", with_ctes(f"""
SELECT metric, n_units, {r('observed', 'p_value', 'ci_lower', 'ci_upper')} FROM suite WHERE test = 'paired_sign_flip'""", "suite"))
def paired_test(spark, sf):
    tests = [x for x in TESTS if x.test == analysis.PAIRED]
    results = rs.sign_flip_tests(_units(spark, sf), tests, "unit", seed=A.seed)
    return rounded(results.select("metric", "n_units", "observed", "p_value", "ci_lower", "ci_upper"))


@query("one_sample_test", with_ctes(f"""
SELECT metric, n_units, {r('observed', 'p_value', 'ci_lower', 'ci_upper')} FROM suite WHERE test <> 'paired_sign_flip'""", "suite"))
def one_sample_test(spark, sf):
    tests = [x for x in TESTS if x.test != analysis.PAIRED]
    results = rs.sign_flip_tests(_units(spark, sf), tests, "unit", seed=A.seed)
    return rounded(results.select("metric", "n_units", "observed", "p_value", "ci_lower", "ci_upper"))


HOLM = """
SELECT region, metric, test, round(p_value, 9) AS p_value,
  round(least(1e0, max(scaled) OVER (PARTITION BY region ORDER BY p_value, metric, test ROWS UNBOUNDED PRECEDING)), 9) AS p_value_adjusted
FROM (SELECT *, (count(*) OVER (PARTITION BY region) - row_number() OVER (PARTITION BY region ORDER BY p_value, metric, test) + 1) * p_value AS scaled
  FROM (SELECT region, channel_label AS metric, 'share' AS test, avg(time_ptsym) FILTER (WHERE is_burst) / 100 AS p_value
        FROM fact GROUP BY region, channel_label) AS p) AS q"""


@query("holm_adjustment", with_ctes(HOLM, "fact"))
def holm_adjustment(spark, sf):
    """Step-down over a family of channel labels per region."""
    shares = t.fact(spark, sf).groupBy("region", F.col("channel_label").alias("metric")).agg(
        (F.avg(F.when(F.col("is_burst"), F.col("time_ptsym"))) / 100).alias("p_value")
    ).withColumn("test", F.lit("share"))
    return rounded(rs.holm(shares, F.lit(True), ["region"]).select("region", "metric", "test", "p_value", "p_value_adjusted"))


@query("unit_guards", with_ctes("""
SELECT subject_id, count(*) AS n_units, count(*) < 2 AS too_few,
  count(*) FILTER (WHERE ptsym_diff IS NULL OR rdsym_diff IS NULL) AS incomplete
FROM paired GROUP BY subject_id""", "paired"))
def unit_guards(spark, sf):
    """What the input guard looks at, per subject."""
    guarded = [rs.SignFlipTest(c, "difference", c, c, c) for c in ("ptsym_diff", "rdsym_diff")]
    return rs.unit_guards(t.paired(spark, sf), guarded, ["subject_id"]).select("subject_id", "n_units", "too_few", "incomplete")


REPLICATE_UNITS = """
SELECT user_id, unit, b - a AS d FROM (
  SELECT user_id, CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y%m%d') AS unit,
    avg(value) FILTER (WHERE event_id % 2 = 0) AS a, avg(value) FILTER (WHERE event_id % 2 = 1) AS b
  FROM events GROUP BY 1, 2) AS halves WHERE a IS NOT NULL AND b IS NOT NULL"""

CALIBRATION = f"""
WITH u AS ({REPLICATE_UNITS}),
s AS (SELECT user_id, count(*) AS n, sum(d * d) AS q,
  CASE WHEN stddev_samp(d) > 0 THEN avg(d) / (stddev_samp(d) / sqrt(count(*))) ELSE 0 END AS observed FROM u GROUP BY user_id),
w AS (SELECT u.*, block, word, CAST('0x' || substr(md5('7|flip|' || CAST(block AS VARCHAR) || '|' || unit), 1 + 8 * word, 8) AS BIGINT) AS digits
  FROM u, (SELECT unnest(range(8)) AS block) AS b, (SELECT unnest(range(2)) AS word) AS k),
f AS (SELECT user_id, block * 64 + word * 32 + bit AS permutation, sum(CASE WHEN (digits >> bit) & 1 = 1 THEN d ELSE -d END) AS total
  FROM w, (SELECT unnest(range(32)) AS bit) AS k WHERE block * 64 + word * 32 + bit < 500 GROUP BY 1, 2),
p AS (SELECT f.user_id, (1e0 + count(*) FILTER (WHERE abs(CASE WHEN q / n - (total / n) ** 2 > 0
    THEN total / n / sqrt((q / n - (total / n) ** 2) / (n - 1)) ELSE 0 END) >= abs(observed) - 1e-12)) / 501e0 AS p_value
  FROM f JOIN s ON f.user_id = s.user_id GROUP BY f.user_id)
SELECT user_id, round(p_value, 9) AS p_value, p_value < 0.05e0 AS rejected FROM p"""


@query("null_calibration", CALIBRATION)
def null_calibration(spark, sf):
    """Every user is a replicate in which odd and even events do not differ; all tested in one job."""
    unit = F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    odd = F.col("event_id") % 2 == 1
    halves = t.read(spark, sf, "events").groupBy("user_id", unit.alias("unit")).agg(
        F.avg(F.when(~odd, F.col("value"))).alias("a"), F.avg(F.when(odd, F.col("value"))).alias("b")
    ).dropna(subset=["a", "b"])
    units = t.once(spark, sf, "replicates", lambda: halves.withColumn("d", F.col("b") - F.col("a")))
    tests = [rs.SignFlipTest("value", "paired_sign_flip", "d", "d", "a", "b")]
    sums = rs.sign_flip_sums(units, tests, "unit", 500, 7, ["user_id"])
    p = rs.permutation_p_values(sums, rs.describe_tests(units, tests, ["user_id"]), 500, "t_stat", ["user_id"])
    return rounded(p.select("user_id", "p_value", (F.col("p_value") < 0.05).alias("rejected")))
