"""The paired analysis: six tests over the included channels, one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.contract import CHANNEL_KEYS, SYMMETRY_METRICS
from cyclemart.operators.resampling import SignFlipTest, check_units, holm, sign_flip_tests
from cyclemart.settings import Analysis

PAIRED = "paired_sign_flip"


def analysis_units(paired: DataFrame, analysis: Analysis) -> DataFrame:
    """Included channels with the values each test needs."""
    def prefix(metric: str) -> str:
        if metric not in SYMMETRY_METRICS:
            raise ValueError(f"unsupported metric: {metric}")
        return SYMMETRY_METRICS[metric]

    columns = []
    for metric in analysis.metrics:
        x, y = F.col(f"{prefix(metric)}_baseline"), F.col(f"{prefix(metric)}_comparison")
        columns += [
            x.alias(f"{metric}_x"), y.alias(f"{metric}_y"), (y - x).alias(f"{metric}_d"),
            (x - analysis.null_value).alias(f"{metric}_x0"), (y - analysis.null_value).alias(f"{metric}_y0"),
        ]
    return paired.filter("included").select(F.concat_ws("|", *CHANNEL_KEYS).alias("unit"), *columns)


def analysis_tests(analysis: Analysis) -> list[SignFlipTest]:
    """Per metric: does it differ between conditions, and is it off its null value in each."""
    one_sample = f"one_sample_vs_{analysis.null_value:g}"
    tests = []
    for m in analysis.metrics:
        tests.append(SignFlipTest(m, PAIRED, f"{m}_d", f"{m}_d", f"{m}_x", f"{m}_y"))
        tests.append(SignFlipTest(f"{m}@load{analysis.baseline}", one_sample, f"{m}_x0", f"{m}_x", f"{m}_x"))
        tests.append(SignFlipTest(f"{m}@load{analysis.comparison}", one_sample, f"{m}_y0", f"{m}_y", f"{m}_y"))
    return tests


def run_analysis(paired: DataFrame, analysis: Analysis, check: bool = True) -> DataFrame:
    """Test results. Only the paired family is corrected for multiplicity."""
    units, tests = analysis_units(paired, analysis), analysis_tests(analysis)
    if check:
        check_units(units, tests)
    results = sign_flip_tests(
        units, tests, "unit", statistic="t_stat", n_permutations=analysis.n_permutations,
        n_bootstrap=analysis.n_bootstrap, ci_level=analysis.ci_level, seed=analysis.seed,
    )
    return holm(results, F.col("test") == PAIRED)
