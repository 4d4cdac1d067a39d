"""Settings validation and report shapes."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import types as T

from cyclemart.plans import report
from cyclemart.plans.marts import channel_paired
from cyclemart.settings import Analysis, Settings, Signal, load_settings
from cyclemart.sources.extracts import lenient

CONFIG = Path(__file__).resolve().parents[1] / "config" / "cyclemart.yml"


def test_shipped_settings_are_the_defaults():
    loaded = load_settings(str(CONFIG))
    assert replace(loaded, paths=Settings().paths) == Settings()
    assert loaded.paths.lake == str(CONFIG.parents[1] / "warehouse" / "lake")


@pytest.mark.parametrize("make", [
    lambda: Signal(theta_low=7, theta_high=3), lambda: Signal(fs=50, lowpass=30), lambda: Analysis(baseline=1, comparison=1),
    lambda: Analysis(n_permutations=999),
])
def test_bad_settings_are_rejected(make):
    with pytest.raises(ValueError):
        make()


def test_missing_settings_file():
    with pytest.raises(FileNotFoundError):
        load_settings("/nowhere.yml")


def paired(spark):
    cells = [("S1", "R", "C1", "True", "0.5", "0.52", "0.02"), ("S1", "R", "C2", "false", "0.5", "0.6", "0.1"), ("S2", "R", "C1", "1", "0.5", "", "NaN")]
    text = spark.createDataFrame(cells, "subject_id string, region string, channel_label string, included string, ptsym_baseline string, ptsym_comparison string, ptsym_diff string")
    kinds = {"included": T.BooleanType(), **{c: T.DoubleType() for c in ("ptsym_baseline", "ptsym_comparison", "ptsym_diff")}}
    typed = lenient(text, kinds)
    return typed.selectExpr("*", "ptsym_baseline AS rdsym_baseline", "ptsym_comparison AS rdsym_comparison", "ptsym_diff AS rdsym_diff")


def test_points_and_differences_skip_excluded_and_missing(spark):
    points = report.paired_points(paired(spark)).filter("metric = 'ptsym'").collect()
    assert [(p.subject_id, p.channel_label, p.baseline, p.comparison) for p in points] == [("S1", "C1", 0.5, 0.52)]
    assert [d.diff for d in report.paired_differences(paired(spark)).filter("metric = 'rdsym'").collect()] == [0.02]


def test_coverage_and_headline(spark):
    coverage = spark.createDataFrame([("S1", 10, 1, 100), ("S1", 2, 0, 5), ("S2", 10, 0, 50)], "subject_id string, n_channels long, n_channels_included long, n_cycles long")
    assert {(r.subject_id, r.n_channels, r.n_cycles) for r in report.coverage_by_subject(coverage).collect()} == {("S1", 12, 105), ("S2", 10, 50)}
    health = spark.createDataFrame([("a", "2025-01-01", "failed"), ("b", "2025-01-02", "success")], "run_id string, started_at string, status string")
    dq = spark.createDataFrame([(True, "error"), (False, "error"), (False, "warn")], "passed boolean, severity string")
    got = {r.measure: r.value for r in report.headline(coverage, paired(spark), health, dq).collect()}
    assert got == {"n_subjects": "2", "n_channels": "22", "n_cycles": "155", "n_channels_included": "2", "run_id": "b", "run_status": "success",
                   "dq_total": "3", "dq_errors": "1", "dq_warnings": "1"}
    empty = {r.measure: r.value for r in report.headline(coverage.limit(0), paired(spark).limit(0), health.limit(0), dq.limit(0)).collect()}
    assert empty["run_id"] == "n/a" and empty["n_channels"] == "0"


def test_symmetric_histogram(spark):
    differences = spark.createDataFrame([("m", v) for v in (-0.01, 0.0, 0.0041, 0.01)] + [("z", 0.0)], "metric string, diff double")
    rows = report.symmetric_histogram(differences).orderBy("metric", "bin").collect()
    m = [r for r in rows if r.metric == "m"]
    assert len(m) == 6 and sum(r["count"] for r in m) == 4 and m[0].bin_start == pytest.approx(-0.01) and m[-1].bin_end == pytest.approx(0.01)
    assert m[-1]["count"] == 1  # the largest value stays in the last bin
    z = [r for r in rows if r.metric == "z"]
    assert len(z) == 6 and z[0].bin_start == pytest.approx(-0.008)


def test_inclusion_rule_is_symmetric(spark):
    rows = [("A", 1, 10, 0.5), ("A", 3, 10, 0.6), ("B", 1, 10, 0.5), ("B", 3, 9, 0.6), ("C", 1, 10, 0.5), ("D", 2, 10, 0.5)]
    load = spark.createDataFrame(
        [("S", "R", c, cond, n, n, m, m, 5.0 + cond) for c, cond, n, m in rows],
        "subject_id string, region string, channel_label string, load_condition int, n_cycles long, n_trials long, mean_ptsym double, mean_rdsym double, mean_cycle_freq_hz double",
    )
    got = {r.channel_label: (r.included, r.exclusion_reason) for r in channel_paired(load, Settings()).collect()}
    assert got == {"A": (True, None), "B": (False, "below minimum cycle count"), "C": (False, "missing one condition"), "D": (False, "missing one condition")}
    frequency = channel_paired(load, Settings()).filter("channel_label = 'A'").first().mean_cycle_freq_hz
    assert frequency == 8.0  # the larger of the two condition means
