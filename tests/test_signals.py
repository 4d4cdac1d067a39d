"""Locations, identifiers, windows, epochs and the feature hook."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclemart.functions.recordings import hemisphere, region_code, subject_code
from cyclemart.operators import signals
from cyclemart.operators.intervals import points_in_windows
from cyclemart.settings import BurstThresholds, Signal
from cyclemart.sources.trials import normalise_trial_info, resolve_label

SIGNAL = Signal(fs=400)


@pytest.mark.parametrize("location, code, side", [
    ("hippocampus_right", "Hipp", "R"), ("amygdala_left", "Amg", "L"), ("dorsal_anterior_cingulate_cortex_left", "dACC", "L"),
    ("pre_supplementary_motor_area_right", "preSMA", "R"), ("ventral_medial_prefrontal_cortex", "vmPFC", ""),
    ("unknown_region_right", "UnknownRegion", "R"), ("area-4b_left", "Area4b", "L"), ("_left", "NA", "L"), ("", "NA", ""),
])
def test_locations(spark, location, code, side):
    row = spark.createDataFrame([(location,)], "l string").select(region_code(F.col("l")), hemisphere(F.col("l"))).first()
    assert tuple(row) == (code, side)


@pytest.mark.parametrize("identifier, field, subject", [
    ("sub-10_ses-1_P68CS", "10", "P68CS"), ("sub-10_ses-1_p68CS", "", "p68CS"), ("sub-10_ses-1_unnamed", "99", "sub99"),
    ("sub-10", "", "sub-10"), ("", "", "unknown"),
])
def test_subjects(spark, identifier, field, subject):
    row = spark.createDataFrame([(identifier, field)], "i string, f string")
    assert row.select(subject_code(F.col("i"), F.col("f"))).first()[0] == subject


def tables(spark):
    recordings = spark.createDataFrame([("s1", "x_P1", "1", "", 0.0, 400.0, 4000), ("s2", "x_P1", "1", "2", 10.0, 400.0, 4000)],
                                       "session_id string, identifier string, subject_field string, session_field string, start_time double, rate double, n_samples long")
    electrodes = spark.createDataFrame([(s, c, loc) for s in ("s1", "s2") for c, loc in enumerate(["hippocampus_left", "hippocampus_left", "amygdala_right"])],
                                       "session_id string, column_idx int, location string")
    trials = spark.createDataFrame([("s1", 0, 1.0, 1, 1), ("s1", 1, 4.0, 3, 0), ("s1", 2, 99.0, 3, 1), ("s2", 0, 9.9, 1, 1)],
                                   "session_id string, trial int, onset_s double, load int, accuracy int")
    grid = spark.range(4000).withColumnRenamed("id", "t_index").select(F.explode(F.array(F.lit("s1"), F.lit("s2"))).alias("session_id"), "t_index")
    samples = grid.select("session_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("column_idx"), "t_index")
    value = F.when((F.col("session_id") == "s1") & (F.col("t_index") == 2000) & (F.col("column_idx") == 1), float("nan")).otherwise(F.col("t_index") * 1.0)
    return recordings, electrodes, trials, samples.withColumn("value", value)


def test_labels_count_per_side_and_region(spark):
    _, electrodes, _, _ = tables(spark)
    found = signals.channel_table(electrodes).filter("session_id = 's1'").orderBy("column_idx").collect()
    assert [r.channel_label for r in found] == ["LHipp1", "LHipp2", "RAmg1"]
    assert signals.channel_table(electrodes, ["Amg"]).count() == 2


def test_windows_are_half_open_clamped_and_never_empty(spark):
    recordings, _, trials, _ = tables(spark)
    found = {(r.session_id, r.trial): (r.i_low, r.i_high) for r in signals.trial_windows(trials, recordings, SIGNAL).collect()}
    assert found == {("s1", 0): (280, 1520), ("s1", 1): (1480, 2720), ("s2", 0): (0, 1080)}


def test_epochs_features_and_summary(spark):
    recordings, electrodes, trials, samples = tables(spark)
    channels = signals.channel_table(electrodes)
    windows = signals.trial_windows(trials, recordings, SIGNAL)
    found = signals.epochs(samples, windows, channels, SIGNAL).cache()
    one = found.filter("session_id = 's1' AND trial = 0 AND column_idx = 0").first()
    assert one.n_samples == 1240 and one.signal[0] == 280.0 and one.signal[-1] == 1519.0 and one.finite
    assert found.count() == 9 and found.filter("NOT finite").count() == 1

    def cycles(signal):
        if signal[0] == 0.0:
            raise RuntimeError("no rise")
        return pd.DataFrame({"period": [80.0, 81.0], "is_burst": [True, False], "sample_peak": [1, 2], "other": ["x", "y"]})

    rows = signals.feature_rows(found, cycles).cache()
    good = rows.filter("error IS NULL")
    assert good.count() == 5 * 2 and good.filter("amp_fraction IS NULL").count() == 10
    assert {r.error for r in rows.filter("error IS NOT NULL").collect()} == {"RuntimeError: no rise"}
    summary = {r.session_id: r for r in signals.extraction_summary(recordings, channels, trials, found, rows).collect()}
    assert (summary["s1"].cycle_rows, summary["s1"].skipped_trial_channels, summary["s1"].regions, summary["s1"].trials) == (10, 1, 2, 3)
    assert (summary["s2"].cycle_rows, summary["s2"].skipped_trial_channels, summary["s2"].first_error) == (0, 3, "RuntimeError: no rise")
    assert (summary["s1"].session_code, summary["s2"].session_code, summary["s2"].subject_id) == ("1", "2", "P1")


def test_empty_feature_frames_count_as_skipped(spark):
    recordings, electrodes, trials, samples = tables(spark)
    found = signals.epochs(samples, signals.trial_windows(trials, recordings, SIGNAL), signals.channel_table(electrodes), SIGNAL)
    rows = signals.feature_rows(found, lambda signal: pd.DataFrame())
    assert {r.error for r in rows.collect()} == {"no cycles"}


def test_batch_features_see_their_settings_and_fail_one_by_one(spark):
    recordings, electrodes, trials, samples = tables(spark)
    found = signals.epochs(samples, signals.trial_windows(trials, recordings, SIGNAL), signals.channel_table(electrodes), SIGNAL)

    def bursts(epochs, signal, thresholds):
        if any(x[0] == 0.0 for x in epochs):
            raise RuntimeError("no rise")
        kept = [k for k, x in enumerate(epochs) if x[0] > 300.0]
        return pd.DataFrame({"epoch": [k for k in kept for _ in range(2)], "period": float(signal.fs),
                             "is_burst": [x / 10 > thresholds.amp_fraction_threshold for _ in kept for x in (1, 5)]})

    for limit, expected in ((0.2, 2), (0.05, 4), (0.9, 0)):
        rows = signals.batch_feature_rows(found.coalesce(1), bursts, SIGNAL, BurstThresholds(amp_fraction_threshold=limit)).collect()
        assert sum(r.is_burst or False for r in rows) == expected and {r.period for r in rows if r.error is None} == {400.0}
        assert sorted(r.error or "" for r in rows) == [""] * 4 + ["RuntimeError: no rise"] * 3 + ["no cycles"] * 3
        assert {(r.session_id, r.trial) for r in rows if r.error == "no cycles"} == {("s1", 0)}
    assert signals.batch_feature_rows(found.filter("trial > 50"), bursts, SIGNAL, BurstThresholds()).count() == 0


@pytest.mark.parametrize("signal", [SIGNAL, Signal(fs=400, epoch_start_s=0.0, epoch_end_s=0.01), Signal(fs=400, epoch_start_s=0.0, epoch_end_s=0.001)])
def test_epochs_against_brute_force(spark, signal):
    value = {0: 1.0, 3: float("nan"), 9: None, 20: float("-inf"), 33: -2.5}
    points = [(s, c, at, value.get(at, at * 1.0)) for s in ("a", "b") for c in (0, 1, 2) for at in range(-3, 90) if s == "a" or c or at % 3 and at not in range(40, 60)]
    points += [("a", 0, 7, 0.5), ("a", 0, None, 1.0), ("c", 0, 5, 1.0)]  # one position twice, one unknown, a recording without windows
    bounds = [(-9, 2), (0, 5), (4, 9), (10, 13), (13, 41), (39, 60), (41, 47), (60, 80), (0, 200), (88, 95), (200, 210), (20, 20)]
    windows = [(s, k, *w) for s in ("a", "b", "d") for k, w in enumerate(bounds)]
    channels = [(s, c, "R", f"{s}{c}") for s in ("a", "b", "c", "d") for c in (0, 1)]
    found = signals.epochs(
        spark.createDataFrame(points, "session_id string, column_idx int, t_index long, value double"),
        spark.createDataFrame(windows, "session_id string, trial int, i_low long, i_high long"),
        spark.createDataFrame(channels, "session_id string, column_idx int, region string, channel_label string"), signal,
    )
    expected = []
    for session, trial, low, high in windows:
        for channel, column, region, label in channels:
            inside = sorted(((p[2], p[3]) for p in points if p[:2] == (session, column) and p[2] is not None and low <= p[2] < high), key=str)
            if channel == session and inside:
                good = all(v is not None and abs(v) < float("inf") for _, v in inside)
                expected.append((session, trial, column, region, label, sorted(str(v) for _, v in inside), min(at for at, _ in inside), len(inside), good))
    rows = found.collect()
    assert sorted((*r[:5], sorted(str(v) for v in r.signal), *r[6:]) for r in rows) == sorted(expected)
    in_order = [v for r in rows for v in [[x for x in r.signal if x is not None and x > 33.0]]]
    assert all(v == sorted(v) for v in in_order) and any(len(v) > 40 for v in in_order)


def test_samples_of_overlapping_epochs_are_gathered_once(spark):
    samples = spark.range(4000).select(F.lit("s").alias("session_id"), F.lit(0).alias("column_idx"), F.col("id").alias("t_index"), F.col("id").cast("double").alias("value"))
    windows = spark.range(0, 2700).select(F.lit("s").alias("session_id"), F.col("id").cast("int").alias("trial"), F.col("id").alias("i_low"), (F.col("id") + 1240).alias("i_high"))
    channels = spark.createDataFrame([("s", 0, "R", "R1")], "session_id string, column_idx int, region string, channel_label string")
    found = signals.epochs(samples, windows, channels, SIGNAL)
    assert found.agg(F.sum("n_samples")).first()[0] == 2700 * 1240
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan[:plan.index("Aggregate")]  # nothing is grouped after the join to windows


def test_features_as_lists_keep_longs_and_fail_one_by_one(spark):
    recordings, electrodes, trials, samples = tables(spark)
    found = signals.epochs(samples, signals.trial_windows(trials, recordings, SIGNAL), signals.channel_table(electrodes), SIGNAL)
    large = 2**60 + 1

    def cycles(signal):
        if signal[0] == 0.0:
            return {"period": [1.0, 2.0], "is_burst": [True]}
        if signal[0] == 280.0:
            return {}
        return {"period": [80.0, float(len(signal))], "sample_peak": [large, None], "is_burst": [True, False], "other": ["x", "y"]}

    rows = signals.feature_rows(found.coalesce(1), cycles).collect()
    assert sorted(r.error or "" for r in rows) == [""] * 4 + ["ValueError: feature columns differ in length"] * 3 + ["no cycles"] * 3
    good = [(r.trial, r.channel_idx, r.period, r.sample_peak, r.is_burst) for r in rows if r.error is None]
    assert sorted(good, key=lambda r: r[:3]) == [(1, c, *v) for c in (0, 2) for v in ((80.0, large, True), (1240.0, None, False))]
    frames = signals.feature_rows(found.coalesce(1), lambda signal: pd.DataFrame(cycles(signal)) if signal[0] != 0.0 else pd.DataFrame({"other": [1]})).collect()
    assert sorted(r.error or "" for r in frames) == [""] * 7 + ["no cycles"] * 3


def test_measured_rates(spark):
    at = [("a", 0), ("a", 2500), ("a", 5000), ("b", 7), ("c", 0), ("c", 2000), ("d", 3), ("d", 3)]
    found = {r.session_id: (r.rate, r.n_samples) for r in signals.measured_rates(spark.createDataFrame(at, "s string, us long"), "s", "us").collect()}
    assert found == {"a": (400.0, 3), "b": (None, 1), "c": (500.0, 2), "d": (None, 2)}
    rates = spark.createDataFrame([(k, *v) for k, v in found.items()], "session_id string, rate double, n_samples long")
    refused = {r.session_id: r.reason for r in signals.refused_recordings(rates, 400).collect()}
    assert refused == {"b": "rate unknown", "c": "sampled at 500 Hz, settings say 400 Hz", "d": "rate unknown"}
    with pytest.raises(signals.SamplingRateError, match="^b: rate unknown"):
        signals.check_sampling_rate(rates, 400)


def test_sampling_rate(spark):
    recordings, *_ = tables(spark)
    signals.check_sampling_rate(recordings, 400)
    with pytest.raises(signals.SamplingRateError):
        signals.check_sampling_rate(recordings, 500)


def test_trial_metadata(spark):
    recordings, _, trials, _ = tables(spark)
    found = signals.trial_metadata(trials, recordings).orderBy("session_id", "trial").collect()
    assert [(r.subject_id, r.trial, r.load_condition, r.correct) for r in found][:2] == [("P1", 0, 1, True), ("P1", 1, 3, False)]


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_interval_join_against_brute_force(spark, bucket):
    points = [("a", i * 3 - 40) for i in range(60)] + [("b", 5)]
    windows = [("a", -10, 20, 1), ("a", 0, 0, 2), ("a", 15, 200, 3), ("b", 6, 9, 4), ("b", 5, 6, 5)]
    got = points_in_windows(
        spark.createDataFrame(points, "k string, at long"), spark.createDataFrame(windows, "k string, s long, e long, w int"), ["k"], "at", "s", "e", bucket
    )
    expected = sorted((k, at, w) for k, at in points for k2, s, e, w in windows if k == k2 and s <= at < e)
    assert sorted((r.k, r.at, r.w) for r in got.collect()) == expected


def test_trial_info_columns(spark):
    assert resolve_label(["Trial", "SETSIZE"], ("load", "setSize")) == "SETSIZE"
    assert resolve_label(["a"], ("b",)) is None
    with pytest.raises(ValueError):
        resolve_label(["a"], (), "b")
    info = spark.createDataFrame([("P1", 1, 3, 1), ("P1", 2, 1, 0)], "subject_id string, row_number int, nItems int, isCorrect int")
    assert [tuple(r) for r in normalise_trial_info(info).orderBy("trial").collect()] == [("P1", 0, 3, True), ("P1", 1, 1, False)]
    assert normalise_trial_info(info.drop("isCorrect")).filter("correct IS NULL").count() == 2
    with pytest.raises(ValueError):
        normalise_trial_info(info.drop("nItems"))
