"""Recordings: channels, epochs, features."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from cyclemart.functions.recordings import hemisphere, region_code, session_code, subject_code
from cyclemart.operators import signals
from cyclemart.settings import BurstThresholds
from showcase import tables as t
from showcase.registry import query, rounded
from showcase.sql import with_ctes

REGIONS = ("Hipp", "Amg", "UnknownRegion")


def _windows(spark, sf):
    return signals.trial_windows(t.recording_trials(spark, sf), t.recordings(spark, sf), t.RECORDING)


def _epochs(spark, sf):
    def build():
        channels = signals.channel_table(t.electrodes(spark, sf))
        return signals.epochs(t.samples(spark, sf), _windows(spark, sf), channels, t.RECORDING)

    return t.once(spark, sf, "epochs", build)


def extremes(signal) -> dict[str, list]:
    """A small feature function: one row per signal; short signals are refused."""
    if len(signal) < 31:
        raise ValueError("short signal")
    top = float(signal.max())
    return {"period": [float(len(signal))], "volt_peak": [top], "volt_trough": [float(signal.min())], "is_burst": [top > 0.3]}


def _features(spark, sf):
    return t.once(spark, sf, "signal-features", lambda: signals.feature_rows(_epochs(spark, sf), extremes))


@query("location_codes", """
SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'Hipp' WHEN 1 THEN 'Amg' WHEN 2 THEN 'dACC' WHEN 3 THEN 'FrontalEyeField'
    WHEN 4 THEN 'N' || CAST(s_nationkey AS VARCHAR) ELSE 'NA' END AS region,
  CASE s_suppkey % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'R' ELSE '' END AS hemisphere FROM supplier""")
def location_codes(spark, sf):
    """Suppliers as electrodes: known, unknown and empty locations."""
    key = F.col("s_suppkey")
    base = (
        F.when(key % 6 == 0, "hippocampus").when(key % 6 == 1, "amygdala")
        .when(key % 6 == 2, "dorsal_anterior_cingulate_cortex").when(key % 6 == 3, "frontal_eye-_field")
        .when(key % 6 == 4, F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).otherwise("--")
    )
    side = F.when(key % 3 == 0, "_left").when(key % 3 == 1, "_right").otherwise("")
    located = t.read(spark, sf, "supplier").withColumn("location", F.concat(base, side))
    return located.select("s_suppkey", region_code(F.col("location")).alias("region"), hemisphere(F.col("location")).alias("hemisphere"))


@query("recording_identity", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'P' || CAST(c_custkey AS VARCHAR) || 'CS' WHEN 1 THEN 'sub' || CAST(c_nationkey AS VARCHAR)
    WHEN 2 THEN 'sub-' || CAST(c_custkey AS VARCHAR) || '_x' ELSE 'unknown' END AS subject_id,
  CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE CAST(c_nationkey AS VARCHAR) END AS session_code FROM customer""")
def recording_identity(spark, sf):
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    number = key.cast("string")
    identifier = (
        F.when(key % 4 == 0, F.concat(F.lit("sub-1_ses-1_P"), number, F.lit("CS")))
        .when(key % 4 == 1, F.concat(F.lit("sub-"), number, F.lit("_unnamed")))
        .when(key % 4 == 2, F.concat(F.lit("sub-"), number, F.lit("_x"))).otherwise("")
    )
    subject = F.when(key % 4 == 1, nation).otherwise("")
    session = F.when(key % 2 == 0, "").otherwise(nation)
    return t.read(spark, sf, "customer").select(
        "c_custkey", subject_code(identifier, subject).alias("subject_id"), session_code(session).alias("session_code")
    )


@query("channel_labels", with_ctes("SELECT session_id, column_idx, location, hemisphere, region, channel_label FROM channels", "channels"))
def channel_labels(spark, sf):
    return signals.channel_table(t.electrodes(spark, sf))


@query("region_subset", with_ctes("""
SELECT session_id, column_idx, channel_label FROM channels WHERE region IN ('Hipp', 'Amg', 'UnknownRegion')""", "channels"))
def region_subset(spark, sf):
    return signals.channel_table(t.electrodes(spark, sf), REGIONS).select("session_id", "column_idx", "channel_label")


@query("trial_windows", with_ctes("SELECT session_id, trial, i_low, i_high FROM windows", "windows"))
def trial_windows(spark, sf):
    return _windows(spark, sf)


@query("epoch_extraction", with_ctes("""
SELECT session_id, trial, column_idx, region, channel_label, n_samples, first_sample, finite,
  CASE WHEN finite THEN round(moment, 9) END AS moment FROM epochs""", "epochs"))
def epoch_extraction(spark, sf):
    """Ordered samples of every trial and channel, summed with their positions as weights."""
    # The first sample of a cut window is its lower bound, so positions count from there.
    moment = F.aggregate(
        F.transform("signal", lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x
    )
    return rounded(_epochs(spark, sf).select(
        "session_id", "trial", "column_idx", "region", "channel_label", "n_samples", "first_sample", "finite",
        F.when(F.col("finite"), moment).alias("moment"),
    ))


@query("unusable_epochs", with_ctes("""
SELECT session_id, count(*) FILTER (WHERE NOT finite) AS unusable, count(*) AS epochs FROM epochs GROUP BY session_id""", "epochs"))
def unusable_epochs(spark, sf):
    return _epochs(spark, sf).groupBy("session_id").agg(F.count_if(~F.col("finite")).alias("unusable"), F.count("*").alias("epochs"))


@query("signal_features", with_ctes("""
SELECT session_id, region, trial, column_idx AS channel_idx, channel_label,
  CASE WHEN n_samples >= 31 THEN CAST(n_samples AS DOUBLE) END AS period, CASE WHEN n_samples >= 31 THEN round(top, 9) END AS volt_peak,
  CASE WHEN n_samples >= 31 THEN round(bottom, 9) END AS volt_trough, CASE WHEN n_samples >= 31 THEN top > 0.3e0 END AS is_burst,
  CASE WHEN n_samples < 31 THEN 'ValueError: short signal' END AS error FROM epochs WHERE finite""", "epochs"))
def signal_features(spark, sf):
    shown = ["session_id", "region", "trial", "channel_idx", "channel_label", "period", "volt_peak", "volt_trough", "is_burst", "error"]
    return rounded(_features(spark, sf).select(*shown))


LOOSE, STRICT = BurstThresholds(), BurstThresholds(amp_fraction_threshold=0.5, min_n_cycles=20)


def swings(epochs, signal, thresholds) -> pd.DataFrame:
    """A small feature function of a batch: an epoch is a burst if it is long and its swing is wide enough."""
    frame = pd.DataFrame({
        "epoch": range(len(epochs)), "period": [len(x) / signal.fs for x in epochs], "volt_amp": [max(x) - min(x) for x in epochs],
    })
    long_enough = frame["period"] * signal.fs >= thresholds.min_n_cycles
    return frame.assign(is_burst=(frame["volt_amp"] > thresholds.amp_fraction_threshold) & long_enough)


def _bursts(label: str, swing: float, least: int) -> str:
    return f"""SELECT '{label}' AS thresholds, session_id, region, count(*) AS n_epochs,
  count(*) FILTER (WHERE top - bottom > {swing} AND n_samples >= {least}) AS n_bursts, round(sum(n_samples / 10e0), 9) AS seconds,
  count(*) FILTER (WHERE n_samples < 3) AS failed FROM epochs WHERE finite GROUP BY ALL"""


@query("burst_features", with_ctes(f"{_bursts('loose', '0.2e0', 3)} UNION ALL {_bursts('strict', '0.5e0', 20)}", "epochs"))
def burst_features(spark, sf):
    """The feature hook with its settings: other thresholds, other bursts."""
    parts = []
    for label, thresholds in (("loose", LOOSE), ("strict", STRICT)):
        rows = signals.batch_feature_rows(_epochs(spark, sf), swings, t.RECORDING, thresholds)
        parts.append(rows.groupBy(F.lit(label).alias("thresholds"), "session_id", "region").agg(
            F.count("*").alias("n_epochs"), F.count_if("is_burst").alias("n_bursts"), F.sum("period").alias("seconds"),
            F.count("error").alias("failed"),
        ))
    return rounded(parts[0].unionByName(parts[1]))


@query("recording_trial_metadata", with_ctes("""
SELECT session_id, 'P' || substr(session_id, 4) AS subject_id, trial, load AS load_condition, correct FROM rec_trials""", "rec_trials"))
def recording_trial_metadata(spark, sf):
    return signals.trial_metadata(t.recording_trials(spark, sf), t.recordings(spark, sf))


@query("sampling_rates", with_ctes("""
SELECT session_id, 10e0 AS rate, n_samples FROM recordings""", "recordings"))
def sampling_rates(spark, sf):
    found = t.recordings(spark, sf)
    signals.check_sampling_rate(found, t.RECORDING.fs)
    return found.select("session_id", "rate", "n_samples")


@query("refused_recordings", """
WITH rates AS (
  SELECT CAST(user_id AS VARCHAR) AS session_id, count(*) AS n_samples,
    CASE WHEN max(ts) > min(ts) THEN 86400e6 * (count(*) - 1) / (epoch_us(max(ts)) - epoch_us(min(ts))) END AS rate FROM events GROUP BY user_id
), wrong AS (SELECT * FROM rates WHERE rate IS NULL OR round(rate) <> 2)
SELECT session_id, n_samples, round(rate, 9) AS rate, coalesce('sampled at ' || CAST(CAST(round(rate) AS BIGINT) AS VARCHAR) || ' Hz, settings say 2 Hz', 'rate unknown') AS reason,
  (SELECT min(session_id) FROM wrong) AS first_refused FROM wrong""")
def refused_recordings(spark, sf):
    """Users as recordings and days as seconds: those whose events do not come at two a day are refused."""
    micros = (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(86400.0)).alias("micros")
    found = signals.measured_rates(t.read(spark, sf, "events").select("user_id", micros), "user_id", "micros")
    found = t.once(spark, sf, "rates", lambda: found)
    try:
        signals.check_sampling_rate(found, 2)
        first = None
    except signals.SamplingRateError as refused:
        first = str(refused).partition(":")[0]
    return rounded(signals.refused_recordings(found, 2).withColumn("first_refused", F.lit(first).cast("string")))


@query("extraction_summary", with_ctes("""
SELECT r.session_id, 'P' || substr(r.session_id, 4) AS subject_id, '1' AS session_code,
  (SELECT count(DISTINCT region) FROM channels AS c WHERE c.session_id = r.session_id) AS regions,
  (SELECT count(*) FROM rec_trials AS t WHERE t.session_id = r.session_id) AS trials,
  (SELECT count(*) FROM channels AS c WHERE c.session_id = r.session_id) AS channels,
  (SELECT count(*) FROM epochs AS e WHERE e.session_id = r.session_id AND finite AND n_samples >= 31) AS cycle_rows,
  (SELECT count(*) FROM epochs AS e WHERE e.session_id = r.session_id AND (NOT finite OR n_samples < 31)) AS skipped_trial_channels,
  (SELECT max('ValueError: short signal') FROM epochs AS e WHERE e.session_id = r.session_id AND finite AND n_samples < 31) AS first_error
FROM recordings AS r""", "recordings", "channels", "epochs"))
def extraction_summary(spark, sf):
    channels = signals.channel_table(t.electrodes(spark, sf))
    return signals.extraction_summary(
        t.recordings(spark, sf), channels, t.recording_trials(spark, sf), _epochs(spark, sf), _features(spark, sf)
    )
