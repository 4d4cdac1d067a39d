"""Cycle-grain fact and its two dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.contract import CHANNEL_KEYS, CYCLE_ORDER, SIGNAL_KEYS, TRIAL_KEYS
from cyclemart.operators.skew import hot_keys, number_rows
from cyclemart.settings import Settings


def period_seconds(fs: int) -> Column:
    return F.col("period") / F.lit(float(fs))


def cycle_frequency(fs: int) -> Column:
    return F.when(F.col("period") > 0, F.lit(float(fs)) / F.col("period"))


def index_cycles(features: DataFrame, settings: Settings, known_rows: int | None = None) -> DataFrame:
    """Add ``cycle_idx`` and ``cycles_in_signal``, rebuilt from the sample landmarks."""
    scale = settings.scale
    hot = hot_keys(features, SIGNAL_KEYS, scale.hot_group_rows, scale.broadcast_rows, known_rows)
    return number_rows(features, SIGNAL_KEYS, CYCLE_ORDER, "cycle_idx", "cycles_in_signal", hot)


def build_fact(
    features: DataFrame, trials: DataFrame, settings: Settings, known_rows: int | None = None
) -> DataFrame:
    """One row per cycle with its index and its trial's condition.

    The features are exchanged once, on (subject, trial). That placement serves
    the per-signal windows, whose keys contain it, and then the join to the
    trial metadata. Trials too large for one task leave this path: their signals
    are numbered separately and the join is left to Spark's skew handling.
    Duplicate metadata rows repeat cycles, and a trial without metadata keeps
    its cycles with a NULL condition. ``known_rows`` bounds the rows of any trial, if only by the
    number of all; within the limit of one task nothing is read to find large trials.
    """
    scale = settings.scale
    hot = hot_keys(features, TRIAL_KEYS, scale.hot_group_rows, scale.broadcast_rows, known_rows)
    labels = trials.select("subject_id", "trial", "load_condition", F.col("correct").alias("trial_correct"))

    def indexed_and_labelled(rows: DataFrame, limit: int | None) -> DataFrame:
        numbered = index_cycles(rows, settings, limit)
        return numbered.join(labels, list(TRIAL_KEYS), "left")

    if hot is None:
        joined = indexed_and_labelled(features.repartition(*TRIAL_KEYS), 0)
    else:
        hot_rows, other_rows = hot.split(features)
        joined = indexed_and_labelled(other_rows.repartition(*TRIAL_KEYS), 0).unionByName(
            indexed_and_labelled(hot_rows, None)
        )
    fs = settings.signal.fs
    return joined.select(
        "subject_id", "region", "channel_label", "channel_idx", "trial", "cycle_idx", "cycles_in_signal",
        "load_condition", "trial_correct", "is_burst", "time_ptsym", "time_rdsym",
        "period", period_seconds(fs).alias("period_s"), cycle_frequency(fs).alias("cycle_freq_hz"),
        "volt_amp", "band_amp", "amp_fraction", "amp_consistency", "period_consistency", "monotonicity",
        "sample_last_trough", "sample_next_trough",
        "extraction_id", "extracted_at", "source_file", "run_id", "loaded_at",
    )


def signal_rollup(fact: DataFrame) -> DataFrame:
    """Additive measures per (signal, condition): what dimensions and coverage are built from.

    About one row for fifteen cycles; on a fact still placed by (subject, trial)
    it needs no exchange.
    """
    return fact.groupBy(*SIGNAL_KEYS, "load_condition").agg(
        F.min("channel_idx").alias("channel_idx"),
        F.count("*").alias("n_cycles"),
        F.count_if("is_burst").alias("n_burst_cycles"),
        F.sum("cycle_freq_hz").alias("freq_sum"),
        F.count("cycle_freq_hz").alias("freq_count"),
        F.count_if(F.col("time_ptsym").isNull()).alias("n_null_ptsym"),
        F.max("trial_correct").alias("trial_correct"),
        F.max("extracted_at").alias("extracted_at"),
    )


def channel_dimension(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(*CHANNEL_KEYS).agg(
        F.min("channel_idx").alias("channel_idx"),
        F.sum("n_cycles").alias("n_cycles"),
        F.sum("n_burst_cycles").alias("n_burst_cycles"),
        F.countDistinct("trial").alias("n_trials"),
        F.countDistinct("load_condition").alias("n_conditions"),
        F.try_divide(F.sum("freq_sum"), F.sum("freq_count")).alias("mean_cycle_freq_hz"),
        F.sum("n_null_ptsym").alias("n_null_ptsym"),
        F.max("extracted_at").alias("extracted_at"),
    )


def trial_dimension(rollup: DataFrame) -> DataFrame:
    """Where a trial has several conditions (duplicate metadata) the largest is shown.

    A trial has few signals, so they meet as they are, in one exchange of the columns that count: Spark's own plan of a distinct
    count would move nearly as many rows twice.
    """
    signals = rollup.select(*TRIAL_KEYS, "channel_label", "load_condition", "trial_correct", "n_cycles", "n_burst_cycles")
    return signals.repartition(*TRIAL_KEYS).groupBy(*TRIAL_KEYS).agg(
        F.max("load_condition").alias("load_condition"),
        F.max("trial_correct").alias("trial_correct"),
        F.countDistinct("channel_label").alias("n_channels"),
        F.sum("n_cycles").alias("n_cycles"),
        F.sum("n_burst_cycles").alias("n_burst_cycles"),
        F.bool_or(F.col("load_condition").isNull()).alias("missing_condition"),
    )


def fact_counts(fact: DataFrame, channels: DataFrame, trials: DataFrame) -> DataFrame:
    """Row counts of the three core tables, long form."""
    named = (("fact_rows", fact), ("channels", channels), ("trials", trials))
    frames = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("measure"), "rows") for name, df in named]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
