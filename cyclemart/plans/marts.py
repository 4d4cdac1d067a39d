"""Marts: what the analysis and the reports read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.contract import CHANNEL_KEYS, SYMMETRY_METRICS
from cyclemart.operators.skew import exact_medians, hot_keys, join_on_keys
from cyclemart.settings import Settings

LOAD_KEYS = (*CHANNEL_KEYS, "load_condition")
HISTOGRAM_BINS = 50
BIN_KEYS = ("metric", "region", "load_condition", "is_burst", "bin")


def analysed_cycles(fact: DataFrame, burst_only: bool) -> DataFrame:
    """Cycles with a condition and both metrics; burst cycles only when asked."""
    kept = fact.filter(
        F.col("load_condition").isNotNull() & F.col("time_ptsym").isNotNull() & F.col("time_rdsym").isNotNull()
    )
    return kept.filter("is_burst") if burst_only else kept


def channel_load(fact: DataFrame, settings: Settings, known_rows: int | None = None) -> DataFrame:
    """Summary per channel and condition.

    Medians are exact. Groups with more values than one task should hold get
    them by counting (see ``exact_medians``); all other measures combine
    map-side and need no care. Trials are counted apart and joined at channel
    grain: a distinct count in the same aggregate would shuffle the median
    buffers once per trial.
    """
    scale = settings.scale
    cycles = analysed_cycles(fact, settings.analysis.burst_only)
    medians = {"median_ptsym": "time_ptsym", "median_rdsym": "time_rdsym"}
    measures = [
        F.count("*").alias("n_cycles"),
        F.avg("time_ptsym").alias("mean_ptsym"),
        F.stddev_samp("time_ptsym").alias("sd_ptsym"),
        F.avg("time_rdsym").alias("mean_rdsym"),
        F.stddev_samp("time_rdsym").alias("sd_rdsym"),
        F.avg("cycle_freq_hz").alias("mean_cycle_freq_hz"),
        F.avg("volt_amp").alias("mean_volt_amp"),
        F.max("extracted_at").alias("extracted_at"),
    ]
    hot = hot_keys(cycles, LOAD_KEYS, scale.hot_median_rows, scale.broadcast_rows, known_rows)
    grouped = cycles.groupBy(*LOAD_KEYS)
    if hot is None:
        summary = grouped.agg(*measures, *[F.median(c).alias(a) for a, c in medians.items()])
    else:
        summary = join_on_keys(
            grouped.agg(*measures), exact_medians(cycles, LOAD_KEYS, medians, hot), LOAD_KEYS, "left", list(medians)
        )
    trials = cycles.groupBy(*LOAD_KEYS).agg(F.countDistinct("trial").alias("n_trials"))
    return join_on_keys(summary, trials, LOAD_KEYS, "inner", ["n_trials"]).select(
        *LOAD_KEYS, "n_cycles", "n_trials", "mean_ptsym", "median_ptsym", "sd_ptsym",
        "mean_rdsym", "median_rdsym", "sd_rdsym", "mean_cycle_freq_hz", "mean_volt_amp", "extracted_at",
    )


def pivot_conditions(load: DataFrame, baseline: int, comparison: int) -> DataFrame:
    """One row per channel, both conditions side by side.

    ``mean_cycle_freq_hz`` is the largest of the channel's per-condition means.
    """
    def at(column: str, condition: int) -> Column:
        return F.max(F.when(F.col("load_condition") == condition, F.col(column)))

    pairs = [
        at(source, condition).alias(f"{prefix}_{label}")
        for prefix, source in (
            ("n_cycles", "n_cycles"), ("n_trials", "n_trials"), ("ptsym", "mean_ptsym"), ("rdsym", "mean_rdsym")
        )
        for label, condition in (("baseline", baseline), ("comparison", comparison))
    ]
    return load.groupBy(*CHANNEL_KEYS).agg(*pairs, F.max("mean_cycle_freq_hz").alias("mean_cycle_freq_hz"))


def exclusion_reason(min_cycles: int) -> Column:
    """Why a channel cannot be paired; NULL when it can. Both conditions count alike."""
    absent = F.lit(False)
    for prefix in SYMMETRY_METRICS.values():
        absent = absent | F.col(f"{prefix}_baseline").isNull() | F.col(f"{prefix}_comparison").isNull()
    few = F.least(
        F.coalesce(F.col("n_cycles_baseline"), F.lit(0)), F.coalesce(F.col("n_cycles_comparison"), F.lit(0))
    ) < min_cycles
    return F.when(absent, "missing one condition").when(few, "below minimum cycle count")


def channel_paired(load: DataFrame, settings: Settings) -> DataFrame:
    """Paired differences with the inclusion rule."""
    a = settings.analysis
    paired = pivot_conditions(load, a.baseline, a.comparison).withColumns({
        "ptsym_diff": F.col("ptsym_comparison") - F.col("ptsym_baseline"),
        "rdsym_diff": F.col("rdsym_comparison") - F.col("rdsym_baseline"),
        "exclusion_reason": exclusion_reason(a.min_cycles),
    })
    return paired.withColumn("included", F.col("exclusion_reason").isNull()).select(
        *CHANNEL_KEYS, "n_cycles_baseline", "n_cycles_comparison", "n_trials_baseline", "n_trials_comparison",
        "ptsym_baseline", "ptsym_comparison", "ptsym_diff", "rdsym_baseline", "rdsym_comparison", "rdsym_diff",
        "mean_cycle_freq_hz", "included", "exclusion_reason",
    )


def symmetry_counts(fact: DataFrame) -> DataFrame:
    """Both metrics in bins of 1/50 by subject, in one pass over the fact. A value of exactly 1 opens its own bin."""
    long = fact.select("subject_id", "region", "load_condition", "is_burst", *SYMMETRY_METRICS).unpivot(
        ["subject_id", "region", "load_condition", "is_burst"], list(SYMMETRY_METRICS), "metric", "value"
    ).filter("value IS NOT NULL")
    return long.withColumn("bin", F.floor(F.col("value") * HISTOGRAM_BINS)).groupBy("subject_id", *BIN_KEYS).agg(F.count("*").alias("n"))


def histogram_of(counts: DataFrame) -> DataFrame:
    """Subjects are counted by rows, so nothing is expanded for the distinct count."""
    width = F.lit(float(HISTOGRAM_BINS))
    return counts.groupBy(*BIN_KEYS).agg(F.sum("n").alias("n_cycles"), F.count("subject_id").alias("n_subjects")).select(
        *BIN_KEYS[:4], (F.col("bin") / width).alias("bin_start"), ((F.col("bin") + 1) / width).alias("bin_end"),
        "n_cycles", "n_subjects",
    )


def symmetry_histogram(fact: DataFrame) -> DataFrame:
    return histogram_of(symmetry_counts(fact))


def subject_coverage(rollup: DataFrame, paired: DataFrame) -> DataFrame:
    """What each subject and region contributed.

    Works on the signal rollup and joins at channel grain, so the fact is not
    joined at all.
    """
    trials = rollup.groupBy("subject_id", "region").agg(F.countDistinct("trial").alias("n_trials"))
    per_channel = rollup.groupBy(*CHANNEL_KEYS).agg(
        F.sum("n_cycles").alias("n_cycles"), F.sum("n_burst_cycles").alias("n_burst_cycles"),
        F.max("extracted_at").alias("extracted_at"),
    )
    included = paired.filter("included").select(*CHANNEL_KEYS, F.lit(1).alias("_included"))
    totals = per_channel.join(included, list(CHANNEL_KEYS), "left").groupBy("subject_id", "region").agg(
        F.count("channel_label").alias("n_channels"),
        F.sum("n_cycles").alias("n_cycles"),
        F.sum("n_burst_cycles").alias("n_burst_cycles"),
        F.count("_included").alias("n_channels_included"),
        F.max("extracted_at").alias("extracted_at"),
    )
    fraction = F.col("n_burst_cycles").cast("double") / F.nullif(F.col("n_cycles"), F.lit(0))
    joined = join_on_keys(totals, trials, ("subject_id", "region"), "inner", ["n_trials"])
    return joined.select(
        "subject_id", "region", "n_channels", "n_trials", "n_cycles", "n_burst_cycles",
        fraction.alias("burst_fraction"), "n_channels_included", "extracted_at",
    )


def file_totals(source_files: DataFrame) -> DataFrame:
    return source_files.groupBy("run_id").agg(
        F.count("*").alias("files_seen"),
        F.count_if(F.col("status") == "loaded").alias("files_loaded"),
        F.count_if(F.col("status") == "skipped").alias("files_skipped"),
        F.sum(F.coalesce("row_count", F.lit(0))).alias("rows_loaded"),
        F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes_read"),
    )


def check_totals(dq_results: DataFrame) -> DataFrame:
    failed = ~F.col("passed")
    return dq_results.groupBy("run_id").agg(
        F.count("*").alias("checks_run"),
        F.count_if(failed).alias("checks_failed"),
        F.count_if(failed & (F.col("severity") == "error")).alias("dq_errors"),
        F.count_if(failed & (F.col("severity") == "warn")).alias("dq_warnings"),
    )


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two timestamps."""
    def whole(at: Column) -> Column:
        return F.date_trunc("second", at)

    return F.timestamp_diff("SECOND", whole(start), whole(end))


def run_health(runs: DataFrame, source_files: DataFrame, dq_results: DataFrame) -> DataFrame:
    """One row per run with its file and check totals."""
    counts = ("files_seen", "files_loaded", "files_skipped", "rows_loaded", "bytes_read",
              "checks_run", "checks_failed", "dq_errors", "dq_warnings")
    joined = runs.join(file_totals(source_files), "run_id", "left").join(check_totals(dq_results), "run_id", "left")
    return joined.select(
        "run_id", "triggered_by", "started_at", "finished_at",
        elapsed_seconds(F.col("started_at"), F.coalesce("finished_at", "started_at")).alias("duration_s"),
        "status", "message", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
    )


def mart_counts(load: DataFrame, paired: DataFrame) -> DataFrame:
    """Row counts of the channel marts, long form."""
    of_load = load.agg(F.count("*").alias("rows")).select(F.lit("channel_load_rows").alias("measure"), "rows")
    of_paired = paired.agg(
        F.count("*").alias("paired_channels"), F.count_if("included").alias("included_channels")
    ).unpivot([], ["paired_channels", "included_channels"], "measure", "rows")
    return of_load.unionByName(of_paired)
