"""Shapes the reports draw: points, histograms, rollups, headline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.contract import SYMMETRY_METRICS


def paired_points(paired: DataFrame) -> DataFrame:
    """(baseline, comparison) of every included channel, one row per metric."""
    sides = F.array(*[
        F.struct(F.lit(p).alias("metric"), F.col(f"{p}_baseline").alias("baseline"), F.col(f"{p}_comparison").alias("comparison"))
        for p in SYMMETRY_METRICS.values()
    ])
    points = paired.filter("included").select("subject_id", "channel_label", F.inline(sides))
    return points.dropna(subset=["baseline", "comparison"])


def paired_differences(paired: DataFrame) -> DataFrame:
    """Differences of every included channel, one row per metric."""
    columns = {f"{p}_diff": p for p in SYMMETRY_METRICS.values()}
    renamed = paired.filter("included").select("subject_id", "region", "channel_label", *[F.col(c).alias(p) for c, p in columns.items()])
    return renamed.unpivot(["subject_id", "region", "channel_label"], list(columns.values()), "metric", "diff").dropna(subset=["diff"])


def histogram_series(histogram: DataFrame) -> DataFrame:
    """Histogram counts per condition over all regions and burst states."""
    return histogram.groupBy("metric", "load_condition", "bin_start").agg(F.sum("n_cycles").alias("count"))


def coverage_by_subject(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("subject_id").agg(
        F.sum("n_channels").alias("n_channels"),
        F.sum("n_channels_included").alias("n_channels_included"),
        F.sum("n_cycles").alias("n_cycles"),
    )


def headline(coverage: DataFrame, paired: DataFrame, health: DataFrame, dq: DataFrame) -> DataFrame:
    """Key figures, long form: ``measure``, ``value`` (text)."""
    def long(row: DataFrame, *names: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("string").alias("value")) for n in names])
        return row.select(F.inline(pairs))

    scope = coverage.agg(
        F.countDistinct("subject_id").alias("n_subjects"), F.coalesce(F.sum("n_channels"), F.lit(0)).alias("n_channels"),
        F.coalesce(F.sum("n_cycles"), F.lit(0)).alias("n_cycles"),
    )
    kept = paired.agg(F.count_if("included").alias("n_channels_included"))
    newest = health.agg(F.max(F.struct("started_at", "run_id", "status")).alias("r")).select(
        F.coalesce("r.run_id", F.lit("n/a")).alias("run_id"), F.coalesce("r.status", F.lit("n/a")).alias("run_status")
    )
    failed = ~F.col("passed")
    quality = dq.agg(
        F.count("*").alias("dq_total"), F.count_if(failed & (F.col("severity") == "error")).alias("dq_errors"),
        F.count_if(failed & (F.col("severity") != "error")).alias("dq_warnings"),
    )
    return (
        long(scope, "n_subjects", "n_channels", "n_cycles")
        .unionByName(long(kept, "n_channels_included"))
        .unionByName(long(newest, "run_id", "run_status"))
        .unionByName(long(quality, "dq_total", "dq_errors", "dq_warnings"))
    )


def symmetric_histogram(differences: DataFrame, width: float = 0.004) -> DataFrame:
    """Histogram per metric, symmetric about zero, empty bins included, with the mean on every row.

    The range is one row per metric, joined back to the differences.
    """
    wide = differences.groupBy("metric").agg(
        F.greatest(F.abs(F.min("diff")), F.abs(F.max("diff")), F.lit(2 * width)).alias("span"), F.avg("diff").alias("mean")
    ).withColumn("n_bins", F.greatest(F.lit(6), F.floor(F.col("span") * 2 / width + 0.5)).cast("int"))
    placed = differences.join(F.broadcast(wide), "metric")  # one row per metric name
    raw = F.floor((F.col("diff") + F.col("span")) / (F.col("span") * 2) * F.col("n_bins"))
    bin_no = F.greatest(F.lit(0), F.least(F.col("n_bins") - 1, raw)).cast("int")
    counted = placed.groupBy("metric", bin_no.alias("bin")).agg(F.count("*").alias("n"))
    bins = wide.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)))
    step = F.col("span") * 2 / F.col("n_bins")
    return bins.join(counted, ["metric", "bin"], "left").select(
        "metric", "bin", "n_bins", (F.col("bin") * step - F.col("span")).alias("bin_start"),
        ((F.col("bin") + 1) * step - F.col("span")).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("count"), "mean",
    )


def fixed_histogram(differences: DataFrame, width: float = 0.005) -> DataFrame:
    """Histogram per metric in bins of one width, with the mean on every row.

    A difference that rounding leaves a hair below an edge counts as on it.
    """
    means = differences.groupBy("metric").agg(F.avg("diff").alias("mean"))
    counted = differences.groupBy("metric", F.floor(F.round(F.col("diff") / width, 9)).alias("bin")).agg(F.count("*").alias("count"))
    return counted.join(F.broadcast(means), "metric").select(  # one row per metric name
        "metric", (F.col("bin") * width).alias("bin_start"), "count", "mean"
    )


def runs_with_checks(runs: DataFrame, dq: DataFrame) -> DataFrame:
    """Runs with a summary of their checks; checks are aggregated first, so runs never repeat."""
    totals = dq.groupBy("run_id").agg(
        F.count("*").alias("checks_run"), F.count_if(~F.col("passed")).alias("checks_failed"),
        F.max(F.when(~F.col("passed"), F.col("check_name"))).alias("last_failed_check"),
    )
    return runs.join(totals, "run_id", "left")
