"""Staging, fact, dimensions and marts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cyclemart.contract import SIGNAL_KEYS, TRIAL_KEYS
from cyclemart.operators.intervals import points_in_windows
from cyclemart.operators.recency import extraction_times, keep_latest, latest_extraction
from cyclemart.operators.runs import at_signal_edge, flagged_runs
from cyclemart.plans import fact as core
from cyclemart.plans import marts, report
from cyclemart.plans.analysis import run_analysis
from cyclemart.plans.quality import orphan_trials as orphans
from cyclemart.settings import tune
from cyclemart.sources.lake import staged
from cyclemart.sources.ledger import latest_run, of_latest_run
from showcase import tables as t
from showcase.registry import query, rounded
from showcase.sql import rounded as r
from showcase.sql import with_ctes

KEYS = "subject_id, region, channel_label"
ORDERING = "sample_last_trough, sample_peak"


@query("staging_projection", with_ctes("SELECT * FROM feat", "feat"))
def staging_projection(spark, sf):
    return staged(t.features(spark, sf))


@query("extraction_times", with_ctes("""
SELECT subject_id, region, extraction_id, max(extracted_at) AS extracted_at FROM feat GROUP BY 1, 2, 3""", "feat"))
def extraction_times_query(spark, sf):
    return extraction_times(t.features(spark, sf))


LATEST = """
SELECT subject_id, region, newest.id AS extraction_id, newest.at AS extracted_at
FROM (SELECT subject_id, region, max({'at': extracted_at, 'id': extraction_id}) AS newest FROM feat GROUP BY ALL) AS maxima"""


@query("latest_extraction", with_ctes(LATEST, "feat"))
def latest_extraction_query(spark, sf):
    return latest_extraction(t.features(spark, sf))


@query("current_features", with_ctes(f"""
SELECT feat.subject_id, feat.region, feat.extraction_id, channel_label, trial, sample_last_trough, sample_peak
FROM feat JOIN ({LATEST}) AS l ON feat.subject_id = l.subject_id AND feat.region = l.region
  AND feat.extraction_id = l.extraction_id""", "feat"))
def current_features(spark, sf):
    cycles = t.features(spark, sf)
    latest = t.once(spark, sf, "latest", lambda: latest_extraction(cycles))
    return keep_latest(cycles, latest, t.SETTINGS.scale.broadcast_rows).select(
        "subject_id", "region", "extraction_id", "channel_label", "trial", "sample_last_trough", "sample_peak"
    )


@query("cycle_index", with_ctes(f"""
SELECT {KEYS}, trial, {ORDERING}, CAST(row_number() OVER w AS INTEGER) AS cycle_idx,
  count(*) OVER (PARTITION BY {KEYS}, trial) AS cycles_in_signal
FROM feat WINDOW w AS (PARTITION BY {KEYS}, trial ORDER BY sample_last_trough NULLS LAST, sample_peak NULLS LAST)""", "feat"))
def cycle_index(spark, sf):
    rows = t.features(spark, sf).select(*SIGNAL_KEYS, "sample_last_trough", "sample_peak")
    return core.index_cycles(rows, t.SETTINGS, t.known_rows(spark, sf))


FACT = f"""
SELECT {KEYS}, channel_idx, trial, cycle_idx, cycles_in_signal, load_condition, trial_correct, is_burst,
  {r('time_ptsym', 'time_rdsym', 'period', 'period_s', 'cycle_freq_hz', 'volt_amp', 'band_amp', 'amp_fraction',
     'amp_consistency', 'period_consistency', 'monotonicity')},
  sample_last_trough, sample_next_trough, extraction_id, extracted_at, source_file, run_id, loaded_at FROM fact"""


@query("cycle_fact", with_ctes(FACT, "fact"))
def cycle_fact(spark, sf):
    """The whole fact, planned and run here (not the written copy other queries read)."""
    return rounded(core.build_fact(t.features(spark, sf), t.trials(spark, sf), t.SETTINGS, t.trial_rows(spark, sf)))


@query("cycle_timing", with_ctes(f"""
SELECT {KEYS}, trial, cycle_idx, {r('period', 'period_s', 'cycle_freq_hz')} FROM fact""", "fact"))
def cycle_timing(spark, sf):
    fs = t.SETTINGS.signal.fs
    return rounded(t.fact(spark, sf).select(
        *SIGNAL_KEYS, "cycle_idx", "period", core.period_seconds(fs).alias("period_s"),
        core.cycle_frequency(fs).alias("cycle_freq_hz"),
    ))


@query("analysed_cycles", with_ctes(f"""
SELECT 'burst' AS scope, {KEYS}, trial, cycle_idx FROM fact WHERE load_condition IS NOT NULL
  AND time_ptsym IS NOT NULL AND time_rdsym IS NOT NULL AND is_burst
UNION ALL SELECT 'all', {KEYS}, trial, cycle_idx FROM fact WHERE load_condition IS NOT NULL
  AND time_ptsym IS NOT NULL AND time_rdsym IS NOT NULL""", "fact"))
def analysed_cycles(spark, sf):
    cycles = t.fact(spark, sf)
    parts = [
        marts.analysed_cycles(cycles, burst_only).select(F.lit(scope).alias("scope"), *SIGNAL_KEYS, "cycle_idx")
        for scope, burst_only in (("burst", True), ("all", False))
    ]
    return parts[0].unionByName(parts[1])


@query("channel_dimension", with_ctes(f"""
SELECT {KEYS}, min(first_idx) AS channel_idx, CAST(sum(n) AS BIGINT) AS n_cycles, CAST(sum(bursts) AS BIGINT) AS n_burst_cycles,
  count(*) AS n_trials, CAST(len(list_distinct(flatten(list(loads)))) AS BIGINT) AS n_conditions,
  round(sum(freq_sum) / sum(freq_n), 9) AS mean_cycle_freq_hz, CAST(sum(n - ptsym_n) AS BIGINT) AS n_null_ptsym, max(newest) AS extracted_at
FROM (
  SELECT {KEYS}, trial, min(channel_idx) AS first_idx, count(*) AS n, count_if(is_burst) AS bursts, list(DISTINCT load_condition) FILTER (load_condition IS NOT NULL) AS loads,
    sum(cycle_freq_hz) AS freq_sum, count(cycle_freq_hz) AS freq_n, count(time_ptsym) AS ptsym_n, max(extracted_at) AS newest
  FROM fact GROUP BY ALL
) AS signals GROUP BY {KEYS}""", "fact"))
def channel_dimension(spark, sf):
    return rounded(core.channel_dimension(t.rollup(spark, sf)))


@query("trial_dimension", with_ctes("""
SELECT subject_id, trial, max(top) AS load_condition, max(right_) AS trial_correct, count(*) AS n_channels,
  CAST(sum(n) AS BIGINT) AS n_cycles, CAST(sum(bursts) AS BIGINT) AS n_burst_cycles, sum(n) > sum(labelled) AS missing_condition
FROM (
  SELECT subject_id, trial, channel_label, max(load_condition) AS top, max(trial_correct) AS right_, count(*) AS n,
    count_if(is_burst) AS bursts, count(load_condition) AS labelled
  FROM fact GROUP BY ALL
) AS channels GROUP BY subject_id, trial""", "fact"))
def trial_dimension(spark, sf):
    return core.trial_dimension(t.rollup(spark, sf))


@query("core_counts", with_ctes("""
SELECT 'fact_rows' AS measure, count(*) AS rows FROM fact
UNION ALL SELECT 'channels', count(*) FROM (SELECT DISTINCT subject_id, region, channel_label FROM fact) AS c
UNION ALL SELECT 'trials', count(*) FROM (SELECT DISTINCT subject_id, trial FROM fact) AS d""", "fact"))
def core_counts(spark, sf):
    rolled = t.rollup(spark, sf)
    return core.fact_counts(t.fact(spark, sf), core.channel_dimension(rolled), core.trial_dimension(rolled))


LOAD = f"""SELECT {KEYS}, load_condition, n_cycles, n_trials,
  {r('mean_ptsym', 'median_ptsym', 'sd_ptsym', 'mean_rdsym', 'median_rdsym', 'sd_rdsym', 'mean_cycle_freq_hz', 'mean_volt_amp')},
  extracted_at FROM channel_load"""


@query("channel_load_mart", with_ctes(LOAD, "channel_load"))
def channel_load_mart(spark, sf):
    cycles = t.fact(spark, sf)
    return rounded(marts.channel_load(cycles, t.SETTINGS, cycles.count()))


@query("channel_load_all_cycles", with_ctes(f"""
SELECT {KEYS}, load_condition, count(*) AS n_cycles, round(avg(time_ptsym), 9) AS mean_ptsym,
  round(median(time_ptsym), 9) AS median_ptsym FROM fact
WHERE load_condition IS NOT NULL AND time_ptsym IS NOT NULL AND time_rdsym IS NOT NULL
GROUP BY {KEYS}, load_condition""", "fact"))
def channel_load_all_cycles(spark, sf):
    """The same mart without the burst filter."""
    cycles = t.fact(spark, sf)
    every = replace(t.SETTINGS, analysis=replace(t.SETTINGS.analysis, burst_only=False))
    return rounded(marts.channel_load(cycles, every, cycles.count()).select(
        *marts.LOAD_KEYS, "n_cycles", "mean_ptsym", "median_ptsym"
    ))


@query("condition_pivot", with_ctes(f"""
SELECT {KEYS}, n_cycles_baseline, n_cycles_comparison, n_trials_baseline, n_trials_comparison,
  {r('ptsym_baseline', 'ptsym_comparison', 'rdsym_baseline', 'rdsym_comparison', 'mean_cycle_freq_hz')}
FROM pivoted""", "pivoted"))
def condition_pivot(spark, sf):
    return rounded(marts.pivot_conditions(t.load(spark, sf), 1, 3))


PAIRED_ROUNDED = f"""SELECT {KEYS}, n_cycles_baseline, n_cycles_comparison, n_trials_baseline, n_trials_comparison,
  {r('ptsym_baseline', 'ptsym_comparison', 'ptsym_diff', 'rdsym_baseline', 'rdsym_comparison', 'rdsym_diff', 'mean_cycle_freq_hz')},
  included, exclusion_reason FROM paired"""


@query("channel_paired_mart", with_ctes(PAIRED_ROUNDED, "paired"))
def channel_paired_mart(spark, sf):
    return rounded(marts.channel_paired(t.load(spark, sf), t.SETTINGS))


@query("exclusion_reasons", with_ctes("""
SELECT coalesce(exclusion_reason, 'included') AS reason, count(*) AS n_channels FROM paired GROUP BY 1""", "paired"))
def exclusion_reasons(spark, sf):
    reason = F.coalesce(marts.exclusion_reason(t.SETTINGS.analysis.min_cycles), F.lit("included")).alias("reason")
    return marts.pivot_conditions(t.load(spark, sf), 1, 3).groupBy(reason).agg(F.count("*").alias("n_channels"))


@query("symmetry_histogram", with_ctes(f"""
SELECT metric, region, load_condition, is_burst, {r('bin_start', 'bin_end')}, n_cycles, n_subjects FROM histogram""", "histogram"))
def symmetry_histogram(spark, sf):
    return rounded(marts.symmetry_histogram(t.fact(spark, sf)))


@query("subject_coverage", with_ctes(f"""
SELECT subject_id, region, n_channels, n_trials, n_cycles, n_burst_cycles, {r('burst_fraction')},
  n_channels_included, extracted_at FROM coverage""", "coverage"))
def subject_coverage(spark, sf):
    return rounded(marts.subject_coverage(t.rollup(spark, sf), t.paired(spark, sf)))


@query("mart_counts", with_ctes("""
SELECT 'channel_load_rows' AS measure, count(*) AS rows FROM channel_load
UNION ALL SELECT 'paired_channels', count(*) FROM paired
UNION ALL SELECT 'included_channels', count(*) FROM paired WHERE included""", "paired"))
def mart_counts(spark, sf):
    return marts.mart_counts(t.load(spark, sf), t.paired(spark, sf))


@query("file_totals", with_ctes("SELECT * FROM file_totals", "file_totals"))
def file_totals(spark, sf):
    return marts.file_totals(t.source_files(spark, sf))


@query("check_totals", with_ctes("SELECT * FROM check_totals", "check_totals"))
def check_totals(spark, sf):
    return marts.check_totals(t.dq_results(spark, sf))


@query("run_health", with_ctes("SELECT * FROM run_health", "run_health"))
def run_health(spark, sf):
    return marts.run_health(t.runs(spark, sf), t.source_files(spark, sf), t.dq_results(spark, sf))


@query("latest_run", with_ctes("SELECT run_id FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1", "runs"))
def latest_run_query(spark, sf):
    return latest_run(t.runs(spark, sf))


@query("latest_run_files", with_ctes("""
SELECT * FROM source_files WHERE run_id = (SELECT max_by(run_id, started_at) FROM runs)""", "runs", "source_files"))
def latest_run_files(spark, sf):
    return of_latest_run(t.source_files(spark, sf), t.runs(spark, sf))


@query("runs_with_checks", with_ctes("""
SELECT r.run_id, r.status, c.checks_run, c.checks_failed, c.last_failed_check FROM runs AS r LEFT JOIN (
  SELECT run_id, count(*) AS checks_run, count(*) FILTER (WHERE NOT passed) AS checks_failed,
    max(CASE WHEN NOT passed THEN check_name END) AS last_failed_check FROM dq_results GROUP BY run_id
) AS c ON r.run_id = c.run_id""", "runs", "dq_results"))
def runs_with_checks(spark, sf):
    joined = report.runs_with_checks(t.runs(spark, sf), t.dq_results(spark, sf))
    return joined.select("run_id", "status", "checks_run", "checks_failed", "last_failed_check")


@query("orphan_trials", with_ctes("""
SELECT subject_id, trial, load_condition FROM trial_metadata
WHERE (subject_id, trial) IN (SELECT subject_id, trial FROM trial_metadata EXCEPT SELECT subject_id, trial FROM feat)""", "trial_metadata", "feat"))
def orphan_trials(spark, sf):
    return orphans(t.trials(spark, sf), t.fact(spark, sf)).select(*TRIAL_KEYS, "load_condition")


@query("trial_cycle_counts", with_ctes("""
SELECT t.subject_id, t.trial, coalesce(n, 0) AS n_cycles FROM trial_metadata AS t
LEFT JOIN (SELECT subject_id, trial, count(*) AS n FROM feat GROUP BY 1, 2) AS f
  ON t.subject_id = f.subject_id AND t.trial = f.trial""", "trial_metadata", "feat"))
def trial_cycle_counts(spark, sf):
    counted = t.rollup(spark, sf).groupBy(*TRIAL_KEYS).agg(F.sum("n_cycles").alias("n"))
    return t.trials(spark, sf).join(counted, list(TRIAL_KEYS), "left").select(
        *TRIAL_KEYS, F.coalesce("n", F.lit(0)).alias("n_cycles")
    )


@query("interval_join", """
SELECT s.event_id, s.user_id, count(*) AS n_events, round(sum(e.value), 6) AS total
FROM events AS s JOIN events AS e ON e.user_id = s.user_id
  AND e.ts >= s.ts - INTERVAL 6 HOUR AND e.ts < s.ts + INTERVAL 6 HOUR
WHERE s.event_type = 'signup' GROUP BY s.event_id, s.user_id""")
def interval_join(spark, sf):
    """Events of the same user within six hours of each signup."""
    hours = 6 * 3600 * 1_000_000
    events = t.read(spark, sf, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    windows = events.filter("event_type = 'signup'").select(
        "user_id", "event_id", (F.col("at") - hours).alias("start"), (F.col("at") + hours).alias("end")
    )
    points = events.select("user_id", "at", "value")
    near = points_in_windows(points, windows, ["user_id"], "at", "start", "end", 2 * hours)
    return rounded(near.groupBy("event_id", "user_id").agg(F.count("*").alias("n_events"), F.sum("value").alias("total")), 6)


@query("flagged_runs", with_ctes("""
SELECT user_id, CAST(min(cycle_idx) AS INTEGER) AS first_index, CAST(max(cycle_idx) AS INTEGER) AS last_index, count(*) AS run_length FROM (
  SELECT user_id, cycle_idx, cycle_idx - row_number() OVER (PARTITION BY user_id ORDER BY cycle_idx) AS run
  FROM ordered_events WHERE event_type IN ('view', 'click', 'purchase')) AS g
GROUP BY user_id, run HAVING count(*) >= 3""", "ordered_events"))
def flagged_runs_query(spark, sf):
    """Runs of at least three visits per user."""
    events = t.ordered_events(spark, sf).withColumn("visit", F.col("event_type").isin("view", "click", "purchase"))
    runs = flagged_runs(events, ["user_id"], "cycle_idx", "visit", t.event_skew(spark, sf))
    return runs.filter(F.col("run_length") >= t.SETTINGS.thresholds.min_n_cycles)


@query("signal_edges", with_ctes("""
SELECT event_id, user_id, cycle_idx FROM ordered_events WHERE cycle_idx = 1 OR cycle_idx = cycles_in_signal""", "ordered_events"))
def signal_edges(spark, sf):
    return t.ordered_events(spark, sf).filter(at_signal_edge()).select("event_id", "user_id", "cycle_idx")


@query("report_paired_points", with_ctes(f"""
SELECT subject_id, channel_label, 'ptsym' AS metric, round(ptsym_baseline, 9) AS baseline, round(ptsym_comparison, 9) AS comparison FROM paired WHERE included
UNION ALL SELECT subject_id, channel_label, 'rdsym', round(rdsym_baseline, 9), round(rdsym_comparison, 9) FROM paired WHERE included""", "paired"))
def report_paired_points(spark, sf):
    return rounded(report.paired_points(t.paired(spark, sf)))


@query("report_differences", with_ctes(f"SELECT {KEYS}, metric, round(diff, 9) AS diff FROM diffs", "diffs"))
def report_differences(spark, sf):
    return rounded(report.paired_differences(t.paired(spark, sf)))


@query("report_histogram_series", with_ctes("""
SELECT metric, load_condition, round(bin_start, 9) AS bin_start, CAST(sum(n_cycles) AS BIGINT) AS count
FROM histogram GROUP BY metric, load_condition, bin_start""", "histogram"))
def report_histogram_series(spark, sf):
    return rounded(report.histogram_series(marts.symmetry_histogram(t.fact(spark, sf))))


@query("report_coverage", with_ctes("""
SELECT subject_id, CAST(sum(n_channels) AS BIGINT) AS n_channels, CAST(sum(n_channels_included) AS BIGINT) AS n_channels_included,
  CAST(sum(n_cycles) AS BIGINT) AS n_cycles FROM coverage GROUP BY subject_id""", "coverage"))
def report_coverage(spark, sf):
    return report.coverage_by_subject(marts.subject_coverage(t.rollup(spark, sf), t.paired(spark, sf)))


@query("report_headline", with_ctes("""
SELECT 'n_subjects' AS measure, CAST(count(DISTINCT subject_id) AS VARCHAR) AS value FROM coverage
UNION ALL SELECT 'n_channels', CAST(CAST(sum(n_channels) AS BIGINT) AS VARCHAR) FROM coverage
UNION ALL SELECT 'n_cycles', CAST(CAST(sum(n_cycles) AS BIGINT) AS VARCHAR) FROM coverage
UNION ALL SELECT 'n_channels_included', CAST(count(*) AS VARCHAR) FROM paired WHERE included
UNION ALL SELECT 'run_id', max_by(run_id, started_at) FROM runs
UNION ALL SELECT 'run_status', max_by(status, started_at) FROM runs
UNION ALL SELECT 'dq_total', CAST(count(*) AS VARCHAR) FROM dq_results
UNION ALL SELECT 'dq_errors', CAST(count(*) AS VARCHAR) FROM dq_results WHERE NOT passed AND severity = 'error'
UNION ALL SELECT 'dq_warnings', CAST(count(*) AS VARCHAR) FROM dq_results WHERE NOT passed AND severity = 'warn'""",
    "coverage", "paired", "runs", "dq_results"))
def report_headline(spark, sf):
    coverage = marts.subject_coverage(t.rollup(spark, sf), t.paired(spark, sf))
    return report.headline(coverage, t.paired(spark, sf), t.runs(spark, sf), t.dq_results(spark, sf))


@query("report_symmetric_histogram", with_ctes("""
SELECT b.metric, CAST(b.bin AS INTEGER) AS bin, CAST(n_bins AS INTEGER) AS n_bins,
  round(b.bin * (span * 2 / n_bins) - span, 9) AS bin_start, round((b.bin + 1) * (span * 2 / n_bins) - span, 9) AS bin_end,
  coalesce(n, 0) AS count, round(mean, 9) AS mean
FROM (SELECT metric, span, mean, n_bins, unnest(range(n_bins)) AS bin FROM ranges) AS b
LEFT JOIN (SELECT d.metric, greatest(0, least(n_bins - 1, CAST(floor((diff + span) / (span * 2) * n_bins) AS BIGINT))) AS bin, count(*) AS n
  FROM diffs AS d JOIN ranges ON d.metric = ranges.metric GROUP BY 1, 2) AS c ON b.metric = c.metric AND b.bin = c.bin""", "ranges"))
def report_symmetric_histogram(spark, sf):
    return rounded(report.symmetric_histogram(report.paired_differences(t.paired(spark, sf))))


@query("report_fixed_histogram", with_ctes("""
SELECT c.metric, round(bin * 0.005e0, 9) AS bin_start, n AS count, round(mean, 9) AS mean
FROM (SELECT metric, floor(round(diff / 0.005e0, 9)) AS bin, count(*) AS n FROM diffs GROUP BY 1, 2) AS c
JOIN (SELECT metric, avg(diff) AS mean FROM diffs GROUP BY metric) AS m ON c.metric = m.metric""", "diffs"))
def report_fixed_histogram(spark, sf):
    return rounded(report.fixed_histogram(report.paired_differences(t.paired(spark, sf))))


def flagship(spark, sf, settings):
    """Cycles to test results in one go: fact, channel marts, six tests."""
    built = core.build_fact(t.features(tune(spark), sf), t.trials(spark, sf), settings, t.trial_rows(spark, sf))
    cycles = t.materialise(built, "flagship-fact")
    load = marts.channel_load(cycles, settings, cycles.count())
    pairs = t.materialise(marts.channel_paired(load, settings), "flagship-paired")
    return run_analysis(pairs, settings.analysis)
