"""Data-quality checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from cyclemart.contract import SIGNAL_KEYS
from cyclemart.plans import quality
from showcase import tables as t
from showcase.registry import query, rounded
from showcase.sql import with_ctes

AT = datetime(2025, 6, 1, 9, 15)

OBSERVED = """
SELECT unnest(map_entries(MAP {
    'fact_not_empty': n, 'symmetry_null_fraction': ifnull(unknown / n, 0), 'symmetry_within_bounds': outside,
    'trial_condition_coverage': ifnull(unlabelled / n, 1), 'burst_fraction_plausible': ifnull(bursts / n, 0),
    'cycle_frequency_in_band': ifnull(off_band / nullif(timed, 0), 0), 'channel_dropout': ifnull((units - good) / nullif(units, 0), 1),
    'paired_units_sufficient': good, 'cycle_grain_unique': twice, 'natural_key_unique': again,
    'single_extraction_per_partition': mixed, 'no_orphan_trials': orphans, 'trial_coverage_gaps': ifnull(orphans / nullif(listed, 0), 0)
  })) AS entry
FROM (
  SELECT count(*) AS n, count_if((time_ptsym + time_rdsym) IS NULL) * 1e0 AS unknown,
    count_if(greatest(time_ptsym, time_rdsym) > 1 OR least(time_ptsym, time_rdsym) < 0) AS outside,
    count_if(load_condition IS NULL) * 1e0 AS unlabelled, count_if(is_burst) * 1e0 AS bursts,
    count(cycle_freq_hz) AS timed, count_if(cycle_freq_hz NOT BETWEEN 3e0 * 0.6e0 AND 7e0 * 1.6e0) * 1e0 AS off_band
  FROM fact
) AS cycles, (SELECT count(*) * 1e0 AS units, count_if(included) * 1e0 AS good FROM paired) AS pairs,
(SELECT count_if(n > 1) AS twice FROM (SELECT count(*) AS n FROM fact GROUP BY subject_id, region, channel_label, trial, cycle_idx) AS g) AS grain,
(SELECT count_if(n > 1) AS again FROM (SELECT count(*) AS n FROM fact GROUP BY subject_id, region, channel_label, trial, sample_last_trough) AS g) AS natural_key,
(SELECT count_if(low < high) AS mixed FROM (SELECT min(extraction_id) AS low, max(extraction_id) AS high FROM fact GROUP BY subject_id, region) AS g) AS extractions,
(SELECT count(*) * 1e0 AS listed FROM trial_metadata) AS trials,
(SELECT count(*) * 1e0 AS orphans FROM trial_metadata ANTI JOIN fact USING (subject_id, trial)) AS unmatched"""

LIMITS = """
SELECT * FROM (VALUES ('fact_not_empty', 'error', '>', 0e0), ('cycle_grain_unique', 'error', '==', 0e0),
  ('single_extraction_per_partition', 'error', '==', 0e0), ('symmetry_null_fraction', 'error', '<=', 0.05e0),
  ('symmetry_within_bounds', 'error', '==', 0e0), ('trial_condition_coverage', 'error', '<=', 0.05e0),
  ('channel_dropout', 'error', '<=', 0.1e0), ('paired_units_sufficient', 'error', '>=', 2e0),
  ('cycle_frequency_in_band', 'warn', '<=', 0.2e0), ('burst_fraction_plausible', 'warn', '>=', 0.05e0),
  ('trial_coverage_gaps', 'error', '<=', 0.05e0), ('no_orphan_trials', 'warn', '==', 0e0),
  ('natural_key_unique', 'error', '==', 0e0)) AS v(check_name, severity, comparison, threshold)"""

JUDGED = f"""
SELECT check_name, severity, CASE comparison WHEN '<=' THEN observed <= threshold WHEN '>=' THEN observed >= threshold
  WHEN '>' THEN observed > threshold ELSE observed = threshold END AS passed, observed, threshold
FROM ({LIMITS}) AS l JOIN (SELECT entry.key AS check_name, CAST(entry.value AS DOUBLE) AS observed FROM ({OBSERVED}) AS e) AS o USING (check_name)"""


def _outcomes(spark, sf):
    return quality.run_checks(t.checked_signals(spark, sf), t.once(spark, sf, "trials", lambda: t.trials(spark, sf)), t.paired(spark, sf), t.SETTINGS, "run", AT)


@query("quality_checks", with_ctes(f"""
SELECT check_name, severity, passed, round(observed, 9) AS observed, threshold FROM ({JUDGED}) AS j""", "fact", "paired", "trial_metadata"))
def quality_checks(spark, sf):
    return rounded(_outcomes(spark, sf).select("check_name", "severity", "passed", "observed", "threshold"))


@query("quality_gate", with_ctes(f"""
SELECT count(*) FILTER (WHERE NOT passed AND severity = 'error') AS blocking,
  count(*) FILTER (WHERE NOT passed) AS blocking_with_warnings, count(*) AS checks_run FROM ({JUDGED}) AS j""", "fact", "paired", "trial_metadata"))
def quality_gate(spark, sf):
    """How many checks keep the run back, with and without warnings counting."""
    outcomes = t.once(spark, sf, "outcomes", lambda: _outcomes(spark, sf))
    sides = [
        df.agg(F.count("*").alias(name)) for name, df in (
            ("blocking", quality.blocking(outcomes)), ("blocking_with_warnings", quality.blocking(outcomes, True)), ("checks_run", outcomes),
        )
    ]
    numbered = [side.withColumn("_one", F.lit(1)) for side in sides]  # each is one row
    return numbered[0].join(numbered[1], "_one").join(numbered[2], "_one").drop("_one")


@query("repeated_cycles", with_ctes("""
SELECT 'trial_rows' AS check_name, CAST(count(*) AS DOUBLE) AS observed FROM (
  SELECT subject_id, region, channel_label, trial FROM fact GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) AS g""", "fact"))
def repeated_cycles(spark, sf):
    return quality.repeated_groups(t.fact(spark, sf), SIGNAL_KEYS, "trial_rows")


@query("mixed_extractions", with_ctes("""
SELECT 'single_extraction_per_partition' AS check_name, CAST(count(*) AS DOUBLE) AS observed FROM (
  SELECT 1 FROM feat GROUP BY subject_id, region HAVING count(DISTINCT extraction_id) > 1) AS g""", "feat"))
def mixed_extractions(spark, sf):
    return quality.extraction_measures(t.features(spark, sf))
