"""SQL texts of the tables in ``showcase.tables`` and of the warehouse built on them."""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *needs: str):
    def add(text: str) -> None:
        CTES[name] = (needs, text.strip())

    return add


def with_ctes(final: str, *names: str) -> str:
    """``final`` preceded by the named tables and all they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    body = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in ordered)
    return f"WITH {body}\n{final.strip()}"


def rounded(*columns: str, digits: int = 9) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


cte("feat")("""
SELECT 'S' || CAST(s_nationkey AS VARCHAR) AS subject_id, l_linestatus AS region,
  strftime(l_shipdate, '%Y%m') || '01_000000' AS extraction_id, l_shipdate AS extracted_at,
  CAST(l_orderkey AS INTEGER) AS trial, CAST(length(p_type) AS INTEGER) AS channel_idx, p_type AS channel_label,
  l_discount * 10 AS amp_fraction,
  CASE WHEN l_linenumber > 1 THEN l_tax * 12.5e0 END AS amp_consistency,
  CASE WHEN l_linenumber > 1 THEN l_discount * 10 END AS period_consistency,
  l_tax * 12.5e0 AS monotonicity, l_quantity AS period,
  l_quantity / 2 AS time_peak, l_quantity / 2 AS time_trough,
  l_quantity / 4 AS time_rise, l_quantity * 3 / 4 AS time_decay,
  floor(l_extendedprice) / 2 AS volt_peak, -floor(l_extendedprice) / 2 AS volt_trough,
  floor(l_extendedprice) AS volt_rise, floor(l_extendedprice) AS volt_decay,
  floor(l_extendedprice) AS volt_amp, floor(l_extendedprice) / 4 AS band_amp,
  CASE WHEN l_quantity <> 50 THEN l_discount * 10 END AS time_ptsym, l_tax * 12.5e0 AS time_rdsym,
  l_suppkey AS sample_peak, l_partkey AS sample_last_zerox_decay, l_suppkey AS sample_zerox_decay,
  CAST(l_linenumber AS BIGINT) AS sample_zerox_rise,
  CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS sample_last_trough,
  CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey + CAST(l_quantity AS BIGINT) AS sample_next_trough,
  l_returnflag <> 'N' AS is_burst, 'lineitem' AS source_file, 'run' AS run_id, l_shipdate AS loaded_at
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
""")

cte("trial_metadata")("""
SELECT 'S' || CAST(s_nationkey AS VARCHAR) AS subject_id, CAST(o_orderkey AS INTEGER) AS trial,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS load_condition, o_orderstatus = 'F' AS correct, 'run' AS run_id
FROM (SELECT DISTINCT s_nationkey, l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) AS seen
JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'S' || CAST(c_nationkey AS VARCHAR), CAST(o_orderkey AS INTEGER),
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER), o_orderstatus = 'F', 'run'
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")

cte("numbered", "feat")("""
SELECT * EXCLUDE (time_peak, time_trough, time_rise, time_decay, volt_peak, volt_trough, volt_rise, volt_decay,
    sample_peak, sample_last_zerox_decay, sample_zerox_decay, sample_zerox_rise),
  CAST(row_number() OVER along AS INTEGER) AS cycle_idx, count(*) OVER whole AS cycles_in_signal,
  period / 80e0 AS period_s, CASE WHEN period > 0 THEN 80e0 / period END AS cycle_freq_hz
FROM feat WINDOW whole AS (PARTITION BY subject_id, region, channel_label, trial),
  along AS (whole ORDER BY sample_last_trough NULLS LAST, sample_peak NULLS LAST)
""")

cte("fact", "numbered", "trial_metadata")("""
FROM numbered LEFT JOIN (SELECT subject_id, trial, load_condition, correct AS trial_correct FROM trial_metadata) AS conditions
USING (subject_id, trial)
""")

# Values of a channel under a condition, as lists; whatever a mart shows is worked out of these.
cte("channel_values", "fact")("""
SELECT subject_id, region, channel_label, load_condition, list(trial) AS trials, list(time_ptsym) AS ptsym, list(time_rdsym) AS rdsym,
  list(cycle_freq_hz) AS freq, list(volt_amp) AS amp, max(extracted_at) AS extracted_at
FROM fact WHERE is_burst AND (load_condition + time_ptsym + time_rdsym) IS NOT NULL
GROUP BY ALL
""")

cte("channel_load", "channel_values")("""
SELECT subject_id, region, channel_label, load_condition, CAST(len(ptsym) AS BIGINT) AS n_cycles,
  CAST(len(list_distinct(trials)) AS BIGINT) AS n_trials,
  list_avg(ptsym) AS mean_ptsym, list_median(ptsym) AS median_ptsym, list_stddev_samp(ptsym) AS sd_ptsym,
  list_avg(rdsym) AS mean_rdsym, list_median(rdsym) AS median_rdsym, list_stddev_samp(rdsym) AS sd_rdsym,
  list_avg(freq) AS mean_cycle_freq_hz, list_avg(amp) AS mean_volt_amp, extracted_at
FROM channel_values
""")

cte("pivoted", "channel_load")("""
SELECT subject_id, region, channel_label, b.n_cycles AS n_cycles_baseline, c.n_cycles AS n_cycles_comparison,
  b.n_trials AS n_trials_baseline, c.n_trials AS n_trials_comparison,
  b.mean_ptsym AS ptsym_baseline, c.mean_ptsym AS ptsym_comparison, b.mean_rdsym AS rdsym_baseline, c.mean_rdsym AS rdsym_comparison,
  top AS mean_cycle_freq_hz
FROM (SELECT subject_id, region, channel_label, max(mean_cycle_freq_hz) AS top FROM channel_load GROUP BY ALL) AS every
LEFT JOIN (FROM channel_load WHERE load_condition = 1) AS b USING (subject_id, region, channel_label)
LEFT JOIN (FROM channel_load WHERE load_condition = 3) AS c USING (subject_id, region, channel_label)
""")

# A sum is null as soon as one part is; both counts are there once the means are.
cte("paired", "pivoted")("""
SELECT *, exclusion_reason IS NULL AS included FROM (
  SELECT *, ptsym_comparison - ptsym_baseline AS ptsym_diff, rdsym_comparison - rdsym_baseline AS rdsym_diff,
    CASE WHEN (ptsym_comparison + ptsym_baseline + rdsym_comparison + rdsym_baseline) IS NULL THEN 'missing one condition'
      WHEN least(n_cycles_baseline, n_cycles_comparison) < 10 THEN 'below minimum cycle count' END AS exclusion_reason
  FROM pivoted
) AS reasoned
""")

cte("histogram", "fact")("""
SELECT metric, region, load_condition, is_burst, bin / 50e0 AS bin_start, (bin + 1) / 50e0 AS bin_end,
  CAST(sum(n) AS BIGINT) AS n_cycles, count(*) AS n_subjects
FROM (
  SELECT metric, region, load_condition, is_burst, subject_id, floor(value * 50) AS bin, count(*) AS n
  FROM (UNPIVOT (SELECT region, load_condition, is_burst, subject_id, time_ptsym, time_rdsym FROM fact)
    ON time_ptsym, time_rdsym INTO NAME metric VALUE value) AS long
  GROUP BY ALL
) AS by_subject GROUP BY metric, region, load_condition, is_burst, bin
""")

cte("coverage", "fact", "paired")("""
SELECT subject_id, region, count(*) AS n_channels, CAST(len(list_distinct(flatten(list(trials)))) AS BIGINT) AS n_trials,
  CAST(sum(n) AS BIGINT) AS n_cycles, CAST(sum(bursts) AS BIGINT) AS n_burst_cycles, sum(bursts) * 1e0 / sum(n) AS burst_fraction,
  CAST(count_if(coalesce(included, false)) AS BIGINT) AS n_channels_included, max(newest) AS extracted_at
FROM (
  SELECT subject_id, region, channel_label, list(trial) AS trials, count(*) AS n, count_if(is_burst) AS bursts, max(extracted_at) AS newest
  FROM fact GROUP BY ALL
) AS channels LEFT JOIN (SELECT subject_id, region, channel_label, included FROM paired) AS verdicts USING (subject_id, region, channel_label)
GROUP BY ALL
""")

cte("diffs", "paired")("""
SELECT subject_id, region, channel_label, 'ptsym' AS metric, ptsym_diff AS diff FROM paired WHERE included
UNION ALL SELECT subject_id, region, channel_label, 'rdsym', rdsym_diff FROM paired WHERE included
""")

cte("ranges", "diffs")("""
SELECT metric, span, mean, greatest(6, CAST(floor(span * 2 / 0.004e0 + 0.5e0) AS BIGINT)) AS n_bins FROM (
  SELECT metric, greatest(abs(min(diff)), abs(max(diff)), 0.008e0) AS span, avg(diff) AS mean FROM diffs GROUP BY metric
) AS spans
""")

# -- run history --------------------------------------------------------------

cte("runs")("""
SELECT 'run-' || strftime(o_orderdate, '%Y%m') AS run_id, 'cli' AS triggered_by, min(o_orderdate) AS started_at,
  CASE WHEN count(*) % 5 <> 0 THEN max(o_orderdate) END AS finished_at,
  CASE WHEN count(*) % 5 <> 0 THEN 'success' ELSE 'running' END AS status, CAST(NULL AS VARCHAR) AS message
FROM orders GROUP BY 1
""")

cte("source_files")("""
SELECT 'run-' || strftime(o_orderdate, '%Y%m') AS run_id, '/src/' || CAST(o_orderkey AS VARCHAR) AS source_path,
  CASE o_orderstatus WHEN 'F' THEN 'loaded' WHEN 'P' THEN 'skipped' ELSE 'discovered' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS row_count,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS size_bytes
FROM orders
""")

cte("dq_results")("""
SELECT 'run-' || strftime(l_shipdate, '%Y%m') AS run_id, l_returnflag || '-' || l_linestatus AS check_name,
  CASE WHEN l_returnflag = 'N' THEN 'warn' ELSE 'error' END AS severity, l_quantity < 45 AS passed,
  l_quantity AS observed, 45e0 AS threshold, l_shipdate AS checked_at
FROM lineitem
""")

cte("file_totals", "source_files")("""
SELECT run_id, CAST(sum(n) AS BIGINT) AS files_seen, CAST(sum(if(status = 'loaded', n, 0)) AS BIGINT) AS files_loaded,
  CAST(sum(if(status = 'skipped', n, 0)) AS BIGINT) AS files_skipped, CAST(sum(read_rows) AS BIGINT) AS rows_loaded,
  CAST(sum(read_bytes) AS BIGINT) AS bytes_read
FROM (
  SELECT run_id, status, count(*) AS n, ifnull(sum(row_count), 0) AS read_rows, ifnull(sum(size_bytes), 0) AS read_bytes
  FROM source_files GROUP BY ALL
) AS by_status GROUP BY run_id
""")

cte("check_totals", "dq_results")("""
SELECT run_id, n AS checks_run, errors + warnings AS checks_failed, errors AS dq_errors, warnings AS dq_warnings
FROM (
  SELECT run_id, count(*) AS n, CAST(count_if(severity = 'error' AND NOT passed) AS BIGINT) AS errors,
    CAST(count_if(severity = 'warn' AND NOT passed) AS BIGINT) AS warnings
  FROM dq_results GROUP BY run_id
) AS counted
""")

cte("run_health", "runs", "file_totals", "check_totals")(r"""
SELECT runs.*, ifnull(date_diff('second', started_at, finished_at), 0) AS duration_s,
  ifnull(COLUMNS('^(files|rows|bytes|checks|dq)_.*'), 0) AS '\0'
FROM runs LEFT JOIN file_totals USING (run_id) LEFT JOIN check_totals USING (run_id)
""")

# -- source files -------------------------------------------------------------

cte("source_paths", "feat")(r"""
SELECT CASE
  WHEN n % 6 = 1 THEN '/src/' || subject_id || '/' || subject_id || '_merged_bycycle_features_' || stamp || '.csv'
  WHEN n % 6 = 2 THEN '/src/' || subject_id || '/X/' || name
  WHEN n % 6 = 3 THEN '/src/' || subject_id || '/' || region || '/' || subject_id || '_' || region || '_bycycle_features_' || substr(stamp, 1, 4) || '1399_000000.csv'
  WHEN n % 6 = 4 THEN '/src/' || subject_id || '/' || name
  WHEN n % 6 = 5 AND region = 'O' THEN '/src/Z/' || region || '/' || name
  ELSE '/src/' || subject_id || '/' || region || '/' || name END AS path
FROM (
  SELECT subject_id, region, stamp, CAST(substr(subject_id, 2) AS INTEGER) AS n,
    subject_id || '_' || region || '_bycycle_features_' || stamp || '.csv' AS name
  FROM (SELECT DISTINCT subject_id, region, extraction_id AS stamp FROM feat) AS k
) AS named
""")

cte("classified", "source_paths")(r"""
SELECT path AS source_path, subject, reg, stamp,
  CASE
    WHEN regexp_matches(name, '_merged_bycycle_features_') THEN 'merged session file, its rows are in the region files'
    WHEN substr(stamp, 5, 2) > '12' THEN 'no such moment: ' || stamp
    WHEN len(parts) <> 3 THEN 'not in a region folder of a subject: ' || substr(path, 6)
    WHEN parts[1] <> subject THEN 'subject ' || subject || ' in the folder of ' || parts[1]
    WHEN parts[2] <> reg THEN 'region ' || reg || ' in the folder of ' || parts[2]
    WHEN CAST(substr(subject, 2) AS INTEGER) >= 20 THEN 'subject ' || subject || ' was not asked for' END AS reason
FROM (
  SELECT path, string_split(substr(path, 6), '/') AS parts, regexp_extract(path, '[^/]+$') AS name,
    regexp_extract(path, '([^/]+)_([A-Za-z0-9]+)_bycycle_features_(\d{8}_\d{6})\.csv$', 1) AS subject,
    regexp_extract(path, '([^/]+)_([A-Za-z0-9]+)_bycycle_features_(\d{8}_\d{6})\.csv$', 2) AS reg,
    regexp_extract(path, '([^/]+)_([A-Za-z0-9]+)_bycycle_features_(\d{8}_\d{6})\.csv$', 3) AS stamp
  FROM source_paths
) AS p
""")

cte("tree", "feat")("""
SELECT feat.* EXCLUDE (extraction_id), strftime(extracted_at, '%Y') || '0101_' ||
  printf('%02d%02d%02d', trial // 2000000 // 3600, trial // 2000000 // 60 % 60, trial // 2000000 % 60) AS extraction_id
FROM feat
""")

# -- recordings ---------------------------------------------------------------

cte("samples")("""
SELECT 'rec' || CAST(vec_id // 250 AS VARCHAR) AS session_id, CAST(k AS INTEGER) AS column_idx, vec_id % 250 AS t_index,
  CASE WHEN vec_id % 97 = 0 AND k % 16 = 0 THEN CAST('nan' AS DOUBLE) ELSE CAST(embedding[k + 1] AS DOUBLE) END AS value
FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS k FROM embeddings) AS u
""")

cte("recordings")("""
SELECT 'rec' || CAST(vec_id // 250 AS VARCHAR) AS session_id, count(*) AS n_samples FROM embeddings GROUP BY 1
""")

cte("channels", "samples")("""
SELECT session_id, column_idx, location, hemisphere, region,
  hemisphere || region || CAST(row_number() OVER (PARTITION BY session_id, hemisphere, region ORDER BY column_idx) AS VARCHAR) AS channel_label
FROM (
  SELECT session_id, column_idx,
    ['hippocampus_left', 'hippocampus_right', 'amygdala_left', 'dorsal_anterior_cingulate_cortex_right',
     'pre_supplementary_motor_area_left', 'unknown_region_right', 'ventral_medial_prefrontal_cortex', '_left'][column_idx % 8 + 1] AS location,
    ['L', 'R', 'L', 'R', 'L', 'R', '', 'L'][column_idx % 8 + 1] AS hemisphere,
    ['Hipp', 'Hipp', 'Amg', 'dACC', 'preSMA', 'UnknownRegion', 'vmPFC', 'NA'][column_idx % 8 + 1] AS region
  FROM (SELECT DISTINCT session_id, column_idx FROM samples) AS c
) AS coded
""")

cte("rec_trials")("""
SELECT 'rec' || CAST(vec_id // 250 AS VARCHAR) AS session_id, (vec_id % 250) / 10e0 AS onset_s,
  CAST(vec_id % 3 + 1 AS INTEGER) AS load, vec_id % 2 = 1 AS correct,
  CAST(row_number() OVER (PARTITION BY vec_id // 250 ORDER BY vec_id) - 1 AS INTEGER) AS trial
FROM embeddings WHERE label = 0
""")

cte("windows", "rec_trials", "recordings")("""
SELECT session_id, trial, i_low, i_high FROM (
  SELECT t.session_id, trial, greatest(0, CAST(ceil((onset_s - 0.3e0) * 10e0 - 1e-9) AS BIGINT)) AS i_low,
    least(n_samples, CAST(ceil((onset_s + 2.8e0) * 10e0 - 1e-9) AS BIGINT)) AS i_high
  FROM rec_trials AS t JOIN recordings AS r ON t.session_id = r.session_id
) AS w WHERE i_low < i_high
""")

cte("epochs", "windows", "samples", "channels")("""
SELECT w.session_id, w.trial, s.column_idx, c.region, c.channel_label, count(*) AS n_samples, min(s.t_index) AS first_sample,
  bool_and(NOT isnan(s.value)) AS finite, max(s.value) AS top, min(s.value) AS bottom,
  sum(s.value * (s.t_index - w.i_low)) AS moment
FROM windows AS w JOIN samples AS s ON w.session_id = s.session_id AND s.t_index >= w.i_low AND s.t_index < w.i_high
JOIN channels AS c ON c.session_id = s.session_id AND c.column_idx = s.column_idx
GROUP BY ALL
""")

cte("ordered_events")("""
SELECT event_id, user_id, ts, event_type, value,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS cycle_idx,
  count(*) OVER (PARTITION BY user_id) AS cycles_in_signal
FROM events
""")

# -- resampling ---------------------------------------------------------------

cte("units", "paired")("""
SELECT subject_id || '|' || region || '|' || channel_label AS unit,
  ptsym_baseline AS px, ptsym_comparison AS py, rdsym_baseline AS rx, rdsym_comparison AS ry
FROM paired WHERE included
""")

cte("long_units", "units")("""
SELECT unit, 'time_ptsym' AS metric, 'paired_sign_flip' AS test, py - px AS value, py - px AS interval_value, px AS x, py AS y FROM units
UNION ALL SELECT unit, 'time_ptsym@load1', 'one_sample_vs_0.5', px - 0.5e0, px, px, NULL FROM units
UNION ALL SELECT unit, 'time_ptsym@load3', 'one_sample_vs_0.5', py - 0.5e0, py, py, NULL FROM units
UNION ALL SELECT unit, 'time_rdsym', 'paired_sign_flip', ry - rx, ry - rx, rx, ry FROM units
UNION ALL SELECT unit, 'time_rdsym@load1', 'one_sample_vs_0.5', rx - 0.5e0, rx, rx, NULL FROM units
UNION ALL SELECT unit, 'time_rdsym@load3', 'one_sample_vs_0.5', ry - 0.5e0, ry, ry, NULL FROM units
""")

cte("described", "long_units")("""
SELECT metric, test, count(*) AS n_units, avg(value) AS mean, stddev_samp(value) AS sd, sum(value * value) AS square_sum,
  CASE WHEN stddev_samp(value) > 0 THEN avg(value) / (stddev_samp(value) / sqrt(count(*))) ELSE 0 END AS observed,
  CASE WHEN stddev_samp(value) > 0 THEN avg(value) / stddev_samp(value) ELSE 0 END AS effect_size_dz,
  avg(x) AS mean_baseline, avg(y) AS mean_comparison
FROM long_units GROUP BY metric, test
""")

cte("signs", "units")("""
SELECT unit, block * 64 + word * 32 + bit AS permutation, (digits >> bit) & 1 = 1 AS keep FROM (
  SELECT unit, block, word, CAST('0x' || substr(digest, 1 + 8 * word, 8) AS BIGINT) AS digits
  FROM (SELECT unit, block, md5('20240115|flip|' || CAST(block AS VARCHAR) || '|' || unit) AS digest
        FROM units, (SELECT unnest(range(157)) AS block) AS b) AS h, (SELECT unnest(range(2)) AS word) AS w
) AS d, (SELECT unnest(range(32)) AS bit) AS k
WHERE block * 64 + word * 32 + bit < 10000
""")

cte("flips", "signs", "long_units")("""
SELECT metric, test, permutation, sum(CASE WHEN keep THEN value ELSE -value END) AS flipped_sum
FROM signs JOIN long_units ON signs.unit = long_units.unit GROUP BY metric, test, permutation
""")

cte("p_values", "flips", "described")("""
SELECT metric, test, count(*) FILTER (WHERE abs(t) >= abs(observed) - 1e-12) AS exceedances,
  (1e0 + count(*) FILTER (WHERE abs(t) >= abs(observed) - 1e-12)) / 10001e0 AS p_value
FROM (
  SELECT f.metric, f.test, observed, CASE WHEN square_sum / n_units - (flipped_sum / n_units) ** 2 > 0
    THEN flipped_sum / n_units / sqrt((square_sum / n_units - (flipped_sum / n_units) ** 2) / (n_units - 1)) ELSE 0 END AS t
  FROM flips AS f JOIN described AS d ON f.metric = d.metric AND f.test = d.test
) AS permuted GROUP BY metric, test
""")

cte("indexed", "units")("""
SELECT unit, row_number() OVER (ORDER BY md5(unit), unit) - 1 AS unit_index, count(*) OVER () AS n FROM units
""")

cte("draws", "indexed")("""
SELECT block * 4 + word AS resample, CAST('0x' || substr(digest, 1 + 8 * word, 8) AS BIGINT) % n AS unit_index FROM (
  SELECT n, block, md5('20240115|boot|' || CAST(block AS VARCHAR) || '|' || CAST(unit_index AS VARCHAR)) AS digest
  FROM indexed, (SELECT unnest(range(1250)) AS block) AS b
) AS h, (SELECT unnest(range(4)) AS word) AS w
""")

cte("intervals", "draws", "indexed", "long_units")("""
SELECT metric, test, quantile_cont(m, (1 - 0.95e0) / 2) AS ci_lower, quantile_cont(m, 1 - (1 - 0.95e0) / 2) AS ci_upper FROM (
  SELECT metric, test, resample, avg(interval_value) AS m
  FROM draws JOIN indexed ON draws.unit_index = indexed.unit_index JOIN long_units ON long_units.unit = indexed.unit
  GROUP BY metric, test, resample
) AS means GROUP BY metric, test
""")

cte("suite", "described", "p_values", "intervals")("""
SELECT d.metric, d.test, 't_stat' AS statistic, CAST(n_units AS INTEGER) AS n_units, observed, p_value,
  CASE WHEN d.test = 'paired_sign_flip' THEN least(1e0, max(scaled) OVER (PARTITION BY d.test ORDER BY p_value, d.metric
    ROWS UNBOUNDED PRECEDING)) END AS p_value_adjusted,
  CASE WHEN d.test = 'paired_sign_flip' THEN 'holm-bonferroni' END AS adjustment,
  effect_size_dz, ci_lower, ci_upper, 0.95e0 AS ci_level, mean_baseline, mean_comparison, 10000 AS n_permutations
FROM described AS d
JOIN (SELECT *, (count(*) OVER (PARTITION BY test) - row_number() OVER (PARTITION BY test ORDER BY p_value, metric) + 1) * p_value AS scaled
      FROM p_values) AS p ON d.metric = p.metric AND d.test = p.test
JOIN intervals AS i ON d.metric = i.metric AND d.test = i.test
""")
