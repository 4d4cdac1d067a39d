"""Column contract of the cycle-feature files, and the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 source columns, in file order, with their types.
SOURCE_COLUMNS: dict[str, T.DataType] = {
    "trial": T.IntegerType(),
    "channel_idx": T.IntegerType(),
    "channel_label": T.StringType(),
    "amp_fraction": T.DoubleType(),
    "amp_consistency": T.DoubleType(),
    "period_consistency": T.DoubleType(),
    "monotonicity": T.DoubleType(),
    "period": T.DoubleType(),
    "time_peak": T.DoubleType(),
    "time_trough": T.DoubleType(),
    "volt_peak": T.DoubleType(),
    "volt_trough": T.DoubleType(),
    "time_decay": T.DoubleType(),
    "time_rise": T.DoubleType(),
    "volt_decay": T.DoubleType(),
    "volt_rise": T.DoubleType(),
    "volt_amp": T.DoubleType(),
    "time_rdsym": T.DoubleType(),
    "time_ptsym": T.DoubleType(),
    "band_amp": T.DoubleType(),
    "sample_peak": T.LongType(),
    "sample_last_zerox_decay": T.LongType(),
    "sample_zerox_decay": T.LongType(),
    "sample_zerox_rise": T.LongType(),
    "sample_last_trough": T.LongType(),
    "sample_next_trough": T.LongType(),
    "is_burst": T.BooleanType(),
}

# Spellings that mean NULL in source files.
NULL_TOKENS = ("", "NA", "NaN", "NAN", "nan", "None", "null")

# Spellings that mean NULL in published extracts (after trim and lower).
LENIENT_NULL_TOKENS = ("", "na", "nan", "none", "null")

FEATURE_COLUMNS = tuple(SOURCE_COLUMNS)[3:]
SYMMETRY_METRICS = {"time_ptsym": "ptsym", "time_rdsym": "rdsym"}

PARTITION_KEYS = ("subject_id", "region", "extraction_id")
CHANNEL_KEYS = ("subject_id", "region", "channel_label")
TRIAL_KEYS = ("subject_id", "trial")
# Trial keys first: rows sorted for per-signal windows are then sorted for joins on trials.
SIGNAL_KEYS = (*TRIAL_KEYS, "region", "channel_label")
CYCLE_ORDER = ("sample_last_trough", "sample_peak")

# Order of the staging projection.
STAGING_COLUMNS = (
    "subject_id", "region", "extraction_id", "extracted_at",
    "trial", "channel_idx", "channel_label",
    "amp_fraction", "amp_consistency", "period_consistency", "monotonicity",
    "period", "time_peak", "time_trough", "time_rise", "time_decay",
    "volt_peak", "volt_trough", "volt_rise", "volt_decay", "volt_amp", "band_amp",
    "time_ptsym", "time_rdsym",
    "sample_peak", "sample_last_zerox_decay", "sample_zerox_decay", "sample_zerox_rise",
    "sample_last_trough", "sample_next_trough",
    "is_burst", "source_file", "run_id", "loaded_at",
)


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
BOOLEAN, INTEGER, NAIVE_TIME = T.BooleanType(), T.IntegerType(), T.TimestampNTZType()

RAW_SCHEMA = _struct({name: STRING for name in SOURCE_COLUMNS})

# Partition columns sit in the schema as strings, so "001" is never read as 1.
LAKE_SCHEMA = _struct({
    **SOURCE_COLUMNS,
    "extracted_at": NAIVE_TIME, "source_file": STRING, "run_id": STRING, "loaded_at": NAIVE_TIME,
    "subject_id": STRING, "region": STRING, "extraction_id": STRING,
})

TRIAL_SCHEMA = _struct({
    "subject_id": STRING, "trial": INTEGER, "load_condition": INTEGER,
    "correct": BOOLEAN, "run_id": STRING,
})

LEDGER_SCHEMAS = {
    "pipeline_run": _struct({
        "run_id": STRING, "triggered_by": STRING, "started_at": NAIVE_TIME,
        "finished_at": NAIVE_TIME, "status": STRING, "message": STRING,
    }),
    "source_file": _struct({
        "run_id": STRING, "source_path": STRING, "subject_id": STRING, "region": STRING,
        "extraction_id": STRING, "extracted_at": NAIVE_TIME, "size_bytes": LONG,
        "row_count": LONG, "status": STRING, "reason": STRING, "seen_at": NAIVE_TIME,
    }),
    "dq_result": _struct({
        "run_id": STRING, "check_name": STRING, "severity": STRING, "passed": BOOLEAN,
        "observed": DOUBLE, "threshold": DOUBLE, "detail": STRING, "checked_at": NAIVE_TIME,
    }),
    "test_result": _struct({
        "run_id": STRING, "metric": STRING, "test": STRING, "statistic": STRING,
        "n_units": INTEGER, "observed": DOUBLE, "p_value": DOUBLE, "p_value_adjusted": DOUBLE,
        "adjustment": STRING, "effect_size_dz": DOUBLE, "ci_lower": DOUBLE, "ci_upper": DOUBLE,
        "ci_level": DOUBLE, "mean_baseline": DOUBLE, "mean_comparison": DOUBLE,
        "n_permutations": INTEGER, "computed_at": NAIVE_TIME,
    }),
}
