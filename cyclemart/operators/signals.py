"""From sample tables to per-signal feature rows.

Tables: ``samples(session_id, column_idx, t_index, value)``, one row per sample
and channel, each once; ``recordings(session_id, identifier, subject_field, session_field,
start_time, rate, n_samples)``; ``electrodes(session_id, column_idx, location)``
and ``trials(session_id, trial, onset_s, load, accuracy)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.contract import FEATURE_COLUMNS, SOURCE_COLUMNS
from cyclemart.functions.recordings import epoch_bounds, hemisphere, region_code, session_code, subject_code
from cyclemart.operators.skew import hot_keys, number_rows
from cyclemart.settings import BurstThresholds, Scale, Signal


class SamplingRateError(ValueError):
    """A recording was sampled at another rate than the settings say."""


def measured_rates(samples: DataFrame, session: str, micros: str) -> DataFrame:
    """Samples a second of each recording, by the microseconds of its first and last sample; NULL where these are one."""
    spread = F.nullif(F.max(micros) - F.min(micros), F.lit(0).cast("long"))
    rate = F.lit(1e6) * (F.count("*") - 1) / spread
    return samples.groupBy(F.col(session).cast("string").alias("session_id")).agg(rate.alias("rate"), F.count("*").alias("n_samples"))


def refused_recordings(recordings: DataFrame, fs: float) -> DataFrame:
    """Recordings (``session_id``, ``rate``) whose rate is unknown or, in whole samples, another than the settings say, with the reason."""
    wrong = recordings.filter(F.col("rate").isNull() | (F.round("rate") != fs))
    reason = F.when(F.col("rate").isNull(), F.lit("rate unknown")).otherwise(
        F.concat(F.lit("sampled at "), F.round("rate").cast("long").cast("string"), F.lit(f" Hz, settings say {fs:g} Hz"))
    )
    return wrong.withColumn("reason", reason)


def check_sampling_rate(recordings: DataFrame, fs: float) -> None:
    """Raise for the first of the refused recordings."""
    wrong = refused_recordings(recordings, fs).orderBy("session_id").select("session_id", "reason").first()
    if wrong is not None:
        raise SamplingRateError(f"{wrong['session_id']}: {wrong['reason']}")


def identify_recordings(recordings: DataFrame) -> DataFrame:
    """Add subject and session codes."""
    return recordings.withColumns({
        "subject_id": subject_code(F.col("identifier"), F.col("subject_field")),
        "session_code": session_code(F.col("session_field")),
    })


def channel_table(
    electrodes: DataFrame, regions: Iterable[str] | None = None, scale: Scale = Scale(), known_rows: int | None = None
) -> DataFrame:
    """Channels with region code, side and running label (``LHipp1``, ``LHipp2``…).

    Labels are counted before any region is dropped.
    """
    coded = electrodes.withColumns({
        "hemisphere": hemisphere(F.col("location")),
        "region": region_code(F.col("location")),
    })
    keys = ["session_id", "hemisphere", "region"]
    hot = hot_keys(coded, keys, scale.hot_group_rows, scale.broadcast_rows, known_rows)
    numbered = number_rows(coded, keys, ["column_idx"], "_number", hot=hot)
    label = F.concat("hemisphere", "region", F.col("_number").cast("string"))
    labelled = numbered.withColumn("channel_label", label).drop("_number")
    return labelled if regions is None else labelled.filter(F.col("region").isin(*regions))


def trial_windows(
    trials: DataFrame, recordings: DataFrame, signal: Signal
) -> DataFrame:
    """Sample bounds ``[i_low, i_high)`` of each trial's epoch; empty epochs are left out."""
    low, high = epoch_bounds(
        F.col("onset_s"), F.col("start_time"), signal.fs, signal.epoch_start_s, signal.epoch_end_s, F.col("n_samples")
    )
    return (
        trials.join(recordings.select("session_id", "start_time", "n_samples"), "session_id")
        .select("session_id", "trial", low.alias("i_low"), high.alias("i_high"))
        .filter(F.col("i_low") < F.col("i_high"))
    )


#: Epochs that fit into one stretch of a channel, end to end.
STRETCH_EPOCHS = 8


def epochs(samples: DataFrame, windows: DataFrame, channels: DataFrame, signal: Signal) -> DataFrame:
    """One row per (recording, trial, channel): the samples of its epoch, in order.

    An epoch has at most ``(end - start) * fs`` samples, so the collected array
    is bounded by the settings. ``finite`` tells whether all of them are numbers.

    Samples are not repeated for each epoch that holds them: they are gathered once, in stretches of a channel that run on
    by the longest window, so each epoch is cut from the one stretch that its first sample lies in.
    """
    span = max(1, int((signal.epoch_end_s - signal.epoch_start_s) * signal.fs) + 1)
    longest = windows.agg(F.max(F.col("i_high") - F.col("i_low"))).first()[0]
    reach = max(span, longest or 0)
    labels = channels.select("session_id", "column_idx", "region", "channel_label")
    stretches = _stretches(samples, reach * STRETCH_EPOCHS, reach).join(labels, ["session_id", "column_idx"])
    placed = windows.withColumn("_stretch", F.floor(F.col("i_low") / F.lit(reach * STRETCH_EPOCHS)))
    low, high, first = F.greatest("i_low", "_first"), F.least("i_high", F.col("_last") + 1), F.col("_first")
    cut = F.when(F.col("_even"), F.slice("_points", (low - first + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int"))).otherwise(
        F.filter("_points", lambda point: (point["t_index"] >= F.col("i_low")) & (point["t_index"] < F.col("i_high")))
    )
    points = stretches.join(placed, ["session_id", "_stretch"]).filter((F.col("_first") < F.col("i_high")) & (F.col("_last") >= F.col("i_low")))
    found = points.withColumn("_cut", cut).filter(F.size("_cut") > 0)
    finite = F.forall("_cut.value", lambda value: value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    return found.select(
        "session_id", "trial", "column_idx", "region", "channel_label", F.col("_cut.value").alias("signal"),
        F.col("_cut")[0]["t_index"].alias("first_sample"), F.size("_cut").cast("long").alias("n_samples"), finite.alias("finite"),
    )


def _stretches(samples: DataFrame, width: int, reach: int) -> DataFrame:
    """The samples of each channel from every ``width``-th position on, ``reach`` more than up to the next one, in order,
    with the first and last position; ``_even`` where none is missing in between."""
    at = F.col("t_index")
    numbers = F.sequence(F.floor((at - reach) / F.lit(width)), F.floor(at / F.lit(width)))
    gathered = samples.withColumn("_stretch", F.explode(numbers)).groupBy("session_id", "column_idx", "_stretch").agg(
        F.sort_array(F.collect_list(F.struct("t_index", "value"))).alias("_points"), F.min(at).alias("_first"), F.max(at).alias("_last"),
    )
    even = (F.size("_points") == F.col("_last") - F.col("_first") + 1) & (F.col("_points.t_index") == F.sequence("_first", "_last"))
    return gathered.withColumn("_even", even)


FEATURE_ROWS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("region", T.StringType()),
    *[T.StructField(name, kind) for name, kind in SOURCE_COLUMNS.items()],
    T.StructField("error", T.StringType()),
])

_RETURNED = frozenset({*FEATURE_COLUMNS, "error"})

FeatureFunction = Callable[[list[float]], pd.DataFrame | Mapping[str, Sequence]]
BatchFunction = Callable[[list[list[float]], Signal, BurstThresholds], pd.DataFrame]


def feature_rows(epoch_table: DataFrame, function: FeatureFunction) -> DataFrame:
    """Apply a caller's feature function to every finite epoch.

    The function takes one signal and returns any of the feature columns, one row per cycle: as lists of one length,
    or as a frame, which takes far longer to build than a short signal takes to measure. A failing or empty signal
    gives one row with ``error`` set and no features.
    """
    def each(epochs: list, signal: Signal, thresholds: BurstThresholds) -> pd.DataFrame:
        places, columns = [], {}
        for number, one in enumerate(epochs):
            try:
                rows = _cycle_columns(function(one))
            except Exception as failure:  # any failure of the caller's function is recorded
                rows = {"error": [_reason(failure)]}
            for name, values in rows.items():
                column = columns.setdefault(name, [])
                column.extend([None] * (len(places) - len(column)))
                column.extend(values)
            places.extend([number] * max(map(len, rows.values()), default=0))
        for column in columns.values():
            column.extend([None] * (len(places) - len(column)))
        # As objects, so that longs beside empty cells do not become doubles.
        return pd.DataFrame(columns, dtype="object").assign(epoch=pd.Series(places, dtype="int64"))

    return batch_feature_rows(epoch_table, each, Signal(), BurstThresholds())


def _cycle_columns(rows: pd.DataFrame | Mapping[str, Sequence]) -> dict[str, list]:
    """What one signal gave, as lists of one length; columns that are no features are left out."""
    given = rows.to_dict("list") if isinstance(rows, pd.DataFrame) else {name: list(values) for name, values in rows.items()}
    if len({len(values) for values in given.values()}) > 1:
        raise ValueError("feature columns differ in length")
    if given and not given.keys() & _RETURNED:
        given = {"error": [None] * len(next(iter(given.values())))}
    return {name: values for name, values in given.items() if name in _RETURNED}


def batch_feature_rows(epoch_table: DataFrame, function: BatchFunction, signal: Signal, thresholds: BurstThresholds) -> DataFrame:
    """Apply a caller's feature function to the finite epochs, a batch at a time, with the settings it works by.

    The function takes the signals of a batch, the recording's settings (rate and band) and the burst thresholds. It returns
    any of the feature columns, one row per cycle, with ``epoch``, the place of the cycle's signal in the batch (and may set
    ``error``). An epoch without rows gives one row with ``error`` set. Where a batch fails its epochs are tried one by one,
    so only those that fail alone are recorded as failed.
    """
    identity = {"session_id": "session_id", "region": "region", "trial": "trial",
                "channel_idx": "column_idx", "channel_label": "channel_label"}

    def found(epochs: list) -> pd.DataFrame:
        try:
            return function(epochs, signal, thresholds)
        except Exception as failure:  # any failure of the caller's function is recorded
            if len(epochs) == 1:
                return _failed(0, failure)
        return pd.concat([found([one]).assign(epoch=number) for number, one in enumerate(epochs)], ignore_index=True)

    def frames(batches):
        for batch in batches:
            if not len(batch):
                continue
            rows = found(list(batch["signal"])).reindex(columns=[*FEATURE_COLUMNS, "epoch", "error"])
            silent = sorted(set(range(len(batch))) - set(rows["epoch"]))
            out = pd.concat([rows.astype({"error": "object"}), pd.DataFrame({"epoch": silent, "error": "no cycles"})], ignore_index=True)
            out = out.sort_values("epoch", kind="stable")
            place = out["epoch"].to_numpy(dtype="int64")
            for name, source in identity.items():
                out[name] = batch[source].to_numpy()[place]
            out["error"] = out["error"].astype("object").where(out["error"].notna(), None)
            yield _nullable(out[FEATURE_ROWS.names])

    columns = ["session_id", "region", "trial", "column_idx", "channel_label", "signal"]
    return epoch_table.filter("finite").select(*columns).mapInPandas(frames, FEATURE_ROWS)


def _reason(failure: Exception) -> str:
    return f"{type(failure).__name__}: {failure}"


def _failed(epoch: int, failure: Exception) -> pd.DataFrame:
    return pd.DataFrame({"epoch": [epoch], "error": [_reason(failure)]})


def _nullable(frame: pd.DataFrame) -> pd.DataFrame:
    kinds = {T.IntegerType(): "Int32", T.LongType(): "Int64", T.DoubleType(): "Float64", T.BooleanType(): "boolean"}
    return frame.astype({f.name: kinds.get(f.dataType, "object") for f in FEATURE_ROWS.fields})


def trial_metadata(trials: DataFrame, recordings: DataFrame) -> DataFrame:
    """Condition and correctness per trial, keyed by subject and session."""
    return trials.join(identify_recordings(recordings).select("session_id", "subject_id"), "session_id").select(
        "session_id", "subject_id", F.col("trial").cast("int"),
        F.col("load").cast("int").alias("load_condition"), (F.col("accuracy").cast("int") == 1).alias("correct"),
    )


def extraction_summary(
    recordings: DataFrame, channels: DataFrame, trials: DataFrame, epoch_table: DataFrame, rows: DataFrame
) -> DataFrame:
    """Per recording: regions, trials, channels, feature rows, skipped epochs and a first error."""
    base = identify_recordings(recordings).select("session_id", "subject_id", "session_code")
    per_channel = channels.groupBy("session_id").agg(
        F.countDistinct("region").alias("regions"), F.count("*").alias("channels")
    )
    per_trial = trials.groupBy("session_id").agg(F.count("*").alias("trials"))
    per_epoch = epoch_table.groupBy("session_id").agg(F.count_if(~F.col("finite")).alias("unusable"))
    per_row = rows.groupBy("session_id").agg(
        F.count_if(F.col("error").isNull()).alias("cycle_rows"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.min_by("error", F.when(F.col("error") != "no cycles", F.struct("region", "trial", "channel_idx"))).alias("first_error"),
    )
    joined = base
    for side in (per_channel, per_trial, per_epoch, per_row):
        joined = joined.join(side, "session_id", "left")

    def zero(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    return joined.select(
        "session_id", "subject_id", "session_code", zero("regions").alias("regions"), zero("trials").alias("trials"),
        zero("channels").alias("channels"), zero("cycle_rows").alias("cycle_rows"),
        (zero("unusable") + zero("failed")).alias("skipped_trial_channels"), "first_error",
    )
