"""Runs of consecutive flagged rows inside a signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.operators.skew import HotKeys, number_rows


def flagged_runs(
    df: DataFrame, keys: Sequence[str], index: str, flag: str, hot: HotKeys | None = None
) -> DataFrame:
    """One row per run of consecutive ``flag`` rows: keys, first and last index, length.

    ``index`` numbers every row of the key from 1. Within a run, index minus the
    position among flagged rows is constant, which names the run.
    """
    flagged = number_rows(df.filter(F.col(flag)).select(*keys, index), keys, [index], "_position", hot=hot)
    run = (F.col(index) - F.col("_position")).alias("_run")
    return (
        flagged.groupBy(*keys, run)
        .agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count("*").alias("run_length"))
        .drop("_run")
    )


def at_signal_edge(index: str = "cycle_idx", total: str = "cycles_in_signal") -> Column:
    """First or last row of its signal, where consistency measures are undefined."""
    return (F.col(index) == 1) | (F.col(index) == F.col(total))
