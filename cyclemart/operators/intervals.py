"""Join of points to half-open time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def points_in_windows(
    points: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    bucket: int,
) -> DataFrame:
    """Pairs where ``keys`` match and ``start <= at < end`` (integer or epoch units).

    The axis is cut into buckets of the given width. A window is repeated for
    each bucket it touches (two, when buckets are as wide as windows), a point
    lies in one; so it is an equi-join on (keys, bucket). One long recording
    spreads over its buckets, and Spark's skew join splits a crowded one.
    """
    width = F.lit(int(bucket))
    cut_points = points.withColumn("_bucket", F.floor(F.col(at) / width))
    first, last = F.floor(F.col(start) / width), F.floor((F.col(end) - F.lit(1)) / width)
    cut_windows = windows.filter(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(first, last)))
    return (
        cut_points.join(cut_windows, [*keys, "_bucket"])
        .filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)))
        .drop("_bucket")
    )
