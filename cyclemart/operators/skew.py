"""Keys that own too many rows for one task, and ways around them.

Window functions and exact medians send all rows of a key to one task. The
operators here look at the largest key first. When it is small enough the plain
Spark operator runs; otherwise the few hot keys take a second, fully distributed
way and the rest keep the plain one. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.operators.staging_area import materialise


#: Bins of one pass of a selection.
SELECTION_BINS = 4096


@dataclass(frozen=True)
class HotKeys:
    """Keys above a row limit, with their row counts in column ``rows``."""

    keys: tuple[str, ...]
    table: DataFrame
    broadcastable: bool

    def _side(self) -> DataFrame:
        side = self.table.select(*[F.col(key).alias(f"_hot_{key}") for key in self.keys], F.col("rows").alias("_hot_rows"))
        return F.broadcast(side) if self.broadcastable else side

    def _match(self) -> Column:
        condition = F.lit(True)
        for key in self.keys:
            condition = condition & F.col(key).eqNullSafe(F.col(f"_hot_{key}"))
        return condition

    def marked(self, df: DataFrame) -> DataFrame:
        """``df`` written once, with ``_rows``, the row count of a hot row's key (NULL in other rows), and ``_id``, a number
        that no other row has. Hot rows lie in a folder of their own, so either kind is read without the other."""
        joined = df.join(self._side(), self._match(), "left")
        numbered = joined.select(*df.columns, F.col("_hot_rows").alias("_rows"), F.monotonically_increasing_id().alias("_id"))
        return materialise(numbered.withColumn("_hot", F.col("_rows").isNotNull()), "marked", by=("_hot",))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(hot rows, other rows) of ``df``, which is computed once; NULL keys are keys too."""
        marked = self.marked(df)
        return marked.filter("_hot").select(*df.columns), marked.filter("NOT _hot").select(*df.columns)


def hot_keys(
    df: DataFrame, keys: Sequence[str], limit: int, broadcast_rows: int, known_rows: int | None = None
) -> HotKeys | None:
    """Keys with more than ``limit`` rows, or None.

    ``known_rows`` is an upper bound on the row count (Parquet footers give it
    for free); at or below ``limit`` no key can be hot and nothing is read.
    """
    if known_rows is not None and known_rows <= limit:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > limit)
    found = materialise(counts, "hot-keys")  # first, so that ``df`` is computed once
    n_hot = found.count()
    if n_hot == 0:
        return None
    return HotKeys(tuple(keys), found, n_hot <= broadcast_rows)


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    index: str,
    total: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the 1-based position (a long) of each row within its key, and the key's row count.

    With hot keys ``df`` is computed once: its rows are marked and written, and only the hot ones are placed by range.
    Sort keys are ascending with NULLs last; rows equal on all of them get
    distinct positions in any order.
    """
    group = Window.partitionBy(*keys)
    columns = {index: F.row_number().over(group.orderBy(*_nulls_last(order))).cast("long")}
    if total:
        columns[total] = F.count("*").over(group)
    if hot is None:
        return df.withColumns(columns)
    marked, names = hot.marked(df), [*df.columns, *columns]
    own = marked.filter("_hot").drop("_hot")
    numbered = _number_rows_by_range(own, keys, order, index)
    if total:
        numbered = numbered.withColumn(total, F.col("_rows"))
    return marked.filter("NOT _hot").withColumns(columns).select(*names).unionByName(numbered.select(*names))


def _number_rows_by_range(rows: DataFrame, keys: Sequence[str], order: Sequence[str], index: str) -> DataFrame:
    """Positions of written rows (with their ``_id``) whose keys are too large for one task.

    The rows are range-partitioned on (key, order, row id), so one key spreads
    over many partitions and equal rows spread too. Each partition numbers its
    own part; the parts before it, counted per (key, partition), give the offset.
    The partition number is written down before use, because it is not stable
    when a task runs again.
    """
    by_range = rows.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys], *_nulls_last(order), F.col("_id"))
    placed = materialise(by_range.withColumn("_part", F.spark_partition_id()), "hot-ranges")

    parts = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))

    local = Window.partitionBy(*keys, "_part").orderBy(*_nulls_last(order), "_id")
    ranked = placed.withColumn("_local", F.row_number().over(local))
    return join_on_keys(ranked, offsets, [*keys, "_part"], "inner", ["_before"]).select(
        *rows.columns, (F.col("_before") + F.col("_local")).alias(index)
    )


def exact_medians(
    df: DataFrame, keys: Sequence[str], medians: dict[str, str], hot: HotKeys
) -> DataFrame:
    """Exact medians per key (``alias -> column``) when some keys are hot.

    Other keys use the built-in percentile, which holds one key's values in memory.
    """
    hot_rows, other_rows = hot.split(df)
    result = other_rows.groupBy(*keys).agg(*[F.median(c).alias(a) for a, c in medians.items()])
    hot_result = hot_rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    for alias, column in medians.items():
        one = _median_by_counting(hot_rows, keys, column, alias)
        hot_result = join_on_keys(hot_result, one, keys, "left", [alias])
    return result.unionByName(hot_result.drop("_n"))


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, take: Sequence[str]) -> DataFrame:
    """Join on keys that may be NULL, keeping the left row and ``take`` from the right."""
    side = right.select(*[F.col(key).alias(f"_on_{key}") for key in keys], *take)
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_on_{key}"))
    return left.join(side, condition, how).select(*left.columns, *take)


def _open_state(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is known of each key's lower middle value: rank, values below, finite bounds, and the value once found."""
    number, finite = ~F.isnan("_v"), F.abs("_v") < float("inf")
    totals = values.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.count_if(number).alias("_numbers"),
        F.min(F.when(finite, F.col("_v"))).alias("_low"), F.max(F.when(finite, F.col("_v"))).alias("_high"),
    )
    rank = F.floor((F.col("_n") - 1) / 2)
    return totals.withColumns({  # NaN is the largest value
        "_rank": rank, "_below": F.lit(0).cast("long"), "_value": F.when(rank >= F.col("_numbers"), float("nan")),
    }).select(*keys, "_n", "_rank", "_below", F.coalesce("_low", F.lit(0.0)).alias("_low"), F.coalesce("_high", F.lit(0.0)).alias("_high"), "_value")


def _bin() -> Column:
    """Bin of a value between the bounds; a larger value never has a smaller bin, and both bounds have bins of their own ends."""
    value, low, high = (F.col(c) for c in ("_v", "_low", "_high"))
    share = (value / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0))  # halves cannot overflow
    inner = F.least(F.floor(share * SELECTION_BINS), F.lit(SELECTION_BINS - 1))
    return (
        F.when(value == float("-inf"), -1).when(value == float("inf"), SELECTION_BINS)
        .when(value <= low, 0).when(value >= high, SELECTION_BINS - 1).otherwise(F.coalesce(inner, F.lit(0))).cast("int")
    )


def _narrowed(state: DataFrame, values: DataFrame, keys: Sequence[str], first: bool) -> DataFrame:
    """One pass: count the values between the bounds by bin, and go on inside the bin that holds the rank."""
    known = ["_rank", "_below", "_low", "_high"]
    inside = join_on_keys(values, state.filter("_value IS NULL"), keys, "inner", known)
    if not first:
        inside = inside.filter(F.col("_v").between(F.col("_low"), F.col("_high")))
    counted = inside.filter(~F.isnan("_v")).groupBy(*keys, _bin().alias("_bin")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
    )
    bins = counted.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_bin", "_c", "_from", "_to"))).alias("_bins"))
    found = join_on_keys(state, bins, keys, "left", ["_bins"])

    def step(at: Column, each: Column) -> Column:
        passed = at["_below"] + each["_c"]
        here = F.struct(at["_below"].alias("_below"), each["_from"].alias("_from"), each["_to"].alias("_to"))
        later = F.struct(passed.alias("_below"), at["_from"].alias("_from"), at["_to"].alias("_to"))
        return F.when(at["_from"].isNotNull(), at).when(passed > F.col("_rank"), here).otherwise(later)

    nothing = F.lit(None).cast("double")
    start = F.struct(F.col("_below"), nothing.alias("_from"), nothing.alias("_to"))
    reached = found.withColumn("_at", F.when(F.col("_bins").isNotNull(), F.aggregate("_bins", start, step)))
    return reached.select(
        *keys, "_n", "_rank", F.coalesce("_at._below", "_below").alias("_below"), F.coalesce("_at._from", "_low").alias("_low"),
        F.coalesce("_at._to", "_high").alias("_high"),
        F.coalesce("_value", F.when(F.col("_at._from") == F.col("_at._to"), F.col("_at._from"))).alias("_value"),
    )


def _median_by_counting(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    """Exact median per key without sorting a key's values or holding them in one place.

    Values are only counted, in bins that combine map-side: a pass shuffles at most ``SELECTION_BINS`` rows a key and task and
    shrinks a key's bounds to the smallest and largest value of the bin that holds its middle rank. Both bounds fall into different
    bins, so each pass leaves fewer distinct values and the last leaves one. For values spread evenly a pass takes 12 bits.
    """
    values = materialise(df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_v")), "hot-values")
    state, first = materialise(_open_state(values, keys), "hot-state"), True
    while not state.filter("_value IS NULL").isEmpty():
        state, first = materialise(_narrowed(state, values, keys, first), "hot-state"), False
    joined = join_on_keys(values, state, keys, "inner", ["_n", "_value"])
    after = joined.groupBy(*keys, "_n", "_value").agg(
        F.count_if(F.col("_v") <= F.col("_value")).alias("_upto"), F.min(F.when(F.col("_v") > F.col("_value"), F.col("_v"))).alias("_next")
    )
    upper = F.when(F.col("_upto") > F.floor(F.col("_n") / 2), F.col("_value")).otherwise(F.col("_next"))
    return after.select(*keys, ((F.col("_value") + upper) / 2.0).alias(alias))
