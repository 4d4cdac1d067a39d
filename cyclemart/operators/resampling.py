"""Sign-flip permutation tests and bootstrap intervals, one job for any number of tests.

Units are rows; each test is a pair of columns over the same units. Random
draws are hashes of (seed, draw, unit), so a result depends on the seed and the
data only, never on row order or partitioning, and any engine with MD5 can
reproduce it. All tests of a family share their draws.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATISTICS = ("mean_diff", "t_stat")
FLIPS_PER_HASH = 64        # sign flips read from one MD5: two 32-bit words
PICKS_PER_HASH = 4         # bootstrap picks read from one MD5: four 32-bit words
INDEX_PREFIX = 3           # hex digits that split units into 4096 index ranges
SLACK = 1e-12              # ties with the observed statistic count as exceedances


@dataclass(frozen=True)
class SignFlipTest:
    """One test over the units.

    ``value`` is what signs are flipped on, ``interval`` what the bootstrap
    averages; ``baseline`` and ``comparison`` are reported as means.
    """

    metric: str
    test: str
    value: str
    interval: str
    baseline: str
    comparison: str | None = None


class UnitsError(ValueError):
    """The units cannot be tested."""


def _words(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def _word(digest: Column, number: int) -> Column:
    return F.conv(F.substring(digest, 1 + 8 * number, 8), 16, 10).cast("bigint")


LEAST_UNITS = 2


def unit_guards(units: DataFrame, tests: Sequence[SignFlipTest], by: Sequence[str] = ()) -> DataFrame:
    """Per family: n_units, too_few, incomplete (units with a value missing or not finite), and the
    number of such values in each column that the tests use."""
    columns = sorted({c for t in tests for c in (t.value, t.interval, t.baseline, t.comparison) if c})
    bad = [F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in columns]
    return units.groupBy(*by).agg(
        F.count("*").alias("n_units"), (F.count("*") < LEAST_UNITS).alias("too_few"),
        F.count_if(reduce(lambda x, y: x | y, bad)).alias("incomplete"), *[F.count_if(b).alias(c) for b, c in zip(bad, columns)],
    )


def check_units(units: DataFrame, tests: Sequence[SignFlipTest], by: Sequence[str] = ()) -> None:
    """Raise unless every family has two units or more and only finite values."""
    guards = unit_guards(units, tests, by)
    columns = [c for c in guards.columns if c not in (*by, "n_units", "too_few", "incomplete")]
    worst = guards.agg(F.min("n_units").alias("n"), *[F.max(c).alias(c) for c in columns]).first()
    if worst["n"] is None or worst["n"] < LEAST_UNITS:
        raise UnitsError(f"only {worst['n'] or 0} unit(s); a test needs at least {LEAST_UNITS}")
    for column in columns:
        if worst[column]:
            raise UnitsError(f"{column} contains {worst[column]} missing or non-finite value(s)")


def _t(mean: Column, square_sum: Column, n: Column) -> Column:
    """One-sample t from the mean and sum of squares; 0 where there is no spread."""
    spread = F.greatest(F.lit(0.0), square_sum / n - mean * mean)
    return F.when(spread > 0, mean / F.sqrt(spread / (n - F.lit(1.0)))).otherwise(F.lit(0.0))


def unit_values(units: DataFrame, tests: Sequence[SignFlipTest], by: Sequence[str], *keep: str) -> DataFrame:
    """One row per (unit, test)."""
    items = F.array(*[
        F.struct(
            F.lit(i).alias("test_no"),
            F.col(t.value).cast("double").alias("value"),
            F.col(t.interval).cast("double").alias("interval_value"),
            F.col(t.baseline).cast("double").alias("x"),
            (F.col(t.comparison) if t.comparison else F.lit(None)).cast("double").alias("y"),
        )
        for i, t in enumerate(tests)
    ])
    return units.select(*by, *keep, F.inline(items))


def describe_tests(units: DataFrame, tests: Sequence[SignFlipTest], by: Sequence[str] = (), statistic: str = "t_stat") -> DataFrame:
    """Observed statistic, effect size and means per (family, test)."""
    if statistic not in STATISTICS:
        raise ValueError(f"unknown statistic: {statistic}")
    summary = unit_values(units, tests, by).groupBy(*by, "test_no").agg(
        F.count("*").alias("n_units"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.sum(F.col("value") * F.col("value")).alias("square_sum"),
        F.min(F.abs("value")).alias("least"),
        F.max(F.abs("value")).alias("most"),
        F.avg("x").alias("mean_baseline"),
        F.avg("y").alias("mean_comparison"),
    )
    dz = F.when(F.col("sd") > 0, F.col("mean") / F.col("sd")).otherwise(F.lit(0.0))
    t = F.when(F.col("sd") > 0, F.col("mean") / (F.col("sd") / F.sqrt("n_units"))).otherwise(F.lit(0.0))
    return summary.withColumns({
        "observed": t if statistic == "t_stat" else F.col("mean"),
        "effect_size_dz": dz,
    })


def sign_flip_sums(
    units: DataFrame, tests: Sequence[SignFlipTest], unit: str, n_permutations: int, seed: int, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of sign-flipped values per (family, test, permutation).

    One hash per (unit, 64 permutations) yields 64 signs, and the 64 sums are
    aggregated side by side, map-side first: what is shuffled is one row per
    task and block, independent of the number of units.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.lit((n_permutations - 1) // FLIPS_PER_HASH))).alias("block")
    # Units are few bytes in few files, but each stands for n_permutations hashes: deal them out first.
    hashed = (
        units.repartition(units.sparkSession.sparkContext.defaultParallelism, *by, unit).select("*", blocks)
        .withColumn("_digest", _words(F.lit(str(seed)), F.lit("flip"), F.col("block"), F.col(unit)))
        .withColumns({"_w0": _word(F.col("_digest"), 0), "_w1": _word(F.col("_digest"), 1)})
    )
    signed = unit_values(hashed, tests, [*by, "block", "_w0", "_w1"])
    sums = []
    for bit in range(FLIPS_PER_HASH):
        word = F.col(f"_w{bit // 32}").bitwiseAND(1 << (bit % 32))
        sums.append(F.sum(F.when(word != 0, F.col("value")).otherwise(-F.col("value"))).alias(f"s{bit}"))
    wide = signed.groupBy(*by, "test_no", "block").agg(*sums)
    flat = wide.select(
        *by, "test_no", "block", F.posexplode(F.array(*[f"s{bit}" for bit in range(FLIPS_PER_HASH)])).alias("bit", "flipped_sum")
    )
    number = (F.col("block") * FLIPS_PER_HASH + F.col("bit")).cast("bigint").alias("permutation")
    return flat.select(*by, "test_no", number, "flipped_sum").filter(F.col("permutation") < n_permutations)


def permutation_p_values(
    sums: DataFrame, described: DataFrame, n_permutations: int, statistic: str, by: Sequence[str] = ()
) -> DataFrame:
    """Two-sided add-one p-value per (family, test).

    Flipping signs leaves the sum of squares unchanged, so a permuted t needs
    only the permuted mean and grows with it. A permuted mean as large as the
    observed one therefore counts whatever cancellation does to its t. Values
    of one size with one sign have no spread, and then t is 0.
    """
    needed = described.select(*by, "test_no", "n_units", "square_sum", "least", "most", F.col("mean").alias("_mean"), F.col("observed").alias("_observed"))
    joined = sums.join(needed, [*by, "test_no"])
    mean = F.col("flipped_sum") / F.col("n_units")
    limit = F.abs(F.col("_observed")) - F.lit(SLACK)
    if statistic == "t_stat":
        no_spread = (F.col("least") == F.col("most")) & (F.abs(mean) >= F.col("most") * F.lit(1 - SLACK))
        as_large = F.abs(mean) >= F.abs(F.col("_mean")) * F.lit(1 - SLACK)
        t = _t(mean, F.col("square_sum"), F.col("n_units"))
        exceeds = F.when(no_spread, limit <= 0).otherwise((F.abs(t) >= limit) | as_large)
    else:
        exceeds = F.abs(mean) >= limit
    beyond = F.count_if(exceeds)
    return joined.groupBy(*by, "test_no").agg(
        beyond.alias("exceedances"), ((F.lit(1.0) + beyond) / F.lit(1.0 + n_permutations)).alias("p_value")
    )


def index_units(units: DataFrame, unit: str, by: Sequence[str] = ()) -> DataFrame:
    """Number the units of each family 0..n-1 by the MD5 of their key.

    The number is the rank inside one of 4096 digest ranges plus the size of
    the ranges before it, so no task sees all units.
    """
    hashed = units.withColumn("_digest", F.md5(F.col(unit))).withColumn("_range", F.substring("_digest", 1, INDEX_PREFIX))
    inside = Window.partitionBy(*by, "_range").orderBy("_digest", unit)
    ranked = hashed.withColumn("_rank", F.row_number().over(inside))
    sizes = hashed.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        ranked.join(offsets, [*by, "_range"])
        .withColumn("unit_index", F.col("_before") + F.col("_rank") - 1)
        .drop("_digest", "_range", "_rank", "_before")
    )


def bootstrap_means(
    units: DataFrame, tests: Sequence[SignFlipTest], unit: str, n_resamples: int, seed: int, by: Sequence[str] = ()
) -> DataFrame:
    """Mean of every resample with replacement, per (family, test, resample).

    Each unit makes one draw per resample; the drawn index is joined back to
    the units. Draws hold two integers, the units side is joined without a
    hint, so Spark broadcasts it when its size allows and shuffles otherwise.
    """
    values = F.array(*[F.col(t.interval).cast("double") for t in tests])
    indexed = index_units(units.select(*by, F.col(unit).alias("_unit"), values.alias("_values")), "_unit", by)
    sizes = indexed.groupBy(*by).agg(F.count("*").alias("_n"))
    drawn_from = indexed.select(*by, "unit_index").join(sizes, list(by)) if by else _with_count(indexed)
    blocks = F.explode(F.sequence(F.lit(0), F.lit((n_resamples - 1) // PICKS_PER_HASH))).alias("block")
    digest = _words(F.lit(str(seed)), F.lit("boot"), F.col("block"), F.col("unit_index"))
    spread = drawn_from.repartition(units.sparkSession.sparkContext.defaultParallelism, *by, "unit_index")
    hashed = spread.select(*by, "unit_index", "_n", blocks).withColumn("_digest", digest)
    picks = hashed.select(
        *by, "block", F.posexplode(F.array(*[_word(F.col("_digest"), w) % F.col("_n") for w in range(PICKS_PER_HASH)])).alias("word", "unit_index")
    )
    draws = picks.select(*by, (F.col("block") * PICKS_PER_HASH + F.col("word")).alias("resample"), "unit_index").filter(
        F.col("resample") < n_resamples
    )
    drawn = draws.join(indexed.select(*by, "unit_index", "_values"), [*by, "unit_index"])
    means = drawn.groupBy(*by, "resample").agg(*[F.avg(F.col("_values")[i]).alias(f"m{i}") for i in range(len(tests))])
    return means.select(
        *by, "resample", F.posexplode(F.array(*[f"m{i}" for i in range(len(tests))])).alias("test_no", "resampled_mean")
    )


def _with_count(indexed: DataFrame) -> DataFrame:
    total = indexed.count()
    return indexed.select("unit_index", F.lit(total).cast("bigint").alias("_n"))


def percentile_intervals(means: DataFrame, level: float, by: Sequence[str] = ()) -> DataFrame:
    tail = (1.0 - level) / 2.0
    ends = F.percentile("resampled_mean", [tail, 1.0 - tail])
    return means.groupBy(*by, "test_no").agg(F.get(ends, 0).alias("ci_lower"), F.get(ends, 1).alias("ci_upper"))


def sign_flip_tests(
    units: DataFrame,
    tests: Sequence[SignFlipTest],
    unit: str,
    *,
    by: Sequence[str] = (),
    statistic: str = "t_stat",
    n_permutations: int = 10_000,
    n_bootstrap: int = 5_000,
    ci_level: float = 0.95,
    seed: int = 0,
) -> DataFrame:
    """All tests over the units, one row per (family, test). Pass a written table:
    the units are read several times."""
    described = describe_tests(units, tests, by, statistic)
    sums = sign_flip_sums(units, tests, unit, n_permutations, seed, by)
    p_values = permutation_p_values(sums, described, n_permutations, statistic, by)
    intervals = percentile_intervals(bootstrap_means(units, tests, unit, n_bootstrap, seed, by), ci_level, by)
    on = [*by, "test_no"]
    labels = F.create_map(*[x for i, t in enumerate(tests) for x in (F.lit(i), F.struct(F.lit(t.metric).alias("metric"), F.lit(t.test).alias("test")))])
    return (
        described.join(p_values, on).join(intervals, on)
        .withColumn("_label", labels[F.col("test_no")])
        .select(
            *by,
            F.col("_label.metric"), F.col("_label.test"),
            F.lit(statistic).alias("statistic"),
            F.col("n_units").cast("int"),
            "observed", "p_value", "effect_size_dz", "ci_lower", "ci_upper",
            F.lit(float(ci_level)).alias("ci_level"),
            "mean_baseline", "mean_comparison",
            F.lit(int(n_permutations)).alias("n_permutations"),
        )
    )


def holm(results: DataFrame, in_family: Column, by: Sequence[str] = ()) -> DataFrame:
    """Holm step-down over the tests where ``in_family`` holds; others stay unadjusted.

    A family is a handful of tests, so ordering it in a window is safe.
    """
    family = Window.partitionBy(*by, in_family)
    ordered = family.orderBy("p_value", "metric", "test")
    size, rank = F.count("*").over(family), F.row_number().over(ordered)
    scaled = (size - rank + 1) * F.col("p_value")
    stepped = results.withColumn("_scaled", scaled)
    running = F.max("_scaled").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return stepped.withColumns({
        "p_value_adjusted": F.when(in_family, F.least(F.lit(1.0), running)),
        "adjustment": F.when(in_family, F.lit("holm-bonferroni")),
    }).drop("_scaled")
