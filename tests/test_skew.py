"""The distributed ways agree with the plain ones, whatever the keys look like."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cyclemart.operators import skew
from cyclemart.operators.runs import flagged_runs
from cyclemart.operators.skew import exact_medians, hot_keys, number_rows
from cyclemart.plans.fact import build_fact
from cyclemart.plans.marts import channel_load
from cyclemart.settings import Analysis, Scale, Settings
from cyclemart.contract import SIGNAL_KEYS

TIGHT = Scale(hot_group_rows=50, hot_median_rows=50)


def skewed(spark, n=3000, seed=1):
    """A third of the rows share one key, some keys and values are NULL, many values repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", "c", "d", None])
        value = None if rng.random() < 0.05 else round(rng.choice([rng.random(), 0.5, 0.25]), 3)
        rows.append((i, key, value, rng.randint(0, 20)))
    return spark.createDataFrame(rows, "id int, k string, v double, o int")


def test_no_probe_below_the_known_bound(spark):
    assert hot_keys(skewed(spark), ["k"], 5000, 100, known_rows=3000) is None


def test_hot_keys_counts(spark):
    df = skewed(spark)
    hot = hot_keys(df, ["k"], 800, 100)
    assert hot is not None and {r.k for r in hot.table.collect()} >= {"hot"}
    hot_rows, other = hot.split(df)
    assert hot_rows.count() + other.count() == df.count()


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_numbering_of_hot_keys(spark, broadcast_rows):
    df = skewed(spark)
    order = ["o", "id"]
    plain = {r.id: (r.n, r.total) for r in number_rows(df, ["k"], order, "n", "total").collect()}
    hot = hot_keys(df, ["k"], 100, broadcast_rows)
    split = {r.id: (r.n, r.total) for r in number_rows(df, ["k"], order, "n", "total", hot).collect()}
    assert split == plain


def test_hot_numbering_computes_its_input_twice(spark):
    """Once to count the keys and once to number all rows, however many keys are hot."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = skewed(spark).repartition(4).mapInPandas(watched, "id int, k string, v double, o int")
    numbered = number_rows(df, ["k"], ["o", "id"], "n", "total", hot_keys(df, ["k"], 100, 100))
    assert numbered.count() == 3000 and seen.value == 2 * 3000
    assert dict(numbered.dtypes)["n"] == "bigint"
    assert dict(number_rows(df, ["k"], ["id"], "n").dtypes)["n"] == "bigint"


def test_numbering_of_identical_copies(spark):
    """Copies have no order of their own; each still gets its own position."""
    df = spark.range(4000).select(F.lit("k").alias("k"), F.lit(1).alias("o"))
    numbered = number_rows(df, ["k"], ["o"], "n", "total", hot_keys(df, ["k"], 100, 100))
    found = numbered.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.max("total")).first()
    assert tuple(found) == (4000, 4000, 1, 4000, 4000)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_medians_of_hot_keys(spark, seed):
    df = skewed(spark, 2000 + seed, seed)
    plain = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    hot = hot_keys(df, ["k"], 100, 100)
    split = {r.k: r.m for r in exact_medians(df, ["k"], {"m": "v"}, hot).collect()}
    assert set(split) == set(plain)
    assert all(split[k] == pytest.approx(plain[k], abs=1e-12) for k in plain)


def test_median_of_a_key_without_values(spark):
    df = spark.range(300).select(F.lit("k").alias("k"), F.lit(None).cast("double").alias("v"))
    assert [tuple(r) for r in exact_medians(df, ["k"], {"m": "v"}, hot_keys(df, ["k"], 100, 100)).collect()] == [("k", None)]


def test_runs_with_hot_keys(spark):
    df = number_rows(skewed(spark), ["k"], ["id"], "i").withColumn("flag", F.col("o") < 12)
    plain = sorted(map(str, flagged_runs(df, ["k"], "i", "flag").collect()))
    hot = hot_keys(df, ["k"], 100, 100)
    assert sorted(map(str, flagged_runs(df, ["k"], "i", "flag", hot).collect())) == plain


def cycles(spark):
    """One (subject, trial) and one signal hold most rows."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.4
        channel = "C0" if hot and rng.random() < 0.8 else f"C{rng.randint(1, 4)}"
        trial = 0 if hot else rng.randint(1, 30)
        rows.append(("S", "R", channel, trial, i, i % 13, rng.random(), rng.random(), rng.random() < 0.8))
    base = spark.createDataFrame(rows, "subject_id string, region string, channel_label string, trial int, sample_last_trough long, sample_peak long, time_ptsym double, time_rdsym double, is_burst boolean")
    return base.withColumns({
        "channel_idx": F.lit(1), "period": F.lit(80.0), "extraction_id": F.lit("e"), "source_file": F.lit("f"), "run_id": F.lit("r"),
        "extracted_at": F.lit("2025-01-01").cast("timestamp_ntz"), "loaded_at": F.lit("2025-01-01").cast("timestamp_ntz"),
        "sample_next_trough": F.col("sample_last_trough") + 1,
        **{c: F.lit(0.5) for c in ("volt_amp", "band_amp", "amp_fraction", "amp_consistency", "period_consistency", "monotonicity")},
    })


def metadata(spark):
    """Trial 1 appears twice, trial 2 not at all."""
    rows = [("S", t, 1 + t % 3, True, "r") for t in range(31) if t != 2] + [("S", 1, 3, False, "r")]
    return spark.createDataFrame(rows, "subject_id string, trial int, load_condition int, correct boolean, run_id string")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_fact_with_hot_trials(spark):
    plain = build_fact(cycles(spark), metadata(spark), Settings(), known_rows=1500)
    split = build_fact(cycles(spark), metadata(spark), Settings(scale=TIGHT))
    assert rows_of(split) == rows_of(plain)
    assert plain.count() > 1500  # the repeated trial repeats its cycles
    assert plain.filter("load_condition IS NULL").count() == plain.filter("trial = 2").count() > 0


def test_cycle_positions_put_nulls_last(spark):
    df = spark.createDataFrame([("S", "R", "C", 1, None, 1), ("S", "R", "C", 1, 5, None), ("S", "R", "C", 1, 5, 2)],
                               "subject_id string, region string, channel_label string, trial int, sample_last_trough long, sample_peak long")
    found = number_rows(df, SIGNAL_KEYS, ["sample_last_trough", "sample_peak"], "i").orderBy("i").collect()
    assert [(r.sample_last_trough, r.sample_peak) for r in found] == [(5, 2), (5, None), (None, 1)]


def test_channel_marts_with_hot_groups(spark):
    fact = build_fact(cycles(spark), metadata(spark), Settings(), known_rows=1500)
    plain = Settings(analysis=Analysis(min_cycles=3))
    left = channel_load(fact, plain, 5000).orderBy("channel_label", "load_condition").collect()
    right = channel_load(fact, replace(plain, scale=TIGHT)).orderBy("channel_label", "load_condition").collect()
    assert len(left) == len(right) > 5
    for a, b in zip(left, right):
        for name in a.asDict():
            assert a[name] == (pytest.approx(b[name], abs=1e-12) if isinstance(b[name], float) else b[name]), name


def middle(values):
    own = sorted(values, key=lambda v: (math.isnan(v), v))
    return (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2


@pytest.mark.parametrize("bins", [64, 4096])
def test_medians_by_counting(spark, monkeypatch, bins):
    monkeypatch.setattr(skew, "SELECTION_BINS", bins)
    r, inf, nan = random.Random(bins), math.inf, math.nan
    cases = {
        "even": [r.random() for _ in range(400)], "odd": [r.gauss(0, 1e-3) for _ in range(401)], "ties": [0.5] * 300 + [0.25] * 300,
        "scales": [r.choice([-1, 1]) * 10.0 ** r.randint(-30, 30) for _ in range(200)], "huge": [-1.7e308, 1.7e308, 1e308, 3.0],
        "infinite": [-inf] * 3 + [inf] * 2 + [1.0, 2.0], "mostly infinite": [inf] * 5 + [1.0], "nan": [nan] * 3 + [1.0, 2.0, 3.0],
        "mostly nan": [nan] * 4 + [1.0], "one": [7.0], "zeros": [0.0, -0.0, 0.0], None: [1.0, 4.0, 4.5],
        "neighbours": [1.0, math.nextafter(1.0, 2)] * 50 + [math.nextafter(1.0, 2)],
    }
    frame = spark.createDataFrame([(k, v) for k, own in cases.items() for v in own], "k string, v double").repartition(5)
    hot = hot_keys(frame, ["k"], 0, 100)
    found = {x.k: x.m for x in exact_medians(frame, ["k"], {"m": "v"}, hot).collect()}
    assert set(found) == set(cases)
    for k, own in cases.items():
        assert found[k] == middle(own) or math.isnan(found[k]) and math.isnan(middle(own)), k


def test_medians_by_counting_need_no_window_and_no_sort_of_a_group(spark):
    frame = spark.createDataFrame([("hot", i / 7) for i in range(500)], "k string, v double")
    plan = exact_medians(frame, ["k"], {"m": "v"}, hot_keys(frame, ["k"], 50, 100))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan
