"""Shapes of physical plans that decide how the jobs scale."""

import gzip
import re
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from cyclemart.contract import LAKE_SCHEMA
from cyclemart.operators.recency import keep_latest, latest_extraction
from cyclemart.operators.resampling import SignFlipTest, sign_flip_sums
from cyclemart.operators.staging_area import materialise
from cyclemart.plans.fact import build_fact, signal_rollup, trial_dimension
from cyclemart.plans.marts import symmetry_histogram
from cyclemart.plans.quality import signal_checks
from cyclemart.settings import INITIAL_PARTITIONS, Settings, tune
from cyclemart.sources.features import scan_features
from cyclemart.sources.lake import lake_folders, loaded_rows, read_lake, read_matching, write_lake
from showcase import tables
from tests.fixtures import recording
from tests.test_skew import cycles, metadata

AT = datetime(2025, 6, 2)


def plan(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


def tree(df, capsys) -> str:
    return plan(df, capsys).split("\n\n\n")[0]


def test_fact_is_exchanged_and_sorted_once(spark, capsys):
    features, trials = materialise(cycles(spark), "f"), materialise(metadata(spark), "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shape = tree(build_fact(features, trials, Settings(), known_rows=0), capsys)
        rolled = tree(signal_rollup(build_fact(features, trials, Settings(), known_rows=0)), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"\bExchange\b", shape)) == 2  # features and trials
    assert len(re.findall(r"\bSort \(", shape)) == 2
    assert len(re.findall(r"\bExchange\b", rolled)) == 2  # the rollup adds none


def test_both_uniqueness_checks_share_one_exchange_of_the_fact(spark, capsys):
    fact = materialise(build_fact(cycles(spark), metadata(spark), Settings(), known_rows=0), "fact")
    shape = tree(signal_checks(fact, Settings(), largest_signal=0), capsys)
    assert len(re.findall(r"\bExchange\b", shape)) == len(re.findall(r"\bScan parquet\b", shape)) == 1
    assert "Join" not in shape


def lake_of(spark, tmp_path):
    for stamp in ("20250601_091500", "20250701_091500"):
        recording(tmp_path / "src", "P1", "HP", stamp)
        write_lake(scan_features(spark, str(tmp_path / "src"), "r", AT), str(tmp_path / "lake"), 1 << 29)
    return read_lake(spark, str(tmp_path / "lake"))


def test_superseded_extractions_are_pruned_and_columns_too(spark, tmp_path, capsys):
    lake = lake_of(spark, tmp_path)
    latest = materialise(latest_extraction(lake), "latest")
    current = keep_latest(lake, latest, 100)
    narrow = plan(current.select("subject_id", "time_ptsym").filter("trial > 2"), capsys)
    assert "dynamicpruning" in narrow and "BroadcastHashJoin" in narrow
    assert "ReadSchema: struct<trial:int,time_ptsym:double>" in narrow and "GreaterThan(trial,2)" in narrow
    assert current.count() == 72
    assert keep_latest(lake, latest, 0).count() == 72


def test_newest_extractions_come_from_folder_names(spark, tmp_path, capsys):
    """No file is opened to find them, and none of a superseded extraction to read them, whatever their number."""
    root = str(tmp_path / "lake")
    assert lake_folders(spark, root).count() == 0
    lake_of(spark, tmp_path)
    for old in (tmp_path / "lake").rglob("extraction_id=20250601_091500/*"):
        old.write_bytes(b"not a table") if old.suffix == ".parquet" else old.unlink()
    folders = lake_folders(spark, root)
    assert "ColumnarToRow" not in plan(latest_extraction(folders), capsys)  # a listing, no table
    latest = materialise(latest_extraction(folders), "latest")
    assert [(r.subject_id, r.region, r.extraction_id, str(r.extracted_at)) for r in latest.collect()] == [("P1", "HP", "20250701_091500", "2025-07-01 09:15:00")]
    current = read_matching(spark, root, folders, latest)
    assert current.schema == LAKE_SCHEMA and current.count() == 72
    assert all("extraction_id=20250701_091500" in f for f in current.inputFiles())
    assert read_matching(spark, root, folders, latest.filter("region = 'none'")).count() == 0


def test_loaded_rows_are_counted_in_the_folders_of_the_run(spark, tmp_path):
    lake_of(spark, tmp_path)
    for old in (tmp_path / "lake").rglob("extraction_id=20250601_091500/*.parquet"):
        old.write_bytes(b"not a table")
    root = str(tmp_path / "lake")
    files = spark.createDataFrame([("P1", "HP", "20250701_091500")], "subject_id string, region string, extraction_id string")
    found = loaded_rows(read_matching(spark, root, lake_folders(spark, root), files), "r").collect()
    assert [(r.source_file.split("_")[-2], r.row_count) for r in found] == [("20250701", 72)]


def test_latest_extraction_needs_no_window(spark, tmp_path, capsys):
    assert "Window" not in tree(latest_extraction(lake_of(spark, tmp_path)), capsys)


def test_skipped_files_do_not_reach_the_scan(spark, tmp_path):
    recording(tmp_path, "P1", "HP", "20250601_091500")
    recording(tmp_path, "P2", "HP", "20250601_091500")
    (tmp_path / "P1" / "P1_merged_bycycle_features_20250601_091500.csv").write_text("x\n" * 10)
    scanned = scan_features(spark, str(tmp_path), "r", AT, ["P1"])
    assert {f.split("/")[-1] for f in scanned.select("source_file").distinct().toPandas().source_file} == {"P1_HP_bycycle_features_20250601_091500.csv"}


def test_histogram_reads_the_fact_once_and_expands_nothing(spark, capsys):
    fact = materialise(build_fact(cycles(spark), metadata(spark), Settings(), known_rows=0), "fact")
    shape = tree(symmetry_histogram(fact), capsys)
    assert shape.count("Scan parquet") == 1
    assert len(re.findall(r"\bExchange\b", shape)) == 2


def test_sign_flips_combine_before_the_shuffle(spark, capsys):
    units = materialise(spark.range(0, 100, 1, 1).select(F.col("id").cast("string").alias("unit"), F.rand(1).alias("d")), "u")
    shape = tree(sign_flip_sums(units, [SignFlipTest("m", "t", "d", "d", "d")], "unit", 1000, 1), capsys)
    # One exchange deals out the few units before each becomes many draws, the other moves partial sums.
    assert len(re.findall(r"\bExchange\b", shape)) == 2 and len(re.findall(r"Aggregate", shape)) == 2 and "Join" not in shape
    above, _, below = shape.split("\n\n")[0].rpartition("Generate")
    assert "Aggregate" in above and "Exchange" in below and units.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism


def test_lake_keeps_partition_values_as_text(spark, tmp_path):
    recording(tmp_path / "src", "001", "HP", "20250601_091500")
    write_lake(scan_features(spark, str(tmp_path / "src"), "r", AT), str(tmp_path / "lake"), 1 << 29)
    lake = read_lake(spark, str(tmp_path / "lake"))
    assert lake.schema == LAKE_SCHEMA and lake.first().subject_id == "001"


def test_large_sources_become_several_files(spark, tmp_path):
    recording(tmp_path / "src", "P1", "HP", "20250601_091500", trials=40)
    small = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        write_lake(scan_features(spark, str(tmp_path / "src"), "r", AT), str(tmp_path / "lake"), 40_000)
    finally:
        for key in small:
            spark.conf.unset(key)
    assert len(list((tmp_path / "lake").rglob("*.parquet"))) > 1
    assert read_lake(spark, str(tmp_path / "lake")).count() == 40 * 3 * 4


def test_exchanges_start_small_whatever_the_sessions_partitions(spark):
    """The rows that a task sorts follow the advisory size, so the fact does not spill where a session has few partitions."""
    given = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(INITIAL_PARTITIONS)
        plan = build_fact(cycles(tune(spark)), metadata(spark), Settings(), known_rows=0)._jdf.queryExecution().executedPlan().toString()
        assert ", 200), REPARTITION_BY_COL" in plan and ", 8), REPARTITION_BY_COL" not in plan
        spark.conf.set(INITIAL_PARTITIONS, "12")
        assert tune(spark).conf.get(INITIAL_PARTITIONS) == "12"
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if given is None else spark.conf.set(INITIAL_PARTITIONS, given)


def test_large_trials_are_ruled_out_by_orders(spark, monkeypatch):
    """Above the limit of one task the fact is planned by its largest order, and its features are not counted by key first."""
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(tables, "SETTINGS", replace(tables.SETTINGS, scale=replace(tables.SETTINGS.scale, hot_group_rows=100)))
    largest = tables.features(spark, sf).groupBy("subject_id", "trial").count().agg(F.max("count")).first()[0]
    assert largest <= tables.trial_rows(spark, sf) <= 100 < tables.known_rows(spark, sf)


def packed(path):
    path.with_name(path.name + ".gz").write_bytes(gzip.compress(path.read_bytes()))
    path.unlink()
    return f"{path}.gz"


def stored_rows(spark, root):
    return sorted(map(str, read_lake(spark, root).select(*[c for c in LAKE_SCHEMA.names if c != "loaded_at"]).collect()))


def test_packed_files_are_loaded_as_they_are_read(spark, tmp_path, monkeypatch):
    """A file that Spark does not split lies in one task: its rows are not exchanged, and a partition is one file as before."""
    for subject in ("P1", "P2", "P3"):
        for stamp in ("20250601_091500", "20250701_091500"):
            packed(recording(tmp_path / "src", subject, "HP", stamp))
    scan = scan_features(spark, str(tmp_path / "src"), "r", AT)
    exchanged, by_file, again = (str(tmp_path / name) for name in ("exchanged", "by_file", "again"))
    write_lake(scan, exchanged, 1 << 29)
    monkeypatch.setattr(type(scan), "repartition", None)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    write_lake(scan, by_file, 1 << 29, by_file=True)
    write_lake(read_lake(spark, by_file).filter("subject_id <> 'P2'"), again, 1 << 29, by_file=True)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert stored_rows(spark, by_file) == stored_rows(spark, exchanged) and len(stored_rows(spark, again)) == 4 * 72
    assert len(list((tmp_path / "by_file").rglob("*.parquet"))) == 6 and len(list((tmp_path / "again").rglob("*.parquet"))) == 4


def test_names_of_listed_files_are_taken_apart_once_each(spark, tmp_path):
    good = [packed(recording(tmp_path / "a b%2+c", s, "HP", "20250601_091500")) for s in ("P1", "P_2")]
    odd = packed(recording(tmp_path / "a b%2+c", "P1", "merged", "20250601_091500"))
    root = str(tmp_path / "a b%2+c")
    named = scan_features(spark, root, "r", AT, files=[*good, odd])
    assert "RLIKE" not in named._jdf.queryExecution().executedPlan().toString().upper()
    columns = [c for c in named.columns if not c.startswith("_")]
    whole = scan_features(spark, root, "r", AT)
    assert named.schema.simpleString() == whole.schema.simpleString()
    assert sorted(map(str, named.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))
    assert named.count() == 2 * 72 and {r[0] for r in named.select("source_file").distinct().collect()} == set(good)
    assert scan_features(spark, root, "r", AT, subjects=["P1"], files=good).count() == 72
    assert scan_features(spark, root, "r", AT, files=[odd]).count() == 0


def test_signals_of_a_trial_meet_once(spark, capsys):
    rolled = materialise(signal_rollup(build_fact(cycles(spark), metadata(spark), Settings(), known_rows=0)), "rolled")
    assert len(re.findall(r"\bExchange\b", tree(trial_dimension(rolled), capsys))) == 1


def test_line_items_are_placed_once_to_tell_the_trials(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shape = tree(tables.trials(spark, "/root/testdata/sf0.001"), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Recorded: line items and suppliers by supplier, line items and orders by order. Unrecorded: orders, line items, and their customers.
    assert len(re.findall(r"\bExchange\b", shape)) == 8


def test_files_that_arrive_later_are_those_of_the_tree(spark):
    sf = "/root/testdata/sf0.001"

    def rows(root):
        return scan_features(spark, root, "r", AT, by_folder=True).drop("source_file", "_block", "_size")

    whole, later = rows(tables.feature_tree(spark, sf)), rows(tables.later_tree(spark, sf))
    third = F.substring("subject_id", 2, 9).cast("int") % 3
    wanted = whole.filter((third == 2) | ((third == 0) & (F.substring("extraction_id", 1, 4) == "1998")))
    assert sorted(map(str, later.collect())) == sorted(map(str, wanted.collect())) and 0 < later.count() < whole.count()
