"""Whole runs on contract files: results, reruns, re-extraction, gate, stream."""

import math
import os

import pytest
from pyspark.sql import functions as F

from cyclemart.plans.quality import QualityError
from cyclemart.plans.warehouse import ContractError, Warehouse
from cyclemart.settings import Analysis, Paths, Settings
from cyclemart.sources.extracts import missing_extracts, read_extract, read_manifest
from cyclemart.sources.ledger import latest_run_id, of_latest_run
from cyclemart.streaming.arrivals import watch
from tests.fixtures import HEADER, conditions, cycle_row, feature_file, recording, trial_file

STAMP, LATER = "20250601_091500", "20250701_091500"
ANALYSIS = Analysis(min_cycles=3, n_permutations=1000, n_bootstrap=200)


def warehouse(spark, root):
    paths = Paths(**{name: str(root / name) for name in ("source_root", "trial_metadata", "lake", "tables", "ledger", "exports")})
    return Warehouse(spark, Settings(paths=paths, analysis=ANALYSIS))


def sources(root, subjects=("P1", "P2"), shift=0.02):
    for subject in subjects:
        recording(root / "source_root", subject, "HP", STAMP, shift=shift)
        trial_file(root / "trial_metadata", subject, conditions())


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    sources(root)
    w = warehouse(spark, root)
    counts = w.run_all("run-1")
    return w, counts, root


def test_fact_and_marts(ran):
    w, _, _ = ran
    fact = w.table("fct_cycle")
    assert fact.count() == 2 * 6 * 3 * 4
    first = fact.filter("subject_id = 'P1' AND trial = 1 AND channel_idx = 2 AND cycle_idx = 4").first()
    assert (first.load_condition, first.cycles_in_signal, first.trial_correct, first.region) == (3, 4, True, "HP")
    assert first.period_s == 80 / 400 and first.cycle_freq_hz == 5.0 and first.time_ptsym == pytest.approx(0.547)
    pairs = w.table("channel_paired_asym").collect()
    assert len(pairs) == 6 and all(p.included and p.exclusion_reason is None for p in pairs)
    for p in pairs:
        expected = 0.02 + 0.002 * int(p.channel_label[-1])
        assert p.ptsym_diff == pytest.approx(expected) and p.rdsym_diff == pytest.approx(-expected)
    assert w.table("dim_channel").count() == 6 and w.table("dim_trial").count() == 12
    assert {(r.n_channels, r.n_channels_included, r.n_cycles) for r in w.table("subject_coverage").collect()} == {(3, 3, 72)}


def test_ledger_and_exports(ran, spark):
    w, counts, root = ran
    run = w.ledger.read("pipeline_run").first()
    assert (run.run_id, run.status) == ("run-1", "success") and run.finished_at >= run.started_at
    files = w.ledger.read("source_file").collect()
    assert {(f.status, f.row_count) for f in files} == {("loaded", 72)}
    tests = w.ledger.read("test_result")
    assert tests.count() == 6
    shift = tests.filter("metric = 'time_ptsym' AND test = 'paired_sign_flip'").first()
    assert shift.p_value < 0.1 and shift.p_value_adjusted >= shift.p_value and shift.n_units == 6
    assert counts["channel_paired_asym"] == 6 and counts["test_results"] == 6 and counts["dq_results"] == 13
    folder = str(root / "exports")
    assert missing_extracts(spark, folder).count() == 0
    exported = read_extract(spark, folder, "channel_paired_asym")
    assert exported.count() == 6 and {r[0] for r in exported.select("exported_for_run_id").collect()} == {"run-1"}
    assert read_extract(spark, folder, "run_health").first().status == "success"
    manifest = read_manifest(spark, folder).first()
    assert manifest.run_id == "run-1" and manifest.row_counts.channel_paired_asym == 6 and manifest.tables_path == "tables"


def test_lake_layout(ran, spark):
    w, _, root = ran
    folders = [p for p in (root / "lake").rglob("extraction_id=*")]
    assert len(folders) == 2 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    rows = spark.read.parquet(str(folders[0])).collect()
    keys = [(r.channel_label, r.trial, r.sample_last_trough) for r in rows]
    assert keys == sorted(keys)


def test_rerun_gives_the_same_tables(ran):
    w, _, _ = ran
    before = sorted(map(str, w.table("channel_paired_asym").collect()))
    w.run_all("run-1")
    assert sorted(map(str, w.table("channel_paired_asym").collect())) == before
    sizes = {name: w.ledger.read(name).count() for name in ("pipeline_run", "source_file", "dq_result", "test_result")}
    assert sizes == {"pipeline_run": 1, "source_file": 2, "dq_result": 13, "test_result": 6}
    assert w.lake().count() == 144


def test_later_extraction_supersedes(spark, tmp_path):
    sources(tmp_path)
    w = warehouse(spark, tmp_path)
    w.run_all("run-1")
    recording(tmp_path / "source_root", "P1", "HP", LATER, shift=0.05)
    w.run_all("run-2")
    assert w.lake().count() == 3 * 72 and w.table("fct_cycle").count() == 2 * 72
    diffs = {r.subject_id: r.ptsym_diff for r in w.table("channel_paired_asym").filter("channel_label = 'LHP0'").collect()}
    assert diffs["P1"] == pytest.approx(0.05) and diffs["P2"] == pytest.approx(0.02)
    runs = w.ledger.read("pipeline_run")
    assert latest_run_id(runs) == "run-2" and of_latest_run(w.ledger.read("test_result"), runs).count() == 6


def test_broken_files_stop_before_loading(spark, tmp_path):
    sources(tmp_path)
    feature_file(tmp_path / "source_root", "P9", "HP", STAMP, ["1,2"], "trial,channel_idx")
    w = warehouse(spark, tmp_path)
    with pytest.raises(ContractError, match="lacks"):
        w.run_all("run-1")
    assert w.ledger.read("pipeline_run").first().status == "failed" and w.lake().count() == 0


def test_gate_keeps_bad_marts_from_being_published(spark, tmp_path):
    sources(tmp_path)
    w = warehouse(spark, tmp_path)
    w.run_all("run-1")
    before = sorted(map(str, w.table("channel_paired_asym").collect()))
    rows = [cycle_row(t, 0, "LHP0", k, 7.5) for t in range(6) for k in range(4)]
    feature_file(tmp_path / "source_root", "P1", "HP", LATER, rows)
    with pytest.raises(QualityError, match="symmetry_within_bounds"):
        w.run_all("run-2")
    assert sorted(map(str, w.table("channel_paired_asym").collect())) == before
    failed = w.ledger.read("pipeline_run").filter("run_id = 'run-2'").first()
    assert failed.status == "failed" and "symmetry_within_bounds" in failed.message
    assert w.ledger.read("dq_result").filter("run_id = 'run-2'").count() == 13


def test_subject_filter_and_missing_trials(spark, tmp_path):
    sources(tmp_path, ("P1", "P2"))
    w = warehouse(spark, tmp_path)
    w.ledger.start_run("r", "test")
    w.ingest("r", ["P1"])
    assert {r[0] for r in w.lake().select("subject_id").distinct().collect()} == {"P1"}
    statuses = {r.status: r.reason for r in w.ledger.read("source_file").collect()}
    assert statuses["loaded"] is None and "was not asked for" in statuses["skipped"]
    with pytest.raises(FileNotFoundError):
        Warehouse(spark, Settings(paths=Paths(source_root="x", trial_metadata=str(tmp_path / "none"), tables=str(tmp_path / "t")))).load_trials("r")


def test_arrivals_as_a_stream(spark, tmp_path):
    w = warehouse(spark, tmp_path)
    checkpoint = str(tmp_path / "state")
    sources(tmp_path, ("P1",))
    watch(w, checkpoint).awaitTermination()
    sources(tmp_path, ("P2",))
    watch(w, checkpoint).awaitTermination()
    # conditions arrive without features: the gate blocks, the run is recorded
    for n in range(3, 9):
        trial_file(tmp_path / "trial_metadata", f"P{n}", conditions())
    recording(tmp_path / "source_root", "P3", "HP", STAMP)
    watch(w, checkpoint).awaitTermination()
    runs = [(r.run_id, r.status) for r in w.ledger.read("pipeline_run").orderBy("run_id").collect()]
    assert runs == [("arrival-000000", "success"), ("arrival-000001", "success"), ("arrival-000002", "failed")]
    assert w.table("channel_paired_asym").select("subject_id").distinct().count() == 2
    health = w.health().orderBy("run_id").collect()
    assert [h.files_loaded for h in health] == [1, 1, 1] and health[2].dq_errors > 0 and math.isclose(health[0].rows_loaded, 72)


def test_a_bad_file_does_not_cost_the_others(spark, tmp_path):
    """Reordered, narrow, header-only, zero-byte and merged files arrive with good ones, and one is repaired later."""
    root = tmp_path / "source_root"
    w = warehouse(spark, tmp_path)
    sources(tmp_path, ("P1", "P2"))
    names = HEADER.split(",")
    swapped = feature_file(root, "P7", "HP", STAMP, [cycle_row(0, 0, "A1", 0, 0.5)], ",".join([names[1], names[0], *names[2:]]))
    feature_file(root, "P8", "HP", STAMP, ["1,2"], "a,b")
    feature_file(root, "P9", "HP", STAMP, [])
    (root / "P1" / f"P1_merged_bycycle_features_{STAMP}.csv").write_text("x")
    feature_file(root, "P6", "HP", STAMP, []).write_text("")
    watch(w, str(tmp_path / "state"), no_fail=True).awaitTermination()
    assert {r.subject_id for r in w.lake().select("subject_id").distinct().collect()} == {"P1", "P2"}
    files = {r.source_path.split("/")[-1].split("_")[0] + "/" + r.status: r.reason for r in w.ledger.read("source_file").collect()}
    assert {"P1/loaded", "P2/loaded", "P7/skipped", "P8/skipped", "P9/skipped", "P6/skipped", "P1/skipped"} <= set(files)
    assert "another order" in files["P7/skipped"] and "lacks" in files["P8/skipped"] and "it has fewer" in files["P9/skipped"]
    swapped.unlink()
    recording(root, "P7", "HP", STAMP)
    recording(root, "P3", "HP", STAMP)
    watch(w, str(tmp_path / "state"), no_fail=True).awaitTermination()
    assert {r.subject_id for r in w.lake().select("subject_id").distinct().collect()} == {"P1", "P2", "P3", "P7"}


def test_staged_tables_go_and_a_failing_export_fails_the_run(spark, tmp_path):
    from cyclemart.operators.staging_area import materialise, staging

    with staging(spark) as folder:
        materialise(spark.range(3), "x")
        assert os.path.isdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    sources(tmp_path, ("P1", "P2"))
    w = warehouse(spark, tmp_path)
    w.export = lambda run_id: 1 / 0
    with pytest.raises(ZeroDivisionError):
        w.run_all("r", no_fail=True)
    assert [r.status for r in w.ledger.read("pipeline_run").collect()] == ["failed"]


def test_run_health_counts_second_boundaries(spark):
    from cyclemart.plans.marts import elapsed_seconds
    row = spark.createDataFrame([("2025-01-01 00:00:00.9", "2025-01-01 00:00:01.1")], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert row.select(elapsed_seconds(F.col("a"), F.col("b"))).first()[0] == 1
