"""Tables by subject: what a run touches, what it leaves, and what a failed one leaves noted."""

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cyclemart.operators.staging_area import delete
from cyclemart.plans.warehouse import BY_SUBJECT
from cyclemart.sources.features import scan_features
from cyclemart.sources.lake import write_lake
from cyclemart.sources.ledger import now
from cyclemart.sources.published import Published
from tests.fixtures import conditions, recording, trial_file
from tests.test_warehouse import LATER, STAMP, sources, warehouse


def lake_rows(spark, w, subjects, stamp, shift):
    for s in subjects:
        recording(w.root / "source_root", s, "HP", stamp, shift=shift)
    scan = scan_features(spark, str(w.root / "source_root"), "r", now())
    write_lake(scan.filter(F.col("subject_id").isin(subjects) & (F.col("extraction_id") == stamp)), w.settings.paths.lake, 1 << 30)


@pytest.fixture()
def built(spark, tmp_path):
    w = warehouse(spark, tmp_path)
    w.root = tmp_path
    sources(tmp_path, ("01", "02", "P=3"))
    lake_rows(spark, w, ["01", "02", "P=3"], STAMP, 0.02)
    w.load_trials("r")
    w.build_marts(w.build_core())
    w.publish_tables()
    return w


def rows(w, name):
    return sorted(map(str, w.table(name).drop("loaded_at").collect()))


def test_only_touched_subjects_are_read_and_written(spark, built):
    first = built.published.subjects()["versions"]
    assert set(first) == {"01", "02", "P=3"}
    lake_rows(spark, built, ["02"], LATER, 0.05)
    fact = built.build_core(["02"])
    files = fact.inputFiles()
    assert files and all("subject_id=02" in f for f in files)
    built.build_marts(fact)
    assert built._subjects["01"] == first["01"][0] != built._subjects["02"]
    for part in (built.lake().filter(F.col("subject_id").isin(["02", "x"])), built.table("fct_cycle")):
        scan = part._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*subject_id", scan), scan
    built.publish_tables()
    partial = {name: rows(built, name) for name in BY_SUBJECT}
    built.build_marts(built.build_core())
    built.publish_tables()
    assert partial == {name: rows(built, name) for name in BY_SUBJECT}
    assert built.table("channel_paired_asym").schema["subject_id"].dataType.simpleString() == "string"
    assert {r.subject_id for r in built.table("fct_cycle").select("subject_id").distinct().collect()} == {"01", "02", "P=3"}


def test_versions_two_publications_old_are_deleted(spark, built):
    root = built.published.root
    for _ in range(3):
        built.build_marts(built.build_core(["P=3"]))
        built.publish_tables()
    versions = [d for d in os.listdir(f"{root}/fct_cycle") if os.path.isdir(f"{root}/fct_cycle/{d}/subject_id=P%3D3")]
    assert len(versions) == 2 and len(rows(built, "fct_cycle")) == 3 * 72
    assert sum(os.path.isdir(f"{root}/fct_cycle/{d}/subject_id=01") for d in os.listdir(f"{root}/fct_cycle")) == 1


def test_a_subject_that_left_the_lake_leaves_the_tables(spark, built):
    delete(spark, f"{built.settings.paths.lake}/subject_id=01")
    built.build_marts(built.build_core(["01", "02"]))
    built.publish_tables()
    assert set(built.published.subjects()["versions"]) == {"02", "P=3"}


def test_what_must_be_rebuilt(spark, built, tmp_path):
    known = built.table("trial_metadata")
    assert built._touched(None, known, known) is None
    assert built._touched(["01"], known, None) is None
    assert built._touched(["01"], known, known) == ["01"]
    trial_file(tmp_path / "trial_metadata", "02", [(t, 1, "False") for t in range(6)])
    assert built._touched(["01"], built.load_trials("again"), known) == ["01", "02"]
    trial_file(tmp_path / "trial_metadata", "02", conditions())
    built.published.note_changes(["P=3"])  # a run loaded it and did not get further
    assert built._touched([], known, known) == ["P=3"]
    built.settings = replace(built.settings, analysis=replace(built.settings.analysis, min_cycles=4))
    assert built._touched(["01"], known, known) is None


def test_a_note_of_all_stays_until_published(spark, tmp_path):
    published = Published(spark, str(tmp_path / "tables"))
    published.note_changes(["a"])
    assert published.subjects()["changed"] is None  # nothing was ever built
    published.publish({}, {"versions": {"a": "v1"}, "settings": "s", "changed": []}, ["t"])
    published.note_changes(["b"])
    published.note_changes(["a", "b"])
    assert published.subjects() == {"versions": {"a": ["v1"]}, "settings": "s", "changed": ["a", "b"]}
    published.note_changes(None)
    published.note_changes(["c"])
    assert published.subjects()["changed"] is None
    published.publish({"t": "v2"})
    assert published.versions() == {"t": ["v2"]} and published.subjects()["versions"] == {"a": ["v1"]}


def test_changed_trials_are_found_in_one_exchange(spark, built):
    """A row that one side has more often than the other counts as changed; rows with NULL compare like others."""
    kinds = "subject_id string, trial int, load_condition int, correct boolean, run_id string"
    old = spark.createDataFrame([("a", 1, 1, None, "r"), ("b", 1, 1, True, "r"), ("b", 1, 1, True, "r"), ("c", 1, 1, True, "r"), (None, 1, 1, True, "r")], kinds)
    new = spark.createDataFrame([("a", 1, 1, None, "s"), ("b", 1, 1, True, "s"), ("c", 1, 1, None, "s"), ("d", 1, 1, True, "s")], kinds)
    seen = []
    collect = type(old).collect
    try:
        type(old).collect = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df)
        found = built._touched([], new, old)
    finally:
        type(old).collect = collect
    assert found == ["b", "c", "d"] and "exceptAll" not in seen[0] and seen[0].count("Union") == 1
