"""Names, listing, contract check, typed scan."""

import gzip
import math
import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.contract import NULL_TOKENS, SOURCE_COLUMNS
from cyclemart.functions import cells, naming
from cyclemart.sources import files
from cyclemart.sources.extracts import read_extract_in_order
from cyclemart.sources.features import scan_features
from showcase import tables
from tests.fixtures import HEADER, cycle_row, feature_file, recording

AT = datetime(2025, 6, 2)
STAMP = "20250601_091500"


def identity(spark, name):
    row = spark.createDataFrame([(name,)], "name string")
    columns = naming.file_identity(F.col("name"))
    return row.select(*[c.alias(k) for k, c in columns.items()]).first()


def test_name_gives_subject_region_and_time(spark):
    found = identity(spark, f"P60cs_HP_bycycle_features_{STAMP}.csv")
    assert (found.subject_id, found.region, found.extraction_id) == ("P60cs", "HP", STAMP)
    assert found.extracted_at == datetime(2025, 6, 1, 9, 15)


def test_subject_may_hold_underscores(spark):
    assert identity(spark, f"P_60_cs_SMA_bycycle_features_{STAMP}.csv").subject_id == "P_60_cs"


def test_name_format_inverts_parse(spark):
    row = spark.createDataFrame([("P_1", "HP", datetime(2025, 6, 1, 9, 15))], "s string, r string, at timestamp_ntz")
    assert row.select(naming.feature_file_name(F.col("s"), F.col("r"), F.col("at"))).first()[0] == f"P_1_HP_bycycle_features_{STAMP}.csv"


@pytest.mark.parametrize("relative, reason", [
    (f"P60cs/HP/P60cs_HP_bycycle_features_{STAMP}.csv", None),
    (f"P60cs/P60cs_merged_bycycle_features_{STAMP}.csv", "merged session file"),
    ("P/R/SubjectID1_BrainRegion2_bycycle_features_YYYYMMDD_#####_sample.csv", "unknown file name"),
    ("sub01/HPC/sub01_HPC_bycycle_merged.csv", "merged"),
    (f"P60cs/A/P60cs_HP_bycycle_features_{STAMP}.csv", "region HP in the folder of A"),
    (f"X/HP/P60cs_HP_bycycle_features_{STAMP}.csv", "subject P60cs in the folder of X"),
    (f"P60cs_HP_bycycle_features_{STAMP}.csv", "not in a region folder"),
    ("P60cs/HP/P60cs_HP_bycycle_features_20251399_999999.csv", "no such moment"),
    ("P/HP/P_HP_bycycle_features_20240229_000000.csv", None),
    ("P/HP/P_HP_bycycle_features_20230229_000000.csv", "no such moment"),
    ("P/HP/P_HP_bycycle_features_20000229_235959.csv", None),
    ("P/HP/P_HP_bycycle_features_21000229_000000.csv", "no such moment"),
    ("P/HP/P_HP_bycycle_features_20250431_000000.csv", "no such moment"),
    ("P/HP/P_HP_bycycle_features_20250601_240000.csv", "no such moment"),
    (f"P/merged/P_merged_bycycle_features_{STAMP}.csv", "merged session file"),
    (f"P_1/HP/P_1_HP_bycycle_features_{STAMP}.csv", None),
    (f"P/HP/more/P_HP_bycycle_features_{STAMP}.csv", "not in a region folder"),
])
def test_skip_reasons(spark, relative, reason):
    row = spark.createDataFrame([(relative,)], "p string")
    found, loadable = row.select(
        naming.skip_reason(files.base_name(F.col("p")), F.col("p")), naming.is_loadable(F.concat(F.lit("/a.b/"), F.col("p")), "/a.b")
    ).first()
    assert loadable == (reason is None)
    assert found is None if reason is None else reason in found


def test_discovery_lists_skips_and_filters(spark, tmp_path):
    recording(tmp_path, "P1", "HP", STAMP)
    recording(tmp_path, "P2", "HP", STAMP)
    (tmp_path / "P1" / f"P1_merged_bycycle_features_{STAMP}.csv").write_text("x")
    found = {r.source_path.split("/")[-1]: r for r in files.discover(spark, str(tmp_path), ["P1"]).collect()}
    assert found[f"P1_HP_bycycle_features_{STAMP}.csv"].status == "discovered"
    assert "was not asked for" in found[f"P2_HP_bycycle_features_{STAMP}.csv"].reason
    assert "merged" in found[f"P1_merged_bycycle_features_{STAMP}.csv"].reason
    summary = files.discovery_summary(files.discover(spark, str(tmp_path))).first()
    assert (summary.discovered, summary.skipped, summary.subjects, summary.partitions) == (2, 1, 2, 2)


def test_missing_root_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path / "absent")).count()


def test_roots_named_twice_list_files_once(spark, tmp_path):
    recording(tmp_path, "P1", "HP", STAMP)
    assert files.list_files(spark, [str(tmp_path), str(tmp_path / "P1")]).count() == 1


CASES = {
    "good": (HEADER, [cycle_row(0, 0, "L", 0, 0.5)], set()),
    "two": ("trial,channel_idx", ["1,2"], {"lacks"}),
    "extra": (HEADER + ",more", [cycle_row(0, 0, "L", 0, 0.5) + ",1"], {"has besides the agreed columns more"}),
    "swapped": (",".join(["channel_idx", "trial", *list(SOURCE_COLUMNS)[2:]]), [cycle_row(0, 0, "L", 0, 0.5)], {"another order"}),
    "bare": (HEADER, [], {"1 rows are the least"}),
}


@pytest.mark.parametrize("by_scan", [False, True])
def test_contract_problems(spark, tmp_path, by_scan):
    for subject, (header, rows, _) in CASES.items():
        feature_file(tmp_path, subject, "HP", STAMP, rows, header)
    empty = tmp_path / "none" / "HP"
    empty.mkdir(parents=True)
    (empty / f"none_HP_bycycle_features_{STAMP}.csv").write_bytes(b"")
    listed = files.discover(spark, str(tmp_path)).filter("status = 'discovered'")
    heads = files.file_heads_by_scan(listed, spark, str(tmp_path)) if by_scan else files.file_heads(listed, 1)
    problems = {}
    for row in files.contract_problems(heads, 1).collect():
        problems.setdefault(row.source_path.split("/")[-1].split("_")[0], []).append(row.problem)
    for subject, (_, _, wanted) in CASES.items():
        found = problems.get(subject, [])
        assert len(found) == len(wanted) and all(any(w in f for f in found) for w in wanted), (subject, found)
    assert len(problems["none"]) == 1 and "there is nothing in it" in problems["none"][0]


def test_every_null_spelling_reads_as_null(spark, tmp_path):
    rows = [cycle_row(i, 0, "L", 0, 0.5, amp_consistency=token) for i, token in enumerate(NULL_TOKENS)]
    feature_file(tmp_path, "P1", "HP", STAMP, rows)
    read = scan_features(spark, str(tmp_path), "run", AT)
    assert read.filter("amp_consistency IS NULL").count() == len(NULL_TOKENS)
    first = read.orderBy("trial").first()
    assert (first.trial, first.is_burst, first.period, first.subject_id, first.region) == (0, True, 80.0, "P1", "HP")
    assert first.extracted_at == datetime(2025, 6, 1, 9, 15) and first.source_file.endswith(".csv")


@pytest.mark.parametrize("cells_", [{"period": "fast"}, {"sample_peak": "1.5x"}, {"is_burst": "maybe"}])
def test_bad_cells_fail_the_load(spark, tmp_path, cells_):
    feature_file(tmp_path, "P1", "HP", STAMP, [cycle_row(0, 0, "L", 0, 0.5, **cells_)])
    with pytest.raises(PySparkException):
        scan_features(spark, str(tmp_path), "run", AT).collect()


def test_rows_with_missing_cells_fail_the_load(spark, tmp_path):
    feature_file(tmp_path, "P1", "HP", STAMP, ["1,2,3"])
    with pytest.raises(Exception, match="Malformed"):
        scan_features(spark, str(tmp_path), "run", AT).collect()


def test_skipped_files_are_never_opened(spark, tmp_path):
    recording(tmp_path, "P1", "HP", STAMP)
    (tmp_path / "P1" / f"P1_merged_bycycle_features_{STAMP}.csv").write_text("not,the\ncontract\n")
    read = scan_features(spark, str(tmp_path), "run", AT)
    assert read.count() == 72
    assert read.agg(F.sum("period")).first()[0] == 72 * 80.0


def test_lenient_and_rendered_cells(spark):
    texts = spark.createDataFrame([(" 1.5 ",), ("NaN",), ("",), ("x",), (None,), ("True",), ("t",), ("0",)], "c string")
    values = [(r[0], r[1]) for r in texts.select(cells.lenient_double(F.col("c")), cells.lenient_boolean(F.col("c"))).collect()]
    assert values == [(1.5, False), (None, False), (None, False), (None, False), (None, False), (None, True), (None, True), (0.0, False)]
    row = spark.createDataFrame([(0.1234567, float("nan"), 12, None, True)], "a double, b double, s long, n double, f boolean")
    shown = row.select(
        cells.render_cell("period", F.col("a")), cells.render_cell("period", F.col("b")), cells.render_cell("sample_peak", F.col("s")),
        cells.render_cell("period", F.col("n")), cells.render_cell("is_burst", F.col("f")),
    ).first()
    assert tuple(shown) == ("0.123457", "", "12", "", "True")


def test_six_digits_are_those_of_the_exact_value(spark):
    r = random.Random(3)
    values = [k / 128 for k in range(-260, 260)] + [(2 * k + 1) / 2e6 for k in range(2000)] + [0.0, -0.0, -1e-9, 0.9999995, 2.0**52 + 0.5, 9.2e18]
    values += [math.nextafter((k + 0.5) * 1e-6, way) for k in range(1500) for way in (0, 1)]
    values += [r.uniform(-1, 1) * 10.0 ** r.randint(-9, 18) for _ in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [x.t for x in frame.select(cells.render_cell("period", F.col("v")).alias("t")).collect()] == [f"{v:.6f}" for v in values]


def test_rendering_a_cell_is_a_small_expression(spark):
    frame = spark.range(1).select((F.col("id") * 0.1).alias("v")).repartition(1)
    plan = frame.select(cells.render_cell("period", F.col("v")).alias("t"))._jdf.queryExecution().optimizedPlan()
    assert len(plan.expressions().apply(0).numberedTreeString().splitlines()) < 130


def test_positions_of_extract_rows(spark, tmp_path):
    """Several part files, each cut into several stretches that tasks read in any order."""
    rows = spark.range(3000).select(F.col("id").alias("metric"), F.repeat(F.lit("x"), F.pmod(F.col("id") * 7, F.lit(40)).cast("int")).alias("test"))
    rows.repartitionByRange(5, "metric").sortWithinPartitions("metric").write.option("header", "true").csv(str(tmp_path / "many"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "part-00000-a.csv").write_text("metric,test\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = read_extract_in_order(spark, str(tmp_path), "many").collect()
        assert read_extract_in_order(spark, str(tmp_path), "none").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.position for r in found) == list(range(1, 3001))
    assert all(r.position == int(r.metric) + 1 for r in found)


def test_packed_files_are_feature_files(spark, tmp_path):
    """A file in gzip is listed, checked by its head, scanned, and copied as it is."""
    plain = recording(tmp_path / "plain", "P1", "HP", STAMP)
    packed = tmp_path / "src" / "P1" / "HP" / (plain.name + ".gz")
    packed.parent.mkdir(parents=True)
    packed.write_bytes(gzip.compress(plain.read_bytes()))
    root = str(tmp_path / "src")
    found = files.discover(spark, root).collect()
    assert [(f.status, f.subject_id, f.extraction_id) for f in found] == [("discovered", "P1", STAMP)]
    listed = files.list_files(spark, root).select(F.col("path").alias("source_path"))
    for heads in (files.file_heads(listed, 1), files.file_heads_by_scan(listed, spark, root)):
        assert files.contract_problems(heads, 1).count() == 0 and heads.first().data_lines >= 1
    rows = [scan_features(spark, str(tmp_path / d), "r", AT).drop("source_file", "_block", "_size").collect() for d in ("plain", "src")]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1])) and rows[0]
    files.copy_file(str(packed), str(tmp_path / "copy" / packed.name))
    assert (tmp_path / "copy" / packed.name).read_bytes() == packed.read_bytes()


def test_tree_is_exchanged_before_it_is_spelled_out(spark):
    """The exchange carries the columns of the tables, not the 27 cells of the contract."""
    plan = tables._tree_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    assert "volt_amp" in above and "volt_amp" not in below and "time_ptsym" not in below


def test_contract_files_are_copied_by_tasks(spark, tmp_path):
    """Every wanted file of a tree once, packed as it was, under its contract name."""
    for subject, year in (("S1", 1997), ("S2", 1998), ("S3", 1997)):
        folder = tmp_path / "tree" / f"subject_id={subject}" / "region=O" / f"extraction_id={year}0101_000000"
        folder.mkdir(parents=True)
        (folder / "part-0.csv.gz").write_bytes(gzip.compress(f"{subject}{year}".encode()))
    tables.contract_files(spark, str(tmp_path / "tree"), str(tmp_path / "src"), lambda year, third: third > 0 and year == 1997)
    placed = {str(p.relative_to(tmp_path / "src")): gzip.decompress(p.read_bytes()) for p in (tmp_path / "src").rglob("*.gz")}
    assert placed == {"S1/O/S1_O_bycycle_features_19970101_000000.csv.gz": b"S11997"}


def test_identity_by_folder_is_known_for_a_file_not_told_for_a_row(spark, tmp_path):
    """The keys are partition columns: no pattern is matched on rows, and files of other subjects are not scanned."""
    for subject, stamp in (("007", STAMP), ("S2", STAMP), ("S2", "20240102_030405")):
        made = recording(tmp_path / "made", subject, "HP", stamp)
        folder = tmp_path / "tree" / f"subject_id={subject}" / "region=HP" / f"extraction_id={stamp}"
        folder.mkdir(parents=True)
        (folder / "part-0.csv").write_bytes(made.read_bytes())
    root = str(tmp_path / "tree")
    scanned = scan_features(spark, root, "r", AT, by_folder=True)
    plan = scanned.filter("subject_id = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "rlike" not in plan.lower() and "PartitionFilters: [isnotnull(subject_id" in plan
    keys = {(r.subject_id, r.region, r.extraction_id, str(r.extracted_at)) for r in scanned.collect()}
    named = scan_features(spark, str(tmp_path / "made"), "r", AT)
    assert keys == {(r.subject_id, r.region, r.extraction_id, str(r.extracted_at)) for r in named.collect()} and len(keys) == 3


def test_a_cell_is_parsed_once(spark):
    """NULL spellings are not parsed, other cells once; a NaN in no NULL spelling stays, anything else bad fails."""
    texts = spark.createDataFrame([("1.5",), ("",), ("NA",), ("nan",), ("null",), (None,), ("nAN",)], "c string").repartition(1)
    typed = texts.select(cells.strict_cell(F.col("c"), T.DoubleType()).alias("v"))
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("try_cast(") == 1
    assert [str(r.v) for r in typed.collect()] == ["1.5", "None", "None", "None", "None", "None", "nan"]
