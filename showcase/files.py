"""Source files, lake, ledger and extracts."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.contract import SOURCE_COLUMNS
from cyclemart.functions import cells, naming
from cyclemart.operators.recency import latest_extraction
from cyclemart.operators.skew import hot_keys
from cyclemart.operators.staging_area import new_location
from cyclemart.plans import marts
from cyclemart.plans.analysis import run_analysis
from cyclemart.plans.quality import blocking, run_checks
from cyclemart.plans.warehouse import ContractError, Warehouse
from cyclemart.settings import Paths, Settings
from cyclemart.sources import extracts, files
from cyclemart.sources.features import scan_features
from cyclemart.sources.lake import lake_folders, loaded_rows, read_lake, read_matching, write_lake
from cyclemart.sources.ledger import Ledger, stack
from cyclemart.sources.trials import normalise_trial_info, reload_trials
from cyclemart.streaming.arrivals import watch
from showcase import tables as t
from showcase.core import PAIRED_ROUNDED
from showcase.registry import query, rounded
from showcase.sql import with_ctes

AT = datetime(2025, 6, 1, 9, 15)
SUBJECTS = [f"S{i}" for i in range(20)]
SCALE = t.SETTINGS.scale


def _classified(spark, sf) -> DataFrame:
    return files.classify_files(t.source_paths(spark, sf), "/src", SUBJECTS)


@query("file_classification", with_ctes("""
SELECT source_path, CASE WHEN reason IS NULL THEN subject END AS subject_id, CASE WHEN reason IS NULL THEN reg END AS region,
  CASE WHEN reason IS NULL THEN stamp END AS extraction_id,
  CASE WHEN reason IS NULL THEN try_strptime(stamp, '%Y%m%d_%H%M%S') END AS extracted_at,
  CASE WHEN reason IS NULL THEN length(source_path) END AS size_bytes,
  CASE WHEN reason IS NULL THEN 'discovered' ELSE 'skipped' END AS status, reason FROM classified""", "classified"))
def file_classification(spark, sf):
    """Identity or skip reason of a path per subject, region and month."""
    return _classified(spark, sf)


@query("discovery_summary", with_ctes("""
SELECT count(*) FILTER (WHERE reason IS NULL) AS discovered, count(*) FILTER (WHERE reason IS NOT NULL) AS skipped,
  count(DISTINCT CASE WHEN reason IS NULL THEN subject END) AS subjects,
  count(DISTINCT CASE WHEN reason IS NULL THEN subject || '/' || reg END) AS partitions FROM classified""", "classified"))
def discovery_summary(spark, sf):
    return files.discovery_summary(_classified(spark, sf))


@query("feature_file_names", with_ctes("""
SELECT DISTINCT subject_id || '_' || region || '_bycycle_features_' || strftime(extracted_at, '%Y%m%d_%H%M%S') || '.csv' AS name FROM feat""", "feat"))
def feature_file_names(spark, sf):
    name = naming.feature_file_name(F.col("subject_id"), F.col("region"), F.col("extracted_at"))
    return t.features(spark, sf).select(name.alias("name")).distinct()


@query("file_listing", with_ctes("SELECT DISTINCT subject_id, region, extraction_id FROM tree", "tree"))
def file_listing(spark, sf):
    listed = files.list_files(spark, t.feature_tree(spark, sf))
    identity = naming.partition_identity(F.col("path"))
    return listed.select(*[identity[k].alias(k) for k in ("subject_id", "region", "extraction_id")]).distinct()


@query("multi_root_listing", with_ctes("""
SELECT count(DISTINCT subject_id || region || extraction_id) AS partitions, CAST(0 AS BIGINT) AS repeated FROM tree""", "tree"))
def multi_root_listing(spark, sf):
    """A root named twice lists each file once."""
    root = t.feature_tree(spark, sf)
    listed = files.list_files(spark, [root, f"{root}/subject_id=S1", root])
    identity = naming.partition_identity(F.col("path"))
    key = F.concat(identity["subject_id"], identity["region"], identity["extraction_id"])
    return listed.agg(
        F.countDistinct(key).alias("partitions"), (F.count("*") - F.countDistinct("path")).alias("repeated")
    )


CONTRACT = """
SELECT DISTINCT subject_id, region, extraction_id, problem FROM (
  SELECT subject_id, region, extraction_id, unnest(CASE CAST(substr(subject_id, 2) AS INTEGER) % 3
    WHEN 1 THEN ['columns are in another order than agreed']
    WHEN 2 THEN ['lacks is_burst', 'has besides the agreed columns burst'] ELSE [] END) AS problem FROM tree) AS p"""


def _problems(heads: DataFrame) -> DataFrame:
    identity = naming.partition_identity(F.col("source_path"))
    return files.contract_problems(heads, 1).select(
        *[identity[k].alias(k) for k in ("subject_id", "region", "extraction_id")],
        F.regexp_replace("problem", "^[^:]*: ", "").alias("problem"),
    ).distinct()


@query("contract_problems", with_ctes(CONTRACT, "tree"))
def contract_problems(spark, sf):
    listed = files.list_files(spark, t.flawed_tree(spark, sf)).select(F.col("path").alias("source_path"))
    return _problems(files.file_heads(listed, 1))


@query("contract_problems_by_scan", with_ctes(CONTRACT, "tree"))
def contract_problems_by_scan(spark, sf):
    root = t.flawed_tree(spark, sf)
    listed = files.list_files(spark, root).select(F.col("path").alias("source_path"))
    return _problems(files.file_heads_by_scan(listed, spark, root))


def _six(name: str) -> str:
    return f"CAST(printf('%.6f', {name}) AS DOUBLE) AS {name}"


DOUBLES = [c for c, kind in SOURCE_COLUMNS.items() if kind.simpleString() == "double"]
OTHERS = [c for c in SOURCE_COLUMNS if c not in DOUBLES]


def _scan(spark, sf) -> DataFrame:
    return scan_features(spark, t.feature_tree(spark, sf), "run", AT, by_folder=True)


@query("typed_csv_scan", with_ctes(f"""
SELECT {', '.join(OTHERS)}, {', '.join(_six(c) for c in DOUBLES)}, subject_id, region, extraction_id,
  strptime(extraction_id, '%Y%m%d_%H%M%S') AS extracted_at, 'run' AS run_id, TIMESTAMP '2025-06-01 09:15:00' AS loaded_at FROM tree""", "tree"))
def typed_csv_scan(spark, sf):
    """All line items back from CSV with strict types, NULL spellings and lineage."""
    return _scan(spark, sf).drop("source_file", "_block", "_size")


@query("rendered_cells", with_ctes("""
SELECT trial, sample_last_trough AS landmark, sample_peak AS peak, coalesce(printf('%.6f', amp_consistency), '') AS amp_consistency,
  printf('%.6f', time_rdsym) AS time_rdsym, coalesce(printf('%.6f', amp_consistency / 7e0), '') AS seventh, printf('%.6f', volt_amp * 1e-7) AS ten_millionth, CAST(sample_peak AS VARCHAR) AS sample_peak,
  CASE WHEN is_burst THEN 'True' ELSE 'False' END AS is_burst FROM feat""", "feat"))
def rendered_cells(spark, sf):
    shown = ("amp_consistency", "time_rdsym", "sample_peak", "is_burst")
    return t.features(spark, sf).select(
        "trial", F.col("sample_last_trough").alias("landmark"), F.col("sample_peak").alias("peak"),
        *[cells.render_cell(c, F.col(c)).alias(c) for c in shown],
        cells.render_cell("period", F.col("amp_consistency") / 7).alias("seventh"),
        cells.render_cell("period", F.col("volt_amp") * 1e-7).alias("ten_millionth"),
    )


def _lake(spark, sf) -> str:
    """The lake after a full load and a second load of a third of the subjects."""
    def build() -> str:
        root = new_location(spark, "lake")
        write_lake(_scan(spark, sf), root, SCALE.lake_file_bytes, by_file=True)
        again = _scan(spark, sf).filter(F.substring("subject_id", 2, 9).cast("int") % 3 == 0)
        write_lake(again.withColumn("run_id", F.lit("rerun")), root, SCALE.lake_file_bytes, by_file=True)
        return root

    return t.once(spark, sf, "lake", build)


BY_PARTITION = """
SELECT subject_id, region, extraction_id, {run} AS run_id, count(*) AS n_rows, count(amp_consistency) AS n_consistent,
  CAST(sum(sample_last_trough) AS BIGINT) AS landmarks, min(trial) AS first_trial, max(trial) AS last_trial
FROM tree GROUP BY 1, 2, 3, 4"""
RERUN = "CASE WHEN CAST(substr(subject_id, 2) AS INTEGER) % 3 = 0 THEN 'rerun' ELSE 'run' END"


def _by_partition(lake: DataFrame) -> DataFrame:
    return lake.groupBy("subject_id", "region", "extraction_id", "run_id").agg(
        F.count("*").alias("n_rows"), F.count("amp_consistency").alias("n_consistent"),
        F.sum("sample_last_trough").alias("landmarks"), F.min("trial").alias("first_trial"), F.max("trial").alias("last_trial"),
    )


@query("lake_partition_replace", with_ctes(BY_PARTITION.format(run=RERUN), "tree"))
def lake_partition_replace(spark, sf):
    """Loading some partitions again replaces them and leaves the others."""
    return _by_partition(read_lake(spark, _lake(spark, sf)))


@query("lake_scan", with_ctes(f"""
SELECT {', '.join(OTHERS)}, {', '.join(_six(c) for c in DOUBLES)}, subject_id, region, extraction_id FROM tree""", "tree"))
def lake_scan(spark, sf):
    return read_lake(spark, _lake(spark, sf)).select(*OTHERS, *DOUBLES, "subject_id", "region", "extraction_id")


@query("loaded_row_counts", with_ctes(f"""
SELECT subject_id, region, extraction_id, count(*) AS row_count FROM tree WHERE {RERUN} = 'rerun' GROUP BY 1, 2, 3""", "tree"))
def loaded_row_counts(spark, sf):
    counted = loaded_rows(read_lake(spark, _lake(spark, sf)), "rerun")
    identity = naming.partition_identity(F.col("source_file"))
    keys = [identity[k].alias(k) for k in ("subject_id", "region", "extraction_id")]
    return counted.groupBy(*keys).agg(F.sum("row_count").alias("row_count"))


@query("newest_partitions", with_ctes("""
SELECT subject_id, region, extraction_id, strptime(extraction_id, '%Y%m%d_%H%M%S') AS extracted_at, count(*) AS n_rows,
  CAST(sum(sample_last_trough) AS BIGINT) AS landmarks
FROM tree AS t WHERE NOT EXISTS (
  SELECT * FROM (SELECT DISTINCT subject_id, region, extraction_id FROM tree) AS later
  WHERE later.subject_id = t.subject_id AND later.region = t.region AND later.extraction_id > t.extraction_id)
GROUP BY ALL""", "tree"))
def newest_partitions(spark, sf):
    """Newest extractions by the lake's folder names, and what a scan of only their folders finds."""
    folders = lake_folders(spark, _lake(spark, sf))
    current = read_matching(spark, _lake(spark, sf), folders, latest_extraction(folders))
    return current.groupBy("subject_id", "region", "extraction_id", "extracted_at").agg(
        F.count("*").alias("n_rows"), F.sum("sample_last_trough").alias("landmarks")
    )


@query("incremental_lake", with_ctes(BY_PARTITION.format(run="'stream'"), "tree"))
def incremental_lake(spark, sf):
    """The same files taken as a stream in micro-batches, each replacing its partitions."""
    root, checkpoint = new_location(spark, "stream-lake"), new_location(spark, "stream-state")
    source = t.feature_tree(spark, sf)
    features = scan_features(spark, source, "stream", AT, by_folder=True, files_per_batch=150)
    stream = (
        features.writeStream.foreachBatch(lambda batch, _: write_lake(batch, root, SCALE.lake_file_bytes))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return _by_partition(read_lake(spark, root))


@query("trial_metadata_reload", with_ctes("SELECT * FROM trial_metadata", "trial_metadata"))
def trial_metadata_reload(spark, sf):
    """Trial metadata written as CSV, scanned strictly and loaded twice: the table is replaced."""
    def build() -> str:
        root = new_location(spark, "trial-csv")
        rows = t.trials(spark, sf).select("subject_id", "trial", "load_condition", F.initcap(F.col("correct").cast("string")).alias("correct"))
        # Three layouts: as listed, in another order, and with a column nobody asked for.
        layouts = (rows, rows.select("correct", "load_condition", "trial", "subject_id"), rows.withColumn("note", F.lit("x, y")).select("note", *rows.columns))
        for k, layout in enumerate(layouts):
            part = layout.filter(F.pmod(F.xxhash64("subject_id", "trial"), F.lit(3)) == k)
            part.write.option("header", "true").mode("append").csv(root)
        return root

    root, table = t.once(spark, sf, "trial-csv", build), new_location(spark, "trial-table")
    reload_trials(spark, root, "earlier", table, "*.csv")
    return reload_trials(spark, root, "run", table, "*.csv")


@query("trial_info_normalised", """
SELECT CAST(c_nationkey AS VARCHAR) AS subject_id,
  CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) - 1 AS INTEGER) AS trial,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS load_condition, o_orderstatus = 'F' AS correct
FROM orders JOIN customer ON o_custkey = c_custkey""")
def trial_info_normalised(spark, sf):
    """Orders as trial tables whose columns go by other names."""
    customer = t.read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    info = t.read(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("patient"), F.col("o_orderkey").alias("row"), t.condition().alias("SetSize"),
        (F.col("o_orderstatus") == "F").cast("int").alias("Accuracy"),
    )
    hot = hot_keys(info, ["patient"], SCALE.hot_group_rows, SCALE.broadcast_rows, t.read(spark, sf, "orders").count())
    return normalise_trial_info(info, "patient", "row", hot=hot)


@query("warehouse_rebuild", with_ctes("""
SELECT t.subject_id, t.region, count(DISTINCT channel_label) AS n_channels, count(DISTINCT trial) AS n_trials, count(*) AS n_cycles,
  count(*) FILTER (WHERE is_burst) AS n_burst_cycles, max(strptime(t.extraction_id, '%Y%m%d_%H%M%S')) AS extracted_at
FROM tree AS t JOIN (SELECT subject_id, region, max(extraction_id) AS extraction_id FROM tree GROUP BY 1, 2) AS l
  ON t.subject_id = l.subject_id AND t.region = l.region AND t.extraction_id = l.extraction_id
GROUP BY t.subject_id, t.region""", "tree"))
def warehouse_rebuild(spark, sf):
    """From the lake to the coverage mart: newest extractions, fact, dimensions, marts."""
    def build() -> DataFrame:
        paths = replace(t.SETTINGS.paths, lake=_lake(spark, sf), tables=new_location(spark, "tables"))
        warehouse = Warehouse(spark, replace(t.SETTINGS, paths=paths))
        t.trials(spark, sf).write.parquet(warehouse.location("trial_metadata"))
        return warehouse.build_marts(warehouse.build_core())["subject_coverage"]

    coverage = t.once(spark, sf, "rebuilt", build)
    return coverage.select("subject_id", "region", "n_channels", "n_trials", "n_cycles", "n_burst_cycles", "extracted_at")


def _number(column: str = "subject_id") -> Column:
    return F.substring(column, 2, 9).cast("int")


@query("touched_subjects", with_ctes("""
SELECT t.subject_id, t.region, count(DISTINCT channel_label) AS n_channels, count(DISTINCT trial) AS n_trials, count(*) AS n_cycles,
  count(*) FILTER (WHERE is_burst) AS n_burst_cycles, max(strptime(t.extraction_id, '%Y%m%d_%H%M%S')) AS extracted_at,
  CAST(substr(t.subject_id, 2) AS INTEGER) % 3 = 0 AS rebuilt
FROM tree AS t JOIN (SELECT subject_id, region, max(extraction_id) AS extraction_id FROM tree GROUP BY 1, 2) AS l
  ON t.subject_id = l.subject_id AND t.region = l.region AND t.extraction_id = l.extraction_id
GROUP BY t.subject_id, t.region""", "tree"))
def touched_subjects(spark, sf):
    """Extractions of a third of the subjects come late: only these subjects are built again, and all agree with a whole build."""
    def build() -> DataFrame:
        paths = replace(t.SETTINGS.paths, lake=new_location(spark, "late-lake"), tables=new_location(spark, "late-tables"))
        warehouse = Warehouse(spark, replace(t.SETTINGS, paths=paths))
        t.trials(spark, sf).write.parquet(warehouse.location("trial_metadata"))
        lake = read_lake(spark, _lake(spark, sf)).withColumns({"_block": F.lit(0), "_size": F.lit(0)})
        late = (_number() % 3 == 0) & (F.substring("extraction_id", 1, 4) > "1994")
        warehouse.load(lake.filter(~late), by_file=True)
        warehouse.build_marts(warehouse.build_core())
        warehouse.publish_tables()
        first = warehouse.published.subjects()["versions"]
        warehouse.load(lake.filter(late), by_file=True)
        warehouse.build_marts(warehouse.build_core([f"S{i}" for i in range(0, 25, 3)]))
        warehouse.publish_tables()
        second = warehouse.published.subjects()["versions"]
        again = [s for s, versions in second.items() if versions[0] != first.get(s, [None])[0]]
        return warehouse.table("subject_coverage").withColumn("rebuilt", F.col("subject_id").isin(again))

    coverage = t.once(spark, sf, "touched", build)
    return coverage.select("subject_id", "region", "n_channels", "n_trials", "n_cycles", "n_burst_cycles", "extracted_at", "rebuilt")


# Files arrive in two batches. At first those of a third of the subjects are narrow and another third's have two columns
# swapped; the newest extraction of the rest is not there yet. Before the second batch the narrow ones are repaired.
ARRIVED = """
files AS (
  SELECT subject_id, region, extraction_id, CAST(substr(subject_id, 2) AS INTEGER) % 3 AS flaw, count(*) AS n,
    substr(extraction_id, 1, 4) = '1998' AS late
  FROM tree GROUP BY ALL
), seen AS (
  SELECT 0 AS batch, * FROM files WHERE NOT (late AND flaw = 0)
  UNION ALL SELECT 1, * FROM files WHERE flaw > 0 OR late
)
SELECT batch, CASE batch WHEN 0 THEN 'success' ELSE 'failed' END AS run_status, subject_id, region, extraction_id,
  CASE WHEN flaw = 0 OR (flaw = 2 AND batch = 1) THEN 'loaded' ELSE 'skipped' END AS status,
  CASE WHEN flaw = 1 THEN 'another order' WHEN flaw = 2 AND batch = 0 THEN 'has besides the agreed columns burst; lacks is_burst' END AS reason,
  CASE WHEN flaw = 0 OR (flaw = 2 AND batch = 1) THEN n END AS row_count,
  CASE WHEN flaw <> 1 THEN n END AS rows_in_lake
FROM seen"""


#: More than there are files, so what has arrived by a call is one batch.
AT_ONCE = 1_000_000


def _arrival_settings(root: str) -> Settings:
    names = ("source_root", "trial_metadata", "lake", "tables", "ledger", "exports")
    settings = replace(t.SMALL_SETTINGS, paths=Paths(**{n: f"{root}/{n}" for n in names}), quality=replace(t.SETTINGS.quality, max_null_fraction=-1.0))
    return replace(settings, analysis=replace(settings.analysis, n_permutations=1000, n_bootstrap=200))


def _arrivals(spark, sf) -> str:
    """Where a stream has taken flawed files in two batches."""
    def build() -> str:
        root = new_location(spark, "arrivals")
        warehouse = Warehouse(spark, _arrival_settings(root))
        t.contract_files(spark, t.flawed_tree(spark, sf), f"{root}/source_root", lambda year, third: third > 0 or year != 1998)
        t.trial_files(spark, sf, f"{root}/trial_metadata")
        watch(warehouse, f"{root}/state", files_per_batch=AT_ONCE, no_fail=True).awaitTermination()
        t.contract_files(spark, t.later_tree(spark, sf), f"{root}/source_root", lambda year, third: third == 2 or (third == 0 and year == 1998))
        watch(warehouse, f"{root}/state", files_per_batch=AT_ONCE).awaitTermination()
        return root

    return t.once(spark, sf, "arrivals", build)


@query("stream_arrivals", with_ctes("SELECT * FROM (WITH " + ARRIVED.strip() + ") AS arrived", "tree"))
def stream_arrivals(spark, sf):
    """A stream over flawed files: what the ledger says of each file and batch, and the rows the lake has of it.

    The first batch is published whatever the checks say, the second meets the gate and is blocked.
    """
    root = _arrivals(spark, sf)
    ledger = Ledger(spark, f"{root}/ledger")
    runs = ledger.read("pipeline_run").select("run_id", F.col("status").alias("run_status"))
    identity = naming.file_identity(files.base_name(F.col("source_path")))
    keys = ("subject_id", "region", "extraction_id")
    seen = ledger.read("source_file").join(runs, "run_id").select(
        F.substring("run_id", -6, 6).cast("int").alias("batch"), "run_status", *[identity[k].alias(k) for k in keys], "status",
        F.when(F.col("reason").contains("another order"), "another order").otherwise(F.regexp_replace("reason", r"(^contract: |[^ ;]*\.csv(\.gz)?: )", "")).alias("reason"),
        "row_count",
    )
    lake = read_lake(spark, f"{root}/lake").groupBy(*keys).agg(F.count("*").alias("rows_in_lake"))
    return seen.join(lake, list(keys), "left").select("batch", "run_status", *keys, "status", "reason", "row_count", "rows_in_lake")


def _exports(spark, sf) -> str:
    def build() -> str:
        folder = new_location(spark, "exports")
        counts = {"channel_paired_asym": extracts.write_extract(t.paired(spark, sf), "channel_paired_asym", "run", folder)}
        counts["channel_load_asym"] = extracts.write_extract(t.load(spark, sf), "channel_load_asym", "run", folder)
        extracts.write_manifest(spark, t.SETTINGS, "run", counts, AT, folder)
        return folder

    return t.once(spark, sf, "exports", build)


@query("extract_round_trip", with_ctes(PAIRED_ROUNDED.replace("exclusion_reason FROM", "exclusion_reason, 'run' AS exported_for_run_id FROM"), "paired"))
def extract_round_trip(spark, sf):
    """The paired mart published as CSV and read back leniently."""
    text = extracts.read_extract(spark, _exports(spark, sf), "channel_paired_asym")
    kinds = {f.name: f.dataType for f in t.paired(spark, sf).schema if f.dataType.simpleString() != "string"}
    return rounded(extracts.lenient(text, kinds))


# What names a row of each extract, as Spark and as SQL expression.
ROW_NAMES = {
    "channel_paired_asym": ("subject_id", "region", "channel_label"),
    "channel_load_asym": ("subject_id", "region", "channel_label", "load_condition"),
    "cycle_qc_distribution": ("metric", "region", "load_condition", "is_burst", "CAST(round(CAST(bin_start AS DOUBLE) * 50) AS BIGINT)"),
    "subject_coverage": ("subject_id", "region"),
    "run_health": ("run_id",),
    "test_results": ("metric", "test"),
    "dq_results": ("substr(CAST(checked_at AS STRING), 1, 10)", "check_name"),
}


def _in_order(name: str, relation: str, order: str) -> str:
    cells = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in ROW_NAMES[name]).replace("AS STRING", "AS VARCHAR")
    return f"SELECT '{name}' AS extract, row_number() OVER (ORDER BY {order}) AS position, {cells} AS row_name FROM {relation}"


CHANNEL = "subject_id NULLS LAST, region NULLS LAST, channel_label NULLS LAST"
ORDERED = " UNION ALL ".join((
    _in_order("channel_paired_asym", "paired", CHANNEL),
    _in_order("channel_load_asym", "channel_load", CHANNEL + ", load_condition NULLS LAST"),
    _in_order("cycle_qc_distribution", "histogram", "metric NULLS LAST, region NULLS LAST, load_condition NULLS LAST, is_burst NULLS LAST, bin_start NULLS LAST"),
    _in_order("subject_coverage", "coverage", "subject_id NULLS LAST, region NULLS LAST"),
    _in_order("run_health", "run_health", "started_at DESC NULLS LAST"),
    _in_order("test_results", "suite", "metric NULLS LAST, test NULLS LAST"),
    _in_order("dq_results", "dq_results", "checked_at DESC NULLS LAST, check_name NULLS LAST"),
))


@query("extract_order", with_ctes(ORDERED, "paired", "channel_load", "histogram", "coverage", "run_health", "suite", "dq_results"))
def extract_order(spark, sf):
    """All seven extracts as published: which row lies where. Rows equal in all that they are sorted by have one name here."""
    def build() -> str:
        folder = new_location(spark, "all-exports")
        relations = {
            "channel_paired_asym": t.paired(spark, sf), "channel_load_asym": t.load(spark, sf),
            "cycle_qc_distribution": marts.symmetry_histogram(t.fact(spark, sf)),
            "subject_coverage": marts.subject_coverage(t.rollup(spark, sf), t.paired(spark, sf)),
            "run_health": marts.run_health(t.runs(spark, sf), t.source_files(spark, sf), t.dq_results(spark, sf)),
            "test_results": run_analysis(t.paired(spark, sf), t.SETTINGS.analysis), "dq_results": t.dq_results(spark, sf),
        }
        for name, relation in relations.items():
            extracts.write_extract(relation, name, "run", folder)
        return folder

    folder = t.once(spark, sf, "all-exports", build)
    found = []
    for name, parts in ROW_NAMES.items():
        text = F.concat_ws("|", *[F.coalesce(F.expr(part).cast("string"), F.lit("")) for part in parts])
        rows = extracts.read_extract_in_order(spark, folder, name)
        found.append(rows.select(F.lit(name).alias("extract"), "position", text.alias("row_name")))
    return stack(found)


# After the two batches of `stream_arrivals`, one published and one blocked, a whole run over files that break the contract.
RUN_STATES = """
SELECT run_id, triggered_by, status, TRUE AS closed, reason, files FROM (
  SELECT 'arrival-000000' AS run_id, 'stream' AS triggered_by, 'success' AS status, '' AS reason,
    count(*) FILTER (WHERE NOT (late AND flaw = 0)) AS files FROM states
  UNION ALL SELECT 'arrival-000001', 'stream', 'failed', 'data-quality check(s) failed', count(*) FILTER (WHERE flaw > 0 OR late) FROM states
  UNION ALL SELECT 'whole', 'api', 'failed', CAST(count(*) FILTER (WHERE flaw = 1) AS VARCHAR) || ' files break the contract', count(*) FROM states
) AS s"""
STATES = """
states AS (
  SELECT DISTINCT subject_id, region, extraction_id, CAST(substr(subject_id, 2) AS INTEGER) % 3 AS flaw, substr(extraction_id, 1, 4) = '1998' AS late FROM tree
)"""


@query("run_states", with_ctes(f"SELECT * FROM (WITH {STATES.strip()} {RUN_STATES}) AS runs", "tree"))
def run_states(spark, sf):
    """Status, message and files of a good run, one that the gate blocks and one that fails, with the blocking checks that the ledger has."""
    root = _arrivals(spark, sf)

    def build() -> str:
        folder = new_location(spark, "failed-ledger")
        warehouse = Warehouse(spark, _arrival_settings(root))
        warehouse.ledger = Ledger(spark, folder)
        try:
            warehouse.run_all("whole")
        except ContractError:
            return folder
        raise AssertionError("a run over broken files went through")

    ledgers = [Ledger(spark, f"{root}/ledger"), Ledger(spark, t.once(spark, sf, "failed-ledger", build))]
    runs, seen, outcomes = (stack([ledger.read(name) for ledger in ledgers]) for name in ("pipeline_run", "source_file", "dq_result"))
    files = seen.groupBy("run_id").agg(F.count("*").alias("files"))
    blocked = blocking(outcomes).groupBy("run_id").agg(F.count("*").cast("string").alias("n"))
    message = F.split(F.coalesce("message", F.lit("")), r"\n|;|:")[0]
    # The number of failed checks in the message is the ledger's.
    reason = F.when(F.col("status") == "success", F.coalesce("message", F.lit(""))).otherwise(
        F.when(message == F.concat(F.col("n"), F.lit(" data-quality check(s) failed")), "data-quality check(s) failed").otherwise(message)
    )
    return runs.join(files, "run_id").join(blocked, "run_id", "left").select(
        "run_id", "triggered_by", "status", (F.col("finished_at") >= F.col("started_at")).alias("closed"), reason.alias("reason"), "files"
    )


@query("run_manifest", with_ctes("""
SELECT 'run' AS run_id, (SELECT count(*) FROM paired) AS paired_rows, (SELECT count(*) FROM channel_load) AS load_rows,
  TRUE AS burst_only, 10000 AS n_permutations, 80 AS fs""", "paired"))
def run_manifest(spark, sf):
    return extracts.read_manifest(spark, _exports(spark, sf)).select(
        "run_id", F.col("row_counts.channel_paired_asym").alias("paired_rows"), F.col("row_counts.channel_load_asym").alias("load_rows"),
        F.col("analysis.burst_only").alias("burst_only"), F.col("analysis.n_permutations").alias("n_permutations"), F.col("signal.fs").alias("fs"),
    )


@query("missing_extracts", with_ctes("""
SELECT unnest(['cycle_qc_distribution', 'subject_coverage', 'run_health', 'test_results', 'dq_results']) AS extract
WHERE (SELECT count(*) FROM paired) > 0""", "paired"))
def missing_extracts(spark, sf):
    return extracts.missing_extracts(spark, _exports(spark, sf))


@query("run_ledger", with_ctes("""
SELECT 'pipeline_run' AS ledger, count(DISTINCT run_id) AS runs, count(DISTINCT run_id) AS rows FROM runs
UNION ALL SELECT 'source_file', 1, count(*) FROM classified
UNION ALL SELECT 'source_file_loaded', 1, count(*) FROM classified WHERE reason IS NULL
UNION ALL SELECT 'dq_result', 1, 13
UNION ALL SELECT 'test_result', 1, 6""", "runs", "classified"))
def run_ledger(spark, sf):
    """Every ledger table written twice for the same run: rows are replaced, not repeated."""
    ledger = Ledger(spark, new_location(spark, "ledger"))
    ledger.start_run("run", "cli", AT)
    found = t.once(spark, sf, "classified", lambda: _classified(spark, sf))
    loaded = found.filter("status = 'discovered'").select(F.col("source_path").alias("source_file"), F.col("size_bytes").alias("row_count"))
    trials = t.once(spark, sf, "trials", lambda: t.trials(spark, sf))
    outcomes = t.once(spark, sf, "outcomes", lambda: run_checks(t.checked_signals(spark, sf), trials, t.paired(spark, sf), t.SETTINGS, "run", AT))
    tests = t.once(spark, sf, "tests", lambda: run_analysis(t.paired(spark, sf), t.SETTINGS.analysis))
    for _ in range(2):
        ledger.register_files(found, "run", at=AT)
        ledger.register_files(found, "run", loaded, at=AT)
        ledger.record_checks(outcomes, "run")
        ledger.record_tests(tests, "run", AT)
    ledger.finish_run("run", "success", at=AT)
    _write_history(ledger, t.runs(spark, sf))

    def size(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.countDistinct("run_id").alias("runs"), F.count("*").alias("rows")).select(F.lit(name).alias("ledger"), "runs", "rows")

    registered = ledger.read("source_file")
    return (
        size("pipeline_run", ledger.read("pipeline_run").filter("run_id <> 'run'"))
        .unionByName(size("source_file", registered))
        .unionByName(size("source_file_loaded", registered.filter("status = 'loaded' AND row_count > 0")))
        .unionByName(size("dq_result", ledger.read("dq_result")))
        .unionByName(size("test_result", ledger.read("test_result")))
    )


def _write_history(ledger: Ledger, history: DataFrame) -> None:
    """Earlier runs, as they would lie in the ledger: one partition each."""
    history.repartition("run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(
        f"{ledger.root}/pipeline_run"
    )
