"""Benchmark tables seen as cycle features, trials, run history and recordings.

Mapping: supplier nation -> subject, line status -> region, part type -> channel,
order -> trial, line item -> cycle, order priority -> condition.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.contract import NULL_TOKENS, SOURCE_COLUMNS, STAGING_COLUMNS
from cyclemart.functions.cells import render_cell
from cyclemart.functions.naming import feature_file_name
from cyclemart.operators.skew import HotKeys, hot_keys, number_rows
from cyclemart.operators.staging_area import materialise, new_location, shared_folder
from cyclemart.plans.fact import build_fact, signal_rollup
from cyclemart.plans.marts import channel_load, channel_paired
from cyclemart.plans.quality import signal_checks
from cyclemart.settings import Analysis, Settings, Signal
from cyclemart.sources.files import copy_file, list_files

FS = 80
SETTINGS = Settings(signal=Signal(fs=FS, lowpass=30.0), analysis=Analysis())
SMALL_SETTINGS = replace(SETTINGS, analysis=replace(SETTINGS.analysis, min_cycles=3))
RECORDING = Signal(fs=10, theta_low=1.0, theta_high=3.0, lowpass=4.0, epoch_start_s=-0.3, epoch_end_s=2.8)
SAMPLES_PER_RECORDING = 250


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def known_rows(spark: SparkSession, sf_dir: str) -> int:
    """Row count of the cycles, from Parquet footers."""
    return read(spark, sf_dir, "lineitem").count()


def trial_rows(spark: SparkSession, sf_dir: str) -> int:
    """A bound on the rows of any trial: those of the largest order, whose key a trial holds. Line items lie by order,
    so counting them combines map-side. Where all cycles are few enough for one task, their number will do."""
    rows = known_rows(spark, sf_dir)
    if rows <= SETTINGS.scale.hot_group_rows:
        return rows
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]


_written: dict[tuple[str, ...], DataFrame | str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, build):
    """A table written once per session and folder, as a warehouse keeps its tables."""
    key = (spark.sparkContext.applicationId, shared_folder(spark), sf_dir, label)
    if key not in _written:
        made = build()
        _written[key] = materialise(made, label) if isinstance(made, DataFrame) else made
    return _written[key]


# -- cycles -------------------------------------------------------------------


def cycle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with what the staging layout needs of them, of their suppliers and of their parts."""
    line = read(spark, sf_dir, "lineitem")
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate", "s_nationkey", "p_type",
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the staging layout."""
    return in_staging_layout(cycle_rows(spark, sf_dir))


def in_staging_layout(rows: DataFrame, *carried: str) -> DataFrame:
    quantity, price = F.col("l_quantity"), F.floor("l_extendedprice").cast("double")
    shape, slope = F.col("l_discount") * 10, F.col("l_tax") * F.lit(12.5)
    trough = F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey")
    inner = F.col("l_linenumber") > 1
    columns = {
        "subject_id": F.concat(F.lit("S"), F.col("s_nationkey").cast("string")),
        "region": F.col("l_linestatus"),
        "extraction_id": F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("01_000000")),
        "extracted_at": F.col("l_shipdate"),
        "trial": F.col("l_orderkey").cast("int"),
        "channel_idx": F.length("p_type"),
        "channel_label": F.col("p_type"),
        "amp_fraction": shape,
        "amp_consistency": F.when(inner, slope),
        "period_consistency": F.when(inner, shape),
        "monotonicity": slope,
        "period": quantity,
        "time_peak": quantity / 2,
        "time_trough": quantity / 2,
        "time_rise": quantity / 4,
        "time_decay": quantity * 3 / 4,
        "volt_peak": price / 2,
        "volt_trough": -price / 2,
        "volt_rise": price,
        "volt_decay": price,
        "volt_amp": price,
        "band_amp": price / 4,
        "time_ptsym": F.when(quantity != 50, shape),
        "time_rdsym": slope,
        "sample_peak": F.col("l_suppkey"),
        "sample_last_zerox_decay": F.col("l_partkey"),
        "sample_zerox_decay": F.col("l_suppkey"),
        "sample_zerox_rise": F.col("l_linenumber").cast("long"),
        "sample_last_trough": trough,
        "sample_next_trough": trough + quantity.cast("long"),
        "is_burst": F.col("l_returnflag") != "N",
        "source_file": F.lit("lineitem"),
        "run_id": F.lit("run"),
        "loaded_at": F.col("l_shipdate"),
    }
    return rows.select(*[columns[c].alias(c) for c in STAGING_COLUMNS], *carried)


def condition() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trial metadata: trials of closed and open orders, plus orders without line items.

    Line items are placed by order, which serves both telling their nations apart and finding their orders.
    """
    orders = read(spark, sf_dir, "orders")
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    def shaped(df: DataFrame, nation: str) -> DataFrame:
        return df.select(
            F.concat(F.lit("S"), F.col(nation).cast("string")).alias("subject_id"),
            F.col("o_orderkey").cast("int").alias("trial"), condition().alias("load_condition"),
            (F.col("o_orderstatus") == "F").alias("correct"), F.lit("run").alias("run_id"),
        )

    recorded = (
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", "l_orderkey")
        .repartition("l_orderkey").distinct()
        .join(orders.filter("o_orderstatus <> 'P'"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    unrecorded = orders.join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return shaped(recorded, "s_nationkey").unionByName(shaped(unrecorded, "c_nationkey"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "fact", lambda: build_fact(
        features(spark, sf_dir), trials(spark, sf_dir), SETTINGS, trial_rows(spark, sf_dir)
    ))


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "rollup", lambda: signal_rollup(fact(spark, sf_dir)))


def checked_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "checked", lambda: signal_checks(fact(spark, sf_dir), SETTINGS))


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    cycles = fact(spark, sf_dir)
    return once(spark, sf_dir, "load", lambda: channel_load(cycles, SETTINGS, cycles.count()))


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "paired", lambda: channel_paired(load(spark, sf_dir), SETTINGS))


# -- source files -------------------------------------------------------------


def source_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path per (subject, region, month), some of them flawed, below ``/src``."""
    month = F.date_trunc("month", F.col("extracted_at")).cast("timestamp_ntz")
    keys = features(spark, sf_dir).select("subject_id", "region", month.alias("month")).distinct()
    number = F.substring("subject_id", 2, 9).cast("int")
    name = feature_file_name(F.col("subject_id"), F.col("region"), F.col("month"))
    stamp = F.date_format("month", "yyyyMMdd_HHmmss")
    clean = F.concat(F.lit("/src/"), F.col("subject_id"), F.lit("/"), F.col("region"), F.lit("/"), name)
    path = (
        F.when(number % 6 == 1, F.concat(F.lit("/src/"), F.col("subject_id"), F.lit("/"), F.col("subject_id"), F.lit("_merged_bycycle_features_"), stamp, F.lit(".csv")))
        .when(number % 6 == 2, F.concat(F.lit("/src/"), F.col("subject_id"), F.lit("/X/"), name))
        .when(number % 6 == 3, F.regexp_replace(clean, r"_(\d{4})\d{4}_", "_$11399_"))
        .when(number % 6 == 4, F.concat(F.lit("/src/"), F.col("subject_id"), F.lit("/"), name))
        .when((number % 6 == 5) & (F.col("region") == "O"), F.concat(F.lit("/src/Z/"), F.col("region"), F.lit("/"), name))
        .otherwise(clean)
    )
    return keys.select(path.alias("path"), F.length(path).cast("long").alias("size_bytes"))


def _cells(rows: DataFrame) -> list[Column]:
    """Contract cells as text, NULLs in all their spellings."""
    tokens = F.array(*[F.lit(t) for t in NULL_TOKENS])
    spelling = F.element_at(tokens, (F.col("trial") % len(NULL_TOKENS) + 1).cast("int"))
    cells = []
    for name, kind in SOURCE_COLUMNS.items():
        plain = kind.simpleString() in ("int", "string")
        text = F.col(name).cast("string") if plain else render_cell(name, F.col(name))
        cells.append(F.when(F.col(name).isNull(), spelling).otherwise(text).alias(name))
    return cells


TREE_KEYS = ("subject_id", "region", "extraction_id")


def _tree_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract cells with the keys of their file, file by file.

    Rows are exchanged and sorted as the tables have them and spelled out afterwards: as text they are several times as large.
    Extractions are years, cut further every two million orders, so files stay bounded.
    """
    chunk = F.floor(F.col("l_orderkey") / F.lit(2_000_000))
    clock = F.format_string("%02d%02d%02d", F.floor(chunk / 3600), F.floor(chunk / 60) % 60, chunk % 60)
    places = {
        "_subject": F.concat(F.lit("S"), F.col("s_nationkey").cast("string")), "_region": F.col("l_linestatus"),
        "_extraction": F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("0101_"), clock),
    }
    placed = cycle_rows(spark, sf_dir).withColumns(places).repartition(*places).sortWithinPartitions(*places)
    rows = in_staging_layout(placed, *places)
    return rows.select(*_cells(rows), *[F.col(c).alias(k) for c, k in zip(places, TREE_KEYS, strict=True)])


def _write_tree(rows: DataFrame, root: str, mode: str = "error") -> None:
    """Packed at gzip's fastest level, which costs a third of the time of the usual one for a third more bytes."""
    rows.write.mode(mode).option("header", "true").option("escape", '"').option("emptyValue", "").option(
        "compression", "gzip"
    ).option("zlib.compress.level", "BEST_SPEED").partitionBy(*TREE_KEYS).csv(root)


def feature_tree(spark: SparkSession, sf_dir: str) -> str:
    """All line items as contract CSV files in gzip, one per (subject, region, extraction)."""
    def build() -> str:
        root = new_location(spark, "tree")
        _write_tree(_tree_rows(spark, sf_dir).select(*SOURCE_COLUMNS, *TREE_KEYS), root)
        return root

    return once(spark, sf_dir, "tree", build)


def later_tree(spark: SparkSession, sf_dir: str) -> str:
    """Of the files of :func:`feature_tree` those that arrive later: of subjects whose files were narrow at first all, of
    subjects without a flaw those of 1998."""
    def build() -> str:
        root, third = new_location(spark, "later"), F.substring("subject_id", 2, 9).cast("int") % 3
        later = (third == 2) | ((third == 0) & F.col("extraction_id").startswith("1998"))
        _write_tree(_tree_rows(spark, sf_dir).filter(later).select(*SOURCE_COLUMNS, *TREE_KEYS), root)
        return root

    return once(spark, sf_dir, "later", build)


def flawed_tree(spark: SparkSession, sf_dir: str) -> str:
    """The same files with, by subject, swapped, dropped or added columns."""
    def build() -> str:
        rows = _tree_rows(spark, sf_dir)
        flaw = F.substring("subject_id", 2, 9).cast("int") % 3
        names, root = list(SOURCE_COLUMNS), new_location(spark, "flawed")
        _write_tree(rows.filter(flaw == 0).select(*names, *TREE_KEYS), root)
        _write_tree(rows.filter(flaw == 1).select(names[1], names[0], *names[2:], *TREE_KEYS), root, "append")
        _write_tree(rows.filter(flaw == 2).withColumnRenamed("is_burst", "burst").select(*names[:-1], "burst", *TREE_KEYS), root, "append")
        return root

    return once(spark, sf_dir, "flawed", build)


def _place(spark: SparkSession, written: str, root: str, glob: str, name) -> None:
    """Copy the one file of each written folder to ``root`` as ``name`` (of the folder's keys; None: not at all)
    says, each in a task. Files that are there already are replaced."""
    def copy(batches):
        for batch in batches:
            for path in batch["path"]:
                target = name(dict(part.split("=", 1) for part in path.split("/") if "=" in part))
                if target:
                    copy_file(path, f"{root}/{target}")
            yield batch.head(0)

    found = list_files(spark, written, glob).select("path")
    found.repartition("path").mapInPandas(copy, "path string").foreach(lambda _: None)


def contract_files(spark: SparkSession, tree: str, root: str, wanted) -> None:
    """Files of a tree under the names that the contract gives them. ``wanted(year, third)`` says which, by extraction and subject."""
    def name(keys: dict[str, str]) -> str | None:
        subject, region, extraction = keys["subject_id"], keys["region"], keys["extraction_id"]
        if wanted(int(extraction[:4]), int(subject[1:]) % 3):
            return f"{subject}/{region}/{subject}_{region}_bycycle_features_{extraction}.csv.gz"
        return None

    _place(spark, tree, root, "*.csv.gz", name)


def trial_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Trial metadata as the contract has it, one file a subject."""
    rows = trials(spark, sf_dir).select(
        F.col("subject_id").alias("subject"), "subject_id", "trial", "load_condition", F.initcap(F.col("correct").cast("string")).alias("correct")
    )
    written = new_location(spark, "trial-files")
    rows.repartition("subject").write.option("header", "true").partitionBy("subject").csv(written)
    _place(spark, written, root, "*.csv", lambda k: f"{k['subject']}_trial_metadata.csv")


# -- run history --------------------------------------------------------------


def _run(moment: str) -> Column:
    return F.concat(F.lit("run-"), F.date_format(moment, "yyyyMM"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order month."""
    return read(spark, sf_dir, "orders").groupBy(_run("o_orderdate").alias("run_id")).agg(
        F.lit("cli").alias("triggered_by"), F.min("o_orderdate").alias("started_at"),
        F.when(F.count("*") % 5 != 0, F.max("o_orderdate")).alias("finished_at"),
        F.when(F.count("*") % 5 != 0, "success").otherwise("running").alias("status"),
        F.lit(None).cast("string").alias("message"),
    )


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source file per order."""
    status = F.when(F.col("o_orderstatus") == "F", "loaded").when(F.col("o_orderstatus") == "P", "skipped").otherwise("discovered")
    return read(spark, sf_dir, "orders").select(
        _run("o_orderdate").alias("run_id"), F.concat(F.lit("/src/"), F.col("o_orderkey").cast("string")).alias("source_path"),
        status.alias("status"), F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("row_count"),
        F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice")).alias("size_bytes"),
    )


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check outcome per line item."""
    return read(spark, sf_dir, "lineitem").select(
        _run("l_shipdate").alias("run_id"), F.concat_ws("-", "l_returnflag", "l_linestatus").alias("check_name"),
        F.when(F.col("l_returnflag") == "N", "warn").otherwise("error").alias("severity"),
        (F.col("l_quantity") < 45).alias("passed"), F.col("l_quantity").alias("observed"),
        F.lit(45.0).alias("threshold"), F.col("l_shipdate").alias("checked_at"),
    )


# -- recordings ---------------------------------------------------------------


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as recordings: a vector is one sample of all channels. Some values are NaN."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("column_idx", "v"))
    noisy = (F.col("vec_id") % 97 == 0) & (F.col("column_idx") % 16 == 0)
    return vectors.select(
        _recording().alias("session_id"), "column_idx", (F.col("vec_id") % SAMPLES_PER_RECORDING).alias("t_index"),
        F.when(noisy, F.lit(float("nan"))).otherwise(F.col("v").cast("double")).alias("value"),
    )


def _recording() -> Column:
    return F.concat(F.lit("rec"), F.floor(F.col("vec_id") / F.lit(SAMPLES_PER_RECORDING)).cast("string"))


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = _recording().alias("session_id")
    return read(spark, sf_dir, "embeddings").groupBy(session).agg(F.count("*").alias("n_samples")).select(
        "session_id", F.concat(F.lit("sub-1_ses-1_P"), F.substring("session_id", 4, 9)).alias("identifier"),
        F.lit("1").alias("subject_field"), F.lit("").alias("session_field"),
        F.lit(0.0).alias("start_time"), F.lit(10.0).alias("rate"), "n_samples",
    )


LOCATIONS = (
    "hippocampus_left", "hippocampus_right", "amygdala_left", "dorsal_anterior_cingulate_cortex_right",
    "pre_supplementary_motor_area_left", "unknown_region_right", "ventral_medial_prefrontal_cortex", "_left",
)


def electrodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = F.array(*[F.lit(x) for x in LOCATIONS])
    channels = samples(spark, sf_dir).select("session_id", "column_idx").distinct()
    return channels.withColumn("location", F.element_at(places, F.col("column_idx") % len(LOCATIONS) + 1))


def recording_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial starts at every vector of label 0."""
    onsets = read(spark, sf_dir, "embeddings").filter("label = 0").select(
        _recording().alias("session_id"), "vec_id", (F.col("vec_id") % SAMPLES_PER_RECORDING / F.lit(10.0)).alias("onset_s"),
        (F.col("vec_id") % 3 + 1).alias("load"), (F.col("vec_id") % 2).alias("accuracy"),
    )
    scale, vectors = SETTINGS.scale, read(spark, sf_dir, "embeddings")
    hot = hot_keys(onsets, ["session_id"], scale.hot_group_rows, scale.broadcast_rows, vectors.count())
    return number_rows(onsets, ["session_id"], ["vec_id"], "trial", hot=hot).withColumn("trial", F.col("trial") - 1)


def ordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered per user by time."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return number_rows(events, ["user_id"], ["ts", "event_id"], "cycle_idx", "cycles_in_signal", event_skew(spark, sf_dir))


def event_skew(spark: SparkSession, sf_dir: str) -> HotKeys | None:
    events, scale = read(spark, sf_dir, "events"), SETTINGS.scale
    return hot_keys(events, ["user_id"], scale.hot_group_rows, scale.broadcast_rows, events.count())
