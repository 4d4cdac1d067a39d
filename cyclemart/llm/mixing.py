"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source should be taken target / source size times. The whole
part is taken for sure; the fractions are rounded in dependence on each other. Two
documents with a fraction meet, words are moved at random from one to the other
until one of them has a whole number, and the other goes on to the next meeting.
Every fraction keeps its expected value and the words of a source stay the same,
so a source ends within one document of its target.

Meetings run in buckets of each source, in one streaming pass that holds one
document; each bucket leaves one document open. The open ones meet in ``fan_in`` times
fewer buckets, and so on, until one per source is left, which is rounded by itself.
Random numbers are hashes of what meets, so reruns agree on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm import wordhash
from cyclemart.llm.quality_rules import WHITE_SPACE
from cyclemart.llm.tables import written


@dataclass(frozen=True)
class Mixing:
    """``weights`` repeat over the sources in order of their names, null last; a target stops at
    ``most_copies`` times its source. ``buckets``, a power of ``fan_in``, is the least number of buckets of a source; there are
    ``fan_in`` times more until a bucket holds ``bucket_rows`` rows or fewer on average, all sources taken together."""

    weights: tuple[int, ...] = (1, 2, 3)
    most_copies: int = 3
    buckets: int = 256
    bucket_rows: int = 1_000_000
    fan_in: int = 16
    seed: int = 11


def word_count(text: str = "text") -> Column:
    value = F.coalesce(F.col(text), F.lit(""))
    return F.size(F.filter(F.split(value, WHITE_SPACE), lambda w: w != "")).cast("long")


def numbered(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Adds each row's place (from 0) in the order of a column with distinct values: places within
    ranges plus the sizes of the ranges before."""
    ranges = written(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))  # as many rows as partitions
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranges.join(offsets, "_range").withColumn(name, F.col("_before") + inside).drop("_range", "_before")


def targets(sizes: DataFrame, p: Mixing) -> DataFrame:
    """(source, source_size, target) from (source, source_size)."""
    turn = (F.col("_place") % len(p.weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in p.weights]), turn + 1)
    sources = written(
        numbered(sizes, F.col("source").asc_nulls_last(), "_place").select("source", "source_size", weight.alias("_weight")), "sources"
    )
    most = p.most_copies * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    unit, n_full = 0.0, -1
    while True:  # each turn shares the excess anew; full sources stay full
        full = most < unit * F.col("_weight") if n_full >= 0 else F.lit(False)
        found = sources.agg(
            F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, most)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)).alias("weights"),
        ).first()
        if found.n == n_full:
            break
        n_full = found.n
        unit = (total - found.used) / found.weights if found.weights else 0.0
    share = F.lit(unit) * F.col("_weight")
    target = F.when(most < share, most.cast("double")).otherwise(share)
    return written(sources.select("source", "source_size", target.alias("target")), "targets")


def _uniform(a: int, b: int, seed: int) -> float:
    mask = (1 << 64) - 1
    x = ((a & mask) * 0x9E3779B97F4A7C15 + (b & mask) * 0xD6E8FEB86659FD93 + seed) & mask
    return int(wordhash.mix(np.array([x], np.uint64))[0]) / 2.0**64


def meet(pa_: float, size_a: int, pb: float, size_b: int, draw: float) -> tuple[float, float]:
    """Fractions of two documents after words moved between them: at least one is 0.0 or 1.0,
    size_a * fraction_a + size_b * fraction_b stays, and so do expected fractions."""
    up = min((1.0 - pa_) * size_a, pb * size_b)
    down = min(pa_ * size_a, (1.0 - pb) * size_b)
    if draw * (up + down) < down:  # towards a
        if (1.0 - pa_) * size_a <= pb * size_b:
            rest = pb - up / size_b
            return 1.0, 0.0 if rest < 1e-12 else rest
        return min(1.0, pa_ + up / size_a), 0.0
    if pa_ * size_a <= (1.0 - pb) * size_b:
        rest = pb + down / size_b
        return 0.0, 1.0 if rest > 1.0 - 1e-12 else rest
    return max(0.0, pa_ - down / size_a), 1.0


def _rounds(last: bool, seed: int):
    """One pass over rows sorted by group: sets copies and the open fraction."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        held = None  # the open document, a batch of one row
        for batch in batches:
            if batch.num_rows == 0:
                continue
            groups, sizes, order, copies, opens = (
                [x for rows in (held, batch) if rows is not None for x in rows.column(rows.schema.get_field_index(n)).to_pylist()]
                for n in ("_group", "size", "_order", "copies", "_open")
            )
            n_held = len(groups) - batch.num_rows
            waiting = None
            for i, fraction in enumerate(opens):
                if waiting is not None and groups[waiting] != groups[i]:
                    _leave(waiting, copies, opens, order, last, seed)
                    waiting = None
                if fraction is None:
                    continue
                if waiting is None:
                    waiting = i
                    continue
                draw = _uniform(order[waiting], order[i], seed)
                pair = meet(opens[waiting], sizes[waiting], fraction, sizes[i], draw)
                still = None
                for k, value in zip((waiting, i), pair, strict=True):
                    if value in (0.0, 1.0):
                        copies[k] += int(value)
                        opens[k] = None
                    else:
                        opens[k] = value
                        still = k
                waiting = still
            done = [_with(batch, copies[n_held:], opens[n_held:])]
            if n_held:
                done.insert(0, _with(held, copies[:1], opens[:1]))
            held = None
            for rows, first in zip(done, (0, n_held) if n_held else (0,), strict=True):
                at = None if waiting is None else waiting - first
                if at is None or not 0 <= at < rows.num_rows:
                    yield rows
                    continue
                held = rows.slice(at, 1)
                yield from (part for part in (rows.slice(0, at), rows.slice(at + 1)) if part.num_rows)
        if held is not None:
            field = held.schema.get_field_index
            copies, opens = held.column(field("copies")).to_pylist(), held.column(field("_open")).to_pylist()
            _leave(0, copies, opens, held.column(field("_order")).to_pylist(), last, seed)
            yield _with(held, copies, opens)

    return walk


def _leave(i: int, copies: list, opens: list, order: list, last: bool, seed: int) -> None:
    """The end of a group: its open document goes to the next level, or is rounded at the last."""
    if last:
        copies[i] += _uniform(order[i], 0, seed) < opens[i]
        opens[i] = None


def _with(batch: pa.RecordBatch, copies: list, opens: list) -> pa.RecordBatch:
    columns = list(batch.columns)
    columns[batch.schema.get_field_index("copies")] = pa.array(copies, pa.int64())
    columns[batch.schema.get_field_index("_open")] = pa.array(opens, pa.float64())
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def mixed(docs: DataFrame, p: Mixing = Mixing(), carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with size, source_size, target and copies (how often the mix takes the row).

    ``docs``: doc_id, text, source, and any other columns; those named in ``carry`` (default: all) are
    returned. A null text has size 0; a null source is a source. Documents of size 0 are
    taken 0 times. Repeated rows are rounded one by one; rows that are equal in doc_id, source and
    text may change places. Columns of ``docs`` called size, source_size, target or copies give way.
    """
    carry = [c for c in (carry or docs.columns) if c not in ("size", "source_size", "target", "copies")]
    buckets, n_rows = p.buckets, docs.count()
    while buckets * p.bucket_rows < n_rows:
        buckets *= p.fan_in
    order = F.xxhash64(F.lit(p.seed), F.col("doc_id"), F.col("source"), F.col("text"))
    sized = docs.withColumns({"size": word_count(), "_order": order}).select(*carry, F.col("source").alias("_source"), "size", "_order")
    sources = targets(
        docs.select("source", word_count().alias("_size")).groupBy("source").agg(F.sum("_size").alias("source_size")), p
    ).withColumnRenamed("source", "_of")
    rate = F.least(F.lit(float(p.most_copies)), F.col("target") / F.col("source_size"))
    rate = F.when((F.col("size") > 0) & (F.col("source_size") > 0), rate).otherwise(0.0)
    whole = F.floor(F.col("_rate"))
    fraction = F.col("_rate") - whole
    rows = (
        sized.join(sources, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of").withColumn("_rate", rate)
        .withColumn("copies", whole.cast("long"))
        .withColumn("_open", F.when(fraction > 0, fraction))
        .withColumn("_bucket", F.pmod(F.col("_order"), F.lit(buckets))).drop("_rate")
    )
    parts = []
    while True:
        grouped = rows.withColumn("_group", F.xxhash64("_source", "_bucket")).repartition("_source", "_bucket")
        ordered = grouped.sortWithinPartitions("_source", "_bucket", "_order", *(["doc_id"] if "doc_id" in carry else []))
        level = written(ordered.mapInArrow(_rounds(buckets == 1, p.seed + buckets), ordered.schema), "mixing-level")
        parts.append(level.filter("_open IS NULL"))
        if buckets == 1:
            break
        buckets //= p.fan_in
        rows = level.filter("_open IS NOT NULL").withColumn("_bucket", F.pmod(F.col("_bucket"), F.lit(buckets)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(*carry, "size", "source_size", "target", "copies")


def taken_rows(docs: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    names = docs.columns
    often = mixed(docs.toDF(*[f"c_{i}_{n}" if n in ("size", "source_size", "target", "copies") else n for i, n in enumerate(names)]), p)
    rows = often.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.drop("size", "source_size", "target", "copies", "_copy").toDF(*names)
