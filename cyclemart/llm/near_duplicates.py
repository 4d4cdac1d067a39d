"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation, components.

1. One pass turns each text into its set of word shingles, a 128-bit digest of the
   set, ``bands`` band hashes of ``rows`` MinHash values each, and two odd sketches of 1024
   bits. In one, each (hash function, MinHash value) toggles a bit, in the other each shingle does.
   The XOR of two sketches has the symmetric difference of what was folded in, so its
   population count estimates the similarity, most precisely where it is high. For whole
   sets it is also a proof: the sets differ in at least as many shingles as bits are set.
2. Rows with equal sets become one node; copies never meet as pairs.
3. Nodes that share a band are candidates. Each band bucket compares its members
   with one leader (linear in the bucket), a few times with other leaders, while
   components close buckets whose members are already connected.
4. Members of a bucket that are still apart are compared one by one, as far as their
   sketches allow a link. So no link between different texts gets lost in a bucket.
5. Links are confirmed on the shingles themselves.

Two sets of similarity 0.8 share no band with a probability below 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm import wordhash
from cyclemart.llm.components import connected_components
from cyclemart.llm.tables import written

SKETCH_LONGS = 16


@dataclass(frozen=True)
class NearDuplicates:
    """``shingle`` words make a shingle; sets link where 100 * intersection >= ``percent`` * union.

    ``far_bits``: candidates whose odd sketches of MinHash values differ in more bits are
    dropped; 195 is six standard deviations above what a similarity of 0.8 gives.
    ``leader_rounds``: how often buckets try another leader before open pairs are compared.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 6
    bands: int = 50
    far_bits: int = 195
    leader_rounds: int = 3


def _multipliers(n: int) -> np.ndarray:
    seeds = wordhash.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _min_values(shingles: np.ndarray, factors: np.ndarray, room: np.ndarray) -> np.ndarray:
    values = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    for at in range(0, len(short), len(room)):
        piece = short[at:at + len(room)]
        product = np.multiply(piece, factors, out=room[: len(piece)])
        np.minimum(values, np.minimum.reduce(product, axis=0), out=values)
    return values


def _sets(words: wordhash.Words, n: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each text in a block."""
    grams, at = wordhash.gram_hashes(words, n)
    ends = np.cumsum(words.counts)
    low = np.searchsorted(at, ends - words.counts)
    high = np.searchsorted(at, ends)
    for i, count in enumerate(words.counts):
        if count >= n:
            yield np.unique(grams[low[i]:high[i]])
        elif count:
            whole = np.uint64(count)
            for h in words.hashes[ends[i] - count:ends[i]]:
                whole = wordhash.mix(np.array([whole * np.uint64(31) + h], np.uint64))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _signed(p: NearDuplicates, with_bands: bool, text: str):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        factors = _multipliers(p.rows * p.bands)
        room = np.empty((64, len(factors)), np.uint32)
        salt = wordhash.mix(np.arange(len(factors), dtype=np.uint64) + np.uint64(77))
        weight = wordhash.mix(np.arange(p.rows, dtype=np.uint64) + np.uint64(5)) | np.uint64(1)
        band_salt = wordhash.mix(np.arange(p.bands, dtype=np.uint64) + np.uint64(991))
        for batch in batches:
            n = batch.num_rows
            sizes = np.zeros(n, np.int64)
            digest = np.zeros((2, n), np.uint64)
            parity = np.zeros((n, SKETCH_LONGS), np.int64)
            values = np.zeros((n, len(factors)), np.uint32) if with_bands else None
            for words in wordhash.blocks(batch.column(batch.schema.get_field_index(text)), wordhash.SPACED):
                for i, shingles in enumerate(_sets(words, p.shingle), words.first):
                    sizes[i] = len(shingles)
                    if len(shingles):
                        digest[0, i] = wordhash.mix(shingles ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)
                        digest[1, i] = wordhash.mix(shingles + np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)
                        if with_bands:
                            parity[i] = _parity(wordhash.mix(shingles + np.uint64(0xA4093822299F31D0))[None, :])
                            values[i] = _min_values(shingles, factors, room)
            columns = [pa.array(sizes), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64))]
            names = ["n_shingles", "set_a", "set_b"]
            if with_bands:
                columns += [*_bands_and_sketch(values, p, salt, weight, band_salt), _lists(parity)]
                names += ["bands", "sketch", "parity"]
            kept = [k for k in range(batch.num_columns) if with_bands is False or batch.schema.field(k).name != text]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in kept] + columns, [batch.schema.field(k).name for k in kept] + names
            )

    return sign


def _parity(hashes: np.ndarray) -> np.ndarray:
    """An odd sketch of each row of hashes."""
    size = 64 * SKETCH_LONGS
    place = (hashes % np.uint64(size)).astype(np.int64) + np.arange(len(hashes))[:, None] * size
    odd = (np.bincount(place.ravel(), minlength=len(hashes) * size) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(len(hashes), SKETCH_LONGS)


def _lists(matrix: np.ndarray) -> pa.Array:
    starts = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(matrix.reshape(-1).view(np.int64)))


def _bands_and_sketch(values, p: NearDuplicates, salt, weight, band_salt) -> list[pa.Array]:
    n = len(values)
    bands = np.empty((n, p.bands), np.uint64)
    maps = np.empty((n, SKETCH_LONGS), np.int64)
    for at in range(0, n, 512):  # a bounded number of rows in 64 bits at once
        piece = values[at:at + 512].astype(np.uint64)
        grouped = piece.reshape(len(piece), p.bands, p.rows)
        bands[at:at + 512] = wordhash.mix((wordhash.mix(grouped) * weight).sum(axis=2, dtype=np.uint64) + band_salt)
        maps[at:at + 512] = _parity(wordhash.mix(piece + salt))
    return [_lists(bands), _lists(maps)]


def signatures(docs: DataFrame, p: NearDuplicates, text: str = "text") -> DataFrame:
    """``docs`` without its text, with set size, set digest, band hashes and odd sketches."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    return docs.mapInArrow(
        _signed(p, True, text), f"{schema}, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>, parity array<long>"
    )


def digests(docs: DataFrame, p: NearDuplicates, text: str = "text") -> DataFrame:
    """``docs`` with the size and digest of each row's set; columns n_shingles, set_a, set_b."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_signed(p, False, text), f"{schema}, n_shingles long, set_a long, set_b long")


def _differing_bits(left: str, right: str) -> Column:
    bits = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(SKETCH_LONGS)]
    return reduce(lambda x, y: x + y, bits)


def _shingles(text: str, n: int) -> set:
    words = text.encode().lower().split()  # bytes: lowers A-Z only, splits at the six ASCII white-space bytes only
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(n)], strict=False))


def _compared(n: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, set()
        for batch in batches:
            common, union = [], []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                left = left.as_py()
                if left != last_text:
                    last_text, last = left, _shingles(left, n)
                other = _shingles(right.as_py(), n)
                both = len(last & other)
                common.append(both)
                union.append(len(last) + len(other) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())],
                ["a", "b", "common", "total"],
            )

    return compare


def _sketched(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(
        F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n_shingles", "sketch", "parity")]
    )


def _may_link(p: NearDuplicates) -> Column:
    """Whether sketches of a and b allow a link: the sets may differ in (100 - percent) of each
    (100 + percent) of their shingles together."""
    apart = (100 + p.percent) * _differing_bits("parity_a", "parity_b")
    return (apart <= (100 - p.percent) * (F.col("n_shingles_a") + F.col("n_shingles_b"))) & (
        _differing_bits("sketch_a", "sketch_b") <= p.far_bits
    )


def _links(pairs: DataFrame, texts: DataFrame, p: NearDuplicates) -> DataFrame:
    """Those of the pairs (a, b) that link, confirmed on whole texts."""
    with_texts = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_ta")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("_tb")), "b")
        .select("a", "b", "_ta", "_tb")
    )
    compared = with_texts.mapInArrow(_compared(p.shingle), "a long, b long, common long, total long")
    return written(compared.filter(100 * F.col("common") >= p.percent * F.col("total")).select("a", "b"), "links")


def _relabel(labels: DataFrame, linked: DataFrame) -> DataFrame:
    """Labels after joining the components at the ends of ``linked`` pairs."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("_la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("_lb"))
    merged = connected_components(
        linked.join(a, "a").join(b, "b").select(F.col("_la").alias("a"), F.col("_lb").alias("b")).filter("a <> b")
    )
    step = merged.select(F.col("node").alias("_from"), F.col("label").alias("_to"))
    return written(
        labels.join(step, labels.label == step._from, "left").select("node", F.coalesce("_to", "label").alias("label")), "labels"
    )


def near_duplicate_components(docs: DataFrame, p: NearDuplicates = NearDuplicates()) -> DataFrame:
    """Each row's near-duplicate class. ``docs``: doc_id (long), text; other columns are ignored.

    Returns doc_id, n_shingles, set_a, set_b (digest of the set), component_id (smallest
    doc_id reachable over links, itself included), kept (doc_id = component_id).
    Texts without words and null texts have an empty set and link with nothing.
    Rows with equal sets are one class, so repeated rows are all kept or all dropped;
    a null doc_id is never the smallest unless its class has no other, and then it is kept.
    """
    docs = docs.select("doc_id", "text").withColumn("_key", F.xxhash64("text"))
    signed = written(signatures(docs, p), "signatures")
    full = signed.filter("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))
    nodes = full.groupBy("set_a", "set_b").agg(
        first.alias("_first"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch", "parity")]
    )
    nodes = written(
        nodes.select(
            "set_a", "set_b", F.col("_first.doc_id").alias("doc_id"), F.col("_first._key").alias("_key"),
            "n_shingles", "bands", "sketch", "parity",
        ).withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )

    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).filter("_low < _high")
    members = written(buckets.join(shared.select("bucket"), "bucket"), "members")
    labels = written(members.select("node").distinct().withColumn("label", F.col("node")), "labels")
    wanted = nodes.join(labels, "node", "left_semi").select("node", F.col("doc_id").alias("_id"), F.col("_key").alias("_text_key"))
    texts = docs.join(
        wanted, docs.doc_id.eqNullSafe(wanted._id) & (docs._key == wanted._text_key), "inner"
    ).select("node", "text")
    texts = written(texts.dropDuplicates(["node"]), "texts")

    for round_ in range(p.leader_rounds):
        labelled = members.join(labels, "node")
        spread = labelled.groupBy("bucket").agg(
            F.min("label").alias("_low"), F.max("label").alias("_high"),
            F.min_by("node", F.xxhash64(F.col("node"), F.lit(round_))).alias("leader"),
            F.min_by("label", F.xxhash64(F.col("node"), F.lit(round_))).alias("leader_label"),
        ).filter("_low < _high").select("bucket", "leader", "leader_label")
        spread = written(spread, "spread")
        if round_ and spread.isEmpty():
            break
        pairs = (
            labelled.join(spread, "bucket").filter("label <> leader_label")
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        )
        near = pairs.join(_sketched(nodes, "a"), "a").join(_sketched(nodes, "b"), "b").filter(_may_link(p)).select("a", "b")
        labels = _relabel(labels, _links(near, texts, p))
    labels = _relabel(labels, _links(_open_pairs(members, labels, nodes, p), texts, p))
    per_node = nodes.join(labels, "node", "left").select(
        "set_a", "set_b", "doc_id", F.coalesce("label", "node").alias("label")
    )
    ids = per_node.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = per_node.join(ids, "label").select("set_a", "set_b", "component_id")
    sets = full.select("doc_id", "n_shingles", "set_a", "set_b").join(classes, ["set_a", "set_b"])
    empty = signed.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", "set_a", "set_b", F.col("doc_id").alias("component_id")
    )
    result = sets.select("doc_id", "n_shingles", "set_a", "set_b", "component_id").unionByName(empty)
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _open_pairs(members: DataFrame, labels: DataFrame, nodes: DataFrame, p: NearDuplicates) -> DataFrame:
    """Pairs of bucket members with different labels that may link."""
    labelled = members.join(labels, "node")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high")
    opened = written(labelled.join(mixed.select("bucket"), "bucket"), "open")

    def side(name: str) -> DataFrame:
        named = opened.select("bucket", F.col("node").alias(name), F.col("label").alias(f"label_{name}"))
        return named.join(_sketched(nodes, name), name)

    meeting = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & _may_link(p)
    left, right = side("a"), side("b").withColumnRenamed("bucket", "_bucket")
    return left.join(right, (F.col("bucket") == F.col("_bucket")) & meeting).select("a", "b").distinct()


def deduplicated(docs: DataFrame, p: NearDuplicates = NearDuplicates()) -> DataFrame:
    """One row of each near-duplicate class, with all its columns; rows without words all stay.

    The row that stays has the smallest doc_id of its class; of repeated rows, one.
    """
    classes = near_duplicate_components(docs, p).filter("kept AND n_shingles > 0")
    key = F.xxhash64("doc_id", "set_a", "set_b")  # copies have doc_ids of their own, so no key is hot
    staying = classes.select(
        key.alias("_key"), F.col("doc_id").alias("_id"), F.col("set_a").alias("_a"), F.col("set_b").alias("_b")
    ).distinct()
    marked = digests(docs, p).withColumn("_key", key)
    same = (
        (marked._key == staying._key) & (marked.set_a == staying._a) & (marked.set_b == staying._b)
        & marked.doc_id.eqNullSafe(staying._id)
    )
    joined = marked.join(staying, same, "left").select(*[marked[c] for c in marked.columns], F.col("_a").isNotNull().alias("_stays"))
    place = F.row_number().over(Window.partitionBy("_key", "set_a", "set_b").orderBy(F.xxhash64("text")))
    return joined.withColumn("_place", place).filter("n_shingles = 0 OR (_stays AND _place = 1)").select(*docs.columns)
