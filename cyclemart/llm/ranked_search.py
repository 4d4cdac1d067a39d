"""Ranked lexical search with best positions.

Documents are read once: their words become hashes (``wordhash``), and a document keeps its length and the counts of
the words that some item may hold. Document counts of terms give the weights. Then every task walks
its documents in shards. A shard has one impact list for each term, highest impact first, and the same
postings in document order for direct accesses. For each item the lists of its terms are read downwards
side by side. A document met in one list is looked up in all others, which gives its whole
score and marks its position everywhere. The best position of a list is the end of its unbroken run of marked
positions, which direct accesses carry beyond the last one read. No unseen document can score more than
the impacts at the best positions together, and reading stops when that sum is strictly below the
k-th score so far, so equal scores are never lost. The k-th score is kept from shard to shard within a task.

Everything is exact: stopping early is proved by the bound, and scores are 64-bit integers. Words
are told apart by 64-bit hashes.

Memory: a shard holds ``SHARD_POSTINGS`` postings (or one document more), whatever the split; a task's best are k for each item of a
block, and items go out in blocks of ``BLOCK_TERMS`` terms, so what is broadcast has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from cyclemart.llm import wordhash
from cyclemart.llm.tables import written

#: Words that no item holds are left out by a bit map of this fixed size (1 MB); a few others pass, harmlessly.
MAP_BITS = 1 << 23
#: Terms (with repeats between items) of a block of items, the unit that is broadcast (about 2 MB).
BLOCK_TERMS = 100_000
#: Postings that a task ranks together.
SHARD_POSTINGS = 1_000_000
#: Positions read from each list in a first step; steps grow by half.
FIRST_STEP = 64

_COUNTS = "n_terms long, terms array<long>, counts array<int>"


@dataclass(frozen=True)
class Scoring:
    """Weight and impact of a term; integers, divisions rounding down.

    weight = floor(1000 ln((2N + 2) / (2 df + 1))); length = 50 + (50 n N) div L; impact = 10^9 tf div (1000 tf + 20 length).
    N documents have a term, L terms in all, n in the document.
    """

    n_documents: int
    n_terms: int

    def weight(self, df: Column) -> Column:
        return F.floor(1000 * F.log(F.lit(2 * self.n_documents + 2) / (2 * df + 1))).cast("long")

    def lengths(self, n: np.ndarray) -> np.ndarray:
        most = int(n.max(initial=0))
        if 50 * most * self.n_documents < 1 << 62:
            return 50 + 50 * n * self.n_documents // max(1, self.n_terms)
        return np.array([50 + 50 * int(x) * self.n_documents // max(1, self.n_terms) for x in n], np.int64)

    @staticmethod
    def impacts(tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 20 * lengths)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _words_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, its number of words, their hashes), a block at a time."""
    for block in wordhash.blocks(texts, wordhash.ALPHANUMERIC):
        ends = np.cumsum(block.counts)
        for i, (end, n) in enumerate(zip(ends.tolist(), block.counts.tolist(), strict=True)):
            yield block.first + i, n, block.hashes[end - n:end]


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term): each term of an item once. Rows with one id are one item; null ids are one item too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for i, _, hashes in _words_of(batch.column(1)):
                own = np.unique(hashes)
                ids.append(np.full(len(own), i))
                terms.append(own)
            if ids:
                places, found = np.concatenate(ids), _signed(np.concatenate(terms))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), pa.array(found)], ["item", "term"])

    kind = items.schema[item].dataType.simpleString()
    return items.select(item, text).mapInArrow(run, f"item {kind}, term long").distinct()


def _bit_map(terms: DataFrame) -> bytes:
    """One bit for each hash value; the driver gets words of the map, at most a fixed number."""
    places = terms.select(F.pmod("term", F.lit(MAP_BITS)).alias("place"))
    parts = places.selectExpr("place div 63 AS word", "shiftleft(1L, int(place % 63)) AS bit")
    bits = np.zeros(MAP_BITS, np.uint8)
    for row in parts.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # up to MAP_BITS / 63 rows
        for i in range(63):
            if row.bits >> i & 1:
                bits[row.word * 63 + i] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _counted(docs: DataFrame, key: str, text: str, wanted: bytes) -> DataFrame:
    """(doc, n_terms, terms, counts) of every row of ``docs``; terms outside the map are only counted in n_terms."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            spans, terms, counts = np.zeros(batch.num_rows + 1, np.int32), [], []
            for i, n, hashes in _words_of(batch.column(1)):
                sizes[i] = n
                signed = _signed(hashes)
                own, tf = np.unique(signed[bits[signed % MAP_BITS]], return_counts=True)
                spans[i + 1] = len(own)
                terms.append(own)
                counts.append(tf)
            offsets = pa.array(np.cumsum(spans, dtype=np.int32))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(flat[0], pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(flat[1].astype(np.int32)))],
                ["doc", "n_terms", "terms", "counts"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"doc {kind}, {_COUNTS}")


class Shard:
    """Impact lists of some documents, and their postings in document order."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        order = np.lexsort((docs, terms))
        self.docs, self.impacts = docs[order], impacts[order]
        self.terms, self.starts = np.unique(terms[order], return_index=True)
        self.stops = np.append(self.starts[1:], len(order))
        #: Posting at each place of the impact lists, and the place of each posting.
        self.downwards = np.lexsort((self.docs, -self.impacts, np.repeat(np.arange(len(self.terms)), self.stops - self.starts)))
        self.place = np.empty(len(order), np.int64)
        self.place[self.downwards] = np.arange(len(order))

    def lists(self, terms: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, stop, weight) of the item's terms that occur here."""
        if not len(self.terms):
            return []
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return [(int(self.starts[i]), int(self.stops[i]), int(w)) for i, t, w in zip(at, terms, weights, strict=True) if self.terms[i] == t and w > 0]

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, positions read) of all that can be among the k best and reach ``floor``.

        Of documents below the k-th here some are left out; every document with a score of the k-th or more is there.
        """
        lists = self.lists(terms, weights)
        marked = [np.zeros(stop - start + 1, bool) for start, stop, _ in lists]
        best, read, step, n_read = [0] * len(lists), 0, FIRST_STEP, 0
        seen, scores = np.zeros(0, self.docs.dtype), np.zeros(0, np.int64)
        while True:
            new = [self.docs[self.downwards[start + read:min(stop, start + read + step)]] for start, stop, _ in lists]
            n_read += sum(map(len, new))
            new = np.setdiff1d(np.concatenate(new), seen) if new else seen
            total = np.zeros(len(new), np.int64)
            for (start, stop, weight), mark in zip(lists, marked, strict=True):
                at = start + np.searchsorted(self.docs[start:stop], new)  # direct accesses
                there = at < stop
                there[there] = self.docs[at[there]] == new[there]
                total[there] += weight * self.impacts[at[there]]
                mark[self.place[at[there]] - start] = True
            seen, scores = np.concatenate([seen, new]), np.concatenate([scores, total])
            bound = 0
            for i, ((start, stop, weight), mark) in enumerate(zip(lists, marked, strict=True)):
                best[i] += int(np.argmin(mark[best[i]:]))  # the last entry is never marked
                if best[i] < stop - start:
                    bound += weight * int(self.impacts[self.downwards[start + max(0, best[i] - 1)]])
            kth = max(floor, int(np.partition(scores, -k)[-k])) if len(scores) >= k else floor
            read += step
            step += step // 2
            if bound < kth or bound == 0:
                kept = (scores >= kth) & (scores > 0)
                return seen[kept], scores[kept], n_read


class _Best:
    """The k best of an item in a task: score, then the row's place in key order."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    @property
    def floor(self) -> int:
        return self.found[-1][0] if len(self.found) == self.k else 0

    def add(self, scores: list[int], keys: list) -> None:
        rows = [*self.found, *zip(scores, keys, strict=True)]
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
        self.found = rows[:self.k]


def _shards(batches: Iterator[pa.RecordBatch], scoring: Scoring, known: np.ndarray) -> Iterator[tuple[Shard, list]]:
    keys, parts, size = [], [], 0

    def shard() -> Shard:
        terms, docs, impacts = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return Shard(terms, docs, impacts)

    for batch in batches:
        lengths = scoring.lengths(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
        spans = batch.column(2)
        bounds = spans.offsets.to_numpy()
        terms, counts = spans.values.to_numpy(), batch.column(3).values.to_numpy().astype(np.int64)
        at = 0
        while at < batch.num_rows:  # cut where the shard is full, between documents
            to = at + max(1, int(np.searchsorted(bounds[at + 1:], bounds[at] + SHARD_POSTINGS - size, "right")))
            own, tf = terms[bounds[at]:bounds[to]], counts[bounds[at]:bounds[to]]
            rows = np.repeat(np.arange(at, to), np.diff(bounds[at:to + 1]))
            asked = np.searchsorted(known, own)
            asked = known[np.minimum(asked, len(known) - 1)] == own
            own, tf, rows = own[asked], tf[asked], rows[asked]
            parts.append((own, rows - at + len(keys), scoring.impacts(tf, lengths[rows])))
            keys += batch.column(0).slice(at, to - at).to_pylist()
            size += int(bounds[to] - bounds[at])
            at = to
            if size >= SHARD_POSTINGS:
                yield shard(), keys
                keys, parts, size = [], [], 0
    if parts:
        yield shard(), keys


def _blocks(spark: SparkSession, weighted: DataFrame) -> Iterator[dict]:
    """Items with their terms and weights, in blocks of about ``BLOCK_TERMS`` terms, one at a time."""
    per_item = weighted.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("terms"), F.count("*").alias("n"))
    rows, size = {}, 0
    for row in per_item.toLocalIterator():
        terms = np.array([t.term for t in row.terms], np.int64)
        rows[row.item] = terms, np.array([t.weight for t in row.terms], np.int64)
        size += len(terms)
        if size >= BLOCK_TERMS:
            yield rows
            rows, size = {}, 0
    if rows:
        yield rows


def _ranked_block(counted: DataFrame, block: dict, scoring: Scoring, k: int, kinds: str) -> DataFrame:
    shared = counted.sparkSession.sparkContext.broadcast((block, scoring))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rules = shared.value
        known = np.unique(np.concatenate([t for t, _ in items.values()]))
        best = {item: _Best(k) for item in items}
        for shard, keys in _shards(batches, rules, known):
            for item, (terms, weights) in items.items():
                docs, scores, _ = shard.top(terms, weights, k, best[item].floor)
                if len(docs):
                    best[item].add(scores.tolist(), [keys[d] for d in docs.tolist()])
        found = [(item, key, score) for item, own in best.items() for score, key in own.found]
        for at in range(0, len(found), 10_000):
            part = list(zip(*found[at:at + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], item_kind), pa.array(part[1], doc_kind), pa.array(part[2], pa.int64())], ["item", "doc", "score"]
            )

    item_kind, doc_kind = (to_arrow_type(f.dataType) for f in StructType.fromDDL(kinds).fields[:2])
    return counted.mapInArrow(run, kinds)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", item: str = "item_id", text: str = "text", item_text: str = "text"
) -> DataFrame:
    """The k highest-scoring rows of ``docs`` above 0 for each item: item, rank (from 1), key, score.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with only A-Z lower-cased. Equal scores
    go by ascending key, a null key last; each row of ``docs`` is a document of its own, also where
    keys repeat. A null or empty text has no terms and is never found. Rows of ``items`` with the same id (or
    with a null id) are one item. Without documents or items the result is empty. Other columns play no part.
    """
    spark = docs.sparkSession
    asked = written(item_terms(items, item, item_text), "item-terms")
    counted = written(_counted(docs, key, text, _bit_map(asked.select("term").distinct())), "term-counts")
    total = counted.filter("n_terms > 0").agg(F.count("*").alias("n"), F.sum("n_terms").alias("l")).first()
    scoring = Scoring(total.n, total.l or 0)
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighted = written(asked.join(held, "term").select("item", "term", scoring.weight(F.col("df")).alias("weight")), "term-weights")
    kinds = f"item {items.schema[item].dataType.simpleString()}, doc {docs.schema[key].dataType.simpleString()}, score long"
    parts = [written(_ranked_block(counted, block, scoring, k, kinds), "ranked") for block in _blocks(spark, weighted)]
    if not parts:
        parts = [spark.createDataFrame([], kinds)]
    found = parts[0]
    for part in parts[1:]:  # items of different blocks
        found = found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    placed = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return placed.select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")
