"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` places. Every shard owns ``points`` of them (its virtual
nodes); a row's key hashes to a place and belongs to the first virtual node
clockwise. A shard takes at most its capacity; rows that meet a full shard continue
clockwise to the next virtual node whose shard has room. Capacities are the row
count shared out to within one row, so shards differ by one row at most.

Which rows overflow depends only on how many rows each place has. These counts (one for
each cell and lane: a fixed number, whatever the data) are all the driver sees; it
walks the ring once and gives each run of rows of a cell its shard. Rows then find
their run by their number within the cell and lane. Lanes deal the rows of a cell out
by row number, so a key with very many rows is not numbered in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm.tables import written


@dataclass(frozen=True)
class Ring:
    shards: int = 24
    points: int = 64
    cells: int = 8192
    lanes: int = 8
    seed: int = 5

    def owners(self) -> np.ndarray:
        """The shard that owns each cell's place as a virtual node, or -1. A point whose place is
        taken moves on to the next free one; points of shard s do not depend on later shards."""
        owner = np.full(self.cells, -1)
        for shard in range(self.shards):
            for point in range(self.points):
                digest = hashlib.blake2b(f"{self.seed}/{shard}/{point}".encode(), digest_size=8).digest()
                place = int.from_bytes(digest, "little") % self.cells
                while owner[place] >= 0:
                    place = (place + 1) % self.cells
                owner[place] = shard
        return owner


def assign(counts: np.ndarray, ring: Ring) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (cell, lane, first, end, shard, slot) that place ``counts[cell, lane]`` rows of each cell and lane:
    rows numbered first .. end - 1 go to the shard, from the slot on."""
    owner = ring.owners()
    total = int(counts.sum())
    room = np.array([total // ring.shards + (s < total % ring.shards) for s in range(ring.shards)], np.int64)
    slot = np.zeros(ring.shards, np.int64)
    runs, overflow = [], []
    stops = np.flatnonzero(owner >= 0)

    def put(cell: int, lane: int, first: int, end: int, shard: int) -> int:
        n = int(min(end - first, room[shard]))
        if n:
            runs.append((cell, lane, first, first + n, int(shard), int(slot[shard])))
            room[shard] -= n
            slot[shard] += n
        return first + n

    for cell in range(ring.cells):
        at = int(np.searchsorted(stops, cell)) % len(stops)
        for lane in np.flatnonzero(counts[cell]):
            n = int(counts[cell, lane])
            first = put(cell, int(lane), 0, n, owner[stops[at]])
            if first < n:
                overflow.append((cell, int(lane), first, n, at))
    for cell, lane, first, n, at in overflow:
        while first < n:
            at = (at + 1) % len(stops)
            first = put(cell, lane, first, n, owner[stops[at]])
    return runs


def sharded(docs: DataFrame, ring: Ring = Ring()) -> DataFrame:
    """Rows of ``docs`` with shard (int) and slot (long, gapless from 0 in each shard).

    The key is doc_id; a null doc_id is a key. Repeated rows are rows of their own. Existing columns
    shard and slot are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(ring.seed)), F.lit(ring.cells)).cast("int")
    rows = written(
        docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_cell", place)
        .withColumn("_lane", F.pmod(F.xxhash64("_row"), F.lit(ring.lanes)).cast("int")), "ring",
    )
    counts = np.zeros((ring.cells, ring.lanes), np.int64)
    for found in rows.groupBy("_cell", "_lane").agg(F.count("*").alias("n")).toLocalIterator():
        counts[found._cell, found._lane] = found.n
    runs = spark.createDataFrame(
        assign(counts, ring), "_cell int, _lane int, _first long, _end long, shard int, _slot long"
    )
    number = F.row_number().over(Window.partitionBy("_cell", "_lane").orderBy("doc_id", "_row")) - 1
    # At most cells * lanes + overflow runs of some 40 bytes: fixed by the ring's parameters.
    joined = rows.withColumn("_number", number.cast("long")).join(F.broadcast(runs), ["_cell", "_lane"]).filter(
        (F.col("_number") >= F.col("_first")) & (F.col("_number") < F.col("_end"))
    )
    slot = F.col("_slot") + F.col("_number") - F.col("_first")
    return joined.withColumn("slot", slot).select(*docs.columns, "shard", "slot")
