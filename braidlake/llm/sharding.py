"""Sharding by a minimax contiguous partition.

Law ``bytes``: shards get near equal numbers of bytes, and equal texts stay together. Groups of equal texts are
ordered by a hash of 64 bits. The smallest feasible capacity is found by binary search: a capacity is feasible if
filling shards greedily, in order, needs no more than there are. The cuts are then made where greedy filling at that
capacity allows, each as near as may be to an even share of what is left.

The driver holds blocks of consecutive groups and their sizes, at first one for each value of the hash's leading
``CELL_BITS`` bits. Two capacities bound the least one over single groups: that over whole blocks, and that over
blocks that may be cut anywhere. While they differ, the blocks in which cuts may fall are split by the next
``FINER`` bits, down to single groups, so that the capacity is exact. A round adds some thousands of blocks,
whatever the number of documents. Slots are ranks within a shard, counted apart in each partition.

Size: bytes of the text and 16. Defined cases: a null text has no bytes, crc32 0 and a group with other nulls. Very
long texts are a group as any other. Repeated rows each have a slot. With fewer groups than shards the last shards stay
empty. An empty table gives an empty result. Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.runtime import materialize

from .common import columns_of, ranked

SHARDS = 40
CELL_BITS = 16
#: By how many bits of the hash a block is split.
FINER = 6
OVERHEAD = 16


def feasible(prefix: np.ndarray, shards: int, capacity: int) -> bool:
    """Whether greedy filling needs at most ``shards`` shards. prefix: sums of the groups so far, from 0."""
    at = 0
    for _ in range(shards):
        at = int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1
        if at == len(prefix) - 1:
            return True
    return False


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """Binary search for the least capacity with which the groups fit, in order."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    low, high = max(int(sizes.max(initial=0)), -(-int(prefix[-1]) // shards)), int(prefix[-1])
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(prefix, shards, middle) else (middle + 1, high)
    return low


def cuts(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard begins, and the end: shards + 1 indexes into the groups. No shard exceeds the least capacity."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    end, capacity = len(sizes), smallest_capacity(sizes, shards)
    # the earliest begin of each shard from which the rest still fits: greedy filling from the end
    earliest = [end]
    for _ in range(shards):
        earliest.append(int(np.searchsorted(prefix, prefix[earliest[-1]] - capacity, side="left")))
    earliest = earliest[::-1]
    out = [0]
    for k in range(1, shards):
        at = out[-1]
        latest = int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1
        # an even share of what is left; a group larger than that takes a shard, and the rest still share evenly
        even = prefix[at] + (prefix[-1] - prefix[at]) / (shards - k + 1)
        near = int(np.searchsorted(prefix, even, side="left"))
        if near > 0 and even - prefix[near - 1] <= prefix[min(near, end)] - even:
            near -= 1
        out.append(min(max(near, earliest[k], at + 1), latest, end))
    return np.array([*out, end])


def reach(sizes: np.ndarray, whole: np.ndarray, shards: int, capacity: int) -> np.ndarray:
    """Where greedy shards end if blocks that aren't ``whole`` may be cut anywhere."""
    prefix, at, out = np.concatenate([[0], np.cumsum(sizes)]), 0, []
    for _ in range(shards):
        at = min(at + capacity, int(prefix[-1]))
        block = int(np.searchsorted(prefix, at, side="right")) - 1
        if block < len(sizes) and whole[block]:
            at = int(prefix[block])
        out.append(at)
    return np.array(out)


def least_reach(sizes: np.ndarray, whole: np.ndarray, shards: int, most: int) -> int:
    """The least capacity at which ``reach`` comes to the end."""
    total = int(sizes.sum())
    low, high = -(-total // shards), most
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if reach(sizes, whole, shards, middle)[-1] >= total else (middle + 1, high)
    return low


def to_split(sizes: np.ndarray, whole: np.ndarray, shards: int) -> np.ndarray:
    """The blocks in which a cut at the least capacity may fall; none if that is known."""
    high = smallest_capacity(sizes, shards)
    low = least_reach(sizes, whole, shards, high)
    if low == high:
        return np.zeros(0, np.int64)
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    earliest = reach(sizes, np.ones(len(sizes), bool), shards, low)
    latest = reach(sizes, whole, shards, high)
    first, last = np.searchsorted(prefix, earliest, side="right") - 1, np.searchsorted(prefix, latest, side="left")
    touched = np.zeros(len(sizes) + 1, np.int64)
    np.add.at(touched, np.minimum(first, len(sizes)), 1)
    np.add.at(touched, np.clip(last, first, len(sizes)), -1)
    return np.flatnonzero((np.cumsum(touched[:-1]) > 0) & ~whole)


#: Blocks at the driver: first hash they may hold, bits they share, bytes, and whether they are a single group.
KIND = [("start", np.int64), ("depth", np.int64), ("bytes", np.int64), ("whole", bool)]


def counted(rows: DataFrame, depth: int) -> np.ndarray:
    """Blocks of the hashes that share their first ``depth`` bits."""
    start = F.col("hash") if depth >= 64 else F.shiftleft(F.shiftright("hash", 64 - depth), 64 - depth)
    found = rows.groupBy(start.alias("start")).agg(F.sum("size").alias("bytes"), (F.min("hash") == F.max("hash")).alias("whole"))
    return np.array([(r.start, depth, r.bytes, r.whole) for r in found.collect()], KIND)


def blocks_of(rows: DataFrame, shards: int) -> np.ndarray:
    """Blocks in order, fine enough that their minimax is the groups'. rows: hash and size."""
    spark, blocks = rows.sparkSession, np.sort(counted(rows, CELL_BITS), order="start")
    while len(at := to_split(blocks["bytes"], blocks["whole"], shards)):
        finer = [np.delete(blocks, at)]
        for depth in np.unique(blocks["depth"][at]).tolist():
            chosen = blocks["start"][at][blocks["depth"][at] == depth].tolist()
            named = spark.createDataFrame([(x,) for x in chosen], "first long")
            own = rows.join(F.broadcast(named), F.shiftleft(F.shiftright("hash", 64 - depth), 64 - depth) == F.col("first"))
            finer.append(counted(own, min(64, depth + FINER)))
        blocks = np.sort(np.concatenate(finer), order="start")
    return blocks


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of every document."""
    text = F.col("text")
    rows = columns_of(docs, doc_id="long", text="string").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        # a null text has the hash of its own that Spark gives it
        F.xxhash64(text.isNull(), text).alias("hash"),
        F.monotonically_increasing_id().alias("mid"),
    )
    rows = materialize(rows, "sizes")
    blocks = blocks_of(rows.select("hash", "size"), shards)
    begins = cuts(blocks["bytes"], shards)
    # a hash's shard is the number of shards that begin at it or before, but for the first
    firsts = [int(blocks["start"][b]) for b in begins[1:-1] if b < len(blocks)]
    placed = rows.withColumn("shard", sum(((F.col("hash") >= x).cast("int") for x in firsts), F.lit(0)))
    return ranked(placed, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
