"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

In a uniform permutation of all rows, the number of rows that go from source partition i to
target j follows the multivariate hypergeometric law. Here each source partition draws its own
row of that matrix by walking down a binary tree over the partitions: every node splits its
targets' room between its halves with generators seeded by the node, so that all tasks agree and
no task or driver ever holds the matrix. The partition then deals its rows out by a local
permutation, the rows are exchanged once, and each target permutes again.

Targets are blocks of a shard, of at most `block_rows` rows, so a task sorts one block at most.
Shard sizes differ by one row at most (law `rows`). Source partitions and places are written
before the draw, so that a lost executor recomputes the same result.

Edge cases: equal rows and null columns are dealt out like any others; an empty table gives no
rows; the names of other columns are free except for `shard` and `slot`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import scratch, ship_code, stored

NUMPY_LIMIT = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Exact counts for populations of any size (numpy's sampler ends at 10^9).

    Larger ones use the ratio-of-uniforms rejection with its published constants.
    """
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    size, small, large = good + bad, min(good, bad), max(good, bad)
    m = min(draws, size - draws)
    share = small / size
    centre = m * share + 0.5
    spread = math.sqrt((size - m) * draws * share * (1 - share) / (size - 1) + 0.5)
    width = 1.7155277699214135 * spread + 0.8989161620588988

    def weight(k: int) -> float:
        return sum(math.lgamma(x + 1) for x in (k, small - k, m - k, large - m + k))

    peak = weight(math.floor((m + 1) * (small + 1) / (size + 2)))
    top = min(min(m, small) + 1, math.floor(centre + 16 * spread))
    while True:
        x, y = 1.0 - rng.random(), rng.random()
        at = centre + width * (y - 0.5) / x
        if not 0 <= at < top:
            continue
        k = math.floor(at)
        if 2 * math.log(x) <= peak - weight(k):
            break
    k = m - k if good > bad else k
    return good - k if m < draws else k


def split_room(rng: np.random.Generator, room: np.ndarray, draws: int) -> np.ndarray:
    """How many of `draws` rows go to each target, given the targets' free places."""
    left, out = int(room.sum()), np.zeros(len(room), np.int64)
    for j, free in enumerate(room.tolist()):
        if draws == 0:
            break
        out[j] = hypergeometric(rng, free, left - free, draws)
        left -= free
        draws -= int(out[j])
    return out


def matrix_row(seed: int, ends: np.ndarray, sizes: np.ndarray, part: int) -> np.ndarray:
    """Row `part` of the matrix; `ends` are running row counts, `sizes` the targets' rows."""
    low, high, room = 0, len(ends) - 1, sizes
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, 1, low, high])
        first = split_room(rng, room, int(ends[middle] - ends[low]))
        if part < middle:
            high, room = middle, first
        else:
            low, room = middle, room - first
    return room


def targets(rows: int, shards: int, block_rows: int) -> list[tuple[int, int, int]]:
    """(shard, first slot, rows) of every block."""
    out = []
    for shard in range(shards):
        size = rows // shards + (shard < rows % shards)
        blocks = max(1, -(-size // block_rows))
        starts = [size * b // blocks for b in range(blocks + 1)]
        out += [(shard, a, b - a) for a, b in zip(starts, starts[1:], strict=False)]
    return out


def shuffle_into_shards(df: DataFrame, shards: int = 40, seed: int = 7,
                        block_rows: int = 200_000) -> DataFrame:
    """`df` with shard (0 to shards - 1) and slot (0 and up, without gaps, in each shard)."""
    ship_code(df.sparkSession)
    names = df.columns
    low33 = F.lit((1 << 33) - 1)
    placed = stored(df.select(
        F.struct(*names).alias("row"), F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(low33).alias("place")), "placed")
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(
        (F.max("place") + 1).alias("n")).collect()}  # one number per source partition
    parts = sorted(counts)
    ends = np.concatenate(([0], np.cumsum([counts[p] for p in parts], dtype=np.int64)))
    blocks = targets(int(ends[-1]), shards, block_rows)
    sizes = np.array([b[2] for b in blocks], np.int64)
    shard_of = np.array([b[0] for b in blocks], np.int32)
    first_of = np.array([b[1] for b in blocks], np.int64)
    index = {p: i for i, p in enumerate(parts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def drawn(part: int):
            if part not in held:
                held.clear()
                at = index[part]
                row = matrix_row(seed, ends, sizes, at)
                rng = np.random.default_rng([seed, 2, at])
                to = np.repeat(np.arange(len(row), dtype=np.int64), row)
                held[part] = rng.permutation(to), rng.integers(0, 1 << 62, len(to))
            return held[part]

        for batch in batches:
            part = batch.column("part").to_numpy()
            place = batch.column("place").to_numpy()
            block = np.empty(len(part), np.int64)
            order = np.empty(len(part), np.int64)
            for p in np.unique(part):
                to, keys = drawn(int(p))
                own = part == p
                block[own], order[own] = to[place[own]], keys[place[own]]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(part), pa.array(block), pa.array(order),
                pa.array(shard_of[block]), pa.array(first_of[block]),
            ], names=["row", "part", "block", "order", "shard", "first"])

    schema = T.StructType([
        placed.schema["row"], placed.schema["part"], T.StructField("block", T.LongType()),
        T.StructField("order", T.LongType()), T.StructField("shard", T.IntegerType()),
        T.StructField("first", T.LongType())])
    within = Window.partitionBy("block").orderBy("order", "part")
    slot = F.col("first") + F.row_number().over(within) - 1
    return placed.mapInArrow(deal, schema).select("row", "shard", slot.alias("slot")).select(
        "row.*", "shard", "slot")


def write_shards(df: DataFrame, path: str | None = None, shards: int = 40,
                 seed: int = 7) -> str:
    """Write whole rows, one folder per shard, in slot order within each file."""
    path = path or scratch(df.sparkSession, "shards")
    dealt = shuffle_into_shards(df, shards, seed)
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
