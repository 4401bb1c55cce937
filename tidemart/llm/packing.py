"""Conflict-constrained best-fit packing of texts into windows of one length.

Texts longer than the window are cut into pieces. Pieces are taken by falling length; the open
bins are kept ordered by the room that is left and carry bitmaps of the sources and duplicate
clusters they hold. For a piece, the search starts at the bin with the least room that is enough
and goes on to the successors until one holds neither the piece's source nor its cluster; if none
does, a bin is opened. Each chunk of about `chunk_pieces` pieces, dealt by a hash of a written
row number, is packed by itself, so a task holds a bounded number of lengths and no text.

Lengths are UTF-8 bytes plus one end mark (byte-level tokens). Two pieces of one source, of one
cluster (equal texts) or of one text never share a bin.

Edge cases: a null or empty text has no piece and gets one row with length 0 and no bin; a null
source is a source of its own kind; equal rows are packed as texts of one cluster; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship_code, stored

WINDOW = 8192
CHUNK_PIECES = 4096


def best_fit(lengths: list[int], sources: list[int], clusters: list[int],
             window: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; `sources` and `clusters` are bitmaps with one bit or none."""
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    room: list[tuple[int, int]] = []  # (room left, bin), ordered
    held: list[list[int]] = []  # bitmaps of each bin
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        source, cluster = sources[i], clusters[i]
        for at in range(bisect_left(room, (lengths[i], -1)), len(room)):
            left, b = room[at]
            if not (held[b][0] & source or held[b][1] & cluster):
                del room[at]
                break
        else:
            left, b = window, len(held)
            held.append([0, 0])
        bins[i], offsets[i] = b, window - left
        held[b][0] |= source
        held[b][1] |= cluster
        insort(room, (left - lengths[i], b))
    return bins, offsets


def _bits(keys: pd.Series) -> list[int]:
    """One bit for each key that stands more than once, none for the others."""
    counts = keys.value_counts()
    places = {k: 1 << i for i, k in enumerate(sorted(counts[counts > 1].index))}
    return [places.get(k, 0) for k in keys]


def pieces(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """uid, doc_id, piece, start, length, source and cluster of every piece, written once."""
    text = F.col("text").cast("string")
    n = F.coalesce(F.octet_length(text), F.lit(0))
    full = F.when(n > 0, n + 1).otherwise(0)  # with the end mark
    cut = docs.select(
        "doc_id", F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("\0"))).alias("s"),
        F.xxhash64(text).alias("c"), full.alias("n"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / window).cast("int") - 1)
    each = cut.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return stored(each.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "piece",
        (F.col("piece").cast("long") * window).alias("start"),
        F.least(F.lit(window), F.col("n") - F.col("piece") * window).cast("long")
        .alias("length"), F.col("s").alias("source"), F.col("c").alias("cluster")), "pieces")


def pack(docs: DataFrame, window: int = WINDOW, chunk_pieces: int = CHUNK_PIECES) -> DataFrame:
    """doc_id, piece, start, length, source_key, cluster_key, bin_id, bin_offset per piece."""
    ship_code(docs.sparkSession)
    cut = pieces(docs, window)
    real = cut.where("length > 0")
    chunks = max(1, -(-real.count() // chunk_pieces))
    dealt = real.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(chunks)).cast("long"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid", ignore_index=True)
        bins, offsets = best_fit(frame["length"].tolist(), _bits(frame["source"]),
                                 _bits(frame["cluster"]), window)
        bin_ids = [(int(frame["chunk"].iloc[0]) << 32) + b for b in bins]
        return pd.DataFrame({"uid": frame["uid"], "bin_id": bin_ids, "bin_offset": offsets})

    placed = dealt.select("uid", "length", "source", "cluster", "chunk").groupBy(
        "chunk").applyInPandas(run, "uid long, bin_id long, bin_offset long")
    return cut.join(placed, "uid", "left").select(
        "doc_id", "piece", "start", "length", F.col("source").alias("source_key"),
        F.col("cluster").alias("cluster_key"), "bin_id", "bin_offset")
