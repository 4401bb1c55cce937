"""Exact near-duplicate search over embeddings: a metric range join over pivot cells.

The metric is the angle between vectors; two vectors link if their cosine is at least 0.95, that
is, if their angle is within a radius r. Every vector is at home in the cell of its nearest pivot.
By the triangle inequality a vector x can be within r of a vector at home in cell c only if its
angle to pivot c is at most 2 r more than the angle to its own pivot, and at most r more than the
cell's radius; it is replicated to just these cells. Each cell then joins its home vectors with
its members by itself, so each vector's links are counted once, in its home cell.

The number of pivots grows with the root of the number of vectors, at every size.

A cell of any size is cut into blocks: a task compares at most about `HOME` home vectors with
`MEMBERS` members, strip by strip, and returns counts and a forest, never the pairs. Both sides
are sorted by their angle to the pivot; a strip meets only members whose angle lies within r of
its own angles, by the triangle inequality again. Equal
vectors are one node with a weight. Products in single precision only sort out pairs that are
clearly apart; those near the bound are computed in double precision.

Vectors of each length are joined by themselves, one length after the other; vectors of different
length do not link.

Edge cases: vectors that are null, zero, or hold null or non-finite components link with nothing;
equal rows count as vectors of their own; a null vec_id names no component; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship_code, stored
from tidemart.llm.components import connected_components

COSINE = 0.95
REACH = math.acos(COSINE)
HOME, MEMBERS = 4096, 8192
PER_ROOT = 16  # the root of the number of vectors, divided by this, gives the pivots
STRIP = 256
_SLACK = 1e-6


def pivot_count(rows: int) -> int:
    return min(rows, 1 + math.ceil(math.sqrt(rows) / PER_ROOT))


def matrix(column) -> np.ndarray:
    """Unit vectors in double precision from an Arrow column of equally long lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def nodes(vectors: DataFrame) -> DataFrame:
    """node, vec, copies: the distinct vectors that can have links."""
    v = F.col("vec")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = vectors.where(v.isNotNull() & (F.size(v) > 0) & sound & F.exists(v, lambda x: x != 0))
    return some.groupBy("vec").agg(F.count(F.lit(1)).alias("copies")).select(
        F.monotonically_increasing_id().alias("node"), "vec", "copies")


def _angles(column, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(matrix(column) @ pivots.T, -1.0, 1.0))


def _radii(pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.full(len(pivots), -1.0)
        count = np.zeros(len(pivots), np.int64)
        for batch in batches:
            if batch.num_rows:
                angles = _angles(batch.column("vec"), pivots)
                home = angles.argmin(axis=1)
                np.maximum.at(most, home, angles.min(axis=1))
                count += np.bincount(home, minlength=len(pivots))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(pivots), dtype=np.int32)), pa.array(most), pa.array(count)],
            names=["cell", "radius", "n"])

    return run


def _replicate(pivots, radii, reach=REACH):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angles = _angles(batch.column("vec"), pivots)
            home = angles.argmin(axis=1)
            own = angles.min(axis=1, keepdims=True)
            inside = (angles <= own + 2 * reach + _SLACK) & (angles <= radii + reach + _SLACK)
            inside[np.arange(len(home)), home] = True
            row, cell = np.nonzero(inside)
            ends = np.searchsorted(row, np.arange(len(home) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("vec"), batch.column("copies"),
                 pa.array(home.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                          pa.array(cell.astype(np.int32)))],
                names=["node", "vec", "copies", "home", "cells"])

    return run


def reached(strip: np.ndarray, others: np.ndarray) -> tuple[int, int]:
    """Range of the sorted angles `others` within the reach of the sorted angles `strip`."""
    return (int(np.searchsorted(others, strip[0] - REACH - _SLACK)),
            int(np.searchsorted(others, strip[-1] + REACH + _SLACK, "right")))


def links_of(home, members, home_angles, member_angles) -> np.ndarray:
    """Boolean matrix of the pairs with a cosine of COSINE or more, in double precision; both
    sides are sorted by their angles to the pivot."""
    out = np.zeros((len(home), len(members)), bool)
    short = members.astype(np.float32).T.copy()
    for at in range(0, len(home), STRIP):
        strip = home[at:at + STRIP]
        low, high = reached(home_angles[at:at + STRIP], member_angles)
        near = strip.astype(np.float32) @ short[:, low:high]
        hit = near >= COSINE - 1e-4
        if hit.any():
            row, col = np.nonzero(hit & (near < COSINE + 1e-4))
            for k in range(0, len(row), 65536):
                r, c = row[k:k + 65536], col[k:k + 65536]
                hit[r, c] = np.einsum("ij,ij->i", strip[r], members[low + c]) >= COSINE
            out[at:at + STRIP, low:high] = hit
    return out


def forest(linked: np.ndarray, home: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Edges (node, smallest node of its part) over all linked rows and columns."""
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return np.empty((0, 2), np.int64)
    part = linked[np.ix_(rows, cols)]
    left, right = home[rows].copy(), members[cols].copy()
    big = np.iinfo(np.int64).max
    while True:
        before = left.sum(dtype=object), right.sum(dtype=object)
        for at in range(0, len(rows), 256):
            strip = part[at:at + 256]
            left[at:at + 256] = np.minimum(
                left[at:at + 256], np.where(strip, right, big).min(axis=1))
            np.minimum(right, np.where(strip, left[at:at + 256, None], big).min(axis=0),
                       out=right)
        if (left.sum(dtype=object), right.sum(dtype=object)) == before:
            break
    return np.concatenate((np.stack((home[rows], left), 1), np.stack((members[cols], right), 1)))


def _block(pivots: np.ndarray):
    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        node = group.column("node").to_numpy()
        copies = group.column("copies").to_numpy()
        out = np.empty((0, 3), np.int64)
        if len(np.unique(side)) == 2:
            unit = matrix(group.column("vec"))
            pivot = pivots[group.column("cell")[0].as_py()]
            angle = np.arccos(np.clip(unit @ pivot, -1.0, 1.0))
            order = np.argsort(angle, kind="stable")
            own, other = order[side[order] == 0], order[side[order] == 1]
            linked = links_of(unit[own], unit[other], angle[own], angle[other])
            linked &= node[own][:, None] != node[other][None, :]
            counts = linked @ copies[other].astype(np.float64)
            some = np.flatnonzero(counts)
            edges = forest(linked, node[own], node[other])
            out = np.concatenate((
                np.stack((node[own][some], node[own][some], counts[some].astype(np.int64)), 1),
                np.column_stack((edges, np.zeros(len(edges), np.int64)))))
        return pa.table({"a": out[:, 0], "b": out[:, 1], "n": out[:, 2]})

    return run


def cell_links(points: DataFrame) -> DataFrame:
    """Rows (a, a, n): node a has n linked vectors in one block; and (a, b, 0): forest edges."""
    rows = points.count()
    sample = points.orderBy(F.xxhash64("vec"), "node").limit(
        pivot_count(rows)).select("vec").toArrow()
    schema = "a long, b long, n long"
    if not rows:
        return points.sparkSession.createDataFrame([], schema)
    pivots = matrix(sample.column("vec"))  # pivot_count(rows) vectors
    kind = points.schema["vec"].dataType.simpleString()
    cells = points.mapInArrow(_radii(pivots), "cell int, radius double, n long").groupBy(
        "cell").agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).collect()
    radii, homes = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    for c in cells:
        radii[c["cell"]], homes[c["cell"]] = c["radius"], c["n"]
    radii[radii < 0] = -10.0  # an empty cell needs no members
    spread = stored(points.mapInArrow(
        _replicate(pivots, radii),
        f"node long, vec {kind}, copies long, home int, cells array<int>"), "cells")
    members = np.zeros(len(pivots), np.int64)
    for r in spread.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():
        members[r["cell"]] = r["count"]
    # As many rows as pivots.
    blocks = F.broadcast(points.sparkSession.createDataFrame(
        [(c, max(1, -(-int(homes[c]) // HOME)), max(1, -(-int(members[c]) // MEMBERS)))
         for c in range(len(pivots))], "cell int, homes int, others int"))

    def dealt(rows: DataFrame, side: int, mine: str, theirs: str) -> DataFrame:
        """Each row in one block of its side, against every block of the other side."""
        some = F.pmod(F.xxhash64("node"), F.col(f"{mine}s")).cast("int").alias(mine)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{theirs}s") - 1)).alias(theirs)
        return rows.join(blocks, "cell").select(
            F.lit(side).alias("side"), "node", "vec", "copies", "cell", some, every)

    own = dealt(spread.select("node", "vec", "copies", F.col("home").alias("cell")),
                0, "home", "other")
    other = dealt(spread.select("node", "vec", "copies", F.explode("cells").alias("cell")),
                  1, "other", "home")
    return own.unionByName(other).groupBy("cell", "home", "other").applyInArrow(
        _block(pivots), schema)


def links(points: DataFrame) -> DataFrame:
    """`cell_links` of the vectors of each length that two of them or more have."""
    lengths = points.groupBy(F.size("vec").alias("dims")).count().where("count > 1").collect()
    found = points.sparkSession.createDataFrame([], "a long, b long, n long")
    for r in sorted(lengths):
        found = found.union(stored(cell_links(points.where(F.size("vec") == r["dims"])), "links"))
    return found


def near_vectors(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable by links), kept of every row."""
    ship_code(table.sparkSession)
    vectors = table.select("vec_id", F.col("embedding").alias("vec"))
    points = stored(nodes(vectors), "nodes")
    found = links(points)
    counts = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    groups = connected_components(found.where("n = 0").select("a", "b"))
    marks = stored(points.join(groups, "node", "left").join(
        counts, F.col("node") == F.col("a"), "left").select(
        "vec", F.coalesce("component", "node").alias("label"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("links")), "marks")
    labelled = stored(vectors.join(marks, "vec", "left").select("vec_id", "label", "links"),
                      "labelled")
    names = labelled.where("label is not null").groupBy("label").agg(
        F.min("vec_id").alias("name"))
    out = labelled.join(names, "label", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("label").isNull(), F.col("vec_id")).otherwise(F.col("name"))
        .alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
