"""N-gram Jaccard join: near-duplicate texts by their sets of five-word shingles.

A text's set is ordered rare-first: by a frequency sketch counted over all texts, then by hash.
Two sets of similarity 4/5 or more share a shingle within their first n - ceil(4n/5) + 1 ones, so
only these prefixes are posted and joined on their n-grams. A posting carries the set size and
the place in the prefix; at the first shared shingle of a similar pair, what is left of either
set must still be able to hold the needed overlap (positional filter, which implies the length
filter). Before the exact test, counts of both sets by hash range bound their overlap (suffix
filter). Every candidate pair is verified once, on the sets of the whole texts.

Not all pairs of a large group of copies are made. Equal sets are one node. The first join links
each list only with its pivot, the node with the fewest rarer shingles, which is the copy with
the fewest edits; the verified links are contracted, and the second join makes the pairs of a
list whose nodes lie in different components so far. A pair
left out is thus a pair whose nodes are linked already; components are exact.

Edge cases: a null text, or one without words, has an empty set and is linked with nothing; a
text of one to four words has one shingle; equal rows are one node and all are returned; a null
doc_id is never a component's name unless all its ids are null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemart.llm.common import ship_code, sized_ids, stored
from tidemart.llm.components import connected_components
from tidemart.llm.words import U64, mix, slices, utf8, word_hashes

SHINGLE_WORDS = 5
SKETCH_BITS = 20  # counters of the frequency sketch: 4 MB, whatever the corpus
SLICES = 256
_STEP = U64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, hashes, bounds in word_hashes(texts):
        rolled = np.zeros(max(0, len(hashes) - SHINGLE_WORDS + 1), U64)
        for k in range(SHINGLE_WORDS if len(rolled) else 0):
            rolled = rolled * _STEP + hashes[k:len(hashes) - SHINGLE_WORDS + 1 + k]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= SHINGLE_WORDS:
                yield np.unique(rolled[a:b - SHINGLE_WORDS + 1])
            elif b > a:
                whole = np.array([b - a], U64)
                for h in hashes[a:b]:
                    whole = whole * _STEP + h
                yield mix(whole)
            else:
                yield np.empty(0, U64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in slices(batches):
        sets = list(shingle_sets(utf8(batch.column("text"))))
        at, n = np.unique(np.concatenate(sets) & U64((1 << SKETCH_BITS) - 1), return_counts=True)
        counts[at.astype(np.int64)] += n.astype(np.uint32)
    if counts.any():
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()),
             pa.array([c.tobytes() for c in np.split(counts, SLICES)], pa.binary())],
            names=["slice", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, c in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(),
                        strict=True):
            own = np.frombuffer(c, np.uint32).astype(np.uint64)
            sums[s] = sums[s] + own if s in sums else own
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.minimum(c, U64(0xFFFFFFFF)).astype(np.uint32).tobytes()
                       for c in sums.values()], pa.binary())], names=["slice", "counts"])


def frequency_sketch(docs: DataFrame) -> np.ndarray:
    """Counts of all texts' shingles by hash bucket: a fixed number of counters."""
    spec = "slice int, counts binary"
    parts = docs.select("text").mapInArrow(_count, spec)
    sketch = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.uint32)
    for row in parts.repartition(64, "slice").mapInArrow(_add, spec).collect():
        sketch[row["slice"]] = np.frombuffer(row["counts"], np.uint32)
    return sketch.reshape(-1)


def prefix_length(n):
    """How many of n rare-first shingles must be posted: n - ceil(4n/5) + 1."""
    return n - (4 * n + 4) // 5 + 1


def _prefixer(sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for part in slices(batches):
            texts = utf8(part.column("text"))
            sizes, nodes, tokens = [], [], []
            for own in shingle_sets(texts):
                sizes.append(len(own))
                nodes.append(int.from_bytes(hashlib.blake2b(
                    own.tobytes(), digest_size=8).digest(), "little", signed=True)
                    if len(own) else None)
                seen = sketch.value[(own & U64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                rare = np.lexsort((own, seen))[:prefix_length(len(own)) if len(own) else 0]
                tokens.append(own[rare])
            ends = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
            flat = np.concatenate(tokens).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("body_key"), pa.array(sizes, pa.int32()),
                pa.array(nodes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                pa.array([pack.compress(t) if n else None
                          for t, n in zip(texts, sizes, strict=True)], pa.binary()),
            ], names=["doc_id", "body_key", "n", "node", "tokens", "body"])

    return run


def text_key(docs: DataFrame) -> Column:
    """Tells the texts of rows with one doc_id apart."""
    return F.xxhash64(docs["text"].cast("string"))


def prefixed(docs: DataFrame) -> DataFrame:
    """doc_id, body_key (hash of the text), n (set size), node (hash of the set), tokens (prefix),
    body (packed text)."""
    texts = docs.select("doc_id", text_key(docs).alias("body_key"),
                        F.col("text").cast("string").alias("text"))
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(texts))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        _prefixer(sketch),
        f"doc_id {kind}, body_key long, n int, node long, tokens array<long>, body binary")


def shared_lists(sets: DataFrame) -> DataFrame:
    """Postings (token, node, n, pos) of tokens with two nodes or more, each with the pivot."""
    nodes = sets.where("node is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    posted = nodes.select("node", "n", F.posexplode("tokens").alias("pos", "token"))
    by_place = Window.partitionBy("token").orderBy("pos", "node")
    return posted.select(
        "*", F.lag("node").over(by_place).alias("before"),
        F.lead("node").over(by_place).alias("after"),
        F.first(F.struct("node", "n", "pos")).over(by_place).alias("pivot"),
    ).where("before is not null or after is not null").drop("before", "after")


def may_match(n1: Column, pos1: Column, n2: Column, pos2: Column) -> Column:
    """Positional and length filter: overlap o suffices iff 9 o >= 4 (n1 + n2)."""
    return 9 * F.least(n1 - pos1, n2 - pos2) >= 4 * (n1 + n2)


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            bodies = dict(zip(a + b, part.column("body_a").to_pylist()
                              + part.column("body_b").to_pylist(), strict=True))
            held = {k: v for k, v in held.items() if k in bodies}
            new = [k for k in bodies if k not in held]
            for k, own in zip(new, shingle_sets([unpack.decompress(bodies[k]) for k in new]),
                              strict=True):
                held[k] = own, np.bincount((own >> U64(58)).astype(np.int64), minlength=64)
            keep = []
            for x, y in zip(a, b, strict=True):
                (sx, cx), (sy, cy) = held[x], held[y]
                need = 4 * (len(sx) + len(sy))
                fits = 9 * int(np.minimum(cx, cy).sum()) >= need
                keep.append(fits and 9 * len(np.intersect1d(sx, sy, assume_unique=True)) >= need)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"]).filter(pa.array(keep))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The written `pairs` (a, b) whose whole sets have a similarity of 4/5 or more."""
    ids = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ids")
    bodies = stored(sets.select("node", "body").join(sized_ids(ids), "node", "left_semi")
                    .groupBy("node").agg(F.first("body").alias("body")), "bodies")
    left = bodies.select(F.col("node").alias("a"), F.col("body").alias("body_a"))
    right = bodies.select(F.col("node").alias("b"), F.col("body").alias("body_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "body_a", "body_b")
    return both.mapInArrow(_check, "a long, b long")


def star_pairs(lists: DataFrame) -> DataFrame:
    p = F.col("pivot")
    return lists.where(F.col("node") != p["node"]).where(
        may_match(p["n"], p["pos"], F.col("n"), F.col("pos"))).select(
        F.least(p["node"], "node").alias("a"), F.greatest(p["node"], "node").alias("b")).distinct()


def rest_pairs(lists: DataFrame, stars: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of a list whose nodes lie in different components, without those tested before.

    One side leaves out the list's largest component, so a large group meets only the others.
    """
    tagged = stored(lists.drop("pivot").join(groups, "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("component", "node").alias("part")), "tagged")
    split = (tagged.groupBy("token", "part").agg(F.count(F.lit(1)).alias("size"))
             .groupBy("token").agg(F.count(F.lit(1)).alias("parts"),
                                   F.max_by("part", F.struct("size", "part")).alias("main"))
             .where("parts > 1").select("token", "main"))
    live = stored(tagged.join(split, "token"), "live")
    x, y = live.where("part <> main").alias("x"), live.drop("main").alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token"))
                 & ((F.col("y.part") == F.col("x.main")) | (F.col("x.part") < F.col("y.part")))
                 & may_match(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos")))
    return (met.select(F.least("x.node", "y.node").alias("a"),
                       F.greatest("x.node", "y.node").alias("b")).distinct()
            .join(stars, ["a", "b"], "left_anti"))


def _labelled(docs: DataFrame) -> DataFrame:
    """doc_id, body_key, n_shingles, label (of the component; null without words) of every row."""
    ship_code(docs.sparkSession)
    sets = stored(prefixed(docs), "sets")
    lists = stored(shared_lists(sets), "lists")
    stars = stored(star_pairs(lists), "stars")
    links = stored(verified(stars, sets), "links")
    rest = stored(rest_pairs(lists, stars, connected_components(links)), "rest")
    links = links.union(stored(verified(rest, sets), "links"))
    groups = connected_components(links)
    return stored(sets.select("doc_id", "body_key", "n", "node").join(
        groups, "node", "left").select(
        "doc_id", "body_key", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "node").alias("label")), "labelled")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    labelled = _labelled(docs)
    names = labelled.where("label is not null").groupBy("label").agg(
        F.min("doc_id").alias("name"))
    return labelled.join(names, "label", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("name"))
        .alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each group: the one with the smallest doc_id.

    Rows are told apart by doc_id and text: of a doc_id with several texts, only those that have
    a near copy kept elsewhere go. Of equal rows one stays; rows without a doc_id all stay.
    """
    found = _labelled(docs).where("doc_id is not null")
    kept = found.where("label is not null").groupBy("label").agg(
        F.min(F.struct("doc_id", "body_key")).alias("kept"))
    extra = stored(found.join(kept, "label").where(
        F.struct("doc_id", "body_key") != F.col("kept")).select(
        F.col("doc_id").alias("extra_id"), F.col("body_key").alias("extra_key")).distinct(),
        "extra")
    ids = sized_ids(extra)
    left = docs.join(ids, (docs["doc_id"] == ids["extra_id"])
                     & (text_key(docs) == ids["extra_key"]), "left_anti")
    if found.groupBy("doc_id", "body_key").count().where("count > 1").isEmpty():
        return left
    return left.where("doc_id is null").unionByName(
        left.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))
