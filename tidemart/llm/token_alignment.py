"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

Byte offsets where a token of A and a token of B both end cut a text into groups; each A token of
a group is linked with each of its B tokens. How many documents hold a pair of ids linked, and
which B ids are the most frequent partners of an A id, is counted outside memory:

1. Runs. Every task aligns its texts block by block and sorts the records (pair, document, times)
   of a block by radix part of the A id, then A id, B id and document. Each part is written as a
   run, compressed with zstd: its pairs with the number of documents in the block, and apart from
   them the documents of each pair.
2. Merge. The pairs of up to FAN runs of a part are merged at a time by a heap of their next A
   ids, adding the counts of equal pairs, in as many passes as the number of blocks needs. Only
   one number for each pair of a run takes part, so a pair that all documents hold costs one entry
   a block. In the last pass an A id's partners arrive together (side-major), which gives the
   highest count with the counts.
3. Back. The counts of a part meet its runs once more, and each run adds, for each of its
   documents, the counts of its links and how many of them are best. Parts with many bytes are
   dealt to several tasks, each of which gets the part's counts; so a frequent A id is split.

Text before a space that follows a letter, mark or digit always ends a token on both sides (no
match of A's pattern and no piece of B has a space inside), so texts are cut there and equal
stretches of a block are encoded and aligned once. A text with a stretch that B does not give
back byte by byte is encoded whole instead.

A is read as merge ranks. They give the ids of the vocabulary's JSON file, as every token is
reached from its own bytes by the merges (tested).

Edge cases: a null or empty text, or one that A or B changes, has no tokens: zeros and ''; equal
rows are documents of their own and are all returned; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.byte_bpe import load_ranks
from tidemart.llm.common import ship_code, stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = 64  # radix parts, by the lowest bits of the A id
BLOCK_BYTES = 4 << 20  # text of a block
BLOCK_DOCS = 1 << 16
FAN = 64  # runs merged at once
TASK_BYTES = 32 << 20  # compressed runs that a task of the last step gets
SLICE = 1 << 22  # links that are spread out at once
MARK = "▁"
_SPACED = re.compile(r"\s |^ ")
_CUT = re.compile(r"(?<=\S)(?= )")


class Sides:
    """Both vocabularies: encoders, and the bytes of every id."""

    def __init__(self, ranks: dict[bytes, int], model: bytes):
        self.ranks, self.model = ranks, model

    def __getstate__(self):
        return {"ranks": self.ranks, "model": self.model}

    @cached_property
    def _pieces(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def encode_a(self):
        import tiktoken

        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self._pieces.encode(texts, num_threads=1)

    @cached_property
    def bytes_a(self) -> list[bytes]:
        return [t for t, _ in sorted(self.ranks.items(), key=lambda x: x[1])]

    @cached_property
    def bytes_b(self) -> list[bytes]:
        model = self._pieces
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if model.is_byte(i)
                else p.replace(MARK, " ").encode() for i, p in enumerate(names)]

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """Texts of A ids before another A id and before B ids, of B ids inside and at the end."""
        def table(n, marks):
            return np.array([f"{i}{m}" for m in marks for i in range(n)], object)

        return table(len(self.bytes_a), ",|"), table(len(self.bytes_b), ",;")

    @cached_property
    def cuttable(self) -> bool:
        """No piece of B has a space inside, after something else."""
        return not any(re.search(rb"[^ ] ", t) for t in self.bytes_b)

    def stretches(self, text: str) -> list[str]:
        """The parts of space+text, each without its first space."""
        if not self.cuttable:
            return [text]
        if _SPACED.search(text):
            return [s[1:] for s in _CUT.split(f" {text}")]
        return text.split(" ")


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from starts[i] on, sizes[i] of them, for all i."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else \
        np.empty(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first) if len(first) else values[:0]


class Aligned:
    """Tokens, groups and linked pairs of many stretches of text."""

    def __init__(self, sides: Sides, texts: list[str]):
        a = [sides.encode_a(f" {t}") for t in texts]
        b = sides.encode_b(texts) if texts else []
        self.valid = np.array([
            (own := f" {t}".encode()) == b"".join(map(sides.bytes_b.__getitem__, y))
            and own == b"".join(map(sides.bytes_a.__getitem__, x))
            for t, x, y in zip(texts, a, b, strict=True)], bool)
        a = [x if ok else [] for x, ok in zip(a, self.valid, strict=True)]
        b = [x if ok else [] for x, ok in zip(b, self.valid, strict=True)]
        self.n_a, self.n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        ids_a, ids_b = (np.array([i for own in x for i in own], np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(sides.sizes[0][ids_a]), np.cumsum(sides.sizes[1][ids_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        first_a, first_b = _starts(in_a), _starts(in_b)
        text_of_a = np.repeat(np.arange(len(texts)), self.n_a)
        text_of = text_of_a[first_a[1:] - 1]  # of each group
        self.n_groups = np.bincount(text_of, minlength=len(texts))
        self.n_links = np.zeros(len(texts), np.int64)
        np.add.at(self.n_links, text_of, in_a * in_b)
        self._write(sides, ids_a, ids_b, group_a, group_b, first_a, first_b)
        self._pair(ids_a, ids_b, text_of_a, in_b[group_a], first_b[group_a])

    def _write(self, sides, ids_a, ids_b, group_a, group_b, first_a, first_b):
        """The groups of each stretch as text, each group closed by a semicolon."""
        names_a, names_b = sides.spelled
        out = np.empty(len(ids_a) + len(ids_b), object)
        at_a, at_b = np.arange(len(ids_a)), np.arange(len(ids_b))
        last_a, last_b = at_a + 1 == first_a[group_a + 1], at_b + 1 == first_b[group_b + 1]
        out[at_a + first_b[group_a]] = names_a[ids_a + last_a * len(sides.bytes_a)]
        out[at_b + first_a[group_b + 1]] = names_b[ids_b + last_b * len(sides.bytes_b)]
        ends = _starts(self.n_a + self.n_b).tolist()
        parts = out.tolist()
        self.groups = ["".join(parts[x:y]) for x, y in zip(ends, ends[1:])]

    def _pair(self, ids_a, ids_b, text_of_a, partners, first_partner):
        """Distinct pairs of each stretch (A id over B id), and how often each is linked."""
        found, bounds = [], _starts(partners)
        at = 0
        while at < len(ids_a):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1)
            n = partners[at:to]
            b = ids_b[_spread(first_partner[at:to], n)]
            key = (np.repeat(text_of_a[at:to], n) << 32) | (np.repeat(ids_a[at:to], n) << 16) | b
            found.append(np.unique(key, return_counts=True))
            at = to
        keys, times = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64)
                       for i in (0, 1))
        keys, self.times = _summed(keys, times)
        self.pairs = keys & 0xFFFFFFFF
        self.first_pair = np.searchsorted(keys >> 32, np.arange(len(self.valid) + 1))


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(
        head + b"".join(a.tobytes() for a in arrays))


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def pack_pairs(keys: np.ndarray, counts: np.ndarray, best: np.ndarray | None = None) -> bytes:
    """Sorted pairs, as steps, with a number for each, and marks of the best."""
    best = np.empty(0, bool) if best is None else best
    return _packed(np.diff(keys, prepend=0).astype(np.uint32), counts.astype(np.int64), best)


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, counts, best = _unpacked(data, np.uint32, np.int64, bool)
    return np.cumsum(steps, dtype=np.int64), counts, best


class Block:
    """The texts of a block: a row for each document, and its runs."""

    def __init__(self, sides: Sides, texts: list[str]):
        number: dict[str, int] = {}
        own = [[number.setdefault(s, len(number)) for s in sides.stretches(t)] if t else []
               for t in texts]
        known = Aligned(sides, list(number))
        whole = {i: t for i, t in enumerate(texts) if t and not known.valid[own[i]].all()}
        for i in whole:
            own[i] = []
        self.rows = self._count(known, own)
        doc = np.repeat(np.arange(len(own)), list(map(len, own)))
        keys, times = self._records(known, doc, np.array([s for x in own for s in x], np.int64))
        if whole:  # each as one stretch
            more, places = Aligned(sides, list(whole.values())), list(whole)
            for i, row in zip(places, self._count(more, [[k] for k in range(len(places))]),
                              strict=True):
                self.rows[i] = row if row[0] else (0, 0, 0, 0, "")
            extra = self._records(more, np.array(places, np.int64), np.arange(len(places)))
            keys, times = _summed(np.concatenate((keys, extra[0])),
                                  np.concatenate((times, extra[1])))
        self.keys, self.times = keys, times

    @staticmethod
    def _count(known: Aligned, own: list[list[int]]) -> list[tuple]:
        bounds = _starts(np.array(list(map(len, own)), np.int64))
        flat = np.array([s for x in own for s in x], np.int64)
        sums = [np.diff(_starts(x[flat])[bounds]).tolist()
                for x in (known.n_a, known.n_b, known.n_groups, known.n_links)]
        texts = ["".join(map(known.groups.__getitem__, x))[:-1] for x in own]
        return [(*n, hashlib.sha256(t.encode()).hexdigest() if t else "")
                for *n, t in zip(*sums, texts, strict=True)]

    @staticmethod
    def _records(known: Aligned, doc: np.ndarray, stretch: np.ndarray) -> tuple[
            np.ndarray, np.ndarray]:
        """Sorted (part, pair, document) with how often the document links the pair."""
        both, again = np.unique((doc << 32) | stretch, return_counts=True)
        doc, stretch = both >> 32, both & 0xFFFFFFFF
        n = known.first_pair[stretch + 1] - known.first_pair[stretch]
        at = _spread(known.first_pair[stretch], n)
        pair = known.pairs[at].astype(np.uint64)
        part = (pair >> np.uint64(16)) & np.uint64(PARTS - 1)
        key = (part << np.uint64(48)) << np.uint64(10) | pair << np.uint64(26) \
            | np.repeat(doc, n).astype(np.uint64)
        return _summed(key, known.times[at] * np.repeat(again, n))

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """part, its pairs with their numbers of documents, and the documents of each pair."""
        bounds = np.searchsorted(self.keys >> np.uint64(58), np.arange(PARTS + 1, dtype=np.uint64))
        for part in range(PARTS):
            keys, times = (x[bounds[part]:bounds[part + 1]] for x in (self.keys, self.times))
            if len(keys):
                pairs, counts = np.unique((keys >> np.uint64(26)) & np.uint64(0xFFFFFFFF),
                                          return_counts=True)
                docs = (keys & np.uint64(BLOCK_DOCS - 1)).astype(np.uint16)
                yield (part, pack_pairs(pairs.astype(np.int64), counts),
                       _packed(docs, times.astype(np.uint32)))


def _block_rows(sides, ids: list, texts: list[str], number: int, kind) -> pa.RecordBatch:
    block = Block(sides, texts)
    runs, n = list(block.runs()), len(texts)
    none = [None] * len(runs)
    columns = list(zip(*block.rows, strict=True)) or [[]] * 5
    arrays = [pa.array([number] * (n + len(runs)), pa.int64()),
              pa.array([*range(n), *none], pa.int32()), pa.array([*ids, *none], kind)]
    arrays += [pa.array([*c, *none], pa.int64()) for c in columns[:4]]
    arrays += [pa.array([*columns[4], *none], pa.string())]
    empty = [None] * n
    arrays += [pa.array(empty + [r[i] for r in runs], t)
               for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, names=_COLUMNS)


_COLUMNS = ["block", "idx", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
            "part", "pairs", "docs"]
_SCHEMA = ("block long, idx int, doc_id {}, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, part int, pairs binary, docs binary")


def _spiller(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block = TaskContext.get().partitionId(), 0
        ids, texts, size, kind = [], [], 0, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").cast("large_binary").to_pylist(),
                                 strict=True):
                ids.append(doc)
                texts.append((text or b"").decode("utf-8", "replace"))
                size += len(text or b"")
                if size >= BLOCK_BYTES or len(ids) == BLOCK_DOCS:
                    yield _block_rows(shared.value, ids, texts, task << 32 | block, kind)
                    ids, texts, size, block = [], [], 0, block + 1
        if ids:
            yield _block_rows(shared.value, ids, texts, task << 32 | block, kind)

    return run


def spilled(docs: DataFrame, ranks: str = RANKS, pieces: str = PIECES) -> DataFrame:
    """A row for each document (part is null) and for each run (idx is null)."""
    spark = docs.sparkSession
    ship_code(spark)
    with open(pieces, "rb") as model:
        shared = spark.sparkContext.broadcast(Sides(load_ranks(ranks), model.read()))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_spiller(shared), _SCHEMA.format(
        docs.schema["doc_id"].dataType.simpleString()))


def merged_runs(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs with the sums of their counts, one A id after the other."""
    read = [unpack_pairs(r)[:2] for r in runs]
    bounds, heap = [], []
    for k, (keys, _) in enumerate(read):
        first = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
        bounds.append((keys[first] >> 16).tolist())
        if len(keys):
            read[k] += (np.append(first, len(keys)).tolist(),)
            heap.append((bounds[k][0], k, 0))
    heapq.heapify(heap)
    while heap:
        side, found = heap[0][0], []
        while heap and heap[0][0] == side:
            _, k, at = heap[0]
            keys, counts, first = read[k]
            found.append((keys[first[at]:first[at + 1]], counts[first[at]:first[at + 1]]))
            if at + 1 < len(bounds[k]):
                heapq.heapreplace(heap, (bounds[k][at + 1], k, at + 1))
            else:
                heapq.heappop(heap)
        if len(found) == 1:
            yield found[0]
        else:
            yield _summed(*map(np.concatenate, zip(*found, strict=True)))


def _merger(last: bool):
    def run(table: pa.Table) -> pa.Table:
        keys, counts, best = [], [], []
        for k, c in merged_runs(table.column("pairs").to_pylist()):
            keys.append(k)
            counts.append(c)
            if last:
                best.append(c == c.max())
        data = pack_pairs(np.concatenate(keys), np.concatenate(counts),
                          np.concatenate(best) if last else None)
        return table.slice(0, 1).select(["part", "share"]).append_column(
            "pairs", pa.array([data], pa.binary()))

    return run


def pair_counts(runs: DataFrame) -> DataFrame:
    """part, pairs: all pairs of a part with the documents that hold each and the best marked."""
    blocks = runs.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    own = runs.select("part", "pairs", F.col("block").alias("run"))
    while True:
        shares = max(1, -(-blocks // FAN))
        dealt = own.select("part", "pairs", F.pmod(F.xxhash64("run"), F.lit(shares)).alias("share"))
        merged = stored(dealt.groupBy("part", "share").applyInArrow(
            _merger(shares == 1), "part int, share long, pairs binary"), "counts")
        if shares == 1:
            return merged.select("part", "pairs")
        own, blocks = merged.withColumnRenamed("share", "run"), shares


def _give_back(table: pa.Table) -> pa.Table:
    rows = table.select(["block", "pairs", "docs"]).to_pylist()
    known = next(r["pairs"] for r in rows if r["docs"] is None)
    keys, counts, best = unpack_pairs(known)
    blocks, sums = [], []
    for row in rows:
        if row["docs"] is None:
            continue
        pairs, n, _ = unpack_pairs(row["pairs"])
        docs, times = _unpacked(row["docs"], np.uint16, np.uint32)
        at, times = np.repeat(np.searchsorted(keys, pairs), n), times.astype(np.int64)
        out = np.zeros((2, int(docs.max()) + 1), np.int64)
        np.add.at(out[0], docs, times * best[at])
        np.add.at(out[1], docs, times * counts[at])
        blocks.append(row["block"])
        sums.append(_packed(out[0], out[1]))
    return pa.table([pa.array(blocks, pa.int64()), pa.array(sums, pa.binary())],
                    names=["block", "sums"])


def _add_up(table: pa.Table) -> pa.Table:
    parts = [_unpacked(s, np.int64, np.int64) for s in table.column("sums").to_pylist()]
    out = np.zeros((2, max(len(p[0]) for p in parts)), np.int64)
    for best, total in parts:
        out[0, :len(best)] += best
        out[1, :len(total)] += total
    some = np.flatnonzero(out[1])
    return pa.table([pa.repeat(table.column("block")[0], len(some)),
                     pa.array(some, pa.int32()), pa.array(out[0, some]), pa.array(out[1, some])],
                    names=["block", "idx", "n_best", "count_sum"])


def contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """block, idx, n_best, count_sum of every document with links."""
    sizes = runs.groupBy("part").agg(F.ceil(
        F.sum(F.octet_length("docs") + F.octet_length("pairs")) / TASK_BYTES).alias("tasks"))
    sizes = F.broadcast(stored(sizes, "sizes"))  # PARTS rows
    dealt = runs.join(sizes, "part").select(
        "part", F.pmod(F.xxhash64("block"), F.col("tasks")).alias("task"), "block", "pairs", "docs")
    known = counts.join(sizes, "part").select(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"),
        F.lit(None).cast("long").alias("block"), "pairs", F.lit(None).cast("binary").alias("docs"))
    given = dealt.unionByName(known).groupBy("part", "task").applyInArrow(
        _give_back, "block long, sums binary")
    return given.groupBy("block").applyInArrow(
        _add_up, "block long, idx int, n_best long, count_sum long")


def align(docs: DataFrame, ranks: str = RANKS, pieces: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    both = stored(spilled(docs, ranks, pieces), "runs")
    rows = both.where("part is null")
    runs = both.where("part is not null").select("block", "part", "pairs", "docs")
    given = contributions(runs, pair_counts(runs))
    return rows.join(given, ["block", "idx"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256")
