"""Byte-level BPE by a tree reduction: halves are encoded on their own and joined.

An encoded stretch of text is an element of a monoid: the pieces that the pattern cuts, each with
its tokens. A text is halved down to leaves of some hundred letters; two neighbours are joined by
redoing only what the border can touch, and every step of that is exact:

* Pieces. The pattern is matched from left to right without looking back, so a match depends on
  what follows its start only. Pieces of the left half that end before the border, and start three
  letters or more before it (the longest fixed alternative), stay. From the first other one the
  text is matched again, until a match ends where a piece of the right half starts: from there on
  the right half's pieces are those of the whole text.
* Tokens. A piece that was not cut is encoded at once. One that spans the border and is long keeps
  the tokens of its parts outside a window around the border. The window is encoded again and
  grows, doubling, until both its ends are stable: the last token outside and the first inside,
  encoded as one string, give just these two. If that holds for all neighbours, no merge crosses
  any token border: the first that did would also be made by the two tokens alone, as merges
  elsewhere do not change the order (rank, then place) of those between and inside the two.

Decoding joins the bytes of the tokens up a tree in the same way. Texts are independent, so
there is no shuffle; memory is bounded by a batch of rows and its tokens.

Edge cases: a null or empty text has no tokens and decodes to no bytes; bytes that are no UTF-8
count as U+FFFD; equal rows are all returned; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship_code

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LEAF = 1024  # letters of a leaf
LEAF_IDS = 4096  # tokens of a leaf when decoding
LONG = 256  # bytes; longer pieces keep tokens over a join
REACH = 3  # letters of the pattern's longest fixed alternative
HELD_PIECES = 200_000  # pieces and pairs whose tokens a worker keeps
ROWS = 256


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Stretch:
    """Pieces of text[start:end]: where each starts, and its tokens."""

    __slots__ = ("starts", "ids", "end")

    def __init__(self, starts: list[int], ids: list, end: int):
        self.starts, self.ids, self.end = starts, ids, end

    def stop(self, i: int) -> int:
        return self.starts[i + 1] if i + 1 < len(self.starts) else self.end


class Codec:
    """A vocabulary with its merges, and the tree reductions over it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN,
                 leaf: int = LEAF, long: int = LONG):
        self.ranks, self.pattern, self.leaf = ranks, pattern, leaf
        self.long = max([long, *map(len, ranks)])

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("ranks", "pattern", "leaf", "long")}

    @cached_property
    def _cut(self):
        import regex

        return regex.compile(self.pattern)

    @cached_property
    def _whole(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks,
                                 special_tokens={}).encode_ordinary

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def _pieces(self) -> dict[str, tuple[int, ...]]:
        return {}

    @cached_property
    def _pairs(self) -> dict[tuple[int, int], bool]:
        return {}

    def piece(self, piece: str) -> tuple[int, ...]:
        """Tokens of one piece, all at once."""
        ids = self._pieces.get(piece)
        if ids is None:
            ids = tuple(self._whole(piece))
            if len(self._pieces) >= HELD_PIECES:
                self._pieces.clear()
            if len(piece) <= 64:
                self._pieces[piece] = ids
        return ids

    def merged(self, data: bytes) -> list[int]:
        """Tokens after all merges, the lowest rank first and of equal ones the leftmost."""
        ranks, n = self.ranks, len(data)
        after, before, gone = list(range(1, n + 2)), list(range(-1, n)), bytearray(n + 1)
        heap = [(r, i, i + 2) for i in range(n - 1)
                if (r := ranks.get(data[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            j = after[i]
            if gone[i] or j >= n or after[j] != end:
                continue
            after[i], gone[j] = end, 1
            if end < n:
                before[end] = i
                if (r := ranks.get(data[i:after[end]])) is not None:
                    heappush(heap, (r, i, after[end]))
            if (b := before[i]) >= 0 and (r := ranks.get(data[b:end])) is not None:
                heappush(heap, (r, b, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:after[i]]])
            i = after[i]
        return out

    def stable(self, first: int, second: int) -> bool:
        """Whether two neighbouring tokens stay as they are when encoded together."""
        key = first, second
        known = self._pairs.get(key)
        if known is None:
            known = self.merged(self.bytes_of[first] + self.bytes_of[second]) == [first, second]
            if len(self._pairs) >= HELD_PIECES:
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def spliced(self, left: list[int], raw: bytes, right: list[int]) -> list[int]:
        """Tokens of left, raw bytes and right as one piece; left and right are encoded."""
        i, j, step = len(left), 0, 1
        while True:
            window = b"".join([*map(self.bytes_of.get, left[i:]), raw,
                               *map(self.bytes_of.get, right[:j])])
            middle = self.merged(window)
            border = [*left[i - 1:i], *middle, *right[j:j + 1]] if i else [*middle, *right[j:j + 1]]
            fits_left = not i or len(border) < 2 or self.stable(border[0], border[1])
            fits_right = (j == len(right) or len(border) < 2
                          or self.stable(border[-2], border[-1]))
            if fits_left and fits_right:
                return left[:i] + middle + right[j:]
            i = i if fits_left else max(0, i - step)
            j = j if fits_right else min(len(right), j + step)
            step *= 2

    def _part(self, text: str, part: Stretch, i: int, start: int, end: int) -> tuple[
            bytes, list[int], bytes]:
        """What piece i has in text[start:end]: loose bytes, whole tokens, loose bytes."""
        own, stop = part.starts[i], part.stop(i)
        inside = text[max(own, start):min(stop, end)].encode()
        if len(inside) <= self.long:
            return inside, [], b""
        skip, ids = len(text[own:max(own, start)].encode()), part.ids[i]
        ends = list(accumulate(len(self.bytes_of[t]) for t in ids))
        kept = [k for k, e in enumerate(ends)
                if e - len(self.bytes_of[ids[k]]) >= skip and e <= skip + len(inside)]
        if not kept:
            return inside, [], b""
        first, last = kept[0], kept[-1]
        at, to = ends[first] - len(self.bytes_of[ids[first]]) - skip, ends[last] - skip
        return inside[:at], list(ids[first:last + 1]), inside[to:]

    def _again(self, text: str, start: int, end: int, old: list[tuple[Stretch, int]]):
        """Tokens of the piece text[start:end], from the old pieces that it overlaps."""
        piece = text[start:end]
        if len(piece) <= self.long and len(piece.encode()) <= self.long:
            return self.piece(piece)
        ids, raw = [], b""
        for part, i in old:
            if part.stop(i) > start and part.starts[i] < end:
                head, known, tail = self._part(text, part, i, start, end)
                raw += head
                if known:
                    ids, raw = self.spliced(ids, raw, known), tail
        return self.spliced(ids, raw, [])

    def join(self, text: str, left: Stretch, right: Stretch) -> Stretch:
        """Two neighbouring stretches as one."""
        if not left.starts or not right.starts:
            return right if not left.starts else left
        i = len(left.starts) - 1
        while i and left.starts[i - 1] + REACH > left.end:
            i -= 1
        old, k = [(left, x) for x in range(i, len(left.starts))], 0
        starts, ids, spans = left.starts[:i], left.ids[:i], []
        for m in self._cut.finditer(text, left.starts[i], right.end):
            spans.append(m.span())
            while k < len(right.starts) and right.starts[k] < m.end():
                old.append((right, k))
                k += 1
            if m.end() == right.end or k < len(right.starts) and right.starts[k] == m.end():
                break
        for start, end in spans:
            starts.append(start)
            ids.append(self._again(text, start, end, old))
        return Stretch(starts + right.starts[k:], ids + right.ids[k:], right.end)

    def stretch(self, text: str, start: int, end: int) -> Stretch:
        if end - start > self.leaf:
            middle = (start + end) // 2
            return self.join(text, self.stretch(text, start, middle),
                             self.stretch(text, middle, end))
        pieces = self._cut.findall(text, start, end)
        known = self._pieces.get
        ids = [known(p) or self.piece(p) for p in pieces]
        return Stretch(list(accumulate(map(len, pieces[:-1]), initial=start)) if pieces else [],
                       ids, end)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.stretch(text, 0, len(text)).ids))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) > LEAF_IDS:
            middle = len(ids) // 2
            return self.decode(ids[:middle]) + self.decode(ids[middle:])
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _encoder(codec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec.value.encode
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column("text").cast("large_binary").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([encode(t.decode("utf-8", "replace")) if t else [] for t in texts],
                             pa.list_(pa.int32())),
                ], names=["doc_id", "ids"])

    return run


def _decoder(codec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec.value.decode
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("ids"),
                    pa.array([decode(ids or []) for ids in part.column("ids").to_pylist()],
                             pa.binary()),
                ], names=["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids (array of int) of every row of `docs`."""
    spark = docs.sparkSession
    ship_code(spark)
    codec = spark.sparkContext.broadcast(Codec(load_ranks(path)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _encoder(codec), f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and their bytes (`decoded`) of every row of `tokens` (doc_id, ids)."""
    spark = tokens.sparkSession
    ship_code(spark)
    codec = spark.sparkContext.broadcast(Codec(load_ranks(path)))
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(
        _decoder(codec), f"doc_id {kind}, ids array<int>, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of `decode`."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
