"""Words of many texts at once: byte classes, word boundaries and 64-bit word hashes in numpy.

A text is cut into runs of bytes of one class; class 0 separates. Hashes are polynomials of the
bytes, taken from one running sum over the whole chunk, and then mixed; equal words have equal
hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 18  # every worker holds arrays of some 70 times as much

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def classes(separators: bytes, marks: bytes = b"") -> np.ndarray:
    """Class of each byte: 0 separates, 2 is a mark (runs of their own), 1 the rest."""
    table = np.ones(256, np.uint8)
    table[np.frombuffer(separators, np.uint8)] = 0
    table[np.frombuffer(marks, np.uint8)] = 2
    return table


BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
PLAIN = classes(BLANKS)

_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = U64(_BASE if kind == "up" else _INVERSE)
        steps = np.full(max(n, CHUNK_BYTES + 4096), base, U64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=U64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _hash_joined(joined: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a byte string that ends with a blank."""
    low = LOWER[np.frombuffer(joined, np.uint8)]
    kind = table[low]
    edges = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]))
    real = kind[edges[:-1]] != 0
    starts, ends = edges[:-1][real], edges[1:][real]
    sums = np.empty(len(low) + 1, U64)
    sums[0] = 0
    np.cumsum((low.astype(U64) + U64(1)) * _power("up", len(low)), dtype=U64, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", len(low))[starts]
    return mix(hashes + (ends - starts).astype(U64)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """Cut a very long text at blanks, so that no piece is much longer than a chunk."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        cut = max(text.rfind(c, at, at + CHUNK_BYTES) for c in (b" ", b"\n", b"\t"))
        if cut <= at:
            found = [p for c in (b" ", b"\n", b"\t")
                     if (p := text.find(c, at + CHUNK_BYTES)) >= 0]
            cut = min(found, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_hashes(texts: list[bytes], table: np.ndarray = PLAIN) -> Iterator[
        tuple[int, np.ndarray, np.ndarray]]:
    """Chunks (index of first text, hashes of all words, bounds): text i of a chunk has the
    words bounds[i] to bounds[i + 1]."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > CHUNK_BYTES:
            found = [_hash_joined(p + b" ", table)[0] for p in _pieces(texts[at])]
            hashes = np.concatenate(found)
            yield at, hashes, np.array([0, len(hashes)])
            at += 1
            continue
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= CHUNK_BYTES):
            total += len(texts[end]) + 1
            end += 1
        part = texts[at:end]
        hashes, starts = _hash_joined(b" ".join(part) + b" ", table)
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in part])))
        yield at, hashes, np.searchsorted(starts, offsets)
        at = end


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that the texts of one part are copied at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(column) -> list[bytes]:
    """Bytes of an Arrow string column; null gives none."""
    return [b"" if x is None else x for x in column.cast("large_binary").to_pylist()]
