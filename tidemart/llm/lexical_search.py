"""Ranked lexical search by one scan of the texts: an Aho-Corasick automaton of all item terms.

The terms of the items, each between two blanks, form an automaton that every executor gets. A
text is folded byte by byte (A-Z to lower case, all bytes outside the terms' alphabet to blanks),
so an output of the automaton is an occurrence of a whole term, and the blanks guard its borders.
No index of the documents is built: the first scan counts the documents that hold each term, the
number of documents and their lengths; the second counts the terms of each text again, scores it
for all items its terms belong to, and keeps the best of each item within its task. What leaves a
task is a count for each term, then `k` rows for each item at most; these are ranked in two
steps, first within 64 shares of the documents, so that no task gets an item's rows of all tasks.

Items are dealt to blocks whose terms have a bounded size, and each block has its own automaton
and scans; one block is the usual case, and the rows do not depend on their number.

Edge cases: a null text, or one without terms, is no document and is never returned; an item
without terms, or with terms that no document holds, has no rows; rows of one item_id are one
item with the terms of all, a null item_id too; equal rows of documents are ranked one by one; of
equal scores the smaller doc_id comes first, a null one last; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemart.llm.common import ship_code, stored
from tidemart.llm.words import utf8

# Fixed value: what a term is.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 8 << 20  # terms of one automaton
CELLS = 1 << 20  # scores of documents by items that are held at once
PENDING = 1 << 19  # candidates a task keeps before it sorts out the best
SHARES = 64
_DOCUMENTS, _LENGTHS = -1, -2  # rows of the counts that belong to no term


def _fold() -> bytes:
    table = bytearray(range(256))
    for code in range(128):
        letter = chr(code).lower()
        table[code] = ord(letter) if letter.isalnum() else 32
    return bytes(table)


_FOLD = _fold()


class Terms:
    """The automaton of a block's terms and the items that each term belongs to."""

    def __init__(self, terms: list[str], starts: np.ndarray, items: np.ndarray):
        self.terms, self.starts, self.items = terms, starts, items

    def __getstate__(self):
        return {"terms": self.terms, "starts": self.starts, "items": self.items}

    @cached_property
    def automaton(self):
        import ahocorasick

        built = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            built.add_word(f" {term.encode().decode('latin-1')} ", number)
        built.make_automaton()
        return built

    def scan(self, text: bytes) -> tuple[int, Counter]:
        """How many terms the text has, and how often each of the items' terms occurs."""
        folded = text.translate(_FOLD)
        found = self.automaton.iter(f" {folded.decode('latin-1')} ")
        return len(folded.split()), Counter(map(itemgetter(1), found))

    @classmethod
    def of(cls, lists: list[list[str]]) -> Terms:
        """From the distinct terms of each item."""
        owners: dict[str, list[int]] = {}
        for item, own in enumerate(lists):
            for term in own:
                owners.setdefault(term, []).append(item)
        names = sorted(owners)
        sizes = [len(owners[t]) for t in names]
        return cls(names, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))),
                   np.array([i for t in names for i in owners[t]], np.int64))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct) of every item that has any."""
    folded = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    return items.select("item_id", F.explode(F.array_distinct(
        F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))).alias("term")).groupBy(
        "item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        held, documents, lengths = np.zeros(len(terms.terms), np.int64), 0, 0
        for batch in batches:
            for text in utf8(batch.column("text")):
                n, found = terms.scan(text)
                documents, lengths = documents + (n > 0), lengths + n
                held[list(found)] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_DOCUMENTS, _LENGTHS, *some.tolist()], pa.int64()),
             pa.array([documents, lengths, *held[some].tolist()], pa.int64())],
            names=["term", "n"])

    return run


def corpus_counts(texts: DataFrame, shared, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the documents that hold each term."""
    found = texts.select("text").mapInArrow(_counter(shared), "term long, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).collect()  # a row for each term of the block
    counts = {r["term"]: r["n"] for r in found}
    held = np.zeros(size, np.int64)
    for term, n in counts.items():
        if term >= 0:
            held[term] = n
    return counts.get(_DOCUMENTS, 0), counts.get(_LENGTHS, 0), held


def term_weights(documents: int, held: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)


class _Best:
    """The k best (item, doc, score) of every item among those added."""

    def __init__(self, items: int, k: int):
        self.k, self.parts, self.size = k, [], 0
        self.least = np.ones(items, np.int64)  # lower scores are no longer of use

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        self.parts.append((item, ~known[doc], ids[doc], scores[doc, item]))
        self.size += len(doc)
        if self.size > PENDING:
            self.rows()

    def rows(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.empty(0, np.int64), np.empty(0, bool), *[np.empty(0, np.int64)] * 2)
        item, null, ids, score = map(np.concatenate, zip(*self.parts, strict=True))
        order = np.lexsort((ids, null, -score, item))
        starts = np.searchsorted(item[order], np.arange(len(self.least)))
        order = order[np.arange(len(order)) - starts[item[order]] < self.k]
        kept = tuple(x[order] for x in (item, null, ids, score))
        full, n = np.unique(kept[0], return_counts=True)
        last = np.cumsum(n) - 1
        self.least[full[n == self.k]] = kept[3][last[n == self.k]]
        self.parts, self.size = [kept], len(order)
        return kept


def _scores(terms: Terms, found: list[tuple[int, Counter]], items: int, weights: np.ndarray,
            documents: int, lengths: int) -> np.ndarray:
    """Scores of some documents (rows) for all items (columns)."""
    sizes = [len(own) for _, own in found]
    term = np.fromiter((t for _, own in found for t in own), np.int64, sum(sizes))
    tf = np.fromiter((c for _, own in found for c in own.values()), np.int64, sum(sizes))
    m = np.repeat(np.array([50 + 50 * n * documents // max(lengths, 1) for n, _ in found],
                           np.int64), sizes)
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
    owners = terms.starts[term + 1] - terms.starts[term]
    first = terms.starts[term] - np.cumsum(owners) + owners
    at = np.repeat(first, owners) + np.arange(owners.sum())
    cell = np.repeat(np.repeat(np.arange(len(found)), sizes) * items, owners) + terms.items[at]
    out = np.zeros(len(found) * items, np.int64)
    np.add.at(out, cell, np.repeat(part, owners))
    return out.reshape(len(found), items)


def _ranker(shared, names: list, kind: pa.DataType, weights: np.ndarray, documents: int,
            lengths: int, k: int):
    rows = max(1, CELLS // len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, best = shared.value, _Best(len(names), k)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                docs = part.column("doc_id")
                ids = docs.fill_null(0).to_numpy(zero_copy_only=False)
                found = [terms.scan(t) for t in utf8(part.column("text"))]
                best.add(_scores(terms, found, len(names), weights, documents, lengths),
                         ids, docs.is_valid().to_numpy(zero_copy_only=False))
        item, null, ids, score = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in item.tolist()], kind),
             pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())],
            names=["item_id", "doc_id", "score"])

    return run


def _first(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores for each item.

    `docs` has doc_id (a whole number) and text, `items` item_id and text.
    """
    spark = docs.sparkSession
    ship_code(spark)
    context = spark.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    wanted = stored(item_terms(items), "item-terms")
    size = wanted.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: (
        s + F.octet_length(t) + 8)))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    kind, out = items.schema["item_id"].dataType, "item_id {}, doc_id long, score long"
    found = spark.createDataFrame([], out.format(kind.simpleString()))
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if not own:
            continue
        terms = Terms.of([r["terms"] for r in own])
        shared = context.broadcast(terms)
        documents, lengths, held = corpus_counts(texts, shared, len(terms.terms))
        found = found.unionAll(texts.mapInArrow(
            _ranker(shared, [r["item_id"] for r in own], to_arrow_type(kind),
                    term_weights(documents, held), documents, lengths, k),
            out.format(kind.simpleString())))
    shares = found.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    return _first(_first(shares, k, "item_id", "share"), k, "item_id").select(
        "item_id", "rank", "doc_id", "score")


SQL = rf"""
    with words as materialized (
      select row_number() over () as r, doc_id,
        regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') as w
      from documents),
    sizes as (select r, doc_id, len(w) as n from words where len(w) > 0),
    totals as (select count(*) as docs, cast(sum(n) as bigint) as terms from sizes),
    wanted as (
      select distinct item_id,
        unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term
      from benchmark),
    counts as (
      select r, term, count(*) as tf from (select r, unnest(w) as term from words)
      where term in (select term from wanted) group by r, term),
    held as (select term, count(*) as df from counts group by term),
    scored as (
      select item_id, r, doc_id, cast(sum(
        cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint)
        * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) as bigint)
        as score
      from wanted join counts using (term) join held using (term) join sizes using (r), totals
      group by item_id, r, doc_id)
    select item_id, rank, doc_id, score from (
      select *, cast(row_number() over (partition by item_id order by score desc, doc_id, r)
        as integer) as rank from scored where score > 0) where rank <= 50"""
