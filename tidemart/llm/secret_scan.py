"""Secret scans over an incremental blob ledger.

Every text is addressed by its SHA-256. A ledger in shared storage records, for each blob, the
rule versions that have seen it and the spans they found. A run scans only the pairs of blob and
rule version that the ledger lacks, once per blob however many rows hold it, appends what it
found, and joins the findings back to all rows.

A cheap test of the bytes goes with the addressing, where the text is read anyway: for each rule,
the literals of which every match holds one, or else the rule's own pattern. A text that fails it
can have no finding, so only the few others travel to the scan.

Edge cases: a null text counts as empty; an empty table gives no rows; equal rows are all
returned; other columns of the input are ignored by `scan` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import free_names, scratch, ship_code, stored
from tidemart.sources.jsonl import load_or_empty


@dataclass(frozen=True)
class Rule:
    """`pattern` works on UTF-8 bytes; a match counts if its `group` has `least` bytes.

    `needs` are lower-case literals; every match holds one of them, in any case of letters. A rule
    without them is tested by its pattern.
    """

    kind: str
    version: int
    pattern: bytes
    flags: int = 0
    group: int = 0
    least: int = 1
    needs: tuple[bytes, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Patterns and least lengths of the base kinds.
BASE_RULES = (
    Rule("assign", 1,
         rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
         rb"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE, 2, 6,
         (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")),
    Rule("access", 1, rb"AKIA[A-Z0-9]+", 0, 0, 20, (b"akia",)),
    Rule("hex", 1, rb"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", 1, rb"-----BEGIN [A-Z ]*PRIVATE KEY-----",
         needs=(b"private key-----",)),
    Rule("jwt", 1, rb"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
         needs=(b"eyj",)),
    Rule("forge", 1, rb"gh[pousr]_[A-Za-z0-9]{36,}",
         needs=(b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_")),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<rule:string,kind:string,start:int,stop:int>"


def may_hold(text: bytes, rules: tuple[Rule, ...] = RULES) -> bool:
    """False only if no rule can match."""
    low = text.lower()
    return any(any(n in low for n in r.needs) if r.needs
               else re.search(r.pattern, text, r.flags) is not None for r in rules)


def find_spans(text: bytes, rules: tuple[Rule, ...]) -> list[tuple[str, str, int, int]]:
    """Matches of the rules as (rule, kind, start, end) in code points."""
    found = []
    for rule in rules:
        for m in re.finditer(rule.pattern, text, rule.flags):
            if len(m.group(rule.group)) >= rule.least:
                found.append((rule.key, rule.kind, m.start(), m.end()))
    places = sorted({p for f in found for p in f[2:]})
    points, at, done = {}, 0, 0
    for p in places:
        done += len(text[at:p].decode("utf-8", "replace"))
        points[p], at = done, p
    return [(r, k, points[a], points[b]) for r, k, a, b in found]


def _addresser(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b"" if t is None else t
                      for t in batch.column("text").cast("large_binary").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([hashlib.sha256(t).digest() for t in bodies], pa.binary()),
                pa.array([t if may_hold(t, rules) else None for t in bodies], pa.binary()),
            ], names=["doc_id", "blob", "body"])

    return run


def addressed(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob (address of the text), body (the text if a rule may match, else null)."""
    ship_code(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _addresser(rules), f"doc_id {kind}, blob binary, body binary")


def _scanner(rules: tuple[Rule, ...]):
    spans = pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()),
                                ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        for batch in batches:
            found = []
            for body, missing in zip(batch.column("body").to_pylist(),
                                     batch.column("missing").to_pylist(), strict=True):
                wanted = tuple(r for r in rules if r.key in missing)
                found.append([] if body is None else [
                    dict(zip(("rule", "kind", "start", "stop"), s, strict=True))
                    for s in find_spans(body, wanted)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("missing"), pa.array(found, spans)],
                names=["blob", "scanned", "spans"])

    return run


LEDGER = f"blob binary, scanned array<string>, spans array<{SPAN}>"


def read_ledger(spark, path: str) -> DataFrame:
    """All ledger rows; an unused path gives none."""
    return load_or_empty(spark, lambda: spark.read.schema(LEDGER).parquet(path), LEDGER)


def update_ledger(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the pairs of blob and rule version that the ledger lacks and append the result."""
    spark = paths.sparkSession
    wanted = F.array(*[F.lit(r.key) for r in rules])
    blobs = paths.groupBy("blob").agg(F.first("body", ignorenulls=True).alias("body"))
    seen = read_ledger(spark, ledger).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("seen"))
    missing = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    todo = (blobs.join(seen, "blob", "left").select("blob", "body", missing.alias("missing"))
            .where(F.size("missing") > 0))
    todo.mapInArrow(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)


def _ordered(spans: Column, kinds: list[str]) -> Column:
    """`kind:start:end`, by start, then kind as listed."""
    rank = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["stop"].alias("stop"),
        s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def found_blobs(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans: findings of the current rule versions, for blobs that have any."""
    current = [r.key for r in rules]
    return (read_ledger(spark, ledger).where(F.size("spans") > 0)
            .select("blob", F.explode("spans").alias("s")).where(F.col("s.rule").isin(current))
            .groupBy("blob").agg(F.collect_set("s").alias("spans")))


def scan(docs: DataFrame, ledger: str | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans of every row of `docs`, through the ledger at that path (new by default)."""
    spark = docs.sparkSession
    ledger = ledger or scratch(spark, "ledger")
    paths = stored(addressed(docs, rules), "paths")
    update_ledger(paths, ledger, rules)
    return (paths.select("doc_id", "blob")
            .join(found_blobs(spark, ledger, rules), "blob", "left")
            .select("doc_id", F.coalesce(
                "spans", F.array().cast(f"array<{SPAN}>")).alias("spans")))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per scanned row: counts of the base kinds, their hash, and all spans as text."""
    base, kinds = [r.kind for r in BASE_RULES], [r.kind for r in rules]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in base]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *counts,
                        F.sha2(_ordered(own, kinds), 256).alias("base_sha256"),
                        _ordered(F.col("spans"), kinds).alias("spans"))


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column has the spans."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column(-1).to_pylist(),
                               strict=True):
            parts, at = [], 0
            for a, b in sorted((s["start"], s["stop"]) for s in spans):
                if b > at:
                    parts += [text[at:max(a, at)], "[SECRET]" if a >= at else ""]
                    at = b
            out.append("".join(parts) + text[at:])
        i = batch.schema.get_field_index("text")
        batch = batch.set_column(i, "text", pa.array(out, batch.schema.field("text").type))
        yield batch.select(batch.schema.names[:-1])


def redact(docs: DataFrame, ledger: str | None = None,
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with every found span replaced by [SECRET]; n_chars follows the new text.

    Rows keep their place unless their blob has findings; only those texts are shuffled.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch(spark, "ledger")
    paths = stored(addressed(docs, rules), "paths")
    update_ledger(paths, ledger, rules)
    found = stored(found_blobs(spark, ledger, rules), "found")
    blob, spans = free_names(docs, "blob", "spans")
    keyed = docs.withColumn(blob, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    hits = found.select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    few = found.count() <= 50_000  # at most some tens of MB; else both sides are shuffled
    hits = F.broadcast(hits) if few else hits
    joined = keyed.join(hits, blob, "left").select(*docs.columns, spans)
    clean = joined.where(F.col(spans).isNull()).drop(spans)
    dirty = joined.where(F.col(spans).isNotNull()).mapInArrow(_mask, docs.schema)
    out = clean.unionByName(dirty)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
