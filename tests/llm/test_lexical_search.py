"""Ranked search against a plain version that splits every text into its terms."""

import math
import re
from collections import Counter

import pytest

from llm_cases import SF, docs, real  # noqa: F401
from tidemart.llm import lexical_search

TERM = re.compile(lexical_search.TERM)


def terms(text):
    return [] if text is None else TERM.findall(re.sub(
        "[A-Z]", lambda m: m[0].lower(), text))


def plain(documents, items, k=50):
    """(item, rank, doc_id, score) for rows of (doc_id, text) and (item_id, text)."""
    counts = [(d, Counter(terms(t))) for d, t in documents]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    total, held = sum(n for _, _, n in counts), Counter(t for _, c, _ in counts for t in c)
    wanted, out = {}, []
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    for item, own in wanted.items():
        found = []
        for doc, c, n in counts:
            m = 50 + 50 * n * len(counts) // total
            score = sum(math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * held[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -score)
                for i, (score, null, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def compare(spark, documents, items, k=50):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in items],
                                  "item_id long, text string, score int, terms string")
    out = lexical_search.best_documents(documents, frame, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == plain([(r["doc_id"], r["text"]) for r in documents.collect()], items, k)
    return got


def test_all_documents_and_items(spark, real):
    items = [(r["item_id"], r["text"])
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert compare(spark, real, items)


HARD = [
    None, "", " .,!", "word", "Word wordy a-word word", "éclair ÉCLAIR Éclair", "straße x 2 words",
    "a\x00b\x7fc a1b2", "日本 語 word", "x " * 30_000 + "needle", "needle", "needle", (5, "needle"),
    (5, "needle"), (None, "needle"), (None, "needle"), "KKelvin kelvin", "x" * 100_000 + " ab",
    "ab ab a b ab", "퟿\U0001f642 ab🙂ab",
]
ITEMS = [(1, "WORD wordy"), (2, None), (3, ""), (4, "needle needle, x"), (4, "ab"), (4, "ab"),
         (None, "a b c"), (None, "éclair"), (7, "never seen"), (8, "日本 🙂 straße x"),
         (9, "kelvin Kelvin"), (10, "x" * 100_000)]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_hard_cases(spark, docs, k):
    compare(spark, docs(HARD).selectExpr("*", "1 as score", "'t' as terms"), ITEMS, k)


def test_many_ties_and_blocks(spark, docs, monkeypatch):
    texts = [(i % 90, f"same words {'rare' if i % 7 else ''}") for i in range(300)]
    items = [(11, "rare same"), (12, "words"), (13, "same"), (None, "rare")]
    whole = compare(spark, docs(texts), items, 20)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 30)
    monkeypatch.setattr(lexical_search, "PENDING", 10)
    monkeypatch.setattr(lexical_search, "CELLS", 40)
    assert compare(spark, docs(texts), items, 20) == whole


def test_empty_tables(spark, docs):
    assert compare(spark, docs([]), ITEMS) == []
    assert compare(spark, docs(HARD), []) == []
    assert compare(spark, docs([None, "."]), ITEMS) == []
