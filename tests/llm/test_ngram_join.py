"""N-gram join against all pairs."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import docs, real  # noqa: F401
from tidemart.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and part[i] != part[j]:
                part = [part[j] if p == part[i] else p for p in part]
    names = {}
    for (doc, _), p in zip(rows, part, strict=True):
        if doc is not None:
            names[p] = min(doc, names.get(p, doc))
    return sorted(((doc, len(s), names.get(p) if s else doc)
                   for (doc, _), s, p in zip(rows, sets, part, strict=True)), key=repr)


def compare(frame):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                  for r in ngram_join.near_duplicates(frame).collect()), key=repr)
    assert got == plain(rows)
    return got


def test_all_documents(real):
    compare(real)


def test_hard_cases(docs):
    base = " ".join(f"w{i}" for i in range(100))
    compare(docs([
        None, "", " \n ", "a b c", "A B  C", "a b", "a b c d e", "a b c d e", base, base.upper(),
        base + " x", "y " + base, base.replace("w50 ", "q "), base.replace("w5 ", "q "),
        (9, base), (None, base), (None, "alone here"), "é " * 40, "É " * 40, "w " * 30000,
        "w " * 30001, " ".join(f"w{i}" for i in range(55)), base + " " + base,
    ]))


@pytest.mark.parametrize("seed", range(3))
def test_groups_of_copies(docs, seed):
    """Many near copies of a few texts, edits from none to beyond the bound."""
    r = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"t{r.randrange(60)}" for _ in range(r.choice([12, 60, 150]))]
        for _ in range(25):
            own = list(base)
            for _ in range(r.randrange(0, 4)):
                own[r.randrange(len(own))] = f"e{r.randrange(1000)}"
            texts.append(" ".join(own[r.randrange(2):]))
    shared = " ".join(f"s{i}" for i in range(40))
    texts += [shared + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(n))
              for n in (2, 4, 6, 8, 10, 12, 200) for _ in range(3)]
    compare(docs(texts))


def test_one_document_of_each_group_stays(docs):
    base = " ".join(f"w{i}" for i in range(100))
    frame = docs([base, base + " x", "other", None, base, (2, "other")])
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [
        (0, base), (2, "other"), (3, None)]


def test_texts_of_one_doc_id_are_judged_one_by_one(docs):
    base = " ".join(f"w{i}" for i in range(100))
    frame = docs([(1, base), (5, base + " x"), (5, "alone"), (5, base), (7, "alone b"), (7, None),
                  (7, None), (None, base), (None, base)]).selectExpr(
        "*", "1 as extra_id", "2 as body_key", "3 as label")
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(1, base), (5, "alone"), (7, "alone b"), (7, None), (None, base), (None, base)], key=repr)


def test_empty_table_and_clashing_names(docs):
    assert ngram_join.near_duplicates(docs([])).collect() == []
    assert ngram_join.keep_one(docs([])).collect() == []
    named = docs(["a b", "a b"]).selectExpr("*", "1 as node", "2 as tokens", "3 as component_id")
    assert [r["component_id"] for r in ngram_join.near_duplicates(named).collect()] == [0, 0]


@pytest.mark.parametrize("n", range(1, 6))
def test_short_text_in_a_chunk_of_its_own(docs, n):
    short, long = " ".join("abcde"[:n]), "filler words " * 90_000
    for texts in ([short], [long, short, long]):
        sets = list(ngram_join.shingle_sets([t.encode() for t in texts]))
        assert len(sets[len(texts) // 2]) == 1
    compare(docs([short]))


def test_prefix_is_long_enough():
    for n in range(1, 300):
        for m in range(n, 300):
            if 5 * n >= 4 * m:
                need = -(-4 * (n + m) // 9)
                assert n - need + 1 <= ngram_join.prefix_length(n)
                assert m - need + 1 <= ngram_join.prefix_length(m)


def test_sketch_worker_holds_few_texts_at_a_time():
    """The pipeline's executors ran out of memory; a batch took 64 MB of a worker."""
    texts = [" ".join(f"w{i}x{j}" for j in range(250)) for i in range(10000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    next(ngram_join._count(iter([batch.slice(0, 10)])))
    tracemalloc.start()
    counts = next(ngram_join._count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.frombuffer(b"".join(counts.column("counts").to_pylist()), np.uint32)
    assert got.sum() == 10000 * 246 and peak < 30e6, peak
