"""Decontamination against a search over all windows."""

import math
import random
import re
from collections import Counter

import pytest

from llm_cases import docs, plan, real  # noqa: F401
from tidemart.llm import decontaminate

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def words(text):
    return WORD.findall((text or "").lower())


def shingles(own):
    return {tuple(own[i:i + 5]) for i in range(len(own) - 4)} or {tuple(own)}


def plain(docs, items):
    items = [(k, words(t)) for k, t in items if words(t)]
    df = Counter(s for _, w in items for s in shingles(w))
    other = math.log(1 + len(items))
    found = {}
    for doc, text in docs:
        own = words(text)
        here = {tuple(own[i:i + n]) for n in range(1, 6) for i in range(len(own))}
        for k, w in items:
            want = shingles(w)
            total = sum(math.log(1 + len(items) / df[s]) for s in want)
            best = 0.0
            if not want & here:
                continue
            for a in range(1 - len(w), len(own)):
                first = max(0, a)
                if all(tuple(own[i:i + 5]) not in want for i in range(first, a + len(w))) \
                        and len(w) > 4:
                    continue
                have = shingles(own[first:a + len(w)])
                inner = sum(math.log(1 + len(items) / df[s]) for s in want & have)
                best = max(best, inner / (total + other * len(have - want)))
            if best >= decontaminate.SIMILARITY:
                found[doc, k] = max(best, found.get((doc, k), 0))
    return found


def run(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["similarity"]
            for r in decontaminate.leaks(docs, benchmark).collect()}


def test_all_documents(spark, real):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = run(spark, real, items)
    want = plain([(r["doc_id"], r["text"]) for r in real.collect()], items)
    assert got.keys() == want.keys() and want
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def passage(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.mark.parametrize("n", [1, 4, 6, 14, 15, 40, 300])
def test_items_of_any_size_at_any_place(spark, docs, n):
    item = passage(n, "Item")
    texts = [passage(k, "a") + ", " + item.upper() + "! " + passage(9, "b") for k in range(17)]
    texts += [item, passage(40, "c"), passage(max(0, n - n // 3 - 1), "Item")]
    got = run(spark, docs(texts), [(7, item)])
    assert {k for k, v in got.items() if v == 1.0} == {(i, 7) for i in range(18)}
    assert (18, 7) not in got and (19, 7) not in got


@pytest.mark.parametrize("n", [34, 57])
def test_edited_copies(spark, docs, n):
    """One changed word, or a word less at an end, wherever the passage stands."""
    r = random.Random(n)
    item = passage(n, "w").split()
    texts = []
    for k in range(60):
        own = list(item)
        own[r.choice([0, 1, n - 1, r.randrange(n)])] = "q"
        own = r.choice([own, item[1:], item[:-1], item[:5] + ["q"] + item[5:]])
        texts.append(" ".join([f"a{i}" for i in range(r.randrange(20))] + own + ["z"] * 30))
    got = run(spark, docs(texts), [(1, " ".join(item)), (2, passage(30, "v"))])
    want = plain(list(enumerate(texts)), [(1, " ".join(item)), (2, passage(30, "v"))])
    assert got.keys() <= want.keys()
    assert all(v <= want[k] + 1e-9 for k, v in got.items())
    assert len(got) >= 0.9 * len({k for k, v in want.items() if v >= 0.83})


def test_every_edited_copy_above_the_bound(spark, docs):
    """Changed, dropped and added words anywhere: all passages of similarity 0.8 are found."""
    r = random.Random(8)
    sizes = [9, 12, 13, 15, 16, 22, 31, 38, 49, 57, 95]
    items = [(n, passage(n, f"w{n}x")) for n in sizes]
    texts = []
    for n, item in items:
        for _ in range(16):
            own = item.split()
            for _ in range(r.randint(1, 1 + n // 45)):
                at = r.choice([0, len(own) - 1, r.randrange(len(own))])
                own[at:at + 1] = r.choice([["q"], ["q"], [], [own[at], "q"]])
            before, after = r.randrange(20), r.choice([0, 30])
            texts.append(" ".join([f"a{i}" for i in range(before)] + own + ["z"] * after))
    got, want = run(spark, docs(texts), items), plain(list(enumerate(texts)), items)
    above = {k for k, v in want.items() if v > 0.8 + 1e-9}  # at 0.8 itself the sums may round
    assert len(above) > 60 and above <= got.keys() <= want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_hard_cases(spark, docs):
    item = passage(20, "w")
    items = [(1, item), (2, item), (3, None), (4, ""), (5, "..."), (None, passage(16, "n"))]
    texts = [None, "", "?!", item, (3, item), (None, item), passage(16, "n"),
             "x " * 30000 + item, passage(19, "w")]
    got = run(spark, docs(texts), items)
    assert {k for k, v in got.items() if v == 1.0} == {
        (3, 1), (3, 2), (None, 1), (None, 2), (6, None), (7, 1), (7, 2)}


def test_documents_with_leaks_go(spark, docs):
    item = passage(20, "w")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    frame = docs([item, "clean", None, (None, "a b " + item), (None, "clean")]).selectExpr(
        "*", "1 as mark", "2 as words")
    frame = frame.selectExpr("*", "1 as _mark", "2 as Mark_")
    kept = decontaminate.without_leaks(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == [
        "(1, 'clean')", "(2, None)", "(None, 'clean')"]


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert run(spark, docs([]), [(1, "a b c d e f")]) == {}
    assert decontaminate.leaks(docs(["a"]), empty).collect() == []
    assert decontaminate.without_leaks(docs(["a"]), empty).count() == 1


def test_native_plan(spark, real):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert not re.search("Python|Arrow|Pandas", plan(decontaminate.leaks(real, benchmark)))
