"""Sharding: exact sizes, every row once, and the law of a uniform shuffle."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import docs  # noqa: F401
from tidemart.llm import sharding


def spread(frame, **more):
    return sharding.shuffle_into_shards(frame, **more).collect()


@pytest.mark.parametrize("rows,parts,block", [(0, 1, 9), (1, 3, 9), (39, 4, 9), (40, 2, 9),
                                              (1003, 7, 200_000), (1003, 5, 4)])
def test_sizes_and_slots(spark, rows, parts, block):
    frame = spark.range(rows).repartition(parts).withColumn("part", F.lit(None).cast("string"))
    got = spread(frame, block_rows=block)
    assert sorted(r["id"] for r in got) == list(range(rows))
    sizes = Counter(r["shard"] for r in got)
    assert all(sizes[s] == rows // 40 + (s < rows % 40) for s in range(40))
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))


def test_same_rows_are_dealt_one_by_one(spark, docs):
    got = spread(docs([(1, "same")] * 100 + [(None, None)] * 20), shards=7)
    assert Counter(r["doc_id"] for r in got) == {1: 100, None: 20}
    assert max(Counter(r["shard"] for r in got).values()) == 18


def test_repeatable_and_seeded(spark):
    frame = spark.range(500).repartition(4, "id")
    one, two, other = (sorted((r["id"], r["shard"], r["slot"]) for r in spread(frame, seed=s))
                       for s in (1, 1, 2))
    assert one == two != other


def test_every_place_is_equally_likely(spark):
    """Over many seeds each row lands in each (shard, slot) about equally often."""
    ends, sizes = np.array([0, 2, 3, 6]), np.array([2, 2, 2])
    hits = Counter()
    for seed in range(3000):
        rows = [sharding.matrix_row(seed, ends, sizes, p) for p in range(3)]
        assert np.array(rows).sum(axis=0).tolist() == [2, 2, 2]
        assert [int(r.sum()) for r in rows] == [2, 1, 3]
        hits[tuple(map(int, rows[0]))] += 1
    # two rows into three pairs of places: 1/15 for a pair in one target, 4/15 for two targets
    for row, n in hits.items():
        assert abs(n / 3000 - (1 / 15 if 2 in row else 4 / 15)) < 0.035


def test_large_populations():
    rng = np.random.default_rng(5)
    for good, bad, draws in ((6 * 10**9, 4 * 10**9, 10**6), (10**8, 3 * 10**9, 10**9 * 2)):
        got = [sharding.hypergeometric(rng, good, bad, draws) for _ in range(400)]
        share = good / (good + bad)
        spread = (draws * share * (1 - share) * (good + bad - draws) / (good + bad - 1)) ** 0.5
        assert abs(np.mean(got) - draws * share) < 5 * spread / 20
        assert 0.85 < np.std(got) / spread < 1.15
    assert sharding.hypergeometric(rng, 3, 0, 2) == 2
    assert sharding.hypergeometric(rng, 0, 3, 2) == 0


def test_shards_are_written_whole(spark, docs):
    frame = docs([f"text {i}" for i in range(50)])
    back = spark.read.parquet(sharding.write_shards(frame, shards=4))
    assert sorted(r["text"] for r in back.collect()) == sorted(f"text {i}" for i in range(50))
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {
        0: 13, 1: 13, 2: 12, 3: 12}
