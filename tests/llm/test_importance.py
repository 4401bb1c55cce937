"""Importance resampling: models against plain counts, selection against a sort, labels."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from llm_cases import docs, real, SF  # noqa: F401
from tidemart.llm import importance


def buckets(texts):
    out = []
    for _, found, bounds in importance.features([t.encode() for t in texts]):
        out += [found[a:b][found[a:b] >= 0].tolist()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def test_features_are_unigrams_and_bigrams_of_each_text():
    one, two, none, both = buckets(["a b!", "A  b", "", "a b! A b"])
    assert len(one) == 5 and len(two) == 3 and none == []
    assert Counter(two) <= Counter(one) and len(both) == 9
    assert Counter(one) + Counter(two) <= Counter(both)


def test_weights_are_tempered_sums_of_log_ratios(spark, docs):
    texts = ["a b c", "a b b b", None, "", "spam spam spam", "a c"]
    frame = docs(texts)
    sample = spark.createDataFrame([(0, 1), (4, 0), (5, 1)], "doc_id long, good int")
    own = buckets([t or "" for t in texts])
    raw, target = Counter(x for o in own for x in o), Counter(own[0] + own[5])
    size = importance.BUCKETS
    ratio = {b: math.log((target[b] + 1) / (target.total() + size))
             - math.log((raw[b] + 1) / (raw.total() + size)) for b in raw}
    got = {r["doc_id"]: r for r in importance.scored(frame, sample).collect()}
    for i, o in enumerate(own):
        whole = sum(ratio[b] for b in o) / max(len(o), 1) ** 0.5
        assert got[i]["log_ratio"] == pytest.approx(importance.WEIGHT_OF * whole, abs=1e-9)
    assert got[4]["log_ratio"] < got[5]["log_ratio"]


def test_a_toxic_score_is_a_factor_beyond_those_of_good_labels(spark):
    rows = spark.createDataFrame(
        [(0, 5, 1.0, 0.5, 1), (1, 5, 1.0, 2.0, 2), (2, 5, 1.0, importance.NO_SCORE, 3)],
        "doc_id long, n_words long, log_ratio double, toxic_score double, mark long")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, good int, toxic int")
    got = {r["doc_id"]: r["log_weight"] for r in importance.weighted(rows, labels).collect()}
    assert got[0] == got[2] == 1.0
    assert got[1] == pytest.approx(1.0 - importance.TOXIC_WEIGHT * 1.5, abs=1e-4)


@pytest.mark.parametrize("k", [1, 2, 7, 50, 399, 400])
def test_kth_largest(spark, k):
    r = np.random.default_rng(k)
    values = [int(v) for v in r.integers(-10**12, 10**12, 300)] + [5] * 100
    frame = spark.createDataFrame([(v,) for v in values], "code long")
    assert importance.kth_largest(frame, k, ranges=16) == sorted(values)[-k]


def test_kth_largest_of_nothing(spark):
    frame = spark.createDataFrame([], "code long")
    assert importance.kth_largest(frame, 3) is None


def test_inclusion_follows_the_weights(spark):
    """Over many seeds: first places as the weights' shares, places in the first two as drawing
    without replacement gives them."""
    weight = [0.0, 1.0, 1.0, 2.0, -3.0]
    seeds = 20_000
    frame = spark.createDataFrame(list(enumerate(weight)), "doc_id long, log_weight double")
    keys = frame.crossJoin(spark.range(seeds).withColumnRenamed("id", "seed")).withColumn(
        "key", importance.gumbel_key(F.col("log_weight"), F.xxhash64("doc_id", "seed")))
    order = Window.partitionBy("seed").orderBy(F.desc("key"))
    top = keys.withColumn("place", F.row_number().over(order)).groupBy("doc_id").agg(
        F.count_if(F.col("place") == 1).alias("first"),
        F.count_if(F.col("place") <= 2).alias("two")).collect()
    share = np.exp(weight) / np.exp(weight).sum()
    for r in top:
        i = r["doc_id"]
        second = sum(share[j] * share[i] / (1 - share[j]) for j in range(5) if j != i)
        assert abs(r["first"] / seeds - share[i]) < 0.015
        assert abs(r["two"] / seeds - share[i] - second) < 0.015


def test_a_rate_draws_that_many_and_not_by_the_weight_alone(spark, real):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = importance.selected(real, labels, rate=0.4).collect()
    kept = [r["log_weight"] for r in rows if r["kept"]]
    assert abs(len(kept) - 0.4 * len(rows)) <= 1
    by_weight = sorted((r["log_weight"] for r in rows), reverse=True)[:len(kept)]
    assert sum(w < by_weight[-1] for w in kept) > 0.02 * len(kept)  # noise lets others in
    assert importance.selected(real, labels, rate=0.0).where("kept").count() == 0
    with pytest.raises(ValueError):
        importance.selected(real, labels, rate=1.5)


def test_selection_is_the_top_k_of_the_keys(spark, real):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = importance.selected(real, labels).collect()
    kept = sorted(r["gumbel_key"] for r in rows if r["kept"])
    rest = [r["gumbel_key"] for r in rows if not r["kept"]]
    assert kept and max(rest) <= kept[0] + 1e-5
    assert len(rows) == real.count()
    noise = np.array([r["gumbel_key"] - r["log_weight"] for r in rows])
    assert abs(noise.mean() - 0.5772) < 0.4 and 0.9 < noise.std() < 1.7


def test_good_labels_stay_and_most_bad_go(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = importance.selected(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = found.join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.15


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = importance.selected(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = found.join(labels, "doc_id").collect()
    toxic = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 1]
    assert sum(toxic) / len(toxic) < 0.3


def test_the_cut_is_taken_from_all_labels_and_any_weight(spark, docs, monkeypatch):
    """A good label outside the sample, with a weight far below a bad one's, still stays."""
    whole = importance.label_sample
    monkeypatch.setattr(importance, "label_sample", lambda x: whole(x).where("doc_id < 2"))
    frame = docs(["plain words here " * 20, "### $$$ " * 200, "rare tongue " * 1000,
                  *["plain words here " * 20] * 20])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in importance.selected(frame, labels).collect()}
    assert rows[2]["log_weight"] < rows[1]["log_weight"] - 10
    assert all(r["kept"] for r in rows.values())


def test_edge_cases(spark, docs):
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, 0, 0), (0, 1, None), (None, 1, 0), (7, None, 0)],
        "doc_id long, quality int, toxic int")
    good, bad = "plain words here " * 20, "### $$$ *** " * 20
    frame = docs([good, bad, None, "", (None, bad), bad, (5, good)]).selectExpr(
        "*", "1 as good", "2 as kept")
    kept = importance.resample(frame, labels)
    assert kept.columns == frame.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert (0, good) in got and (1, bad) not in got and (None, bad) in got and (5, bad) in got
    assert importance.resample(docs([]), labels).collect() == []
    none = labels.where("quality = 1")
    assert importance.resample(docs([good, bad]), none).count() == 2
    assert importance.resample(docs([good, bad]), labels.limit(0)).count() == 2
