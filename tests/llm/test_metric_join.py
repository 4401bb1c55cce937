"""Metric join against the full matrix of cosines."""

import math

import numpy as np
import pytest

from tidemart.llm import metric_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    def sound(v):
        return v is not None and len(v) and all(
            x is not None and math.isfinite(x) for x in v) and any(v)

    linked = np.zeros((len(rows), len(rows)), bool)
    for dims in {len(v) for _, v in rows if sound(v)}:
        good = [i for i, (_, v) in enumerate(rows) if sound(v) and len(v) == dims]
        x = np.array([np.float32(rows[i][1]) for i in good], np.float64)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        linked[np.ix_(good, good)] = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    links, part = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        links[i] = int(linked[i].sum())
        for j in np.flatnonzero(linked[i]):
            if part[i] != part[j]:
                part = [part[i] if p == part[j] else p for p in part]
    names = {}
    for (v, _), p in zip(rows, part, strict=True):
        if v is not None:
            names[p] = min(v, names.get(p, v))
    return sorted(((v, links[i], names.get(part[i])) for i, (v, _) in enumerate(rows)), key=repr)


def compare(spark, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    out = metric_join.near_vectors(frame).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out),
                  key=repr) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def cloud(seed, n=240, dims=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dims))
    noise = r.choice([0.0, 0.05, 0.25, 0.6], n)[:, None] * r.normal(size=(n, dims))
    points = centres[r.integers(0, 6, n)] + noise
    return [(i, [float(v) for v in p]) for i, p in enumerate(points.astype(np.float32))]


@pytest.mark.parametrize("seed,per_root,home,members", [
    (0, 16, 4096, 8192), (1, 2, 4096, 8192), (2, 2, 7, 13), (3, 1, 16, 16)])
def test_clouds(spark, monkeypatch, seed, per_root, home, members):
    monkeypatch.setattr(metric_join, "PER_ROOT", per_root)
    monkeypatch.setattr(metric_join, "HOME", home)
    monkeypatch.setattr(metric_join, "MEMBERS", members)
    compare(spark, cloud(seed))


def test_hard_cases(spark):
    compare(spark, [
        (0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
        (8, [2.0, 0.0]), (9, [1e-30, 0.0]), (10, [3e38, 1e38]), (11, [1.0, 1 / 3]),
        (12, [-1.0, 0.0]), (None, [1.0, 0.0]), (13, [1.0, 0.0, 0.0]), (None, None)])


def test_every_length_is_joined(spark):
    rows = cloud(5, 60, 4) + [(100 + i, v) for i, v in cloud(6, 90, 12)]
    compare(spark, rows)
    links = {i: n for i, n, _ in plain(rows)}
    assert any(n for i, n in links.items() if i < 60) and any(
        n for i, n in links.items() if i >= 100)


def test_clashing_columns_and_vectors_of_doubles(spark):
    rows = cloud(7, 80, 3)
    frame = spark.createDataFrame(
        [(i, v, "x", 1, 2.0) for i, v in rows],
        "vec_id long, embedding array<double>, vec string, node int, label double")
    out = metric_join.near_vectors(frame).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out),
                  key=repr) == plain(rows)


def test_more_than_one_cell_at_every_size_and_no_bound():
    assert [metric_join.pivot_count(n) for n in (0, 1, 2, 200, 2000, 10 ** 6, 10 ** 10)] == [
        0, 1, 2, 2, 4, 64, 6251]


def test_strips_prune_by_angle(monkeypatch):
    r = np.random.default_rng(1)
    x = np.concatenate([c + 0.02 * r.normal(size=(300, 8)) for c in 3 * r.normal(size=(9, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    angle = np.arccos(np.clip(x @ x[0], -1, 1))
    x, angle = x[np.argsort(angle)], np.sort(angle)
    linked = metric_join.links_of(x, x, angle, angle)
    assert (linked == (x @ x.T >= 0.95)).all()
    compared = sum(
        len(x[i:i + 256]) * np.subtract(*metric_join.reached(angle[i:i + 256], angle)[::-1])
        for i in range(0, len(x), 256))
    assert linked.sum() <= compared < 0.6 * len(x) ** 2


def test_empty_tables(spark):
    compare(spark, [])
    compare(spark, [(1, None), (2, [])])


def test_real_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    got = metric_join.near_vectors(frame).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got),
                  key=repr) == plain(rows)
