import random

import pytest

from tidemart.llm.components import connected_components


def plain(links):
    low = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 1), (2, 3)], [(i, i + 1) for i in range(40)],
    [(0, i) for i in range(1, 50)] + [(49, 60), (-5, 60)],
    [(random.Random(3).randrange(200) + k, (k * 37) % 90) for k in range(80)],
])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert got == plain([x for x in links if x[0] != x[1]])
