import random

import pytest

from starkeel.llm.components import components
from starkeel.llm.staging import Workspace


@pytest.mark.parametrize("piece", [10**6, 40])
def test_components_in_one_piece_and_in_many(spark, piece):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000 + i, 1000) for i in range(1, 80)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)] + [(7, 7), (3, 2), (3, 2)]
    rng.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        parent[max(find(u), find(v))] = min(find(u), find(v))
    found = components(spark.createDataFrame(edges, "u bigint, v bigint"), Workspace(spark, "t"), "c", piece)
    assert {(r["u"], r["v"]) for r in found.collect()} == {(x, find(x)) for x in parent if find(x) != x}
    assert found.count() == len({x for x in parent if find(x) != x})


def test_no_links(spark):
    none = spark.createDataFrame([], "u bigint, v bigint")
    assert components(none, Workspace(spark, "t"), "c").collect() == []
