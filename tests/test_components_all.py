"""Components over all lineitem edges of a small fixture, by the registered query, against union-find."""

import random

import __spark_entry__


def test_every_edge_reaches_the_operator(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.randrange(1, 200), rng.randrange(1, 120), float(rng.randrange(1, 51)), rng.randrange(11) / 100) for _ in range(150)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_quantity double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for order, part, *_ in rows:
        a, b = find(order), find(-part)
        parent[max(a, b)] = min(a, b)
    got = __spark_entry__.queries()["k07_components_all"](spark, str(tmp_path)).collect()
    assert dict(map(tuple, got)) == {x: find(x) for x in list(parent)}
    assert len(got) == len(parent)
