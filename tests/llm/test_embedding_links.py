"""Embedding links against brute force, with windows, blocks and parts far smaller than the groups."""

import math

import numpy as np
import pytest

from tidewater.llm import embedding_links

SCHEMA = {"float": "vec_id long, embedding array<float>", "double": "vec_id long, embedding array<double>"}


def _want(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    component = np.arange(len(x))
    while True:
        now = np.minimum(component, np.where(links, component, 1 << 40).min(1))
        if (now == component).all():
            return links.sum(1).tolist(), component.tolist()
        component = now


@pytest.mark.parametrize("kind, window, block, part_bytes", [("float", 16, 64, 2000), ("double", 32, 40, 1 << 20), ("float", 1024, 8192, 1 << 22)])
def test_groups_over_the_window_lose_nothing(spark, kind, window, block, part_bytes):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 16))
    tight = base[0] + 1e-6 * rng.standard_normal((250, 16))  # one key in every pass
    loose = base[1] + 0.1 * rng.standard_normal((300, 16))
    chain = [base[2]]
    for _ in range(60):
        chain.append(chain[-1] + 0.35 * rng.standard_normal(16))
    x = np.concatenate([base, tight, loose, np.array(chain), base[5:8], base[5:8]])
    x = x.astype(np.float32).astype(float) if kind == "float" else x
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], SCHEMA[kind])
    got = {r.vec_id: r for r in embedding_links.link_embeddings(df, window=window, block=block, miss=1e-5, part_bytes=part_bytes).collect()}
    links, component = _want(x)
    assert [got[k].n_links for k in range(len(x))] == links
    assert [got[k].component_id for k in range(len(x))] == component
    assert max(links) > 3 * min(window, 80)


def test_passes_grow_with_the_table():
    counts = [embedding_links.passes_for(n, 1024, 0.9, 0.002) for n in (10, 1024, 10_000, 100_000, 10_000_000)]
    assert counts[:2] == [1, 1] and counts == sorted(counts) and counts[-1] > 2 * counts[-2]
    p = 1 - math.acos(0.9) / math.pi
    assert (1 - p ** (math.log2(100_000 / 1024) + 1)) ** counts[3] <= 0.002


def test_pairs_near_the_limit_are_settled_in_doubles():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((300, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.standard_normal((300, 64))
    o -= (o * a).sum(1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    c = 0.9 + rng.uniform(-1, 1, (300, 1)) * 1e-9
    b = c * a + np.sqrt(1 - c * c) * o
    assert (np.diag(embedding_links._near(a, b, 0.9)) == (np.einsum("ij,ij->i", a, b) >= 0.9)).all()
