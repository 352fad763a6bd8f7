"""The near_duplicates stage against brute force over all pairs."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import near_copies

SF = "/root/testdata/sf0.01"


def _shingles(text, size=5):
    words = (text or "").lower().split()
    return {" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def _components(rows, likeness=0.8):
    """Index of the least row of each row's component, by comparing all pairs."""
    sets, label = [_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for b in range(len(rows)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if both >= likeness * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(rows))]


def _chain(n):
    """Near copies each of the next, the ends far apart; a common passage; short, blank and null texts; rows without an id."""
    texts = [" ".join(f"w{k}" for k in range(5 * j, 5 * j + 60)) for j in range(n)]
    texts += ["stop " + " ".join(f"p{k}" for k in range(30)) + f" own{j} " + " ".join(f"q{j}_{k}" for k in range(j)) for j in range(n)]
    texts += [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d e f"]
    return [(100 + k, t) for k, t in enumerate(texts)] + [(None, texts[0]), (None, "alone without an id")]


def _roots(spark, rows):
    got = near_copies.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups: dict = {}
    for x in got:
        groups.setdefault(x.root, []).append(x["_row"])
    return sorted(sorted(x) for x in groups.values())


@pytest.mark.parametrize("frequent", [0, 8])
def test_components_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(near_copies, "FREQUENT", frequent)
    monkeypatch.setattr(near_copies, "SAMPLE", 1 if not frequent else 32)
    rows = _chain(14)
    keyed = near_copies._with_row(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    own = {(x.doc_id, x.text): x["_row"] for x in keyed}
    groups: dict = {}
    for row, root in zip(rows, _components(rows)):
        groups.setdefault(root, []).append(own[row])
    assert _roots(spark, rows) == sorted(sorted(x) for x in groups.values())
    assert near_copies.keep_one(spark.createDataFrame(rows[:0], "doc_id long, text string")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_stage_has_full_recall_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()))
    want = {rows[k][0] for k, root in enumerate(_components(rows)) if k == root}
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.select(F.col("doc_id")).collect()) == sorted(want)


def test_one_row_of_each_component_stays(spark):
    """Null and repeated ids: components of null ids alone, near copies with and without an id, two texts under one id."""
    long = " ".join(f"w{k}" for k in range(80))
    rows = [(None, "only here"), (None, "another text alone"), (None, "only here"), (1, long), (None, long + " x"), (1, long), (2, long + " y")]
    rows += [(7, "first text of seven"), (7, "second text of seven"), (7, "first text of seven"), (8, "second text of seven"), (None, None), (None, "")]
    for held in (rows, rows[:7], rows[7:], [x for x in rows if x[0] is None]):
        kept = near_copies.keep_one(spark.createDataFrame(held, "doc_id long, text string")).collect()
        least: dict = {}
        for (doc_id, text), root in zip(held, _components(held)):
            least.setdefault(root, []).append((doc_id is None, doc_id or 0, text))
        assert len(kept) == len(least)
        got = sorted((x.doc_id is None, x.doc_id or 0, (x.text or "")) for x in kept)
        assert [x[:2] for x in got] == sorted(min(x[:2] for x in group) for group in least.values())
        assert all(any((*x[:2], x[2]) in [(*y[:2], y[2] or "") for y in group] for group in least.values()) for x in got)


def test_simhash_meets_the_pairs_it_can_reach(spark, monkeypatch):
    words = [f"w{k}" for k in range(900)]
    texts = [" ".join([*words[:at], f"new{at}", *words[at + 1 :]]) for at in range(0, 900, 75)] + [" ".join(words[::-1]), "alone", None]
    rows, asked = list(enumerate(texts)), []

    def recorded(prints, within):
        pairs = hamming_pairs(prints, within)
        asked.append(({x[0] for x in prints.collect()}, within, {tuple(x) for x in pairs.collect()}))
        return pairs

    hamming_pairs = near_copies.hamming_pairs
    monkeypatch.setattr(near_copies, "hamming_pairs", recorded)
    found = _roots(spark, rows)
    assert sorted(map(len, found)) == [1, 1, 1, 12]
    prints = {near_copies.majority(near_copies.shingle_set(t.encode() if t else None)) for t in texts}
    signed = {x - (1 << 64) if x >> 63 else x for x in prints}
    (got, within, pairs), = asked
    assert got == signed
    assert pairs == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= within} and pairs
