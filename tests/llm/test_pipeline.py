"""The pipeline's stages on small tables, and co-training against a plain reading of its definition."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tidewater.llm import mixing, quality
from tidewater.workspace import Workspace

#: Names that stages use inside; as columns of documents they must pass unharmed.
CLASHING = (
    "rate limits draws mix_source _mix times _times row named facts _facts row_key _row_key _row root id size key prefix parity first of label bins mask items copy"
    " repetition_rate shuffle_key score kept d n h packed content"
).split()
VOCABULARY = [f"word{k}" for k in range(150)]


def _tables(spark, folder):
    rng = random.Random(21)
    text = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n)) + "."
    item = " ".join(f"test{k}" for k in range(12))
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        docs.append((k, " ".join(w + "###$$" for w in text(60).split()) if bad else text(60), "en", "web" if k % 3 else None, 300))
        if k % 2 == 0:
            labels.append((k, int(not bad), 0))
    docs[101] = (101, docs[103][1], "en", "web", 300)  # an exact copy: 101 stays
    docs[105] = (105, docs[107][1] + " tail", "en", "web", 300)  # a near copy: 105 stays
    docs[109] = (109, docs[109][1] + " " + item.upper(), "en", "web", 300)
    docs += [(None, docs[111][1], None, None, None), (None, None, None, None, None)]
    extra = {name: k for k, name in enumerate(CLASHING)}
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{x} long" for x in CLASHING)
    spark.createDataFrame([(*x, *extra.values()) for x in docs], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, extra


def test_stages_do_what_they_say_and_keep_columns(spark, tmp_path):
    docs, extra = _tables(spark, tmp_path)
    now, space, got = spark.read.parquet(f"{tmp_path}/documents.parquet"), Workspace(spark, "test"), {}
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES:
        now, _ = space.table(stage(spark, now, str(tmp_path)), name)
        got[name] = now.collect()
        if name != "token_ids":
            assert now.columns == columns
            assert all(x[k] == v for x in got[name] for k, v in extra.items())
    texts = {k: t for k, t, *_ in docs}
    ids = lambda name: {x.doc_id for x in got[name]}
    clean = {k for k in range(400) if k % 4}
    assert clean <= ids("quality") and not {k for k in range(0, 400, 4)} & ids("quality")
    assert ids("near_duplicates") - {None} == (ids("quality") - {None, 103, 107})
    assert sum(x.doc_id is None and x.text == texts[111] for x in got["near_duplicates"]) == 0
    assert ids("decontamination") == ids("near_duplicates") - {109}
    want = sorted((x.doc_id is not None, x.doc_id or 0) for x in got["mixing"])
    assert sorted((x.doc_id is not None, x.doc_id or 0) for x in got["token_ids"]) == want
    rates = mixing.source_rates(spark.createDataFrame(got["decontamination"], spark.read.parquet(f"{tmp_path}/documents.parquet").schema))
    assert {x.mix_source for x in rates.collect()} == {"", "web"}
    assert all(x.text == texts[x.doc_id] for x in got["mixing"] if x.doc_id is not None)
    whole = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert whole == sorted(map(str, got["token_ids"]))


def test_stages_on_empty_tables(spark, tmp_path):
    _tables(spark, tmp_path / "full")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def _plain_co_training(bins, labels, rounds, confidence):
    """Both views' models by loops over documents; the calibration's inputs are compared, its solver is shared."""
    n, m = len(quality.CONTENT), len(quality.CONTENT) + len(quality.METADATA)
    views = (range(n), range(n, m))

    def train(view, given):
        counts = {(f, b, c): 1.0 for f in view for b in range(quality.BINS) for c in (0, 1)}
        for row, label in zip(bins, given):
            if label in (0, 1):
                for f in view:
                    counts[f, row[f], label] += 1
        total = {(f, c): sum(counts[f, b, c] for b in range(quality.BINS)) for f in view for c in (0, 1)}
        return {(f, b): np.log(counts[f, b, 1] / total[f, 1]) - np.log(counts[f, b, 0] / total[f, 0]) for f in view for b in range(quality.BINS)}

    score = lambda model, view, row: sum(model[f, row[f]] for f in view)
    cell = lambda x: min(quality.CELLS - 1, max(0, int((x + quality.SPAN) * quality.CELLS / (2 * quality.SPAN))))

    def limits(model, view):
        held = [(cell(score(model, view, r)), y) for r, y in zip(bins, labels) if y is not None]
        share = lambda rows, c: (sum(y == c for _, y in rows) / len(rows) >= confidence) if len(rows) >= 20 else False
        low = max((k for k in range(quality.CELLS) if share([x for x in held if x[0] <= k], 0)), default=-1)
        high = min((k for k in range(quality.CELLS) if share([x for x in held if x[0] >= k], 1)), default=quality.CELLS)
        return low, high

    models = [train(v, labels) for v in views]
    for _ in range(rounds):
        guesses = []
        for model, view in zip(models, views):
            low, high = limits(model, view)
            at = [cell(score(model, view, r)) for r in bins]
            guesses.append([y if y is not None else (0 if c <= low else 1 if c >= high else None) for y, c in zip(labels, at)])
        models = [train(views[0], guesses[1]), train(views[1], guesses[0])]
    return [[score(model, view, r) for r in bins] for model, view in zip(models, views)]


def test_co_training_equals_a_plain_version(spark, tmp_path):
    _tables(spark, tmp_path)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("documents", "labels"))
    docs = docs.where("doc_id is not null")
    got = {x.doc_id: x for x in quality.score_quality(docs, labels, rounds=2, confidence=0.9).collect()}
    rows = quality._features(docs, labels, "true").collect()
    texts = {x.doc_id: x.text for x in docs.collect()}
    assert all(list(x.bins)[: len(quality.CONTENT)] == quality.content_bins(texts[x.doc_id]) for x in rows)
    content, metadata = _plain_co_training([list(x.bins) for x in rows], [x.label for x in rows], 2, 0.9)
    for k, x in enumerate(rows):
        assert got[x.doc_id].content_score == pytest.approx(max(-quality.SPAN, min(quality.SPAN, content[k])))
        assert got[x.doc_id].metadata_score == pytest.approx(max(-quality.SPAN, min(quality.SPAN, metadata[k])))
