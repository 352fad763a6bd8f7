"""Language-model scoring against a plain reading of its definition."""

import inspect
import random
import zlib

import numpy as np
import pytest

from tidewater.llm import lm_scoring

SCHEMA = "doc_id long, text string"
DEFAULTS = {k: v.default for k, v in inspect.signature(lm_scoring.score_documents).parameters.items() if k != "docs"}


def _docs():
    rng = random.Random(11)
    docs = [(k, " ".join(f"{'ab'[k % 2]}{int(rng.paretovariate(0.7)) % 400}" for _ in range(120)) + f" rare{k}") for k in range(300)]
    return docs + [(400, None), (401, ""), (None, "A0 a0 unseen"), (402, docs[3][1]), (402, docs[3][1]), (403, "a1 " * 5000)]


def _words(text):
    return (text or "").lower().split() + ["\n"]


def _counts(docs):
    counts: dict = {}
    for k, text in docs:
        if zlib.crc32(b"" if k is None else str(k).encode()) % 10:
            for w in _words(text):
                counts[w] = counts.get(w, 0) + 1
    return counts


def _brute(fitted, counts, text):
    """log10 probability of a text, a symbol at a time, by the model's definition."""
    words, m = fitted.words, fitted.model
    place = {w.decode(): k for k, w in enumerate(words.order)}
    symbol = {w: int(words.symbol[k]) for w, k in place.items()}
    rest = len(words.shares) - 1
    mass = np.bincount(words.symbol, words.counts + 0.1, rest + 1)
    total = sum(counts.values()) + 0.1 * (len(counts) + 1)
    mass[rest] = total - mass[:rest].sum()
    out, x, y, frequent = 0.0, 0, 0, []
    for k, w in enumerate(_words(text)):
        s = symbol.get(w, rest)
        before = [symbol.get(v, rest) for v in _words(text)[:k]]
        x = before[-1] if before else 0
        frequent = [v for v in before[:-1] if v < words.frequent]
        y = frequent[-1] if frequent else 0
        logits = (m.r[x] @ m.c1 + m.r[y] @ m.c2) @ m.q.T + m.b
        logits = logits.astype(np.float64) - logits.max()
        out += (logits[s] - np.log(np.exp(logits).sum())) / np.log(10)
        if s >= words.frequent:
            out += np.log10((counts.get(w, 0) + 0.1) / mass[s])
    return out


def test_scores_and_counts_at_the_defaults(spark):
    docs = _docs()
    df, counts = spark.createDataFrame(docs, SCHEMA), _counts(docs)
    got = sorted(lm_scoring.score_documents(df).collect(), key=lambda x: (x.doc_id is None, x.doc_id))
    total, distinct = sum(counts.values()), len(counts)
    assert [x.doc_id for x in got] == sorted((k for k, _ in docs if k is not None)) + [None]
    fitted, texts = lm_scoring.Fitted(df, **DEFAULTS), {k: t for k, t in docs}
    assert fitted.learned == total
    assert len(fitted.words.shares) > fitted.words.frequent + 1 and abs(fitted.words.shares.sum() - 1) < 1e-12
    for x in got:
        words = _words(texts[x.doc_id])
        base = sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert x.base_score == pytest.approx(base) and x.train_tokens == total
        assert (x.n_tokens, x.n_known) == (len(words), sum(w in counts for w in words))
        assert x.held_out == (zlib.crc32(b"" if x.doc_id is None else str(x.doc_id).encode()) % 10 == 0)
        if len(words) < 500:
            assert x.score == pytest.approx(_brute(fitted, counts, texts[x.doc_id]), rel=1e-4, abs=1e-3)
    assert np.mean([x.score - x.base_score for x in got if x.held_out and x.n_tokens > 50]) > 0


def test_few_heads_leave_words_to_the_join(spark):
    docs = _docs()
    df, counts = spark.createDataFrame(docs, SCHEMA), _counts(docs)
    few = {**DEFAULTS, "heads": 40, "most_symbols": 20}
    fitted, texts = lm_scoring.Fitted(df, **few), dict(docs)
    assert len(fitted.words.order) <= 41 and fitted.words.frequent == 20
    for x in lm_scoring.score_documents(df, **few).where("doc_id < 30").collect():
        assert x.score == pytest.approx(_brute(fitted, counts, texts[x.doc_id]), rel=1e-4)
        assert x.n_known == sum(w in counts for w in _words(texts[x.doc_id]))


def test_scores_do_not_depend_on_the_splits(spark):
    df = spark.createDataFrame(_docs()[:300], SCHEMA)
    a, b = ({x.doc_id: x.score for x in lm_scoring.score_documents(df.repartition(n), shard_tokens=2000).collect()} for n in (1, 7))
    assert all(a[k] == pytest.approx(b[k], rel=1e-5) for k in a)


def test_no_training_text(spark):
    alone = spark.createDataFrame([(None, "a b"), (None, None)], SCHEMA)
    assert {(x.n_tokens, x.n_known, x.train_tokens) for x in lm_scoring.score_documents(alone).collect()} == {(3, 0, 0), (1, 0, 0)}
    assert lm_scoring.score_documents(alone.limit(0)).count() == 0
