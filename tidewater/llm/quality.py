"""Quality classifier by co-training of two views of a document.

The content view reads the text (shares of character kinds, repetition of words
and lines, word lengths); the metadata view reads the page's recorded facts
(language, source, size). Each view is a naive Bayes model over binned features, so training is one
grouped count over all documents: nothing is sampled. Each round, a document
without a label gets a pseudo-label for one view's model from the other view, where that
is confident: beyond a score at which the labelled training rows say that at
least ``confidence`` of its calls of the class are right. At the end, the two views' scores are
calibrated together by a logistic model on the labelled training rows.

Only counts leave the executors: (feature, bin, class) and (score cell, class),
both of fixed size.

Defined cases: a null or empty text falls in its own bins (no words); null lang,
source and n_chars have bins of their own; a label that is null or not 0 or 1 is
no label; of several labels of a document the least counts; repeated documents are
scored alike; a null doc_id is scored but never labelled; an empty table gives no
row; without labels of both classes every document gets the share of good labels
(1.0 with none at all); extra columns of any name pass ``keep_good`` unharmed.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches, fresh
from tidewater.workspace import Workspace

BINS = 24
CONTENT = (
    "size", "distinct", "repeats", "upper", "shouting", "marks", "exclaims", "bars", "digits", "stops", "lines", "same_lines", "word_length", "wide", "controls",
)
METADATA = ("lang", "source", "n_chars", "lang_source")
#: Score cells for calibration, over log-odds from -SPAN to SPAN.
CELLS, SPAN = 64, 32.0

_KIND = np.zeros((256, 8), np.float64)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*@^~_=+<>{}[]\\", b"!?", b"|", b"0123456789", b".,;:", b"\n", bytes(range(0x80, 0x100)))):
    _KIND[list(_bytes), _k] = 1


def _share_bin(share: float) -> int:
    """Bins of a share in [0, 1], finer towards zero: 0 for none, then halves of a factor two."""
    return 0 if share <= 0 else max(1, min(BINS - 1, BINS - 1 + math.floor(1.5 * math.log2(min(share, 1.0)))))


def content_bins(text: str | None) -> list[int]:
    """One bin for each name in CONTENT."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = text.split() if text else []
    n, size = len(words), max(1, len(data))
    if not n:
        return [BINS - 1] * len(CONTENT)
    upper, marks, exclaims, bars, digits, stops, breaks, wide = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _KIND
    lines = [x for x in text.split("\n") if x.strip()]
    scale = min(BINS - 1, int(math.log2(n) * 1.5))
    distinct = len(set(words)) / n
    return [
        scale,
        (scale // 6) * 6 + min(5, int(distinct * 6)),
        _share_bin(sum(map(eq, words, words[1:])) / n),
        _share_bin(upper / size),
        _share_bin(sum(map(str.isupper, words)) / n),
        _share_bin(marks / size),
        _share_bin(exclaims / size),
        _share_bin(bars / size),
        _share_bin(digits / size),
        _share_bin(stops / size),
        _share_bin(breaks / n),
        _share_bin(1 - len(set(lines)) / len(lines)) if lines else 0,
        min(BINS - 1, int(2 * len(data) / n)),
        _share_bin(wide / size),
        _share_bin(sum(map(data.count, (b"\x00", b"\xef\xbf\xbd", b"\x1b"))) / size),
    ]


def _metadata_columns() -> list:
    lang, source = F.coalesce("lang", F.lit("\0")), F.coalesce("source", F.lit("\0"))
    size = F.when(F.col("n_chars").isNull() | (F.col("n_chars") < 1), 0).otherwise(F.least(F.lit(BINS - 1), 1 + F.floor(F.log2(F.col("n_chars").cast("double")))))
    spread = lambda *x: F.pmod(F.xxhash64(*x), F.lit(BINS))
    return [spread(lang), spread(source), size, spread(lang, source)]


def _features(docs: DataFrame, labels: DataFrame, learn: str) -> DataFrame:
    """doc_id, bins (binary: content then metadata), label (of the rows to learn from), one row per document."""
    n = len(CONTENT)

    def run(batches):
        for batch in batches:
            own = [bytes(content_bins(x.as_py())) for x in batch.column(1)]
            bins = [a + bytes(b) for a, b in zip(own, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins, pa.binary())], ["doc_id", "bins"])

    bound_batches(docs.sparkSession)
    facts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.array(*[x.cast("int") for x in _metadata_columns()]).alias("facts"))
    rows = facts.mapInArrow(run, "doc_id long, bins binary")
    known = labels.where("quality in (0, 1) and doc_id is not null").where(learn).groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.min("quality").alias("label"))
    return rows.join(known, F.col("doc_id") == F.col("of"), "left").select("doc_id", "bins", F.col("label").cast("int"))


def _views() -> tuple[np.ndarray, np.ndarray]:
    n = len(CONTENT)
    return np.arange(n), np.arange(n, n + len(METADATA))


def _matrix(column) -> np.ndarray:
    width = len(CONTENT) + len(METADATA)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


class NaiveBayes:
    """Log-odds of class 1 by (feature, bin), with add-one smoothing. The evidence of v features counts for the root of v."""

    def __init__(self, counts: np.ndarray, view: np.ndarray):
        held = counts[view] + 1.0
        odds = np.log(held[:, :, 1] / held[:, :, 1].sum(1, keepdims=True)) - np.log(held[:, :, 0] / held[:, :, 0].sum(1, keepdims=True))
        self.view, self.odds = view, odds

    def score(self, bins: np.ndarray) -> np.ndarray:
        return self.odds[np.arange(len(self.view)), bins[:, self.view]].sum(1)


def _cell(score: np.ndarray) -> np.ndarray:
    return np.clip(((score + SPAN) * CELLS / (2 * SPAN)).astype(np.int64), 0, CELLS - 1)


def _counted(rows: DataFrame, slots: int, count) -> np.ndarray:
    """count(bins, label) gives slots to be counted; the sums over all rows, an array of that many."""

    def run(batches):
        total = np.zeros(slots, np.int64)
        for batch in batches:
            if batch.num_rows:
                label = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
                total += np.bincount(count(_matrix(batch.column(0)), label), minlength=slots)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    sums = rows.select("bins", "label").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(slots)
    for slot, n in sums.collect():  # at most `slots` rows
        out[slot] = n
    return out


def _feature_counts(rows: DataFrame, label_of) -> np.ndarray:
    """Counts (feature, bin, class) over the rows for which label_of(bins, label) is 0 or 1."""
    width = len(CONTENT) + len(METADATA)

    def count(bins, label):
        given = label_of(bins, label)
        have = given >= 0
        return ((np.arange(width) * BINS + bins[have]) * 2 + given[have, None]).ravel().astype(np.int64)

    return _counted(rows, width * BINS * 2, count).reshape(width, BINS, 2)


def _limits(cells: np.ndarray, confidence: float) -> tuple[int, int]:
    """Cells at or under the first are confidently 0, at or over the second confidently 1, by labelled counts (cell, class)."""
    zero, one = cells[:, 0].cumsum(), cells[::-1, 1].cumsum()
    low_all, high_all = cells.sum(1).cumsum(), cells[::-1].sum(1).cumsum()
    low = np.flatnonzero((zero >= confidence * low_all) & (low_all >= 20))
    high = np.flatnonzero((one >= confidence * high_all) & (high_all >= 20))
    return (int(low[-1]) if len(low) else -1), (CELLS - 1 - int(high[-1]) if len(high) else CELLS)


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (with the intercept last) of a logistic model on weighted rows, by Newton's method."""
    design, weight, total = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1), good + bad
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        slope = design.T @ (good - total * p) - ridge * weight
        step = np.linalg.solve(design.T @ (design * (total * p * (1 - p))[:, None]) + ridge * np.eye(len(weight)), slope)
        weight += step
        if np.abs(step).max() < 1e-9:
            break
    return weight


class CoTrained:
    """The two views' models and the weights that combine their scores."""

    def __init__(self, rows: DataFrame, rounds: int, confidence: float):
        first, second = _views()
        counts = _feature_counts(rows, lambda bins, label: label)
        classes = counts[0].sum(0)
        self.share = float(classes[1] / classes.sum()) if classes.sum() else 1.0
        self.weight = None
        self.history: list[tuple] = []
        if not classes.all():
            return
        self.a, self.b = NaiveBayes(counts, first), NaiveBayes(counts, second)
        for _ in range(rounds):
            a, b = self.a, self.b
            cells = self._cells(rows)
            low_a, high_a = _limits(cells.sum(1), confidence)
            low_b, high_b = _limits(cells.sum(0), confidence)
            self.history.append((low_a, high_a, low_b, high_b))

            def given(model, low, high):
                def label_of(bins, label):
                    cell = _cell(model.score(bins))
                    guess = np.where(cell <= low, 0, np.where(cell >= high, 1, -1))
                    return np.where(label >= 0, label, guess)

                return label_of

            both = [_feature_counts(rows, given(*x)) for x in ((b, low_b, high_b), (a, low_a, high_a))]
            self.a, self.b = NaiveBayes(both[0], first), NaiveBayes(both[1], second)
        cells = self._cells(rows)
        at = (np.arange(CELLS) + 0.5) * 2 * SPAN / CELLS - SPAN
        x, y = np.meshgrid(at, at, indexing="ij")
        good, bad = cells[:, :, 1].ravel(), cells[:, :, 0].ravel()
        seen = good + bad > 0
        self.weight = _logistic(np.column_stack([x.ravel(), y.ravel()])[seen], good[seen], bad[seen])

    def _cells(self, rows: DataFrame) -> np.ndarray:
        a, b = self.a, self.b

        def count(bins, label):
            have = label >= 0
            return (_cell(a.score(bins[have])) * CELLS + _cell(b.score(bins[have]))) * 2 + label[have].astype(np.int64)

        return _counted(rows, CELLS * CELLS * 2, count).reshape(CELLS, CELLS, 2)

    def good(self, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of class 1, and the log-odds of either view."""
        if self.weight is None:
            nothing = np.zeros(len(bins))
            return np.full(len(bins), self.share), nothing, nothing
        a, b = (np.clip(m.score(bins), -SPAN, SPAN) for m in (self.a, self.b))
        return 1 / (1 + np.exp(-np.clip(np.column_stack([a, b, np.ones(len(a))]) @ self.weight, -500, 500))), a, b


_SCORES = "doc_id long, score double, content_score double, metadata_score double"


def score_quality(docs: DataFrame, labels: DataFrame, learn: str = "true", rounds: int = 3, confidence: float = 0.99, reject_under: float = 0.5) -> DataFrame:
    """One row per document: probability of good quality, either view's log-odds, and whether the document is kept.

    ``learn`` is the SQL condition on doc_id of the labels to learn from.
    """
    space = Workspace(docs.sparkSession, "quality")
    rows, _ = space.table(_features(docs, labels, learn), "features")
    model = CoTrained(rows, rounds, confidence)

    def run(batches):
        for batch in batches:
            good, a, b = model.good(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good), pa.array(a), pa.array(b)], [x.split()[0] for x in _SCORES.split(", ")])

    scored = rows.select("doc_id", "bins").mapInArrow(run, _SCORES)
    return scored.withColumn("kept", F.col("score") >= reject_under)


def keep_good(docs: DataFrame, labels: DataFrame, rounds: int = 3, confidence: float = 0.99, reject_under: float = 0.5) -> DataFrame:
    """The rows of docs that the classifier does not reject, all columns as they were."""
    space = Workspace(docs.sparkSession, "quality-keep")
    rows, path = space.table(_features(docs, labels, "true"), "features")
    model = CoTrained(rows, rounds, confidence)
    space.drop(path)
    place = {name: docs.columns.index(name) for name in ("text",)}
    width = len(docs.columns)

    def run(batches):
        for batch in batches:
            own = [bytes(content_bins(x.as_py())) for x in batch.column(place["text"])]
            bins = pa.array([a + bytes(b) for a, b in zip(own, batch.column(width).to_pylist())], pa.binary())
            keep = model.good(_matrix(bins))[0] >= reject_under if batch.num_rows else np.zeros(0, bool)
            yield batch.select(range(width)).filter(pa.array(keep))

    facts = F.array(*[x.cast("int") for x in _metadata_columns()])
    return docs.select("*", facts.alias(fresh(docs, "facts"))).mapInArrow(run, docs.schema)
