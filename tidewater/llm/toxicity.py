"""Toxic passages by maximum-scoring segment search.

A word's forms are the word and its first four and five characters. The score of
a form is the log-odds of toxic against other labelled documents under a Dirichlet
prior in proportion to its frequency in all documents. A form counts only where it
is among the best explanations of most of the toxic documents that hold it, so a
word that merely came along in copies of one toxic document has no weight. A word
scores as its best form, any other word as ``-DRIFT``.

A scan in linear time gives every maximal segment of a text (all disjoint segments
that no extension improves). Local alignment statistics make scores comparable: the
rate L solves sum p(s) exp(L s) = 1 over words of the other labelled documents, and
K comes from their largest segments; L s - ln(K n) is a segment's significance in a
text of n words. The largest and the sum of the significances over zero are
calibrated to a probability by a logistic model on labelled documents, each scored
with weights that its own half of the labels had no part in.

The model is fitted on at most ``most_labels`` labelled rows (those of least hash); as
a form must be in LEAST of their toxic texts, this bounds what is shipped. No form that
passes is left out.

Defined cases: a null, empty or wordless text scores as one without toxic words; a
label that is null or not 0 or 1 is no label, of several the least counts; repeated
documents score alike; a null doc_id hashes as an empty text and is scored; without
labels of both classes every score is the share of toxic labels (0.0 with none); an
empty table gives no row; only doc_id and text of documents are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches
from tidewater.llm.quality import _logistic
from tidewater.workspace import Workspace

DRIFT, PRIOR, LEAST = 0.5, 500.0, 5
_WORD = re.compile(r"[^\W_]+")
CELLS, SPAN = 48, 24.0


def crc_fold(doc_id: int | None, folds: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def forms_of(word: str) -> tuple[str, ...]:
    """The word, and its beginnings marked with a hyphen."""
    return (word, *(word[:k] + "-" for k in (4, 5) if len(word) >= k))


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a text with the given (place, positive score) and -drift elsewhere."""
    held: list[list] = []  # first, last, sum before, sum with
    total, last = 0.0, -1
    for place, score in scores:
        total -= drift * (place - last - 1)
        one = [place, place, total, total + score]
        total, last = total + score, place
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= one[2]:
                k -= 1
            if k < 0 or held[k][3] >= one[3]:
                held.append(one)
                break
            one = [held[k][0], one[1], held[k][2], one[3]]
            del held[k:]
    return [(a, b, high - low) for a, b, low, high in held]


class Scorer:
    """Words to scores by their best form, and texts to segments."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.memo = weights, {}

    def __missing(self, word: str) -> float:
        get = self.weights.get
        if len(self.memo) > 300_000:
            self.memo.clear()
        score = self.memo[word] = max(get(x, -DRIFT) for x in forms_of(word))
        return score

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        memo, missing = self.memo, self.__missing
        scores = [memo[w] if w in memo else missing(w) for w in words]
        hits = [(k, s) for k, s in enumerate(scores) if s > 0]
        return segments(hits) if hits else []


class Calibration:
    """Rate and K of the local alignment statistics."""

    def __init__(self, rate: float, k: float):
        self.rate, self.log_k = rate, math.log(k)

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        """Largest significance, and log(1 + sum of those over zero)."""
        base = self.log_k + math.log(max(n, 1))
        held = [self.rate * s - base for _, _, s in found]
        return max(held, default=-base), math.log1p(sum(x for x in held if x > 0))


def _rate(shares: list[tuple[float, float]]) -> float:
    """The positive solution L of sum of share * exp(L * score) = 1; the rest of the words score -DRIFT."""
    rest = 1 - sum(p for p, _ in shares)
    total = lambda x: sum(p * math.exp(min(700.0, x * s)) for p, s in shares) + rest * math.exp(-x * DRIFT) - 1
    low, high = 0.0, 1.0
    while total(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 0 else (low, middle)
    return max(high, 1e-3)


#: fold 2: not labelled
_COUNTS = "form string, y0 long, y1 long, c0 long, c1 long"


def _tally(forms, flush: int = 300_000):
    """(text, label, fold) rows to partial counts of documents by form, class and fold, for forms(words) of each text."""

    def run(batches):
        held: dict[str, list[int]] = {}

        def out():
            columns = [pa.array(list(held), pa.string()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in range(4))]
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _COUNTS.split(", ")])

        for batch in batches:
            for text, label, fold in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                slot = (0 if label else 2) + fold
                for form in forms(set(words_of(text.as_py()))):
                    held.setdefault(form, [0, 0, 0, 0])[slot] += 1
                if len(held) > flush:
                    yield out()
                    held.clear()
        yield out()

    return run


def _all_forms(words: set[str]) -> set[str]:
    return {x for w in words for x in forms_of(w)}


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("form").agg(*[F.sum(x).alias(x) for x in ("y0", "y1", "c0", "c1")])


class Model:
    """Fitted on labelled rows (text, label, fold) and the frequencies of forms in all texts."""

    def __init__(self, docs: DataFrame, known: DataFrame):
        sizes = {(x.label, x.fold): x.n for x in known.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
        n = np.array([[sizes.get((label, fold), 0) for fold in (0, 1)] for label in (1, 0)], float)
        self.share, self.weight, self.logistic, self.scale = (n[0].sum() / n.sum() if n.sum() else 0.0), {}, None, Calibration(1.0, 1.0)
        if not n.sum(1).all():
            return
        counted = _summed(known.mapInArrow(_tally(_all_forms), _COUNTS)).where(f"y0 + y1 >= {LEAST}")
        odds = F.log((F.col("y0") + F.col("y1") + 1) / (F.col("c0") + F.col("c1") + 1))
        first = counted.where(odds > math.log(n[0].sum() / n[1].sum()) + 2)
        rows = {x.form: np.array([[x.y0, x.y1], [x.c0, x.c1]], float) for x in first.collect()}  # forms of the bounded labelled rows
        if rows:
            rows = self._explaining(known, rows, n)
        prior = self._prior(docs, rows) if rows else {}
        self.weights = [self._odds(rows, prior, n, use) for use in ((1,), (0,), (0, 1))]  # for fold 0, for fold 1, for all
        clean = n[1].sum()
        self._calibrate(known, [(rows[k][1].sum() + 0.5, s) for k, s in self.weights[2].items() if s > 0], clean)

    @staticmethod
    def _explaining(known: DataFrame, rows: dict, n: np.ndarray) -> dict:
        """The forms that at least half of their toxic documents count among the best they hold."""
        best = {k: math.log((v[0].sum() + 1) / (v[1].sum() + 1)) for k, v in rows.items()}
        lift = math.log(n[1].sum() / n[0].sum())
        best = {k: v + lift for k, v in best.items()}

        def forms(words):
            held = {x: best[x] for x in _all_forms(words) if x in best}
            limit = 0.85 * max(held.values(), default=0.0)
            return [x for x, v in held.items() if v >= limit]

        counted = _summed(known.where("label = 1").mapInArrow(_tally(forms), _COUNTS)).collect()
        credit = {x.form: x.y0 + x.y1 for x in counted}
        return {k: v for k, v in rows.items() if 2 * credit.get(k, 0) >= v[0].sum()}

    @staticmethod
    def _prior(docs: DataFrame, rows: dict) -> dict[str, float]:
        """The share of all documents that hold each of the given forms."""
        wanted = set(rows)

        def forms(words):
            return ["", *(x for x in _all_forms(words) if x in wanted)]  # the empty form is in every document

        found = _summed(docs.select("text", F.lit(0).alias("label"), F.lit(0).alias("fold")).mapInArrow(_tally(forms), _COUNTS)).collect()
        count = {x.form: x.c0 for x in found}
        total = max(1, count.pop("", 0))
        return {form: n / total for form, n in count.items()}

    @staticmethod
    def _odds(rows: dict, prior: dict, n: np.ndarray, folds: tuple) -> dict[str, float]:
        out = {}
        toxic, other = (n[k, list(folds)].sum() for k in (0, 1))
        for form, held in rows.items():
            add = PRIOR * prior.get(form, 0.0) + 0.5
            y, c = held[0, list(folds)].sum(), held[1, list(folds)].sum()
            odds = math.log((y + add) / (toxic + PRIOR - y)) - math.log((c + add) / (other + PRIOR - c)) if toxic + PRIOR > y and other + PRIOR > c else 0.0
            if y and odds / math.sqrt(1 / (y + add) + 1 / (c + add)) > 2:
                out[form] = odds - DRIFT
        return out

    def _calibrate(self, known: DataFrame, shares: list, clean: float) -> None:
        weights, slots = self.weights, CELLS * CELLS * 2
        words = known.where("label = 0").agg(F.avg(F.size(F.split("text", r"\s+")))).first()[0] or 1.0
        rate = _rate([(p / (clean * words), s) for p, s in shares])

        def scored(batches):
            scorers = [Scorer(x) for x in weights]
            for batch in batches:
                for text, label, fold in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    own = words_of(text.as_py())
                    yield label, scorers[fold].segments(own), len(own)

        def largest(batches):
            held = [rate * max((s for _, _, s in found), default=0.0) - math.log(max(n, 1)) for label, found, n in scored(batches) if not label]
            yield pa.RecordBatch.from_arrays([pa.array([len(held)]), pa.array([float(sum(held))])], ["n", "total"])

        n, total = known.mapInArrow(largest, "n long, total double").agg(F.sum("n"), F.sum("total")).first()
        self.scale = scale = Calibration(rate, math.exp(min(50.0, max(-50.0, total / max(n, 1) - 0.5772156649))))

        def cells(batches):
            count: Counter = Counter()
            for label, found, size in scored(batches):
                a, b = scale.evidence(found, size)
                count[(_cell(a, SPAN) * CELLS + _cell(b, 8.0)) * 2 + label] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int64()), pa.array(list(count.values()), pa.int64())], ["slot", "n"])

        held = np.zeros(slots)
        for slot, times in known.mapInArrow(cells, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():  # at most `slots`
            held[slot] = times
        held = held.reshape(CELLS, CELLS, 2)
        x, y = np.meshgrid(_middles(SPAN), _middles(8.0), indexing="ij")
        seen = held.sum(2) > 0
        self.logistic = _logistic(np.column_stack([x[seen], y[seen]]), held[seen][:, 1], held[seen][:, 0], ridge=0.01)

    def score(self, evidence: tuple[float, float]) -> float:
        if self.logistic is None:
            return self.share
        a, b = min(SPAN, max(-SPAN, evidence[0])), min(8.0, evidence[1])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.logistic[0] * a + self.logistic[1] * b + self.logistic[2]))))


def _cell(value: float, span: float) -> int:
    return min(CELLS - 1, max(0, int((value + span) * CELLS / (2 * span))))


def _middles(span: float) -> np.ndarray:
    return (np.arange(CELLS) + 0.5) * 2 * span / CELLS - span


_RESULT = "doc_id long, held_out boolean, score double, predicted int, n_passages int, passages array<struct<first:int,last:int,score:double>>"


def score_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 3, out_fold: int = 1, limit: float = 0.7, most_labels: int = 200_000
) -> DataFrame:
    """One row per document: held_out, score (probability of toxicity), predicted, and its significant passages (word places).

    Labels of rows whose crc32(doc_id) mod folds is out_fold are not learned from.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    given = labels.where("toxic in (0, 1) and doc_id is not null").withColumn("crc", crc).where(F.col("crc") % folds != out_fold)
    given = given.groupBy(F.col("doc_id").cast("long").alias("of"), ((F.floor(F.col("crc") / folds)) % 2).cast("int").alias("fold")).agg(F.min("toxic").cast("int").alias("label"))
    given = given.orderBy(F.xxhash64("of"), "of").limit(most_labels)
    known = texts.join(F.broadcast(given), F.col("doc_id") == F.col("of")).select("text", "label", "fold")
    known, path = Workspace(spark, "toxicity").table(known, "labelled")
    model = Model(texts, known)
    Workspace(spark, "toxicity").drop(path)
    weights = spark.sparkContext.broadcast(model.weights[2] if model.logistic is not None else {})
    scale, logistic, share = model.scale, model.logistic, model.share

    def run(batches):
        scorer, final = Scorer(weights.value), Model.__new__(Model)
        final.logistic, final.share = logistic, share
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                found = scorer.segments(words)
                score = final.score(scale.evidence(found, len(words)))
                base = scale.log_k + math.log(max(len(words), 1))
                told = [{"first": a, "last": b, "score": scale.rate * s - base} for a, b, s in found if scale.rate * s > base]
                rows.append((doc_id, crc_fold(doc_id, folds) == out_fold, score, int(score >= limit), len(told), told))
            if rows:
                types = (pa.int64(), pa.bool_(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["doc_id", "held_out", "score", "predicted", "n_passages", "passages"])

    return texts.mapInArrow(run, _RESULT)
