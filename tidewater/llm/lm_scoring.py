"""Language-model scoring with a log-bilinear neural model trained by noise-contrastive estimation.

Tokens are the white-space words of a text, A-Z in lower case, and one end token.
Word counts cover every training text. The most frequent tokens, as many as half the
root of the training tokens and at most ``most_symbols``, are symbols of the model. The other
words fall into classes, one for each octave of the count and one for all that are
not among the ``heads`` most frequent; each class is a symbol too, and a word has the probability
of its class times its smoothed share of the class's counts. So the model is a
distribution over all words, an unseen one included.

The model predicts a symbol's logit as (C1 r[x] + C2 r[y]) . q[w] + b[w], where x
is the symbol before and y the last symbol before x that is no class. Every position of
every training text is learned from once: the texts are encoded to symbols, divided
by hash over ``rounds`` rounds and, within a round, over shards of about
``shard_tokens`` positions. The tasks of a round train copies by noise-contrastive estimation
with Adagrad; the copies, weighted by positions, are averaged over a tree of sums. The
shards follow from the texts and the corpus's size, not from how the input is split
into files, so only the order of equal hashes and rounding can move a score. The
normaliser of every context comes from batched matrix products.

Only the ``heads`` most frequent words and the model are shipped to the executors;
counts of rarer words meet their documents in a join on the word.

Defined cases: null and empty texts hold the end token alone; a null doc_id hashes
as an empty text (crc32 zero, so held out); repeated rows count and score each; without
training texts all counts are zero and the end token and all other words are equally
likely; an empty table gives no row; no column but doc_id and text is read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches
from tidewater.workspace import Workspace

#: The end token; no word holds white space.
END = b"\n"
_FLUSH = 400_000
#: Sums of copies that one task adds up.
FAN = 32
LN10 = float(np.log(10.0))


def tokens_of(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []
    words.append(END)
    return words


def held_out(doc_id: int | None, folds: int = 10) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def _count(batches):
    held: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not held_out(doc_id):
                held.update(tokens_of(text.as_py()))
                if len(held) > _FLUSH:
                    yield rows()
                    held.clear()
    yield rows()


class Model:
    """The parameters: r and q (symbol vectors), c1 and c2 (context maps), b (biases); the last symbol is the rest class."""

    def __init__(self, shares: np.ndarray, width: int, seed: int):
        rng, n = np.random.default_rng(seed), len(shares)
        self.r, self.q = (rng.normal(0, 0.1, (n, width)).astype(np.float32) for _ in range(2))
        self.c1, self.c2 = (np.eye(width, dtype=np.float32) for _ in range(2))
        self.b = np.log(shares).astype(np.float32)

    NAMES = ("r", "q", "c1", "c2", "b")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, x).ravel() for x in self.NAMES])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def tables(self, rows: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits by (x, w) with the bias, logits by (y, w), and the log normaliser by (x, y), each exact for its context."""
        first, second = self.r @ self.c1 @ self.q.T + self.b, self.r @ self.c2 @ self.q.T
        n = len(self.b)
        norm = np.empty((n, n), np.float32)
        # exp(f + s) = exp(f) exp(s): one matrix product normalises all contexts
        top, over = first.max(1, keepdims=True), second.max(1, keepdims=True)
        norm[:] = np.log(np.exp(first - top).astype(np.float64) @ np.exp(second - over).astype(np.float64).T)
        return first - top, second - over, norm


def contexts(symbols: np.ndarray, starts: np.ndarray, frequent: int, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """x and y of every position of concatenated texts; before a text stand end tokens."""
    n = len(symbols)
    x = np.empty(n, symbols.dtype)
    x[1:], x[starts] = symbols[:-1], end
    place = np.arange(n)
    # the last symbol that is no class at or before each position, and that of position i - 2
    last = np.maximum.accumulate(np.where(symbols < frequent, place, -1))
    y = np.full(n, end, symbols.dtype)
    begin = np.repeat(starts, np.diff(np.append(starts, n)))
    back = place - 2
    at = np.where(back >= begin, last[np.maximum(back, 0)], -1)
    have = at >= begin
    y[have] = symbols[at[have]]
    return x, y


def _gathered(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indices and the sum of the rows of each."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    return index[first], np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    def __init__(self, model: Model, shares: np.ndarray, noise: int, step: float, seed):
        self.m, self.noise, self.step = model, noise, step
        self.shares, self.log_noise = shares, np.log(noise * shares).astype(np.float32)
        self.rng, self.upto = np.random.default_rng(seed), np.cumsum(shares)[:-1]
        self.past = {x: np.full_like(getattr(model, x), 1.0) for x in Model.NAMES}

    def batch(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        """One step of noise-contrastive estimation; the rows of a batch share its noise symbols."""
        m = self.m
        false = np.searchsorted(self.upto, self.rng.random(self.noise), side="right")
        rx, ry, qw, qf = m.r[x], m.r[y], m.q[w], m.q[false]
        h = rx @ m.c1 + ry @ m.c2
        right = 1 / (1 + np.exp(-np.clip((h * qw).sum(1) + m.b[w] - self.log_noise[w], -30, 30))) - 1
        wrong = 1 / (1 + np.exp(-np.clip(h @ qf.T + m.b[false] - self.log_noise[false], -30, 30)))
        right, wrong = right.astype(np.float32), wrong.astype(np.float32)
        dh = right[:, None] * qw + wrong @ qf
        qs, dq = _gathered(np.append(w, false), np.concatenate([np.column_stack([right[:, None] * h, right]), np.column_stack([wrong.T @ h, wrong.sum(0)])]))
        rs, dr = _gathered(np.append(x, y), np.concatenate([dh @ m.c1.T, dh @ m.c2.T]))
        for name, at, grad in (("q", qs, dq[:, :-1]), ("b", qs, dq[:, -1]), ("r", rs, dr), ("c1", slice(None), rx.T @ dh), ("c2", slice(None), ry.T @ dh)):
            past = self.past[name]
            past[at] += grad * grad
            getattr(m, name)[at] -= self.step * grad / np.sqrt(past[at])


def _train(model_bytes: bytes, width: int, shares: np.ndarray, frequent: int, turn: int, noise: int, step: float, rows: int):
    """One round in one task: the symbols of its texts, in order, to (shard, positions, parameters times positions)."""

    def run(batches):
        model, shard = Model(shares, width, 0).load(np.frombuffer(model_bytes, np.float32)), TaskContext.get().partitionId()
        trainer = Trainer(model, shares, noise, step, seed=[turn, shard])
        held, waiting, total = [], 0, 0

        def learn():
            nonlocal held, waiting, total
            x, y, w = (np.concatenate(k) for k in zip(*held))
            order = trainer.rng.permutation(len(w))
            for k in range(0, len(w), rows):
                part = order[k : k + rows]
                trainer.batch(x[part], y[part], w[part])
            total += len(w)
            held, waiting = [], 0

        for batch in batches:
            texts = [np.frombuffer(x, "<u2") for x in batch.column(0).to_pylist()]
            for symbols, starts in _joined(texts, 64 * rows):
                held.append((*contexts(symbols, starts, frequent), symbols))
                waiting += len(symbols)
                if waiting >= 64 * rows:
                    learn()
        if waiting:
            learn()
        if total:
            yield _sum_row(shard, total, model.flat().astype(np.float64) * total)

    return run


def _joined(texts: list[np.ndarray], size: int):
    """Texts' symbols joined, at least ``size`` at a time but for the last, with the place where each text begins."""
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size or text is texts[-1]:
            yield np.concatenate(held).astype(np.int64), np.cumsum([0, *map(len, held[:-1])])
            held, total = [], 0


_SUM = "shard long, n long, flat binary"


def _sum_row(shard: int, n: int, flat: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([shard], pa.int64()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "n", "flat"])


def _add_up(key, table):
    """The sums of some shards, added in their order."""
    order = np.argsort(table.column("shard").to_numpy(), kind="stable")
    flat = sum(np.frombuffer(table.column("flat")[int(k)].as_py(), np.float64) for k in order)
    return pa.Table.from_batches([_sum_row(key[0].as_py(), sum(table.column("n").to_pylist()), flat)])


def fit(texts: DataFrame, tokens: int, shares: np.ndarray, frequent: int, width: int, rounds: int, shard_tokens: int, noise: int, step: float, rows: int) -> tuple[Model, int]:
    """The model learned from every position of texts (h, a hash of the row, and symbols), each in one of the rounds; and how many these were."""
    learned, model, shards = 0, Model(shares, width, seed=11), max(1, -(-tokens // (rounds * shard_tokens)))
    for turn in range(rounds):
        task = _train(model.flat().tobytes(), width, shares, frequent, turn, noise, step, rows)
        dealt = texts.where(F.pmod("h", F.lit(rounds)) == turn).repartition(shards, "h").sortWithinPartitions("h")
        sums, left = dealt.select("symbols").mapInArrow(task, _SUM), max(shards, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        while left > 1:
            left = -(-left // FAN)
            sums = sums.groupBy(F.floor(F.col("shard") / FAN).alias("slot")).applyInArrow(_add_up, _SUM)
        found = sums.collect()  # one row; none without training texts
        if found:
            model.load(sum(np.frombuffer(x.flat, np.float64) for x in found) / sum(x.n for x in found))
            learned += sum(x.n for x in found)
    return model, learned


class Vocabulary:
    """The most frequent words with their counts, the symbol of each, and the words' smoothed shares of their classes.

    counted holds (word, n) for every training word; of these at most ``heads`` come to the driver.
    """

    def __init__(self, counted: DataFrame, heads: int, most_symbols: int):
        self.total, self.distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        # words in steps of a sixteenth of an octave of their count; whole steps from the top, as far as they hold at most `heads`
        step_of = F.floor(F.log2("n") * 16).cast("int")
        sizes = sorted(((x.step, x.size) for x in counted.groupBy(step_of.alias("step")).agg(F.count("*").alias("size")).collect()), reverse=True)
        within = [k for k, size in zip([k for k, _ in sizes], np.cumsum([size for _, size in sizes])) if size <= heads]
        top = counted.where(step_of >= within[-1]).collect() if within else []
        top.sort(key=lambda x: (-x.n, bytes(x.word)))
        order = [bytes(x.word) for x in top]
        counts = np.array([x.n for x in top], np.float64)
        ends = counted.where(F.col("word") == F.lit(END)).collect()
        rest = [k for k, w in enumerate(order) if w != END]
        self.order, self.counts = [END, *(order[k] for k in rest)], np.append(float(ends[0].n) if ends else 0.0, counts[rest])
        self.mass = self.total + 0.1 * (self.distinct + 1)
        self.frequent = min(most_symbols, len(self.order), max(64, math.isqrt(self.total) // 2))
        # a class for each octave of the count beyond the frequent words, and the last for words that are not here
        octaves = np.log2(np.maximum(self.counts[self.frequent :], 1)).astype(np.int64)
        _, nth = np.unique(-octaves, return_inverse=True)
        self.symbol = np.append(np.arange(self.frequent), self.frequent + nth).astype(np.int64)
        n = int(self.symbol[-1]) + 2
        masses = np.bincount(self.symbol, self.counts + 0.1, n)
        masses[-1] = max(self.mass - masses[:-1].sum(), 0.1)
        self.rest_log = float(np.log10(masses[-1]))
        #: log10 of a class word's share of its class; zero for the frequent words
        self.share_log = np.where(self.symbol < self.frequent, 0.0, np.log10((self.counts + 0.1) / masses[self.symbol]))
        self.shares = masses / masses.sum()


_CODED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, rest_n long, rare array<binary>, symbols binary"


def _encode(words: Vocabulary):
    """(doc_id, text) to symbols, sums over the words of the vocabulary, and the list of the other words, repeats included."""
    head = {w: k for k, w in enumerate(words.order)}
    out = len(words.order)
    symbol = np.append(words.symbol, len(words.shares) - 1).astype("<u2")
    logs, share_log = np.append(np.log10(words.counts + 0.1), 0.0), np.append(words.share_log, 0.0)
    known = np.append(words.counts > 0, False)

    def run(batches):
        get, part, row = head.get, TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = tokens_of(text.as_py())
                place = np.fromiter((get(k, out) for k in own), np.int64, len(own))
                rare = [own[k] for k in np.flatnonzero(place == out)]
                sums = int(known[place].sum()), float(logs[place].sum()), float(share_log[place].sum())
                rows.append(((part << 40) + row, doc_id, held_out(doc_id), len(own), *sums, len(rare), rare or None, symbol[place].tobytes()))
                row += 1
            if rows:
                types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], [v.split()[0] for v in _CODED.split(", ")])

    return run


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _score(tables, frequent: int, rest_log: float):
    """Encoded texts to their log10 probability but for the words that are not in the vocabulary."""
    first, second, norm = tables

    def run(batches):
        for batch in batches:
            texts = [np.frombuffer(x, "<u2") for x in batch.column("symbols").to_pylist()]
            scores = []
            for symbols, starts in _joined(texts, 1 << 18):
                x, y = contexts(symbols, starts, frequent)
                scores.append(np.add.reduceat((first[x, symbols] + second[y, symbols] - norm[x, y]).astype(np.float64), starts) / LN10)
            score = np.concatenate(scores or [np.zeros(0)]) + batch.column("within").to_numpy() - rest_log * batch.column("rest_n").to_numpy()
            columns = [*(batch.column(k) for k in ("row", "doc_id", "held_out", "n_tokens", "n_known", "base")), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [v.split()[0] for v in _SCORED.split(", ")])

    return run


class Fitted:
    """Counts of all training words, the vocabulary, the encoded texts and the model."""

    def __init__(self, docs: DataFrame, most_symbols: int, heads: int, width: int, rounds: int, shard_tokens: int, noise: int, step: float, rows: int):
        spark = docs.sparkSession
        bound_batches(spark)
        space = Workspace(spark, "lm")
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        self.counted, _ = space.table(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
        self.words = words = Vocabulary(self.counted, heads, most_symbols)
        shipped = spark.sparkContext.broadcast(words)
        self.coded, _ = space.table(texts.mapInArrow(lambda batches: _encode(shipped.value)(batches), _CODED), "coded")
        train = self.coded.where("not held_out").select(F.xxhash64("doc_id", "symbols").alias("h"), "symbols")
        self.model, self.learned = fit(train, words.total, words.shares, words.frequent, width, rounds, shard_tokens, noise, step, rows)


def score_documents(
    docs: DataFrame,
    most_symbols: int = 2048,
    heads: int = 100_000,
    width: int = 24,
    rounds: int = 4,
    shard_tokens: int = 500_000,
    noise: int = 100,
    step: float = 0.1,
    rows: int = 512,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per document."""
    spark = docs.sparkSession
    fitted = Fitted(docs, most_symbols, heads, width, rounds, shard_tokens, noise, step, rows)
    counted, coded, words = fitted.counted, fitted.coded, fitted.words
    tables = spark.sparkContext.broadcast(fitted.model.tables())
    frequent, rest_log, mass, total = words.frequent, words.rest_log, float(np.log10(words.mass)), words.total
    names = ("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "within", "rest_n", "symbols")
    scored = coded.select(*names).mapInArrow(lambda batches: _score(tables.value, frequent, rest_log)(batches), _SCORED)
    rare = coded.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    rare = rare.join(counted, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(mass)).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
