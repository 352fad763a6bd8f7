"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive benchmark words (a shorter item is one
window). For windows of one length a shift table over blocks of two words tells
how far the scan may jump; a block with shift zero selects a bucket of windows
that end with it, their first words narrow the bucket, and a direct comparison of
all words confirms. Most blocks of a text are in no window and skip nine words.

Items beyond PIECE_WORDS words are cut into pieces that share all but one word of a window,
so no window is lost. The benchmark is taken in blocks of about ``block_bytes`` of text,
each read, shipped and searched for in all documents in a job of its own, whose finds
are written before the next begins; so what the driver and a task hold is bounded.

Defined cases: null and empty texts have no words; items without words have no
window; rows with equal item_id are one item, a null item_id is the item named by
an empty string; repeated documents each get a row; empty tables give no hits or
no rows; columns beyond those named are not read by ``scan`` and are kept by
``drop_contaminated``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches
from tidewater.workspace import Workspace

WINDOW, PIECE_WORDS = 10, 20_000
_WORDS = bytes(
    x + 32 if 0x41 <= x <= 0x5A else x if x >= 0x80 or 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A else 0x20 for x in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters a-z (A-Z in lower case), digits and non-ASCII characters, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


class WuManber:
    """Finds every occurrence of word tuples of one length."""

    def __init__(self, patterns):
        self.length = length = len(next(iter(patterns)))
        self.block = block = min(2, length)
        self.skip = length - block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = defaultdict(lambda: defaultdict(list))
        for pattern in patterns:
            for end in range(block, length + 1):
                part = pattern[end - block : end]
                self.shift[part] = min(self.shift.get(part, self.skip), length - end)
            self.buckets[pattern[-block:]][pattern[:block]].append(pattern)

    def find(self, words: list[bytes]):
        """(start, pattern) of each occurrence."""
        at, n, length, block, skip = self.length, len(words), self.length, self.block, self.skip
        jump = self.shift.get
        while at <= n:
            last = tuple(words[at - block : at])
            step = jump(last, skip)
            if not step:
                start = at - length
                for pattern in self.buckets[last].get(tuple(words[start : start + block]), ()):
                    if tuple(words[start:at]) == pattern:
                        yield start, pattern
                step = 1
            at += step


def windows_of(items: list[tuple], window: int = WINDOW) -> dict[tuple, set[str]]:
    """Each window of (item_id, text) rows with the ids of the items that hold it."""
    out: dict[tuple, set[str]] = defaultdict(set)
    for item_id, text in items:
        words = words_of(text)
        for start in range(max(1, len(words) - window + 1) if words else 0):
            out[tuple(words[start : start + window])].add("" if item_id is None else str(item_id))
    return out


class Scanner:
    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.items = windows_of(items, window)
        by_length = defaultdict(list)
        for pattern in self.items:
            by_length[len(pattern)].append(pattern)
        self.searches = [WuManber(x) for _, x in sorted(by_length.items())]

    def hits(self, words: list[bytes], mask: bytearray) -> set[str]:
        """Marks the words inside occurrences and returns the items found."""
        found: set[str] = set()
        for search in self.searches:
            for start, pattern in search.find(words):
                mask[start : start + search.length] = b"\1" * search.length
                found |= self.items[pattern]
        return found


def _pieces(window: int, most: int):
    """(item_id, text) to (item_id, words) of pieces of at most ``most`` windows; one piece of a text of fewer words than a window."""

    def run(batches):
        for batch in batches:
            rows = []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(0, max(1, len(words) - window + 1) if words else 0, most):
                    rows.append((item_id, b" ".join(words[at : at + most + window - 1]).decode("utf-8", "surrogatepass")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows)], ["item_id", "words"])

    return run


class Blocks:
    """The benchmark in blocks, each read when it is asked for."""

    def __init__(self, benchmark: DataFrame, window: int, block_bytes: int):
        items = benchmark.select(F.col("item_id").cast("string"), F.col("text")).distinct()
        pieces = items.mapInArrow(_pieces(window, PIECE_WORDS), "item_id string, words string")
        self.pieces, _ = Workspace(benchmark.sparkSession, "benchmark").table(pieces, "pieces")
        size = self.pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
        self.count = max(1, -(-size // block_bytes))

    def read(self, k: int) -> list[tuple]:
        """About block_bytes of pieces."""
        return [tuple(x) for x in self.pieces.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(self.count)) == k).collect()]


_STATE = "doc_id long, text string, mask binary, items array<string>"
_RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _search(held, window: int):
    """One pass: texts with what earlier passes found to texts with what this block adds."""

    def run(batches):
        scanner = Scanner(held.value, window)
        for batch in batches:
            masks, items = [], []
            for text, mask, found in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text.as_py())
                marks = bytearray(mask or bytes(len(words)))
                found = sorted(scanner.hits(words, marks).union(found or ()))
                masks.append(bytes(marks) if found else None)
                items.append(found or None)
            columns = [batch.column(0), batch.column(1), pa.array(masks, pa.binary()), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "mask", "items"])

    return run


def _digest(held, window: int):
    """The last pass."""

    def run(batches):
        scanner = Scanner(held.value, window)
        for batch in batches:
            rows = []
            for text, mask, found in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text.as_py())
                marks = bytearray(mask or bytes(len(words)))
                found = sorted(scanner.hits(words, marks).union(found or ()))
                hit = sum(marks)
                rows.append((len(words), hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
            columns = [batch.column(0), *(pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())))] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _RESULT.split(", ")])

    return run


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 2 << 20) -> DataFrame:
    """One row per document: words, words inside benchmark windows, items found and a digest of their ids."""
    bound_batches(docs.sparkSession)
    context, space = docs.sparkSession.sparkContext, Workspace(docs.sparkSession, "decontaminate")
    none, blocks, path = F.lit(None), Blocks(benchmark, window, block_bytes), None
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", none.cast("binary").alias("mask"), none.cast("array<string>").alias("items"))
    for k in range(blocks.count - 1):
        old = path
        state, path = space.table(state.mapInArrow(_search(context.broadcast(blocks.read(k)), window), _STATE), "state")
        space.drop(*([old] if old else []))
    return state.mapInArrow(_digest(context.broadcast(blocks.read(blocks.count - 1)), window), _RESULT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 2 << 20) -> DataFrame:
    """The rows of docs in whose text no benchmark window occurs, all columns as they were."""
    bound_batches(docs.sparkSession)
    context, place = docs.sparkSession.sparkContext, docs.columns.index("text")

    def clean(held):
        def run(batches):
            scanner = Scanner(held.value, window)
            for batch in batches:
                keep = []
                for text in batch.column(place):
                    words = words_of(text.as_py())
                    keep.append(not any(True for search in scanner.searches for _ in search.find(words)))
                yield batch.filter(pa.array(np.array(keep, bool)))

        return run

    blocks, space, path = Blocks(benchmark, window, block_bytes), Workspace(docs.sparkSession, "decontaminate"), None
    for k in range(blocks.count):
        docs, old = docs.mapInArrow(clean(context.broadcast(blocks.read(k))), docs.schema), path
        if k < blocks.count - 1:
            docs, path = space.table(docs, "clean")
            space.drop(*([old] if old else []))
    return docs
