"""Token-ID output: shards of concatenated ids with Elias-Fano document boundaries.

A shard file holds, in this order and little-endian: the header ``_HEAD`` (magic,
bytes an id, place of the shard as two numbers, documents, leading documents
without an id, least doc_id, ids), the doc_ids less the least one and the ends of
the documents (both Elias-Fano), the id array, and the trailer ``TRAILER``.
Shards in order of their places hold the documents in ascending doc_id order.

Defined cases: a null text is empty and has the end id alone; documents with a
null doc_id come first; rows with equal doc_id keep all their copies, ordered by
hash of the text; an empty table gives no shard; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches, read_blobs, write_blobs
from tidewater.llm.elias_fano import EliasFano
from tidewater.workspace import Workspace, tasks_for

MAGIC, TRAILER = b"TIDEIDS1", "TIDE-END"
_HEAD = struct.Struct("<8sIQQQQqQ")
#: Where the split at single spaces could divide a run of white space that the tokenizer takes as one piece.
_RUN = re.compile(r"\s\s(?:\s|\Z)|[\x1c-\x1f]")
#: Words remembered by each task, characters of text encoded together, and words in one call of the tokenizer.
_MEMO_ENTRIES, _GROUP_CHARS, _CALL_WORDS = 400_000, 1 << 22, 50


class Encoder:
    """Whole texts to id bytes, remembering what a space-separated part of a text encodes to.

    The byte-level pattern never joins characters across a single space but for
    the space itself, which opens the next piece; so a text without longer runs
    of white space is encoded part by part, each part with its leading space.
    Other texts, and those that hold one of the tokenizer's added tokens, go to the
    tokenizer whole. ``separable`` says whether the tokenizer has that pattern;
    others get whole texts only.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.memo, self.sizes = dtype, {}, None
        pre = self.tokenizer.pre_tokenizer
        self.separable = self.tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in str(pre) and "use_regex=True" in str(pre)
        self.added = sorted(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.by_word = None
        if self.separable:  # for new words: ids alone, so no offsets to trim, and no second memo of words
            self.by_word = Tokenizer.from_file(path)
            self.by_word.post_processor = None
            self.by_word.model._resize_cache(0)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _parts(self, words: list[str]) -> dict[str, bytes]:
        """What each word encodes to after a space, by encoding many in one text and cutting its ids by their bytes."""
        if self.sizes is None:
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
            for token, k in vocab.items():  # a byte-level token has one character for each byte
                self.sizes[k] = len(token)
        texts = (" " + " ".join(words[k : k + _CALL_WORDS]) for k in range(0, len(words), _CALL_WORDS))
        found = (self.by_word.encode_batch_fast([x], add_special_tokens=False)[0].ids for x in texts)
        ids = np.fromiter(chain.from_iterable(found), self.dtype)
        reached = np.cumsum(self.sizes[ids])
        spaced = np.frombuffer(" ".join([*words, ""]).encode("utf-8", "surrogatepass"), np.uint8)
        wanted = np.flatnonzero(spaced == ord(" ")) + 1  # a word holds no space
        cuts = (ids.itemsize * (np.searchsorted(reached, wanted) + 1)).tolist()
        data = ids.tobytes()
        return {x: data[a:b] for x, a, b in zip(words, [0, *cuts], cuts)}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The id bytes of each text; words that are new to the memo are encoded once for all texts."""
        if not self.separable:
            return [self._whole(x) if x else b"" for x in texts]
        parts, get = [x.split(" ") for x in texts], self.memo.get
        found = [list(map(get, own)) for own in parts]  # what a word encodes to is never empty
        missing = [list(compress(own, map(not_, held))) for own, held in zip(parts, found)]
        new = set().union(*missing)
        rest = new.difference(" ".join(new).split())  # the words that are empty or hold white space
        odd = {x for x in rest if not x or x != x.strip() or _RUN.search(x)}  # no run of white space is without one of these
        whole = {k for k, x in enumerate(texts) if odd and not odd.isdisjoint(missing[k]) and _RUN.search(x)}
        for token in self.added:
            whole.update(k for k, x in enumerate(texts) if token in x)
        if whole:
            new = set().union(*(x for k, x in enumerate(missing) if k not in whole))
        plain = list(new - odd)
        fresh = self._parts(plain) if plain else {}
        if len(self.memo) + len(fresh) > _MEMO_ENTRIES:
            used = set().union(*(x for k, x in enumerate(parts) if k not in whole))
            self.memo = {x: self.memo[x] for x in used & self.memo.keys()}
        self.memo.update(fresh)
        fresh.update((x, self._whole(" " + x)) for x in new & odd)  # not remembered, so that they are seen in every text
        out = []
        for k, (text, own, held, gaps) in enumerate(zip(texts, parts, found, missing)):
            if k in whole:
                out.append(self._whole(text))
                continue
            at = -1
            for word in gaps:
                at = held.index(None, at + 1)
                held[at] = fresh[word]
            held[0] = self._whole(own[0]) if own[0] else b""  # the one without a space before it
            out.append(b"".join(held))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _groups(batches):
    """(doc_ids, texts) of the rows in order, about _GROUP_CHARS characters at a time."""
    ids, texts, chars = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py())
            chars += len(texts[-1]) + 1
            if chars >= _GROUP_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _shard(width: int, part: int, seq: int, ids: list[int | None], ends: list[int], data: list[bytes]) -> bytes:
    known = [x for x in ids if x is not None]
    least = known[0] if known else 0
    docs = EliasFano.encode(np.array([x - least for x in known], np.uint64)).to_bytes()
    bounds = EliasFano.encode(np.array(ends, np.uint64)).to_bytes()
    return b"".join([_HEAD.pack(MAGIC, width, part, seq, len(ids), len(ids) - len(known), least, ends[-1]), docs, bounds, *data])


def write_token_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, vocab: int = 50_257, shard_ids: int = 3_000_000
) -> None:
    """Encode every text of docs (doc_id, text) and write shards of about shard_ids ids, each held in memory once."""
    width = 2 if vocab <= 1 << 16 else 4
    dtype = f"<u{width}"
    end = np.array([end_id], dtype).tobytes()

    def run(batches):
        encode_all, part = Encoder(tokenizer, dtype).encode_all, TaskContext.get().partitionId()
        seq, total, ids, ends, data = 0, 0, [], [], []
        for held, texts in _groups(batches):
            for doc_id, one in zip(held, encode_all(texts)):
                one += end
                ids.append(doc_id)
                data.append(one)
                total += len(one) // width
                ends.append(total)
                if total >= shard_ids:
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([_shard(width, part, seq, ids, ends, data)], pa.binary())})
                    seq, total, ids, ends, data = seq + 1, 0, [], [], []
        if ids:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([_shard(width, part, seq, ids, ends, data)], pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(tasks_for(docs), F.col("doc_id").asc_nulls_first(), tie)
    shards = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text").mapInArrow(run, "shard binary")
    write_blobs(shards, "shard", path, TRAILER)


class Shard:
    """A shard's place, and any of its documents by the select structures, without a table of the others."""

    def __init__(self, blob: bytes):
        magic, width, *self.place, self.n, self.n_null, self.least, total = _HEAD.unpack_from(blob)
        if magic != MAGIC or blob[-len(TRAILER) :] != TRAILER.encode():
            raise ValueError("not a whole token shard")
        self.known, at = EliasFano.from_bytes(blob, _HEAD.size)
        self.bounds, at = EliasFano.from_bytes(blob, at)
        self.ids = np.frombuffer(blob, f"<u{width}", total, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.least + self.known.select(i - self.n_null)

    def span(self, i: int) -> tuple[int, int]:
        """Where the ids of the i-th document begin and end."""
        return (self.bounds.select(i - 1) if i else 0), self.bounds.select(i)


_ROWS = "part long, seq long, doc_id long, local long, n_tokens long, ids_crc32 long"


def _digests(batches):
    for batch in batches:
        for blob in batch.column(0):
            shard, rows, end = Shard(blob.as_py()), [], 0
            for i in range(shard.n):
                start, end = end, shard.bounds.select(i)
                rows.append((*shard.place, shard.doc_id(i), start, end - start, zlib.crc32(shard.ids[start:end].astype("<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], [x.split()[0] for x in _ROWS.split(", ")])


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the shards at path: doc_id, start (among all ids), n_tokens, ids_crc32, shard."""
    space = Workspace(spark, "token-index")
    rows, _ = space.table(read_blobs(spark, path).mapInArrow(_digests, _ROWS), "documents")
    sizes = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("size"))  # a row per shard file
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("part", "seq", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", F.concat_ws("-", "part", "seq").alias("shard")
    )


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the shards of docs into the shared folder and return the index read back from them."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = Workspace(spark, "token-shards").path("ids")
    write_token_shards(docs, path, tokenizer, end_id)
    return read_token_index(spark, path)
