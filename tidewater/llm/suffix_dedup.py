"""Removal of repeated byte strings by the common-prefix interval tree of enhanced suffix arrays.

A string of ``length`` bytes starts at each *window* of a document. Documents are
cut so that equal windows meet in one small suffix array:

1. Every window is owned by the place of the least hash among its GRAM-byte strings
   (the first of equals). Equal windows own equal strings at equal offsets, so all
   occurrences of a window have the same anchor. A maximal run of windows of one
   owner is a *stretch*, about length - GRAM over two of them.
2. Stretches with equal bytes are one; within a batch of documents only the first
   is sent on, and the others are repeats at once. This bounds what any anchor
   sends, however many documents share it. Per anchor the first stretch of each
   content stays.
3. Where an anchor has several contents, their bytes are fetched, and an enhanced
   suffix array of their windows (order and common prefixes, cut at ``length``) is
   built by refinement, eight bytes at a time, of those still tied. A stack scan of
   the common prefixes gives the interval tree; each interval of at least ``length``
   is a window with all its occurrences. Every occurrence but the least is a repeat.
4. The bytes that repeated windows cover are removed.

An anchor with more than ``split_over`` contents is split by a hash of each whole
window, so that a frequent string with many continuations is shared by many tasks; of
equal windows in a batch of documents only the first is sent on, the others are repeats
at once. Anchors that a sample of the texts shows to be so frequent (at most HOT of
them) are spread by content from the start. Both change the cost only.

The windows that repeat are what is removed, and they are groups of equal ones, so common
prefixes are compared up to ``length`` and this path has no use for left extensions: a
repeat is not cut short where one can be extended. ``maximal_repeats`` gives the groups
of a text that are maximal on both sides, with all occurrences.

Stretches are told apart by two 64-bit hashes of their bytes (together 128 bits).

Defined cases: a null or empty text has no bytes; texts under ``length`` bytes keep
all; documents are in order of doc_id, null first; rows that share a doc_id are in
order of their text's SHA-256, and equal rows each get a row of the result (the first
keeps its bytes); an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches
from tidewater.workspace import Workspace, tasks_for

GRAM = 24
_PLACE = 24
#: Bytes of text hashed at once; a task holds about fifteen times as much.
_CHUNK = 2 << 20
#: One of SAMPLE texts is looked at for frequent anchors, of which at most HOT are told to all tasks.
SAMPLE, HOT = 64, 50_000
_rng = np.random.default_rng(20)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, (n + 1).bit_length())
    if size not in _powers:
        _powers.clear()
        steps = np.full((2, size), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = _BASE, _UNBASE
        _powers[size] = tuple(np.multiply.accumulate(steps, axis=1))
    return _powers[size]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def stretches(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """anchor, content, start (in data) and windows of each stretch of the concatenated documents that end at ends."""
    n, width = len(data), length - GRAM + 1
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < length:
        return none
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * power[:n], out=sums[1:])
    grams = _mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1], 0)
    low = np.uint64((1 << _PLACE) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    pad = np.full(-len(keys) % width, np.iinfo(np.uint64).max)
    blocks = np.concatenate([keys, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    owner = (np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
    sound = np.zeros(windows, bool)
    for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
        sound[a : max(a, b - length + 1)] = True
    cut = ~sound
    cut[0] = True
    cut[1:] |= (owner[1:] != owner[:-1]) | ~sound[:-1]
    at = np.flatnonzero(cut)
    size = np.diff(np.append(at, windows))
    own = sound[at]
    at, size = at[own], size[own]
    if not len(at):
        return none
    content = (sums[at + size - 1 + length] - sums[at]) * inverse[at]
    return grams[owner[at]], _mix(content ^ _mix(size.astype(np.uint64), 7), 3), at, size


def _first_of_equals(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by keys (most important first; ties in given order), and in that order whether a row differs from the one before in the first two."""
    order = np.lexsort(keys[::-1])
    a, b = keys[0][order], keys[1][order]
    return order, np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(order) else np.zeros(0, bool)


_BLOB = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("size", "u1")])


def _pack(rows: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.uint32(len(rows)).tobytes(), *(np.ascontiguousarray(rows[x]).tobytes() for x in rows.dtype.names)]))


def _unpack(blob: bytes, kind: np.dtype = _BLOB) -> np.ndarray:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    rows, at = np.empty(n, kind), 4
    for name in kind.names:
        rows[name] = np.frombuffer(data, kind[name], n, at)
        at += n * kind[name].itemsize
    return rows


def _hot_anchors(texts: DataFrame, length: int, split_over: int, sample: int) -> np.ndarray:
    """Anchors with so many contents in a sample of the texts that they will be split, ordered."""

    def run(batches):
        for batch in batches:
            for text in batch.column(0):
                data = text.as_py()
                for at in range(0, len(data), _CHUNK):
                    part = np.frombuffer(data[at : at + _CHUNK + length - 1], np.uint8)
                    anchor, content, *_ = stretches(part, np.array([len(part)]), length)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))], ["anchor", "content"])

    part = texts.where(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0).select("text").mapInArrow(run, "anchor long, content long")
    counted, path = (space := Workspace(texts.sparkSession, "anchors")).table(part.distinct().groupBy("anchor").agg(F.count("*").alias("n")), "counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("n") > max(1, split_over // sample, total // HOT)).select("anchor").collect()  # at most HOT
    space.drop(path)
    return np.sort(np.array([x.anchor for x in found], np.int64).view(np.uint64))


def _scan(length: int, buckets: int, hot: np.ndarray):
    """(doc, text) to packed stretches by bucket of their anchor (of a hot one: and content); repeats found here have kind 1."""

    def out(docs: list[tuple[int, bytes]]):
        docs.sort(key=lambda x: x[0])
        sizes = np.array([len(x) for _, x in docs])
        ends = np.cumsum(sizes)
        anchor, content, at, size = stretches(np.frombuffer(b"".join(x for _, x in docs), np.uint8), ends, length)
        rows = np.empty(len(at), _BLOB)
        which = np.searchsorted(ends, at, side="right")
        rows["anchor"], rows["content"], rows["size"] = anchor, content, size
        rows["doc"], rows["start"] = np.array([k for k, _ in docs], np.int64)[which], at - (ends - sizes)[which]
        order, first = _first_of_equals(anchor, content)
        firsts = np.sort(order[first])
        again = rows[order[~first]]
        keep = rows[firsts]
        place = np.where(np.isin(keep["anchor"], hot), _mix(keep["anchor"] ^ keep["content"], 5), keep["anchor"])
        home = (place % np.uint64(buckets)).astype(np.int64)
        turn = np.argsort(home, kind="stable")
        keep, home = keep[turn], home[turn]
        cuts = np.flatnonzero(np.append(True, home[1:] != home[:-1])) if len(home) else []
        parts = [(int(home[a]), 0, _pack(keep[a:b])) for a, b in zip(cuts, [*cuts[1:], len(home)])]
        if len(again):
            parts.append((int(again["doc"][0]) % buckets, 1, _pack(again)))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts), (pa.int32(), pa.int32(), pa.binary()))], ["bucket", "kind", "blob"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py() or b""
                # a text beyond one chunk is cut into pieces that share length - 1 bytes, so no window is lost or doubled
                if len(data) < length:
                    continue
                for piece in range(0, len(data), _CHUNK) if len(data) > _CHUNK else (0,):
                    part = data[piece : piece + _CHUNK + length - 1] if len(data) > _CHUNK else data
                    if len(part) < length:
                        continue
                    if len(data) > _CHUNK:
                        yield from _shifted(out([(doc, part)]), piece)
                    else:
                        held.append((doc, part))
                        size += len(part)
                if size >= _CHUNK:
                    yield from out(held)
                    held, size = [], 0
        if held:
            yield from out(held)

    return run


def _shifted(batches, by: int):
    for batch in batches:
        blobs = []
        for blob in batch.column(2).to_pylist():
            rows = _unpack(blob)
            rows["start"] += by
            blobs.append(_pack(rows))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["bucket", "kind", "blob"])


_FOUND = "doc long, start int, size int, anchor long, split boolean"


def _meet(split_over: int, hot: np.ndarray):
    """All stretches of a bucket to repeats (anchor null) and to stretches whose bytes must be compared."""

    def run(key, table):
        blobs = list(zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()))
        again = [_unpack(x) for kind, x in blobs if kind]
        rows = np.concatenate([np.empty(0, _BLOB), *(_unpack(x) for kind, x in blobs if not kind)])
        order, first = _first_of_equals(rows["anchor"], rows["content"], rows["doc"], rows["start"])
        again.append(rows[order[~first]])
        held = rows[order[first]]
        _, at, times = np.unique(held["anchor"], return_inverse=True, return_counts=True)
        many = np.where(np.isin(held["anchor"], hot), split_over + 2, times[at])  # a hot anchor's other contents may be elsewhere
        again, held, many = np.concatenate(again), held[many > 1], many[many > 1]
        n = len(again)
        both = np.concatenate([again, held])
        anchors = pa.array(both["anchor"].view(np.int64), pa.int64(), mask=np.arange(len(both)) < n)
        columns = [pa.array(both["doc"]), pa.array(both["start"]), pa.array(both["size"].astype(np.int32)), anchors, pa.array(np.append(np.zeros(n, bool), many > split_over))]
        return pa.Table.from_arrays(columns, ["doc", "start", "size", "anchor", "split"])

    return run


_PIECE = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("size", "u1")])


def _fetch(length: int, buckets: int):
    """(doc, packed text, wanted stretches) to their bytes by bucket; windows found to repeat here go to buckets of their own, without bytes."""

    def run(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            parts: dict[int, list] = {}
            seen, again = set(), []
            for doc, packed, wanted in sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()), key=lambda x: x[0]):
                text = open_(packed)
                for x in sorted(wanted, key=lambda x: x["start"]):
                    start, size, anchor = x["start"], x["size"], x["anchor"] % (1 << 64)
                    if not x["split"]:
                        parts.setdefault(anchor % buckets, []).append((anchor, doc, start, size, text[start : start + size - 1 + length]))
                        continue
                    for at in range(start, start + size):
                        window = text[at : at + length]
                        mark = hashlib.blake2b(window, digest_size=16, key=anchor.to_bytes(8, "little")).digest()
                        if mark not in seen:
                            seen.add(mark)
                            parts.setdefault(int.from_bytes(mark[:8], "little") % buckets, []).append((anchor, doc, at, 1, window))
                        elif again and again[-1][1] == doc and again[-1][2] + again[-1][3] == at and again[-1][3] < 255:
                            again[-1][3] += 1
                        else:
                            again.append([anchor, doc, at, 1])
            rows = []
            for home, held in parts.items():
                head = np.array([x[:4] for x in held], _PIECE)
                rows.append((home, _pack(head), zstandard.ZstdCompressor(level=1).compress(b"".join(x[4] for x in held))))
            if again:
                rows.append((buckets + again[0][1] % buckets, _pack(np.array([tuple(x) for x in again], _PIECE)), None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["bucket", "head", "data"])

    return run


def suffix_array(data: np.ndarray, starts: np.ndarray, length: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings data[s : s + length] (after the group, where given), and the common prefix of each with the one before."""
    n, steps = len(starts), -(-length // 8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    common = np.full(n, length, np.int64)
    order = np.arange(n) if group is None else np.argsort(group, kind="stable")
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    if group is not None and n:
        new[1:] = group[order[1:]] != group[order[:-1]]
    common[new] = 0
    for step in range(steps):
        offset = min(8 * step, max(0, length - 8))
        label = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        live = np.flatnonzero(~alone)
        if not len(live):
            break
        at = starts[order[live]] + offset
        word = np.zeros(len(live), np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | padded[at + k]
        if length < 8:
            word >>= np.uint64(8 * (8 - length))
        turn = np.lexsort((word, label[live]))
        order[live], word = order[live][turn], word[turn]
        # labels are unchanged by the sort, as it orders within equal labels only
        split = np.zeros(len(live), bool)
        split[1:] = (word[1:] != word[:-1]) & (label[live][1:] == label[live][:-1])
        differ = word[1:] ^ word[:-1]
        same = np.zeros(len(live), np.int64)
        same[1:] = sum((differ >> np.uint64(8 * k)) == 0 for k in range(1, 8)) if len(live) > 1 else 0
        common[live[split]] = (offset if length >= 8 else length - 8) + same[split]
        new[live[split]] = True
    return order, common


def intervals(common: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first, last, common prefix) of every node of the interval tree with a prefix of at least ``least``, by a stack scan.

    Runs of equal common prefixes are taken in one step.
    """
    at = np.flatnonzero(np.append(True, common[1:] != common[:-1])) if len(common) else np.zeros(0, np.int64)
    out, stack = [], []
    for k, value in zip([*at.tolist(), len(common)], [*common[at].tolist(), 0]):
        left = max(k - 1, 0)
        while stack and stack[-1][1] > value:
            left, prefix = stack.pop()
            out.append((left, k - 1, prefix))
        if value >= least and (not stack or stack[-1][1] < value):
            stack.append((left, value))
    return out


def _compare(length: int, buckets: int):
    """The pieces of a bucket to the windows among them that repeat an earlier one; those known to repeat as they are."""

    def run(key, table):
        import zstandard

        head = np.concatenate([_unpack(x, _PIECE) for x in table.column("head").to_pylist()])
        if key[0].as_py() >= buckets:
            return pa.Table.from_arrays([pa.array(head["doc"]), pa.array(head["start"]), pa.array(head["size"].astype(np.int32))], ["doc", "start", "size"])
        data = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for x in table.column("data").to_pylist()), np.uint8)
        size = head["size"].astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(size - 1 + length)[:-1]])
        piece = np.repeat(np.arange(len(head)), size)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(size) - size, size)
        starts, doc, place = begin[piece] + nth, head["doc"][piece], head["start"][piece] + nth
        order, common = suffix_array(data, starts, length, head["anchor"][piece])
        age = np.empty(len(piece), np.int64)
        age[np.lexsort((place, doc))] = np.arange(len(piece))
        again = np.zeros(len(piece), bool)
        found = intervals(common, length)
        if found:
            first, last = np.array(found)[:, :2].T
            turn = np.argsort(first)
            first, last = first[turn], last[turn]
            inside = np.zeros(len(piece) + 1, np.int64)
            np.add.at(inside, first, 1)
            np.add.at(inside, last + 1, -1)
            members = order[np.flatnonzero(np.cumsum(inside)[:-1])]
            edges = np.concatenate([[0], np.cumsum(last - first + 1)[:-1]])
            oldest = np.repeat(np.minimum.reduceat(age[members], edges), last - first + 1)
            again[members[age[members] != oldest]] = True
        cut = np.flatnonzero(again & ~(np.append(False, again[:-1]) & np.append(False, piece[1:] == piece[:-1])))
        if len(cut):
            run_of = np.cumsum(np.isin(np.arange(len(piece)), cut))[again] - 1
            sizes = np.bincount(run_of, minlength=len(cut)).astype(np.int32)
        else:
            sizes = np.zeros(0, np.int32)
        return pa.Table.from_arrays([pa.array(doc[cut]), pa.array(place[cut].astype(np.int32)), pa.array(sizes)], ["doc", "start", "size"])

    return run


def maximal_repeats(data: bytes, least: int) -> list[tuple[int, list[int]]]:
    """(length, all starts) of each maximal repeat of at least ``least`` bytes in a text: right-maximal as a node of the
    interval tree, left-maximal as the bytes before its occurrences (or the text's begin) differ."""
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    order, common = suffix_array(np.concatenate([text, np.zeros(n + 8, np.uint8)]), np.arange(n), max(n, 8))
    common = np.minimum(common, np.minimum(n - order, n - np.append(n, order[:-1])))
    out = []
    for first, last, size in intervals(common, least):
        places = order[first : last + 1]
        if len({data[k - 1] if k else -1 for k in places.tolist()}) > 1 or 0 in places:
            out.append((int(size), sorted(places.tolist())))
    return out


_RESULT = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first:int,last:int>>"


def _cut_out(length: int):
    def run(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for key, packed, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = open_(packed.as_py())
                spans: list[list[int]] = []
                for start, size in sorted((x["start"], x["size"]) for x in marks or ()):
                    end = start + size - 1 + length
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                digest, at = hashlib.sha256(), 0
                for a, b in [*spans, [len(text), len(text)]]:
                    digest.update(text[at:a])
                    at = b
                rows.append((key, len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [{"first": a, "last": b} for a, b in spans]))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [x.split()[0] for x in _RESULT.split(", ")[:5]] + ["spans"])

    return run


def _packed(batches):
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(x.as_py() or b"") for x in batch.column(1)], pa.binary())], ["key", "packed"])


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """key, doc_id, text (binary), and whether the key is the doc_id: so where ids are unique, else it is the row's place in the order of documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    if not rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text"), True
    spark = docs.sparkSession
    marked = rows.withColumn("sha", F.sha2("text", 256)).withColumn("nth", F.row_number().over(W.partitionBy("doc_id", "sha").orderBy(F.lit(0))))
    marked, _ = Workspace(spark, "repeats").table(marked, "keyed")
    ordered = marked.select("doc_id", "sha", "nth").orderBy(F.col("doc_id").asc_nulls_first(), "sha", "nth")
    places = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])).toDF("of long, hash string, turn int, key long")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("hash")) & (F.col("nth") == F.col("turn"))
    return Workspace(spark, "repeats").table(marked.join(places, same).select("key", "doc_id", "text"), "documents")[0], False


def remove_repeats(docs: DataFrame, length: int = 100, split_over: int = 20_000, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (byte ranges removed), one row per row of docs.

    length is from GRAM to GRAM + 254, as a stretch's windows are counted in a byte.
    """
    if not GRAM <= length <= GRAM + 254:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 254}")
    spark = docs.sparkSession
    bound_batches(spark)
    space = Workspace(spark, "repeats")
    rows, plain = _keyed(docs)
    texts = rows.select("key", "text")
    buckets = tasks_for(docs, 16 << 20)
    hot = _hot_anchors(texts, length, split_over, sample)
    sent = texts.mapInArrow(_scan(length, buckets, hot), "bucket int, kind int, blob binary")
    found, _ = space.table(sent.groupBy("bucket").applyInArrow(_meet(split_over, hot), _FOUND), "stretches")

    asked = found.where("anchor is not null")
    volume = asked.agg(F.sum(F.col("size") + F.when(F.col("split"), F.col("size") * length).otherwise(length))).first()[0] or 0
    wanted = asked.groupBy("doc").agg(F.collect_list(F.struct("start", "size", "anchor", "split")).alias("wanted"))
    packed = texts.mapInArrow(_packed, "key long, packed binary")
    pieces = packed.join(wanted, F.col("key") == F.col("doc")).select("key", "packed", "wanted")
    cells = max(1, -(-volume // (4 << 20)))
    pieces = pieces.mapInArrow(_fetch(length, cells), "bucket int, head binary, data binary")
    more, _ = space.table(pieces.groupBy("bucket").applyInArrow(_compare(length, cells), "doc long, start int, size int"), "windows")

    marks = found.where("anchor is null").select("doc", "start", "size").union(more)
    marks = marks.groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("marks"))
    joined = packed.join(marks, F.col("key") == F.col("doc"), "left").select("key", "packed", "marks")
    done = joined.mapInArrow(_cut_out(length), _RESULT)
    if not plain:
        return done.join(rows.select("key", "doc_id"), "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    return done.withColumnRenamed("key", "doc_id")
