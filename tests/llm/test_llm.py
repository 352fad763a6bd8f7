"""The operators of tidewater.llm against brute-force versions, round trips and edge cases."""

import base64
import hashlib
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, embedding_links, mixing, quality, simhash, suffix_dedup, token_shards, toxicity, warc
from tidewater.llm.elias_fano import EliasFano
from tidewater.llm.queries import tokenizer_path

ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "no id here"), (4, "a b c d e f g h i j k l"), (4, "a b c d e f g h i j k l"), (5, "x" * 30_000), (6, "Ünïcode wörds ñ 漢字 " * 40)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if k % 2 else None, None if k % 3 else "s", None, 7) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 1 << 40), (1000, 50), (3000, 1 << 33)):
        values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
        held, _ = EliasFano.from_bytes(EliasFano.encode(values).to_bytes())
        assert held.decode().tolist() == values.tolist()
        assert [held.select(i) for i in range(0, n, 7)] == values[::7].tolist()


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    own = token_shards.Encoder(tokenizer_path(), "<u2")
    rng, parts = random.Random(4), [" ", "  ", "\n", "\t", "a", "b.", "'s", "é1", "ñ", " the", "<|endoftext|>", "漢"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert own.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u2").tobytes(), repr(text)


def test_encoder_tests_only_words_with_white_space(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_shards, "_MEMO_ENTRIES", 60)
    plain, own = Tokenizer.from_file(tokenizer_path()), token_shards.Encoder(tokenizer_path(), "<u2")
    asked, tested, search = [], [], token_shards._RUN.search
    monkeypatch.setattr(token_shards, "_RUN", SimpleNamespace(search=lambda x: (tested.append(x), search(x))[1]))
    monkeypatch.setattr(own, "_parts", lambda words, f=own._parts: (asked.extend(words), f(words))[1])
    rng = random.Random(5)
    groups = [[" ".join(rng.choice(["", "\n", "a\nb", "c\n\n\nd"]) if rng.random() < 0.04 else f"w{rng.randrange(40 * g, 40 * g + 40)}," for _ in range(30)) for _ in range(20)] for g in range(3)]
    for texts in [*groups, groups[-1]]:  # the memo overflows; odd words known from one group must still be seen in the next
        assert own.encode_all(texts) == [np.array(plain.encode(x, add_special_tokens=False).ids, "<u2").tobytes() for x in texts]
    assert len(own.memo) <= 100 and len(asked) == len(set(asked)) > 100
    assert tested and all(x != x.strip() or len(x.split()) > 1 for x in tested)


def test_encoder_takes_added_tokens_as_the_library_does():
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(tokenizer_path()), token_shards.Encoder(tokenizer_path(), "<u2")
    added = [x.content for x in plain.get_added_tokens_decoder().values()]
    assert added
    texts = ["plain words", *(form.format(x) for x in added for form in ("{0}", "hello {0} world", "a{0}b", "{0}{0} c", " {0}", "{0}\n\n x"))]
    want = [np.array(plain.encode(x, add_special_tokens=False).ids, "<u2").tobytes() for x in texts]
    assert own.encode_all(texts) == want
    assert [own.encode(x) for x in texts] == want


def test_token_shards_of_many_files_a_task(spark, tmp_path):
    from tokenizers import Tokenizer

    plain, rng = Tokenizer.from_file(tokenizer_path()), random.Random(3)
    rows = [(k * 3 - 50, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(40)))) for k in range(700)] + [(None, "x"), (None, None)]
    token_shards.write_token_shards(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "ids"), tokenizer_path(), 2, shard_ids=500)
    got = sorted(token_shards.read_token_index(spark, str(tmp_path / "ids")).collect(), key=lambda x: x.start)
    assert len({x.shard for x in got}) > 8
    at = 0
    for x, (doc_id, n) in zip(got, [(None, None)] * 2 + sorted((k, t) for k, t in rows if k is not None)):
        assert (x.doc_id, x.start) == (doc_id, at)
        if doc_id is not None:
            ids = np.array(plain.encode(n, add_special_tokens=False).ids + [2], "<u4")
            assert (x.n_tokens, x.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        at += x.n_tokens
    assert len(got) == len(rows)


def test_token_shards_round_trip(spark, odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    got = sorted(token_shards.encode_documents(odd, tokenizer_path(), 2).collect(), key=lambda x: x.start)
    at = 0
    for row, (doc_id, text) in zip(got, sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0))):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_shards.encode_documents(odd.limit(0), tokenizer_path(), 2).count() == 0


def test_embedding_links_find_what_brute_force_finds(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 16))
    near = base[:40] + 0.1 * rng.standard_normal((40, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near, base[:5], base[:1] * 3]))]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0, 2.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {x.vec_id: x for x in embedding_links.link_embeddings(df).collect()}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    assert [got[k].n_links for k in range(len(rows))] == links.sum(1).tolist()
    component = np.arange(len(rows))
    for _ in range(len(rows)):
        component = np.minimum(component, np.where(links, component, 1 << 40).min(1))
    assert [got[k].component_id for k in range(len(rows))] == component.tolist()
    assert all(got[k].n_links == 0 and got[k].kept for k in range(900, 906))
    assert embedding_links.link_embeddings(df.limit(0)).count() == 0


def test_mix_matches_its_sql_and_means(spark, odd):
    import duckdb

    docs = spark.createDataFrame([(k, "w" * (1 + k % 50), "a" if k % 3 else "b", 1) for k in range(3000)], "doc_id long, text string, source string, copy int")
    got = mixing.mix(docs).select("doc_id", F.col("copy").alias("c"), "shuffle_key").toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.sql(mixing.mix_sql(columns="doc_id").replace("SELECT *, unnest", "SELECT * EXCLUDE (copy), unnest")).df()
    assert sorted(zip(got.doc_id, got.c, got.shuffle_key)) == sorted(zip(want.doc_id, want["copy"], want.shuffle_key))
    heavy = mixing.mix(docs, weights={"a": 1.0}, epochs=5.0)
    assert heavy.where("source = 'b'").count() == 0
    rate = heavy.select("repetition_rate").first()[0]
    assert abs(heavy.count() / (2000 * rate) - 1) < 0.05 and rate > mixing.STEP
    rate = {x.mix_source: x.rate for x in mixing.source_rates(odd).collect()}
    assert set(rate) == {"", "s"}
    copies = mixing.mix(odd.withColumn("row", F.lit(3))).collect()
    assert {(x.doc_id, x.text, x.row, x.score) for x in copies} <= {(k, t, 3, 7) for k, t in ODD} and len(copies) == mixing.mix(odd, told=False).count()
    assert sum(x.doc_id == 4 for x in copies) % 2 == 0  # repeated rows draw alike
    con.register("odd", odd.toArrow())
    assert con.sql(mixing.mix_sql(table="odd", columns="doc_id")).df().shape[0] == len(copies)
    assert mixing.mix(odd.limit(0)).count() == 0


def _junk(rng, words):
    return " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words)


def test_quality_learns_and_keeps_columns(spark, odd):
    rng, vocabulary = random.Random(5), ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]
    docs, labels = [], []
    for k in range(600):
        words = [rng.choice(vocabulary) for _ in range(60)]
        docs.append((k, _junk(rng, words) if k % 4 == 0 else " ".join(words) + ".", "en", "s", 300))
        if k % 2 == 0:
            labels.append((k, int(k % 4 != 0)))
    df, known = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")
    scores = {x.doc_id: x.kept for x in quality.score_quality(df, known).collect()}
    assert sum(scores[k] != (k % 4 != 0) for k in range(600)) == 0
    kept = quality.keep_good(df, known)
    assert kept.columns == df.columns and kept.count() == 450
    assert quality.score_quality(odd, known).count() == len(ODD)
    assert {x.score for x in quality.score_quality(odd, known.limit(0)).collect()} == {1.0}
    assert quality.keep_good(odd.limit(0), known).count() == 0


def _print(text):
    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    ones = [sum(xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_simhash_prints_and_pairs(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert sorted(x.fingerprint for x in got) == sorted(f"{_print(t):016x}" for _, t in ODD)
    assert {x.doc_id: x.component_id for x in got}[3] == 1
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("split_over", [1, 256])
def test_hamming_pairs_are_complete(spark, split_over):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(60)]
    held = {x ^ sum(1 << b for b in set(rng.sample(range(64), rng.randrange(4)))) for x in base for _ in range(12)}
    signed = [x - (1 << 64) if x >> 63 else x for x in held]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    got = simhash.hamming_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"), 2, split_over)
    assert {tuple(x) for x in got.collect()} == want


@pytest.mark.parametrize("block_bytes, piece_words", [(40, 20_000), (1 << 20, 2), (1 << 20, 20_000)])
def test_decontamination_equals_brute_force(spark, odd, monkeypatch, block_bytes, piece_words):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece_words)
    rng, vocabulary = random.Random(7), ["a", "b", "c", "É", "7"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, text(12)), (2, text(3)), (3, None), (4, "!!"), (5, text(15)), (5, text(10)), (None, text(4))]
    docs = [(k, text(200)) for k in range(20)] + [(50, "x " + items[0][1].upper() + ", y")]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {x.doc_id: x for x in decontaminate.scan(spark.createDataFrame(docs, "doc_id long, text string"), benchmark, block_bytes=block_bytes).collect()}
    for doc_id, body in docs:
        own, hit, found = words(body), set(), set()
        for item_id, item in items:
            w = words(item)
            for k in range(max(1, len(w) - 9) if w else 0):
                window = w[k : k + 10]
                for at in range(len(own) - len(window) + 1):
                    if own[at : at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        found.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(got[doc_id]) == (doc_id, len(own), len(hit), len(found), digest, bool(hit))
    kept = decontaminate.drop_contaminated(odd, spark.createDataFrame([(1, "c d e f g h i j k l")], "item_id long, text string"))
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 2
    assert decontaminate.scan(odd, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.scan(odd.limit(0), benchmark).count() == 0
    many = decontaminate.drop_contaminated(odd, spark.createDataFrame([(k, f"c d e f g h i j k {x}") for k, x in enumerate("xyzl")], "item_id long, text string"), block_bytes=30)
    assert many.count() == len(ODD) - 2


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/ x\r\ny", "same"), (3, None, None), (4, "u", ""), (5, "u", "<p>" + "long " * 5000), (None, "u", "alone"), (7, "u", "same"), (7, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archive_pages(pages).collect()
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        row = next(x for x in got if x.page_id == page_id)
        revisit = page_id is not None and page_id != max(same)
        assert (row.payload_bytes, row.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (row.record_type, row.refers_to) == (("revisit", max(same)) if revisit else ("response", None))
    assert warc.archive_pages(pages.limit(0)).count() == 0


def _maximal(scores, low, high):
    """The segment of the greatest sum (of those the shortest, of those the first), then those of what is left of it and right of it."""
    sums = [(round(sum(scores[a : b + 1]), 9), a - b, -a, b) for a in range(low, high + 1) for b in range(a, high + 1)]
    if not sums or max(sums)[0] <= 0:
        return []
    _, _, a, b = max(sums)
    return [*_maximal(scores, low, -a - 1), (-a, b), *_maximal(scores, b + 1, high)]


def test_segments_equal_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.choice([-0.5, -0.5, -0.5, 2.0, 1.0, 0.25]) for _ in range(rng.randrange(1, 14))]
        found = toxicity.segments([(k, s) for k, s in enumerate(scores) if s > 0])
        places = {k for k, v in enumerate(scores) if v > 0}
        assert {(a, b) for a, b, _ in found} == set(_maximal(scores, 0, len(scores) - 1)) and places == {k for a, b, _ in found for k in range(a, b + 1) if scores[k] > 0}
        best = max((sum(scores[a : b + 1]) for a in range(len(scores)) for b in range(a, len(scores))), default=0)
        assert max((s for _, _, s in found), default=0) == pytest.approx(max(best, 0))
        assert all(sum(scores[a : b + 1]) == pytest.approx(s) for a, b, s in found)
        assert all(x[1] < y[0] for x, y in zip(found, found[1:]))


def test_toxicity_on_held_out_rows(spark, odd):
    rng = random.Random(9)
    docs = [(k, " ".join([f"w{rng.randrange(400)}" for _ in range(80)] + (["badword", "awful"] if k % 5 == 0 else []))) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(900)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(df, labels).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got)
    assert sum(x.predicted != (x.doc_id % 5 == 0) for x in got if x.held_out) == 0
    odd_scores = {x.doc_id: x for x in toxicity.score_toxicity(odd, labels).collect() if x.doc_id not in (4, None)}
    assert len(odd_scores) == len(ODD) - 3 and not any(x.predicted for x in odd_scores.values()) and odd_scores[1].score == odd_scores[2].score == odd_scores[3].score
    assert toxicity.score_toxicity(odd, labels).count() == len(ODD) and toxicity.score_toxicity(odd.limit(0), labels).count() == 0
    assert {x.score for x in toxicity.score_toxicity(odd, labels.limit(0)).collect()} == {0.0}


def _removed(docs, length):
    seen, out = set(), []
    for doc_id, text in docs:
        data, mask = (text or "").encode(), bytearray(len((text or "").encode()))
        for k in range(len(data) - length + 1):
            if data[k : k + length] in seen:
                mask[k : k + length] = b"\1" * length
            seen.add(data[k : k + length])
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        out.append((doc_id, len(data), sum(mask), spans, hashlib.sha256(bytes(c for c, m in zip(data, mask) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("split_over, sample", [(1, 64), (1, 1), (20_000, 64)])
def test_suffix_dedup_equals_brute_force(spark, odd, split_over, sample):
    rng = random.Random(10)
    pool = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(60, 260))) for _ in range(12)]
    docs = [(k, "".join(rng.choice(pool)[rng.randrange(20) :] for _ in range(rng.randrange(5)))) for k in range(60)] + [(99, "z" * 500), (100, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), split_over=split_over, sample=sample).drop("spans")
    assert sorted(tuple(x) for x in got.collect()) == _removed(docs, 100)


def test_suffix_dedup_of_a_text_beyond_one_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 3000)
    rng = random.Random(12)
    long = "".join(rng.choice("abcdefgh") for _ in range(9000))
    docs = [(1, long), (2, "x" + long[2900:3200] + "y" + long[5900:6150]), (3, "q" * 7000), (4, long[:99])]
    got = sorted(tuple(x) for x in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).drop("spans").collect())
    assert got == _removed(docs, 100)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), length=400)


def test_suffix_dedup_edges(spark, odd):
    ordered = sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256((x[1] or "").encode()).hexdigest()))
    got = suffix_dedup.remove_repeats(odd).drop("spans").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _removed(ordered, 100)))
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_maximal_repeats():
    data = b"xabcdyabcdzabc"
    assert sorted(suffix_dedup.maximal_repeats(data, 3)) == [(3, [1, 6, 11]), (4, [1, 6])]


def test_lm_tables_are_normalised():
    from tidewater.llm.lm_scoring import Model

    shares = np.array([0.5, 0.3, 0.2])
    first, second, norm = Model(shares, 4, 1).tables()
    total = np.exp(first[:, None, :] + second[None, :, :] - norm[:, :, None]).sum(2)
    assert np.allclose(total, 1, atol=1e-5)
