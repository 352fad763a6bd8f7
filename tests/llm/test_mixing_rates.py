"""Default weights over sources of very unequal size."""

import hashlib
import math
from collections import Counter

import duckdb
import pytest

from tidewater.llm import mixing


def test_a_tiny_source_is_served_at_any_rate(spark):
    rows = [(k, "x" * 1_000_000, "large") for k in range(4)] + [(10 + k, "yz"[k : k + 1], "tiny") for k in range(2)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("doc_id", "repetition_rate").collect()
    shares = {"large": 4e6 / 4_000_002, "tiny": 2 / 4_000_002}
    rate = {k: v**0.7 / sum(x**0.7 for x in shares.values()) / v for k, v in shares.items()}
    assert rate["tiny"] > 64 and {round(x.repetition_rate, 6) for x in got} == {round(x, 6) for x in rate.values()}
    want = Counter()
    for doc_id, _, source in rows:
        draws = max(1, math.ceil(rate[source] / mixing.STEP))
        mean = rate[source] / draws
        limits = [sum(math.exp(-mean) * mean**j / math.factorial(j) for j in range(k + 1)) for k in range(mixing.TERMS)]
        for k in range(1, draws + 1):
            u = int(hashlib.md5(f"mix-1|{k}|{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
            want[doc_id] += sum(u >= x for x in limits)
    assert Counter(x.doc_id for x in got) == +want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert Counter(x for (x,) in con.sql(mixing.mix_sql(columns="doc_id")).project("doc_id").fetchall()) == +want
    with pytest.raises(ValueError):
        mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights={"tiny": 1.0, "large": 1.0})
