"""Adapter views: the driver's tables in the shape of sequencing tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "reads": """SELECT CAST(doc_id AS STRING) AS read_id, text AS seq, lang AS marker, source AS sample, n_chars AS len, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id % 30 END AS qscore,
 CASE doc_id % 5 WHEN 0 THEN 'sup' WHEN 1 THEN 'hac' WHEN 2 THEN 'fast' WHEN 3 THEN 'hac2sup' ELSE 'other' END AS model, doc_id FROM documents""",
    "headers": """SELECT doc_id, concat_ws('|', CAST(doc_id AS STRING), upper(lang), CASE doc_id % 4 WHEN 0 THEN 'SUP' WHEN 1 THEN 'hac_fixed' WHEN 2 THEN 'fast' ELSE 'hac2sup' END,
 concat('barcode=', source), concat('adapter=', CASE WHEN doc_id % 5 = 0 THEN 'no_adapter_' ELSE 'ad_' END, CAST(doc_id % 3 AS STRING))) AS header FROM documents""",
    "hsps": """SELECT l_orderkey AS hash, l_partkey AS subject, CAST(l_linenumber AS BIGINT) AS ordinal, CAST(floor(l_extendedprice / 10000) AS BIGINT) AS bitscore,
 CAST(round(l_discount * 100) AS BIGINT) AS evalue, CAST(floor(l_quantity / 10) AS BIGINT) AS length, CAST(90 + round(l_tax * 100) AS BIGINT) AS pident,
 CAST(l_quantity AS BIGINT) AS qstart, CAST(l_quantity + 10 * l_linenumber AS BIGINT) AS qend, CAST(100 AS BIGINT) AS qlen FROM lineitem""",
    "lineage": """SELECT p_partkey AS subject, 'Metazoa' AS kingdom, p_type AS family, CASE WHEN p_size % 9 = 0 THEN 'NA' ELSE p_brand END AS genus,
 CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE p_name END AS species FROM part""",
    "members": "SELECT DISTINCT l_suppkey AS otu, l_orderkey AS read_id, l_returnflag AS marker FROM lineitem",
    "rounds": """SELECT event_id, user_id AS otu, event_type AS marker, CAST(EXTRACT(DAY FROM ts) AS BIGINT) AS round, CAST(floor(value) AS BIGINT) AS amount FROM events""",
    "sized": "SELECT round, otu, marker, count(*) AS n FROM rounds GROUP BY round, otu, marker",
    "best": """SELECT hash, subject, bitscore, evalue, length, pident FROM (SELECT *, rank() OVER (PARTITION BY hash ORDER BY bitscore DESC, evalue, length DESC, pident DESC) AS place FROM (
 SELECT *, row_number() OVER (PARTITION BY hash, subject ORDER BY bitscore DESC, evalue, length DESC, pident DESC, ordinal) AS nth FROM hsps) AS a WHERE nth = 1) AS b WHERE place = 1""",
    "hits": "SELECT hash, family, genus, species, pident FROM best JOIN lineage ON best.subject = lineage.subject",
}


def _needed(sql: str) -> list[str]:
    """The views that a query names, each after those that it needs."""
    out: list[str] = []
    for name, body in VIEWS.items():
        if re.search(rf"\b{name}\b", sql):
            for inner in [*_needed(body), name]:
                if inner not in out:
                    out.append(inner)
    return out


def with_views(sql: str) -> str:
    names = _needed(sql)
    return ("WITH " + ",\n".join(f"{x} AS ({VIEWS[x]})" for x in names) + "\n" if names else "") + sql


def duckdb(sql: str) -> str:
    return with_views(sql).replace("{has}", "regexp_matches").replace("{all}", ", 'g'")


def spark(sql: str, sf_dir: str) -> str:
    text = with_views(sql).replace("{has}", "regexp_like").replace("{all}", "")
    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b", lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet`", text)


def view(session: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views over the tables in sf_dir."""
    return session.sql(spark(f"SELECT * FROM {name}", sf_dir))
