"""The pipeline's stages on small tables, against plain Python."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lettermill.llm.catalog import QUERIES, SQL
from .conftest import edge_rows
from .test_operators import brute_groups

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(str(tuple(r[c] for c in columns)) for r in frame.collect())
    result = con.execute(SQL[name])
    at = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(at) == columns
    assert got == sorted(str(tuple(r[at[c]] for c in columns)) for r in result.fetchall())


def test_stages_keep_columns_and_take_effect(spark, edge, nothing):
    columns = edge.columns
    kept = corpus_pipeline.line_dedup(spark, edge, DATA)
    assert kept.columns == columns and kept.count() == len(edge_rows())
    assert all(r.n_chars == len(r.text) for r in kept.select("text", "n_chars").collect())
    single = corpus_pipeline.near_dedup(spark, edge, DATA)
    assert single.columns == columns
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] is not None]
    want = sorted({i for i, _, c in brute_groups(rows) if i == c})
    assert sorted(str(r.doc_id) for r in single.filter("doc_id is not null").collect()) == want
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, nothing, DATA)
        assert out.columns == columns and out.count() == 0


def test_near_dedup_links_at_80_percent(spark):
    rows = []
    for i in range(120):  # spread changes of five-word shingles: 0.76 to 0.86 in common
        words = [f"w{i}x{k}" for k in range(300)]
        rows.append((2 * i, " ".join(words)))
        for k in range(4 + i % 6):
            words[10 + 30 * k] = f"new{k}"
        rows.append((2 * i + 1, " ".join(words)))
    sets = {i: set(zip(*[t.split()[k:] for k in range(5)])) for i, t in rows}  # noqa: B905
    share = {i: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 240, 2)}
    want = sorted([*share, *(i + 1 for i in share if share[i] < 0.8)])
    assert sum(0.8 <= x < 0.85 for x in share.values()) >= 20 and min(share.values()) < 0.8
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA)
    assert sorted(r.doc_id for r in got.collect()) == want


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, DATA).collect()
        docs = spark.createDataFrame(rows, docs.schema) if rows and rows[0].__fields__ == docs.columns else rows
    digest = lambda r: (r.doc_id, r.n_tokens, tuple(r.ids), r.n_chars)
    assert sorted(map(digest, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(digest, docs))
    assert len(docs) > 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1").select("doc_id")
    clean = docs.join(good, "doc_id").filter(F.size(F.split("text", r"\s+")) >= 60)
    kept = corpus_pipeline.quality_rules(spark, docs, DATA).join(clean.select("doc_id"), "doc_id").count()
    assert kept == clean.count()
