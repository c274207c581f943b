"""Registered queries against their DuckDB statements, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from metaskein.llm import decontamination, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches(name, spark, con, sf_dir):
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = Counter(cursor.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, sf_dir).collect()) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_one_row_each(name, spark, sf_dir):
    table = "pages" if name.startswith("op1_") else "documents"
    assert queries.QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = docs.columns
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "!! 12", "en", "s", 5)], docs.schema))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf_dir).cache()
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(kept[name]) or name == "language"
        assert set(kept[name]) <= set(before)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == given
    assert not {-1, -2, -3} & set(kept["language"])
    near = queries.op7_ngram_jaccard(spark, sf_dir).collect()
    first = {r.component_id for r in near}
    assert set(kept["near_duplicates"]) == first & set(kept["language"])
    items = [set(zip(*(w[k:] for k in range(10)))) for w in (decontamination.words_of(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())]
    windows = set().union(*items)
    for i, r in kept["near_duplicates"].items():
        w = decontamination.words_of(r.text)
        assert (i in kept["decontamination"]) == (not windows & set(zip(*(w[k:] for k in range(10)))))
    for i, r in kept["personal_data"].items():
        assert not re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]", r.text) and r.n_chars == len(r.text)
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    assert all(r.exact for r in kept["tokens"].values()) and set(kept["tokens"]) == set(kept["personal_data"])


def test_pipeline_without_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
