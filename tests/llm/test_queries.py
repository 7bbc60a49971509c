"""Registered queries against their SQL, and the pipeline against its stages by brute force."""

from __future__ import annotations

import re

import duckdb
import pytest

import corpus_pipeline
from palaver.llm.oracle import ORACLE
from palaver.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    ours = QUERIES[name](spark, SF_DIR)
    columns = sorted(ours.columns)
    found = duck.execute(ORACLE[name])
    theirs = [c[0] for c in found.description]
    assert sorted(theirs) == columns
    want = sorted(repr(tuple(row[theirs.index(c)] for c in columns)) for row in found.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in ours.collect()) == want


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").persist()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, SF_DIR).persist()
        after = docs.collect()
        assert after and {r["doc_id"] for r in after} <= set(before)
        if name != "source mixture":
            assert docs.columns == columns and len(after) == len({r["doc_id"] for r in after})
        if name == "near duplicates":
            sets = {}
            for r in after:
                ws = re.findall(r"[^\x20\x09-\x0D]+", r["text"].lower())
                sets[r["doc_id"]] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))}
            ids = sorted(sets)
            assert not any(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for k, a in enumerate(ids) for b in ids[k + 1 :])
        if name == "personal data":
            assert not any(re.search(r"@mail\d\.example\.com", r["text"]) for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
    assert {"pass", "slot", "n_tokens"} <= set(docs.columns)
