"""Registered queries of the training-data operators on the smallest tables: SQL, schemas and cross-checks."""

import zlib

import numpy as np
import pytest

from check_oracles import compare, connect
from orebed.llm import packing
from orebed.llm.queries import ORACLES, QUERIES, tokenizer_path

from .helpers import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLES[name]) is None


def test_near_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = components(docs, 4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op2_minhash_near_dedup"](spark, SF).collect()}
    assert got == {d: want[i] for i, (d, _) in enumerate(docs)}


def test_packed_ids(spark):
    rows = QUERIES["op10_best_fit_packing"](spark, SF).collect()
    encode = packing.encoder(tokenizer_path()).tokenizer
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {d: encode.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts.items()}
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part)
    used = len({r["sequence_id"] for r in rows})
    assert used <= -(-sum(r["length"] for r in rows) // 1024) * 1.02 + 1


@pytest.mark.parametrize("name, columns", [
    ("op5_embedding_near_dedup", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    ("op6_html_extraction", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    ("op7_url_filters", {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}),
    ("op9_sentencepiece", {"doc_id": "bigint", "ids": "array<int>", "n_ids": "bigint"}),
])
def test_schema_and_rows(spark, name, columns):
    found = QUERIES[name](spark, SF)
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in columns} == columns
    table = {"op5": "embeddings", "op9": "documents"}.get(name.split("_")[0], "pages")
    assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
