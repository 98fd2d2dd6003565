import random

import pytest

import corpus_pipeline
from orebed.llm import quality, secretscan

from .helpers import components, docs, family_texts, measures, prose
from .test_linechunks import brute as without_repeats


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    texts = family_texts(12) + ["junk### " * 40, "go!! " * 50, prose(rng, 60, breaks=0) + " password=abcdefgh123"]
    shared = prose(rng, 90, breaks=0.1)
    texts += [f"{prose(rng, 60, vocabulary=5000)}\n{shared}\n{prose(rng, 60, vocabulary=5000)}" for _ in range(12)]
    return list(enumerate(texts))


def test_stages_against_brute_force(spark, corpus, tmp_path):
    table = docs(spark, [t for _, t in corpus]).selectExpr("*", "'more' AS row")
    rows = dict(corpus)
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, table, "unused")
        done.write.parquet(str(tmp_path / name))
        done = spark.read.parquet(str(tmp_path / name))
        if name == "best_fit_packing":
            break
        assert done.columns == table.columns, name
        if name == "quality_rules":
            bad = {i for i, t in rows.items() if any(eval(r.fails, dict(measures(t))) for r in quality.RULES)}  # noqa: S307
            rows = {i: t for i, t in rows.items() if i not in bad}
        elif name == "line_dedup":
            left = without_repeats(list(rows.items()))
            rows = {i: left[i, t] for i, t in rows.items() if left[i, t] == t or left[i, t].split()}
        elif name == "near_dedup":
            order = sorted(rows)
            found = components([(i, rows[i]) for i in order], 5)
            rows = {i: rows[i] for k, i in enumerate(order) if found[k][1] == i or not found[k][0]}
        elif name == "secret_scans":
            assert sum(secretscan.KINDS[0] in str(t) or "[secret]" in (t or "") for t in [r["text"] for r in done.collect()]) >= 1
            rows = {i: t.replace("password=abcdefgh123", "[secret]") for i, t in rows.items()}
        assert {r["doc_id"]: r["text"] for r in done.collect()} == rows, name
        assert all(r["n_chars"] == len(r["text"]) for r in done.collect()), name
        table = done
    assert {r["doc_id"] for r in done.collect()} == set(rows)


def test_empty_and_null_rows_pass_every_stage(spark):
    for table in (docs(spark, []), docs(spark, [None, "", None], [None, None, 4])):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, "unused").count() >= 0
    kept = corpus_pipeline.line_dedup(spark, docs(spark, [None, ""], [None, 1]), "").count()
    assert kept == 2 and corpus_pipeline.secret_scans(spark, docs(spark, [None, ""]), "").count() == 2
    assert corpus_pipeline.near_dedup(spark, docs(spark, [None, ""]), "").count() == 2


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
