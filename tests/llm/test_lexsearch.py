"""Ranked lexical search: dual-tree pruning against a brute-force ranker, pooled ids, edge cases."""

import math
import random
import re
from collections import Counter

import pytest

from orebed.llm import lexsearch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    counts = {}
    for d, t in docs:
        counts.setdefault(d, Counter()).update(TERM.findall((t or "").translate(LOWER)))
    counts = {d: c for d, c in counts.items() if c}
    n_docs, total = len(counts), sum(sum(c.values()) for c in counts.values())
    df = Counter(t for c in counts.values() for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    asks = {}
    for i, t in items:
        asks.setdefault(i, Counter()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for i, q in asks.items():
        scored = []
        for d, c in counts.items():
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            s = sum(n * w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, n in q.items() if t in c)
            if s > 0:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored, key=lambda x: (x[0], -1 if x[1] is None else x[1]))[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexsearch.search(d, b, **kw).select("item_id", "rank", "doc_id", "score").collect()),
                  key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocab = ["t%d" % i for i in range(80)] + ["Çé", "x1", "2b"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    items = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(1, 12)))) for i in range(30)]
    items += [(90, None), (91, "..."), (92, "zzz unseen"), (93, items[0][1])]
    docs = [(d, " ".join(rng.choices(vocab, weights, k=rng.randrange(0, 60)))) for d in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, docs[5][1]), (n + 3, "T1 " * 2000), (7, "t3 t3 pooled")]
    for d in range(n + 4, n + 30):
        docs.append((d, rng.choice(items[:30])[1].upper()))
    return docs, items


@pytest.mark.parametrize("seed, leaf, fanout", [(1, 4, 2), (2, 16, 4), (3, 1, 1)])
def test_search_equals_brute_force(spark, monkeypatch, seed, leaf, fanout):
    monkeypatch.setattr(lexsearch, "LEAF", leaf)
    monkeypatch.setattr(lexsearch, "FANOUT", fanout)
    monkeypatch.setattr(lexsearch, "ITEM_BLOCK", 3)
    docs, items = corpus(seed)
    assert searched(spark, docs, items) == brute(docs, items)


def test_other_k_and_ties(spark, monkeypatch):
    monkeypatch.setattr(lexsearch, "LEAF", 2)
    docs = [(d, "alpha beta") for d in range(12)] + [(20, "gamma")]
    items = [(1, "alpha"), (2, "gamma gamma"), (3, "delta")]
    for k in (1, 3, 20):
        assert searched(spark, docs, items, k=k) == brute(docs, items, k)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = corpus(4, 20)
    assert searched(spark, docs, []) == []
    assert searched(spark, [], items) == []
    assert searched(spark, [(1, None), (2, "")], items) == []
    d = spark.createDataFrame([(1, "a b", 3), (2, "b c", 4)], "doc_id long, text string, score long")
    b = spark.createDataFrame([(5, "A", 0)], "item_id long, text string, rank long")
    assert [tuple(r) for r in lexsearch.search(d, b).collect()] == [(5, 1, 1, brute([(1, "a b"), (2, "b c")], [(5, "A")])[0][3])]


def test_pruning_skips_leaves(spark, monkeypatch):
    """Topical texts: leaves without an item's topic are bounded below its tenth score and skipped."""
    monkeypatch.setattr(lexsearch, "LEAF", 2)
    monkeypatch.setattr(lexsearch, "FANOUT", 4)
    rng = random.Random(9)
    topics = [["k%dx%d" % (t, i) for i in range(40)] for t in range(6)]
    docs = [(d, " ".join(rng.choices(topics[d % 6], k=rng.randrange(5, 40)))) for d in range(400)]
    items = [(i, " ".join(rng.choices(topics[i % 6], k=6))) for i in range(12)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    report = {}
    found = sorted((tuple(r) for r in lexsearch.search(d, b, report=report).collect()), key=str)
    assert found == brute(docs, items)
    assert 0 < report["scored_leaf_pairs"] < report["leaf_pairs"] / 2


def test_scoring_shuffles_no_item_document_rows(spark):
    """Postings meet the asking items by leaf, in slices and parts, and only each leaf's best come back."""
    items = spark.createDataFrame([(1, 7, 3, 0), (1, 8, 1, 0), (2, 8, 5, 1), (3, 9, 4, 1)], "item_id long, term long, q long, iblock int")
    pairs = spark.createDataFrame([(i, b, leaf) for i in (1, 2, 3) for b, leaf in ((0, 0), (0, 1))], "item_id long, bucket int, leaf int")
    rows = [(0, d % 2, t, d, 10 * d + t) for d in range(8) for t in (7, 8)] + [(0, 1, 8, None, 3)]
    postings = spark.createDataFrame(rows, "bucket int, leaf int, term long, doc_id long, c long")
    found = lexsearch._leaf_scores(items, pairs, postings, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    dealt = [x.split(")")[0] for x in plan.split("hashpartitioning(")[1:]]
    assert dealt and not any("doc_id" in x or "term" in x for x in dealt)
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, 4, 3 * 47 + 48), (1, 5, 3 * 57 + 58), (1, 6, 3 * 67 + 68), (1, 7, 3 * 77 + 78),
        (2, 4, 5 * 48), (2, 5, 5 * 58), (2, 6, 5 * 68), (2, 7, 5 * 78)]


def test_leaf_scores_stay_exact_beyond_doubles(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lexsearch, "TERM_SLICE", 1)
    monkeypatch.setattr(lexsearch, "ITEM_SLICE", 1)
    found = pa.table({"doc_id": pa.array([4, 4, None, None, 2], "int64"), "term": pa.array([1, 2, 1, 2, 9], "int64"),
                      "c": pa.array([2**40 + 1, 1, 2**40 + 1, 1, 5], "int64")})
    asked = pa.table({"item_id": pa.array([6, 7], "int64"), "terms": pa.array([[1, 2], [3]], pa.list_(pa.int64())),
                      "qs": pa.array([[2**21 + 1, 1], [1]], pa.list_(pa.int64()))})
    score = (2**40 + 1) * (2**21 + 1) + 1
    assert lexsearch._leaf_best(found, asked, 10).to_pylist() == [
        {"item_id": 6, "doc_id": None, "score": score}, {"item_id": 6, "doc_id": 4, "score": score}]
