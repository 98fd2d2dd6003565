"""Benchmark decontamination: automaton scan against brute-force windows, blocks, edge cases, removal."""

import hashlib
import random
import re

import pytest

from orebed.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, window=10):
    windows = {}
    for item_id, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        k = min(len(w), window)
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item_id)
    sizes = {len(key) for key in windows}
    out = {}
    for doc_id, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                ids = windows.get(tuple(w[i : i + k]))
                if ids:
                    hit.update(range(i, i + k))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc_id] = (len(w), len(hit), len(found), digest)
    return out


def scanned(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(d, b, **kw)
    return {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"]), r["d"]) for r in found.withColumn(
        "d", decontam.item_digest(found["items"])).collect()}


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(30)] + ["Ünï", "çà", "x9", "9"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 25)))) for i in range(12)]
    items += [(100, None), (101, ""), (102, "!!! ,,"), (103, items[0][1]), (104, "W1 w2")]
    docs = []
    for d in range(40):
        parts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 30)))]
        for _ in range(rng.randrange(0, 3)):
            text = rng.choice(items[:12])[1]
            parts.append(text.upper() if rng.random() < 0.3 else text)
        docs.append((d, ", ".join(parts)))
    docs += [(50, None), (51, ""), (52, "   "), (53, docs[3][1]), (54, "w1 w2 " * 3000)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scan_equals_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert scanned(spark, docs, items) == brute(docs, items)


def test_blocks_agree(spark, monkeypatch):
    docs, items = corpus(4)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 20)
    assert scanned(spark, docs, items) == brute(docs, items)


def test_window_sizes(spark):
    docs, items = corpus(5)
    for window in (1, 3, 25):
        assert scanned(spark, docs, items, window=window) == brute(docs, items, window)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = corpus(6)
    assert scanned(spark, docs, []) == {d: (len(WORD.findall((t or "").translate(LOWER))), 0, 0,
                                           hashlib.sha256(b"").hexdigest()) for d, t in docs}
    assert scanned(spark, [], items) == {}
    d = spark.createDataFrame([(1, "a b c", 5, "x")], "doc_id long, text string, n_hit long, items string")
    b = spark.createDataFrame([(7, "A B C", 1)], "item_id long, text string, doc_id long")
    assert decontam.contamination(d, b).select("doc_id", "n_hit").collect()[0] == (1, 3)


def test_decontaminate_removes_spans_and_drops_covered(spark):
    item = " ".join("t%d" % i for i in range(12))
    intro = "Intro words here, and more of them so that the item covers less than half of all words in it."
    docs = [(1, intro + " " + item.upper() + ". Tail stays"), (2, item), (3, "clean text"), (4, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(9, item)], "item_id long, text string")
    out = {r["doc_id"]: (r["text"], r["removed_words"]) for r in decontam.decontaminate(d, b).collect()}
    assert out == {1: (intro + " . Tail stays", 12), 3: ("clean text", 0), 4: (None, 0)}
