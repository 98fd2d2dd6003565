import random
from collections import Counter

import numpy as np

from orebed.llm import nearsets

from .helpers import components, docs, family_texts, prose, shingles


def judged(table, k):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nearsets.near_duplicates(table, k).collect())


def wanted(ids, texts, k):
    found = components(list(zip(ids, texts, strict=True)), k)
    return Counter((d, *found[i]) for i, d in enumerate(ids))


def test_components_match_all_pairs(spark):
    texts = family_texts()
    ids = list(range(100, 100 + len(texts)))
    random.Random(8).shuffle(ids)
    table = docs(spark, texts, ids).selectExpr("*", "1 AS digest", "2 AS bands", "3 AS bucket")
    for k in (4, 5):
        assert judged(table, k) == wanted(ids, texts, k)


def test_a_hot_passage_links_only_what_is_similar(spark):
    rng = random.Random(11)
    passage = prose(rng, 60, breaks=0)
    texts = [passage + " " + prose(rng, rng.randrange(5, 60), vocabulary=9999) for _ in range(150)] + [passage] * 60
    assert judged(docs(spark, texts), 4) == wanted(range(len(texts)), texts, 4)


def test_rows_that_share_an_id_or_have_none(spark):
    texts = family_texts(6)[:30] * 2
    ids = [None if i % 5 == 0 else i // 3 for i in range(len(texts))]
    assert judged(docs(spark, texts, ids), 5) == wanted(ids, texts, 5)


def test_one_document_of_each_group_stays(spark):
    texts = family_texts(7)
    table = docs(spark, texts + texts[:20], list(range(len(texts))) + list(range(20)))
    kept = nearsets.keep_one(table)
    assert kept.columns == table.columns
    found = components(list(enumerate(texts)), 5)
    blank = [i for i, t in enumerate(texts) if not shingles(t, 5)]
    want = {c for i, (n, c) in found.items() if n}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want) + Counter({i: 1 + (i < 20) for i in blank})


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(150):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = np.unique(pool[:240]), np.unique(pool[60:])
        s = nearsets.signatures([a, b])
        errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / 300)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.6 * 0.4 / nearsets.SLOTS  # independent minima would have 0.24 / SLOTS
    one = nearsets.signatures([np.array([5], np.uint64)])
    assert sorted((one[0] >> np.uint64(56)).tolist()) == list(range(nearsets.SLOTS))


def test_empty_tables(spark):
    assert nearsets.near_duplicates(docs(spark, [])).count() == 0
    assert nearsets.keep_one(docs(spark, [])).count() == 0
    assert judged(docs(spark, [None, ""]), 4) == Counter([(0, 0, 0), (1, 0, 1)])


def test_remembered_words_leave_room_for_the_other_workers():
    assert nearsets.REMEMBERED <= 250_000  # six workers with a million each were over 3000 MB
    sets_of = nearsets.ShingleSets(2)
    before = [s.tolist() for s in sets_of(["a b c d", "c d e"])]
    sets_of.memo.update((str(i).encode() + b"x", i) for i in range(nearsets.REMEMBERED + 1))
    assert [s.tolist() for s in sets_of(["a b c d", "c d e"])] == before and len(sets_of.memo) == 5
