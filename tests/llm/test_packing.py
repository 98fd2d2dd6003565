import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orebed.llm import packing
from orebed.llm.queries import tokenizer_path

from .helpers import docs, prose


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=200))
def test_plan_places_every_piece_once(sizes):
    counts = Counter(sizes)
    slots = packing.plan_slots(dict(counts), 60)
    ranks, bins = defaultdict(list), defaultdict(list)
    for size, first, n, sequence, offset in slots:
        ranks[size] += range(first, first + n)
        for k in range(n):
            bins[sequence + k].append((offset, size))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 60 and sum(3 * s > 60 for _, s in parts) <= 2
    assert sorted(bins) == list(range(len(bins)))
    assert len(bins) <= -(-sum(sizes) * 3 // 120) + 1 + sum(2 * s > 60 for s in sizes)


def test_plan_refuses_bad_lengths():
    for size in (0, 61):
        with pytest.raises(ValueError):
            packing.plan_slots({size: 1}, 60)


def odd_texts():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "foo", "é", "中文", "<|endoftext|>", "'s", "123", "!!", " ", "😀", "\r\n", "x" * 30]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)]


def test_units_give_the_tokenizers_ids():
    encode = packing.encoder(tokenizer_path())
    given = odd_texts() + [prose(random.Random(2), 3000)]
    want = encode.tokenizer.encode_batch(given, add_special_tokens=False)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(given)] == [x.ids for x in want]


def test_sequences_hold_all_documents(spark):
    rng = random.Random(4)
    texts = [None, "", "a", "a"] + odd_texts()[:80] + [prose(rng, n) for n in (200, 400, 900, 5000)]
    ids = [None, 1, 1, 1] + list(range(10, 10 + len(texts) - 4))
    table = docs(spark, texts, ids).selectExpr("*", "1 AS length", "2 AS piece", "3 AS rank_")
    pieces = packing.token_pieces(table, tokenizer_path(), capacity=64)
    packed = packing.pack(pieces, 64).cache()
    encode = packing.encoder(tokenizer_path()).tokenizer
    want = Counter()
    for d, t in zip(ids, texts, strict=True):
        tokens = encode.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(tokens) % 64 or 64
        cuts = [0, *range(first, len(tokens) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d, k, a, b - a, np.array(tokens[a:b], "<u4").tobytes())] += 1
    rows = packed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for parts in bins.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert joined == {s: b"".join(x[2] for x in sorted(p)) for s, p in bins.items()}
    assert len(bins) <= 1.05 * sum(r["length"] for r in rows) / 64 + 1


def test_numbering_splits_hot_lengths(spark):
    pieces = spark.range(1000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "IF(id % 3 = 0, 5L, 7L) AS length")
    rows = packing.numbered(pieces, 9).collect()
    for size in (5, 7):
        ranks = sorted(r["rank_"] for r in rows if r["length"] == size)
        assert ranks == list(range(len(ranks)))


def test_empty_table(spark):
    pieces = packing.token_pieces(docs(spark, []), tokenizer_path())
    assert packing.pack(pieces).count() == 0


def test_encoding_rounds_share_units_and_bound_long_texts(monkeypatch):
    """Short texts go together by the thousand, long ones alone; no row is lost and ids stay the tokenizer's."""
    import pandas as pd

    batch = pd.DataFrame({"doc_id": range(3000), "text": ["ab cd"] * 2998 + [None, ""]})
    assert [len(x) for x in packing.encoding_rounds(batch)] == [2048, 952]
    monkeypatch.setattr(packing, "ROUND_CHARS", 10)
    batch = pd.DataFrame({"doc_id": range(5), "text": ["x" * 30, "ab", "cd", "y" * 9, None]})
    assert [list(x["doc_id"]) for x in packing.encoding_rounds(batch)] == [[0], [1, 2], [3, 4]]
    assert list(packing.encoding_rounds(batch.iloc[:0])) == []
    encode = packing.UnitEncoder(tokenizer_path())
    texts = odd_texts()
    expected = [np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode(texts) == expected and encode(texts[::-1]) == expected[::-1]


def test_runs_of_new_units_are_encoded_once(monkeypatch):
    """Words, signs and single line breaks are cut apart before they are encoded; the ids stay the tokenizer's."""
    encode = packing.UnitEncoder(tokenizer_path())
    texts = ["Ab qwzx.\nQwzx, qwzx! größe,\nübung.", "x don't a's foo.'s bar.\n\nx y.\n z 12,3 a²b ab\n1 <|endoftext|> a<|endoftext|>.\nb", "a", "", " a", "a "]
    want = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    asked = []
    runs = encode._dealt_runs
    monkeypatch.setattr(encode, "_dealt_runs", lambda parts, before: runs(asked.extend((before, x) for x in parts) or parts, before))
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
    assert len(asked) == len(set(asked)) and {(" ", "qwzx"), ("", "Qwzx"), (" ", "größe"), ("", "übung")} <= set(asked)
    assert not {x for _, x in asked} & {"qwzx.\nQwzx,", "qwzx!", "größe,\nübung."}
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts[::-1])] == want[::-1]
    ids, sizes = encode.flat(texts)
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(x) for x in want]


def test_large_ids_beside_null_ids(spark):
    """A null id beside an id above 2^53 leaves that id as it is."""
    big = 2**60 + 1
    rows = packing.token_pieces(docs(spark, ["a b", "c"], [big, None]), tokenizer_path()).collect()
    assert {r["doc_id"] for r in rows} == {big, None}
