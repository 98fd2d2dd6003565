import random

from orebed.llm import quality

from .helpers import docs, measures, prose


def texts():
    rng = random.Random(3)
    out = [None, "", " \t\n", "word", "é ü 中文 😀 x", "#*$ %&| <>", "a\nb\na\n\n \na", "no!! no!! no!!", "x " * 100]
    phrase = prose(rng, 12, breaks=0)
    out += [f"{phrase} mid {phrase} end {phrase}", " ".join(["q"] * 7), " ".join(["q"] * 9), " ".join("abcdefgh"), " nb sp"]
    out += [prose(rng, rng.randrange(1, 120), vocabulary=rng.choice([2, 3, 400])) for _ in range(60)]
    out.append(prose(rng, 20_000, vocabulary=30))
    return out


def test_measures_match_brute_force(spark):
    given = texts()
    table = docs(spark, given).selectExpr("*", "1 AS words", "'z' AS lines", "2 AS n_words")
    got = {r["doc_id"]: r.asDict() for r in quality.measure(table).collect()}
    assert {i: {k: got[i][k] for k in quality.MEASURES} for i in got} == {i: measures(t) for i, t in enumerate(given)}


def test_bits_policies_and_ablations(spark):
    book = quality.ledger(docs(spark, texts())).cache()
    for row in quality.apply_policy(book, quality.BASE).collect():
        few, repeats = row["n_words"] < 20, 100 * row["n_repeat_words"] > 30 * row["n_words"]
        assert row["fail_bits"] & 3 == few + 2 * repeats and row["kept"] == (not few and not repeats)
    bits = [r["fail_bits"] for r in book.collect()]
    mask = quality.policy_mask(quality.POLICIES["v2"])
    for row in quality.ablations(book, quality.POLICIES["v2"]).collect():
        bit = quality.policy_mask((row["rule"],))
        assert row["n_failing"] == sum(bool(b & bit) for b in bits)
        assert row["n_only_this"] == sum(b & mask == bit for b in bits)
        assert row["n_kept_without"] == sum(not b & mask & ~bit for b in bits)


def test_edges(spark):
    good = " ".join(f"word{i}" for i in range(40))
    table = docs(spark, [good, good, None, "", good], [None, 7, 7, None, 7]).selectExpr("*", "3 AS kept", "4 AS row")
    kept = quality.keep_good(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 7, 7]
    assert quality.ledger(table.limit(0)).count() == 0 and quality.keep_good(table.limit(0)).count() == 0
    assert quality.ablations(quality.ledger(table.limit(0)), quality.BASE).count() == 0
