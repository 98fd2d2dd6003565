"""Repeated passages go whole, whatever their line breaks."""

import random

from orebed.llm import linechunks

from .helpers import docs, prose


def size(lines):
    return sum(len(line.split()) for line in lines)


def repeated(texts):
    """(document, line) of every repeat of a run of LONG_WORDS words, by comparing all pairs of lines."""
    split = [t.split("\n") for t in texts]
    out = set()
    for b, later in enumerate(split):
        for a, former in enumerate(split[: b + 1]):
            for i in range(len(former)):
                for j in range(len(later)):
                    if a == b and i >= j or i and j and former[i - 1] == later[j - 1]:
                        continue  # only where a shared run begins
                    n = 0
                    while i + n < len(former) and j + n < len(later) and former[i + n] == later[j + n] and (a < b or i + n < j):
                        n += 1
                    if size(later[j : j + n]) >= linechunks.LONG_WORDS:
                        out.update((b, k) for k in range(j, j + n))
    return out


def test_every_repeated_run_goes_whatever_its_line_breaks(spark):
    rng = random.Random(8)
    texts = []
    for breaks in (0.0, 0.03, 0.1, 0.2, 0.4, 0.9):
        for words in (51, 60, 90):
            passage = prose(rng, words, vocabulary=100_000, breaks=breaks)
            for _ in range(2):
                own = [prose(rng, 12, vocabulary=100_000, breaks=0.2) for _ in range(2)]
                texts.append("\n".join([own[0], passage, own[1]]))
    got = {r["doc_id"]: r["text"] for r in linechunks.dedup_passages(docs(spark, texts)).select("row.doc_id", "text").collect()}
    chunked = {r["doc_id"]: r["text"] for r in linechunks.dedup_lines(docs(spark, texts)).select("row.doc_id", "text").collect()}
    gone = repeated(texts)
    assert len({b for b, _ in gone}) == len(texts) // 2
    for d, t in enumerate(texts):
        assert got[d] == "\n".join(line for k, line in enumerate(t.split("\n")) if (d, k) not in gone)
    assert sum(chunked[d] != got[d] for d in got) > 5  # chunks alone leave parts of these


def test_mixed_repeats_go_and_words_stay(spark):
    rng = random.Random(9)
    pool = [prose(rng, rng.randrange(1, 30), breaks=0) for _ in range(30)] + [""]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 25))) for _ in range(25)]
    texts += ["\n".join(pool[:12]), "\n".join(["x", *pool[:12], *pool[3:12]]), "\n".join(["a b c d e f g h i j"] * 17)]
    texts += [texts[3], "\n".join(pool[5:20])]
    done = linechunks.dedup_passages(docs(spark, texts)).select("row.doc_id", "text", "removed_lines").collect()
    got = {r["doc_id"]: r["text"] for r in done}
    gone = repeated(texts)
    for d, t in enumerate(texts):  # what is left is in order, and no line of a repeated run is in it
        rest = iter([line for k, line in enumerate(t.split("\n")) if (d, k) not in gone] + [""])
        assert all(any(line == other for other in rest) for line in got[d].split("\n"))
    assert all(r["removed_lines"] >= sum(d == r["doc_id"] for d, _ in gone) for r in done)
    assert {line for t in texts for line in t.split("\n")} - {line for t in got.values() for line in t.split("\n")} <= {""}


def test_spans_with_one_key_and_different_texts_stay(spark, monkeypatch):
    long = "\n".join(f"{i} a b c d e f g h i" for i in range(6))
    monkeypatch.setattr(linechunks, "_digest", lambda text: b"same")
    got = linechunks.dedup_passages(docs(spark, [long, long])).collect()
    assert [(r["text"], r["removed_lines"]) for r in got] == [(long, 0)] * 2


def test_edges(spark):
    long = "\n".join(f"{i} a b c d e f g h i" for i in range(6))
    table = docs(spark, [long, long, long, None, "", "x\n" + long], [None, None, 3, None, 3, 4])
    got = sorted((r["row"]["doc_id"] or 0, r["text"], r["removed_lines"]) for r in linechunks.dedup_passages(
        table.where("text IS NOT NULL")).collect())
    assert got == [(0, "", 6), (0, "", 6), (3, "", 0), (3, long, 0), (4, "x", 6)]
    assert linechunks.dedup_passages(table).where("text IS NULL AND removed_lines = 0").count() == 1
    assert linechunks.dedup_passages(docs(spark, [])).count() == 0
