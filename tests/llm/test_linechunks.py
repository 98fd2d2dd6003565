import random
from collections import Counter

from orebed.llm import linechunks

from .helpers import docs, prose


def brute(rows):
    """[(id, text without repeated chunks)] by comparing the chunks of all documents."""
    first, pieces = {}, []
    rows = list(dict.fromkeys(rows))
    for d, t in rows:
        for start, n, eligible in linechunks.chunks(t) if t is not None else []:
            text = "\n".join(t.split("\n")[start : start + n])
            pieces.append((d, t, start, n, text, eligible))
    for p in sorted((p for p in pieces if p[5]), key=lambda p: (p[0] is None, p[0] or 0, p[2])):
        first.setdefault(p[4], p[:3])
    out = {}
    for d, t in rows:
        keep = [p[4] for p in pieces if p[:2] == (d, t) and (not p[5] or first[p[4]] == p[:3])]
        out[d, t] = None if t is None else "\n".join(keep)
    return out


def test_matches_brute_force(spark):
    rng = random.Random(2)
    passages = [prose(rng, 80, breaks=0.15) for _ in range(4)] + [prose(rng, 55, breaks=0)]
    texts = [None, "", "\n\n\n", "one line"]
    for _ in range(40):
        body = prose(rng, rng.randrange(10, 80), vocabulary=5000, breaks=0.2)
        texts.append("\n".join([body, rng.choice(passages), prose(rng, 10, vocabulary=5000, breaks=0.2)]))
    texts += texts[10:13]
    rows = list(enumerate(texts)) + [(20, texts[20]), (20, texts[20])]
    table = docs(spark, [t for _, t in rows], [d for d, _ in rows]).selectExpr("*", "1 AS start", "2 AS chunk", "3 AS row")
    got = linechunks.dedup_lines(table).select("row.doc_id", "row.text", "text", "removed_chunks").collect()
    want = brute(rows)
    assert len(got) == len(rows) and all(r[2] == want[r[0], r[1]] for r in got)
    assert sum(r[3] for r in got) > 40


def test_passages_shift_without_harm():
    rng = random.Random(5)
    passage = [prose(rng, 6, breaks=0) for _ in range(30)]
    cut = lambda lines: {tuple(lines[a : a + n]) for a, n, e in linechunks.chunks("\n".join(lines)) if e}
    whole = cut(passage)
    for shift in range(1, 6):
        moved = cut([f"other {i} line" for i in range(shift)] + passage)
        assert len(whole - moved) <= 1


def test_long_lines_are_chunks_and_emptied_documents_go(spark):
    rng = random.Random(6)
    long_line = prose(rng, 60, breaks=0)
    table = docs(spark, [f"first words\n{long_line}\nlast words", long_line, "short\nunique"])
    kept = {r["doc_id"]: r for r in linechunks.keep_lines(table).collect()}
    assert set(kept) == {0, 2} and kept[0]["text"].count(long_line) == 1
    assert linechunks.keep_lines(table).columns == table.columns


def test_edges(spark):
    same = "a b c d\ne f g h\ni j k l\nm n o p\nq r s t\nu v w x"
    table = docs(spark, [same, same, same, None, ""], [None, None, 3, None, 3])
    got = Counter((r["row"]["doc_id"], r["text"]) for r in linechunks.dedup_lines(table).collect())
    assert got[3, same] == 1 and got[None, same] == 0 and got[None, None] == 1 and got[3, ""] == 1
    assert linechunks.dedup_lines(docs(spark, [])).count() == 0 and linechunks.keep_lines(docs(spark, [])).count() == 0
