"""Small tables and brute-force versions for the training-data operators."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, schema=SCHEMA):
    """A documents table; ids default to 0, 1, ..."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, schema)


def prose(rng, n, vocabulary=400, breaks=0.05):
    out = []
    for _ in range(n):
        out.append("w%d" % rng.randrange(vocabulary))
        out.append("\n" if rng.random() < breaks else " ")
    return "".join(out[:-1])


def family_texts(seed=5):
    """Unrelated texts, exact and near copies, chains of copies, short and blank texts."""
    rng = random.Random(seed)
    texts = [None, "", "  \n", "one", "One", "two words", "three short words", "a b c d", "A b C d"]
    for _ in range(12):
        base = prose(rng, rng.randrange(30, 200)).split(" ")
        texts.append(" ".join(base))
        chain = list(base)
        for _ in range(rng.randrange(0, 6)):
            chain = list(chain)
            chain[rng.randrange(len(chain))] = "x%d" % rng.randrange(9999)
            texts.append(" ".join(chain))
        for _ in range(rng.randrange(0, 4)):
            star = list(base)
            del star[rng.randrange(len(star))]
            texts.append(" ".join(star))
        texts.append(" ".join(base))
    return texts


def shingles(text, k):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def components(rows, k, percent=80):
    """{row index: (set size, smallest id reachable)} by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[root(i)].append(d)
    out = {}
    for i in range(len(rows)):
        ids = [d for d in groups[root(i)] if d is not None]
        out[i] = (len(sets[i]), min(ids) if ids else None)
    return out


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    covered = set()
    for i in range(n - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_stutter": sum(a == b for a, b in zip(words, words[1:])), "n_bangs": text.count("!!"),
    }
