"""Benchmark decontamination through a generalised suffix automaton of the normalised test items.

Method: texts are normalised (only A-Z lower-cased) and cut into words, the maximal runs of
anything but ASCII punctuation, digits aside, and white space. All words of a block of test items
go into one generalised suffix automaton. Each document's words are streamed through it while the
longest matched length ``l`` is tracked: a missing transition follows suffix links. Where
``l >= window``, the last ``window`` words are a window of some item. The state holding that
length names the items that contain it, and those words are hit. Items of fewer words than
``window`` (but not none) count only whole; a match is found where such an item's end state lies
on the current suffix-link path within the matched length. Hit words are merged into spans.
``decontaminate`` removes spans of at least ``min_span`` words from the text, and drops documents
whose hit share exceeds ``max_coverage``.

Spark plan: items are dealt into blocks of at most ``BLOCK_WORDS`` words; the bound is checked,
and the block count doubled until it holds. One block's words are broadcast, and each Python
worker builds its automaton once. Documents stream through it in ``mapInPandas``: a task holds one
batch of documents and one automaton, and nothing else. With several blocks, the per-block results
of a document are merged by one aggregation over doc_id. Spans are merged with a SQL ``aggregate``
over the sorted spans.

Defined results:
- A null or empty text has no words: n_words 0, no hit, no items. A null or empty item has no
  window and matches nothing.
- Repeated items each count; equal windows of several items name all of them. Repeated documents
  are scanned independently. A very long text is streamed whole, one state at a time.
- Extra columns of the inputs are ignored: only the id and text columns are read and renamed.
- An empty document table gives an empty result; an empty item table marks nothing.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed: a word is a maximal run of bytes outside ASCII control, space, punctuation and symbols, digits kept
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
BLOCK_WORDS = 500_000

SCHEMA = "doc_id long, n_words long, n_hit long, items array<long>, spans array<struct<start:long,finish:long>>"


def words(text: str | None) -> list[bytes]:
    """Words of ``text`` after lower-casing A-Z only (bytes.lower touches ASCII alone)."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class Automaton:
    """Generalised suffix automaton of several word sequences, with window and whole-item marks."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, seq in items:
            self._add(seq)
        self.window_items: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for item_id, seq in items:
            state = 0
            for end, w in enumerate(seq):
                state = self.next[state][w]
                if end + 1 >= window:
                    self.window_items.setdefault(self._holding(state, window), set()).add(item_id)
            if 0 < len(seq) < window:
                self.whole.setdefault(state, []).append((len(seq), item_id))
        self._on_path: dict[int, tuple[tuple[int, int], ...]] = {}
        self._windows: dict[int, int] = {}

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, p: int, q: int, w: bytes) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _add(self, seq: list[bytes]) -> None:
        last = 0
        for w in seq:
            q = self.next[last].get(w)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
                continue
            cur = self._state(self.length[last] + 1, 0, {})
            p = last
            while p != -1 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p != -1:
                q = self.next[p][w]
                self.link[cur] = q if self.length[p] + 1 == self.length[q] else self._clone(p, q, w)
            last = cur

    def _holding(self, state: int, length: int) -> int:
        """The state on the suffix-link path whose strings include the one of ``length``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _wholes(self, state: int) -> tuple[tuple[int, int], ...]:
        """Whole short items that end in ``state`` or on its suffix-link path."""
        path = []
        while state > 0 and state not in self._on_path:
            path.append(state)
            state = self.link[state]
        found = self._on_path.get(state, ())
        for s in reversed(path):
            found = tuple(self.whole.get(s, ())) + found
            self._on_path[s] = found
        return found

    def _window_state(self, state: int) -> int:
        found = self._windows.get(state)
        if found is None:
            found = self._windows[state] = self._holding(state, self.window)
        return found

    def scan(self, seq: list[bytes]) -> tuple[int, list[tuple[int, int]], set[int]]:
        """(hit words, merged spans [start, end), items) of one document's words."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        shorts = bool(self.whole)
        spans: list[list[int]] = []
        items: set[int] = set()
        state = matched = 0
        for i, w in enumerate(seq):
            moves = nxt[state]
            while state and w not in moves:
                state = link[state]
                matched = length[state]
                moves = nxt[state]
            target = moves.get(w)
            if target is None:
                state = matched = 0
                continue
            state = target
            matched += 1
            if matched >= window:
                items |= self.window_items[self._window_state(state)]
                _mark(spans, i + 1 - window, i + 1)
            if shorts:
                for size, item in self._wholes(state):
                    if size <= matched:
                        items.add(item)
                        _mark(spans, i + 1 - size, i + 1)
        return sum(e - s for s, e in spans), [(s, e) for s, e in spans], items


def _mark(spans: list[list[int]], start: int, end: int) -> None:
    """Add [start, end) to spans sorted by end, merging overlapping and adjacent ones."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans[-1][0])
        end = max(end, spans.pop()[1])
    spans.append([start, end])


_BUILT: dict[int, Automaton] = {}


def _automaton(shared, token: str, window: int) -> Automaton:
    """One automaton per broadcast block and Python worker."""
    key = (token, window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(shared.value, window)
    return _BUILT[key]


def _scanner(shared, window: int):
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared, token, window)
        for batch in batches:
            rows = {"doc_id": [], "n_words": [], "n_hit": [], "items": [], "spans": []}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                seq = words(text if isinstance(text, str) else None)
                hit, spans, items = automaton.scan(seq)
                rows["doc_id"].append(doc_id)
                rows["n_words"].append(len(seq))
                rows["n_hit"].append(hit)
                rows["items"].append(sorted(items))
                rows["spans"].append([{"start": s, "finish": e} for s, e in spans])
            yield pd.DataFrame(rows)

    return run


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """Items with a block number such that no block holds more than ``BLOCK_WORDS`` words."""
    sized = items.withColumn("n", F.size(F.regexp_extract_all(
        F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))))
    total = sized.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, math.ceil(2 * total / BLOCK_WORDS))
    while True:
        dealt = sized.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
        largest = dealt.groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= BLOCK_WORDS or n_blocks >= max(1, total):
            return dealt, n_blocks
        n_blocks *= 2


_MERGED = """aggregate(array_sort(spans), named_struct('reach', -1L, 'n', 0L),
  (acc, x) -> named_struct('reach', greatest(acc.reach, x.finish),
                           'n', acc.n + greatest(0L, x.finish - greatest(x.start, acc.reach))),
  acc -> acc.n)"""


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every document; spans are word offsets [start, finish)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tests = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    dealt, n_blocks = _blocks(tests)
    found = []
    for block in range(n_blocks):
        part = [(r["item_id"], words(r["text"])) for r in dealt.where(F.col("block") == block).select(
            "item_id", "text").toLocalIterator()]
        shared = spark.sparkContext.broadcast(part)
        found.append(texts.mapInPandas(_scanner(shared, window), SCHEMA))
    if len(found) == 1:
        return found[0]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("doc_id").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    return merged.select("doc_id", "n_words", F.expr(_MERGED).alias("n_hit"), "items", "spans")


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, min_span: int = WINDOW,
                  max_coverage: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without their hit spans of ``min_span`` words or more; those hit beyond ``max_coverage`` go.

    Columns of ``docs`` stay; ``text`` is replaced, and ``removed_words`` is added.
    """
    found = contamination(docs, items, window=window, doc_id=doc_id, text=text).select(
        F.col("doc_id").alias("_d"), F.col("n_words").alias("_n"), F.col("n_hit").alias("_h"),
        F.filter("spans", lambda s: s["finish"] - s["start"] >= min_span).alias("_s"))
    joined = docs.join(found, F.col(doc_id).cast("long").eqNullSafe(F.col("_d")), "left")
    kept = joined.where(~(F.coalesce(F.col("_h"), F.lit(0)) > F.lit(max_coverage) * F.col("_n")))
    removed = F.coalesce(F.aggregate("_s", F.lit(0).cast("long"), lambda a, s: a + s["finish"] - s["start"]), F.lit(0).cast("long"))
    marked = kept.withColumn("removed_words", removed)
    has = F.coalesce(F.size("_s"), F.lit(0)) > 0
    cut = F.udf(_cut_spans, "string")
    return marked.where(~has).unionByName(
        marked.where(has).withColumn(text, cut(F.col(text), F.col("_s")))).drop("_d", "_n", "_h", "_s")


def _cut_spans(text: str | None, spans) -> str | None:
    """``text`` without the characters from the first to the last word of each span."""
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    places = [(m.start(), m.end()) for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for s in sorted(spans, key=lambda x: x["start"]):
        begin, finish = places[s["start"]][0], places[s["finish"] - 1][1]
        out.append(raw[at:begin])
        at = finish
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def item_digest(items: Column) -> Column:
    """Lowercase hex SHA-256 of the item ids sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ","), 256)
