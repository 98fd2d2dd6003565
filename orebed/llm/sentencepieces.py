"""SentencePiece encoding and decoding by a streaming Viterbi search.

Encoding takes the segmentation of a text into pieces of the model with the
largest sum of scores. The search keeps the best scores of the last ``longest``
positions only, because no piece reaches further back. Whenever all paths that
are still alive there run through one boundary, everything before it is decided
and its ids are committed, so memory does not grow with the text. Characters
without a piece become the ids of their bytes where the model has these, else
the unknown id.

Where no piece of the model holds a word mark behind another character, every
place before a word mark is such a boundary by construction; the stretches
between are searched once per worker and remembered. Where no piece joins
letters, signs and line breaks, the places between these are boundaries too, and
a new stretch is put together from its runs. New runs are searched together,
position by position, with the same scores and the same choice among equals.

Defined results: null and empty texts have no ids; a word mark that stands in
the text itself decodes to a space, as in the library; null ids decode to an
empty text; repeated rows and null document ids are carried through; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orebed.llm.common import LETTERS, RUNS, SIGNS

MARK = "▁"  # the library's sign for a space
UNKNOWN_PENALTY = 10.0
#: Stretches whose ids a worker remembers; beyond that it keeps those met again.
REMEMBERED = 350_000
_NEVER = float("-inf")
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_JOINED = re.compile(f"[{LETTERS}][{SIGNS}\n]|[{SIGNS}]\n|\n[{LETTERS}]")  # places between the runs of a stretch
#: Characters that are searched together, and the longest run among them.
TOGETHER, LONGEST_RUN = 65_536, 64


def _stretches(text: str) -> list[str]:
    """Stretches of ``text``, each without the word mark it begins with."""
    if text[0] == " " or "  " in text or MARK in text:
        return [x[1:] for x in _STRETCH.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


class PieceModel:
    """Pieces and scores of a model file, with streaming encoding and decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        self.unknown = model.unk_id()
        self.byte_ids = {int(pieces[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.pieces = {pieces[i]: (i, model.get_score(i)) for i in range(size) if i not in special}
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown_score = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.surface = [b"" if i in special else pieces[i].replace(MARK, " ").encode() for i in range(size)]
        for value, i in self.byte_ids.items():
            self.surface[i] = bytes([value])
        self.surface[self.unknown] = " ⁇ ".encode()  # as the library shows it
        self.shown = np.frombuffer(b"".join(self.surface), "uint8")
        self.shown_size = np.array([len(x) for x in self.surface], "int64")
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.cuts = not any(_JOINED.search(p) for p in self.pieces)
        self.memo: dict[str, bytes] = {}
        self.again: set[str] = set()
        self.runs: dict[str, bytes] = {}  # runs met without a word mark before them

    @cached_property
    def tree(self) -> dict[str, tuple]:
        """Pieces by their characters: each leads to the score of the piece that ends there, if any, and to longer ones."""
        tree: dict = {}
        gains = {piece: gain for piece, (_, gain) in self.pieces.items()}
        leaf: dict = {}
        branches = {"": tree}
        for piece in sorted(self.pieces, key=len, reverse=True):  # the longest first, so that inner nodes are known
            for size in range(len(piece) - 1, 0, -1):
                if piece[:size] in branches:
                    break
                branches[piece[:size]] = {}
        for prefix in sorted(branches.keys() | gains.keys(), key=len, reverse=True):
            if prefix:
                step = (gains.get(prefix), branches.get(prefix, leaf))
                branches[prefix[:-1]][prefix[-1]] = step
        for char, (gain, branch) in tree.items():  # one character can always be taken
            tree[char] = (self.unknown_score if gain is None else gain, branch)
        return tree

    def _ids(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found is not None:
            return [found[0]]
        data = piece.encode()
        return [self.byte_ids[b] for b in data] if all(b in self.byte_ids for b in data) else [self.unknown]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of ``text``, committed stretch by stretch."""
        n, tree, longest, alone = len(text), self.tree, self.longest, (self.unknown_score, None)
        score = {0: 0.0}  # of the best path to each boundary in the window
        best = score.get
        back: dict[int, int] = {}  # start of that path's last piece, for boundaries not committed
        done, check = 0, longest
        at = 0
        while at < n:
            here = score.pop(at)
            gain, branch = tree.get(text[at], alone)
            end = at + 1
            if here + gain > best(end, _NEVER):
                score[end], back[end] = here + gain, at
            if branch:
                for char in text[end : at + longest]:
                    step = branch.get(char)
                    if step is None:
                        break
                    end += 1
                    gain, branch = step
                    if gain is not None and here + gain > best(end, _NEVER):
                        score[end], back[end] = here + gain, at
            at += 1
            if at >= check:
                boundary = self._converged(score, back, done)
                if boundary > done:
                    yield self._walk(text, back, done, boundary)
                    done = boundary
                    for b in [b for b in back if b <= done]:
                        del back[b]
                check = at + longest
        if n > done:
            yield self._walk(text, back, done, n)

    @staticmethod
    def _converged(score: dict[int, float], back: dict[int, int], done: int) -> int:
        """The last boundary that all paths to the window's boundaries run through."""
        alive = sorted(score)
        while len(alive) > 1:
            last = alive.pop()
            start = back.get(last, done)
            if start not in alive:
                alive.append(start)
                alive.sort()
        return max(alive[0], done)

    def _walk(self, text: str, back: dict[int, int], start: int, end: int) -> list[int]:
        spans = []
        while end > start:
            spans.append(text[back[end] : end])
            end = back[end]
        out, pieces = [], self.pieces
        for piece in reversed(spans):
            found = pieces.get(piece)
            if found is None:
                out += self._ids(piece)
            else:
                out.append(found[0])
        return out

    def _search(self, stretch: str) -> bytes:
        ids = [i for part in self.stream(stretch) for i in part]
        return struct.pack(f"<{len(ids)}I", *ids)

    @cached_property
    def steps(self) -> tuple[np.ndarray, ...]:
        """The tree as arrays: the number of each character, sorted (node, character) keys and the nodes they lead to, and of each node its piece or -1 and its score."""
        numbers = np.zeros(0x110000, "uint16")
        chars = sorted(set().union(*self.pieces))
        numbers[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        prefixes = sorted({p[:k] for p in self.pieces for k in range(1, len(p) + 1)}, key=len)
        at = {"": 0} | {p: k for k, p in enumerate(prefixes, 1)}
        keys = np.array([at[p[:-1]] * (len(chars) + 1) + int(numbers[ord(p[-1])]) for p in prefixes], "int64")
        ends = [self.pieces.get(p, (-1, _NEVER)) for p in ["", *prefixes]]
        order = np.argsort(keys)
        return (numbers, keys[order], order + 1, np.array([i for i, _ in ends], "int64"), np.array([s for _, s in ends]))

    def _search_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each of many short texts; longer ones, and those with characters without a piece, are searched alone."""
        out: list[bytes] = [b""] * len(texts)
        order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
        low = 0
        while low < len(order):
            longest = len(texts[order[low]])
            if longest > LONGEST_RUN:
                break
            high = low + max(1, TOGETHER // max(longest, 1))
            some = order[low:high]
            longest = len(texts[some[-1]])
            if longest > LONGEST_RUN:
                some = [k for k in some if len(texts[k]) <= LONGEST_RUN]
                longest = len(texts[some[-1]])
            for k, ids in zip(some, self._search_block([texts[k] for k in some], longest), strict=True):
                out[k] = self._search(texts[k]) if ids is None else ids
            low += len(some)
        for k in order[low:]:
            out[k] = self._search(texts[k])
        return out

    def _search_block(self, texts: list[str], n: int) -> list[bytes | None]:
        """Ids of texts of up to ``n`` characters, None for those with a character without a piece."""
        if not n:
            return [b""] * len(texts)
        numbers, keys, nodes, piece_of, score_of = self.steps
        points = np.frombuffer("".join([t.ljust(n, "\0") for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4")
        chars = numbers[points.reshape(-1, n).T].astype("int64")  # one row per place, one column per text
        sizes = np.fromiter(map(len, texts), "int64", len(texts))
        inside = np.arange(n)[:, None] < sizes
        chars[~inside] = 0
        width, base = len(texts), int(numbers.max()) + 1
        flat = chars.ravel()
        at, node = np.flatnonzero(flat), np.zeros(np.count_nonzero(flat), "int64")
        gains, pieces = [], []
        for depth in range(min(self.longest, n)):  # all pieces that begin at each place, one character longer each time
            key = node * base + flat[at + depth * width]
            found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[found] == key
            at, node = at[hit], nodes[found[hit]]
            if not len(at):
                break
            gain, piece = np.full(n * width, _NEVER), np.full(n * width, -1, "int32")
            gain[at], piece[at] = score_of[node], piece_of[node]
            gains.append(gain.reshape(n, width))
            pieces.append(piece.reshape(n, width))
            going = at < (n - depth - 1) * width
            at, node = at[going], node[going]
        if not gains:
            return [None if t else b"" for t in texts]
        alone = ((pieces[0] >= 0) | ~inside).all(axis=0)
        score, back = np.full((n + 1, width), _NEVER), np.zeros((n + 1, width), "int64")
        score[0] = 0.0
        for place in range(n):
            for depth, gain in enumerate(gains[: n - place], 1):
                total = score[place] + gain[place]
                better = total > score[place + depth]
                np.copyto(score[place + depth], total, where=better)
                np.copyto(back[place + depth], depth, where=better)
        taken, end, texts_ = [], np.where(alone, sizes, 0), np.arange(width)
        deep = np.stack(pieces)
        while end.any():
            depth = back[end, texts_]
            start = end - depth
            taken.append(np.where(depth > 0, deep[depth - 1, np.minimum(start, n - 1), texts_], -1))
            end = start
        if not taken:
            return [b"" if ok else None for ok in alone]
        ids = np.stack(taken[::-1], axis=1)
        real = ids >= 0
        data, ends = ids[real].astype("<u4").tobytes(), (4 * np.cumsum(real.sum(axis=1))).tolist()
        return [data[a:b] if ok else None for a, b, ok in zip([0, *ends], ends, alone.tolist())]

    def _learn(self, stretches: set[str]) -> None:
        """Remember the ids of ``stretches``, each behind a word mark."""
        memo, runs = self.memo, self.runs
        if len(runs) > REMEMBERED or not runs:
            runs.clear()
            runs.update({"": b"", "\n": self._search("\n")})
        words, later, cut = set(), set(), []
        for stretch in stretches:
            found = RUNS.fullmatch(stretch) if self.cuts else None
            if found is None:
                words.add(stretch)
                continue
            word, signs, line, more = found.groups("")
            words.add(word)
            if signs or line:
                cut.append((stretch, word, signs, line, more))
                later.update((signs, line, more))
        words = list(words - memo.keys())
        memo.update(zip(words, self._search_all([MARK + x for x in words])))
        later = list(later - runs.keys())
        runs.update(zip(later, self._search_all(later)))
        for stretch, word, signs, line, more in cut:
            ids = memo[word] + runs[signs]
            memo[stretch] = b"".join((ids, runs["\n"], runs[line], runs[more])) if line else ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.splits:
            return [self._search(MARK + t.replace(" ", MARK)) if t else b"" for t in texts]
        parts = [_stretches(t) if t else [] for t in texts]
        if len(self.memo) > REMEMBERED:
            self.memo = {x: self.memo[x] for x in self.again} if 2 * len(self.again) < REMEMBERED else {}
            self.again = set()
        memo = self.memo
        seen = set().union(*parts)
        new = seen - memo.keys()
        seen -= new
        self.again |= seen
        self._learn(new)
        return [b"".join(map(memo.__getitem__, p)) for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.shown_size[ids]
        ends = np.cumsum(sizes)
        taken = np.repeat(self.shown_at[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.shown[taken].tobytes().decode("utf-8", "replace").removeprefix(" ")


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model of this worker process, kept between its tasks."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row; a narrow pass."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = piece_model(path)
        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.iloc[low : low + 512]
                found = [np.frombuffer(x, "<u4").astype("int32") for x in model.encode(list(part["text"]))]
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": found})

    return rows.mapInPandas(run, f"doc_id {kind}, ids array<int>")


def decoded(ids: Column, path: str) -> Column:
    """Text of an array of ids."""

    @F.pandas_udf(StringType())
    def run(found: pd.Series) -> pd.Series:
        model = piece_model(path)
        return found.map(lambda x: "" if x is None else model.decode(np.asarray(x, "int64"))).astype("object")

    return run(ids)
