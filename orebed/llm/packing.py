"""Best-fit packing of token pieces into fixed-length sequences.

A plan of which lengths share a sequence needs only how many pieces of each
length exist: at most ``capacity`` numbers, whatever the table holds. Pieces
above a third of the capacity share a sequence with at most one other such
piece and are paired greedily, the longest first with the longest that fits;
shorter ones then go, longest first, to the smallest gap that holds them.
The plan is worked out on runs of equal sequences, so its size depends on the
capacity and not on the data. Spark numbers the pieces of each length within
salted groups and joins them to the plan's slots.

Defined results: null and empty texts are the end id alone; repeated rows and
null ids are packed like any other row; an empty table gives no rows; pieces of
more than the capacity or of no length are refused.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orebed.llm.common import LETTERS, RUNS, SIGNS, cut, keyed

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id {id}, piece int, start long, length long, ids binary"
#: Text units whose ids a worker remembers; beyond that it keeps those met again.
REMEMBERED = 250_000
#: Texts and characters encoded in one round.
ROUND_ROWS = 2048
ROUND_CHARS = 2_000_000
#: Pieces that one numbering group holds on average.
GROUP_ROWS = 20_000
_PART_OF_RUNS = re.compile(f"[{LETTERS}]*[{SIGNS}]*(?:\n[{LETTERS}]*[{SIGNS}]*)?")


class UnitEncoder:
    """Ids of whole texts, looked up by space-separated unit.

    The byte-level pre-tokenizer never joins what lies before a single space
    with what lies after it, so the ids of a text are those of its units, each
    with its leading space. Texts with wider gaps are encoded as one. Units not
    seen before are encoded as one joined text; its ids are dealt back by the
    bytes that each id stands for. Units of words, signs and a line break are
    known to be cut there, so each of their runs is encoded once, by the same
    model without the search for cuts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, "int64")
        for token, at in vocabulary.items():  # one character stands for one byte, but in added tokens
            self.bytes_of[at] = len(token.encode()) if token in special else len(token)
        self.cuts = not any(_PART_OF_RUNS.fullmatch(x) for x in special)  # no added token lies in such a unit
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = str.maketrans({c: shown(c)[0][0] for c in map(chr, range(32, 384))})  # the model's signs for bytes
        self.runs_tokenizer = Tokenizer(self.tokenizer.model)
        self.runs_tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.memo: dict[str, bytes] = {}
        self.again: set[str] = set()  # units met in more than one batch
        self.runs: dict[str, bytes] = {}  # runs met without a space before them

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _dealt(self, parts: list[str], before: str) -> Iterator[tuple[str, bytes]]:
        """Each unit or run with its ids behind ``before``, from one joined text."""
        for low in range(0, len(parts), 512):
            some = parts[low : low + 512]
            yield from self._cut(self._encode([before + before.join(some)])[0], some, len(before))

    def _dealt_runs(self, runs: list[str], before: str) -> Iterator[tuple[str, bytes]]:
        for low in range(0, len(runs), 512):
            some = runs[low : low + 512]
            joined = "\n".join([before + x for x in some]).translate(self.shown)
            found = self.runs_tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            yield from self._cut(np.array(found, "<u4").tobytes(), some, len(before))

    def _cut(self, ids: bytes, parts: list[str], before: int) -> Iterator[tuple[str, bytes]]:
        reached = np.cumsum(self.bytes_of[np.frombuffer(ids, "<u4")])
        ends = np.searchsorted(reached, np.cumsum([before + len(x.encode()) for x in parts])) + 1
        at = 0
        for part, end in zip(parts, (4 * ends).tolist(), strict=True):
            yield part, ids[at:end]
            at = end

    def _learn(self, units: list[str]) -> None:
        """Remember the ids of ``units``, each behind a space."""
        memo, runs = self.memo, self.runs
        if len(runs) > REMEMBERED or not runs:
            runs.clear()
            runs.update({"": b"", "\n": self._encode(["\n"])[0]})
        rest, words, later, cut = [], set(), set(), []
        for unit in units:
            found = RUNS.fullmatch(unit) if self.cuts else None
            if found is None:
                rest.append(unit)
                continue
            word, signs, line, more = found.groups("")
            words.add(word)
            if signs or line:
                cut.append((unit, word, signs, line, more))
                later.update((signs, line, more))
        memo.update(self._dealt(rest, " "))
        memo.update(self._dealt_runs(list(words - memo.keys()), " "))
        runs.update(self._dealt_runs(list(later - runs.keys()), ""))
        for unit, word, signs, line, more in cut:
            ids = memo[word] + runs[signs]
            memo[unit] = b"".join((ids, runs["\n"], runs[line], runs[more])) if line else ids

    def _known(self, units: list[str]) -> tuple[list[bytes], list[int]]:
        """The ids of different units, and the places of those that belong to wider gaps and are not looked up."""
        if len(self.memo) > REMEMBERED:
            self.memo = {x: self.memo[x] for x in self.again} if 2 * len(self.again) < REMEMBERED else {}
            self.again = set()
        memo = self.memo
        found = list(map(memo.get, units))
        new = [k for k, ids in enumerate(found) if ids is None]
        self.again.update(units)
        self.again.difference_update([units[k] for k in new])
        wide = [k for k in new if not (x := units[k]) or x[0].isspace() or x[-1].isspace()]
        if wide:
            new = sorted(set(new).difference(wide))
        self._learn([units[k] for k in new])
        for k in new:
            found[k] = memo[units[k]]
        for k in wide:
            found[k] = b""
        return found, wide

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind each other, and the number of each text's ids."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, "int64")
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = split.offsets.to_numpy()[:-1]
        coded = split.values.dictionary_encode()
        at = coded.indices.to_numpy().astype("int64")
        later = np.ones(len(at), bool)
        later[starts] = False
        asked = np.flatnonzero(np.bincount(at[later], minlength=len(coded.dictionary)))
        place = np.zeros(len(coded.dictionary), "int64")
        place[asked] = np.arange(len(asked))
        found, wide = self._known(coded.dictionary.take(pa.array(asked)).to_numpy(zero_copy_only=False).tolist())
        at = place[at]
        gaps = np.zeros(len(found) + 1, bool)
        gaps[wide] = True
        whole = np.logical_or.reduceat(gaps[at] & later, starts)
        several = np.diff(np.append(starts, len(at))) > 1
        first = []
        for k, text in enumerate(texts):
            start = text.split(" ", 1)[0]
            if several[k] and (whole[k] or not start or start[-1].isspace()):
                whole[k], start = True, text
            first.append(start)
        at[starts] = len(found) + np.arange(len(texts))
        found += self._encode(first)
        sizes = np.fromiter(map(len, found), "int64", len(found)) // 4
        before = np.cumsum(sizes) - sizes
        size = sizes[at]
        if whole.any():
            size[np.repeat(whole, np.diff(np.append(starts, len(at)))) & later] = 0
        ends = np.cumsum(size)
        taken = np.arange(ends[-1]) + np.repeat(before[at] - ends + size, size)
        return np.frombuffer(b"".join(found), "<u4")[taken], np.add.reduceat(size, starts)

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, sizes = self.flat(texts)
        ends = (4 * np.cumsum(sizes)).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The encoder of this worker process, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def encoding_rounds(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows encoded together: units shared by many texts are looked up once, while long texts stay few."""
    low, held = 0, 0
    for k, text in enumerate(batch["text"]):
        size = len(text or "")
        if k > low and (held + size > ROUND_CHARS or k - low == ROUND_ROWS):
            yield batch.iloc[low:k]
            low, held = k, 0
        held += size
    if low < len(batch):
        yield batch.iloc[low:]


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids): a document's ids and the end id, cut at the capacity.

    ``ids`` are little-endian unsigned 32-bit integers. The first piece holds
    what is left over, all later ones are full.
    """
    rows = keyed(docs, id_col, text_col)
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for low in range(0, batch.num_rows, ROUND_ROWS):
                some = batch.slice(low, ROUND_ROWS)
                docs_, at = some.column("doc_id"), 0
                for part in encoding_rounds(pd.DataFrame({"text": some.column("text").to_numpy(zero_copy_only=False)})):
                    ids, sizes = encode.flat([t or "" for t in part["text"]])
                    yield _pieces(docs_.slice(at, len(part)), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1, capacity)
                    at += len(part)

    return rows.mapInArrow(run, schema)


def _pieces(docs: pa.Array, ids: np.ndarray, sizes: np.ndarray, capacity: int) -> pa.RecordBatch:
    """The pieces of documents of ``sizes`` ids each; every document has at least one."""
    number = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), number)
    piece = np.arange(len(doc)) - (np.cumsum(number) - number)[doc]
    first = (sizes - 1) % capacity + 1
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
    length = np.where(piece == 0, first[doc], capacity)
    data = ids.astype("<u4").tobytes()
    ends = (4 * np.cumsum(length)).tolist()
    return pa.RecordBatch.from_arrays(
        [docs.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
         pa.array([data[a:b] for a, b in zip([0, *ends], ends)], pa.binary())],
        ["doc_id", "piece", "start", "length", "ids"])


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, rank_from, n, sequence, offset) runs that place every piece once.

    The n pieces of a run, numbered from rank_from among those of their length,
    go to the sequences numbered from ``sequence``, one in each, all at ``offset``.
    """
    if any(not 0 < size <= capacity for size in counts):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    left = {size: n for size, n in counts.items() if n > 0}
    rank = dict.fromkeys(left, 0)
    slots: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of (first sequence, sequences)
    sizes: list[int] = []  # the gaps there are, sorted
    opened = 0

    def put(size: int, n: int, sequence: int, offset: int) -> None:
        slots.append((size, rank[size], n, sequence, offset))
        rank[size] += n
        left[size] -= n

    def open_gap(gap: int, sequence: int, n: int) -> None:
        if gap <= 0 or not n:
            return
        if gap not in gaps:
            gaps[gap] = []
            insort(sizes, gap)
        gaps[gap].append((sequence, n))

    def close_gap(gap: int) -> None:
        del gaps[gap]
        sizes.remove(gap)

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    waiting = sorted(large)  # ascending, still unpaired
    for size in large:
        while left[size]:
            mate_at = bisect_left(waiting, capacity - size + 1) - 1
            mate = waiting[mate_at] if mate_at >= 0 else 0
            while mate and not left[mate]:
                waiting.pop(mate_at)
                mate_at = bisect_left(waiting, capacity - size + 1) - 1
                mate = waiting[mate_at] if mate_at >= 0 else 0
            pairs = min(left[size], left[mate]) if mate and mate != size else left[size] // 2 if mate else 0
            if pairs:
                put(size, pairs, opened, 0)
                put(mate, pairs, opened, size)
                open_gap(capacity - size - mate, opened, pairs)
                opened += pairs
            else:
                if mate == size:  # one piece of this length is left: pair it with the next shorter one
                    shorter = [m for m in waiting[:mate_at] if left[m]]
                    if shorter:
                        put(size, 1, opened, 0)
                        put(shorter[-1], 1, opened, size)
                        open_gap(capacity - size - shorter[-1], opened, 1)
                        opened += 1
                        continue
                n = left[size]
                put(size, n, opened, 0)
                open_gap(capacity - size, opened, n)
                opened += n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(sizes, size)
            if at == len(sizes):
                each = capacity // size
                full, rest = divmod(left[size], each)
                for used, n in ((each, full), (rest, 1)):
                    if used and n:
                        for k in range(used):
                            put(size, n, opened, k * size)
                        open_gap(capacity - used * size, opened, n)
                        opened += n
                continue
            gap = sizes[at]
            runs = gaps[gap]
            sequence, n = runs.pop()
            used = min(n, left[size])
            if used < n:
                runs.append((sequence + used, n - used))
            elif not runs:
                close_gap(gap)
            put(size, used, sequence, capacity - gap)
            open_gap(gap - size, sequence, used)
    return slots


def numbered(pieces: DataFrame, groups: int) -> DataFrame:
    """``pieces`` with ``rank_``: 0, 1, ... among the rows of each length.

    Rows are numbered within (length, group) and shifted by the rows of the
    length's earlier groups, so that no length is gathered in one task.
    """
    order = [c for c in ("doc_id", "piece", "start") if c in pieces.columns]
    grouped = pieces.withColumn("group_", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = grouped.groupBy("length", "group_").agg(F.count("*").alias("n_"))
    before = Window.partitionBy("length").orderBy("group_").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "group_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("shift_"))
    inner = Window.partitionBy("length", "group_").orderBy(*order)
    return (
        grouped.withColumn("rank_", F.row_number().over(inner) - 1).join(shifts, ["length", "group_"])
        .withColumn("rank_", F.col("rank_") + F.col("shift_")).drop("group_", "shift_")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with doc_id, piece, length and any other columns) plus sequence_id and offset.

    Sequences are numbered from 0 and filled without gaps. The slots broadcast
    are at most a few per pair of lengths, independent of the number of pieces.
    """
    spark = pieces.sparkSession
    held = cut(pieces)
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan_slots(counts, capacity)
    steps = pd.DataFrame(slots, columns=["length", "from_", "n_", "sequence_", "offset"]).astype("int64")
    plan = spark.createDataFrame(steps, "length long, from_ long, n_ long, sequence_ long, offset long")
    ranked = numbered(held, max(1, -(-sum(counts.values()) // GROUP_ROWS)))
    placed = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & (F.col("rank_") >= F.col("from_")) & (F.col("rank_") < F.col("from_") + F.col("n_"))).drop(plan["length"])
    return placed.withColumn("sequence_id", F.col("sequence_") + F.col("rank_") - F.col("from_")).drop(
        "rank_", "from_", "n_", "sequence_")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids of each sequence, pieces joined by offset."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
