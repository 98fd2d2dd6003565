"""Exact order statistics and global ranks that never gather a column in one task.

Spark's exact ``percentile`` keeps every distinct value of a column in one
buffer. It is used here only after the row count is known to be small; beyond
that, mergeable quantile sketches bracket each wanted rank, one counting pass
checks the bracket, and only the few values left inside it are listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.session import cut_lineage

SMALL_ROWS = 2_000_000     # rows for which the built-in exact percentile is used
BUFFERED_VALUES = 4_000_000  # values that its buffers may hold in one pass, over all columns
BRACKET_VALUES = 2_000     # distinct-value bound of a listed bracket
SKETCH_ACCURACY = 10_000
AGGREGATES_PER_PASS = 200  # keeps generated code below the method limits
MAX_PASSES = 40


def chunks(items: Sequence, size: int = AGGREGATES_PER_PASS):
    for i in range(0, len(items), size):
        yield items[i : i + size]


def aggregate_row(df: DataFrame, exprs: Sequence, width: int = AGGREGATES_PER_PASS) -> list:
    """Values of many aggregates, evaluated in passes of bounded width."""
    out = []
    for part in chunks(list(exprs), width):
        out.extend(df.agg(*[e.alias(f"a{i}") for i, e in enumerate(part)]).first())
    return out


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], small_rows: int = SMALL_ROWS
) -> dict[str, list]:
    """Linear-interpolated quantiles of each column, nulls ignored."""
    cols = list(cols)
    if not cols:
        return {}
    counts = dict(zip(cols, aggregate_row(df, [F.count(c) for c in cols])))
    most = max(counts.values())
    if most <= small_rows:
        probs_lit = F.array(*[F.lit(float(p)) for p in probs])
        width = max(1, min(AGGREGATES_PER_PASS, BUFFERED_VALUES // max(most, 1)))
        rows = aggregate_row(df, [F.percentile(F.col(c).cast("double"), probs_lit) for c in cols], width)
        return {c: list(v) if v is not None else [None] * len(probs) for c, v in zip(cols, rows)}
    wanted = {}
    for c in cols:
        for p in probs:
            pos = p * (counts[c] - 1)
            if counts[c]:
                wanted.setdefault(c, set()).update((math.floor(pos), math.ceil(pos)))
    found = order_statistics(df, {c: sorted(r) for c, r in wanted.items()}, counts)
    result = {}
    for c in cols:
        values = []
        for p in probs:
            if not counts[c]:
                values.append(None)
                continue
            pos = p * (counts[c] - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            a, b = found[c, lo], found[c, hi]
            values.append(a if lo == hi else (hi - pos) * a + (pos - lo) * b)
        result[c] = values
    return result


def exact_quantile(df: DataFrame, col: str, prob: float) -> float | None:
    return exact_quantiles(df, [col], [prob])[col][0]


@dataclass
class _Bracket:
    col: str
    rank: int
    lo: float
    hi: float
    below: int
    inside: int
    light: int
    value: float | None = None


def order_statistics(
    df: DataFrame, ranks: dict[str, Sequence[int]], counts: dict[str, int] | None = None
) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ascending ranks of numeric columns."""
    cols = list(ranks)
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    stats = aggregate_row(
        df, [e for c in cols for e in (F.count(c), F.min(c), F.max(c))]
    )
    brackets = []
    for i, c in enumerate(cols):
        n, lo, hi = stats[3 * i : 3 * i + 3]
        for r in ranks[c]:
            if not 0 <= r < n:
                raise ValueError(f"rank {r} outside column {c} of {n} values")
            brackets.append(_Bracket(c, r, lo, hi, 0, n, n))
    for _ in range(MAX_PASSES):
        for b in brackets:
            if b.value is None and b.lo == b.hi:
                b.value = b.lo
        open_ = [b for b in brackets if b.value is None]
        if not open_:
            return {(b.col, b.rank): b.value for b in brackets}
        _list_brackets(df, [b for b in open_ if b.light <= BRACKET_VALUES])
        _narrow(df, [b for b in open_ if b.light > BRACKET_VALUES])
    raise RuntimeError("order statistics did not converge")


def _sorted_columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Values of each column, nulls left out; NaN sorts last, as in Spark."""
    return [c.drop_null().to_numpy(zero_copy_only=False) + 0.0 for c in batch.columns]


def _inside(values: np.ndarray, lo: float, hi: float) -> np.ndarray:
    low = np.isnan(values) | (values >= lo) if lo == lo else np.isnan(values)
    return low & (values <= hi) if hi == hi else low


def _list_brackets(df: DataFrame, ready: list[_Bracket]) -> None:
    """Read off ranks from the distinct values of brackets that are small; tasks send on these only."""
    if not ready:
        return
    by_column: dict[int, list[_Bracket]] = {}
    for b in ready:
        by_column.setdefault(df.columns.index(b.col), []).append(b)
    spans = {i: [(b.lo, b.hi) for b in held] for i, held in by_column.items()}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _sorted_columns(batch)
            for i, wanted in spans.items():
                held = np.zeros(len(columns[i]), bool)
                for lo, hi in wanted:
                    held |= _inside(columns[i], lo, hi)
                v, n = np.unique(columns[i][held], return_counts=True)
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, "int32")), pa.array(v), pa.array(n)], ["c", "v", "n"])

    rows = df.mapInArrow(fold, "c int, v double, n long").groupBy("c", "v").agg(F.sum("n").alias("n")).orderBy("c", "v").collect()
    values: dict[int, list[tuple[float, int]]] = {}
    for c, v, n in rows:
        values.setdefault(c, []).append((v, n))
    for i, held in by_column.items():
        v, n = (np.array(x) for x in zip(*values[i]))
        for b in held:
            own = _inside(v, b.lo, b.hi)
            at = int(np.searchsorted(np.cumsum(n[own]) + b.below, b.rank, "right"))
            b.value = float(v[own][at])


def _counts_at(df: DataFrame, cuts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Rows of each column in 2 k + 1 slots around its k sorted cuts: slot 2 i lies below cut i, slot 2 i + 1 on it."""
    wanted = {df.columns.index(c): at for c, at in cuts.items()}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {i: np.zeros(2 * len(at) + 1, "int64") for i, at in wanted.items()}
        for batch in batches:
            columns = _sorted_columns(batch)
            for i, at in wanted.items():
                slot = np.searchsorted(at, columns[i], "left") + np.searchsorted(at, columns[i], "right")
                seen[i] += np.bincount(slot, minlength=len(seen[i]))
        for i, n in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), i, "int32")), pa.array(np.arange(len(n), dtype="int32")), pa.array(n)], ["c", "slot", "n"])

    out = {c: np.zeros(2 * len(at) + 1, "int64") for c, at in cuts.items()}
    for c, slot, n in df.mapInArrow(fold, "c int, slot int, n long").groupBy("c", "slot").agg(F.sum("n")).collect():
        out[df.columns[c]][slot] = n
    return out


def _narrow(df: DataFrame, wide: list[_Bracket]) -> None:
    """One sketch pass and one counting pass over all wide brackets."""
    if not wide:
        return
    slack = 2.0 / SKETCH_ACCURACY
    ranges: dict[tuple, list[int]] = {}  # brackets over the same values share one sketch
    for i, b in enumerate(wide):
        ranges.setdefault((b.col, b.lo, b.hi), []).append(i)
    exprs = []
    for (c, lo, hi), members in ranges.items():
        probs = []
        for b in (wide[i] for i in members):
            probs += [max(0.0, (b.rank - b.below) / b.inside - slack),
                      min(1.0, (b.rank - b.below + 1) / b.inside + slack)]
        exprs.append(F.percentile_approx(F.when(F.col(c).between(lo, hi), F.col(c)), probs, SKETCH_ACCURACY))
    sketches: list = [None] * len(wide)
    for members, ends in zip(ranges.values(), aggregate_row(df, exprs)):
        for k, i in enumerate(members):
            sketches[i] = ends[2 * k : 2 * k + 2]
    cuts: dict[str, set[float]] = {}
    for b, ends in zip(wide, sketches):
        cuts.setdefault(b.col, set()).update(ends)
    places = {c: np.unique(np.array(list(ends), float) + 0.0) for c, ends in cuts.items()}
    upto = {c: np.concatenate([[0], np.cumsum(n)]) for c, n in _counts_at(df, places).items()}
    for b, (lo, hi) in zip(wide, sketches):
        first, last = (2 * int(np.searchsorted(places[b.col], x)) + 1 for x in (lo, hi))
        run = upto[b.col]
        below, inside = int(run[first]), int(run[last + 1] - run[first])
        light = max(0, int(run[last] - run[first + 1]))
        if below <= b.rank < below + inside:
            b.lo, b.hi, b.below, b.inside, b.light = lo, hi, below, inside, light
        elif b.rank < below:
            b.hi, b.inside = lo, below - b.below + 1
        else:
            b.lo, b.below = hi, below + inside - 1


def ranked_values(df: DataFrame, value: str, weight: str | None = None, descending: bool = False) -> DataFrame:
    """Distinct values in global order with their running row count.

    Columns: ``value``, ``n`` (rows holding it), ``upto`` (rows up to and with
    it in the order), ``dense`` (1-based rank among distinct values) and
    ``next_value``. Equal values are merged before any sort, so a value held by
    a third of all rows is one row here, and the sort is split by value range.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    distinct = (
        df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value"))
        .agg(n.cast("bigint").alias("n"))
    )
    order = F.col("value").desc() if descending else F.col("value").asc()
    parts = cut_lineage(
        distinct.repartitionByRange(order).withColumn("part", F.spark_partition_id())
    )
    first, last = (F.max, F.min) if descending else (F.min, F.max)
    heads = sorted(
        parts.groupBy("part").agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"),
            first("value").alias("first"), last("value").alias("last"),
        ).collect(),
        key=lambda r: r["part"],
    )
    rows, seen, dense = [], 0, 0
    for i, h in enumerate(heads):
        following = heads[i + 1]["first"] if i + 1 < len(heads) else None
        rows.append((h["part"], seen, dense, following))
        seen, dense = seen + h["n"], dense + h["d"]
    vtype = distinct.schema["value"].dataType.simpleString()
    offsets = df.sparkSession.createDataFrame(
        rows, f"part int, seen bigint, ahead bigint, following {vtype}"
    )
    w = Window.partitionBy("part").orderBy(order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return (
        parts.join(F.broadcast(offsets), "part")  # one row per range partition
        .select(
            "value", "n",
            (F.sum("n").over(running) + F.col("seen")).alias("upto"),
            (F.row_number().over(w) + F.col("ahead")).cast("bigint").alias("dense"),
            F.coalesce(F.lead("value").over(w), F.col("following")).alias("next_value"),
        )
    )
