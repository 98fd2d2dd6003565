"""Column expressions that stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_to_double(c: Column) -> Column:
    """``'13.56%'`` to 13.56; anything unreadable becomes null."""
    return F.trim(F.replace(c, F.lit("%"), F.lit(""))).try_cast("double")


def months_to_long(c: Column) -> Column:
    """``' 36 months'`` to 36; anything unreadable becomes null."""
    return F.trim(F.replace(c, F.lit("months"), F.lit(""))).try_cast("bigint")


def lookup(c: Column, mapping: Mapping) -> Column:
    """Value of ``c`` in a small constant mapping, null when absent."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(table, c)


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("tinyint")


def right_closed_bin(c: Column, edges: Sequence[float], labels: Sequence, lowest: bool = False) -> Column:
    """Label of the interval (lo, hi] holding ``c``; null outside all intervals.

    ``lowest`` also takes values equal to the first edge.
    """
    result = F.when(c.isNull(), F.lit(None))
    for i, label in enumerate(labels):
        lo, hi = float(edges[i]), float(edges[i + 1])
        above = (c >= lo) if lowest and i == 0 else (c > lo)
        result = result.when(above & (c <= hi), F.lit(label))
    return result


def merge_edges(edges: Sequence[float], labels: Sequence) -> tuple[list[float], list]:
    """Drop repeated edges; labels are then taken from the front."""
    kept = sorted(set(edges))
    return kept, list(labels)[: max(len(kept) - 1, 0)]


def clip(c: Column, lo: float | None, hi: float | None) -> Column:
    """Bound ``c``; null stays null."""
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(float(lo))).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(float(hi))).otherwise(out)
    return out


def zscore(c: Column, mean: float, std: float) -> Column:
    """(c - mean) / std, dividing by 1 when the column does not vary."""
    return (c - F.lit(float(mean))) / F.lit(float(std) if std and std > 0 else 1.0)


# Expressions of many terms are written as SQL text: one call builds the whole
# tree, where column operators would cross into the JVM once per term.


def number(x: float) -> str:
    """SQL double literal that keeps every digit."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def squared_distance_sql(a: Sequence[str], b: Sequence[str]) -> str:
    """Sum of squared differences of paired SQL terms."""
    return "(" + " + ".join(f"({x} - {y}) * ({x} - {y})" for x, y in zip(a, b)) + ")"


def linear_sql(terms: Sequence[str], weights: Sequence[float], offsets: Sequence[float]) -> str:
    """Weighted sum of terms after subtracting an offset from each."""
    return "(" + " + ".join(
        f"({t} - {number(o)}) * {number(w)}" for t, w, o in zip(terms, weights, offsets)
    ) + ")"


def sampling_hash(key: Column | Sequence[Column], seed: int) -> Column:
    """Seeded order of rows that depends on the row key only."""
    keys = list(key) if isinstance(key, (list, tuple)) else [key]
    return F.md5(F.concat_ws("_", *[k.cast("string") for k in keys], F.lit(str(seed))))


def digamma(c: Column) -> Column:
    """Digamma of x >= 1: asymptotic series after shifting x up by 8."""
    x = c.cast("double") + 8.0
    inv2 = 1.0 / (x * x)
    series = F.log(x) - 0.5 / x - inv2 * (
        F.lit(1.0 / 12) - inv2 * (F.lit(1.0 / 120) - inv2 * (F.lit(1.0 / 252) - inv2 / 240.0))
    )
    for i in range(8):
        series = series - 1.0 / (c.cast("double") + float(i))
    return series
