"""Exact quantiles of many columns in two passes, whatever the number of distinct values.

Spark's exact ``percentile`` merges a value-to-count map of the whole column in one task. Here the
first pass brackets the wanted rank with bounded sketches; the second counts what lies below the
bracket and ranks only the values inside it, which the sketch error keeps to a sliver of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from inplay.operators.prefix import running_totals

ACCURACY = 10_000
_BRACKET_CELLS = 65_536


def bracket_columns(columns: Sequence[str], q: float = 0.5, accuracy: int = ACCURACY) -> list[Column]:
    """Aggregates of the first pass, to be run with any others: n, low and high per column."""
    margin = 2.0 / accuracy
    ends = [max(0.0, q - margin), min(1.0, q + margin)]
    out = []
    for c in columns:
        out += [F.count(c).alias(f"n__{c}"),
                F.percentile_approx(c, ends, accuracy).alias(f"ends__{c}"),
                F.array(F.min(c), F.max(c)).alias(f"range__{c}")]
    return out


def ranks(n: int, q: float) -> tuple[int, int, float]:
    """1-based ranks around the quantile of n values, and the weight of the upper one."""
    at = (n - 1) * q
    low = math.floor(at)
    return low + 1, min(math.ceil(at), n - 1) + 1, at - low


def _bracketed(df: DataFrame, brackets: dict[str, tuple[float, float]]) -> DataFrame:
    """(column, cell, value, n): counts of every value in its bracket, in cells that rise with the value.

    The column is given by its position. Cell 0 holds a null value, which stands for all values below.
    """
    def entry(i: int, c: str, low: float, high: float) -> Column:
        inside = F.col(c) >= F.lit(low)
        share = (F.col(c) - F.lit(low)) * F.lit(_BRACKET_CELLS / ((high - low) or 1.0))
        return F.when(F.col(c) <= F.lit(high), F.struct(
            F.lit(i).alias("column"), F.when(inside, F.floor(share) + 1).otherwise(F.lit(0)).alias("cell"),
            F.when(inside, F.col(c)).alias("value")))

    entries = F.array(*[entry(i, c, *ends) for i, (c, ends) in enumerate(brackets.items())])
    return (df.select(F.explode(entries).alias("e")).where(F.col("e").isNotNull())
              .groupBy("e.column", "e.cell", "e.value").agg(F.count("*").alias("n")))


def _select(df: DataFrame, brackets: dict, sizes: dict[str, int], q: float) -> dict[str, float]:
    wanted = F.array(*[F.array(*map(F.lit, ranks(sizes[c], q)[:2])) for c in brackets])
    counts = _bracketed(df, brackets)
    total = running_totals(counts, {"upto": F.col("n")}, [F.col("cell")], [F.col("value")], ["column"])
    hits = (total.where(F.col("value").isNotNull())
                 .select("column", "value", "upto", (F.col("upto") - F.col("n")).alias("before"),
                         F.explode(wanted[F.col("column")]).alias("rank"))
                 .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("upto"))))
    columns = list(brackets)
    # At most two rows per column.
    found = {(columns[r["column"]], r["rank"]): r["value"] for r in hits.collect()}
    result = {}
    for c in columns:
        lower, upper, weight = ranks(sizes[c], q)
        if (c, lower) in found and (c, upper) in found:
            a, b = found[c, lower], found[c, upper]
            result[c] = a if weight == 0 else a + (b - a) * weight
    return result


def finish_quantiles(df: DataFrame, first_pass: dict, columns: Sequence[str],
                     q: float = 0.5) -> dict[str, float | None]:
    """Second pass, given the collected first-pass row as a dict. None for a column without values."""
    sizes = {c: first_pass[f"n__{c}"] for c in columns}
    brackets = {c: tuple(map(float, first_pass[f"ends__{c}"])) for c in columns if sizes[c]}
    result = _select(df, brackets, sizes, q) if brackets else {}
    # A sketch that missed the rank would leave its column out: rank that one over its full range.
    missed = {c: tuple(map(float, first_pass[f"range__{c}"])) for c in brackets if c not in result}
    if missed:
        result.update(_select(df, missed, sizes, q))
    return {c: result.get(c) for c in columns}


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5,
                    accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Quantile of each column with linear interpolation between ranks, ignoring nulls."""
    first = df.agg(*bracket_columns(columns, q, accuracy)).first().asDict()
    return finish_quantiles(df, first, columns, q)
