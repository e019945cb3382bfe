"""Running totals over an ordered table without a single-task window.

A window ordered over the whole table puts every row in one task. Here the order is cut into a
hierarchy of cells (``levels``, coarse to fine, dates or integers that never fall along the order): rows are
summed inside their finest cell, and the total of everything before a cell is found the same way one
level up, on the much smaller table of cell totals. Only the coarsest table, as long as its number of cells, is
seen by one task. The cells are plain expressions, so a recomputed task gets the same answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_BEFORE_ALL = -(2**63)


def _with_cells(df: DataFrame, levels: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    """Add the cells as integers that are never null: null comes first, as it does in an ascending sort.

    Columns that cannot be null need no null filter on the join sides, so these stay equal plans and
    share one shuffle.
    """
    names = [f"__cell{i}" for i in range(len(levels))]
    typed = df.select("*", *[c.alias(n) for c, n in zip(levels, names)])
    whole = {n: F.unix_date(n) if isinstance(typed.schema[n].dataType, T.DateType) else F.col(n) for n in names}
    return typed.withColumns({
        n: F.coalesce(c.cast("bigint"), F.lit(_BEFORE_ALL)) for n, c in whole.items()}), names


def _same(rows: DataFrame, within: Sequence[str], levels: Sequence[str]) -> Column:
    """Equality with the renamed keys; null-safe only for group columns that may be null."""
    parts = []
    for k in [*within, *levels]:
        a, b = F.col(k), F.col(f"__of_{k}")
        parts.append(a.eqNullSafe(b) if k in within and rows.schema[k].nullable else a == b)
    return reduce(and_, parts)


def running_totals(
    df: DataFrame,
    sums: Mapping[str, Column],
    levels: Sequence[Column],
    order_by: Sequence[Column],
    within: Sequence[str] = (),
    grand_suffix: str | None = None,
    ahead: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add inclusive running sums along ``levels``, then the ascending ``order_by`` expressions.

    ``within`` restarts the totals per group (null is a group). With ``grand_suffix`` the total over the
    whole group is added as well, as ``<name><suffix>``. ``ahead`` adds values of the next row in the
    order, null on the last one.
    """
    cells, names = _with_cells(df, levels)
    wanted = F.struct(*[c.alias(n) for n, c in ahead.items()]) if ahead else None
    out = _accumulate(cells, dict(sums), names, list(order_by), list(within), grand_suffix, wanted)
    if ahead:
        out = out.withColumns({n: F.col("__ahead")[n] for n in ahead}).drop("__ahead")
    return out.drop(*names)


def _dealt_whole(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys`` with all columns, whatever is used of them afterwards.

    The rows and the totals of their cells then come from one equal exchange, so the source is read and shuffled once.
    The condition is always true; naming every column after the exchange keeps the optimizer from cutting the
    columns before it for the totals alone, and the number of the partition keeps the condition where it is.
    """
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.repartition(*keys).where((F.spark_partition_id() >= 0) | (F.xxhash64(*hashable) == 0))


def _accumulate(df, sums, levels, order_by, within, grand_suffix, wanted):
    keys = [*within, *levels]
    ordered = Window.partitionBy(*keys).orderBy(*order_by)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = [F.sum(c).over(upto).alias(n) for n, c in sums.items()]
    if wanted is not None:
        added.append(F.lead(wanted).over(ordered).alias("__ahead"))
    if not levels:
        if grand_suffix:
            everything = Window.partitionBy(*within)
            added += [F.sum(c).over(everything).alias(n + grand_suffix) for n, c in sums.items()]
        return df.select("*", *added)

    df = _dealt_whole(df, keys)
    rows = df.select("*", *added)
    # One row per cell: its totals and its first row, which is what follows the cell before it.
    own = [F.sum(c).alias(f"__own_{n}") for n, c in sums.items()]
    first = [F.min_by(wanted, F.struct(*order_by)).alias("__first")] if wanted is not None else []
    cells = df.groupBy(*keys).agg(*own, *first)
    before = _accumulate(cells, {f"__upto_{n}": F.col(f"__own_{n}") for n in sums}, levels[:-1],
                         [F.col(levels[-1])], within, grand_suffix, F.col("__first") if first else None)
    grand = [f"__upto_{n}{grand_suffix}" for n in sums] if grand_suffix else []
    before = before.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys],
        *[(F.col(f"__upto_{n}") - F.col(f"__own_{n}")).alias(f"__before_{n}") for n in sums], *grand,
        *[F.col("__ahead").alias("__later") for _ in first])
    joined = rows.join(before, _same(rows, within, levels))
    return joined.select(
        *df.columns,
        *[(F.col(n) + F.col(f"__before_{n}")).alias(n) for n in sums],
        *[F.col(g).alias(g.removeprefix("__upto_")) for g in grand],
        *[F.coalesce("__ahead", "__later").alias("__ahead") for _ in first])


def ordered_index(
    df: DataFrame, name: str, levels: Sequence[Column | str], order_by: Sequence[Column], start: int = 1
) -> DataFrame:
    """Add a dense 64-bit position, counted from ``start`` in the order of levels, then ``order_by``.

    The rows come dealt by ranges of the levels and in their order, so a write in that order needs no other shuffle or
    sort. A level that is a column of ``df`` is best given by its name: what follows then knows it is sorted by it.
    What lies before a cell joins its rows as one more row, through the only shuffle of the rows; the cells are
    counted by a pass of their own, so ``df`` has to give the same rows whenever it is computed.
    """
    keys = [c if isinstance(c, str) else f"__level{i}" for i, c in enumerate(levels)]
    placed = df.select("*", *[c.alias(k) for c, k in zip(levels, keys) if not isinstance(c, str)])
    cells = running_totals(placed.groupBy(*keys).agg(F.count("*").alias("__n")), {"__upto": F.col("__n")},
                           [F.col(k) for k in keys[:-1]], [F.col(keys[-1])])
    heads = cells.select(*keys, (F.col("__upto") - F.col("__n") + F.lit(start - 1)).alias("__before"))
    rows = placed.withColumn("__before", F.lit(None).cast("bigint")).unionByName(heads, allowMissingColumns=True)
    upto = (Window.partitionBy(*keys).orderBy(F.col("__before").asc_nulls_last(), *order_by)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = rows.repartitionByRange(*keys).withColumn(name, F.sum(F.coalesce("__before", F.lit(1).cast("bigint"))).over(upto))
    return counted.where(F.col("__before").isNull()).select(*df.columns, name)
