"""Semi join of points with intervals of any length and number, as a hash join.

The line is cut into at most ``_CELLS`` + 1 cells at quantiles of the intervals' first points, and in each cell overlapping intervals
become one. What a cell's intervals leave over for later cells is a single number, the farthest end before it, so
every cell is merged on its own. A point looks up the one row of its cell and searches it by halves: rows that are
shuffled are as many as there are points and intervals, however long the intervals are and however they overlap.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Cells of the line; their ends are sent with the plan.
_CELLS = 1000
# Bits of a digit: 16 pieces of a length make one of the next.
RADIX_BITS = 4
_LEVELS = 64 // RADIX_BITS


def _place(column: Column, kind: T.DataType) -> Column:
    """A point on the line as a whole number: days, microseconds or the number itself."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        # Microseconds of the clock's reading, whatever the session's time zone is.
        seconds = F.hour(column) * 3600 + F.minute(column) * 60
        return (F.unix_date(column.cast("date")).cast("bigint") * 86400 + seconds) * 1_000_000 + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
    return column.cast("bigint")


def _constant(numbers: list[int]) -> Column:
    """An array of whole numbers as one literal; one for each number would take the planner seconds."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _upto(values: Column, halves: Column, point: Column) -> Column:
    """How many of the ascending ``values`` are not above ``point``; ``halves`` are falling powers of two, in all at least their number."""
    return F.aggregate(halves, F.lit(0), lambda n, half: F.when(F.get(values, n + half - 1) <= point, n + half).otherwise(n))


def _halves(number: Column) -> Column:
    """Falling powers of two down to 1 that add up to ``number`` at least, whatever the rounding of the logarithm."""
    return F.transform(F.sequence(F.floor(F.log2(number)).cast("int") + 1, F.lit(0), F.lit(-1)), lambda k: F.call_function("shiftleft", F.lit(1), k))


def _cell(bounds: list[int], point: Column) -> Column:
    """The cell of a point: the number of bounds that are not above it."""
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return _upto(_constant(bounds), F.lit(steps), point)


def merged(intervals: DataFrame, first: str, last: str) -> tuple[list[int], DataFrame | None]:
    """The ascending ends of the cells, and (cell, low, high): the intervals' union as runs [low, high) that lie in one cell and apart.

    A null end, or a last point before the first, makes an interval empty; without any there is no table.
    """
    kind = intervals.schema[first].dataType
    spans = intervals.select(_place(F.col(first), kind).alias("low"), (_place(F.col(last), kind) + 1).alias("high")).where("low < high")
    bounds = sorted(set(spans.agg(F.percentile_approx("low", [k / _CELLS for k in range(_CELLS)], 10 * _CELLS)).first()[0] or []))
    if not bounds:
        return [], None
    dealt = spans.groupBy("low").agg(F.max("high").alias("high")).withColumn("cell", _cell(bounds, F.col("low")))
    # One row for each cell at most: what the cells before it reach, if that is inside it.
    tops = dict(spans.groupBy(_cell(bounds, F.col("low")).alias("cell")).agg(F.max("high")).collect())
    reach = list(accumulate((tops.get(k, -(1 << 63)) for k in range(len(bounds))), max))
    at = F.col("id").cast("int")
    carried = intervals.sparkSession.range(len(bounds)).select(
        F.get(_constant(bounds), at).alias("low"), F.get(_constant(reach), at).alias("high"), (at + 1).alias("cell")).where("low < high")
    ordered = Window.partitionBy("cell").orderBy("low")
    before = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = dealt.unionByName(carried).withColumn("begins", F.coalesce(F.col("low") > before, F.lit(True)).cast("bigint"))
    runs = marked.withColumn("run", F.sum("begins").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # A cell's last run ends where the next cell begins, which has the rest.
    end = F.get(_constant(bounds), F.col("cell"))
    found = runs.groupBy("cell", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return bounds, found.select("cell", "low", F.least("high", end).alias("high"))


def pieces(intervals: DataFrame, first: str, last: str) -> DataFrame:
    """(level, piece): the aligned pieces that cover the intervals, both ends included; no piece lies in another.

    Lengths of pieces are powers of ``2 ** RADIX_BITS``, as numbers are cut into digits: a long interval is a few large pieces and
    a few small ones at either end. A run of overlapping intervals has at most 2 * (2 ** RADIX_BITS - 1) pieces of a level.
    """
    _, rest = merged(intervals, first, last)
    if rest is None:
        return intervals.sparkSession.range(0).select(F.lit(0).alias("level"), F.col("id").alias("piece"))
    rest = rest.select("low", "high")
    # [low, high) in units of a level: what does not fill pieces of the next level is cut off at either end.
    for level in range(_LEVELS):
        rest = rest.withColumns({"up_low": F.shiftright(F.col("low") + ((1 << RADIX_BITS) - 1), RADIX_BITS), "up_high": F.shiftright("high", RADIX_BITS)})
        inner = F.col("up_low") < F.col("up_high")
        rest = rest.withColumns({
            f"from{level}": F.col("low"), f"head{level}": F.when(inner, F.shiftleft("up_low", RADIX_BITS)).otherwise(F.col("high")),
            f"tail{level}": F.when(inner, F.shiftleft("up_high", RADIX_BITS)).otherwise(F.col("high")), f"to{level}": F.col("high"),
            "low": F.when(inner, F.col("up_low")).otherwise(F.lit(0)), "high": F.when(inner, F.col("up_high")).otherwise(F.lit(0))})
    cut = F.array(*[F.struct(F.lit(level).alias("level"), F.col(a).alias("a"), F.col(b).alias("b"))
                    for level in range(_LEVELS) for a, b in ((f"from{level}", f"head{level}"), (f"tail{level}", f"to{level}"))])
    runs = rest.select(F.explode(F.filter(cut, lambda r: r["a"] < r["b"])).alias("r"))
    return runs.select("r.level", F.explode(F.sequence(F.col("r.a"), F.col("r.b") - 1)).alias("piece"))


def interval_semi_join(points: DataFrame, column: str, intervals: DataFrame, first: str, last: str) -> DataFrame:
    """The rows of ``points`` that lie in an interval, each once; ``first`` and ``last`` belong to the interval. Null points lie in none."""
    bounds, runs = merged(intervals, first, last)
    if runs is None:
        return points.limit(0)
    # One row for each cell: its runs in their order.
    listed = runs.groupBy(F.col("cell").alias("__cell")).agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs")).select(
        "__cell", F.col("runs.low").alias("__low"), F.col("runs.high").alias("__high"), _halves(F.size("runs")).alias("__halves"))
    place = _place(F.col(column), points.schema[column].dataType)
    looked = points.withColumns({"__at": place, "__in": _cell(bounds, place)})
    inside = F.get("__high", _upto(F.col("__low"), F.col("__halves"), F.col("__at")) - 1) > F.col("__at")
    return looked.join(listed, (F.col("__in") == F.col("__cell")) & inside, "left_semi").drop("__at", "__in")
