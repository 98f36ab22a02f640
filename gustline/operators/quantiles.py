"""Exact order statistics without gathering a group in one place, in two passes over the rows.

A double is cut into whole numbers that rise with it: its sign, exponent and first bits of the fraction make a cell, the
next bits a part of the cell. Pass 1 counts the rows of each cell. Only cells that hold a wanted rank are looked into: pass 2
counts their distinct values, and what it finds, a small share of the rows, is narrowed by parts and then by values. Every
table that one task orders is bounded by the number of cells, of parts of a cell, or of doubles in a part. All groups go
through this together, whatever their size. The result is exact, with linear interpolation between neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.storage import materialize

# Bits of the fraction that tell cells apart, and parts of a cell; as many again are left in a part.
CELL_BITS, PART_BITS = 8, 22
# The sketch of bucket medians has a rank error of at most rows / ACCURACY; up to SMALL_GROUP rows it holds every value.
ACCURACY = 40_000
SMALL_GROUP = 10_000
# Moves exponents above zero, so that cells of negative numbers are negative.
_SHIFT = 1100


def _placed(v: Column) -> tuple[Column, Column]:
    """Cell of a double, and where in the cell it is, from 0 to 1."""
    a = F.abs(v)
    two = F.lit(2.0)
    guess = F.floor(F.log2(a))
    # The logarithm is rounded; powers of two and quotients by them are not.
    exponent = guess + (F.pow(two, guess + 1) <= a).cast("bigint") - (F.pow(two, guess) > a).cast("bigint")
    least = F.pow(two, F.lit(-1022.0))
    ratio = F.when(a < least, 1 + a * F.pow(two, F.lit(1022.0))).otherwise(a / F.pow(two, exponent))
    exponent = F.when(a < least, F.lit(-1023)).otherwise(exponent)
    scaled = (ratio - 1) * F.lit(float(1 << CELL_BITS))
    cell = (exponent + _SHIFT) * (1 << CELL_BITS) + F.floor(scaled)
    endless = F.lit((1024 + _SHIFT) << CELL_BITS)
    cell = F.when(F.isnan(v), endless + 1).when(a == float("inf"), endless).otherwise(cell).cast("bigint")
    inside = F.when(F.isnan(v) | (a == float("inf")), F.lit(0.0)).otherwise(scaled - F.floor(scaled))
    return F.when(v < 0, -cell).otherwise(cell), F.when(v < 0, -inside).otherwise(inside)


def counted_cells(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Pass 1: (keys, __cell, n, low, high, mean, square) of every cell; the rows without a value have the cell null."""
    v = F.col(value).cast("double")
    return materialize(df.select(*keys, v.alias("__v"), _placed(v)[0].alias("__cell")).groupBy(*keys, "__cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"), F.avg("__v").alias("mean"),
        F.var_pop("__v").alias("square")), "cells")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                    cells: DataFrame | None = None) -> DataFrame:
    """Per group: ``rows`` (present values), ``least``, ``most``, ``mean``, ``deviation`` (sample) and
    ``quantiles``, an array in the order of the probabilities. ``cells``: what pass 1 gave, if it has been made.
    """
    keys = list(keys)
    cells = counted_cells(df, keys, value) if cells is None else cells
    group = Window.partitionBy(*keys)
    n, rows = F.col("n"), F.col("rows")
    ranked = cells.where("__cell is not null").withColumns({
        "rows": F.sum("n").over(group), "center": F.sum(n * F.col("mean")).over(group) / F.sum("n").over(group),
        "last": F.sum("n").over(group.orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0))})
    places = [F.lit(float(p)) * (rows - 1) for p in probabilities]
    ranked = ranked.withColumn("ranks", F.array(*[r for p in places for r in (F.floor(p) + 1, F.ceil(p) + 1)]))
    squares = F.sum(n * F.col("square")) + F.sum(n * F.pow(F.col("mean") - F.col("center"), F.lit(2.0)))
    cell = F.struct(F.col("__cell").alias("cell"), (F.col("last") - n + 1).alias("first"), "last", "low", "high")
    # A group has two wanted ranks a probability, and no more wanted cells.
    shape = materialize(ranked.groupBy(*keys).agg(
        F.first("rows").alias("rows"), F.min("low").alias("least"), F.max("high").alias("most"), F.first("center").alias("mean"),
        F.when(F.first("rows") > 1, F.sqrt(squares / (F.first("rows") - 1))).alias("deviation"), F.first("ranks").alias("ranks"),
        F.collect_list(F.when(_wanted(), cell)).alias("cells")), "shape")

    held = shape.select(*keys, "ranks", F.explode("cells").alias("c")).select(
        *keys, "ranks", F.col("c.cell").alias("__cell"), "c.first", "c.last", "c.low", "c.high")
    # Equal values, the first and the last of a cell are known without looking into it.
    known = held.select(*keys, F.explode(F.array(
        F.struct(F.col("first").alias("first"), F.when(F.col("low") == F.col("high"), F.col("last")).otherwise(F.col("first")).alias("last"),
                 F.col("low").alias("value")),
        F.struct(F.col("last").alias("first"), F.col("last").alias("last"), F.col("high").alias("value")))).alias("v"))
    found = known.union(_looked_into(df, keys, value, held.where("low < high")).select(
        *keys, F.struct("first", "last", "value").alias("v"))).groupBy(*keys).agg(F.collect_list("v").alias("values"))

    def at(rank: Column) -> Column:
        return F.filter("values", lambda v: (v["first"] <= rank) & (rank <= v["last"]))[0]["value"]

    def quantile(place: Column) -> Column:
        low, high = at(F.floor(place) + 1), at(F.ceil(place) + 1)
        return low + (high - low) * (place - F.floor(place))

    joined = shape.drop("cells", "ranks").join(found, keys)
    return joined.select(*keys, "rows", "least", "most", "mean", "deviation", F.array(*map(quantile, places)).alias("quantiles"))


def _wanted() -> Column:
    """Whether one of the ranks is among the row's ranks."""
    return F.exists("ranks", lambda r: (r > F.col("last") - F.col("n")) & (r <= F.col("last")))


def _looked_into(df: DataFrame, keys: list[str], value: str, held: DataFrame) -> DataFrame:
    """Pass 2: (keys, first, last, value) of the wanted ranks inside the cells ``held``."""
    v = F.col(value).cast("double")
    cell, inside = _placed(v)
    # Never null, and so declared: else the join's null check is the whole expression once more, without the steps that its parts
    # share, in code too long for the JVM to compile.
    cell = F.coalesce(cell, F.lit(0).cast("bigint"))
    rows = df.where(v.isNotNull()).select(*keys, v.alias("value"), cell.alias("__cell"), F.floor(inside * F.lit(float(1 << PART_BITS))).alias("part"))
    level = [*keys, "__cell"]
    inner = materialize(rows.join(held.select(*level, "ranks", (F.col("first") - 1).alias("before")), level).groupBy(
        *level, "ranks", "before", "part", "value").agg(F.count(F.lit(1)).alias("n")), "inside")

    def narrowed(counts: DataFrame, level: list[str], order: str) -> DataFrame:
        running = Window.partitionBy(*level).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumn("last", F.col("before") + F.sum("n").over(running)).where(_wanted())

    parts = narrowed(inner.groupBy(*level, "ranks", "before", "part").agg(F.sum("n").alias("n")), level, "part")
    wanted = parts.select(*level, "part", (F.col("last") - F.col("n")).alias("before"))
    values = narrowed(inner.drop("before").join(wanted, [*level, "part"]), [*level, "part"], "value")
    return values.select(*keys, (F.col("last") - F.col("n") + 1).alias("first"), "last", "value")


# --- medians of buckets ------------------------------------------------------------------------------

def _bracket(probability: float) -> tuple[float, float]:
    return max(0.0, probability - 2 / ACCURACY), min(1.0, probability + 2 / ACCURACY)


def middle_pair(value: Column) -> Column:
    """Sketch holding the two middle values; exact for groups of at most SMALL_GROUP present values."""
    low, high = _bracket(0.5)
    return F.percentile_approx(value, [0.5, 0.5 + 0.4 / SMALL_GROUP, low, high], ACCURACY)


def median_of_pair(pair: Column, rows: Column) -> Column:
    return F.when(rows % 2 == 0, (pair[0] + pair[1]) / 2).otherwise(pair[0])


def median_of_counts(counts: Sequence[str]) -> Column:
    """Median of values 0..k-1 from the columns that count each: bounded state whatever the group's size."""
    rows = " + ".join(f"`{c}`" for c in counts)

    def at(rank: str) -> str:
        cases = " ".join(
            f"WHEN {rank} <= {' + '.join(f'`{c}`' for c in counts[:value + 1])} THEN {value}D" for value in range(len(counts)))
        return f"CASE {cases} END"

    return F.expr(f"CASE WHEN {rows} > 0 THEN ({at(f'floor(({rows} + 1) / 2)')} + {at(f'(floor(({rows}) / 2) + 1)')}) / 2 END")
