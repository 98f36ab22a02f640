"""Tables behind the distribution, time and cluster reports. ``keys`` may be empty or name the station."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.timeline import month_angle, month_name
from gustline.operators.quantiles import counted_cells, exact_quantiles
from gustline.storage import materialize

# Most distinct values a text column may have to be counted by category; grid points of a
# density curve and how many bandwidths it reaches past the data; whisker length in quartile ranges.
MAX_CATEGORIES = 50
GRID_POINTS, GRID_CUT = 200, 3.0
WHISKER = 1.5


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def unpivot(df: DataFrame, columns: Sequence[str], keys: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Long rows (keys, also, column, value) as doubles."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, *also, F.explode(cells).alias("__c")).select(*keys, *also, "__c.column", "__c.value")


# --- gates and counts --------------------------------------------------------------------------------

# Distinct values that a task holds of a column before it hands them on.
_HELD = 1 << 16

_VALUES = T.StructType([T.StructField(c, T.StringType()) for c in ("column", "kind", "value")] + [T.StructField("n", T.LongType())])


def values_met(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """(column, kind, value, n): of every column the distinct present values as text (kind ``value``) with their rows, and the
    present and missing cells (kinds ``present`` and ``missing``). One scan; no row is repeated by column.

    With ``limit``, a task that has met more values of a column hands on ``limit + 1`` of them and looks for no more: their counts
    mean nothing then, but their number tells that there are too many."""
    columns = list(columns)
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    source = df.select(*[(F.to_json(c) if isinstance(df.schema[c].dataType, nested) else F.col(c) if is_numeric(df, c)
                          else F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = [{} for _ in columns]
        rows, missing = 0, [0] * len(columns)
        full = [False] * len(columns)

        def packed(i: int, kind: str, counts: dict) -> pa.RecordBatch:
            # Zero has two signs and is one value.
            text = [None if v is None else str(v + 0.0 if isinstance(v, float) else v) for v in counts]
            return pa.RecordBatch.from_arrays(
                [pa.array([columns[i]] * len(text), pa.string()), pa.array([kind] * len(text), pa.string()), pa.array(text, pa.string()),
                 pa.array(counts.values(), pa.int64())], names=_VALUES.names)

        for batch in batches:
            rows += batch.num_rows
            for i in range(len(columns)):
                missing[i] += batch.column(i).null_count
                if full[i]:
                    continue
                counts = pc.value_counts(batch.column(i).drop_null())
                for v, n in zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()):
                    held[i][v] = held[i].get(v, 0) + n
                    if limit is not None and len(held[i]) > limit:
                        full[i] = True
                        break
                if limit is None and len(held[i]) > _HELD:
                    yield packed(i, "value", held[i])
                    held[i] = {}
        for i in range(len(columns)):
            if held[i]:
                yield packed(i, "value", held[i])
            yield packed(i, "missing", {None: missing[i]})
            yield packed(i, "present", {None: rows - missing[i]})

    return source.mapInArrow(run, _VALUES).groupBy("column", "kind", "value").agg(F.sum("n").alias("n"))


def _of_all(met: DataFrame, columns: Sequence[str], **found: Column) -> DataFrame:
    """A row for every column; zeros where nothing was met."""
    every = met.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    counted = met.groupBy("column").agg(*[c.alias(n) for n, c in found.items()])
    return every.join(counted, "column", "left").select("column", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in found])


def _number() -> Column:
    return F.count(F.when(F.col("kind") == "value", F.lit(1)))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct present values per column. Tasks hand on the values they meet; those are dealt out by column and
    value, so a column of many values is spread, and a frequent value costs a row a task."""
    return _of_all(values_met(df, columns), columns, distinct_values=_number())


def column_gates(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> DataFrame:
    """Per column: numeric, at most ``limit`` distinct values, without any value. One scan; a task hands on at most ``limit + 1``
    values of a column, which is enough to know."""
    numeric = F.array(*[F.lit(c) for c in columns if is_numeric(df, c)]).cast("array<string>")
    found = _of_all(values_met(df, columns, limit), columns, values=_number(), present=F.sum(F.when(F.col("kind") == "present", F.col("n"))))
    return found.select("column", F.array_contains(numeric, F.col("column")).alias("is_numeric"),
                        (F.col("values") <= limit).alias("has_few_values"), (F.col("present") == 0).alias("is_empty"))


def few_values(met: DataFrame, limit: int = MAX_CATEGORIES) -> DataFrame:
    """(column, value, n) of the columns with at most ``limit`` distinct values, from a written :func:`values_met` of that limit."""
    values = met.where(F.col("kind") == "value").select("column", "value", "n")
    few = values.groupBy("column").agg(F.count("value").alias("__n")).where(F.col("__n") <= limit).select("column")
    return values.join(few, "column", "left_semi")


def missing_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Present and missing cells per column, in one pass."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(f"__n_{c}") for c in columns])
    return counted.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__n_{c}").alias("present"),
                 (F.col("__rows") - F.col(f"__n_{c}")).alias("missing")) for c in columns])))


def category_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows per value of each text column; missing values are not counted."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(*keys, F.explode(cells).alias("__c")).select(*keys, "__c.column", "__c.value")
    return long.where(F.col("value").isNotNull()).groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))


# --- distributions -----------------------------------------------------------------------------------

def _group(keys: Sequence[str]) -> list[str]:
    return [*keys, "column"]


def value_cells(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The first pass of :func:`summaries`; it has the missing cells, too."""
    return counted_cells(unpivot(df, columns, keys), _group(keys), "value")


def summaries(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), cells: DataFrame | None = None) -> DataFrame:
    """Per column: ``n``, ``least``, ``most``, ``mean``, ``deviation``, ``q1``, ``median``, ``q3``; exact.

    One row per column and key, written, so the passes that use it plan their join by its size.
    """
    found = exact_quantiles(unpivot(df, columns, keys), _group(keys), "value", [0.25, 0.5, 0.75], cells)
    q = F.col("quantiles")
    return materialize(found.select(
        *_group(keys), F.col("rows").alias("n"), "least", "most", "mean", "deviation",
        q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")), "summary")


def _within_whiskers() -> Column:
    spread = F.col("q3") - F.col("q1")
    return F.col("value").between(F.col("q1") - WHISKER * spread, F.col("q3") + WHISKER * spread)


# Numbers that the pass below needs of a column: bins, whiskers, and the grid of its density.
_NEEDED = ("low", "width", "bins", "fence_low", "fence_high", "bandwidth", "grid_from", "grid_step")


def _needed(summary: DataFrame, keys: Sequence[str], points: int, cut: float) -> DataFrame:
    """(keys, column) and the numbers of ``_NEEDED`` as one array."""
    spread = F.col("q3") - F.col("q1")
    width = F.when(F.col("deviation") > 0, F.col("deviation") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    found = summary.join(histogram_bins(summary, keys), _group(keys)).select(
        *_group(keys), "low", "width", F.col("bins").cast("double"), (F.col("q1") - WHISKER * spread).alias("fence_low"),
        (F.col("q3") + WHISKER * spread).alias("fence_high"), width.alias("bandwidth"), (F.col("least") - cut * width).alias("grid_from"),
        ((F.col("most") - F.col("least") + 2 * cut * width) / (points - 1)).alias("grid_step"))
    return found.select(*_group(keys), F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in _NEEDED]).alias("__p"))


_PARTS = ("histogram", "box", "density")
# Groups whose sums a task holds before it hands them on, values whose kernel is computed at once, and bandwidths beyond which
# a kernel is zero in double precision.
_GROUPS, _KERNEL_ROWS, _REACH = 2048, 2048, 39.0


def _density_sums(v: np.ndarray, n: np.ndarray, p: np.ndarray, begin: np.ndarray, points: int) -> np.ndarray:
    """Sums of kernels on the grids of groups of rows: ``v`` and ``n`` (values and how often) lie by group, from ``begin`` on; ``p``
    has the bandwidth, first point and step of each group."""
    out = np.zeros((len(begin), points))
    grid = np.arange(points)
    ends = np.append(begin[1:], len(v))
    for g, (a, b) in enumerate(zip(begin.tolist(), ends.tolist())):
        width, first, step = p[g]
        if not width > 0:
            continue
        for i in range(a, b, _KERNEL_ROWS):
            x, weight = v[i:min(b, i + _KERNEL_ROWS)], n[i:min(b, i + _KERNEL_ROWS)]
            # Values lie in order, so those near a point are neighbours: points out of reach of all are left out.
            low = max(0, int(np.ceil((x[0] - _REACH * width - first) / step)))
            high = min(points, int(np.floor((x[-1] + _REACH * width - first) / step)) + 1)
            if low < high:
                z = ((first + grid[low:high] * step) / width)[None, :] - (x / width)[:, None]
                out[g, low:high] += weight @ np.exp(-0.5 * z * z)
    return out


def spread(df: DataFrame, columns: Sequence[str], keys: Sequence[str], summary: DataFrame, parts: Sequence[str] = _PARTS,
           points: int = GRID_POINTS, cut: float = GRID_CUT) -> DataFrame:
    """(keys, column, part, slot, n, total, least, most): bins, whiskers and outliers, and kernel sums of all columns in one scan.

    Columns go to the tasks side by side, beside the numbers of their group; a task adds up counts per bin and a grid of fixed
    size per group and column, and only those sums are exchanged.
    """
    columns, keys, parts = list(columns), list(keys), tuple(parts)
    size = len(_NEEDED)
    # A row per group, written: the join is planned by its size. A column without a value has no numbers.
    wide = materialize(_needed(summary, keys, points, cut).groupBy(*keys).agg(F.flatten(F.array(*[
        F.coalesce(F.max(F.when(F.col("column") == c, F.col("__p"))), F.array_repeat(F.lit(float("nan")), size)) for c in columns])).alias("__p")), "needed")
    values = df.select(*keys, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)])
    # Without keys there is one row of numbers, which goes with the function.
    only = None if keys else np.array((wide.first() or [[float("nan")] * size * len(columns)])[0], float).reshape(1, len(columns), size)
    source = values.join(wide, keys) if keys else values
    kinds = {k: df.schema[k].dataType for k in keys}
    schema = T.StructType([*[T.StructField(k, kinds[k]) for k in keys], *[T.StructField(n, k) for n, k in (
        ("column", T.StringType()), ("part", T.StringType()), ("slot", T.LongType()), ("n", T.LongType()), ("total", T.DoubleType()),
        ("least", T.DoubleType()), ("most", T.DoubleType()))]])
    source = source.select(*keys, *values.columns[len(keys):], *(["__p"] if keys else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple, tuple] = {}  # a group's place in the sums, and its keys as they came
        bins: dict[tuple, dict] = {}
        boxes: dict[tuple, list] = {}
        curves: dict[tuple, np.ndarray] = {}

        def packed() -> pa.RecordBatch:
            out = []
            for (g, i), found in bins.items():
                out += [(g, i, "histogram", slot, n, None, None, None) for slot, n in found.items()]
            out += [(g, i, "box", 0, n, None, least, most) for (g, i), (n, least, most) in boxes.items()]
            for (g, i), sums in curves.items():
                out += [(g, i, "density", slot, None, total, None, None) for slot, total in enumerate(sums.tolist())]
            rows = {k: [r[0][j] for r in out] for j, k in enumerate(keys)}
            arrays = [pa.array(rows[k], kind) for k, kind in zip(keys, key_kinds)]
            arrays += [pa.array([columns[r[1]] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string())]
            arrays += [pa.array([r[j] for r in out], k) for j, k in ((3, pa.int64()), (4, pa.int64()), (5, pa.float64()),
                                                                    (6, pa.float64()), (7, pa.float64()))]
            for held in (bins, boxes, curves, names):
                held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        key_kinds: list[pa.DataType] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key_kinds = [batch.schema.field(j).type for j in range(len(keys))]
            needed = only
            if keys:
                needed = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(columns), size)
                codes = [batch.column(j).dictionary_encode().indices.to_numpy(zero_copy_only=False) for j in range(len(keys))]
                _, one, group = np.unique(np.column_stack(codes), axis=0, return_index=True, return_inverse=True)
                group = group.reshape(-1)
                labels = list(zip(*[batch.column(j).take(pa.array(one)).to_pylist() for j in range(len(keys))]))
            else:
                one, group, labels = np.zeros(1, np.int64), np.zeros(batch.num_rows, np.int64), [()]
            for i in range(len(columns)):
                v = batch.column(len(keys) + i).to_numpy(zero_copy_only=False)
                kept = np.flatnonzero(~np.isnan(v))
                if not len(kept):
                    continue
                order = kept[np.lexsort((v[kept], group[kept]))]
                x, g = v[order], group[order]
                # Equal values of a group are one value that counts often.
                new = np.append(True, (g[1:] != g[:-1]) | (x[1:] != x[:-1]))
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(x)))
                x, g = x[at], g[at]
                begin = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
                p = needed[one[g], i]
                own = [(labels[k], i) for k in g[begin].tolist()]
                if "histogram" in parts:
                    slot = np.minimum(np.floor((x - p[:, 0]) / p[:, 1]), p[:, 2] - 1).astype(np.int64)
                    cell = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (slot[1:] != slot[:-1])))
                    for k, s, m in zip(g[cell].tolist(), slot[cell].tolist(), np.add.reduceat(n, cell).tolist()):
                        found = bins.setdefault((labels[k], i), {})
                        found[s] = found.get(s, 0) + m
                if "box" in parts:
                    inner = (x >= p[:, 3]) & (x <= p[:, 4])
                    out = np.add.reduceat(np.where(inner, 0, n), begin)
                    least = np.minimum.reduceat(np.where(inner, x, np.inf), begin)
                    most = np.maximum.reduceat(np.where(inner, x, -np.inf), begin)
                    for name, *now in zip(own, out.tolist(), least.tolist(), most.tolist()):
                        old = boxes.get(name, (0, np.inf, -np.inf))
                        boxes[name] = [old[0] + now[0], min(old[1], now[1]), max(old[2], now[2])]
                if "density" in parts:
                    sums = _density_sums(x, n.astype(float), p[begin, 5:], begin, points)
                    for name, one_sum, width in zip(own, sums, p[begin, 5].tolist()):
                        if width > 0:
                            curves[name] = curves[name] + one_sum if name in curves else one_sum
            if max(len(bins), len(boxes), len(curves)) > _GROUPS:
                yield packed()
        if bins or boxes or curves:
            yield packed()

    return materialize(source.mapInArrow(run, schema).groupBy(*_group(keys), "part", "slot").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most")), "spread")


def _part(df: DataFrame, columns: Sequence[str], keys: Sequence[str], summary: DataFrame, part: str, given: DataFrame | None, **options) -> DataFrame:
    found = spread(df, columns, keys, summary, (part,), **options) if given is None else given
    return found.where(F.col("part") == part)


def box_stats(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), summary: DataFrame | None = None,
              given: DataFrame | None = None) -> DataFrame:
    """Quartiles, mean, whiskers at the last real values within 1.5 quartile ranges, number of outliers. ``given``: what
    :func:`spread` has found already."""
    summary = summaries(df, columns, keys) if summary is None else summary
    part = _part(df, columns, keys, summary, "box", given)
    bounded = [F.when(F.abs(F.col(c)) < float("inf"), F.col(c)) for c in ("least", "most")]
    return part.select(*_group(keys), bounded[0].alias("whisker_low"), bounded[1].alias("whisker_high"), F.col("n").alias("outliers")) \
        .join(summary.select(*_group(keys), "n", "q1", "median", "q3", "mean"), _group(keys)).select(
            *_group(keys), "n", "q1", "median", "q3", "mean", "whisker_low", "whisker_high", "outliers")


def outliers(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), summary: DataFrame | None = None) -> DataFrame:
    """Distinct values beyond the whiskers and how often they occur."""
    summary = summaries(df, columns, keys) if summary is None else summary
    held = unpivot(df, columns, keys).where(F.col("value").isNotNull()).join(summary, _group(keys))
    beyond = held.where(~_within_whiskers())
    return beyond.groupBy(*_group(keys), "value").agg(F.count(F.lit(1)).alias("n"))


def histogram_bins(summary: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per column: ``low``, ``width``, ``bins``.

    The bin width is the smaller of the Freedman-Diaconis and the Sturges width; a column without spread
    gets one bin of width 1 around its value.
    """
    span = F.col("most") - F.col("least")
    rows = F.col("n").cast("double")
    diaconis = 2 * (F.col("q3") - F.col("q1")) / F.pow(rows, F.lit(1.0 / 3.0))
    sturges = span / (F.log2(rows) + 1)
    guess = F.when(diaconis > 0, F.least(diaconis, sturges)).otherwise(sturges)
    # Rounded first: a quotient a hair above a whole number is that number.
    bins = F.when(span > 0, F.ceil(F.round(span / guess, 9))).otherwise(F.lit(1)).cast("bigint")
    return summary.select(
        *_group(keys), F.when(span > 0, F.col("least")).otherwise(F.col("least") - 0.5).alias("low"),
        F.when(span > 0, span / bins).otherwise(F.lit(1.0)).alias("width"), bins.alias("bins"))


def histogram(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), summary: DataFrame | None = None,
              given: DataFrame | None = None) -> DataFrame:
    """Rows per non-empty bin; the last bin holds its upper bound."""
    summary = summaries(df, columns, keys) if summary is None else summary
    part = _part(df, columns, keys, summary, "histogram", given)
    return part.select(*_group(keys), F.col("slot").alias("bin"), "n").join(histogram_bins(summary, keys), _group(keys)).select(
        *_group(keys), "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"), F.col("width").alias("bin_width"), "n")


def density(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), points: int = GRID_POINTS,
            cut: float = GRID_CUT, summary: DataFrame | None = None, given: DataFrame | None = None) -> DataFrame:
    """Gaussian kernel density (Scott's bandwidth) on an even grid past the data's ends. A task adds the kernels of its values up
    on the grid; a row per task, column and grid point is exchanged."""
    summary = summaries(df, columns, keys) if summary is None else summary
    part = _part(df, columns, keys, summary, "density", given, points=points, cut=cut)
    width = F.col("deviation") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    curve = summary.where(F.col("deviation") > 0).select(
        *_group(keys), (F.col("n") * width * F.sqrt(2 * F.pi())).alias("__area"), (F.col("least") - cut * width).alias("__from"),
        ((F.col("most") - F.col("least") + 2 * cut * width) / (points - 1)).alias("__step"))
    return part.join(curve, _group(keys)).select(
        *_group(keys), F.col("slot").cast("int").alias("point"), (F.col("__from") + F.col("slot") * F.col("__step")).alias("x"),
        (F.col("total") / F.col("__area")).alias("density"))


# --- time --------------------------------------------------------------------------------------------

def _period_means(df: DataFrame, columns: Sequence[str], keys: Sequence[str], time: str, unit: str) -> DataFrame:
    start = F.trunc(F.to_date(time), unit).cast("timestamp_ntz")
    means = df.where(F.col(time).isNotNull()).groupBy(*keys, start.alias("period")).agg(*[F.avg(c).alias(c) for c in columns])
    return unpivot(means, columns, [*keys], ["period"]).where(F.col("value").isNotNull())


def monthly(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), time: str = "valid") -> DataFrame:
    """Monthly means, empty months left out, with month name, year and the month's angle on a circle."""
    period = F.col("period")
    return _period_means(df, columns, keys, time, "month").select(
        *_group(keys), "period", "value", month_name(period).alias("month"), F.year(period).alias("year"),
        month_angle(period).alias("angle"))


def quarterly(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), time: str = "valid") -> DataFrame:
    return _period_means(df, columns, keys, time, "quarter").select(
        *_group(keys), "period", "value", F.quarter("period").alias("quarter"), F.year("period").alias("year"))


def _complete(means: DataFrame, group: Sequence[str]) -> DataFrame:
    """Groups whose months have no gap, cover the whole calendar and span more than one year."""
    number = F.year("period") * 12 + F.month("period")
    shape = means.groupBy(*group).agg(
        (F.max(number) - F.min(number) + 1 == F.count(F.lit(1))).alias("__whole"),
        F.count_distinct(F.month("period")).alias("__months"), F.count_distinct(F.year("period")).alias("__years"))
    return shape.where(F.col("__whole") & (F.col("__months") == 12) & (F.col("__years") > 1)).select(*group)


def _with_average(means: DataFrame, season: Column, name: str, group: Sequence[str]) -> DataFrame:
    # A group has one row per month or quarter of its range.
    return means.withColumn(name, season).withColumn(
        "season_mean", F.avg("value").over(Window.partitionBy(*group, name)))


def seasonal_months(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), time: str = "valid") -> DataFrame:
    """Value per calendar month and year beside the month's mean; only for complete groups."""
    group = _group(keys)
    means = _period_means(df, columns, keys, time, "month")
    kept = means.join(_complete(means, group), group, "left_semi")
    return _with_average(kept, F.month("period"), "month", group).select(
        *group, "month", F.year("period").alias("year"), "value", "season_mean")


def seasonal_quarters(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), time: str = "valid") -> DataFrame:
    """Value per calendar quarter and year beside the quarter's mean; gated by the months as well."""
    group = _group(keys)
    whole = _complete(_period_means(df, columns, keys, time, "month"), group)
    means = _period_means(df, columns, keys, time, "quarter").join(whole, group, "left_semi")
    return _with_average(means, F.quarter("period"), "quarter", group).select(
        *group, "quarter", F.year("period").alias("year"), "value", "season_mean")


# --- points and years --------------------------------------------------------------------------------

def interval_years(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Distinct years in which an interval starts or ends, sorted."""
    years = F.array(F.year(start), F.year(end))
    return df.select(F.explode(F.array_compact(years)).alias("year")).distinct().orderBy("year")


def bounds(df: DataFrame, keys: Sequence[str] = (), lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(lat).alias("south"), F.max(lat).alias("north"), F.min(lon).alias("west"), F.max(lon).alias("east"))
