"""Train and test sets by a hash of the row's key: no sort, stable under any partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.operators.running import with_row_numbers
from gustline.storage import materialize

# Hexadecimal digits of a hash.
_DIGITS = 32


def split_features(df: DataFrame, labels: Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """Features and labels as two frames that share the key."""
    return df.drop(*[c for c in labels if c != key]), df.select(key, *[c for c in df.columns if c in labels and c != key])


def hash_digits(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def mark_test(df: DataFrame, key: str, test_size: float = 0.25, seed: int = 0, exact: bool = False) -> DataFrame:
    """Add ``is_test``. By default each row is decided alone and the share is approximate.

    ``exact`` marks exactly ``ceil(rows * test_size)`` rows (with unique keys): those with the smallest
    hashes. Rows are counted by four hash digits at a time, each time within the one group that holds the
    limit, until the limit lies between two groups; the limit's digits decide every row. A pass returns at
    most 65,536 counts, and no rows are ordered.
    """
    digits = hash_digits(key, seed)
    if not exact:
        limit = f"{int(test_size * 16**8):08x}" if test_size < 1 else "g"
        return df.withColumn("is_test", F.substring(digits, 1, 8) < F.lit(limit))
    hashed = df.select(digits.alias("__hash"))
    prefix, room = "", None
    while len(prefix) < _DIGITS:
        here = hashed.where(F.substring("__hash", 1, len(prefix)) == prefix) if prefix else hashed
        counts = sorted(map(tuple, here.groupBy(F.substring("__hash", len(prefix) + 1, 4)).count().collect()))
        if room is None:
            room = math.ceil(sum(n for _, n in counts) * test_size)
            if not room:
                return df.withColumn("is_test", F.lit(False))
        for head, n in counts:
            if n >= room:
                break
            room -= n
        prefix += head
        if n == room:
            break
    return df.withColumn("is_test", F.substring(digits, 1, len(prefix)) <= F.lit(prefix))


_STRATUM, _HASH = "__stratum", "__hash"


def quotas(sizes: DataFrame, test_size: float) -> DataFrame:
    """``quota`` beside (__stratum, n): shares that add up to ``ceil(rows * test_size)``. Every stratum gets its share rounded
    down; what is left goes, a row each, to the largest fractions, and among equal ones to the first strata."""
    share = F.round(F.col("n") * F.lit(float(test_size)), 9)
    parted = sizes.withColumn("__part", F.floor(share)).withColumn("__order", -(share - F.floor(share)))
    every, given = parted.agg(F.sum("n"), F.sum("__part")).first()
    left = math.ceil(round((every or 0) * test_size, 9)) - (given or 0)
    placed = with_row_numbers(parted, ["__order", _STRATUM], [], "__place")
    return placed.select(_STRATUM, "n", (F.col("__part") + (F.col("__place") < left).cast("long")).alias("quota"))


def mark_test_within(df: DataFrame, key: str, strata: Sequence[str], test_size: float = 0.25, seed: int = 0) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(rows * test_size)`` rows, each stratum with its share of them (see :func:`quotas`), those
    with the smallest hashes of their stratum; a null is a value of its own. Keys are unique.

    All strata are narrowed at once, in a table of (stratum, prefix, room): rows with the prefix are counted by their next
    digits, and the cell that holds the limit becomes the next prefix, until the limit lies between two cells. The number of
    digits goes by the stratum's size, so cells hold some dozens of rows and two or three turns do; the driver sees a boolean a
    turn, however many strata there are. A stratum's counts, at most 65,536, are ordered in one task; rows never are.
    """
    stratum = F.to_json(F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(strata)]), {"ignoreNullFields": "false"})
    rows = materialize(df.select(stratum.alias(_STRATUM), hash_digits(key, seed).alias(_HASH)), "hashes")
    sizes = materialize(rows.groupBy(_STRATUM).agg(F.count(F.lit(1)).alias("n")), "sizes")
    digits = F.least(F.lit(4), F.greatest(F.lit(1), F.ceil(F.log2(F.col("n") / 64) / 4))).cast("int")
    state = materialize(quotas(sizes, test_size).where("quota > 0").select(
        _STRATUM, F.lit("").alias("prefix"), F.col("quota").alias("room"), digits.alias("digits")), "state")
    limits = None
    while not state.isEmpty():
        here = rows.join(state, _STRATUM).where(F.expr(f"startswith({_HASH}, prefix)"))
        counted = here.groupBy(_STRATUM, "prefix", "room", "digits", F.expr(f"substring({_HASH}, length(prefix) + 1, digits)").alias("head")) \
            .agg(F.count(F.lit(1)).alias("n"))
        running = Window.partitionBy(_STRATUM).orderBy("head").rowsBetween(Window.unboundedPreceding, 0)
        cell = counted.withColumn("until", F.sum("n").over(running)).where("until >= room and until - n < room").select(
            _STRATUM, F.concat("prefix", "head").alias("prefix"), (F.col("room") - F.col("until") + F.col("n")).alias("room"),
            "n", F.least(F.lit(4), F.greatest(F.lit(1), F.ceil(F.log2(F.col("n") / 64) / 4))).cast("int").alias("digits"))
        turn = materialize(cell, "turn")
        # A cell taken whole is a limit, and so is one that a whole hash tells apart.
        done = (F.col("room") == F.col("n")) | (F.length("prefix") >= _DIGITS)
        found = turn.where(done).select(_STRATUM, F.col("prefix").alias("__limit"))
        limits = found if limits is None else limits.union(found)
        state = turn.where(~done).select(_STRATUM, "prefix", "room", "digits")
    if limits is None:
        return df.withColumn("is_test", F.lit(False))
    # Written once more, so that the join is planned by the size of the limits.
    limits = materialize(limits, "limits")
    marked = df.withColumn(_STRATUM, stratum).join(limits, _STRATUM, "left")
    below = F.expr("substring({h}, 1, length(__limit))".format(h=_HASH)) <= F.col("__limit")
    return marked.withColumn(_HASH, hash_digits(key, seed)).withColumn("is_test", F.coalesce(below, F.lit(False))).drop(
        _STRATUM, _HASH, "__limit")


def train_test(df: DataFrame, key: str, labels: Sequence[str] | None = None, **options) -> tuple[DataFrame, ...]:
    """(train, test), or with labels (features train, features test, labels train, labels test). With ``strata``, both sets
    have the strata's shares."""
    marked = mark_test_within(df, key, **options) if options.get("strata") else mark_test(df, key, **options)
    train, test = marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")
    if labels is None:
        return train, test
    (x_train, y_train), (x_test, y_test) = split_features(train, labels, key), split_features(test, labels, key)
    return x_train, x_test, y_train, y_test
