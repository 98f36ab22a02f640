"""Per-station scalers as parameter tables: fit with aggregates, apply with a join and arithmetic.

A parameter row says ``scaled = (value - center) / scale * width + floor``, clipped if ``clip``. A constant
column has scale 1, so min-max puts it on the lower bound and standard on zero; the standard scaler uses
the population deviation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline import versions
from gustline.schema import KEYS
from gustline.storage import materialize

PARAMETERS = ("position", "center", "scale", "width", "floor", "clip")
SCALERS = ("minmax", "standard")


def _measurements(df: DataFrame, keys: Sequence[str], time: str) -> list[str]:
    return [c for c in df.columns if c not in keys and c != time]


def fit_scaler(df: DataFrame, scaler: str = "minmax", columns: Sequence[str] | None = None,
               keys: Sequence[str] = KEYS, time: str = "valid", variant: str = "",
               feature_range: tuple[float, float] = (0.0, 1.0), clip: bool = False,
               with_mean: bool = True, with_std: bool = True) -> DataFrame:
    """One parameter row per key and column; all columns in one aggregation."""
    if scaler not in SCALERS:
        raise ValueError(f"unknown scaler {scaler!r}")
    low, high = (float(x) for x in feature_range)
    if scaler == "minmax" and not low < high:
        raise ValueError("feature_range must rise")
    columns = list(columns) if columns is not None else _measurements(df, keys, time)
    stats = df.groupBy(*keys).agg(*[a for c in columns for a in (
        F.min(c).alias(f"__min_{c}"), F.max(c).alias(f"__max_{c}"),
        *((F.avg(c).alias(f"__avg_{c}"), F.stddev_pop(c).alias(f"__std_{c}")) if scaler == "standard" else ()),
    )])

    def row(position: int, c: str) -> Column:
        least, most = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        constant = least == most
        if scaler == "minmax":
            center, spread, width, floor = least, most - least, high - low, low
        else:
            center = F.col(f"__avg_{c}") if with_mean else F.when(least.isNotNull(), F.lit(0.0))
            spread = F.col(f"__std_{c}") if with_std else F.lit(1.0)
            width, floor = 1.0, 0.0
        return F.struct(
            F.lit(c).alias("column"), F.lit(position).alias("position"), center.cast("double").alias("center"),
            F.when(constant, F.lit(1.0)).otherwise(spread).alias("scale"),
            F.lit(width).alias("width"), F.lit(floor).alias("floor"),
            F.lit(clip and scaler == "minmax").alias("clip"))

    rows = F.array(*[row(i, c) for i, c in enumerate(columns)])
    return stats.select(*keys, F.lit(scaler).alias("scaler"), F.lit(variant).alias("variant"),
                        F.explode(rows).alias("p")).select(*keys, "scaler", "variant", "p.*")


def fitted_columns(params: DataFrame) -> list[str]:
    """Columns of the fit in its order; as many rows as the table has measurements."""
    order = params.groupBy("column").agg(F.min("position").alias("position")).orderBy("position", "column")
    return [r["column"] for r in order.collect()]


def apply_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str] | None = None,
                 keys: Sequence[str] = KEYS, time: str = "valid") -> DataFrame:
    """Keys, time and the fitted columns, scaled, in the order of the fit.

    Columns that were not fitted are dropped, fitted ones the frame lacks are left out. Stations without
    parameters are left out too. ``columns`` names the fit's columns when the caller knows them.
    """
    fitted = list(columns) if columns is not None else fitted_columns(params)
    usable = [c for c in fitted if c in df.columns]
    wide = params.groupBy(*keys).pivot("column", usable).agg(
        F.first(F.struct("center", "scale", "width", "floor", "clip")))
    wide = wide.select(*keys, *[F.col(c).alias(f"__p_{c}") for c in usable])

    def scaled(c: str) -> Column:
        p = F.col(f"__p_{c}")
        plain = (F.col(c) - p["center"]) / p["scale"] * p["width"] + p["floor"]
        clipped = F.least(F.greatest(plain, p["floor"]), p["floor"] + p["width"])
        return F.when(p["clip"] & plain.isNotNull(), clipped).otherwise(plain).alias(c)

    passed = [c for c in (*keys, time) if c in df.columns]
    return df.join(wide, list(keys)).select(*passed, *[scaled(c) for c in usable])


def scale(df: DataFrame, scaler: str | DataFrame = "minmax", keys: Sequence[str] = KEYS, time: str = "valid",
          **options) -> tuple[DataFrame, DataFrame]:
    """Fit (or take a parameter table) and apply; returns the scaled frame and the parameters."""
    if isinstance(scaler, DataFrame):
        return apply_scaler(df, scaler, keys=keys, time=time), scaler
    columns = options.get("columns") or _measurements(df, keys, time)
    # Fitted once and written: its size is known when the join is planned.
    params = materialize(fit_scaler(df, scaler, keys=keys, time=time, **{**options, "columns": columns}), "scaler")
    return apply_scaler(df, params, columns, keys, time), params


def stored_scaler(df: DataFrame, path: str, scaler: str, variant: str = "", refit: bool = False,
                  keys: Sequence[str] = KEYS, time: str = "valid", **options) -> DataFrame:
    """Parameters from the store; stations not in it are fitted and added.

    The store's key is station, scaler and variant; a stored fit is reused whatever the time range.
    ``refit`` fits every station of the frame anew and replaces its rows. A version of the store is changed as a whole
    (:mod:`gustline.versions`), so readers and other writers are not disturbed.
    """
    identity = list(keys)
    order = [*identity, "scaler", "variant", "column", *PARAMETERS]
    wanted = (F.col("scaler") == scaler) & (F.col("variant") == variant)

    def made(stored: DataFrame | None) -> DataFrame:
        fresh_rows = df if stored is None or refit else df.join(stored.select(*identity).distinct(), identity, "left_anti")
        fresh = fit_scaler(fresh_rows, scaler, keys=keys, time=time, variant=variant, **options).where(wanted).select(*order)
        if stored is None or not refit:
            return fresh
        # Written aside first: it decides which stored rows stay, and is one of both parts.
        fresh = materialize(fresh, "scaler")
        return stored.join(fresh.select(*identity).distinct(), identity, "left_anti").select(*order).unionByName(fresh)

    return versions.append(df.sparkSession, path, f"{scaler} {variant}", made, instead=refit).select(*order)
