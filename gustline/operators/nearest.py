"""Nearest station of every distinct point, exactly, without a cross join.

Stations form a pyramid of square blocks, each a quarter as wide as the one above, down to blocks of a few stations. Every
block knows the four outermost stations in it, and so its true outline. Points that lie close together form a unit; units
far outside the stations are wider in proportion, for directions hardly differ there. All units walk down the pyramid
together, one equi-join per level, and drop each block whose stations are all farther, from every point of the unit, than
the best station known. What is left at the bottom are the few stations that can be nearest to a point of the unit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.functions.geo import planar_distance
from gustline.storage import materialize

# Levels go down until no block holds more stations than this; the last one is as narrow as a double tells apart.
_BLOCK_STATIONS = 16
_LEVELS = 26
_UNIT = ["u_level", "u_lat", "u_lon"]
_OUTLINE = ["low_lat", "high_lat", "low_lon", "high_lon"]


class _Grid:
    """Square blocks over the stations' extent; level 0 is as wide as the extent."""

    def __init__(self, places: DataFrame, within: list[str]):
        box = places.agg(F.min("s_lat").alias("a"), F.max("s_lat").alias("b"),
                         F.min("s_lon").alias("c"), F.max("s_lon").alias("d")).first()
        self.south, self.west, north, east = (float(box[k] or 0) for k in ("a", "c", "b", "d"))
        self.north, self.east = north, east
        self.extent = max(north - self.south, east - self.west) or 1.0
        level = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS)))
        counts = places.select(*within, "s_lat", "s_lon", level.alias("level")).select(
            *within, "level", *[c.alias(n) for c, n in zip(self._block(F.pow(F.lit(4.0), F.col("level"))), "xy")])
        fullest = counts.groupBy(*within, "level", "x", "y").count().groupBy("level").agg(F.max("count").alias("n"))
        self.depth = min((r["level"] for r in fullest.collect() if r["n"] <= _BLOCK_STATIONS), default=_LEVELS)

    def _block(self, parts: Column) -> tuple[Column, Column]:
        width = F.lit(self.extent) / parts
        return F.floor((F.col("s_lat") - self.south) / width), F.floor((F.col("s_lon") - self.west) / width)

    def pyramid(self, places: DataFrame, within: list[str]) -> DataFrame:
        """Per level and block: the outermost stations on each side, and the block above."""
        x, y = self._block(F.lit(4.0 ** self.depth))
        up = f"CAST(2 * ({self.depth} - level) AS INT)"
        rows = places.withColumns({"x": x, "y": y}).withColumn(
            "level", F.explode(F.sequence(F.lit(0), F.lit(self.depth)))).withColumns({
                "x": F.expr(f"shiftright(x, {up})"), "y": F.expr(f"shiftright(y, {up})")})
        by_lat, by_lon = F.struct("s_lat", "s_lon"), F.struct("s_lon", "s_lat")
        return rows.groupBy(*within, "level", "x", "y").agg(
            F.min(by_lat).alias("south"), F.max(by_lat).alias("north"),
            F.min(by_lon).alias("west"), F.max(by_lon).alias("east"))

    def unit(self) -> list[Column]:
        """Unit of a point: the narrowest blocks' width near the stations, growing with the distance far outside."""
        out = F.greatest(F.lit(self.south) - F.col("lat"), F.col("lat") - F.lit(self.north),
                         F.lit(self.west) - F.col("lon"), F.col("lon") - F.lit(self.east), F.lit(self.extent))
        level = F.floor(F.log2(out / self.extent))
        width = F.lit(self.extent / 4.0 ** self.depth) * F.pow(F.lit(2.0), level)
        return [level.alias("u_level"), F.floor(F.col("lat") / width).alias("u_lat"), F.floor(F.col("lon") / width).alias("u_lon")]


def _least_lead(side: str, low: Column, high: Column) -> Column:
    """Along one axis: the least of (p - t)² - (p - s)² for any p of the unit, any t from low to high, and the rival s."""
    center, half, rival = F.col(f"mid_{side}"), F.col(f"half_{side}"), F.col(f"rival.s_{side}")
    # The square is convex in t and linear in p: p is at an end of the unit, t as near to that end as it can be.
    ends = []
    for sign in (1.0, -1.0):
        t = F.least(F.greatest(center + half * sign, low), high)
        ends.append((t - center) * (t - center) - half * (2.0 * sign) * (t - rival))
    return F.least(*ends) - (rival - center) * (rival - center)


def _possible(met: DataFrame, group: list[str], known: Sequence[Column], outline: Sequence[Column]) -> DataFrame:
    """Rows whose stations can be nearest to some point of the unit. ``known`` are stations of the row."""
    def rated(s: Column) -> Column:
        lat, lon = s["s_lat"], s["s_lon"]
        away = planar_distance(lat, lon, F.col("mid_lat"), F.col("mid_lon"))
        return F.struct(away.alias("away"), lat.alias("s_lat"), lon.alias("s_lon"))

    best = F.array_min(F.array(*[rated(s) for s in known]))
    ranked = met.withColumn("rival", F.min(best).over(Window.partitionBy(*group)))
    lead = _least_lead("lat", *outline[:2]) + _least_lead("lon", *outline[2:])
    reach = F.col("rival.away") + F.col("half_lat") + F.col("half_lon")
    # The margin keeps ties that differ only by rounding.
    return ranked.where(lead <= reach * reach * 1e-12).drop("rival")


def _candidates(units: DataFrame, places: DataFrame, grid: _Grid, within: list[str]) -> DataFrame:
    """Per unit: the stations that can be nearest to some point of it."""
    group = [*within, *_UNIT]
    shape = ["mid_lat", "half_lat", "mid_lon", "half_lon"]
    kept = units.withColumns({"x": F.lit(0).cast("bigint"), "y": F.lit(0).cast("bigint")})
    # Read once per level: written, so that each join is planned by size.
    pyramid = materialize(grid.pyramid(places, within), "pyramid")
    for level in range(grid.depth + 1):
        # The four possible blocks of level 0 lie below one root.
        above = 2 if level else 1
        blocks = pyramid.where(F.col("level") == level).drop("level").withColumnsRenamed({"x": "b_x", "y": "b_y"}).withColumns({
            "x": F.expr(f"shiftright(b_x, {above})"), "y": F.expr(f"shiftright(b_y, {above})")})
        met = kept.join(blocks, [*within, "x", "y"])
        sides = [F.col(c) for c in ("south", "north", "west", "east")]
        outline = [F.col("south.s_lat"), F.col("north.s_lat"), F.col("west.s_lon"), F.col("east.s_lon")]
        kept = _possible(met, group, sides, outline).select(*group, *shape, F.col("b_x").alias("x"), F.col("b_y").alias("y"))
    x, y = grid._block(F.lit(4.0 ** grid.depth))
    met = kept.join(places.withColumns({"x": x, "y": y}), [*within, "x", "y"])
    lat, lon = F.col("s_lat"), F.col("s_lon")
    return _possible(met, group, [F.struct("s_lat", "s_lon")], [lat, lat, lon, lon]).select(*group, "seq", "s_lat", "s_lon")


def _units(points: DataFrame, group: list[str]) -> DataFrame:
    """Middle and half width of the points of each unit, per axis."""
    ends = points.groupBy(*group).agg(*[f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("low", F.min), ("high", F.max))])
    mid = ends.withColumns({f"mid_{c}": (F.col(f"low_{c}") + F.col(f"high_{c}")) / 2 for c in ("lat", "lon")})
    return mid.withColumns({
        f"half_{c}": F.greatest(F.col(f"high_{c}") - F.col(f"mid_{c}"), F.col(f"mid_{c}") - F.col(f"low_{c}"))
        for c in ("lat", "lon")}).drop(*_OUTLINE)


def _known_place(df: DataFrame) -> DataFrame:
    for c in ("lat", "lon"):
        df = df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df


def nearest_station(points: DataFrame, stations: DataFrame, by: Sequence[str] = ("lat", "lon"),
                    order: str = "seq", carry: Sequence[str] = (), within: Sequence[str] = ()) -> DataFrame:
    """Per distinct point: nearest station coordinates, distance and ``order`` value; the first station on a tie.

    ``points`` and ``stations`` have ``lat`` and ``lon``; ``order`` numbers the stations in their source
    order. ``by`` is the key a result row is kept for (default: one per distinct coordinate), ``carry``
    names station columns to add. ``within`` names columns that point and station must share, for one map
    per network.
    """
    within = list(within)
    points, stations = _known_place(points), _known_place(stations)
    # Stations at one place: the first one stands for it.
    places = stations.groupBy(*within, F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon")).agg(
        F.min(order).alias("seq"))
    grid = _Grid(places, within)
    keys = list(dict.fromkeys([*within, *by, "lat", "lon"]))
    group = [*within, *_UNIT]
    distinct = points.select(*keys).distinct().select(*keys, *grid.unit())
    # A few stations per unit, written: the join with the points is planned by its size.
    units = _units(points.select(*within, "lat", "lon", *grid.unit()), group)
    candidates = materialize(_candidates(units, places, grid, within), "candidates")
    met = distinct.join(candidates, group)
    distance = planar_distance(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))
    best = met.groupBy(*keys).agg(
        F.min(F.struct(distance.alias("distance"), "seq", "s_lat", "s_lon")).alias("best"))
    result = best.select(*keys, F.col("best.seq").alias(order), F.col("best.s_lat").alias("station_lat"),
                         F.col("best.s_lon").alias("station_lon"), F.col("best.distance").alias("distance"))
    return result.join(stations.select(*within, order, *carry), [*within, order]) if carry else result
