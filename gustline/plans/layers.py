"""Map layers as one feature table ``(network, layer, lat, lon, radius_m, lat2, lon2, props)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.geo import given_radius, spread_radius, with_standard_coordinates
from gustline.functions.popup import attributes
from gustline.operators.nearest import nearest_station

# Layer names.
STATIONS, FIRES, LINES = "Stations", "Fires", "Nearest Stations"


def _features(df: DataFrame, layer: Column, by_network: bool, radius: Column | None = None, to: tuple[str, str] | None = None,
              props: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("double")
    return df.select(
        (F.col("network") if by_network else F.lit("ALL")).alias("network"), layer.alias("layer"), "lat", "lon",
        (radius if radius is not None else none).alias("radius_m"),
        (F.col(to[0]) if to else none).alias("lat2"), (F.col(to[1]) if to else none).alias("lon2"),
        (props if props is not None else F.lit(None).cast("map<string,string>")).alias("props"))


def _radius(df: DataFrame, spread_as_radius: bool) -> Column:
    column = "spread" if spread_as_radius else "radius"
    if column not in df.columns:
        return F.lit(1.0)
    return spread_radius(F.col(column)) if spread_as_radius else given_radius(F.col(column))


def station_features(stations: DataFrame, by_network: bool = False, props: Sequence[str] | None = None) -> DataFrame:
    shown = attributes(stations, props, datetime_to_year=True)
    stations = with_standard_coordinates(stations.withColumn("__props", shown))
    return _features(stations, F.lit(STATIONS), by_network, props=F.col("__props"))


def fire_features(fires: DataFrame, by_network: bool = False, spread_as_radius: bool = True,
                  props: Sequence[str] | None = None) -> DataFrame:
    shown = attributes(fires, props)
    fires = with_standard_coordinates(fires.withColumn("__props", shown))
    return _features(fires, F.lit(FIRES), by_network, _radius(fires, spread_as_radius), props=F.col("__props"))


def info_layers(stations: DataFrame | None = None, fires: DataFrame | None = None, by_network: bool = False,
                order: str = "seq", station_props: Sequence[str] | None = None,
                fire_props: Sequence[str] | None = None) -> DataFrame | None:
    """Station points, fire circles, and a line from every fire coordinate to its nearest station.

    ``by_network`` makes one map per network: only stations of the fire's network are looked at.
    """
    layers = []
    if stations is not None:
        layers.append(station_features(stations, by_network, station_props))
    if fires is not None:
        layers.append(fire_features(fires, by_network, props=fire_props))
    if stations is not None and fires is not None:
        lines = nearest_station(
            with_standard_coordinates(fires), with_standard_coordinates(stations), order=order,
            within=("network",) if by_network else ())
        layers.append(_features(lines, F.lit(LINES), by_network, to=("station_lat", "station_lon")))
    if not layers:
        return None
    table = layers[0]
    for layer in layers[1:]:
        table = table.unionByName(layer)
    return table


def yearly_fire_layers(fires: DataFrame, by_network: bool = False, props: Sequence[str] | None = None) -> DataFrame:
    """One layer per year: a fire is in the years it starts or ends in, not in the years between."""
    years = F.array_distinct(F.array_compact(F.array(F.year("start"), F.year("end"))))
    shown = fires.withColumn("__props", attributes(fires, props))
    rows = with_standard_coordinates(shown).withColumn("__year", F.explode(years))
    return _features(rows, F.col("__year").cast("string"), by_network, _radius(rows, True), props=F.col("__props"))
