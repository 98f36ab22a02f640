"""Nearest station, coordinates, layers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import table
from gustline.functions import geo
from gustline.functions.popup import attributes, display_name
from gustline.operators import nearest, profile
from gustline.operators.nearest import nearest_station
from gustline.plans import layers


def brute(points, stations):
    found = {}
    for lat, lon in points:
        found[(lat, lon)] = min((math.sqrt((lat - a) ** 2 + (lon - b) ** 2), s) for s, a, b in stations)
    return found


def frames(spark, points, stations):
    return (spark.createDataFrame(points, "lat double, lon double"),
            spark.createDataFrame(stations, "seq bigint, lat double, lon double"))


def uniform(rng, n):
    return [(rng.uniform(-60, 60), rng.uniform(-170, 170)) for _ in range(n)]


def clustered(rng, n):
    towns = uniform(rng, 3)
    return [(a + rng.gauss(0, 0.01), b + rng.gauss(0, 0.01)) for a, b in (rng.choice(towns) for _ in range(n - 1))] + [(0.0, 0.0)]


def on_a_line(rng, n):
    return [(37.5, rng.uniform(20, 28)) for _ in range(n)]


def rounded(rng, n):
    return [(float(rng.randint(30, 34)), float(rng.randint(20, 24))) for _ in range(n)]


@pytest.mark.parametrize("stations_of, points_of", [
    (uniform, uniform), (clustered, uniform), (clustered, clustered), (on_a_line, uniform), (rounded, rounded), (uniform, clustered)])
@pytest.mark.parametrize("count", [1, 150])
def test_nearest_equals_brute_force(spark, stations_of, points_of, count):
    rng = random.Random(count)
    stations = [(i, *p) for i, p in enumerate(stations_of(rng, count))]
    points = points_of(rng, 200)
    points += points[:50]
    found = nearest_station(*frames(spark, points, stations))
    expected = brute(points, stations)
    assert found.count() == len(expected)
    for r in found.collect():
        distance, seq = expected[(r.lat, r.lon)]
        assert abs(r.distance - distance) < 1e-12
        assert (r.station_lat, r.station_lon) == stations[r.seq][1:]
        if abs(r.distance - distance) == 0:
            assert r.seq == seq


def test_tie_goes_to_the_first_station(spark):
    found = nearest_station(*frames(spark, [(0.0, 0.0)], [(5, 2.0, 0.0), (3, 0.0, 2.0), (4, 0.0, -2.0), (9, 0.0, 2.0)]))
    assert [(r.seq, r.distance) for r in found.collect()] == [(3, 2.0)]


def test_far_points_and_missing_coordinates(spark):
    points = [(1e9, -1e9), (-5000.0, 3.0), (None, 1.0), (50.0, 20.0)]
    stations = [(1, 10.0, 10.0), (2, 60.0, 20.0), (3, None, None)]
    found = {(r.lat, r.lon): r.seq for r in nearest_station(*frames(spark, points, stations)).collect()}
    assert found == {(1e9, -1e9): 2, (-5000.0, 3.0): 1, (50.0, 20.0): 2}


def test_no_stations_or_points(spark):
    p, s = frames(spark, [(1.0, 1.0)], [(1, 1.0, 1.0)])
    assert nearest_station(p, s.limit(0)).count() == 0
    assert nearest_station(p.limit(0), s).count() == 0


def test_hot_place_and_own_network(spark):
    rng = random.Random(8)
    stations = [(i, "AB"[i % 2], *p) for i, p in enumerate(uniform(rng, 60))]
    points = [("A", 3.0, 3.0)] * 3000 + [(rng.choice("ABC"), *p) for p in uniform(rng, 300)]
    p = spark.createDataFrame(points, "network string, lat double, lon double")
    s = spark.createDataFrame(stations, "seq bigint, network string, lat double, lon double")
    found = {(r.network, r.lat, r.lon): r.distance for r in nearest_station(p, s, within=("network",)).collect()}
    expected = {}
    for n in "AB":
        mine = {(a, b) for m, a, b in points if m == n}
        expected |= {(n, *k): v[0] for k, v in brute(mine, [(i, a, b) for i, m, a, b in stations if m == n]).items()}
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-12 for k in found)


def test_by_key_and_carried_columns(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0)], "fire int, lat double, lon double")
    s = spark.createDataFrame([(1, 1.0, 1.0, "X")], "seq bigint, lat double, lon double, sid string")
    found = nearest_station(p, s, by=("fire",), carry=("sid",))
    assert table(found.select("fire", "sid"), "fire") == [(1, "X"), (2, "X")]


@pytest.mark.parametrize("low, high", [((0, 0), (10, 10)), ((0, 11), (10, 21)), ((11, 11), (15, 15)), ((-1e4, 1e3), (1e4, 1e4))])
def test_rows_of_every_join_stay_near_linear(spark, monkeypatch, low, high):
    """Points inside, beside, diagonal to and far from the stations: each join yields a bounded number of rows a unit."""
    rng = random.Random(4)
    stations = [(i, rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(3000)]
    points = [(rng.uniform(low[0], high[0]), rng.uniform(low[1], high[1])) for _ in range(500)]
    joins, possible = [], nearest._possible
    monkeypatch.setattr(nearest, "_possible", lambda met, *a: joins.append(met) or possible(met, *a))
    found = {(r.lat, r.lon): r.distance for r in nearest_station(*frames(spark, points, stations)).collect()}
    assert all(met.count() <= 40 * len(points) for met in joins)
    places = np.array([s[1:] for s in stations])
    for p in points:
        expected = np.sqrt(((places - np.array(p)) ** 2).sum(axis=1)).min()
        assert abs(found[p] - expected) <= 1e-12 * max(1.0, expected)


def test_plan_has_no_cross_join(spark):
    rng = random.Random(0)
    plan = nearest_station(*frames(spark, uniform(rng, 50), [(i, *p) for i, p in enumerate(uniform(rng, 20))]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def snyder(easting, northing, zone):
    """Inverse by the footpoint latitude, another derivation than the library's."""
    a, f = geo.SEMI_MAJOR, geo.FLATTENING
    e2 = f * (2 - f)
    ep2, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = northing / 0.9996 / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    phi = (mu + (3 * e1 / 2 - 27 * e1**3 / 32) * math.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * math.sin(4 * mu)
           + 151 * e1**3 / 96 * math.sin(6 * mu) + 1097 * e1**4 / 512 * math.sin(8 * mu))
    n1, t1, c1 = a / math.sqrt(1 - e2 * math.sin(phi) ** 2), math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2
    r1 = a * (1 - e2) / (1 - e2 * math.sin(phi) ** 2) ** 1.5
    d = (easting - 500000) / (n1 * 0.9996)
    lat = phi - n1 * math.tan(phi) / r1 * (d**2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1**2 - 9 * ep2) * d**4 / 24
                                           + (61 + 90 * t1 + 298 * c1 + 45 * t1**2 - 252 * ep2 - 3 * c1**2) * d**6 / 720)
    lon = (d - (1 + 2 * t1 + c1) * d**3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1**2 + 8 * ep2 + 24 * t1**2) * d**5 / 120) / math.cos(phi)
    return math.degrees(lat), 6 * zone - 183 + math.degrees(lon)


def test_utm_against_another_series(spark):
    rng = random.Random(6)
    rows = [(rng.uniform(250000, 750000), rng.uniform(0, 6.5e6)) for _ in range(200)]
    df = spark.createDataFrame(rows, "e double, n double")
    lat, lon = geo.utm_to_latlon(34, F.col("e"), F.col("n"))
    for r in df.select("e", "n", lat.alias("lat"), lon.alias("lon")).collect():
        assert np.allclose((r.lat, r.lon), snyder(r.e, r.n, 34), rtol=0, atol=1e-6)


def test_utm_halves_and_limits(spark):
    df = spark.createDataFrame([(500000.0, 4649776.0), (99999.0, 1.0), (1e6, 1.0), (500000.0, -1.0)], "e double, n double")

    def at(**options):
        lat, lon = geo.utm_to_latlon(33, F.col("e"), F.col("n"), **options)
        return [(r[0] and round(r[0], 4), r[1]) for r in df.select(lat, lon).collect()]

    north, south = at(), at(northern=False)
    assert abs(north[0][0] - 42.0) < 0.01 and north[0][1] == 15.0 and north[1:] == [(None, None)] * 3
    assert south[0][0] < 0 and at(zone_letter="T", northern=False) == north and at(zone_letter="h") == south
    lat, _ = geo.utm_to_latlon(61, F.col("e"), F.col("n"))
    assert df.select(lat).first()[0] is None


def test_radius(spark):
    df = spark.createDataFrame([(56133.0,), (12759.0,), (4.0,), (None,)], "s double")
    assert [round(r[0], 4) for r in df.select(geo.spread_radius(F.col("s"))).collect()] == [11846.2019, 5647.7872, 100.0, 1.0]


def test_coordinate_names():
    assert geo.coordinate_columns(["latitude", "long", "lng"]) == ("latitude", "long")
    assert geo.coordinate_columns(["lat_fire", "lon_fire"], "_fire") == ("lat_fire", "lon_fire")
    assert geo.coordinate_columns(["lat"]) is None


FIRES = [("N", "f1", 38.0, 23.0, 1.0, "2018-07-01", "2020-01-02"), ("N", "f2", 39.0, 24.0, None, "2018-08-01", None)]
STATIONS = [(1, "S1", "N", 38.1, 23.1, "1990-01-01", None), (2, "S2", "M", 38.0, 23.0, "1990-01-01", "2001-01-01")]


def dims(spark):
    fires = spark.createDataFrame(FIRES, "network string, name string, lat double, lon double, spread double, start string, end string")
    stations = spark.createDataFrame(STATIONS, "seq bigint, sid string, network string, lat double, lon double, start string, end string")
    dated = [df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")}) for df in (stations, fires)]
    return dated


def test_layers(spark):
    stations, fires = dims(spark)
    whole = layers.info_layers(stations, fires)
    assert dict(table(whole.groupBy("layer").count())) == {"Stations": 2, "Fires": 2, "Nearest Stations": 2}
    assert {(r.lat, r.lat2) for r in whole.where("layer = 'Nearest Stations'").collect()} == {(38.0, 38.0), (39.0, 38.1)}
    own = layers.info_layers(stations, fires, by_network=True).where("layer = 'Nearest Stations'")
    assert {(r.network, r.lat, r.lat2) for r in own.collect()} == {("N", 38.0, 38.1), ("N", 39.0, 38.1)}
    assert sorted(r.radius_m for r in whole.where("layer = 'Fires'").collect()) == [1.0, 50.0]
    props = whole.where("layer = 'Stations' and lat = 38.1").first().props
    assert props["ID"] == "S1" and props["Start"] == "1990" and "End" not in props
    assert layers.info_layers(stations).count() == 2 and layers.info_layers() is None


def test_years_skip_the_middle(spark):
    _, fires = dims(spark)
    assert table(layers.yearly_fire_layers(fires).select("layer", "lat"), "layer", "lat") == [("2018", 38.0), ("2018", 39.0), ("2020", 38.0)]
    assert table(profile.interval_years(fires)) == [(2018,), (2020,)]


def test_attribute_names(spark):
    assert [display_name(c) for c in ("sname", "tzname", "lon", "longitude", "elevation")] == [
        "Name", "Timezone", "Longitude", "Longitude", "Elevation"]
    df = spark.createDataFrame([("x", None)], "state string, county string")
    assert df.select(attributes(df)).first()[0] == {"State": "x"}
