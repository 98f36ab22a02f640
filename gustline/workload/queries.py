"""Registered queries and their SQL, by operator family. Every query runs over its whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustline.functions import encode, geo, text, timeline
from gustline.functions.describe import describe_columns, descriptions
from gustline.functions.popup import attributes
from gustline.operators import cluster, dedup, dtw, fill, holdout, nearest, profile, resample, scale, select, smooth, smooth_long, split
from gustline.plans import layers, reports, stages
from gustline.plans.clean import SERIES_START, clean
from gustline.schema import KEYS, MAIN_COLUMNS, RULES, report_type
from gustline.sources import documents, payloads, sinks, tables
from gustline.sources import text as files
from gustline.storage import materialize, scratch_path
from gustline.workload import oracle as O
from gustline.workload import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_MAIN = list(O.MAIN)
_ALL = list(O.ALL)
_SERIES = (*KEYS, "column", "day")


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function
    return register


def r6(column: Column | str) -> Column:
    """Same rounding as in the SQL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.floor(c * F.lit(1e6) + F.lit(0.501)) / F.lit(1e6)


def rounded(df: DataFrame, columns) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def flat(df: DataFrame, values: str = "values") -> DataFrame:
    """One row per slot, rounded."""
    kept = [c for c in df.columns if c != values]
    return df.select(*kept, F.posexplode(values).alias("slot", "value")).select(
        *kept, F.col("slot").cast("bigint").alias("slot"), r6("value").alias("value"))


def ts(text_: str) -> str:
    return f"TIMESTAMP '{text_}'"


# === scans, sources, sinks ===========================================================================

_SINCE, _UNTIL, _AS_OF = "1997-01-01 00:00:00", "2000-06-30 00:00:00", "2024-01-01 00:00:00"
_CELLS = ", ".join(O.ALL)


@query("q_scan_obs", O.chain(O.observations(), final=f"""
    SELECT network, station, valid, {', '.join(O.MAIN)} FROM obs
    WHERE valid BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"""))
def scan_obs(spark, folder):
    path = scratch_path(spark, "fetched")
    sinks.write_observations(V.obs(spark, folder), path)
    return tables.scan_observations(spark, path, since="2024-01-05 00:00:00", until="2024-01-20 12:00:00", main=True)


@query("q_sink_roundtrip", O.chain(O.observations(), final=f"SELECT network, station, valid, src_seq, {_CELLS} FROM obs"))
def sink_roundtrip(spark, folder):
    path = scratch_path(spark, "fetched")
    sinks.write_observations(V.obs(spark, folder), path)
    return tables.read_stored(spark, path)


@query("q_network_info", """SELECT concat('NET_', CAST(n_nationkey AS VARCHAR)) AS network, n_name AS network_name
    FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def network_info(spark, folder):
    nations = V.table(spark, folder, "nation").selectExpr(
        "concat('NET_', cast(n_nationkey as string)) as network", "n_name as network_name")
    path = scratch_path(spark, "networks")
    sinks.write_networks(nations, path)
    return tables.read_networks(spark, path, networks=V.stations(spark, folder).select("network"))


_OVERLAP = """("start" BETWEEN {a} AND {b} OR {end} BETWEEN {a} AND {b} OR ("start" < {a} AND {end} > {b}))"""


def overlap_sql(end: str) -> str:
    return _OVERLAP.format(a=ts(_SINCE), b=ts(_UNTIL), end=end)


_OPEN = overlap_sql(f'coalesce("end", {ts(_AS_OF)})')


@query("q_station_info", O.chain(O.STATIONS, final=f"""
    SELECT sid, network, "start", "end", lat, lon FROM stations WHERE {_OPEN}"""))
def station_info(spark, folder):
    path = scratch_path(spark, "stations")
    filed = V.stations(spark, folder)
    for c in ("elevation", "sname", "state", "country", "tzname", "county"):
        filed = filed.withColumn(c, F.lit(None).cast("string"))
    order = tables.S.STATION_FILE.names
    sinks.write_stations(filed.select(*order), path)
    found = tables.read_stations(spark, path, since=_SINCE, until=_UNTIL, as_of=_AS_OF)
    return found.select("sid", "network", "start", "end", "lat", "lon")


@query("q_fire_info", O.chain(O.FIRES, final=f"""
    SELECT network, lat, lon, "start", "end", spread FROM fires WHERE {overlap_sql('"end"')} AND spread >= 50e0"""))
def fire_info(spark, folder):
    path = scratch_path(spark, "fires")
    filed = V.fires(spark, folder)
    for c in ("country", "state", "location", "cause"):
        filed = filed.withColumn(c, F.lit(None).cast("string"))
    sinks.write_fires(filed.select(*tables.S.FIRES.names), path)
    return tables.read_fires(spark, path, main=True, since=_SINCE, until=_UNTIL, least_spread=50)


@query("q_select_config", O.chain(O.STATIONS, final="""
    SELECT sid, network FROM stations WHERE network IN (
      SELECT upper(trim(concat('  net_', CAST(n_nationkey AS VARCHAR), ' '))) FROM nation)"""))
def select_config(spark, folder):
    lines = V.table(spark, folder, "nation").selectExpr("concat('  net_', cast(n_nationkey as string), ' ') as value")
    path = scratch_path(spark, "selection")
    lines.unionByName(lines.selectExpr("'   ' as value")).write.text(path)
    chosen = files.read_selection(spark, path, "network")
    return tables.station_info(V.stations(spark, folder), networks=chosen, main=True)


@query("q_select_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN o_orderdate
      ELSE CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS valid FROM orders""")
def select_dates(spark, folder):
    orders = V.table(spark, folder, "orders")
    lines = orders.selectExpr("o_orderkey", """concat(' ', CASE o_orderkey % 4
        WHEN 0 THEN date_format(o_orderdate, 'yyyy/MM/dd HH:mm:ss') WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy HH:mm:ss')
        WHEN 2 THEN date_format(o_orderdate, 'yyyy/MM/dd') ELSE date_format(o_orderdate, 'dd/MM/yyyy') END, ' ') as value""")
    return lines.select("o_orderkey", timeline.parse_date(F.col("value")).alias("valid"))


@query("q_text_items", """
    SELECT CAST(event_id AS VARCHAR) AS first, event_type AS second, 2 AS parts FROM events""")
def text_items(spark, folder):
    events = V.table(spark, folder, "events")
    items = events.select(F.array(F.col("event_id").cast("string"), "event_type").alias("values"))
    path = scratch_path(spark, "items") + ".txt"
    files.write_table(items, path, sep=";")
    back = files.read_table(spark, path, sep=";")
    return back.select(F.col("values")[0].alias("first"), F.col("values")[1].alias("second"), F.size("values").alias("parts"))


@query("q_json_docs", """
    SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events""")
def json_docs(spark, folder):
    parsed = files.parse_json(V.table(spark, folder, "events").select("event_id", "props"), "props", "k bigint")
    path = scratch_path(spark, "documents") + ".json"
    files.write_table(parsed, path)
    return files.read_table(spark, path, schema="event_id bigint, k bigint", lines=True)


@query("q_matrix_text", f"""
    SELECT vec_id, slot, {O.r6('CAST(embedding[slot + 1] AS DOUBLE)')} AS value
    FROM embeddings, (SELECT unnest(range(64)) AS slot) s""")
def matrix_text(spark, folder):
    rows = V.table(spark, folder, "embeddings").select(F.concat(
        F.array(F.col("vec_id").cast("double")), F.col("embedding").cast("array<double>")).alias("values"))
    path = scratch_path(spark, "matrix")
    files.write_matrix(rows, path)
    back = files.read_table(spark, path, kind="matrix")
    return flat(back.select(F.col("values")[0].cast("bigint").alias("vec_id"),
                            F.slice("values", 2, F.size("values") - 1).alias("values")))


def _plain_sql(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{character}')"
    return x


_LINK = r"""(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>"""


@query("q_html_options", f"""
    SELECT page_id, position, {_plain_sql('v[position + 1]')} AS value, {_plain_sql('t[position + 1]')} AS text
    FROM (SELECT page_id, v, t, unnest(range(len(v))) AS position FROM (
      SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS v, regexp_extract_all(html, '{_LINK}', 2) AS t FROM pages) a) b""")
def html_options(spark, folder):
    found = documents.html_pairs(V.table(spark, folder, "pages"), "html", "a", "href", keep=["page_id"])
    return found.withColumn("position", F.col("position").cast("bigint"))


@query("q_option_list", "SELECT concat('NET_', CAST(n_nationkey AS VARCHAR)) AS network, concat(n_name, ' <&> \"', CAST(n_regionkey AS VARCHAR), '\"') AS network_name FROM nation")
def option_list(spark, folder):
    """Selection pages, one a region, with an option for every nation."""
    option = F.concat(F.lit('<option class="n" value="NET_'), F.col("n_nationkey").cast("string"), F.lit('">\n<b>'),
                      F.col("n_name"), F.lit("</b> &lt;&amp;&gt; &quot;"), F.col("n_regionkey").cast("string"), F.lit("&quot;</option>"))
    pages = V.table(spark, folder, "nation").groupBy("n_regionkey").agg(
        F.concat(F.lit("<form><select name=n>"), F.array_join(F.collect_list(option), "\n"), F.lit("</select></form>")).alias("page"))
    found = documents.network_options(pages, "page")
    return found.withColumn("network_name", F.trim(F.regexp_replace("network_name", "^\\s+", "")))


def _geojson(spark, folder) -> DataFrame:
    """Documents of station features, a bounded number of stations in each."""
    s = V.stations(spark, folder)
    properties = F.struct(
        F.lit(12.5).alias("elevation"), F.concat(F.lit("Field  "), F.col("sid")).alias("sname"),
        F.lit("A B").alias("state"), F.lit(" GR").alias("country"), F.lit("UTC").alias("tzname"),
        F.lit(None).cast("string").alias("county"), "sid", "network",
        F.concat(F.lit("("), F.year("start").cast("string"), F.lit("-"),
                 F.coalesce(F.year("end").cast("string"), F.lit("Now")), F.lit(")")).alias("time_domain"),
        F.lit("x").alias("wfo"))
    feature = F.struct(properties.alias("properties"), F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"))
    return s.groupBy("network", F.floor(F.col("seq") / 50).alias("part")).agg(
        F.to_json(F.struct(F.count(F.lit(1)).alias("count"), F.collect_list(feature).alias("features"))).alias("document"))


@query("q_geojson_stations", O.chain(O.STATIONS, final="""
    SELECT 125e-1 AS elevation, concat('Field ', sid) AS sname, 'AB' AS state, 'GR' AS country, 'UTC' AS tzname,
      CAST(NULL AS VARCHAR) AS county, sid, network, CAST(year("start") AS VARCHAR) AS "start",
      coalesce(CAST(year("end") AS VARCHAR), '') AS "end", lat, lon FROM stations"""))
def geojson_stations(spark, folder):
    return documents.geojson_stations(_geojson(spark, folder), "document")


@query("q_union_stations", O.chain(O.STATIONS, final="""
    SELECT sid, network, lat, lon, "start" FROM stations UNION ALL
    SELECT c_name, concat('NET_', CAST(c_nationkey AS VARCHAR)), NULL, NULL, NULL FROM customer"""))
def union_stations(spark, folder):
    more = V.table(spark, folder, "customer").selectExpr(
        "c_name as sid", "concat('NET_', cast(c_nationkey as string)) as network")
    return documents.union_tables([V.stations(spark, folder).select("sid", "network", "lat", "lon", "start"), more])


def _payloads(spark, folder, time: str = "exact") -> DataFrame:
    """CSV texts of 200 reports each and, per text, one refused answer."""
    columns = ["station", "valid", *O.ALL, "metar"]
    cells = [F.col("station"), F.date_format("valid", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
             *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in O.ALL], F.lit('"A, B"')]
    line = V.obs(spark, folder, time=time).select(
        "network", "src_seq", F.floor(F.col("src_seq") / 200).alias("part"), F.concat_ws(",", *cells).alias("line"))
    head = F.lit(",".join(columns) + "\n")
    good = line.groupBy("network", "part").agg(F.concat(head, F.concat_ws("\n", F.transform(
        F.sort_array(F.collect_list(F.struct("src_seq", "line"))), lambda s: s["line"])), F.lit("\n")).alias("payload"))
    return good.unionByName(good.select("network", "part", F.concat(F.lit("ERROR: "), "payload").alias("payload")))


@query("q_payload_parse", O.chain(O.observations(), final=f"""
    SELECT network, station, valid, {', '.join("trim(skyc1) AS skyc1" if c == 'skyc1' else c for c in O.ALL)} FROM obs"""))
def payload_parse(spark, folder):
    return payloads.parse_payloads(_payloads(spark, folder), keep=["network"]).select("network", "station", "valid", *O.ALL)


_BASE = "http://service.example/reports?"


@query("q_request_manifest", O.chain(O.STATIONS, final=f"""
    SELECT network, sid, concat('{_BASE}data=all&report_type=2&tz=Etc/UTC&format=onlycomma&missing=empty&trace=empty&latlon=yes&',
      'year1=2018&month1=01&day1=01&hour1=00&minute1=00&year2=2022&month2=01&day2=01&hour2=06&minute2=30&&station=', sid) AS request
    FROM stations"""))
def request_manifest(spark, folder):
    return payloads.request_manifest(
        V.stations(spark, folder), _BASE, "2018-01-01 00:00:00", "2022-01-01 06:30:00", report="combined", latlon=True)


@query("q_request_all", f"""
    WITH e AS (SELECT min(ts) AS first, max(ts) AS last FROM events)
    SELECT concat('{_BASE}data=all&tz=Etc/UTC&format=onlycomma&missing=empty&trace=empty&',
      strftime(first, 'year1=%Y&month1=%m&day1=%d&hour1=%H&minute1=%M&'),
      strftime(first + INTERVAL 24 HOUR, 'year2=%Y&month2=%m&day2=%d&hour2=%H&minute2=%M&')) AS request FROM e""")
def request_all(spark, folder):
    """All stations at once: granted for a day from the first report on, refused for the whole range of the reports."""
    first, last = V.table(spark, folder, "events").agg(F.min("ts"), F.max("ts")).first()
    day = payloads.request_all(spark, _BASE, first, first + timedelta(days=1))
    return day.union(payloads.request_all(spark, _BASE, first, last)).union(
        payloads.request_all(spark, _BASE, first, first + timedelta(days=1, microseconds=1)))


@query("q_report_types", O.chain(O.observations(), final=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {'NULL' if kind is None else f"'{kind}'"} AS kind, count({c}) AS present FROM obs"""
    for c, kind in (("network", None), ("station", "string"), ("valid", "timestamp"), ("skyc1", "string"), ("src_seq", None),
                    *((c, "double") for c in O.ALL if c != "skyc1")))))
def report_types(spark, folder):
    """Type that a report's column is read with, beside the cells that the observations have of it."""
    counted = profile.missing_counts(V.obs(spark, folder), ["network", "station", "valid", "src_seq", *O.ALL])
    kinds = {c: report_type(c) for c in ("network", "station", "valid", "src_seq", *O.ALL)}
    known = F.create_map(*[x for c, k in kinds.items() for x in (F.lit(c), F.lit(k).cast("string"))])
    return counted.select("column", known[F.col("column")].alias("kind"), "present")


_EARLY = "TIMESTAMP '2024-01-15 00:00:00'"


@query("q_scaler_reuse", O.chain(*O.clean_steps(), ("early", f"SELECT * FROM clean WHERE network = 'NET_A' AND valid < {_EARLY}"),
    ("old", O.minmax_params(_MAIN, "early")[1]),
    ("new", O.minmax_params(_MAIN, "clean", "WHERE network <> 'NET_A'")[1]),
    final=f"""SELECT network, station, 'minmax' AS scaler, "column", {O.r6('center')} AS center, {O.r6('scale')} AS scale
      FROM (SELECT * FROM old UNION ALL SELECT * FROM new) p"""))
def scaler_reuse(spark, folder):
    table = materialize(clean(V.obs(spark, folder)), "clean")
    store = scratch_path(spark, "scalers")
    early = table.where("network = 'NET_A' and valid < timestamp_ntz'2024-01-15 00:00:00'")
    scale.stored_scaler(early, store, "minmax", "main")
    params = scale.stored_scaler(table, store, "minmax", "main")
    return rounded(params.select(*KEYS, "scaler", "column", "center", "scale"), ("center", "scale"))


# === projections and filters =========================================================================

@query("q_main_columns", O.chain(O.observations(), final=f"SELECT network, station, valid, {', '.join(O.MAIN)} FROM obs"))
def main_columns(spark, folder):
    return select.main_columns(V.obs(spark, folder))


_DROPPED = ("drct", "p01i", "vsby", "gust", "metar", "not_there")


@query("q_drop_columns", O.chain(O.observations(), final=f"""
    SELECT network, station, valid, src_seq, {', '.join(c for c in O.ALL if c not in _DROPPED)} FROM obs"""))
def drop_columns(spark, folder):
    return select.drop_columns(V.obs(spark, folder), _DROPPED)


@query("q_drop_allnull", O.chain(O.observations(), final="SELECT network, station, valid, tmpf, skyc1 FROM obs"))
def drop_allnull(spark, folder):
    df = V.obs(spark, folder).select(*KEYS, "valid", "tmpf", F.lit(None).cast("double").alias("mslp"), "skyc1",
                                     F.lit(None).cast("string").alias("wxcodes"))
    return select.drop_empty_columns(df)


@query("q_membership", O.chain(O.STATIONS, O.FIRES, final="""
    SELECT f.* FROM fires f WHERE network IN (SELECT network FROM stations) AND network IN ('NET_1', 'NET_2', 'NET_3')"""))
def membership(spark, folder):
    by_table = select.members(V.fires(spark, folder), "network", V.stations(spark, folder))
    return select.members(by_table, "network", ["NET_1", "NET_2", "NET_3"])


@query("q_overlap_open", O.chain(O.STATIONS, final=f"SELECT * FROM stations WHERE {_OPEN}"))
def overlap_open(spark, folder):
    return select.overlapping(V.stations(spark, folder), _SINCE, _UNTIL, open_end=True, as_of=_AS_OF)


@query("q_overlap_strict", O.chain(O.FIRES, final=f"""SELECT * FROM fires WHERE {overlap_sql('"end"')}"""))
def overlap_strict(spark, folder):
    return select.overlapping(V.fires(spark, folder), _SINCE, _UNTIL)


@query("q_min_spread", O.chain(O.FIRES, final="SELECT * FROM fires WHERE spread >= 100e0"))
def min_spread(spark, folder):
    return select.min_spread(V.fires(spark, folder), 100)


@query("q_indicator", O.chain(O.observations(), final="""
    SELECT src_seq, CASE WHEN p01i > 0 THEN 1e0 ELSE 0e0 END AS p01i, CASE WHEN gust > 0 THEN 1e0 ELSE 0e0 END AS gust FROM obs"""))
def indicator(spark, folder):
    return V.obs(spark, folder).select("src_seq", *[encode.positive_indicator(F.col(c)).alias(c) for c in ("p01i", "gust")])


_GATED = ("tmpf", "relh", "skyc1", "mslp", "station")


@query("q_column_gates", O.chain(O.observations(), ("g", "SELECT *, CAST(NULL AS DOUBLE) AS mslp FROM obs"), final=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {'false' if c in ('skyc1', 'station') else 'true'} AS is_numeric,
        count(DISTINCT {c}) <= 50 AS has_few_values, count({c}) = 0 AS is_empty FROM g""" for c in _GATED)))
def column_gates(spark, folder):
    return profile.column_gates(V.obs(spark, folder).withColumn("mslp", F.lit(None).cast("double")), _GATED)


# === joins ===========================================================================================

def _nearest_sql(match: str, keys: str, points: str = "fires") -> str:
    return f"""SELECT {keys}, arg_min(seq, (d, seq)) AS seq, arg_min(slat, (d, seq)) AS station_lat,
        arg_min(slon, (d, seq)) AS station_lon, {O.r6('min(d)')} AS distance FROM (
        SELECT {', '.join('f.' + k.strip() for k in keys.split(','))}, s.seq, s.lat AS slat, s.lon AS slon,
          sqrt((f.lat - s.lat) * (f.lat - s.lat) + (f.lon - s.lon) * (f.lon - s.lon)) AS d
        FROM (SELECT DISTINCT {keys} FROM {points}) f JOIN stations s ON {match}) x GROUP BY {keys}"""


@query("q_nearest", O.chain(O.STATIONS, O.FIRES, final=_nearest_sql("true", "lat, lon")))
def nearest_station(spark, folder):
    return rounded(nearest.nearest_station(V.fires(spark, folder), V.stations(spark, folder)), ("distance",))


@query("q_nearest_outside", O.chain(O.STATIONS, O.FIRES, ("far", """SELECT lat + (fire_id % 4) * 15e0 AS lat,
    lon - (fire_id % 3) * 400e0 AS lon FROM fires"""), final=_nearest_sql("true", "lat, lon", "far")))
def nearest_outside(spark, folder):
    far = V.fires(spark, folder).select(F.expr("lat + (fire_id % 4) * 15e0").alias("lat"), F.expr("lon - (fire_id % 3) * 400e0").alias("lon"))
    return rounded(nearest.nearest_station(far, V.stations(spark, folder)), ("distance",))


@query("q_nearest_by_network", O.chain(O.STATIONS, O.FIRES, final=_nearest_sql("f.network = s.network", "network, lat, lon")))
def nearest_by_network(spark, folder):
    found = nearest.nearest_station(V.fires(spark, folder), V.stations(spark, folder), within=("network",))
    return rounded(found, ("distance",))


@query("q_station_lookup", O.chain(O.STATIONS, final="""
    SELECT l_orderkey, l_linenumber, sid AS station, network FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN stations ON s_name = sid"""))
def station_lookup(spark, folder):
    rows = V.table(spark, folder, "lineitem").join(
        V.table(spark, folder, "supplier").selectExpr("s_suppkey as l_suppkey", "s_name as station"), "l_suppkey")
    return tables.with_network(rows.select("l_orderkey", "l_linenumber", "station"), V.stations(spark, folder)).select(
        "l_orderkey", "l_linenumber", "station", "network")


_SPLIT_STEPS = [*O.clean_steps(), O.long_rows(), *O.SPLIT]
_LABEL = "(day(day) + length(\"column\") + 3) % 5"


def _split(spark, folder, smoothed: bool = False) -> DataFrame:
    return stages.split_days(clean(V.obs(spark, folder), with_start=True), start=SERIES_START, smooth=smoothed)


def _labels(rows: DataFrame) -> DataFrame:
    return rows.select(*_SERIES, ((F.day("day") + F.length("column") + 3) % 5).alias("cluster"))


@query("q_align_columns", O.chain(*_SPLIT_STEPS, final="SELECT network, station, day, " + ", ".join(
    f"max(CASE WHEN \"column\" = '{c}' THEN CAST({_LABEL} AS INT) END) AS {c}" for c in O.MAIN) + " FROM split GROUP BY 1, 2, 3"))
def align_columns(spark, folder):
    return cluster.align_labels(_labels(_split(spark, folder)), MAIN_COLUMNS)


@query("q_cluster_members", O.chain(*_SPLIT_STEPS, final=f"""
    SELECT network, station, "column", day, slot, CAST({_LABEL} AS INT) AS cluster, {O.r6('value')} AS value FROM cells"""))
def cluster_members(spark, folder):
    rows = materialize(_split(spark, folder), "split")
    return flat(cluster.with_labels(rows, _labels(rows)))


@query("q_scale_stored", O.chain(*O.clean_steps(), ("early", f"SELECT * FROM clean WHERE valid < {_EARLY}"),
    O.minmax_params(_MAIN, "early"), O.scaled_wide(_MAIN), final=O.rounded(_MAIN, source="scaled")))
def scale_stored(spark, folder):
    table = materialize(clean(V.obs(spark, folder)), "clean")
    params = scale.fit_scaler(table.where("valid < timestamp_ntz'2024-01-15 00:00:00'"))
    # An extra column is not in the fit and is dropped.
    return rounded(scale.apply_scaler(table.withColumn("extra", F.lit(1.0)), params), _MAIN)


# === aggregations ====================================================================================

@query("q_resample_hourly", O.chain(O.observations(), O.encoded(_ALL), O.buckets(_ALL), final=O.rounded(_ALL, source="hourly")))
def resample_hourly(spark, folder):
    return rounded(resample.resample(_encoded(spark, folder), dense=False), _ALL)


def _encoded(spark, folder, station: str = "type") -> DataFrame:
    return V.obs(spark, folder, station).withColumns({
        "skyc1": encode.ordinal_code(F.col("skyc1")),
        **{c: encode.positive_indicator(F.col(c)) for c in ("p01i", "gust")}})


def _method(c: str) -> str:
    return "linear" if c in O.MEANS else "zero" if c in ("p01i", "gust") else "ffill_bfill"


def _regular(columns, label: str, steps: str, source: str = O.FROM_FIRST, first=(O.observations(), O.encoded(O.ALL))) -> str:
    """Dense and filled buckets named by ``label``, of the steps ``steps``."""
    def filled(c: str) -> str:
        how = {"linear": O.linear, "zero": lambda x: f"coalesce({x}, 0e0)", "ffill_bfill": O.both_fills}[_method(c)]
        return f"{how(c)} AS {c}"
    return O.chain(*first, O.buckets(columns, source, label), O.grid(columns, steps),
                   ("filled", f"SELECT network, station, valid, {', '.join(map(filled, columns))} FROM grid"),
                   final=O.rounded(columns, source="filled"))


def _regularly(df: DataFrame, columns, frequency: str) -> DataFrame:
    rules = {c: RULES[c] for c in columns}
    return rounded(fill.resample_filled(df, rules, {c: _method(c) for c in columns}, frequency), columns)


_MIDNIGHT = "date_trunc('day', first)"


@query("q_resample_5h", _regular(
    _ALL, f"{_MIDNIGHT} + to_hours(5 * CAST(floor((epoch(valid) - epoch({_MIDNIGHT})) / 18000) AS BIGINT))",
    "generate_series(min(valid), max(valid), INTERVAL 5 HOUR)"))
def resample_5h(spark, folder):
    """A width that does not divide a day: buckets begin at the midnight before a station's first report."""
    return _regularly(_encoded(spark, folder), _ALL, "5h")


_SUNDAY = "date_trunc('week', {}) + INTERVAL 6 DAY"


@query("q_resample_2week", _regular(
    _ALL, f"{_SUNDAY.format('first')} + to_days(14 * CAST(ceil(date_diff('day', {_SUNDAY.format('first')}, "
          f"{_SUNDAY.format('valid')}) / 14) AS INT))", "generate_series(min(valid), max(valid), INTERVAL 14 DAY)"))
def resample_2week(spark, folder):
    """Pairs of calendar weeks, named by their last Sunday, from the week of a station's first report."""
    return _regularly(_encoded(spark, folder), _ALL, "2W")


_ORDERED = ["tmpf", "skyl1", "gust"]
_ORDER_SERIES = """SELECT 'orders' AS network, CAST(o_custkey AS VARCHAR) AS station, o_orderdate::TIMESTAMP AS valid,
    CAST(o_totalprice AS DOUBLE) AS tmpf, CAST(o_totalprice AS DOUBLE) AS skyl1, CAST(o_totalprice AS DOUBLE) AS gust FROM orders"""


def _order_series(spark, folder) -> DataFrame:
    """Orders of a customer as a series of years with long gaps."""
    price = F.col("o_totalprice").cast("double")
    return V.table(spark, folder, "orders").select(
        F.lit("orders").alias("network"), F.col("o_custkey").cast("string").alias("station"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("valid"), *[price.alias(c) for c in _ORDERED])


@query("q_resample_month", _regular(
    _ORDERED, "last_day(valid)", "list_transform(generate_series(date_trunc('month', min(valid)), max(valid), INTERVAL 1 MONTH), "
    "lambda m: last_day(m))", "enc", [("enc", _ORDER_SERIES)]))
def resample_month(spark, folder):
    """Calendar months, named by their last day; lines are drawn over steps of unequal length."""
    return _regularly(_order_series(spark, folder), _ORDERED, "M")


@query("q_resample_2quarter", _regular(
    _ORDERED, "date_trunc('quarter', first) + to_months(6 * CAST(floor(date_diff('quarter', first, valid) / 2) AS INT))",
    "generate_series(min(valid), max(valid), INTERVAL 6 MONTH)", O.FROM_FIRST, [("enc", _ORDER_SERIES)]))
def resample_2quarter(spark, folder):
    """Pairs of quarters, named by their first day, from the quarter of the first order."""
    return _regularly(_order_series(spark, folder), _ORDERED, "2QS")


_FILL_SQL = [O.observations("user"), O.encoded(_ALL), O.buckets(_ALL), O.grid(_ALL)]


@query("q_dense_grid", O.chain(*_FILL_SQL, final=O.rounded(_ALL, source="grid")))
def dense_grid(spark, folder):
    return rounded(resample.resample(_encoded(spark, folder, "user")), _ALL)


_PARAMS = f"""SELECT network, station, "column", {O.r6('center')} AS center, {O.r6('scale')} AS scale FROM params"""


def _params(params: DataFrame) -> DataFrame:
    return rounded(params.select(*KEYS, "column", "center", "scale"), ("center", "scale"))


_NUMERIC = ["tmpf", "dwpf", "relh", "drct", "sknt", "p01i", "vsby", "gust", "skyl1", "feel"]


@query("q_fit_minmax", O.chain(O.observations("user"), O.minmax_params(_NUMERIC, "obs"), final=_PARAMS))
def fit_minmax(spark, folder):
    return _params(scale.fit_scaler(V.obs(spark, folder, "user"), "minmax", _NUMERIC))


@query("q_fit_standard", O.chain(O.observations("user"), O.standard_params(_NUMERIC, "obs"), final=_PARAMS))
def fit_standard(spark, folder):
    return _params(scale.fit_scaler(V.obs(spark, folder, "user"), "standard", _NUMERIC))


_MONTHS = """SELECT 'o_totalprice' AS "column", date_trunc('month', o_orderdate)::TIMESTAMP AS period, avg(o_totalprice) AS value
    FROM orders GROUP BY 2"""
_QUARTERS = _MONTHS.replace("month", "quarter")


def _orders(spark, folder) -> DataFrame:
    return V.table(spark, folder, "orders")


@query("q_monthly", O.chain(("m", _MONTHS), final=f"""
    SELECT "column", period, {O.r6('value')} AS value, strftime(period, '%b') AS month, CAST(year(period) AS INT) AS year,
      {O.r6('(month(period) - 1) * (2 * pi()) / 12')} AS angle FROM m"""))
def monthly(spark, folder):
    return rounded(profile.monthly(_orders(spark, folder), ["o_totalprice"], time="o_orderdate"), ("value", "angle"))


@query("q_quarterly", O.chain(("m", _QUARTERS), final=f"""
    SELECT "column", period, {O.r6('value')} AS value, CAST(quarter(period) AS INT) AS quarter,
      CAST(year(period) AS INT) AS year FROM m"""))
def quarterly(spark, folder):
    return rounded(profile.quarterly(_orders(spark, folder), ["o_totalprice"], time="o_orderdate"), ("value",))


_COMPLETE = ("whole", """SELECT (max(year(period) * 12 + month(period)) - min(year(period) * 12 + month(period)) + 1 = count(*))
    AND count(DISTINCT month(period)) = 12 AND count(DISTINCT year(period)) > 1 AS ok FROM m""")


@query("q_seasonal_month", O.chain(("m", _MONTHS), _COMPLETE, final=f"""
    SELECT "column", CAST(month(period) AS INT) AS month, CAST(year(period) AS INT) AS year, {O.r6('value')} AS value,
      {O.r6('avg(value) OVER (PARTITION BY month(period))')} AS season_mean FROM m WHERE (SELECT ok FROM whole)"""))
def seasonal_month(spark, folder):
    return rounded(profile.seasonal_months(_orders(spark, folder), ["o_totalprice"], time="o_orderdate"), ("value", "season_mean"))


@query("q_seasonal_quarter", O.chain(("m", _MONTHS), _COMPLETE, ("s", _QUARTERS), final=f"""
    SELECT "column", CAST(quarter(period) AS INT) AS quarter, CAST(year(period) AS INT) AS year, {O.r6('value')} AS value,
      {O.r6('avg(value) OVER (PARTITION BY quarter(period))')} AS season_mean FROM s WHERE (SELECT ok FROM whole)"""))
def seasonal_quarter(spark, folder):
    return rounded(profile.seasonal_quarters(_orders(spark, folder), ["o_totalprice"], time="o_orderdate"), ("value", "season_mean"))


@query("q_missing_counts", O.chain(O.observations(), final=" UNION ALL ".join(
    f"""SELECT network, station, '{c}' AS "column", count({c}) AS present, count(*) - count({c}) AS missing FROM obs GROUP BY 1, 2"""
    for c in O.ALL)))
def missing_counts(spark, folder):
    return profile.missing_counts(V.obs(spark, folder), _ALL, KEYS)


_PROFILED = _NUMERIC
_VALUES = ("vals", " UNION ALL ".join(f"""SELECT '{c}' AS "column", {c} AS value FROM obs WHERE {c} IS NOT NULL""" for c in _PROFILED))
_QUARTILES = ("quart", """SELECT "column", count(*) AS rows, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
    quantile_cont(value, 0.75) AS q3, min(value) AS low, max(value) AS high, avg(value) AS mean FROM vals GROUP BY 1""")
_BINS = ("bins", """SELECT "column", low, (high - low) / n AS width, n FROM (
    SELECT *, CAST(ceil(round((high - low) / CASE WHEN 2 * (q3 - q1) / power(rows * 1e0, 1e0 / 3e0) > 0
      THEN least(2 * (q3 - q1) / power(rows * 1e0, 1e0 / 3e0), (high - low) / (log2(rows * 1e0) + 1))
      ELSE (high - low) / (log2(rows * 1e0) + 1) END, 9)) AS BIGINT) AS n FROM quart) q""")
_HIST = ("hist", """SELECT "column", bin, min(low + bin * width) AS bin_start, min(width) AS bin_width, count(*) AS n FROM (
    SELECT v."column", low, width, CAST(least(floor((value - low) / width), b.n - 1) AS BIGINT) AS bin
    FROM vals v JOIN bins b USING ("column")) x GROUP BY 1, 2""")
_BOX = ("box", """SELECT "column", any_value(rows) AS n, any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3,
    any_value(mean) AS mean, min(CASE WHEN inn THEN value END) AS whisker_low, max(CASE WHEN inn THEN value END) AS whisker_high,
    count(*) FILTER (NOT inn) AS outliers FROM (
      SELECT v."column", value, rows, q1, med, q3, mean, value BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1) AS inn
      FROM vals v JOIN quart USING ("column")) x GROUP BY 1""")
_CURVE = ("curve", """SELECT "column", point, x, sum(c * exp(-5e-1 * power((x - value) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS density
    FROM (SELECT "column", value, count(*) AS c FROM vals GROUP BY 1, 2) v JOIN (
      SELECT *, low - 3 * bw + point * ((high - low + 6 * bw) / 199) AS x FROM (
        SELECT "column", count(*) AS n, min(value) AS low, max(value) AS high, stddev_samp(value) * power(count(*) * 1e0, -2e-1) AS bw
        FROM vals GROUP BY 1) m, (SELECT unnest(range(200)) AS point) p) g USING ("column") GROUP BY 1, 2, 3""")


@query("q_histogram", O.chain(O.observations(), _VALUES, _QUARTILES, _BINS, _HIST, final=f"""
    SELECT "column", bin, {O.r6('bin_start')} AS bin_start, {O.r6('bin_width')} AS bin_width, n FROM hist"""))
def histogram(spark, folder):
    return rounded(profile.histogram(V.obs(spark, folder), _PROFILED), ("bin_start", "bin_width"))


@query("q_category_counts", O.chain(O.observations(), final="""
    SELECT network, station, 'skyc1' AS "column", skyc1 AS value, count(*) AS n FROM obs WHERE skyc1 IS NOT NULL GROUP BY ALL"""))
def category_counts(spark, folder):
    return profile.category_counts(V.obs(spark, folder), ["skyc1"], KEYS)


@query("q_kde", O.chain(O.observations(), _VALUES, _CURVE, final=f"""
    SELECT "column", point, {O.r6('x')} AS x, {O.r6('density')} AS density FROM curve"""))
def kde(spark, folder):
    found = profile.density(V.obs(spark, folder), _PROFILED).withColumn("point", F.col("point").cast("bigint"))
    return rounded(found, ("x", "density"))


@query("q_fire_years", O.chain(O.FIRES, final="""
    SELECT CAST(y AS INT) AS year FROM (SELECT year("start") AS y FROM fires UNION SELECT year("end") FROM fires) u
    WHERE y IS NOT NULL ORDER BY 1"""))
def fire_years(spark, folder):
    return profile.interval_years(V.fires(spark, folder))


_BOX_FIELDS = ("q1", "median", "q3", "mean", "whisker_low", "whisker_high")


@query("q_box_stats", O.chain(O.observations(), _VALUES, _QUARTILES, _BOX, final=f"""
    SELECT "column", n, outliers, {', '.join(f'{O.r6(c)} AS {c}' for c in _BOX_FIELDS)} FROM box"""))
def box_stats(spark, folder):
    return rounded(profile.box_stats(V.obs(spark, folder), _PROFILED), _BOX_FIELDS)


@query("q_outliers", O.chain(O.observations(), _VALUES, _QUARTILES, final=f"""
    SELECT "column", {O.r6('value')} AS value, count(*) AS n FROM vals JOIN quart USING ("column")
    WHERE NOT value BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1) GROUP BY 1, 2"""))
def outliers(spark, folder):
    return rounded(profile.outliers(V.obs(spark, folder), _PROFILED), ("value",))


@query("q_bounds", O.chain(O.FIRES, final="""
    SELECT network, min(lat) AS south, max(lat) AS north, min(lon) AS west, max(lon) AS east FROM fires GROUP BY 1"""))
def bounds(spark, folder):
    return profile.bounds(V.fires(spark, folder), ["network"])


@query("q_distinct_counts", O.chain(O.observations(), final=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM obs""" for c in O.ALL)))
def distinct_counts(spark, folder):
    return profile.distinct_counts(V.obs(spark, folder), _ALL)


# === windows and sequences ===========================================================================

_PRESENT = " + ".join(f"({c} IS NOT NULL)::INT" for c in (*O.ALL, "network", "station", "valid"))


@query("q_dedup_best", O.chain(O.observations("type", "hour"), final=f"""
    SELECT network, station, valid, src_seq, {_CELLS} FROM (
      SELECT *, row_number() OVER (PARTITION BY network, station, valid ORDER BY {_PRESENT} DESC, src_seq DESC) AS rn FROM obs) r
    WHERE rn = 1"""))
def dedup_best(spark, folder):
    return dedup.dedup_best(V.obs(spark, folder, time="hour"))


def _filled_sql(expression) -> str:
    cells = ", ".join(f"{expression(c)} AS {c}" for c in _ALL)
    return O.chain(*_FILL_SQL, ("filled", f"SELECT network, station, valid, {cells} FROM grid"), final=O.rounded(_ALL, source="filled"))


def _filled(spark, folder, method: str) -> DataFrame:
    rules = {c: RULES[c] for c in _ALL}
    return rounded(fill.resample_filled(_encoded(spark, folder, "user"), rules, dict.fromkeys(rules, method)), _ALL)


@query("q_ffill", _filled_sql(O.ffill))
def ffill(spark, folder):
    return _filled(spark, folder, "ffill")


@query("q_ffill_bfill", _filled_sql(O.both_fills))
def ffill_bfill(spark, folder):
    return _filled(spark, folder, "ffill_bfill")


@query("q_interpolate", _filled_sql(O.linear))
def interpolate(spark, folder):
    return _filled(spark, folder, "linear")


_CELL_ROWS = f"""SELECT network, station, "column", day, slot, {O.r6('value')} AS value FROM cells"""


@query("q_split_daily", O.chain(*_SPLIT_STEPS, final=_CELL_ROWS))
def split_daily(spark, folder):
    return flat(_split(spark, folder))


@query("q_split_rows", O.chain(O.observations(), ("numbered", """
    SELECT network, station, tmpf AS value, row_number() OVER (PARTITION BY network, station ORDER BY valid, src_seq) - 1 AS place FROM obs"""),
    ("chunks", "SELECT network, station, place // 10 AS row, list(value ORDER BY place) AS v FROM numbered GROUP BY ALL"),
    final=f"""SELECT network, station, 'tmpf' AS "column", row, slot, {O.r6('CASE WHEN slot < len(v) THEN v[slot + 1] ELSE v[-1] END')} AS value
      FROM chunks, (SELECT unnest(range(10)) AS slot) s"""))
def split_rows(spark, folder):
    return flat(split.split_rows(V.obs(spark, folder), ["tmpf"], 10, order=("valid", "src_seq")))


_SMOOTH_STEPS = [*_SPLIT_STEPS, *O.lowess_steps(24, 9)]


@query("q_lowess", O.chain(*_SMOOTH_STEPS, final=f"""
    SELECT network, station, "column", day, slot, {O.r6('value')} AS value, {O.r6('smooth')} AS smooth FROM smooth"""))
def lowess(spark, folder):
    both = reports.smoothing_table(_split(spark, folder), frac=0.4)
    return rounded(both.withColumn("slot", F.col("slot").cast("bigint")), ("value", "smooth"))


_ROW_WINDOW = 'OVER (PARTITION BY network, station, "column", day)'


@query("q_lowess_long", O.chain(
    *O.clean_steps(), ("series", """SELECT network, station, valid, tmpf AS value,
        row_number() OVER (PARTITION BY network, station ORDER BY valid) - 1 AS slot FROM clean WHERE tmpf IS NOT NULL"""),
    *O.long_lowess_steps("1e-1", "series"),
    final=f"SELECT network, station, valid, {O.r6('series.value')} AS tmpf, {O.r6('smooth')} AS tmpf_smooth "
          "FROM series JOIN smooth USING (network, station, slot)"))
def lowess_long(spark, folder):
    """A station's whole series as one column."""
    table = materialize(clean(V.obs(spark, folder)).select(*KEYS, "valid", "tmpf"), "clean")
    return rounded(smooth_long.smooth_column(table, "tmpf", frac=0.1), ("tmpf", "tmpf_smooth"))


@query("q_scale_rows", O.chain(*_SPLIT_STEPS, ("rows_scaled", f"""
    SELECT network, station, "column", day, slot,
      (value - min(value) {_ROW_WINDOW}) / CASE WHEN max(value) {_ROW_WINDOW} = min(value) {_ROW_WINDOW} THEN 1e0
        ELSE max(value) {_ROW_WINDOW} - min(value) {_ROW_WINDOW} END AS value FROM cells"""),
    final=_CELL_ROWS.replace("FROM cells", "FROM rows_scaled")))
def scale_rows(spark, folder):
    return flat(split.scale_rows(_split(spark, folder)))


@query("q_scale_rows_standard", O.chain(*_SPLIT_STEPS, ("rows_scaled", f"""
    SELECT network, station, "column", day, slot,
      (value - avg(value) {_ROW_WINDOW}) / CASE WHEN max(value) {_ROW_WINDOW} = min(value) {_ROW_WINDOW} THEN 1e0
        ELSE stddev_pop(value) {_ROW_WINDOW} END AS value FROM cells"""),
    final=_CELL_ROWS.replace("FROM cells", "FROM rows_scaled")))
def scale_rows_standard(spark, folder):
    return flat(split.scale_rows(_split(spark, folder), "standard"))


@query("q_unsplit", O.chain(*_SPLIT_STEPS, final=f"""
    SELECT network, station, "column", day + slot * INTERVAL 1 HOUR AS valid, {O.r6('value')} AS value FROM cells"""))
def unsplit(spark, folder):
    return rounded(split.unsplit(_split(spark, folder)).drop("day", "slot"), ("value",))


# === scalar functions ================================================================================

@query("q_ordinal", O.chain(O.observations(), final=f"SELECT src_seq, {O.CODE} AS skyc1 FROM obs"))
def ordinal(spark, folder):
    return V.obs(spark, folder).select("src_seq", encode.ordinal_code(F.col("skyc1")).alias("skyc1"))


@query("q_cyclical", O.chain(O.observations(), final=f"""
    SELECT src_seq, {O.r6('sin(2 * pi() * drct / 360)')} AS drct_sin, {O.r6('cos(2 * pi() * drct / 360)')} AS drct_cos FROM obs"""))
def cyclical(spark, folder):
    found = encode.encode_cyclical(V.obs(spark, folder).select("src_seq", "drct"), "drct", 360)
    return rounded(found, ("drct_sin", "drct_cos"))


# One row of parameters per station, so that one join serves all columns.
_WIDE = ("wide", "SELECT network, station, " + ", ".join(
    f"""max(CASE WHEN "column" = '{c}' THEN {v} END) AS {v}_{c}""" for c in _NUMERIC for v in ("center", "scale")) + " FROM params GROUP BY 1, 2")
_WITH_WIDE = " FROM obs o LEFT JOIN wide p ON p.network = o.network AND p.station = o.station"


@query("q_scale_minmax", O.chain(O.observations("user"), O.minmax_params(_NUMERIC, "obs"), _WIDE,
    final="SELECT o.network, o.station, o.valid, " + ", ".join(
        O.r6(f"CASE WHEN o.{c} IS NULL THEN NULL ELSE greatest(least((o.{c} - p.center_{c}) / p.scale_{c} * 2e0 - 1e0, 1e0), -1e0) END")
        + f" AS {c}" for c in _NUMERIC) + _WITH_WIDE))
def scale_minmax(spark, folder):
    df = V.obs(spark, folder, "user").select(*KEYS, "valid", *_NUMERIC)
    scaled, _ = scale.scale(df, "minmax", feature_range=(-1, 1), clip=True)
    return rounded(scaled, _NUMERIC)


@query("q_scale_standard", O.chain(O.observations("user"), O.standard_params(_NUMERIC, "obs"), _WIDE,
    final="SELECT o.network, o.station, o.valid, " + ", ".join(
        O.r6(f"(o.{c} - p.center_{c}) / p.scale_{c}") + f" AS {c}" for c in _NUMERIC) + _WITH_WIDE))
def scale_standard(spark, folder):
    df = V.obs(spark, folder, "user").select(*KEYS, "valid", *_NUMERIC)
    scaled, _ = scale.scale(df, "standard")
    return rounded(scaled, _NUMERIC)


def _utm_sql() -> str:
    """Krüger series with the third flattening n; the tests compare it with another derivation."""
    n = "(1e0 / 298.257223563e0) / (2e0 - 1e0 / 298.257223563e0)"
    beta = ("n/2 - 2*n*n/3 + 37*power(n,3)/96", "n*n/48 + power(n,3)/15", "17*power(n,3)/480")
    delta = ("2*n - 2*n*n/3 - 2*power(n,3)", "7*n*n/3 - 8*power(n,3)/5", "56*power(n,3)/15")
    xi = "".join(f" - ({b}) * sin({2 * j}*xi) * cosh({2 * j}*eta)" for j, b in enumerate(beta, 1))
    eta = "".join(f" - ({b}) * cos({2 * j}*xi) * sinh({2 * j}*eta)" for j, b in enumerate(beta, 1))
    chi = "".join(f" + ({d}) * sin({2 * j}*chi)" for j, d in enumerate(delta, 1))
    return f"""
    SELECT c_custkey, {O.r6(f'degrees(chi{chi})')} AS lat, {O.r6('21 + degrees(atan2(sinh(eta1), cos(xi1)))')} AS lon FROM (
      SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM (
        SELECT *, xi{xi} AS xi1, eta{eta} AS eta1 FROM (
          SELECT c_custkey, n, (4000000e0 + (c_custkey * 91 % 500000)) / (9996e-4 * radius) AS xi,
            (200000e0 + (c_custkey * 37 % 600000) - 500000e0) / (9996e-4 * radius) AS eta FROM (
            SELECT *, 6378137e0 / (1 + n) * (1 + n*n/4 + power(n,4)/64) AS radius FROM (
              SELECT c_custkey, {n} AS n FROM customer) q0) q1) q2) q3) q4"""


@query("q_utm_latlon", _utm_sql())
def utm_latlon(spark, folder):
    grid = V.table(spark, folder, "customer").selectExpr(
        "c_custkey", "200000e0 + (c_custkey * 37 % 600000) as easting", "4000000e0 + (c_custkey * 91 % 500000) as northing")
    return rounded(geo.with_latlon(grid, 34, "easting", "northing"), ("lat", "lon"))


@query("q_radius", O.chain(O.FIRES, final=f"SELECT fire_id, {O.r6('coalesce(sqrt(spread * 10000) / 2, 1e0)')} AS radius_m FROM fires"))
def radius(spark, folder):
    return V.fires(spark, folder).select("fire_id", r6(geo.spread_radius(F.col("spread"))).alias("radius_m"))


@query("q_datetime_fns", O.chain(O.FIRES, final=f"""
    SELECT fire_id, strftime("start", '%Y') AS year, strftime("start", '%Y%m%d%H%M') AS stamp, strftime("start", '%b') AS month,
      CAST(make_date(CAST(strftime("start", '%Y') AS INT), 1, 1) AS TIMESTAMP) AS year_start,
      {O.r6('date_diff(\'microsecond\', "start", "end") / 86400e6')} AS days FROM fires"""))
def datetime_fns(spark, folder):
    start, end = F.col("start"), F.col("end")
    return V.fires(spark, folder).select(
        "fire_id", timeline.to_year(start).alias("year"), timeline.compact_stamp(start).alias("stamp"),
        timeline.month_name(start).alias("month"), timeline.from_year(timeline.to_year(start)).alias("year_start"),
        r6(timeline.days_between(start, end)).alias("days"))


@query("q_string_fns", """
    SELECT p_partkey, replace(p_name, ' ', '') AS spaceless, replace(concat(p_name, '  ', p_brand), '  ', ' ') AS single,
      CAST(1990 + p_size AS VARCHAR) AS start_year, CASE WHEN p_size % 2 = 0 THEN '' ELSE CAST(2000 + p_size AS VARCHAR) END AS end_year,
      upper(trim(concat(' ', p_name, ' '))) AS code, concat(upper(substr(p_type, 1, 1)), lower(substr(p_type, 2))) AS capital FROM part""")
def string_fns(spark, folder):
    period = F.concat(F.lit("("), (F.col("p_size") + 1990).cast("string"), F.lit("-"),
                      F.when(F.col("p_size") % 2 == 0, F.lit("Now")).otherwise((F.col("p_size") + 2000).cast("string")), F.lit(")"))
    start, end = text.period_parts(period)
    name = F.col("p_name")
    return V.table(spark, folder, "part").select(
        "p_partkey", text.without_spaces(name).alias("spaceless"),
        text.single_spaced(F.concat(name, F.lit("  "), "p_brand")).alias("single"), start.alias("start_year"), end.alias("end_year"),
        text.code_upper(F.concat(F.lit(" "), name, F.lit(" "))).alias("code"), text.capitalised(F.col("p_type")).alias("capital"))


@query("q_feature_table", O.chain(O.STATIONS, final="""
    SELECT seq, lat, lon, key, value FROM (
      SELECT seq, lat, lon, 'ID' AS key, sid AS value FROM stations UNION ALL
      SELECT seq, lat, lon, 'Network', network FROM stations UNION ALL
      SELECT seq, lat, lon, 'Start', CAST(year("start") AS VARCHAR) FROM stations UNION ALL
      SELECT seq, lat, lon, 'End', CAST(year("end") AS VARCHAR) FROM stations) a WHERE value IS NOT NULL"""))
def feature_table(spark, folder):
    named = V.stations(spark, folder).withColumnsRenamed({"lat": "latitude", "lon": "lng"})
    shown = named.withColumn("props", attributes(named, ["sid", "network", "start", "end"], datetime_to_year=True))
    return geo.with_standard_coordinates(shown).select("seq", "lat", "lon", F.explode("props"))


_TEXTS = descriptions(units=True)


@query("q_describe", O.chain(O.observations(), final=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{_TEXTS[c]}' AS description, '{'string' if c in ('station', 'skyc1') else 'double'}' AS type,
        count({c}) AS present FROM obs""" for c in ("station", *O.ALL))))
def describe(spark, folder):
    return describe_columns(V.obs(spark, folder).select("station", *O.ALL), units=True)


# === statistics and clusters =========================================================================

@query("q_train_test", """
    SELECT event_id, value, substr(md5(concat('7:', CAST(event_id AS VARCHAR))), 1, 8) < '40000000' AS is_test FROM events""")
def train_test(spark, folder):
    train, test, y_train, y_test = holdout.train_test(
        V.table(spark, folder, "events").select("event_id", "user_id", "value"), "event_id", ["value"], test_size=0.25, seed=7)
    mark = [x.join(y, "event_id").select("event_id", "value", F.lit(flag).alias("is_test"))
            for x, y, flag in ((train, y_train, False), (test, y_test, True))]
    return mark[0].unionByName(mark[1])


@query("q_train_test_exact", """
    SELECT event_id, row_number() OVER (ORDER BY md5(concat('7:', CAST(event_id AS VARCHAR))), event_id)
      <= ceil(count(*) OVER () * 3e-1) AS is_test FROM events""")
def train_test_exact(spark, folder):
    return holdout.mark_test(V.table(spark, folder, "events").select("event_id"), "event_id", 0.3, 7, exact=True)


_STRATA_PARTS = "SELECT event_id, event_type, CASE WHEN event_id % 5 <> 0 THEN CAST(user_id % 10 AS BIGINT) END AS part FROM {}"


@query("q_train_test_strata", O.chain(
    ("e", "SELECT *, concat('{\"s0\":\"', event_type, '\",\"s1\":', coalesce(CAST(part AS VARCHAR), 'null'), '}') AS s FROM (" + _STRATA_PARTS.format("events") + ") x"),
    ("sizes", "SELECT s, count(*) AS n, round(count(*) * 3e-1, 9) AS share FROM e GROUP BY 1"),
    ("quotas", """SELECT s, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, s)
        <= ceil(round(sum(n) OVER () * 3e-1, 9)) - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS quota FROM sizes"""),
    final="""SELECT event_id, event_type, part, row_number() OVER (PARTITION BY s ORDER BY md5(concat('7:', CAST(event_id AS VARCHAR))))
      <= quota AS is_test FROM e JOIN quotas USING (s)"""))
def train_test_strata(spark, folder):
    V.table(spark, folder, "events").createOrReplaceTempView("strata_events")
    parts = spark.sql(_STRATA_PARTS.format("strata_events"))
    return holdout.mark_test_within(parts, "event_id", ["event_type", "part"], 0.3, 7)


def _vectors(spark, folder) -> DataFrame:
    return V.table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


# Groups far apart: what a fit must find is known, whatever it draws. The cluster's name is its first member.
_APART = "x[i] + CASE WHEN i = label + 1 THEN 1e3 ELSE 0e0 END"


@query("q_kmeans_fit", O.chain(
    ("v", "SELECT vec_id, CAST(label AS INT) AS label, embedding::DOUBLE[] AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings"),
    final=f"""SELECT min(vec_id) AS first_id, count(*) AS n, CAST(i - 1 AS INT) AS place, {O.r6('avg(' + _APART + ')')} AS value
        FROM v GROUP BY label, i"""))
def kmeans_fit(spark, folder):
    rows = _vectors(spark, folder)
    rows = rows.withColumn("x", F.expr("transform(x, (v, i) -> v + CASE WHEN i = label THEN 1e3 ELSE 0e0 END)"))
    centers = cluster.fit_kmeans(rows, "x", clusters=rows.select("label").distinct().count(), seed=1)
    found = cluster.assign_kmeans(rows, "x", centers).groupBy("cluster").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return rounded(found.join(centers, "cluster").select("first_id", "n", F.posexplode("center").alias("place", "value")), ("value",))


@query("q_kmeans_assign", O.chain(
    ("centers", "SELECT label AS cluster, arg_min(embedding, vec_id) AS c FROM embeddings GROUP BY 1"),
    ("d", """SELECT vec_id, cluster, list_sum(list_transform(range(1, 65), lambda i: power(embedding[i]::DOUBLE - c[i]::DOUBLE, 2))) AS s
        FROM embeddings, centers"""),
    final=f"SELECT vec_id, arg_min(cluster, (s, cluster)) AS cluster, {O.r6('sqrt(min(s))')} AS distance FROM d GROUP BY 1"))
def kmeans_assign(spark, folder):
    rows = _vectors(spark, folder)
    centers = rows.groupBy(F.col("label").alias("cluster")).agg(F.min_by("x", "vec_id").alias("center"))
    return rounded(cluster.assign_kmeans(rows, "x", centers).select("vec_id", "cluster", "distance"), ("distance",))


@query("q_dtw_pairs", O.chain(*_SPLIT_STEPS, *O.dtw_steps("""
    SELECT network, station, "column", s.day, s.vals AS a, n.vals AS b FROM split s
    JOIN (SELECT network, station, "column", day - INTERVAL 1 DAY AS day, vals FROM split) n
    USING (network, station, "column", day)""", 24, 'network, station, "column", day'),
    final=f"""SELECT network, station, "column", day, {O.r6('sqrt(cost)')} AS distance FROM costs"""))
def dtw_pairs(spark, folder):
    rows = materialize(_split(spark, folder), "split")
    follower = rows.select(*KEYS, "column", (F.col("day") - F.expr("interval 1 day")).alias("day"), F.col("values").alias("b"))
    pairs = rows.join(follower, list(_SERIES))
    return pairs.select(*_SERIES, r6(dtw.dtw_distance(F.col("values"), F.col("b"))).alias("distance"))


_COMPLETE_DAYS = ("whole_days", "SELECT * FROM split WHERE list_count(vals) = 24")


def _apart(rows: DataFrame) -> DataFrame:
    """Every series in three groups of days that no distance within them comes near to."""
    return rows.withColumn("values", F.transform("values", lambda v: v + F.day("day") % 3 * F.lit(1e7)))


@query("q_dtw_kmeans", O.chain(*_SPLIT_STEPS, _COMPLETE_DAYS, final="""
    SELECT network, station, "column", day, min(day) OVER w AS first_day, count(*) OVER w AS n FROM whole_days
    WINDOW w AS (PARTITION BY network, station, "column", day(day) % 3)"""))
def dtw_kmeans(spark, folder):
    rows = materialize(_apart(_split(spark, folder, smoothed=True)), "split")
    labels = materialize(cluster.assign_dtw(rows, cluster.fit_dtw_kmeans(rows, clusters=3, seed=1)), "labels")
    group = [*cluster.GROUP, "cluster"]
    names = labels.groupBy(*group).agg(F.min("day").alias("first_day"), F.count(F.lit(1)).alias("n"))
    return labels.join(names, group).select(*_SERIES, "first_day", "n")


_CENTER_DAYS = ("2024-01-03", "2024-01-10", "2024-01-17")


_CENTERS = ("centers", """SELECT network, station, "column", vals AS b, CAST(dense_rank() OVER (ORDER BY CAST(day AS DATE)) - 1 AS INT) AS cluster
        FROM split WHERE CAST(day AS DATE) IN ('2024-01-03', '2024-01-10', '2024-01-17')""")
_CENTER_COSTS = O.dtw_steps("""SELECT network, station, "column", day, cluster, vals AS a, b FROM split JOIN centers USING (network, station, "column")""",
                            24, 'network, station, "column", day, cluster')


def _center_days(rows: DataFrame) -> DataFrame:
    number = F.array_position(F.array(*[F.lit(d) for d in _CENTER_DAYS]), F.date_format("day", "yyyy-MM-dd"))
    return rows.where(number > 0).select(*KEYS, "column", (number - 1).cast("int").alias("cluster"), F.col("values").alias("center"))


@query("q_dtw_assign", O.chain(*_SPLIT_STEPS, _CENTERS, *_CENTER_COSTS,
    final=f"""SELECT network, station, "column", day, arg_min(cluster, (cost, cluster)) AS cluster, {O.r6('sqrt(min(cost))')} AS distance
        FROM costs GROUP BY ALL"""))
def dtw_assign(spark, folder):
    rows = materialize(_split(spark, folder), "split")
    return rounded(cluster.assign_dtw(rows, _center_days(rows)).select(*_SERIES, "cluster", "distance"), ("distance",))


@query("q_dtw_first_step", O.chain(*_SPLIT_STEPS, _CENTERS, *_CENTER_COSTS,
    ("least", 'SELECT network, station, "column", day, min(cost) AS cost FROM costs GROUP BY ALL'),
    final=f"""SELECT network, station, "column", {O.r6('avg(cost)')} AS inertia, 1 AS iterations FROM least GROUP BY ALL"""))
def dtw_first_step(spark, folder):
    rows = materialize(_split(spark, folder), "split")
    model = cluster.fit_dtw_kmeans(rows, clusters=3, start=_center_days(rows), max_iter=1)
    return rounded(model.where("cluster = 0").select(*KEYS, "column", "inertia", "iterations"), ("inertia",))


# === stages ==========================================================================================

@query("q_clean", O.chain(*O.clean_steps(), final=O.rounded(_MAIN)))
def clean_main(spark, folder):
    return rounded(clean(V.obs(spark, folder)), _MAIN)


@query("q_clean_all", O.chain(*O.clean_steps(O.ALL), final=O.rounded(O.CLEAN_ALL)))
def clean_all(spark, folder):
    return rounded(clean(V.obs(spark, folder), main=False), O.CLEAN_ALL)


@query("q_clean_many_stations", O.chain(*O.clean_steps(station="user"), final=O.rounded(_MAIN)))
def clean_many_stations(spark, folder):
    return rounded(clean(V.obs(spark, folder, "user")), _MAIN)


def _stored(spark, folder) -> stages.Layout:
    layout = stages.Layout(scratch_path(spark, "data"))
    sinks.write_observations(V.obs(spark, folder), layout.fetched)
    return layout


@query("q_scale_stage", O.chain(*O.clean_steps(), O.standard_params(_MAIN), O.scaled_wide(_MAIN), final=O.rounded(_MAIN, source="scaled")))
def scale_stage(spark, folder):
    layout = _stored(spark, folder)
    stages.run_clean(spark, layout)
    return rounded(stages.run_scale(spark, layout, scaler="standard")["standard"].select(*KEYS, "valid", *_MAIN), _MAIN)


_SMOOTH_ROWS = f"""SELECT network, station, "column", day, slot, {O.r6('smooth')} AS value FROM smooth"""


@query("q_split_stage", O.chain(*_SMOOTH_STEPS, final=_SMOOTH_ROWS))
def split_stage(spark, folder):
    layout = _stored(spark, folder)
    stages.run_clean(spark, layout)
    found = stages.run_split(spark, layout)["clean"]
    return flat(found.select(*_SERIES, "values"))


@query("q_preprocess", O.chain(*O.clean_steps(), O.minmax_params(_MAIN), O.scaled_wide(_MAIN), O.long_rows(source="scaled"), *O.SPLIT,
                               *O.lowess_steps(24, 9), final=_SMOOTH_ROWS))
def preprocess(spark, folder):
    layout = _stored(spark, folder)
    stages.run_preprocess(spark, layout, split="all", scaler="minmax")
    return flat(tables.read_stored(spark, layout.split("scaled_minmax")).select(*_SERIES, "values"))


@query("q_cluster_days", O.chain(*_SPLIT_STEPS, _COMPLETE_DAYS,
    ("named", """SELECT *, min(day) OVER (PARTITION BY network, station, "column", day(day) % 3) AS first_day FROM whole_days"""),
    final="SELECT network, station, day, " + ", ".join(
        f"""max(CASE WHEN "column" = '{c}' THEN first_day END) AS {c}""" for c in O.MAIN) + " FROM named GROUP BY ALL"))
def cluster_days(spark, folder):
    layout, apart = _stored(spark, folder), stages.Layout(scratch_path(spark, "data"))
    stages.run_preprocess(spark, layout, split="clean")
    sinks.write_split(_apart(tables.read_stored(spark, layout.split("clean"))), apart.split("clean"))
    labels = stages.run_cluster(spark, apart, clusters=3, seed=1)
    # One row per station and day: a window holds the days of one station's cluster.
    first = {c: F.when(F.col(c).isNotNull(), F.min("day").over(Window.partitionBy(*KEYS, c))) for c in MAIN_COLUMNS}
    return labels.select(*KEYS, "day", *[f.alias(c) for c, f in first.items()])


@query("q_model_json", O.chain(*_SPLIT_STEPS, ("ranked", """SELECT *, row_number() OVER (PARTITION BY network, station, "column" ORDER BY day) AS k
        FROM split"""), final=f"""
    SELECT network, station, "column", CAST(k - 1 AS INT) AS cluster, 3 AS n_clusters, 'dtw' AS metric, CAST(slot AS INT) AS slot,
      {O.r6('vals[slot + 1]')} AS value, {O.r6('list_sum(vals)')} AS inertia
    FROM ranked, (SELECT unnest(range(24)) AS slot) s WHERE k <= 3"""))
def model_json(spark, folder):
    """Models written as JSON documents and read back; the first days of a series stand for its centers."""
    days = _split(spark, folder)
    place = F.row_number().over(Window.partitionBy(*cluster.GROUP).orderBy("day")) - 1
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    model = days.withColumn("cluster", place).where("cluster < 3").select(
        *cluster.GROUP, "cluster", F.col("values").alias("center"), total.alias("inertia"), F.lit(1).alias("iterations"))
    # A document has one inertia: a center's own is told by a document of that center alone.
    parts = [cluster.model_json(model.where(F.col("cluster") == i), n_clusters=3, metric="dtw").withColumn("cluster", F.lit(i)) for i in range(3)]
    body = F.from_json("document", "hyper_params struct<n_clusters: int, metric: string>, "
                                   "model_params struct<cluster_centers_: array<array<double>>, inertia_: double, n_iter_: int>")
    back = parts[0].union(parts[1]).union(parts[2]).withColumn("d", body)
    return rounded(back.select(
        *cluster.GROUP, "cluster", "d.hyper_params.n_clusters", "d.hyper_params.metric",
        F.posexplode(F.col("d.model_params.cluster_centers_")[0]).alias("slot", "value"), F.col("d.model_params.inertia_").alias("inertia")),
        ("value", "inertia"))


_LAYER = """SELECT '{network}' AS network, '{layer}' AS layer, lat, lon, {radius} AS radius_m, CAST(NULL AS DOUBLE) AS lat2,
    CAST(NULL AS DOUBLE) AS lon2, {props} AS props FROM {source}"""


@query("q_info_layers", O.chain(O.STATIONS, O.FIRES, ("near", _nearest_sql("true", "lat, lon")), final=" UNION ALL ".join((
    _LAYER.format(network="ALL", layer="Stations", radius="CAST(NULL AS DOUBLE)", source="stations",
                  props="""concat('ID=', sid, ';Start=', CAST(year("start") AS VARCHAR), CASE WHEN "end" IS NULL THEN '' ELSE concat(';End=', CAST(year("end") AS VARCHAR)) END)"""),
    _LAYER.format(network="ALL", layer="Fires", radius=O.r6("coalesce(sqrt(spread * 10000) / 2, 1e0)"), source="fires",
                  props="concat('Fire_id=', CAST(fire_id AS VARCHAR))"),
    "SELECT 'ALL', 'Nearest Stations', lat, lon, NULL, station_lat, station_lon, NULL FROM near"))))
def info_layers(spark, folder):
    found = layers.info_layers(V.stations(spark, folder), V.fires(spark, folder),
                               station_props=["sid", "start", "end"], fire_props=["fire_id"])
    return _shown(found)


def _shown(features: DataFrame) -> DataFrame:
    props = F.concat_ws(";", F.transform(F.map_entries("props"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return rounded(features.withColumn("props", F.when(F.col("props").isNotNull(), props)), ("radius_m",))


@query("q_yearly_fires", O.chain(O.FIRES, ("years", """SELECT *, year("start") AS y FROM fires UNION ALL
      SELECT *, year("end") FROM fires WHERE "end" IS NOT NULL AND year("end") <> year("start")"""),
    final=f"""SELECT network, CAST(y AS VARCHAR) AS layer, lat, lon, {O.r6('coalesce(sqrt(spread * 10000) / 2, 1e0)')} AS radius_m,
      CAST(NULL AS DOUBLE) AS lat2, CAST(NULL AS DOUBLE) AS lon2, concat('Fire_id=', CAST(fire_id AS VARCHAR)) AS props FROM years"""))
def yearly_fires(spark, folder):
    return _shown(layers.yearly_fire_layers(V.fires(spark, folder), by_network=True, props=["fire_id"]))


_PART = """SELECT "column", '{part}' AS part, CAST({item} AS VARCHAR) AS item, CAST({value} AS DOUBLE) AS value FROM {source}"""
_PROFILE_COLUMNS = [*_PROFILED, "skyc1"]


@query("q_profile_distribution", O.chain(
    O.observations(), _VALUES, _QUARTILES, _BINS, _HIST, _BOX, _CURVE,
    ("missing", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS present, count(*) - count({c}) AS missing FROM obs"""
                                   for c in _PROFILE_COLUMNS)),
    ("cats", """SELECT 'skyc1' AS "column", skyc1 AS value, count(*) AS n FROM obs WHERE skyc1 IS NOT NULL GROUP BY 2"""),
    ("parts", " UNION ALL ".join((
        *[_PART.format(part="missing", item=f"'{c}'", value=c, source="missing") for c in ("present", "missing")],
        _PART.format(part="histogram", item="bin", value="n", source="hist"),
        _PART.format(part="density", item="point", value="density", source="curve"),
        *[_PART.format(part="box", item=f"'{c}'", value=c, source="box") for c in ("n", "outliers", *_BOX_FIELDS)],
        _PART.format(part="category", item="value", value="n", source="cats")))),
    final=f"""SELECT "column", part, item, {O.r6('value')} AS value FROM parts"""))
def profile_distribution(spark, folder):
    return rounded(reports.distribution_profile(V.obs(spark, folder), _PROFILE_COLUMNS), ("value",))


def _by_station(step: tuple[str, str]) -> tuple[str, str]:
    """A step of the profile with a station's rows apart."""
    name, text = step
    text = re.sub(r"""SELECT ('\w+' AS )?"column\"""", r'SELECT network, station, \1"column"', text)
    text = text.replace('SELECT v."column"', 'SELECT v.network, v.station, v."column"').replace('("column")', '(network, station, "column")')
    return name, re.sub(r"GROUP BY [0-9, ]+", "GROUP BY ALL ", text)


_STATION_PART = _PART.replace('SELECT "column"', 'SELECT network, station, "column"')


@query("q_station_reports", O.chain(
    O.observations(), *map(_by_station, (_VALUES, _QUARTILES, _BINS, _HIST, _BOX, _CURVE)),
    ("missing", " UNION ALL ".join(f"""SELECT network, station, '{c}' AS "column", count({c}) AS present, count(*) - count({c}) AS missing
        FROM obs GROUP BY ALL""" for c in _PROFILE_COLUMNS)),
    ("cats", """SELECT network, station, 'skyc1' AS "column", skyc1 AS value, count(*) AS n FROM obs WHERE skyc1 IS NOT NULL GROUP BY ALL"""),
    ("parts", " UNION ALL ".join((
        *[_STATION_PART.format(part="missing", item=f"'{c}'", value=c, source="missing") for c in ("present", "missing")],
        _STATION_PART.format(part="histogram", item="bin", value="n", source="hist"),
        _STATION_PART.format(part="density", item="point", value="density", source="curve"),
        *[_STATION_PART.format(part="box", item=f"'{c}'", value=c, source="box") for c in ("n", "outliers", *_BOX_FIELDS)],
        _STATION_PART.format(part="category", item="value", value="n", source="cats")))),
    final=f"""SELECT network, station, "column", part, item, {O.r6('value')} AS value FROM parts"""))
def station_reports(spark, folder):
    """The stored reports of the fetched category, every station on its own."""
    found = reports.station_reports(spark, _stored(spark, folder), "fetched")
    return rounded(reports.profile_rows(found, KEYS), ("value",))


@query("q_profile_time", O.chain(("m", _MONTHS), _COMPLETE, ("s", _QUARTERS), ("parts", """
    SELECT "column", 'monthly' AS part, strftime(period, '%b') AS season, CAST(year(period) AS INT) AS year, value,
      CAST(NULL AS DOUBLE) AS season_mean, (month(period) - 1) * (2 * pi()) / 12 AS angle FROM m UNION ALL
    SELECT "column", 'quarterly', CAST(quarter(period) AS VARCHAR), CAST(year(period) AS INT), value, NULL, NULL FROM s UNION ALL
    SELECT "column", 'seasonal_months', CAST(month(period) AS VARCHAR), CAST(year(period) AS INT), value,
      avg(value) OVER (PARTITION BY month(period)), NULL FROM m WHERE (SELECT ok FROM whole) UNION ALL
    SELECT "column", 'seasonal_quarters', CAST(quarter(period) AS VARCHAR), CAST(year(period) AS INT), value,
      avg(value) OVER (PARTITION BY quarter(period)), NULL FROM s WHERE (SELECT ok FROM whole)"""),
    final=f"""SELECT "column", part, season, year, {O.r6('value')} AS value, {O.r6('season_mean')} AS season_mean, {O.r6('angle')} AS angle FROM parts"""))
def profile_time(spark, folder):
    found = reports.time_profile(_orders(spark, folder), ["o_totalprice"], time="o_orderdate")
    return rounded(found, ("value", "season_mean", "angle"))


@query("q_profile_clusters", O.chain(*_SPLIT_STEPS, final=f"""
    SELECT network, station, "column", day, day + slot * INTERVAL 1 HOUR AS valid, CAST({_LABEL} AS INT) AS cluster,
      {O.r6('value')} AS value FROM cells"""))
def profile_clusters(spark, folder):
    rows = materialize(_split(spark, folder), "split")
    labels = _labels(rows)
    model = cluster.with_labels(rows, labels).groupBy(*KEYS, "column", "cluster").agg(F.min_by("values", "day").alias("center"))
    return rounded(reports.cluster_tables(rows, labels, model)["stacked"].drop("slot"), ("value",))


@query("q_ingest", O.chain(O.observations("type", "hour"), final=f"""
    SELECT network, station, valid, {', '.join("trim(skyc1) AS skyc1" if c == 'skyc1' else c for c in O.ALL)} FROM (
      SELECT *, row_number() OVER (PARTITION BY network, station, valid ORDER BY {_PRESENT} DESC, src_seq DESC) AS rn FROM obs) r
    WHERE rn = 1"""))
def ingest(spark, folder):
    layout = stages.Layout(scratch_path(spark, "data"))
    stages.run_ingest(_payloads(spark, folder, time="hour"), layout, order=("part",))
    return tables.read_stored(spark, layout.fetched).select(*KEYS, "valid", *O.ALL)
