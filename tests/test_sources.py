"""Scans, sinks, payloads, documents, selections, stored stages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import table
from gustline import schema, storage
from gustline.functions import describe
from gustline.operators import select
from gustline.plans import reports, stages
from gustline.sources import documents, payloads, sinks, tables
from gustline.sources import text as files

HEAD = "station,valid,lat,tmpf,skyc1,wxcodes,metar"
PAYLOADS = [
    ("N", 0, HEAD + "\r\na,2024-01-01 00:00,1.5,50.0,CLR,,x\r\na,2024-01-01 00:00,1.5,51.0,,,x\r\n\r\n"),
    ("N", 1, "valid,station,feel,tmpf\n2024-01-01 01:00,a,7,bad\n2024-01-01 02:00,a,,60"),
    ("N", 2, "ERROR: too busy\na,2024-01-01 00:00,1"),
    ("N", 3, HEAD + "\nb,2024-01-01 00:00,,\"49.5\",FEW,\"RA, BR\",\"AAA, BBB\"\n"),
]


@pytest.fixture
def landed(spark):
    return spark.createDataFrame(PAYLOADS, "network string, part int, payload string")


def test_payloads(landed):
    rows = payloads.parse_payloads(landed, keep=["network", "part"], also={"lat": "double"})
    found = table(rows.select("station", "valid", "tmpf", "skyc1", "feel", "wxcodes", "lat", "src_seq"), "part", "src_seq")
    assert found == [
        ("a", dt.datetime(2024, 1, 1, 0), 50.0, "CLR", None, None, 1.5, 0), ("a", dt.datetime(2024, 1, 1, 0), 51.0, None, None, None, 1.5, 1),
        ("a", dt.datetime(2024, 1, 1, 1), None, None, 7.0, None, None, 0), ("a", dt.datetime(2024, 1, 1, 2), 60.0, None, None, None, None, 1),
        ("b", dt.datetime(2024, 1, 1, 0), 49.5, "FEW", None, "RA, BR", None, 0)]
    assert "metar" not in rows.columns
    extra = payloads.parse_payloads(landed, extra_columns=True)
    assert {r.metar for r in extra.collect()} == {"x", None, "AAA, BBB"}


def test_ingest_keeps_the_best_report(landed):
    found = table(stages.ingest(landed, order=("part",)).select("station", "valid", "tmpf", "skyc1"), "station", "valid")
    assert len(found) == 4 and found[0][2:] == (50.0, "CLR")
    assert stages.ingest(landed, duplicates=True, order=("part",)).count() == 5


def test_requests(spark):
    stations = spark.createDataFrame([("N", "STNA")], "network string, sid string")
    address = payloads.request_manifest(stations, "http://x/?", "2018-01-01", "2018-01-02 03:04:00", report="routine", trace=True).first().request
    assert address == ("http://x/?data=all&report_type=3&tz=Etc/UTC&format=onlycomma&missing=empty&year1=2018&month1=01&day1=01&hour1=00"
                       "&minute1=00&year2=2018&month2=01&day2=02&hour2=03&minute2=04&&station=STNA")
    assert "report_type" not in payloads.request_manifest(stations, "", "2018-01-01", "2018-01-02").first().request
    assert payloads.request_all(spark, "", "2018-01-01", "2018-01-02", elevation=True).count() == 1
    assert payloads.request_all(spark, "", "2018-01-01", "2018-01-02 00:00:01").count() == 0


def test_geojson(spark):
    text = """{"count": 1, "features": [{"properties": {"elevation": 3.9, "sname": "A  B", "state": null, "country": "G R",
      "sid": "STNL", "network": "N", "time_domain": "(1932-Now)", "wfo": "w"}, "geometry": {"coordinates": [25.9, 40.8]}},
      {"properties": {"sname": "C", "sid": "X", "time_domain": "(1990-2001)"}, "geometry": {"coordinates": [1, 2]}}]}"""
    df = spark.createDataFrame([(text,), ('{"count": 0, "features": []}',)], "document string")
    rows = {r.sid: r for r in documents.geojson_stations(df, "document", extra_columns=True).collect()}
    assert (rows["STNL"].sname, rows["STNL"].country, rows["STNL"].start, rows["STNL"].end, rows["STNL"].lat) == ("A B", "GR", "1932", "", 40.8)
    assert rows["X"].end == "2001" and rows["STNL"].wfo == "w" and rows["STNL"].state is None
    assert "wfo" not in documents.geojson_stations(df, "document").columns


def test_option_list(spark):
    page = '<form name="netselect"><select><option  value="AL_NET" selected>Alabama &amp; <b>co</b></option>\n<OPTION value="B">B\nb</OPTION></select></form>'
    df = spark.createDataFrame([(page,)], "html string")
    assert table(documents.network_options(df, "html"), "network") == [("AL_NET", "Alabama & co"), ("B", "B\nb")]


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert table(documents.union_tables([a, b]), "x") == [(1, 2), (3, None)]


def test_selections(spark, tmp_path):
    (tmp_path / "networks.txt").write_text("  gr__net \n\nal_net\n   \n")
    (tmp_path / "dates.txt").write_text("2018/01/01\n 31/12/2020 10:20:30 \n2022/01/01 05:00:00\nnonsense\n")
    assert table(files.read_selection(spark, str(tmp_path / "networks.txt"), "network"), "network") == [("AL_NET",), ("GR__NET",)]
    found = [r[0] for r in files.read_selection(spark, str(tmp_path / "dates.txt"), "valid").collect()]
    assert found == [dt.datetime(2018, 1, 1), dt.datetime(2020, 12, 31, 10, 20, 30), dt.datetime(2022, 1, 1, 5), None]


def test_items(spark, tmp_path):
    (tmp_path / "items.txt").write_text(" a b ;c;;  ;d.e")
    read = lambda **o: [r[0] for r in files.read_items(spark, str(tmp_path / "items.txt"), end=";", **o).collect()]
    assert read() == [["a", "b"], ["c"], ["d.e"]]
    assert read(sep=".") == [["a b"], ["c"], ["d", "e"]]
    assert read(keep_empty=True)[2] == [""]
    assert read(sep="")[1:] == [["c"], ["d", ".", "e"]]
    assert [r[0] for r in files.read_items(spark, str(tmp_path / "items.txt"), end="").collect()][0] == ["a"]


@pytest.mark.parametrize("path, kind", [("x/a.csv", "table"), ("a.JSON", "json"), ("a.html", "text"), ("a.txt", "list"), ("dir/b.parquet/", "parquet"), ("none", "list")])
def test_kind_by_extension(path, kind):
    assert files.file_kind(path) == kind


def test_round_trips_by_kind(spark, tmp_path):
    df = spark.createDataFrame([(1, "p q"), (2, "r,s")], "i int, s string")
    for name, schema_ in (("a.csv", "i int, s string"), ("b.json", None), ("c.parquet", None)):
        path = str(tmp_path / name)
        files.write_table(df, path)
        options = {"schema": "i int, s string", "lines": True} if name == "b.json" else {"schema": schema_}
        assert table(files.read_table(spark, path, **options), "i") == table(df, "i")
    numbers = spark.createDataFrame([([1.0, 2.5],), ([1e-9, -3.0],)], "values array<double>")
    files.write_table(numbers, str(tmp_path / "m.txt"), kind="matrix")
    assert table(files.read_table(spark, str(tmp_path / "m.txt"), kind="matrix"), "values") == table(numbers, "values")
    with pytest.raises(ValueError):
        files.read_table(spark, "x", kind="pickle")


def test_station_and_fire_files(spark, tmp_path):
    (tmp_path / "stations.csv").write_text(
        "elevation,sname,state,country,tzname,county,sid,network,start,end,lat,lon\n"
        "1.0,A,,GR,Europe/Athens,,AAA,N,1932,,40.8,25.9\n2.0,B,,GR,Europe/Athens,,BBB,N,1950,1980,1,2\n3.0,C,,GR,,,CCC,M,2019,,1,2\n")
    read = lambda **o: [r.sid for r in tables.read_stations(spark, str(tmp_path / "stations.csv"), **o).orderBy("sid").collect()]
    assert read() == ["AAA", "BBB", "CCC"]
    assert read(networks="N") == ["AAA", "BBB"] and read(stations=["CCC", "AAA"]) == ["AAA", "CCC"]
    assert read(since="1990-01-01", until="2000-01-01") == ["AAA"]
    assert read(since="1990-01-01", until="2000-01-01", as_of="1985-01-01") == []
    assert read(since="1975-01-01", until="1979-01-01") == ["AAA", "BBB"]
    assert read(since="2000-01-01", until="1990-01-01") == ["AAA", "BBB", "CCC"]
    assert read(until="1940-01-01") == ["AAA"] and read(since="1990-01-01") == ["AAA", "CCC"]
    whole = tables.read_stations(spark, str(tmp_path / "stations.csv"))
    assert tables.station_info(whole, main=True).columns == ["sid", "network"]
    sinks.write_stations(whole, str(tmp_path / "out"), networks="N")
    assert table(tables.read_stations(spark, str(tmp_path / "out")), "sid") == table(whole.where("network = 'N'"), "sid")


def test_fire_rules(spark):
    rows = [("N", 1.0, "2018-01-05", "2018-02-01"), ("N", None, "2017-01-01", None), ("M", 5.0, "2017-01-01", "2019-01-01")]
    df = spark.createDataFrame(rows, "network string, spread double, start string, end string").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
    size = lambda **o: tables.fire_info(df, **o).count()
    # An unknown end matches through the start only.
    assert size(since="2018-01-01", until="2018-12-31") == 2 and size(since="2016-12-01", until="2017-02-01") == 2
    assert size(least_spread=2) == 1 and size(least_spread=0) == 3 and size(networks=["M"]) == 1


def test_membership_and_projection(spark, obs):
    df = obs([("a", "2024-01-01 00:00", 1.0, 2.0, None), ("b", "2024-01-01 00:00", 1.0, 2.0, None)], ["mslp", "tmpf", "feel"])
    assert select.main_columns(df).columns == ["network", "station", "valid", "tmpf", "feel"]
    assert select.drop_empty_columns(df).columns == ["network", "station", "valid", "mslp", "tmpf"]
    assert select.members(df, "station", "a").count() == 1 and select.members(df, "station", ["a", "b"]).count() == 2
    chosen = spark.createDataFrame([("b", "N"), ("b", "N")], "sid string, network string")
    assert select.members(df, "station", chosen, "sid").count() == 1
    assert tables.observations(df, stations=chosen).count() == 1
    assert table(tables.with_network(df.select("station"), chosen.distinct())) == [("b", "N")]


def test_descriptions(obs):
    plain, units = describe.descriptions(), describe.descriptions(units=True)
    assert len(plain) == 30 and plain["tmpf"] == "Air Temperature" and units["tmpf"] == "Air Temperature [°F]"
    clean_ = describe.descriptions(preprocessed=True, units=True)
    assert len(clean_) == 17 and clean_["skyc1"].endswith("(CLR/FEW/SCT/BKN/OVC/VV ordinal encoding)")
    assert clean_["drct_sin"] == "Wind Direction from True North (sine cyclical encoding)" and "drct" not in clean_
    df = obs([("a", "2024-01-01 00:00", None)], ["tmpf"])
    assert describe.described(df, units=True).schema["tmpf"].metadata["description"] == "Air Temperature [°F]"
    assert {r.column: r.present for r in describe.describe_columns(df).collect()} == {"station": 1, "valid": 1, "tmpf": 0}
    assert schema.report_type("skyc1") == "string" and schema.report_type("skyl1") == "double" and schema.report_type("no") is None


def test_pruning_reaches_the_scan(spark, obs, tmp_path):
    rows = [(s, f"2024-01-0{d} 00:00", 1.0, 2.0) for s in "ab" for d in range(1, 6)]
    sinks.write_observations(obs(rows, ["tmpf", "gust"]), str(tmp_path / "o"))
    df = tables.scan_observations(spark, str(tmp_path / "o"), since="2024-01-02", until="2024-01-03", stations="a", columns=["tmpf"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert " = a)" in plan and "__bucket" in df.inputFiles()[0] and "GreaterThanOrEqual(valid" in plan and "gust" not in plan
    assert df.count() == 2


def test_scan_of_a_station_reads_its_bucket(spark, obs, tmp_path):
    path = str(tmp_path / "o")
    names = [f"s{i}" for i in range(40)]
    sinks.write_observations(obs([(s, f"2024-01-0{d} 00:00", float(d)) for s in names for d in (1, 2)], ["tmpf"]), path, buckets=8)
    sinks.write_observations(obs([("new", "2024-01-01 00:00", 7.0)], ["tmpf"]), path)
    every = tables.read_stored(spark, path)
    assert every.count() == 81
    assert len({f.split("__bucket=")[1].split("/")[0] for f in every.inputFiles()}) == 8
    for wanted in ("s3", ["s3"], spark.createDataFrame([("N", "s3")], "network string, sid string")):
        one = tables.scan_observations(spark, path, stations=wanted)
        assert len({f.split("__bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1 and one.count() == 2
    assert tables.scan_observations(spark, path, stations="none").count() == 0
    assert tables.scan_observations(spark, path, networks="N").count() == 81


def test_sink_keeps_and_adds_columns(spark, obs, tmp_path):
    path = str(tmp_path / "o")
    sinks.write_observations(obs([("a", "2024-01-01 00:00", 1.0)], ["tmpf"]), path, buckets=1)
    sinks.write_observations(obs([("b", "2024-01-01 00:00", 2.0)], ["gust"]), path)
    sinks.write_observations(obs([("b", "2024-01-02 00:00", 3.0)], ["gust"]), path, mode="append")
    assert table(tables.read_stored(spark, path).select("station", "tmpf", "gust"), "station", "gust") == [
        ("a", 1.0, None), ("b", None, 2.0), ("b", None, 3.0)]
    with pytest.raises(ValueError):
        sinks.write_observations(obs([("b", "2024-01-01 00:00", "x")], ["gust string"]), path)
    assert tables.read_stored(spark, path).count() == 3


def test_sink_replaces_only_the_stations_written(spark, obs, tmp_path):
    path = str(tmp_path / "o")
    sinks.write_observations(obs([("a", "2024-01-01 00:00", 1.0), ("b", "2024-01-01 00:00", 2.0)], ["tmpf"]), path)
    sinks.write_observations(obs([("b", "2024-01-01 00:00", 9.0)], ["tmpf"]), path)
    assert table(tables.read_stored(spark, path).select("station", "tmpf"), "station") == [("a", 1.0), ("b", 9.0)]


def test_stages_end_to_end(spark, landed, obs, tmp_path):
    layout = stages.Layout(str(tmp_path / "data"))
    stages.run_ingest(landed, layout, order=("part",))
    assert tables.read_stored(spark, layout.fetched).count() == 4
    hours = [(s, f"2024-02-{d:02d} {h:02d}:10", float(h + d), "FEW", None) for s in "ab" for d in range(1, 7) for h in range(24)]
    sinks.write_observations(obs(hours, ["tmpf", "skyc1 string", "dwpf"]), layout.fetched)
    cleaned = stages.run_clean(spark, layout)
    # A measurement nobody has is dropped.
    assert set(cleaned.columns) == {"network", "station", "valid", "tmpf", "skyc1"} and cleaned.count() == 288
    stages.run_preprocess(spark, layout, stations=["a"], split="all", scaler="minmax standard")
    assert tables.read_stored(spark, layout.scaled("minmax")).agg(F.max("tmpf")).first()[0] == 1.0
    assert set(tables.read_stored(spark, layout.split("scaled_standard")).select("station").distinct().collect()[0]) == {"a"}
    assert tables.read_stored(spark, layout.split("clean")).count() == 12
    part = stages.run_cluster(spark, layout, since="2024-02-02", until="2024-02-03 12:00:00", clusters=1, max_iter=1)
    assert part.count() == 2
    labels = stages.run_cluster(spark, layout, clusters=2, refit=True, seed=1, max_iter=2)
    assert labels.count() == 6 and {"tmpf", "skyc1", "feel"} <= set(labels.columns)
    tables_ = reports.station_reports(spark, layout, "modeled")
    assert tables_["stacked"].count() == 12 * 24 and tables_["centers"].count() == 2 * 2 * 24
    distribution = reports.station_reports(spark, layout, "fetched")
    assert {"missing", "histogram", "box", "categories", "monthly"} <= set(distribution)
    assert reports.station_reports(spark, layout, "preprocessed", "clean")["monthly"].count() == 4
    with pytest.raises(ValueError):
        reports.station_reports(spark, layout, "other")


def test_range_of_a_stage(spark, obs, tmp_path):
    layout = stages.Layout(str(tmp_path / "data"))
    sinks.write_observations(obs([("a", f"2024-01-01 {h:02d}:30", float(h)) for h in range(10)], ["tmpf"]), layout.fetched)
    cleaned = stages.run_clean(spark, layout, since="2024-01-01 02:15:00", until="2024-01-01 05:45:00")
    assert [r.tmpf for r in cleaned.orderBy("valid").collect()] == [2.0, 3.0, 4.0, 5.0]


class _Context:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(name, default=None):
            return default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        storage.shared_folder(_Session())


def test_checkpoint_cuts_lineage(spark):
    df = storage.cut_lineage(spark.range(5).selectExpr("id + 1 as x"))
    assert "Project" not in df._jdf.queryExecution().optimizedPlan().toString() and df.count() == 5


def test_payloads_of_any_width_and_quotes(spark):
    extra = [f"x{i}" for i in range(60)]
    head = ",".join(["station", "valid", *extra, "tmpf", "metar"])
    lines = [",".join(["A", "2024-01-01 00:00", *["1"] * 60, "7.5", '"RMK ""A"", B"']), ",".join(["B", "2024-01-01 01:00", *[""] * 60, '"8"', ""])]
    df = spark.createDataFrame([("\n".join([head, *lines]) + "\n",)], "payload string")
    got = {r["station"]: r for r in payloads.parse_payloads(df, extra_columns=True).collect()}
    assert got["A"]["tmpf"] == 7.5 and got["A"]["metar"] == 'RMK "A", B'
    assert got["B"]["tmpf"] == 8.0 and got["B"]["metar"] is None
