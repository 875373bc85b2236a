from __future__ import annotations

import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from aridspan import cli, shipping, sinks
from aridspan.config import Bounds, IndexConfig
from aridspan.operators import grid as gridops
from aridspan.operators import indices
from aridspan.plans import dispatcher
from aridspan.schemas import CATALOG, GRID_DAILY, REGIONS
from aridspan.functions.attributes import MM_A_DAY, described
from aridspan.sources import crawl, grid_files, netcdf3, shapefile, tables
from aridspan.sources.work import WorkTable
from aridspan.streaming.arrivals import arrivals, fold_state, heavy_days, index_files, index_so_far
from tests import hdf5_writer


def sample(days=5, calendar="standard", variable="pr"):
    lat, lon = np.array([-31.0, -30.0]), np.array([20.0, 20.25, 20.5])
    values = np.arange(days * 6, dtype="f4").reshape(days, 2, 3)
    values[1, 0, 0] = np.nan
    values[2, 1, 2] = -999.0
    time = netcdf3.Variable(("time",), np.arange(days, dtype="f8") + 0.5, {"units": "days since 2000-02-27", "calendar": calendar})
    return netcdf3.Dataset(
        {"time": days, "lat": 2, "lon": 3},
        {
            "time": time, "lat": netcdf3.Variable(("lat",), lat, {"units": "degrees_north"}), "lon": netcdf3.Variable(("lon",), lon),
            variable: netcdf3.Variable(("time", "lat", "lon"), values, {"_FillValue": [-999.0], "units": "kg m-2 s-1"}),
        },
        {"title": "sample", "number": 3},
    )


@pytest.fixture
def folder(tmp_path):
    for model, text in (("M1", None), ("M2", b"CDF\1broken")):
        place = tmp_path / "pr" / model / "historical"
        place.mkdir(parents=True)
        (place / f"pr_day_{model}_historical_r1i1p1f1_gn_2000.nc").write_bytes(text or netcdf3.write(sample()))
    return tmp_path


def test_netcdf_round_trip():
    got = netcdf3.read(netcdf3.write(sample()))
    want = sample()
    assert got.dimensions == want.dimensions and got.attributes == {"title": "sample", "number": [3]}
    for name, v in want.variables.items():
        assert got.variables[name].dimensions == v.dimensions
        np.testing.assert_array_equal(got.variables[name].values, v.values)
    with pytest.raises(ValueError):
        netcdf3.read(b"HDF....")


def test_calendars_of_files():
    time = lambda c: grid_files.dates(sample(3, c).variables["time"])
    assert [str(d) for d in time("standard")[0]] == ["2000-02-27", "2000-02-28", "2000-02-29"]
    assert [str(d) for d in time("365_day")[0]] == ["2000-02-27", "2000-02-28", "2000-03-01"]
    days, name = grid_files.dates(sample(4, "360_day").variables["time"])
    assert [str(d)[5:] for d in days] == ["02-27", "02-28", "02-29", "02-29"] and name == "360_day"


def test_reading_grids(spark, folder):
    rows, rejects = grid_files.read_grid(spark, str(folder))
    assert rows.count() == 30 and rows.filter("value IS NULL").count() == 2
    assert rows.agg(F.max("value")).first()[0] == 29 * 86_400.0  # flux, in mm a day
    assert rows.select("model", "experiment", "file_year").distinct().first() == ("M1", "historical", 2000)
    assert [r.file_id for r in rejects.collect()] == ["pr_day_M2_historical_r1i1p1f1_gn_2000.nc"]
    want = rows.filter("lat = -30 AND value > 500000").collect()
    (folder / "pr" / "M2" / "historical" / "pr_day_M2_historical_r1i1p1f1_gn_2000.nc").unlink()
    grid_files.register(spark)
    source = spark.read.format("gridnc").option("variable", "pr").load(str(folder))
    box = source.filter((F.col("lat") >= -30.5) & (F.col("lat") <= -29.0) & (F.col("file_year") == 2000) & (F.col("value") > 500000))
    assert sorted(map(tuple, box.collect()), key=str) == sorted(map(tuple, want), key=str)
    assert source.filter("file_year = 1999").count() == 0


def test_listing(spark, folder):
    found = grid_files.found_files(spark, str(folder), ["historical"]).orderBy("model").collect()
    assert [(r.model, r.variable, r.experiment, r.year) for r in found] == [("M1", "pr", "historical", 2000), ("M2", "pr", "historical", 2000)]
    assert grid_files.listed_files(spark, str(folder)).filter("length > 0").count() == 2


def shape(tmp_path):
    rings = [[(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]
    points = [p for r in rings for p in r]
    body = struct.pack("<i4d2i2i", 5, 0, 0, 4, 4, len(rings), len(points), 0, len(rings[0])) + b"".join(struct.pack("<2d", *p) for p in points)
    shp = b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body + struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    field = b"Name\0\0\0\0\0\0\0C" + b"\0" * 4 + bytes([8]) + b"\0" * 15
    dbf = b"\3\0\0\0" + struct.pack("<IHH", 2, 32 + 32 + 1, 9) + b"\0" * 20 + field + b"\x0d" + b" Fynbos  " + b" Karoo\xc3\xa9 "
    for end, data in ((".shp", shp), (".dbf", dbf), (".prj", b'GEOGCS["GCS_WGS_1984"]'), (".cpg", b"UTF-8")):
        (tmp_path / f"r{end}").write_bytes(data)
    return f"{tmp_path}/r.shp"


def test_shapefiles(spark, tmp_path):
    rows = shapefile.read_regions(spark, shape(tmp_path), "Name").orderBy("region_id").collect()
    assert [(r.name, r.srid, [len(x) for x in r.rings]) for r in rows] == [("Fynbos", 4326, [4, 3]), ("Karooé", 4326, [])]
    assert shapefile.srid('PROJCS["WGS_1984_Web_Mercator"]') == 3857
    with pytest.raises(ValueError):
        shapefile.srid("somewhere else")
    with pytest.raises(FileNotFoundError):
        shapefile.read_regions(spark, f"{tmp_path}/none.shp", "Name")


def test_towns_and_documents(spark, tmp_path):
    (tmp_path / "t.csv").write_text("city;city_ascii;lat;lng;country;iso2;iso3;admin_name;capital; population\nX;X;-30.5;20.25;S;S;S;A;;\nY;Y;-1;2;S;S;S;A;admin;12\n")
    rows = tables.read_towns(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.city, r.lat, r.capital, r.population) for r in rows] == [("X", -30.5, None, None), ("Y", -1.0, "admin", 12)]
    (tmp_path / "c.xml").write_text("<catalog>\n</catalog>")
    assert tables.read_documents(spark, str(tmp_path / "c.xml")).first().xml == "<catalog>\n</catalog>"
    urls = spark.createDataFrame([(f"file://{tmp_path}/c.xml",), (f"file://{tmp_path}/none.xml",)], "url string")
    got = {r.url[-8:]: (r.xml, r.error is None) for r in tables.fetch_documents(urls).collect()}
    assert got == {f"{tmp_path}/c.xml"[-8:]: ("<catalog>\n</catalog>", True), "none.xml": (None, False)}


def test_downloads_take_the_first_that_works_and_leave_no_parts(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "plain.nc").write_bytes(b"data")
    base = f"file://{tmp_path}/src"
    rows = [("A", "pr", "h", 2000, 0, "v.nc", f"{base}/v.nc"), ("A", "pr", "h", 2000, 1, "plain.nc", f"{base}/plain.nc"), ("B", "pr", "h", 2000, 0, "w.nc", f"{base}/w.nc")]
    plan = spark.createDataFrame(rows, "model string, variable string, experiment string, year int, priority int, file string, url string")
    done = {r.model: (r.file, r.error) for r in crawl.download(plan, f"{tmp_path}/out", WorkTable(spark, f"file://{tmp_path}/w", most=1)).collect()}
    assert done["A"] == ("plain.nc", None) and done["B"][0] is None and "w.nc" in done["B"][1]
    assert [p.name for p in (tmp_path / "out").rglob("*") if p.is_file()] == ["plain.nc"]


def test_sinks(spark, tmp_path):
    table = spark.createDataFrame([("h", "cdd", -30.0, 20.0, 1.5, 2), ("h", "cdd", -31.0, 21.0, None, 2), ("s", "cdd", -30.0, 20.0, 3.0, 2)],
                                  "experiment string, index_name string, lat double, lon double, value double, n_files long")
    sinks.write_ensemble(table, f"{tmp_path}/e")
    sinks.write_ensemble(table.filter("experiment = 's'").withColumn("value", F.lit(9.0)), f"{tmp_path}/e")
    assert {(r.experiment, r.value) for r in spark.read.parquet(f"{tmp_path}/e").collect()} == {("h", 1.5), ("h", None), ("s", 9.0)}
    sinks.write_netcdf(table, "h", "max_cdd", tmp_path / "n" / "o.nc", {"title": "t", "units": "days"})
    back = netcdf3.read((tmp_path / "n" / "o.nc").read_bytes())
    assert back.attributes["title"] == "t" and back.variables["max_cdd"].values[1, 0] == 1.5 and np.isnan(back.variables["max_cdd"].values[0, 1])
    sinks.write_report(table.select("experiment", "value"), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 3
    assert "cdd" in sinks.text_table(table)


def daily(spark, days, file="f"):
    rows = spark.range(days).select(
        F.lit("A").alias("model"), F.lit("historical").alias("experiment"), F.lit("pr").alias("variable"), F.lit("r").alias("run"), F.lit("gn").alias("grid_label"),
        F.lit(2001).alias("file_year"), F.lit(file).alias("file_id"), F.lit("standard").alias("calendar"), F.lit(-30.0).alias("lat"), F.lit(20.0).alias("lon"),
        F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.col("id").cast("int").alias("day_ordinal"), (F.col("id") % 12).cast("double").alias("value"),
    )
    return described(rows.select(*(F.col(f.name).cast(f.dataType) for f in GRID_DAILY)), MM_A_DAY)


def test_netcdf_files_are_written_in_slabs(spark, tmp_path):
    cells = spark.range(1000).select((F.col("id") / 4).alias("lat")).crossJoin(spark.range(1200).select((F.col("id") / 4).alias("lon")))
    means = cells.filter("lat <> 3 OR lon > 100").select(F.lit("h").alias("experiment"), "lat", "lon", (F.col("lat") * 1000 + F.col("lon")).alias("value"))
    means = described(means.unionByName(means.limit(5).withColumn("experiment", F.lit("other"))), {"units": "days", "long_name": "L", "cell_methods": "time: mean"})
    target = tmp_path / "n" / "o.nc"
    sinks.write_netcdf(means, "h", "max_cdd", target, {"title": "t", "units": "days"})
    got = netcdf3.read(target.read_bytes())
    lat, lon = np.arange(1000) / 4, np.arange(1200) / 4
    want = lat[:, None] * 1000 + lon[None, :]
    want[12, lon <= 100] = np.nan
    np.testing.assert_array_equal(got.variables["max_cdd"].values, want)
    assert got.variables["max_cdd"].attributes == {"units": "days", "long_name": "L", "cell_methods": "time: mean"} and got.attributes == {"title": "t", "units": "days"}
    assert [p.name for p in target.parent.iterdir()] == ["o.nc"]
    sinks.write_netcdf(means, "h", "max_cdd", target, {"title": "again"})  # replaces the file
    assert netcdf3.read(target.read_bytes()).attributes == {"title": "again"}
    sinks.write_netcdf(means, "nothing", "max_cdd", tmp_path / "none.nc", {})
    assert netcdf3.read((tmp_path / "none.nc").read_bytes()).variables["max_cdd"].values.shape == (0, 0)


@pytest.mark.parametrize("calendar", ["standard", "noleap", "360_day"])
def test_daily_files_keep_their_days(spark, tmp_path, calendar):
    first = grid_files.days_before(dt.date(2001, 3, 2), 70, calendar)
    rows = daily(spark, 40).withColumn("calendar", F.lit(calendar)).withColumn("day_ordinal", F.col("day_ordinal") + 70).filter("day_ordinal <> 90")
    rows = rows.withColumn("day", F.date_add(F.lit("2001-03-02").cast("date"), F.col("day_ordinal") - 70)).filter("day < '2001-03-30'")
    assert sinks.write_daily(rows, str(tmp_path)).first().n_days == 27
    file = next(tmp_path.rglob("*.nc"))
    time = netcdf3.read(file.read_bytes()).variables["time"]
    assert time.attributes["units"] == f"days since {first}"
    got = {(r.day, round(r.value, 9)) for r in grid_files.read_grid(spark, str(tmp_path))[0].collect()}
    assert got == {(r.day, r.value) for r in rows.collect()} and not list(tmp_path.rglob("*.part"))


def test_grid_store_prunes(spark, tmp_path):
    gridops.write_grid(daily(spark, 20).unionByName(daily(spark, 20, "g").withColumn("experiment", F.lit("ssp126"))), f"{tmp_path}/g")
    kept = spark.read.parquet(f"{tmp_path}/g").filter("experiment = 'historical' AND lat >= -31")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 20 and "PartitionFilters: [isnotnull(experiment" in plan and "GreaterThanOrEqual(lat,-31.0)" in plan


def test_streaming(spark, tmp_path):
    whole = daily(spark, 365)
    parts = [whole.filter("day_ordinal < 100"), whole.filter("day_ordinal BETWEEN 90 AND 250"), whole.filter("day_ordinal > 240")]  # some days come twice
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        index_files(arrivals(spark, f"{tmp_path}/in", 1), "cdd", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        got = [r.value for r in index_so_far(spark, "cdd", f"{tmp_path}/out").collect()]
        assert got == ([None] if i < 2 else [1.0])  # a year with missing days is missing
    assert len(list((tmp_path / "out").glob("batch=*"))) == 3
    want = indices.index_by_period(whole, indices.CDD, "MS").count()
    assert want == 12 and indices.index_by_period(whole, indices.CDD).first().value == 1.0
    fold_state(spark, f"{tmp_path}/out", f"{tmp_path}/folded")
    assert index_so_far(spark, "cdd", f"{tmp_path}/folded").first().value == 1.0 and spark.read.parquet(f"{tmp_path}/folded").count() == 1
    whole.unionByName(whole.withColumn("experiment", F.lit("ssp585"))).write.parquet(f"{tmp_path}/two")
    stream = heavy_days(arrivals(spark, f"{tmp_path}/two"))
    query = stream.writeStream.format("memory").queryName("heavy").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    found = {r.experiment: r.n for r in spark.table("heavy").groupBy("experiment").agg(F.sum("n_days").alias("n")).collect()}
    assert found == dict.fromkeys(("historical", "ssp585"), sum(i % 12 >= 10 for i in range(365)))


def test_command_line(spark, tmp_path, capsys):
    spark.createDataFrame([("M", "h", "r1", ["tas", "pr"]), ("L", "h", "r1", ["pr"])], CATALOG).write.parquet(f"{tmp_path}/cat")
    at = ["--catalog", f"{tmp_path}/cat"]
    assert cli.main(["models", *at]) == ["L", "M"]
    assert cli.main(["info", *at, "M"]) == ["h:", "  r1: pr, tas"]
    assert cli.main(["runs", *at, "M", "h"]) == ["r1"]
    assert cli.main(["vars", *at, "M", "h", "r1"]) == ["pr, tas"]
    assert cli.main(["report", *at])[2:] == ["| L | h | r1 | pr |", "| M | h | r1 | pr, tas |"]
    daily(spark, 365).write.parquet(f"{tmp_path}/grid")
    (tmp_path / "i.yml").write_text("region: {lat_min: -35, lat_max: -20, lon_min: 16, lon_max: 33}\nrun_indices: [cdd, none]\n")
    lines = cli.main(["run", "--config", f"{tmp_path}/i.yml", "--grid", f"{tmp_path}/grid", "--out", f"{tmp_path}/o"])
    assert lines[0] == "CDD: done" and lines[1].startswith("NONE: KeyError")
    assert spark.read.parquet(f"{tmp_path}/o/cdd").count() == 1
    place = tmp_path / "data" / "pr" / "A" / "historical"
    place.mkdir(parents=True)
    (place / "pr_day_A_historical_r1i1p1f1_gn_2000.nc").write_bytes(b"x")
    (tmp_path / "d.yml").write_text("region: {lat_min: -35, lat_max: -20, lon_min: 16, lon_max: 33}\nmodels: {select: [A]}\nexperiments: {select: [historical], time_ranges: {historical: [2000, 2001]}}\nvariables: {daily: [pr]}\n")
    lines = cli.main(["verify", "--config", f"{tmp_path}/d.yml", "--data", f"{tmp_path}/data", "--out", f"{tmp_path}/v"])
    assert lines[-3:] == ["Found: 1", "Expected: 2", "Complete: 50.00%"] and lines[1].split()[:2] == ["A", "pr"]


def place(root, data, model="M1", experiment="historical", name=None):
    folder = root / "pr" / model / experiment
    folder.mkdir(parents=True, exist_ok=True)
    (folder / (name or f"pr_day_{model}_{experiment}_r1i1p1f1_gn_2001.nc")).write_bytes(data)


def year_of_rain(mm, units="kg m-2 s-1", factor=1 / 86_400, hdf=False):
    """One year on two cells: mm a day, and nothing."""
    values = np.zeros((365, 1, 2), "f8")
    values[:, 0, 0] = mm * factor
    time = np.arange(365, dtype="f8"), {"units": "days since 2001-01-01", "calendar": "standard"}
    if hdf:
        return hdf5_writer.write({"time": (("time",), *time), "lat": (("lat",), np.array([-30.0]), {}), "lon": (("lon",), np.array([20.0, 21.0]), {}),
                                  "pr": (("time", "lat", "lon"), values, {"units": units})}, (100, 1, 2))
    variables = {
        "time": netcdf3.Variable(("time",), *time), "lat": netcdf3.Variable(("lat",), np.array([-30.0])),
        "lon": netcdf3.Variable(("lon",), np.array([20.0, 21.0])), "pr": netcdf3.Variable(("time", "lat", "lon"), values, {"units": units} if units else {}),
    }
    return netcdf3.write(netcdf3.Dataset({"time": 365, "lat": 1, "lon": 2}, variables))


INDEX_YML = "region: {lat_min: -35, lat_max: -20, lon_min: 16, lon_max: 33}\nexperiments: {select: [historical, ssp245]}\nrun_indices: [cdd, cwd, none, r10mm]\n"


def test_from_files_to_netcdf(spark, tmp_path):
    data = tmp_path / "data"
    place(data, year_of_rain(5.0))
    place(data, year_of_rain(5.0, hdf=True), "M2")
    place(data, year_of_rain(5.0, "mm day-1", 1.0), "M3", name="foreign.nc")
    place(data, year_of_rain(5.0, None), "M4")
    place(data, year_of_rain(5.0, "furlongs"), "M5")
    place(data, b"CDF\1 no", "M6")
    (tmp_path / "i.yml").write_text(INDEX_YML)
    lines = cli.main(["run", "--config", f"{tmp_path}/i.yml", "--data", str(data), "--out", f"{tmp_path}/o"])
    assert "historical: 6 files" in lines and "ssp245: no files found, skipped" in lines and lines[-1].startswith("Completed in")
    assert sum("furlongs" in x for x in lines) == 1 and sum(x.startswith("pr_day_M6") for x in lines) == 1
    usable = [x for x in lines if x.endswith(" ssp245:  0")]
    assert usable == [f"{m:30} historical:  1 ssp245:  0" for m in ("M1", "M2", "M3", "M4")]  # not those of unknown units or broken
    assert "CDD: done" in lines and "R10MM: done" in lines and any(x.startswith("NONE: KeyError") for x in lines)
    for index, output, wet, dry in (("cdd", "max_cdd", 0, 365), ("cwd", "max_cwd", 365, 0), ("r10mm", "r10mm", 0, 0)):
        got = netcdf3.read((tmp_path / "o" / index / f"{index}_ensemble_mean_historical.nc").read_bytes())
        assert got.variables[output].values.tolist() == [[wet, dry]] and got.attributes["models_included"] == "M1, M2, M3, M4"
        assert got.attributes["title"].endswith("- historical") and got.attributes["units"] == "days"
        assert not (tmp_path / "o" / index / f"{index}_ensemble_mean_ssp245.nc").exists()


def test_an_index_that_fails_while_it_is_written_does_not_stop_the_next():
    done = dispatcher.Outcome({"a": 1, "b": 2}, {"c": "no"})

    def write(name, table):
        if name == "a":
            raise OSError("disk")

    assert done.carry_out(write).report() == ["A: OSError: disk", "B: done", "C: no"]


def test_identity_of_files():
    get = lambda p: tuple(grid_files.name_fields(p, "pr")[k] for k in ("variable", "model", "experiment", "file_year"))
    assert get("file:/x/pr/M_a/ssp245/pr_day_B_historical_r1i1p1f1_gn_1999.nc") == ("pr", "M_a", "ssp245", 1999)
    assert get("/flat/pr_day_B_historical_r1i1p1f1_gn_1999_v1.1.nc") == ("pr", "B", "historical", 1999)
    assert get("/x/M/historical/any_2003.nc") == ("pr", "M", "historical", 2003) and get("one_two_three.nc") == ("pr", "three", None, None)
    assert get("/x/M/historical/any.nc") == ("pr", "M", "historical", None)


def test_boxes_and_strides_are_cut_from_files(spark, tmp_path):
    place(tmp_path, netcdf3.write(sample()))
    rows, _ = grid_files.read_grid(spark, str(tmp_path), bounds=Bounds(-31, -30, 20, 20.5, 2))
    assert {(r.lat, r.lon) for r in rows.select("lat", "lon").collect()} == {(-31.0, 20.0), (-31.0, 20.5)}
    rows, rejects = grid_files.read_grid(spark, str(tmp_path), bounds=Bounds(50, 60, 0, 1))
    assert rows.count() == 0 and rejects.count() == 0


def test_daily_files_round_trip(spark, tmp_path):
    rows = daily(spark, 40)
    assert sinks.write_daily(rows, str(tmp_path)).first().n_days == 40
    back, _ = grid_files.read_grid(spark, str(tmp_path))
    want, got = ([tuple(r) for r in x.select("model", "experiment", "day", "lat", "lon", F.round("value", 9)).collect()] for x in (rows, back))
    assert sorted(got) == sorted(want)


def test_regions_of_files(spark, tmp_path):
    place(tmp_path / "data", year_of_rain(5.0))
    rings = {"a": [(19.5, -31.0), (19.5, -29.0), (20.5, -29.0), (20.5, -31.0)], "b": [(20.5, -31.0), (20.5, -29.0), (22.0, -29.0), (22.0, -31.0)]}
    metres = lambda x, y: (np.radians(x) * 6_378_137.0, np.arcsinh(np.tan(np.radians(y))) * 6_378_137.0)
    shapes = spark.createDataFrame([(0, "a", 4326, [rings["a"]]), (1, "b", 3857, [[tuple(map(float, metres(*p))) for p in rings["b"]]]), (2, "c", 4326, [])], REGIONS)
    config = IndexConfig(Bounds(-35, -20, 16, 33), ["historical"], ["cdd"])
    got = dispatcher.run_regions(spark, str(tmp_path / "data"), shapes, config, f"{tmp_path}/o").collect()
    assert [(r.Bioregion, r.Max_CDD_days) for r in got] == [("b", 365.0), ("a", 0.0), ("c", None)]
    assert spark.read.option("header", True).csv(f"{tmp_path}/o/regions_cdd").count() == 3
    with pytest.raises(RuntimeError):
        (tmp_path / "none").mkdir()
        place(tmp_path / "none", b"CDF\1")
        dispatcher.run_regions(spark, str(tmp_path / "none"), shapes, config, f"{tmp_path}/o2")


def test_catalogue_and_download_commands(spark, tmp_path):
    base, ref = tmp_path / "cat", '<c:catalogRef xlink:title="{}" name=""/>'
    for parts, body in {
        (): ref.format("M1") + ref.format("M2"), ("M1",): ref.format("historical"), ("M2",): ref.format("historical"),
        ("M1", "historical"): ref.format("r1"), ("M2", "historical"): ref.format("r1") + ref.format("r2"),
        ("M1", "historical", "r1"): ref.format("tas") + ref.format("pr"), ("M2", "historical", "r1"): '<dataset name="pr_a.nc"/><dataset name="pr_b.nc"/>',
        ("M2", "historical", "r2"): "", ("M1", "historical", "r1", "pr"): '<dataset name="b.nc"/><dataset name="a.nc"/><dataset name="b.nc"/>',
        ("M1", "historical", "r1", "tas"): "",
    }.items():
        folder = base.joinpath(*parts)
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "catalog.xml").write_text(f"<catalog>{body}</catalog>")
    url = f"file://{base}"
    assert cli.main(["crawl", "--base", url, "--out", f"{tmp_path}/t"]) == ["3 runs"]
    at = ["--catalog", f"{tmp_path}/t/catalog"]
    assert cli.main(["info", *at, "M2"]) == ["historical:", "  r1: pr", "  r2: —"] and cli.main(["vars", *at, "M1", "historical", "r1"]) == ["pr, tas"]
    assert cli.main(["vars", *at, "M2", "historical", "r2"]) == ["No variables found"]
    assert cli.main(["files", "--base", url, "M1", "historical", "r1", "pr"]) == ["b.nc", "a.nc", "b.nc"]
    assert cli.main(["files", "--base", url, "M1", "historical", "r1", "tas"]) == ["No files found"]
    with pytest.raises(OSError):
        cli.main(["files", "--base", url, "M1", "historical", "r9", "pr"])
    (tmp_path / "d.yml").write_text("region: {lat_min: -35, lat_max: -20, lon_min: 16, lon_max: 33}\nmodels: {select: [B, A]}\nexperiments: {select: [historical], time_ranges: {historical: [2000, 2001]}}\nvariables: {daily: [tas, pr]}\n")
    place(tmp_path / "data", b"x", "A", name="pr_day_A_historical_r1i1p1f1_gn_2000.nc")
    lines = cli.main(["download", "--config", f"{tmp_path}/d.yml", "--data", f"{tmp_path}/data", "--base", url, "--model", "A", "--variable", "pr"])
    assert len(lines) == 2 and lines[0].startswith("A historical pr 2001: pr_day_A") and lines[1] == "All downloads completed: 1 were there"
    lines = cli.main(["verify", "--config", f"{tmp_path}/d.yml", "--data", f"{tmp_path}/data", "--out", f"{tmp_path}/v"])
    assert [x.split()[:2] for x in lines[1:5]] == [["B", "tas"], ["B", "pr"], ["A", "tas"], ["A", "pr"]]


def test_shared_folder_of_a_cluster_must_be_named(spark):
    assert shipping.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
