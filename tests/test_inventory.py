from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aridspan import sinks
from aridspan.config import DownloadConfig, IndexConfig, find_root, read_yaml
from aridspan.functions import names
from aridspan.operators import catalog as cat
from aridspan.operators import inventory
from aridspan.schemas import FOUND_FILES

CONFIG = """
region: {name: test, lat_min: -35.0, lat_max: -21.0, lon_min: 16.0, lon_max: 33.0, stride: 2}
time: {start_year: 1990, end_year: 1991}
models: {select: [A, B-gr_2]}
grid_label_default: gn
grid_labels: {B-gr_2: gr2}
experiments:
  select: [historical, ssp126]
  time_ranges: {historical: [2000, 2002]}
variables: {daily: [pr]}
run: r1i1p1f1
"""


@pytest.fixture
def config(tmp_path):
    (tmp_path / "download.yml").write_text(CONFIG)
    assert find_root(tmp_path / "a" / "b", "download.yml") == tmp_path
    with pytest.raises(FileNotFoundError):
        find_root(tmp_path, "nothing.yml")
    return DownloadConfig.of(read_yaml(tmp_path / "download.yml"))


def test_expected_files(spark, config):
    rows = inventory.expected_files(spark, config).collect()
    assert len(rows) == 2 * (3 + 3)  # the second experiment takes the first one's years
    one = next(r for r in rows if r.model == "B-gr_2" and r.experiment == "ssp126" and r.year == 2001)
    assert one.versioned == "pr_day_B-gr_2_ssp126_r1i1p1f1_gr2_2001_v1.1.nc" and one.plain == one.versioned.replace("_v1.1", "")
    with pytest.raises(KeyError):
        inventory.expected_files(spark, config, strict=True)


def test_plan_leaves_out_what_is_there(spark, config):
    expected = inventory.expected_files(spark, config)
    found = spark.createDataFrame([("A", "pr", "historical", 2000, "x"), ("A", "pr", "historical", 2000, "y")], FOUND_FILES)
    assert inventory.work_list(expected, found).count() == 11
    plan = inventory.plan_downloads(expected, found, config, "https://host/ncss")
    assert plan.count() == 22
    url = plan.filter("model = 'A' AND year = 2001 AND priority = 0 AND experiment = 'historical'").first().url
    assert url == (
        "https://host/ncss/A/historical/r1i1p1f1/pr/pr_day_A_historical_r1i1p1f1_gn_2001_v1.1.nc?var=pr&north=-21&west=16&east=33&south=-35"
        "&horizStride=2&time_start=2001-01-01T12:00:00Z&time_end=2001-12-31T12:00:00Z&accept=netcdf4&addLatLon=true"
    )
    picked = inventory.pick_version(plan.filter("priority = 1 OR model = 'A'"), ["model", "experiment", "year"])
    assert {r.file.endswith("v1.1.nc") for r in picked.filter("model = 'A'").collect()} == {True}


def test_verification(spark):
    expected = spark.createDataFrame([(m, "pr", e, y) for m in "AB" for e in ("historical", "ssp126") for y in (2000, 2001)], "model string, variable string, experiment string, year int")
    rows = [("A", "historical", 2000), ("A", "historical", 2001), ("A", "ssp126", 2000), ("B", "historical", 2000), ("B", "historical", 2001), ("B", "historical", 2001)]
    found = spark.createDataFrame([(m, "pr", e, y, "f") for m, e, y in rows], FOUND_FILES)
    checked = inventory.verify(expected, found)
    status = {(r.model, r.experiment): r.status for r in inventory.detail(checked).collect()}
    assert status == {("A", "historical"): "✅", ("A", "ssp126"): "⚠️ 1/2", ("B", "historical"): "🔴 3/2", ("B", "ssp126"): "⚠️ 0/2"}
    report = {r.Model: r for r in inventory.detail_report(checked, {"historical": 2, "ssp126": 2}).collect()}
    assert (report["A"]["historical (2)"], report["A"].Total, report["A"].Overall) == ("✅", "3/4", "⚠️")
    matrix = {r.Model: (r.historical, r.ssp126) for r in inventory.scenario_matrix(checked, ["ssp126", "historical"]).collect()}
    assert matrix == {"A": (100.0, 50.0), "B": (150.0, 0.0)}
    total = inventory.overall(checked).first()
    assert (total.found, total.expected, total.completion) == (6, 8, "75.00%")
    assert inventory.overall(checked.limit(0)).first().percent == 0.0
    assert {r.model: r.status for r in inventory.count_by_model(found, 3).collect()} == {"A": "✅", "B": "✅"}
    assert {r.model: (r.historical, r.ssp126) for r in inventory.count_by_model_experiment(found, ["historical", "ssp126"]).collect()} == {"A": (2, 1), "B": (3, 0)}


def test_names(spark):
    made = [
        "pr_day_ACCESS-CM2_historical_r1i1p1f1_gn_1950_v1.1.nc", "pr_day_GFDL-CM4_gr2_ssp585_r1i1p1f1_gr2_2015.nc", "notes.txt", None,
    ]
    frame = spark.createDataFrame([(x,) for x in made], "f string")
    got = [r[0] for r in frame.select(names.parsed_name(F.col("f"))).collect()]
    assert (got[0].model, got[0].year, got[0].version) == ("ACCESS-CM2", 1950, "v1.1")
    assert (got[1].model, got[1].grid_label, got[1].version) == ("GFDL-CM4_gr2", "gr2", None)
    assert got[2] is None and got[3] is None
    paths = ["/d/pr/M1/historical/x.nc", "/d/pr_day_M2_x.nc", "historical/a_b_M3.nc"]
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in frame.select(names.path_model(F.col("p"), F.lit("historical"))).collect()] == ["M1", "M2", "M3"]
    half = spark.createDataFrame([(0.25,)], "x double").select(F.bround("x", 1)).first()[0]
    assert half == 0.2


def test_catalogue(spark):
    xml = (
        '<th:catalog xmlns:th="t" xmlns:xlink="x"><th:catalogRef name="B" xlink:title="no"/><th:catalogRef name="" xlink:title="A"/>'
        '<th:catalogRef xlink:href="h"/><th:dataset name="pr_day.nc"/></th:catalog>'
    )
    plain = '<catalog><dataset name="tas_1.nc"/><dataset name="pr_1.nc"/><dataset name="pr_2.nc"/></catalog>'
    documents = spark.createDataFrame([("u", xml), ("v", plain), ("w", "<catalog/>")], "url string, xml string")
    assert [r.name for r in cat.references(documents).orderBy("position").collect()] == ["B", "A"]
    assert [r.name for r in cat.datasets(documents).filter("url = 'v'").orderBy("position").collect()] == ["tas_1.nc", "pr_1.nc", "pr_2.nc"]
    assert {r.url: r.variables for r in cat.run_variables(documents).collect()} == {"u": ["A", "B"], "v": ["pr", "tas"], "w": None}
    assert {r.url: list(r.names) for r in cat.xpath_names(documents).collect()}["u"] == ["B", ""]
    table = spark.createDataFrame([("M", "e", "r2", ["tas", "pr"]), ("M", "e", "r1", []), ("L", "h", "r1", ["pr"])], "model string, experiment string, run string, variables array<string>")
    assert [r.model for r in cat.models(table).collect()] == ["L", "M"]
    assert [r.run for r in cat.runs(table, "M", "e").collect()] == ["r1", "r2"]
    assert {(r.run, r.variables) for r in cat.info(table, "M").collect()} == {("r2", "pr, tas"), ("r1", "—")}
    with pytest.raises(LookupError):
        cat.info(table, "N")
    assert spark.range(1).select(cat.variable_list(F.lit(" a, ,b ,"))).first()[0] == ["a", "b"]


def test_index_config(tmp_path):
    text = "region: {lat_min: -35, lat_max: -20, lon_min: 16, lon_max: 33}\nrun_indices: [r10mm]\ncdd: {threshold_mm: 1.0, aggregation: monthly}\ncwd: {threshold_mm: 2.0, aggregation_code: QS-DEC}\n"
    (tmp_path / "c.yml").write_text(text)
    config = IndexConfig.of(read_yaml(tmp_path / "c.yml"))
    assert config.periods == {"cdd": "MS", "cwd": "QS-DEC"} and config.thresholds["cwd"] == 2.0
    assert config.experiments == ["historical"] and config.bounds.north == -20


def test_text_table_has_all_rows(spark):
    lines = sinks.text_table(spark.range(1_501).toDF("n")).split("\n")
    assert len(lines) == 1_502 and lines[-1].strip() == "1500"
