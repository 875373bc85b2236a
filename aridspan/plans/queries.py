"""The registered queries of the climate engine, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan import sinks
from aridspan.config import Bounds, DownloadConfig, IndexConfig
from aridspan.functions import names
from aridspan.functions.geometry import from_web_mercator
from aridspan.operators import catalog as cat
from aridspan.operators import alignment, ensemble, indices, inventory
from aridspan.operators import grid as gridops
from aridspan.operators import regions as reg
from aridspan.plans import analog, dispatcher
from aridspan.plans import oracles as sql
from aridspan.shipping import kept, shared_dir, shared_folder
from aridspan.schemas import GRID_DAILY, TOWNS
from aridspan.sources import crawl, file_catalogue, grid_files, netcdf3, tables, work
from aridspan.streaming import arrivals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BOX = Bounds(-32.0, -26.0, 20.0, 28.0)


def query(oracle: str | None = None) -> Callable:
    """Registers a query under its function's name."""

    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return add


def periods(spark: SparkSession, sf_dir: str, name: str, period: str, **options) -> DataFrame:
    return indices.index_by_period(analog.grid(spark, sf_dir), indices.spec_of(name), period, **options)


def cdd_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble.time_mean(periods(spark, sf_dir, "cdd", "YS"))


def rounded(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


# grid


@query(sql.grid() + " SELECT model, lat, lon, day, value FROM grid WHERE lat BETWEEN -32 AND -26 AND lon BETWEEN 20 AND 28")
def bbox_filter(spark, sf_dir):
    return gridops.in_box(analog.grid(spark, sf_dir), BOX).select("model", "lat", "lon", "day", "value")


@query(sql.grid() + " SELECT model, lat, lon, sum(value) AS total FROM grid WHERE lat_idx % 2 = 0 AND lon_idx % 2 = 0 GROUP BY ALL")
def stride_sample(spark, sf_dir):
    return gridops.every_nth(analog.grid(spark, sf_dir), 2).groupBy("model", "lat", "lon").agg(F.sum("value").alias("total"))


@query(sql.grid(False) + " SELECT model, lat, lon, day, value * 86400.0 AS value FROM grid WHERE value IS NOT NULL")
def unit_conversion(spark, sf_dir):
    rows = gridops.convert_units(analog.grid(spark, sf_dir, filled=False))
    return rows.filter("value IS NOT NULL").select("model", "lat", "lon", "day", "value")


@query(sql.grid(False) + " SELECT file_id, count(*) FILTER (value >= 10) AS n_hit, count(value) AS n_valid FROM grid GROUP BY ALL")
def nan_is_missing(spark, sf_dir):
    rows = analog.grid(spark, sf_dir, filled=False).withColumn("value", F.coalesce("value", F.lit(float("nan"))))
    rows = gridops.nan_to_null(rows)
    return rows.groupBy("file_id").agg(F.count_if(F.col("value") >= 10).alias("n_hit"), F.count("value").alias("n_valid"))


@query(sql.grid(False) + " SELECT file_id, count(value) AS n_valid FROM grid GROUP BY ALL HAVING count(value) > 0")
def null_guard(spark, sf_dir):
    rows = gridops.null_guard(analog.grid(spark, sf_dir, filled=False))
    return rows.groupBy("file_id").agg(F.count("value").alias("n_valid"))


# indices by period


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.PERIODS)
def cdd_annual(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "YS")


@query(sql.grid() + sql.spells(sql.DRY, "MS") + sql.PERIODS)
def cdd_monthly(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "MS")


@query(sql.grid() + sql.spells(sql.DRY, "QS-DEC") + sql.PERIODS)
def cdd_seasonal(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "QS-DEC")


@query(sql.grid() + f""", days AS (SELECT experiment, model, lat, lon, day, value, coalesce({sql.DRY}, false) AS hit FROM grid
), islands AS (
  SELECT *, row_number() OVER (PARTITION BY experiment, model, lat, lon ORDER BY day)
    - row_number() OVER (PARTITION BY experiment, model, lat, lon, hit ORDER BY day) AS island FROM days
), runs AS (SELECT experiment, model, lat, lon, hit, island, count(*) AS n, count(value) AS v FROM islands GROUP BY ALL)
SELECT experiment, model, lat, lon, CAST(coalesce(max(n) FILTER (hit), 0) AS DOUBLE) AS value, CAST(sum(v) AS BIGINT) AS n_valid
FROM runs GROUP BY ALL HAVING sum(v) > 0""")
def cdd_whole_series(spark, sf_dir):
    """The longest dry spell over all years of a series, from one file to the next."""
    return indices.whole_series(analog.grid(spark, sf_dir), indices.spec_of("cdd")).filter("value IS NOT NULL")


@query(sql.grid() + """, files AS (SELECT * FROM grid WHERE model <> 'R' OR lon >= 24)
SELECT experiment, lat, lon, round(avg(v), 6) AS value, count(*) AS n_files
FROM (SELECT experiment, file_id, lat, lon, avg(value) AS v FROM files GROUP BY ALL) GROUP BY ALL""")
def mean_by_labels(spark, sf_dir):
    """The mean over files of which one model's axes are off by noise and another's box is smaller."""
    grid = analog.grid(spark, sf_dir).filter("model <> 'R' OR lon >= 24")
    noise = F.when(F.col("model") == "N", (F.pmod(F.hash("file_id"), F.lit(9)) - 4) * 1e-8).otherwise(0.0)
    noisy = grid.withColumns({"lat": F.col("lat") + noise, "lon": F.col("lon") - noise})
    axes = [alignment.axis_of(noisy, c) for c in ("lat", "lon")]
    return rounded(ensemble.ensemble_mean(ensemble.time_mean(alignment.on_labels(noisy, *axes))))


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.TIME_MEAN + sql.ENSEMBLE)
def ensemble_kept(spark, sf_dir):
    """The ensemble mean from a table that files were put into, one of them twice and one withdrawn in between."""
    files = ensemble.time_mean(indices.index_by_period(analog.grid(spark, sf_dir), indices.spec_of("cdd")))
    files = kept(files, "index-files")
    table = ensemble.MeanTable(spark, f"{shared_dir(spark)}/aridspan/mean-{uuid.uuid4().hex}", 8)
    table.put(files.filter("model <> 'A'").withColumn("value", F.col("value") + F.when(F.col("model") == "N", 1.0).otherwise(0.0)))
    table.withdraw([r.file_id for r in files.filter("model = 'R'").select("file_id").distinct().collect()])
    table.put(files)
    return rounded(table.mean())


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.PERIODS)
def cdd_annual_by_state(spark, sf_dir):
    """Yearly spells from states of parts of the days: every other day, most days, and the rest, merged."""
    grid = analog.grid(spark, sf_dir)
    spec, n = indices.spec_of("cdd"), F.dayofyear("day")
    parts = [indices.index_state(grid.filter(part), spec) for part in (n % 2 == 0, n % 3 != 1, (n % 2 != 0) & (n % 3 == 1))]
    return indices.index_of_state(parts[0].unionByName(parts[1]).unionByName(parts[2]), spec)


@query(sql.grid() + sql.spells(sql.DRY, "QS-DEC", boundary="series") + sql.PERIODS)
def cdd_seasonal_series(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "QS-DEC", boundary="series")


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.PERIODS)
def cdd_annual_by_fold(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "YS", form="fold")


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.PERIODS)
def cdd_annual_by_lag(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "YS", form="lag")


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.PERIODS)
def cdd_annual_by_islands(spark, sf_dir):
    return periods(spark, sf_dir, "cdd", "YS", form="islands")


@query(sql.grid(False, "n_regionkey", "1995-02-01") + sql.spells("value < 100", "MS") + sql.PERIODS)
def cdd_missing_any(spark, sf_dir):
    rows = analog.grid(spark, sf_dir, filled=False, place="n_regionkey", first="1995-02-01")
    return indices.index_by_period(rows, indices.spec_of("cdd", 100.0), "MS")


@query(sql.grid() + sql.spells(sql.WET, "YS") + sql.PERIODS)
def cwd_annual(spark, sf_dir):
    return periods(spark, sf_dir, "cwd", "YS")


@query(sql.grid() + sql.spells(sql.WET, "MS") + sql.PERIODS)
def cwd_monthly(spark, sf_dir):
    return periods(spark, sf_dir, "cwd", "MS")


@query(sql.grid() + sql.counts(sql.HEAVY, "YS") + sql.PERIODS)
def r10mm_annual(spark, sf_dir):
    return periods(spark, sf_dir, "r10mm", "YS")


@query(sql.grid() + sql.counts(sql.HEAVY, "MS") + sql.PERIODS)
def r10mm_monthly(spark, sf_dir):
    return periods(spark, sf_dir, "r10mm", "MS")


@query(sql.grid() + sql.counts(sql.HEAVY, "QS-DEC") + sql.PERIODS)
def r10mm_seasonal(spark, sf_dir):
    return periods(spark, sf_dir, "r10mm", "QS-DEC")


# means


@query(sql.CDD_FILES + " SELECT experiment, model, file_id, lat, lon, round(value, 6) AS value FROM index_file")
def time_mean(spark, sf_dir):
    return rounded(cdd_files(spark, sf_dir))


@query(sql.CDD_FILES + sql.ENSEMBLE)
def ensemble_cdd(spark, sf_dir):
    return rounded(ensemble.ensemble_mean(cdd_files(spark, sf_dir)))


@query(sql.grid() + sql.spells(sql.WET, "YS") + sql.TIME_MEAN + sql.ENSEMBLE)
def ensemble_cwd(spark, sf_dir):
    return rounded(ensemble.ensemble_mean(ensemble.time_mean(periods(spark, sf_dir, "cwd", "YS"))))


@query(sql.grid() + sql.counts(sql.HEAVY, "YS") + sql.TIME_MEAN + sql.ENSEMBLE)
def ensemble_r10mm(spark, sf_dir):
    return rounded(ensemble.ensemble_mean(ensemble.time_mean(periods(spark, sf_dir, "r10mm", "YS"))))


@query(
    sql.CDD_FILES
    + """ SELECT experiment, lat, lon, round(avg(m), 6) AS value, CAST(sum(n) AS BIGINT) AS n_files FROM (
      SELECT experiment, model, lat, lon, avg(value) AS m, count(value) AS n FROM index_file GROUP BY ALL) GROUP BY ALL"""
)
def ensemble_by_model(spark, sf_dir):
    return rounded(ensemble.ensemble_mean(cdd_files(spark, sf_dir), "models"))


@query(sql.grid() + " SELECT experiment, string_agg(DISTINCT model, ', ' ORDER BY model) AS models FROM grid GROUP BY ALL")
def models_included(spark, sf_dir):
    return ensemble.models_included(analog.grid(spark, sf_dir))


@query(
    sql.grid() + sql.spells(sql.DRY, "YS") + sql.TIME_MEAN
    + ", cdd AS (SELECT experiment, 'cdd' AS index_name, lat, lon, round(avg(value), 6) AS value, count(value) AS n_files FROM index_file GROUP BY ALL)"
    + ", heavy AS (SELECT experiment, file_id, lat, lon, CAST(count(*) FILTER (value >= 12) AS DOUBLE) AS v FROM grid GROUP BY ALL)"
    + " SELECT * FROM cdd WHERE lat BETWEEN -32 AND -26 AND lon BETWEEN 20 AND 28 UNION ALL SELECT experiment, 'r10mm', lat, lon, round(avg(v), 6), count(v)"
    + " FROM heavy WHERE lat BETWEEN -32 AND -26 AND lon BETWEEN 20 AND 28 GROUP BY ALL"
)
def run_all_indices(spark, sf_dir):
    config = IndexConfig(BOX, ["historical", "ssp245"], ["cdd", "unknown", "r10mm"], {"r10mm": 12.0}, {})
    done = dispatcher.run_indices(analog.grid(spark, sf_dir), config)
    return rounded(done.tables["cdd"].unionByName(done.tables["r10mm"]))


# regions


def mask_of(spark, sf_dir) -> DataFrame:
    cells = analog.grid(spark, sf_dir).select("lat", "lon").distinct()
    return reg.cell_region(cells, analog.regions(spark))


@query(sql.grid() + sql.MASK + " SELECT lat, lon, region_id FROM mask")
def cell_region_mask(spark, sf_dir):
    return mask_of(spark, sf_dir)


@query(sql.REGION_MEANS + " SELECT experiment, region_id, round(value, 6) AS value FROM means")
def region_mean(spark, sf_dir):
    return rounded(reg.region_mean(cdd_files(spark, sf_dir), mask_of(spark, sf_dir)))


@query(sql.CDD_FILES + sql.MASK + sql.COSLAT + " SELECT experiment, region_id, round(value, 6) AS value FROM means")
def region_mean_coslat(spark, sf_dir):
    return rounded(reg.region_mean(cdd_files(spark, sf_dir), mask_of(spark, sf_dir), "coslat"))


def historical_means(spark, sf_dir) -> DataFrame:
    means = reg.region_mean(cdd_files(spark, sf_dir), mask_of(spark, sf_dir)).filter("experiment = 'historical'").drop("experiment")
    return rounded(reg.with_names(means, analog.regions(spark)))


NAMED = sql.REGION_MEANS + """, named AS (
  SELECT r.region_id, r.name, round(m.value, 6) AS value FROM regions r
  LEFT JOIN (SELECT * FROM means WHERE experiment = 'historical') m USING (region_id)
)"""


@query(NAMED + " SELECT region_id, name, value, row_number() OVER (ORDER BY value DESC NULLS LAST, name) AS rank FROM named")
def region_rank(spark, sf_dir):
    return reg.rank_regions(historical_means(spark, sf_dir))


@query(NAMED + " SELECT region_id, name, value FROM named ORDER BY value DESC NULLS LAST, name LIMIT 3")
def region_top3(spark, sf_dir):
    return reg.top_regions(historical_means(spark, sf_dir), 3)


@query(NAMED + ", points AS (SELECT region_id, count(*) AS n_points FROM edges GROUP BY ALL) SELECT name, value, n_points FROM named JOIN points USING (region_id)")
def region_merge(spark, sf_dir):
    stats = historical_means(spark, sf_dir).select("name", "value")
    merged = reg.merge_regions(analog.regions(spark), stats)
    return merged.select("name", "value", F.size(F.flatten("rings")).cast("long").alias("n_points"))


@query(NAMED + " SELECT CAST(unnest(range(0, CAST(ceil(max(value) + 10) AS INT), 10)) AS INT) AS tick FROM named")
def map_ticks(spark, sf_dir):
    return reg.legend_ticks(historical_means(spark, sf_dir))


@query("SELECT city, x, y, x + CAST(0.1 AS DOUBLE) AS label_x, y + CAST(0.1 AS DOUBLE) AS label_y FROM"
       " (SELECT s_name AS city, CAST(s_suppkey % 360 AS DOUBLE) - 180 AS x, CAST(s_nationkey AS DOUBLE) * 3 - 36 AS y FROM supplier)")
def town_labels(spark, sf_dir):
    """Suppliers as towns: their points and the places of their labels."""
    place = analog.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("city"), (F.col("s_suppkey") % 360).cast("double").alias("_x"), F.col("s_nationkey").cast("double").alias("_y")
    )
    towns = place.select("city", (F.col("_x") - 180).alias("lng"), (F.col("_y") * 3 - 36).alias("lat"))
    return reg.town_labels(towns).select("city", "point.x", "point.y", "label_x", "label_y")


@query(
    "SELECT s_suppkey, round(degrees(s_suppkey * 1000.0 / 6378137.0), 9) AS lon,"
    " round(degrees(atan((exp(s_suppkey * -2000.0 / 6378137.0) - exp(s_suppkey * 2000.0 / 6378137.0)) / 2)), 9) AS lat FROM supplier"
)
def web_mercator(spark, sf_dir):
    key = F.col("s_suppkey")
    lon, lat = from_web_mercator(key * 1000.0, key * -2000.0)
    return analog.table(spark, sf_dir, "supplier").select("s_suppkey", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


# inventory


def checked(spark, sf_dir) -> DataFrame:
    return inventory.verify(analog.expected_orders(spark, sf_dir), analog.found_orders(spark, sf_dir))


@query(sql.EXPECTED + " SELECT model, variable, experiment, CAST(year AS INT) AS year FROM expected")
def expected_files(spark, sf_dir):
    return analog.expected_orders(spark, sf_dir)


@query(
    "SELECT n_name AS model, coalesce(CASE r_name WHEN 'AFRICA' THEN 'gr' WHEN 'ASIA' THEN 'gr1' END, 'gn') AS grid_label"
    " FROM nation JOIN region ON n_regionkey = r_regionkey"
)
def grid_label_lookup(spark, sf_dir):
    nations = analog.table(spark, sf_dir, "nation")
    regions = analog.table(spark, sf_dir, "region").filter("r_name IN ('AFRICA', 'ASIA')")
    label = F.when(F.col("r_name") == "AFRICA", "gr").otherwise("gr1")
    labels = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("model"), label.alias("grid_label"))
    return inventory.with_grid_label(nations.select(F.col("n_name").alias("model")), labels, "gn").select("model", "grid_label")


@query(
    "SELECT DISTINCT event_type AS experiment, CASE WHEN event_type = 'click' THEN 2015 ELSE 1950 END AS start,"
    ' CASE WHEN event_type = \'click\' THEN 2100 ELSE 2014 END AS "end" FROM events'
)
def time_range_fallback(spark, sf_dir):
    experiments = analog.table(spark, sf_dir, "events").select(F.col("event_type").alias("experiment")).distinct()
    ranges = spark.createDataFrame([("click", 2015, 2100)], "experiment string, start int, end int")
    return inventory.with_time_range(experiments, ranges, (1950, 2014))


@query(
    sql.EXPECTED + " SELECT model, variable, experiment, CAST(year AS INT) AS year FROM expected e WHERE NOT EXISTS"
    " (SELECT 1 FROM found f WHERE f.model = e.model AND f.variable = e.variable AND f.experiment = e.experiment AND f.year = e.year)"
)
def work_list(spark, sf_dir):
    out = inventory.work_list(analog.expected_orders(spark, sf_dir), analog.found_orders(spark, sf_dir))
    return out.select("model", "variable", "experiment", "year")


@query(
    sql.EXPECTED + " SELECT model, CAST(year AS INT) AS year, 'pr_day_M' || model || '_' || year || '_' ||"
    " min_by(o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) || '.nc' AS file FROM found GROUP BY model, year"
)
def version_pick(spark, sf_dir):
    priority = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    found = analog.found_orders(spark, sf_dir).withColumn("priority", priority)
    return inventory.pick_version(found, ["model", "year"])


@query(sql.CHECKED + f" SELECT *, {sql.STATUS} AS status FROM checked")
def verify_detail(spark, sf_dir):
    return inventory.detail(checked(spark, sf_dir))


@query(
    sql.CHECKED + f", marked AS (SELECT *, {sql.STATUS} AS status FROM checked)"
    " SELECT model AS \"Model\", variable AS \"Variable\", max(status) FILTER (experiment = 'historical') AS \"historical (3)\","
    " max(status) FILTER (experiment = 'ssp245') AS \"ssp245 (4)\", sum(found) || '/' || sum(expected) AS \"Total\","
    " CASE WHEN sum(found) = sum(expected) THEN '✅' WHEN sum(found) > sum(expected) THEN '🔴' ELSE '⚠️' END AS \"Overall\" FROM marked GROUP BY model, variable"
)
def verify_report(spark, sf_dir):
    return inventory.detail_report(checked(spark, sf_dir), {"historical": 3, "ssp245": 4})


@query(sql.CHECKED + sql.SUMS.format(keys="model, variable,"))
def verify_totals(spark, sf_dir):
    return inventory.totals(checked(spark, sf_dir), "model", "variable")


@query(sql.CHECKED + sql.SUMS.format(keys="model, experiment,"))
def verify_percent(spark, sf_dir):
    return inventory.totals(checked(spark, sf_dir), "model", "experiment")


@query(
    sql.CHECKED + ", shares AS (SELECT model, experiment, round_even(CAST(sum(found) AS DOUBLE) / CAST(sum(expected) AS DOUBLE) * 100, 1) AS p FROM checked GROUP BY ALL)"
    ' SELECT model AS "Model", coalesce(max(p) FILTER (experiment = \'historical\'), 0) AS historical, coalesce(max(p) FILTER (experiment = \'ssp245\'), 0) AS ssp245 FROM shares GROUP BY model'
)
def verify_by_scenario(spark, sf_dir):
    return inventory.scenario_matrix(checked(spark, sf_dir), ["historical", "ssp245"])


@query(
    sql.CHECKED + " SELECT CAST(sum(found) AS BIGINT) AS found, CAST(sum(expected) AS BIGINT) AS expected,"
    " CAST(sum(found) AS DOUBLE) / CAST(sum(expected) AS DOUBLE) * 100 AS percent, format('{:.2f}%', CAST(sum(found) AS DOUBLE) / CAST(sum(expected) AS DOUBLE) * 100) AS completion FROM checked"
)
def verify_overall(spark, sf_dir):
    return inventory.overall(checked(spark, sf_dir))


@query(sql.EXPECTED + " SELECT model, count(*) AS n_files, CASE WHEN count(*) >= 8 THEN '✅' ELSE '❌ MISSING' END AS status FROM found GROUP BY ALL")
def file_counts_by_model(spark, sf_dir):
    return inventory.count_by_model(analog.found_orders(spark, sf_dir), least=8)


@query(
    sql.EXPECTED + " SELECT model, count(*) FILTER (experiment = 'historical') AS historical, count(*) FILTER (experiment = 'ssp245') AS ssp245 FROM found GROUP BY ALL"
)
def file_counts_model_experiment(spark, sf_dir):
    return inventory.count_by_model_experiment(analog.found_orders(spark, sf_dir), ["historical", "ssp245"])


@query(
    sql.EXPECTED + " SELECT model, rpad(CAST(model AS VARCHAR), 30, ' ') || ' ' || lpad(CAST(count(*) AS VARCHAR), 12, ' ') || ' ' ||"
    " CASE WHEN count(*) >= 1 THEN '✅' ELSE '❌ MISSING' END AS line FROM found GROUP BY model"
)
def status_rows(spark, sf_dir):
    counted = inventory.count_by_model(analog.found_orders(spark, sf_dir))
    return counted.select("model", names.status_row(F.col("model").cast("string"), F.col("n_files"), F.col("status")).alias("line"))


# names


def made_names(spark, sf_dir) -> DataFrame:
    part = analog.table(spark, sf_dir, "part").select("p_partkey")
    key = F.col("p_partkey")
    model = F.when(key % 3 == 0, "GFDL-CM4_gr2").otherwise(F.concat(F.lit("ACCESS-CM"), key % 7))
    experiment = F.when(key % 2 == 0, "historical").otherwise("ssp245")
    made = lambda version: names.file_name(
        F.lit("pr"), model, experiment, F.lit("r1i1p1f1"), F.lit("gn"), 1950 + key % 65, version
    )
    return part.select("p_partkey", model.alias("model"), experiment.alias("experiment"), F.when(key % 5 == 0, made("v1.1")).otherwise(made(None)).alias("file"))


MADE = """
WITH made AS (
  SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'GFDL-CM4_gr2' ELSE 'ACCESS-CM' || (p_partkey % 7) END AS model,
    CASE WHEN p_partkey % 2 = 0 THEN 'historical' ELSE 'ssp245' END AS experiment, 1950 + p_partkey % 65 AS year,
    CASE WHEN p_partkey % 5 = 0 THEN 'v1.1' END AS version FROM part
)"""


@query(
    MADE + " SELECT p_partkey, 'pr' AS variable, model, experiment, 'r1i1p1f1' AS run, 'gn' AS grid_label, CAST(year AS INT) AS year, version FROM made"
)
def filename_parse(spark, sf_dir):
    return made_names(spark, sf_dir).select("p_partkey", names.parsed_name(F.col("file")).alias("n")).select("p_partkey", "n.*")


@query(MADE + " SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN split_part(model, '_', 1) ELSE model END AS model FROM made")
def path_model(spark, sf_dir):
    made = made_names(spark, sf_dir)
    path = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("/data/pr/"), F.col("file"))).otherwise(
        F.concat_ws("/", F.lit("/data/pr"), F.col("model"), F.col("experiment"), F.col("file"))
    )
    return made.select("p_partkey", names.path_model(path, F.col("experiment")).alias("model"))


@query(
    MADE + " SELECT p_partkey, 'https://host/ncss/' || model || '/' || experiment || '/r1i1p1f1/pr/pr_day_' || model || '_' || experiment || '_r1i1p1f1_gn_' || year ||"
    " coalesce('_' || version, '') || '.nc?var=pr&north=-26&west=20&east=28&south=-32&horizStride=1&time_start=' || year || '-01-01T12:00:00Z&time_end=' || year ||"
    " '-12-31T12:00:00Z&accept=netcdf4&addLatLon=true' AS url FROM made"
)
def request_urls(spark, sf_dir):
    made = made_names(spark, sf_dir)
    url = names.request_url(
        F.lit("https://host/ncss/"), F.col("model"), F.col("experiment"), F.lit("r1i1p1f1"), F.lit("pr"), F.col("file"), (1950 + F.col("p_partkey") % 65).cast("int"), BOX
    )
    return made.select("p_partkey", url.alias("url"))


# catalogue


@query(sql.CATALOG + " SELECT DISTINCT model FROM catalog")
def catalog_models(spark, sf_dir):
    return cat.models(analog.catalog(spark, sf_dir))


@query(sql.CATALOG + " SELECT DISTINCT experiment FROM catalog WHERE model = 'BUILDING'")
def catalog_experiments(spark, sf_dir):
    return cat.experiments(analog.catalog(spark, sf_dir), "BUILDING")


@query(sql.CATALOG + " SELECT DISTINCT run FROM catalog WHERE model = 'BUILDING' AND experiment = 'F'")
def catalog_runs(spark, sf_dir):
    return cat.runs(analog.catalog(spark, sf_dir), "BUILDING", "F")


@query(sql.CATALOG + " SELECT DISTINCT unnest(variables) AS variable FROM catalog WHERE model = 'BUILDING' AND experiment = 'F' AND run = 'r2i1p1f1'")
def catalog_vars(spark, sf_dir):
    return cat.variables(analog.catalog(spark, sf_dir), "BUILDING", "F", "r2i1p1f1")


@query(sql.CATALOG + " SELECT experiment, run, array_to_string(variables, ', ') AS variables FROM catalog WHERE model = 'MACHINERY'")
def catalog_info(spark, sf_dir):
    return cat.info(analog.catalog(spark, sf_dir), "MACHINERY")


@query(sql.CATALOG + " SELECT model, experiment, run, '| ' || model || ' | ' || experiment || ' | ' || run || ' | ' || array_to_string(variables, ', ') || ' |' AS line FROM catalog")
def catalog_report(spark, sf_dir):
    tree = analog.catalog(spark, sf_dir)
    runs = tree.groupBy("model", "experiment").agg(F.map_from_entries(F.collect_list(F.struct("run", "variables"))).alias("runs"))
    nested = runs.groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("experiment", "runs"))).alias("tree"))
    return cat.report(cat.flatten(nested))


@query(sql.EXPECTED + " SELECT model, string_agg('pr_day_M' || model || '_' || year || '_' || o_orderstatus || '.nc', ', ' ORDER BY year, o_orderstatus) AS files FROM found GROUP BY ALL")
def catalog_files(spark, sf_dir):
    """The files of a variable's document, in its order."""
    found = analog.found_orders(spark, sf_dir).groupBy("model").agg(F.array_sort(F.collect_list(F.struct("year", "o_orderstatus", "file"))).alias("rows"))
    entries = F.array_join(F.transform("rows", lambda x: F.concat(F.lit('<dataset name="'), x["file"], F.lit('" urlPath="p"/>'))), "")
    documents = found.select(F.col("model").alias("url"), F.concat(F.lit("<catalog>"), entries, F.lit("</catalog>")).alias("xml"))
    return cat.file_list(documents).select(F.col("url").alias("model"), F.array_join("files", ", ").alias("files"))


@query("SELECT r_name AS model, n_name AS experiment, 'b/' || r_name || '/' || n_name || '/catalog.xml' AS url FROM region JOIN nation ON r_regionkey = n_regionkey")
def catalog_level(spark, sf_dir):
    """From a level of the catalogue to the next: a row for each reference of each parent's document."""
    rows = analog.table(spark, sf_dir, "region").join(analog.table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    url = F.concat(F.lit("b/"), F.col("r_name"), F.lit("/catalog.xml"))
    refs = F.array_join(F.transform(F.collect_list("n_name"), lambda n: F.concat(F.lit('<catalogRef xlink:title="'), n, F.lit('"/>'))), "")
    documents = rows.groupBy(url.alias("url")).agg(F.concat(F.lit("<catalog>"), refs, F.lit("</catalog>")).alias("xml"))
    parents = analog.table(spark, sf_dir, "region").select(url.alias("url"), F.col("r_name").alias("model"))
    return crawl.below(parents, documents, "experiment").select("model", "experiment", "url")


@query("SELECT n_nationkey AS k, upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS title, len(regexp_extract_all(n_name, '[^ ]+')) + 2 AS n_tokens FROM nation")
def text_forms(spark, sf_dir):
    nations = analog.table(spark, sf_dir, "nation")
    text = F.concat(F.lit(" a \t"), F.col("n_name"), F.lit("\n  b "))
    return nations.select(F.col("n_nationkey").alias("k"), names.title_case(F.col("n_name")).alias("title"), F.size(names.tokens(text)).cast("long").alias("n_tokens"))


@query("SELECT Model, Variable FROM (SELECT r_name AS Model, v AS Variable, r_regionkey AS i, v = 'pr' AS j FROM region CROSS JOIN (VALUES ('pr'), ('tas')) t(v)) ORDER BY i DESC, j")
def report_order(spark, sf_dir):
    """The wide report's rows in the order of the configuration."""
    rows = analog.table(spark, sf_dir, "region").select(F.col("r_name").alias("Model"), F.explode(F.array(F.lit("pr"), F.lit("tas"))).alias("Variable"))
    models = [r.Model for r in analog.table(spark, sf_dir, "region").orderBy(F.desc("r_regionkey")).select(F.col("r_name").alias("Model")).collect()]
    config = DownloadConfig(BOX, models, [], ["tas", "pr"], "", "", {}, {}, None)
    return inventory.in_config_order(rows, config)


# files


def written_files(spark, sf_dir) -> str:
    """A folder with the daily grid as files of flux, a file that is broken, one of unknown units, and one whose name has
    another form and whose folders say what it is."""
    folder = shared_folder(spark, "grid-files")
    sinks.write_daily(analog.grid(spark, sf_dir, place="n_regionkey"), folder).count()
    place = Path(folder) / "pr" / "Z" / "historical"
    place.mkdir(parents=True, exist_ok=True)
    (place / "pr_day_Z_historical_r1i1p1f1_gn_1995.nc").write_bytes(b"CDF\1 broken")
    for name, units in (("pr_day_Z_historical_r1i1p1f1_gn_1996.nc", b"cubits s-1"), ("other_form.nc", None)):
        raw = next(Path(folder).glob("pr/A/historical/*_1996.nc")).read_bytes()
        (place / name).write_bytes(raw.replace(b"kg m-2 s-1", units) if units else raw)
    return folder


NO_RAIN = "value < 0.5"
FILES = sql.grid(True, "n_regionkey") + ", own AS (SELECT * FROM grid UNION ALL SELECT * REPLACE ('Z' AS model, 'Z_1996' AS file_id) FROM grid WHERE model = 'A' AND file_year = 1996)"


@query(FILES + sql.spells(NO_RAIN, "YS", "own") + sql.TIME_MEAN + sql.ENSEMBLE)
def files_to_cdd(spark, sf_dir):
    """From files of flux to the ensemble mean: the whole way, with units, names and rejects."""
    config = IndexConfig(Bounds(-90.0, 90.0, -180.0, 360.0), ["historical", "ssp245"], ["cdd"], {"cdd": 0.5}, {})
    daily, _ = grid_files.read_grid(spark, f"file://{written_files(spark, sf_dir)}", bounds=config.bounds)
    return rounded(dispatcher.run_index(daily, "cdd", config)).select("experiment", "lat", "lon", "value", "n_files")


@query("SELECT * FROM (VALUES ('pr_day_Z_historical_r1i1p1f1_gn_1995.nc', true), ('pr_day_Z_historical_r1i1p1f1_gn_1996.nc', true)) t(file_id, has_error)")
def files_rejected(spark, sf_dir):
    _, rejects = grid_files.read_grid(spark, f"file://{written_files(spark, sf_dir)}")
    return rejects.select("file_id", F.col("error").isNotNull().alias("has_error"))


@query(FILES + """ SELECT model, count(DISTINCT file_id) FILTER (experiment = 'historical') AS historical, count(DISTINCT file_id) FILTER (experiment = 'ssp245') AS ssp245
FROM own GROUP BY model""")
def files_successful(spark, sf_dir):
    """Files of each model and experiment that can be used: those found without those that a catalogue rejects."""
    folder = f"file://{written_files(spark, sf_dir)}"
    experiments = ["historical", "ssp245"]
    rejects = file_catalogue.scan(grid_files.listed_files(spark, folder)).filter("error IS NOT NULL").select("file_id", "error")
    return inventory.count_by_model_experiment(grid_files.found_files(spark, folder, experiments), experiments, rejects)


@query(FILES + """ SELECT model, experiment, file_year, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS n_days, min(lat) AS south, max(lat) AS north,
  min(lon) AS west, max(lon) AS east FROM own WHERE experiment = 'ssp245' GROUP BY ALL""")
def files_catalogue(spark, sf_dir):
    """What the headers of one experiment's files say about their axes."""
    folder = f"file://{written_files(spark, sf_dir)}"
    files = file_catalogue.pruned(file_catalogue.scan(grid_files.listed_files(spark, folder), "pr", ["ssp245"]), "pr", ["ssp245"], Bounds(-90.0, 90.0, -180.0, 360.0))
    return files.select("model", "experiment", F.col("file_year").cast("long").alias("file_year"), "first_day", "last_day", F.col("n_days").cast("long").alias("n_days"), "south", "north", "west", "east")


@query(FILES + " SELECT model, count(*) FILTER (value >= 9.5) AS n_heavy FROM own WHERE lon BETWEEN 20 AND 28 AND file_year = 1996 AND model <> 'Z' GROUP BY ALL")
def files_by_data_source(spark, sf_dir):
    """Heavy days by the data source gridnc, with box and year pushed into it."""
    folder = written_files(spark, sf_dir)
    rows = grid_files.register(spark).read.format("gridnc").option("variable", "pr").option("errors", "skip").load(folder)
    box = rows.filter((F.col("lon") >= 20.0) & (F.col("lon") <= 28.0) & (F.col("file_year") == 1996))
    return box.groupBy("model").agg(F.count_if(F.col("value") >= 9.5).alias("n_heavy"))


@query(FILES + sql.spells(NO_RAIN, "YS", "own") + sql.TIME_MEAN + sql.MASK + sql.MEANS.format(mean="avg(value)") + """
SELECT r.region_id, r.name, round(m.value, 6) AS value, row_number() OVER (ORDER BY m.value DESC NULLS LAST, r.name) AS rank
FROM regions r LEFT JOIN (SELECT * FROM means WHERE experiment = 'historical') m USING (region_id)""")
def files_to_regions(spark, sf_dir):
    """From files to polygons: each region's mean over the historical files, ranked."""
    config = IndexConfig(Bounds(-90.0, 90.0, -180.0, 360.0), ["historical"], ["cdd"], {"cdd": 0.5}, {})
    daily, _ = grid_files.read_grid(spark, f"file://{written_files(spark, sf_dir)}", bounds=config.bounds)
    shapes = analog.regions(spark)
    files = dispatcher.index_files(daily, "cdd", config)
    return rounded(dispatcher.region_table(files, shapes, "historical"))


@query(
    "SELECT 'n' || n_nationkey AS url, CAST(r.i AS INT) AS position, CASE r.i WHEN 0 THEN n_name WHEN 1 THEN 'T' || n_nationkey END AS name FROM nation CROSS JOIN (VALUES (0), (1)) r(i)"
)
def xml_refs(spark, sf_dir):
    nations = analog.table(spark, sf_dir, "nation")
    xml = F.concat(
        F.lit('<catalog xmlns:xlink="http://www.w3.org/1999/xlink"><catalogRef name="'), F.col("n_name"), F.lit('" xlink:title="x"/><catalogRef name="" xlink:title="T'),
        F.col("n_nationkey"), F.lit('"/><catalogRef/><dataset name="pr_day.nc"/></catalog>'),
    )
    return cat.references(nations.select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("url"), xml.alias("xml")))


@query("SELECT n_nationkey AS url, array_to_string(list_sort([replace(lower(n_name), '_', '-'), 'tas']), ',') AS variables FROM nation")
def xml_variables(spark, sf_dir):
    nations = analog.table(spark, sf_dir, "nation")
    name = F.lower(F.translate("n_name", "_", "-"))
    by_ref = F.concat(F.lit('<c><catalogRef name="'), name, F.lit('"/><catalogRef name="tas"/><dataset name="pr_1.nc"/></c>'))
    by_file = F.concat(F.lit('<c><dataset name="'), name, F.lit('_day_1.nc"/><dataset name="tas_day_1.nc"/><dataset name="tas_day_2.nc"/></c>'))
    xml = F.when(F.col("n_nationkey") % 2 == 0, by_ref).otherwise(by_file)
    found = cat.run_variables(nations.select(F.col("n_nationkey").alias("url"), xml.alias("xml")))
    return found.select("url", F.array_join("variables", ",").alias("variables"))


# what is written and read again, or fetched


@query(sql.CDD_FILES + " SELECT lat, lon, round(avg(value), 6) AS value, 'days' AS units, 'time: maximum time: mean model: mean' AS cell_methods"
       " FROM index_file WHERE experiment = 'historical' GROUP BY lat, lon")
def netcdf_written(spark, sf_dir):
    """An ensemble's mean as a NetCDF file that tasks write in slabs, read back with its attributes."""
    target = Path(shared_folder(spark, "netcdf")) / "cdd.nc"
    sinks.write_netcdf(ensemble.ensemble_mean(cdd_files(spark, sf_dir)), "historical", "max_cdd", target, {"title": "CDD"})

    def rows(frames):
        for frame in frames:
            for path in frame["path"]:
                file = netcdf3.read(Path(path).read_bytes()).variables
                lat, lon = (file[n].values.astype("f8") for n in ("lat", "lon"))
                y, x = np.meshgrid(lat, lon, indexing="ij")
                out = pd.DataFrame({"lat": y.ravel(), "lon": x.ravel(), "value": file["max_cdd"].values.astype("f8").ravel()})
                yield out.assign(units=file["max_cdd"].attributes["units"], cell_methods=file["max_cdd"].attributes["cell_methods"])

    paths = spark.createDataFrame([(str(target),)], "path string")
    return rounded(paths.mapInPandas(rows, "lat double, lon double, value double, units string, cell_methods string")).filter("value IS NOT NULL AND NOT isnan(value)")


@query(ORACLES["verify_report"])
def report_written(spark, sf_dir):
    """The wide report as a CSV with a header, read back."""
    report = verify_report(spark, sf_dir)
    path = f"{shared_dir(spark)}/aridspan/report-{uuid.uuid4().hex}"
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query("SELECT s_name AS city, CAST(s_suppkey % 90 AS DOUBLE) AS lat, CAST(s_nationkey AS DOUBLE) / 4 AS lng, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey END AS population FROM supplier")
def towns_read(spark, sf_dir):
    """Suppliers as towns: a CSV with semicolons, a name of a column between blanks, and holes; read as towns are."""
    supplier = analog.table(spark, sf_dir, "supplier")
    some = {"city": F.col("s_name"), "city_ascii": F.col("s_name"), "lat": F.col("s_suppkey") % 90, "lng": F.col("s_nationkey") / 4, "population": F.when(F.col("s_suppkey") % 3 > 0, F.col("s_suppkey"))}
    columns = [some.get(f.name, F.lit(None).cast("string")).alias(f" {f.name}" if f.name == "population" else f.name) for f in TOWNS.fields]
    path = f"{shared_dir(spark)}/aridspan/towns-{uuid.uuid4().hex}"
    supplier.select(*columns).write.option("header", True).option("sep", ";").csv(path)
    return tables.read_towns(spark, path).select("city", "lat", "lng", "population")


def served(spark, documents: DataFrame) -> str:
    """A folder with documents (place, text) that a URL names; each is written by a task."""
    folder = shared_folder(spark, "served")

    def put(frames):
        for frame in frames:
            for place, text in zip(frame["place"], frame["text"]):
                target = Path(folder) / place
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text(text, encoding="utf-8")
            yield frame[["place"]]

    documents.select("place", "text").mapInPandas(put, "place string").count()
    return folder


@query("SELECT replace(r_name, ' ', '_') AS model, 'historical' AS experiment, 'r' || n_nationkey AS run, CASE WHEN n_nationkey % 2 = 0 THEN 'pr, tas' ELSE 'pr' END AS variables"
       " FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 4")
def catalog_crawled(spark, sf_dir):
    """A catalogue of regions (models) and nations (runs), crawled document by document; those of some runs are not there."""
    nations = analog.table(spark, sf_dir, "nation").join(analog.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nations = nations.select(F.translate("r_name", " ", "_").alias("model"), F.concat(F.lit("r"), F.col("n_nationkey")).alias("run"), "n_nationkey")
    refs = lambda names: F.concat(
        F.lit('<catalog xmlns:xlink="http://www.w3.org/1999/xlink">'), F.array_join(F.transform(names, lambda n: F.concat(F.lit('<catalogRef name="'), n, F.lit('"/>'))), ""), F.lit("</catalog>")
    )
    place = lambda *parts: F.concat_ws("/", *parts, F.lit("catalog.xml"))
    models = nations.groupBy("model").agg(F.collect_set("run").alias("runs"))
    documents = [
        models.agg(F.collect_list("model").alias("m")).select(place().alias("place"), refs(F.col("m")).alias("text")),
        models.select(place("model").alias("place"), refs(F.array(F.lit("historical"))).alias("text")),
        models.select(place("model", F.lit("historical")).alias("place"), refs(F.col("runs")).alias("text")),
        nations.filter("n_nationkey % 5 <> 4").select(
            place("model", F.lit("historical"), "run").alias("place"),
            refs(F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit("pr"), F.lit("tas"))).otherwise(F.array(F.lit("pr")))).alias("text"),
        ),
    ]
    every = documents[0]
    for d in documents[1:]:
        every = every.unionByName(d)
    base = f"file://{served(spark, every)}"
    found = crawl.crawl(spark, base, f"{shared_dir(spark)}/aridspan/crawl-{uuid.uuid4().hex}")
    return found.select("model", "experiment", "run", F.array_join(F.array_sort("variables"), ", ").alias("variables"))


@query("SELECT n_name AS model, CASE n_nationkey % 3 WHEN 0 THEN 'new.nc' WHEN 1 THEN 'old.nc' END AS file, n_nationkey % 3 = 2 AS has_error FROM nation")
def files_downloaded(spark, sf_dir):
    """Downloads for nations: of a third the first candidate is there, of a third only the second, of the others none."""
    nations = analog.table(spark, sf_dir, "nation").select(F.col("n_name").alias("model"), "n_nationkey")
    place = lambda file: F.concat_ws("/", "model", file)
    there = nations.filter("n_nationkey % 3 < 2").select(place(F.when(F.col("n_nationkey") % 3 == 0, "new.nc").otherwise("old.nc")).alias("place"), F.lit("data").alias("text"))
    base = f"file://{served(spark, there)}"
    plan = nations.select(
        "model", F.lit("pr").alias("variable"), F.lit("historical").alias("experiment"), F.lit(2000).alias("year"), F.posexplode(F.array(F.lit("new.nc"), F.lit("old.nc"))).alias("priority", "file")
    ).withColumn("url", F.concat_ws("/", F.lit(base), F.regexp_replace("model", " ", "%20"), "file"))
    done = crawl.download(plan, shared_folder(spark, "downloads"), work.WorkTable(spark, f"{shared_dir(spark)}/aridspan/work-{uuid.uuid4().hex}"))
    return done.select("model", "file", F.col("error").isNotNull().alias("has_error"))


@query(sql.grid() + ", w AS (SELECT *, CAST(DATE '1970-01-01' + CAST(date_diff('day', DATE '1970-01-01', day) // 30 * 30 AS INTEGER) AS DATE) AS start FROM grid)"
       " SELECT experiment, model, lat, lon, start, count(*) FILTER (value >= 10) AS n_days FROM w GROUP BY ALL")
def heavy_days_streamed(spark, sf_dir):
    """Heavy days in windows of 30 days, counted as a stream over stored grid files."""
    place, name = f"{shared_dir(spark)}/aridspan/stream-{uuid.uuid4().hex}", f"heavy_{uuid.uuid4().hex}"
    analog.grid(spark, sf_dir).select(*(F.col(f.name).cast(f.dataType) for f in GRID_DAILY.fields)).write.parquet(place)
    counted = arrivals.heavy_days(arrivals.arrivals(spark, place, 10_000))
    stream = counted.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{place}-checkpoint").trigger(availableNow=True)
    stream.start().awaitTermination()
    return spark.table(name).drop("run")


@query(sql.grid() + sql.spells(sql.DRY, "YS") + sql.PERIODS)
def cdd_annual_streamed(spark, sf_dir):
    """Yearly spells of files whose days arrive in batches of some stored files, several batches to a file."""
    place = f"{shared_dir(spark)}/aridspan/stream-{uuid.uuid4().hex}"
    grid = analog.grid(spark, sf_dir).select(*(F.col(f.name).cast(f.dataType) for f in GRID_DAILY.fields))
    grid.repartition(6, F.pmod("day_ordinal", F.lit(6))).write.parquet(place)
    arrivals.index_files(arrivals.arrivals(spark, place, 2), "cdd", f"{place}-state", f"{place}-checkpoint").awaitTermination()
    return arrivals.index_so_far(spark, "cdd", f"{place}-state")
