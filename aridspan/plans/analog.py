"""The engine's tables as views over the star-schema test tables.

model: return flag; cell: supplier nation, on a 5 x 5 grid of coordinates; day: ship date; value: quantity.
A file is a model and a year, an experiment the years up to 1997 or after. Inventories take customers for
models and orders for files; the catalogue takes market segments, order states and priorities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.functions.attributes import MM_A_DAY, described

FIRST_DAY, LAST_DAY, LAST_HISTORICAL = "1995-01-01", "2000-12-31", 1997

#: Hand-made polygons over the grid's coordinates: a square, a concave one, one with a hole, one that
#: overlaps the first, and one without a cell.
POLYGONS = (
    (0, "west", [[(15, -36), (25, -36), (25, -27), (15, -27)]]),
    (1, "north", [[(15, -27), (34, -27), (34, -20), (26, -20), (24, -25), (20, -20), (15, -20)]]),
    (2, "ring", [[(25, -36), (34, -36), (34, -27), (25, -27)], [(27, -33), (29, -33), (29, -31), (27, -31)]]),
    (3, "south", [[(15, -36), (34, -36), (34, -33.5), (15, -33.5)]]),
    (4, "sea", [[(40, -40), (42, -40), (42, -38), (40, -38)]]),
)

TOWNS = (
    ("Kaapstad", -33.93, 18.42, 4_770_313), ("Joburg", -26.20, 28.05, 7_860_781), ("Durban", -29.88, 31.05, 838_634),
    ("Polokwane", -23.90, 29.45, 130_028), ("Nelspruit", -25.47, 30.97, None),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def experiment_of(year: Column) -> Column:
    return F.when(year <= LAST_HISTORICAL, "historical").otherwise("ssp245")


def observations(spark: SparkSession, sf_dir: str, place: str = "s_nationkey") -> DataFrame:
    """model, cell, day, pr: quantities summed."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if place != "s_nationkey":
        supplier = supplier.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model"), "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity"
    )
    rows = items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy("model", F.col(place).alias("cell"), "day").agg(F.sum("l_quantity").alias("pr"))


def grid(spark: SparkSession, sf_dir: str, filled: bool = True, place: str = "s_nationkey", first: str = FIRST_DAY) -> DataFrame:
    """The daily grid: schemas.GRID_DAILY with lat_idx and lon_idx. filled: days without a value are 0, else null."""
    observed = observations(spark, sf_dir, place)
    models = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model")).distinct()
    source = table(spark, sf_dir, "supplier").select("s_nationkey") if place == "s_nationkey" else table(spark, sf_dir, "nation")
    cells = source.select(F.col(place).alias("cell")).distinct()
    days = spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{LAST_DAY}')) AS day")
    rows = models.crossJoin(cells).crossJoin(days).join(observed, ["model", "cell", "day"], "left")
    year = F.year("day")
    value = F.coalesce("pr", F.lit(0.0)) if filled else F.col("pr")
    cells = rows.select(
        "model", experiment_of(year).alias("experiment"), F.lit("pr").alias("variable"), F.lit("r1i1p1f1").alias("run"),
        F.lit("gn").alias("grid_label"), year.alias("file_year"), F.concat_ws("_", "model", year.cast("string")).alias("file_id"),
        F.lit("standard").alias("calendar"),
        (F.lit(-35.0) + 3 * F.floor(F.col("cell") / 5)).cast("double").alias("lat"), (F.lit(16.0) + 4 * (F.col("cell") % 5)).cast("double").alias("lon"),
        "day", F.dayofyear("day").alias("day_ordinal"), value.cast("double").alias("value"),
        F.floor(F.col("cell") / 5).cast("int").alias("lat_idx"), (F.col("cell") % 5).cast("int").alias("lon_idx"),
    )
    return described(cells, MM_A_DAY)


def regions(spark: SparkSession) -> DataFrame:
    rows = [(i, name, 4326, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, name, rings in POLYGONS]
    return spark.createDataFrame(rows, "region_id int, name string, srid int, rings array<array<struct<x: double, y: double>>>")


def towns(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TOWNS), "city string, lat double, lng double, population bigint")


def expected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, variable, experiment, year: each customer in each year from 1995 to 2001."""
    models = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("model"))
    years = spark.range(1995, 2002).select(F.col("id").cast("int").alias("year"))
    return models.crossJoin(years).select("model", F.lit("pr").alias("variable"), experiment_of(F.col("year")).alias("experiment"), "year")


def found_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, variable, experiment, year, file: a file for each year and order state, which stands for its version."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("model"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    file = F.concat(F.lit("pr_day_M"), F.col("model"), F.lit("_"), F.col("year"), F.lit("_"), F.col("o_orderstatus"), F.lit(".nc"))
    return orders.distinct().select("model", F.lit("pr").alias("variable"), experiment_of(F.col("year")).alias("experiment"), "year", "o_orderstatus", file.alias("file"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, experiment, run, variables from segments, order states, years and priorities."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    run = F.concat(F.lit("r"), F.year("o_orderdate") - 1994, F.lit("i1p1f1"))
    return orders.groupBy(F.col("c_mktsegment").alias("model"), F.col("o_orderstatus").alias("experiment"), run.alias("run")).agg(
        F.array_sort(F.collect_set("o_orderpriority")).alias("variables")
    )
