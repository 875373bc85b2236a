"""SQL of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from aridspan.plans.analog import FIRST_DAY, LAST_DAY, LAST_HISTORICAL, POLYGONS, TOWNS


def grid(filled: bool = True, place: str = "s_nationkey", first: str = FIRST_DAY) -> str:
    """WITH clause of the daily grid."""
    join = "" if place == "s_nationkey" else "JOIN nation ON s_nationkey = n_nationkey"
    cells = "supplier" if place == "s_nationkey" else "nation"
    value = "coalesce(pr, 0.0)" if filled else "pr"
    return f"""
WITH obs AS (
  SELECT l_returnflag AS model, {place} AS cell, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS pr
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey {join} GROUP BY ALL
), grid AS (
  SELECT m.model, CASE WHEN year(d.day) <= {LAST_HISTORICAL} THEN 'historical' ELSE 'ssp245' END AS experiment,
    m.model || '_' || year(d.day) AS file_id, year(d.day) AS file_year,
    CAST(-35 + 3 * (c.cell // 5) AS DOUBLE) AS lat, CAST(16 + 4 * (c.cell % 5) AS DOUBLE) AS lon,
    c.cell // 5 AS lat_idx, c.cell % 5 AS lon_idx, d.day, CAST({value} AS DOUBLE) AS value
  FROM (SELECT DISTINCT l_returnflag AS model FROM lineitem) m
  CROSS JOIN (SELECT DISTINCT {place} AS cell FROM {cells}) c
  CROSS JOIN (SELECT CAST(g AS DATE) AS day FROM generate_series(DATE '{first}', DATE '{LAST_DAY}', INTERVAL 1 DAY) t(g)) d
  LEFT JOIN obs o ON o.model = m.model AND o.cell = c.cell AND o.day = d.day
)"""


STARTS = {
    "YS": ("CAST(date_trunc('year', day) AS DATE)", "INTERVAL 12 MONTH"),
    "MS": ("CAST(date_trunc('month', day) AS DATE)", "INTERVAL 1 MONTH"),
    "QS-DEC": (
        "CAST(date_trunc('quarter', date_trunc('month', day) + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE)",
        "INTERVAL 3 MONTH",
    ),
}


def spells(hit: str, period: str, source: str = "grid", boundary: str = "file") -> str:
    """Further WITH terms: index_period by two row numbers; a period that lacks a day is null."""
    start, length = STARTS[period]
    file = "file_id" if boundary == "file" else "CAST(NULL AS VARCHAR)"
    return f""", days AS (
  SELECT experiment, model, {file} AS file_id, lat, lon, {start} AS period_start, day, value, coalesce({hit}, false) AS hit FROM {source}
), islands AS (
  SELECT *, row_number() OVER (PARTITION BY experiment, model, file_id, lat, lon, period_start ORDER BY day)
    - row_number() OVER (PARTITION BY experiment, model, file_id, lat, lon, period_start, hit ORDER BY day) AS island FROM days
), runs AS (
  SELECT experiment, model, file_id, lat, lon, period_start, hit, island, count(*) AS n, count(value) AS v FROM islands GROUP BY ALL
), index_period AS (
  SELECT experiment, model, file_id, lat, lon, period_start,
    CASE WHEN sum(v) >= date_diff('day', period_start, CAST(period_start + {length} AS DATE))
         THEN CAST(coalesce(max(n) FILTER (hit), 0) AS DOUBLE) END AS value
  FROM runs GROUP BY experiment, model, file_id, lat, lon, period_start
)"""


def counts(hit: str, period: str) -> str:
    start, _ = STARTS[period]
    return f""", index_period AS (
  SELECT experiment, model, file_id, lat, lon, {start} AS period_start, CAST(count(*) FILTER ({hit}) AS DOUBLE) AS value FROM grid GROUP BY ALL
)"""


TIME_MEAN = ", index_file AS (SELECT experiment, model, file_id, lat, lon, avg(value) AS value FROM index_period GROUP BY ALL)"
PERIODS = " SELECT experiment, model, file_id, lat, lon, period_start, value FROM index_period"
ENSEMBLE = " SELECT experiment, lat, lon, round(avg(value), 6) AS value, count(value) AS n_files FROM index_file GROUP BY ALL"

DRY, WET, HEAVY = "value < 1", "value > 1", "value >= 10"
CDD_FILES = grid() + spells(DRY, "YS") + TIME_MEAN

EDGES = ", ".join(
    f"({i}, '{name}', {x1}, {y1}, {x2}, {y2})"
    for i, name, rings in POLYGONS
    for ring in rings
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])
)
REGIONS = ", ".join(f"({i}, '{name}')" for i, name, _ in POLYGONS)
MASK = f""", edges(region_id, name, x1, y1, x2, y2) AS (VALUES {EDGES}), regions(region_id, name) AS (VALUES {REGIONS}),
mask AS (
  SELECT lat, lon, min(region_id) AS region_id FROM (
    SELECT lat, lon, region_id FROM (SELECT DISTINCT lat, lon FROM grid) CROSS JOIN edges
    WHERE (y1 > lat) <> (y2 > lat) AND lon < CAST(x2 - x1 AS DOUBLE) * (lat - y1) / nullif(CAST(y2 - y1 AS DOUBLE), 0) + x1
    GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY ALL
)"""
MEANS = """, means AS (
  SELECT experiment, region_id, avg(value) AS value FROM (
    SELECT experiment, file_id, region_id, {mean} AS value FROM index_file JOIN mask USING (lat, lon) GROUP BY ALL) GROUP BY ALL
)"""
REGION_MEANS = CDD_FILES + MASK + MEANS.format(mean="avg(value)")
COSLAT = MEANS.format(mean="sum(value * cos(radians(lat))) / nullif(sum(CASE WHEN value IS NOT NULL THEN cos(radians(lat)) END), 0)")

EXPERIMENT = f"CASE WHEN y <= {LAST_HISTORICAL} THEN 'historical' ELSE 'ssp245' END"
EXPECTED = f"""
WITH expected AS (
  SELECT c_custkey AS model, 'pr' AS variable, {EXPERIMENT} AS experiment, y AS year FROM customer CROSS JOIN generate_series(1995, 2001) t(y)
), found AS (
  SELECT DISTINCT o_custkey AS model, 'pr' AS variable, {EXPERIMENT} AS experiment, y AS year, o_orderstatus
  FROM (SELECT *, year(o_orderdate) AS y FROM orders)
)"""
CHECKED = (
    EXPECTED
    + """, checked AS (
  SELECT e.model, e.variable, e.experiment, coalesce(f.n, 0) AS found, e.n AS expected
  FROM (SELECT model, variable, experiment, count(*) AS n FROM expected GROUP BY ALL) e
  LEFT JOIN (SELECT model, variable, experiment, count(*) AS n FROM found GROUP BY ALL) f USING (model, variable, experiment)
)"""
)
STATUS = "CASE WHEN found = expected THEN '✅' WHEN found < expected THEN '⚠️ ' || found || '/' || expected ELSE '🔴 ' || found || '/' || expected END"
SUMS = """SELECT {keys} CAST(sum(found) AS BIGINT) AS found, CAST(sum(expected) AS BIGINT) AS expected,
  sum(found) || '/' || sum(expected) AS total,
  CASE WHEN sum(found) = sum(expected) THEN '✅' WHEN sum(found) > sum(expected) THEN '🔴' ELSE '⚠️' END AS overall,
  CASE WHEN sum(expected) > 0 THEN CAST(sum(found) AS DOUBLE) / CAST(sum(expected) AS DOUBLE) * 100 ELSE 0 END AS percent
FROM checked GROUP BY ALL"""

CATALOG = """
WITH catalog AS (
  SELECT c_mktsegment AS model, o_orderstatus AS experiment, 'r' || (year(o_orderdate) - 1994) || 'i1p1f1' AS run,
    list_sort(list(DISTINCT o_orderpriority)) AS variables
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
)"""
TOWN_ROWS = ", ".join(f"('{c}', {lat}, {lng}, {'NULL' if p is None else p})" for c, lat, lng, p in TOWNS)
