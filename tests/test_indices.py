"""Spells, counts and means on hand-made series."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aridspan.functions.periods import expected_days, period_code, period_start
from aridspan.operators import alignment, ensemble, indices
from aridspan.functions.attributes import MM_A_DAY, attributes_of, described
from aridspan.operators.grid import FLUX_TO_MM, convert_units, every_nth, files_without, in_box, nan_to_null, null_guard, require_variable
from aridspan.operators.spells import longest_run
from aridspan.config import Bounds
from aridspan.schemas import GRID_DAILY


def series(spark, values, first="2001-06-01", file="f", model="A", calendar="standard", lat=-30.0, lon=20.0):
    start = dt.date.fromisoformat(first)
    rows = [
        (model, "historical", "pr", "r1i1p1f1", "gn", start.year, file, calendar, lat, lon, start + dt.timedelta(days=i), i, None if v is None else float(v))
        for i, v in enumerate(values)
    ]
    return described(spark.createDataFrame(rows, GRID_DAILY), MM_A_DAY)


GOLDENS = {
    "all dry": ([0] * 10, 10, 0, 0),
    "all wet": ([12] * 10, 0, 10, 10),
    "alternating": ([0, 12] * 5, 1, 1, 5),
    "at threshold": ([1] * 10, 0, 0, 0),
    "exactly ten": ([10] * 10, 0, 10, 10),
    "run at start": ([0] * 3 + [5] * 7, 3, 7, 0),
    "run at end": ([5] * 7 + [0] * 3, 3, 7, 0),
    "one missing": ([0] * 4 + [None] + [0] * 5, 5, 0, 0),
    "all missing": ([None] * 10, 0, 0, 0),
}


@pytest.mark.parametrize("form", ["bits", "blocks", "fold", "lag", "islands"])
def test_longest_runs(spark, form):
    frame = None
    for name, (values, *_) in GOLDENS.items():
        part = series(spark, values, file=name)
        frame = part if frame is None else frame.unionByName(part)
    frame = frame.repartition(3)
    dry = {r.file_id: (r.run, r.n_valid) for r in longest_run(frame, ["file_id"], indices.CDD.hit(F.col("value")), form=form).collect()}
    wet = {r.file_id: r.run for r in longest_run(frame, ["file_id"], indices.CWD.hit(F.col("value")), form=form).collect()}
    for name, (values, cdd, cwd, _) in GOLDENS.items():
        assert dry[name] == (cdd, sum(v is not None for v in values)), name
        assert wet[name] == cwd, name


def test_missing_days_mask_spells_but_not_counts(spark):
    full = [0.0] * 30
    hole = [0.0] * 10 + [None] + [12.0] * 19
    frame = series(spark, full, file="full").unionByName(series(spark, hole, file="hole"))
    cdd = {r.file_id: r.value for r in indices.index_by_period(frame, indices.CDD, "MS").collect()}
    heavy = {r.file_id: r.value for r in indices.index_by_period(frame, indices.R10MM, "MS").collect()}
    assert cdd == {"full": 30.0, "hole": None}
    assert heavy == {"full": 0.0, "hole": 19.0}
    everything_missing = indices.index_by_period(series(spark, [None] * 30), indices.R10MM, "MS").first()
    assert everything_missing.value == 0.0


def test_runs_split_at_period_ends_and_by_file(spark):
    days = series(spark, [0.0] * 62, first="2001-12-01", file="a")
    monthly = {str(r.period_start): r.value for r in indices.index_by_period(days, indices.CDD, "MS").collect()}
    assert monthly == {"2001-12-01": 31.0, "2002-01-01": 31.0}
    second = series(spark, [0.0] * 59, first="2002-01-01", file="b")
    first = series(spark, [0.0] * 31, first="2001-12-01", file="a")
    both = first.unionByName(second)
    by_file = indices.index_by_period(both, indices.CDD, "QS-DEC").collect()
    assert sorted((r.file_id, r.value) for r in by_file) == [("a", None), ("b", None)]
    joined = indices.index_by_period(both, indices.CDD, "QS-DEC", boundary="series").collect()
    assert [(str(r.period_start), r.value) for r in joined] == [("2001-12-01", 90.0)]


def test_calendars(spark):
    leap = series(spark, [0.0] * 366, first="2004-01-01")
    assert indices.index_by_period(leap, indices.CDD, "YS").first().value == 366.0
    no_leap = series(spark, [0.0] * 365, first="2004-01-01", calendar="noleap")
    assert indices.index_by_period(no_leap, indices.CDD, "YS").first().value == 365.0
    assert indices.index_by_period(series(spark, [0.0] * 365, first="2004-01-01"), indices.CDD, "YS").first().value is None
    frame = spark.createDataFrame([(dt.date(2004, 2, 1),), (dt.date(2003, 12, 1),)], "d date")
    for code, calendar, want in (("MS", "standard", [29, 31]), ("MS", "noleap", [28, 31]), ("MS", "360_day", [30, 30]), ("QS-DEC", "noleap", [89, 90])):
        got = [r[0] for r in frame.select(expected_days(F.col("d"), code, F.lit(calendar))).collect()]
        assert got == want, (code, calendar)


def test_bits_run_around_their_circle(spark):
    frame = spark.range(366).select(F.lit("k").alias("k"), (F.col("id") + 300).alias("day_ordinal"), F.lit(0.0).alias("value"))
    hit = F.col("day_ordinal") != 310
    assert longest_run(frame, ["k"], hit).first().run == longest_run(frame, ["k"], hit, form="fold").first().run == 355


def test_a_calendar_without_leap_days_has_no_gap_in_a_series(spark):
    days = series(spark, [0.0] * 59, first="2004-01-01", calendar="noleap")
    rest = series(spark, [0.0] * 306, first="2004-03-01", calendar="noleap", file="g")
    found = indices.index_by_period(days.unionByName(rest), indices.CDD, "YS", boundary="series").first()
    assert found.value == 365.0


def test_period_starts(spark):
    days = ["2010-12-31", "2011-02-28", "2011-03-01", "2012-02-29", "2011-08-31"]
    frame = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    seasons = [str(r[0]) for r in frame.select(period_start(F.col("d"), "QS-DEC")).collect()]
    assert seasons == ["2010-12-01", "2010-12-01", "2011-03-01", "2011-12-01", "2011-06-01"]
    assert [period_code(x) for x in ("annual", "monthly", "seasonal", "weekly", None)] == ["YS", "MS", "QS-DEC", "YS", "YS"]
    with pytest.raises(ValueError):
        period_start(F.col("d"), "W")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(0, 20)), min_size=1, max_size=40))
def test_forms_agree_and_thresholds_order(spark, values):
    frame = series(spark, values).repartition(2)
    runs = [longest_run(frame, ["file_id"], F.col("value") < 1.0, form=f).first().run for f in ("bits", "blocks", "fold", "lag", "islands")]
    assert len(set(runs)) == 1 and runs[0] <= len(values)
    assert longest_run(frame, ["file_id"], F.col("value") < 5.0).first().run >= runs[0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.sampled_from([1, 3, 60, 447, 448, 449, 896, 1000])), min_size=1, max_size=6), st.integers(-2000, 2000), st.sampled_from([0, 5, 448]))
def test_blocks_join_runs_of_any_length(spark, parts, start, hole):
    days, at = [], start
    for dry, n in parts:
        days += [(at + i, 0.0 if dry else 9.0) for i in range(n)]
        at += n + (hole if dry else 0)
    frame = spark.createDataFrame([(1, d, v) for d, v in days], "k int, day_ordinal int, value double").repartition(3)
    got = longest_run(frame, ["k"], F.col("value") < 1.0, form="blocks").first()
    assert (got.run, got.n_valid) == tuple(longest_run(frame, ["k"], F.col("value") < 1.0, form="islands").first())[1:]


def test_a_series_passes_from_file_to_file(spark):
    files = [series(spark, [0.0] * n, first=f"{y}-01-01", file=f"f{y}", calendar=c, lat=lat) for y, n in ((2003, 365), (2004, 366), (2005, 365)) for c, lat in (("standard", 1.0),)]
    files += [series(spark, [0.0] * 365, first=f"{y}-01-01", file=f"n{y}", calendar="noleap", lat=2.0) for y in (2003, 2005)]
    leap = spark.createDataFrame([(dt.date(2004, 1, 1) + dt.timedelta(days=i),) for i in range(366) if i != 59], "day date")
    late = series(spark, [0.0], calendar="noleap", lat=2.0, file="n2004").drop("day").crossJoin(leap).select(*files[0].columns)
    rows = files[0]
    for f in [*files[1:], late]:
        rows = rows.unionByName(f)
    got = {r.lat: (r.value, r.n_valid) for r in indices.whole_series(rows, indices.CDD).collect()}
    assert got == {1.0: (1096.0, 1096), 2.0: (1095.0, 1095)}
    counts = {r.lat: r.value for r in indices.whole_series(rows, indices.R10MM).collect()}
    assert counts == {1.0: 0.0, 2.0: 0.0}


def test_states_of_parts_merge(spark):
    rng = random.Random(8)
    full = series(spark, [rng.choice([0.0, 0.0, 0.5, 12.0, None]) for _ in range(900)], first="2001-01-01", file="a").unionByName(series(spark, [0.0] * 365, first="2001-01-01", file="b"))
    parts = [full.filter(F.pmod(F.hash("day", "file_id"), F.lit(3)) != k) for k in range(3)]  # every day is in two of them
    for spec in (indices.CDD, indices.R10MM):
        state = None
        for p in parts:
            one = indices.index_state(p, spec, "MS")
            state = one if state is None else state.unionByName(one)
        rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
        assert rows(indices.index_of_state(state, spec, "MS")) == rows(indices.index_by_period(full, spec, "MS"))


def test_means_weigh_files_or_models(spark):
    rows = [("e", "A", "a1", 1.0), ("e", "A", "a2", 3.0), ("e", "A", "a3", 5.0), ("e", "B", "b1", 9.0), ("e", "B", "b2", None)]
    frame = spark.createDataFrame([(e, m, f, 0.0, 0.0, v) for e, m, f, v in rows], "experiment string, model string, file_id string, lat double, lon double, value double")
    assert ensemble.ensemble_mean(frame).first().value == 4.5
    assert ensemble.ensemble_mean(frame).first().n_files == 4
    assert ensemble.ensemble_mean(frame, "models").first().value == 6.0
    assert ensemble.models_included(frame).first().models == "A, B"
    assert {r.file_id for r in ensemble.drop_empty_files(frame).collect()} == {"a1", "a2", "a3", "b1"}
    assert ensemble.attributes(frame, "CDD", "d").first().attributes["models_included"] == "A, B"
    with pytest.raises(ValueError):
        ensemble.ensemble_mean(frame, "years")


def test_a_mean_is_kept_as_files_come_change_and_go(spark, tmp_path):
    def file(name, values, model="M", experiment="historical"):
        rows = [(experiment, model, name, 0.0, float(i), v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "experiment string, model string, file_id string, lat double, lon double, value double")

    kept = ensemble.MeanTable(spark, f"file://{tmp_path}/m", groups=3)
    now = {}

    def agree():
        every = None
        for f in now.values():
            every = f if every is None else every.unionByName(f)
        want = [] if every is None else ensemble.ensemble_mean(every).collect()
        key = lambda rows: sorted((r.experiment, r.lat, r.lon, r.n_files, None if r.value is None else round(r.value, 9)) for r in rows)
        return key(kept.mean().collect()) == key(want)

    assert agree()
    for i in range(6):
        now[f"f{i} a/b"] = file(f"f{i} a/b", [float(i), None if i else 3.5, 2.0 * i], experiment=("historical", "ssp")[i % 2])
    first, *rest = now.values()
    kept.put(first)
    for r in rest[1:]:
        rest[0] = rest[0].unionByName(r)
    kept.put(rest[0])
    kept.put(first)  # again
    assert agree()
    now["f2 a/b"] = file("f2 a/b", [100.0, 1.0])  # revised, a cell less
    kept.put(now["f2 a/b"])
    assert agree()
    del now["f1 a/b"], now["f0 a/b"]
    kept.withdraw(["f1 a/b", "f0 a/b", "never there"])
    assert agree()
    kept.withdraw(list(now))
    now.clear()
    assert agree()


def test_grids_meet_by_labels(spark):
    cells = [(round(-30 + i * 0.25, 6), round(10.125 + k * 0.25, 6)) for i in range(6) for k in range(8)]
    rows = [("e", "A", "a", y, x, 1.0) for y, x in cells] + [("e", "B", "b", y + 1e-7, x - 3e-8, 3.0) for y, x in cells]
    rows += [("e", "C", "c", y, x, 5.0) for y, x in cells if x > 11] + [("e", "D", "d", -29.9, 10.125, 7.0)]  # a shifted box, and a cell of no grid
    frame = spark.createDataFrame(rows, "experiment string, model string, file_id string, lat double, lon double, value double").repartition(3)
    axes = [alignment.axis_of(frame.filter("file_id <> 'd'"), c) for c in ("lat", "lon")]
    assert axes == [alignment.Axis(-30.0, 0.25), alignment.Axis(10.125, 0.25)]
    got = {(r.lat, r.lon): (r.value, r.n_files) for r in ensemble.ensemble_mean(alignment.on_labels(frame, *axes)).collect()}
    assert got == {(y, x): (3.0, 3) if x > 11 else (2.0, 2) for y, x in cells} | {(-29.9, 10.125): (7.0, 1)}
    assert [r.file_id for r in alignment.off_labels(frame, *axes).collect()] == ["d"]
    assert alignment.axis_of(frame.filter("file_id = 'd'"), "lat") == alignment.Axis(-29.9, 1.0)
    files = spark.createDataFrame([(-30.0, -28.75, 6, 10.125, 11.875, 8), (-30.0000001, -28.75, 6, 11.125, 11.875, 4)], "south double, north double, n_lat int, west double, east double, n_lon int")
    assert alignment.axes_of_files(files) == tuple(axes) and alignment.axes_of_files(files.limit(0)) is None


def test_grid_filters(spark):
    frame = series(spark, [float("nan"), 1.0]).unionByName(series(spark, [None, None], file="empty", lat=-20.0))
    clean = nan_to_null(frame)
    assert clean.filter("value IS NULL").count() == 3
    assert {r.file_id for r in null_guard(clean).collect()} == {"f"}
    assert convert_units(clean).agg(F.max("value")).first()[0] == FLUX_TO_MM
    assert in_box(clean, Bounds(-30.0, -21.0, 20.0, 20.0)).count() == 2
    assert require_variable(clean, "tasmax").count() == 0
    assert files_without(clean, "tasmax").count() == 2
    with pytest.raises(ValueError):
        require_variable(clean.drop("variable"))
    cells = spark.createDataFrame([(i, j) for i in range(4) for j in range(4)], "lat_idx int, lon_idx int")
    assert every_nth(cells, 2).count() == 4 and every_nth(cells, 1).count() == 16


def test_attributes_travel(spark, tmp_path):
    frame = series(spark, [0.0] * 365, first="2001-01-01")
    files = ensemble.time_mean(indices.index_by_period(in_box(require_variable(frame), Bounds(-90, 90, 0, 90)), indices.CDD))
    means = ensemble.ensemble_mean(files)
    assert attributes_of(means) == {"units": "days", "long_name": "Max Consecutive Dry Days", "cell_methods": "time: maximum time: mean model: mean"}
    means.write.parquet(f"{tmp_path}/m")
    assert attributes_of(spark.read.parquet(f"{tmp_path}/m")) == attributes_of(means)
    assert attributes_of(nan_to_null(frame.unionByName(frame))) == MM_A_DAY
    flux = described(frame, {"units": "kg m-2 s-1"})
    for bad in (flux, described(frame, {})):
        for index in (indices.index_by_period, indices.whole_series, indices.index_state):
            with pytest.raises(ValueError, match="mm/day"):
                index(bad, indices.CDD)
    assert attributes_of(convert_units(flux)) == MM_A_DAY


def test_registry():
    assert indices.spec_of("cdd", 2.0).threshold == 2.0
    with pytest.raises(KeyError):
        indices.spec_of("nothing")
