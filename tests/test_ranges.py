"""Files read by ranges, in blocks of days, and picked by a catalogue."""

from __future__ import annotations

import io
import os
import time

import numpy as np
import pytest

from aridspan.config import Bounds
from aridspan.sources import file_catalogue, grid_files, hdf5, netcdf3, ranges
from tests import hdf5_writer

DAYS, LATS, LONS = 120, 60, 80


def content(days=DAYS, units="mm/day", lats=LATS, lons=LONS):
    rng = np.random.default_rng(2)
    pr = rng.random((days, lats, lons)).astype("f4") * 20
    pr[0, 0, 0] = np.nan
    pr[1, 1, 1] = 1e20
    return {
        "time": (("time",), np.arange(days, dtype="f8"), {"units": "days since 2001-01-01", "calendar": "noleap"}),
        "lat": (("lat",), np.arange(lats) * 0.25 - 30, {}), "lon": (("lon",), np.arange(lons) * 0.25 + 10, {}),
        "pr": (("time", "lat", "lon"), pr, {"units": units, "_FillValue": np.array(1e20, "f4")}),
    }


def chunked(**more):
    return hdf5_writer.write(content(**more), (10, 12, 16))


def classic(**more):
    variables = {n: netcdf3.Variable(d, v, {k: (x if isinstance(x, str) else [float(x)]) for k, x in a.items()}) for n, (d, v, a) in content(**more).items()}
    return netcdf3.write(netcdf3.Dataset({d: len(variables[d].values) for d in ("time", "lat", "lon")}, variables))


def ranged(data):
    return ranges.Ranged(io.BytesIO(data), len(data))


@pytest.mark.parametrize("make", [chunked, classic])
def test_a_small_box_fetches_little(make):
    data = make()
    file = ranged(data)
    slabs = grid_files.Slabs(grid_files.header(file, {"pr", "time", "lat", "lon"}), "pr", {"lat": (-29.9, -29.2), "lon": (12.0, 12.7)})
    got = list(slabs.read(20, 40))
    want = content()["pr"][1][20:40, 1:4, 8:11]
    assert [d for d, *_ in got] == list(range(20, 40)) and np.array_equal(np.stack([v for _, _, v, _ in got]), want.astype("f8"))
    assert file.fetched < 0.05 * len(data)


def test_every_region_of_an_array():
    rng = np.random.default_rng(4)
    for data in (chunked(days=23, lats=25, lons=33), classic(days=23, lats=25, lons=33), hdf5_writer.write(content(days=23, lats=25, lons=33))):
        stored = grid_files.header(ranged(data)).variables["pr"].values
        want = content(days=23, lats=25, lons=33)["pr"][1]
        np.testing.assert_array_equal(stored.read(), want)
        for _ in range(40):
            region = tuple(slice(*sorted(rng.integers(0, n + 1, 2).tolist())) for n in stored.shape)
            np.testing.assert_array_equal(stored.read(region), want[region])


def test_pages_and_cut_files():
    data = bytes(range(256)) * 2000
    file = ranged(data)
    assert file[5] == 5 and file[8190:8200] == data[8190:8200] and file[100:400_000] == data[100:400_000] and file[len(data) - 3 :] == data[-3:]
    assert file[len(data) : len(data) + 9] == b"" and len(file) == len(data)
    whole = chunked()
    for bad in (b"", b"\x89HDF", whole[:40], whole[: len(whole) // 2], whole.replace(b"TREE", b"EERT")):
        with pytest.raises((ValueError, IndexError, KeyError, StopIteration)):
            hdf5.opened(ranged(bad)).loaded()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("grid")
    for experiment, model, data in (("historical", "A", chunked()), ("historical", "B", classic()), ("ssp245", "A", classic(days=30))):
        (place / "pr" / model / experiment).mkdir(parents=True)
        (place / "pr" / model / experiment / f"pr_day_{model}_{experiment}_r1i1p1f1_gn_2001.nc").write_bytes(data)
    return place


def test_blocks_of_days_are_the_whole_file(spark, folder, monkeypatch):
    monkeypatch.setattr(grid_files, "BLOCK_BYTES", 100_000)
    box = Bounds(-29.9, -20, 12, 13)
    rows, rejects = grid_files.read_grid(spark, str(folder / "pr" / "A"), bounds=box)
    got = {(r.file_id, r.day_ordinal, r.lat, r.lon): r.value for r in rows.collect()}
    want = content()["pr"][1].astype("f8")
    assert rejects.count() == 0 and len(got) == (DAYS + 30) * 40 * 5
    name = "pr_day_A_historical_r1i1p1f1_gn_2001.nc"
    assert all(v == want[d, round((y + 30) * 4), round((x - 10) * 4)] for (f, d, y, x), v in got.items() if f == name)
    assert grid_files.read_files(spark, str(folder), bounds=box).rdd.getNumPartitions() >= 8
    source = grid_files.register(spark).read.format("gridnc").load(str(folder / "pr" / "A" / "historical"))
    near = source.filter((source.lat >= -29.9) & (source.lat <= -20) & (source.lon >= 12) & (source.lon <= 13))
    assert {(r.day_ordinal, r.lat, r.lon): r.value for r in near.collect()} == {k[1:]: v for k, v in got.items() if k[0] == name}
    reader = grid_files.GridReader(str(folder), "pr", False)
    assert len(reader.partitions()) > 10


def test_missing_values_and_a_broken_chunk(spark, folder, tmp_path, monkeypatch):
    rows, _ = grid_files.read_grid(spark, str(folder / "pr" / "B"))
    assert rows.filter("value IS NULL").count() == 2
    monkeypatch.setattr(grid_files, "BLOCK_BYTES", 100_000)
    data = bytearray(chunked())
    data[len(data) // 2 : len(data) // 2 + 20_000] = b"\0" * 20_000  # in the middle of the values
    (tmp_path / "pr_day_C_historical_r1i1p1f1_gn_2001.nc").write_bytes(data)
    rows, rejects = grid_files.read_grid(spark, str(tmp_path))
    assert rows.count() == 0 and [r.file_id for r in rejects.collect()] == ["pr_day_C_historical_r1i1p1f1_gn_2001.nc"]


def test_speed_of_a_large_grid(tmp_path):
    days = 6
    path = tmp_path / "pr_day_A_historical_r1i1p1f1_gn_2001.nc"
    path.write_bytes(classic(days=days, lats=600, lons=1440))
    file = ranges.opened(str(path))
    began = time.perf_counter()
    slabs = grid_files.Slabs(grid_files.header(file), "pr")
    n = sum(n for _, n in grid_files.day_lines(slabs, 0, days))
    assert n == 600 * days and time.perf_counter() - began < 0.5 * days  # about 0.03 s a day; a wide margin for busy machines
    file.handle.close()


def test_catalogue_opens_only_what_is_new(spark, folder, tmp_path):
    place = f"file://{tmp_path}/catalogue"
    paths = {p.parent.name + p.parent.parent.name: p for p in folder.rglob("*.nc")}
    first = file_catalogue.refresh(spark, f"file://{folder}", place, "pr", ["historical"])
    got = {r.model: r for r in first.collect()}
    assert set(got) == {"A", "B"} and all(r.error is None and r.n_days == DAYS and (r.south, r.east) == (-30.0, 29.75) for r in got.values())
    kept = {}
    for key in ("historicalA", "ssp245A"):  # same path, length and time, other bytes: opening them would show
        kept[key] = paths[key].read_bytes()
        stat = paths[key].stat()
        paths[key].write_bytes(b"x" * stat.st_size)
        os.utime(paths[key], ns=(stat.st_atime_ns, stat.st_mtime_ns))
    try:
        (folder / "bad.nc").write_bytes(b"CDF\1 broken")
        os.makedirs(folder / "pr" / "D" / "historical")
        (folder / "pr" / "D" / "historical" / "pr_day_D_historical_r1i1p1f1_gn_2001.nc").write_bytes(b"CDF\1 broken")
        paths["historicalB"].unlink()
        second = {r.model: r.error for r in file_catalogue.refresh(spark, f"file://{folder}", place, "pr", ["historical"]).collect()}
        assert second["A"] is None and second["D"] and set(second) == {"A", "D"}
    finally:
        for key, data in kept.items():
            paths[key].write_bytes(data)
        paths["historicalB"].write_bytes(classic())
    every = file_catalogue.scan(grid_files.listed_files(spark, f"file://{folder}"))
    assert {r.model for r in file_catalogue.pruned(every, "pr", ["historical"]).collect()} == {"A", "B"}
    assert file_catalogue.pruned(every, "pr", None, Bounds(10, 20, 0, 5)).count() == 0 and file_catalogue.pruned(every, years=(2002, 2010)).count() == 0
    picked = file_catalogue.pruned(every, "pr", ["ssp245"])
    rows, _ = grid_files.parts_of(grid_files.read_files(spark, f"file://{folder}", files=picked))
    assert rows.count() == 30 * LATS * LONS
    rows, _ = grid_files.parts_of(grid_files.read_files(spark, f"file://{folder}", files=picked, ranges=False))
    assert rows.count() == 30 * LATS * LONS
