from __future__ import annotations

import itertools

import numpy as np
import pytest

from aridspan.sources import grid_files, hdf5
from tests import hdf5_writer


def variables(days=7, kind="f4", units="kg m-2 s-1"):
    rng = np.random.default_rng(1)
    pr = rng.random((days, 3, 5)).astype(kind)
    pr[1, 1, 1] = 1e20
    many = {f"note_{i}": f"text {i}" for i in range(9)}
    return {
        "time": (("time",), np.arange(days, dtype="f8"), {"units": "days since 2001-01-01", "calendar": "noleap"}),
        "lat": (("lat",), np.array([-31.0, -30.5, -30.0]), {"units": "degrees_north"}),
        "lon": (("lon",), np.arange(5) * 0.25 + 20, {}),
        "pr": (("time", "lat", "lon"), pr, {"units": units, "_FillValue": np.array(1e20, kind), "long_name": "Précipitation", **many}),
    }


@pytest.mark.parametrize("old, chunk, dense", [x for x in itertools.product([True, False], [None, (2, 2, 3)], [None, "flat", "deep"]) if not (x[0] and x[2])])
def test_files_of_either_generation(old, chunk, dense):
    want = variables()
    data = hdf5_writer.write(want, chunk, old, bool(dense), dense == "deep", attributes={"title": "T", "numbers": [1.5, 2.5]})
    got = grid_files.decode(data)
    assert got.dimensions == {"time": 7, "lat": 3, "lon": 5} and got.attributes == {"title": "T", "numbers": [1.5, 2.5]}
    for name, (dims, values, own) in want.items():
        v = got.variables[name]
        assert v.dimensions == dims and v.values.dtype == values.dtype
        np.testing.assert_array_equal(v.values, values)
        assert {k: x for k, x in v.attributes.items() if k != "_FillValue"} == {k: x for k, x in own.items() if k != "_FillValue"}
    assert got.variables["pr"].attributes["_FillValue"] == [np.float32(1e20)]
    assert set(hdf5.read(data, {"lat"}).variables) == {"lat"}


def test_chunks_that_are_not_there_hold_the_fill_value():
    want = variables()
    data = hdf5_writer.write(want, (2, 3, 5), leave_out={(4, 0, 0)})
    got = hdf5.read(data).variables["pr"].values
    assert (got[4:6] == np.float32(1e20)).all() and (got[6] == want["pr"][1][6]).all()


def test_big_endian_numbers():
    want = variables(kind=">f4")
    np.testing.assert_array_equal(hdf5.read(hdf5_writer.write(want, old=True)).variables["pr"].values, want["pr"][1])


def test_broken_files_are_errors():
    data = hdf5_writer.write(variables(), (2, 2, 3))
    for bad in (b"", b"\x89HDF", data[:40], data[: len(data) // 2], data.replace(b"TREE", b"EERT")):
        with pytest.raises((ValueError, IndexError, KeyError, StopIteration)):
            hdf5.read(bad)
