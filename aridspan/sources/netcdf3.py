"""The classic NetCDF format (CDF-1 and CDF-2), read and written with struct and numpy alone. ``opened`` reads the
header and leaves values in the file until a region of them is asked for; ``read`` has them all."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

from aridspan.sources.ranges import Ranged, Rows, Stored

#: External types by their code in the file.
TYPES = {1: "S1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
CODES = {"S": 2, "i1": 1, "i2": 3, "i4": 4, "f4": 5, "f8": 6}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12


@dataclass
class Variable:
    dimensions: tuple[str, ...]
    values: np.ndarray | Stored
    attributes: dict[str, object] = field(default_factory=dict)


@dataclass
class Dataset:
    dimensions: dict[str, int]
    variables: dict[str, Variable]
    attributes: dict[str, object] = field(default_factory=dict)

    def loaded(self) -> Dataset:
        """The same with all values in memory."""
        whole = {n: Variable(v.dimensions, v.values.read() if isinstance(v.values, Stored) else v.values, v.attributes) for n, v in self.variables.items()}
        return Dataset(self.dimensions, whole, self.attributes)


class _Cursor:
    def __init__(self, data: bytes | Ranged) -> None:
        self.data, self.at = data, 0

    def number(self, form: str = ">i") -> int:
        size = struct.calcsize(form)
        value = struct.unpack(form, self.data[self.at : self.at + size])[0]
        self.at += size
        return value

    def padded(self, size: int) -> bytes:
        out = self.data[self.at : self.at + size]
        self.at += -(-size // 4) * 4
        return out

    def name(self) -> str:
        return self.padded(self.number()).decode()

    def entries(self, tag: int) -> range:
        found, count = self.number(), self.number()
        if found not in (0, tag):
            raise ValueError("the file's header is damaged")
        return range(count)

    def attributes(self) -> dict[str, object]:
        out = {}
        for _ in self.entries(ATTRIBUTE):
            name, code, count = self.name(), self.number(), self.number()
            kind = np.dtype(TYPES[code])
            raw = self.padded(kind.itemsize * count)
            out[name] = raw.decode() if code == 2 else np.frombuffer(raw, kind).tolist()
        return out


def read(data: bytes) -> Dataset:
    """A dataset from a file's bytes; values come unscaled, in their own types."""
    return opened(data).loaded()


def opened(data: bytes | Ranged) -> Dataset:
    """The same with its values left where they are."""
    if data[:3] != b"CDF" or data[3] not in (1, 2):
        raise ValueError("not a classic NetCDF file")
    wide = data[3] == 2
    cursor = _Cursor(data)
    cursor.at = 4
    records = max(0, cursor.number())
    sizes = [(cursor.name(), cursor.number()) for _ in cursor.entries(DIMENSION)]
    attributes = cursor.attributes()
    headers = []
    for _ in cursor.entries(VARIABLE):
        name = cursor.name()
        ids = [cursor.number() for _ in range(cursor.number())]
        own, code, size, begin = cursor.attributes(), cursor.number(), cursor.number(), cursor.number(">q" if wide else ">i")
        headers.append((name, ids, own, np.dtype(TYPES[code]), size, begin))
    unlimited = [i for i, (_, n) in enumerate(sizes) if n == 0]
    moving = [h for h in headers if h[1] and h[1][0] in unlimited]
    step = moving[0][3].itemsize * int(np.prod([sizes[i][1] for i in moving[0][1][1:]], dtype=np.int64)) if len(moving) == 1 else sum(h[4] for h in moving)
    dimensions = {n: records if i in unlimited else size for i, (n, size) in enumerate(sizes)}
    variables = {}
    for name, ids, own, kind, _, begin in headers:
        shape = tuple(dimensions[sizes[i][0]] for i in ids)
        values = Rows(data, kind, shape, begin, step if ids and ids[0] in unlimited else None)
        variables[name] = Variable(tuple(sizes[i][0] for i in ids), values, own)
    return Dataset(dimensions, variables, attributes)


def _pad(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 4)


def _name(text: str) -> bytes:
    raw = text.encode()
    return struct.pack(">i", len(raw)) + _pad(raw)


def _code(values: np.ndarray) -> int:
    return CODES["S" if values.dtype.kind == "S" else f"{values.dtype.kind}{values.dtype.itemsize}"]


def _attributes(attributes: dict[str, object]) -> bytes:
    out = struct.pack(">ii", ATTRIBUTE if attributes else 0, len(attributes))
    for name, value in attributes.items():
        if isinstance(value, str):
            raw = value.encode()
            out += _name(name) + struct.pack(">ii", 2, len(raw)) + _pad(raw)
        else:
            values = np.atleast_1d(np.asarray(value))
            values = values.astype("i4" if values.dtype.kind in "iu" else "f8")
            code = _code(values)
            out += _name(name) + struct.pack(">ii", code, len(values)) + _pad(values.astype(TYPES[code]).tobytes())
    return out


def laid_out(dimensions: dict[str, int], variables: dict[str, tuple[tuple[str, ...], np.dtype, dict[str, object]]], attributes: dict[str, object]) -> tuple[bytes, dict[str, int], int]:
    """The header of a CDF-2 file without an unlimited dimension, where each variable's values begin, and the file's size;
    variables: dimensions, type, attributes."""
    names = list(dimensions)
    head = b"CDF\2" + struct.pack(">i", 0) + struct.pack(">ii", DIMENSION if names else 0, len(names))
    head += b"".join(_name(n) + struct.pack(">i", dimensions[n]) for n in names) + _attributes(attributes)
    head += struct.pack(">ii", VARIABLE if variables else 0, len(variables))
    parts, sizes = [], []
    for name, (dims, kind, own) in variables.items():
        code = CODES["S" if kind.kind == "S" else f"{kind.kind}{kind.itemsize}"]
        size = -(-int(np.prod([dimensions[d] for d in dims], dtype=np.int64)) * np.dtype(TYPES[code]).itemsize // 4) * 4
        ids = struct.pack(f">i{len(dims)}i", len(dims), *(names.index(d) for d in dims))
        parts.append(_name(name) + ids + _attributes(own) + struct.pack(">iI", code, min(size, 2**32 - 1)))
        sizes.append(size)
    at = len(head) + sum(len(p) + 8 for p in parts)
    begins = {}
    for name, part, size in zip(variables, parts, sizes):
        head += part + struct.pack(">q", at)
        begins[name] = at
        at += size
    return head, begins, at


def write(dataset: Dataset) -> bytes:
    """A CDF-2 file without an unlimited dimension."""
    about = {n: (v.dimensions, v.values.dtype, v.attributes) for n, v in dataset.variables.items()}
    head, _, _ = laid_out(dataset.dimensions, about, dataset.attributes)
    return head + b"".join(_pad(v.values.astype(TYPES[_code(v.values)]).tobytes()) for v in dataset.variables.values())
