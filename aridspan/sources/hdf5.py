"""The HDF5 files that NetCDF-4 makes, read with struct, zlib and numpy alone.

What is read, after the public file format specification: superblocks 0 to 3; object headers 1 and 2 with their
continuations; links in symbol tables, in headers and in fractal heaps; integers, floats and texts; contiguous,
compact and chunked data (version 1 B-trees), with deflate, shuffle and checksums; attributes in headers and in
fractal heaps, and texts and references of variable length in global heaps. Anything else (other chunk indices,
other filters, external files) raises a ValueError that says so. A file may be given by ranges; of a chunked variable only
those chunks are fetched and inflated that meet the region asked for, and only the branches of the chunks' tree that lead there.

Attributes named ``_Netcdf4...``, ``DIMENSION_LIST`` and the like bind variables to dimensions and do not show.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

from aridspan.sources.netcdf3 import Dataset, Variable
from aridspan.sources.ranges import Ranged, Region, Rows, Stored

SIGNATURE = b"\x89HDF\r\n\x1a\n"
# fixed values of the file format: message types ...
SPACE, LINK_INFO, TYPE, FILL, LINK, LAYOUT, FILTERS, ATTRIBUTE, CONTINUED, SYMBOLS, ATTRIBUTE_INFO = 1, 2, 3, 5, 6, 8, 11, 12, 16, 17, 21
# ... and filters
DEFLATE, SHUFFLE, CHECKSUM = 1, 2, 3
#: Attributes that only bind variables to dimensions.
HIDDEN = {"DIMENSION_LIST", "REFERENCE_LIST", "CLASS", "NAME", "_Netcdf4Dimid", "_Netcdf4Coordinates", "_nc3_strict", "_NCProperties"}


class _Type:
    """A datatype: a numpy type, a fixed text, or a sequence of variable length of another type."""

    def __init__(self, raw: bytes) -> None:
        head, bits, self.size = raw[0], raw[1] | raw[2] << 8 | raw[3] << 16, struct.unpack_from("<I", raw, 4)[0]
        self.kind, order = head & 15, ">" if bits & 1 else "<"
        self.text = self.kind == 3
        self.base = None
        if self.kind == 0:
            self.numpy = np.dtype(f"{order}{'i' if bits & 8 else 'u'}{self.size}")
        elif self.kind == 1:
            self.numpy = np.dtype(f"{order}f{self.size}")
        elif self.kind == 3:
            self.numpy = np.dtype(f"S{self.size}")
        elif self.kind == 7:
            self.numpy = np.dtype(f"<u{self.size}") if self.size in (4, 8) else np.dtype(f"V{self.size}")
        else:
            self.numpy = np.dtype(f"V{self.size}")
        if self.kind == 9:
            self.base, self.text = _Type(raw[8:]), bits & 15 == 1


class _File:
    def __init__(self, data: bytes | Ranged) -> None:
        start = next((p for p in (0, *(512 << i for i in range(8))) if data[p : p + 8] == SIGNATURE), -1)
        if start < 0:
            raise ValueError("not an HDF5 file")
        self.data, version = data, data[start + 8]
        at = start + (13 if version < 2 else 9)
        self.o, self.l = data[at], data[at + 1]
        if version < 2:
            at = start + 24 + (4 if version == 1 else 0)
            self.base = self.number(at, self.o)
            self.root = self.base + self.number(at + 4 * self.o + self.o, self.o)
        else:
            self.base = self.number(start + 12, self.o)
            self.root = self.base + self.number(start + 12 + 3 * self.o, self.o)
        self.heaps: dict[int, dict[int, bytes]] = {}

    def number(self, at: int, size: int) -> int:
        if at + size > len(self.data):
            raise ValueError("the file is cut off")
        return int.from_bytes(self.data[at : at + size], "little")

    def address(self, at: int) -> int | None:
        """The address that stands at a place; None where it is undefined."""
        value = self.number(at, self.o)
        return None if value == (1 << 8 * self.o) - 1 else value + self.base

    def signed(self, at: int, signature: bytes) -> int:
        if self.data[at : at + 4] != signature:
            raise ValueError(f"no {signature.decode()} where one should be")
        return at + 4

    # object headers

    def messages(self, at: int) -> Iterator[tuple[int, int, int]]:
        """(type, place, size) of each message of the object header at a place."""
        if self.data[at : at + 4] == b"OHDR":
            flags = self.data[at + 5]
            at += 6 + (16 if flags & 32 else 0) + (4 if flags & 16 else 0)
            width = 1 << (flags & 3)
            blocks = [(at + width, self.number(at, width))]
            head = 6 if flags & 4 else 4
        else:
            if self.data[at] != 1:
                raise ValueError("this object header is not known")
            blocks, head, flags = [(at + 16, self.number(at + 8, 4))], 8, None
        for at, size in blocks:
            end = at + size
            while at + head <= end:
                if flags is None:
                    kind, n, shared = self.number(at, 2), self.number(at + 2, 2), self.data[at + 4]
                else:
                    kind, n, shared = self.data[at], self.number(at + 1, 2), self.data[at + 3]
                at += head
                if kind == CONTINUED:
                    place, size = self.address(at), self.number(at + self.o, self.l)
                    blocks.append((place, size) if flags is None else (self.signed(place, b"OCHK"), size - 8))
                elif shared & 2 and kind == TYPE:
                    raise ValueError("named datatypes are not read")
                elif kind:
                    yield kind, at, n
                at += n

    # links and attributes

    def links(self, at: int) -> dict[str, int]:
        """Objects of the group whose header is at a place."""
        out: dict[str, int] = {}
        for kind, m, _ in self.messages(at):
            if kind == LINK:
                out |= self.link(m)
            elif kind == LINK_INFO:
                m += 2 + (8 if self.data[m + 1] & 1 else 0)
                for place in self.heap_objects(self.address(m), self.address(m + self.o), 4):
                    out |= self.link(place)
            elif kind == SYMBOLS:
                heap = self.signed(self.address(m + self.o), b"HEAP")
                names = self.address(heap + 4 + 2 * self.l)
                for node in self.leaves(self.address(m), 0, self.l):
                    node = self.signed(node, b"SNOD")
                    for i in range(self.number(node + 2, 2)):
                        entry = node + 4 + i * (2 * self.o + 24)
                        name = names + self.number(entry, self.o)
                        out[self.text(name)] = self.address(entry + self.o)
        return out

    def text(self, at: int) -> str:
        """What stands at a place up to a zero."""
        out = b""
        while (end := out.find(b"\0")) < 0:
            more = self.data[at + len(out) : at + len(out) + 64]
            if not more:
                raise ValueError("the file is cut off")
            out += more
        return out[:end].decode()

    def link(self, at: int) -> dict[str, int]:
        flags = self.data[at + 1]
        at += 2
        if flags & 8:
            if self.data[at]:
                return {}  # a soft or external link
            at += 1
        at += (8 if flags & 4 else 0) + (1 if flags & 16 else 0)
        width = 1 << (flags & 3)
        n = self.number(at, width)
        at += width
        return {self.data[at : at + n].decode(): self.address(at + n)}

    def attributes(self, at: int) -> dict[str, object]:
        out: dict[str, object] = {}
        for kind, m, _ in self.messages(at):
            if kind == ATTRIBUTE:
                out |= self.attribute(m)
            elif kind == ATTRIBUTE_INFO:
                m += 2 + (2 if self.data[m + 1] & 1 else 0)
                for place in self.heap_objects(self.address(m), self.address(m + self.o), 0):
                    out |= self.attribute(place)
        return out

    def attribute(self, at: int) -> dict[str, object]:
        version, flags = self.data[at], self.data[at + 1]
        sizes = [self.number(at + 2 + 2 * i, 2) for i in range(3)]
        at += 8 + (version == 3)
        if version > 1 and flags & 3:
            return {}  # of a named datatype or dataspace
        places = []
        for n in sizes:
            places.append(at)
            at += -(-n // 8) * 8 if version == 1 else n
        name = self.data[places[0] : places[0] + sizes[0]].split(b"\0")[0].decode()
        kind = _Type(self.data[places[1] : places[1] + sizes[1]])
        return {name: self.value(kind, self.shape(places[2]), at)}

    def value(self, kind: _Type, shape: tuple[int, ...] | None, at: int) -> object:
        if shape is None:
            return None
        n = int(np.prod(shape, dtype=np.int64))
        if kind.base is not None:
            each = [self.sequence(kind, at + i * kind.size) for i in range(n)]
            return each[0] if shape == () or (kind.text and n == 1) else each
        raw = np.frombuffer(self.data[at : at + n * kind.numpy.itemsize], kind.numpy, n)
        if kind.text:
            texts = [x.split(b"\0")[0].decode("utf-8", "replace") for x in raw.tolist()]
            return texts[0] if n == 1 else texts
        return raw.tolist()

    def sequence(self, kind: _Type, at: int) -> object:
        """A text or array of variable length."""
        n, heap, index = self.number(at, 4), self.address(at + 4), self.number(at + 4 + self.o, 4)
        raw = self.global_heap(heap).get(index, b"") if n else b""
        if kind.text:
            return raw[:n].split(b"\0")[0].decode("utf-8", "replace")
        return np.frombuffer(raw, kind.base.numpy, n).tolist()

    def global_heap(self, at: int) -> dict[int, bytes]:
        if at not in self.heaps:
            place = self.signed(at, b"GCOL") + 4
            end, place, found = at + self.number(place, self.l), place + self.l, {}
            while place + 8 + self.l <= end and (index := self.number(place, 2)):
                n = self.number(place + 8, self.l)
                found[index] = self.data[place + 8 + self.l : place + 8 + self.l + n]
                place += 8 + self.l + -(-n // 8) * 8
            self.heaps[at] = found
        return self.heaps[at]

    # fractal heaps with their version 2 B-trees

    def heap_objects(self, heap: int | None, tree: int | None, skip: int) -> Iterator[int]:
        """Where the managed objects of a fractal heap stand, by the records of a B-tree (skip: bytes before their ids)."""
        if heap is None or tree is None:
            return
        at = self.signed(heap, b"FRHP") + 1
        if self.number(at + 2, 2):
            raise ValueError("filtered heaps are not read")
        flags, largest = self.data[at + 4], self.number(at + 5, 4)
        at += 9 + self.l + self.o + self.l + self.o + 8 * self.l
        width, start, direct = self.number(at, 2), self.number(at + 2, self.l), self.number(at + 2 + self.l, self.l)
        at += 2 + 2 * self.l
        bits, root, rows = self.number(at, 2), self.address(at + 4), self.number(at + 4 + self.o, 2)
        n_offset = (bits + 7) // 8
        n_length = min((direct.bit_length() + 6) // 8, (largest.bit_length() - 1) // 8 + 1)
        blocks = list(self.direct_blocks(root, rows, 0, width, start, direct, n_offset))
        for record in self.records(tree):
            at = record + skip
            if self.data[at] >> 4 & 3 != 0:
                raise ValueError("only managed objects of heaps are read")
            offset = self.number(at + 1, n_offset)
            self.number(at + 1 + n_offset, n_length)
            yield next(place + offset - begin for place, begin, size in blocks if begin <= offset < begin + size)

    def direct_blocks(self, at: int | None, rows: int, begin: int, width: int, start: int, direct: int, n_offset: int) -> Iterator[tuple[int, int, int]]:
        """(place, offset in the heap, size) of each direct block."""
        if at is None:
            return
        if not rows:
            yield at, begin, start
            return
        entry = self.signed(at, b"FHIB") + 1 + self.o + n_offset
        for row in range(rows):
            size = start << max(0, row - 1)
            for _ in range(width):
                child = self.address(entry)
                entry += self.o
                if child is not None and size <= direct:
                    yield child, begin, size
                elif child is not None:
                    below = size.bit_length() - (start * width).bit_length() + 1
                    yield from self.direct_blocks(child, below, begin, width, start, direct, n_offset)
                begin += size

    def records(self, tree: int) -> Iterator[int]:
        """Where the records of a version 2 B-tree stand."""
        at = self.signed(tree, b"BTHD") + 2
        node, size, depth = self.number(at, 4), self.number(at + 4, 2), self.number(at + 6, 2)
        root, n = self.address(at + 10), self.number(at + 10 + self.o, 2)
        bytes_of = lambda x: (x.bit_length() + 7) // 8
        most = [(node - 10) // size]
        count_width, total = bytes_of(most[0]), [most[0]]
        for level in range(1, depth + 1):
            pointer = self.o + count_width + (bytes_of(total[level - 1]) if level > 1 else 0)
            most.append((node - 10 - pointer) // (size + pointer))
            total.append((most[level] + 1) * total[level - 1] + most[level])

        def walk(at: int | None, n: int, level: int) -> Iterator[int]:
            if at is None:
                return
            place = self.signed(at, b"BTIN" if level else b"BTLF") + 2
            yield from (place + i * size for i in range(n))
            if level:
                place += n * size
                for _ in range(n + 1):
                    yield from walk(self.address(place), self.number(place + self.o, count_width), level - 1)
                    place += self.o + count_width + (bytes_of(total[level - 1]) if level > 1 else 0)

        yield from walk(root, n, depth)

    # data

    def shape(self, at: int) -> tuple[int, ...] | None:
        """The extent of a dataspace; None of an empty one."""
        version, rank = self.data[at], self.data[at + 1]
        if version == 2 and self.data[at + 3] == 2:
            return None
        at += 8 if version == 1 else 4
        return tuple(self.number(at + i * self.l, self.l) for i in range(rank))

    def leaves(self, at: int | None, kind: int, key: int) -> Iterator[int]:
        """Children of the leaves of a version 1 B-tree of groups."""
        if at is None:
            return
        place = self.signed(at, b"TREE")
        level, n = self.data[place + 1], self.number(place + 2, 2)
        place += 4 + 2 * self.o + key
        for i in range(n):
            child = self.address(place + i * (key + self.o))
            if level:
                yield from self.leaves(child, kind, key)
            else:
                yield child

    def chunks(self, at: int | None, rank: int, first: slice | None = None) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """(offset, place, stored size, mask of filters left out) of each chunk; of a tree's inner nodes only those branches
        are followed that may hold an offset within first along the first axis."""
        if at is None:
            return
        place = self.signed(at, b"TREE")
        if self.data[place] != 1:
            raise ValueError("not a tree of chunks")
        level, n = self.data[place + 1], self.number(place + 2, 2)
        key = 8 + 8 * (rank + 1)
        place += 4 + 2 * self.o
        for i in range(n):
            here = place + i * (key + self.o)
            child = self.address(here + key)
            if level:
                begin, end = self.number(here + 8, 8), self.number(here + key + self.o + 8, 8)
                if first is None or (begin < first.stop and end >= first.start):
                    yield from self.chunks(child, rank, first)
            else:
                yield tuple(self.number(here + 8 + 8 * k, 8) for k in range(rank)), child, self.number(here, 4), self.number(here + 4, 4)

    def filters(self, at: int) -> list[tuple[int, list[int]]]:
        version, n = self.data[at], self.data[at + 1]
        at += 8 if version == 1 else 2
        out = []
        for _ in range(n):
            code = self.number(at, 2)
            named = version == 1 or code >= 256
            length = self.number(at + 2, 2) if named else 0
            at += 4 if named else 2
            count = self.number(at + 2, 2)
            at += 4 + (-(-length // 8) * 8 if version == 1 else length)
            out.append((code, [self.number(at + 4 * i, 4) for i in range(count)]))
            at += 4 * count + (4 if version == 1 and count % 2 else 0)
        return out

    def dataset(self, at: int) -> tuple[Stored, object] | None:
        """Values and fill value (None: none) of the object whose header is at a place; None of a group."""
        found = {kind: (m, n) for kind, m, n in self.messages(at)}
        if LAYOUT not in found or TYPE not in found:
            return None
        m, n = found[TYPE]
        kind, shape = _Type(self.data[m : m + n]), self.shape(found[SPACE][0])
        if kind.kind not in (0, 1, 3) or shape is None:
            return Empty(shape or (), np.dtype("V1"), None), None
        fill = self.fill(found[FILL][0], kind) if FILL in found else None
        m = found[LAYOUT][0]
        if self.data[m] not in (3, 4) or self.data[m] == 4 and self.data[m + 1] == 2:
            raise ValueError(f"data layout {self.data[m]} is not read")
        if self.data[m + 1] == 0:
            return Rows(self.data, kind.numpy, shape, m + 4), fill
        if self.data[m + 1] == 1:
            place = self.address(m + 2)
            return (Empty(shape, kind.numpy, fill) if place is None else Rows(self.data, kind.numpy, shape, place)), fill
        rank = self.data[m + 2] - 1
        size = tuple(self.number(m + 3 + self.o + 4 * i, 4) for i in range(rank))
        pipeline = self.filters(found[FILTERS][0]) if FILTERS in found else []
        return Chunks(self, self.address(m + 3), kind.numpy, shape, size, fill, pipeline), fill

    def fill(self, at: int, kind: _Type) -> object:
        version = self.data[at]
        if version < 3:
            there, place = version < 2 or self.data[at + 3], at + 4
        else:
            there, place = self.data[at + 1] & 32, at + 2
        n = self.number(place, 4) if there else 0
        return np.frombuffer(self.data[place + 4 : place + 4 + n], kind.numpy)[0] if n == kind.numpy.itemsize else None


class Empty(Stored):
    """An array of which nothing was written: its fill value."""

    def __init__(self, shape: tuple[int, ...], dtype: np.dtype, fill: object) -> None:
        self.shape, self.dtype, self.filled = shape, dtype, fill
        self.pieces = (1,) * len(shape)

    def read(self, region: Region | None = None) -> np.ndarray:
        region = region or tuple(slice(0, n) for n in self.shape)
        shape = tuple(s.stop - s.start for s in region)
        return np.zeros(shape, self.dtype) if self.filled is None else np.full(shape, self.filled, self.dtype)


class Chunks(Empty):
    """An array in chunks, each of which may be packed by filters; chunks that are not there hold the fill value."""

    def __init__(self, file: _File, tree: int | None, dtype: np.dtype, shape: tuple[int, ...], size: tuple[int, ...], fill: object, pipeline: list) -> None:
        super().__init__(shape, dtype, fill)
        self.file, self.tree, self.pieces, self.pipeline = file, tree, size, pipeline

    def read(self, region: Region | None = None) -> np.ndarray:
        region = region or tuple(slice(0, n) for n in self.shape)
        out = super().read(region)
        if not out.size:
            return out
        first = slice(region[0].start - region[0].start % self.pieces[0], region[0].stop)
        for offset, place, stored, mask in self.file.chunks(self.tree, len(self.shape), first):
            low = [max(o, r.start) for o, r in zip(offset, region)]
            high = [min(o + s, r.stop) for o, s, r in zip(offset, self.pieces, region)]
            if any(a >= b for a, b in zip(low, high)):
                continue
            raw = self.file.data[place : place + stored]
            for i, (code, parameters) in reversed(list(enumerate(self.pipeline))):
                if not mask >> i & 1:
                    raw = unfiltered(raw, code, parameters)
            piece = np.frombuffer(raw, self.dtype, int(np.prod(self.pieces, dtype=np.int64))).reshape(self.pieces)
            inside = tuple(slice(a - r.start, b - r.start) for a, b, r in zip(low, high, region))
            out[inside] = piece[tuple(slice(a - o, b - o) for a, b, o in zip(low, high, offset))]
        return out


def unfiltered(raw: bytes, code: int, parameters: list[int]) -> bytes:
    if code == DEFLATE:
        return zlib.decompress(raw)
    if code == SHUFFLE:
        size = parameters[0]
        whole = len(raw) // size * size
        return np.frombuffer(raw, np.uint8, whole).reshape(size, -1).T.tobytes() + raw[whole:]
    if code == CHECKSUM:
        return raw[:-4]
    raise ValueError(f"filter {code} is not read")


def read(data: bytes, wanted: set[str] | None = None) -> Dataset:
    """See opened; all values are in memory."""
    return opened(data, wanted).loaded()


def opened(data: bytes | Ranged, wanted: set[str] | None = None) -> Dataset:
    """The variables of the root group (wanted: only these) with their dimensions; values stay in the file,
    unscaled, in their own types. A dimension is the variable that an axis refers to; axes that refer to nothing take the variable of one
    dimension with their length, or a name of their own."""
    file = _File(data)
    places = file.links(file.root)
    names = {at - file.base: name for name, at in places.items()}
    loaded = {}
    for name, at in places.items():
        if wanted is None or name in wanted:
            got = file.dataset(at)
            if got is not None and got[0].dtype.kind in "iufS":
                loaded[name] = (*got, file.attributes(at))
    axes = {name: v.shape[0] for name, (v, _, _) in loaded.items() if v.ndim == 1}
    variables, dimensions = {}, {}
    for name, (values, fill, attributes) in loaded.items():
        bound, dims = attributes.get("DIMENSION_LIST") or [], []
        for i, n in enumerate(values.shape):
            known = names.get(bound[i][0]) if i < len(bound) and bound[i] else None
            if known is None and values.ndim == 1:
                known = name
            if known is None:
                known = next((a for a, size in axes.items() if size == n and a not in dims), f"{name}_{i}")
            dims.append(known)
            dimensions[known] = n
        own = {k: v for k, v in attributes.items() if k not in HIDDEN}
        if fill is not None and "_FillValue" not in own and values.ndim > 1:
            own["_FillValue"] = [fill.item()]
        variables[name] = Variable(tuple(dims), values, own)
    shown = {k: v for k, v in file.attributes(file.root).items() if k not in HIDDEN}
    return Dataset(dimensions, variables, shown)
