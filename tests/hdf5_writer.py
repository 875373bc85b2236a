"""Small HDF5 files for tests, laid out as the public specification says; checksums are left at zero."""

from __future__ import annotations

import struct
import zlib

import numpy as np

UNDEFINED = b"\xff" * 8


def u(value: int, size: int = 8) -> bytes:
    return int(value).to_bytes(size, "little")


def pad(raw: bytes, to: int = 8) -> bytes:
    return raw + b"\0" * (-len(raw) % to)


def datatype(kind: np.dtype) -> bytes:
    big = kind.byteorder == ">"
    if kind.kind == "f":
        bits = (0x20 | big, 63 if kind.itemsize == 8 else 31, 0)
        tail = struct.pack("<HHBBBBI", 0, 64, 52, 11, 0, 52, 1023) if kind.itemsize == 8 else struct.pack("<HHBBBBI", 0, 32, 23, 8, 0, 23, 127)
        return bytes([0x11, *bits]) + u(kind.itemsize, 4) + tail
    if kind.kind in "iu":
        return bytes([0x10, big | (8 if kind.kind == "i" else 0), 0, 0]) + u(kind.itemsize, 4) + struct.pack("<HH", 0, 8 * kind.itemsize)
    return bytes([0x13, 0, 0, 0]) + u(kind.itemsize, 4)


REFERENCES = bytes([0x19, 0, 0, 0]) + u(16, 4) + bytes([0x17, 0, 0, 0]) + u(8, 4)
TEXTS = bytes([0x19, 1, 0, 0]) + u(16, 4) + bytes([0x13, 0, 0, 0]) + u(1, 4)


class Writer:
    def __init__(self) -> None:
        self.out = bytearray()

    def put(self, raw: bytes) -> int:
        self.out += b"\0" * (-len(self.out) % 8)
        self.out += raw
        return len(self.out) - len(raw)

    def global_heap(self, objects: list[bytes]) -> int:
        body = b"".join(u(i, 2) + u(1, 2) + u(0, 4) + u(len(x)) + pad(x) for i, x in enumerate(objects, 1))
        return self.put(b"GCOL\1\0\0\0" + u(16 + len(body) + 16) + body + b"\0" * 16)

    def heap(self, objects: list[bytes], id_size: int, record, record_size: int, kind: int, deep: bool) -> tuple[int, int]:
        """A fractal heap of objects and the B-tree of their ids. deep: blocks under an indirect block, and a tree of two levels."""
        start, width, head = 512, 4, 5 + 8 + 4
        if deep:  # two direct blocks in the first row
            half = len(objects) // 2
            parts, begins = [objects[:half], objects[half:]], [0, start]
        else:
            parts, begins, start = [objects], [0], 4096
        ids, blocks = [], []
        for part, begin in zip(parts, begins):
            raw = b"FHDB\0" + UNDEFINED + u(begin, 4)
            for x in part:
                ids.append(bytes([0]) + u(begin + len(raw), 4) + u(len(x), 2) + b"\0" * (id_size - 7))
                raw += x
            assert len(raw) <= start and head == 17
            blocks.append(self.put(raw.ljust(start, b"\0")))
        root, rows = blocks[0], 0
        if deep:
            rows = 1
            root = self.put(b"FHIB\0" + UNDEFINED + u(0, 4) + b"".join(map(u, blocks)) + UNDEFINED * (width - 2) + u(0, 4))
        header = b"FRHP\0" + u(id_size, 2) + u(0, 2) + b"\0" + u(4096, 4) + u(0) + UNDEFINED + u(0) + UNDEFINED + u(0) * 8
        header += u(width, 2) + u(start) + u(65536) + u(32, 2) + u(1, 2) + u(root) + u(rows, 2) + u(0, 4)
        heap = self.put(header)
        records = [record(i, x) for i, x in enumerate(ids)]
        assert all(len(r) == record_size for r in records)
        leaf = lambda rs: self.put((b"BTLF\0" + bytes([kind]) + b"".join(rs) + u(0, 4)).ljust(512, b"\0"))
        if deep:
            a, b = records[: len(records) // 2], records[len(records) // 2 + 1 :]
            middle = records[len(records) // 2]
            raw = b"BTIN\0" + bytes([kind]) + middle + u(leaf(a)) + u(len(a), 1) + u(leaf(b)) + u(len(b), 1) + u(0, 4)
            top, depth, n = self.put(raw.ljust(512, b"\0")), 1, 1
        else:
            top, depth, n = leaf(records), 0, len(records)
        tree = self.put(b"BTHD\0" + bytes([kind]) + u(512, 4) + u(record_size, 2) + u(depth, 2) + bytes([100, 40]) + u(top) + u(n, 2) + u(len(records)) + u(0, 4))
        return heap, tree


def attribute(w: Writer, name: str, value: object, old: bool) -> bytes:
    if isinstance(value, list) and name == "DIMENSION_LIST":
        at = w.global_heap([u(v) for v in value])
        kind, shape, raw = REFERENCES, (len(value),), b"".join(u(1, 4) + u(at) + u(i, 4) for i in range(1, len(value) + 1))
    elif isinstance(value, str) and not value.isascii():
        at = w.global_heap([value.encode()])
        kind, shape, raw = TEXTS, (), u(len(value.encode()), 4) + u(at) + u(1, 4)
    elif isinstance(value, str):
        raw = value.encode() + b"\0"
        kind, shape = datatype(np.dtype(f"S{len(raw)}")), ()
    else:
        array = np.atleast_1d(np.asarray(value))
        kind, shape, raw = datatype(array.dtype), array.shape, array.tobytes()
    label = name.encode() + b"\0"
    if old:
        space = bytes([1, len(shape), 0, 0]) + u(0, 4) + b"".join(map(u, shape))
        return bytes([1, 0]) + u(len(label), 2) + u(len(kind), 2) + u(len(space), 2) + pad(label) + pad(kind) + pad(space) + raw
    space = bytes([2, len(shape), 0, 1 if shape else 0]) + b"".join(map(u, shape))
    return bytes([3, 0]) + u(len(label), 2) + u(len(kind), 2) + u(len(space), 2) + b"\0" + label + kind + space + raw


def chunked(w: Writer, values: np.ndarray, chunk: tuple[int, ...], squeeze: bool, leave_out: set) -> tuple[bytes, bytes]:
    """The layout and filter messages; chunks are written under a B-tree of two levels."""
    entries = []
    size = values.dtype.itemsize
    for index in np.ndindex(*(-(-n // c) for n, c in zip(values.shape, chunk))):
        offset = tuple(i * c for i, c in zip(index, chunk))
        if offset in leave_out:
            continue
        piece = np.zeros(chunk, values.dtype)
        part = values[tuple(slice(o, o + c) for o, c in zip(offset, chunk))]
        piece[tuple(slice(0, n) for n in part.shape)] = part
        raw = piece.tobytes()
        mask = 0
        if squeeze:
            raw = np.frombuffer(raw, np.uint8).reshape(-1, size).T.tobytes()
            if len(entries) == 0:
                mask = 2  # the first chunk is stored without deflate
            else:
                raw = zlib.compress(raw)
            raw += u(0, 4)
        key = u(len(raw), 4) + u(mask, 4) + b"".join(map(u, offset)) + u(0)
        entries.append((key, w.put(raw)))
    last = u(0, 8) + b"".join(map(u, values.shape)) + u(0)

    def node(level: int, items: list) -> int:
        return w.put(b"TREE\1" + bytes([level]) + u(len(items), 2) + UNDEFINED * 2 + b"".join(k + u(a) for k, a in items) + last)

    half = max(1, len(entries) // 2)
    leaves = [(part[0][0], node(0, part)) for part in (entries[:half], entries[half:]) if part]
    top = node(1, leaves)
    layout = bytes([3, 2, len(chunk) + 1]) + u(top) + b"".join(u(c, 4) for c in chunk) + u(size, 4)
    return layout, bytes([2, 3]) + u(2, 2) + u(0, 2) + u(1, 2) + u(size, 4) + u(1, 2) + u(0, 2) + u(1, 2) + u(6, 4) + u(3, 2) + u(0, 2) + u(0, 2)


def old_header(messages: list[tuple[int, bytes]]) -> bytes:
    body = b"".join(u(k, 2) + u(len(pad(m)), 2) + b"\0" * 4 + pad(m) for k, m in messages)
    return b"\1\0" + u(len(messages), 2) + u(1, 4) + u(len(body), 4) + u(0, 4) + body


def new_header(w: Writer, messages: list[tuple[int, bytes]]) -> int:
    """The first message in the header, the others in a continuation."""
    one = lambda k, m: bytes([k]) + u(len(m), 2) + b"\0" + m
    rest = b"OCHK" + b"".join(one(*x) for x in messages[1:]) + u(0, 4)
    at = w.put(rest)
    body = one(*messages[0]) + one(16, u(at) + u(len(rest)))
    return w.put(b"OHDR\2\1" + u(len(body), 2) + body + u(0, 4))


def write(variables: dict, chunk: tuple[int, ...] | None = None, old: bool = False, dense: bool = False, deep: bool = False, leave_out: set = frozenset(), attributes: dict | None = None) -> bytes:
    """variables: name -> (dimensions, values, attributes); chunk: of variables of three dimensions."""
    w = Writer()
    w.put(b"\0" * 96)
    places: dict[str, int] = {}

    def attribute_messages(items: dict) -> list[tuple[int, bytes]]:
        raw = [attribute(w, k, v, old) for k, v in items.items()]
        if old or not dense or len(raw) < 3:
            return [(12, r) for r in raw]
        heap, tree = w.heap(raw, 8, lambda i, x: x + b"\0" + u(i, 4) + u(0, 4), 17, 8, deep)
        return [(21, b"\0\0" + u(heap) + u(tree))]

    for name, (dims, values, own) in sorted(variables.items(), key=lambda x: x[1][1].ndim):
        items = dict(own)
        if values.ndim > 1 and not old:
            items["DIMENSION_LIST"] = [places[d] for d in dims]
        shape = values.shape
        space = bytes([1, len(shape), 0, 0]) + u(0, 4) + b"".join(map(u, shape)) if old else bytes([2, len(shape), 0, 1]) + b"".join(map(u, shape))
        fill = own.get("_FillValue")
        raw_fill = np.asarray(fill, values.dtype).tobytes() if fill is not None else b""
        fills = (bytes([2, 2, 2, 1]) if old else bytes([3, 0x20 if raw_fill else 0])) + (u(len(raw_fill), 4) + raw_fill if old or raw_fill else b"")
        messages = [(1, space), (3, datatype(values.dtype)), (5, fills)]
        if chunk and values.ndim > 1:
            layout, pipeline = chunked(w, values, chunk, not old, leave_out)
            messages += [(8, layout)] + ([(11, pipeline)] if not old else [])
        else:
            messages.append((8, bytes([3, 1]) + u(w.put(values.tobytes())) + u(values.nbytes)))
        messages += attribute_messages(items)
        places[name] = w.put(old_header(messages)) if old else new_header(w, messages)

    shown = attribute_messages(attributes or {})
    if old:
        names, offsets = b"\0" * 8, {}
        for n in sorted(places):
            offsets[n] = len(names)
            names += pad(n.encode() + b"\0")
        segment = w.put(names)
        heap = w.put(b"HEAP\0\0\0\0" + u(len(names)) + UNDEFINED + u(segment))
        node = w.put(b"SNOD\1\0" + u(len(places), 2) + b"".join(u(offsets[n]) + u(places[n]) + u(0, 4) * 2 + b"\0" * 16 for n in sorted(places)))
        tree = w.put(b"TREE\0\0" + u(1, 2) + UNDEFINED * 2 + u(0) + u(node) + u(offsets[max(places)]))
        root = w.put(old_header([(17, u(tree) + u(heap)), *shown]))
        head = b"\x89HDF\r\n\x1a\n" + bytes([0, 0, 0, 0, 0, 8, 8, 0]) + u(4, 2) + u(16, 2) + u(0, 4) + u(0) + UNDEFINED + u(len(w.out)) + UNDEFINED + u(0) + u(root)
    else:
        links = [bytes([1, 0x10]) + b"\1" + u(len(n), 1) + n.encode() + u(a) for n, a in places.items()]
        if dense:
            heap, tree = w.heap(links, 7, lambda i, x: u(0, 4) + x, 11, 5, False)
            messages = [(2, b"\0\0" + u(heap) + u(tree))]
        else:
            messages = [(6, x) for x in links]
        root = new_header(w, [*messages, *shown])
        head = b"\x89HDF\r\n\x1a\n" + bytes([2, 8, 8, 0]) + u(0) + UNDEFINED + u(len(w.out)) + u(root) + u(0, 4)
    w.out[: len(head)] = head
    return bytes(w.out)
