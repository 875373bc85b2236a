"""Files read by ranges of bytes, and arrays of which only a region is fetched."""

from __future__ import annotations

from typing import BinaryIO

import numpy as np

#: Small reads go through pages of this size, of which so many are kept; longer ones are fetched as they are.
PAGE, PAGES_KEPT, LONG = 8 << 10, 512, 64 << 10


class Ranged:
    """The bytes of a file that is open for reading, sliced and indexed as bytes are; fetched counts what was read."""

    def __init__(self, handle: BinaryIO, length: int) -> None:
        self.handle, self.length, self.fetched = handle, length, 0
        self.pages: dict[int, bytes] = {}

    def __len__(self) -> int:
        return self.length

    def fetch(self, start: int, stop: int) -> bytes:
        self.handle.seek(start)
        out = self.handle.read(stop - start)
        self.fetched += len(out)
        return out

    def page(self, number: int) -> bytes:
        if number not in self.pages:
            if len(self.pages) >= PAGES_KEPT:
                self.pages.clear()
            self.pages[number] = self.fetch(number * PAGE, min(self.length, (number + 1) * PAGE))
        return self.pages[number]

    def __getitem__(self, key: int | slice) -> int | bytes:
        if isinstance(key, int):
            return self[key : key + 1][0]
        start, stop, _ = key.indices(self.length)
        if stop <= start:
            return b""
        if stop - start > LONG:
            return self.fetch(start, stop)
        first = start // PAGE
        joined = b"".join(self.page(p) for p in range(first, (stop - 1) // PAGE + 1))
        return joined[start - first * PAGE : stop - first * PAGE]


def opened(path: str) -> Ranged:
    """A mounted file, or one of a store that pyarrow knows, by ranges; close its handle in the end."""
    if "://" not in path or path.startswith("file:"):
        handle = open(local(path), "rb")  # noqa: SIM115
        return Ranged(handle, handle.seek(0, 2))
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    handle = store.open_input_file(place)
    return Ranged(handle, handle.size())


def local(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


Region = tuple[slice, ...]


class Stored:
    """An array in a file. pieces: the edges of what is fetched and unpacked together, along each axis."""

    shape: tuple[int, ...]
    dtype: np.dtype
    pieces: tuple[int, ...]

    @property
    def ndim(self) -> int:
        return len(self.shape)

    def read(self, region: Region | None = None) -> np.ndarray:
        """The values of a region (slices without steps, of every axis), or all."""
        raise NotImplementedError


class Rows(Stored):
    """Values one after another, but that entries along the first axis may stand step bytes apart."""

    def __init__(self, data: bytes | Ranged, dtype: np.dtype, shape: tuple[int, ...], begin: int, step: int | None = None) -> None:
        self.data, self.dtype, self.shape, self.begin = data, dtype, tuple(shape), begin
        self.entry = dtype.itemsize * int(np.prod(self.shape[1:], dtype=np.int64))
        self.step = self.entry if step is None else step
        self.pieces = (1,) * len(self.shape)

    def values(self, start: int, shape: tuple[int, ...]) -> np.ndarray:
        size = self.dtype.itemsize * int(np.prod(shape, dtype=np.int64))
        raw = self.data.fetch(start, start + size) if isinstance(self.data, Ranged) else self.data[start : start + size]
        return np.frombuffer(raw, self.dtype).reshape(shape)

    def read(self, region: Region | None = None) -> np.ndarray:
        if not self.shape:
            return self.values(self.begin, ())
        region = region or tuple(slice(0, n) for n in self.shape)
        first, rest = region[0], region[1:]
        n = first.stop - first.start
        if self.step == self.entry and all(s.start == 0 and s.stop == size for s, size in zip(rest, self.shape[1:])):
            return self.values(self.begin + first.start * self.step, (n, *self.shape[1:]))
        inner = self.entry // self.shape[1] if rest and self.shape[1] else 0
        out = []
        for i in range(first.start, first.stop):
            at = self.begin + i * self.step
            if not rest:
                out.append(self.values(at, ()))
                continue
            rows = self.values(at + rest[0].start * inner, (rest[0].stop - rest[0].start, *self.shape[2:]))
            out.append(rows[(slice(None), *rest[1:])])
        return np.stack(out) if out else np.zeros((0, *(s.stop - s.start for s in rest)), self.dtype)
