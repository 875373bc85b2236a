"""Suffix-array dedup: every byte covered by a 50-byte string that also starts in a document with a smaller
doc_id is removed.

Merging Burrows-Wheeler transforms costs many rounds over every byte, so only text that can matter gets
there, and nothing that can is left out:

1. Each 50-byte window belongs to the smallest hash of its 24-byte grams; windows with equal text belong
   to the same hash. A run of windows with one hash at one place is a snippet, of 76 bytes at most; a
   snippet that follows itself again and again (a line of dashes) is one with a count. Snippets (hashes and
   places, no text) are combined within a block of documents, packed and shuffled by that hash.
2. Equal snippets are one string, which belongs to the smallest document that holds it; it is removed from
   the others. Of different snippets of one hash those go on whose windows may be equal: the 24 bytes and 20
   more around them, of which every 7 consecutive windows share one form (a cell), are in two documents.
   A hash whose strings would be too many bytes for one merge is split by cells, and a cell that is still too
   large by its single windows. So what one task holds has a bound in bytes, whatever a third of all rows share.
3. The text of those snippets is cut from their documents, and its transforms are made there, by shard: the
   strings of a few documents that belong to one bucket of hashes.
4. The transforms of a bucket's shards, which come from many tasks, are merged by refining their interleave
   (bwt.py); repeated intervals with a smaller document mark the windows to remove. Windows that step 2 split
   off are combined by (128-bit hash, smallest document), first within their documents' task.
5. The marks meet their documents.

Rows of a bucket are folded in a stream: only one row of each different string is held. A hash with more different
snippets than HELD is not held either, and goes on by single windows.

Strings are taken as equal where the hash of their gram (43 bits), a polynomial hash (64 bits) and a hash of
their words of 8 bytes (32 bits) are, or 128 bits of xxHash for single windows; else only by their bytes.

Defined cases: a null text is empty; texts under 50 bytes lose nothing; rows without doc_id are neither
searched nor cut; of rows that repeat a doc_id, marks of one apply to each; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.bwt import Shard, repeats_across, shard_transform
from aridspan.llm.common import blocks, stored, table, texts

MATCH, GRAM = 50, 24
#: Windows of a cell, and cells: a window begins 0 to 26 bytes before its gram.
CELL, CELLS = 7, 4
#: Low bits of a gram's hash that give way to its place in the block.
PLACE = np.uint64((1 << 21) - 1)
#: Bytes of strings with one hash (or cell) that go to the same merge, and bytes of a merge on average.
LIMIT, CHUNK = 1 << 18, 1 << 20
#: Bytes of text that are searched at once, rows that a fold takes in at once, different snippets of one hash that it holds.
BLOCK, ROWS, HELD = 1 << 20, 1 << 19, 1 << 16
#: Windows of a bucket on average.
WINDOWS = 1 << 18

P1, P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MARKS, WANTED, TEXT, SHARD, SINGLE = 0, 1, 2, 3, 4
#: Columns of packed snippets. unit: windows of the repeated unit + 32 * the first one's distance to the gram; span: windows.
COLUMNS = ("key", "poly", "words", "doc", "start", "span", "unit", "sides")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * P1
    return h ^ (h >> np.uint64(29))


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length in 8 bytes each, the planes of their bytes apart, compressed."""
    n = len(arrays[0])
    planes = [np.ascontiguousarray(np.asarray(a).astype("<i8").view(np.uint8).reshape(n, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // (8 * count)
    return [np.ascontiguousarray(p.reshape(8, n).T).reshape(-1).view("<i8") for p in raw.reshape(count, -1)] if n else [np.zeros(0, np.int64)] * count


def by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    """(bucket, the rows of each array) of each bucket."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    at = np.flatnonzero(edges(b))
    sliced = [a[order] for a in arrays]
    for a, e in zip(at, np.append(at[1:], len(b))):
        yield int(b[a]), [x[a:e] for x in sliced]


def doc_bucket(doc: np.ndarray, count: int) -> np.ndarray:
    return (mixed(doc.view(np.uint64) + P2) % np.uint64(count)).astype(np.int64)


def gram_hashes(text: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Hashes of the 24 bytes from each place on; polynomials of 4, 8 and 32 bytes."""
    h = mixed(np.arange(1, 257, dtype=np.uint64) * P2)[text]
    sizes = {}
    length = 1
    while length < 32:
        h = h[:-length] * power(length) + h[length:]
        length *= 2
        if length in (4, 8, 16, 32):
            sizes[length] = h
    n = len(text) - GRAM + 1
    grams = mixed(sizes[16][:n] * power(8) + sizes[8][16 : 16 + n])
    del sizes[16]
    return grams, sizes


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(P1), n, 1 << 64))


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        h = np.minimum(h[:-length], h[length:])
        length *= 2
    rest = width - length
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def word_hashes(text: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32-bit hashes of texts of 50 to 80 bytes by their words of 8 bytes."""
    words = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    out = (end - first).astype(np.uint64) * P1
    for at in (*(first + 8 * i for i in range(6)), *(end - 8 * i for i in range(1, 5))):
        out = (out ^ words[at]) * P2
        out ^= out >> np.uint64(29)
    return mixed(out) >> np.uint64(32)


def snippets(docs: list[bytes], ids: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """COLUMNS of each snippet of texts of 50 bytes or more; begin: where each text begins in its document. sides: for each
    cell 16 bits of a hash of the 44 bytes that its windows share, 0 for cells without a window."""
    lengths = np.array([len(d) for d in docs])
    begins = np.cumsum(lengths) - lengths
    text = np.frombuffer(b"".join(docs), np.uint8)
    grams, sizes = gram_hashes(text)
    grams &= ~PLACE
    grams |= np.arange(len(grams), dtype=np.uint64) & PLACE
    least = window_minima(grams, MATCH - GRAM + 1)
    n = len(least)
    inside = np.ones(n, bool)
    for a in (begins + lengths)[:-1]:
        inside[a - MATCH + 1 : a] = False
    edge = np.ones(n, bool)
    edge[1:] = least[1:] != least[:-1]
    edge[1:] |= inside[1:] != inside[:-1]
    edge[begins] = True
    first = np.flatnonzero(edge)
    after = np.append(first[1:], n)
    keep = inside[first]
    first, after = first[keep], after[keep]
    unit, end = after - first, after + MATCH - 1
    lead = ((least[first] & PLACE) - first.astype(np.uint64) & PLACE).astype(np.int64)  # from the first window to the gram
    wide, eight, four = sizes[32], sizes[8], sizes[4]
    middle = np.minimum(first + 32, end - 32)
    poly = mixed(mixed(mixed(wide[first] + np.uint64(1)) + wide[middle]) + wide[end - 32]) + (end - first).astype(np.uint64)
    words = word_hashes(text, first, end)
    sides = np.zeros(len(first), np.uint64)
    for c in range(CELLS):
        at = np.clip(first + lead - CELL * c, 0, len(wide) - 13)
        h = mixed(wide[at] * power(12) + eight[at + 32] * power(4) + four[at + 40])
        there = (lead >= CELL * c) & (lead - unit < CELL * (c + 1) - 1)
        sides |= np.where(there, h % np.uint64(65_535) + np.uint64(1), np.uint64(0)) << np.uint64(16 * c)
    which = np.searchsorted(begins, first, side="right") - 1
    # snippets that follow themselves become one
    again = np.append(False, (poly[1:] == poly[:-1]) & (words[1:] == words[:-1]) & (first[1:] == after[:-1]) & (which[1:] == which[:-1]))
    one = np.flatnonzero(~again)
    span = after[np.append(one[1:], len(first)) - 1] - first[one]
    places = (ids[which], first - begins[which] + begin[which])
    key, poly, words, doc, start, unit, sides = (x[one].astype(np.int64) for x in (least[first] >> np.uint64(21), poly, words, *places, unit + 32 * lead, sides))
    return [key, poly, words, doc, start, span, unit, sides]


OUT = "bucket long, kind long, size long, data binary"
SHARDS = "bucket long, kind long, data binary, strings binary, places binary"


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [name for name, _ in fields])


def marks(count: int, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple]:
    """Rows (bucket, kind, data) of byte ranges to remove."""
    return [(b, MARKS, pack(*x)) for b, x in by_bucket(doc_bucket(doc, count), doc, start, end)]


def marked(rows: list[tuple]) -> list[tuple]:
    """marks as rows of OUT."""
    return [(b, kind, 0, data) for b, kind, data in rows]


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Texts of about BLOCK bytes together, their documents, and where they begin there: longer texts are cut so that
    each window is in one part."""
    held, size = [], 0
    for block in blocks(batches, "text", BLOCK):
        for text, doc in zip(texts(block), block.column("doc_id").to_pylist()):
            for at in range(0, len(text or b"") - MATCH + 1, BLOCK):
                part = text[at : at + BLOCK + MATCH - 1]
                if held and size + len(part) > BLOCK:
                    yield [x[0] for x in held], *(np.array([x[i] for x in held], np.int64) for i in (1, 2))
                    held, size = [], 0
                held.append((part, doc, at))
                size += len(part)
    if held:
        yield [x[0] for x in held], *(np.array([x[i] for x in held], np.int64) for i in (1, 2))


def scanned(docs: DataFrame, count: int) -> DataFrame:
    """Step 1: OUT: snippets by the bucket of their key (WANTED), and marks of snippets that a smaller document of the
    same block holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches):
            columns = snippets(*part)
            poly, words, doc, start, span = columns[1:6]
            order = np.lexsort((doc, words, poly))
            d, head = doc[order], edges(poly[order], words[order])
            later = np.empty(len(order), bool)
            later[order] = d > d[head][np.cumsum(head) - 1]
            rows = marked(marks(count, doc[later], start[later], start[later] + span[later] + MATCH - 1))
            for b, x in by_bucket(columns[0][~later] % count, *(c[~later] for c in columns)):
                x[3] = np.diff(x[3], prepend=0)
                rows.append((b, WANTED, 0, pack(*x)))
            yield batch_of(rows, OUT)

    return docs.filter("doc_id IS NOT NULL").mapInArrow(run, OUT)


def groups(batches: Iterator[pa.RecordBatch], column: str = "bucket") -> Iterator[tuple[int, Iterator[dict]]]:
    """(bucket, its rows) of batches that are sorted by bucket."""
    from itertools import groupby

    rows = (r for batch in batches for at in range(0, batch.num_rows, 64) for r in batch.slice(at, 64).to_pylist())
    return groupby(rows, key=lambda r: r[column])


def by_task(rows: DataFrame, tasks: int) -> DataFrame:
    """Buckets dealt out in turn, so that no task gets more than its share of them."""
    return rows.repartitionById(tasks, F.col("bucket").cast("int"))


def edges(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    out[:1] = True
    return out


def owned(columns: list[np.ndarray], identity: int, doc: int, start: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted rows whose document is the smallest of those with equal first columns, and the other rows."""
    order = np.lexsort((columns[start], columns[doc], *columns[:identity][::-1]))
    columns = [c[order] for c in columns]
    new = edges(*columns[:identity])
    later = columns[doc] > columns[doc][new][np.cumsum(new) - 1]
    return [c[~later] for c in columns], [c[later] for c in columns]


def cells_shared(group: np.ndarray, owner: np.ndarray, sides: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each cell: which different snippets share its 44 bytes with another document's of their group, and the bytes of
    all that do."""
    out = []
    for c in range(CELLS):
        h = (sides >> (16 * c)) & 65_535
        some = np.flatnonzero(h)
        shared, total = np.zeros(len(group), bool), np.zeros(len(group), np.int64)
        if len(some):
            some = some[np.lexsort((h[some], group[some]))]
            at = np.flatnonzero(edges(group[some], h[some]))
            n = np.diff(np.append(at, len(some)))
            several = np.maximum.reduceat(owner[some], at) > np.minimum.reduceat(owner[some], at)
            shared[some] = np.repeat(several, n)
            total[some] = np.repeat(np.add.reduceat(size[some], at), n)
        out.append((shared, total))
    return out


def wanted_parts(columns: list[np.ndarray], limit: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of snippets (sorted, owners only): which rows are wanted, and how, and how many bytes and windows that will be. The
    lower 8 bits of how have two for each cell, 1: its windows are merged, 2: they are compared one by one; 256: the
    whole range of cells goes together."""
    key, poly, words, owner, _, _, unit, sides = columns
    new_key, new = edges(key), edges(key, poly, words)
    which, group = np.cumsum(new) - 1, (np.cumsum(new_key) - 1)[new]
    size = (unit[new] & 31) + MATCH - 1
    shared = cells_shared(group, owner[new], sides[new], size)
    wanted = np.logical_or.reduce([s for s, _ in shared])
    together = np.bincount(group, weights=wanted * size, minlength=1)[group] <= limit
    how = np.where(together & wanted, 256, 0)
    for c, (s, total) in enumerate(shared):
        how |= np.where(s, np.where(together | (total <= limit), 1, 2), 0) << (2 * c)
    return how[which] > 0, how[which]


def decided(rows: DataFrame, count: int) -> DataFrame:
    """Step 2: OUT (bucket now of documents): marks, and the snippets whose text is wanted: doc, start, span, unit, key,
    sides, how; size: their bytes, and windows compared singly << 32."""

    def ask(columns: list[np.ndarray], how: np.ndarray) -> list[tuple]:
        key, _, _, doc, start, span, unit, sides = columns
        n = unit & 31
        single = np.zeros(len(how), np.int64)
        for c in range(CELLS):
            single += ((how >> (2 * c)) & 3 == 2) * np.minimum(n, CELL)
        size = np.where(how & 85, n + MATCH - 1, 0) + (single << 32)
        asked = (doc, start, span, unit, key, sides, how, size)
        return [(b, WANTED, int(x[-1].sum()), pack(*x[:-1])) for b, x in by_bucket(doc_bucket(doc, count), *asked)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in groups(batches):
            state = [np.zeros(0, np.int64)] * len(COLUMNS)
            large = np.zeros(0, np.int64)
            held, n_held = [], 0

            def fold() -> list[tuple]:
                nonlocal state, large, held, n_held
                columns = [np.concatenate(x) for x in zip(state, *held)]
                held, n_held, out = [], 0, []
                now = np.isin(columns[0], large)
                if now.any():
                    out += ask([c[now] for c in columns], np.full(now.sum(), 170))
                    columns = [c[~now] for c in columns]
                state, later = owned(columns, 3, 3, 4)
                out += marked(marks(count, later[3], later[4], later[4] + later[5] + MATCH - 1))
                found, n = np.unique(state[0][edges(*state[:3])], return_counts=True)
                if (n > HELD).any():
                    more = found[n > HELD]
                    large, now = np.append(large, more), np.isin(state[0], more)
                    out += ask([c[now] for c in state], np.full(now.sum(), 170))
                    state = [c[~now] for c in state]
                return out

            for r in members:
                if r["kind"] == MARKS:
                    yield batch_of([tuple(r[c] for c in ("bucket", "kind", "size", "data"))], OUT)
                    continue
                x = unpack(r["data"], len(COLUMNS))
                x[3] = np.cumsum(x[3])
                held.append(x)
                n_held += len(x[0])
                if n_held >= max(ROWS, len(state[0])):
                    yield batch_of(fold(), OUT)
            out = fold() if held else []
            if len(state[0]):
                wanted, how = wanted_parts(state, LIMIT)
                out += ask([c[wanted] for c in state], how[wanted])
            yield batch_of(out, OUT)

    return by_task(rows, count).sortWithinPartitions("bucket").mapInArrow(run, OUT)


def beside_texts(docs: DataFrame, rows: DataFrame, count: int) -> DataFrame:
    """docs and rows (bucket, kind, data) of the same bucket of documents in one partition, the rows first. Texts are
    compressed before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for block in blocks(batches, "text"):
            ids = block.column("doc_id")
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_bucket(doc.astype(np.int64), count)),
                    pa.array([TEXT] * len(doc), pa.int64()),
                    ids,
                    pa.array([squeeze(t or b"") for t in texts(block)], pa.binary()),
                ],
                ["bucket", "kind", "doc_id", "data"],
            )

    moved = docs.mapInArrow(run, "bucket long, kind long, doc_id long, data binary")
    every = moved.unionByName(rows.select("bucket", "kind", F.lit(None).cast("long").alias("doc_id"), "data"))
    return by_task(every, count).sortWithinPartitions("bucket", "kind")


def gathered(parts: list[bytes], count: int) -> list[np.ndarray]:
    """Packed arrays joined and sorted by the first, documents."""
    arrays = [np.concatenate(x) for x in zip(*(unpack(p, count) for p in parts))] if parts else [np.zeros(0, np.int64)] * count
    order = np.argsort(arrays[0], kind="stable")
    return [a[order] for a in arrays]


def pieces_of(asked: list[np.ndarray], merges: int) -> list[np.ndarray]:
    """doc, start, windows, reach (windows from the first to that of the last repeat), bucket, kind of what is cut from
    documents for asked snippets; buckets of single windows follow from their text."""
    doc, start, span, unit, key, sides, how = asked
    n, lead = unit & 31, unit >> 5
    parts = []

    def part(some: np.ndarray, low: np.ndarray, high: np.ndarray, bucket: np.ndarray, kind: int) -> None:
        first, last = np.maximum(0, lead - (CELL * high + CELL - 1)), np.minimum(n - 1, lead - CELL * low)
        some = some & (last >= first)
        columns = (doc, start + first, last - first + 1, span - n, bucket)
        parts.append([*(c[some] for c in columns), np.full(some.sum(), kind)])

    cell = [(how >> (2 * c)) & 3 for c in range(CELLS)]
    low, high = np.full(len(how), CELLS), np.full(len(how), -1)
    for c in range(CELLS):
        low, high = np.where(cell[c] > 0, np.minimum(low, c), low), np.where(cell[c] > 0, c, high)
    whole = how >= 256
    part(whole, low, high, (mixed(key.view(np.uint64)) % np.uint64(merges)).astype(np.int64), SHARD)
    for c in range(CELLS):
        own = mixed(mixed(key.view(np.uint64)) + ((sides >> (16 * c)) & 65_535).astype(np.uint64) * np.uint64(CELLS) + np.uint64(c))
        each = np.full(len(how), c)
        part(~whole & (cell[c] == 1), each, each, (own % np.uint64(merges)).astype(np.int64), SHARD)
        part(cell[c] == 2, each, each, np.zeros(len(how), np.int64), SINGLE)
    out = [np.concatenate(x) for x in zip(*parts)]
    order = np.lexsort((out[1], out[0]))
    return [x[order] for x in out]


class Strings:
    """Different strings by bucket, each with its smallest document and its places there."""

    def __init__(self, count: int) -> None:
        self.count, self.size, self.held, self.lost = count, 0, {}, []

    def add(self, bucket: int, text: bytes, doc: int, start: int, reach: int) -> None:
        known = self.held.setdefault(bucket, {})
        found = known.get(text)
        if found is None or doc < found[0]:
            if found:
                self.lost += [(found[0], a, a + b + len(text)) for a, b in found[1]]
            else:
                self.size += len(text)
            known[text] = (doc, [(start, reach)])
        elif doc > found[0]:
            self.lost.append((doc, start, start + reach + len(text)))
        else:
            found[1].append((start, reach))

    def flush(self) -> list[tuple]:
        """SHARDS: a shard's transform for each bucket, and marks."""
        lost = np.array(self.lost, np.int64).reshape(-1, 3)
        out = [(*x, None, None) for x in marks(self.count, *(lost[:, i].copy() for i in range(3)))]
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for bucket, known in self.held.items():
            shard = shard_transform(list(known))
            doc = np.array([d for d, _ in known.values()], np.int64)
            n = np.array([len(p) for _, p in known.values()], np.int64)
            places = np.array([p for _, ps in known.values() for p in ps], np.int64)
            out.append((bucket, SHARD, squeeze(shard.symbols.tobytes()), pack(doc, shard.ends, n), pack(places[:, 0], places[:, 1])))
        self.size, self.held, self.lost = 0, {}, []
        return out


def smallest_windows(rows: list[tuple]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of (text, doc, start, reach): hash (two columns), doc, start, reach of the rows of each text's smallest document, and
    of the others."""
    at = [np.array([x[i] for x in rows], np.int64) for i in (1, 2, 3)]
    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x[0]) for x in rows), "<i8").reshape(-1, 2)
    return owned([h[:, 0], h[:, 1], *at], 2, 2, 3)


def fetched(docs: DataFrame, wanted: DataFrame, count: int, merges: int, singles: int) -> DataFrame:
    """Step 3: SHARDS, by bucket: transforms of shards (below merges), single windows (below merges + singles), marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = zstandard.ZstdDecompressor().decompress
        strings, windows = Strings(count), []

        def flush(windows: list[tuple]) -> pa.RecordBatch:
            out = strings.flush()
            if windows:
                own, later = smallest_windows(windows)
                out += [(*x, None, None) for x in marks(count, later[2], later[3], later[3] + later[4] + MATCH)]
                bucket = merges + (own[0].view(np.uint64) % np.uint64(singles)).astype(np.int64)
                out += [(b, SINGLE, pack(*x), None, None) for b, x in by_bucket(bucket, *own)]
            return batch_of(out, SHARDS)

        for _, members in groups(batches):
            parts, asked = [], None
            for r in members:
                if r["kind"] == WANTED:
                    parts.append(r["data"])
                    continue
                asked = asked or pieces_of(gathered(parts, 7), merges)
                if r["doc_id"] is None:
                    continue
                a, b = np.searchsorted(asked[0], [r["doc_id"], r["doc_id"] + 1])
                if a == b:
                    continue
                text = stretch(r["data"])
                for start, n, reach, bucket, kind in zip(*(x[a:b].tolist() for x in asked[1:])):
                    if start + n + MATCH - 1 > len(text):  # of another row with this doc_id
                        continue
                    if kind == SHARD:
                        strings.add(bucket, text[start : start + n + MATCH - 1], r["doc_id"], start, reach)
                    else:
                        windows += [(text[i : i + MATCH], r["doc_id"], i, reach) for i in range(start, start + n)]
                if strings.size > 8 * CHUNK or len(windows) > WINDOWS:
                    yield flush(windows)
                    windows = []
        yield flush(windows)

    return beside_texts(docs, wanted, count).mapInArrow(run, SHARDS)


def merged_marks(found: DataFrame, count: int, tasks: int) -> DataFrame:
    """Step 4: OUT (buckets of documents): marks of shards' repeated strings and of single windows."""

    def search(rows: list[dict]) -> list[tuple]:
        stretch = zstandard.ZstdDecompressor().decompress
        about = [unpack(r["strings"], 3) for r in rows]
        places = [np.concatenate(x) for x in zip(*(unpack(r["places"], 2) for r in rows))]
        shards = [Shard(np.frombuffer(stretch(r["data"]), np.uint8), a[1].astype(np.int32)) for r, a in zip(rows, about)]
        doc, n = (np.concatenate([a[i] for a in about]) for i in (0, 2))
        who, at = repeats_across(shards, doc, MATCH)
        if not len(who):
            return []
        first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (np.diff(at) > MATCH)))
        last = np.append(first[1:], len(who)) - 1
        who, low, high = who[first], at[first], at[last] + MATCH
        times = n[who]  # a string's places
        place = np.repeat((np.cumsum(n) - n)[who] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        start, reach = places[0][place], places[1][place]
        return marked(marks(count, np.repeat(doc[who], times), start + np.repeat(low, times), start + reach + np.repeat(high, times)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in groups(batches):
            shards, held, n_held, state = [], [], 0, None
            for r in members:
                if r["kind"] == MARKS:
                    yield batch_of([(r["bucket"], MARKS, 0, r["data"])], OUT)
                elif r["kind"] == SHARD:
                    shards.append(r)
                else:
                    held.append(unpack(r["data"], 5))
                    n_held += len(held[-1][0])
                    if n_held >= max(ROWS, len(state[0]) if state else 0):
                        state, later = owned([np.concatenate(x) for x in zip(*([state] if state else []), *held)], 2, 2, 3)
                        held, n_held = [], 0
                        yield batch_of(marked(marks(count, later[2], later[3], later[3] + later[4] + MATCH)), OUT)
            if shards:
                yield batch_of(search(shards), OUT)
            if held:
                _, later = owned([np.concatenate(x) for x in zip(*([state] if state else []), *held)], 2, 2, 3)
                yield batch_of(marked(marks(count, later[2], later[3], later[3] + later[4] + MATCH)), OUT)

    return by_task(found, tasks).sortWithinPartitions("bucket").mapInArrow(run, OUT)


def cut(docs: DataFrame, removed: DataFrame, count: int) -> DataFrame:
    """Step 5: doc_id, n_bytes, n_removed, n_spans, kept (binary)."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = zstandard.ZstdDecompressor().decompress
        for _, members in groups(batches):
            parts, known, out, size = [], None, [], 0
            for r in members:
                if r["kind"] == MARKS:
                    parts.append(r["data"])
                    continue
                known = known or gathered(parts, 3)
                doc, start, end = known
                text = stretch(r["data"])
                a, b = np.searchsorted(doc, [r["doc_id"], r["doc_id"] + 1]) if r["doc_id"] is not None else (0, 0)
                kept, spans, at = [], 0, 0
                last = -1
                for s, e in sorted(zip(start[a:b].tolist(), end[a:b].tolist())):
                    e = min(e, len(text))
                    if s > last:
                        if s >= len(text):
                            break
                        spans += 1
                        kept.append(text[max(at, 0) : s])
                    last = max(last, e)
                    at = max(at, e)
                rest = b"".join(kept) + text[at:]
                out.append((r["doc_id"], len(text), len(text) - len(rest), spans, rest))
                size += len(rest)
                if size > 4 << 20:
                    yield batch_of(out, schema)
                    out, size = [], 0
            yield batch_of(out, schema)

    return beside_texts(docs, removed, count).mapInArrow(run, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes that stay) of each row of docs
    (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = 4 * max(4, docs.rdd.getNumPartitions())
    first = stored(decided(scanned(docs, count), count), "repeat-marks")
    wanted = first.filter(F.col("kind") == WANTED)
    n_bytes, n_windows = wanted.agg(F.sum(F.col("size").bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftright("size", 32))).first()
    merges, singles = 1 + (n_bytes or 0) // CHUNK, 1 + (n_windows or 0) // WINDOWS
    found = fetched(docs, wanted, count, merges, singles)
    more = stored(merged_marks(found, count, max(8, (merges + singles) // 4)), "repeat-marks")
    return cut(docs, first.filter(F.col("kind") == MARKS).unionByName(more), count)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
