"""Best-fit packing by sum of squares: each piece goes where the sum over all residual gaps of the
squared number of open bins with that gap becomes smallest (an open bin, or a new one).

Tokens stay where they were made. Placement needs lengths alone, so rows of some 40 bytes are packed:
first within each input partition, in chunks of bounded size and without a shuffle; the pieces of bins
that stay unfilled are then packed again together, in groups of bounded size. Neither sources nor
copies matter to the placement, so there is nothing to skew.

Defined cases: a null text counts as empty and gives one piece that holds the end token; repeated rows
are separate documents; an empty table gives an empty result; a long text is cut into full pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import blocks, stored, table, texts
from aridspan.llm.tokens import encode_block, loaded, vocabulary_path

SEQUENCE, END = 2048, 0
#: Pieces that one task packs together at most, and the unfilled share of a sequence that is tried again.
GROUP, SLACK = 200_000, 1 / 256


def tokenize(docs: DataFrame, path: str | None = None, length: int = SEQUENCE, end: int = END) -> DataFrame:
    """Pieces of at most length tokens of each row's text and an end token: doc_id, piece, start, length,
    ids (binary: little-endian unsigned 32-bit token ids). path: the tokenizer's file."""
    path = path or vocabulary_path()
    last = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows, piece, start, ids = [], [], [], []
            for i, got in enumerate(encode_block(texts(block), path)):
                got += last
                for k, at in enumerate(range(0, len(got), 4 * length)):
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    ids.append(got[at : at + 4 * length])
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )
        loaded(path).forget()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places items one after another: bin and offset of each item, and the fill of each bin."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    far = np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        best, gap = 2 * int(count[capacity - s]) + 1 if s < capacity else 0, capacity
        if count[s] and 1 - 2 * int(count[s]) <= best:
            best, gap = 1 - 2 * int(count[s]), s
        if s + 1 < capacity:
            before = count[s + 1 : capacity]
            change = np.where(before > 0, 2 * (count[1 : capacity - s] - before) + 2, far)
            k = int(change.argmin())
            if change[k] < best:
                gap = s + 1 + k
        if gap == capacity:
            bins[i], offsets[i] = len(fill), 0
            fill.append(s)
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
            bins[i], offsets[i] = b, fill[b]
            fill[b] += s
        if left := gap - s:
            open_bins[left].append(int(bins[i]))
            count[left] += 1
    return bins, offsets, np.asarray(fill, np.int64)


def pack(pieces: DataFrame, capacity: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces (length: 1 to capacity; other columns are carried along, so leave
    token ids out and join them by key where they are needed)."""
    names = pieces.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def packer(level: int, tries_again: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = (level << 60) + (TaskContext.get().partitionId() << 36)
            held: list[pa.RecordBatch] = []

            def packed() -> pa.RecordBatch:
                nonlocal made
                rows = pa.Table.from_batches(held).combine_chunks()
                sizes = rows.column("length").to_numpy()
                order = np.argsort(-sizes, kind="stable")
                bins, offsets, fill = sum_of_squares(sizes[order], capacity)
                again = (capacity - fill[bins] > capacity * SLACK) & tries_again
                back = np.argsort(order, kind="stable")
                ids = bins + made
                made += len(fill)
                rows = rows.append_column("sequence_id", pa.array(ids[back]))
                rows = rows.append_column("offset", pa.array(offsets[back]))
                return rows.append_column("again", pa.array(again[back])).to_batches()[0]

            n = 0
            for batch in batches:
                for at in range(0, batch.num_rows, group):
                    part = batch.slice(at, group)
                    if n and n + part.num_rows > group:
                        yield packed()
                        held, n = [], 0
                    held.append(part)
                    n += part.num_rows
            if n:
                yield packed()

        return run

    first = stored(
        pieces.mapInArrow(packer(1, True), f"{schema}, sequence_id long, offset long, again boolean"), "packed"
    )
    rest = first.filter("again").select(*names)
    tasks = -(-rest.count() // group)
    second = (
        rest.repartition(max(1, tasks))
        .mapInArrow(packer(2, False), f"{schema}, sequence_id long, offset long, again boolean")
        .drop("again")
    )
    return first.filter("not again").drop("again").unionByName(second)


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all pieces of docs (doc_id, text); the checksum
    is taken on the pieces' ids before lengths alone go on."""
    pieces = tokenize(docs)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(table(spark, sf_dir, "documents"))
