"""What the text operators share: tables in the shared folder, Arrow blocks, words.

Operators read only the columns they name (``doc_id``, ``text`` and so on) and return only the
columns they state, so further columns of the input, whatever their names, never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.shipping import shared_dir, ship

#: White space that parts words, and all ASCII characters that part words of letters and digits.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20]))
PARTING = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: bytes.translate table: A-Z lower-cased, every ASCII byte outside letters and digits a space.
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


#: Rows and bytes of an Arrow batch: texts are long, and batches of the usual 10,000 rows would fill a small executor.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this package on its executors and batches fit for texts; both stay set for the session."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends there, so that
    a lost executor costs a reread of files and no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/aridspan/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_spread(rows: DataFrame, totals: DataFrame, key: str, spread: str, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with totals (a stored table: one row for each key, n: how many of rows have it). Rows of a hot key are
    dealt out to all tasks by the column spread; so are rows without a key, which meet nothing. Hot are keys with over a thousand rows and over a ten-thousandth of
    all; so there are fewer than 10,000 of them, which are broadcast."""
    least = max(1_000, (totals.agg(F.sum("n")).first()[0] or 0) // 10_000)
    hot = F.broadcast(totals.filter(F.col("n") > least).select(key, F.lit(True).alias("_hot")))
    salt, every = F.pmod(F.xxhash64(spread), F.lit(n_tasks(rows))), F.sequence(F.lit(0), F.lit(n_tasks(rows) - 1))
    dealt = rows.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(0).cast("int")).drop("_hot")
    copied = totals.join(hot, key, "left").withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


def words_of(text: Column, parting: str, lower: bool = False) -> Column:
    """The words of a text between characters of parting (null: none), with A-Z lower-cased if asked. Characters are
    exchanged one by one and the split is at a single space: many times faster than a pattern for words."""
    others = parting.replace(" ", "")
    spaced = F.translate(text, others + UPPER * lower, " " * len(others) + UPPER.lower() * lower)
    return F.coalesce(F.array_remove(F.split(spaced, " ", -1), ""), F.array().cast("array<string>"))


class Recent(dict):
    """What make() gives for short keys, remembered for the keys of late: when size of them are held, they become the
    old ones, and those of the old ones that are asked for again come back."""

    def __init__(self, size: int = 80_000, longest: int = 64) -> None:
        self.size, self.longest, self.old = size, longest, {}

    def make(self, key: bytes) -> object:
        raise NotImplementedError

    def __missing__(self, key: bytes) -> object:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        """For the end of a task, as the worker lives on."""
        self.old = {}
        self.clear()


def blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one block take about max_bytes; a longer text is a block of its own."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    return batch.column(column).cast(pa.binary()).to_pylist()
