"""Towns, and documents of the remote catalogue."""

from __future__ import annotations

import os
import urllib.error
import urllib.request
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.schemas import TOWNS

TIMEOUT, FILE_TIMEOUT, CHUNK = 30, 600, 1 << 20


def read_towns(spark: SparkSession, path: str) -> DataFrame:
    """Towns of a CSV separated by semicolons; names of columns are trimmed, population may be missing."""
    rows = spark.read.schema(TOWNS).option("sep", ";").option("header", True).csv(path)
    return rows.toDF(*(c.strip() for c in rows.columns))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """url, xml of landed catalogue documents."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("xml"))


def fetch_documents(urls: DataFrame) -> DataFrame:
    """url, xml, error of each url, fetched in tasks; a failure is a row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for url in frame["url"]:
                try:
                    with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:  # noqa: S310
                        rows.append((url, answer.read().decode("utf-8"), None))
                except (OSError, ValueError) as error:
                    rows.append((url, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["url", "xml", "error"])

    return urls.select("url").mapInPandas(run, "url string, xml string, error string")


def save(url: str, target: Path) -> None:
    """Streams a file into place: a part file first, so that a broken transfer never looks complete."""
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f"{target.name}.{os.getpid()}.part")
    try:
        with urllib.request.urlopen(url, timeout=FILE_TIMEOUT) as answer, part.open("wb") as out:  # noqa: S310
            while chunk := answer.read(CHUNK):
                out.write(chunk)
        part.replace(target)
    finally:
        part.unlink(missing_ok=True)
