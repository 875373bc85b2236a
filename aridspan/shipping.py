"""What executors need: this package, which the driver sends where it is not installed, and a folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package to what executors can import, once for each Spark context."""
    context = spark.sparkContext
    if not getattr(context, "_aridspan_shipped", False):
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="aridspan-")) / "aridspan.zip"
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, f"aridspan/{path.relative_to(root)}")
        context.addPyFile(str(target))
        context._aridspan_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session gets a folder
    of its own, and any other is an error: its machines would each write to their own disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = f"file://{tempfile.mkdtemp(prefix='aridspan-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df computed once, as a table below shared_dir."""
    path = f"{shared_dir(df.sparkSession)}/aridspan/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below shared_dir, for files that are written and read as files of a mounted folder."""
    folder = shared_dir(spark)
    if "://" in folder and not folder.startswith("file://"):
        raise RuntimeError(f"{folder} is not a mounted folder")
    out = Path(folder.removeprefix("file://")) / "aridspan" / f"{name}-{uuid.uuid4().hex}"
    out.mkdir(parents=True)
    return str(out)
