"""Work that a crawl or a download has to do, as a table that outlives its run.

Each piece of work is a key with a host and a payload. A round takes what is due, does it in tasks, at most ``per_host`` pieces
of one host at a time, and writes the outcomes as one more folder; the state of a key is its latest row. So a run that ends
half-way goes on where it stood, and repeats one round at most. What fails is tried again after a pause that doubles
each time, until it works, has failed ``most`` times, or never can work. What was fetched before is asked for with the
validators that its server gave, and stays as it is if the server says so.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.shipping import ship
from aridspan.sources.tables import TIMEOUT, save

WORK = "key string, host string, payload string, state string, tries int, next_try double, etag string, modified string, result string, error string"
TODO, DONE, FAILED = "todo", "done", "failed"
#: Answers that another try will not change.
FINAL = {400, 401, 403, 404, 405, 410, 414}
#: (result, etag, modified); a result of None leaves what is known.
Done = tuple[str | None, str | None, str | None]


def hopeless(error: Exception) -> bool:
    """Whether another try would fail as well."""
    if isinstance(error, urllib.error.HTTPError):
        return error.code in FINAL
    return isinstance(error, ValueError) or isinstance(getattr(error, "reason", error), FileNotFoundError)


def host_of(url: str) -> str:
    """SQL for the host of a URL, empty if it has none."""
    return f"lower(regexp_extract({url}, '^[A-Za-z]+://(?:[^/@]*@)?([^/:?#]*)', 1))"


def document(url: str, etag: str | None, modified: str | None) -> Done:
    """The text at a URL, unless it is the one that these validators name."""
    headers = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", modified)) if v}
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=TIMEOUT) as answer:  # noqa: S310
            return answer.read().decode("utf-8"), answer.headers.get("ETag"), answer.headers.get("Last-Modified")
    except urllib.error.HTTPError as error:
        if error.code == 304:
            return None, etag, modified
        raise


def candidates(payload: str, etag: str | None, modified: str | None) -> Done:
    """Saves the first of the payload's [url, target] that can be fetched; the result is its name."""
    errors: list[Exception] = []
    for url, target in json.loads(payload):
        try:
            save(url, Path(target))
            return Path(target).name, None, None
        except (OSError, ValueError) as error:
            errors.append(error)
    text = "; ".join(f"{Path(t).name}: {type(e).__name__}" for (_, t), e in zip(json.loads(payload), errors))
    raise (ValueError if all(map(hopeless, errors)) else OSError)(text)


@dataclass
class WorkTable:
    """See above; folder is one that driver and executors share. pause: seconds after the first failure; per_round: pieces of
    work that a round takes, so that little is repeated after a crash."""

    spark: SparkSession
    folder: str
    most: int = 5
    pause: float = 1.0
    per_host: int = 4
    per_round: int = 20_000

    def _rounds(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        found = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path(f"{self.folder}/round-*/_SUCCESS"))
        return sorted(int(x.getPath().getParent().getName().split("-")[1]) for x in found or ())

    def _append(self, rows: DataFrame) -> None:
        number = max(self._rounds(), default=0) + 1
        columns = [F.col(name).cast(kind) for name, kind in (f.split() for f in WORK.split(", "))]
        rows.select(*columns, F.lit(number).alias("round")).write.mode("overwrite").parquet(f"{self.folder}/round-{number:06d}")

    def current(self) -> DataFrame:
        """WORK: the latest row of each key."""
        rounds = self._rounds()
        if not rounds:
            return self.spark.createDataFrame([], WORK)
        rows = self.spark.read.schema(f"{WORK}, round int").parquet(*(f"{self.folder}/round-{n:06d}" for n in rounds))
        names = [f.split()[0] for f in WORK.split(", ")]
        return rows.groupBy("key").agg(F.max_by(F.struct(*names), "round").alias("now")).select("now.*")

    def add(self, rows: DataFrame, again: bool = False) -> None:
        """Makes rows (key, host, payload) work to do, if their keys are new; again: also if they are known, by what is known."""
        new = rows.select("key", "host", "payload").dropDuplicates(["key"])
        known = self.current().select("key", "etag", "modified", "result")
        new = new.join(known, "key", "left") if again else new.join(known, "key", "left_anti").withColumns(dict.fromkeys(("etag", "modified", "result"), F.lit(None)))
        self._append(new.withColumns({"state": F.lit(TODO), "tries": F.lit(0), "next_try": F.lit(0.0), "error": F.lit(None)}))

    def step(self, do: Callable[[str, str | None, str | None], Done], now: float) -> int:
        """Does what is due at a time (seconds); returns how much that was."""
        due = self.current().filter((F.col("state") == TODO) & (F.col("next_try") <= now)).limit(self.per_round)
        number, most, pause = max(self._rounds(), default=0) + 1, self.most, self.pause

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for r in frame.itertuples(index=False):
                    row = r._asdict()
                    try:
                        result, row["etag"], row["modified"] = do(r.payload, r.etag, r.modified)
                        row |= {"state": DONE, "error": None, "tries": r.tries + 1, "result": r.result if result is None else result}
                    except (OSError, ValueError) as error:
                        given_up = hopeless(error) or r.tries + 1 >= most
                        row |= {"state": FAILED if given_up else TODO, "tries": r.tries + 1, "error": f"{type(error).__name__}: {error}"}
                        row["next_try"] = time.time() + pause * 2**r.tries
                    rows.append(row)
                yield pd.DataFrame(rows, columns=list(frame.columns))

        slots = due.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(self.per_host)))
        spread = slots.repartition(max(self.per_host, self.spark.sparkContext.defaultParallelism), "host", "slot").drop("slot")
        ship(self.spark)
        self._append(spread.mapInPandas(run, WORK))
        return self.spark.read.parquet(f"{self.folder}/round-{number:06d}").count()

    def run(self, do: Callable[[str, str | None, str | None], Done]) -> DataFrame:
        """Rounds until nothing is left to do; returns current()."""
        while (left := self.current().filter(F.col("state") == TODO).agg(F.min("next_try")).first()[0]) is not None:
            time.sleep(max(0.0, left - time.time()))
            self.step(do, time.time())
        return self.current()
