"""Token counts as rollups that are maintained by deltas: inserts, deletes and revised counts are signed
rows, combined by source, language and tokenizer version, and added to totals. A batch is committed
once: it is written under a name of its attempt, and one strict rename makes it count, so that of two writers
of a batch one wins, one that failed half-way leaves nothing that counts, and a batch that is sent again
changes nothing. Compaction writes the totals beside the batches; one rename of a manifest, which keeps the
names of all batches in them, makes these totals count and the old folders not. So a crash at any moment counts
nothing twice, and old batches may be sent again for ever. That needs a file system whose rename of a file or folder
is atomic and refuses a name that is taken, as HDFS and local disks have; object stores have none.

Native: counts are made by built-in functions inside the scan. Only a document's counts move, and every
sum is combined before its shuffle, so a hot source is a few rows by then.

Defined cases: a null text has no tokens; null sources and languages are keys of their own; repeated rows
count each time; a key whose documents and tokens are all taken back vanishes; an empty table commits
an empty batch.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import PARTING, SPACES, blocks, join_spread, shared_dir, stored, table, texts, words_of

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

#: Tokenizer versions that the characters between tokens define: white space, or all but letters and digits.
VERSIONS = {"space-1": SPACES, "alnum-1": PARTING}


def counted(text: Column, parting: str) -> Column:
    return F.size(words_of(text, parting)).cast("long")


def public_tokenizer_counts(docs: DataFrame, path: str) -> DataFrame:
    """docs (text, any others) with n_tokens by a public tokenizer's file, for versions that no characters define."""
    from aridspan.llm.tokens import encode_block, loaded

    def run(batches):
        for block in blocks(batches, "text"):
            n = [len(ids) // 4 for ids in encode_block(texts(block), path)]
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(n, pa.int64())], [*block.schema.names, "n_tokens"])
        loaded(path).forget()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, n_tokens long")


def deltas(counts: DataFrame, sign: int | None, was: str | None = None) -> DataFrame:
    """Signed rows (DELTA) of counts (source, lang, tokenizer, n_tokens). sign 1: inserted, -1: deleted, None: counted
    anew, where the column that was names held the old count."""
    if sign is None:
        docs, tokens = F.lit(0), F.col("n_tokens") - F.col(was)
    else:
        docs, tokens = F.lit(sign), F.lit(sign) * F.col("n_tokens")
    return counts.select(*KEYS, docs.cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens"))


@dataclass
class Ledger:
    """Committed batches under a folder that all machines share."""

    spark: SparkSession
    folder: str
    _path: object = field(init=False, repr=False)
    _files: object = field(init=False, repr=False)
    _strict: object = field(init=False, repr=False)

    def __post_init__(self) -> None:
        jvm = self.spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        self._files = self._path(self.folder).getFileSystem(conf)
        self._strict = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)
        self._files.mkdirs(self._path(self.folder))

    def _listed(self, pattern: str) -> list[str]:
        found = self._files.globStatus(self._path(f"{self.folder}/{pattern}"))
        return sorted(x.getPath().getName() for x in found or ())

    def _named(self, attempt: str, name: str) -> bool:
        """Gives an attempt its name; False, and the attempt goes, if that name is taken."""
        options = self.spark._jvm.org.apache.hadoop.fs.Options
        none = self.spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 0)
        try:
            self._strict.rename(self._path(f"{self.folder}/{attempt}"), self._path(f"{self.folder}/{name}"), none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            self._files.delete(self._path(f"{self.folder}/{attempt}"), True)
            return False
        return True

    def _manifest(self) -> dict:
        """The latest manifest: number, folder of totals, names of the batches in them."""
        found = self._listed("manifest-*.json")
        if not found:
            return {"number": 0, "folder": None, "batches": []}
        return json.loads(self.spark.read.text(f"{self.folder}/{found[-1]}", wholetext=True).first()[0])

    def _loose(self, manifest: dict) -> list[str]:
        """The batches that count beside the manifest's totals."""
        return sorted({x.removeprefix("batch=") for x in self._listed("batch=*")} - set(manifest["batches"]))

    def committed(self) -> list[str]:
        """The names of the batches that count, compacted ones too."""
        manifest = self._manifest()
        return sorted([*manifest["batches"], *self._loose(manifest)])

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Adds signed rows (DELTA) as a batch; False, and no change, if that batch is there."""
        if batch in self.committed():
            return False
        combined = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        attempt = f"attempt-{uuid.uuid4().hex}"
        combined.write.parquet(f"{self.folder}/{attempt}")
        return self._named(attempt, f"batch={batch}")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all batches that count."""
        manifest = self._manifest()
        return self._sums(manifest, self._loose(manifest))

    def _sums(self, manifest: dict, loose: list[str]) -> DataFrame:
        """The totals of exactly these: what a manifest holds and the batches beside it."""
        names = [*([manifest["folder"]] if manifest["folder"] else []), *(f"batch={b}" for b in loose)]
        paths = [f"{self.folder}/{name}" for name in names]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> bool:
        """Puts the totals in place of the batches that count now; False, and no change, if another compaction was first.
        A batch that is committed meanwhile stays beside the totals. For times without readers, as folders that no longer
        count are deleted in the end."""
        before = self._manifest()
        loose = self._loose(before)
        names, number = sorted([*before["batches"], *loose]), before["number"] + 1
        folder = f"totals-{number:08d}-{uuid.uuid4().hex}"
        self._sums(before, loose).coalesce(1).write.parquet(f"{self.folder}/{folder}")
        attempt = f"attempt-{uuid.uuid4().hex}"
        out = self._files.create(self._path(f"{self.folder}/{attempt}"))
        out.write(bytearray(json.dumps({"number": number, "folder": folder, "batches": names}).encode()))
        out.close()
        if not self._named(attempt, f"manifest-{number:08d}.json"):
            self._files.delete(self._path(f"{self.folder}/{folder}"), True)
            return False
        self.tidy()
        return True

    def tidy(self) -> None:
        """Deletes folders that do not count: compacted batches, older totals and their manifests."""
        now = self._manifest()
        old = [f"batch={b}" for b in now["batches"]] + [x for x in self._listed("totals-*") if x != now["folder"]]
        for name in [*old, *self._listed("manifest-*.json")[:-1]]:
            self._files.delete(self._path(f"{self.folder}/{name}"), True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: all documents inserted; exact copies (all but the smallest doc_id of a text) deleted;
    the others with repeated lines counted anew without the repeats; and the second batch sent again."""
    lines = F.split("text", "\n", -1)
    shorter = F.when(F.size(F.array_distinct(lines)) < F.size(lines), F.array_join(F.array_distinct(lines), "\n"))
    per = []
    for version, parting in VERSIONS.items():
        n = counted(F.col("text"), parting)
        n_unique = F.when(F.col("shorter").isNull(), n).otherwise(counted(F.col("shorter"), parting))
        per.append(F.struct(F.lit(version).alias("tokenizer"), n.alias("n_tokens"), n_unique.alias("n_unique")))
    counts = stored(
        table(spark, sf_dir, "documents").withColumn("shorter", shorter).select("doc_id", "source", "lang", F.md5("text").alias("text_hash"), F.array(*per).alias("per")),
        "token-counts",
    )
    first = counts.filter("text_hash IS NOT NULL").groupBy("text_hash").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    first = stored(first.filter("n > 1"), "copies")
    marked = join_spread(counts, first, "text_hash", "doc_id", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)))
    rows = stored(marked.select("source", "lang", "copy", F.inline("per")), "token-rows")
    ledger = Ledger(spark, f"{shared_dir(spark)}/aridspan/ledger-{uuid.uuid4().hex}")
    ledger.commit("1-insert", deltas(rows, 1))
    ledger.commit("2-copies", deltas(rows.filter("copy"), -1))
    renewed = rows.filter("NOT copy AND n_unique <> n_tokens").withColumnRenamed("n_tokens", "was").withColumnRenamed("n_unique", "n_tokens")
    ledger.commit("3-lines", deltas(renewed, None, "was"))
    ledger.commit("2-copies", deltas(rows.filter("copy"), -1))
    return ledger.totals()


ORACLE_SQL = r"""
WITH kept AS (
  SELECT source, lang, list_aggregate(list_distinct(string_split(text, chr(10))), 'string_agg', chr(10)) AS clean
  FROM documents AS d
  WHERE text IS NULL OR doc_id = (SELECT min(doc_id) FROM documents AS e WHERE e.text = d.text)
), counts AS (
  SELECT source, lang, unnest([
    {'tokenizer': 'space-1', 'n': len(regexp_extract_all(clean, '[^\x20\x09-\x0D]+'))},
    {'tokenizer': 'alnum-1', 'n': len(regexp_extract_all(clean, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))}]) AS x
  FROM kept
)
SELECT source, lang, x.tokenizer AS tokenizer, count(*) AS n_docs, CAST(coalesce(sum(x.n), 0) AS BIGINT) AS n_tokens
FROM counts GROUP BY ALL
"""
