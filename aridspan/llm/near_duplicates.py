"""MinHash near-duplicates: minima of many universal hash functions, banding, signature comparison,
confirmation on full shingle sets, and connected components by large-star and small-star.

1. One pass makes each document's sketch: size and hash of its shingle set, a hash for each band, a byte
   for each minimum. Documents with equal sets become one class before anything else moves.
2. Classes that share a band's bucket are candidates. Each class is first held against the best looking
   of its buckets' smallest members (one confirmation a class), which settles groups of copies.
3. Buckets that still hold more than one component are searched whole. They are cut into blocks with a bound in
   members and in shingles, a large component into blocks of its own, and every two blocks meet that do not belong
   to one component. They meet by signatures first; only members that look like one of another component
   bring their shingle sets, pairs are confirmed where they are found, and only links leave the task, at most
   one fewer than it has members.
4. All links are confirmed on the full shingle sets of both texts; they are the edges of the components.

Members of a hot bucket are never brought together: joins by bucket deal them out, and blocks spread them.

A pair at similarity 0.75 misses all 48 bands of 5 minima with probability 2e-6, and falls under the
signature threshold with less; every pair that is reported linked has been confirmed exactly.

Defined cases: a null or empty text, or one without words, has no shingles and is linked with nothing;
fewer words than a shingle make one shingle of all words; rows that repeat a doc_id are one document;
rows without doc_id have a null component_id and are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import Recent, blocks, join_spread, stored, table, texts
from aridspan.llm.components import components

SHINGLE = 5
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 48, 5
#: Pairs whose signatures look less alike than this are not confirmed; 0.75 is over four deviations away.
LOOKS = 0.62
#: Members of a bucket that one block holds, and their shingles together (but for a longer text alone).
BLOCK, BLOCK_SHINGLES = 512, 1 << 20

#: Stands for the components that share blocks.
SHARED = -(1 << 63)

P1, P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(Recent):
    """64-bit hashes of words."""

    def make(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


HASHES = WordHashes()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * P1
    h = (h ^ (h >> np.uint64(29))) * P2
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, length: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; bytes.lower and bytes.split know ASCII alone."""
    words = (text or b"").lower().split()
    n = len(words)
    w = np.fromiter(map(HASHES.__getitem__, words), np.uint64, n)
    k = min(n, length)
    if not k:
        return w
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * P2 + w[i : n - k + 1 + i]
    return np.unique(mixed(h))


def coefficients(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, count, np.uint64)


def minima(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of each function a * x + b over the set."""
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 4096):
        x = np.multiply.outer(a, h[at : at + 4096])
        x += b[:, None]
        np.minimum(out, x.min(1), out=out)
    return out >> np.uint64(32)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash, bands (one bucket each), signature of each row of docs (doc_id, text); the last
    three are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coefficients(BANDS * ROWS)
        for block in blocks(batches, "text"):
            n, sets, bands, signatures = [], [], [], []
            for text in texts(block):
                h = shingles(text)
                n.append(len(h))
                if not len(h):
                    sets.append(None), bands.append(None), signatures.append(None)
                    continue
                m = minima(h, a, b)
                key = np.arange(BANDS, dtype=np.uint64)
                for i in range(ROWS):
                    key = mixed(key * P2 + m[i::ROWS])
                sets.append(xxhash.xxh3_128_digest(h))
                bands.append(key.view(np.int64))
                signatures.append((m & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_hash", "bands", "signature"],
            )
        HASHES.forget()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_hash binary, bands array<long>, signature binary"
    )


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of one signature and many; equal bytes by chance are taken off."""
    return ((y == x).mean(1) * 256 - 1) / 255


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are linked."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def across_parts(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Signatures and numbered components of a group's rows, sorted by their block; how many are of the first block;
    whether there is but one block."""
    rows.sort(key=lambda r: (r["own"] != r["i"], r["node"]))
    s = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint8).reshape(len(rows), -1)
    _, part = np.unique(np.array([r["component"] for r in rows]), return_inverse=True)
    return s, part, sum(r["own"] == r["i"] for r in rows), rows[0]["i"] == rows[0]["k"]


def looking_alike(rows: list[dict]) -> list[dict]:
    """The rows of a group that look like one of another component in the other block."""
    s, part, first, alone = across_parts(rows)
    out = np.zeros(len(rows), bool)
    for x in range(first):
        start = x + 1 if alone else first
        other = start + np.flatnonzero(part[start:] != part[x])
        if len(other):
            other = other[alike(s[x], s[other]) >= LOOKS]
            out[other] = True
            out[x] |= len(other) > 0
    return [rows[i] for i in np.flatnonzero(out)]


def links_across(rows: list[dict]) -> tuple[list[int], list[int]]:
    """Links between members of different components, for one bucket's blocks i and k (own: a member's block). Members
    that a link has joined are not held against each other again."""
    s, part, first, alone = across_parts(rows)
    node = [r["node"] for r in rows]
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    u, v = [], []
    for x in range(first):
        start = x + 1 if alone else first
        other = start + np.flatnonzero(part[start:] != part[x])
        if not len(other):
            continue
        looks = alike(s[x], s[other])
        other, looks = other[looks >= LOOKS], looks[looks >= LOOKS]
        for y in other[np.argsort(-looks, kind="stable")].tolist():
            if part[x] != part[y] and linked(sets[x], sets[y]):
                u.append(node[x])
                v.append(node[y])
                part[part == part[y]] = part[x]
    return u, v


GROUP = "bucket long, i long, k long, own long, node long, component long, signature binary"


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (bucket, i, k) of batches sorted by these."""
    rows = (r for batch in batches for at in range(0, batch.num_rows, 256) for r in batch.slice(at, 256).to_pylist())
    for _, group in groupby(rows, key=lambda r: (r["bucket"], r["i"], r["k"])):
        yield list(group)


def dealt(groups: DataFrame) -> DataFrame:
    return groups.repartition("bucket", "i", "k").sortWithinPartitions("bucket", "i", "k")


def meeting(rows: DataFrame) -> DataFrame:
    """GROUP: each member once for every pair of blocks in which it meets others; rows: bucket, class_id, component,
    n_shingles, signature, of buckets with several components. Members of a component that fills a block have blocks of
    their own, which do not meet each other; the others share blocks."""
    weigh = lambda n, w: F.greatest(n / F.lit(BLOCK), w / F.lit(BLOCK_SHINGLES))
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    large = weigh(F.col("n"), F.col("w")) >= 1
    filled = (
        sizes.withColumn("holder", F.when(large, F.col("component")))
        .groupBy("bucket", "holder")
        .agg(F.sum("n").alias("n"), F.ceil(weigh(F.sum("n"), F.sum("w"))).alias("parts"))
    )
    shape = F.struct(F.coalesce("holder", F.lit(SHARED)).alias("holder"), "parts")
    shapes = stored(
        filled.groupBy("bucket").agg(F.sum("n").alias("n"), F.collect_list(shape).alias("shapes"), F.collect_list(F.col("holder")).alias("large")), "blocks"
    )
    placed = join_spread(rows, shapes, "bucket", "class_id").drop("n")
    number = lambda holder, j: F.xxhash64(holder, j)
    holder = F.when(F.array_contains("large", F.col("component")), F.col("component")).otherwise(F.lit(SHARED))
    own_parts = F.get(F.filter("shapes", lambda x: x["holder"] == F.col("holder")), F.lit(0))["parts"]
    every = F.flatten(
        F.transform(
            F.filter("shapes", lambda x: (x["holder"] == F.lit(SHARED)) | (x["holder"] != F.col("holder"))),
            lambda x: F.transform(F.sequence(F.lit(0).cast("long"), x["parts"] - 1), lambda j: number(x["holder"], j)),
        )
    )
    return (
        placed.withColumn("holder", holder.cast("long"))
        .withColumn("own", number(F.col("holder"), F.pmod(F.xxhash64("class_id"), own_parts)))
        .withColumn("other", F.explode(every))
        .select(
            "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("k"), "own",
            F.col("class_id").alias("node"), "component", "signature",
        )
    )


def across(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) between components of a bucket; rows: as of meeting; sets: class_id, shingles."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "binary": pa.binary()}
        names = [f.split() for f in GROUP.split(", ")]
        for group in grouped(batches):
            if found := looking_alike(group):
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], kinds[k]) for n, k in names], [n for n, _ in names])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches):
            u, v = links_across(group)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    found = stored(dealt(meeting(rows)).mapInArrow(look, GROUP), "looking-alike")
    whole = found.join(sets, F.col("node") == F.col("class_id")).drop("class_id")
    return dealt(whole).mapInArrow(confirm, "u long, v long")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """class_id, shingles (binary: the sorted hashes) of rows (class_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 1 << 20):
            sets = pa.array([shingles(t).tobytes() for t in texts(block)], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column("class_id"), sets], ["class_id", "shingles"])
        HASHES.forget()

    return rows.mapInArrow(run, "class_id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked; sets: class_id, shingles. A group's head is read first and kept, the
    others are read one after another; groups are salted, so a head that many pairs share is in many tasks."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(256)).cast("int"))
    heads = pairs.select("a", "salt").distinct().join(sets, F.col("a") == F.col("class_id"))
    rest = pairs.join(sets, F.col("b") == F.col("class_id"))
    rows = heads.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "shingles").unionByName(
        rest.select("a", "salt", F.lit(1).alias("role"), "b", "shingles")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, key = None, None
        for block in blocks(batches, "shingles"):
            u, v = [], []
            for a, salt, role, b, data in zip(*(c.to_pylist() for c in block.columns)):
                h = np.frombuffer(data, np.uint64)
                if role == 0:
                    head, key = h, (a, salt)
                elif key == (a, salt) and linked(head, h):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = stored(sketches(docs), "sketches")
    named = sketch.filter("doc_id IS NOT NULL AND set_hash IS NOT NULL")
    classes = stored(
        named.groupBy("set_hash")
        .agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"), F.min_by(F.struct("bands", "signature", "n_shingles"), "doc_id").alias("x"))
        .select("set_hash", "class_id", "n", "x.bands", "x.signature", "x.n_shingles"),
        "classes",
    )
    entries = classes.select("class_id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("class_id").alias("head"), F.max("class_id").alias("last"), F.count("*").alias("n"))
    shared = stored(shared.filter("head <> last").drop("last"), "buckets")
    members = stored(join_spread(entries, shared, "bucket", "class_id").drop("n"), "members")
    signatures = stored(
        classes.join(members.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "signature", "n_shingles"), "signatures"
    )
    wanted = signatures.select("class_id")
    # always a merge join: texts move once, whether few or many of them are wanted
    held = docs.join(wanted.hint("merge"), F.col("doc_id") == F.col("class_id")).select("class_id", "text").dropDuplicates(["class_id"])
    sets = stored(shingle_sets(held), "shingle-sets")

    # each class and the best looking of its buckets' heads
    stars = stored(members.filter("class_id <> head").select("class_id", "head").distinct(), "stars")
    heads = stars.groupBy("head").agg(F.count("*").alias("n")).join(signatures, F.col("head") == F.col("class_id"))
    heads = stored(heads.select("head", "n", F.col("signature").alias("t")), "heads")
    own = signatures.select("class_id", F.col("signature").alias("s"))
    looked = looked_alike(join_spread(stars, heads, "head", "class_id").join(own, "class_id"))
    best = looked.groupBy("class_id").agg(F.max_by("head", F.struct("looks", -F.col("head"))).alias("head"))
    edges = stored(confirmed(best.select(F.col("head").alias("a"), F.col("class_id").alias("b")), sets), "links")
    found = components(edges)

    # pairs across the components that remain in a bucket
    placed = members.join(found, F.col("class_id") == F.col("node"), "left").select(
        "bucket", "class_id", F.coalesce("component", "class_id").alias("component")
    )
    placed = stored(placed, "placed")
    least = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
    open_ = stored(least.filter("x <> y").select("bucket", "n"), "open-buckets")
    rows = stored(join_spread(placed, open_, "bucket", "class_id").drop("n").join(signatures, "class_id"), "open")
    more = stored(across(rows, sets), "links")
    found = stored(components(edges.unionByName(more)), "components")

    # back to the documents
    names = classes.select("set_hash", "class_id", "n").join(found, F.col("class_id") == F.col("node"), "left").select(
        "set_hash", "n", F.coalesce("component", "class_id").alias("component_id")
    )
    rows = sketch.select("doc_id", "n_shingles", "set_hash")
    out = join_spread(rows, stored(names, "names"), "set_hash", "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def looked_alike(pairs: DataFrame) -> DataFrame:
    """class_id, head, looks of the pairs whose signatures s and t look alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s, t = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("s", "t")
            )
            looks = ((s == t).mean(1) * 256 - 1) / 255
            keep = pa.array(looks >= LOOKS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id").filter(keep), batch.column("head").filter(keep), pa.array(looks).filter(keep)],
                ["class_id", "head", "looks"],
            )

    return pairs.select("class_id", "head", "s", "t").mapInArrow(run, "class_id long, head long, looks double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
