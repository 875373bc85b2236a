"""Prefix trie of conversations by preorder intervals: distinct sequences of turns are ranked in lexicographic order, which
puts every node right before its subtree. A node's place in that preorder and the place where its subtree ends are
stored, and what a subtree holds (leaves, tokens that sharing saves) is the difference of two prefix sums, which are
taken over all nodes at once, by ranges of places.

A turn is 16 bytes of digest of its role and text; texts never move. A node is named by 128 bits: the exclusive or of
hashes of its turns with their depths, a running aggregate. Equal conversations are combined before their nodes are made,
and nodes before their shuffle, so neither a common first turn nor a group of equal conversations is a hot key; a
node of many children is dealt out with ``join_spread``. A list of members is written as strings of at most 4,096 ids by
many tasks and only hashed in one, as a checksum of one string is made from its beginning to its end; no task holds it.
A conversation's digests are one row.

Defined cases: null roles and texts are empty; rows of one turn stand in order of role, then of the text's MD5;
rows without conv_id belong to no conversation; an empty table has no node, not even a root; repeated rows are turns
like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from aridspan.llm.common import join_spread, n_tasks, stored, table

#: Conversations of a family share the turns of its first; how many, is a checksum of the conversation below this.
FAMILY, MOST_SHARED = 5, 9
IDS_A_STRING = 4096


def prefix_sums(df: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """A stored table of df with, for each of values (longs), ``<value>_before``: its sum over all rows that come before in
    order (which names a row). Each task sums its own range of rows; the driver adds up one total for each task."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(f"{v}_before", T.LongType()) for v in values), T.StructField("_part", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = dict.fromkeys(values, 0)
        for batch in batches:
            columns = list(batch.columns)
            for v in values:
                own = np.asarray(batch.column(v), dtype=np.int64)
                upto = held[v] + np.cumsum(own)
                columns.append(pa.array(upto - own))
                held[v] = int(upto[-1]) if len(upto) else held[v]
            columns.append(pa.array(np.full(batch.num_rows, TaskContext.get().partitionId(), dtype=np.int32)))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    within = stored(df.repartitionByRange(n_tasks(df), *order).sortWithinPartitions(*order).mapInArrow(run, schema), "prefix-sums")
    totals = sorted(within.groupBy("_part").agg(*(F.sum(v).alias(v) for v in values)).collect())
    sums, offsets = [0] * len(values), []
    for part, *total in totals:
        offsets.append((part, *sums))
        sums = [a + b for a, b in zip(sums, total)]
    offset = df.sparkSession.createDataFrame(offsets, ", ".join(["_part int", *(f"_{v} long" for v in values)]))
    whole = {f"{v}_before": F.col(f"{v}_before") + F.col(f"_{v}") for v in values}
    return within.join(F.broadcast(offset), "_part").withColumns(whole).drop("_part", *(f"_{v}" for v in values))


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, k (from 1), key (16 bytes for role and text), bytes of each row of rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(text)
    slim = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), digest.alias("digest"),
        F.unhex(F.md5(F.concat(F.md5(role), digest))).alias("key"), F.octet_length(text).cast("long").alias("bytes"),
    )
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return slim.select("conv_id", F.row_number().over(order).alias("k"), "key", "bytes")


def shared_turns(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(MOST_SHARED))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id of every conversation, and conv_id, part, k, key, bytes of its turns: its family's first turns (part 0), then
    its own after as many (part 1)."""
    every = stored(turns(rows), "trie-turns")
    ids = every.select("conv_id").distinct()
    shared = ids.select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first"), F.col("conv_id").alias("to"))
    heads = every.filter((F.col("conv_id") % FAMILY == 0) & (F.col("k") < MOST_SHARED)).join(shared, F.col("conv_id") == F.col("first"))
    heads = heads.filter(F.col("k") <= shared_turns(F.col("to"))).select(F.col("to").alias("conv_id"), F.lit(0).alias("part"), "k", "key", "bytes")
    own = every.filter(F.col("k") > shared_turns(F.col("conv_id"))).select("conv_id", F.lit(1).alias("part"), "k", "key", "bytes")
    return ids, heads.unionByName(own)


def sequences(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """A stored table of conv_id, path (name of its last node), turns (depth, key, bytes, path of each node on its way) for
    each conversation of ids, from rows (conv_id, part, k, key, bytes) in order of part and k."""
    order = W.partitionBy("conv_id").orderBy("part", "k")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumn("depth", F.row_number().over(order))
    hashes = {"a": F.xxhash64("depth", "key"), "b": F.xxhash64("key", "depth")}
    path = F.struct(*(F.bit_xor(h).over(upto).alias(c) for c, h in hashes.items())).alias("path")
    held = placed.select("conv_id", F.struct("depth", "key", "bytes", path).alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    nothing = F.from_json(F.lit("[]"), held.schema["turns"].dataType)
    out = ids.join(held, "conv_id", "left").withColumn("turns", F.coalesce("turns", nothing))
    return stored(out.select("conv_id", F.coalesce(F.try_element_at("turns", F.lit(-1))["path"], root_path()).alias("path"), "turns"), "trie-sequences")


def root_path() -> Column:
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def nodes(convs: DataFrame) -> DataFrame:
    """A stored table of path, depth, parent, bytes, n_convs, conv_id, n_ends, first, last for each node of sequences():
    first and last are the lexicographic ranks of the first and the last sequence that begins with it."""
    alike = convs.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("turns").alias("turns"))
    alike = alike.withColumn("keys", F.transform("turns", lambda t: t["key"]))
    ranked = alike.repartitionByRange(n_tasks(convs), "keys").sortWithinPartitions("keys").withColumn("rank", F.monotonically_increasing_id())
    ranked = stored(ranked.drop("keys"), "trie-ranks")
    parent = lambda i: F.when(i > 0, F.get(F.col("turns"), i - 1)["path"]).otherwise(root_path())
    row = lambda path, depth, up, size: F.struct(path.alias("node"), depth.alias("depth"), up.alias("parent"), size.alias("bytes"))
    below = F.transform("turns", lambda t, i: row(t["path"], t["depth"], parent(i), t["bytes"]))
    root = row(root_path(), F.lit(0), F.when(F.lit(False), root_path()), F.lit(0).cast("long"))
    passed = ranked.select("path", "n", "least", "rank", F.inline(F.concat(F.array(root), below)))
    out = passed.groupBy("node", "depth").agg(
        F.first("parent").alias("parent"), F.first("bytes").alias("bytes"), F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"),
        F.coalesce(F.sum(F.when(F.col("node") == F.col("path"), F.col("n"))), F.lit(0)).alias("n_ends"), F.min("rank").alias("first"), F.max("rank").alias("last"),
    )
    return stored(out.withColumnRenamed("node", "path"), "trie-nodes")


def end_digests(convs: DataFrame) -> DataFrame:
    """path, ends_sha256: the SHA-256 of the comma-joined conv_ids, ascending, that end at each node."""
    order = ["path", "conv_id"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, ids = batch.column("path"), batch.column("conv_id").to_pylist()
            a, b = (np.asarray(paths.field(i)) for i in range(2))
            ends = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            cuts = sorted({0, *ends.tolist(), *range(0, len(ids), IDS_A_STRING), len(ids)})
            lists = pa.array([",".join(map(str, ids[i:k])) for i, k in zip(cuts, cuts[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([paths.take(pa.array(cuts[:-1])), batch.column("conv_id").take(pa.array(cuts[:-1])), lists], ["path", "conv_id", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, sha = None, None
        for batch in batches:
            done = []
            for p, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
                if p == path:
                    sha.update(b"," + ids.encode())
                    continue
                if sha is not None:
                    done.append((path, sha.hexdigest()))
                path, sha = p, hashlib.sha256(ids.encode())
            yield digest_batch(batch, done)
        if sha is not None:
            yield digest_batch(batch, [(path, sha.hexdigest())])

    def digest_batch(like: pa.RecordBatch, done: list[tuple]) -> pa.RecordBatch:
        kind = like.schema.field("path").type
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], kind), pa.array([s for _, s in done], pa.string())], ["path", "ends_sha256"])

    pair = "path struct<a: long, b: long>"
    lists = convs.select(*order).repartitionByRange(n_tasks(convs), *order).sortWithinPartitions(*order).mapInArrow(joined, f"{pair}, conv_id long, ids string")
    return lists.repartition(n_tasks(convs), "path").sortWithinPartitions(*order).select("path", "ids").mapInArrow(hashed, f"{pair}, ends_sha256 string")


def intervals(found: DataFrame) -> DataFrame:
    """nodes() with n_children, position (from 0, in preorder), subtree_end (the last position in its subtree), n_leaves and
    saved_tokens."""
    children = found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("n_children"))
    whole = found.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = {"one": F.lit(1).cast("long"), "leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")}
    sums = prefix_sums(whole.withColumns(own), ["first", "depth"], list(own))
    # the last sequence that begins with a node ends where the node's subtree does
    ends = sums.filter("n_ends > 0").select(F.col("first").alias("last"), *((F.col(f"{v}_before") + F.col(v)).alias(f"{v}_upto") for v in own))
    within = {v: F.col(f"{v}_upto") - F.col(f"{v}_before") for v in own}
    return sums.join(ends, "last").select(
        *whole.columns, F.col("one_before").alias("position"), (F.col("one_upto") - 1).alias("subtree_end"),
        within["leaf"].alias("n_leaves"), within["saved"].alias("saved_tokens"),
    )


def trie(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, position,
    subtree_end for each node of the conversations ids (conv_id), whose turns are rows (conv_id, part, k, key, bytes)."""
    convs = sequences(ids, rows)
    placed = stored(intervals(nodes(convs)), "trie-intervals")
    parents = placed.filter("n_children > 0").select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n"))
    out = join_spread(placed, parents, "parent", "path", "left").join(end_digests(convs), "path", "left")
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "position", "subtree_end",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, rows = rebuilt(table(spark, sf_dir, "conversations"))
    return trie(ids, rows).drop("position", "subtree_end")
