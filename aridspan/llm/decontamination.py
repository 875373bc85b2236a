"""Benchmark decontamination by winnowing: of every 9 consecutive 5-word hashes the smallest is kept as a
fingerprint, so two texts that share 13 consecutive words share a fingerprint at the same place of the
shared span. Fingerprints of documents and benchmark items are joined; a hit at a word can only lie in the
nine windows around it, and the hit is extended to those that equal a window of an item word by word.

Native: DataFrame operations only. Hashes are made by higher-order functions inside the row, so only
fingerprints (a fifth of the words) are exploded, as rows of 24 bytes, and only documents with a hit are
read again, once each whatever the number of hits or items. The work for a text is linear in its words: a
text of one word repeated has one fingerprint and one window for each word, and an item of that word has one
of each in all. Tables made of items are broadcast while their counted rows stay under a limit; beyond it each
of their rows is copied to a fixed number of partitions, among which the rows of a hot key are dealt out.

Defined cases: a null text has no words; items without words match nothing; items of fewer than 13 words
match where all their words stand; a document without words is not contaminated; a repeated item_id
counts once; repeated rows are each judged; empty tables give no hits or an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import PARTING, stored, table, words_of

#: Words of a window, words of a hashed gram; grams of a winnowing window follow.
WINDOW, GRAM = 13, 5
SPAN = WINDOW - GRAM + 1  # nine, see winnowed
#: A packed fingerprint is hash << 30 | place: a text has fewer than 2^30 words, as a row is under 2 GB.
PLACE = (1 << 30) - 1
#: Item tables of at most so many rows (of 13 words at most) are broadcast; larger ones are copied to so many partitions.
MAX_BROADCAST_ROWS, COPIES = 200_000, 32


def words(text: Column) -> Column:
    return words_of(text, PARTING, lower=True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def places(n: Column) -> Column:
    """0 to n - 1, empty if n < 1."""
    return F.when(n >= 1, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def gram(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + k) for k in range(length)))


def packed(hash_: Column, at: Column) -> Column:
    return F.shiftleft(hash_, 30).bitwiseOR(at.cast("long"))


def least_of_three(values: Column, apart: int) -> Column:
    """The least of each value and the two that follow at the distance apart."""
    return F.transform(
        places(F.size(values) - 2 * apart), lambda i: F.least(*(F.get(values, i + apart * k) for k in range(3)))
    )


def winnowed(ws: Column) -> Column:
    """The packed fingerprints of an array of words, each once. The least of nine is the least of three leasts of
    three, which touches six values instead of nine and copies none."""
    grams = lambda hashes: F.transform(
        places(F.size(hashes) - (GRAM - 1)), lambda i: packed(gram(hashes, i, GRAM), i)
    )
    smallest = lambda g: F.array_distinct(let(least_of_three(g, 1), lambda m: least_of_three(m, 3)))
    return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda hashes: let(grams(hashes), smallest))


def whole_grams(ws: Column, length: int) -> Column:
    """Every packed gram of length words."""
    return let(
        F.transform(ws, lambda w: F.xxhash64(w)),
        lambda hashes: F.transform(places(F.size(hashes) - (length - 1)), lambda i: packed(gram(hashes, i, length), i)),
    )


def fingerprints(ws: Column, lengths: list[int]) -> Column:
    """Structs of length and p (packed): winnowed grams for windows of WINDOW words, every gram for shorter lengths."""
    of_length = lambda n, prints: F.transform(prints, lambda p: F.struct(F.lit(n).alias("length"), p.alias("p")))
    return F.concat(of_length(WINDOW, winnowed(ws)), *(of_length(n, whole_grams(ws, n)) for n in lengths))


def exploded(rows: DataFrame, keys: list[str], prints: Column) -> DataFrame:
    """keys, length, place and print of each fingerprint."""
    return rows.select(*keys, F.explode(prints).alias("f")).select(
        *keys, "f.length", F.col("f.p").bitwiseAND(F.lit(PLACE)).cast("int").alias("place"), F.shiftright("f.p", 30).alias("print")
    )


def meet(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows joined with few, a stored table made of items; see MAX_BROADCAST_ROWS."""
    if few.count() <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(few), keys, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(COPIES)).cast("int"))
    copied = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")


def window_at(ws: Column, start: Column, length: Column) -> Column:
    """The words of a window, which hold no space, in one string."""
    return F.array_join(F.slice(ws, start + 1, length), " ")


def item_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored tables of (window, group), each window once, and (group, ids), the sorted item_ids that hold the windows of a group."""
    n = F.size("words")
    at = F.transform(places(F.greatest(n - (WINDOW - 1), F.lit(1))), lambda i: window_at(F.col("words"), i, F.least(n, F.lit(WINDOW))))
    held = items.select(F.col("item_id").cast("string").alias("id"), F.explode(F.array_distinct(at)).alias("window"))
    named = held.groupBy("window").agg(F.sort_array(F.collect_set("id")).alias("ids")).withColumn("group", F.md5(F.to_json("ids")))
    named = stored(named, "item-windows")
    return named.select("window", "group"), stored(named.groupBy("group").agg(F.first("ids").alias("ids")), "item-groups")


def spanned(start: Column, length: Column) -> Column:
    """A window packed in one long: the functions for distinct values compare structs pair by pair, longs by hash."""
    return F.shiftleft(start.cast("long"), 5).bitwiseOR(length.cast("long"))


def start_of(span: Column) -> Column:
    return F.shiftright(span, 5).cast("int")


def length_of(span: Column) -> Column:
    return span.bitwiseAND(F.lit(31)).cast("int")


def candidates(n_words: Column, found: Column) -> Column:
    """Every window (see spanned) of a text of n_words that holds a hit fingerprint (length and place, packed alike) of its length."""
    around = lambda f: F.sequence(F.greatest(F.lit(0), start_of(f) - (SPAN - 1)), F.least(start_of(f), n_words - WINDOW))
    starts = lambda f: F.when(length_of(f) == WINDOW, around(f)).otherwise(F.array(start_of(f)))
    return F.array_distinct(F.flatten(F.transform(found, lambda f: F.transform(starts(f), lambda s: spanned(s, length_of(f))))))


def covered(spans: Column) -> Column:
    """Words in the union of spans, sorted."""
    end = lambda x: start_of(x) + length_of(x)
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), end(x) - F.greatest(start_of(x), acc["reach"]))).cast("long").alias("n"),
        F.greatest(acc["reach"], end(x)).alias("reach"),
    )
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")), step, lambda acc: acc["n"])


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans, items for each text that holds a window of an item: spans are
    its shared windows by place (see spanned), items the sorted item_ids as strings. docs: doc_id, text; benchmark: item_id, text."""
    keys = ["doc_id", "text_hash"]
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    items = stored(
        benchmark.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct(), "items"
    )
    lengths = sorted(r[0] for r in items.filter(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())
    prints = fingerprints(F.col("words"), lengths)
    marks = stored(exploded(items, [], prints).select("length", "print").distinct(), "item-fingerprints")
    hit = meet(exploded(texts, keys, prints), marks, ["length", "print"], "left_semi")
    hit = stored(hit.groupBy(*keys).agg(F.collect_set(spanned(F.col("place"), F.col("length"))).alias("found")), "fingerprint-hits")
    windows, groups = item_windows(items)
    same = texts["doc_id"].eqNullSafe(hit["doc_id"]) & (texts["text_hash"] == hit["text_hash"])
    near = texts.join(hit, same).select(hit["doc_id"], hit["text_hash"], "words", candidates(F.size("words"), F.col("found")).alias("near"))
    at = F.transform("near", lambda w: F.struct(w.alias("span"), window_at(F.col("words"), start_of(w), length_of(w)).alias("window")))
    held = meet(near.select(*keys, F.inline(at)), windows, ["window"])
    spans = held.groupBy(*keys).agg(F.sort_array(F.collect_set("span")).alias("spans"), F.collect_set("group").alias("groups"))
    ids = meet(spans.select(*keys, "spans", F.explode("groups").alias("group")), groups, ["group"])
    return ids.groupBy(*keys).agg(F.first("spans").alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs (doc_id, text); other
    columns of docs are left alone, see clean."""
    found = hits(docs, benchmark).select("doc_id", "text_hash", covered(F.col("spans")).alias("n_hit"), "items")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_hash"] == found["text_hash"]), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        rows["doc_id"], rows["text_hash"], "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all of their columns."""
    bad = judge(docs, benchmark).filter("contaminated").select("doc_id", "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")
