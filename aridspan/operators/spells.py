"""Longest runs of days that meet a condition, in four forms that agree.

``bits`` (the default) keeps a period's days as seven 64-bit words that are combined by bitwise or: a plain
hash aggregate with a map-side combine, after which a cell's period is one row of fixed size. ``fold`` collects
the days that meet the condition and folds each sorted list; ``lag`` marks changes and sums them in one window;
``islands`` subtracts two row numbers. All group by whole keys, so a series lies in one task.

``blocks`` is for series of any length: ``day_bits`` keeps the words of each block of 448 days, a table whose rows merge by
bitwise or (``merged_bits``), so that parts of a series may come from different files, runs or batches, in any order and
more than once; a block then gives its leading, trailing and longest run, and ``spells_of`` joins those of neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Places of the circle of bits: more than a period has days, so that a run never meets its own beginning.
WORDS, WORD = 7, 64


def longest_in_bits(words: list[Column]) -> Column:
    """The longest run of ones in a circle of 64-bit words, the last one first."""
    circle = F.concat(*(F.lpad(F.bin(F.coalesce(w, F.lit(0).cast("long"))), WORD, "0") for w in reversed(words)))
    return F.array_max(F.transform(F.split(F.concat(circle, circle), "0", -1), lambda run: F.length(run)))


#: Columns of a block's words: of days that meet the condition, and of days with a value.
HITS, VALID = [f"hit_{w}" for w in range(WORDS)], [f"valid_{w}" for w in range(WORDS)]


def day_bits(rows: DataFrame, keys: Sequence[str], hit: Column, order: str = "day_ordinal", value: str = "value") -> DataFrame:
    """keys, block, and the words of HITS and VALID for each 448 places of order that hold a row; combines before its shuffle."""
    place = F.col(order).cast("long")
    within = F.pmod(place, F.lit(WORDS * WORD)).cast("int")
    word, one = F.shiftright(within, 6), F.call_function("shiftleft", F.lit(1).cast("long"), within.bitwiseAND(F.lit(WORD - 1)))
    bits = lambda when, w: F.coalesce(F.bit_or(F.when(when & (word == w), one)), F.lit(0).cast("long"))
    kept = rows.withColumn("block", F.floor(place / (WORDS * WORD)).cast("long"))
    kinds = [(HITS, F.coalesce(hit, F.lit(False))), (VALID, F.col(value).isNotNull())]
    return kept.groupBy(*keys, "block").agg(*(bits(when, w).alias(names[w]) for names, when in kinds for w in range(WORDS)))


def merged_bits(bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each keys and block of day_bits rows from any number of parts; parts that repeat change nothing."""
    return bits.groupBy(*keys, "block").agg(*(F.bit_or(c).alias(c) for c in (*HITS, *VALID)))


def spells_of(bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, longest (run), n_hits, n_valid of the blocks of day_bits. Blocks hold 448 places, so a task holds a row of five
    numbers for each of them."""
    line = F.concat(*(F.lpad(F.bin(c), WORD, "0") for c in reversed(HITS)))  # the last place first
    runs = F.transform(F.split(line, "0", -1), lambda run: F.length(run))
    counted = lambda names: sum((F.bit_count(c).cast("long") for c in names), F.lit(0).cast("long"))
    one = bits.select(*keys, "block", runs.alias("runs"), counted(HITS).alias("n_hits"), counted(VALID).alias("n_valid"))
    part = F.struct("block", F.element_at("runs", -1).cast("long").alias("head"), F.element_at("runs", 1).cast("long").alias("tail"), F.array_max("runs").cast("long").alias("best"))
    grouped = one.groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum("n_hits").alias("n_hits"), F.sum("n_valid").alias("n_valid"))
    return grouped.select(*keys, F.aggregate("parts", F.struct(*(F.lit(None if c == "block" else 0).cast("long").alias(c) for c in ("block", "tail", "best"))), joined, lambda acc: acc["best"]).alias("longest"), "n_hits", "n_valid")


def joined(acc: Column, part: Column) -> Column:
    """What is known after a block: its number, the run that is open at its end, the longest run so far. A full block carries on
    the open run of the block right before it; a block that is not there ends it."""
    carried = F.when(part["block"] == acc["block"] + 1, acc["tail"]).otherwise(F.lit(0).cast("long"))
    full = part["best"] == WORDS * WORD
    return F.struct(
        part["block"].alias("block"), (part["tail"] + F.when(full, carried).otherwise(0)).cast("long").alias("tail"),
        F.greatest(acc["best"], part["best"], carried + part["head"]).alias("best"),
    )


def longest(days: Column) -> Column:
    """The longest run of successive integers in a list."""
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, day: Column) -> Column:
        run = F.when(day == acc["last"], acc["run"]).when(day == acc["last"] + 1, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(day.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.array_sort(days), start, step, lambda acc: acc["best"])


def longest_run(rows: DataFrame, keys: Sequence[str], hit: Column, order: str = "day_ordinal", value: str = "value", form: str = "bits") -> DataFrame:
    """keys, run (int: 0 without a hit), n_valid (values that are not null). A null condition is no hit and ends a run.
    For ``bits`` the days of one group span fewer than 448 places of order; which places does not matter."""
    hit = F.coalesce(hit, F.lit(False))
    if form == "bits":
        place = F.pmod(F.col(order).cast("int"), F.lit(WORDS * WORD))
        word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(WORD - 1))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        grouped = rows.groupBy(*keys).agg(
            *(F.bit_or(F.when(hit & (word == w), one)).alias(f"_{w}") for w in range(WORDS)), F.count(value).alias("n_valid")
        )
        return grouped.select(*keys, longest_in_bits([F.col(f"_{w}") for w in range(WORDS)]).alias("run"), "n_valid")
    if form == "blocks":
        return spells_of(day_bits(rows, keys, hit, order, value), keys).select(*keys, F.col("longest").cast("int").alias("run"), "n_valid")
    if form == "fold":
        grouped = rows.groupBy(*keys).agg(
            F.collect_list(F.when(hit, F.col(order).cast("int"))).alias("days"), F.count(value).alias("n_valid")
        )
        return grouped.select(*keys, longest(F.col("days")).alias("run"), "n_valid")
    marked = rows.select(*keys, F.col(order).alias("_at"), F.col(value).alias("_value"), hit.alias("_hit"))
    window = Window.partitionBy(*keys).orderBy("_at")
    if form == "lag":
        new = (F.lag("_hit").over(window) != F.col("_hit")) | (F.lag("_at").over(window) + 1 != F.col("_at"))
        marked = marked.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("_island", F.sum("_new").over(window))
    elif form == "islands":
        marked = marked.withColumn("_island", F.col("_at") - F.row_number().over(Window.partitionBy(*keys, "_hit").orderBy("_at")))
    else:
        raise ValueError(f"unknown form {form!r}")
    runs = marked.groupBy(*keys, "_hit", "_island").agg(F.count("*").alias("_n"), F.count("_value").alias("_valid"))
    return runs.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("_hit"), F.col("_n"))), F.lit(0)).cast("int").alias("run"), F.sum("_valid").alias("n_valid")
    )
