"""License scans: fuzzy search for short notices. A notice with at most k errors, split into k + 1
pieces, has at least one piece intact (pigeonhole), so an exact search for the pieces finds every
candidate place; the regex library's bounded-error matching then verifies the edits around it and
reports the span.

One pass in Arrow batches without a shuffle. Searches run on a normal form of the text: A-Z
lower-cased, runs of other ASCII characters than letters and digits one space.

Defined cases: a null text counts as empty (0 words, no labels, score 0); repeated rows are each
searched alone; an empty table gives an empty result; texts of any length are searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import ALNUM_TABLE, blocks, table, texts

#: Phrases that are found exactly, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices that are found with errors: label, words, most errors.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0", 3),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 4),
    ("mit", "released under the mit license", 2),
    ("bsd", "redistribution and use in source and binary forms", 3),
    ("gpl", "gnu general public license", 2),
    ("lgpl", "gnu lesser general public license", 2),
    ("mpl-2.0", "subject to the terms of the mozilla public license", 3),
    ("cc-by", "licensed under cc by", 2),
    ("cc-by", "creative commons attribution", 2),
    ("cc0", "creative commons zero", 1),
    ("public-domain", "released into the public domain", 2),
    ("reserved", "all rights reserved", 2),
    ("unlicense", "this is free and unencumbered software", 3),
)

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label: string, first_word: long, last_word: long, errors: int>>"
)


def pieces(words: str, errors: int) -> list[tuple[int, bytes]]:
    """The notice cut into errors + 1 pieces of about equal length: (place in the notice, piece)."""
    text, k = words.encode(), errors + 1
    at = [len(text) * i // k for i in range(k + 1)]
    return [(a, text[a:b]) for a, b in zip(at, at[1:])]


@cache
def searches(notices: tuple = NOTICES) -> list[tuple]:
    """For each notice: label, its length, most errors, pieces, compiled pattern."""
    return [
        (label, len(words), k, pieces(words, k), regex.compile(rb"(?b)(?:" + regex.escape(words.encode()) + rb"){e<=" + str(k).encode() + b"}"))
        for label, words, k in notices
    ]


def places(norm: bytes, phrase: bytes) -> list[int]:
    """Where the phrase stands as whole words; norm begins and ends with a space."""
    out, at = [], norm.find(phrase)
    while at >= 0:
        out.append(at)
        at = norm.find(phrase, at + 1)
    return out


def fuzzy(norm: bytes, notices: tuple = NOTICES) -> list[tuple[str, int, int, int, float]]:
    """(label, start, end, errors, similarity) of each verified place, in bytes of norm."""
    found = []
    for label, length, k, seeds, pattern in searches(notices):
        areas = sorted(
            (max(0, p - at - 2 * k), min(len(norm), p - at + length + 2 * k))
            for at, seed in seeds
            for p in places(norm, seed)
        )
        joined: list[list[int]] = []
        for a, b in areas:
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        for a, b in joined:
            for m in pattern.finditer(norm, a, b):
                s, e = m.span()
                errors = sum(m.fuzzy_counts)
                found.append((label, s, e, errors, 1 - errors / length))
    return found


def scan(text: bytes | None, notices: tuple = NOTICES) -> tuple:
    """The columns of SCHEMA after doc_id, for one text."""
    words = (text or b"").translate(ALNUM_TABLE).split()
    norm = b" " + b" ".join(words) + b" "
    starts, labels = [], set()
    for phrase, label in BASE.items():
        if hits := places(norm, b" " + phrase.encode() + b" "):
            starts += hits
            labels.add(label)
    near = fuzzy(norm, notices)
    spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32) if starts or near else np.zeros(0, np.int64)
    word = lambda at: int(np.searchsorted(spaces, at, side="right")) - 1  # noqa: E731  the word that holds, or begins after, this byte
    every = labels | {x[0] for x in near}
    score = 1.0 if labels else max((x[4] for x in near), default=0.0)
    spans = [{"label": x[0], "first_word": max(0, word(x[1])), "last_word": max(0, word(x[2] - 1)), "errors": x[3]} for x in near]
    first, last = (word(min(starts)), word(max(starts))) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(labels)), ",".join(sorted(every)), score, spans


def scan_licenses(docs: DataFrame, notices: tuple = NOTICES) -> DataFrame:
    """Returns SCHEMA, one row for each row of docs (doc_id, text): the exact phrases of BASE, and labels and
    word spans of notices within their number of errors. score: 1 for an exact phrase, else the best similarity."""

    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            columns = zip(*(scan(t, notices) for t in texts(block)))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and the number of fuzzy spans."""
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("*", F.size("spans").cast("long").alias("n_spans")).drop("spans")
