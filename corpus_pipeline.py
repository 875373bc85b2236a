"""A corpus from documents to packed sequences, one operator after another.

Each stage gets what the one before has kept, written as Parquet and read again, and its decisions take
effect: documents of no known language go, one document of each group of near-duplicates stays, documents
contaminated by the benchmark go, personal data give way to their kind in brackets, and what is left is
packed. All stages but the last return the columns of ``documents``.

Defined cases are those of the operators; besides, a row without doc_id is no near-duplicate, and an empty
table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm import decontamination, language_id, near_duplicates, packing, private_data
from aridspan.llm.common import prepared, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence."""
    return language_id.keep_known(docs, language_id.fit_languages(docs))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group."""
    gone = near_duplicates.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share too little with the benchmark to count as contaminated."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and n_chars counted anew."""
    found = private_data.find_private(docs)
    spans = F.concat("base", "extra")
    text = private_data.redacted(F.col("row.text"), spans)
    n_chars = F.when(F.size(spans) > 0, F.char_length(text).cast("long")).otherwise(F.col("row.n_chars"))
    changed = {"text": text, "n_chars": n_chars}
    return found.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece's place in the packed sequences."""
    return packing.placed(docs)


STAGES = [
    ("language id", lambda spark, docs, sf_dir: language(prepared(spark), docs, sf_dir)),
    ("near-duplicates", lambda spark, docs, sf_dir: near_duplicate(prepared(spark), docs, sf_dir)),
    ("decontamination", lambda spark, docs, sf_dir: decontaminate(prepared(spark), docs, sf_dir)),
    ("personal data", lambda spark, docs, sf_dir: redact(prepared(spark), docs, sf_dir)),
    ("packing", lambda spark, docs, sf_dir: pack(prepared(spark), docs, sf_dir)),
]

#: Trained and iterative stages have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i + 1}")
    return docs
