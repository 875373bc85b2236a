"""Registered text queries against their SQL, and the pipeline against its parts."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aridspan.llm import registry
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"{SF_DIR} is not there")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.queries())
    assert numbers == list(range(1, 14)) and set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF_DIR)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want.project(", ".join(columns)).fetchall(), key=repr)


def test_pipeline(spark, duck):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    now = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_DIR).cache()
        assert now.columns == docs.columns and now.dtypes == docs.dtypes, name
        kept.append({r.doc_id: r.text for r in now.collect()})
    language, near, clean, red = kept
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert len(language) >= 0.98 * len(whole)
    groups = brute.near(sorted(language.items()))
    assert set(near) == {d for d, (_, c) in groups.items() if d == c}
    items = duck.sql("SELECT item_id, text FROM benchmark").fetchall()
    judged = brute.contaminated(sorted(near.items()), items)
    assert set(clean) == {d for d in near if not judged[d][4]} and clean.items() <= near.items()
    assert set(red) == set(clean)
    for d, text in clean.items():
        spans = brute.private(text)
        assert (red[d] == text) == (not spans)
        assert not brute.private(red[d])
    assert now.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    placed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in placed.collect()} == set(red)


def test_pipeline_on_odd_rows(spark, tmp_path, duck):
    for name in ("documents", "benchmark"):
        duck.sql(f"SELECT * FROM {name} LIMIT 0").write_parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    rows = [(1, None, None, None, None), (None, "Some words that nobody else has written down here.", "en", "s", 3), (2, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for clash in ("row", "base", "extra", "n_words", "text_hash", "kept", "component_id", "contaminated", "lang_pred"):
        docs = docs.withColumn(clash, F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.filter("kept = 'clash' AND base = 'clash'").count() == 3, name
    assert corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 3
