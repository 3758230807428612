"""The pipeline's stages against each other and against brute force; the optional registration."""

import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline as pipe
from strata.llm import decontam, line_dedup, simhash, toxicity


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    found = {}
    for name, stage in pipe.STAGES[:-1]:
        before, docs = docs, pipe.cut(stage(spark, docs, sf), "test")
        assert docs.columns == columns and docs.schema == before.schema
        found[name] = (before, docs)
    before, after = found["toxicity"]
    score = toxicity.scorer(before, toxicity.fit(before, spark.read.parquet(f"{sf}/labels.parquet")))(F.col("text"))
    assert {x.doc_id for x in after.collect()} == {x.doc_id for x in before.withColumn("s", score).collect() if x.s < 0.5}
    before, after = found["line_dedup"]
    want = {x.doc_id: x.text for x in line_dedup.dedup_lines(before).select("doc.*").collect()}
    assert {x.doc_id: x.text for x in after.collect()} == want and all(x.n_chars == len(x.text) for x in after.collect())
    before, after = found["simhash"]
    groups = {x.component_id for x in simhash.near_duplicates(before).collect()}
    assert {x.doc_id for x in after.collect()} == groups
    before, after = found["decontamination"]
    hit = {x.id for x in decontam.find_contamination(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if x.hits}
    assert hit and {x.doc_id for x in after.collect()} == {x.doc_id for x in before.collect()} - hit
    tokens = pipe.tokenize(spark, after, sf).collect()
    assert len(tokens) == after.count() and all(x.n_tokens == len(x.token_ids) for x in tokens)
    assert pipe.run(spark, sf).count() == len(tokens)


def test_odd_documents(spark, sf):
    docs = spark.createDataFrame(
        [(1, None, None, None, None, "t"), (1, None, None, None, None, "t"), (2, "", "en", "s", 0, "t"), (None, "a b", "en", "s", 3, "t"), (3, "x\n" * 2000, "en", "s", 9, "t")],
        "doc_id long, text string, lang string, source string, n_chars long, tid string",
    )
    for rows in (docs, docs.limit(0)):
        for _, stage in pipe.STAGES[:-1]:
            rows = pipe.cut(stage(spark, rows, sf), "odd")
            assert rows.columns == docs.columns
        pipe.tokenize(spark, rows, sf).collect()


def test_entry_without_the_package(tmp_path):
    """Without the corpus folders the entry point still offers the other queries."""
    code = (
        "import sys; sys.modules['strata.llm'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    )
    root = pipe.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
