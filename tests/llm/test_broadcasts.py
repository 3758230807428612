"""Joins whose sides Spark sizes too low are not broadcast through the driver."""

import pytest

import corpus_pipeline
from strata.llm import simhash


@pytest.mark.parametrize("segments", [2, 3])
def test_simhash_exploded_sides_are_not_broadcast(spark, monkeypatch, segments):
    plans, found = [], simhash.components

    def seen(edges, name):
        edges.collect()
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return found(edges, name)

    monkeypatch.setattr(simhash, "components", seen)
    fps = [(i, (i * 0x9E3779B97F4A7C15 % 2**63) ^ (i % 3)) for i in range(300)]
    simhash.link(spark.createDataFrame(fps, "id long, fp long"), 4, segments)
    assert len(plans) == 3
    for plan in plans:
        final = plan.split("Initial Plan")[0]
        assert "isFinalPlan=true" in plan and "Broadcast" not in final, final


def test_pipeline_drops_near_duplicates_without_exploded_broadcasts(spark, monkeypatch):
    plans, found = [], simhash.components

    def seen(edges, name):
        edges.collect()
        plans.append(edges._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return found(edges, name)

    monkeypatch.setattr(simhash, "components", seen)
    words = "one two three four five six seven eight".split()
    texts = [" ".join(words[(i * j) % 8] + str(i % 40) for j in range(20)) for i in range(80)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert len(plans) == 3 and not any("Broadcast" in p for p in plans), plans
    assert kept.columns == docs.columns and 0 < kept.count() <= 40
