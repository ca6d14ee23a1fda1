"""What components and the pipeline leave in the checkpoint folder."""

import os

import corpus_pipeline
from eventlens.llm.components import components
from eventlens.session import scratch_run

SF = "/root/testdata/sf0.001"


def _tables(path):
    return sorted(d.rpartition("-")[0] for p, dirs, _ in os.walk(path) for d in dirs if os.path.exists(f"{p}/{d}/_SUCCESS"))


def test_components_keep_their_last_table(spark):
    with scratch_run(spark) as path:
        chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
        found = components(chain, "chain")
        assert _tables(path) == ["chain"]
        assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(301)}


def test_pipeline_keeps_the_table_its_result_reads(spark):
    with scratch_run(spark) as path:
        out = corpus_pipeline.run(spark, SF)
        assert _tables(path) == ["pipeline-personal_data"]
        assert out.count() > 0
    assert not os.path.exists(path)
