import re

import corpus_pipeline
from common import MIDDLE, edge_frame, empty_frame
from shotframe.llm import decontam, minhash


def test_stages(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").cache()
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, MIDDLE).cache()
        before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()}
        assert after <= before and len(after) == out.count()
        if name != "shard":
            assert out.columns == names
        seen[name] = (docs, out, before, after)
        docs = out
    docs, _, before, after = seen["language"]
    assert {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")} == after
    docs, _, before, after = seen["near_duplicates"]
    assert after == {r.doc_id for r in minhash.near_duplicates(docs, percent=80).collect() if r.kept}
    docs, _, before, after = seen["decontamination"]
    bench = spark.read.parquet(f"{MIDDLE}/benchmark.parquet")
    assert before - after == {r.doc_id for r in decontam.contaminated(docs, bench).collect() if r.contaminated}
    assert before - after
    assert seen["shard"][2] == seen["shard"][3]


def test_edge_rows_and_empty_table(spark):
    for start in (edge_frame(spark), empty_frame(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, MIDDLE)
            if name != "shard":
                assert docs.columns == start.columns
        docs.collect()


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "text", "shard", "slot"} <= set(out.columns) and out.count() > 0


def test_near_duplicates_stage_takes_a_percent(spark):
    own = [f"w{i}" for i in range(500)]
    docs = spark.createDataFrame([(1, " ".join(own)), (2, " ".join(own[:450] + [f"x{i}" for i in range(50)]))],
                                 "doc_id bigint, text string")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, MIDDLE, percent=80).collect()] == [1]
