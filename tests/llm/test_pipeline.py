"""The pipeline's stages, on small tables, against brute force."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402
from tidemart.llm.shared import saved  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(pipeline.STAGES)
    for name in ("toxicity", "exact_dedup", "near_dedup", "decontamination"):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = saved(stages[name](spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        left = {r.doc_id for r in out.collect()}
        if name == "exact_dedup":
            assert left == {i for i, r in brute.exact(rows).items() if r[2]}
        elif name == "near_dedup":
            assert left == {i for i, r in brute.near(rows, words=5).items() if r[2]}
        elif name == "decontamination":
            assert left == {i for i, r in brute.contamination(rows, bench).items() if not r[4]}
        else:
            assert len(rows) * 0.7 < len(left) < len(rows)
        docs = out
    texts = {r.doc_id: r.text for r in docs.collect()}
    final = stages["merge_dropout"](spark, docs, SF).collect()
    assert {r.doc_id for r in final} == set(texts) and all(r.lossless for r in final)
    assert all(len(r.ids) == r.n_pieces for r in final)
