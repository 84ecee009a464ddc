"""Rows that the pipeline hands to Python workers at a time."""

from __future__ import annotations

import pyarrow as pa

import corpus_pipeline


def test_long_texts_come_in_small_batches(spark, tmp_path, monkeypatch):
    spark.range(0, 600, 1, 1).selectExpr("id AS doc_id", "repeat('long text ', 5000) AS text").write.parquet(f"{tmp_path}/documents.parquet")

    def peek(spark, docs, sf_dir):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "bytes"])

        return docs.mapInArrow(run, "n bigint, bytes bigint")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("peek", peek)])
    try:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert sum(r.n for r in got) == 600 and max(r.bytes for r in got) < 5 << 20
