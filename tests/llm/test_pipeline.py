"""The pipeline as a whole and stage by stage on awkward rows."""

import re

import brute
import corpus_pipeline
from cases import ROWS, SF


def test_run_on_the_smallest_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    lettered = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    groups = {}
    for i, t in lettered:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i, t))
    unique = [min(g)[1:] for g in groups.values()]
    leaders = {i for i, _, c in brute.components(unique) if c == i}
    ids = set(got.doc_id)
    assert ids == leaders


def test_stages_on_awkward_and_empty_rows(spark, awkward, nothing):
    for frame in (awkward, nothing):
        docs = frame
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == frame.columns
        assert docs.count() > 0 if frame is awkward else docs.count() == 0
    assert len(ROWS) == awkward.count()
