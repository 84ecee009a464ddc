"""Repeated passages in short lines and amid other text."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import substring_dedup


def _words(rng, n):
    return ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(n)]


def _lined(rng, words):
    out = []
    while words:
        k = int(rng.integers(5, 8))
        out.append(" ".join(words[:k]))
        words = words[k:]
    return "\n".join(out)


def test_short_lines_have_pieces():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    for n in (8, 9, 15, 60, 400):
        text = _lined(rng, _words(rng, n))
        for _, p in substring_dedup.pieces_of(pa.array([text], pa.string())):
            assert (p.last - p.first + 1).sum() == n and (p.last - p.first + 1 >= 8).all()


def test_passages_in_short_lines(spark, scratch):
    rng = np.random.default_rng(4)
    data = []
    for g in range(20):
        verse = _lined(rng, _words(rng, 60))
        data += [(2 * g + k, "\n".join([" ".join(_words(rng, 30)), verse, " ".join(_words(rng, 30))])) for k in range(2)]
    got = {r.doc_id for r in substring_dedup.passages(spark.createDataFrame(data, "doc_id long, text string"), scratch).collect()}
    assert got == {i for i, _ in data}


def test_equal_words_are_found_to_their_ends(spark, scratch):
    rng = np.random.default_rng(5)
    data, want = [], {}
    for g in range(150):  # 51 words inline, with stops at 0, 10 or 20 words
        passage = _words(rng, 51)
        every = (0, 10, 20)[g % 3]
        passage = [w + "." if every and i % every == every - 1 else w for i, w in enumerate(passage)]
        for k in range(2):
            left, right = _words(rng, int(rng.integers(0, 90))), _words(rng, int(rng.integers(0, 90)))
            text = " ".join([*left, *passage, *right])
            want[len(data)] = (text.index(passage[0]), text.index(passage[-1]) + len(passage[-1]))
            data.append((len(data), text))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    runs = substring_dedup.equal_runs(docs, scratch).groupBy("doc_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_list("first_word").alias("at"), F.min("first.doc_id").alias("doc"), F.max("first.doc_id").alias("high")).collect()
    assert {r.doc_id: (r.start, r.end) for r in runs} == want
    for r in runs:
        assert len({i + k for i in r.at for k in range(substring_dedup.GRAM)}) == 51 and r.doc == r.high == r.doc_id // 2 * 2
    got = {r.doc_id: r for r in substring_dedup.passages(docs, scratch).collect()}
    assert set(got) == set(want)
    for i, (start, end) in want.items():  # a piece that is nearly equal may reach a few words into other text
        r = got[i]
        assert r.start <= start and r.end >= end and r.repeated_words == r.n_words < 51 + 16
        assert r.removed_words == (r.n_words if i % 2 else 0) and r.first_doc == i - i % 2
    assert sum((r.start, r.end) == want[i] for i, r in got.items()) > 0.9 * len(want)
