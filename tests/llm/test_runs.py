"""Periodic runs against every lag of every word."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ROWS, SF
from riskloom.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """(start, length, period): all maximal stretches, by every lag."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s = i - q
            if j - s >= max(6, 4 * q):
                found.setdefault((s, j - s), q)  # the smallest period comes first
            i = j + 1 if j > i else i + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def plain_report(doc, text, tail):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if tail and doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(), n, n - len(gone))


def fast_runs(w):
    codes = np.unique(w, return_inverse=True)[1].astype(np.int64) if len(w) else np.zeros(0, np.int64)
    return sorted((int(s), int(e - s), int(q)) for s, e, q in runs.find_runs(codes, np.zeros(len(w), np.int64), len(w)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_random_words(w):
    assert fast_runs(w) == plain_runs(w)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 9)), max_size=6), st.integers(0, 3))
def test_powers_with_long_periods(parts, cut):
    w = [x for block, k in parts for x in (block * k)[cut:]]
    assert fast_runs(w) == plain_runs(w)


@pytest.mark.parametrize("seed", range(30))
def test_nested_periods(seed):
    """Long periods made of short ones: windows with a short period of their own inside a long lag."""
    rng = np.random.default_rng(seed)
    block = []
    while len(block) < rng.integers(17, 150):
        block += [int(rng.integers(0, 3))] * int(rng.integers(1, 60)) if rng.random() < 0.5 else rng.integers(0, 3, 5).tolist() * int(rng.integers(1, 9))
    w = rng.integers(0, 3, 20).tolist() + block * int(rng.integers(3, 7)) + block[: int(rng.integers(0, len(block)))] + rng.integers(0, 3, 9).tolist()
    assert fast_runs(w) == plain_runs(w)


@pytest.mark.parametrize("q", [17, 31, 32, 100, 127, 128, 200, 255, 300, 700])
def test_exactly_four_long_periods(q):
    rng = np.random.default_rng(q)
    w = [-1, *rng.permutation(q).tolist() * 4, -2, *rng.permutation(q).tolist() * 4][:-1]
    assert fast_runs(w) == [(1, 4 * q, q)]


def test_one_word_a_million_times():
    w = np.zeros(1_000_000, np.int64)
    assert runs.find_runs(w, np.zeros(len(w), np.int64), len(w)).tolist() == [[0, 1_000_000, 1]]


def test_short_slices(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "b"], int(rng.integers(0, 60)))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    want = [plain_report(i, t, True) for i, t in enumerate(texts)]
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(runs, "SLICE_BYTES", size)
        got = [tuple(r.values()) for b in runs._report(True)([batch]) for r in b.to_pylist()]
        assert got == want


@pytest.mark.parametrize("tail", [False, True])
def test_awkward_rows(awkward, nothing, tail):
    few = [(i, t) for i, t, *_ in ROWS if len(t or "") < 100_000]
    got = Counter(tuple(r) for r in runs.report(awkward, tail).collect() if r.n_words < 10_000)
    assert got == Counter(plain_report(i, t, tail) for i, t in few)
    assert runs.report(nothing, tail).count() == 0 and runs.runs(nothing).count() == 0
    assert runs.report(awkward, tail).count() == len(ROWS)


def test_runs_as_rows(spark):
    df = spark.createDataFrame([(1, "x " * 7), (2, "a b a b a b a b c"), (3, None), (4, "a b c")], "doc_id long, text string")
    assert sorted(tuple(r) for r in runs.runs(df).collect()) == [(1, 0, 7, 1), (2, 0, 8, 2)]


def test_query_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = [(r.doc_id, r.text) for r in docs if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t in short:
        assert got[i] == plain_report(i, t, True)
