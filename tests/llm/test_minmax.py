"""Min-max hashing: signatures, recall, lists of any size, and components against brute force."""

from collections import Counter

import numpy as np
import pyarrow as pa

import brute
from cases import ROWS, SF
from riskloom.llm import minmax, queries
from riskloom.llm.common import mix

U = np.uint64


def random_pair(rng, n, j):
    """Two sets of similarity near j."""
    common = round(n * j)
    x = mix(rng.integers(0, 1 << 62, 2 * n - common).astype(U))
    return np.unique(x[:n]), np.unique(np.concatenate([x[:common], x[n:]]))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_signature_is_least_and_greatest_hash():
    rng = np.random.default_rng(0)
    sets = [np.unique(mix(rng.integers(0, 1 << 62, n).astype(U))) for n in (1, 2, 50)]
    sig = minmax.signatures(sets)
    times, mask = minmax._constants(0)
    for s, row in zip(sets, sig, strict=True):
        for k in (0, 7, len(times) - 1):
            h = [(int(x) ^ int(mask[k])) * int(times[k]) % (1 << 64) for x in s]
            assert (min(h), max(h)) == (int(row[k]), int(row[len(times) + k]))


def test_estimate_is_unbiased_and_recall_is_high():
    rng = np.random.default_rng(1)
    for n in (40, 300):
        pairs = [random_pair(rng, n, 0.92) for _ in range(300)]  # 0.92 n common of 1.08 n: similarity 0.85
        x, y = (minmax.signatures(list(s)) for s in zip(*pairs, strict=True))
        true = np.mean([len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in pairs])
        assert abs((x == y).mean() - true) < 0.01
        assert ((x == y).mean(axis=1)).var() < true * (1 - true) / minmax.VALUES * 1.3
        met = (minmax.list_names(x) == minmax.list_names(y)).any(axis=1)
        assert met.mean() > 0.99 and ((x == y).sum(axis=1) >= minmax.FEWEST).all()


def test_threshold_is_exact():
    a = np.arange(100, dtype=U)
    assert minmax.linked(a, np.arange(85, dtype=U)) and not minmax.linked(a, np.arange(84, dtype=U))
    assert minmax.linked(a[:17], a[:20]) and not minmax.linked(a[:16], a[:20])


def test_groups_cross_batches():
    rng = np.random.default_rng(2)
    key = np.sort(rng.integers(0, 9, 60))
    for size in (1, 2, 7, 60):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + size]), pa.array(np.arange(60)[i : i + size])], names=["k", "v"]) for i in range(0, 60, size)]
        got = [t.to_pydict() for t in minmax.groups(batches, 1)]
        assert [t["k"][0] for t in got] == sorted(set(key.tolist())) and sum((t["v"] for t in got), []) == list(range(60))


def grown(seed, n_groups, size, words=120, edits=6):
    """Chains of near copies: each is an edit of an earlier one of its group, so links are needed beyond centres."""
    rng = np.random.default_rng(seed)
    out = []
    for g in range(n_groups):
        group = [[f"w{g}x{i}" for i in range(words)]]
        for k in range(size - 1):
            copy = list(group[int(rng.integers(0, len(group)))])
            for i in rng.integers(0, words, int(rng.integers(0, edits))).tolist():
                copy[i] = f"v{g}x{k}x{i}"
            group.append(copy)
        out += [" ".join(w) for w in group]
    return list(enumerate(out))


def check(spark, scratch, data):
    got = minmax.link(spark.createDataFrame(data, "doc_id long, text string").repartition(5), scratch)
    assert rows(got) == Counter((d, n, c, d == c) for d, n, c in brute.components(data, 85))


def test_chains_of_near_copies(spark, scratch):
    check(spark, scratch, grown(3, 12, 25))


def test_one_large_group_in_small_tiles(spark, scratch, monkeypatch):
    monkeypatch.setattr(minmax, "TILE", 16)
    check(spark, scratch, grown(4, 1, 400))


def test_batches_of_three_rows(spark, scratch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        check(spark, scratch, grown(5, 8, 20))
    finally:
        spark.conf.set(key, before)


def test_awkward_rows(awkward, nothing, scratch):
    want = Counter((d, n, c, d is not None and d == c) for d, n, c in brute.components([(i, t) for i, t, *_ in ROWS], 85))
    assert rows(minmax.link(awkward, scratch)) == want
    assert minmax.link(nothing, scratch).count() == 0


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {tuple(r) for r in queries.QUERIES["op11_minmax_near_dedup"](spark, SF).collect()}
    assert got == {(d, n, c, d == c) for d, n, c in brute.components(docs, 85)}
