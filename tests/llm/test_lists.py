"""Lists of nodes that cross the borders of Arrow batches."""

import brute
import numpy as np
import pyarrow as pa

from riskloom.llm import ngram_join
from riskloom.llm import near
from riskloom.llm.common import mix
from riskloom.llm.near import _centres, _whole_lists


def test_lists_stay_whole_over_batches():
    rng = np.random.default_rng(1)
    for most in (2, 5, 12):
        key = np.repeat(rng.permutation(40), rng.integers(1, most + 1, 40))
        node = np.arange(len(key))
        for rows in (1, 3, 7):
            batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + rows]), pa.array(node[i : i + rows])], names=["list", "node"]) for i in range(0, len(key), rows)]
            seen = [t.column("list").to_numpy() for t in _whole_lists(batches, ["list", "node"])]
            assert np.concatenate(seen).tolist() == key.tolist()
            assert sum(len(set(s.tolist())) for s in seen) == 40  # no list in two tables


def test_first_centres_of_all_lists(monkeypatch):
    rng = np.random.default_rng(3)
    key = np.repeat(np.arange(60), rng.integers(1, 9, 60))
    node = np.concatenate([rng.choice(50, n, replace=False) for n in np.bincount(key)])
    want = {}
    for turn in range(near.CENTRES):
        with np.errstate(over="ignore"):
            rank = mix(np.arange(50).astype(np.uint64) + np.uint64(turn)) >> np.uint64(1)
        for k in range(60):
            mine = node[key == k].tolist()
            centre = min(mine, key=lambda x: rank[x])
            for x in mine:
                if x != centre and ((x, turn) not in want or rank[centre] < rank[want[x, turn]]):
                    want[x, turn] = centre
    for rows, kept in ((1, 3), (7, 1 << 20), (1000, 10)):
        monkeypatch.setattr(near, "KEPT", kept)
        batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + rows]), pa.array(node[i : i + rows])], names=["list", "node"]) for i in range(0, len(key), rows)]
        got = {(x, t): c for b in _centres(batches) for x, t, _, c in zip(*(c.to_pylist() for c in b.columns), strict=True)}
        assert got == want
    assert list(_centres([])) == []


def test_join_with_batches_of_three_rows(spark, scratch):
    rng = np.random.default_rng(2)
    data = []
    for g in range(60):  # isolated pairs and small groups of near copies
        words = [f"w{g}x{i}" for i in range(60)]
        for _ in range(2 + g % 4):
            copy = list(words)
            copy[int(rng.integers(0, 60))] = f"v{len(data)}"
            data.append((len(data), " ".join(copy)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in data]
    root = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if 7 * len(sets[i] & sets[j]) >= 3 * (len(sets[i]) + len(sets[j])):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        got = ngram_join.link(spark.createDataFrame(data, "doc_id long, text string").repartition(2), scratch).select("doc_id", "component_id").collect()
    finally:
        spark.conf.set(key, before)
    first = {}
    for i, r in enumerate(root):
        first.setdefault(r, i)
    whole = {}
    for r in got:
        whole.setdefault(r.component_id, set()).add(r.doc_id)
    want = {}
    for i, r in enumerate(root):
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, whole.values())) == sorted(map(sorted, want.values()))


def test_one_large_group_in_several_tasks(spark, scratch, monkeypatch):
    """Chains of edits, so that many pairs lie about the threshold and links are found in the last round."""
    monkeypatch.setattr(near, "TOGETHER", 60)
    rng = np.random.default_rng(8)
    group = [[f"w{i}" for i in range(90)]]
    for k in range(220):
        copy = list(group[int(rng.integers(0, len(group)))])
        for i in rng.integers(0, 90, int(rng.integers(0, 8))).tolist():
            copy[i] = f"v{k}x{i}"
        group.append(copy)
    data = list(enumerate(" ".join(w) for w in group))
    got = ngram_join.link(spark.createDataFrame(data, "doc_id long, text string").repartition(3), scratch)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == sorted(brute.components(data))
