"""The last round of the joins: parities of counts, tiles and components."""

import numpy as np
import pyarrow as pa

from riskloom.llm import near, ngram_join
from riskloom.llm.common import shingle_sets
from riskloom.llm.components import components
from riskloom.llm.count_tree import parity, parity_pairs, point


def _links(x, y):
    return 7 * len(np.intersect1d(x, y)) >= 3 * (len(x) + len(y))


def test_parities_lose_no_link():
    rng = np.random.default_rng(1)
    sets = []
    for n in (1, 4, 15, 16, 30, 33, 64, 400, 410, 1000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for _ in range(12):
            x, m = base.copy(), int(rng.integers(0, max(1, n // 5) + 1))
            x[rng.permutation(n)[:m]] = rng.integers(0, 2**63, m).astype(np.uint64)
            sets.append(np.unique(x))
    told = [parity(point(s)) for s in sets]
    assert [n for n, _ in told] == [len(s) for s in sets]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if _links(sets[i], sets[j])}
    for block in (1 << 18, 50):
        got = [(i, j) for x, y in parity_pairs(np.array([n for n, _ in told]), [b for _, b in told], block) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        assert len(got) == len(set(got)) and want <= set(got)
    apart = [parity(point(rng.integers(0, 2**63, 300).astype(np.uint64))) for _ in range(60)]
    assert not [x for x, _ in parity_pairs(np.array([n for n, _ in apart]), [b for _, b in apart]) if len(x)]


def _edits(n, words=60, most=4):
    rng = np.random.default_rng(4)
    out = []
    for k in range(n):
        w = [f"w{i}" for i in range(words)]
        for i in rng.integers(0, words, int(rng.integers(0, most))).tolist():
            w[i] = f"v{k}x{i}"
        out.append(" ".join(w))
    return out


def test_a_tile_tells_a_tree_and_not_its_pairs():
    texts = _edits(120)
    n = len(texts)
    sets = list(shingle_sets(pa.array(texts)))
    pairs = sum(_links(sets[i], sets[j]) for j in range(n) for i in range(j))
    zero = pa.array([0] * n, pa.int64())
    small = pa.array([0] * n, pa.int32())
    node = pa.array(range(n), pa.int64())
    tile = pa.RecordBatch.from_arrays([zero, small, small, small, small, node, node, pa.array(texts)], names=["home", "part", "i", "j", "side", "node", "root", "text"])
    told = sum(b.num_rows for b in near._joined([tile.slice(0, 50), tile.slice(50)]))
    assert pairs > 10 * n and n // 2 < told < n


def test_long_lists_meet_in_tiles(spark, scratch, monkeypatch):
    import brute

    monkeypatch.setattr(near, "TILE", 16)
    rng = np.random.default_rng(8)
    group = [[f"w{i}" for i in range(90)]]
    for k in range(120):
        copy = list(group[int(rng.integers(0, len(group)))])
        for i in rng.integers(0, 90, int(rng.integers(0, 8))).tolist():
            copy[i] = f"v{k}x{i}"
        group.append(copy)
    data = list(enumerate(" ".join(w) for w in group))
    got = ngram_join.link(spark.createDataFrame(data, "doc_id long, text string").repartition(3), scratch)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == sorted(brute.components(data))


def test_components_of_paths_stars_and_later_links(spark, scratch):
    path = [(i, i + 1) for i in range(100, 160)]
    stars = [(1000, i) for i in range(900, 930)] + [(2, i) for i in range(10, 40)]
    links = spark.createDataFrame([*path, *stars, (7, 7), (101, 100), (100, 101)], "a long, b long")
    roots = components(links, scratch)
    want = {i: 100 for i in range(100, 161)} | {i: 900 for i in [*range(900, 930), 1000]} | {i: 2 for i in [2, *range(10, 40)]}
    assert {r.node: r.root for r in roots.collect()} == want
    more = near._merged(roots, spark.createDataFrame([(150, 915), (5, 6), (160, 130)], "a long, b long"), scratch)
    later = {k: 100 if v == 900 else v for k, v in want.items()} | {5: 5, 6: 5}
    assert sorted((r.node, r.root) for r in more.collect()) == sorted(later.items())
    assert components(links.limit(0), scratch).isEmpty()
