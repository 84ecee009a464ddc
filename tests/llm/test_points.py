"""Points of many sets at once beside those of one set at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from riskloom.llm import common, near, substring_dedup
from riskloom.llm.count_tree import Points, folded, parities, parity, point, points, stacked


def _sets() -> list[np.ndarray]:
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)) for n in (1, 4, 5, 60, 60, 700)]
    return [*sets, sets[3], np.arange(900, dtype=np.uint64)]  # an equal set, and counts beyond a byte


def test_points_of_many_sets_are_those_of_each():
    sets = _sets()
    twice = [np.concatenate([s, s[: len(s) // 2 + 1]]) for s in sets]
    each = [point(s) for s in sets]
    assert points(np.concatenate(twice), np.repeat(np.arange(len(sets)), [len(s) for s in twice]), len(sets)) == each
    assert folded(each) == [folded([b])[0] for b in each] and folded([]) == []
    size, bits = parities(each)
    assert size.tolist() == [len(s) for s in sets] and [parity(b) for b in each] == list(zip(size.tolist(), bits, strict=True))
    rows = Points(each).rows(np.array([5, 0, 7, 3]), 5)
    assert rows.sum(axis=1).tolist() == [len(sets[k]) for k in (5, 0, 7, 3)]
    assert sorted(i for part, _, _ in stacked(each) for i in part.tolist()) == list(range(len(each)))


def test_pieces_and_rows_get_their_points_together():
    # a point a piece, a fold or a parity a row took most of these steps' time
    used = {f.__name__: f.__code__.co_names for f in (near._folded, near._parities)}
    assert "folded" in used["_folded"] and "parities" in used["_parities"] and not hasattr(substring_dedup, "point")


def test_long_columns_are_hashed_a_short_stretch_at_a_time(monkeypatch):
    seen = []
    whole = common.word_hashes
    monkeypatch.setattr(common, "word_hashes", lambda raw, off: seen.append(len(raw)) or whole(raw, off))
    texts = ["word %d " % i * 20_000 for i in range(40)]
    assert len(list(common.shingle_sets(pa.array(texts)))) == 40
    assert max(seen) <= 1 << 21
