"""R-tree over count vectors, and bounds on the overlap of the sets behind them.

The elements of a set are hashed into groups; the counts by group are a point. Two sets share at most
the sum over groups of the smaller count, and a box of points at most the sum of its upper corner's.
Large sets have more groups, two to four for an element, since the bound weakens with full groups; a
group is a range of the top bits of the hash, so a point folds into one of fewer groups by adding.
"""

from __future__ import annotations

import numpy as np

#: Bits of the group number: least and most.
FEWEST, MOST = 5, 16
LEAF, FAN = 16, 8
#: Two sets link when 100 x intersection >= 75 x union, that is 7 x intersection >= 3 x sum of sizes.
OVER, UNDER = 7, 3


def point(elements: np.ndarray) -> bytes:
    """The point of distinct 64-bit hashes: a byte with the bits of its groups, then the counts in one
    byte each, or four where one is too little."""
    bits = min(MOST, max(FEWEST, (2 * len(elements)).bit_length()))
    counts = np.bincount((elements >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return bytes([bits]) + counts.astype("u1" if counts.max() < 256 else "<u4").tobytes()


def points(elements: np.ndarray, of: np.ndarray, n: int) -> list[bytes]:
    """The points of ``n`` sets that are not empty, ``of`` being the set of each element; one set's elements may repeat."""
    order = np.argsort(elements)
    same = elements[order[1:]] == elements[order[:-1]]
    again = order[np.append(same, False) | np.append(False, same)] if len(order) else order
    if len(again):  # elements that are there more than once, in one set or in several
        again = again[np.lexsort((of[again], elements[again]))]
        repeats = again[1:][(elements[again[1:]] == elements[again[:-1]]) & (of[again[1:]] == of[again[:-1]])]
        once = np.ones(len(of), bool)
        once[repeats] = False
        elements, of = elements[once], of[once]
    bits = np.clip(np.frexp(2 * np.bincount(of, minlength=n))[1], FEWEST, MOST)
    width = 1 << bits.astype(np.int64)
    begin = np.cumsum(width) - width
    counts = np.bincount(begin[of] + (elements >> (64 - bits[of]).astype(np.uint64)).astype(np.int64), minlength=int(width.sum()))
    return _blobs(bits.tolist(), counts, begin, width)


def _blobs(bits: list[int], counts: np.ndarray, begin: np.ndarray, width: np.ndarray) -> list[bytes]:
    if not len(begin):
        return []
    small, wide = counts.astype("u1").tobytes(), np.maximum.reduceat(counts, begin) > 255
    out = [bytes([k]) + small[a : a + w] for k, a, w in zip(bits, begin.tolist(), width.tolist(), strict=True)]
    for i in np.flatnonzero(wide).tolist():
        out[i] = bytes([bits[i]]) + counts[begin[i] : begin[i] + width[i]].astype("<u4").tobytes()
    return out


def stacked(blobs: list[bytes]):
    """(which, bits, counts) of points of equal form, matrices of about a million counts."""
    form = np.array([(b[0], len(b) > (1 << b[0]) + 1) for b in blobs], np.int64).reshape(-1, 2)
    for bits, wide in np.unique(form, axis=0).tolist():
        alike = np.flatnonzero((form[:, 0] == bits) & (form[:, 1] == wide))
        step = max(1, (1 << 20) >> bits)
        for k in range(0, len(alike), step):
            part = alike[k : k + step]
            rows = np.frombuffer(b"".join([blobs[i] for i in part.tolist()]), np.uint8).reshape(len(part), -1)[:, 1:]
            yield part, bits, np.ascontiguousarray(rows).view("<u4") if wide else rows


def _joined_groups(counts: np.ndarray, bits: int) -> np.ndarray:
    return counts.reshape(len(counts), 1 << bits, -1).sum(axis=2, dtype=np.int64)


def folded(blobs: list[bytes], fewer: int = 2) -> list[bytes]:
    """Points with their groups joined four by four, for a first look at many pairs."""
    out = [b""] * len(blobs)
    for part, own, counts in stacked(blobs):
        bits = max(FEWEST, own - fewer)
        width = np.full(len(part), 1 << bits)
        for i, b in zip(part.tolist(), _blobs([bits] * len(part), _joined_groups(counts, bits).ravel(), np.cumsum(width) - width, width), strict=True):
            out[i] = b
    return out


def parities(blobs: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The sizes of sets, and for each a bit for every two groups of its point: whether their count is odd."""
    size, out = np.zeros(len(blobs), np.int64), [b""] * len(blobs)
    for part, own, counts in stacked(blobs):
        joined = _joined_groups(counts, max(FEWEST, own - 1))
        size[part] = joined.sum(axis=1)
        for i, bits in zip(part.tolist(), np.packbits((joined & 1).astype(np.uint8), axis=1), strict=True):
            out[i] = bits.tobytes()
    return size, out


def parity(blob: bytes) -> tuple[int, bytes]:
    """Those of one point."""
    size, out = parities([blob])
    return int(size[0]), out[0]


def parity_pairs(size: np.ndarray, parities: list[bytes], block: int = 1 << 18):
    """Arrays (x, y), x < y, of sets that may link: bits that differ are elements that only one of the two has,
    and sets that link have at most a seventh of their elements so, counted with copies."""
    width = np.array([len(b) for b in parities], np.int64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero((width == w) | (width == 2 * w))  # sizes that differ by more do not link
        wide = width[rows] > w
        bits = np.empty((len(rows), w), np.uint8)
        bits[~wide] = np.frombuffer(b"".join(parities[k] for k in rows[~wide].tolist()), np.uint8).reshape(-1, w)
        if wide.any():  # neighbouring groups are joined
            double = np.unpackbits(np.frombuffer(b"".join(parities[k] for k in rows[wide].tolist()), np.uint8)).reshape(-1, 2)
            bits[wide] = np.packbits(double[:, 0] ^ double[:, 1]).reshape(-1, w)
        words = bits.view(np.uint32 if w % 8 else np.uint64)
        n = size[rows]
        step = max(1, block // (len(rows) * words.shape[1]))
        for s in range(0, len(rows) - 1, step):
            e = min(s + step, len(rows))
            apart = np.bitwise_count(words[s:e, None, :] ^ words[None, s:, :]).sum(axis=2, dtype=np.int64)
            both = n[s:e, None] + n[None, s:]
            ok = (OVER * np.maximum(apart, np.abs(n[s:e, None] - n[None, s:])) <= both) & ~(wide[s:e, None] & wide[None, s:])
            x, y = np.nonzero(ok)
            inside = x < y
            if inside.any():
                yield rows[x[inside] + s], rows[y[inside] + s]


class Points:
    """Points as read from their bytes."""

    def __init__(self, blobs: list[bytes]):
        self.blobs = blobs
        self.bits = np.array([b[0] for b in blobs], np.int64)

    def rows(self, which: np.ndarray, bits: int) -> np.ndarray:
        """A matrix of some points, each folded to the same groups."""
        out = np.empty((len(which), 1 << bits), np.int32)
        for part, own, counts in stacked([self.blobs[i] for i in which.tolist()]):
            out[part] = _joined_groups(counts, bits) if own > bits else counts
        return out

    def may_link(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of pairs of points: whether the bound allows a link."""
        bits = np.minimum(self.bits[left], self.bits[right])
        out = np.zeros(len(left), bool)
        for level in np.unique(bits):
            at = np.flatnonzero(bits == level)
            step = max(1, (1 << 20) >> int(level))  # rows of about four megabytes at a time
            for k in range(0, len(at), step):
                part = at[k : k + step]
                out[part] = may_link(self.rows(left[part], int(level)), self.rows(right[part], int(level)))
        return out


def may_link(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of points in rows: whether the bound allows a link."""
    return OVER * np.minimum(a, b).sum(axis=-1, dtype=np.int64) >= UNDER * (a.sum(axis=-1, dtype=np.int64) + b.sum(axis=-1, dtype=np.int64))


class CountTree:
    """Boxes of points, filled by sorting on size and then on the widest coordinate of each slab."""

    def __init__(self, at: np.ndarray, kinds: np.ndarray):
        """``kinds``: pairs of one kind are of no interest; a box of one kind is not joined with another of it."""
        size = at.sum(axis=1)
        order = np.argsort(size, kind="stable")
        slab = LEAF * FAN
        parts = []
        for i in range(0, len(order), slab):
            part = order[i : i + slab]
            parts.append(part[np.argsort(at[part][:, np.argmax(at[part].var(axis=0))], kind="stable")])
        self.order = np.concatenate(parts)
        self.at, self.kinds = at[self.order], kinds[self.order]
        self.levels = [self._boxes(self.at, size[self.order], self.kinds, self.kinds, LEAF)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._boxes(*self.levels[-1], FAN))

    @staticmethod
    def _boxes(corner, least, low, high, fan):
        starts = np.arange(0, len(least), fan)
        return np.maximum.reduceat(corner, starts), np.minimum.reduceat(least, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)

    def pairs(self):
        """Arrays (i, j) of points of different kinds that the bound lets through, block by block."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            if level < 0:
                a = np.arange(i * LEAF, min(len(self.at), (i + 1) * LEAF))
                b = np.arange(j * LEAF, min(len(self.at), (j + 1) * LEAF))
                ok = may_link(self.at[a][:, None, :], self.at[b][None, :, :]) & (self.kinds[a][:, None] != self.kinds[b][None, :])
                if i == j:
                    ok &= a[:, None] < b[None, :]
                x, y = np.nonzero(ok)
                if len(x):
                    yield self.order[a[x]], self.order[b[y]]
                continue
            corner, least, low, high = self.levels[level]
            if low[i] == high[i] == low[j] == high[j]:
                continue
            if OVER * int(np.minimum(corner[i], corner[j]).sum()) < UNDER * int(least[i] + least[j]):
                continue
            if level == 0:
                stack.append((-1, i, j))
                continue
            n = len(self.levels[level - 1][1])
            for x in range(i * FAN, min(n, (i + 1) * FAN)):
                for y in range(max(x, j * FAN) if i == j else j * FAN, min(n, (j + 1) * FAN)):
                    stack.append((level - 1, x, y))
