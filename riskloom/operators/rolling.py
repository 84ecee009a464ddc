"""The catalogue's trailing windows in Arrow batches of whole assets, for all rows of a batch at once.

The steps of a batch's assets stand in one line of cells, with a longest window of empty cells before each asset.
What a window needs (counts, sums, extremes, means with sums of squares and products about them) is put together from
two shorter windows, so its cost grows with the logarithm of its steps, and nothing is ever subtracted: a window
without spread has exactly none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.session import spread

#: Values beside ``ret`` that families without a factor read.
READS = {"high_low": ["mcap"], "turnover": ["mcap", "volume"], "dollar_volume": ["volume", "price"], "amihud": ["volume", "price"]}


class Cells:
    """Rows of a batch, sorted by segment (asset) and step, as cells; rows of one step share a cell."""

    def __init__(self, starts: np.ndarray, steps: np.ndarray, known: np.ndarray, longest: int):
        # a segment is an asset's rows with a step, or those without one, which are one cell
        starts = starts | np.concatenate([[True], known[1:] != known[:-1]])
        gap = np.concatenate([[0], np.minimum(np.diff(np.where(known, steps, 0)), longest)])
        self.at = np.cumsum(np.where(starts, longest, gap))
        self.n = int(self.at[-1]) + 1
        self.first = np.flatnonzero(starts | (gap != 0))
        self.cell = self.at[self.first]
        self.shared = len(self.first) < len(self.at)
        self.stepless = np.zeros(self.n, bool)
        self.stepless[self.at[~known]] = True
        self.memo: dict = {}

    def put(self, v: np.ndarray, op: np.ufunc = np.add, empty: float = 0.0) -> np.ndarray:
        """Values of rows in their cells."""
        out = np.full(self.n, empty)
        out[self.cell] = op.reduceat(v, self.first) if self.shared else v
        return out

    def window(self, name: str, length: int, leaf: Callable, join: Callable):
        """What cells ``length`` steps long hold, from two shorter windows: the older one first."""
        known = self.memo.setdefault(name, {})
        if length not in known:
            if length == 1:
                known[1] = leaf()
            else:
                a = max((x for x in known if x < length and length - x in known), default=length - length // 2)
                old, new = self.window(name, a, leaf, join), self.window(name, length - a, leaf, join)
                known[length] = join(old, new, length - a)
        return known[length]

    def fold(self, name: str, length: int, gap: int, leaf: Callable[[], np.ndarray], op: np.ufunc = np.add, empty: float = 0.0) -> np.ndarray:
        """Sum or extreme over the last ``length`` steps without the last ``gap``."""
        out = self.window(name, length - gap, leaf, lambda a, b, k: op(_later(a, k, empty), b))
        return np.where(self.stepless, self.window(name, 1, leaf, None), _later(out, gap, empty)) if gap else out


def _later(v: np.ndarray, k: int, empty: float = 0.0) -> np.ndarray:
    return np.concatenate([np.full(k, empty), v[: len(v) - k]])


class Moments:
    """Counts, means, and sums of products about the means, of some columns where all have a value."""

    def __init__(self, cells: Cells, values: dict[str, np.ndarray], valid: dict[str, np.ndarray], columns: Sequence[str], pairs: Sequence[tuple[int, int]]):
        self.cells, self.columns, self.pairs = cells, columns, pairs
        self.name = "moments " + " ".join(columns)
        self.values, self.valid = values, valid

    def leaf(self) -> list[np.ndarray]:
        c = self.cells
        whole = np.logical_and.reduce([self.valid[x] for x in self.columns])
        v = [np.where(whole, self.values[x], 0.0) for x in self.columns]
        n = c.put(whole.astype(float))
        means, sums = [c.put(x) for x in v], [np.zeros(c.n) for _ in self.pairs]
        if c.shared:
            for i, x in enumerate(v):
                low, high = c.put(np.where(whole, x, np.inf), np.minimum), c.put(np.where(whole, x, -np.inf), np.maximum)
                means[i] = np.where(low == high, low, means[i] / np.where(n > 0, n, 1.0))
            d = [np.where(whole, x - m[c.at], 0.0) for x, m in zip(v, means)]
            sums = [c.put(d[i] * d[j]) for i, j in self.pairs]
        return [n, *means, *sums]

    def join(self, a: list[np.ndarray], b: list[np.ndarray], k: int) -> list[np.ndarray]:
        a = [_later(x, k) for x in a]
        n, m = a[0] + b[0], len(self.columns)
        share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
        both = a[0] * share
        d = [y - x for x, y in zip(a[1 : m + 1], b[1 : m + 1])]
        means = [x + y * share for x, y in zip(a[1 : m + 1], d)]
        return [n, *means, *[x + y + d[i] * d[j] * both for (i, j), x, y in zip(self.pairs, a[m + 1 :], b[m + 1 :])]]

    def over(self, length: int) -> list[np.ndarray]:
        return self.cells.window(self.name, length, self.leaf, self.join)


def _fit(d, cells: Cells, values: dict, valid: dict, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Slope, intercept, correlation or residual deviation of returns on a factor."""
    n, y, x, xx, yy, yx = Moments(cells, values, valid, ["ret", d.against], [(1, 1), (0, 0), (0, 1)]).over(d.window)
    enough, slope, spread_ = n >= least, yx / xx, xx != 0
    if d.family in ("beta", "sensitivity"):
        return slope, enough & spread_
    if d.family == "alpha":
        return y - slope * x, enough & spread_
    if d.family == "correlation":
        return np.where(yy == 0, 1.0, np.sqrt(yx / xx * (yx / yy))), enough & spread_
    return np.sqrt(np.where(spread_, np.maximum(yy - yx * yx / xx, 0.0), 0.0) / (n - 2)), enough & (n > 2)


def _net(d, cells: Cells, values: dict, valid: dict, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Slope on a series beside the market and an intercept."""
    n, _, _, _, xx, mm, xm, yx, ym = Moments(cells, values, valid, ["ret", d.against, d.net], [(1, 1), (2, 2), (1, 2), (0, 1), (0, 2)]).over(d.window)
    det = xx * mm - xm * xm
    return (yx * mm - ym * xm) / det, (n >= least + 1) & (det > xx * mm * 1e-6)


def _plain(d, cells: Cells, values: dict, valid: dict, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A family without a factor."""

    def total(name: str, row: Callable[[], np.ndarray]) -> np.ndarray:
        return cells.fold(name, d.window, d.gap, lambda: cells.put(row()))

    ret, has = values["ret"], valid["ret"]
    filled = lambda c: np.where(valid[c], values[c], 0.0)
    count = lambda *cs: total("count " + " ".join(cs), lambda: np.logical_and.reduce([valid[c] for c in cs]).astype(float))
    if d.family == "momentum":
        grown = total("growth", lambda: np.log1p(np.maximum(filled("ret"), -0.999)))
        return np.exp(grown) - 1, count("ret") > 0
    if d.family == "hist_vol":
        return np.sqrt(total("ret 2", lambda: filled("ret") ** 2) / d.window), np.ones(cells.n, bool)
    if d.family == "traded":
        return count("ret") / d.window, np.ones(cells.n, bool)
    if d.family == "nonzero":
        return total("nonzero", lambda: (has & (ret != 0)).astype(float)) / d.window, np.ones(cells.n, bool)
    if d.family in ("mean_return", "skewness"):
        n = count("ret")
        mean = total("ret 1", lambda: filled("ret")) / n
        if d.family == "mean_return":
            return mean, n >= least
        var = Moments(cells, values, valid, ["ret"], [(0, 0)]).over(d.window)[2] / n
        third = total("ret 3", lambda: filled("ret") ** 3) / n - 3 * mean * (total("ret 2", lambda: filled("ret") ** 2) / n) + 2 * mean**3
        return third / var**1.5, (n >= least) & ~(var <= 1e-12)
    if d.family == "high_low":
        high = cells.fold("high", d.window, d.gap, lambda: cells.put(np.where(valid["mcap"], values["mcap"], -np.inf), np.maximum, -np.inf), np.maximum, -np.inf)
        low = cells.fold("low", d.window, d.gap, lambda: cells.put(np.where(valid["mcap"], values["mcap"], np.inf), np.fmin, np.inf), np.fmin, np.inf)
        return np.log(high / low), (count("mcap") > 0) & (low != 0) & ~(high / low <= 0)
    if d.family == "turnover":
        n, m = count("volume"), count("mcap")
        cap = total("mcap", lambda: filled("mcap")) / m
        ratio = total("volume", lambda: filled("volume")) / n / cap
        return np.log(ratio), (n > 0) & (m > 0) & (cap != 0) & ~(ratio <= 0)
    traded = valid["volume"] & valid["price"]
    if d.family == "dollar_volume":
        n = count("volume", "price")
        return total("traded value", lambda: np.where(traded, values["volume"] * values["price"], 0.0)) / n, n > 0
    value = values["volume"] * values["price"]
    ok = has & traded & (value != 0)
    n = total("count amihud", lambda: ok.astype(float))
    return total("amihud", lambda: np.where(ok, np.abs(ret) / np.where(ok, value, 1.0), 0.0)) / n, n > 0


def _batches(frames: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole keys, with whether a row begins a key; rows come sorted by key."""
    held, last = [], None

    def done(parts: Sequence[pa.RecordBatch], starts: Sequence[np.ndarray]):
        return pa.Table.from_batches(parts).combine_chunks(), np.concatenate(starts)

    for batch in frames:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(key))
        joined = col if last is None else pa.concat_arrays([last, col])
        codes = joined.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        starts = np.concatenate([[True], codes[1:] != codes[:-1]])[len(joined) - len(col) :]
        last = col.slice(len(col) - 1)
        cut = int(np.flatnonzero(starts)[-1]) if starts.any() else 0
        if cut or (starts[0] and held):
            if cut:
                held.append((batch.slice(0, cut), starts[:cut]))
            yield done(*zip(*held))
            held = []
        held.append((batch.slice(cut), starts[cut:]))
    if held:
        yield done(*zip(*held))


def build(panel: DataFrame, wanted: Sequence, key: str, step: str, least: Callable[[int], int]) -> DataFrame:
    """``descriptors.build`` for many windows; ``step`` is a whole number."""
    reads = sorted({"ret", *[c for d in wanted for c in READS.get(d.family, [])], *[c for d in wanted for c in (d.against, d.net) if c]})
    doubles = {c: c if isinstance(panel.schema[c].dataType, T.DoubleType) else f"_double_{c}" for c in reads}
    longest = max(d.window for d in wanted)
    columns, needed = panel.columns, [(d, least(d.window)) for d in wanted]

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _batches(frames, key):
            col = lambda c: table.column(c).combine_chunks() if table.column(c).num_chunks != 1 else table.column(c).chunk(0)
            steps = col("_step")
            known = steps.is_valid().to_numpy(zero_copy_only=False)
            cells = Cells(starts, steps.fill_null(0).to_numpy(zero_copy_only=False), known, longest)
            valid = {c: col(n).is_valid().to_numpy(zero_copy_only=False) for c, n in doubles.items()}
            values = {c: col(n).fill_null(0.0).to_numpy(zero_copy_only=False) for c, n in doubles.items()}
            out = [col(c) for c in columns]
            with np.errstate(all="ignore"):
                for d, n in needed:
                    v, ok = (_net if d.net else _fit if d.against else _plain)(d, cells, values, valid, n)
                    out.append(pa.array(v[cells.at], mask=~ok[cells.at]))
            yield from pa.Table.from_arrays(out, names=[*columns, *[d.name for d in wanted]]).to_batches()

    x = panel.withColumns({n: F.col(c).cast("double") for c, n in doubles.items() if n != c} | {"_step": F.col(step).cast("long")})
    schema = T.StructType([*panel.schema.fields, *[T.StructField(d.name, T.DoubleType()) for d in wanted]])
    return spread(x, [key]).sortWithinPartitions(key, "_step").mapInArrow(run, schema)
