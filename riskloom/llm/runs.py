"""Periodic runs in the words of a text, by a sparse diagonal recurrence over earlier occurrences.

A word that repeats an earlier one q words back lies on the diagonal of lag q; its match length there is one
more than that of the word before it. A diagonal that ends with max(6 - q, 3 q) matches or more gives a run of
period q, which begins q words before its first match. Only diagonals that can become a run are opened:

- lags below ``SHORT`` compare whole arrays, so each diagonal is looked at once;
- a longer lag q, with L the power of two that q is not below, needs 3 q >= L matches in a row, so the L words
  that end at some word of the run also end q words earlier. Unless these L words have a period of L / 2 or
  less, they occur at most three times within 2 L words; and a stretch of length 4 q whose L-word windows all
  had such a period would have it as a whole, so q would not be its smallest. The three nearest earlier
  occurrences of every window of L words therefore open every diagonal that a run lies on.

An opened diagonal is followed by comparing the words themselves, and given out when it ends. Texts are taken
in slices of a bounded number of bytes (or one text); the work is in proportion to words times the logarithm
of the longest text, however often words repeat.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskloom.llm.common import BASE, U, mix

#: Lags below this compare whole arrays; a power of two.
SHORT = 16
#: Nearest earlier occurrences of a window that open diagonals (see above for why three are enough).
NEAREST = 3
#: A run has at least LEAST words and LEAST_TIMES periods.
LEAST, LEAST_TIMES = 6, 4
#: Bytes of text in a slice.
SLICE_BYTES = 1 << 23
NO_RUNS = hashlib.sha256(b"").hexdigest()
OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("n_words", pa.int64()), ("n_kept", pa.int64())]
)


def needed(q: int) -> int:
    """Matches in a row that a run of period q has."""
    return max(LEAST - q, (LEAST_TIMES - 1) * q)


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers."""
    cut = np.flatnonzero(at[1:] != at[:-1] + 1)
    return at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]


def _same_ahead(w: np.ndarray, i: int, q: int, end: int) -> int:
    """How many words from i on equal the words q before them."""
    n, step = 0, 64
    while i + n < end:
        m = min(step, end - i - n)
        differ = np.flatnonzero(w[i + n : i + n + m] != w[i + n - q : i + n + m - q])
        if len(differ):
            return n + int(differ[0])
        n, step = n + m, step * 4
    return n


def _same_behind(w: np.ndarray, i: int, q: int, first: int) -> int:
    """How many words before i, down to ``first``, equal the words q before them."""
    n, step = 0, 64
    while i - n > first:
        m = min(step, i - n - first)
        differ = np.flatnonzero(w[i - n - m : i - n] != w[i - n - m - q : i - n - q])
        if len(differ):
            return n + m - 1 - int(differ[-1])
        n, step = n + m, step * 4
    return n


def find_runs(words: np.ndarray, first: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of all runs, sorted. ``words`` are numbers, none shared by two texts; ``first``
    is the place of each word's text's first word; ``longest`` the words of the longest text."""
    n = len(words)
    found: list[np.ndarray] = []
    for q in range(1, min(SHORT, longest // LEAST_TIMES + 1, n)):
        at = np.flatnonzero(words[q:] == words[:-q]) + q
        if len(at):
            a, b = _stretches(at)
            keep = b - a + 1 >= needed(q)
            found.append(np.stack([a[keep] - q, b[keep] + 1, np.full(int(keep.sum()), q)], axis=1))
    if longest >= LEAST_TIMES * SHORT:
        found.extend(_long_lags(words, first, longest))
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # a stretch of period q has the periods 2 q, 3 q ... too; the smallest counts
    same = np.append(False, (runs[1:, :2] == runs[:-1, :2]).all(axis=1)) if len(runs) else np.zeros(0, bool)
    return runs[~same]


def _long_lags(words: np.ndarray, first: np.ndarray, longest: int):
    n = len(words)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.append(U(1), np.full(n, BASE, U)))
        inverse = np.multiply.accumulate(np.append(U(1), np.full(n, U(pow(int(BASE), -1, 1 << 64)), U)))
        sums = np.append(U(0), np.cumsum(mix(words.astype(U) + U(1)) * power[:n], dtype=U))
    place = np.arange(n)
    length = SHORT
    ends = place[place - first >= length - 1]  # last words of windows
    while len(ends) and LEAST_TIMES * length <= longest:
        with np.errstate(over="ignore"):
            window = (sums[ends + 1] - sums[ends + 1 - length]) * inverse[ends + 1 - length]
        order = np.argsort(window, kind="stable")  # by window, then place
        window, at = window[order], ends[order]
        again = np.append(False, window[1:] == window[:-1])
        yield from _opened(words, first, at, window, length)
        # a window twice as long occurs twice only where this one does; its ends are among these
        ends = np.sort(at[again | np.append(again[1:], False)])
        length *= 2
        ends = ends[ends - first[ends] >= length - 1]


def _opened(words, first, at, window, length):
    lags, places = [], []
    for t in range(1, NEAREST + 1):
        lag = at[t:] - at[:-t]
        ok = (window[t:] == window[:-t]) & (lag >= length) & (lag < 2 * length)
        lags.append(lag[ok])
        places.append(at[t:][ok])
    lag, place = np.concatenate(lags), np.concatenate(places)
    if not len(lag):
        return
    order = np.lexsort((place, lag))
    lag, place = lag[order], place[order]
    opens = np.append(True, (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1))
    n = len(words)
    had, done = 0, 0
    out = []
    for q, i in zip(lag[opens].tolist(), place[opens].tolist(), strict=True):
        if q == had and i < done:  # on the diagonal stretch that was followed last
            continue
        if words[i] != words[i - q]:  # two windows of one hash
            continue
        a = i - _same_behind(words, i, q, int(first[i]) + q)
        b = i + _same_ahead(words, i, q, n)
        had, done = q, b
        if b - a >= needed(q):
            out.append((a - q, b, q))
    if out:
        yield np.array(out, np.int64)


def repeated_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word each word of a text is when the text is one of those that get a periodic tail."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.append(np.arange(a), a + np.arange(n - a) % p)


def _slices(batches):
    for b in batches:
        ids, text = b.column(0), pc.fill_null(b.column(1).cast(pa.large_string()), "")
        size = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < len(size):
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + SLICE_BYTES, side="right")))
            yield ids.slice(i, j - i), text.slice(i, j - i)
            i = j


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and the n + 1 borders of the texts."""
    parts = pc.ascii_split_whitespace(text)  # cuts at blanks and the characters 9 to 13
    flat, of = parts.flatten(), pc.list_parent_indices(parts).to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    of = of[real.to_numpy(zero_copy_only=False)]
    return flat.filter(real), np.searchsorted(of, np.arange(len(text) + 1))


def _report(tail: bool):
    def run(batches):
        for ids, text in _slices(batches):
            word, edge = _words(text)
            count = np.diff(edge)
            source = np.arange(len(word))
            docs = ids.to_pylist()
            if tail:
                for k, doc in enumerate(docs):
                    order = repeated_order(doc, int(count[k]))
                    if order is not None:
                        source[edge[k] : edge[k + 1]] = edge[k] + order
            of = np.repeat(np.arange(len(docs)), count)
            codes = word.dictionary_encode()
            numbers = (codes.indices.to_numpy().astype(np.int64)[source] if len(word) else source) + of * max(1, len(codes.dictionary))
            runs = find_runs(numbers, edge[:-1][of], int(count.max(initial=0)))
            # words inside a run after its first period go: +1 and -1 at the ends of those stretches
            depth = np.zeros(len(word) + 1, np.int64)
            np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
            np.add.at(depth, runs[:, 1], -1)
            kept = np.cumsum(depth[:-1]) == 0
            kept_edge = np.append(0, np.cumsum(kept))[edge]
            kept_words = word.take(pa.array(source[kept]))
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(kept_edge, pa.int64()), kept_words), pa.scalar(" ", pa.large_string()))
            run_edge = np.searchsorted(runs[:, 0], edge)
            rows = []
            for k, (doc, plain) in enumerate(zip(docs, joined, strict=True)):
                mine = runs[run_edge[k] : run_edge[k + 1]] if count[k] else runs[:0]
                best, listed = (None, None, None, None), NO_RUNS
                if len(mine):
                    each = [(int(s - edge[k]), int(e - s), int(q)) for s, e, q in mine]
                    each.sort(key=lambda r: (r[0], r[2]))
                    s, m, q = min(each, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
                    best = (s, m, q, 1000 * m // q)
                    listed = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in each).encode()).hexdigest()
                rows.append((doc, len(mine), *best, listed, hashlib.sha256(plain.as_buffer()).hexdigest(), int(count[k]), int(kept_edge[k + 1] - kept_edge[k])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), OUT, strict=True)], schema=OUT)

    return run


DDL = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, n_words bigint, n_kept bigint"


def report(docs: DataFrame, tail: bool = False) -> DataFrame:
    """One row for every row of (doc_id, text): its runs, the run of greatest exponent and what collapsing leaves.

    ``tail`` gives one document in ten the periodic tail that the contract of the query names; a null doc_id
    gets none. A null, empty or blank text has no words, no runs and the hash of an empty text. Repeated rows
    give repeated rows; an empty table gives none. Other columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(_report(tail), DDL)


def _listed(batches):
    for ids, text in _slices(batches):
        word, edge = _words(text)
        of = np.repeat(np.arange(len(ids)), np.diff(edge))
        codes = word.dictionary_encode()
        numbers = (codes.indices.to_numpy().astype(np.int64) if len(word) else of) + of * max(1, len(codes.dictionary))
        runs = find_runs(numbers, edge[:-1][of], int(np.diff(edge).max(initial=0)))
        k = of[runs[:, 0]]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(k)), pa.array(runs[:, 0] - edge[k]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], names=["doc_id", "start", "length", "period"])


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run of every text, words counted from 0."""
    return docs.select("doc_id", "text").mapInArrow(_listed, "doc_id bigint, start bigint, length bigint, period bigint")
