"""What the operators of this subpackage share: tables, scratch tables, shingles of whole batches."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_dir

U = np.uint64
#: Odd multipliers of the polynomial hashes; any odd values do, results do not depend on them.
BASE, STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
#: Bytes hashed at a time; arrays of eight bytes for each of them are held.
CHUNK = 1 << 20
WORDS_PER_SHINGLE = 5
#: For every byte: whether it parts words, and one more than its lower-case form.
GAP = bytes(c in b" \t\n\v\f\r" for c in range(256))
LOWER = bytes((c + 1) & 255 for c in bytes(range(256)).lower())
#: Groups that are joined by broadcast: those with a share of 1 / MOST_HOT of all rows, and LEAST_HOT rows.
MOST_HOT, LEAST_HOT = 10_000, 32
#: Keys that a semi-join broadcasts at most.
MOST_SENT = 500_000


_HELD: dict = {}


def held(key, make):
    """This Python worker's tables of ``key``, made by ``make`` where it has none. A worker outlives stages, so it
    holds the tables of one operator at a time: those of another go first."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Drop the tables that an earlier operator left in this Python worker."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, rows: int = 512):
    """Arrow batches in pieces of a few rows, so that little of a batch is held as Python objects."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def semi(rows: DataFrame, key: str, wanted: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (or, with "left_anti", is not) among ``wanted`` (one column, distinct, a written table), null counting as a
    value. Up to ``MOST_SENT`` wanted keys are broadcast; beyond that both sides are shuffled."""
    other = wanted.columns[0]
    side = F.broadcast(wanted) if wanted.count() <= MOST_SENT else wanted
    return rows.join(side, rows[key].eqNullSafe(side[other]), how)


class Scratch:
    """Tables written under the shared folder, to be read by several later jobs and then dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return a reader of it."""
        path = f"{shared_dir(self.spark)}/llm-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete all tables of this object; no frame that reads them may be used afterwards."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for p in self.paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
        self.paths = []


# --- hashing words and shingles of whole Arrow batches --------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, U), np.multiply.accumulate(np.full(n, base, U))])


_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _TABLES:
        _TABLES.extend((_powers(int(BASE), CHUNK), _powers(pow(int(BASE), -1, 1 << 64), CHUNK)))
    return _TABLES


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its values; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(off) and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of all texts, in order, the n + 1 offsets of the texts'
    words, and the first byte and the end of each word.

    Words are runs of bytes other than blank and 9 to 13. Long inputs are hashed in chunks cut at
    white space, so memory stays bounded but for a single word longer than a chunk.
    """
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U), np.zeros(len(off), np.int64), none, none
    gap = np.frombuffer(raw.tobytes().translate(GAP), bool)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = ~gap & (edge[:-1] | np.concatenate([[True], gap[:-1]]))
    last = ~gap & (edge[1:] | np.concatenate([gap[1:], [True]]))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), U)
    power, inverse = _tables()
    k = 0
    while k < len(starts):
        base = starts[k]
        m = int(np.searchsorted(ends, base + CHUNK, side="right"))
        if m == k:  # one word beyond a chunk: fold its pieces
            h = U(0)
            for i in range(base, ends[k], CHUNK):
                part = _lower(raw[i : min(i + CHUNK, ends[k])])
                h = mix((h * STEP + (part * power[: len(part)]).sum(dtype=U)).reshape(1))[0]
            out[k] = h
            k += 1
            continue
        part = _lower(raw[base : ends[m - 1]])
        sums = np.concatenate([np.zeros(1, U), np.cumsum(part * power[: len(part)], dtype=U)])
        s, e = starts[k:m] - base, ends[k:m] - base
        out[k:m] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U) * STEP)
        k = m
    return out, np.searchsorted(starts, off), starts, ends


def _lower(part: np.ndarray) -> np.ndarray:
    return np.frombuffer(part.tobytes().translate(LOWER), np.uint8).astype(U)


def shingle_hashes(words: np.ndarray, k: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``k`` words; fewer words give the whole sequence as one, none give none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        h = U(n)
        for w in words:
            h = mix((h * STEP + w).reshape(1))[0]
        return np.array([h], U)
    h = np.zeros(n - k + 1, U)
    for i in range(k):
        h = h * STEP + words[i : n - k + 1 + i]
    return mix(h)


def shingle_sets(column: pa.Array, k: int = WORDS_PER_SHINGLE, most_bytes: int = 1 << 21):
    """The sorted distinct shingle hashes of each text of a column, one array after another."""
    raw, off = text_buffer(column)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(off) - 1:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most_bytes, side="right")) - 1)
            words, at, _, _ = word_hashes(raw[off[i] : off[j]], off[i : j + 1] - off[i])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                yield np.unique(shingle_hashes(words[a:b], k))
            i = j


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row a group, ``size`` being the group's rows and ``total`` all rows.

    Groups of at least a ten-thousandth of all rows number ten thousand at most; they are broadcast, so
    that no hot key meets in one task. The rest is an ordinary join. ``groups`` should be a written table.
    """
    hot = groups.filter(F.col(size) * MOST_HOT >= total).filter(F.col(size) >= LEAST_HOT)
    cold = groups.filter((F.col(size) * MOST_HOT < total) | (F.col(size) < LEAST_HOT))
    few = F.broadcast(hot)
    names = F.broadcast(hot.select(key))
    return rows.join(few, key).unionByName(rows.join(names, key, "left_anti").join(cold, key))
