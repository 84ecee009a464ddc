"""Repeated passages within and across documents, by MinHash bands over paragraphs.

A paragraph is cut at line ends and, by content alone, after most sentences, so a passage
that stands in other surroundings falls into the same pieces; neighbouring short lines are joined. Exact copies of a piece are one node;
nodes that collide in a band are joined, checked by exact Jaccard similarity of their word shingles and
clustered by components. Beside the pieces, winnowed runs of words (the least hash of every window is
kept) tell any equal ``SURE`` words of two documents, and from there every equal run is followed word by
word to its ends. Passages are runs of neighbouring pieces and equal runs that occur elsewhere too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import WORDS_PER_SHINGLE, Scratch, attach, mix, semi, text_buffer, word_hashes
from riskloom.llm.count_tree import points
from riskloom.llm.near import connect, met_in_lists
from riskloom.llm.ngram_join import HELD, PER_BUCKET, _lists, _packed

U = np.uint64
#: Words of the shortest piece that is compared, of the shortest passage that is reported and of its
#: repeated words together, and between two pieces of one passage. The pieces at a near copy's ends often
#: run into the text around it, so a passage of 50 words is found by fewer.
PIECE, PASSAGE, REPEATED, BETWEEN = 8, 28, 16, 12
#: A stop so many words after the last stop or line end ends a piece with probability 3/4, another with 1/8.
#: After so many words without a stop any word may end a piece, by content, with probability 3/32.
SENTENCE, UNSTOPPED = 6, 24
#: Words to a cut on average where neighbouring pieces, lines say, are too short and are joined.
JOINED = 20
#: Words of an equal run, and runs in a window of which one is kept: two documents with
#: SURE = GRAM + WINDOW - 1 equal words side by side have a kept run in common.
GRAM, WINDOW = 20, 31
SURE = GRAM + WINDOW - 1
THRESHOLD, RECALL, HASHES = 0.75, 0.996, 14
UNIT = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("first_word", pa.int32()), ("words", pa.int32()), ("node", pa.int64())])
UNIT_DDL = "doc_id bigint, start int, end int, first_word int, words int, node bigint"


def tune(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows a band for which some number of bands finds a pair at the threshold
    with at least the wanted probability, within a number of hash functions."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("too few hash functions for this recall")
    return best


class Pieces:
    """Pieces of the texts of a column, a stretch of texts at a time."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw, self.off = raw, off
        self.words, self.at, self.starts, self.ends = word_hashes(raw, off)
        n = len(self.words)
        self.first = self.last = self.doc = self.size = self.begin = np.zeros(0, np.int64)
        self.shingles = np.zeros(0, U)
        if n < PIECE:
            return
        lines = np.concatenate([[0], np.cumsum(raw == 10)])
        cut = np.zeros(n, bool)
        cut[:-1] = lines[self.starts[1:]] > lines[self.ends[:-1]]
        cut[self.at[1:][self.at[1:] > 0] - 1] = True  # texts end
        stop = np.isin(raw[self.ends - 1], np.frombuffer(b".!?", np.uint8))
        place = np.arange(n)
        # words since the last stop, line end or text end: what came before a text has no part in it
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(stop | cut, place, -1))[:-1]])
        left = np.concatenate([[U(0)], self.words[:-1]])
        left[self.at[:-1][self.at[:-1] < n]] = 0
        drawn = mix(self.words + left * U(3))
        chance = drawn >> U(56)
        cut |= stop & (chance < np.where(place - before >= SENTENCE, U(192), U(32)))
        cut |= (place - before > UNSTOPPED) & (chance < U(24))
        self._join_short(cut, drawn >> U(40) & U(255))
        last = np.flatnonzero(cut)
        first = np.concatenate([[0], last[:-1] + 1])
        long = last - first + 1 >= PIECE
        self.first, self.last = first[long], last[long]
        self.doc = np.searchsorted(self.at, self.first, side="right") - 1
        k = WORDS_PER_SHINGLE
        every = np.zeros(n - k + 1, U) if n >= k else np.zeros(0, U)
        for i in range(k):
            every = every * U(0xD6E8FEB86659FD93) + self.words[i : n - k + 1 + i]
        every = mix(every)
        #: All shingles of the pieces one after another, and where each piece's begin.
        self.size = self.last - self.first + 2 - k
        self.begin = np.cumsum(self.size) - self.size
        inside = np.arange(self.size.sum()) + np.repeat(self.first - self.begin, self.size)
        self.shingles = every[inside]

    def _join_short(self, cut: np.ndarray, chance: np.ndarray) -> None:
        """Take back cuts between neighbouring pieces that are too short, but for some of them, chosen by
        content (one in about ``JOINED`` words), that leave no piece of such a run too short."""
        last = np.flatnonzero(cut)
        first = np.concatenate([[0], last[:-1] + 1])
        size = last - first + 1
        short = size < PIECE
        ends = np.zeros(len(cut), bool)
        ends[self.at[1:][self.at[1:] > 0] - 1] = True
        within = np.concatenate([short[:-1] & short[1:] & ~ends[last[:-1]], [False]])
        starts = np.maximum.accumulate(np.where(np.concatenate([[True], ~within[:-1]]), first, 0))
        stops = np.minimum.accumulate(np.where(within, len(cut), last)[::-1])[::-1]
        cut[last[within]] = False
        taken = np.flatnonzero(within & (chance[last] < (size * 256 // JOINED).astype(U)))
        at = last[taken]
        since = np.maximum(np.concatenate([[0], at[:-1] + 1]), starts[taken])
        cut[at[(at + 1 - since >= PIECE) & (stops[taken] - at >= PIECE)]] = True

    def reduce(self, by: np.ufunc, values: np.ndarray) -> np.ndarray:
        return by.reduceat(values, self.begin) if len(self.begin) else values[:0]

    def nodes(self) -> np.ndarray:
        """A 64-bit key of each piece's shingles, order aside."""
        return self.reduce(np.add, mix(self.shingles + U(0x632BE59BD9B4E019))).view(np.int64)

    def bands(self, bands: int, rows: int):
        """A key for each piece in every band."""
        for b in range(bands):
            key = np.full(len(self.begin), U(b + 1))
            for r in range(rows):
                seed = mix(np.array([b * rows + r + 1], U))[0]
                key = mix(key * U(31) + self.reduce(np.minimum, (self.shingles ^ seed) * U(0x9E3779B97F4A7C15)))
            yield key


def pieces_of(column: pa.Array, most_bytes: int = 1 << 22):
    """(first text, pieces) for stretches of the texts of a column."""
    raw, off = text_buffer(column)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(off) - 1:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most_bytes, side="right")) - 1)
            yield i, Pieces(raw[off[i] : off[j]], off[i : j + 1] - off[i])
            i = j


def _over(by: np.ufunc, x: np.ndarray, n: int) -> np.ndarray:
    """``by`` over each ``n`` neighbours of ``x``."""
    size = 1
    while 2 * size <= n:
        x = by(x[:-size], x[size:])
        size *= 2
    return by(x[: len(x) - (n - size)], x[n - size :]) if size < n else x


class Grams:
    """Runs of ``GRAM`` words of the texts of a column, a stretch of texts at a time: ``key`` of the run
    that begins at each word, ``fits`` where it lies within its text."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw, self.off = raw, off
        words, self.at, self.starts, self.ends = word_hashes(raw, off)
        n = max(0, len(words) - GRAM + 1)
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(self.at))
        self.left = (self.at[self.text + 1] - np.arange(len(words)))[:n]  # words to the text's end
        key = np.zeros(n, U)
        for i in range(GRAM if n else 0):
            key = key * U(0xD6E8FEB86659FD93) + words[i : n + i]
        self.key, self.fits = mix(key) | U(1), self.left >= GRAM

    def kept(self) -> np.ndarray:
        """Words where a run begins whose key is the least of a window of the text."""
        n = len(self.key)
        if n < WINDOW:
            return np.zeros(0, np.int64)
        least = np.where(self.left[: n - WINDOW + 1] >= SURE, _over(np.minimum, self.key, WINDOW), U(0))
        none = np.zeros(WINDOW - 1, U)
        return np.flatnonzero(_over(np.maximum, np.concatenate([none, least, none]), WINDOW) == self.key)

    def around(self, met: np.ndarray) -> np.ndarray:
        """Words where runs begin that tell how far the equal words at the kept runs ``met`` (ascending)
        reach: all within a window before and after a row of them, and one before a wide gap's end."""
        text = self.text[met]
        apart = (np.diff(met) > WINDOW) | (text[1:] != text[:-1])
        head, tail = met[np.concatenate([[True], apart])], met[np.concatenate([apart, [True]])]
        step = np.arange(1, WINDOW)
        before, after = (head[:, None] - step).ravel(), (tail[:, None] + step).ravel()
        before = before[before >= np.repeat(self.at[self.text[head]], WINDOW - 1)]
        after = after[after < np.repeat(self.at[self.text[tail] + 1], WINDOW - 1)]
        wide = met[1:][~apart & (np.diff(met) > GRAM)] - GRAM
        every = np.unique(np.concatenate([met, before, after, wide]))
        every = every[every < len(self.key)]
        return every[self.fits[every]]


def _grams_of(column: pa.Array, most_bytes: int = 1 << 21):
    """(first text, runs) for stretches of the texts of a column."""
    raw, off = text_buffer(column)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(off) - 1:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most_bytes, side="right")) - 1)
            yield i, Grams(raw[off[i] : off[j]], off[i : j + 1] - off[i])
            i = j


def _elsewhere(rows: DataFrame, *more) -> DataFrame:
    """(key, size, ...) of keys that more than one document has; a null doc_id is one document."""
    found = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.count("doc_id").alias("known"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), *more)
    return found.filter("low < high OR (known > 0 AND known < size)").drop("known", "low", "high")


def equal_runs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Runs of ``GRAM`` words that another document has: doc_id, start, end, first_word, words, key, first
    (doc_id and word of the first occurrence). Together they cover all words that two documents share in
    a row of ``SURE`` words or more, but for up to ``WINDOW - GRAM`` words between two such rows."""

    def kept(batches):
        for b in batches:
            ids = b.column("doc_id")
            for i, g in _grams_of(b.column("text")):
                k = g.kept()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(g.text[k] + i)), pa.array(g.key[k].view(np.int64)), pa.array((k - g.at[g.text[k]]).astype(np.int32))], names=["doc_id", "key", "word"])

    def followed(batches):
        for b in batches:
            ids, met = b.column("doc_id"), b.column("met")
            for i, g in _grams_of(b.column("text")):
                lists = met.slice(i, len(g.off) - 1)
                size = np.array([len(x) for x in lists], np.int64)
                place = lists.flatten().to_numpy().astype(np.int64) + np.repeat(g.at[:-1], size)
                place = np.unique(place[place < np.repeat(g.at[1:], size)])
                if not len(place):
                    continue
                k = g.around(place)
                points = np.concatenate([[0], np.cumsum((g.raw & 0xC0) != 0x80)])
                base = points[g.off[g.text[k]]]
                cols = [points[g.starts[k]] - base, points[g.ends[k + GRAM - 1]] - base, k - g.at[g.text[k]]]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(g.text[k] + i)), *[pa.array(c.astype(np.int32)) for c in cols], pa.array(g.key[k].view(np.int64))], names=["doc_id", "start", "end", "first_word", "key"])

    marks = scratch.keep(docs.mapInArrow(kept, "doc_id bigint, key bigint, word int"))
    shared = scratch.keep(_elsewhere(marks))
    met = attach(marks, shared, "key", "size", marks.count()).groupBy("doc_id").agg(F.collect_list("word").alias("met"))
    met = scratch.keep(met.withColumnRenamed("doc_id", "doc"))
    texts = semi(docs, "doc_id", met.select("doc"))
    texts = texts.join(met, texts.doc_id.eqNullSafe(met.doc)).select("doc_id", "text", "met")
    runs = scratch.keep(texts.mapInArrow(followed, "doc_id bigint, start int, end int, first_word int, key bigint"))
    firsts = scratch.keep(_elsewhere(runs, F.min(F.struct("doc_id", "first_word")).alias("first")))
    return attach(runs, firsts, "key", "size", runs.count()).select("doc_id", "start", "end", "first_word", F.lit(GRAM).alias("words"), "key", "first")


def units(docs: DataFrame) -> DataFrame:
    """The pieces of every text: place in code points, place and number of words, and node."""

    def run(batches):
        for b in batches:
            ids = b.column("doc_id")
            for i, p in pieces_of(b.column("text")):
                if not len(p.first):
                    continue
                points = np.concatenate([[0], np.cumsum((p.raw & 0xC0) != 0x80)])
                base = points[p.off[p.doc]]
                start, end = points[p.starts[p.first]] - base, points[p.ends[p.last]] - base
                cols = [ids.take(pa.array(p.doc + i)), start, end, p.first - p.at[p.doc], p.last - p.first + 1, p.nodes()]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(cols, UNIT, strict=True)], schema=UNIT)

    return docs.mapInArrow(run, UNIT_DDL)


def banded(docs: DataFrame, bands: int, rows: int, buckets: int) -> DataFrame:
    """Band keys of all pieces, packed by bucket; copies within a stretch of texts once."""

    def run(batches):
        keys, nodes, sizes, held = [], [], [], 0
        for b in batches:
            for _, p in pieces_of(b.column("text")):
                node, once = np.unique(p.nodes(), return_index=True)
                for key in p.bands(bands, rows):
                    keys.append(key[once])
                    nodes.append(node)
                    sizes.append(p.size[once])
                    held += len(node)
                if held > HELD:
                    yield from _packed(keys, nodes, sizes, buckets)
                    keys, nodes, sizes, held = [], [], [], 0
        if held:
            yield from _packed(keys, nodes, sizes, buckets)

    return docs.select("text").mapInArrow(run, "bucket int, tokens binary, nodes binary, sizes binary")


def _node_texts(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, text, point), once each, for wanted (node, doc)."""
    def run(batches):
        for b in batches:
            for _, p in pieces_of(b.column("text")):
                if not len(p.first):
                    continue
                node, once = np.unique(p.nodes(), return_index=True)
                text = [p.raw[a:e].tobytes() for a, e in zip(p.starts[p.first[once]].tolist(), p.ends[p.last[once]].tolist(), strict=True)]
                size = p.size[once]
                inside = np.arange(size.sum()) + np.repeat(p.begin[once] - (np.cumsum(size) - size), size)
                at = points(p.shingles[inside], np.repeat(np.arange(len(once)), size), len(once))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(text, pa.binary()).cast(pa.string()), pa.array(at, pa.binary())], names=["node", "text", "point"])

    found = semi(docs, "doc_id", scratch.keep(wanted.select("doc").distinct())).select("text")
    return found.mapInArrow(run, "node bigint, text string, point binary").join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Repeated passages: doc_id, start, end (code points, end exclusive), n_words, repeated_words,
    removed_words, cluster_id and first_doc.

    A passage is a run of pieces and of equal words that each occur in another document too. Their first
    occurrence, by doc_id and place, stays; ``removed_words`` counts the words of the others
    and is 0 for a passage that stays in whole. ``cluster_id`` is that of the passage's first piece (the key
    of its first equal run where it has no piece) and ``first_doc`` the document where that one stays. Documents without repeated passages, null and
    empty texts have no row. Rows with a null doc_id come first; rows that repeat in full are copies.
    """
    docs = docs.select("doc_id", "text")
    bands, rows = tune()
    table = scratch.keep(units(docs))
    buckets = max(8, table.count() * bands // PER_BUCKET + 1)
    lists, met = met_in_lists(banded(docs, bands, rows, buckets), _lists, scratch)
    counts = table.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc"))
    wanted = scratch.keep(counts.join(lists.select("node").distinct(), "node").select("node", "doc"))
    text = scratch.keep(_node_texts(docs, wanted, scratch))
    roots = connect(lists, met, text.select("node", "point"), lambda nodes: text.join(nodes, "node").select("node", "text"), scratch)
    repeated = counts.join(roots, "node", "left").filter("n > 1 OR root IS NOT NULL").select("node", "n", F.coalesce("root", "node").alias("cluster"))
    repeated = scratch.keep(repeated)
    total = table.count()
    members = scratch.keep(attach(table, repeated, "node", "n", total).select("doc_id", "start", "end", "first_word", "words", "cluster"))
    place = F.struct(F.col("doc_id"), F.col("start"))
    firsts = scratch.keep(members.groupBy("cluster").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("size"), (F.when(F.min("doc_id").eqNullSafe(F.max("doc_id")), 1).otherwise(2)).alias("documents")))
    known = attach(members, firsts.filter("documents > 1"), "cluster", "size", total).withColumn("stays", place.eqNullSafe(F.col("first")))
    known = known.select("doc_id", "start", "end", "first_word", "words", "stays", F.col("first.doc_id").alias("first_doc"), "cluster", F.col("start").alias("piece"))
    equal = equal_runs(docs, scratch)
    stays = F.struct("doc_id", "first_word").eqNullSafe(F.col("first"))
    known = known.union(equal.select("doc_id", "start", "end", "first_word", "words", stays, "first.doc_id", "key", F.lit(None).cast("int")))
    in_doc = Window.partitionBy("doc_id").orderBy("first_word", "words", "stays", "cluster")
    before = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    past = F.col("first_word") + F.col("words")
    runs = known.withColumn("told", F.coalesce(F.max(past).over(before), F.lit(0))).withColumn("gone", F.coalesce(F.max(F.when(~F.col("stays"), past)).over(before), F.lit(0)))
    apart = F.row_number().over(in_doc) == 1
    runs = runs.withColumn("new", F.when(~apart & (F.col("first_word") - F.col("told") <= BETWEEN), 0).otherwise(1)).withColumn("run", F.sum("new").over(in_doc))
    fresh = lambda told: F.greatest(F.lit(0), past - F.greatest("first_word", told))
    # the cluster and document of the first piece, or of the first equal run where there is no piece
    of_first = lambda c: F.coalesce(F.min_by(c, "piece"), F.min_by(c, "start"))
    out = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max(past) - F.min("first_word")).alias("n_words"), F.sum(fresh("told")).alias("repeated_words"),
        F.sum(F.when(F.col("stays"), 0).otherwise(fresh("gone"))).alias("removed_words"), of_first("cluster").alias("cluster_id"), of_first("first_doc").alias("first_doc"),
    )
    return out.filter((F.col("n_words") >= PASSAGE) & (F.col("repeated_words") >= REPEATED)).drop("run")


def cleaned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the passages of which every word is removed; all rows and other columns stay."""
    spans = found.filter("removed_words = repeated_words").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    spans = spans.withColumnRenamed("doc_id", "__doc")
    joined = docs.join(spans, docs.doc_id.eqNullSafe(spans["__doc"]), "left").drop("__doc")
    names, at = docs.columns, docs.columns.index("text")

    def cut(text, parts):
        out, end = [], 0
        for s in parts or []:
            out.append(text[end : s["start"]])
            end = s["end"]
        return "".join([*out, text[end:]]) if parts and text is not None else text

    def run(batches):
        for b in batches:
            text = [cut(t, s) for t, s in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if i == at else c for i, c in enumerate(b.columns[:-1])], names=names)

    return joined.mapInArrow(run, docs.schema)
