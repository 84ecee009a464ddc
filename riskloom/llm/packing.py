"""Best-fit packing of documents into sequences under several capacities at once.

A piece is a vector (tokens, documents, attention cost), a sequence one capacity for each. Pieces are
placed longest first into the open sequence that fits in every dimension and is best by the chosen
rule: the smallest weighted norm of what remains, or the largest weighted dot product of piece and
residual. Groups of a bounded number of pieces are packed apart, at a cost of at most the last
sequences of each group.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, slices
from riskloom.llm.word_tokens import END_ID, encoder, in_groups

CAPACITY = 4096
#: Pieces packed together; larger groups waste less and take longer.
GROUP = 20_000
#: Weights of tokens, documents and attention cost in the choice of a sequence.
WEIGHTS = (1.0, 0.05, 0.2)

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every row of (doc_id, text): its ids and the end id, cut only where longer than
    ``capacity``. Null and empty texts are the end id alone; repeated rows have pieces each."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)

    def run(batches):
        encode, end = encoder(vocabulary).encode, np.array([END_ID], "<u4").tobytes()
        for b in slices(batches):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for i, j in in_groups(texts):
                rows = []
                for doc, raw in zip(ids[i:j], encode(texts[i:j]), strict=True):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), part)[: 5 + with_ids])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def best_fit(length: np.ndarray, capacity: tuple[int, int, int], weights=WEIGHTS, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, ``length`` being sorted in falling order."""
    caps = np.array(capacity, float)
    if len(length) and (length[0] > caps[0] or float(length[0]) ** 2 > caps[2] or caps[1] < 1):
        raise ValueError("a piece is larger than an empty sequence")
    w = np.asarray(weights, float)
    bins, offsets = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    rest = np.empty((3, 1024))  # of the open bins
    name = np.empty(1024, np.int64)
    n = made = 0
    least = length[-1] if len(length) else 0
    for i, size in enumerate(length.tolist()):
        need = np.array([size, 1.0, float(size) * size])
        have = rest[:, :n]
        fits = np.flatnonzero((have[0] >= need[0]) & (have[1] >= need[1]) & (have[2] >= need[2]))
        if len(fits):
            left = (have[:, fits] - need[:, None]) / caps[:, None]
            score = w @ (left * left) if rule == "norm" else -(w * need / caps) @ (have[:, fits] / caps[:, None])
            k = fits[np.argmin(score)]
        else:
            if n == len(name):
                rest, name = np.hstack([rest, np.empty_like(rest)]), np.concatenate([name, np.empty_like(name)])
            k = n
            rest[:, k], name[k] = caps, made
            n, made = n + 1, made + 1
        bins[i], offsets[i] = name[k], capacity[0] - rest[0, k]
        rest[:, k] -= need
        if rest[0, k] < least or rest[1, k] < 1:  # nothing fits any more: close it
            n -= 1
            rest[:, k], name[k] = rest[:, n], name[n]
    return bins, offsets


def pack(cut: DataFrame, capacity: int = CAPACITY, documents: int = CAPACITY, attention: int | None = None, rows: int | None = None, rule: str = "norm") -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences: adds sequence_id and offset.

    ``documents`` bounds the pieces of a sequence and ``attention`` the sum of squared lengths; the
    defaults bind only as far as the tokens do. Pieces that fill a sequence are placed apart.
    """
    attention = capacity * capacity if attention is None else attention
    groups = max(1, -(-(cut.count() if rows is None else rows) // GROUP))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(t.column("length").to_numpy(), (capacity, documents, attention), rule=rule)
        group = t.column("group").to_numpy().astype(np.int64)
        out = t.drop_columns(["group"])
        return out.append_column("sequence_id", pa.array(bins * groups + group)).append_column("offset", pa.array(offsets))

    dealt = cut.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    return dealt.groupBy("group").applyInArrow(run, PIECES + ", sequence_id bigint, offset bigint")


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces; ``cut`` has the ids. A sequence gathers at most its capacity."""
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    place = packed.join(cut.select(*keys, "ids").dropDuplicates(keys), [packed[k].eqNullSafe(cut[k]) for k in keys]).select("sequence_id", "offset", "ids")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return place.groupBy("sequence_id").agg(ordered.alias("parts")).select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def packed(docs: DataFrame, vocabulary: str, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of ``docs`` with their places. An empty table gives no rows."""
    cut = scratch.keep(pieces(docs, vocabulary, capacity))
    return pack(cut, capacity)
