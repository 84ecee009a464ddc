"""Byte-level BPE by recursive SQL inside each task.

A task splits its texts into the words of the pattern, and words it has not met yet become rows (word,
ids, ranks of neighbouring pairs) of a DuckDB table. A recursive query contracts the leftmost pair of least
rank of every word and joins the two pairs beside it with the merge table, until no word has a pair left.
Decoding joins ids with the vocabulary and gathers their bytes in an ordered aggregation.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import held, slices
from riskloom.llm.word_tokens import in_groups

#: Words, and stretches in each of two generations, held with their ids by a Python worker; sum of the squared bytes of words
#: in one recursive query (it keeps a word's ids of every pass), and the longest
#: word that goes there (its passes grow with its length); longer ones are contracted by the same rule
#: from a heap.
MOST_WORDS, QUERY_SIZE, LONGEST = 400_000, 1 << 23, 256
#: In place of a rank: the two do not merge, or nothing follows.
NONE = (1 << 31) - 1
#: Ids in one decoding query, whatever texts they belong to.
DECODED = 1 << 19

ENCODE = f"""
WITH RECURSIVE t(w, ids, ranks) AS (
  SELECT w, ids, ranks FROM start
  UNION ALL
  (WITH best AS (
     SELECT w, ids, ranks, list_min(ranks) AS id, list_position(ranks, list_min(ranks)) AS i FROM t WHERE list_min(ranks) < {NONE})
   SELECT w, ids[:i - 1] || [id] || ids[i + 2:],
     CASE WHEN i > 1 THEN ranks[:i - 2] || [coalesce(x.rank, {NONE})] ELSE [] END || [coalesce(y.rank, {NONE})] || ranks[i + 2:]
   FROM best LEFT JOIN merges x ON x.l = ids[i - 1] AND x.r = id LEFT JOIN merges y ON y.l = id AND y.r = ids[i + 2]))
SELECT w, ids FROM t WHERE list_min(ranks) = {NONE}
"""
DECODE = "SELECT d, list(v.bytes ORDER BY p) AS parts FROM ids JOIN vocabulary v USING (id) GROUP BY d"


class Bpe:
    """Encoder and decoder for a file of ranks and a pattern."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        ranks = self.ranks
        splits = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.byte_pairs = np.array([[ranks.get(bytes([i, j]), NONE) for j in range(256)] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = pa.table([pa.array(c, pa.int32()) for c in zip(*splits, strict=True)], names=["l", "r", "rank"])  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        vocabulary = pa.table([pa.array(list(ranks.values()), pa.int32()), pa.array(list(ranks), pa.binary())], names=["id", "bytes"])  # noqa: F841
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _contract(self, words: list[bytes]) -> dict[int, bytes]:
        """Ids of short words by the recursive query."""
        at = np.cumsum([0, *map(len, words)], dtype=np.int32)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ranks = np.full(len(raw), NONE, np.int32)
        ranks[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        ranks[at[1:] - 1] = NONE  # a word's last byte has no next one
        lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (self.byte_ids[raw], ranks)]
        self.db.register("start", pa.table([pa.array(np.arange(len(words), dtype=np.int32)), *lists], names=["w", "ids", "ranks"]))
        out = self.db.sql(ENCODE).to_arrow_table().combine_chunks()
        self.db.unregister("start")
        ids = out.column("ids").combine_chunks()
        offsets = ids.offsets.to_numpy()
        raw = ids.values.to_numpy().astype("<u4").tobytes()
        return {w: raw[4 * a : 4 * b] for w, a, b in zip(out.column("w").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)}

    def _contract_long(self, word: bytes) -> bytes:
        """Ids of one word: least rank first, leftmost of equal ranks, from a heap over linked rows."""
        rank = self.ranks
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        end = len(parts)

        def pair(i):
            j = after[i]
            joined = parts[i] + parts[j] if i >= 0 and j < end else None
            return (rank[joined], i, joined) if joined in rank else None

        heap = [x for x in map(pair, range(end)) if x]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= end or parts[i] + parts[j] != joined:
                continue  # a row of this pair has changed since
            parts[i], parts[j], after[i] = joined, None, after[j]
            if after[i] < end:
                before[after[i]] = i
            for x in filter(None, (pair(before[i]) if before[i] >= 0 else None, pair(i))):
                heapq.heappush(heap, x)
        return np.array([rank[x] for x in parts if x is not None], "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        short, size = [], 0
        for w in sorted(words):
            raw = w.encode()
            if len(raw) > LONGEST:
                self.words[w] = self._contract_long(raw)
                continue
            short.append((w, raw))
            size += len(raw) ** 2
            if size > QUERY_SIZE:
                self._solve(short)
                short, size = [], 0
        if short:
            self._solve(short)

    def _solve(self, words: list[tuple[str, bytes]]) -> None:
        ids = self._contract([raw for _, raw in words])
        self.words.update((w, ids[i]) for i, (w, _) in enumerate(words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        split = [stretches(t or "") for t in texts]
        new = set(chain.from_iterable(split)).difference(self.parts)
        if len(self.parts) > MOST_WORDS:  # what is used again moves over from the old generation
            self.old, self.parts = self.parts, {}
            new = set(chain.from_iterable(split))
        if len(self.words) > MOST_WORDS:
            self.words = {}
        self.parts.update((x, self.old[x]) for x in new if x in self.old)
        new.difference_update(self.parts)
        matches = {part: self.pattern.findall(part) for part in new}
        self._learn(set(chain.from_iterable(matches.values())).difference(self.words))
        ids = self.words.__getitem__
        self.parts.update((part, ids(found[0]) if len(found) == 1 else b"".join(map(ids, found))) for part, found in matches.items())
        get = self.parts.__getitem__
        return [b"".join(map(get, parts)) for parts in split]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids, from stretches of a bounded number of ids: a long list's bytes are
        joined from consecutive stretches."""
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        every = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        found: list[list[bytes]] = [[] for _ in ids]
        for s in range(0, len(every), DECODED):
            for d, part in self._decoded(doc[s : s + DECODED], every[s : s + DECODED]):
                found[d].append(part)
        return [b"".join(parts) for parts in found]

    def _decoded(self, doc: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(list, bytes) of the lists of one stretch."""
        self.db.register("ids", pa.table([doc, np.arange(len(doc)), ids], names=["d", "p", "id"]))
        out = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("ids")
        for table in out.to_batches():
            parts = table.column("parts")
            values = parts.values.cast(pa.large_binary())  # the bytes of a list lie side by side
            _, at, data = values.buffers()
            at = np.frombuffer(at, np.int64)[values.offset :][parts.offsets.to_numpy()]
            for d, a, b in zip(table.column("d").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                yield d, data[a:b].to_pybytes()


SPACE_AFTER_SPACE = re.compile(r"\s\x20")
EDGE = re.compile(r"(?<=\S)(?=\x20)")


def stretches(text: str) -> list[str]:
    """The text cut before every blank that follows a character other than white space. No match of
    the pattern reaches over such a place: white space stands only at a match's start or fills it."""
    if SPACE_AFTER_SPACE.search(text):
        return EDGE.split(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + x for x in rest]


def coder(path: str, pattern: str) -> Bpe:
    """This worker's coder for a file of ranks."""
    return held((path, pattern), lambda: Bpe(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids binary) of every row of (doc_id, text); null and empty texts have no ids."""

    def run(batches):
        bpe = coder(path, pattern)
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            for i, j in in_groups(texts):
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(bpe.encode(texts[i:j]), pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary) of (doc_id, ids)."""

    def run(batches):
        bpe = coder(path, pattern)
        for b in slices(batches, 256):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bpe.decode(b.column("ids").to_pylist()), pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row, encoded and decoded by one worker a task, so that a task
    holds one set of tables."""

    def run(batches):
        bpe = coder(path, pattern)
        for b in slices(batches, 1024):  # in_groups bounds what is encoded at once
            texts = b.column("text").to_pylist()
            for i, j in in_groups(texts):
                ids = bpe.encode(texts[i:j])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(ids, pa.binary()), pa.array(bpe.decode(ids), pa.binary())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and decoded again."""
    both = round_trip(docs, path, pattern)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
