"""Language of texts: known words by their log frequency in each language, other words by character n-grams.

A word that training has seen scores by its frequency. Any other word falls back to its n-grams, from
the longest order down to the first of which the model knows at least one.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import held, slices
from riskloom.llm.word_tokens import in_groups

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
ORDERS = (5, 4, 3, 2, 1)
#: Documents to learn from in each language, on average (they are chosen by a hash of their id), the
#: fewest times that a word or n-gram must occur to be known, and the entries of the model (the most frequent
#: ones of every language, in equal shares).
SAMPLE, LEAST, MOST = 3000, 3, 120_000
#: Words that a Python worker keeps with their scores.
KEPT = 120_000
#: Characters of the texts whose new words are scored together.
TOGETHER = 1 << 20
SMOOTHING = 0.5
#: N-grams of a word up to which those of many words are added together.
MOST_ADDED = 40


def held_out() -> Column:
    """True for documents that are kept from training; null doc_id: not held out, and not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _grams(word: str, n: int):
    w = f"<{word}>" if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _words(batches):
    """(lang, word, count) of a task."""
    words: dict[str, Counter] = {}
    for b in slices(batches):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
    for lang, counts in words.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "count"])


def _parts(batches):
    """(lang, n, gram, count) of distinct words: n-grams, each as often as the words of this task hold it."""
    for b in batches:
        words: dict[str, list[str]] = {}
        for lang, word in zip(b.column("lang").to_pylist(), b.column("word").to_pylist(), strict=True):
            words.setdefault(lang, []).append(word)
        for lang, mine in words.items():
            for n in ORDERS:
                grams = Counter(chain.from_iterable(_grams(w, n) for w in mine))
                k = len(grams)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array([n] * k, pa.int32()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["lang", "n", "gram", "count"])


class Model:
    """Log frequencies by language of words (order 0) and n-grams."""

    def __init__(self, languages: list[str], rows: list[tuple[int, str, str, int]]):
        self.languages = languages
        at = {x: i for i, x in enumerate(languages)}
        self.rows: dict[int, dict[str, int]] = {}
        for n, gram, _, _ in rows:
            known = self.rows.setdefault(n, {})
            known.setdefault(gram, len(known))
        self.logs = {n: np.full((len(known), len(languages)), SMOOTHING) for n, known in self.rows.items()}
        for n, gram, lang, count in rows:
            self.logs[n][self.rows[n][gram], at[lang]] += count
        self.logs = {n: np.log(m / m.sum(axis=0)).astype(np.float32) for n, m in self.logs.items()}

    def word(self, word: str) -> np.ndarray:
        """Log score of one lower-case word in every language."""
        return self.words([word])[0]

    def words(self, words: list[str]) -> np.ndarray:
        """Log scores of lower-case words, a row each, in every language."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        get = self.rows.get(0, {}).get
        at = np.array([get(w, -1) for w in words], np.int64)
        if (at >= 0).any():
            out[at >= 0] = self.logs[0][at[at >= 0]]
        left = np.flatnonzero(at < 0).tolist()
        for n in ORDERS:
            get = self.rows.get(n, {}).get
            mine, rest, hits, size = [], [], [], []
            for i in left:
                found = [k for k in map(get, _grams(words[i], n)) if k is not None]
                if found:
                    mine.append(i)
                    hits += found
                    size.append(len(found))
                else:
                    rest.append(i)
            if mine:
                out[mine] = _means(self.logs[n], np.array(hits), np.array(size))
            left = rest
        return out


def _means(logs: np.ndarray, hits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The mean of the rows of each stretch of ``hits``, added up in order."""
    start = np.cumsum(size) - size
    total = logs[hits[start]]
    for k in range(1, min(int(size.max()), MOST_ADDED)):
        more = np.flatnonzero(size > k)
        total[more] += logs[hits[start[more] + k]]
    total /= size[:, None].astype(np.float32)
    for i in np.flatnonzero(size > MOST_ADDED).tolist():
        total[i] = logs[hits[start[i] : start[i] + size[i]]].mean(axis=0)
    return total


class Predictor:
    """A model with the scores of the words met so far, up to ``KEPT``."""

    def __init__(self, model: Model):
        self.model, self.at = model, {}
        self.scores = np.zeros((1024, len(model.languages)), np.float32)

    def _learn(self, words: list[str]) -> None:
        k, end = len(self.at), len(self.at) + len(words)
        if end > len(self.scores):
            self.scores = np.vstack([self.scores, np.zeros((max(end, 2 * len(self.scores)) - len(self.scores), self.scores.shape[1]), np.float32)])
        self.scores[k:end] = self.model.words(words)
        self.at.update(zip(words, range(k, end), strict=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; all new words of some texts are scored together."""
        out = []
        for i, j in in_groups(texts, TOGETHER):
            split = [WORD.findall((t or "").lower()) for t in texts[i:j]]
            if len(self.at) > KEPT:
                self.at.clear()
            at = self.at
            new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in at]
            if new and self.model.languages:
                self._learn(new)
            out += [self._score(words) for words in split]
        return out

    def _score(self, words: list[str]) -> tuple[str, float]:
        if not any(c.isalpha() for w in words for c in w) or not self.model.languages:
            return UNKNOWN, 0.0
        total = self.scores[list(map(self.at.__getitem__, words))].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))  # a tie falls to the language first in order
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows with a language whose doc_id is not held out; about ``sample`` documents of each
    language, fewer where there are fewer. No labelled row: the model knows no language."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], [])
    share = F.create_map(*chain.from_iterable((F.lit(x), F.lit(min(1.0, sample / sizes[x]))) for x in languages))
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select("lang", "text")
    words = chosen.mapInArrow(_words, "lang string, word string, count bigint").groupBy("lang", "word").agg(F.sum("count").alias("count"))
    words = words.persist(StorageLevel.DISK_ONLY)
    grams = words.select("lang", "word").mapInArrow(_parts, "lang string, n int, gram string, count bigint").groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))
    counts = words.select("lang", F.lit(0).alias("n"), F.col("word").alias("gram"), "count").unionByName(grams)
    # what is known is known in all languages: an entry is kept if it is among the most frequent of any of them
    often = counts.groupBy("n", "gram").agg(F.sum("count").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("by")).filter(F.col("all") >= LEAST)
    each = often.select("n", "gram", F.explode("by").alias("lang", "count"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "n", "gram"))
    kept = each.withColumn("place", place).filter(F.col("place") <= max(1, MOST // len(languages))).select("n", "gram").distinct()
    known = often.join(kept, ["n", "gram"]).select("n", "gram", F.explode("by").alias("lang", "count")).collect()
    words.unpersist()
    return Model(languages, sorted((r.n, r.gram, r.lang, r["count"]) for r in known))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; null text or none with a letter: ``und``, 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        p = _predictor(shared)
        for b in slices(batches):
            out = p.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())], schema=schema)

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def _predictor(shared) -> Predictor:
    model = shared.value
    return held(id(model), lambda: Predictor(model))  # the predictor keeps the model, so its id stays its own


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` whose language can be told: all whose text has a letter, if the model knows a language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        p = _predictor(shared)
        for b in slices(batches):
            keep = [x != UNKNOWN for x, _ in p.predict(b.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays(b.columns, schema=b.schema).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
