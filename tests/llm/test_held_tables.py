"""Tables that a Python worker holds, and how words reach the library."""

import brute
import numpy as np
import public_tokenizers as P
import pyarrow as pa

from riskloom.llm import bpe, common, language, ngram_join
from riskloom.llm.word_tokens import WordEncoder, encoder

WORDS = P.path("word_bpe_49k.json")


def test_a_worker_holds_one_operators_tables():
    first = encoder(WORDS)
    assert encoder(WORDS) is first and list(common._HELD.values()) == [first]
    coder = bpe.coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert list(common._HELD.values()) == [coder]

    class Shared:
        value = language.Model([], [])

    predictor = language._predictor(Shared)
    assert language._predictor(Shared) is predictor and list(common._HELD.values()) == [predictor]


def test_the_join_lets_go_of_earlier_tables(monkeypatch):
    seen = []

    class Docs:
        def select(self, *names):
            return self

        def mapInArrow(self, run, ddl):
            seen.append(run)

    ngram_join.profile(Docs(), 0)
    encoder(WORDS)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": pa.array(["a b c"])})
    assert sum(b.num_rows for b in seen[0](iter([batch]))) == 1 and not common._HELD


def test_words_of_letters_pass_by_the_normaliser():
    own = WordEncoder(WORDS)
    library, seen = own.library, {}

    class Spy:
        def __setattr__(self, name, value):
            setattr(library, name, value)

        def encode_batch_fast(self, texts, **how):
            seen.update({w: library.normalizer is None for t in texts for w in t.split()})
            return library.encode_batch_fast(texts, **how)

    own.library = Spy()
    texts = ["Plain words HERE x-ray 12 plain", "É Zwölf KELVIN K plain İx é WORDS", None, "a.b 's don't"]
    got = own.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in got] == [brute.word_ids(t) for t in texts]
    assert seen["plain"] and seen["kelvin"] and not seen["Zwölf"] and not seen["x-ray"] and library.normalizer is not None
