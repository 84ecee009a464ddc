"""Pieces that the word encoder cuts texts into, and their ids beside those of the tokenizers library."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from riskloom.llm.word_tokens import WordEncoder, cut_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_texts_are_cut_where_a_match_surely_begins():
    pieces, edge = cut_texts(["Don't,  stop!!\n", None, "a1b 12.5 (it's", "", "MENTÉ. 'sA-'sa x-ray,"])
    got = [pieces[a:b].to_pylist() for a, b in zip(edge[:-1], edge[1:], strict=True)]
    want = [["don", "'t", ",", "stop", "!!"], [], ["a", "1", "b", "1", "2", ".", "5", "(", "it", "'s"], [], ["MENTÉ.", "'sa-'sa", "x-ray", ","]]
    assert [[x.decode() for x in p] for p in got] == want


def test_ids_are_those_of_the_library():
    # letters that the normaliser takes apart from their marks, before punctuation that then belongs to the marks
    texts = ["İ' İ, x", "क़, क़", "H̱> H̱_ ẖ", "'TIS don'T it's(a's ''s", "a\x85b  c d", "ΑΣ, ß!! ½. ²3", "<|startoftext|>A<|STARTOFTEXT|>", "中文,abc1一", None, ""]
    library = Tokenizer.from_file(PATH)
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encoder = WordEncoder(PATH)
    assert encoder.encode(texts) == want
    assert encoder.encode(texts[::-1]) == want[::-1]
