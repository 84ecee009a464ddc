"""Ids of a public word-end BPE for whole texts, one library call per distinct word.

The vocabulary's pattern never matches white space and its normaliser works on single characters and
their combining marks, so a text's ids are the ids of its blank-separated words, one after another. The
strings of special tokens are taken out of a text before all else, as the library does. Words are kept with their ids for the texts that follow, up to a fixed number.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata

import numpy as np
import pyarrow as pa

from riskloom.llm.common import held, text_buffer

#: Words in each of the two generations that a Python worker holds; when the younger is full it becomes
#: the older, and what is used again moves over.
MOST_WORDS = 300_000
#: Words encoded as one text.
TOGETHER = 1000
END_ID = 1
WORD_END = "</w>"
#: Characters that are neither letters, numbers, blanks nor combining.
TAIL = string.punctuation.encode()


#: Words of Latin letters that stay one letter each when they are composed and lower-cased.
MARKED = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.steps = self.library.normalizer, self.library.pre_tokenizer
        self.blanks = pre_tokenizers.WhitespaceSplit()
        self.blanks_in_bytes = pre_tokenizers.Sequence([self.blanks, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.composed = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.library.encode_special_tokens = True  # words are lower-cased before; what looks like one now was none
        self.library.model._resize_cache(0)  # every word that the library is given is new
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.special_ids = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _learn(self, words: list[bytes]) -> None:
        """Words of letters only are one match of the pattern each, so many of them are encoded as one
        text and told apart by the tokens that end a match; where the counts differ, and for all other
        words, each is a text of its own."""
        latin: list[bytes] = []
        marked: list[bytes] = []
        plain: list[bytes] = []
        single: list[bytes] = []
        for w in words:
            (latin if w.isalpha() else marked if MARKED.fullmatch(text := w.decode()) else plain if text.isalpha() else single).append(w)
        # the pattern cuts these words at blanks, and the normaliser only lower-cases and composes them: both are much slower than that
        try:
            self.library.normalizer, self.library.pre_tokenizer = None, self.blanks
            single += self._learn_together(latin, bytes.lower)
            self.library.normalizer, self.library.pre_tokenizer = self.composed, self.blanks_in_bytes
            single += self._learn_together(marked, bytes)
        finally:
            self.library.normalizer, self.library.pre_tokenizer = self.steps
        single += self._learn_together(plain, bytes)
        for w, e in zip(single, self.library.encode_batch_fast([w.decode() for w in single], add_special_tokens=False), strict=True):
            self.known[w] = np.array(e.ids, "<u4").tobytes()

    def _learn_together(self, words: list[bytes], form) -> list[bytes]:
        """Learn words of letters, many in one call; what could not be told apart is returned."""
        left: list[bytes] = []
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, found in zip(groups, self.library.encode_batch_fast([form(b" ".join(g)).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(group):
                left += group
                continue
            raw = ids.tobytes()
            self.known.update(zip(group, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
        return left

    def _need(self, words: set[bytes]) -> None:
        """Ids of ``words``. Punctuation after a word's last letter is a match of its own, so words of letters
        with punctuation behind them are put together from the two parts."""
        cut = {w: stem for w in words if w[-1] in TAIL and (stem := w.rstrip(TAIL)) and _letters(stem)}
        rest = words.difference(cut) | set(cut.values()) | {w[len(stem) :] for w, stem in cut.items()}
        self._learn(list(rest.difference(self.known)))
        known = self.known
        for w, stem in cut.items():
            known[w] = known[stem] + known[w[len(stem) :]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        if self.special and any(t and "<|" in t and self.special.search(t) for t in texts):
            return [self._around_special(t) if t and "<|" in t else self._encode([t])[0] for t in texts]
        return self._encode(texts)

    def _around_special(self, text: str) -> bytes:
        parts = self.special.split(text)  # every second part is a special token
        plain = self._encode(parts[::2])
        return b"".join(x for i, p in enumerate(parts) for x in [self.special_ids[p] if i % 2 else plain[i // 2]])

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        pieces, edge = cut_texts(texts)
        coded = pieces.dictionary_encode()
        _, offsets, data = coded.dictionary.buffers()
        at, raw = np.frombuffer(offsets, np.int64)[: len(coded.dictionary) + 1].tolist(), data.to_pybytes() if data is not None else b""
        distinct = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        if len(self.known) > MOST_WORDS:
            self.old, self.known = self.known, {}
        found = list(map(self.known.get, distinct))
        new = [w for w, x in zip(distinct, found, strict=True) if x is None]
        if new:
            self.known.update((w, x) for w, x in zip(new, map(self.old.get, new), strict=True) if x is not None)
            rest = {w for w in new if w not in self.known}
            if rest:
                self._need(rest)
            found = list(map(self.known.__getitem__, distinct))
        # a piece's ids lie at start, size of them, in those of the distinct pieces
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, start = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        place = coded.indices.to_numpy()
        size = size[place]
        end = np.concatenate([[0], np.cumsum(size)])
        out = ids[np.arange(end[-1]) + np.repeat(start[place] - end[:-1], size)].tobytes()
        edge = (4 * end[edge]).tolist()
        return [out[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _letters(word: bytes) -> bool:
    """Whether a word is letters only after the normaliser too, which takes some letters apart from their marks."""
    return word.isalpha() or unicodedata.normalize("NFC", word.decode()).lower().isalpha()


BLANK = b" \t\n\v\f\r"
#: Classes of bytes: blank, letter of A-Z, digit, punctuation, apostrophe (its match may run on into letters), other;
#: words with a hyphen stay in one piece.
CLASSES = (BLANK, string.ascii_letters.encode(), string.digits.encode(), TAIL.translate(None, b"'-"), b"'")
KIND = bytes(next((k for k, chars in enumerate(CLASSES) if c in chars), 5) for c in range(256))
#: For a class and the next one, by 6 * class + next: 2 before a blank, 1 where a piece surely begins, else 0.
BEGINS = {(0, b) for b in range(6)} | {(1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)}
CUT = bytes(2 if k < 36 and k % 6 == 0 else int(divmod(k, 6) in BEGINS) for k in range(256))


def cut_texts(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """Blank-separated words of all texts in order, cut further where neighbouring characters of ASCII belong to two
    matches of the pattern whatever stands around them, and the n + 1 offsets of the texts' pieces. Pieces
    of ASCII are in lower case; in others a capital and its marks may compose to another letter than the small one."""
    raw, off = text_buffer(pa.array(texts, pa.large_string()))
    text = raw.tobytes()
    kind = np.frombuffer(text.translate(KIND), np.uint8)
    mark = np.empty(len(kind), np.uint8)
    mark[1:] = np.frombuffer((kind[:-1] * np.uint8(6) + kind[1:]).tobytes().translate(CUT), np.uint8)
    head = off[:-1][off[:-1] < len(kind)]
    mark[head] = np.where(kind[head] == 0, 2, 1)
    edge = np.searchsorted(np.flatnonzero(mark == 1), off)
    begin = np.flatnonzero(np.frombuffer(mark.tobytes().translate(None, b"\x02"), np.uint8))
    words = text.translate(None, BLANK)
    offsets = np.append(begin, len(words))
    data = np.frombuffer(words.lower(), np.uint8)
    if not words.isascii():
        as_is = np.frombuffer(words, np.uint8)
        beyond = np.zeros(len(begin), bool)
        beyond[np.searchsorted(begin, np.flatnonzero(as_is > 127), side="right") - 1] = True
        data = np.where(np.repeat(beyond, np.diff(offsets)), as_is, data)
    return pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), edge


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a vocabulary file."""
    return held(path, lambda: WordEncoder(path))


def in_groups(texts: list[str | None], most: int = 1 << 21):
    """Ranges of rows of about ``most`` characters, at least one row each."""
    i = size = 0
    for j, t in enumerate(texts):
        n = len(t or "")
        if j > i and size + n > most:
            yield i, j
            i, size = j, 0
        size += n
    if i < len(texts):
        yield i, len(texts)
