"""Words scored together have the scores that each has alone."""

import numpy as np

from riskloom.llm import language
from riskloom.llm.language import Model, Predictor, _grams


def _alone(model, word):
    known = model.rows.get(0, {}).get(word)
    if known is not None:
        return model.logs[0][known]
    for n in language.ORDERS:
        table = model.rows.get(n, {})
        hits = [table[g] for g in _grams(word, n) if g in table]
        if hits:
            return model.logs[n][hits].mean(axis=0)
    return np.zeros(len(model.languages), np.float32)


def test_words_scored_together(monkeypatch):
    rng = np.random.default_rng(5)
    word = lambda most: "".join(rng.choice(list("abcde\u00e9"), int(rng.integers(1, most))))
    rows = {(n, g): int(c) for c in rng.integers(1, 50, 300) for w in [word(9)] for n in language.ORDERS for g in _grams(w, n)[:2]} | {(0, word(6)): 7 for _ in range(40)}
    model = Model(["x", "y", "z"], sorted((n, g, "xyz"[c % 3], c) for (n, g), c in rows.items()))
    words = [word(14) for _ in range(400)] + [word(300) for _ in range(20)] + ["q", "0", "qqq"]
    assert np.array_equal(model.words(words), np.array([_alone(model, w) for w in words]))
    assert model.words([]).shape == (0, 3)
    texts = [" ".join(words[i : i + 30]) for i in range(0, 420, 7)] + [None, "", "12 34"]
    calls = []
    learn = Predictor._learn
    monkeypatch.setattr(Predictor, "_learn", lambda self, new: (calls.append(len(new)), learn(self, new))[1])
    whole = Predictor(model).predict(texts)
    assert len(calls) == 1  # not once a word
    monkeypatch.setattr(language, "KEPT", 50)
    monkeypatch.setattr(language, "TOGETHER", 40)
    assert Predictor(model).predict(texts) == whole
    for text, (lang, score) in zip(texts, whole, strict=True):
        found = language.WORD.findall((text or "").lower())
        if not found:
            assert (lang, score) == ("und", 0.0)
            continue
        total = np.array([_alone(model, w) for w in found]).sum(axis=0, dtype=np.float64)
        assert lang == "xyz"[int(np.argmax(total))] and score == float(1 / np.exp(total - total.max()).sum())
