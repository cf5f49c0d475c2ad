"""Learning languages from tokens of any length."""

import numpy as np
import pytest

from gavel.llm import language


def uses(prob, text):
    """Expected uses of each piece over all segmentations of text, in logarithms."""
    n, most = len(text), max(map(len, prob))
    score = lambda s: np.log(prob[s]) if s in prob else language.UNKNOWN if len(s) == 1 else -np.inf
    ahead, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = back[n] = 0.0
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[i] + score(text[i:j]) for i in range(max(0, j - most), j)])
    for i in range(n - 1, -1, -1):
        back[i] = np.logaddexp.reduce([back[j] + score(text[i:j]) for j in range(i + 1, min(n, i + most) + 1)])
    out = dict.fromkeys(prob, 0.0)
    for i in range(n):
        for j in range(i + 1, min(n, i + most) + 1):
            if text[i:j] in prob:
                out[text[i:j]] += np.exp(ahead[i] + score(text[i:j]) + back[j] - ahead[n])
    return out


@pytest.mark.parametrize("length", [1, 39, 40, 511, 512, 1600])
def test_expected_uses(length):
    names = ["a", "b", "ab", "aba", "bbab", language.MARK, language.MARK + "a"]
    index, p = language.Pieces.of(names), np.array([0.0, 0.3, 0.2, 0.15, 0.1, 0.05, 0.1, 0.1])
    word = "".join(np.random.default_rng(length).choice(list("abz"), length, p=[0.5, 0.4, 0.1]))
    want = uses(dict(zip(names, p[1:], strict=True)), language.MARK + word)
    got = language._expected(index, p, [word, "ab"], np.array([3.0, 2.0]))
    short = uses(dict(zip(names, p[1:], strict=True)), language.MARK + "ab")
    assert np.allclose(got[1:], [3 * want[x] + 2 * short[x] for x in names], rtol=1e-6)


def test_languages_without_spaces(spark):
    rng = np.random.default_rng(2)
    letters = {"aa": list("東京大学研究会社"), "bb": list("のはをにがでとも"), "cc": list("абвгдежз")}
    rows = [(i, lang, "".join(rng.choice(letters[lang], 700 if i % 2 else 60))) for i in range(90) for lang in [["aa", "bb", "cc"][i // 30]]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.train(docs)
    assert all(len(set(model.table[1:, k])) > 1 for k in range(3))
    assert all(r["lang"] == r["lang_pred"] for r in language.predict(docs, model).collect())


def test_unbroken_words_are_summed_as_a_whole(monkeypatch):
    names = ["a", "b", "ab", "aba", "xx", "xxxxx"]
    index, table = language.Pieces.of(names), np.random.default_rng(1).random((7, 2)) / 7
    table[0] = 0.0

    def plain(text):
        sums = [np.zeros(2)]
        for j in range(1, len(text) + 1):
            part = {n: names.index(text[j - n : j]) + 1 if text[j - n : j] in names else 0 for n in range(1, min(5, j) + 1)}
            terms = [sums[-n] + np.log(table[i]) if i else sums[-n] + language.UNKNOWN for n, i in part.items() if i or n == 1]
            sums.append(np.logaddexp.reduce(terms))
        return sums[-1]

    monkeypatch.setattr(language, "STRIDE", 64)
    monkeypatch.setattr(language, "STRIDES", 5)
    monkeypatch.setattr(language, "UNBROKEN", 100)
    for word in ("x" * 1001, "".join(np.random.default_rng(2).choice(list("abx"), 700)), "ab" * 320, "x" * 99, "xxab" * 16 + "x"):
        for found in (language._unbroken(index, table, word), language._scores(index, table, [word])[0]):
            assert np.allclose(found, plain(word), rtol=1e-9)
        assert np.allclose(language.word_scores(index, table, [word])[0], plain(language.MARK + word), rtol=1e-9)


def test_a_long_unbroken_word_takes_seconds():
    import time

    index = language.Pieces.of(language.pieces(language.VOCABULARY))
    table = np.random.default_rng(0).random((len(index.keys), 4)) / len(index.keys)
    table[0], began = 0.0, time.thread_time()
    language.word_scores(index, table, ["x" * 200_000])
    assert time.thread_time() - began < 10
