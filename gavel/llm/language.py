"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood is the sum over all
its segmentations into pieces, by the forward algorithm; a text's is the product over its words. Pieces do not cross
white space, so words are scored once a batch however often they occur, for all languages together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavel.llm.rows import quoted

#: The vocabulary's file (only the driver reads it) and the mark that starts a word in it.
VOCABULARY, MARK = "/opt/tokenizers/piece_bpe_32k.model", "▁"
#: Bound of the training sample: documents a language, those of the smallest id hash.
DOCUMENTS_A_LANGUAGE = 400
#: Rounds of expectation-maximisation, and the weight of the even distribution in each estimate.
ROUNDS, EVEN = 3, 1e-3
#: Log-probability of a character that is no piece, the same in every language.
UNKNOWN = -16.0
#: Characters of a token that are learned from together, and what is read on both sides of them.
SPAN, CONTEXT = 512, 64
#: Least characters of a part of a word that is scored in parts; words of twice as many are.
LONG_WORD = 64
#: Characters of a part from which on it is scored in blocks; characters of a block; blocks that are carried together.
UNBROKEN, STRIDE, STRIDES = 4096, 512, 256
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LETTER = regex.compile(r"\p{L}")
#: Distinct words kept in a worker before it starts anew; cells of a matrix of words.
KEPT_WORDS, CELLS = 150_000, 400_000
#: Characters of texts that are scored together.
BLOCK = 1_000_000


@lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """The vocabulary's pieces in lower case, distinct, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return sorted({model.id_to_piece(i).lower() for i in kept} - {""})


def _hash(piece: str) -> np.uint64:
    h = np.uint64(len(piece))
    with np.errstate(over="ignore"):
        for c in piece:
            h = h * _MULTIPLIER + np.uint64(ord(c) + 1)
        return h * _MULTIPLIER


@dataclass
class Pieces:
    """A hash table from the hash of a substring to the number of its piece; 0: none."""

    keys: np.ndarray  # by piece number
    tables: list[np.ndarray]
    longest: int

    BITS = 18

    @classmethod
    def of(cls, vocabulary: list[str]) -> Pieces:
        keys = np.array([0, *(_hash(p) for p in vocabulary)], dtype=np.uint64)
        tables, left = [], np.arange(1, len(keys), dtype=np.int32)
        while len(left):
            table = np.zeros(1 << cls.BITS, dtype=np.int32)
            slot = cls._slot(keys[left], len(tables))
            _, first = np.unique(slot, return_index=True)
            table[slot[first]] = left[first]
            left = np.delete(left, first)
            tables.append(table)
        return cls(keys, tables, max(map(len, vocabulary), default=1))

    @staticmethod
    def _slot(h: np.ndarray, n: int) -> np.ndarray:
        return (h >> np.uint64(64 - Pieces.BITS - 7 * n)) & np.uint64((1 << Pieces.BITS) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(h.shape, dtype=np.int32)
        for n, table in enumerate(self.tables):
            at = table[self._slot(h, n)]
            np.copyto(out, at, where=(self.keys[at] == h) & (at > 0))
        return out


def _matrices(words: list[str], mark: str = MARK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, code points by word and position, lengths) of groups of words of about equal length."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + len(mark)
    order = np.argsort(lengths, kind="stable")
    i = 0
    while i < len(order):
        j = min(len(order), i + max(1, CELLS // int(lengths[order[i]])))
        wide = int(lengths[order[j - 1]])
        if wide > lengths[order[i]] + 2:  # few words of very different length: keep padding small
            j = max(i + 1, int(np.searchsorted(lengths[order], lengths[order[i]] + 2, side="right")))
            j = min(j, i + max(1, CELLS // int(lengths[order[i]])))
            wide = int(lengths[order[j - 1]])
        at = order[i:j]
        text = "".join(mark + words[k] for k in at)
        flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes, own = np.zeros((len(at), wide), dtype=np.uint64), lengths[at]
        codes[np.arange(wide)[None, :] < own[:, None]] = flat.astype(np.uint64) + np.uint64(1)
        yield at, codes, own
        i = j


def _rolled(index: Pieces, codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each length l from 1: the pieces of l characters, by the position where they start."""
    wide = codes.shape[1]
    with np.errstate(over="ignore"):
        body, power = codes.copy(), _MULTIPLIER  # body: sum of codes times powers, without the length's term
        for n in range(1, min(index.longest, wide) + 1):
            if n > 1:
                body = body[:, :-1] * _MULTIPLIER + codes[:, n - 1 :]
                power = power * _MULTIPLIER
            yield index.find((body + np.uint64(n) * power) * _MULTIPLIER)


def _parts(index: Pieces, word: str) -> list[str]:
    """Word in parts of LONG_WORD characters or more, cut where no piece of the vocabulary lies across.

    Every segmentation has these cuts, so the word's sum is the product of the parts' sums.
    """
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)[None, :] + np.uint64(1)
    across = np.zeros(len(word) + 1, dtype=np.int64)
    for n, found in enumerate(_rolled(index, codes), 1):
        start = np.flatnonzero(found[0])
        np.add.at(across, start + 1, 1)
        np.add.at(across, start + n, -1)
    cuts = [0]
    for c in np.flatnonzero(np.cumsum(across)[: len(word)] == 0).tolist():
        if c - cuts[-1] >= LONG_WORD:
            cuts.append(c)
    return [word[a:b] for a, b in zip(cuts, [*cuts[1:], len(word)], strict=True)]


def word_scores(index: Pieces, table: np.ndarray, words: list[str]) -> np.ndarray:
    """Log-likelihood of each word in each language: a row a word, a column a language."""
    marked = [[MARK + w] if len(w) < 2 * LONG_WORD else _parts(index, MARK + w) for w in words]
    parts, out = [p for own in marked for p in own], np.zeros((len(words), table.shape[1]))
    long = np.fromiter((len(p) >= UNBROKEN for p in parts), dtype=bool, count=len(parts))
    scores = np.zeros((len(parts), table.shape[1]))
    scores[~long] = _scores(index, table, [p for p, n in zip(parts, long, strict=True) if not n])
    for i in np.flatnonzero(long):
        scores[i] = _unbroken(index, table, parts[i])
    np.add.at(out, np.repeat(np.arange(len(words)), [len(own) for own in marked]), scores)
    return out


def _transfers(found: list[np.ndarray], table: np.ndarray, starts: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """What `steps` steps of the forward algorithm make of each unit state at each start, and the logarithm of its scale.

    A state has the sums at a place and at those before it, as many as the longest piece has characters.
    """
    deep, unknown = len(found), np.exp(UNKNOWN)
    recent = [np.zeros((len(starts), deep, table.shape[1])) for _ in range(deep)]  # by block, unit state, language; the latest first
    for n, sums in enumerate(recent):
        sums[:, n] = 1.0
    scale = np.zeros((len(starts), table.shape[1]))
    for k in range(1, steps + 1):
        new = np.zeros(recent[0].shape)
        for n, sums in enumerate(recent, 1):
            at = starts + k - n
            ids = np.where(at >= 0, found[n - 1][np.maximum(at, 0)], 0)
            if n == 1:
                new += sums * np.where((ids == 0)[:, None], unknown, table[ids])[:, None, :]
            elif ids.any():
                new += sums * table[ids][:, None, :]
        recent = [new, *recent[:-1]]
        if k % 8 == 0:
            top = np.max([x.max(axis=1) for x in recent], axis=0)
            top[top == 0] = 1.0
            recent = [x / top[:, None, :] for x in recent]
            scale += np.log(top)
    return np.stack(recent), scale


def _unbroken(index: Pieces, table: np.ndarray, word: str) -> np.ndarray:
    """Log-likelihood of one long string in each language, by the forward algorithm in blocks.

    A step of the algorithm is linear in the state before it. So all blocks are walked at once, from every unit state,
    and the state is carried from block to block by what these give.
    """
    deep = index.longest
    state, total = np.zeros((deep, table.shape[1])), np.zeros(table.shape[1])
    state[0] = 1.0
    for lo in range(0, len(word), STRIDE * STRIDES):
        head = max(0, lo - deep + 1)
        text = word[head : lo + STRIDE * STRIDES]
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)[None, :] + np.uint64(1)
        found = [f[0] for f in _rolled(index, codes)]
        found += [np.zeros(1, dtype=np.int32)] * (deep - len(found))
        first, whole = lo - head, (len(text) - (lo - head)) // STRIDE
        for starts, steps in ((first + STRIDE * np.arange(whole), STRIDE), (np.array([first + STRIDE * whole]), len(text) - first - STRIDE * whole)):
            if len(starts) and steps:
                moved, scale = _transfers([np.pad(f, (0, len(text) - len(f))) for f in found], table, starts, steps)
                for b in range(len(starts)):
                    state = np.einsum("ail,il->al", moved[:, b], state)
                    top = state.max(axis=0)
                    top[top == 0] = 1.0
                    state, total = state / top, total + scale[b] + np.log(top)
    return np.log(np.maximum(state[0], 1e-300)) + total


def _scores(index: Pieces, table: np.ndarray, words: list[str]) -> np.ndarray:
    """Log-likelihoods of strings as they are, by the forward algorithm."""
    out, unknown = np.zeros((len(words), table.shape[1])), np.exp(UNKNOWN)
    for at, codes, lengths in _matrices(words, ""):
        found, wide = list(_rolled(index, codes)), codes.shape[1]
        alpha, scale = [np.ones((len(at), table.shape[1]))], np.zeros((len(at), table.shape[1]))
        for j in range(1, wide + 1):
            a = alpha[-1] * np.where((found[0][:, j - 1] == 0)[:, None], unknown, table[found[0][:, j - 1]])
            for n in range(2, min(len(found), j) + 1):
                ids = found[n - 1][:, j - n]
                hit = np.flatnonzero(ids)
                if len(hit):
                    a[hit] += alpha[-n][hit] * table[ids[hit]]
            if j % 8 == 0:  # keep the numbers in range; all that later steps use shares a scale
                top = np.where(a > 0, a, 1.0)  # of each language, for one may fall far behind
                a = a / top
                alpha = [x / top for x in alpha[-index.longest :]]
                scale += np.log(top)
            alpha.append(a)
            del alpha[: -index.longest - 1]
            ends = np.flatnonzero(lengths == j)
            if len(ends):
                out[at[ends]] = np.log(np.maximum(a[ends], 1e-300)) + scale[ends]
    return out


def _spans(words: list[str], counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Marked words, longer ones than SPAN in overlapping parts: text, count, and the places whose pieces count in it."""
    rows = []
    for word, n in zip(words, counts.tolist(), strict=True):
        word = MARK + word
        for a in range(0, len(word), SPAN):
            lo = max(0, a - CONTEXT)
            rows.append((word[lo : a + SPAN + CONTEXT], n, a - lo, min(a + SPAN, len(word)) - lo))
    text, n, first, stop = zip(*rows, strict=True) if rows else ((), (), (), ())
    return list(text), np.array(n, dtype=float), np.array(first, dtype=np.int64), np.array(stop, dtype=np.int64)


def _sums(probability: list[np.ndarray], ends: np.ndarray, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the segmentations up to each place, or from each on, by place and word; and the logarithms of their scales."""
    rows, wide = probability[0].shape
    sums, scales = np.zeros((wide + 1, rows)), np.zeros((wide + 1, rows))
    recent, scale = [], np.zeros(rows)  # the latest sums, all at the same scale
    for k in range(wide + 1):
        j = wide - k if backward else k
        row = (ends == j).astype(float) if backward else np.full(rows, float(j == 0))
        for n in range(1, min(len(probability), k) + 1):
            row += recent[-n] * probability[n - 1][:, j if backward else j - n]
        if k % 8 == 7:
            top = np.where(row > 0, row, 1.0)
            row = row / top
            recent = [x / top for x in recent[-len(probability) :]]
            scale = scale + np.log(top)
        recent.append(row)
        del recent[: -len(probability)]
        sums[j], scales[j] = row, scale
    return sums, scales


def _expected(index: Pieces, p: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece over all segmentations of the words, for one language."""
    use, unknown = np.zeros(len(p)), np.exp(UNKNOWN)
    words, counts, first, stop = _spans(words, counts)
    for at, codes, lengths in _matrices(words, ""):
        found, wide, rows = list(_rolled(index, codes)), codes.shape[1], np.arange(len(at))
        one = np.where(found[0] == 0, unknown, p[found[0]])
        probability = [one, *(p[f] for f in found[1:])]
        (ahead, ahead_scale), (back, back_scale) = _sums(probability, lengths, False), _sums(probability, lengths, True)
        total = ahead_scale[lengths, rows] + np.log(ahead[lengths, rows])
        inside = (np.arange(wide) >= first[at][:, None]) & (np.arange(wide) < stop[at][:, None])
        for n in range(1, len(found) + 1):
            k = wide - n + 1
            share = ahead[:k] * back[n:] * np.exp(np.minimum(ahead_scale[:k] + back_scale[n:] - total, 700.0))
            np.add.at(use, found[n - 1].ravel(), (share.T * probability[n - 1] * inside[:, :k] * counts[at][:, None]).ravel())
    use[0] = 0.0
    return use


@dataclass
class Model:
    """languages in code-point order; table: probability by piece (row 0: no piece) and language."""

    languages: list[str]
    table: np.ndarray
    index: Pieces


def learnable(docs: DataFrame) -> DataFrame:
    """Rows with text, id and language whose crc32 of the id, as text, leaves another remainder than 1 by 3."""
    return docs.filter("text is not null and lang is not null and pmod(crc32(cast(doc_id as string)), 3) <> 1")


def train(docs: DataFrame, vocabulary: str = VOCABULARY, sample: int = DOCUMENTS_A_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from at most `sample` learnable documents (more at equal hashes).

    The sample is the same at every run. Executors count its words; the driver gets one row a distinct word.
    """
    hashed = learnable(docs).select("lang", "text", F.xxhash64("doc_id", F.lit("language")).alias("__h"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("__h"))
    last = hashed.select("lang", "__h").withColumn("__n", nth).filter(F.col("__n") <= sample).groupBy("lang").agg(F.max("__h").alias("__last")).collect()
    bounds = {r["lang"]: r["__last"] for r in last}
    index = Pieces.of(pieces(vocabulary))
    languages = sorted(bounds, key=lambda x: x.encode())
    table = np.zeros((len(index.keys), len(languages)))
    if not languages:
        return Model([], table, index)
    limit = F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair))
    chosen = hashed.filter(F.col("__h") <= F.element_at(limit, F.col("lang"))).select("lang", "text")

    def count(batches):
        from collections import Counter, defaultdict

        for batch in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                seen[lang].update(text.lower().split())
            rows = [(lang, w, n) for lang, words in seen.items() for w, n in words.items()]
            yield pd.DataFrame(rows, columns=["lang", "word", "n"])

    counted = chosen.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    for k, lang in enumerate(languages):
        own = counted[counted["lang"] == lang]
        words, n = own["word"].tolist(), own["n"].to_numpy(dtype=float)
        p = np.full(len(index.keys), 1.0 / max(1, len(index.keys) - 1))
        p[0] = 0.0
        for _ in range(rounds):
            use = _expected(index, p, words, n)
            total = use.sum()
            p = (1 - EVEN) * use / total + EVEN / (len(p) - 1) if total else p
            p[0] = 0.0
        table[:, k] = p
    return Model(languages, table, index)


def judgement(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function of a text column: struct of lang_pred and score, see predict()."""
    shipped = spark.sparkContext.broadcast(model)  # pieces times languages, fixed by the vocabulary

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, score = shipped.value, None
        for texts in batches:
            if score is None:
                score = Scorer(model)
            yield score(texts)

    return judge


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs and lang_pred, score: the likeliest learned language and its posterior under even priors.

    `und` and 0 if the text is null or has no letter, or nothing was learned. Of equal languages the first by code
    point wins. Every word of the text counts, whatever its length. Columns of these names in docs are replaced; repeated
    rows are judged each by itself, and alike.
    """
    own = docs.drop("lang_pred", "score").withColumn("__judged", judgement(docs.sparkSession, model)(quoted(text)))
    return own.withColumn("lang_pred", F.col("__judged.lang_pred")).withColumn("score", F.col("__judged.score")).drop("__judged")


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of docs in whose text predict() finds a language, with the columns of docs, of any names, as they are."""
    return docs.filter(judgement(docs.sparkSession, model)(quoted(text))["lang_pred"] != "und")


class _Numbers(dict):
    """Numbers words as they come; `new` has those not scored yet."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Scorer:
    """Scores batches of texts; distinct words are kept between them up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.numbers, self.scores = model, _Numbers(), np.zeros((0, len(model.languages)))

    def _totals(self, texts: list[str]) -> np.ndarray:
        """Log-likelihoods of a block of texts."""
        if len(self.numbers) > KEPT_WORDS:
            self.numbers, self.scores = _Numbers(), self.scores[:0]
        ids, ends = [], []
        for t in texts:
            words = t.lower().split()
            ids.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words)))
            ends.append(len(words))
        if self.numbers.new:
            self.scores = np.concatenate([self.scores, word_scores(self.model.index, self.model.table, self.numbers.new)])
            self.numbers.new = []
        out = np.zeros((len(texts), self.scores.shape[1]))
        for i, own in enumerate(ids):
            out[i] = self.scores[own].sum(axis=0)
        return out

    def __call__(self, texts: pd.Series) -> pd.DataFrame:
        languages = self.model.languages
        named, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
        if not languages:
            return pd.DataFrame({"lang_pred": named, "score": score})
        todo = [(i, t) for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
        block: list[tuple[int, str]] = []
        size = 0
        for i, t in [*todo, (-1, "")]:
            if i < 0 or size > BLOCK:
                totals = self._totals([x for _, x in block])
                best = totals.argmax(axis=1)
                share = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1) if len(block) else []
                for (k, _), b, s in zip(block, best, share, strict=True):
                    named[k], score[k] = languages[b], s
                block, size = [], 0
            block.append((i, t))
            size += len(t)
        return pd.DataFrame({"lang_pred": named, "score": score})


def held_out(doc_id: Column) -> Column:
    """Whether no model may learn from a document; false for a null id, which is not learned from either."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))
