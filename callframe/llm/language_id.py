"""Language identification, words first.

A word that the training texts hold is scored by its log frequency in each
language. An unseen word falls back to its character n-grams, marked at the
word's ends: the longest n (4 to 1) with a known n-gram decides, by the mean
log frequency of the known ones. A text's score is the sum over its words; the
probability treats the evidence as that of at most ``EVIDENCE_WORDS`` words, so
long texts do not all saturate.

The tables are fitted on at most about ``MAX_TRAIN`` labelled documents, chosen
by a hash of the id, the same number of every language (all of a language that
has fewer), so a rare one is learned at every size of the corpus. Words and
n-grams are counted in Spark. The tables hold at most ``MAX_WORDS`` words and
``MAX_GRAMS`` n-grams of each length, shared evenly among the languages: of each
language those from a count on, which is found from how many have each count, so
no task ranks a whole language. That bounds what is collected (by Arrow) and
broadcast. Prediction covers every document and whole texts in one pass
without a shuffle. Only text and the learned tables enter a prediction.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
if there was nothing to learn from. A text whose words give no evidence (a
foreign script) gets the most frequent language at the score 1 / languages.
Ties go to the language first in order. Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import bucket_of, map_texts, text_of, written

FOLDS = 5
MAX_TRAIN = 20_000
MAX_WORDS = 200_000
MAX_GRAMS = 50_000
MAX_N = 4
SMOOTHING = 0.5
EVIDENCE_WORDS = 20
#: unseen words a task remembers before it forgets them
CACHE_WORDS = 1 << 18
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single characters
    without the marks."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def sample_fraction(rows: int, limit: int) -> float:
    return min(1.0, limit / max(rows, 1))


class LanguageModel:
    """Log frequencies per language of words and n-grams (rows of matrices).

    ``words`` are (language, word, count); ``gram_counts`` (language, length,
    n-gram, count), by default those of the words."""

    def __init__(self, words, gram_counts=None):
        words = list(words)
        if gram_counts is None:
            gram_counts = [(lang, n, g, c) for lang, w, c in words for n in range(1, MAX_N + 1) for g in grams(w, n)]
        self.languages = sorted({lang for lang, _, _ in words})
        column = {lang: i for i, lang in enumerate(self.languages)}
        self.words, totals = self._logs([(column[lang], w, c) for lang, w, c in words])
        self.prior = totals
        held: list[list] = [[] for _ in range(MAX_N + 1)]
        for lang, n, gram, c in gram_counts:
            if lang in column:
                held[n].append((column[lang], gram, c))
        self.grams = [self._logs(h)[0] for h in held]

    def _logs(self, entries: list[tuple[int, str, int]]):
        """((row of each key, log frequencies), total of each language)"""
        if not entries:
            return ({}, np.zeros((0, len(self.languages)), np.float32)), np.zeros(len(self.languages))
        lang, key, n = zip(*entries)
        rows, keys = pd.factorize(np.array(key, object))
        m = np.zeros((len(keys), len(self.languages)))
        np.add.at(m, (rows, np.array(lang)), np.array(n, float))
        logs = np.log((m + SMOOTHING) / (m.sum(0) + SMOOTHING * (len(m) + 1)))
        return ({k: i for i, k in enumerate(keys.tolist())}, logs.astype(np.float32)), m.sum(0)

    def backoff(self, word: str) -> np.ndarray:
        for n in range(MAX_N, 0, -1):
            index, logs = self.grams[n]
            known = [i for g in grams(word, n) if (i := index.get(g)) is not None]
            if known:
                return logs[known].mean(0)
        return np.zeros(len(self.languages), np.float32)


class Predictor:
    def __init__(self, model: LanguageModel):
        self.model = model
        self._reset()

    def _reset(self):
        index, logs = self.model.words
        self.index, self.rows, self.known = dict(index), [logs], len(logs)
        self.matrix, self.size = logs, len(logs)

    def _lookup(self, words: list[str]) -> np.ndarray:
        index = self.index
        try:
            return np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        except KeyError:
            new = [w for w in dict.fromkeys(words) if w not in index]
            if self.size + len(new) > len(self.matrix):
                room = np.zeros((max(len(new), 4096, len(self.matrix) // 2), self.matrix.shape[1]), np.float32)
                self.matrix = np.concatenate([self.matrix, room])
            for w in new:
                self.matrix[self.size] = self.model.backoff(w)
                index[w] = self.size
                self.size += 1
            return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def predict(self, text: str) -> tuple[str, float]:
        words = words_of(text)
        languages = self.model.languages
        if not languages or not has_letter(words):
            return UNDETERMINED, 0.0
        if self.size - self.known > CACHE_WORDS:
            self._reset()
        numbers = self._lookup(words)
        total = np.zeros(len(languages))
        for i in range(0, len(numbers), 1 << 16):
            total += self.matrix[numbers[i:i + (1 << 16)]].sum(0, dtype=np.float64)
        if not total.any():
            return languages[int(self.model.prior.argmax())], 1.0 / len(languages)
        best = int(total.argmax())
        odds = np.exp((total - total[best]) * (min(len(words), EVIDENCE_WORDS) / len(words)))
        return languages[best], float(1.0 / odds.sum())


def spread_sample(rows: DataFrame, by: str, id_col: str, limit: int) -> tuple[DataFrame, int]:
    """(about ``limit`` rows, as many of every value of ``by`` or all that it
    has, by a hash of the id; the number of values). One small row per value
    is collected."""
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    if not counts:
        return rows, 0
    share = {k: int(sample_fraction(n, max(1, limit // len(counts))) * (1 << 20)) for k, n in counts.items()}
    bound = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])[F.col(by)]
    return rows.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) < bound), len(counts)


def most_frequent(counted: DataFrame, groups: list[str], key: str, limit: int) -> DataFrame:
    """The rows (groups, key, n) of every key that is among the most frequent of
    some group: in each group the keys from a count on, at most ``limit``."""
    group = F.concat_ws("|", *groups)
    # how many keys have each count: few rows, whatever the number of keys
    steps = counted.groupBy(group.alias("g"), "n").agg(F.count(key).alias("keys")).toArrow().to_pydict()
    least: dict[str, int] = {}
    held: dict[str, int] = {}
    for g, n, keys in sorted(zip(steps["g"], steps["n"], steps["keys"]), key=lambda x: (x[0], -x[1])):
        held[g] = held.get(g, 0) + keys
        if held[g] <= limit:
            least[g] = n
    if not least:
        return counted.limit(0)
    bound = F.create_map(*[F.lit(x) for kv in least.items() for x in kv])[group]
    # the first group column is the language: a kept key counts in all languages
    chosen = counted.filter(F.col("n") >= bound).select(*groups[1:], key).distinct()
    return counted.join(chosen.hint("merge"), [*groups[1:], key], "left_semi")


def _grams_of(word: Column) -> Column:
    """array<(length, n-gram)>: the n-grams of ``grams`` in Spark."""
    marked = F.concat(F.lit("<"), word, F.lit(">"))

    def pair(n: int, gram: Column) -> Column:
        return F.struct(F.lit(n).alias("size"), gram.alias("gram"))

    def of(n: int) -> Column:
        last = F.char_length(marked) - n + 1
        some = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: pair(n, F.substring(marked, i, F.lit(n))))
        return F.when(last >= 1, some).otherwise(F.array().cast("array<struct<size:int,gram:string>>"))

    return F.concat(F.transform(F.split(word, ""), lambda c: pair(1, c)), *[of(n) for n in range(2, MAX_N + 1)])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> LanguageModel:
    """Learn from (text, lang) rows; null texts and labels teach nothing."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    rows, languages = spread_sample(rows, "lang", "id", max_train)
    if not languages:
        return LanguageModel([])

    def task():
        def batch(ids, rest, texts):
            counts: dict[str, Counter] = {}
            for lang, text in zip(rest[0].to_pylist(), texts):
                counts.setdefault(lang, Counter()).update(words_of(text))
            for lang, c in counts.items():
                yield [[None] * len(c), [lang] * len(c), list(c), list(c.values())]

        return batch

    counted = map_texts(rows.select(F.lit(None).cast("bigint").alias("id"), "lang", "text"), task,
                        [("word", "string"), ("n", "bigint")], carry=["lang"])
    words = written(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    grams_ = (words.select("lang", "n", F.explode(_grams_of(F.col("word"))).alias("g"))
              .groupBy("lang", F.col("g.size").alias("size"), F.col("g.gram").alias("gram")).agg(F.sum("n").alias("n")))
    grams_ = written(grams_, "language-grams")
    kept = most_frequent(words, ["lang"], "word", max(1, max_words // languages)).toArrow()
    kept_grams = most_frequent(grams_, ["lang", "size"], "gram", max(1, max_grams // languages)).toArrow()
    return LanguageModel(zip(*(kept.column(c).to_pylist() for c in ("lang", "word", "n"))),
                         zip(*(kept_grams.column(c).to_pylist() for c in ("lang", "size", "gram", "n"))))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
            carry: list[str] = (), models: list | None = None) -> DataFrame:
    """One row per document: id, carried columns, lang_pred, score. The
    broadcast is added to ``models``, for callers that destroy it once the rows
    are written."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if models is not None:
        models.append(shared)

    def task():
        predictor = Predictor(shared.value)

        def batch(ids, rest, texts):
            found = [predictor.predict(t) for t in texts]
            yield [ids, *rest, [f[0] for f in found], [f[1] for f in found]]

        return batch

    return map_texts(docs.select(F.col(id_col), *carry, text_of(text_col).alias("_text")), task,
                     [("lang_pred", "string"), ("score", "double")], carry=list(carry))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the documents outside fold 0 of FOLDS and predict all."""
    fold = bucket_of(id_col, FOLDS)
    model = fit(docs.filter(fold != 0), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"), (fold == 0).alias("held_out"))
    return predict(rows, model, id_col, "text", carry=["held_out"])
