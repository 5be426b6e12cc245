"""Toxicity by the nearest labelled examples.

Terms are words and the first four and five letters of longer words (stems).
Every text is a TF-IDF vector over all its terms, also those that no example
has. Terms that speak for the toxic class weigh more: a likelihood-ratio test
on the examples gives each term a factor between 1 and ``1 + BOOST``; it never
removes a term or an example. In this test copies and near copies count as one
witness: a row's weight is one over the number of rows that share one of its
shingle sketches.

A text's score is the vote of its ``NEIGHBOURS`` nearest examples by exact
cosine. A vote counts by the cube of the similarity and by how many labelled
rows of its class the example stands for; all votes are shrunk towards the base
rate, the toxic share of examples without a term that clearly speaks for the
class, which a text that is like no example gets. The neighbours' ids and the strongest terms shared with the nearest are the evidence.

Examples are found through an inverted index in blocks of ``BLOCK`` examples.
The terms that most examples have are kept as a dense matrix per block, the
others as postings. Each term has, for each block, its largest weight there; the
sum of query weight times block maximum bounds every score in a block, so blocks
are evaluated in descending bounds (a matrix product for all texts of a step
that still need the block, then the postings) until no bound exceeds the worst
neighbour held. The best are then summed again in double precision, with all
that are close to the last one, so the neighbours are exact.

About ``MAX_EXAMPLES`` labelled rows (by a hash of the id, the same number of
each label, or all that a label has) are the examples; that bounds what is
collected (by Arrow) and broadcast. Scoring covers all documents and whole texts
in one pass without a shuffle; labels, language, source and id never enter a
score.

Defined results: a null or empty text has no terms and gets the base rate.
With no training rows every score is 0. Repeated rows give repeated rows.
Several labels of one id count as toxic if any is. Ids are integers. Equal
similarities prefer the example with the smaller id.
"""

from __future__ import annotations

import contextlib
import itertools
import math
import zlib
from array import array
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import bucket_of, map_texts, text_of, written
from callframe.llm.language_id import spread_sample, words_of

FOLDS, HELD_OUT = 4, 2
MAX_EXAMPLES = 6144
STEMS = (4, 5)
SKETCHES = 3
SHINGLE = 3
#: largest extra weight of a term, and the values of the test where it begins and is reached
BOOST, LEAST_TEST, FULL_TEST = 30.0, 4.0, 20.0
#: a term with a factor has so many witnesses, and is at least so many times as often toxic as a training text is
MIN_WITNESSES, MIN_LIFT = 2.0, 3.0
NEIGHBOURS = 15
POWER = 3
SHRINKAGE = 0.25
BLOCK = 512
#: terms kept as a dense matrix, and texts scored together
DENSE = 1024
STEP = 128
THRESHOLD = 0.3
CACHE = 1 << 16


def terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def term_counts(text: str) -> dict[str, int]:
    out: Counter = Counter()
    for word, n in Counter(words_of(text)).items():
        for t in terms_of(word):
            out[t] += n
    return out


def sketches(words: list[str]) -> list[int]:
    """SKETCHES minimum hashes over the word shingles."""
    best = [1 << 32] * SKETCHES
    for i in range(max(1, len(words) - SHINGLE + 1)):
        shingle = " ".join(words[i:i + SHINGLE]).encode()
        for k in range(SKETCHES):
            best[k] = min(best[k], zlib.crc32(shingle, 0x9E3779B1 * (k + 1) & 0xFFFFFFFF))
    return best


def ratio_test(pos: np.ndarray, neg: np.ndarray, positives: float, negatives: float) -> np.ndarray:
    """Likelihood-ratio statistic (G squared) of terms against the class."""
    total = max(positives + negatives, 1e-9)
    seen = pos + neg

    def part(observed, expected):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(observed > 1e-9, observed * np.log(observed / np.maximum(expected, 1e-9)), 0.0)

    return 2 * sum(part(o, e) for o, e in (
        (pos, seen / total * positives), (neg, seen / total * negatives),
        (positives - pos, (1 - seen / total) * positives), (negatives - neg, (1 - seen / total) * negatives)))


class ExampleIndex:
    """Labelled examples as sparse unit vectors over all their terms, compact enough
    to be sent out. ``stands_for`` tells how many labelled rows of its class an
    example stands for, ``witness`` its weight in the test."""

    def __init__(self, ids, labels, terms, counts, stands_for=None, witness=None):
        """``terms`` and ``counts`` are Arrow lists, one per example, ids ascending."""
        import pyarrow.compute as pc
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, float)
        n = len(self.ids)
        self.stands_for = np.ones(n) if stands_for is None else np.array(stands_for, float)
        witness = np.ones(n) if witness is None else np.array(witness, float)
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        coded = terms.flatten().dictionary_encode()
        self.terms = coded.dictionary
        self.term = coded.indices.to_numpy().astype(np.int32)
        count = counts.flatten().to_numpy()
        owner = np.repeat(np.arange(n), sizes)
        width = len(self.terms)
        #: the examples' words, and for each the numbers of its terms: -1 for a
        #: stem that the word is too short for, -2 for one that no example has
        is_word = pc.invert(pc.ends_with(self.terms, "*"))
        self.word = np.flatnonzero(is_word.to_numpy(zero_copy_only=False)).astype(np.int32)
        words = self.terms.filter(is_word)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        self.word_terms = np.empty((len(words), 1 + len(STEMS)), np.int32)
        self.word_terms[:, 0] = self.word
        for i, k in enumerate(STEMS):
            stem = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, k), "*", "")
            found = pc.fill_null(pc.index_in(stem, self.terms), -2).to_numpy(zero_copy_only=False)
            self.word_terms[:, 1 + i] = np.where(size > k, found, -1)
        df = np.bincount(self.term, minlength=width)
        self.rows = n
        pos = np.bincount(self.term, witness[owner] * self.labels[owner], minlength=width)
        neg = np.bincount(self.term, witness[owner] * (1 - self.labels[owner]), minlength=width)
        toxic, clean = float((witness * self.labels).sum()), float((witness * (1 - self.labels)).sum())
        share = toxic / max(toxic + clean, 1e-9)
        speaks = (pos >= MIN_WITNESSES) & (pos >= min(MIN_LIFT * share, (1 + share) / 2) * (pos + neg))
        test = ratio_test(pos, neg, toxic, clean)
        factor = 1 + BOOST * np.where(speaks, np.clip((test - LEAST_TEST) / (FULL_TEST - LEAST_TEST), 0.0, 1.0), 0.0)
        # the toxic share of examples without a term that clearly speaks for the class
        plain = np.bincount(owner[factor[self.term] >= 1 + BOOST / 2], minlength=n) == 0
        plain = self.stands_for * (plain if plain.any() else 1)
        self.base_rate = float((plain * self.labels).sum() / max(plain.sum(), 1e-9))
        #: weight of one occurrence of each term
        self.unit = (np.log((n + 1) / (df + 1)) + 1) * factor
        #: the examples' entries, parts of unit vectors
        self.weight = (1 + np.log(count)) * self.unit[self.term]
        self.weight /= np.sqrt(np.bincount(owner, self.weight * self.weight, minlength=n))[owner]

    @classmethod
    def of_counts(cls, ids, labels, vectors: list[dict[str, int]], **weights) -> ExampleIndex:
        """From one dict of term counts per example."""
        import pyarrow as pa
        order = np.argsort(np.array(ids, np.int64), kind="stable").tolist()
        return cls([ids[i] for i in order], [labels[i] for i in order],
                   pa.array([list(vectors[i]) for i in order], pa.list_(pa.string())),
                   pa.array([list(vectors[i].values()) for i in order], pa.list_(pa.int32())),
                   **{k: [v[i] for i in order] for k, v in weights.items()})


class _Filled(dict):
    """A dict that works out and keeps the value of a key it does not have."""

    def __init__(self, value):
        self.value = value

    def __missing__(self, key):
        found = self[key] = self.value(key)
        return found


class Scorer:
    """Scores texts against an index. Built once per task."""

    def __init__(self, index: ExampleIndex, block: int = BLOCK, dense: int = DENSE):
        self.index, self.block = index, block
        self.whole = np.zeros(len(index.terms))
        self.unseen = math.log(index.rows + 1) + 1
        self._number()
        n, width = index.rows, len(index.terms)
        self.weight = index.weight
        df = np.bincount(index.term, minlength=width)
        frequent = np.argsort(-df, kind="stable")[:dense]
        self.column = np.full(width, -1, np.int32)
        self.column[frequent] = np.arange(len(frequent), dtype=np.int32)
        self.dense = np.zeros((n, len(frequent)), np.float32)
        # largest weight of each frequent term in each block
        blocks = -(-n // block)
        self.maxima = np.zeros((blocks, len(frequent)), np.float32)
        # rare terms: postings by term, the examples of a term ascending
        df[frequent] = 0
        self.posting_start = np.concatenate([[0], np.cumsum(df)])
        free = self.posting_start[:-1].copy()
        self.posting = np.empty(self.posting_start[-1], np.min_scalar_type(n))
        self.posting_weight = np.empty(len(self.posting), np.float32)
        # one block after another, to need little at once
        for b in range(blocks):
            first, last = b * block, min(n, (b + 1) * block)
            part = slice(index.start[first], index.start[last])
            owner = np.repeat(np.arange(first, last), np.diff(index.start[first:last + 1]))
            term, weight = index.term[part], index.weight[part].astype(np.float32)
            where = self.column.take(term)
            often, rare = np.flatnonzero(where >= 0), np.flatnonzero(where < 0)
            self.dense[owner[often], where[often]] = weight[often]
            if len(frequent):
                self.maxima[b] = self.dense[first:last].max(0)
            bits = len(rare).bit_length()
            order = np.sort(term[rare].astype(np.int64) << bits | np.arange(len(rare)))
            term, rare = order >> bits, rare[order & (1 << bits) - 1]
            start = np.flatnonzero(np.diff(term, prepend=-1))
            size = np.diff(start, append=len(term))
            place = np.repeat(free[term[start]] - start, size) + np.arange(len(term))
            self.posting[place], self.posting_weight[place] = owner[rare], weight[rare]
            free[term[start]] += size

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(terms that some example has, weights) of a text; the weights are
        parts of the whole text's unit vector."""
        words = Counter(words_of(text))
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        if len(self.hits) - self.known[0] > CACHE:
            self._forget()
        rows = np.fromiter(map(self.hits.__getitem__, words), np.int64, len(words))
        ids = np.frombuffer(self.rows, np.int32).reshape(-1, 1 + len(STEMS))[rows].ravel()
        held = ids >= 0
        ids = ids[held]
        terms, place = np.unique(ids, return_inverse=True)
        n = np.fromiter(words.values(), float, len(words))
        n = np.bincount(place, np.repeat(n, 1 + len(STEMS))[held], minlength=len(terms))
        known = int(np.searchsorted(terms, len(self.index.unit)))
        weight = (1 + np.log(n)) * np.concatenate([self.index.unit[terms[:known]], np.full(len(terms) - known, self.unseen)])
        norm = math.sqrt(float((weight * weight).sum()))
        return terms[:known], (weight / norm if norm else weight)[:known]

    def _number(self) -> None:
        """Each word's row, and the rows: the numbers of a word's terms, -1 for a
        stem that the word is too short for. The examples' words and stems come
        first; words and stems that no example has are numbered after them."""
        index, rows = self.index, array("i")
        whole, stem = (index.word_terms != -2).all(1), np.ones(len(index.terms), bool)
        stem[index.word] = False
        stem = np.flatnonzero(stem)
        # words of which no example has a stem, as a hand-made index can hold
        partly = dict(zip(index.terms.take(index.word[~whole]).to_pylist(), index.word[~whole].tolist()))
        rows.frombytes(index.word_terms[whole].tobytes())

        def unseen(_) -> int:
            self.numbered += 1
            return self.numbered - 1

        stems = _Filled(unseen)
        stems.update(zip([t[:-1] for t in index.terms.take(stem).to_pylist()], stem.tolist()))

        def row(word: str) -> int:
            size = len(word)
            rows.append(partly[word] if word in partly else unseen(word))
            rows.extend([stems[word[:n]] if size > n else -1 for n in STEMS])
            return len(rows) // (1 + len(STEMS)) - 1

        self.hits, self.stems, self.rows = _Filled(row), stems, rows
        self.hits.update(zip(index.terms.take(index.word[whole]).to_pylist(), itertools.count()))
        self.known, self.numbered = (len(self.hits), len(stems)), len(index.terms)

    def _forget(self) -> None:
        """Words and stems that no example has are numbered anew."""
        for held, known in zip((self.hits, self.stems), self.known):
            while len(held) > known:
                held.popitem()
        del self.rows[self.known[0] * (1 + len(STEMS)):]
        self.numbered = len(self.index.terms)

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[list[tuple[float, int]]]:
        """For each text the k examples of highest cosine above 0, equal ones by
        id: (cosine, example)."""
        n, rows = self.index.rows, len(vectors)
        if not n or not rows:
            return [[] for _ in vectors]
        queries = np.zeros((rows, self.dense.shape[1]), np.float32)
        blocks = len(self.maxima)
        scores = np.zeros((rows, blocks * self.block), np.float32)  # at first the rare terms' part of every cosine
        for i, (terms, weight) in enumerate(vectors):
            at = self.column.take(terms)
            often = at >= 0
            queries[i, at[often]] = weight[often]
            few, w = terms[~often], weight[~often]
            begin = self.posting_start.take(few)
            size = self.posting_start.take(few + 1) - begin
            ends = size.cumsum()
            if len(few) and ends[-1]:
                place = np.repeat(begin - ends + size, size)
                place += np.arange(len(place))
                parts = np.repeat(w, size)
                parts *= self.posting_weight.take(place)
                scores[i, :n] = np.bincount(self.posting.take(place), parts, minlength=n)
        # no score of a block is above its bound
        bounds = queries @ self.maxima.T + scores.reshape(rows, blocks, self.block).max(2) + 1e-5
        best = np.zeros((rows, k), np.float32)
        for b in np.argsort(-bounds.max(0), kind="stable").tolist():
            part = scores[:, b * self.block:min(n, (b + 1) * self.block)]
            need = bounds[:, b] >= best.min(1)
            if need.all():
                part += queries @ self.dense[b * self.block:(b + 1) * self.block].T
                best = np.partition(np.concatenate([best, part], axis=1), part.shape[1], axis=1)[:, -k:]
                continue
            part[~need] = -1.0
            if need.any():
                found = part[need] + queries[need] @ self.dense[b * self.block:(b + 1) * self.block].T
                part[need] = found
                best[need] = np.partition(np.concatenate([best[need], found], axis=1), found.shape[1], axis=1)[:, -k:]
        scores = scores[:, :n]
        least = best.min(1) - 2e-5
        return [self._exact(scores[i], least[i], *vectors[i], k) for i in range(rows)]

    def _exact(self, scores, least, terms, weight, k):
        found = []
        with self._spread(terms, weight) as whole:
            chosen = np.flatnonzero(scores > max(float(least), 0.0))
            start, end = self.index.start[chosen].tolist(), self.index.start[chosen + 1].tolist()
            for e, a, b in zip(chosen.tolist(), start, end):
                found.append((float(whole.take(self.index.term[a:b]) @ self.weight[a:b]), e))
        return sorted(found, key=lambda x: (-round(x[0], 9), x[1]))[:k]

    @contextlib.contextmanager
    def _spread(self, terms, weight):
        """A vector over all terms, in one array that every text uses in turn."""
        self.whole[terms] = weight
        yield self.whole
        self.whole[terms] = 0.0

    def score(self, near: list[tuple[float, int]]) -> float:
        if not self.index.rows:
            return 0.0
        index, base = self.index, self.index.base_rate
        votes = np.array([s ** POWER * index.stands_for[e] for s, e in near])
        toxic = sum(v * index.labels[e] for v, (_, e) in zip(votes, near))
        return float((toxic + SHRINKAGE * base) / (votes.sum() + SHRINKAGE))

    def evidence(self, vector, near, most: int = 5) -> list[str]:
        """The strongest terms that a text shares with its nearest example."""
        if not near:
            return []
        part = slice(self.index.start[near[0][1]], self.index.start[near[0][1] + 1])
        with self._spread(*vector) as whole:
            both = whole[self.index.term[part]] * self.weight[part]
        best = np.argsort(-both, kind="stable")[:most]
        return [self.index.terms[t].as_py() for t in self.index.term[part][best[both[best] > 0]].tolist()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> ExampleIndex:
    """The index of the labelled documents."""
    import pyarrow as pa
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg((F.max(F.col(label_col).cast("int")) == 1).cast("int").alias("label"))
    all_of = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    chosen, _ = spread_sample(marked, "label", "id", max_examples)
    # at most about max_examples rows of two numbers
    rows = written(docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
                   .join(F.broadcast(chosen), "id").select("id", "label", "text"), "toxicity-examples")

    def vectors():
        def batch(ids, rest, texts):
            for i in range(0, len(texts), 256):
                found = [term_counts(t) for t in texts[i:i + 256]]
                yield [ids.slice(i, len(found)), rest[0].slice(i, len(found)), [sketches(words_of(t)) for t in texts[i:i + 256]],
                       [list(f) for f in found], [list(f.values()) for f in found]]

        return batch

    seen = map_texts(rows, vectors, [("sketches", "array<bigint>"), ("terms", "array<string>"), ("counts", "array<int>")],
                     carry=["label"]).toArrow()
    seen = seen.sort_by("id").combine_chunks()
    if not seen.num_rows:
        return ExampleIndex.of_counts([], [], [])
    column = {c: seen.column(c).chunk(0) for c in seen.column_names}
    labels_ = column["label"].to_numpy(zero_copy_only=False)
    # rows that share a sketch at its place: mark k of a row is shared by so many rows
    marks = column["sketches"].flatten().to_numpy().reshape(-1, SKETCHES)
    shared_by = np.stack([np.unique(m, return_inverse=True, return_counts=True)[2][np.unique(m, return_inverse=True)[1]]
                          for m in marks.T], axis=1).max(1)
    held = Counter(labels_.tolist())
    index = ExampleIndex(column["id"].to_numpy(), labels_, column["terms"], column["counts"],
                         stands_for=[max(1.0, all_of[x] / held[x]) for x in labels_.tolist()], witness=1.0 / shared_by)
    del seen, column
    pa.default_memory_pool().release_unused()
    return index


def score(docs: DataFrame, index: ExampleIndex, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] = (), with_evidence: bool = False, models: list | None = None) -> DataFrame:
    """One row per document: id, carried columns, score; on request the
    evidence: ``matched`` terms and the ``neighbours``' ids. The broadcast is
    added to ``models``, for callers that destroy it once the rows are written."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    if models is not None:
        models.append(shared)
    columns = [("score", "double")] + [("matched", "array<string>"), ("neighbours", "array<bigint>")] * with_evidence

    def task():
        scorer = Scorer(shared.value)

        def batch(ids, rest, texts):
            for i in range(0, len(texts), STEP):
                vectors = [scorer.vector(t) for t in texts[i:i + STEP]]
                near = scorer.nearest(vectors)
                out = [ids.slice(i, len(near)), *[c.slice(i, len(near)) for c in rest], [scorer.score(x) for x in near]]
                if with_evidence:
                    out += [[scorer.evidence(v, x) for v, x in zip(vectors, near)],
                            [[int(scorer.index.ids[e]) for _, e in x] for x in near]]
                yield out

        return batch

    return map_texts(docs.select(F.col(id_col), *carry, text_of(text_col).alias("_text")), task, columns,
                     carry=list(carry))


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", threshold: float = THRESHOLD, with_evidence: bool = False) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold; score all rows."""
    index = fit(docs, labels.filter(bucket_of(id_col, FOLDS) != HELD_OUT), id_col, text_col, label_col)
    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"),
                       (bucket_of(id_col, FOLDS) == HELD_OUT).alias("held_out"))
    return score(rows, index, id_col, "text", carry=["held_out"], with_evidence=with_evidence).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
