"""Language-model scoring by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z lowered and one end byte. Each byte is eight
binary decisions, from its highest bit on; each decision has its own context
tree over the ``DEPTH`` bytes before. A node's counts of zeros and ones give the
Krichevsky-Trofimov estimate, and a node's weighted probability is the even
mixture of its own estimate and of the product of its children. The trained
tree then predicts a bit by mixing the estimates of all depths on the path of
the current context, each with its posterior weight. The log10 probability of a
text is the sum over all bits, so the code length per byte follows from it.

Training counts every (DEPTH + 1)-gram of all training documents in Spark, and
the tree keeps them all. Grams are dealt by the last ``CUT`` bytes of their
context, so every task holds whole subtrees and weighs them; the driver gets
only the sums at contexts of ``CUT`` - 1 bytes, whose number the alphabet bounds,
and weighs the few levels above. A second pass over the subtrees gives the log
probability of every distinct gram of all documents, trained or not.

The grams with the largest counts, at most ``MAX_GRAMS``, are looked up in the
scoring pass; the other grams of a document leave it as (row, gram, times) and
meet their probabilities in a join. Which are looked up changes no score.

Word counts of the training documents (for the unigram base) grow with the
corpus and are never broadcast whole. The words with the largest counts, at
most ``MAX_FREQUENT``, are looked up in the scoring pass; the other words of a
document leave it as (row, word, times) and meet their counts in a join. So
neither a frequent word nor a large vocabulary burdens one task.

Defined results: null counts as the empty text, which is one end token.
Repeated rows and null ids are scored one by one. With nothing to learn from,
every bit costs one bit and the base is 0. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import bucket_of, map_texts, text_of, written

FOLDS, HELD_OUT = 7, 2
DEPTH = 5
MAX_GRAMS = 1 << 19
MAX_FREQUENT = 1 << 17
END = b"\xff"
STEP = 1 << 20
FLUSH = 1 << 20
CUT = 3
FOREST = 1 << 17


def mask(n_bytes: int) -> int:
    return (1 << 8 * n_bytes) - 1


def gram_keys(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Key of (depth bytes before, byte) at every byte and the end of each
    text; offsets of the texts' first keys and the end."""
    pad = END * depth
    data = b"".join(pad + t + END for t in texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    # the eight bytes from every place on, of which the first are the key
    n = max(len(data) - depth, 0)
    keys = np.ndarray(n, ">u8", data + bytes(8), strides=(1,)).astype(np.uint64)
    keys >>= np.uint64(56 - 8 * depth)
    keys = keys.view(np.int64)
    # drop the positions inside the padding of the texts after the first
    skip = np.zeros(len(keys) + depth, bool)
    starts = offsets[:-1] + depth * np.arange(len(texts))
    for i in range(depth):
        skip[starts[1:] - depth + i] = True
    return keys[~skip[:len(keys)]], offsets


def grams_by_text(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text, times) of the distinct keys of each text, keys ascending; for
    at most ``texts_of_step(depth)`` texts."""
    keys, offsets = gram_keys(texts, depth)
    bits = np.uint64(max(len(texts) - 1, 0).bit_length())
    both = keys.view(np.uint64) << bits
    both |= np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(offsets))
    both, times = np.unique(both, return_counts=True)
    return (both >> bits).view(np.int64), (both & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64), times


def texts_of_step(depth: int) -> int:
    """How many texts can be numbered beside a key in 64 bits."""
    return 1 << min(16, 56 - 8 * depth)


def tokens_of(data: bytes) -> list[bytes]:
    """Words between blanks, tabs and line ends of the lowered bytes."""
    return data.split()


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a sequence."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - math.log(math.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5: Stirling's series after a shift by six."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for i in range(6):
        shift += np.log(x + i)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (
        1260 * y ** 5) - shift


class ContextTree:
    """The trained tree: per depth the kept contexts, the log10 probability of
    each gram in them, and each decision's probability."""

    def __init__(self, depths: np.ndarray, keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH):
        self.depth = depth
        nodes = [self._nodes(keys[depths == d], counts[depths == d]) for d in range(depth + 1)]
        weights = self._weights(nodes)
        self.contexts, self.grams, self.node_keys, self.ones = [], [], [], []
        above = reach = None
        for d, (node, zero, one) in enumerate(nodes):
            p = (one + 0.5) / (zero + one + 1.0)
            if d == 0:
                above, reach = np.zeros(len(node)), np.ones(len(node))
            else:
                parent = np.searchsorted(nodes[d - 1][0], self._parent(node, d - 1))
                above, reach = above_next[parent], reach_next[parent]  # noqa: F821
            mixed = above + reach * p
            above_next, reach_next = above + reach * weights[d] * p, reach * (1 - weights[d])  # noqa: F841
            self.node_keys.append(node)
            self.ones.append(mixed)
            own = np.sort(keys[depths == d])
            self.contexts.append(np.unique(own >> 8))
            self.grams.append((own, self._of_seen(own, node, mixed)))

    @staticmethod
    def _nodes(keys: np.ndarray, counts: np.ndarray):
        """(sorted decision keys, zeros, ones): context above the bits read.
        In sorted keys the grams of a decision are neighbours."""
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(float)
        found, totals, ones = [], [], []
        for j in range(8):
            group = keys >> 8 - j
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            group = group[starts]
            found.append(group >> j << 8 | 1 << j | group & (1 << j) - 1)
            for out, values in ((totals, counts), (ones, counts * (keys >> 7 - j & 1))):
                out.append(np.add.reduceat(values, starts) if len(starts) else values)
        node = np.concatenate(found)
        order = np.argsort(node)
        one = np.concatenate(ones)[order]
        return node[order], np.concatenate(totals)[order] - one, one

    @staticmethod
    def _parent(node: np.ndarray, d: int) -> np.ndarray:
        """The same decision in the context of d bytes."""
        return (node >> 8 & mask(d)) << 8 | node & 255

    def _weights(self, nodes, first: int = 0) -> list[np.ndarray]:
        """Posterior weight of stopping at each decision's node of the depths
        from ``first`` on."""
        out: list[np.ndarray] = [np.zeros(0)] * (self.depth + 1)
        below = None
        for d in range(self.depth, first - 1, -1):
            node, zero, one = nodes[d]
            own = log_kt(zero, one)
            if below is None or not len(below[0]):
                out[d], weighted = np.ones(len(node)), own
            else:
                parent = np.searchsorted(node, self._parent(below[0], d))
                split = np.bincount(parent, below[1], len(node))
                rest = [np.maximum(x - np.bincount(parent, y, len(node)), 0.0) for x, y in ((zero, below[2]), (one, below[3]))]
                split += log_kt(*rest)
                inner = np.bincount(parent, minlength=len(node)) > 0
                weighted = np.where(inner, np.logaddexp(own, split) - math.log(2), own)
                out[d] = np.where(inner, np.exp(own - math.log(2) - weighted), 1.0)
            below = (node, weighted, zero, one)
        self.roots = below
        return out

    @staticmethod
    def _of_seen(grams: np.ndarray, node: np.ndarray, ones: np.ndarray) -> np.ndarray:
        total = np.zeros(len(grams))
        byte, context = grams & 255, grams >> 8
        for j in range(8):
            p = ones[np.searchsorted(node, context << 8 | 1 << j | byte >> 8 - j)]
            total += np.log10(np.where(byte >> 7 - j & 1, p, 1 - p))
        return total

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Position of each key in a sorted table, -1 if absent."""
        if not len(table):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, at, -1)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each (context, byte) key."""
        out = np.full(len(keys), np.nan)
        left = np.arange(len(keys))
        for d in range(self.depth, -1, -1):
            own = keys[left] & mask(d + 1)
            at = self._find(self.grams[d][0], own)
            out[left[at >= 0]] = self.grams[d][1][at[at >= 0]]
            # unseen in a kept context: decision by decision; else the next shorter context
            unseen = (at < 0) & ((self._find(self.contexts[d], own >> 8) >= 0) | (d == 0))
            if unseen.any():
                out[left[unseen]] = self._by_decision(keys[left[unseen]], d)
            left = left[(at < 0) & ~unseen]
        return out

    def _by_decision(self, keys: np.ndarray, deepest: int) -> np.ndarray:
        total, byte = np.zeros(len(keys)), keys & 255
        for j in range(8):
            p = np.full(len(keys), np.nan)
            bits = 1 << j | byte >> 8 - j
            for d in range(deepest, -1, -1):
                open_ = np.flatnonzero(np.isnan(p))
                at = self._find(self.node_keys[d], (keys[open_] >> 8 & mask(d)) << 8 | bits[open_])
                p[open_[at >= 0]] = self.ones[d][at[at >= 0]]
            p[np.isnan(p)] = 0.5
            total += np.log10(np.where(byte >> 7 - j & 1, p, 1 - p))
        return total


class Top:
    """The levels above ``CUT``: per depth the decisions' nodes, their mixed
    probability, and what a child inherits (above, reach)."""

    def __init__(self, node: np.ndarray, split: np.ndarray, zero: np.ndarray, one: np.ndarray, deepest: int):
        levels = []
        for d in range(deepest, -1, -1):
            own = log_kt(zero, one)
            weighted = np.logaddexp(own, split) - math.log(2)
            levels.insert(0, (node, (one + 0.5) / (zero + one + 1.0), np.exp(own - math.log(2) - weighted)))
            if d:
                node, at = np.unique(ContextTree._parent(node, d - 1), return_inverse=True)
                split, zero, one = (np.bincount(at, x, len(node)) for x in (weighted, zero, one))
        self.node_keys, self.ones = [], []
        for d, (node, p, weight) in enumerate(levels):
            above, reach = np.zeros(len(node)), np.ones(len(node))
            if d:
                parent = np.searchsorted(self.node_keys[-1], ContextTree._parent(node, d - 1))
                above, reach = self.above[parent], self.reach[parent]
            self.node_keys.append(node)
            self.ones.append(above + reach * p)
            self.above, self.reach = above + reach * weight * p, reach * (1 - weight)


class Forest(ContextTree):
    """Whole subtrees below contexts of ``CUT`` bytes, unpruned."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH):
        self.depth, self.first = depth, min(CUT, depth)
        self.nodes = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))] * self.first
        for d in range(self.first, depth + 1):
            own, at = np.unique(keys & mask(d + 1), return_inverse=True)
            self.nodes.append(self._nodes(own, np.bincount(at, counts, len(own))))
        self.weights = self._weights(self.nodes, self.first)

    def sums(self) -> tuple[np.ndarray, ...]:
        """(node, split, zeros, ones) of the contexts one byte shorter."""
        node, weighted, zero, one = self.roots
        parent, at = np.unique(self._parent(node, self.first - 1), return_inverse=True)
        return parent, *(np.bincount(at, x, len(parent)) for x in (weighted, zero, one))

    def scores(self, top: Top, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each key: every decision by its deepest node."""
        self.node_keys, self.ones = list(top.node_keys), list(top.ones)
        above, reach = top.above, top.reach
        for d in range(self.first, self.depth + 1):
            node, zero, one = self.nodes[d]
            parent = np.searchsorted(self.node_keys[-1], self._parent(node, d - 1))
            p = (one + 0.5) / (zero + one + 1.0)
            above, reach = above[parent], reach[parent]
            self.node_keys.append(node)
            self.ones.append(above + reach * p)
            above, reach = above + reach * self.weights[d] * p, reach * (1 - self.weights[d])
        return self._by_decision(keys, self.depth)


def forests(batches, depth: int):
    """(keys, counts) of whole subtrees from batches (gram, n, sub) in the
    order of sub, about ``FOREST`` grams at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(tuple(c.to_numpy() for c in batch.columns))
        size += batch.num_rows
        if size >= FOREST:
            gram, n, sub = (np.concatenate(c) for c in zip(*held))
            end = int(np.searchsorted(sub, sub[-1]))
            if end:
                yield gram[:end], n[:end]
            held, size = [(gram[end:], n[end:], sub[end:])], len(sub) - end if end else 0
    if held:
        yield tuple(np.concatenate(c) for c in list(zip(*held))[:2])


def gram_scores(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n, p): the log10 probability of every counted gram under the
    tree of all grams with n > 0."""
    first = min(CUT, depth)
    dealt = (counts.filter("gram is not null")
             .select("gram", "n", F.shiftright("gram", 8).bitwiseAND(F.lit(mask(first))).alias("sub"))
             .repartition("sub").sortWithinPartitions("sub"))

    def weigh(batches):
        import pyarrow as pa
        for keys, n in forests(batches, depth):
            found = Forest(keys[n > 0], n[n > 0], depth).sums()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["node", "split", "zero", "one"])

    sums = (dealt.mapInArrow(weigh, "node bigint, split double, zero double, one double").groupBy("node")
            .agg(F.sum("split").alias("split"), F.sum("zero").alias("zero"), F.sum("one").alias("one"))
            .orderBy("node").toArrow())
    top = counts.sparkSession.sparkContext.broadcast(Top(*(sums.column(c).to_numpy() for c in range(4)), first - 1))

    def final(batches):
        import pyarrow as pa
        for keys, n in forests(batches, depth):
            p = Forest(keys[n > 0], n[n > 0], depth).scores(top.value, keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n), pa.array(p)], ["gram", "n", "p"])

    return dealt.mapInArrow(final, "gram bigint, n bigint, p double")


def corpus_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(word, gram, n): one kind of key per row, counted over the training
    texts; grams that only other texts have count 0. ``docs`` has the columns
    id, train and text. The number of training documents is the count of the
    row whose keys are both null."""
    def task():
        import pyarrow as pa
        words, grams, held, documents, blank = Counter(), [], 0, 0, []

        def emit():
            nonlocal held
            keys, at = np.unique(np.concatenate([np.zeros(0, np.int64), *(g[0] for g in grams)]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([np.zeros(0, np.int64), *(g[1] for g in grams)])).astype(np.int64)
            for word, gram, n in ((list(words), pa.nulls(len(words), pa.int64()), list(words.values())),
                                  (pa.nulls(len(keys), pa.binary()), pa.array(keys), pa.array(sums))):
                if len(n):
                    yield [*(pa.nulls(len(n), kind) for kind in blank), word, gram, n]
            words.clear()
            grams.clear()
            held = 0

        def batch(ids, rest, texts):
            nonlocal held, documents
            chosen, blank[:] = rest[0].to_pylist(), (ids.type, rest[0].type)
            documents += sum(map(bool, chosen))
            for train in (True, False):
                for part in steps(t.encode().lower() for t, c in zip(texts, chosen) if bool(c) == train):
                    if train:
                        for t in part:
                            words.update(tokens_of(t))
                    distinct, times = np.unique(gram_keys(part, depth)[0], return_counts=True)
                    grams.append((distinct, times * train))
                    held += len(distinct)
                    if held + len(words) > FLUSH:
                        yield from emit()

        def finish():
            yield from emit()
            yield [[None], [None], [None], [None], [documents]]

        batch.finish = finish
        return batch

    found = map_texts(docs, task, [("word", "binary"), ("gram", "bigint"), ("n", "bigint")], carry=["_train"])
    # one emission's keys are distinct: they are dealt as they come and summed where they meet
    return found.repartition("word", "gram").groupBy("word", "gram").agg(F.sum("n").alias("n"))


def steps(texts, most: int = 1 << 16):
    """Runs of texts of about STEP bytes, and at most ``most`` texts."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t) + DEPTH
        if size >= STEP or len(run) >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def threshold(histogram: list[tuple[int, int]], limit: int) -> int:
    """Smallest power of two such that at most ``limit`` entries of the
    histogram (exponent of the count, entries) lie at or above it."""
    total = 0
    for exponent, entries in sorted(histogram, reverse=True):
        total += entries
        if total > limit:
            return 1 << exponent + 1
    return 1


def _exponent(col: str):
    return F.floor(F.log2(F.col(col))).cast("int")


def score(docs: DataFrame, train_filter, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] = (), depth: int = DEPTH) -> DataFrame:
    """One row per document: id, carried columns, n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte."""
    rows = docs.select(F.col(id_col), *carry, text_of(text_col).alias("_text"))
    every = docs.select(F.col(id_col), train_filter.alias("_train"), text_of(text_col).alias("_text"))
    counts = written(corpus_counts(every, depth), "lm-counts")
    words = counts.filter("word is not null").select("word", "n")
    documents = counts.filter("word is null and gram is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    tokens, kinds = tokens + documents, kinds + (documents > 0)
    norm = math.log10(tokens + (kinds + 1))
    least = threshold([(r.e, r.k) for r in words.groupBy(_exponent("n").alias("e")).agg(F.count("n").alias("k"))
                      .collect()], MAX_FREQUENT)
    common = words.filter(F.col("n") >= least).toArrow()
    frequent = dict(zip(common.column("word").to_pylist(),
                        np.log10(common.column("n").to_numpy() + 1.0).tolist()))
    context = docs.sparkSession.sparkContext
    grams = written(gram_scores(counts, depth), "lm-grams")
    least_gram = threshold([(r.e, r.k) for r in grams.filter("n > 0").groupBy(_exponent("n").alias("e"))
                           .agg(F.count("n").alias("k")).collect()], MAX_GRAMS)
    top = grams.filter(F.col("n") >= least_gram).select("gram", "p").toArrow()
    order = np.argsort(top.column("gram").to_numpy())
    shared = context.broadcast((frequent, *(top.column(c).to_numpy()[order] for c in ("gram", "p"))))
    end_known, end_log = int(documents > 0), math.log10(documents + 1)

    def task():
        import pyarrow as pa
        known_words, known_grams, known_logs = shared.value

        def lists(owner, values, n, kind):
            """A list per text of values whose owners ascend."""
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

        def batch(ids, rest, texts):
            first = 0
            for part in steps((t.encode().lower() for t in texts), texts_of_step(depth)):
                n = len(part)
                keys, owner, times = grams_by_text(part, depth)
                at = ContextTree._find(known_grams, keys)
                found = np.flatnonzero(at >= 0)
                logs_of_grams = np.bincount(owner[found], times[found] * known_logs[at[found]], n)
                left = np.flatnonzero(at < 0)
                left = left[np.argsort(owner[left], kind="stable")]
                words = [tokens_of(data) for data in part]
                sizes = np.fromiter(map(len, words), np.int64, n)
                words = list(itertools.chain.from_iterable(words))
                logs = np.fromiter(map(known_words.get, words, itertools.repeat(-1.0)), float, len(words))
                of = np.repeat(np.arange(n), sizes)
                known = logs >= 0
                rare = Counter(zip(of[~known].tolist(), itertools.compress(words, (~known).tolist())))
                of_rare = np.fromiter((k[0] for k in rare), np.int64, len(rare))
                yield [c.slice(first, n) for c in (ids, *rest)] + [
                    sizes + 1, np.bincount(of, known, n).astype(np.int64) + end_known,
                    np.bincount(of, np.where(known, logs, 0.0), n) + end_log,
                    lists(of_rare, [k[1] for k in rare], n, pa.binary()), lists(of_rare, list(rare.values()), n, pa.int64()),
                    logs_of_grams, np.fromiter(map(len, part), np.int64, n) + 1,
                    lists(owner[left], keys[left], n, pa.int64()), lists(owner[left], times[left], n, pa.int64())]
                first += n

        return batch

    scored = map_texts(rows, task, [("n_tokens", "bigint"), ("n_known", "bigint"), ("logs", "double"),
                                    ("rare", "array<binary>"), ("times", "array<bigint>"), ("score", "double"),
                                    ("n_bytes", "bigint"), ("grams", "array<bigint>"),
                                    ("gram_times", "array<bigint>")], carry=list(carry))
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "lm-rows")
    rare = scored.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "_row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    rare = (rare.join(words.filter(F.col("n") < least), "word", "inner").groupBy("_row")
            .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs")))
    left = scored.select("_row", F.explode(F.arrays_zip("grams", "gram_times")).alias("r")).select(
        "_row", F.col("r.grams").alias("gram"), F.col("r.gram_times").alias("times"))
    left = (left.join(grams.filter(F.col("n") < least_gram).select("gram", "p").hint("merge"), "gram")
            .groupBy("_row").agg(F.sum(F.col("times") * F.col("p")).alias("more_score")))
    zero = F.lit(0)
    return (scored.drop("rare", "times", "grams", "gram_times").join(rare, "_row", "left").join(left, "_row", "left")
            .withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
            .select(id_col, *carry, "n_tokens", (F.col("n_known") + F.coalesce("more", zero)).alias("n_known"),
                    F.lit(tokens).cast("bigint").alias("train_tokens"),
                    (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
                    "score", (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte")))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the documents outside the held-out fold; score all."""
    held_out = bucket_of(id_col, FOLDS) == HELD_OUT
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), held_out.alias("held_out"))
    return score(rows, ~F.col("held_out"), id_col, "text", carry=["held_out"])
