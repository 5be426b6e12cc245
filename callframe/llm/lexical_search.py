"""Ranked lexical search by dense blocked matrix multiplication.

The terms of the queries (``items``) are a compact vocabulary. One pass over
the documents counts each document's terms and keeps those of the vocabulary;
the statistics of the corpus (documents, terms, document frequencies) are sums
over all documents. Then every task multiplies tiles: a tile of items (rows)
times vocabulary (weights) with a tile of vocabulary times documents (integer
impacts), in float64 by BLAS. All entries are integers and a vocabulary tile is
so narrow that no partial sum reaches 2^53, so every product is exact; tiles
are added as 64-bit integers. A tile's best ``k`` documents of each item are
chosen with all ties of the k-th score and merged by (score, id), so equal
scores never depend on the partitioning. Each task returns at most ``k`` rows
an item; these are ranked in two rounds.

A term is a maximal run of characters other than ASCII control characters,
space and punctuation; only A-Z are lower-cased. With N the documents that have
a term, L all terms, n those of a document, df the documents with a term and tf
its occurrences in the document: a term's weight is
floor(1000 ln((2N + 2) / (2 df + 1))), a document's length mark is
m = 10 + (90 n N div L), and the score is the sum over the item's distinct terms
of weight * (10^9 tf div (1000 tf + 8 m)).

Items are taken in blocks whose dense weight tiles hold at most ``PASS_CELLS``
numbers; each block is one pass, so neither the driver nor a task holds more.

Defined results: a null or empty text has no terms: as a document it is not
counted and never found, as an item it gives no rows. Every row is a document
or an item of its own, also if ids repeat; a null id comes after all others
among equal scores. Document ids are integers. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callframe.llm.common import text_of, written

K = 10
#: numbers in the weight tiles of one pass, items and vocabulary of one tile, documents of one tile
PASS_CELLS = 1 << 23
ITEM_TILE = 256
VOCABULARY_TILE = 4096
DOCUMENT_TILE = 512
#: largest impact of a term in a document: 10^9 tf div (1000 tf + 8 m) < 10^6
IMPACT = 10 ** 6
#: first-round groups per item when the tasks' rows are ranked
SPREAD = 64

_SPACE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_SPACE).split()


class ItemTile:
    """Up to ``ITEM_TILE`` items over their own compact vocabulary."""

    def __init__(self):
        self.rows, self.items = [], []
        self.vocabulary: dict[bytes, int] = {}

    def cells(self, words=()) -> int:
        return (len(self.rows) + bool(words)) * (len(self.vocabulary) + sum(w not in self.vocabulary for w in words))

    def add(self, row: int, words: set[bytes]) -> None:
        self.rows.append(row)
        self.items.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in sorted(words)])

    def weights(self, weight: np.ndarray) -> np.ndarray:
        """Dense weights, items x vocabulary; ``weight`` is that of each word."""
        out = np.zeros((len(self.items), len(self.vocabulary)))
        for row, words in enumerate(self.items):
            out[row, words] = weight[words]
        return out


def item_blocks(items: DataFrame, item_id: str, item_text: str, cells: int = PASS_CELLS):
    """Blocks (ids of the items, tiles), read one after another."""
    ids, tiles = [], [ItemTile()]
    for item, text in items.select(item_id, text_of(item_text).cast("binary")).toLocalIterator():
        words = set(terms(bytes(text)))
        if not words:
            continue
        if len(tiles[-1].rows) == ITEM_TILE:
            tiles.append(ItemTile())
        if ids and sum(t.cells() for t in tiles[:-1]) + tiles[-1].cells(words) > cells:
            yield ids, tiles
            ids, tiles = [], [ItemTile()]
        tiles[-1].add(len(ids), words)
        ids.append(item)
    if ids:
        yield ids, tiles


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, term array<int>, tf array<bigint>) of every document: all its
    terms counted, those of the vocabulary listed."""
    def run(batches):
        import pyarrow as pa
        known = vocabulary.keys()
        for batch in batches:
            n, size, term, tf = [], [0], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                count = Counter(words)
                found = sorted(vocabulary[w] for w in count.keys() & known)
                back = {vocabulary[w]: count[w] for w in count.keys() & known}
                n.append(len(words))
                term += found
                tf += [back[t] for t in found]
                size.append(len(term))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(size, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(size, pa.array(tf, pa.int64()))], ["id", "n", "term", "tf"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).cast("binary").alias("text")).mapInArrow(
        run, "id bigint, n bigint, term array<int>, tf array<bigint>")


class Best:
    """The best ``k`` documents of each item so far, ties by id (null last)."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.item = self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, first_item: int, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of a tile, items x documents; ``first_item`` is its first row."""
        last = slice(first_item, first_item + len(scores))
        least = self.floor[last]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, col = np.nonzero(scores >= least[:, None])
        if not len(row):
            return
        item = np.concatenate([self.item, row + first_item])
        score = np.concatenate([self.score, scores[row, col]])
        key, gone = np.concatenate([self.id, ids[col]]), np.concatenate([self.null, null[col]])
        order = np.lexsort((key, gone, -score, item))
        item = item[order]
        start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
        order, item, full = order[rank < self.k], item[rank < self.k], rank[rank < self.k] == self.k - 1
        self.item, self.score, self.id, self.null = item, score[order], key[order], gone[order]
        self.floor[item[full]] = self.score[full]


def tile_width(weight: np.ndarray) -> int:
    """Words of a vocabulary tile: width * largest weight * IMPACT < 2^53."""
    return max(1, min(VOCABULARY_TILE, (2 ** 53 - 1) // (IMPACT * max(1, int(weight.max(initial=0))))))


def rank_counts(counts: DataFrame, tiles: list[ItemTile], vocabulary: dict[bytes, int], df: np.ndarray,
                n_docs: int, n_terms: int, k: int = K) -> DataFrame:
    """(item, id, score): each task's best documents of every item (its row in
    the block), from the ``term_counts`` of the documents."""
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    width, n_items = tile_width(weight), sum(len(t.rows) for t in tiles)
    # word of the block -> column of the tile
    columns = [np.full(len(vocabulary), -1, np.int64) for _ in tiles]
    for column, tile in zip(columns, tiles):
        column[[vocabulary[w] for w in tile.vocabulary]] = np.arange(len(tile.vocabulary))

    def run(batches):
        import pyarrow as pa
        best = Best(n_items, k)
        dense = [t.weights(weight[[vocabulary[w] for w in t.vocabulary]]) for t in tiles]
        for whole in batches:
            for batch in (whole.slice(i, DOCUMENT_TILE) for i in range(0, whole.num_rows, DOCUMENT_TILE)):
                null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = batch.column(0).fill_null(0).to_numpy()
                mark = np.array([10 + 90 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
                held = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(ids)), held)
                term, tf = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
                impact = 10 ** 9 * tf // (1000 * tf + 8 * mark[doc])
                for weights, column, tile in zip(dense, columns, tiles):
                    at = column[term]
                    scores = np.zeros((len(weights), len(ids)), np.int64)
                    for left in range(0, weights.shape[1], width):
                        part = weights[:, left:left + width]
                        inside = (at >= left) & (at < left + part.shape[1])
                        impacts = np.zeros((part.shape[1], len(ids)))
                        impacts[at[inside] - left, doc[inside]] = impact[inside]
                        scores += (part @ impacts).astype(np.int64)
                    best.add(scores, tile.rows[0], ids, null)
        if len(best.item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.item.astype(np.int32)), pa.array(best.id, mask=best.null), pa.array(best.score)],
                ["item", "id", "score"])

    return counts.mapInArrow(run, "item int, id bigint, score bigint")


def ranked(rows: DataFrame, k: int = K) -> DataFrame:
    """The best ``k`` rows (item, id, score) of each item with their rank, in
    two rounds, so that no group holds the rows of all tasks."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    some = Window.partitionBy("item", "part").orderBy(*order)
    rows = (rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
            .withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k))
    return (rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .filter(F.col("rank") <= k).select("item", "rank", "id", "score"))


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", k: int = K, cells: int = PASS_CELLS) -> DataFrame:
    """(item id, rank, document id, score): the ``k`` best documents of each
    item with a score above 0."""
    spark, out = docs.sparkSession, None
    id_type = items.schema[item_id].dataType
    for ids, tiles in item_blocks(items, item_id, item_text, cells):
        vocabulary: dict[bytes, int] = {}
        for tile in tiles:
            for word in tile.vocabulary:
                vocabulary.setdefault(word, len(vocabulary))
        counts = written(term_counts(docs, vocabulary, id_col, text_col), "search-counts")
        n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for term, n in counts.select(F.explode("term").alias("term")).groupBy("term").count().collect():
            df[term] = n
        names = spark.createDataFrame(list(enumerate(ids)), "item int, name " + id_type.simpleString())
        best = ranked(rank_counts(counts, tiles, vocabulary, df, n_docs, n_terms, k), k)
        found = best.join(F.broadcast(names), "item").select(
            F.col("name").alias(item_id), "rank", F.col("id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.select(F.lit(None).cast(id_type).alias(item_id), F.lit(0).alias("rank"),
                           F.col(id_col).cast("bigint").alias(id_col), F.lit(0).cast("bigint").alias("score")).limit(0)
    return out
