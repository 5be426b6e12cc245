"""Spelling variants: words one edit apart, grouped under their commonest form.

Words are gathered and counted in Spark. Candidates meet in groups: a single
edit between two words whose longer one has N characters lies in one of
``SEGMENTS`` segments of its N positions, and both words are equal before and
after that segment. So a word joins, for N its own length and N one more, one
group per segment, keyed by N, the segment and all its other characters. A
group of more than ``TILE`` words is dealt again, one group per position of its
segment; such a group differs in one character only, so it holds at most as
many words as there are letters. All groups are therefore bounded without
dropping a word, whatever the data.

Inside a task, the groups with one N are a dense matrix of code points, padded
at the end (for prefixes) and at the front (for suffixes). Tiles of this matrix
are compared block by block: two words are one edit apart exactly if their
common prefix and common suffix together reach N - 1. A pair that meets in
several segments is taken from the first one, so every link appears once.

Each word's near words are then reduced (count, commonest; ties to the smallest
in code-point order) by map-side aggregates, and roots are found by pointer
doubling over the words that have a form.

Defined results: a null text has no runs; a null id is written as the empty
text in ``<id>:<run>``. Repeated rows count each time. Words hold only code
points below U+0100, one byte each in a tile. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import text_of, written

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: one of so many runs loses a character (planted misspellings)
SLIP = 31
SEGMENTS = 4
#: largest group compared as it is, and bytes compared at once
TILE = 512
CELLS = 1 << 22
#: words of whole groups held as one matrix
MEMBERS = 1 << 14
LETTERS = r"[A-Za-zÀ-ÿ]"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
          min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): distinct results of the runs and their occurrences."""
    lowered = F.translate(text_of(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # shorter runs give no word; the quantifier is greedy, so matches are maximal runs
    runs = F.regexp_extract_all(lowered, F.lit(f"({LETTERS}{{{min_length},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(h % slip == 0, cut).otherwise(F.col("run"))
    return (rows.select(word.alias("word")).filter(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count("word").alias("n")).filter(F.col("n") >= min_count))


def in_groups(rows: DataFrame) -> DataFrame:
    """Adds the group's key: a hash of the characters before position ``left``
    and, counted from the word's end, from position ``right`` of ``big`` on.
    Words of other groups with an equal hash only cost a comparison."""
    size = F.char_length("word")
    before = F.substring("word", F.lit(1), F.col("left"))
    after = F.substring("word", F.col("right") - F.col("big") + size + 1, size)
    return rows.withColumn("key", F.xxhash64("big", "left", "right", before, after))


def word_groups(found: DataFrame, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(key, big, left, right, members array<(word, n)>): the groups of two
    words or more, each of at most ``tile`` words or one open position."""
    size = F.char_length("word")
    rows = (found.select("word", "n", F.explode(F.array(size, size + 1)).alias("big"))
            .select("word", "n", "big", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("j"))
            .select("word", "n", "big", F.expr(f"cast(j * big div {segments} as int)").alias("left"),
                    F.expr(f"cast((j + 1) * big div {segments} as int)").alias("right"))
            .filter("left < right"))
    group = ["key", "big", "left", "right"]

    def shared(rows):
        held = rows.groupBy(*group).agg(F.count("word").alias("held")).filter("held > 1")
        return written(rows.join(held.hint("merge"), group), "spelling-groups")

    def listed(rows):
        return rows.groupBy(*group).agg(F.collect_list(F.struct("word", "n")).alias("members"))

    rows = shared(in_groups(rows))
    large = f"held > {tile} and right - left > 1"
    fine = (rows.filter(large).select("word", "n", "big", F.explode(F.sequence(F.col("left"), F.col("right") - 1)).alias("left"))
            .withColumn("right", F.col("left") + 1))
    return listed(rows.filter(f"not ({large})")).unionByName(listed(shared(in_groups(fine))))


def tiles(words: list[bytes], big: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``big`` characters as two matrices, padded at the end
    and at the front."""
    shape = (len(words), big)
    return (np.array(words, f"S{big}").view(np.uint8).reshape(shape),
            np.array([w.rjust(big, b"\x00") for w in words], f"S{big}").view(np.uint8).reshape(shape))


def compare_tiles(front: np.ndarray, back: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix and suffix lengths of the pairs of rows (one[i], two[i])."""
    prefix, suffix = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    big = front.shape[1]
    step = max(1, CELLS // big)
    for i in range(0, len(one), step):
        a, b = one[i:i + step], two[i:i + step]
        differ = front[a] != front[b]
        prefix[i:i + step] = np.where(differ.any(1), differ.argmax(1), big)
        differ = (back[a] != back[b])[:, ::-1]
        suffix[i:i + step] = np.where(differ.any(1), differ.argmax(1), big)
    return prefix, suffix


def group_pairs(sizes: np.ndarray, cells: int):
    """(row, row) of all pairs inside consecutive groups of the given sizes, in
    blocks of about ``cells`` pairs: block after block of first rows, each with
    the rows of its group that follow."""
    start = np.cumsum(sizes) - sizes
    follow = np.repeat(start + sizes, sizes) - np.arange(sizes.sum()) - 1
    first = np.flatnonzero(follow)
    for block in np.split(first, np.searchsorted(np.cumsum(follow[first]), np.arange(cells, int(follow.sum()), cells))):
        n = follow[block]
        one = np.repeat(block, n)
        yield one, one + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def near_pairs(groups: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """(a, a_n, b, b_n): words one edit apart among the groups (big, left,
    right, members array<(word, n)>), each pair once over all groups."""
    def slices(batches):
        """Whole groups, about ``MEMBERS`` words at a time."""
        for batch in batches:
            held = np.cumsum(batch.column(3).value_lengths().to_numpy())
            cut = np.unique(np.searchsorted(held, np.arange(MEMBERS, held[-1] if len(held) else 0, MEMBERS), "left") + 1)
            for a, b in zip([0, *cut], [*cut, len(held)]):
                if b > a:
                    yield batch.slice(a, b - a)

    def run(batches):
        import pyarrow as pa
        for batch in slices(batches):
            big, left, right = (batch.column(i).to_numpy() for i in range(3))
            size = batch.column(3).value_lengths().to_numpy()
            members = batch.column(3).flatten()
            names, counts = members.field(0), members.field(1)
            owner = np.repeat(np.arange(len(size)), size)
            for n in np.unique(big).tolist():
                rows = np.flatnonzero((big == n)[owner])
                words = [w.encode("latin-1") for w in names.take(pa.array(rows)).to_pylist()]
                length = np.array([len(w) for w in words])
                front, back = tiles(words, n)
                lo, hi = left[owner[rows]], right[owner[rows]]
                bounds = np.arange(segments + 1) * n // segments
                for one, two in group_pairs(size[big == n], CELLS // 8):
                    longer = np.maximum(length[one], length[two]) == n
                    one, two = one[longer], two[longer]
                    prefix, suffix = compare_tiles(front, back, one, two)
                    near = prefix + suffix >= n - 1
                    one, two, suffix = one[near], two[near], suffix[near]
                    # both agree outside a segment from the first whose end reaches n - suffix
                    end = hi[one]
                    first = np.where(end - lo[one] == 1, end == n - suffix,
                                     end == bounds[np.searchsorted(bounds, n - suffix)])
                    one, two = pa.array(rows[one[first]]), pa.array(rows[two[first]])
                    yield pa.RecordBatch.from_arrays([names.take(one), counts.take(one), names.take(two), counts.take(two)],
                                                     ["a", "a_n", "b", "b_n"])

    return groups.select("big", "left", "right", "members").mapInArrow(run, "a string, a_n bigint, b string, b_n bigint")


def roots(forms: DataFrame, most: int, ratio: int = RATIO) -> DataFrame:
    """(word, root) of the words (word, form) that have a form, by pointer
    doubling. A form occurs at least ``ratio`` times as often, so ``most``, the
    largest count, bounds the steps."""
    jump, steps = forms.select("word", F.col("form").alias("root")), max(1.0, math.log(max(2, most), ratio))
    for _ in range(math.ceil(math.log2(steps))):
        jump = written(jump, "spelling-roots")
        onward = jump.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jump = jump.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return jump


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO,
                      tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    found = written(words(docs, id_col, text_col), "spelling-words")
    pairs = near_pairs(word_groups(found, tile=tile))
    one = F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    two = F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    best = (pairs.select(F.explode(F.array(one, two)).alias("link")).select("link.*").groupBy("word")
            .agg(F.count("near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    enough = -F.col("best.less") >= ratio * F.col("n")
    linked = written(found.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-near")
    most = found.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    root = roots(linked.filter("form is not null").select("word", "form"), most, ratio)
    return linked.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
