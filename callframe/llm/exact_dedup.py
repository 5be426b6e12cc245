"""Exact deduplication by a tree merge of sorted digest runs (native).

Every input partition first reduces its own rows to one run: one entry per
distinct text with the chosen identifier and the number of rows (Spark's
map-side partial aggregate). The runs then meet in rounds. In each round
``fan_in`` runs merge into one: rows are exchanged on (run // fan_in, digest),
so a merged run is itself spread over all tasks by digest, and a text that
holds a third of the table arrives as at most ``fan_in`` entries per run, not
as its rows. After the last round one run is left, one entry per text.

An entry's key is the SHA-256 of the whole text together with its byte length
and an independent 64-bit hash. Entries merge only if all three agree, so
every level verifies what it merges; two texts with one SHA-256 but different
check values stay apart.

Defined results: a null text counts as the empty text. A null id is never
preferred over another id. Rows that repeat both id and text are one document
stored twice: each counts in ``group_size`` and each has the same ``kept``.
An empty table gives an empty result. Other columns are not read, so their
names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import text_of, written

LEAF_RUNS = 64
FAN_IN = 8
_KEY = ("digest", "n_bytes", "check")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, n_bytes, check) of every row's whole text."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)).alias("digest"),
        F.octet_length(text_of(text_col)).alias("n_bytes"),
        F.xxhash64(text_of(text_col)).alias("check"))


def merge_runs(rows: DataFrame, keep: str = "largest", leaf_runs: int = LEAF_RUNS,
               fan_in: int = FAN_IN) -> DataFrame:
    """One entry (key columns, keep_id, group_size) per distinct text."""
    best = F.max if keep == "largest" else F.min
    runs = leaf_runs
    merged = rows.select(*_KEY, F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                         F.pmod(F.spark_partition_id(), F.lit(leaf_runs)).alias("run"))
    while runs > 1:
        runs = -(-runs // fan_in)
        keys = [*_KEY] if runs == 1 else [F.floor(F.col("run") / fan_in).cast("int").alias("run"), *_KEY]
        merged = merged.groupBy(*keys).agg(best("keep_id").alias("keep_id"),
                                           F.sum("group_size").alias("group_size"))
    return merged


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Only texts that occur more than once are joined back; every other row
    keeps itself. The joined side is a written table, so Spark knows its size
    and can split the rows of a very frequent text over many tasks."""
    groups = written(merge_runs(digests(docs, id_col, text_col), keep).filter("group_size > 1"),
                     "exact-groups")
    rows = digests(docs, id_col, text_col)
    return (rows.join(groups, list(_KEY), "left")
            .select(F.col("id").alias(id_col),
                    F.coalesce("keep_id", "id").alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                    F.col("id").eqNullSafe(F.coalesce("keep_id", "id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """The documents that stay, with all their columns and exactly one row
    per text (of rows repeating both id and text, one).

    The rows that go are known by id and digest, so a very frequent text is
    spread by its ids. Their number grows with the corpus: they are merged,
    never broadcast, and each text is moved once."""
    gone = exact_dedup(docs, id_col, text_col, keep).filter("not kept").select(
        F.col(id_col).alias("id"), F.unhex("text_sha256").alias("digest"))
    gone = written(gone, "exact-gone").select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("id"),
                       F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)).alias("digest"))
    same = (F.col("digest") == F.col("gone_digest")) & F.col("id").eqNullSafe(F.col("gone_id"))
    return rows.join(gone.hint("merge"), same, "left_anti").dropDuplicates(["id", "digest"]).select("row.*")
