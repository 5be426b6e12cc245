"""Document fingerprints by winnowing (native).

Every run of ``k`` bytes of the UTF-8 text (a k-gram) is hashed at every
position. Each window of ``w`` consecutive hashes gives its minimum; among
equal minima the rightmost counts. The fingerprint is the list of these
minima, each with its position (1-based byte offset of the gram). Two texts
that share any run of at least ``w + k - 1`` bytes share a fingerprint entry
(the match guarantee), and entries further apart than ``w`` never occur.

Hash and position share one long, ``(hash << 31) - position``: its minimum is
the smallest hash and, among ties, the rightmost position. Window minima are
taken by doubling (span 1, 2, 4, ... w), so a text costs log2(w) passes over
its hashes, whatever its length, with array functions only.

Defined results: null counts as the empty text, whose fingerprint is empty. A
text shorter than ``k`` bytes has one gram, the whole text; one with fewer than
``w`` grams has one window. Equal texts have equal fingerprints. The likeness
of two empty fingerprints is 1. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callframe.llm.common import text_of, written

K = 16
W = 64
_SPAN = 1 << 31
#: rows per bucket and number of measured id intervals when neighbours are sought
BUCKET_ROWS = 1000
INTERVALS = 64


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """array<bigint>: the selected (hash, position) entries in text order.
    ``w`` must be a power of two."""
    if w & (w - 1):
        raise ValueError("w must be a power of two")

    def grams(b):
        n = F.greatest(F.octet_length(b) - (k - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.shiftleft(
            F.hash(F.substring(b, i, F.lit(k))).cast("bigint"), 31) - i)

    def doubled(span):
        def body(v):
            later = F.slice(v, F.lit(span + 1), F.greatest(F.size(v) - span, F.lit(0)))
            return F.zip_with(v, later, lambda x, y: F.least(x, y))

        return body

    minima = _let(text.cast("binary"), grams)
    for level in range(w.bit_length() - 1):
        minima = _let(minima, doubled(1 << level))
    full = _let(minima, lambda v: F.array_distinct(
        F.slice(v, F.lit(1), F.greatest(F.size(v) - (w - 1), F.lit(1)))))
    return F.when(F.octet_length(text) > 0, full).otherwise(F.array().cast("array<bigint>"))


def continued_fingerprint(entries: Column, kept_bytes: Column, text: Column, k: int = K, w: int = W) -> Column:
    """The fingerprint of ``text``, which begins with the first ``kept_bytes``
    bytes of a text whose fingerprint is ``entries``.

    Every window inside those bytes has the entry that it has there, and entries
    ascend by position with their windows. So only the windows from the last of
    these on are hashed, and the entries before its entry are taken over."""
    start = kept_bytes - (w + k - 2)
    begin = F.greatest(start, F.lit(1))
    tail = fingerprint(F.substring(text.cast("binary"), begin, F.octet_length(text)), k, w)

    def joined(found):
        first = entry_position(found[0])
        return F.when(start >= 1, F.concat(F.filter(entries, lambda e: entry_position(e) < first), found)).otherwise(found)

    return _let(F.transform(tail, lambda e: e - (begin - 1)), joined)


def entry_hash(entry: Column) -> Column:
    return F.shiftright(entry + (_SPAN - 1), 31)


def entry_position(entry: Column) -> Column:
    return F.shiftleft(entry_hash(entry), 31) - entry


def fingerprint_string(entries: Column) -> Column:
    """``hash:position`` entries, blank-separated."""
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(
        ":", F.lower(F.hex(entry_hash(e).cast("int"))), entry_position(e).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the two fingerprints' hash sets."""
    ha, hb = (F.array_distinct(F.transform(x, entry_hash)) for x in (a, b))
    both = F.size(F.array_intersect(ha, hb))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / (F.size(ha) + F.size(hb) - both))


def winnow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           k: int = K, w: int = W) -> DataFrame:
    """(id, entries): one row per document."""
    return docs.select(F.col(id_col), fingerprint(text_of(text_col), k, w).alias("entries"))


def _buckets(docs: DataFrame, id_col: str):
    """(bucket, sub) columns that ascend with the id, about BUCKET_ROWS rows each.

    Quantiles of the ids (INTERVALS numbers, however long the table is) set the
    buckets; each interval is cut evenly into as many sub-buckets as its share
    of the rows needs. Null ids have buckets of their own, by their text."""
    cuts = [i / INTERVALS for i in range(INTERVALS + 1)]
    rows, n, bounds = docs.agg(F.count(F.lit(1)), F.count(id_col),
                               F.percentile_approx(id_col, cuts, 10000)).first()
    bounds = sorted(set(bounds or []))
    parts = max(1, -(-n // (INTERVALS * BUCKET_ROWS)))
    null_parts = max(1, -(-(rows - n) // BUCKET_ROWS))
    edge = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>")
    bucket = F.when(F.col(id_col).isNull(), -1).otherwise(F.size(F.filter(edge, lambda b: b <= F.col(id_col))))
    low, high = F.get(edge, bucket - 1), F.get(edge, bucket)
    sub = F.when(F.col(id_col).isNull(), F.pmod(F.xxhash64("text"), F.lit(null_parts))).otherwise(
        F.coalesce(F.floor((F.col(id_col) - low).cast("double") / (high - low) * parts), F.lit(0)))
    return bucket.alias("bucket"), sub.cast("bigint").alias("sub")


def with_next(docs: DataFrame, id_col: str, derived: dict[str, Column]) -> DataFrame:
    """(id, text, derived columns) of every row, and ``next_<c>`` of each: the
    value of the following row by ascending id (ties by text); the first row
    follows the last. ``docs`` has the id and ``text``.

    Rows meet their neighbour inside a bucket of about a thousand rows, so no
    task sees the whole order. The first row of a bucket also goes, as a guest,
    to the bucket before it. These first ids come from the id column alone; the
    texts are shuffled once. Rows without an id follow each other in rings."""
    bucket, sub = _buckets(docs, id_col)
    placed = docs.select(F.col(id_col).alias("id"), "text", bucket, sub)
    first = placed.filter("id is not null").groupBy("bucket", "sub").agg(F.min("id").alias("id"))
    in_interval = Window.partitionBy("bucket").orderBy("sub")
    starts = first.withColumn("before", F.lag("sub").over(in_interval))
    ends = first.groupBy("bucket").agg(F.max("sub").alias("last"))  # one row per interval
    order = Window.orderBy("bucket")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("bucket", F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(every)).alias("b0"),
                       F.coalesce(F.lag("last").over(order), F.last("last").over(every)).alias("s0"))
    guests = written(starts.join(ends, "bucket").select(
        "id", F.when(F.col("before").isNull(), F.col("b0")).otherwise(F.col("bucket")).alias("bucket"),
        F.coalesce("before", "s0").alias("sub")), "bucket-starts")
    plain = docs.select(F.col(id_col).alias("id"), "text")
    rows = (placed.select("bucket", "sub", F.lit(False).alias("guest"), "id", "text", *derived_columns(derived))
            .unionByName(plain.join(guests, "id").select("bucket", "sub", F.lit(True).alias("guest"), "id", "text",
                                                         *derived_columns(derived))))
    around = Window.partitionBy("bucket", "sub").orderBy("guest", "id", "text")
    carry = ["text", *derived]
    rows = rows.withColumns({f"next_{c}": F.coalesce(F.lead(c).over(around), F.first(c).over(around)) for c in carry})
    return rows.filter("not guest").select(F.col("id").alias(id_col), *carry, *[f"next_{c}" for c in carry])


def derived_columns(derived: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in derived.items()]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        k: int = K, w: int = W) -> DataFrame:
    """Each document's fingerprint beside that of its edited text (the last
    quarter of its code points replaced by the start of the next document)."""
    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"))
    rows = with_next(rows, id_col, {"entries": fingerprint(F.col("text"), k, w)})
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("kept", F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")))
    rows = rows.withColumns({"edited": F.concat("kept", F.substring("next_text", F.lit(1), cut)),
                             "kept_bytes": F.octet_length("kept")})
    rows = rows.withColumn("edited_entries", continued_fingerprint(F.col("entries"), F.col("kept_bytes"), F.col("edited"), k, w))
    return rows.select(
        id_col, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_string(F.col("entries")).alias("fingerprint"),
        fingerprint_string(F.col("edited_entries")).alias("edited_fingerprint"),
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        likeness(F.col("entries"), F.col("next_entries")).alias("near_next"))
