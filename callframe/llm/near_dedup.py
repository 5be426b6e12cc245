"""Near-duplicate detection by ProbMinHash, banding and verification.

Equal texts are one node, the 128-bit digest of the text. A node is the
weighted set of its five-word shingles (weight: 1 + ln of the times it holds
one). Every shingle sends points of a Poisson process whose rate is its weight:
exponential arrival times, each at a register chosen by the point's hash. A
register keeps the shingle of its earliest arrival, so two texts agree in a
register with the probability Jaccard similarity of their sets. Arrivals grow,
so a shingle stops once it is later than every register's earliest (early
termination): after a few rounds only few shingles are still sending.

``BANDS`` bands of ``ROWS`` registers put texts with an equal band into a
bucket. First every member is compared with its bucket's leader, the smallest
digest; then, in ``SWEEPS`` sweeps, buckets that still hold several classes are
dealt at random into parts of about ``PART`` members, and members of other
classes are compared with their part's leader. These cheap links join most of a bucket at
one pair per member and sweep. The rest is settled exactly: the members of
buckets that still hold several classes are joined on the rarest shingles of
their sets (prefix, length and position filters, which lose no pair at
``SIMILARITY``), and all pairs of different classes that remain are candidates.
So every two texts of one bucket that are near copies end in one class. Every
candidate pair is verified on the shingle sets of the whole texts: at least
``SIMILARITY`` of their union is shared. Classes are the connected components
of verified links, found in rounds of large and small stars, each written to
the shared folder.

Defined results: null counts as the empty text. A text of fewer than five words
is one shingle, all its words; a text without words is like no other. Repeated
rows and copies share their class. A class is named by its smallest id (null
only if it has none), and by the smallest key of the texts with that id. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import map_texts, text_of, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
SWEEPS = 2
PART = 64
STEP = 1 << 18
#: slots in which shingles are counted to find an order, rarest first
SLOTS = 1 << 20
#: bits of the bitmap of keys that texts are held against before they move (4 MB)
BITS = 1 << 25
#: bytes of a word beyond which a polynomial does not tell it apart
LONG_WORD = 24
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_POLY = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_POLY, pow(_POLY, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word (between white space); that of a word of more
    than ``LONG_WORD`` bytes is a cut of its BLAKE2 digest."""
    words = text.split()
    if len(words) < 64:
        return np.array([_word_hash(w.encode()) for w in words], np.uint64)
    data = np.frombuffer((" ".join(words) + " ").encode(), np.uint8)
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])])
    out = mix((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[i] = _word_hash(data[starts[i]:ends[i]].tobytes())
    return out


def _word_hash(data: bytes) -> int:
    if len(data) > LONG_WORD:
        return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")
    return int(mix(np.array([_poly(data)], np.uint64))[0])


def _poly(data: bytes) -> int:
    total, power = 0, 1
    for b in data:
        total = (total + (b + 1) * power) & (1 << 64) - 1
        power = power * _POLY & (1 << 64) - 1
    return total


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs."""
    h = word_hashes(text)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(size, len(h))):
        out = mix(out * _A + h[i:i + n] + np.uint64(i + 1))
    return np.unique(out, return_counts=True)


def prob_min_hash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """Signatures (uint64, one row per set; 0 for the empty set)."""
    n = len(sets)
    earliest = np.full(n * registers, np.inf)
    holder = np.zeros(n * registers, np.uint64)
    shingle = np.concatenate([s for s, _ in sets]) if n else np.zeros(0, np.uint64)
    weight = 1 + np.log(np.concatenate([c for _, c in sets])) if n else np.zeros(0)
    owner = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    time, turn = np.zeros(len(shingle)), 0  # of each shingle's last arrival
    while len(shingle):
        turn += 1
        point = mix(shingle + np.uint64(turn * int(_A) & (1 << 64) - 1))
        time = time - np.log(((point >> np.uint64(11)).astype(float) + 1) * 2.0 ** -53) / weight
        slot = owner * registers + (mix(point) % np.uint64(registers)).astype(np.int64)
        better = time < earliest[slot]
        if better.any():
            # the earliest arrival of each register among this round's points
            order = np.lexsort((time[better], slot[better]))
            slots, first = np.unique(slot[better][order], return_index=True)
            earliest[slots] = time[better][order][first]
            holder[slots] = shingle[better][order][first]
        latest = earliest.reshape(n, registers).max(1)
        alive = time < latest[owner]
        shingle, weight, owner, time = shingle[alive], weight[alive], owner[alive], time[alive]
    return holder.reshape(n, registers)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, text): key is the text's 128-bit digest."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))


def signatures(rows: DataFrame) -> DataFrame:
    """(key, id, bands, size) of each row: size counts its distinct shingles; a
    text without words has no bands."""
    def task():
        def batch(keys, rest, texts):
            held, size, first = [], 0, 0
            for i, text in enumerate(texts):
                held.append(shingles(text))
                size += len(held[-1][0])
                if size >= STEP or i + 1 == len(texts):
                    sig = prob_min_hash(held).reshape(len(held), BANDS, ROWS)
                    key = np.zeros((len(held), BANDS), np.uint64)
                    for r in range(ROWS):
                        key = mix(key * _A + sig[:, :, r])
                    key = mix(key + np.arange(1, BANDS + 1, dtype=np.uint64) * _A).view(np.int64)
                    yield [keys.slice(first, len(held)), rest[0].slice(first, len(held)),
                           [k.tolist() if len(s[0]) else [] for k, s in zip(key, held)], [len(s[0]) for s in held]]
                    held, size, first = [], 0, i + 1

        return batch

    return map_texts(rows.select("key", "id", "text"), task, [("bands", "array<bigint>"), ("size", "int")], carry=["id"])


def possible(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key can be one of ``keys``, told by a bitmap of the keys'
    hashes that every task gets (``BITS`` bits, whatever the corpus): it may let
    others pass and loses none."""
    slot = F.pmod(F.xxhash64("key"), F.lit(BITS))
    bits = (keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits")))
    at = rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_bit": F.bitmap_bit_position(slot).cast("int")})
    byte = F.expr("cast(conv(hex(substring(_bits, _bit div 8 + 1, 1)), 16, 10) as int)")
    return (at.join(F.broadcast(bits), "_bucket").withColumn("_byte", byte)
            .filter("shiftright(_byte, _bit % 8) % 2 = 1").select(*rows.columns))


def shingle_sets(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, s) of the texts named by ``keys``: their shingles' 32-bit hashes.

    Most texts that are not named, and all but one copy per task, are left out
    before anything moves, and each remaining text is moved once. The keys grow with the corpus, so they are
    merged, never broadcast."""
    def task():
        def batch(keys, _, texts):
            yield [keys, [(shingles(t)[0] >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist() for t in texts]]

        return batch

    texts = possible(rows, keys).groupBy("key").agg(F.first("text").alias("text"))
    return map_texts(texts.join(keys.hint("merge"), "key", "left_semi"), task, [("s", "array<int>")])


def sizes_allow(a: str, b: str, similarity: float):
    """Sets of these sizes can share ``similarity`` of their union; pairs of other
    sizes are left out before any set moves."""
    return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose shingle sets share at least ``similarity`` of
    their union."""
    both = (pairs.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")).hint("merge"), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")).hint("merge"), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= similarity * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(key, label) of the nodes that have links (a, b): the label is the
    smallest key of the connected component. Nodes are linked in rounds to the
    smallest node around them, larger neighbours first (large star), then the
    rest (small star), until a round changes nothing."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = written(small, "near-links")
        before, state = state, edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == state:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("key"), F.col("v").alias("label")).distinct())


def prefixes(sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, label, size, x, pos, short) of the sets (key, label, s): the
    shingles x among which a set shares one with every set at ``similarity``.

    Shingles are ordered by the count of their slot (any order gives the same
    pairs; rare ones first give few candidates). Of n shingles the first
    n - t n + 1 meet all sets that are not larger, and already the first
    n - 2 t n / (1 + t) + 1 (``short``) all that are not smaller. A shingle
    alone in its slot is in no other set."""
    spark = sets.sparkSession
    counted = (sets.select(F.explode("s").alias("x")).groupBy(F.pmod("x", F.lit(SLOTS)).alias("slot"))
               .agg(F.count("x").alias("n")).toArrow())
    counts = np.zeros(SLOTS, np.int64)
    counts[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                x = batch.column(2).flatten().to_numpy()
                owner = np.repeat(np.arange(len(size)), size)
                count = shared.value[x & (SLOTS - 1)]
                order = np.lexsort((x, count, owner))
                x, count = x[order], count[order]
                pos = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
                n = size[owner]
                long = n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1
                short = n - np.ceil(2 * similarity / (1 + similarity) * n - 1e-9).astype(np.int64) + 1
                at = np.flatnonzero((pos < long) & (count > 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner[at])), batch.column(1).take(pa.array(owner[at])),
                     pa.array(n[at], pa.int32()), pa.array(x[at], pa.int32()), pa.array(pos[at], pa.int32()),
                     pa.array(pos[at] < short[at])], ["key", "label", "size", "x", "pos", "short"])

    return sets.select("key", "label", "s").mapInArrow(
        run, "key binary, label binary, size int, x int, pos int, short boolean")


def open_pairs(sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Candidates (a, b) among the sets (key, label, s): all pairs of different
    labels that can share ``similarity`` of their union.

    The rows of a shingle's largest class meet only those of other classes, so
    a large class never meets itself."""
    rows = written(prefixes(sets, similarity), "near-prefixes")
    top = (rows.groupBy("x", "label").agg(F.count("x").alias("n"), F.max("short").alias("short"))
           .groupBy("x").agg(F.max(F.struct("n", "label")).alias("top"), F.count("label").alias("classes"),
                             F.max("short").alias("any")).filter("classes > 1 and any")
           .select("x", F.col("top.label").alias("top")))
    rows = written(rows.join(top.hint("merge"), "x").withColumn("top", F.col("label") == F.col("top")), "near-prefixes")
    a = rows.filter("short").select("x", *[F.col(c).alias(f"a_{c}") for c in ("key", "label", "size", "pos", "top")])
    b = rows.select("x", *[F.col(c).alias(f"b_{c}") for c in ("key", "label", "size", "pos", "top")])
    near = (F.expr("a_label <> b_label and (a_size < b_size or a_size = b_size and a_key < b_key)")
            & (F.col("a_size") >= similarity * F.col("b_size") - 1e-9)
            & (F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos"))
               >= similarity / (1 + similarity) * (F.col("a_size") + F.col("b_size")) - 1e-9))

    def met(a, b):
        return (a.join(b.hint("merge"), (a["x"] == b["x"]) & near)
                .select(F.least("a_key", "b_key").alias("a"), F.greatest("a_key", "b_key").alias("b")))

    return met(a.filter("not a_top"), b).unionByName(met(a.filter("a_top"), b.filter("not b_top"))).distinct()


def near_links(rows: DataFrame, bands: DataFrame, sweeps: int = SWEEPS, similarity: float = SIMILARITY):
    """(links, labels): verified links between nodes and the classes' labels."""
    member = written(bands.select("key", "size", F.explode("bands").alias("bucket")), "near-members")
    leaders = written(member.groupBy("bucket").agg(F.min(F.struct("key", "size")).alias("lead"), F.count("key").alias("n"))
                      .filter("n > 1").select("bucket", F.col("lead.key").alias("a"), F.col("lead.size").alias("a_size"), "n"),
                      "near-leaders")
    shared = member.join(leaders, "bucket")
    sets = written(shingle_sets(rows, written(shared.select("key").distinct(), "near-shared")), "near-sets")
    pairs = (shared.filter((F.col("a") != F.col("key")) & sizes_allow("a_size", "size", similarity))
             .select("a", F.col("key").alias("b")).distinct())
    links = written(verified(pairs, sets, similarity), "near-verified")
    labels = components(links)
    # a power of two: the parts of a group's buckets nest, whatever their sizes,
    # so its bands mostly choose the same leaders and repeat the same pairs
    parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.ceil(F.col("n") / PART)))).cast("bigint")
    for sweep in range(sweeps):
        placed = (member.join(leaders.select("bucket", "n"), "bucket").join(labels, "key", "left")
                  .select("bucket", "key", "size", F.coalesce("label", "key").alias("label"),
                          F.pmod(F.xxhash64("key", F.lit(sweep)), parts).alias("part"),
                          F.xxhash64(F.lit(sweep), "key").alias("turn")))
        placed = written(placed, "near-placed")
        head = written(placed.groupBy("bucket", "part").agg(
            F.min(F.struct("turn", "key", "label", "size")).alias("h"), F.min("label").alias("l0"), F.max("label").alias("l1"))
            .filter("l0 <> l1").select("bucket", "part", F.col("h.key").alias("a"), F.col("h.label").alias("la"),
                                       F.col("h.size").alias("a_size")), "near-heads")
        cross = (placed.join(head, ["bucket", "part"]).filter((F.col("label") != F.col("la")) & sizes_allow("a_size", "size", similarity))
                 .select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct())
        more = written(verified(cross, sets, similarity), "near-verified")
        if more.isEmpty():
            continue
        links = written(links.unionByName(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "near-verified")
        labels = components(links)
    placed = written(member.join(leaders.select("bucket"), "bucket").join(labels, "key", "left")
                     .select("bucket", "key", F.coalesce("label", "key").alias("label")), "near-placed")
    mixed = (placed.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
             .filter("l0 <> l1").select("bucket"))
    unsettled = placed.join(mixed.hint("merge"), "bucket", "left_semi").select("key", "label").distinct()
    unsettled = written(sets.join(unsettled.hint("merge"), "key"), "near-open")
    more = written(verified(open_pairs(unsettled, similarity), sets, similarity), "near-verified")
    if not more.isEmpty():
        links = written(links.unionByName(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "near-verified")
        labels = components(links)
    return links, labels


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, sweeps: int) -> tuple[DataFrame, DataFrame]:
    """(id, key of every row; key, class_id, class_size, links, names of every
    node): ``names`` marks the one node of a class that holds its smallest id."""
    rows = keyed(docs, id_col, text_col)
    every = written(signatures(rows), "near-signatures")
    nodes = written(every.groupBy("key").agg(F.min("id").alias("first"), F.first("bands").alias("bands"),
                                             F.first("size").alias("size")), "near-nodes")
    links, labels = near_links(rows, nodes.filter(F.size("bands") > 0), sweeps, similarity)
    named = nodes.select("key", "first").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    # null ids last, equal ids by key
    best = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "key"))
    classes = named.groupBy("label").agg(best.alias("best"), F.count("key").alias("class_size"))
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("key").alias("links"))
    of_key = written(named.join(classes, "label").join(degree, "key", "left")
                     .select("key", F.col("best.first").alias("class_id"), "class_size",
                             F.coalesce("links", F.lit(0)).cast("bigint").alias("links"),
                             (F.col("key") == F.col("best.key")).alias("names")), "near-classes")
    return every.select("id", "key"), of_key


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
               sweeps: int = SWEEPS) -> DataFrame:
    """One row per input row: id, class_id, class_size (distinct texts), links
    (verified links of its text), kept (it names its class)."""
    every, of_key = _classes(docs, id_col, text_col, similarity, sweeps)
    return (every.join(of_key, "key")
            .select(F.col("id").alias(id_col), "class_id", "class_size", "links",
                    F.col("id").eqNullSafe(F.col("class_id")).alias("kept")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that name their class, with all their columns: exactly one
    row per class, also where ids repeat or are null."""
    _, of_key = _classes(docs, id_col, text_col, SIMILARITY, SWEEPS)
    keep = of_key.filter("names").select(F.col("key").alias("_kept"), F.col("class_id").alias("_first")).hint("merge")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("_id"),
                       F.unhex(F.md5(text_of(text_col).cast("binary"))).alias("_key"))
    same = (F.col("_key") == F.col("_kept")) & F.col("_id").eqNullSafe(F.col("_first"))
    return rows.join(keep, same, "left_semi").dropDuplicates(["_key"]).select("row.*")
