"""Long repeated strings by a run-length index.

Every string of ``LENGTH`` bytes that starts at two or more places of the
corpus is found, and the bytes it covers are marked, at every place.

*Regions.* Each window of ``LENGTH`` bytes has an anchor: of its ``GRAM``-byte
grams the one with the smallest hash, rightmost of ties. Neighbouring windows
share anchors, so a text falls into regions, the windows of one anchor; each
window lies in exactly one region, at most ``LENGTH + WINDOW - 1`` bytes long.
Equal windows have equal anchors. So only windows whose anchors have equal
hashes can be equal, and regions whose anchor occurs once in the corpus hold no
repeat and are never moved. The others are reduced to distinct regions with
their number of occurrences and dealt out by the anchor's hash.

*Index.* A task joins the regions of whole anchors to a block of text, with
separators, sorts its suffixes, and keeps the Burrows-Wheeler transform as
runs, with the suffix positions sampled at both ends of every run. Matching
statistics are then streamed in text order: a suffix that is no run head keeps
the lexicographic neighbour of the suffix before it, and its match is one byte
shorter; only at sampled positions are matches compared, so the work of
comparing grows with the runs, not with the text. The longer match of both
neighbours is the longest string at a position that starts anywhere else; a
region that occurs twice matches whole. Positions matching ``LENGTH`` bytes or
more mark them.

*Hot anchors.* A passage in a third of all documents gives one anchor as many
distinct regions. Anchors with more than ``LARGE`` distinct regions are dealt
again by longer keys: windows are split into classes by the place of the anchor
in them (``STEPS`` places a class, then one), and a class is keyed by the bytes
that all its windows share. At one place a class the key is the whole window,
which is one distinct string. So groups are bounded without dropping any.

Equal texts are one node, known by 128 bits of SHA-256. Defined results: null
counts as the empty text. A text of ``LENGTH`` bytes or more that occurs twice
is removed whole. Shorter texts keep all bytes. Every row is a text of its own,
also if ids repeat; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callframe.llm.common import text_of, written

LENGTH = 200
GRAM = 48
#: grams of a window
WINDOW = LENGTH - GRAM + 1
LARGE = 4096
STEPS = (19, 1)
#: bytes whose anchors are sought at once, and bytes of one index
CHUNK = 1 << 21
BLOCK = 1 << 21
_POLY = 0x9E3779B97F4A7C15
_POSITION = (1 << 31) - 1
#: least keys in which one, two, ... of seven symbols differ
_SYMBOLS = np.int64(1) << (9 * np.arange(7))


def identity(data: Column) -> Column:
    """128 bits of the SHA-256 of a binary column."""
    return F.substring(F.unhex(F.sha2(data, 256)), 1, 16)


# ---- regions ----------------------------------------------------------------

def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the gram at every position that has one."""
    power, width, total, at = _POLY, 1, None, 0
    h = data.astype(np.uint64) + np.uint64(1)
    while True:
        if gram & width:  # the gram is put together from power-of-two pieces
            piece = h[at:len(data) - gram + at + 1]
            total = piece.copy() if total is None else total * np.uint64(power) + piece
            at += width
        if 2 * width > gram:
            break
        h = h[:-width] * np.uint64(power) + h[width:]
        width, power = 2 * width, power * power & (1 << 64) - 1
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def regions(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, start, end, anchor, hash) arrays: the regions of the texts that
    lie one after another in ``data`` and end at ``ends``. Positions count in
    ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    h = gram_hashes(data, gram)
    packed = (h & ~np.uint64(_POSITION)) | (np.uint64(_POSITION) - np.arange(len(h), dtype=np.uint64))
    least = sliding_minimum(packed, length - gram + 1)
    anchor = _POSITION - (least & np.uint64(_POSITION)).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(len(anchor) + 1, np.int32)
    whole = ends - starts >= length
    valid[starts[whole]] += 1
    np.subtract.at(valid, ends[whole] - length + 1, 1)
    at = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(at):
        return none, none, none, none, none.astype(np.uint64)
    chosen = anchor[at]
    first = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)])
    last = np.r_[first[1:], len(at)] - 1
    return (np.searchsorted(ends, at[first], "right"), at[first], at[last] + length, chosen[first], h[chosen[first]])


def chunks(texts, size: int = CHUNK):
    """(first, data, ends) of consecutive texts (bytes), about ``size`` bytes at a time."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size or i + 1 == len(texts):
            part = texts[first:i + 1]
            yield first, np.frombuffer(b"".join(part), np.uint8), np.cumsum([len(t) for t in part])
            first, held = i + 1, 0


def anchors(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, sha, n_bytes, anchors) of the rows (id, sha, text binary): the
    distinct hashes of a text's anchors, twice if the text repeats them."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found, size = [], []
            for _, data, ends in chunks(texts):
                text, *_, h = regions(data, ends, length, gram)
                order = np.lexsort((h, text))
                text, h = text[order], h[order]
                same = np.r_[False, (h[1:] == h[:-1]) & (text[1:] == text[:-1])]
                keep = ~(same & np.r_[False, same[:-1]])
                found.append(h[keep])
                size.append(np.bincount(text[keep], minlength=len(ends)))
            offsets = np.r_[0, np.cumsum(np.concatenate(size))] if size else np.zeros(1)
            values = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], ["id", "sha", "n_bytes", "anchors"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "sha", "text").mapInArrow(run, f"id {id_type}, sha binary, n_bytes bigint, anchors array<bigint>")


def repeated_regions(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, start, h, at, seg) of the texts (key, repeated, text): the regions
    whose anchor's hash is listed; ``at`` is the anchor's place in the region."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            content = batch.column(2).to_pylist()
            listed, ends_listed = batch.column(1).flatten().to_numpy().view(np.uint64), batch.column(1).value_lengths().to_numpy()
            of_text = np.split(listed, np.cumsum(ends_listed)[:-1])
            for first, data, ends in chunks(content):
                text, start, end, anchor, h = regions(data, ends, length, gram)
                bounds = np.searchsorted(text, np.arange(len(ends) + 1))
                keep = np.concatenate([np.zeros(0, np.int64)] + [
                    a + np.flatnonzero(np.isin(h[a:b], of_text[first + i])) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))])
                text, start, end, anchor, h = (x[keep] for x in (text, start, end, anchor, h))
                begin = np.r_[0, ends][text]
                for a in range(0, len(text), 10_000):
                    b = slice(a, a + 10_000)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(first + text[b])), pa.array((start - begin)[b], pa.int64()),
                         pa.array(h[b].view(np.int64)), pa.array((anchor - start)[b], pa.int32()),
                         pa.array([data[x:y].tobytes() for x, y in zip(start[b].tolist(), end[b].tolist())], pa.binary())],
                        ["key", "start", "h", "at", "seg"])

    return texts.select("key", "repeated", "text").mapInArrow(run, "key binary, start bigint, h bigint, at int, seg binary")


# ---- the index --------------------------------------------------------------

def symbol_keys(text: np.ndarray) -> np.ndarray:
    """Seven symbols (9 bits each) from every position on, as one integer."""
    padded = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.int64)
    key = np.zeros(len(text), np.int64)
    for i in range(7):
        key = (key << 9) | padded[i:i + len(text)]
    return key


def suffix_array(text: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of at least their first ``depth`` symbols, by
    prefix doubling; only suffixes that are not yet alone are sorted again."""
    n = len(text)
    order = np.argsort(keys)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    value, done = keys[order], 7

    def regroup(places, value, suffixes):
        head = np.r_[True, value[1:] != value[:-1]]
        rank[suffixes] = places[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        return places[~(head & np.r_[head[1:], True])]

    open_ = regroup(np.arange(n), value, order)
    while len(open_) and done < depth:
        mine = order[open_]
        value = rank[mine] * (n + 1) + rank[np.minimum(mine + done, n)] + 1
        turn = np.argsort(value)
        order[open_] = mine[turn]
        open_ = regroup(open_, value[turn], mine[turn])
        done *= 2
    return order


def common_prefix(keys: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common symbols of the suffixes a[i] and b[i], at least up to ``limit``."""
    out, n = np.zeros(len(a), np.int64), len(keys)
    live = np.arange(len(a))
    for done in range(0, limit, 7):
        x, y = a[live] + done, b[live] + done
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        differ = keys[x] ^ keys[y]
        # equal leading symbols: 7 less those up to the highest differing bit
        out[live] = done + 7 - np.searchsorted(_SYMBOLS, differ, "right")
        live = live[differ == 0]
        if not len(live):
            break
    return out


class RunIndex:
    """Run-length Burrows-Wheeler index of some strings (bytes, no two alike)
    with the suffix positions at the ends of its runs."""

    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) + 1 for s in strings])
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        text = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8).astype(np.uint16) + 1
        text[self.ends - 1] = 0  # the separators
        # no two strings are alike, so no suffix repeats another over two separators
        self.depth = 2 * int(size.max()) + 2
        self.keys = symbol_keys(text)
        order = suffix_array(text, self.keys, self.depth)
        before = text[order - 1].astype(np.int32)
        before[order == 0] = -1
        change = before[1:] != before[:-1]
        self.heads, self.tails = np.flatnonzero(np.r_[True, change]), np.flatnonzero(np.r_[change, True])
        self.symbols = before[self.heads]
        n = len(order)
        # samples: the first and last suffix of every run, each with its neighbour outside the run
        self.first, self.last = order[self.heads], order[self.tails]
        self.above, self.below = order[np.maximum(self.heads - 1, 0)], order[np.minimum(self.tails + 1, n - 1)]
        self.above[0] = self.below[-1] = n  # none
        self.size = n

    def streamed(self, samples: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
        """The match of every position with its neighbour on one side."""
        match = common_prefix(self.keys, samples, neighbours, self.depth)
        at = np.zeros(self.size, np.int64)
        at[samples] = samples
        value = np.zeros(self.size, np.int64)
        value[samples] = match
        at = np.maximum.accumulate(at)  # position 0 is always sampled
        return value[at] - (np.arange(self.size) - at)

    def matches(self) -> np.ndarray:
        """Matching statistics: at every position the longest string that also
        starts at another, ending before the separator."""
        rest = np.repeat(self.ends - 1, self.ends - self.starts) - np.arange(self.size)
        return np.minimum(np.maximum(self.streamed(self.first, self.above), self.streamed(self.last, self.below)), rest)


def repeated_spans(strings: list[bytes], times: list[int], length: int = LENGTH):
    """(string, from, to) arrays: the bytes covered by strings of ``length``
    bytes that start at two places or in a string that occurs twice."""
    index = RunIndex(strings)
    match = index.matches()
    for i in np.flatnonzero(np.array(times) > 1):
        a, b = index.starts[i], index.ends[i]
        match[a:b] = np.arange(b - a - 1, -1, -1)
    at = np.flatnonzero(match >= length)
    depth = np.zeros(index.size + 1, np.int32)
    depth[at] += 1
    depth[at + length] -= 1
    inside = np.cumsum(depth) > 0
    edge = np.diff(np.r_[False, inside].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    string = np.searchsorted(index.ends, start, "right")
    return string, start - index.starts[string], end - index.starts[string]


def indexed(items: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(dg, a, b): the marked spans of the distinct strings (h, dg, seg, n),
    each block of whole groups ``h`` by an index of its own."""
    def run(batches):
        import pyarrow as pa
        held = {"dg": [], "seg": [], "n": []}

        def marked():
            string, a, b = repeated_spans(held["seg"], held["n"], length)
            yield pa.RecordBatch.from_arrays(
                [pa.array([held["dg"][i] for i in string.tolist()], pa.binary()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                ["dg", "a", "b"])

        size, last = 0, None
        for batch in batches:
            for h, dg, seg, n in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= block and h != last:
                    yield from marked()
                    held, size = {"dg": [], "seg": [], "n": []}, 0
                for name, value in (("dg", dg), ("seg", seg), ("n", n)):
                    held[name].append(value)
                size, last = size + len(seg) + 1, h
        if size:
            yield from marked()

    rows = items.select("h", "dg", "seg", "n").repartition("h").sortWithinPartitions("h")
    return rows.mapInArrow(run, "dg binary, a bigint, b bigint")


def refined(items: DataFrame, step: int, length: int = LENGTH) -> DataFrame:
    """(dg, off, h, at, seg, n): the windows of each string (dg, h, at, seg, n)
    in classes of ``step`` places of the anchor; ``off`` is the class's place in
    the string, ``h`` the hash of the bytes that all windows of a class share."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            out = {name: [] for name in ("dg", "off", "h", "at", "seg", "n")}
            for dg, at, seg, n in zip(*(c.to_pylist() for c in batch.columns)):
                least = at - (len(seg) - length)
                for c in range(least // step, at // step + 1):
                    lo, hi = max(c * step, least), min(c * step + step - 1, at)
                    core = seg[at - c * step:at - c * step - step + 1 + length]
                    h = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=c.to_bytes(4, "little")).digest(), "little", signed=True)
                    for name, value in zip(out, (dg, at - hi, h, hi, seg[at - hi:at - lo + length], n)):
                        out[name].append(value)
                if len(out["dg"]) >= 10_000:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out = {name: [] for name in out}
            yield pa.RecordBatch.from_pydict(out, schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    ddl = "dg binary, off bigint, h bigint, at int, seg binary, n bigint"
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    return items.select("dg", "at", "seg", "n").mapInArrow(run, ddl)


def marked(items: DataFrame, length: int = LENGTH, large: int = LARGE, steps: tuple = STEPS) -> DataFrame:
    """(dg, a, b): the marked spans of distinct strings (dg, h, at, seg, n)."""
    groups = items.groupBy("h").agg(F.count("dg").alias("held"), F.sum("n").alias("times")).filter("times > 1")
    live = written(items.join(groups.hint("merge"), "h"), "runs-live")
    out = indexed(live.filter(F.col("held") <= large) if steps else live, length)
    hot = live.filter(F.col("held") > large)
    if not steps or hot.isEmpty():
        return out
    parts = written(refined(hot, steps[0], length).withColumn("part", identity(F.col("seg"))), "runs-parts")
    finer = parts.groupBy(F.col("part").alias("dg")).agg(
        F.first("h").alias("h"), F.first("at").alias("at"), F.first("seg").alias("seg"), F.sum("n").alias("n"))
    spans = marked(finer, length, large, steps[1:]).withColumnRenamed("dg", "part")
    back = parts.select("dg", "off", "part").join(spans.hint("merge"), "part")
    return out.unionByName(back.select("dg", (F.col("off") + F.col("a")).alias("a"), (F.col("off") + F.col("b")).alias("b")))


# ---- documents --------------------------------------------------------------

def kept_texts(texts: DataFrame) -> DataFrame:
    """(key, spans, n_removed, kept_sha256) of the texts (key, marks, text):
    marked spans joined to maximal ones, and the digest of the other bytes."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            spans, removed, sha = [], [], []
            for marks, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ends = np.array([(m["a"], m["b"]) for m in marks], np.int64)
                ends = ends[np.argsort(ends[:, 0])]
                reach = np.maximum.accumulate(ends[:, 1])
                new = np.r_[True, ends[1:, 0] > reach[:-1]]
                a, b = ends[new, 0], reach[np.r_[new[1:], True]]
                spans.append([{"a": int(x), "b": int(y)} for x, y in zip(a, b)])
                removed.append(int((b - a).sum()))
                digest, at = hashlib.sha256(), 0
                for x, y in zip(a.tolist(), b.tolist()):
                    digest.update(text[at:x])
                    at = y
                digest.update(text[at:])
                sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                 pa.array(removed, pa.int64()), pa.array(sha, pa.string())], ["key", "spans", "n_removed", "kept_sha256"])

    return texts.select("key", "marks", "text").mapInArrow(
        run, "key binary, spans array<struct<a bigint, b bigint>>, n_removed bigint, kept_sha256 string")


def long_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 large: int = LARGE) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and
    spans array<(a, b)>, the removed byte ranges."""
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM} bytes")
    data = text_of(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(data, 256)).alias("sha"), data.alias("text"))
    every = written(anchors(rows, length), "runs-anchors").withColumn("key", F.substring("sha", 1, 16))
    nodes = written(every.groupBy("key").agg(F.first("anchors").alias("anchors"), F.count("key").alias("copies")), "runs-nodes")
    anchor = nodes.select("key", F.explode("anchors").alias("h"))
    repeated = anchor.groupBy("h").agg(F.count("h").alias("n")).filter("n > 1").select("h")
    open_ = (anchor.join(repeated.hint("merge"), "h").groupBy("key").agg(F.collect_set("h").alias("repeated")))
    texts = rows.groupBy(F.substring("sha", 1, 16).alias("key")).agg(F.first("text").alias("text"))
    texts = written(texts.join(open_.hint("merge"), "key"), "runs-texts")
    found = written(repeated_regions(texts, length).withColumn("dg", identity(F.col("seg"))), "runs-regions")
    items = found.groupBy("dg").agg(F.first("h").alias("h"), F.first("at").alias("at"), F.first("seg").alias("seg"),
                                    F.count("dg").alias("n"))
    spans = written(marked(items, length, large), "runs-spans")
    marks = (found.select("key", "start", "dg").join(spans.hint("merge"), "dg")
             .groupBy("key").agg(F.collect_list(F.struct((F.col("start") + F.col("a")).alias("a"),
                                                         (F.col("start") + F.col("b")).alias("b"))).alias("marks")))
    cut = written(kept_texts(texts.select("key", "text").join(marks.hint("merge"), "key")), "runs-cut")
    whole = F.col("n_bytes") >= length
    copied = nodes.filter("copies > 1").select("key", F.lit(True).alias("copied"))
    known = written(copied.join(cut, "key", "full"), "runs-known")
    gone = F.coalesce("copied", F.lit(False)) & whole
    none = F.array().cast("array<struct<a bigint, b bigint>>")
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("a"), F.col("n_bytes").alias("b")))
    return (every.select("id", "key", "sha", "n_bytes").join(known.hint("merge"), "key", "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
                    F.when(gone, F.lit(hashlib.sha256().hexdigest()))
                    .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
                    F.when(gone, everything).otherwise(F.coalesce("spans", none)).alias("spans"))
            .select(id_col, "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "spans"))
