"""Training-order materialisation of token ids in fixed-stride shards.

Each task's documents, tokenised and closed by an end id, form one stream that
is cut into sequences of ``LENGTH`` ids; the last one is filled up with the end
id. The sequences are written with their task and their number in it, so every
text is tokenised once and a repeated task gives the same rows. Counting the
sequences of each task gives each one a global number below their total N. A
keyed Feistel permutation over the smallest even number of bits that holds N,
walked along its cycle until the value is below N, gives each sequence its
global slot: a full shuffle of the corpus that needs no sort key, no table and
no random state, and that any reader can compute again.

Slots are cut into ranges of ``PER_SHARD``. A range is one shard file. Tasks get
consecutive ranges of shards by their numbers (one shuffle of the ids, no
sampling pass): sequence s lies at byte (s mod PER_SHARD) * stride of shard
s div PER_SHARD. A reader resumes at any slot by one seek (``read_slots``).
A shard is written under a temporary name and then renamed, so a repeated or
lost task never leaves half a shard under the final name.

Defined results: null counts as the empty text (its end id only). Repeated
rows are written one by one. An empty table writes no shard and gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callframe.llm.bytebpe import shared_piece_table, vocabulary_path
from callframe.llm.common import map_texts, text_of, written
from callframe.session import scratch_path

LENGTH = 1024
PER_SHARD = 8192
#: most tasks that write shards, each a range of consecutive ones
WRITERS = 1 << 14
END_ID = 50256
ROUNDS = 4
KEY = 0x5EED


def _round(half: np.ndarray, key: int, turn: int, bits: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xBF58476D1CE4E5B9) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64((1 << bits) - 1)


def feistel(values, size: int, key: int = KEY) -> np.ndarray:
    """Permute numbers below ``size``: a bijection of [0, size)."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = np.array(values, np.uint64)
    open_ = np.arange(len(out))
    while len(open_):
        left, right = out[open_] >> np.uint64(half), out[open_] & low
        for turn in range(ROUNDS):
            left, right = right, left ^ _round(right, key, turn, half)
        out[open_] = left << np.uint64(half) | right
        open_ = open_[out[open_] >= np.uint64(size)]
    return out.astype(np.int64)


def _id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def shard_path(folder: str, shard: int) -> str:
    return f"{folder.rstrip('/')}/shard-{shard:010d}.bin"


def cut_sequences(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, end_id: int = END_ID,
                  vocabulary: int = END_ID + 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(first_doc, part, number, ids, n_tokens): the sequences of every task.
    ``first_doc`` is the document of the first id, ``n_tokens`` counts without
    filling."""
    path = tokenizer_path or vocabulary_path("byte_bpe_50k.json")
    kind = _id_type(vocabulary)

    def cutting():
        from pyspark import TaskContext
        table = shared_piece_table(path)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        rest, heads, numbered = np.zeros(0, np.uint32), [], 0

        def sequences(stream, owners, starts, tokens):
            """Rows of whole sequences; owners and starts tell the documents."""
            nonlocal numbered
            count = len(stream) // length
            numbers = np.arange(numbered, numbered + count)
            numbered += count
            at = np.searchsorted(starts, np.arange(count) * length, "right") - 1
            data = stream.astype(kind)
            return [[owners[i] for i in at], [part] * count, numbers,
                    [data[i * length:(i + 1) * length].tobytes() for i in range(count)], [tokens] * count]

        def batch(ids, _, texts):
            nonlocal rest, heads
            ids = ids.to_pylist()
            for at, flat, offsets in table.run(texts):
                pieces, owners, starts, size = [rest], list(heads), [0] * len(heads), len(rest)
                for i in range(len(offsets) - 1):
                    own = flat[offsets[i]:offsets[i + 1]]
                    owners.append(ids[at + i])
                    starts.append(size)
                    pieces += [own, end]
                    size += len(own) + 1
                stream = np.concatenate(pieces)
                whole = size // length * length
                if whole:
                    yield sequences(stream[:whole], owners, starts, length)
                # the owner of the next sequence's first id
                rest = stream[whole:]
                heads = [owners[int(np.searchsorted(starts, whole, "right")) - 1]] if len(rest) else []

        def finish():
            if len(rest):
                filled = np.concatenate([rest, np.full(length - len(rest), end_id, np.uint32)])
                yield sequences(filled, heads, [0], len(rest))

        batch.finish = finish
        return batch

    cut = map_texts(docs.select(F.col(id_col), text_of(text_col).alias("_text")), cutting,
                    [("part", "int"), ("number", "bigint"), ("ids", "binary"), ("n_tokens", "bigint")])
    return cut.withColumnRenamed(id_col, "first_doc")


def with_slots(cut: DataFrame, key: int = KEY) -> tuple[DataFrame, int]:
    """((first_doc, slot, packed, n_tokens) of the sequences, their total N).
    ``packed`` is a sequence's ids, compressed for the way to its shard."""
    counts = cut.groupBy("part").agg(F.count("number").alias("n"))
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # one row per task of the pass, which bounds what is broadcast
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = counts.select("part", before.alias("first"))

    def placing(batches):
        import pyarrow as pa
        import zstandard
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("first_doc"), pa.array(feistel(batch.column("number").to_numpy(), size, key)),
                 pa.array(packed, pa.binary()), batch.column("n_tokens")], ["first_doc", "slot", "packed", "n_tokens"])

    numbered = cut.join(F.broadcast(first), "part").select(
        "first_doc", (F.col("first") + F.col("number")).alias("number"), "ids", "n_tokens")
    kind_of_id = cut.schema["first_doc"].dataType.simpleString()
    return numbered.mapInArrow(placing, f"first_doc {kind_of_id}, slot bigint, packed binary, n_tokens bigint"), size


def materialise(docs: DataFrame, folder: str | None = None, tokenizer_path: str | None = None,
                length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY, end_id: int = END_ID,
                vocabulary: int = END_ID + 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards and return one row per sequence: slot, shard,
    byte_offset, n_tokens (without filling), ids_crc32, first_doc (the document
    of its first id), sequences (N). The shards are written when the result is
    evaluated; ``folder`` defaults to one below the shared folder."""
    folder = folder or scratch_path(docs.sparkSession, "shards")
    stride = length * np.dtype(_id_type(vocabulary)).itemsize
    cut = written(cut_sequences(docs, tokenizer_path, length, end_id, vocabulary, id_col, text_col), "shard-sequences",
                  **{"compression": "zstd", "parquet.compression.codec.zstd.level": "9"})
    placed, size = with_slots(cut, key)
    shards = max(1, -(-size // per_shard))
    tasks = min(shards, WRITERS)
    ordered = (placed.repartitionById(tasks, F.expr(f"cast(slot div {per_shard} * {tasks} div {shards} as int)"))
               .sortWithinPartitions("slot"))

    def writing(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs
        import zstandard
        system, base = fs.FileSystem.from_uri(folder)
        unpacker = zstandard.ZstdDecompressor()
        open_shard, temporary, out = None, None, None

        def close():
            if out is not None:
                out.close()
                system.move(temporary, shard_path(base, open_shard))

        for batch in batches:
            slots = batch.column("slot").to_numpy()
            blobs = [unpacker.decompress(x, stride) for x in batch.column("packed").to_pylist()]
            for shard, blob in zip((slots // per_shard).tolist(), blobs):
                if shard != open_shard:
                    close()
                    system.create_dir(base, recursive=True)
                    open_shard, temporary = shard, f"{shard_path(base, shard)}.{uuid.uuid4().hex}.tmp"
                    out = system.open_output_stream(temporary)
                out.write(blob)
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(slots // per_shard), pa.array(slots % per_shard * stride, pa.int64()),
                 batch.column("n_tokens"), pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                 batch.column("first_doc"), pa.array([size] * len(blobs), pa.int64())],
                ["slot", "shard", "byte_offset", "n_tokens", "ids_crc32", "first_doc", "sequences"])
        close()

    kind_of_id = docs.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(writing, "slot bigint, shard bigint, byte_offset bigint, n_tokens bigint, "
                                       f"ids_crc32 bigint, first_doc {kind_of_id}, sequences bigint")


def read_slots(folder: str, start: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD,
               vocabulary: int = END_ID + 1):
    """Yield the sequences of ``count`` slots from ``start`` on, in training
    order: one seek, then sequential reads over the shards."""
    from pyarrow import fs
    kind = _id_type(vocabulary)
    stride = length * np.dtype(kind).itemsize
    system, base = fs.FileSystem.from_uri(folder)
    while count > 0:
        shard, at = divmod(start, per_shard)
        todo = min(count, per_shard - at)
        with system.open_input_file(shard_path(base, shard)) as f:
            f.seek(at * stride)
            for _ in range(todo):
                data = f.read(stride)
                if len(data) < stride:
                    return
                yield np.frombuffer(data, kind)
        start, count = start + todo, count - todo
