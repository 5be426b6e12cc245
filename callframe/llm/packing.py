"""Cost-balanced packing of documents into training sequences.

A document is its token ids and a closing id. Training on a piece of l tokens
costs about ``linear * l + quadratic * l**2`` (the matrix products and the
attention inside the piece). Documents longer than a sequence first give whole
sequences. The rests of a block of documents are then assigned in descending
length, each to the sequence of the lowest cost so far that has the token
capacity left; where none can take it whole, it is cut over the cheapest ones
with room. The block opens exactly as much capacity as its tokens need: full
sequences, and for the remainder sequences of power-of-two lengths. So every
sequence is filled to the last token and nothing is padded.

A block is a run of consecutive documents in one task (about ``BLOCK_TOKENS``
tokens), so no row is shuffled, the ids never leave the task that made them,
and a lost task repeats by itself. A sequence's number is the task's partition
above a counter.

Defined results: null counts as the empty text, which still has its closing
id. Repeated rows are packed one by one. A null id stays null. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.bytebpe import shared_piece_table, vocabulary_path
from callframe.llm.common import map_texts, text_of

CAPACITY = 1024
LINEAR = 1.0
QUADRATIC = 1.0 / 1024
BLOCK_TOKENS = 1 << 20
#: sequences a task may number
_TASK_SEQUENCES = 1 << 36


def capacities(tokens: int, capacity: int) -> np.ndarray:
    """Sequence lengths that hold exactly ``tokens``: full ones, then powers of two."""
    rest = tokens % capacity
    powers = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    return np.array([capacity] * (tokens // capacity) + powers, np.int64)


def pack_block(lengths, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Pieces (document, start, length, sequence, offset) of one block, as arrays."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequences, rests = 0, []
    for doc, length in enumerate(lengths):
        whole = length // capacity
        pieces.extend((doc, i * capacity, capacity, sequences + i, 0) for i in range(whole))
        sequences += whole
        if length % capacity:
            rests.append((length % capacity, doc, whole * capacity))
    room = capacities(sum(r[0] for r in rests), capacity)
    size, cost = room.copy(), np.zeros(len(room))
    for length, doc, start in sorted(rests, key=lambda r: -r[0]):
        while length:
            fits = room >= length
            if not fits.any():
                fits = room > 0
            s = int(np.where(fits, cost, np.inf).argmin())
            part = min(length, int(room[s]))
            pieces.append((doc, start, part, sequences + s, int(size[s] - room[s])))
            room[s] -= part
            cost[s] += linear * part + quadratic * part * part
            start += part
            length -= part
    return np.array(pieces, np.int64).reshape(-1, 5), sequences + len(room)


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; ``with_ids`` adds the piece's ids (little-endian
    unsigned 32-bit) for writing them out."""
    path = tokenizer_path or vocabulary_path("byte_bpe_50k.json")
    columns = [("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint"),
               ("sequence_id", "bigint"), ("offset", "bigint")] + [("ids", "binary")] * with_ids

    def task():
        import pyarrow as pa
        from pyspark import TaskContext
        table = shared_piece_table(path)
        numbered = TaskContext.get().partitionId() * _TASK_SEQUENCES

        def block(keys, docs_ids):
            nonlocal numbered
            lengths = [len(d) for d in docs_ids]
            pieces, sequences = pack_block(lengths, capacity)
            data = [docs_ids[d][s:s + n].astype("<u4").tobytes() for d, s, n in pieces[:, :3].tolist()]
            doc = pieces[:, 0]
            out = [pa.array(keys).take(pa.array(doc)) if not isinstance(keys, pa.Array) else keys.take(pa.array(doc)),
                   pieces[:, 1], pieces[:, 2], [zlib.crc32(x) for x in data],
                   np.array(lengths, np.int64)[doc], pieces[:, 3] + numbered, pieces[:, 4]]
            numbered += sequences
            return out + [data] * with_ids

        def batch(ids, _, texts):
            held, first, tokens = [], 0, 0
            end = np.array([end_id], np.uint32)
            for at, flat, offsets in table.run(texts):
                for i in range(len(offsets) - 1):
                    held.append(np.concatenate([flat[offsets[i]:offsets[i + 1]], end]))
                    tokens += len(held[-1])
                    if tokens >= BLOCK_TOKENS:
                        yield block(ids.slice(first, len(held)), held)
                        first, held, tokens = first + len(held), [], 0
            if held:
                yield block(ids.slice(first, len(held)), held)

        return batch

    return map_texts(docs.select(F.col(id_col), text_of(text_col).alias("text")), task, columns)
