"""Byte-level BPE encoding and decoding over Arrow batches.

The tokenizers library holds the vocabulary of a rank file, its bytes mapped to
the byte-level alphabet and its merges derived from the ranks. A batch's texts
are cut by the pattern, its distinct pieces are encoded by the library, and the
ids are laid out per text (``bytebpe.PieceTable``). Decoding looks up each id's
bytes in the reversed table and joins them: the bytes of a code point may be
split over tokens, so only the joined bytes are read as UTF-8.

Defined results: null counts as the empty text (no ids). Strings of special
tokens are ordinary text. Unknown ids raise an error. ``decode`` replaces bytes
that are not UTF-8 by U+FFFD; its bytes column keeps them. Repeated rows give
repeated rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.bytebpe import PieceTable, encoder, rank_tokenizer, read_ranks, vocabulary_path
from callframe.llm.common import map_texts, text_of


class ByteTable:
    """Bytes of every id, flat, for decoding by array lookups."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.size = np.fromiter(map(len, tokens), np.int64, size)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, offset of each id's first byte and the end)."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id outside the vocabulary")
        sizes = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[np.repeat(self.begin[ids] - ends[:-1], sizes) + np.arange(ends[-1])], ends


@functools.cache
def byte_table(path: str) -> ByteTable:
    return ByteTable(read_ranks(path))


def char_offsets(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each token's first code point in the decoded text: a token that begins
    inside a split character has that character's number."""
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = ends[:-1]
    inside = np.zeros(len(at), np.int64)
    known = at < len(data)
    inside[known] = (data[at[known]] & 0xC0) == 0x80
    return np.maximum(leads[at] - inside, 0)


def piece_table(path: str, pattern: str | None = None) -> PieceTable:
    import public_tokenizers
    return PieceTable(encoder(rank_tokenizer(path, None)),
                      lambda texts: encoder(rank_tokenizer(path, pattern or public_tokenizers.PATTERN))(texts))


def encode(docs: DataFrame, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           with_offsets: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids (little-endian unsigned 32-bit)
    and, on request, the code point at which each token begins."""
    path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")
    columns = [("n_tokens", "bigint"), ("ids", "binary")] + [("offsets", "array<bigint>")] * with_offsets

    def task():
        table = piece_table(path)

        def batch(ids, _, texts):
            for at, flat, offsets in table.run(texts):
                own = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
                out = [ids.slice(at, len(own)), np.diff(offsets), [x.astype("<u4").tobytes() for x in own]]
                yield out + [[char_offsets(*byte_table(path).decode(x)).tolist() for x in own]] * with_offsets

        return batch

    return map_texts(docs.select(F.col(id_col), text_of(text_col).alias("text")), task, columns)


def decode(encoded: DataFrame, ranks_path: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """One row per row: id, bytes, text. Null ids decode to no bytes."""
    path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")

    def task():
        table = byte_table(path)

        def batch(ids, _, blobs):
            data = [table.decode(np.frombuffer(b, "<u4"))[0].tobytes() for b in blobs]
            yield [ids, data, [d.decode("utf-8", "replace") for d in data]]

        return batch

    return map_texts(encoded.select(F.col(id_col), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids")),
                     task, [("bytes", "binary"), ("text", "string")])


def round_trip(docs: DataFrame, ranks_path: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every text and decode the ids again: id, n_tokens and the
    digests of ids and decoded bytes, without moving either."""
    path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")

    def task():
        table, back = piece_table(path), byte_table(path)

        def batch(ids, _, texts):
            for at, flat, offsets in table.run(texts):
                data, ends = back.decode(flat)
                raw, data, cuts = flat.astype("<u4"), data, ends[offsets]
                yield [ids.slice(at, len(offsets) - 1), np.diff(offsets),
                       [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])],
                       [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])]]

        return batch

    return map_texts(docs.select(F.col(id_col), text_of(text_col).alias("text")), task,
                     [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")])
