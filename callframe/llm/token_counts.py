"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

Reading a piece byte by byte, the number of tokens of the prefix read so far is
a function of a finite state. A prefix's encoding ends in exactly one token t,
and is the encoding of what precedes t followed by t; t may follow the token
before it only if the two, merged as one string, stay these two. So the state
keeps the positions from which some token could still be under way: the bytes
read since, the token that ended there, and how many tokens fewer were counted
there than now. A transition reads a byte, finds the one token that fits, and
is annotated with the change of the count (which can be negative, when a longer
token replaces several).

The transducer is deterministic and compiled on demand: states and transitions
are made when first needed, and all are dropped when more than ``max_arcs``
exist, so its memory is bounded. A run over a chunk is a state map, entry state
to (exit state, tokens). Maps of adjacent chunks compose, which is associative,
so chunks of one piece are evaluated by themselves and joined by a balanced
scan. At the start of a piece the state is always the initial one: whole
pieces have constant maps, kept per distinct piece, and a text's count is a
prefix sum over its pieces.

Defined results: null counts as the empty text (0 tokens). Special strings in
a text are single tokens, as the vocabulary file's own library reads them.
Repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callframe.llm.bytebpe import PieceTable, byte_characters, encoder, json_tokenizer, vocabulary_path
from callframe.llm.common import map_texts, text_of

CHUNK = 4096
LIMIT = 512


class CountTransducer:
    """Counts the tokens of pieces (bytes) by ``tokens``: bytes -> merge rank."""

    def __init__(self, tokens: dict[bytes, int], max_arcs: int = 1 << 19):
        self.tokens = tokens
        self.prefixes = {t[:i] for t in tokens for i in range(1, len(t) + 1)}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.max_arcs = max_arcs
        self._reset()

    def _reset(self):
        #: a state: ((bytes under way, token before, tokens counted there minus now), ...)
        self.states = [((b"", None, 0),)]
        self.number = {self.states[0]: 0}
        self.arcs: dict[int, tuple[int, int]] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """The tokens of a short string, by the merge rule itself."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.tokens[j], i) for i in range(len(parts) - 1)
                      if (j := parts[i] + parts[i + 1]) in self.tokens]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def may_follow(self, before: bytes | None, token: bytes) -> bool:
        if before is None:
            return True
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) > self.max_arcs:
                self.pairs.clear()
            known = self.pairs[before, token] = self.merge(before + token) == [before, token]
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of ``state`` on ``byte``: (next state, tokens emitted)."""
        b = bytes([byte])
        open_, last, emitted = [], None, 0
        for under_way, before, delta in self.states[state]:
            read = under_way + b
            if last is None and read in self.tokens and self.may_follow(before, read):
                last, emitted = read, delta + 1
            if read in self.prefixes:
                open_.append((read, before, delta))
        key = (*((read, before, delta - emitted) for read, before, delta in open_), (b"", last, 0))
        target = self.number.setdefault(key, len(self.states))
        if target == len(self.states):
            self.states.append(key)
        arc = self.arcs[state << 8 | byte] = (target, emitted)
        return arc

    def run(self, data: bytes, state: int = 0) -> tuple[int, int]:
        """(exit state, tokens emitted) of a chunk entered in ``state``."""
        arcs, total = self.arcs, 0
        for byte in data:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                arc = self.compile(state, byte)
            state = arc[0]
            total += arc[1]
        return state, total

    def count(self, piece: bytes) -> int:
        if len(self.arcs) > self.max_arcs:
            self._reset()
        if len(piece) <= CHUNK:
            return self.run(piece)[1]
        maps = [ChunkMap(self, piece[i:i + CHUNK]) for i in range(0, len(piece), CHUNK)]
        while len(maps) > 1:  # balanced scan: neighbours compose, log2(chunks) levels
            maps = [ChunkMap(self, None, maps[i:i + 2]) if i + 1 < len(maps) else maps[i]
                    for i in range(0, len(maps), 2)]
        return maps[0].at(0)[1]


class ChunkMap:
    """State map of a chunk or of two adjacent maps. Entries are evaluated for
    the entry states that the composition asks for, and kept."""

    def __init__(self, transducer: CountTransducer, data: bytes | None, parts=()):
        self.transducer, self.data, self.parts, self.entries = transducer, data, parts, {}

    def at(self, state: int) -> tuple[int, int]:
        if state not in self.entries:
            if self.data is not None:
                found = self.transducer.run(self.data, state)
            else:
                middle, left = self.parts[0].at(state)
                end, right = self.parts[1].at(middle)
                found = end, left + right
            self.entries[state] = found
        return self.entries[state]


def transducer(path: str) -> CountTransducer:
    """Compile from a tokenizer file: bytes of each mergeable token by rank."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    back = {c: b for b, c in byte_characters().items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    tokens = {bytes([b]): -1 for b in range(256)}
    for rank, (left, right) in enumerate(pairs):
        tokens.setdefault(bytes(map(back.__getitem__, left + right)), rank)
    return CountTransducer(tokens)


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    path = tokenizer_path or vocabulary_path("byte_bpe_50k.json")

    def task():
        with open(path, encoding="utf-8") as f:
            added = [a for a in json.load(f)["added_tokens"] if a["special"]]
        machine, whole = transducer(path), encoder(json_tokenizer(path, regex=True))
        table = PieceTable(lambda pieces: [machine.count(p.encode()) for p in pieces],
                           lambda texts: [len(ids) for ids in whole(texts)],
                           special_id=added[0]["id"] if added else None,
                           special=added[0]["content"] if added else None, counts_only=True)

        def batch(ids, rest, texts):
            counts = [c for _, _, offsets in table.run(texts) for c in (offsets[1:] - offsets[:-1]).tolist()]
            yield [ids, rest[0], counts]

        return batch

    counted = map_texts(docs.select(F.col(id_col), F.octet_length(text_of(text_col)).cast("bigint").alias("n_bytes"),
                                    text_of(text_col).alias("text")),
                        task, [("n_tokens", "bigint")], carry=["n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
