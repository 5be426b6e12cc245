"""Byte-level BPE over batches of whole texts.

A byte-level BPE tokenizer first cuts a text into pieces (words with a leading
blank, digits, signs, white space) and then merges bytes inside each piece.
Pieces repeat, so a batch is handled by distinct pieces:

* ``piece_starts`` finds all piece borders of a batch at once. The pattern only
  looks one code point back and up to two ahead, so borders are comparisons of
  shifted arrays.
* ``PieceTable`` numbers the distinct pieces of a batch and asks the tokenizer
  only for pieces not met before. Pieces are found by a 64-bit hash, and every
  piece is then compared with the one it is taken for, of its batch or of the
  table, code point by code point. It is a cache: when it holds ``max_pieces``
  pieces or ``max_ids`` ids it starts again, so a task's memory does not grow
  with its input.

Code points that Python's Unicode tables do not know yet may have another
class in the tokenizer's own tables: segments holding one go to the tokenizer
whole. Strings of special tokens are cut out first where they are to become
ids. A very long text is handled in segments cut before white space that
follows another character, where a piece always starts.
"""

from __future__ import annotations

import base64
import functools
import itertools
import os
import re
import sys
import unicodedata

import numpy as np
import pandas as pd

from callframe.llm.common import left_in_stage

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)
_NONE_BEFORE, _NONE_AFTER = 255, 254
#: code points in one step, and the longest segment of one text
STEP = 1 << 20
#: fixed values: code points with the White_Space property
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_CUT = re.compile(r"\S(?=\s)")
_MULTIPLIER = 0x9E3779B97F4A7C15
_POLY = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point."""
    names = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else names.get(c[0], OTHER)
                         for i in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    table[list(WHITE_SPACE)] = SPACE
    return table


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    n = STEP + (1 << 17)

    def powers(base):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return powers(_POLY), powers(pow(_POLY, -1, 1 << 64))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def piece_starts(points: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a piece starts. ``first`` marks the segments' first points."""
    n = len(points)
    before = np.empty(n, np.uint8)
    before[1:] = kinds[:-1]
    before[first] = _NONE_BEFORE
    after = np.empty(n, np.uint8)
    after[:-1] = kinds[1:]
    after[-1] = _NONE_AFTER
    after[first[first > 0] - 1] = _NONE_AFTER
    blank_before = np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 32
    blank_before[first] = False
    space = kinds == SPACE
    starts = np.where(space, (before != SPACE) | ((after != SPACE) & (after != _NONE_AFTER)),
                      (before != kinds) & ~blank_before)
    quote = np.flatnonzero((points == 39) & starts)
    if len(quote):
        inside = np.ones(n + 3, bool)
        inside[first] = False
        inside[n:] = False
        ahead = np.concatenate([points, np.zeros(3, np.uint32)])
        one, two = ahead[quote + 1], ahead[quote + 2]
        short = inside[quote + 1] & np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        pair &= inside[quote + 1] & inside[quote + 2]
        for hit, length in ((short, 2), (pair, 3)):
            at = quote[hit]
            for k in range(1, length):
                starts[at + k] = False
            over = at + length
            starts[over[over < n]] = True
    starts[first] = True
    return starts


def piece_hashes(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece's code points and length."""
    up, down = _powers()
    if len(points) > len(up):  # one segment without a cut
        return np.fromiter((hash(points[a:b].tobytes()) & _MASK for a, b in zip(begin, end)), np.uint64, len(begin))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:len(points)], out=sums[1:])
    h = (sums[end] - sums[begin]) * down[begin]
    h ^= h >> np.uint64(29)
    h = (h + (end - begin).astype(np.uint64)) * np.uint64(_MULTIPLIER)
    return h ^ (h >> np.uint64(32))


def distinct_pieces(points: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray,
                    whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each piece, a place of each number) of the distinct pieces.
    Pieces share a number only if their code points agree."""
    codes, values = pd.factorize(hashes)
    at = np.full(len(values), -1, np.int64)
    at[codes[::-1]] = np.arange(len(codes))[::-1]
    size, like = end - begin, at[codes]
    wrong = (size != size[like]) | (whole != whole[like])
    shift = np.repeat(np.where(wrong, 0, begin[like] - begin), size)
    differ = np.flatnonzero(points != points[np.arange(len(points)) + shift])
    wrong[np.searchsorted(begin, differ, "right") - 1] = True
    if wrong.any():  # equal hashes of different pieces
        number: dict[tuple[bytes, bool], int] = {}
        more = []
        for i in np.flatnonzero(wrong).tolist():
            key = points[begin[i]:end[i]].tobytes(), bool(whole[i])
            if key not in number:
                number[key] = len(at) + len(more)
                more.append(i)
            codes[i] = number[key]
        at = np.concatenate([at, more])
    return codes, at


def segments(texts: list[str], special: str | None):
    """(texts cut to segments, first segment of each text, special positions).
    A None segment stands for the special token."""
    out: list[str | None] = []
    first = np.empty(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        first[i] = len(out)
        parts = [text]
        if special and special in text:
            parts = [p for part in text.split(special) for p in (part, None)][:-1]
        for part in parts:
            while part is not None and len(part) > STEP:
                cut = _CUT.search(part, STEP // 2)
                if not cut:
                    break
                out.append(part[:cut.end()])
                part = part[cut.end():]
            out.append(part)
    first[-1] = len(out)
    return out, first


class PieceTable:
    """Ids (or only their number) of the distinct pieces met so far.

    ``encode`` gets pieces, ``encode_whole`` segments with unknown code points;
    both return a list of id lists, or of counts if ``counts_only``."""

    def __init__(self, encode, encode_whole, special_id: int | None = None, special: str | None = None,
                 counts_only: bool = False, max_pieces: int = 1 << 20, max_ids: int = 1 << 23):
        self.encode, self.encode_whole = encode, encode_whole
        self.special, self.special_id = special, special_id
        self.counts_only, self.max_pieces, self.max_ids = counts_only, max_pieces, max_ids
        self._reset()

    def _reset(self):
        #: number of a piece by its hash, and of pieces whose hash is taken by another
        self.number: dict[int, int] = {}
        self.collided: dict[tuple[bytes, bool], int] = {}
        self.pieces = self.used = self.held = 0
        self.size, self.begin, self.piece_begin, self.piece_size = (np.zeros(1 << 12, np.int64) for _ in range(4))
        self.whole = np.zeros(1 << 12, bool)
        self.flat, self.points = np.zeros(1 << 12, np.uint32), np.zeros(1 << 14, np.uint32)

    @staticmethod
    def _room(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x)), x.dtype)])

    def _add(self, texts: list[str], results: list, whole: bool) -> int:
        """Number new pieces; the first number."""
        n, k = self.pieces, len(texts)
        self.pieces = n + k
        for name in ("size", "begin", "piece_begin", "piece_size", "whole"):
            setattr(self, name, self._room(getattr(self, name), n + k))
        sizes = np.fromiter(results if self.counts_only else map(len, results), np.int64, k)
        self.size[n:n + k] = sizes
        self.whole[n:n + k] = whole
        if not self.counts_only:
            total = int(sizes.sum())
            self.flat = self._room(self.flat, self.used + total)
            self.begin[n:n + k] = self.used + np.cumsum(sizes) - sizes
            self.flat[self.used:self.used + total] = np.fromiter((x for r in results for x in r), np.uint32, total)
            self.used += total
        points, lengths = code_points("".join(texts)), np.fromiter(map(len, texts), np.int64, k)
        self.points = self._room(self.points, self.held + len(points))
        self.points[self.held:self.held + len(points)] = points
        self.piece_begin[n:n + k] = self.held + np.cumsum(lengths) - lengths
        self.piece_size[n:n + k] = lengths
        self.held += len(points)
        return n

    def _known(self, points, begin, size, whole, hashes: list[int]) -> np.ndarray:
        """The table's number of each piece, -1 where it is not in it."""
        numbers = np.fromiter(map(self.number.get, hashes, itertools.repeat(-1)), np.int64, len(hashes))
        same = (numbers >= 0) & (self.piece_size[numbers] == size) & (self.whole[numbers] == whole)
        at = np.flatnonzero(same)
        ramp = np.arange(int(size[at].sum())) - np.repeat(np.cumsum(size[at]) - size[at], size[at])
        differ = np.flatnonzero(points[np.repeat(begin[at], size[at]) + ramp]
                                != self.points[np.repeat(self.piece_begin[numbers[at]], size[at]) + ramp])
        if len(differ):
            same[at[np.searchsorted(np.cumsum(size[at]), differ, "right")]] = False
        if self.collided:
            for i in np.flatnonzero(~same & (numbers >= 0)).tolist():
                numbers[i] = self.collided.get((points[begin[i]:begin[i] + size[i]].tobytes(), bool(whole[i])), -1)
                same[i] = numbers[i] >= 0
        return np.where(same, numbers, -1)

    def _step(self, parts: list[str]):
        """Numbers of all pieces of some segments, and each segment's first piece."""
        points = code_points("".join(parts))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.cumsum(sizes) - sizes
        full = sizes > 0
        first = begins[full]
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(parts) + 1, np.int64)
        kinds = class_table()[points]
        starts = piece_starts(points, kinds, first)
        odd = np.zeros(0, np.int64)
        if (kinds == UNKNOWN).any():
            odd = np.unique(np.searchsorted(first, np.flatnonzero(kinds == UNKNOWN), "right") - 1)
            ends = np.append(first[1:], len(points))
            for k in odd:
                starts[first[k] + 1:ends[k]] = False
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(points))
        hashes = piece_hashes(points, begin, end)
        whole = np.zeros(len(begin), bool)
        if len(odd):
            whole = np.isin(begin, first[odd])
            hashes[whole] ^= np.uint64(_POLY)
        codes, at = distinct_pieces(points, begin, end, hashes, whole)
        if self.pieces + len(at) > self.max_pieces or self.used > self.max_ids:
            self._reset()
        b, size, as_whole, keys = begin[at], (end - begin)[at], whole[at], hashes[at].tolist()
        numbers = self._known(points, b, size, as_whole, keys)
        for is_whole, encode in ((False, self.encode), (True, self.encode_whole)):
            new = np.flatnonzero((numbers < 0) & (as_whole == is_whole))
            if not len(new):
                continue
            texts = [points[x:x + n].tobytes().decode("utf-32-le", "surrogatepass") for x, n in zip(b[new].tolist(), size[new].tolist())]
            n = self._add(texts, encode(texts), is_whole)
            numbers[new] = np.arange(n, n + len(new))
            for i, number in zip(new.tolist(), range(n, n + len(new))):
                if self.number.setdefault(keys[i], number) != number:
                    self.collided[points[b[i]:b[i] + size[i]].tobytes(), is_whole] = number
        numbers = numbers[codes]
        return numbers, np.searchsorted(begin, np.append(begins, len(points)))

    def run(self, texts: list[str], with_ids: bool = True):
        """Yield (index of the first text, ids or None, offsets) for runs of
        texts of bounded size; offsets has each text's first id and the end."""
        with_ids = with_ids and not self.counts_only
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= STEP):
                size += len(texts[stop])
                stop += 1
            parts, first = segments(texts[at:stop], self.special)
            ids, sizes = [], [np.zeros(1, np.int64)]
            group: list[str] = []

            def flush():
                if not group:
                    return
                numbers, begins = self._step(group)
                counts = self.size[numbers]
                ends = np.concatenate([[0], np.cumsum(counts)])
                sizes.append(np.diff(ends[begins]))
                if with_ids:
                    total = int(ends[-1])
                    ids.append(self.flat[np.repeat(self.begin[numbers] - ends[:-1], counts) + np.arange(total)])
                group.clear()

            held = 0
            for part in parts:
                if part is None or held + len(part) > STEP:
                    flush()
                    held = 0
                if part is None:
                    sizes.append(np.ones(1, np.int64))
                    ids.append(np.array([self.special_id], np.uint32))
                else:
                    group.append(part)
                    held += len(part)
            flush()
            offsets = np.cumsum(np.concatenate(sizes))[first]
            yield at, (None if not with_ids else np.concatenate(ids) if ids else np.zeros(0, np.uint32)), offsets
            at = stop


# ---- tokenizers -----------------------------------------------------------

def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    for the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    table.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)})
    return table


def json_tokenizer(path: str, regex: bool):
    """The tokenizer of a .json file; with ``regex`` off it merges what it is
    given as one piece. Special strings are ordinary text to it."""
    from tokenizers import Tokenizer, pre_tokenizers
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    if not regex:
        t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return t


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The merge that makes each token, in rank order: its bytes merged by all
    lower ranks leave two parts."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) == 1:
            continue
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
            if best >= rank:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def rank_tokenizer(path: str, pattern: str | None):
    """A tokenizers object with the vocabulary of a rank file; ``pattern`` cuts
    the pieces, None takes each text as one piece."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    ranks = read_ranks(path)
    chars = byte_characters()
    as_text = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
    merges = [(as_text[a], as_text[b]) for a, b in merge_pairs(ranks)]
    t = Tokenizer(models.BPE(vocab={as_text[k]: v for k, v in ranks.items()}, merges=merges))
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    t.pre_tokenizer = level if pattern is None else pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), level])
    return t


def encoder(tokenizer):
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def json_piece_table(path: str, **kw) -> PieceTable:
    import json
    with open(path, encoding="utf-8") as f:
        added = [a for a in json.load(f)["added_tokens"] if a["special"]]
    special = added[0] if added else {"content": None, "id": None}
    return PieceTable(encoder(json_tokenizer(path, regex=False)), encoder(json_tokenizer(path, regex=True)),
                      special_id=special["id"], special=special["content"], **kw)


def shared_piece_table(path: str) -> PieceTable:
    """One table for all tasks of a stage in a Python worker, so that a task finds
    the pieces known that an earlier one met. It holds half as many as any other."""
    return left_in_stage(path, lambda: json_piece_table(path, max_pieces=1 << 19))
