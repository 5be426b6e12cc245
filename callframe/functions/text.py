"""String helpers with Python's semantics, as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set: Unicode White_Space plus the four ASCII
# separators \x1c-\x1f.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(text: Column | str) -> Column:
    """``str.strip()`` with no arguments; reads the ends only."""
    return F.btrim(_c(text), F.lit(WHITE_SPACE))


def whole_tag(text: Column | str, tag: str, ignore_case: bool) -> Column:
    """The first tag match with its tags, found in one pass; NULL when there is
    no match."""
    flags = "(?sU" + ("i" if ignore_case else "") + ")"
    return F.nullif(F.regexp_extract(_c(text), flags + f"<{tag}>.*?</{tag}>", 0), F.lit(""))


def tag_inner(whole: Column | str, tag: str) -> Column:
    """What a ``whole_tag`` has between its tags, white space included."""
    whole = _c(whole)
    return F.substring(whole, F.lit(len(tag) + 3), F.length(whole) - (2 * len(tag) + 5))


def tag_pattern(tag: str, ignore_case: bool) -> str:
    """First ``<tag>\\s*(.*?)\\s*</tag>``, dot matching newlines."""
    flags = "(?sU" + ("i" if ignore_case else "") + ")"
    return flags + "<" + tag + r">\s*(.*?)\s*</" + tag + ">"


def has_tag(text: Column | str, tag: str, ignore_case: bool) -> Column:
    return F.coalesce(_c(text).rlike(tag_pattern(tag, ignore_case)), F.lit(False))


def tag_body(text: Column | str, tag: str, ignore_case: bool) -> Column:
    """Group 1 of the first tag match; NULL when there is no match."""
    pat = tag_pattern(tag, ignore_case)
    return F.when(_c(text).rlike(pat), F.regexp_extract(_c(text), pat, 1))


def strip_fence(raw: Column | str) -> Column:
    """Drop a leading ```json or ``` and a trailing ```, then strip."""
    raw = _c(raw)
    head = (
        F.when(raw.startswith("```json"), F.substring(raw, 8, 1 << 30))
        .when(raw.startswith("```"), F.substring(raw, 4, 1 << 30))
        .otherwise(raw)
    )
    tail = F.when(head.endswith("```"), F.substring(head, F.lit(1), F.length(head) - 3)).otherwise(head)
    return py_strip(tail)


def contains_all(text: Column | str, *needles: str) -> Column:
    cond = F.lit(True)
    for n in needles:
        cond = cond & _c(text).contains(n)
    return F.coalesce(cond, F.lit(False))
