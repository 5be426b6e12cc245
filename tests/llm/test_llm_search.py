"""Ranked search against a plain-Python version of the score."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from callframe.llm import lexical_search as S
from tests_llm_util import documents

RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return RUN.findall((text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted(((r[0], r[1], r[2], r[3]) for r in S.search(docs, items, **options).collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, score int")


def corpus(rng, n):
    words = ["Ab", "ab", "é1", "Éa", "x9", "the", "q\x00z", "a-b", "あ", "b c", "O'K"] + [f"w{i}" for i in range(60)]
    return [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(n)]


def test_terms_are_the_contract_runs():
    rng = random.Random(1)
    pieces = [chr(i) for i in range(256)] + ["İ", " ", " ", "😀", "AZ", "az"]
    for _ in range(300):
        text = "".join(rng.choices(pieces, k=40))
        assert [t.decode() for t in S.terms(text.encode())] == plain_terms(text)


@pytest.mark.parametrize("cells", [S.PASS_CELLS, 200])
def test_search_by_brute_force(spark, cells):
    rng = random.Random(2)
    texts = corpus(rng, 300) + [None, "", " \n", "the " * 5000] + ["same words here"] * 40
    items = list(enumerate(corpus(rng, 25) + [None, "", "unseen words only", "same words", "the", "THE the"]))
    got = found(documents(spark, texts).repartition(5), items_of(spark, items), cells=cells)
    assert got == plain_search(list(enumerate(texts)), items)


def test_ties_at_the_cut_go_to_the_smallest_ids(spark):
    docs = documents(spark, ["same"] * 3000 + ["other thing"] * 3000).repartition(7)
    assert [r[2] for r in sorted(found(docs, items_of(spark, [(1, "same")])), key=lambda r: r[1])] == list(range(10))


def test_narrow_tiles_change_nothing(spark, monkeypatch):
    rng = random.Random(3)
    texts, items = corpus(rng, 120), list(enumerate(corpus(rng, 12)))
    counts = S.term_counts(documents(spark, texts), {w.encode(): i for i, w in enumerate(sorted({t for x in texts for t in plain_terms(x)}))})
    assert counts.count() == 120
    monkeypatch.setattr(S, "tile_width", lambda weight: 3)
    assert found(documents(spark, texts), items_of(spark, items)) == plain_search(list(enumerate(texts)), items)


def test_tiles_stay_below_two_to_53():
    for weight in (0, 1, 20_000, 10 ** 7):
        width = S.tile_width(np.array([weight, 1]))
        assert width >= 1 and width * weight * S.IMPACT < 2 ** 53


def test_null_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "cat dog"), (3, "cat dog"), (3, "cat dog"), (1, "cat"), (5, None), (None, "cat dog")]
    docs = spark.createDataFrame([(i, t, "n", [1], 2) for i, t in rows], "doc_id long, text string, n string, term array<int>, item int")
    items = [(7, "cat, dog"), (7, "Dog"), (None, "cat")]
    assert found(docs, items_of(spark, items)) == plain_search(rows, items)


def test_empty_tables(spark):
    docs, items = documents(spark, ["a"]), items_of(spark, [(1, "a")])
    assert found(docs, items.limit(0)) == found(docs.limit(0), items) == found(documents(spark, ["", None]), items) == []
    assert S.search(docs.limit(0), items).columns == S.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
