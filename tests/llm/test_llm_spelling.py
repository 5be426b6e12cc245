"""Spelling variants against a plain-Python version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from callframe.llm import spelling as S
from tests_llm_util import documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain_variants(rows):
    n = plain_words(rows)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(docs, **options):
    rows = S.spelling_variants(docs, **options)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in rows.collect())


def corpus(rng, n, letters="abcéÉß"):
    stems = ["".join(rng.choices(letters, k=rng.randint(6, 11))) for _ in range(25)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = stems[int(rng.random() ** 3 * len(stems))]
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", rng.choice(letters), w[at] + rng.choice(letters)]) + w[at + 1:]
            words.append(w if rng.random() < 0.9 else w.upper() if "ß" not in w else w)
        texts.append(rng.choice([" ", ", ", "1"]).join(words))
    return texts


@pytest.mark.parametrize("tile", [S.TILE, 3])
def test_variants_by_brute_force(spark, tile):
    texts = corpus(random.Random(1), 400) + [None, "", "short words only", "÷×àÿ" * 3 + " ÷×àÿ" * 3] * 2
    rows = got(documents(spark, texts).repartition(5), tile=tile)
    assert rows == plain_variants(list(enumerate(texts)))
    assert any(r[1] for r in rows)


def test_chains_reach_the_last_form(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb"]
    texts = [" ".join([w] * (2 * 11 ** i)) for i, w in enumerate(chain)]
    rows = [(i, t) for i, t in enumerate(texts)]
    want = plain_variants(rows)
    assert got(documents(spark, texts)) == want and {r[2] for r in want if r[0] == chain[0]} == {chain[-1]}


def test_tiles_decide_single_edits():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(2, 9)
        words = ["".join(rng.choices("ab", k=rng.choice([n, n - 1]))) for _ in range(8)]
        pairs = [(i, j) for i in range(8) for j in range(i) if words[i] != words[j] and max(len(words[i]), len(words[j])) == n]
        if pairs:
            one, two = map(np.array, zip(*pairs))
            prefix, suffix = S.compare_tiles(*S.tiles([w.encode() for w in words], n), one, two)
            assert [p + s >= n - 1 for p, s in zip(prefix, suffix)] == [one_edit(words[i], words[j]) for i, j in pairs]


def test_group_pairs_are_all_pairs_of_a_group():
    for cells in (1, 3, 1000):
        found = [p for one, two in S.group_pairs(np.array([3, 1, 4, 2]), cells) for p in zip(one.tolist(), two.tolist())]
        want = [(a + i, a + j) for a, n in ((0, 3), (3, 1), (4, 4), (8, 2)) for i in range(n) for j in range(i + 1, n)]
        assert sorted(found) == want
    assert [len(one) for one, _ in S.group_pairs(np.array([1, 1]), 5)] == [0]


def test_edge_rows_and_clashing_columns(spark):
    rows = [(None, "letters letterz letters"), (3, "letters lettres"), (3, "letters"), (4, None), (None, "x" * 100_000 + " lettres " + "x" * 100_000)]
    docs = spark.createDataFrame([(i, t, "w", 1, [2]) for i, t in rows], "doc_id long, text string, word string, n int, key array<int>")
    assert got(docs) == plain_variants(rows)
    assert got(docs.limit(0)) == []
