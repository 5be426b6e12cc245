"""Long repeats against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from callframe.llm import run_index as R
from tests_llm_util import documents


def plain(texts, length=R.LENGTH):
    data = [(t or "").encode() for t in texts]
    starts = defaultdict(list)
    for d, text in enumerate(data):
        for p in range(len(text) - length + 1):
            starts[text[p:p + length]].append((d, p))
    gone = [np.zeros(len(t), bool) for t in data]
    for places in starts.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p:p + length] = True
    out = []
    for d, text in enumerate(data):
        edges = np.diff(np.r_[0, gone[d].astype(int), 0])
        kept = bytes(b for b, g in zip(text, gone[d]) if not g)
        out.append((d, len(text), int(gone[d].sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def got(spark, texts, **options):
    rows = R.long_repeats(documents(spark, texts).repartition(3), **options).collect()
    assert all(sum(s.b - s.a for s in r.spans) == r.n_removed for r in rows)
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def words(rng, n, pool):
    return " ".join(rng.choices(pool, k=n))


def corpus(rng, n):
    pool = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)]
    passages = [words(rng, k, pool) for k in (30, 45, 60, 90, 200)]
    texts = []
    for _ in range(n):
        parts = [words(rng, rng.randint(0, 60), pool)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 40)
            parts += [p[a:] if rng.random() < .5 else p[:len(p) - a], words(rng, rng.randint(0, 30), pool)]
        texts.append(rng.choice(["", " "]).join(parts))
        if rng.random() < .2:
            copy = texts[-1].split(" ")
            copy[len(copy) // 2] = "CHANGED"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("large", [R.LARGE, 2])
def test_repeats_by_brute_force(spark, large):
    rng = random.Random(1)
    texts = corpus(rng, 60)
    texts += [None, "", "x" * 199, "y" * 200, "z" * 201, "ab" * 150, "=" * 1000, texts[0], texts[0], "q" * 200, "q" * 200,
              "short", "short", texts[3] + texts[3]]
    assert got(spark, texts, large=large) == plain(texts)


def test_a_hot_passage_with_different_surroundings(spark):
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=260))
    texts = ["".join(rng.choices("abc", k=rng.randint(0, 120))) + passage + "".join(rng.choices("abc", k=rng.randint(0, 120)))
             for _ in range(120)] + ["".join(rng.choices("xyz", k=400)) for _ in range(30)]
    assert got(spark, texts, large=8) == got(spark, texts) == plain(texts)


def test_repeats_of_other_lengths(spark):
    texts = corpus(random.Random(3), 25)
    assert got(spark, texts, length=77) == plain(texts, 77)


def test_matching_statistics_are_streamed_exactly():
    rng = random.Random(4)
    for _ in range(60):
        alphabet = rng.choice(["ab", "abcdef", "a"])
        strings = list({"".join(rng.choices(alphabet, k=rng.randint(1, 40))).encode() for _ in range(rng.randint(1, 12))})
        strings += [s + t for s, t in zip(strings, strings[1:]) if s + t not in strings][:3]
        # neighbours that repeat each other across the separator
        u, v = ("".join(rng.choices("xyzw", k=30)).encode() for _ in range(2))
        strings = list(dict.fromkeys(strings + [b"1" + u, v + b"2", b"3" + u, v + b"4"]))
        index = R.RunIndex(strings)
        match = index.matches()
        places = [(s, p) for s, x in enumerate(strings) for p in range(len(x))]
        for s, p in places:
            best = 0
            for u, q in places:
                if (u, q) != (s, p):
                    a, b, k = strings[s][p:], strings[u][q:], 0
                    while k < min(len(a), len(b)) and a[k] == b[k]:
                        k += 1
                    best = max(best, k)
            assert match[index.starts[s] + p] == best
        assert len(index.heads) == len(index.tails) == len(index.symbols) <= index.size


def test_repetitive_strings_have_few_runs():
    rng = random.Random(5)
    base = "".join(rng.choices("abcd", k=300))
    strings = [(base[:i] + "x" + base[i + 1:]).encode() for i in range(0, 300, 5)]
    assert len(R.RunIndex(strings).heads) < 0.12 * sum(map(len, strings))


def test_every_window_lies_in_one_region_and_equal_windows_share_a_hash():
    rng = random.Random(6)
    texts = [t.encode() for t in corpus(rng, 12)] + [b"a" * 500, b"", b"ab" * 100]
    seen = {}
    for first, data, ends in R.chunks(texts, 3000):
        text, start, end, anchor, h = R.regions(data, ends)
        windows = [(t, p) for t, a, b in zip(text, start, end) for p in range(a, b - R.LENGTH + 1)]
        assert len(set(windows)) == len(windows) == sum(max(0, len(t) - R.LENGTH + 1) for t in texts[first:first + len(ends)])
        assert all(a <= x <= b - R.GRAM and b - a <= R.LENGTH + R.WINDOW - 1 for a, b, x in zip(start, end, anchor))
        for a, b, x in zip(start, end, h):
            for p in range(a, b - R.LENGTH + 1):
                assert seen.setdefault(data[p:p + R.LENGTH].tobytes(), x) == x


def test_edge_rows_and_clashing_columns(spark):
    rows = [(None, "w" * 300), (3, None), (3, "w" * 300), (4, ""), (None, "v" * 100_000)]
    docs = spark.createDataFrame([(i, t, "k", 1, [2], 3) for i, t in rows], "doc_id long, text string, key string, h int, spans array<int>, id int")
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in R.long_repeats(docs).collect()]
    assert sorted(found, key=str) == sorted([(None, 300, 300, 1), (3, 0, 0, 0), (3, 300, 300, 1), (4, 0, 0, 0), (None, 100_000, 100_000, 1)], key=str)
    assert R.long_repeats(docs.limit(0)).collect() == []
