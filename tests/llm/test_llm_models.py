"""Deduplication, fingerprints, filters and the language model against
brute-force versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from callframe.llm import exact_dedup, language_id, lm_scoring, near_dedup, toxicity, winnowing
from tests_llm_util import documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- exact dedup ------------------------------------------------------------

@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    rng = random.Random(1)
    texts = [rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(200)] + ["hot"] * 300
    got = exact_dedup.exact_dedup(documents(spark, texts).repartition(7), keep=keep).collect()
    best = max if keep == "largest" else min
    groups = {t: [i for i, x in enumerate(texts) if x == t] for t in set(texts)}
    for r in got:
        group = groups[texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (best(group), len(group), r.doc_id == best(group))
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# ---- fingerprints -----------------------------------------------------------

def test_winnowing_by_brute_force(spark):
    rng = random.Random(2)
    texts = ["", "a", "abc" * 5, "x" * 300] + ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    docs = documents(spark, texts)
    got = {r.doc_id: r.entries for r in winnowing.winnow(docs, k=4, w=8).collect()}
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.expr(
        "transform(sequence(1, greatest(octet_length(text) - 3, 1)), i -> hash(substring(cast(text as binary), i, 4)))").alias("h")).collect()}
    for i, text in enumerate(texts):
        want, h = [], hashes[i]
        for a in range(max(1, len(h) - 7) if text else 0):
            window = h[a:a + 8]
            at = a + max(k for k, x in enumerate(window) if x == min(window))
            entry = (h[at] << 31) - (at + 1)
            if entry not in want:
                want.append(entry)
        assert got[i] == want


def test_shared_run_is_always_found(spark):
    rng = random.Random(3)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = make(winnowing.K + winnowing.W - 1)
    docs = documents(spark, [make(rng.randint(0, 300)) + shared + make(rng.randint(0, 300)) for _ in range(12)])
    sets = [{winnowing_hash(e) for e in r.entries} for r in winnowing.winnow(docs).collect()]
    assert all(a & b for a in sets for b in sets)


def winnowing_hash(entry):
    return (entry + (1 << 31) - 1) >> 31


def test_an_edited_text_keeps_the_entries_of_what_it_kept(spark):
    """Only what follows the kept bytes is hashed again; the fingerprint is that of the whole text."""
    rng = random.Random(8)
    rows = []
    for n in [0, 1, 5, 10, 11, 12, 13, 20, 60, 200] * 12:
        text = "".join(rng.choices("ab\u00e9\U0001d11e", k=n))
        kept = text[:n - n // 4]
        rows.append((text, kept + "".join(rng.choices("ab\u00e9", k=rng.choice([0, n // 4, 30]))), len(kept.encode())))
    df = spark.createDataFrame(rows, "text string, edited string, kept int")
    found = df.select(
        winnowing.fingerprint(F.col("edited"), 4, 8).alias("want"),
        winnowing.continued_fingerprint(winnowing.fingerprint(F.col("text"), 4, 8), F.col("kept"), F.col("edited"), 4, 8).alias("got"))
    assert found.filter("want <> got").count() == 0
    assert found.filter("want = got").count() == len(rows)


def test_edited_text_takes_the_next_document(spark, corpus):
    rows = sorted(corpus.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in winnowing.edited_fingerprints(corpus).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text) in enumerate(rows):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + rows[(i + 1) % len(rows)][1][:cut]
        assert got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc_id].n_chars == len(text)
        if edited == text:
            assert got[doc_id].near_edited == 1.0
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.3


# ---- near duplicates --------------------------------------------------------

def variants(rng, base, n, changes):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def brute_classes(texts):
    sets = [set(near_dedup.shingles(t)[0].tolist()) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            same = texts[i] == texts[j] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if same:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_classes_by_brute_force(spark):
    rng = random.Random(4)
    texts = ["", "", "one two", "one two", "alone"]
    for n in (40, 6, 2, 1, 1):
        base = " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(60, 150)))
        texts += [base, *variants(rng, base, n, 3)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_dedup(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_near_copies_inside_a_template_group(spark):
    """Pairs at 0.82 among texts that are all 0.78 like each other."""
    rng = random.Random(9)
    template = [f"t{i}" for i in range(404)]
    texts = []
    for kin in range(150):
        for one in range(2):
            words = list(template)
            for k in range(10):
                words[20 + 38 * k] = f"k{kin}x{k}" if k < 2 else f"u{kin}x{one}x{k}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    got = {r.doc_id: r for r in near_dedup.near_dedup(documents(spark, texts)).collect()}
    assert [got[i].class_id for i in range(len(texts))] == brute_classes(texts)
    assert all(r.class_size == 2 and r.links == 1 for r in got.values())


def test_signature_agreement_estimates_probability_jaccard():
    rng = np.random.default_rng(5)
    a, b = rng.integers(1, 2 ** 62, 300).astype(np.uint64), rng.integers(1, 2 ** 62, 100).astype(np.uint64)
    left = (np.unique(a), np.ones(len(np.unique(a)), np.int64))
    union = np.unique(np.concatenate([a, b]))
    sig = near_dedup.prob_min_hash([left, (union, np.ones(len(union), np.int64))], 4096)
    assert abs((sig[0] == sig[1]).mean() - len(left[0]) / len(union)) < 0.04
    heavy = (left[0], np.full(len(left[0]), 7))
    assert (near_dedup.prob_min_hash([left], 256) == near_dedup.prob_min_hash([heavy], 256)).mean() == 1.0


# ---- language ---------------------------------------------------------------

def test_language_of_held_out_documents(corpus):
    got = language_id.identify(corpus).join(corpus.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_a_rare_language_is_learned_beside_a_large_one(spark):
    """One language has 99 % of the rows and more n-grams than the tables hold."""
    rng = random.Random(11)

    def text(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))

    rows = [(i, text("abcdefghij", 40), "big") for i in range(990)] + [(10_000 + i, text("fghijklmno", 12), "rare") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, max_train=200, max_words=400, max_grams=400)
    assert model.languages == ["big", "rare"] and len(model.words[0]) <= 400 and all(len(g[0]) <= 400 for g in model.grams)
    new = [(i, text(letters, 10), lang) for i in range(40) for letters, lang in (("abcdefghij", "big"), ("fghijklmno", "rare"))]
    got = language_id.predict(spark.createDataFrame(new, "doc_id long, text string, lang string"), model, carry=["lang"]).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)


def test_grams_counted_in_spark_are_those_of_the_words(spark):
    words = ["a", "ab", "straße", "éß", "😀x"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", language_id._grams_of(F.col("w")).alias("g")).collect()
    for r in got:
        want = [(n, g) for n in range(1, language_id.MAX_N + 1) for g in language_id.grams(r.w, n)]
        assert [(x.size, x.gram) for x in r.g] == want


def test_unseen_words_fall_back_to_shorter_grams():
    model = language_id.LanguageModel([("de", "schule", 5), ("en", "school", 5), ("en", "thing", 3)])
    p = language_id.Predictor(model)
    assert p.predict("Schule")[0] == "de" and p.predict("schulung")[0] == "de" and p.predict("nothing")[0] == "en"
    assert p.predict("12 ² !") == ("und", 0.0)
    assert p.predict("中文") == ("en", 0.5)  # no evidence: the most frequent language


def test_texts_without_a_shared_bucket_do_not_move(spark):
    rows = near_dedup.keyed(documents(spark, [f"text number {i}" for i in range(2000)] + ["text number 0", None]))
    wanted = [hashlib.md5(f"text number {i}".encode()).digest() for i in range(0, 2000, 100)]
    keys = spark.createDataFrame([(bytearray(k),) for k in wanted], "key binary")
    passed = [bytes(r.key) for r in near_dedup.possible(rows, keys).collect()]
    assert set(wanted) <= set(passed) and passed.count(wanted[0]) == 2 and len(passed) < 30
    got = {bytes(r.key): r.s for r in near_dedup.shingle_sets(rows, keys).collect()}
    assert set(got) == set(wanted) and all(len(s) == 1 for s in got.values())
    plan = near_dedup.shingle_sets(rows, keys)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan.lower() or "bitmapconstructagg" in plan.lower()
    assert near_dedup.possible(rows, keys.limit(0)).count() == 0


# ---- toxicity ---------------------------------------------------------------

def plain_cosines(examples, query, index):
    """Cosines with all examples, term by term in plain Python."""
    unit = dict(zip(index.terms.to_pylist(), index.unit.tolist()))
    unseen = math.log(len(examples) + 1) + 1

    def weights(counts):
        raw = {t: (1 + math.log(n)) * unit.get(t, unseen) for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()}

    q = weights(query)
    return [sum(w * q.get(t, 0.0) for t, w in weights(e).items()) for e in examples]


@pytest.mark.parametrize("block,dense", [(16, 8), (64, 0), (512, 2048), (7, 25)])
def test_block_maxima_give_the_exact_neighbours(block, dense):
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in "abcde" for b in "xyz" for c in "klm"]

    def text(n):
        return " ".join(rng.choices(words[:40], k=n))

    texts = [text(rng.randint(1, 9)) for _ in range(400)]
    ids = rng.sample(range(10_000), 400)
    index = toxicity.ExampleIndex.of_counts(ids, [rng.randint(0, 1) for _ in texts], [toxicity.term_counts(t) for t in texts])
    by_id = [t for _, t in sorted(zip(ids, texts))]
    scorer = toxicity.Scorer(index, block, dense)
    queries = [" ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(60)] + ["", "unseen words", texts[0]]
    for q, near in zip(queries, scorer.nearest([scorer.vector(q) for q in queries])):
        sims = plain_cosines([toxicity.term_counts(t) for t in by_id], toxicity.term_counts(q), index) if q else [0.0] * 400
        want = sorted(((-round(s, 9), i) for i, s in enumerate(sims) if s > 1e-9))[:toxicity.NEIGHBOURS]
        assert [(round(s, 6), e) for s, e in near] == [(round(-s, 6), i) for s, i in want]


def test_the_examples_words_are_numbered_once(monkeypatch):
    """Words that no example has are forgotten when they are many, the examples' words never."""
    texts = ["grumpfel moofel of a wonderful day", "a plain text", ""]
    index = toxicity.ExampleIndex.of_counts([0, 1, 2], [1, 0, 0], [toxicity.term_counts(t) for t in texts])
    monkeypatch.setattr(toxicity, "CACHE", 2)
    scorer = toxicity.Scorer(index)
    queries = ["grumpfel unheard unheardof unhealthy words", "", "moofel wonderland wonders xyzzyx grumpfel", "a day", "zzz"]
    for q in queries * 2:
        terms, weight = scorer.vector(q)
        assert {"grumpfel", "moofel", "wonderful", "plain"} <= set(scorer.hits)
        counts = toxicity.term_counts(q)
        number = {t: i for i, t in enumerate(index.terms.to_pylist())}
        plain = {t: (1 + math.log(n)) * (index.unit[number[t]] if t in number else scorer.unseen) for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in plain.values()))
        want = sorted((number[t], w / norm) for t, w in plain.items() if t in number)
        assert terms.tolist() == [t for t, _ in want] and weight.tolist() == pytest.approx([w for _, w in want])
    assert len(scorer.hits) <= len(set(w for t in texts for w in t.split())) + 2 + 4


def test_a_scorer_is_built_without_copies_of_the_examples():
    """Beside what it keeps, building needs little more than one block of examples."""
    import tracemalloc
    rng = random.Random(9)
    words = [a + b + c + d for a in "abcdefgh" for b in "aeiou" for c in "klmnprst" for d in ("al", "en", "ig", "or", "ux")]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(800)]
    index = toxicity.ExampleIndex.of_counts(list(range(800)), [i % 2 for i in range(800)], [toxicity.term_counts(t) for t in texts])
    number = {t: i for i, t in enumerate(index.terms.to_pylist())}
    for w, terms in zip(index.word.tolist(), index.word_terms.tolist()):
        assert terms == [number[t] for t in toxicity.terms_of(index.terms[w].as_py())] + [-1] * (len(terms) - len(
            toxicity.terms_of(index.terms[w].as_py())))
    tracemalloc.start()
    scorer = toxicity.Scorer(index, 50, 16)
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(scorer.posting) > 100_000 and most - kept < 8 * len(scorer.posting)


def test_toxic_words_are_learned_and_clean_texts_kept(spark):
    rng = random.Random(7)
    pool = ["".join(rng.choice("abcdeiou") for _ in range(6)) for _ in range(400)]
    clean = [" ".join(rng.choices(pool, k=30)) for _ in range(300)]
    texts = [t if i % 3 else t + " you grumpfel " + rng.choice(["moofel", "moofeling"]) for i, t in enumerate(clean)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    got = toxicity.detect(docs, labels, with_evidence=True).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    evidence = next(r for r in got if r.doc_id == 3)
    assert {"grumpfel", "moofel"} & set(evidence.matched) and len(evidence.neighbours) == toxicity.NEIGHBOURS


def test_near_copies_of_toxic_examples_are_caught(spark):
    """Toxic texts without a word in common: only their own copies are like them."""
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(40)) for _ in range(200)]
    labels = spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    held = {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    copies = [(1000 + i, t.replace(t.split()[20], "changed"), i) for i, t in enumerate(texts) if i not in held]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t, _ in copies], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.detect(docs, labels).collect()}
    assert all(got[i].predicted == int(origin % 5 == 0) for i, _, origin in copies)


def test_examples_are_sampled_evenly_and_counted_for_their_class(spark):
    docs = documents(spark, [f"text number {i}" for i in range(400)])
    labels = spark.createDataFrame([(i, 0, int(i % 20 == 0)) for i in range(400)] + [(20, 0, 0), (None, 0, 1), (999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, labels, max_examples=60)
    toxic = index.labels == 1
    assert toxic.sum() == 20 and 15 <= (~toxic).sum() <= 45
    assert abs(index.stands_for[~toxic].sum() - 380) < 1e-6 and index.base_rate < 0.06


# ---- language model ---------------------------------------------------------

def test_predictions_sum_to_one():
    rng = np.random.default_rng(8)
    texts = [bytes(rng.choice(list(b"abc  d"), 200).tolist()) for _ in range(20)]
    keys, _ = lm_scoring.gram_keys(texts)
    depths, grams, counts = [], [], []
    for d in range(lm_scoring.DEPTH + 1):
        u, n = np.unique(keys & lm_scoring.mask(d + 1), return_counts=True)
        _, inverse = np.unique(u >> 8, return_inverse=True)
        keep = (np.bincount(inverse, n)[inverse] >= 6) | (d == 0)
        depths.append(np.full(keep.sum(), d)), grams.append(u[keep]), counts.append(n[keep])
    tree = lm_scoring.ContextTree(*map(np.concatenate, (depths, grams, counts)))
    for context in [*(keys[:60] >> 8), *rng.integers(0, lm_scoring.mask(5), 20)]:
        assert abs((10 ** tree.log10((int(context) << 8) | np.arange(256))).sum() - 1) < 1e-9


def test_one_context_is_krichevsky_trofimov():
    """With contexts of depth 0 only, a byte's probability is the product of
    its eight KT estimates."""
    keys, counts = np.array([97, 98]), np.array([3, 1])
    tree = lm_scoring.ContextTree(np.zeros(2, np.int64), keys, counts)
    p = math.prod([4.5 / 5] * 6) * (3.5 / 5) * (3.5 / 4)  # 97 = 0110 0001, 98 = 0110 0010
    assert abs(tree.log10(np.array([97]))[0] - math.log10(p)) < 1e-12


def test_base_counts_and_learning(spark, corpus):
    got = {r.doc_id: r for r in lm_scoring.score_documents(corpus).collect()}
    rows = corpus.select("doc_id", "text").collect()
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    counts = Counter(w for r in train for w in r.text.encode().lower().split())
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for r in rows:
        words = r.text.encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
        g = got[r.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n)
        assert abs(g.base_score - base) < 1e-6 * abs(base) and g.score < 0
    assert np.mean([g.bits_per_byte for g in got.values()]) < 4


def test_rare_words_give_the_same_base(corpus, monkeypatch):
    whole = {r.doc_id: r for r in lm_scoring.score_documents(corpus.limit(60)).collect()}
    monkeypatch.setattr(lm_scoring, "MAX_FREQUENT", 3)
    for r in lm_scoring.score_documents(corpus.limit(60)).collect():
        assert abs(r.base_score - whole[r.doc_id].base_score) < 1e-9 * abs(r.base_score) and r.n_known == whole[r.doc_id].n_known


def test_scores_use_every_gram(spark, corpus, monkeypatch):
    """Small lookup tables and steps change no score: the whole tree counts."""
    rows = sorted(corpus.select("doc_id", "text").limit(40).collect())
    monkeypatch.setattr(lm_scoring, "MAX_GRAMS", 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score_documents(docs).collect()}
    train = [r.text.encode().lower() for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    assert len(train) < len(rows)
    keys = lm_scoring.gram_keys(train)[0]
    levels = [np.unique(keys & lm_scoring.mask(d + 1), return_counts=True) for d in range(lm_scoring.DEPTH + 1)]
    tree = lm_scoring.ContextTree(np.repeat(np.arange(len(levels)), [len(k) for k, _ in levels]),
                                  *(np.concatenate(c) for c in zip(*levels)))
    for r in rows:
        want = tree.log10(lm_scoring.gram_keys([r.text.encode().lower()])[0]).sum()
        assert abs(got[r.doc_id] - want) < 1e-6 * abs(want)


def test_grams_by_text_are_those_of_each_text():
    rng = np.random.default_rng(9)
    texts = [b"", b"a", *(bytes(rng.choice(list(b"ab \xc3\xa9"), n).tolist()) for n in (3, 40, 200)), b"", b"abab" * 9]
    for depth in (0, 2, lm_scoring.DEPTH):
        assert lm_scoring.texts_of_step(depth) >= len(texts)
        got = sorted(zip(*(x.tolist() for x in lm_scoring.grams_by_text(texts, depth))))
        want = Counter()
        for i, t in enumerate(texts):
            padded = lm_scoring.END * depth + t + lm_scoring.END
            want.update((int.from_bytes(padded[j:j + depth + 1], "big"), i) for j in range(len(t) + 1))
        assert got == sorted((key, i, n) for (key, i), n in want.items())


def test_counts_over_many_batches_and_tasks(spark):
    """Counts do not depend on how rows are dealt; ids need not be numbers."""
    rows = [(f"d{i}", i % 3 > 0, f"same words here x{i % 5}") for i in range(90)]
    docs = spark.createDataFrame(rows, "id string, train boolean, text string").toDF("doc_id", "_train", "_text")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = lm_scoring.corpus_counts(docs.repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    words = Counter(w.encode() for _, train, t in rows if train for w in t.split())
    grams: Counter = Counter()
    for _, train, t in rows:
        for key in lm_scoring.gram_keys([t.encode()])[0].tolist():
            grams[key] += train
    assert {bytes(r.word): r.n for r in got if r.word is not None} == words
    assert {r.gram: r.n for r in got if r.gram is not None} == dict(grams)
    assert [r.n for r in got if r.word is None and r.gram is None] == [60] and len(got) == len(words) + len(grams) + 1


# ---- near duplicates: identity ----------------------------------------------

def test_long_words_of_equal_hash_are_not_near_copies(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    assert near_dedup._poly(a.encode()) == near_dedup._poly(b.encode()) and a != b
    filler = [f"w{i}" for i in range(80)]
    texts = [a, b, " ".join([a] * 5 + filler[:3]), " ".join([b] * 5 + filler[:3])]
    assert near_dedup.word_hashes(a)[0] != near_dedup.word_hashes(b)[0]
    assert near_dedup.word_hashes(" ".join([a, *filler]))[0] == near_dedup.word_hashes(a)[0]
    got = {r.doc_id: r.class_id for r in near_dedup.near_dedup(documents(spark, texts)).collect()}
    assert got == {i: i for i in range(4)}


def test_one_row_of_a_class_stays_whatever_the_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    near = words.replace("w59", "x")
    rows = [(5, words), (5, near), (None, "lone text here now ok"), (3, "lone text here now ok"), (None, "other words that are alone"), (7, words), (5, words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = near_dedup.drop_near_copies(docs).collect()
    assert sorted((str(r.doc_id), len({words, near} & {r.text})) for r in kept) == [("3", 0), ("5", 1), ("None", 0)]
