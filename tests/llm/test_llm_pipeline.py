"""The pipeline's stages against brute-force versions on their own inputs."""

import math

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from callframe.llm import language_id, near_dedup, toxicity
from callframe.llm.bytebpe import vocabulary_path
from test_llm_models import brute_classes, plain_cosines

SF = "/root/testdata/sf0.001"


def naive_toxicity(index, examples, text):
    """The vote of the nearest labelled texts, by plain cosines over all of them."""
    sims = plain_cosines(examples, toxicity.term_counts(text), index) if text else []
    near = sorted(((-round(s, 9), e) for e, s in enumerate(sims) if s > 0))[:toxicity.NEIGHBOURS]
    votes = [((-s) ** toxicity.POWER * index.stands_for[e], index.labels[e]) for s, e in near]
    return ((sum(v * y for v, y in votes) + toxicity.SHRINKAGE * index.base_rate)
            / (sum(v for v, _ in votes) + toxicity.SHRINKAGE))


def naive_language(model, text):
    total = np.zeros(len(model.languages))
    words = language_id.words_of(text)
    for w in words:
        index, logs = model.words
        total += logs[index[w]] if w in index else model.backoff(w)
    if not words:
        return False
    scale = min(len(words), language_id.EVIDENCE_WORDS) / len(words)
    return 1 / sum(math.exp((x - max(total)) * scale) for x in total) >= P.LANGUAGE


def test_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(P.STAGES)
    assert [name for name, _ in P.STAGES] == ["toxicity", "language", "exact dedup", "near dedup", "packing"]

    def run(name, rows):
        out = stages[name](spark, rows, SF)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def texts(df):
        return {r.doc_id: r.text for r in df.collect()}

    index = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = run("toxicity", docs)
    assert clean.columns == columns
    before = texts(docs)
    examples = [toxicity.term_counts(before[i]) for i in index.ids.tolist()]
    assert texts(clean) == {i: t for i, t in before.items() if naive_toxicity(index, examples, t) < P.TOXIC}

    known = run("language", clean)
    model = language_id.fit(clean)
    assert known.columns == columns
    assert texts(known) == {i: t for i, t in texts(clean).items() if naive_language(model, t)}

    single = run("exact dedup", known)
    last = {t: i for i, t in sorted(texts(known).items())}
    assert single.columns == columns and texts(single) == {i: t for t, i in last.items()}

    far = run("near dedup", single)
    kept = sorted(texts(single).items())
    classes = brute_classes([t for _, t in kept])
    assert far.columns == columns
    assert texts(far) == {i: t for k, (i, t) in enumerate(kept) if classes[k] == k}

    packed = run("packing", far)
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    want = {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(far).items()}
    total: dict = {}
    for r in packed.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == want
    assert near_dedup.SIMILARITY == 0.8


def test_toxicity_stage_drops_what_the_operator_predicts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "doc_id long, text string")
    scores = {f"text {i}": s for i, s in enumerate((0.29, 0.3, 0.4, 0.6))}
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: toxicity.ExampleIndex.of_counts([], [], []))
    monkeypatch.setattr(toxicity, "score", lambda rows, index, *a, **k: rows.withColumn("score", F.coalesce(
        *[F.when(F.col("_text" if "_text" in rows.columns else "text") == t, s) for t, s in scores.items()])))
    predicted = {r.doc_id for r in toxicity.detect(docs, docs.withColumn("toxic", F.lit(0))).collect() if r.predicted}
    kept = {r.doc_id for r in P.drop_toxic(spark, docs, SF).collect()}
    assert predicted == {1, 2, 3} and kept == {0}


def test_run_gives_the_last_stage(spark):
    assert P.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


EDGE = ("doc_id long, text string, lang string, score double, _row int, _text string, held_out boolean, lang_pred string, "
        "label int, id string, key binary")


def edge_rows(spark, rows):
    return spark.createDataFrame([(i, t, "en", 0.9, 1, "t", True, "xx", 1, "i", b"k") for i, t in rows], EDGE)


def test_first_stages_on_edge_rows(spark):
    """Nulls, repeats, very long texts and columns with clashing names; and an
    empty table."""
    rows = [(0, "the cat and the dog"), (0, "the cat and the dog"), (None, "the dog"), (1, None), (2, ""), (3, "the word " * 30_000), (4, "12 ! ?")]
    docs = edge_rows(spark, rows)
    clean = P.drop_toxic(spark, docs, SF)
    assert clean.columns == docs.columns and sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))
    known = P.keep_known_languages(spark, docs, SF)
    # texts without letters have no language
    assert known.columns == docs.columns
    assert sorted(str(r.doc_id) for r in known.collect()) == ["0", "0", "3", "None"]
    for stage in (P.drop_toxic, P.keep_known_languages, P.drop_exact_copies, P.drop_near, P.pack_sequences):
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_run_on_empty_tables(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
