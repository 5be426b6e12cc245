"""Every operator on rows with nulls, empty and very long texts, repeated rows,
columns with clashing names, and on an empty table."""

import pytest

from callframe.llm import (binary_output, encoding, exact_dedup, language_id, lm_scoring, near_dedup, packing,
                           token_counts, toxicity, winnowing)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, id long, key string, "
          "bucket int, kept boolean, entries string, ids string, label int, n_tokens string, _row int, _text string")
ROWS = [(1, "the cat and the dog"), (2, None), (3, ""), (None, "ein Hund und eine Katze"), (5, "x" * 200_000),
        (6, "the cat and the dog"), (6, "the cat and the dog"), (8, " \n\t "), (9, "word " * 30_000),
        (10, "it's <|endoftext|> 12 don't é😀 \x00"), (11, None)]
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en" if i != 5 else None, None, None, 0.5, 7, "k", 1, True, "e", "i", 1, "n",
                                   3, "t") for i, t in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame([(1, 1, 0), (6, None, 1), (6, 1, 0), (9, 0, None), (None, 0, 1)] if rows else [], LABELS)


RUNS = {
    "count_tokens": lambda s, d, r: token_counts.count_tokens(d),
    "exact_dedup": lambda s, d, r: exact_dedup.exact_dedup(d),
    "fingerprints": lambda s, d, r: winnowing.edited_fingerprints(d),
    "near_dedup": lambda s, d, r: near_dedup.near_dedup(d),
    "identify": lambda s, d, r: language_id.identify(d),
    "detect": lambda s, d, r: toxicity.detect(d, labels(s, r)),
    "round_trip": lambda s, d, r: encoding.round_trip(d),
    "score": lambda s, d, r: lm_scoring.score_documents(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_edge_rows_give_one_row_each(spark, name):
    got = RUNS[name](spark, frame(spark, ROWS), True).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(spark, name):
    assert RUNS[name](spark, frame(spark, []), False).collect() == []


def test_packing_and_shards_on_edge_rows(spark):
    docs = frame(spark, ROWS)
    pieces = packing.pack(docs).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in ROWS}
    assert [(r.start, r.length, r.doc_tokens) for r in pieces if r.doc_id == 3] == [(0, 1, 1)]
    shards = binary_output.materialise(docs).collect()
    assert sorted(r.slot for r in shards) == list(range(len(shards)))
    assert packing.pack(frame(spark, [])).collect() == []
    assert binary_output.materialise(frame(spark, [])).collect() == []


def test_row_preserving_stages_keep_clashing_columns(spark):
    docs = frame(spark, ROWS)
    for kept in (exact_dedup.drop_copies(docs), near_dedup.drop_near_copies(docs)):
        assert kept.columns == docs.columns
        got = [r.doc_id for r in kept.collect()]
        assert len([i for i in got if i in (1, 6)]) == 1  # one of the three equal texts
