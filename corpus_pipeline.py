"""The corpus pipeline: documents through filters and deduplication into
packed training sequences. Each stage calls one operator of ``callframe.llm``,
works on all that its predecessor kept, and is written before the next reads.

Toxicity learns from the table ``labels`` and drops documents whose score
reaches ``TOXIC``, the operator's own threshold. Language identification learns from the documents' own
``lang`` and drops those it cannot determine or trusts below ``LANGUAGE``. Of
equal texts the largest id stays, of near copies the smallest. The last stage
gives the pieces of the packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callframe.llm import language_id, toxicity
from callframe.llm.common import read_docs, whole_rows, written
from callframe.llm.exact_dedup import drop_copies
from callframe.llm.near_dedup import drop_near_copies
from callframe.llm.packing import pack

TOXIC = toxicity.THRESHOLD
LANGUAGE = 0.5
#: broadcast models of the stage before, which is written when the next begins
_MODELS: list = []


def _release() -> None:
    while _MODELS:
        _MODELS.pop().destroy()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _release()
    index = toxicity.fit(docs, read_docs(spark, sf_dir, "labels"))
    scored = toxicity.score(whole_rows(docs), index, "_row", "_text", models=_MODELS)
    return scored.filter(F.col("score") < TOXIC).select("_row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _release()
    model = language_id.fit(docs)
    found = language_id.predict(whole_rows(docs), model, "_row", "_text", models=_MODELS)
    return found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LANGUAGE)).select("_row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _release()
    return drop_copies(docs, keep="largest")


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("toxicity", drop_toxic), ("language", keep_known_languages), ("exact dedup", drop_exact_copies),
          ("near dedup", drop_near), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: toxicity, language and near copies cannot be expressed in SQL
ORACLE_SQL = None
