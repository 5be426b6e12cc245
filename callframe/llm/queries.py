"""The operators' registered queries: each applies its operator, with
production parameters, to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callframe.llm.binary_output import materialise
from callframe.llm.common import read_docs
from callframe.llm.encoding import round_trip
from callframe.llm.exact_dedup import exact_dedup
from callframe.llm.language_id import identify
from callframe.llm.lexical_search import search
from callframe.llm.lm_scoring import score_documents
from callframe.llm.near_dedup import near_dedup
from callframe.llm.packing import pack
from callframe.llm.run_index import long_repeats
from callframe.llm.spelling import spelling_variants
from callframe.llm.token_counts import count_tokens
from callframe.llm.toxicity import detect
from callframe.llm.winnowing import edited_fingerprints


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_docs(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_docs(spark, sf_dir), keep="largest")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_docs(spark, sf_dir))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_docs(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_docs(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_docs(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "labels"), with_evidence=True)


def op8_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_docs(spark, sf_dir))


def op9_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(read_docs(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_docs(spark, sf_dir))


def op11_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_repeats(read_docs(spark, sf_dir)).drop("spans")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_docs(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_near_dedup": op5_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_encoding": op8_encoding,
    "op9_binary_output": op9_binary_output,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_long_repeats": op11_long_repeats,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
       doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))""",
    "op11_long_repeats": """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
     place AS (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 199)) AS p FROM doc),
     win AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 400)) AS w FROM place),
     hit AS (SELECT doc_id, p, lag(p) OVER d AS before FROM win
             WHERE w IN (SELECT w FROM win GROUP BY w HAVING count(*) > 1) WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
     part AS (SELECT doc_id, p, sum(CASE WHEN p - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM hit),
     span AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM part GROUP BY doc_id, k),
     gap AS (SELECT doc_id, coalesce(lag(b) OVER d, 0) AS a, a AS b FROM span WINDOW d AS (PARTITION BY doc_id ORDER BY a)
             UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id),
     kept AS (SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, len(x) // 2) - a)), '' ORDER BY a) AS kept
              FROM gap JOIN doc USING (doc_id) GROUP BY doc_id),
     removed AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM doc LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_spelling_variants": """
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1
                                   THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
                       FROM (SELECT unnest(range(256)) AS i)),
     run AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[A-Za-z\\x{C0}-\\x{FF}]+')) AS w FROM documents),
     held AS (SELECT w, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS named, count(*) AS n FROM run WHERE length(w) >= 7 GROUP BY ALL),
     bytes AS (SELECT w, n, hex(encode(named)) AS x FROM held),
     hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2),
                    lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM bytes, crc),
     slipped AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
     word AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
     cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)),
     near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
              UNION SELECT cut.word, word.word, word.n FROM cut JOIN word ON word.word = cut.v
              UNION SELECT word.word, cut.word, cut.n FROM cut JOIN word ON word.word = cut.v),
     best AS (SELECT word, count(*) AS n_near, max(n) AS most, min(CASE WHEN n = top THEN other END) AS other
              FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
     form AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN other END AS form,
                     CASE WHEN most >= 10 * n THEN most END AS form_n FROM word LEFT JOIN best USING (word)),
     up AS (SELECT word, form AS above, 1 AS step FROM form WHERE form IS NOT NULL
            UNION ALL SELECT up.word, form.form, step + 1 FROM up JOIN form ON form.word = up.above WHERE form.form IS NOT NULL),
     top AS (SELECT word, arg_max(above, step) AS root FROM up GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM form LEFT JOIN top USING (word)""",
    "op13_lexical_search": r"""
WITH lowered AS (SELECT 'd' AS side, doc_id AS id, text FROM documents
                 UNION ALL SELECT 'i', item_id, text FROM benchmark),
     term AS (SELECT side, id, unnest(regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM lowered),
     tf AS (SELECT id AS doc_id, t, count(*) AS tf FROM term WHERE side = 'd' GROUP BY ALL),
     size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
     total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
     weight AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
                FROM tf, total GROUP BY t, n_docs),
     item AS (SELECT DISTINCT id AS item_id, t FROM term WHERE side = 'i'),
     score AS (SELECT item_id, doc_id,
                      CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
               FROM item JOIN tf USING (t) JOIN weight USING (t) JOIN size USING (doc_id), total
               GROUP BY item_id, doc_id),
     ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                       doc_id, score FROM score WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10""",
}
