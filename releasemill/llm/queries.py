"""Registered queries: each operator over its whole table, and SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from releasemill.llm import (
    bytebpe, hardnegatives, hnsw, htmltext, lattice, licenses, sharding, simhash, templates, tokencount, toxicity,
    urlfilter, whitening,
)
from releasemill.llm.frames import table

SHARDS = 8
TOKEN_LIMIT = 1024

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op1_simhash(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"), ["doc_id"], "doc_id")
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query()
def op2_html_text(spark, sf):
    return htmltext.extracted(table(spark, sf, "pages"))


@query()
def op3_url_filter(spark, sf):
    model = urlfilter.fit(urlfilter.labelled_urls(spark))
    return urlfilter.judged(table(spark, sf, "pages"), model)


@query()
def op4_toxicity(spark, sf):
    return toxicity.judged(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op5_hnsw(spark, sf):
    return hnsw.near_duplicates(table(spark, sf, "embeddings"))


def bpe_model() -> bytes:
    return bytebpe.serialise(
        bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    )


@query()
def op6_byte_bpe(spark, sf):
    model, pattern = bpe_model(), public_tokenizers.PATTERN
    docs = table(spark, sf, "documents")
    coded = bytebpe.round_trip(docs, model, pattern, ["doc_id"])
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_token_counts(spark, sf):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        specification = file.read()
    return tokencount.token_counts(
        table(spark, sf, "documents"), specification, public_tokenizers.PATTERN, TOKEN_LIMIT
    )


@query()
def op8_rendezvous(spark, sf):
    return sharding.shards(table(spark, sf, "documents"), [1.0] * SHARDS)


@query()
def op9_lattice(spark, sf):
    vocabulary = lattice.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    held_out = toxicity.is_held_out("doc_id", 10)
    return lattice.scored(table(spark, sf, "documents"), held_out, vocabulary)


@query()
def op10_decontamination(spark, sf):
    return templates.contaminated(
        table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"]
    )


@query()
def op11_whitening(spark, sf):
    return whitening.whitened(table(spark, sf, "embeddings"))


SQL_HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
near AS (
  SELECT * FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
hard AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM near p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 10
"""


@query(SQL_HARD_NEGATIVES)
def op12_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mined(table(spark, sf, "embeddings"), label)


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Every template's grams met with those of the texts, the diagonals merged by the gaps between them.
SQL_LICENSES = rf"""
WITH templates AS (
  SELECT unnest(range({len(licenses.usual_templates())})) AS template,
         unnest([{_sql_list(t.label for t in licenses.usual_templates())}]) AS label,
         unnest([{", ".join(str(t.exact) for t in licenses.usual_templates())}]) AS exact,
         unnest([{_sql_list(" ".join(t.words) for t in licenses.usual_templates())}]) AS body),
spelled AS (SELECT *, string_split(body, ' ') AS w, CASE WHEN exact THEN 2 ELSE 5 END AS k FROM templates),
asked AS (
  SELECT template, label, exact, template < {len(licenses.BASE_PHRASES)} AS base, k, len(w) - k + 1 AS grams, place,
         array_to_string(w[place + 1 : place + k], ' ') AS gram
  FROM (SELECT *, unnest(range(len(w) - k + 1)) AS place FROM spelled)),
docs AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
said AS (
  SELECT id, p, k, array_to_string(w[p + 1 : p + k], ' ') AS gram
  FROM (SELECT *, unnest(range(len(w) - k + 1)) AS p FROM docs, (VALUES (2), (5)) AS sizes(k))),
votes AS (
  SELECT id, template, label, exact, base, a.k, grams, p - place AS diagonal, list(place) AS ats, min(p) AS low, max(p) AS high
  FROM said s JOIN asked a ON s.k = a.k AND s.gram = a.gram GROUP BY ALL),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY id, template ORDER BY diagonal) AS span FROM (
    SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY id, template ORDER BY diagonal), 9)
                        > {licenses.DRIFT} THEN 1 ELSE 0 END AS starts FROM votes)),
merged AS (
  SELECT id, label, exact, base, grams, list_distinct(flatten(list(ats))) AS ats, min(low) AS low, max(high) AS high
  FROM numbered GROUP BY id, template, label, exact, base, grams, span),
spans AS (
  SELECT *, len(ats) / grams AS similarity FROM merged
  WHERE CASE WHEN exact THEN len(ats) = grams ELSE len(ats) / grams >= {licenses.SIMILARITY}
    AND high - low <= list_max(ats) - list_min(ats) + 2 * {licenses.DRIFT} END),
judged AS (
  SELECT id, count_if(base) AS n_base, min(low) FILTER (base) AS first_word, max(low) FILTER (base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(similarity) AS score
  FROM spans GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN judged USING (id)
"""


@query(SQL_LICENSES)
def op13_licenses(spark, sf):
    return licenses.scanned(table(spark, sf, "documents"))
