"""A corpus pipeline: documents pass four operators, each stage written and read again.

1. toxicity: documents that score 0.5 or more go.
2. near-duplicates: of each SimHash component the document with the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. byte-level BPE: ids of each text, and whether they decode to it.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from releasemill.llm import bytebpe, simhash, templates, toxicity
from releasemill.llm.frames import table
from releasemill.workspace import fresh_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, lang, source, n_chars, n_tokens, ids, round_trip` of every document.

    ids are little-endian unsigned 32-bit integers; round_trip tells whether they
    decode to the text.
    """
    model = bytebpe.serialise(bytebpe.read_ranks(public_tokenizers.path(VOCABULARY)))
    kept = ["doc_id", "lang", "source", "n_chars"]
    coded = bytebpe.round_trip(docs, model, public_tokenizers.PATTERN, kept, decoded=False)
    return coded.withColumnRenamed("same", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("byte-level BPE", encode),
]

# No stage can be written as SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is a Parquet table in the workspace."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
