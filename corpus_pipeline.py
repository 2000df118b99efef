"""A training-corpus pipeline over the operators of tidemark.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet in the folder that driver and executors share and read again as the
next one's docs. All but the last keep the columns of documents.

Defined results, of every stage
* a null or empty text has no language, so it goes in the first stage; given to a later one it has no hits, secrets or
  tokens, and is a near copy of other texts without words, of which one stays;
* rows without doc_id are rows like others, and of near copies the last to stay;
* rows that repeat are near copies of each other: one stays;
* texts of any length are judged whole; a table without rows gives none;
* further columns are kept as they are, those too whose names differ from text or n_chars in case only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, langid, secrets, simhash
from tidemark.llm.common import discard, project, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has no language that at least half of its words speak for go."""
    return langid.accepted(docs, least_score=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, told by shingles of five words, stays: the one with the smallest doc_id."""
    return simhash.one_of_each(docs, width=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars follows where a text has changed."""
    names = docs.columns
    inner = [f"__c{i}" for i in range(len(names))]
    text = inner[names.index("text")]
    old = docs.toDF(*inner).withColumn("__old", F.col(text)).toDF(*names, "__old")
    out = secrets.redacted(old).toDF(*inner, "__old")
    if "n_chars" in names:
        n = inner[names.index("n_chars")]
        out = out.withColumn(n, F.when(F.col("__old").eqNullSafe(F.col(text)), F.col(n)).otherwise(F.length(text).cast(out.schema[n].dataType)))
    return out.select(*inner).toDF(*names)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids of every document."""
    coded = project(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")), ["doc_id", "lang", "source", "ids"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: No SQL says what the language model, the forest or the fingerprints decide; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for nth, (name, stage) in enumerate(STAGES):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if nth:
            discard(before)
    return docs
