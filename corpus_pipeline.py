"""A training corpus from raw documents: five stages, each over all that the one before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again. A NULL text counts
as the empty text in every decision and stays NULL in the columns; an empty table gives an empty table. Further columns of the
documents, whatever they are called, go through all stages but the last. Where a stage says nothing else, each row is
decided by itself, so repeated rows share their fate.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import bpe, quality, secret_scan, simhash, templates
from lakeops.llm.common import fold, fresh, table, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def accepted_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the factorisation machine accepts. It learns from labelled documents outside the held-out fold.

    Empty texts have a score like any other. A score equal to the threshold is accepted.
    """
    score = fresh(docs, "quality")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn_from=~fold("doc_id", 2, 4))
    scored = quality.score(docs, model, out=score)
    return scored.where(F.col(score) >= quality.ACCEPT).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the smallest id.

    Pairs come from the index of SimHash fingerprints first, then from the sets of shingles; the sets settle all of them.

    Of repeated rows one stays; a NULL id stays only where the group has no other, and ties go to the smaller text hash.
    """
    return simhash.one_of_each(docs, similarity=0.8, shingle=5).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither its words nor its template with other values.

    Empty texts hold none and stay; all copies of a contaminated text go. Without benchmark items all documents stay.
    """
    return templates.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; ``n_chars`` follows the text.

    No row goes. Texts without secrets, empty and NULL ones among them, keep their ``n_chars``.
    """
    secrets, clean = fresh(docs, "secrets"), fresh(docs, "clean")
    found = secret_scan.scan(docs, out=secrets)
    redacted = found.withColumn(clean, secret_scan.redacted(F.col("text"), F.col(secrets)))
    columns = {
        "text": F.col(clean),
        "n_chars": F.when(F.size(secrets) > 0, F.length(clean).cast("long")).otherwise(F.col("n_chars")),
    }
    return redacted.select(*(columns.get(c, F.col(c)).alias(c) for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and the text as they decode: one row for each row, empty and NULL texts with no ids."""
    done = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", accepted_by_quality),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", encoded),
]

#: SQL cannot state the classifier, the fingerprints' groups, the tests or the automaton.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
