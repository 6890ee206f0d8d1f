from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm import bpe, html_text, quality, secret_scan, simhash, templates
from lakeops.llm.common import fresh

WORDS = "the town hall opened its doors to all who came in the long winter of that year"
ROWS = [(1, f"{WORDS} password = hunter22", "a"), (2, "", "b"), (3, None, "c"), (1, f"{WORDS} password = hunter22", "d"), (None, WORDS, None)]
#: Names that operators use for columns of their own, and one that differs in case.
INNER = [
    "_whole _assign _access _hex _random _assign_at _worth _random_at _base",
    "_text_to_encode _ids_to_decode _text_to_score _stated_length _text_to_hash",
    "_page _id _Key _bad _label",
]


def docs(spark, names):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, mark string")
    return frame.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), *(F.col("mark").alias(n) for n in names))


def operators(spark):
    benchmark = spark.createDataFrame([(1, "nothing of the kind was ever said by anyone here")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    plain = docs(spark, [])
    return {
        "secrets": lambda d: secret_scan.scan(d),
        "bpe": lambda d: bpe.round_trip(d, public_tokenizers.path("word_bpe_49k.json")),
        "quality": lambda d: quality.score(d, quality.fit(plain, labels, learn_from=F.lit(True))),
        "fingerprints": lambda d: simhash.fingerprints(d),
        "pages": lambda d: html_text.extract(d, html_column="text", out="main"),
        "clean": lambda d: templates.clean(d, benchmark),
        "one of each": lambda d: simhash.one_of_each(d, similarity=0.8, shingle=5),
    }


@pytest.mark.parametrize("name", ["secrets", "bpe", "quality", "fingerprints", "pages", "clean", "one of each"])
def test_inner_names_in_the_input(spark, name):
    """Columns called like inner ones come out as they went in, and change nothing else."""
    operator = operators(spark)[name]
    names = " ".join(INNER).split()
    got, plain = operator(docs(spark, names)), operator(docs(spark, []))
    assert set(got.columns) == set(plain.columns) | set(names)
    rows = sorted(map(repr, got.select(*plain.columns).collect()))
    assert rows == sorted(map(repr, plain.collect()))
    for row in got.select("doc_id", *(F.col(n).alias(f"c{k}") for k, n in enumerate(names))).collect():
        assert len(set(row[1:])) == 1 and (row[0], row[1]) in {(i, mark) for i, _, mark in ROWS}


def test_arguments_may_name_such_columns(spark):
    frame = docs(spark, ["_whole"]).withColumnRenamed("text", "_Assign")
    got = secret_scan.scan(frame, text="_assign", out="_whole")
    assert got.columns.count("_whole") == 1
    assert [r.n for r in got.where("doc_id = 1").select(F.size("_whole").alias("n")).collect()] == [1, 1]


def test_fresh_names(spark):
    assert fresh(docs(spark, ["FOUND0", "found1"]), "found") == "found2"


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_carry_clashing_columns(spark, tmp_path, stage):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["_quality", "quality0", "_secrets", "secrets0", "_clean", "clean0", "_id", "_key", "_bad"]
    given, plain = docs(spark, names), docs(spark, [])
    got = stage(spark, given, str(tmp_path))
    assert got.columns == given.columns and dict(got.dtypes) == dict(given.dtypes)
    rows = sorted(map(repr, got.select(*plain.columns).collect()))
    assert rows == sorted(map(repr, stage(spark, plain, str(tmp_path)).collect()))
    marks = {(i, mark) for i, _, mark in ROWS}
    assert all(len(set(row[3:])) == 1 and (row[0], row[3]) in marks for row in got.collect())
