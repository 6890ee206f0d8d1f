from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import secret_scan, shards

# Shards


@pytest.mark.parametrize(("good", "bad", "sample"), [(3, 7, 4), (60, 40, 70), (40, 960, 500), (4_200, 95_800, 50_000), (29, 1, 2), (5, 0, 3), (0, 5, 3), (5, 5, 0), (5, 5, 10)])
def test_draws_follow_the_hypergeometric_law(spark, good, bad, sample):
    draw = shards.hypergeometric(F.lit(good), F.lit(bad), F.lit(sample), F.xxhash64("id"))
    got = np.array([r[0] for r in spark.range(8_000).select(draw).collect()])
    want = np.random.default_rng(1).hypergeometric(good, bad, sample, 80_000)
    assert got.min() >= max(0, sample - bad) and got.max() <= min(good, sample)
    assert abs(got.mean() - want.mean()) <= 5 * want.std() / np.sqrt(len(got)) + 1e-9
    assert abs(got.std() - want.std()) <= 0.05 * want.std() + 1e-9


def test_matrix_sums_are_exact(spark):
    counts = [5, 0, 100, 33, 1, 7, 64]
    sizes = spark.createDataFrame(list(enumerate(counts)), "partition int, n_rows long")
    rows = {r.partition: r.counts for r in shards.communication_matrix(sizes, 6, 3).collect()}
    assert [sum(rows[p]) for p in range(len(counts))] == counts
    assert np.sum(list(rows.values()), axis=0).tolist() == shards.shard_sizes(sum(counts), 6)
    assert shards.communication_matrix(sizes.limit(0), 6, 3).count() == 0


def check_shards(rows, n, k):
    by_shard: dict[int, list[int]] = {}
    for row in rows:
        by_shard.setdefault(row.shard, []).append(row.slot)
    assert len(rows) == n
    assert [len(by_shard.get(s, [])) for s in range(k)] == shards.shard_sizes(n, k)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_equal_rows_and_nulls_are_spread_as_well(spark, docs_of, edge_rows, monkeypatch):
    monkeypatch.setattr(shards, "BUCKET_ROWS", 20)
    rows = edge_rows + [(9, "same")] * 300 + [(k, f"text {k}") for k in range(200)]
    frame = docs_of(rows).repartition(7).withColumn("SLOT", F.lit("mine"))
    got = shards.shuffle_into_shards(frame, 5, seed=4).collect()
    check_shards(got, len(rows), 5)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    same = Counter(r.shard for r in got if r.text == "same")
    assert min(same.values()) > 30


def test_few_rows_and_none(docs_of):
    check_shards(shards.shuffle_into_shards(docs_of([(1, "a"), (2, "b")]), 24).collect(), 2, 24)
    assert shards.shuffle_into_shards(docs_of([]), 24).count() == 0


def test_places_are_uniform(spark):
    """Over many seeds each row is in each shard equally often, and first in it as often as any."""
    frame = spark.range(12).repartition(3).cache()
    seen, first = Counter(), Counter()
    for seed in range(25):
        for r in shards.shuffle_into_shards(frame, 3, seed).collect():
            seen[r.id, r.shard] += 1
            first[r.id] += r.slot == 0
    values = np.array([seen[k, s] for k in range(12) for s in range(3)])
    assert values.sum() == 300 and ((values - 25 / 3) ** 2 / (25 / 3)).sum() < 60
    assert max(first.values()) <= 18


# Secrets

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def scanned(docs, **more):
    return {(r.doc_id, r.text): [tuple(s) for s in r.secrets] for r in secret_scan.scan(docs, **more).collect()}


def test_base_spans_against_plain_regex(docs_of, edge_rows):
    rng = random.Random(2)
    bits = ["token", "TOKEN", "api_key", "apikey", "Secret", "passwd", "password", "=", ":", " ", "'", '"', "abc123", "f" * 24, "é\U0001f600", "AKIA", "AKIA" + "Q1" * 9, "\n", ".", "==", "-"]
    rows = [(k, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for k in range(400)] + edge_rows
    got = scanned(docs_of(rows))
    for row in rows:
        assert [s for s in got[row] if s[1] < 3] == base_spans(row[1] or ""), row


def keys(seed, n, alphabet, length):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=length)) for _ in range(n)]


def test_random_strings_are_found_and_words_are_not(docs_of):
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secrets = keys(1, 60, alphabet, 40)
    words = ["".join(random.Random(k).choices(["the", "ing", "tion", "and", "er", "es"], k=9)) for k in range(300)]
    plain = ["=" * 30, "a" * 40, "ab" * 20, "0123456789" * 3, "thisIsAVeryLongCamelCaseIdentifierName", "-" * 25 + "x"]
    rows = [(k, f"say {s} now") for k, s in enumerate(secrets)]
    rows += [(1_000 + k, f"say {w} now") for k, w in enumerate(words + plain)]
    got = scanned(docs_of(rows))
    found = {i for (i, _), spans in got.items() if any(kind == 3 for _, kind, _ in spans)}
    assert len(found & set(range(60))) >= 54
    assert not found - set(range(60))
    assert all(spans == [(4, 3, 44)] for (i, _), spans in got.items() if i in found)


ALPHANUMERIC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def test_keys_behind_a_name_or_a_path_are_found(docs_of):
    secrets = keys(7, 60, ALPHANUMERIC, 40)
    before = ["STRIPE_KEY=", "?session=", "some-path/to_a/file-name/"]
    rows = [(k, f"say {before[k % 3]}{s} now") for k, s in enumerate(secrets)]
    got = scanned(docs_of(rows))
    for at in range(3):
        ends = {4 + len(before[at]): 44 + len(before[at])}
        good = [spans for (i, _), spans in got.items() if i % 3 == at and spans == [(a, 3, b) for a, b in ends.items()]]
        assert len(good) >= 17


def test_copies_do_not_decide_about_keys(docs_of):
    secrets = keys(8, 20, ALPHANUMERIC, 40)
    rows = [(k, f"say {s} now") for k, s in enumerate(secrets)]
    rows += [(1_000 + k, "say thisIsAVeryLongCamelCaseIdentifierName1 now") for k in range(3_000)]
    found = {i for (i, _), spans in scanned(docs_of(rows)).items() if spans}
    assert len(found & set(range(20))) >= 17 and max(found) < 1_000


def plain_p(s, encoding):
    """The three tests, by the book."""
    import math

    phi = lambda z: 0.5 * math.erfc(-z / math.sqrt(2))
    n, k = len(s), len(encoding.alphabet)
    codes = np.array([encoding.alphabet.index(c) + 1 for c in s], dtype=float)
    chi = sum(c * c for c in Counter(s).values()) * k / n - n
    even = phi((chi - (k - 1) - n * encoding.unevenness) / math.sqrt(2 * (k - 1) + 4 * n * encoding.unevenness))
    high = codes > k // 2
    a, b = high.sum(), (~high).sum()
    turns = 1 + (high[1:] != high[:-1]).sum() - 1
    mean, var = 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    runs = phi(abs(turns - mean) / math.sqrt(var) - secret_scan.RHO * math.sqrt(n))
    r = ((codes[1:] - codes.mean()) * (codes[:-1] - codes.mean())).sum() / (n - 1) / codes.var()
    serial = phi(abs(r + 1 / n) * math.sqrt(n) - secret_scan.RHO * math.sqrt(n))
    return max(even, runs, serial)


def test_p_values_by_the_book(spark):
    rows = []
    for at, encoding in enumerate(secret_scan.ENCODINGS):
        rows += [(s, at) for s in keys(at, 8, encoding.alphabet, 20 + 5 * at)]
    frame = spark.createDataFrame(rows, "s string, kind int")
    for row in frame.select("s", "kind", secret_scan.p_value(F.col("s"), F.col("kind")).alias("p")).collect():
        assert row.p == pytest.approx(plain_p(row.s, secret_scan.ENCODINGS[row.kind]), abs=1e-6)


def test_redaction(spark, docs_of):
    text = 'é token = "0123456789abcdef0123456789abcdef" end \U0001f600 ' + "f" * 30
    docs = docs_of([(1, text), (2, "clean"), (3, None)])
    done = secret_scan.scan(docs).select("doc_id", secret_scan.redacted(F.col("text"), F.col("secrets")).alias("t"))
    assert {r.doc_id: r.t for r in done.collect()} == {1: 'é <SECRET>" end \U0001f600 <SECRET>', 2: "clean", 3: None}


def test_clashing_columns_and_no_rows(docs_of):
    frame = docs_of([(1, "api_key: abcdefg")]).withColumn("SECRETS", F.lit(1)).withColumn("kind", F.lit(1))
    assert [tuple(s) for s in secret_scan.scan(frame).first().secrets] == [(0, 0, 16)]
    assert secret_scan.scan(docs_of([])).count() == 0
    shown = secret_scan.scan(frame).select(secret_scan.spelled(F.col("secrets")).alias("s")).first().s
    assert shown == "assign:0:16"


def test_no_python_in_the_plans(docs_of, capsys):
    for frame in (secret_scan.scan(docs_of([(1, "a")])), shards.shuffle_into_shards(docs_of([(1, "a")]), 3)):
        frame.explain()
        assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
