from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm import gru, lm, queries, topk
from lakeops.llm.common import fold


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(["ka", "lo", "mi", "ne", "ru", "ta", "é"], k=rng.randint(1, 3))) for _ in range(n))


# Language model


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_scores_against_plain_counts(docs_of, edge_rows, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 40)  # so that most words go through the join
    rows = [(100 + k, prose(k, 30)) for k in range(60)] + edge_rows
    counts = Counter(w for i, t in rows if not held(i) for w in lm.words_of(t or ""))
    n, v = sum(counts.values()), len(counts)
    got = lm.score(docs_of(rows).withColumn("score", F.lit("mine")), ~fold("doc_id", 2, 7)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        words = lm.words_of(t or "")
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want.setdefault(i, []).append((len(words), sum(w in counts for w in words), n, round(base, 4)))
    for row in got:
        assert (row.n_tokens, row.n_known, row.train_tokens, round(row.base_score, 4)) in want[row.doc_id]
        assert row.score < 0 and math.isfinite(row.score)


def test_no_documents_and_no_training_texts(docs_of):
    assert lm.score(docs_of([]), F.lit(True)).count() == 0
    row = lm.score(docs_of([(1, "some words"), (2, None)]), F.lit(False)).where("doc_id = 1").first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)


def toy(seed=0, head=150):
    rng = np.random.default_rng(seed)
    return gru.Gru.fresh(rng.integers(1, 100, head).astype(float), rng.integers(1, 50, gru.TAIL_CLASSES).astype(float), seed)


def test_next_word_probabilities_sum_to_one():
    model = toy()
    every = np.arange(model.head + gru.TAIL_CLASSES)
    hidden = np.repeat(np.random.default_rng(1).normal(0, 1, (1, gru.HIDDEN)).astype(np.float32), len(every), axis=0)
    assert np.exp(model.output(hidden, every)[0]).sum() == pytest.approx(1, abs=1e-4)


def test_state_goes_over_windows():
    """Scores do not depend on how texts are batched, and match a plain word-by-word pass."""
    model, rng = toy(2), np.random.default_rng(3)
    texts = [rng.integers(0, model.head + gru.TAIL_CLASSES, n) for n in (1, 50, 7, 33, 16, 17, 0)]
    together = model.log_likelihoods(texts)
    for text, found in zip(texts, together, strict=True):
        state, total, last = np.zeros((1, gru.HIDDEN), np.float32), 0.0, model.head + gru.TAIL_CLASSES
        for token in text:
            state, _ = model.step(np.array([last]), state)
            total += model.output(state, np.array([token]))[0][0]
            last = token
        assert found == pytest.approx(total, rel=1e-4, abs=1e-4)


def test_gradients_by_differences():
    model, rng = toy(4), np.random.default_rng(5)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    start = model.head + gru.TAIL_CLASSES
    before, tokens = rng.integers(0, start, (6, 4)), rng.integers(0, start, (6, 4))
    before[3, 1] = start
    state = rng.normal(0, 0.1, (4, gru.HIDDEN))

    def loss():
        s, hidden = state, []
        for inputs in before:
            s, _ = model.step(inputs, s * (inputs != start)[:, None])
            hidden.append(s)
        return -model.output(np.concatenate(hidden), tokens.ravel())[0].mean()

    _, gradients = model.gradients(before, tokens, state)
    for name, g in gradients.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = model.weights[name][at]
        model.weights[name][at] = old + 1e-5
        high = loss()
        model.weights[name][at] = old - 1e-5
        low = loss()
        model.weights[name][at] = old
        assert g[at] == pytest.approx((high - low) / 2e-5, rel=1e-3)


def test_training_helps_on_held_out_texts(docs_of):
    rng = random.Random(6)
    one, two = [f"a{k}" for k in range(20)], [f"b{k}" for k in range(20)]
    rows = [(k, " ".join(rng.choices(one if k % 2 else two, k=80))) for k in range(400)]
    got = lm.score(docs_of(rows), ~fold("doc_id", 2, 7)).select("base_score", "score", fold("doc_id", 2, 7).alias("out")).collect()
    assert sum(r.score for r in got if r.out) > 0.9 * sum(r.base_score for r in got if r.out)
    assert sum(r.score for r in got if r.out) > sum(r.base_score for r in got if r.out) + 100


def test_every_training_text_teaches(docs_of, monkeypatch):
    """With NULL ids, one text, or many: all of them are lessons."""
    lessons = []
    original = lm.written
    monkeypatch.setattr(lm, "written", lambda df, label: lessons.append((label, kept := original(df, label))) or kept)
    for rows in ([(None, "a b c")], [(3, "a b c")], [(k, f"word{k % 7} x y") for k in range(50)]):
        lessons.clear()
        lm.score(docs_of(rows), F.lit(True))
        assert dict(lessons)["lessons"].count() == len(rows)


def test_texts_are_read_twice_and_scored_from_their_tokens(docs_of, monkeypatch):
    """Once for their counts and once for their tokens; neither lessons nor scores go back to the texts."""
    texts_in = {}
    original = lm.written

    def written(df, label):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        texts_in[label] = "text" in plan
        return original(df, label)

    monkeypatch.setattr(lm, "written", written)
    lm.score(docs_of([(k, f"word{k % 7} x y") for k in range(20)]), F.lit(True)).collect()
    assert texts_in == {"word-counts": True, "lessons": True, "scored": False}


def test_a_texts_parts_do_not_depend_on_how_it_is_read(docs_of, monkeypatch):
    """Words known here, in tail classes, not known here and repeated, in slices of one text or of all."""
    monkeypatch.setattr(lm, "FREQUENT", 30)
    monkeypatch.setattr(gru, "HEAD", 10)
    monkeypatch.setattr(lm, "HEAD", 10)
    rows = [(k, prose(k, 25) + " new" * (k % 4)) for k in range(40)] + [(50, None), (51, "")]
    found = []
    for together in (1, 1 << 20):
        monkeypatch.setattr(lm, "TOGETHER", together)
        got = lm.score(docs_of(rows).coalesce(1), F.col("doc_id") < 30).orderBy("doc_id").collect()
        found.append([(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in got])
    assert found[0] == found[1] and [r[0] for r in found[0]] == [i for i, _ in rows]


def test_large_scores_do_not_overflow():
    """Weights whose scores no 32-bit exponential holds, beside the same scores less a constant."""
    plain, shifted = toy(8), toy(8)
    for name in ("class_bias", "word_bias"):
        shifted.weights[name] = shifted.weights[name] + np.float32(500)
    tokens = np.arange(plain.head + gru.TAIL_CLASSES)
    hidden = np.random.default_rng(9).uniform(-1, 1, (len(tokens), gru.HIDDEN)).astype(np.float32)
    assert shifted.output(hidden, tokens)[0] == pytest.approx(plain.output(hidden, tokens)[0], abs=1e-2)


def test_training_uses_every_token(monkeypatch):
    """Also those behind the last whole row of streams, and those of a long text in pieces."""
    seen = []
    original = gru.Gru.gradients
    monkeypatch.setattr(gru.Gru, "gradients", lambda self, b, t, s: seen.append(t.size) or original(self, b, t, s))
    for lengths in ((1,), (5, 40), (700, 3, 0, 1_001), (9_000,) * 3):
        seen.clear()
        toy().train([np.arange(n) % 150 for n in lengths], 0.01, streams=16)
        assert sum(seen) == sum(lengths)


def test_words_are_split_at_ascii_white_space_only():
    """By Arrow as by Python: blank texts, white space at both ends, letters beyond ASCII, what only looks like white space."""
    rng = random.Random(12)
    texts = ["", " ", "\n\t", "a", " a ", "A\x0bB\x0c", "\x1c a\x85b\xa0c\u2003d", "\u0130\u00c9 \U0001f600", "x" * 5_000]
    texts += ["".join(rng.choices("aB\u00e9 \t\r\n\x1d\xa0", k=rng.randint(0, 30))) for _ in range(500)]
    want = [lm.words_of(t) for t in texts]
    for kind in (pa.string(), pa.large_string()):
        words, lengths = lm.split(pa.array(["cut off", *texts], kind).slice(1))
        assert words.to_pylist() == [w for one in want for w in one] and lengths.tolist() == [len(one) for one in want]
        coded = words.dictionary_encode()
        assert lm.listed(coded.dictionary) == coded.dictionary.to_pylist()


def test_word_counts_by_hand(docs_of, edge_rows, monkeypatch):
    """Handed on after every slice, or once for a task; also bytes that are no letters."""
    docs = docs_of(edge_rows).select(F.coalesce("text", F.lit("")).alias("text"))
    want = Counter(w for _, t in edge_rows for w in lm.words_of(t or ""))
    for held_bytes, together in ((1, 1), (1 << 25, 1 << 20)):
        monkeypatch.setattr(lm, "HELD_BYTES", held_bytes)
        monkeypatch.setattr(lm, "TOGETHER", together)
        assert {bytes(r.word): r.n for r in lm.word_counts(docs).collect()} == want
    broken = docs.limit(1).select(F.unhex(F.lit("61FF20C3")).cast("string").alias("text"))
    assert {bytes(r.word): r.n for r in lm.word_counts(broken).collect()} == {b"a\xff": 1, b"\xc3": 1, b"": 1}


def test_each_distinct_word_is_looked_up_once(monkeypatch):
    """Rare words too: their class is found once for a slice, not at each place."""
    seen = []
    monkeypatch.setattr(lm, "tail_class", lambda word: seen.append(word) or gru.tail_class(word))
    known = lm.Lexicon([b"", b"a"], np.array([5, 4]), np.ones(gru.TAIL_CLASSES), np.ones(gru.TAIL_CLASSES), 9, 2).opened()
    words, _ = lm.split(pa.array(["a rare rare", "rare other a"] * 50))
    index, tokens, within = known.read(lm.listed(words.dictionary_encode().dictionary))
    assert sorted(seen) == [b"other", b"rare"] and index.tolist() == [1, -1, 0, -1]
    assert tokens.tolist() == [1, 2 + gru.tail_class(b"rare"), 0, 2 + gru.tail_class(b"other")]
    assert within[[1, 3]] == pytest.approx([-math.log10(3)] * 2) and within[[0, 2]].tolist() == [0, 0]


def test_short_texts_fill_the_streams_beside_long_ones(monkeypatch):
    """As many steps as the longest text has words, not those of each group of texts besides."""
    model, rng, wide = toy(13), np.random.default_rng(14), []
    texts = [rng.integers(0, model.head + gru.TAIL_CLASSES, n) for n in [20] * 3_000 + [200] * 10 + [0]]
    alone = [model.log_likelihoods([t])[0] for t in texts[-20:]]
    original = gru.Gru._step
    monkeypatch.setattr(gru.Gru, "_step", lambda self, x, s, r: wide.append(len(s)) or original(self, x, s, r))
    found = model.log_likelihoods(texts)
    assert sum(wide) == sum(map(len, texts)) and len(wide) <= 220
    assert found[-20:] == pytest.approx(alone, rel=1e-5)


def test_gradients_of_large_scores():
    """Scores that no 32-bit exponential holds have the slopes of the same scores less a constant."""
    plain, shifted = toy(15), toy(15)
    for name in ("class_bias", "word_bias"):
        shifted.weights[name] = shifted.weights[name] + np.float32(500)
    rng = np.random.default_rng(16)
    before, tokens = (rng.integers(0, plain.head + gru.TAIL_CLASSES, (6, 40)) for _ in range(2))
    state = rng.normal(0, 0.1, (40, gru.HIDDEN)).astype(np.float32)
    one, two = (model.gradients(before, tokens, state)[1] for model in (plain, shifted))
    for name in gru.NAMES:
        assert two[name] == pytest.approx(one[name], abs=1e-4)


# Top-k search


def brute(rows, k, every):
    """Rows of the result, sorted: every row but the query's own is a candidate."""
    kept = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, u) in enumerate(kept):
        if q % every == 0:
            others = [(j, v) for b, (j, v) in enumerate(kept) if a != b and len(u) == len(v)]
            scores = [(-sum(int(x) * int(y) for x, y in zip(u, v, strict=True)), j) for j, v in others]
            out += [(q, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, rows, k, every):
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    return [tuple(r) for r in topk.top_k(frame, F.col("id") % every == 0, k).collect()]


@pytest.mark.parametrize("block", [7, 1_000])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block * 4)
    rng = random.Random(8)
    centres = [[rng.randint(-50, 50) for _ in range(6)] for _ in range(5)]
    rows = [(k, [float(c + rng.randint(-4, 4)) for c in rng.choice(centres)]) for k in range(150)]
    rows += [(200 + k, [3.0] * 6) for k in range(60)]  # ties
    rows += [(300, [1.0, 2.0]), (301, [5.0, 2.0]), (10, [9.0] * 6), (None, [1.0] * 6), (310, None), (311, [])]
    rows += [(350, [7.0] * 6), (350, [7.0] * 6), (350, [8.0] * 6), (360, []), (320, [2.0] * 6)]  # ids of several rows, empty vectors
    rows += [(312, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (340, [0.0] * 6)]
    assert sorted(found(spark, rows, 5, 10)) == brute(rows, 5, 10)


def test_few_candidates_and_none(spark):
    assert found(spark, [(0, [1.0, 2.0]), (1, [3.0, 4.0])], 5, 2) == [(0, 1, 1, 11)]
    assert found(spark, [(0, [1.0])], 5, 2) == [] and found(spark, [(1, [1.0]), (3, [1.0])], 5, 2) == []
    assert topk.top_k(spark.createDataFrame([], "id long, vector array<double>"), F.lit(True), 5).count() == 0


def test_bounds_leave_candidates_out():
    rng = np.random.default_rng(9)
    centres = rng.integers(-200, 200, (40, 8))
    vectors = (centres[rng.integers(0, 40, 4_000)] + rng.integers(-3, 4, (4_000, 8))).astype(float)
    pivots = topk.spread_out(vectors[:500], 32)
    apart = np.linalg.norm(vectors[:, None, :] - pivots[None], axis=2)
    ids = np.arange(4_000)
    for query, best, scores, evaluated in topk.block_top_k(ids[:20], vectors[:20], apart[:20], ids, vectors, apart, 5):
        exact = vectors @ vectors[query]
        exact[query] = -np.inf
        assert best.tolist() == np.lexsort((ids, -exact))[:5].tolist() and scores.tolist() == exact[best].tolist()
        assert evaluated < 1_000


def test_large_numbers_stay_exact():
    a, b = np.array([2.0**40, 3.0]), np.array([[2.0**20, 1.0], [1.0, 2.0**30]])
    assert topk._scores(a, b).tolist() == [2**60 + 3, 2**40 + 3 * 2**30]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_against_their_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())


# Pipeline


def test_pipeline_names_and_registered_queries():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_over_planted_documents(spark, docs_of, tmp_path):
    junk = [(k, " ".join(w + "###" for w in prose(k, 60).split())) for k in range(100)]
    good = [(100 + k, prose(1_000 + k, 120)) for k in range(200)]
    item = prose(77_777, 40)
    leak, copy = (400, prose(5, 40) + " " + item + " " + prose(6, 40)), (401, good[0][1])
    near = (402, good[1][1].replace(good[1][1].split()[60], "other", 1))
    secret = (403, prose(9, 100) + ' token = "0123456789abcdef0123456789abcdef"')
    rows = junk + good + [leak, copy, near, secret]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0, 0) for i, _ in junk] + [(i, 1, 0) for i, _ in good]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _ in good} | {403}
    assert "0123456789abcdef" not in got[403].decoded.replace("</w> ", "") and "secret</w>" in got[403].decoded
    assert all(r.n_tokens == len(r.ids) for r in got.values())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_and_empty_tables(spark, docs_of, edge_rows, tmp_path, stage):
    spark.createDataFrame([(1, 1, 0), (5, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = docs_of(edge_rows)
    got = stage(spark, docs, str(tmp_path))
    if stage is not corpus_pipeline.encoded:
        assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
    assert got.count() <= len(edge_rows)
    assert stage(spark, docs_of([]), str(tmp_path)).count() == 0
