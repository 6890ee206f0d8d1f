"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, no accents or invisible letters, look-alike letters of other alphabets as Latin ones,
digits and signs inside words as the letters they stand for. Entries are words and beginnings of words, found by an
Aho-Corasick automaton; at each word the longest entry counts. Exceptions are longer entries and phrases of weight zero: what
they cover counts nothing. The weights found in a text, related to its length, give the score.

Weights are learnt from labelled texts as log odds of an entry's contexts (its two neighbours) in toxic and other texts.
Counting each context once keeps copies of a text, exact or near, from making their words look toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import carried, forget, prepare_workers, whole_text, written

#: Labelled documents to learn from, at most, of each label: those with the smallest hashed ids.
LEARNT_FROM = 8_192
#: Entries and exceptions, at most: those with the clearest evidence.
ENTRIES, EXCEPTIONS = 4_096, 4_096
#: Letters of a beginning of a word that may be an entry, and the number of different words that must share it.
STEM_LETTERS, STEM_WORDS = (4, 10), 3
#: Evidence an entry needs: contexts in toxic texts, log odds, and likelihood ratio against even odds.
LEAST_CONTEXTS, LEAST_ODDS, LEAST_SURE = 5, 1.5, 24.0
#: Contexts in other texts from which an extension or phrase without raised odds is an exception.
LEAST_HARMLESS = 8
#: A longer entry stands beside its beginning if its log odds are higher by this.
STRONGER = 1.0
THRESHOLD = 0.5

#: Harmless phrases with a word that is an insult by itself.
HARMLESS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "sore loser")

#: Letters of other alphabets and the Latin letters they look like (fixed values).
LOOK_ALIKE = str.maketrans(
    "абвгдеёзикмнорстухіјѕһԁԛԝӏαβεηικμνορτυχω",
    "abbrdeeeukmhopctyxijshdqwlabenikuvoptuxw",
)
#: Digits and signs that stand for letters within a word (fixed values).
STANDS_FOR = str.maketrans("01345789@$!|+", "oieastbgasilt")

_ACCENTS = re.compile("[̀-ͯ­​-‏⁠﻿]+")
_INSTEAD = re.compile(r"[01345789@$!|+]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")
_ASCII = {code: " " for code in range(128) if not chr(code).isalpha()}


def fold(text: str) -> str:
    """Words of a text in folded form, each between single blanks; the empty text gives one blank."""
    plain = text.isascii()
    if not plain:
        text = _ACCENTS.sub("", unicodedata.normalize("NFKD", text)).lower().translate(LOOK_ALIKE)
    else:
        text = text.lower()
    text = _INSTEAD.sub(lambda m: m.group().translate(STANDS_FOR), text)
    words = text.translate(_ASCII).split() if plain else _WORD.findall(text)
    return f" {' '.join(words)} " if words else " "


@dataclass
class Lexicon:
    """Weighted entries, exceptions and the two parts of the score's scale."""

    #: Folded patterns with weights: " begin" for beginnings, " word " for words; exceptions weigh 0.
    entries: dict[str, float] = field(default_factory=dict)
    #: Folded phrases, " two words ", inside which nothing counts.
    phrases: tuple[str, ...] = ()
    #: Logistic scale: constant and one factor for each of :func:`features`.
    scale: tuple[float, ...] = ()

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for pattern, weight in self.entries.items():
            found.add_word(pattern, (len(pattern), weight, False))
        for phrase in self.phrases:
            found.add_word(phrase, (len(phrase), 0.0, True))
        found.make_automaton()
        return found


def hits(automaton: ahocorasick.Automaton, folded: str) -> list[tuple[int, float]]:
    """Place and weight of what counts in a folded text, in order."""
    if not len(automaton):
        return []
    longest: dict[int, tuple[int, float]] = {}
    covered: list[tuple[int, int]] = []
    for end, (length, weight, phrase) in automaton.iter(folded):
        start = end - length + 1
        if phrase:
            covered.append((start, end))
        elif start not in longest or longest[start][0] < length:
            longest[start] = (length, weight)
    spared, reach, i = [], -1, 0
    covered.sort()
    for start in sorted(longest):
        while i < len(covered) and covered[i][0] <= start:
            reach, i = max(reach, covered[i][1]), i + 1
        if start >= reach and longest[start][1] > 0:
            spared.append((start, longest[start][1]))
    return spared


def features(total: float, words: int) -> tuple[float, float, float]:
    """Evidence in relation to length, in three ways."""
    return total / (words + 20), total / math.sqrt(words + 20), math.log1p(total)


def fit_scale(totals: np.ndarray, words: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression on the features by Newton's method."""
    if not len(labels):
        return ()
    x = np.array([(1.0, *features(t, n)) for t, n in zip(totals, words, strict=True)])
    beta, ridge = np.zeros(4), np.diag([1e-3, 1e-2, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + ridge @ beta
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + ridge, gradient)
        # more evidence never lowers the score
        beta = np.concatenate([[beta[0] - step[0]], np.maximum(beta[1:] - step[1:], 0.0)])
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def _sample(docs: DataFrame, labels: DataFrame, learn_from: Column, key: str, label: str) -> DataFrame:
    """``label, text`` of bounded many labelled documents, each different text once."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).where(learn_from)
    # an id that is labelled both ways teaches nothing
    one = usable.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"), F.min(label).alias("_least"))
    ids = one.where("_label = _least").select("_key", "_label")
    chosen = None
    for value in (0, 1):
        some = ids.where(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(LEARNT_FROM)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = docs.select(F.col(key).alias("_key"), whole_text().alias("text"))
    # bounded: twice LEARNT_FROM ids
    found = rows.join(F.broadcast(chosen), "_key")
    one_text = found.groupBy("_key", "_label").agg(F.min("text").alias("text"))
    return one_text.groupBy("text").agg(F.max("_label").alias("label"), F.min("_label").alias("_least")).where("label = _least").drop("_least")


def _folded(rows: DataFrame) -> DataFrame:
    """``label, words`` (array) from ``label, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [fold(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(texts, pa.string())], names=["label", "folded"])

    done = rows.select("label", "text").mapInArrow(run, "label int, folded string")
    return done.select("label", F.filter(F.split("folded", " "), lambda w: w != "").alias("words"))


def _odds(toxic: Column, other: Column, all_toxic: float, all_other: float) -> tuple[Column, Column]:
    """Log odds of an entry, and the likelihood ratio (G squared) against its being as frequent in both kinds of text."""
    odds = F.log((toxic + 0.5) / (all_toxic + 1.0)) - F.log((other + 0.5) / (all_other + 1.0))
    share = (all_toxic + 0.5) / (all_toxic + all_other + 1.0)
    part = lambda n, due: F.when(n > 0, n * F.log(n / due)).otherwise(0.0)
    return odds, 2 * (part(toxic, (toxic + other) * share) + part(other, (toxic + other) * (1 - share)))


def _vocabulary(folded: DataFrame) -> DataFrame:
    """``word, toxic, other``: different contexts of each word in either kind of text."""
    placed = F.transform(
        "words",
        lambda w, i: F.struct(w.alias("word"), F.xxhash64(F.get("words", i - 1), F.get("words", i + 1)).alias("context")),
    )
    met = folded.select("label", F.explode(placed).alias("p")).select("label", "p.word", "p.context")
    once = met.groupBy("word", "context").agg(F.max("label").alias("toxic"), F.max(1 - F.col("label")).alias("other"))
    return once.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _entries(vocabulary: DataFrame, totals: tuple[float, float]) -> dict[str, float]:
    """Weighted words and beginnings of words, with harmless extensions at weight 0."""
    low, high = STEM_LETTERS
    stems = vocabulary.where(F.length("word") > low).select(
        F.explode(F.transform(F.sequence(F.lit(low), F.least(F.length("word") - 1, F.lit(high))), lambda k: F.substring("word", F.lit(1), k))).alias("e"),
        "toxic",
        "other",
    )
    of_stems = stems.groupBy("e").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.count("*").alias("n"))
    whole = vocabulary.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("e"), "toxic", "other")
    shared = of_stems.where(F.col("n") >= STEM_WORDS).select(F.concat(F.lit(" "), "e").alias("e"), "toxic", "other")
    odds, sure = _odds(F.col("toxic"), F.col("other"), *totals)
    rated = whole.unionByName(shared).select("e", "toxic", "other", odds.alias("odds"), sure.alias("sure"))
    raised = rated.where((F.col("toxic") >= LEAST_CONTEXTS) & (F.col("odds") >= LEAST_ODDS) & (F.col("sure") >= LEAST_SURE))
    kept: dict[str, float] = {}
    best = raised.orderBy(F.desc("sure"), "e").limit(ENTRIES).collect()
    for row in sorted(best, key=lambda r: (len(r["e"]), r["e"])):
        before = [kept[row["e"][:n]] for n in range(low + 1, len(row["e"])) if row["e"][:n] in kept]
        if not before or row["odds"] > before[-1] + STRONGER:
            kept[row["e"]] = row["odds"]
    stems_kept = [e for e in kept if not e.endswith(" ")]
    if stems_kept:
        begins = rated.sparkSession.createDataFrame([(e,) for e in stems_kept], "stem string")  # at most ENTRIES
        harmless = rated.where((F.col("other") >= LEAST_HARMLESS) & (F.col("odds") <= 0)).alias("r")
        longer = (
            harmless.withColumn("stem", F.explode(F.transform(F.sequence(F.lit(low + 1), F.greatest(F.length("e") - 1, F.lit(low + 1))), lambda k: F.substring("e", F.lit(1), k))))
            .join(F.broadcast(begins), "stem", "left_semi")
            .select("e", "other")
            .distinct()
        )
        for row in longer.orderBy(F.desc("other"), "e").limit(EXCEPTIONS).collect():
            kept.setdefault(row["e"], 0.0)
    return kept


def _phrases(folded: DataFrame, lexicon: Lexicon, totals: tuple[float, float]) -> list[str]:
    """Phrases of two words, one of them an entry, that are no more frequent in toxic texts than in others."""
    shared = folded.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            out: list[tuple[int, str]] = []
            for label, words in zip(batch.column("label").to_pylist(), batch.column("words").to_pylist(), strict=True):
                text = f" {' '.join(words)} "
                for start, _ in hits(automaton, text):
                    end = text.index(" ", start + 1)
                    before, after = text.rfind(" ", 0, start), text.find(" ", end + 1)
                    if before >= 0:
                        out.append((label, text[before : end + 1]))
                    if after >= 0:
                        out.append((label, text[start : after + 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([label for label, _ in out], pa.int32()), pa.array([p for _, p in out], pa.string())], names=["label", "phrase"]
            )

    met = folded.mapInArrow(run, "label int, phrase string").groupBy("phrase")
    counted = met.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
    odds, _ = _odds(F.col("toxic"), F.col("other"), *totals)
    harmless = counted.where((F.col("other") >= LEAST_HARMLESS) & (odds <= 0))
    return [r["phrase"] for r in harmless.orderBy(F.desc("other"), "phrase").limit(EXCEPTIONS).collect()]


def fit(
    docs: DataFrame, labels: DataFrame, learn_from: Column, *, key: str = "doc_id", label: str = "toxic", harmless: Sequence[str] = HARMLESS
) -> Lexicon:
    """Learn a lexicon from labelled documents; ``learn_from`` is a condition over the labels' columns.

    NULL ids and labels other than 0 and 1 teach nothing, nor do ids or texts that are labelled both ways. Without labelled
    texts nothing is found and all scores are 0.
    """
    prepare_workers(docs.sparkSession)
    folded = written(_folded(_sample(docs, labels, learn_from, key, label)), "toxicity-sample")
    vocabulary = written(_vocabulary(folded), "toxicity-words")
    sums = vocabulary.agg(F.sum("toxic"), F.sum("other")).first()
    totals = (float(sums[0] or 0), float(sums[1] or 0))
    lexicon = Lexicon(_entries(vocabulary, totals), tuple(fold(p) for p in harmless))
    lexicon.phrases += tuple(p for p in _phrases(folded, lexicon, totals) if p not in lexicon.phrases)
    measured = _measured(folded.select("label", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("folded")), lexicon, ["label"], False)
    rows = measured.collect()  # at most twice LEARNT_FROM rows of three numbers
    truth = np.array([r["label"] for r in rows], dtype=float)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).where(learn_from)
    share = known.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    weights = np.where(truth == 1, share / max(truth.mean(), 1e-9), (1 - share) / max(1 - truth.mean(), 1e-9)) if len(rows) else truth
    lexicon.scale = fit_scale(np.array([r["_total"] for r in rows]), np.array([r["_words"] for r in rows]), truth, weights)
    for done in (folded, vocabulary):
        forget(done)
    return lexicon


def _measured(rows: DataFrame, lexicon: Lexicon, keep: list[str], fold_first: bool) -> DataFrame:
    """The kept columns with the summed weight ``_total``, the number of hits ``_hits`` and the number of words ``_words``."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            totals, counts, words = [], [], []
            for text in batch.column("folded").to_pylist():
                text = fold(text) if fold_first else text
                found = hits(automaton, text)
                totals.append(math.fsum(w for _, w in found))
                counts.append(len(found))
                words.append(text.count(" ") - 1)
            columns = [pa.array(totals, pa.float64()), pa.array(counts, pa.int64()), pa.array([max(0, w) for w in words], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *columns], names=[*keep, "_total", "_hits", "_words"])

    schema = rows.select(*keep).schema.add("_total", "double").add("_hits", "long").add("_words", "long")
    return rows.mapInArrow(run, schema)


def score(df: DataFrame, lexicon: Lexicon, column: str = "text") -> DataFrame:
    """The input's rows with ``score`` (0 to 1), ``n_hits`` and ``n_words``; row by row, no shuffle.

    NULL counts as the empty text, and texts without words have the score of no evidence, below the threshold unless most
    labelled texts are toxic. Texts are read whole, whatever their length; equal texts have equal scores; NULLs in other columns stay. Input
    columns named like a result column give way to it.
    """
    prepare_workers(df.sparkSession)
    results = ["score", "n_hits", "n_words"]
    others = carried(df, results)
    inner = [f"c{i}" for i in range(len(others))]
    rows = df.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(others, inner, strict=True)], whole_text(f"`{column}`").alias("folded"))
    measured = _measured(rows, lexicon, inner, True)
    if lexicon.scale:
        total, words = F.col("_total"), F.col("_words") + 20
        constant, *factors = (F.lit(f) for f in lexicon.scale)
        z = constant + factors[0] * total / words + factors[1] * total / F.sqrt(words) + factors[2] * F.log1p(total)
        value = 1 / (1 + F.exp(-z))
    else:
        value = F.lit(0.0)
    return measured.select(
        *[F.col(i).alias(c) for i, c in zip(inner, others, strict=True)],
        value.alias("score"),
        F.col("_hits").alias("n_hits"),
        F.col("_words").alias("n_words"),
    )

