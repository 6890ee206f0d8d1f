"""Language-model scores of whole documents: corpus counts, a recurrent model, and both applied.

1. Word counts of all training texts (map-side sums, one shuffle).
2. The commonest words, at most ``FREQUENT``, go to the workers; the ``HEAD`` first of them are the model's own words.
3. One pass reads all texts: their words become the model's tokens, and what the counts say of them is summed up.
   What it needs to know about words that were not sent along, their counts, is joined afterwards: a shuffle of rare
   words only.
4. The recurrent model learns from the tokens of all training texts: each task trains a copy on its texts, lesson by
   lesson, and Spark averages the copies' parameters.
5. The model scores the tokens of all texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import prepare_workers, spans, whole_text, written
from lakeops.llm.gru import HEAD, TAIL_CLASSES, Gru, tail_class

#: Words sent to the workers, at most.
FREQUENT = 1 << 18
#: Training tokens of one copy of the model (a task), and of one lesson, which is held in memory.
COPY_TOKENS, LESSON_TOKENS = 1 << 22, 1 << 20
ROUNDS = 1
#: Bytes of words a task counts together, bytes of text split and tokens scored at once.
HELD_BYTES, TOGETHER, HELD_TOKENS = 1 << 24, 1 << 19, 2_000_000
#: Parameters in one row while they are averaged.
BLOCK = 4_096
END = b""


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, what lies between ASCII white space, then the end."""
    return [*text.encode("utf-8", "replace").lower().split(), END]


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts one after the other, as :func:`words_of` gives them, and how many each text has."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    # White space behind the last word leaves an empty one there: the end.
    blank, space = (pa.scalar(x, texts.type) for x in ("", " "))
    closed = pc.if_else(pc.equal(trimmed, blank), blank, pc.binary_join_element_wise(trimmed, blank, space))
    lists = pc.ascii_split_whitespace(closed)
    return lists.flatten().cast(pa.binary()), pc.list_value_length(lists).to_numpy().astype(np.int64)


def listed(words: pa.Array) -> list[bytes]:
    """Words as Python has them. None holds white space, so one split finds them all."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py().split(b" ")


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all texts (column ``text``); the end of a text is the empty word."""
    prepare_workers(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def handed_on() -> pa.RecordBatch:
            counted = pc.value_counts(pa.chunked_array(held, pa.binary()))
            held.clear()
            return pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "n"])

        for batch in batches:
            column = batch.column("text")
            for first, last in spans(pc.binary_length(column).to_pylist(), TOGETHER):
                held.append(split(column.slice(first, last - first))[0])
                if sum(words.nbytes for words in held) > HELD_BYTES:
                    yield handed_on()
        if held:
            yield handed_on()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """Words known to the workers in falling frequency, and what is known of all others."""

    def __init__(self, words: list[bytes], counts: np.ndarray, tail_tokens: np.ndarray, tail_words: np.ndarray, tokens: int, distinct: int):
        self.words, self.counts = words, counts
        self.tail_tokens, self.tail_words = tail_tokens, tail_words
        self.tokens, self.distinct = tokens, distinct
        self.head = min(HEAD, len(words))

    def opened(self) -> Lexicon:
        """With its look-up tables, which are not sent. The last entry of each is that of words not known here.

        A worker keeps them for its next tasks.
        """
        if hasattr(self, "at"):
            return self
        self.at = {w: k for k, w in enumerate(self.words)}
        kinds = np.array([tail_class(w) for w in self.words[self.head :]], dtype=np.int64)
        self.token = np.concatenate([np.arange(self.head), self.head + kinds, [0]]).astype("<u2")
        self.logs = np.append(np.log10(self.counts + 1.0), 0.0)
        self.room = np.log10(self.tail_tokens + self.tail_words + 1.0)
        self.within = self.logs.copy()
        self.within[: self.head] = 0
        self.within[self.head : -1] -= self.room[kinds]
        return self

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its index (-1 if not known here), its model token, and log10 of its share within its tail class."""
        index = np.fromiter(map(self.at.get, words, repeat(-1)), dtype=np.int32, count=len(words))
        tokens, within = self.token[index], self.within[index]
        missing = np.flatnonzero(index < 0)
        kinds = np.array([tail_class(words[k]) for k in missing.tolist()], dtype=np.int64)
        tokens[missing] = self.head + kinds
        within[missing] -= self.room[kinds]
        return index, tokens, within


def lexicon(counts: DataFrame) -> tuple[Lexicon, int]:
    """The lexicon of ``word, n``, and the count from which on words are in it."""
    level = F.floor(8 * F.log2("n")).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens"), F.min("n").alias("least")).collect()
    held, least = 0, 1 << 62
    for row in sorted(levels, key=lambda r: -r["level"]):
        held += row["words"]
        if held > FREQUENT:
            break
        least = row["least"]
    found = counts.where(F.col("n") >= least).toArrow()  # at most FREQUENT words
    pairs = sorted(zip(found["word"].to_pylist(), found["n"].to_pylist(), strict=True), key=lambda p: (-p[1], p[0]))
    words, numbers = [p[0] for p in pairs], np.array([p[1] for p in pairs], dtype=np.int64)
    sent = counts.sparkSession.sparkContext.broadcast(frozenset(words[:HEAD]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value
        for batch in batches:
            pairs = [(tail_class(w), n) for w, n in zip(*(c.to_pylist() for c in batch.columns), strict=True) if w not in head]
            kinds, n = np.array([p[0] for p in pairs], dtype=np.int64), np.array([p[1] for p in pairs], dtype=np.float64)
            sums = [np.arange(TAIL_CLASSES), np.bincount(kinds, n, TAIL_CLASSES).astype(np.int64), np.bincount(kinds, minlength=TAIL_CLASSES)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in sums], names=["kind", "tokens", "words"])

    tails = counts.select("word", "n").mapInArrow(run, "kind long, tokens long, words long").groupBy("kind").agg(F.sum("tokens"), F.sum("words"))
    tail_tokens, tail_words = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for kind, tokens, distinct in tails.collect():
        tail_tokens[kind], tail_words[kind] = tokens, distinct
    total, distinct = sum(r["tokens"] for r in levels), sum(r["words"] for r in levels)
    return Lexicon(words, numbers, tail_tokens, tail_words, total, distinct), least


READ = (
    "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, within double, tokens binary, "
    "rare array<struct<word:binary,n:int>>"
)


def _read(docs: DataFrame, known: Lexicon) -> DataFrame:
    """Model tokens of each text, counts and base scores without the words the workers do not know, and those words.

    within: log10 of the shares of the text's words within their tail classes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value.opened()
        total = np.log10(own.tokens + own.distinct + 1.0)
        for batch in batches:
            column = batch.column("text")
            for first, last in spans(pc.binary_length(column).to_pylist(), TOGETHER):
                words, lengths = split(column.slice(first, last - first))
                ends = np.cumsum(lengths)
                starts = ends - lengths
                coded = words.dictionary_encode()  # each distinct word is looked up once
                at = coded.indices.to_numpy()
                index, tokens, within = own.read(listed(coded.dictionary))
                data, bounds = tokens[at].tobytes(), zip((2 * starts).tolist(), (2 * ends).tolist(), strict=True)
                missing = np.flatnonzero((index < 0)[at])
                of_text = np.searchsorted(ends, missing, side="right")
                rare, times = np.unique(of_text * len(index) + at[missing], return_counts=True)
                pairs = pa.StructArray.from_arrays(
                    [coded.dictionary.take(pa.array(rare % len(index))), pa.array(times, pa.int32())], names=["word", "n"]
                )
                places = np.searchsorted(rare, np.arange(last - first + 1) * len(index))
                columns = [
                    batch.column("doc_id").slice(first, last - first),
                    batch.column("learn").slice(first, last - first),
                    pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat((index >= 0)[at].astype(np.int64), starts), pa.int64()),
                    pa.array(np.add.reduceat(own.logs[index][at], starts) - lengths * total, pa.float64()),
                    pa.array(np.add.reduceat(within[at], starts), pa.float64()),
                    pa.array([data[a:b] for a, b in bounds], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(places, pa.int32()), pairs),
                ]
                names = ["doc_id", "learn", "n_tokens", "n_known", "base_score", "within", "tokens", "rare"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, READ)


def taught(lessons: DataFrame, known: Lexicon) -> Gru:
    """The recurrent model after ``ROUNDS`` rounds over ``lessons`` (column ``tokens``)."""
    spark = lessons.sparkSession
    model = Gru.fresh(known.counts[: known.head].astype(np.float64), known.tail_tokens)
    # Dealt row by row: neither copies of a text nor a hot source come to one task.
    dealt = lessons.repartition(max(1, -(-known.tokens // COPY_TOKENS)))
    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast((model.head, model.weights))
        copies = dealt.mapInArrow(_lesson(start, 0.01 / (turn + 1)), "block int, weight double, values array<double>")
        each = copies.select("block", "weight", F.posexplode("values").alias("at", "value"))
        mean = each.groupBy("block", "at").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value"))
        found = mean.toArrow()  # one number for each parameter of the model
        if found.num_rows:
            flat = np.empty(found.num_rows)
            flat[np.asarray(found["block"]) * BLOCK + np.asarray(found["at"])] = np.asarray(found["value"])
            model = model.with_flat(flat)
    return model


def _lesson(start: Broadcast, rate: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task's texts do to its copy of the model, lesson by lesson: its parameters in blocks, weighted by their tokens."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weights = start.value
        own = Gru(head, {k: v.copy() for k, v in weights.items()})
        texts: list[np.ndarray] = []
        held = taught = 0
        for batch in batches:
            for tokens in batch.column("tokens").to_pylist():
                texts.append(np.frombuffer(tokens, "<u2"))
                held += len(texts[-1])
                if held >= LESSON_TOKENS:
                    own.train(texts, rate)
                    texts, held, taught = [], 0, taught + held
        own.train(texts, rate)
        taught += held
        if taught:
            flat = own.flat().astype(np.float64)
            parts = [flat[at : at + BLOCK] for at in range(0, len(flat), BLOCK)]
            columns = [
                pa.array(range(len(parts)), pa.int32()),
                pa.array([float(taught)] * len(parts)),
                pa.array(parts, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "weight", "values"])

    return train


PARTS = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scored(texts: DataFrame, model: Gru) -> DataFrame:
    """Texts that were read, with the model's score of their tokens."""
    sent = texts.sparkSession.sparkContext.broadcast((model.head, model.weights))
    same = ["row", "doc_id", "n_tokens", "n_known", "base_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru = Gru(*sent.value)

        def done(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens = [np.frombuffer(t, "<u2") for batch in some for t in batch.column("tokens").to_pylist()]
            likelihoods = gru.log_likelihoods(tokens) / np.log(10)
            at = 0
            for batch in some:
                scores = likelihoods[at : at + batch.num_rows] + np.asarray(batch.column("within"))
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in same), pa.array(scores)], names=[*same, "score"])

        some: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            some.append(batch)
            held += pc.sum(batch.column("n_tokens")).as_py() or 0
            if held > HELD_TOKENS:
                yield from done(some)
                some, held = [], 0
        yield from done(some)

    return texts.select(*same, "within", "tokens").mapInArrow(run, PARTS)


def score(df: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every whole text.

    learn_from: over ``doc_id``; which texts are training texts. base_score is the add-one unigram law of the training
    texts, score the recurrent model's log10 probability of the text with its end. A NULL or empty text is its end alone;
    rows stay one to one, repeated ones too; other columns are not looked at. Without training texts every word is
    unknown and scores follow from that; no rows give no rows.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"), learn_from.alias("learn"))
    learnt = docs.where("learn")
    counts = written(word_counts(learnt.select("text")), "word-counts")
    known, least = lexicon(counts)
    texts = written(_read(docs, known).withColumn("row", F.monotonically_increasing_id()), "lessons")
    model = taught(texts.where("learn").select("tokens"), known)
    parts = written(_scored(texts, model), "scored")
    rare = texts.select("row", F.inline("rare"))
    seldom = counts.where(F.col("n") < least).select("word", F.col("n").alias("c"))
    found = rare.join(seldom, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("found"),
    )
    more = F.coalesce("more", F.lit(0.0))
    return parts.join(found, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
