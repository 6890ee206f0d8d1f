"""Benchmark decontamination by template canonicalisation.

Words become literals or typed placeholders: numbers, units behind a number, and names (capitalised words inside a
sentence). Windows of this template are hashed and hash-joined with those of the benchmark, so a question whose
numbers or names were exchanged still meets its original. What fills the slots is then compared: along one
alignment of a document with an item, each value of the item must always have become the same value of the
document. Of alignments that break this rule only the windows with the item's own values count; the others are
chance meetings of common templates.

Copies need no template: windows over the bare lower-cased words themselves are joined too, without any
condition on literals and for items of almost any length, so nothing that makes a template poor hides a copy.

The join sees only windows that pass a bitmap of fixed size over the benchmark's hashes. The bitmap only saves
work: whatever passes is decided by the join.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import keeps_inner_names_apart, prepare_workers, slices, whole_text, written

#: Template words in a window; an item with fewer is one window of its own length.
WINDOW = 8
#: Items with fewer words do not match as templates, and not at all: a word or two prove nothing.
LEAST_WORDS, LEAST_COPIED = 5, 3
#: Windows with a smaller share of literals do not match as templates.
LEAST_LITERALS = 0.5
#: A document is contaminated by an item if it has this share of its windows, or this many: thirteen words in a row.
LEAST_SHARE, ENOUGH_WINDOWS = 0.5, 6
#: Characters of the texts that a worker looks at together, unless one text alone has more.
TOGETHER = 1 << 19
#: Bits of the bitmap: 2 MB whatever the benchmark holds.
BITMAP_BITS = 24

# Unit names.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms t ton tons tonne"
    " tonnes oz ounce ounces lb lbs pound pounds ml cl l litre litres liter liters gallon gallons s sec second seconds min minute"
    " minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz w kw mw kwh v kv a ma j kj cal kcal k c f"
    " degree degrees percent dollar dollars euro euros cent cents kmh mph kph usd eur gbp kb mb gb tb bit bits byte bytes".split()
)
EMPTY, LITERAL, NUMBER, UNIT, NAME = range(5)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*")
_MEASURE = re.compile(r"([+-]?\d+(?:[.,]\d+)*)([a-zA-Z]{1,4})")
_PLACE = np.array([zlib.crc32(f"place {k}".encode()) * 0x9E3779B97F4A7C15 % (1 << 64) | 1 for k in range(WINDOW)], dtype=np.uint64)


def _code(canonical: str) -> int:
    data = canonical.encode("utf-8", "replace")
    return (zlib.crc32(data) << 32 | zlib.crc32(data, 0x5BD1E995)) * 0xBF58476D1CE4E5B9 % (1 << 64)


_CODES = {NUMBER: _code("\x01number"), UNIT: _code("\x01unit"), NAME: _code("\x01name")}


@dataclass
class Template:
    """Words of some texts: hash in the template and as such, kind and number (in ``words``) of each, and where each text begins."""

    codes: np.ndarray
    plain: np.ndarray
    kinds: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray
    words: Words

    def slots(self, at: int, length: int) -> list[str]:
        """What fills the slots of a window; literals are empty. A window of bare words has no slots."""
        if length < 0:
            return []
        place = range(at, at + length)
        return [self.words.bare[self.numbers[k]] if self.kinds[k] != LITERAL else "" for k in place]


class Words:
    """What a worker knows about raw words; emptied when full. A word's role depends on the word before it as well."""

    FULL = 120_000

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.pairs: dict[str, tuple[int, int]] = {}
        self.bare: list[str] = []
        self.codes, self.kinds = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int8)
        self.units, self.ends = np.zeros(1 << 12, bool), np.zeros(1 << 12, bool)

    def of(self, word: str) -> int:
        """Number of a word: its hash as a literal, kind, whether a unit, whether it ends a sentence, and its bare form."""
        at = self.number.get(word)
        if at is None:
            if word.isalpha() or word[:-1].isalpha():  # no regular expression is needed for most words
                bare = word if word[-1].isalnum() else word[:-1]
                kind = LITERAL
            else:
                bare = _EDGE.sub("", word)
                kind = EMPTY if not bare else NUMBER if _NUMBER.fullmatch(bare) else LITERAL
            if kind == LITERAL and len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
                kind = NAME
            low = bare.lower()
            low = word if low == word else low
            at = self.number[word] = len(self.bare)
            if at == len(self.codes):
                self.codes, self.kinds, self.units, self.ends = (
                    np.concatenate([a, np.zeros_like(a)]) for a in (self.codes, self.kinds, self.units, self.ends)
                )
            self.bare.append(low)
            self.codes[at], self.kinds[at] = _code(low), kind
            self.units[at], self.ends[at] = low in UNITS, word.rstrip("\"')")[-1:] in (".", "!", "?", ":")
        return at

    def numbers(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words; a measure such as 12kg has two, other words have -1 as their second."""
        first, second = np.empty(len(words), np.int64), np.full(len(words), -1, np.int64)
        for i, word in enumerate(words):
            at = self.number.get(word)
            if at is None:
                pair = self.pairs.get(word)
                if pair is None:
                    parts = [word] if word.isalpha() else _parted(word)
                    if len(parts) == 1:
                        first[i] = self.of(word)
                        continue
                    pair = self.pairs[word] = (self.of(parts[0]), self.of(parts[1]))
                at, second[i] = pair
            first[i] = at
        return first, second

    def template(self, texts: list[str]) -> Template:
        if len(self.bare) > self.FULL:
            self.clear()
        parts = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pa.array(texts, pa.large_string())))
        starts, coded = parts.offsets.to_numpy(), parts.flatten().dictionary_encode()
        # each different word of the batch is looked at once
        first, second = self.numbers(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy()
        at, more = first[index], second[index]
        pairs = np.flatnonzero(more >= 0)
        at = np.insert(at, pairs + 1, more[pairs])
        starts = starts + np.searchsorted(pairs, starts)
        codes, kinds, units, ends = self.codes[at], self.kinds[at], self.units[at], self.ends[at]
        plain = codes.copy()
        opening = np.concatenate([[True], ends])
        opening[starts] = True
        behind = np.concatenate([[False], kinds == NUMBER])
        behind[starts] = False
        kinds[(kinds == NAME) & opening[:-1]] = LITERAL
        kinds[(kinds == LITERAL) & units & behind[:-1]] = UNIT
        for kind, code in _CODES.items():
            codes[kinds == kind] = np.uint64(code)
        kept = kinds != EMPTY
        counts = np.concatenate([[0], np.cumsum(kept)])
        return Template(codes[kept], plain[kept], kinds[kept], at[kept], counts[starts], self)


def _parted(word: str) -> list[str]:
    """A measure such as 12kg is a number and a unit."""
    found = _MEASURE.fullmatch(_EDGE.sub("", word))
    return [found[1], found[2]] if found and found[2].lower() in UNITS else [word]


def windows(template: Template, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash (unsigned) of each window that lies in one text and, as a template, has enough literals.

    A negative length asks for windows over the bare words, all of them.
    """
    size = abs(length)
    n = len(template.codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    codes = template.codes if length > 0 else template.plain
    hashes = np.full(n, size if length > 0 else size + WINDOW, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            hashes += codes[k : k + n] * _PLACE[k]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        hashes ^= hashes >> np.uint64(32)
    if length > 0:
        counts = np.concatenate([[0], np.cumsum(template.kinds == LITERAL)])
        fits = counts[size:] - counts[:-size] >= LEAST_LITERALS * size
    else:
        fits = np.ones(n, dtype=bool)
    for cut in template.starts[1:-1]:
        fits[max(0, cut - size + 1) : cut] = False
    at = np.flatnonzero(fits)
    return at, hashes[at]


ITEM = "item_id long, item_key long, item_at int, n_windows int, length int, hash long, item_slots array<string>"
MEETING = "doc_id long, doc_key long, doc_at int, length int, hash long, doc_slots array<string>"


def _names(schema: str) -> list[str]:
    return [part.split(" ")[0] for part in schema.split(", ")]


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Windows of the benchmark's items, as templates and (with negative lengths) as bare words. NULL texts count as empty."""
    prepare_workers(benchmark.sparkSession)
    source = benchmark.select(F.col(item_id).cast("long").alias("item_id"), whole_text(text).alias("text"))
    source = source.withColumn("item_key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            rows = []
            for name, key, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "item_key", "text")), strict=True):
                template = words.template([text])
                n = len(template.codes)
                size = min(WINDOW, n)
                for least, length in ((LEAST_WORDS, size), (LEAST_COPIED, -size)):
                    if n < least:
                        continue
                    at, hashes = windows(template, length)
                    for a, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        rows.append((name, key, a, len(at), length, h, template.slots(a, length)))
            yield pa.RecordBatch.from_pylist([dict(zip(_names(ITEM), r, strict=True)) for r in rows], schema=_arrow(ITEM))

    return source.mapInArrow(run, ITEM)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(p.split(" ")[0], kinds[p.split(" ")[1]]) for p in schema.split(", ")])


def bitmap(items: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of the windows' hashes, put together from at most 2 ** 18 words of 64 bits."""
    place = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 63 AS int))")
    rows = items.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    words = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return words.view(np.uint64)


def passing(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITMAP_BITS)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def document_windows(docs: DataFrame, words_of: Broadcast, lengths: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Windows of whole documents that pass the bitmap. ``doc_key`` tells texts apart that share a ``doc_id``."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    source = source.withColumn("doc_key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            names, keys, texts = (batch.column(c).to_pylist() for c in ("doc_id", "doc_key", "text"))
            rows = []
            for first, last in slices(texts, TOGETHER):
                template = words.template(texts[first:last])
                for length in lengths:
                    at, hashes = windows(template, length)
                    passed = passing(hashes, words_of.value)
                    at, hashes = at[passed], hashes[passed]
                    doc = np.searchsorted(template.starts, at, side="right") - 1
                    for a, h, d in zip(at.tolist(), hashes.view(np.int64).tolist(), doc.tolist(), strict=True):
                        rows.append((names[first + d], keys[first + d], a - int(template.starts[d]), length, h, template.slots(a, length)))
            yield pa.RecordBatch.from_pylist([dict(zip(_names(MEETING), r, strict=True)) for r in rows], schema=_arrow(MEETING))

    return source.mapInArrow(run, MEETING)


def contaminations(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Documents that hold benchmark items: ``doc_id, doc_key, item_id, kind, windows, n_windows``.

    One row for each contaminated document and item. kind: ``copy`` if all slots of an alignment hold the item's own
    values, or those of enough windows where its others contradict each other; else ``reparameterised``. NULL and empty texts hold nothing; documents or items that share an id and a text give one
    row; an empty table on either side gives none.
    """
    spark = docs.sparkSession
    items = written(benchmark_windows(benchmark, item_id, text), "benchmark-windows")
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most twice WINDOW
    sent = spark.sparkContext.broadcast(bitmap(items))
    met = document_windows(docs, sent, lengths, doc_id, text).join(
        items.dropDuplicates(["item_id", "item_key", "item_at", "length"]), ["hash", "length"]
    )
    filled = F.arrays_zip(F.col("item_slots").alias("item"), F.col("doc_slots").alias("doc"))
    aligned = met.select(
        "doc_id",
        "doc_key",
        "item_id",
        "item_key",
        "n_windows",
        (F.col("length") < 0).alias("bare"),
        "item_at",
        (F.col("doc_at") - F.col("item_at")).alias("shift"),
        F.filter(filled, lambda s: s["item"] != "").alias("filled"),
    )
    own = F.forall("filled", lambda s: s["item"] == s["doc"])
    # An alignment has at most as many rows as the item has windows.
    lines = aligned.groupBy("doc_id", "doc_key", "item_id", "item_key", "n_windows", "bare", "shift").agg(
        F.collect_set("item_at").alias("places"),
        F.array_distinct(F.flatten(F.collect_list("filled"))).alias("filled"),
        F.collect_set(F.when(own, F.col("item_at"))).alias("verbatim"),
    )
    values = F.transform("filled", lambda s: s["item"])
    consistent = F.size("filled") == F.size(F.array_distinct(values))
    enough_of = lambda n: (n >= LEAST_SHARE * F.col("n_windows")) | (n >= ENOUGH_WINDOWS)
    places = F.when(consistent, F.col("places")).otherwise(F.col("verbatim"))
    same = F.when(consistent, F.forall("filled", lambda s: s["item"] == s["doc"])).otherwise(enough_of(F.size("verbatim")))
    lines = lines.select("doc_id", "doc_key", "item_id", "item_key", "n_windows", "bare", places.alias("places"), same.alias("same"))
    found = lines.groupBy("doc_id", "doc_key", "item_id", "item_key", "n_windows", "bare").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("windows"),
        F.max("same").alias("copied"),
    )
    # As a copy and as a template: one row, the copy if it is one.
    best = F.max_by(F.struct("windows", "n_windows"), F.struct("copied", "bare", "windows"))
    one = found.where(enough_of(F.col("windows"))).groupBy("doc_id", "doc_key", "item_id", "item_key").agg(
        F.max("copied").alias("copied"), best.alias("best")
    )
    kind = F.when(F.col("copied"), "copy").otherwise("reparameterised")
    return one.select("doc_id", "doc_key", "item_id", kind.alias("kind"), "best.windows", "best.n_windows")


@keeps_inner_names_apart
def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that hold no benchmark item, with all their columns."""
    bad = contaminations(docs, benchmark, doc_id=doc_id, text=text).select(F.col("doc_id").alias("_bad"), F.col("doc_key").alias("_key")).distinct()
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col("_bad")) & (F.xxhash64(whole_text(text)) == F.col("_key")), "left_anti")
