"""Secrets in texts: three fixed patterns, and a battery of randomness tests for the rest.

Everything here is a DataFrame expression. Strings that might be keys (long runs of key letters) are put through three
tests over the alphabet of the encoding they seem to use: chi-squared for an even use of the alphabet, runs above
and below its middle, and serial correlation of neighbours. A key is told by being random, so each test is turned round:
its null hypothesis is structure of at least a given strength, whose statistic grows with the length, and a small
p-value says the string is too even, too irregular and too uncorrelated for that. A string must pass all three, so
the largest p-value counts (intersection-union test). Short strings cannot have small p-values, and discoveries are
controlled (Benjamini-Hochberg) within each encoding and length class over the whole corpus, so that
the many words of one length do not decide about the keys of another.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import carried, keeps_inner_names_apart, whole_text

# The base patterns, in the order of their kinds, and the least length of what each must hold.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: HEX, but without the runs that are too short to count; a longer run is one match of either.
LONG_HEX = r"[0-9a-f]{24,}+"

#: What is put to the tests: '=' only ends a candidate, so that the value of an assignment stands alone.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+"
#: Parts of a candidate that no encoding fits, from the finest: an earlier part that counts stands for the later ones around it.
PARTS = (r"[A-Za-z0-9+]{20,}+=*+", r"[A-Za-z0-9+/]{20,}+=*+", r"[A-Za-z0-9_-]{20,}+=*+")
#: The least a candidate must hold without its padding.
LEAST_SYMBOLS = 16
#: Share of false discoveries allowed in each stratum.
ALPHA = 0.05
#: Structure in runs and neighbours that a key must not have, as a correlation.
RHO = 0.75
#: Width of the p-value bins: tenths of a power of ten, up to 10 ** -20.
BINS = 200


@dataclass(frozen=True)
class Encoding:
    """An alphabet, how its strings look, and the least unevenness (k * sum q^2 - 1) of structured text in it."""

    name: str
    pattern: str
    alphabet: str
    unevenness: float


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Tried in this order.
ENCODINGS = (
    Encoding("digits", "^[0-9]+$", _DIGITS, 1.0),
    Encoding("hex", "^[0-9a-f]+$", _DIGITS + "abcdef", 1.0),
    Encoding("hex_upper", "^[0-9A-F]+$", _DIGITS + "ABCDEF", 1.0),
    Encoding("lower", "^[a-z]+$", _LOWER, 0.7),
    Encoding("upper", "^[A-Z]+$", _UPPER, 0.7),
    Encoding("base32", "^[A-Z2-7]+$", _UPPER + "234567", 1.0),
    Encoding("alphanumeric", "^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS, 1.5),
    Encoding("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 1.5),
    Encoding("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "_-", 1.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is worked out once however often it occurs there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normal(z: Column) -> Column:
    """The normal distribution function (Abramowitz and Stegun 26.2.17, error below 1e-7)."""

    def tail(t: Column) -> Column:
        return t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))

    def value(x: Column) -> Column:
        upper = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * let(F.lit(1.0) / (1 + 0.2316419 * F.abs(x)), tail)
        return let(upper, lambda u: F.when(x < 0, u).otherwise(1 - u))

    return let(z, value)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def _of_encoding(kind: Column, values: list) -> Column:
    return F.get(F.array(*map(F.lit, values)), kind)


def p_value(s: Column, kind: Column) -> Column:
    """The largest of the three p-values of a string over its encoding's alphabet; 1 if it uses one symbol or one half."""
    sizes = [len(e.alphabet) for e in ENCODINGS]
    given = F.struct(
        F.length(s).cast("double").alias("n"),
        _of_encoding(kind, [float(k) for k in sizes]).alias("k"),
        _of_encoding(kind, [e.unevenness for e in ENCODINGS]).alias("delta"),
        F.call_function("translate", s, _of_encoding(kind, [e.alphabet for e in ENCODINGS]), _of_encoding(kind, ["0" * (k // 2) + "1" * (k - k // 2) for k in sizes])).alias("halves"),
        F.transform(F.split(s, ""), lambda c: F.instr(_of_encoding(kind, [e.alphabet for e in ENCODINGS]), c).cast("double")).alias("codes"),
        F.transform(F.split(_of_encoding(kind, [e.alphabet for e in ENCODINGS]), ""), lambda c: F.length(s) - F.length(F.replace(s, c, F.lit("")))).alias("counts"),
    )

    def sums(g: Column) -> Column:
        following = F.zip_with(g["codes"], F.slice(g["codes"], 2, F.size(g["codes"])), lambda a, b: F.coalesce(a * b, F.lit(0.0)))
        without = lambda pair: F.length(F.replace(g["halves"], F.lit(pair), F.lit("")))
        return F.struct(
            *(g[name].alias(name) for name in ("n", "k", "delta")),
            (_sum(F.transform(g["counts"], lambda c: (c * c).cast("double"))) * g["k"] / g["n"] - g["n"]).alias("chi"),
            without("0").cast("double").alias("high"),
            ((2 * g["n"] - without("01") - without("10")) / 2).alias("turns"),
            (_sum(g["codes"]) / g["n"]).alias("mean"),
            (_sum(F.transform(g["codes"], lambda x: x * x)) / g["n"]).alias("square"),
            _sum(following).alias("following"),
            (F.element_at(g["codes"], 1) + F.element_at(g["codes"], -1)).alias("ends"),
        )

    def moments(g: Column) -> Column:
        product = 2 * g["high"] * (g["n"] - g["high"])
        covariance = (g["following"] - g["mean"] * (2 * g["n"] * g["mean"] - g["ends"])) / (g["n"] - 1) + g["mean"] * g["mean"]
        return F.struct(
            *(g[name].alias(name) for name in ("n", "k", "delta", "chi")),
            (g["turns"] - product / g["n"]).alias("turns"),
            (product * (product - g["n"]) / (g["n"] * g["n"] * (g["n"] - 1))).alias("spread"),
            covariance.alias("covariance"),
            (g["square"] - g["mean"] * g["mean"]).alias("variance"),
        )

    def largest(g: Column) -> Column:
        root = F.sqrt(g["n"])
        even = _normal((g["chi"] - (g["k"] - 1) - g["n"] * g["delta"]) / F.sqrt(2 * (g["k"] - 1) + 4 * g["n"] * g["delta"]))
        runs = _normal(F.abs(g["turns"]) / F.sqrt(g["spread"]) - RHO * root)
        serial = _normal(F.abs(g["covariance"] / g["variance"] + 1 / g["n"]) * root - RHO * root)
        return F.when((g["spread"] > 0) & (g["variance"] > 1e-9), F.greatest(even, runs, serial)).otherwise(1.0)

    return let(let(let(given, sums), moments), largest)


def encoding_of(s: Column) -> Column:
    """Index of the first encoding that fits, NULL if none does."""
    kind = F.lit(None).cast("int")
    for at in range(len(ENCODINGS) - 1, -1, -1):
        kind = F.when(s.rlike(ENCODINGS[at].pattern), at).otherwise(kind)
    return kind


def tested(s: Column) -> Column:
    """Stratum (encoding and length class) and p-value bin of one candidate, without its padding: struct of two ints.

    NULL if no encoding fits or too few symbols are left.
    """

    def bins(kind: Column, bare: Column) -> Column:
        p = p_value(bare, kind)
        bin_of = F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-30))) + 1e-9).cast("int"))
        place = kind * 16 + F.least(F.lit(15), F.floor(F.log2(F.length(bare))).cast("int"))
        return F.when(kind.isNotNull() & (F.length(bare) >= LEAST_SYMBOLS), F.struct(place.alias("stratum"), F.greatest(F.lit(0), bin_of).alias("bin")))

    return let(F.rtrim(s, F.lit("=")), lambda bare: let(encoding_of(bare), lambda kind: bins(kind, bare)))


def _fits(s: Column) -> Column:
    return encoding_of(F.rtrim(s, F.lit("="))).isNotNull()


def _parts(s: Column, pattern: str) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), F.lit(0))


def _located(text: Column, pattern: str, hits: Column, worth: Column) -> Column:
    """Start, end and ``worth`` of each hit in code points, from the text between the hits.

    Work and memory grow with the hits of one document alone.
    """
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), worth.alias("worth"))
    none = F.array().cast("array<struct<start:int,end:int,worth:int>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["hit"]), F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), pair["worth"].alias("worth"))
        return F.struct(end.alias("at"), F.when(pair["hit"].isNull(), state["spans"]).otherwise(F.array_append(state["spans"], one)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    walked = F.aggregate(pairs, begin, step, lambda state: state["spans"])
    return F.when(F.size(hits) > 0, walked).otherwise(none)


def _of_kind(spans: Column, kind: str) -> Column:
    least, number = LEAST[kind], KINDS.index(kind)
    fit = F.filter(spans, lambda s: s["worth"] >= least)
    return F.transform(fit, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def thresholds(df: DataFrame, text: str = "text", alpha: float = ALPHA) -> dict[int, int]:
    """For each stratum with discoveries the lowest bin that counts, over all distinct candidates of the corpus:
    copies of a text, or of a long identifier, do not decide about the keys beside them.

    Benjamini-Hochberg on binned p-values, each counted as the upper edge of its bin. At most
    ``16 * len(ENCODINGS)`` strata of ``BINS + 1`` bins reach the driver.
    """
    candidates = df.select(F.explode(F.regexp_extract_all(whole_text(text), F.lit(CANDIDATE), F.lit(0))).alias("s")).distinct()
    candidates = candidates.select(F.explode(F.when(_fits(F.col("s")), F.array("s")).otherwise(F.flatten(F.array(*(_parts(F.col("s"), p) for p in PARTS))))).alias("s")).distinct()
    placed = candidates.select(tested(F.col("s")).alias("t")).where("t IS NOT NULL")
    counted: dict[int, dict[int, int]] = {}
    for row in placed.groupBy("t.stratum", "t.bin").count().collect():
        counted.setdefault(row["stratum"], {})[row["bin"]] = row["count"]
    lowest = {}
    for place, bins in counted.items():
        total, better = sum(bins.values()), 0
        for at in sorted(bins, reverse=True):
            better += bins[at]
            if 10 ** (-at / 10) <= alpha * better / total:
                lowest[place] = at
    return lowest


@keeps_inner_names_apart
def scan(df: DataFrame, text: str = "text", out: str = "secrets", alpha: float = ALPHA) -> DataFrame:
    """Add ``out``: all secrets of each whole text, as structs ``start, kind, end``, in that order.

    kind is an index into :data:`KINDS`; positions are code points, the end is exclusive. Hits of the base patterns are
    all kept; a random string is added where no base hit covers it. Two passes over the texts, no shuffle of
    rows but of distinct candidates: the first one counts the candidates' test results, the second finds the spans. NULL and empty texts have
    none; rows stay one to one; a column called like the result is replaced.
    """
    lowest = thresholds(df, text, alpha)
    keep = carried(df, [out])
    whole = F.col("_whole")
    rows = df.select(*keep, whole_text(text).alias("_whole"))
    rows = rows.select(
        "*",
        F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(0)).alias("_assign"),
        F.regexp_extract_all(whole, F.lit(ACCESS), F.lit(0)).alias("_access"),
        F.regexp_extract_all(whole, F.lit(LONG_HEX), F.lit(0)).alias("_hex"),
        F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0)).alias("_random"),
    )
    values = F.when(F.size("_assign") > 0, F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(2)))
    lengths = lambda hits: F.transform(hits, F.length)
    spots = {place: at for place, at in sorted(lowest.items())}
    known = F.create_map(*[F.lit(v) for pair in spots.items() for v in pair]) if spots else F.create_map().cast("map<int,int>")

    def counts(s: Column) -> Column:
        enough = let(tested(s), lambda t: t["bin"] >= F.element_at(known, t["stratum"]))
        return F.when(F.coalesce(enough, F.lit(False)), 1).otherwise(0)

    rows = rows.select(
        "*",
        _located(whole, ASSIGN, F.col("_assign"), lengths(values)).alias("_assign_at"),
        _located(whole, ACCESS, F.col("_access"), lengths(F.col("_access"))).alias("_access_at"),
        _located(whole, LONG_HEX, F.col("_hex"), lengths(F.col("_hex"))).alias("_hex_at"),
        F.transform("_random", lambda s: F.when(_fits(s), counts(s)).otherwise(2)).alias("_worth"),
    )
    none = F.array().cast("array<struct<start:int,end:int,worth:int>>")
    some = F.exists("_worth", lambda w: w > 0)
    rows = rows.withColumn("_random_at", F.when(some, _located(whole, CANDIDATE, F.col("_random"), F.col("_worth"))).otherwise(none))

    def within(span: Column) -> Column:
        """Parts that count of a candidate without encoding (worth 2), placed in the text; any other span itself."""
        run = F.substring(whole, span["start"] + 1, span["end"] - span["start"])

        def beside(taken: Column, more: Column) -> Column:
            return F.concat(taken, F.filter(more, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

        def of(pattern: str) -> Column:
            hits = _parts(run, pattern)
            return F.filter(_located(run, pattern, hits, F.transform(hits, counts)), lambda s: s["worth"] == 1)

        fine, *wider = map(of, PARTS)
        found = fine
        for more in wider:
            found = let(F.struct(found.alias("taken"), more.alias("more")), lambda g: beside(g["taken"], g["more"]))
        moved = F.transform(
            found, lambda s: F.struct((s["start"] + span["start"]).alias("start"), (s["end"] + span["start"]).alias("end"), s["worth"].alias("worth"))
        )
        return F.when(span["worth"] == 2, moved).otherwise(F.array(span))

    mixed = F.exists("_worth", lambda w: w == 2)
    rows = rows.withColumn("_random_at", F.when(mixed, F.flatten(F.transform("_random_at", within))).otherwise(F.col("_random_at")))
    base = F.concat(*(_of_kind(F.col(f"_{k}_at"), k) for k in KINDS[:3]))
    rows = rows.withColumn("_base", base)
    added = F.filter(
        "_random_at", lambda s: (s["worth"] == 1) & ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    added = F.transform(added, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    return rows.select(*keep, F.array_sort(F.concat("_base", added)).alias(out))


def spelled(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "<SECRET>") -> Column:
    """The text with each span, or group of overlapping ones, replaced by a mark; ``spans`` sorted by start."""

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
