"""Near-duplicate documents by SimHash fingerprints and a byte-position inverted index.

A fingerprint is read as bytes at fixed positions. Two fingerprints that differ in at most ``k`` bits
differ in at most ``k`` bytes, so of ``p`` positional bytes they share at least ``p - k``: the guaranteed
minimum of the count filter. A list for one positional byte would hold a share of all documents that grows with
the corpus, and tallying such lists pair by pair grows with its square. So the index joins the postings first:
its keys are sets of ``p - k`` positions with their bytes, a pair reaches the minimum exactly if it meets
under such a key, and the number of keys it meets under is the tally. Only what is left of the fingerprint
differs within a list, so a list holds at most ``2 ** (8 k)`` fingerprints, whatever the input: 65,536 for two bits.

Only distinct fingerprints are indexed; documents with equal ones are members of one class beforehand.

At wider distances, as similarities of 0.8 need, no minimum is guaranteed: :func:`similar_documents` takes its first
pairs from the fingerprints' classes, settles them by the whole sets of shingles, and finds the others by those sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import carried, forget, keeps_inner_names_apart, prepare_workers, whole_text, written
from lakeops.llm.templates import bitmap, passing

SEED = 42
BYTES = 8
#: Shingles hashed at once: bounds the memory of very long texts.
SLICE = 1 << 16
#: One in so many texts is counted for the order of shingles, and the commonest ones that are put last, at most.
COUNTED, COMMON = 16, 1 << 18
#: Parts of the list that one class has under one shingle.
PARTS = 64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float32)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _spread(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit hashes of each shingle; the first is its XXH64, the others are mixed from it."""
    if words == 1:
        return hashes[:, None]
    out = hashes[:, None] + _ODD * np.arange(words, dtype=np.uint64)
    out[:, 1:] = (out[:, 1:] ^ (out[:, 1:] >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out[:, 1:] = (out[:, 1:] ^ (out[:, 1:] >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    out[:, 1:] ^= out[:, 1:] >> np.uint64(31)
    return out


def _shingles(text: str, shingle: int) -> tuple[bytes, list[int], list[int]]:
    """A text's words joined by spaces, and where each shingle begins and ends; no shingles without words.

    A-Z are lower-cased, words are what lies between ASCII white space, shingles are there as often as they occur.
    Texts with fewer words are one shingle.
    """
    tokens = text.encode("utf-8", "replace").lower().split()
    if not tokens:
        return b"", [], []
    n = max(1, len(tokens) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return b" ".join(tokens), starts[:n].tolist(), ends[min(shingle, len(tokens)) - 1 :].tolist()


def _hashes(joined: bytes, first: list[int], last: list[int]) -> np.ndarray:
    """XXH64 of shingles."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first))


def _votes(hashes: np.ndarray, words: int) -> np.ndarray:
    """How many of the shingles' hashes have each bit of ``words`` 64-bit words set."""
    width = BYTES * words
    split = _spread(hashes, words).astype("<u8").view(np.uint8).reshape(-1, width)
    if len(split) < 400:
        return np.unpackbits(split, axis=1, bitorder="little").sum(axis=0, dtype=np.int64).reshape(width, 8)
    tally = np.bincount((split + (np.arange(width) * 256).astype(np.int64)).ravel(), minlength=256 * width).reshape(width, 256)
    return (tally.astype(np.float32) @ _BITS).astype(np.int64)


def _majority(counts: np.ndarray, n: int) -> np.ndarray:
    """The words whose bits are set in over half of ``n`` hashes."""
    return np.packbits((2 * counts > n).astype(np.uint8).ravel(), bitorder="little").view("<i8")


def fingerprint_words(text: str, shingle: int, words: int = 1) -> np.ndarray:
    """SimHash of a whole text in ``words`` 64-bit words.

    A bit is set if it is set in over half of the hashes of the shingles (:func:`_shingles`), repeats counted; a text
    without words has fingerprint zero.
    """
    joined, first, last = _shingles(text, shingle)
    counts = np.zeros((BYTES * words, 8), dtype=np.int64)
    for at in range(0, len(first), SLICE):
        counts += _votes(_hashes(joined, first[at : at + SLICE], last[at : at + SLICE]), words)
    return _majority(counts, len(first))


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit fingerprint, as a signed number."""
    return int(fingerprint_words(text, shingle)[0])


@keeps_inner_names_apart
def fingerprints(df: DataFrame, shingle: int = 3, text: str = "text", out: str = "fp") -> DataFrame:
    """Add ``out``, the fingerprint of each whole text as a long. NULL texts count as empty."""
    prepare_workers(df.sparkSession)
    keep, at = carried(df, [out]), "_text_to_hash"
    source = df.select(*keep, whole_text(text).alias(at))
    schema = T.StructType([*df.select(*keep).schema, T.StructField(out, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), found], names=[*keep, out])

    return source.mapInArrow(run, schema)


def shared_bytes(difference: Column, positions: int = BYTES) -> Column:
    """Tally of the positional bytes that two fingerprints share, from their exclusive or."""
    total = F.lit(0)
    for at in range(positions):
        total = total + F.when(F.shiftrightunsigned(difference, 8 * at).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0)
    return total


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def linked_pairs(distinct: DataFrame, max_bits: int = 2, fp: str = "fp") -> DataFrame:
    """All pairs ``a < b`` of distinct 64-bit fingerprints that differ in at most ``max_bits`` (1 to 7) bits.

    ``distinct`` has one row for each fingerprint. Every such pair is found: it shares at least
    ``8 - max_bits`` positional bytes, and so a key of the index.
    """
    least = BYTES - max_bits
    masks = [_signed(sum(255 << (8 * at) for at in kept)) for kept in combinations(range(BYTES), least)]
    keys = F.array(*(F.col(fp).bitwiseAND(F.lit(m).cast("long")) for m in masks))
    index = distinct.select(F.col(fp).alias("fp"), F.posexplode(keys).alias("positions", "bytes"))
    # Spark sizes the index as one row for each fingerprint, whatever the explode makes of it: too low to broadcast it by that.
    a, b = index.alias("a").hint("merge"), index.alias("b")
    difference = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    met = a.join(
        b,
        (F.col("a.positions") == F.col("b.positions"))
        & (F.col("a.bytes") == F.col("b.bytes"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (shared_bytes(difference) >= least)
        & (F.bit_count(difference) <= max_bits),
    )
    return met.groupBy(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).agg(F.count("*").alias("met_under"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``a, b`` (longs): ``node``, ``label``, the label its smallest node.

    Alternating large and small stars: each round links every node to the smallest one near it. A round is
    two shuffles of the links, which never grow in number; rounds grow with the logarithm of the longest chain.
    Each round is written to the shared folder. Links of a node with itself are ignored; no links give no rows.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == seen:
            break
        seen = (state["n"], state["h"])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smaller = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smaller, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        turned = small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct()
        following = written(turned, "links")
        forget(edges)
        edges = following
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for each document.

    Documents are linked if their fingerprints differ in at most ``max_bits`` bits; ``component_id`` is the
    smallest ``doc_id`` that can be reached over links. Texts that are NULL, empty or without words share
    fingerprint zero. Rows that share a ``doc_id`` stay separate rows; a NULL ``doc_id`` is never the smallest,
    and a component without any other has a NULL id. Columns besides the two are not looked at.
    """
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = written(fingerprints(source, shingle).select("doc_id", "fp"), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = components(linked_pairs(classes.select("fp"), max_bits))
    linked = labels.join(classes, labels["node"] == classes["fp"]).select("fp", "label", "first")
    smallest = linked.groupBy("label").agg(F.min("first").alias("smallest"))
    known = linked.join(smallest, "label").select("fp", "smallest")
    of_class = classes.join(known, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id"))
    # Each row has a class, so this join keeps the same rows as an inner one. It never broadcasts the rows, whose files may be small.
    return rows.join(of_class, "fp", "left").select("doc_id", "fp", "component_id")


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """XXH64 of the distinct shingles of a whole text, sorted; words and shingles as in :func:`_shingles`."""
    return np.unique(_hashes(*_shingles(text, shingle)))


def set_and_fingerprint(text: str, shingle: int) -> tuple[np.ndarray, int]:
    """:func:`shingle_set` and :func:`fingerprint` of a text, whose shingles are hashed once for both."""
    hashes = _hashes(*_shingles(text, shingle))
    counts = np.zeros((BYTES, 8), dtype=np.int64)
    for at in range(0, len(hashes), SLICE):
        counts += _votes(hashes[at : at + SLICE], 1)
    return np.unique(hashes), int(_majority(counts, len(hashes))[0])


def _prefix(shingles: np.ndarray, similarity: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order that all sets share: those not in ``common`` by hash, then those by count.

    Two sets of at least this similarity have a common shingle among theirs, whatever the order; putting common
    shingles last only keeps the lists short.
    """
    n = len(shingles)
    rank = np.zeros(n, dtype=np.int64)
    if len(common):
        place = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        known = common[place] == shingles
        rank[known] = counts[place[known]]
    kept = n - math.ceil(similarity * n - 1e-9) + 1 if n else 0
    return shingles[np.lexsort((shingles, rank))[:kept]]


def _common_shingles(source: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``COMMON`` of the commonest shingles, sorted, and their counts, by a sample of texts: see :func:`_prefix`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text, shingle).view(np.int64))], names=["shingle"])

    sample = source.where(F.pmod("text_key", F.lit(COUNTED)) == 0).select("text").mapInArrow(run, "shingle long")
    found = sample.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 2").orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()
    hashes = np.asarray(found["shingle"]).astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.asarray(found["n"]).astype(np.int64)[order]


def _verified(pairs: DataFrame, classes: DataFrame, source: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Those of ``a, b`` (nodes) whose sets of distinct shingles have at least this Jaccard similarity, written.

    Only texts in some pair are read into sets; the bitmap of fixed size that finds them only saves work.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(classes.select("node", "text_key").join(nodes, "node"), "wanted")
    sent = source.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.col("text_key").alias("hash"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("text_key")).astype(np.int64)
            for at in np.flatnonzero(passing(keys.view(np.uint64), sent.value)).tolist():
                found = shingle_set(batch.column("text")[at].as_py(), shingle).view(np.int64)
                sets = pa.array([found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 1]), sets], names=["text_key", "shingles"])

    read = source.select("text_key", "text").mapInArrow(run, "text_key long, shingles array<long>").dropDuplicates(["text_key"])
    sets = written(wanted.join(read, "text_key").select("node", "shingles"), "shingle-sets")
    sides = [sets.select(F.col("node").alias(s), F.col("shingles").alias(f"of_{s}")) for s in "ab"]
    shared, total = F.size(F.array_intersect("of_a", "of_b")), F.size("of_a") + F.size("of_b")
    linked = pairs.join(sides[0], "a").join(sides[1], "b").where(shared * (1 + similarity) >= total * similarity - 1e-9)
    found = written(linked.select("a", "b"), "verified")
    for done in (wanted, sets):
        forget(done)
    return found


def _fingerprint_pairs(prints: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``a < b`` of each node and the smallest node of its fingerprints' component, from rows ``node, fp``.

    Components are those of :func:`near_duplicates`. One pair for each node and fingerprint, however large a component is.
    """
    labels = components(linked_pairs(prints.select("fp").distinct(), max_bits))
    placed = prints.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").select("node", F.coalesce("label", "fp").alias("label"))
    hubs = placed.groupBy("label").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other")
    met = placed.join(hubs, "label").where("node <> hub")
    return met.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def _of_two_classes(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those of ``a, b`` (nodes) that are not of one class yet."""
    sides = [labels.select(F.col("node").alias(s), F.col("label").alias(f"of_{s}")) for s in "ab"]
    placed = pairs.join(sides[0], "a", "left").join(sides[1], "b", "left")
    return placed.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def similar_documents(
    df: DataFrame, similarity: float = 0.8, shingle: int = 5, doc_id: str = "doc_id", text: str = "text", max_bits: int = 2
) -> DataFrame:
    """``doc_id, text_key, node, fp, label``: classes of texts whose shingles are similar; equal labels mean one class.

    Two texts are linked exactly if their sets of distinct shingles have at least this Jaccard similarity; classes are
    the connected components of the links.

    First come the fingerprints: texts are put into the components that :func:`near_duplicates` makes of fingerprints (of
    the same shingles, at most ``max_bits`` apart), and each is compared with one of its component. At such similarities
    fingerprints guarantee no minimum of shared bytes, so what they do not link is then sought by
    the sets themselves: in one order of all shingles, two similar sets share one of their first
    ones (prefix filter), at places from which enough is left of both (position filter). Both are necessary
    conditions, no pair is lost.

    There each set is first compared with two nodes of each of its lists, so that a large group of near copies becomes one class
    at the cost of its size: the smallest, and the one with the fewest shingles before the list's, which are the seldom
    ones; in a group of edited copies that is the text with the fewest edits, to which most are similar.
    Then all pairs in a list that are not of one class yet are compared, list by list of the classes' members. Sets that
    reach no size in a list are not in it. All links are settled by the whole sets. text_key is the text's XXH64.
    Texts that are NULL, empty or without words form one class.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    order = spark.sparkContext.broadcast(_common_shingles(source, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [set_and_fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            sets = [found for found, _ in both]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
            prefixes = pa.array([_prefix(s, similarity, *order.value).view(np.int64) for s in sets], pa.list_(pa.int64()))
            columns = [pa.array(nodes), pa.array([fp for _, fp in both], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), prefixes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *columns], names=["doc_id", "text_key", "node", "fp", "size", "prefix"]
            )

    kinds = "doc_id long, text_key long, node long, fp long, size int, prefix array<long>"
    rows = written(source.mapInArrow(run, kinds), "shingle-prefixes")
    classes = written(rows.groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("size").alias("size"), F.first("prefix").alias("prefix")), "classes")
    nodes = written(rows.select("doc_id", "text_key", "node", "fp"), "nodes")
    forget(rows)
    near = written(_fingerprint_pairs(nodes.select("node", "fp").distinct(), max_bits), "fingerprint-pairs")
    close = _verified(near, classes, source, similarity, shingle)
    forget(near)
    postings = classes.select(F.posexplode("prefix").alias("pos", "shingle"), "node", "size").select("shingle", F.struct("node", "size", "pos").alias("x"))
    # A shingle is in a set once, so its rows are its sets. Few and narrow columns: most shingles have one row, which they repeat.
    plain = F.min(F.struct("x.pos", "x.size", "x.node"))
    ends = postings.groupBy("shingle").agg(F.min("x").alias("low"), plain.alias("plain"), F.min("x.size").alias("least"), F.count("*").alias("n"))

    def enough(left: Column, sizes: Column) -> Column:
        """Whether sets of these sizes together can be similar if they share at most ``left`` shingles."""
        return left * (1 + similarity) >= sizes * similarity - 1e-9

    reaches = enough(F.col("x.size") - F.col("x.pos"), F.col("x.size") + F.col("least"))
    same_order = F.struct("plain.node", "plain.size", "plain.pos").alias("plain")
    lists = written(postings.join(ends.where("n > 1"), "shingle").where(reaches).select("shingle", "x", "low", same_order), "lists")

    def similar(x: Column, y: Column) -> Column:
        """Whether two entries are far enough from the ends of their sets to be similar."""
        return (x["node"] != y["node"]) & enough(F.least(*(s["size"] - s["pos"] for s in (x, y))), x["size"] + y["size"])

    def pairs(frame: DataFrame, others: Column) -> DataFrame:
        """Distinct pairs of the entry ``x`` and those of ``others`` that it can be similar to."""
        met = frame.select("x", F.explode(F.filter(others, lambda y: similar(F.col("x"), y))).alias("y"))
        return met.select(*(f("x.node", "y.node").alias(s) for f, s in ((F.least, "a"), (F.greatest, "b")))).distinct()

    first = written(_of_two_classes(pairs(lists, F.array("low", "plain")), components(close)), "star-pairs")
    links = close.unionByName(_verified(first, classes, source, similarity, shingle))
    labels = components(links)
    placed = lists.select("shingle", F.col("x.node").alias("node"), "x").join(labels, "node", "left")
    members = placed.groupBy("shingle", F.coalesce("label", "node").alias("label"), F.pmod("node", F.lit(PARTS)).alias("part")).agg(F.collect_list("x").alias("xs"))
    members = written(members.select("shingle", "label", "xs"), "members")
    forget(lists)
    mixed = members.groupBy("shingle").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("shingle")
    several = members.join(mixed, "shingle")
    other = several.select("shingle", F.col("label").alias("label_y"), F.col("xs").alias("ys"))
    met = several.join(other, "shingle").where("label < label_y").select(F.explode("xs").alias("x"), "ys")
    second = written(pairs(met, F.col("ys")).join(first, ["a", "b"], "left_anti"), "list-pairs")
    forget(members)
    forget(first)
    settled = _verified(second, classes, source, similarity, shingle)
    forget(second)
    forget(classes)
    labels = components(links.unionByName(settled))
    return nodes.join(labels, "node", "left").select("doc_id", "text_key", "node", "fp", F.coalesce("label", "node").alias("label"))


@keeps_inner_names_apart
def one_of_each(df: DataFrame, similarity: float = 0.8, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class of similar ones (:func:`similar_documents`), with all its columns: that with the smallest
    id, then text hash.

    A NULL id is kept only where the class has no other. Rows that repeat an id and its text are one document.
    """
    rows = written(similar_documents(df, similarity, shingle, doc_id, text), "similar")
    best = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best"))
    kept = written(best.select(F.col("best.doc_id").alias("_id"), F.col("best.text_key").alias("_key")), "kept")
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.xxhash64(whole_text(text)) == F.col("_key"))
    found = df.join(kept, same, "left_semi")
    twice = rows.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    twice = written(twice, "repeated")
    if twice.isEmpty():
        return found
    return found.join(twice, same, "left_anti").unionByName(found.join(twice, same, "left_semi").dropDuplicates([doc_id, text]))
