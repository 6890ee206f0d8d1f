"""Token ids in fixed-width bit-packed files.

A file is a Parquet dataset whose rows are blocks; any file system Spark can write will do, and a lost
task's block is simply written again. A block holds whole documents:

===========  ====================================================================
part         number of the range of documents the block lies in
block        number of the block within its part
start        ids before the block, within its part
width        bits for each id, the least that hold the vocabulary
doc_ids      the documents of the block, ascending
ends         for each of them the number of ids in the block up to its end
payload      the ids, ``width`` bits each, least significant bit first
===========  ====================================================================

``<path>/parts`` adds one row for each part: the ids before it. Id ``k`` of a block lies at bit
``k * width`` of its payload, so a block unpacks as one vectorised numpy step, and a single document
needs only its own bytes (:func:`slice_ids`). The position of a document in the whole corpus is
the start of its part, plus the start of its block, plus the previous end.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.common import prepare_workers, whole_text

#: A block is closed by the document that brings it to this many ids.
BLOCK_IDS = 1 << 16
BLOCKS = (
    "part int, block int, start long, width int, doc_ids array<long>, ends array<long>, payload binary, n_ids long"
)


def bits_for(vocabulary: int) -> int:
    """The least number of bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits for each id."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"An id does not fit into {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, n: int, width: int) -> np.ndarray:
    """The first ``n`` ids of a payload."""
    return slice_ids(payload, 0, n, width)


def slice_ids(payload: bytes, first: int, last: int, width: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive), read from their own bytes alone."""
    if first >= last:
        return np.zeros(0, dtype=np.uint32)
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(payload, dtype=f"<u{size}", count=last - first, offset=first * size).astype(np.uint32)
    low, high = first * width // 8, (last * width + 7) // 8
    raw = np.frombuffer(payload, dtype=np.uint8, count=high - low, offset=low)
    bits = np.unpackbits(raw, bitorder="little")[first * width - 8 * low :][: (last - first) * width]
    return bits.reshape(-1, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def write_token_files(
    df: DataFrame,
    path: str,
    encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]],
    vocabulary: int,
    end_id: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode each whole text and write the ids to ``path`` in ascending order of ``doc_id``.

    encoder: makes, on a worker, the function from texts to id arrays. end_id: appended to each document.
    NULL and empty texts have no ids but the end. A NULL doc_id comes first; rows that share a doc_id are
    ordered by their text, and are all kept. No rows give files without blocks.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    width = bits_for(vocabulary)
    order = ["doc_id", "salt"]
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    source = source.withColumn("salt", F.xxhash64("text"))
    placed = source.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder()
        part, block, start = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        found: list[np.ndarray] = []
        held = 0
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

        def closed() -> pa.RecordBatch:
            nonlocal names, found, held, block, start
            ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
            ends = np.cumsum([len(x) for x in found])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([width], pa.int32()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([ends], pa.list_(pa.int64())),
                    pa.array([pack(ids, width)], pa.binary()),
                    pa.array([len(ids)], pa.int64()),
                ],
                names=[c.split(" ")[0] for c in BLOCKS.split(", ")],
            )
            start, block = start + len(ids), block + 1
            names, found, held = [], [], 0
            return row

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for name, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                names.append(name)
                found.append(np.concatenate([ids, end]))
                held += len(ids) + len(end)
                if held >= BLOCK_IDS:
                    yield closed()
        if names:
            yield closed()

    placed.select("doc_id", "text").mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    totals = blocks(spark, path).groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # One row for each part, however many documents there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("part", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("part_start")).write.parquet(f"{path}/parts")


def blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if wanted, ``ids``.

    start: ids of all documents before it. ids_crc32: checksum of its ids as little-endian unsigned
    32-bit numbers, taken while they are unpacked.
    """
    prepare_workers(spark)
    fields = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["n_ids"], row["width"])
                ends = np.array(row["ends"], dtype=np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(ids.astype("<u4").tobytes())
                columns = [
                    pa.array(np.full(len(ends), row["part"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + starts),
                    pa.array(ends - starts),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ]
                if with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pc.cast(pa.array(ids), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split(" ")[0] for f in fields.split(", ")])

    parts = spark.read.schema("part int, n_ids long, part_start long").parquet(f"{path}/parts")
    rows = blocks(spark, path).mapInArrow(run, fields).join(parts.select("part", "part_start"), "part")
    wanted = ["n_tokens", "ids_crc32", *["ids"] * with_ids]
    return rows.select("doc_id", (F.col("part_start") + F.col("start")).alias("start"), *wanted)


def library_encoder(tokenizer: str) -> Callable[[], Callable[[list[str]], list[np.ndarray]]]:
    """An encoder for :func:`write_token_files` that asks the tokenizers library.

    For files with a GPT-like byte-level split. Text is cut where that split always cuts, so that the library
    sees each distinct piece once and not each of its occurrences. The path must exist on the workers.
    """

    def make() -> Callable[[list[str]], list[np.ndarray]]:
        return _Pieces.of(tokenizer).encode

    return make


class _Pieces:
    """Ids of the pieces a worker has seen."""

    #: Pieces remembered; a full memory is emptied. Speed only.
    REMEMBERED = 1_500_000
    _made: dict[str, _Pieces] = {}

    @classmethod
    def of(cls, path: str) -> _Pieces:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        space = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
        #: A word with the space before it; white space up to the last one before a word; what is left.
        self.pieces = re.compile(f" ?[^{space}]+|[{space}]+(?![^{space}])|[{space}]+").findall
        #: White space that rules out cutting at single spaces.
        self.odd = re.compile(f"[\t\x0b-\r\x1c-\x1f{space[4:]}]").search
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        tokens = self.tokenizer.get_vocab()
        mark = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]  # how tokens spell a space
        self.takes_space = np.zeros(max(tokens.values()) + 1, dtype=bool)
        self.takes_space[[n for token, n in tokens.items() if token.startswith(mark)]] = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.known) + len(self.spaced) > self.REMEMBERED:
            self.known.clear()
            self.spaced.clear()
        done: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain, other, cut = [], [], []
        for at, text in enumerate(texts):
            if self.special is not None and "<|" in text and self.special.search(text):
                whole = self.special.fullmatch
                other.append(at)
                cut.append([p for s in self.special.split(text) for p in ([s] if whole(s) else self.pieces(s))])
            elif "  " in text or " \n" in text or "\n " in text or text[-1:] == " " or self.odd(text):
                other.append(at)
                cut.append(self.pieces(text))
            else:
                plain.append(at)
        lost = {p for parts in cut for p in parts if p not in self.known}
        if lost:
            self.learn([(False, p) for p in lost])
        for at, parts in zip(other, cut, strict=True):
            done[at] = np.frombuffer(b"".join([self.known[p] for p in parts]), dtype="<u4")
        for at, ids in zip(plain, self.cut_at_spaces([texts[at] for at in plain]), strict=True):
            done[at] = ids
        return done

    def cut_at_spaces(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that fall apart at single spaces. Each different piece of the batch is looked up once."""
        if not texts:
            return []
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = parts.offsets.to_numpy()
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        at, different = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        # A text's first piece has no space before it.
        first = flat.take(pa.array(starts[:-1])).to_pylist()
        lost = [(True, p) for p in different if p and p not in self.spaced] + [(False, p) for p in set(first) if p not in self.known]
        if lost:
            self.learn(lost)
        found = [self.spaced[p] if p else b"" for p in different] + [self.known[p] for p in first]
        at[starts[:-1]] = len(different) + np.arange(len(first))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, begins = np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(lengths) - lengths
        each = lengths[at]
        ends = np.cumsum(each)
        ids = pool[np.repeat(begins[at] - (ends - each), each) + np.arange(int(each.sum()))]
        cuts = np.concatenate([[0], ends])[starts]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def learn(self, pieces: list[tuple[bool, str]]) -> None:
        """Ask the library for pieces not seen yet; with True, a space comes before the piece.

        Pieces behind a space are asked for as one text: the split never reaches over such a space.
        """
        spaced = [p for after, p in pieces if after]
        for at in range(0, len(spaced), 2_000):
            some = spaced[at : at + 2_000]
            got = self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0]
            ids = np.array(got.ids, dtype="<u4")
            # A piece begins with the one token that takes in the space before it.
            starts = np.flatnonzero(self.takes_space[ids])
            if len(starts) != len(some):
                raise ValueError("The tokenizer does not keep a space with the piece behind it")
            cuts = (4 * np.append(starts, len(ids))).tolist()
            raw = ids.tobytes()
            self.spaced.update((p, raw[a:b]) for p, a, b in zip(some, cuts, cuts[1:], strict=False))
        alone = [p for after, p in pieces if not after]
        for piece, got in zip(alone, self.tokenizer.encode_batch(alone, add_special_tokens=False), strict=True):
            self.known[piece] = np.array(got.ids, dtype="<u4").tobytes()
