"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens, not characters. It starts as one state with a loop for each base
symbol. Each merge ``u v -> w`` then adds one gadget, in the order of the merges:

* wherever ``u`` may be read, ``w`` may be read now, and leads where ``v`` led;
* the state behind ``u`` is replaced by a copy that lacks the arc ``v``.

Behind the last gadget the automaton accepts exactly one token sequence for each symbol sequence,
the one the merges produce. A copied state differs from its original in one arc, so rows are not
stored: a state is the token that led to it, and ``gadget`` holds the merge that cut the arc
``(u, v)``. :meth:`Automaton.arc` looks an arc up by walking the two short spines of halves.

Each position that a tokenization reaches has one state; from there the trie of tokens gives the possible next
arcs, and the arc table says which exist. Encoding follows the longest arc and goes back to a shorter one where that
leads nowhere; it leaves each position once at most. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import carried, keeps_inner_names_apart, prepare_workers, whole_text

END = "</w>"
#: Distinct chunks of text, as many words in them, and arcs, that a worker remembers. Speed only: chunks and words come in two
#: generations of this size, and those that do not occur again during one are forgotten; a full memory of arcs is emptied.
REMEMBERED, ARCS = 200_000, 200_000
NEVER = 1 << 60
#: White space that a text normaliser folds but Python's str.split() does not agree on.
_CONTROL_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, free = [], 256
    for byte in range(256):
        letters.append(chr(byte) if byte in shown else chr(free))
        free += byte not in shown
    return letters


class Automaton:
    """Compiled tables of one tokenizer file: BPE whose last symbol of a word carries an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or suffix != END or spec.get("decoder"):
            raise ValueError("Expected a BPE file with word ends and no decoder of its own")
        self.letters = byte_letters()
        vocab: dict[str, int] = model["vocab"]
        self.labels = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for text, number in vocab.items():
            self.labels[number] = text
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, number in self.special.items():
            self.labels[number] = text
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.gadget: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"], 1):
            first, second = merge.split(" ") if isinstance(merge, str) else merge
            u, v = vocab[first], vocab[second]
            if not self.arc(u, v):
                continue  # the pair can never stand side by side
            w = vocab[first + second]
            self.left[w], self.right[w], self.born[w] = u, v, rank
            self.gadget[u, v] = rank
        self.tokens = [number for text, number in vocab.items() if len(text.removesuffix(END)) <= 1 or number in self.born]
        self.start()

    @staticmethod
    def symbols(text: str) -> list[str]:
        """Letters of a token; the end mark belongs to the last one."""
        if not text.endswith(END) or text == END:
            return list(text)
        body = text.removesuffix(END)
        return [*body[:-1], body[-1] + END]

    def start(self) -> None:
        """What is not sent along: compiled patterns, the trie and memories."""
        self.find, self.scan = regex.compile(self.pattern).findall, regex.compile(self.pattern).finditer
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.ends = [letter + END for letter in self.letters]
        #: For each symbol the node behind it, None without any arcs, and the token that ends there, if one does.
        self.trie: dict[str, list] = {}
        for number in self.tokens:
            node, step = self.trie, [None, None]
            for symbol in self.symbols(self.labels[number]):
                if node is None:
                    node = step[0] = {}
                step = node.setdefault(symbol, [None, None])
                node = step[0]
            step[1] = number
        self.arcs: dict[tuple[int, int], bool] = {}
        self.chunks, self.pieces = _Memory(self.chunk), _Memory(self.piece)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("find", "scan", "cut", "ends", "trie", "arcs", "chunks", "pieces")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.start()

    def arc(self, u: int, w: int) -> bool:
        """Whether the state behind ``u`` has an arc ``w``.

        A copy of the state was cut by a gadget at ``(x, y)`` if the gadget came while ``x`` stood for the
        end of ``u`` and ``y`` for the start of ``w``.
        """
        x, until_x = u, NEVER
        while True:
            y, until_y = w, NEVER
            while True:
                rank = self.gadget.get((x, y), NEVER)
                if rank < until_x and rank <= until_y and rank != NEVER:
                    return False
                if y not in self.left:
                    break
                y, until_y = self.left[y], self.born[y]
            if x not in self.right:
                return True
            x, until_x = self.right[x], self.born[x]

    def word(self, symbols: list[str]) -> list[int]:
        """Tokens of one word by table-driven transitions, the longest first.

        What is read up to a position has one token sequence, so a position that led nowhere is not tried again.
        """
        n, arcs = len(symbols), self.arcs
        tried = bytearray(n + 1)
        tokens: list[int] = []
        ways = [self.ways(symbols, 0)]
        while True:
            way = ways[-1]
            if not way:
                ways.pop()
                tokens.pop()
                continue
            j, token = way.pop()
            if tried[j]:
                continue
            if tokens:
                arc = (tokens[-1], token)
                fits = arcs.get(arc)
                if fits is None:
                    if len(arcs) >= ARCS:
                        arcs.clear()
                    fits = arcs[arc] = self.arc(*arc)
                if not fits:
                    continue
            tokens.append(token)
            if j == n:
                return tokens
            tried[j] = 1
            ways.append(self.ways(symbols, j))

    def ways(self, symbols: list[str], i: int) -> list[tuple[int, int]]:
        """Tokens of the vocabulary that the symbols from ``i`` on begin with, and where each ends, by rising length."""
        node, j, found = self.trie, i, []
        for symbol in symbols[i:] if i else symbols:
            step = node.get(symbol)
            if step is None:
                break
            j += 1
            node, token = step
            if token is not None:
                found.append((j, token))
            if node is None:
                break
        return found

    def words(self, text: str) -> list[str]:
        """Pieces by the file's pattern; a letter newer than Python's own tables counts as a symbol."""
        if text.isascii() or text.isprintable():  # what Python has no table of does not count as printable
            return self.find(text)
        known = "".join("\ue000" if unicodedata.category(c) == "Cn" else c for c in text)
        return [text[m.start() : m.end()] for m in self.scan(known)]

    def chunk(self, text: str) -> bytes:
        """Ids of a piece of text without white space, as bytes of 32-bit numbers."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        pieces = self.pieces
        return b"".join([pieces[word] for word in self.words(text)])

    def piece(self, word: str) -> bytes:
        """Ids of one word, as bytes of 32-bit numbers."""
        data = word.encode("utf-8", "replace")
        letters = self.letters
        symbols = [letters[b] for b in data]
        symbols[-1] = self.ends[data[-1]]
        return np.array(self.word(symbols), dtype="<i4").tobytes()

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        parts = _SPACES.split(text) if _CONTROL_SPACE.search(text) else text.split()
        chunks = self.chunks
        return b"".join([chunks[part] for part in parts])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as bytes of 32-bit numbers; special tokens keep their own ids."""
        if self.cut is None or "<|" not in text and not self.cut.search(text):
            return self.plain(text)
        return b"".join(
            np.int32(self.special[part]).tobytes() if part in self.special else self.plain(part) for part in self.cut.split(text) if part
        )


class _Memory(dict):
    """Ids of texts seen before: in this generation, and in ``older`` in the one before. Others are worked out by ``ids_of``."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        super().__init__()
        self.ids_of, self.older = ids_of, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.ids_of(text)
        if len(text) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


@keeps_inner_names_apart
def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, the token ids of each whole text.

    tokenizer: path of the tokenizer file, read once here. The compiled tables are as large as its
    vocabulary and are sent to the workers. NULL and empty texts give an empty list. Rows stay one to one,
    repeated ones too; a column that is called like the result is replaced, all others are kept.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    tables = spark.sparkContext.broadcast(Automaton(tokenizer))
    keep = carried(df, [ids])
    at = "_text_to_encode"
    source = df.select(*keep, whole_text(text).alias(at))
    schema = T.StructType([*df.select(*keep).schema, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = tables.value
        for batch in batches:
            found = [automaton.encode(t) for t in batch.column(at).to_pylist()]
            lists = _lists(found)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), lists], names=[*keep, ids])

    return source.mapInArrow(run, schema)


def _lists(found: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, dtype=np.int32)
    np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
    values = np.frombuffer(b"".join(found), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


@keeps_inner_names_apart
def decode(df: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the labels of the arcs, joined by one space as the file has no decoder.

    NULL lists and empty lists give the empty text; an id the file does not know raises.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    labels = spark.sparkContext.broadcast(Automaton(tokenizer).labels)
    keep = carried(df, [decoded])
    at = "_ids_to_decode"
    source = df.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias(at))
    schema = T.StructType([*df.select(*keep).schema, T.StructField(decoded, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(labels.value)
        for batch in batches:
            joined = _joined(names, batch.column(at))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), joined], names=[*keep, decoded])

    return source.mapInArrow(run, schema)


def _joined(names: pa.Array, lists: pa.ListArray) -> pa.Array:
    """The labels of each list's ids, joined by one space."""
    words = pc.take(names, lists.flatten())
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), " ")


@keeps_inner_names_apart
def round_trip(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Documents with ``ids`` and ``decoded``: :func:`encode`, and :func:`decode` of its ids, in one pass over the texts."""
    spark = df.sparkSession
    prepare_workers(spark)
    tables = spark.sparkContext.broadcast(Automaton(tokenizer))
    keep, at = carried(df, ["ids", "decoded"]), "_text_to_encode"
    source = df.select(*keep, whole_text(text).alias(at))
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = tables.value
        names = pa.array(automaton.labels)
        for batch in batches:
            lists = _lists([automaton.encode(t) for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), lists, _joined(names, lists)], names=[*keep, "ids", "decoded"])

    return source.mapInArrow(run, T.StructType([*df.select(*keep).schema, *added]))
