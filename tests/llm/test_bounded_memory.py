"""What workers hold at once and remember."""

from __future__ import annotations

import random
import unicodedata

import public_tokenizers
from tokenizers import Tokenizer

from lakeops.llm import bpe, common, templates

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(["ka", "lo", "mi", "ne", "ru", "é"], k=rng.randint(1, 4))) for _ in range(n))


def test_slices_hold_all_texts_in_order_and_few_characters():
    texts = ["a" * n for n in (3, 0, 4, 9, 1, 1, 0, 30, 2)]
    ranges = list(common.slices(texts, 8))
    assert [k for a, b in ranges for k in range(a, b)] == list(range(len(texts)))
    assert all(b - a == 1 or sum(map(len, texts[a:b])) <= 8 for a, b in ranges)
    assert list(common.slices([], 8)) == []


def test_slices_of_documents_keep_their_own_windows(spark, docs_of):
    """More text than is looked at together, and a copied item at the end of it."""
    item = prose(31, 20)
    long = prose(32, 2_000)
    times = 3 * templates.TOGETHER // len(long)
    rows = [(k, long) for k in range(times)] + [(5_000, prose(33, 30) + " " + item)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = templates.contaminations(docs_of(rows).coalesce(1), benchmark).collect()
    assert [(r.doc_id, r.item_id, r.kind) for r in got] == [(5_000, 1, "copy")]


def test_two_generations_of_chunks_change_no_ids(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 30)
    monkeypatch.setattr(bpe, "ARCS", 20)
    automaton, library = bpe.Automaton(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for text in [prose(k % 7, 60) for k in range(21)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text) == b"".join(n.to_bytes(4, "little") for n in ids)
        assert max(len(automaton.chunks), len(automaton.chunks.older)) <= 30 and len(automaton.arcs) <= 20
    assert automaton.chunks.older


def test_a_round_trip_goes_through_python_once(docs_of, edge_rows):
    docs = docs_of(edge_rows)
    done = bpe.round_trip(docs, WORD_BPE)
    assert done._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    apart = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE)
    assert done.schema == apart.schema
    assert sorted(map(str, done.collect())) == sorted(map(str, apart.collect()))


def test_a_word_is_worked_out_once_in_all_chunks(monkeypatch):
    worked_out = []
    original = bpe.Automaton.word
    monkeypatch.setattr(bpe.Automaton, "word", lambda self, symbols: worked_out.append("".join(symbols)) or original(self, symbols))
    automaton, library = bpe.Automaton(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    text = "Kalomi, kalomi. (kalomi) KALOMI! kalomi-kalomi"
    ids = library.encode(text, add_special_tokens=False).ids
    assert automaton.encode(text) == b"".join(n.to_bytes(4, "little") for n in ids)
    assert worked_out.count("kalomi</w>") == 1


def test_a_word_leaves_each_position_once_at_most(monkeypatch):
    """Words that lead the longest arcs astray, long ones too, encode as the library does."""
    left = []
    original = getattr(bpe.Automaton, "ways", None)
    monkeypatch.setattr(bpe.Automaton, "ways", lambda self, symbols, i: left.append(i) or original(self, symbols, i), raising=False)
    automaton, library, rng = bpe.Automaton(WORD_BPE), Tokenizer.from_file(WORD_BPE), random.Random(41)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for letters in ("ab", "tionsrea", "osn", "éüa") for _ in range(200)]
    steps = 0
    for word in ["of" * 2_000, *words, "a" * 3_000, "re" * 2_000, "in the".replace(" ", "") * 500]:
        left.clear()
        ids = library.encode(word, add_special_tokens=False).ids
        assert automaton.encode(word) == b"".join(n.to_bytes(4, "little") for n in ids)
        assert len(left) == len(set(left))
        steps += len(left)
    assert steps > 3_000


def test_what_python_has_no_table_of_is_not_printable():
    new = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    assert new and not any(c.isprintable() for c in new)
