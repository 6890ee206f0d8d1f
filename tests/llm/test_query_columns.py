"""Columns of registered queries on the smallest table, row by row against plain Python."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeops.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name, *columns):
    return Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SF).collect())


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tokenizer(name):
    found = Tokenizer.from_file(str(public_tokenizers.path(name)))
    found.no_truncation()
    found.no_padding()
    return found


def test_op2_columns(spark, texts):
    library, want = tokenizer("word_bpe_49k.json"), Counter()
    for doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), sha256(" ".join(map(str, ids))), sha256(decoded)] += 1
    assert rows(spark, "op2_bpe_automaton", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op7_columns(spark, texts):
    got = queries.QUERIES["op7_hypergeometric_shards"](spark, SF).collect()
    want = Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(k, [])) for k in range(24)]
    assert set(slots) <= set(range(24)) and max(counts) - min(counts) <= 1
    first = min(min(s) for s in slots.values())
    assert all(sorted(s) == list(range(first, first + len(s))) for s in slots.values())


BASE = (
    ("assign", re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def test_op8_base_columns(spark, texts):
    want = Counter()
    for doc_id, text in texts:
        spans = []
        for k, (_, pattern, group, least) in enumerate(BASE):
            spans += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        spelled = ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        want[doc_id, *counts, sha256(spelled)] += 1
    assert rows(spark, "op8_secret_randomness", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_op9_columns(spark, texts):
    library, want, start = tokenizer("byte_bpe_50k.json"), Counter(), 0
    for doc_id, text in sorted(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want[doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
        start += len(ids)
    assert rows(spark, "op9_token_bit_packing", "doc_id", "start", "n_tokens", "ids_crc32") == want
