from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from lakeops.llm import simhash


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijk", k=rng.randint(1, 6))) for _ in range(n)]


def plain_fingerprint(text, shingle=3):
    w = text.encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    names = list(range(len(prints)))
    label = dict(zip(names, names, strict=True))
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                if (prints[a] ^ prints[b]).bit_count() <= bits and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@pytest.mark.parametrize("text", ["", " \t", "One", "one TWO", "a b c", "a  b\nc d", "é É Ä", "a\x1cb c\xa0d", " ".join(words(1, 2_000))])
def test_fingerprint_against_plain_counting(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_slices_do_not_matter(monkeypatch):
    text = " ".join(words(2, 900))
    whole = simhash.fingerprint_words(text, 5, 4).tolist()
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.fingerprint_words(text, 5, 4).tolist() == whole
    assert whole[0] == simhash.fingerprint(text, 5)


def test_all_pairs_within_two_bits_are_found(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(4):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.linked_pairs(frame).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert found == want and want


def test_dense_cluster_under_one_key(spark):
    """All fingerprints share six bytes, as in the fullest list the index can have."""
    signed = list(range(300))
    found = simhash.linked_pairs(spark.createDataFrame([(p,) for p in signed], "fp long"))
    want = sum((a ^ b).bit_count() <= 2 for a in signed for b in signed if a < b)
    assert found.count() == want


def test_the_index_is_never_broadcast(spark, tmp_path):
    """Its rows are many times what Spark takes them for, so even a short table under the threshold is merged."""
    signed = [4, 5, 6, -1, 1 << 40]
    spark.createDataFrame([(p,) for p in signed], "fp long").write.parquet(f"{tmp_path}/prints")
    found = simhash.linked_pairs(spark.read.parquet(f"{tmp_path}/prints").distinct())
    assert sorted((r.a, r.b, r.met_under) for r in found.collect()) == [(4, 5, 7), (4, 6, 7), (4, 1 << 40, 1), (5, 6, 7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (-5, 300), (300, -7)]
    got = {r.node: r.label for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 130))
    assert got[300] == got[-5] == -7 and 200 not in got
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_brute_force(docs_of, edge_rows):
    texts = [" ".join(words(k, 60)) for k in range(25)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, texts[k] + " x") for k in range(12)] + [(50, texts[0]), (60, texts[0].upper())]
    rows += [(i and i + 1_000, t) for i, t in edge_rows]
    prints = [plain_fingerprint(t or "") for _, t in rows]
    label = plain_components(prints)
    want = {}
    for at, (name, _) in enumerate(rows):
        members = [rows[o][0] for o in label if label[o] == label[at] and rows[o][0] is not None]
        want.setdefault((name, prints[at]), min(members, default=None))
    got = simhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        assert want[row.doc_id, row.fp % (1 << 64)] == row.component_id


def test_the_rows_are_never_broadcast(docs_of):
    """Equal texts and ids in order take few bytes in files and many in memory; the classes are what is small."""
    found = simhash.near_duplicates(docs_of([(k, "a b c d") for k in range(40)] + [(None, None), (90, "e f g h")]))
    got = [(r.doc_id, r.component_id) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(k, 0) for k in range(40)] + [(None, None), (90, 90)], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan.split("Initial Plan")[-1].split("FileScan")[0]


def test_extra_columns_and_no_rows(docs_of):
    frame = docs_of([(1, "a b c d")]).withColumn("fp", F.lit("mine")).withColumn("component_id", F.lit("mine"))
    assert simhash.near_duplicates(frame).first().component_id == 1
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.one_of_each(docs_of([])).count() == 0


def test_one_of_each_keeps_one_of_a_group_and_every_other(docs_of, edge_rows):
    rng = random.Random(9)
    rows, groups = [], []
    for g in range(12):
        base = words(1_000 + g, 300)
        group = []
        for c in range(4):
            copy = list(base)
            for at in rng.sample(range(300), c):
                copy[at] = "changed"
            group.append((10 * g + c, " ".join(copy)))
        groups.append({i for i, _ in group})
        rows += group
    alone = [(500 + k, " ".join(words(5_000 + k, 200))) for k in range(30)]
    got = simhash.one_of_each(docs_of(rows + alone + [(i and i + 2_000, t) for i, t in edge_rows]))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = [r.doc_id for r in got.collect()]
    assert {i for i, _ in alone} <= set(kept)
    for group in groups:
        assert [i for i in kept if i in group] == [min(group)]
    assert kept.count(2_005) == 1
    # Texts without words are one class; its only row without an id is not the one that stays.
    assert sum(i in (2_002, 2_003, 2_004) for i in kept) == 1 and kept.count(None) == 1


def jaccard(a, b):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def classes_of(docs_of, texts):
    """Groups of documents by single links at 0.8, by brute force, and those found."""
    split = [t.split() for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if label[a] != label[b] and jaccard(split[a], split[b]) >= 0.8:
                label = [label[b] if x == label[a] else x for x in label]
    found = {}
    for row in simhash.similar_documents(docs_of(list(enumerate(texts)))).collect():
        found.setdefault(row.label, set()).add(row.doc_id)
    want = {}
    for at, x in enumerate(label):
        want.setdefault(x, set()).add(at)
    return sorted(map(sorted, want.values())), sorted(map(sorted, found.values()))


def test_all_pairs_just_similar_in_full_lists_are_found(docs_of):
    """A passage shared by all texts, and pairs at 0.8 to 0.85 among them."""
    rng = random.Random(11)
    passage, texts = words(77, 60), []
    for k in range(60):
        base = passage + words(9_000 + k, 140)
        copy = list(base)
        for at in rng.sample(range(65, 195), 40):
            before = list(copy)
            copy[at] = "changed"
            if jaccard(base, copy) < 0.8:
                copy = before
                break
        texts += [" ".join(base), " ".join(copy)]
    want, got = classes_of(docs_of, texts)
    assert got == want and sum(len(g) == 2 for g in want) == 60


def test_a_template_family_below_the_threshold_stays_whole(docs_of):
    """Texts at 0.6 to 0.79 of each other are no near duplicates, however many there are."""
    rng = random.Random(12)
    form, texts = words(78, 300), []
    for k in range(80):
        own = list(form)
        at = rng.randrange(30, 240)
        own[at : at + 36] = words(20_000 + k, 36)
        texts.append(" ".join(own))
    split = [t.split() for t in texts]
    near = [jaccard(split[a], split[b]) for a in range(80) for b in range(a)]
    assert sum(0.6 <= x < 0.8 for x in near) > 800
    want, got = classes_of(docs_of, texts)
    assert got == want


def test_edited_copies_meet_by_the_one_with_the_fewest_edits(docs_of):
    """Copies of one text with one to six words changed: some are similar to the text alone, some to nothing, sizes vary."""
    rng = random.Random(13)
    form, texts = words(79, 146), []
    for k in range(110):
        own = list(form[: 146 - rng.choice((0, 0, 0, 2, 9))])
        for at in rng.sample(range(len(own)), k % 7):
            own[at] = f"edit{k}x{at}"
        texts.append(" ".join(own))
    rng.shuffle(texts)
    want, got = classes_of(docs_of, texts)
    assert got == want and max(map(len, want)) > 40 and sum(len(g) == 1 for g in want) > 10


def test_similar_documents_come_through_their_fingerprints(docs_of, edge_rows, monkeypatch):
    """Each row carries its fingerprint, and the index is asked for the links of exactly these."""
    rows = [(100 + k, prose) for k, prose in enumerate([" ".join(words(300 + k, 80)) for k in range(10)])] + edge_rows
    asked, index = [], simhash.linked_pairs

    def spied(distinct, max_bits=2, fp="fp"):
        asked.append(({r[0] for r in distinct.select(fp).collect()}, max_bits))
        return index(distinct, max_bits, fp)

    monkeypatch.setattr(simhash, "linked_pairs", spied)
    got = simhash.similar_documents(docs_of(rows)).collect()
    want = sorted((i or 0, plain_fingerprint(t or "", 5)) for i, t in rows)
    assert sorted((r.doc_id or 0, r.fp % (1 << 64)) for r in got) == want
    assert asked == [({r.fp for r in got}, 2)]


def test_fingerprint_pairs_are_stars_of_the_components(spark):
    rng = random.Random(14)
    prints = []
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            prints.append(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2)))
    nodes = list(range(len(prints)))
    rng.shuffle(nodes)
    label = plain_components(prints)
    groups = {}
    for at, node in enumerate(nodes):
        groups.setdefault(label[at], []).append(node)
    want = {(min(g), node) for g in groups.values() for node in g if node != min(g)}
    frame = spark.createDataFrame([(n, p - (1 << 64) if p >> 63 else p) for n, p in zip(nodes, prints, strict=True)], "node long, fp long")
    assert {(r.a, r.b) for r in simhash._fingerprint_pairs(frame, 2).collect()} == want and want


def test_close_fingerprints_of_different_texts_are_no_link(docs_of):
    """One passage over and over decides both fingerprints; the sets of shingles share little."""
    again = " ".join(["same old words here again"] * 3_000)
    texts = [again + " " + " ".join(words(400 + k, 40)) for k in range(2)]
    assert (plain_fingerprint(texts[0], 5) ^ plain_fingerprint(texts[1], 5)).bit_count() <= 2
    want, got = classes_of(docs_of, texts)
    assert got == want == [[0], [1]]


@pytest.mark.parametrize("text", ["", "One", "a b c", "é É Ä x y z", " ".join(words(5, 3_000))])
def test_set_and_fingerprint_are_those_of_the_text(text, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 700)
    found, print_ = simhash.set_and_fingerprint(text, 5)
    assert print_ == simhash.fingerprint(text, 5) and print_ % (1 << 64) == plain_fingerprint(text, 5)
    assert found.tolist() == simhash.shingle_set(text, 5).tolist()
