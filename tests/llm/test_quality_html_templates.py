from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import html_text, quality, templates
from lakeops.llm.common import fold

RNG = random.Random(4)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(["ka", "lo", "mi", "ne", "ru", "ta"], k=rng.randint(1, 4))) for _ in range(n))


# Quality classifier


def machine(seed=0):
    rng = np.random.default_rng(seed)
    return quality.Machine(0.3, rng.normal(0, 1, quality.WIDTH).astype(np.float32), rng.normal(0, 1, (quality.WIDTH, 3)).astype(np.float32))


def test_margin_is_the_pairwise_sum():
    model, rows = machine(), quality.features(["one two two three", "", "Ünï!! \n 12"], [None, None, 99])
    for r, margin in enumerate(model.margins(rows)):
        part = slice(rows.starts[r], rows.starts[r + 1])
        index, x = rows.index[part], rows.value[part].astype(float)
        want = model.bias + sum(model.linear[i] * v for i, v in zip(index, x, strict=True))
        for a in range(len(index)):
            for b in range(a):
                want += float(model.factors[index[a]] @ model.factors[index[b]]) * x[a] * x[b]
        assert margin == pytest.approx(want, rel=1e-3, abs=1e-3)


def labelled(docs_of, spark, n=240):
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        text = prose(k, 60)
        rows.append((k, " ".join(w + "###" for w in text.split()) if bad else text))
        labels.append((k, 0 if bad else 1, 0))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_and_holds_out(docs_of, spark):
    docs, labels = labelled(docs_of, spark)
    model = quality.fit(docs, labels, ~fold("doc_id", 2, 4))
    got = quality.score(docs, model).select("doc_id", "score", fold("doc_id", 2, 4).alias("out")).collect()
    right = [(r.score >= quality.ACCEPT) == (r.doc_id % 4 != 0) for r in got if r.out]
    assert len(right) > 30 and np.mean(right) > 0.97
    assert quality.fit(docs, labels, ~fold("doc_id", 2, 4)).linear.tolist() == model.linear.tolist()


def test_held_out_labels_do_not_matter(docs_of, spark):
    docs, labels = labelled(docs_of, spark)
    turned = labels.withColumn("quality", F.when(fold("doc_id", 2, 4), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, x, ~fold("doc_id", 2, 4)) for x in (labels, turned))
    assert a.linear.tolist() == b.linear.tolist()


def test_scores_of_edge_rows(docs_of, edge_rows, spark):
    docs, labels = labelled(docs_of, spark, 80)
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels.union(odd), F.lit(True))
    got = quality.score(docs_of(edge_rows).withColumn("SCORE", F.lit("mine")), model)
    rows = got.collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs_of([]), model).count() == 0


def test_without_labels_or_with_one_label(docs_of, spark):
    docs = docs_of([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none, F.lit(True))).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    scores = {round(r.score, 6) for r in quality.score(docs, quality.fit(docs, one, F.lit(True))).collect()}
    assert scores == {round(2 / 3, 6)}


# Main text of pages


def test_tree_knows_its_table():
    rows, labels = html_text.labelled()
    assert (html_text.Tree(rows, labels).keeps(rows) == labels).all()


LONG = "This sentence is part of the story and long enough to be read as such by all."
PAGES = {
    "<article><h1>T</h1><p>One.</p><p>a &amp; b&nbsp;c &#65;&lt;</p></article><footer>x y z</footer>": "T\nOne.\na & b c A<",
    f"<nav><a>x</a></nav><article><p>{LONG}<p>Yes": f"{LONG}\nYes",
    f"<article><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></article>": LONG,
    f"<article><p>{LONG}</p><aside>{LONG}</aside><form>{LONG}</form></article>": LONG,
    f"<script>var a = '<article><p>x</p>'</script><article><style>p{{}}</style><p>{LONG}</p></article>": LONG,
    f"<div class=sidebar><p>{LONG}</p></div><article>A<b>b</b>c<br>d</article>": "Abc d",
    "<article><p>1 < 2 and &am": "1 < 2 and &am",
    "<article><!-- <p>no</p> --><p>a\n\t b</p><p </article>": "a b",
    f'<main><p title="a > b">{LONG}</p></main><div id="cookie-banner">{LONG}</div>': LONG,
    "<nav><a>only</a></nav>": "",
    "<p": "",
    "": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    tree = html_text.Tree(*html_text.labelled())
    assert html_text.main_text(page, tree) == PAGES[page]


def test_extract_keeps_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", f"<article><p>{LONG}"), (4, "w", "<p>" * 20_000), (4, "w", "<p>" * 20_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("TEXT", F.lit("mine"))
    got = html_text.extract(frame).collect()
    assert sorted(r.text for r in got) == ["", "", "", "", LONG] and len(got) == 5
    assert html_text.extract(frame.limit(0)).count() == 0


ARTICLE = "<article><h1>Snow</h1><p>The mayor spoke for some minutes and then left the hall.</p><p>End.</p></article>"


@pytest.mark.parametrize("name", ["content with-sidebar", "has-nav", "no-comments", "social-science"])
def test_names_that_only_go_with_other_things(name):
    tree = html_text.Tree(*html_text.labelled())
    want = html_text.main_text(ARTICLE, tree)
    assert want.startswith("Snow\nThe mayor") and html_text.main_text(f"<div class='{name}'>{ARTICLE}</div>", tree) == want
    assert html_text.main_text(f"<div class='social-links'>{ARTICLE}</div>", tree) != want


@pytest.mark.parametrize(
    "page",
    ["<svg/>%s", "<button>%s", "<noscript>%s", "<svg><svg></svg>icon</svg>%s", "<button>%s<button>b</button>", "<canvas>x</canvas>%s"]
    + ["<script>a = '<button>'</script>%s", "<!-- <svg> -->%s<svg>x</svg>", "%s<script>never closed", "<object>%s<object>b</object>"],
)
def test_embedded_elements_take_nothing_with_them(page):
    tree = html_text.Tree(*html_text.labelled())
    assert html_text.main_text(page % ARTICLE, tree) == html_text.main_text(ARTICLE, tree)


def test_all_pages_of_the_smallest_table(spark):
    """The given pages have one article element each; this reads it by another way."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    kept = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        blocks = [html.unescape(re.sub("<[^>]*>", "", part.replace("<br>", " "))) for part in re.split("</?(?:p|h1)>", inner)]
        assert kept[row.page_id] == "\n".join(" ".join(b.split()) for b in blocks if b.split())


# Benchmark decontamination

ITEM = "Anna buys 12 kg of apples for 30 euros at the old market and gives Anna half of them to her neighbours"
OTHER = "Peter buys 7 kg of apples for 55 euros at the old market and gives Peter half of them to her neighbours"
MIXED = "Peter buys 7 kg of apples for 55 euros at the old market and gives Maria half of them to her neighbours"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, benchmark):
    return {(r.doc_id, r.item_id): r.kind for r in templates.contaminations(docs, benchmark).collect()}


def test_copies_and_new_values(spark, docs_of):
    start = "In the morning "
    bench = items(spark, [(1, "He says that " + ITEM), (2, prose(77, 40))])
    docs = docs_of(
        [
            (1, prose(1, 50) + " He says that " + ITEM + " " + prose(2, 50)),
            (2, prose(3, 20) + " He says that " + OTHER + "."),
            (3, prose(4, 200)),
            (4, start + prose(77, 40).upper().replace(" ", "!! ")),
            (5, None),
            (6, ""),
        ]
    )
    assert found(docs, bench) == {(1, 1): "copy", (2, 1): "reparameterised", (4, 2): "copy"}


def test_slots_must_be_consistent(spark, docs_of):
    bench = items(spark, [(1, "He says that " + ITEM)])
    assert found(docs_of([(1, "He says that " + OTHER)]), bench) and not found(docs_of([(1, "He says that " + MIXED)]), bench)


def test_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    bench = [(k, prose(900 + k, rng.randint(5, 60))) for k in range(30)]
    docs = []
    for k in range(120):
        body = prose(k, 80).split()
        if k % 3 == 0:
            at = rng.randint(0, 80)
            body[at:at] = bench[k // 4][1].split()
        docs.append((k, " ".join(body)))
    want = set()
    for i, t in docs:
        w = t.split()
        for j, b in bench:
            v = b.split()
            n = min(templates.WINDOW, len(v))
            grams = {tuple(w[x : x + n]) for x in range(len(w) - n + 1)}
            hits = sum(tuple(v[x : x + n]) in grams for x in range(len(v) - n + 1))
            if len(v) >= templates.LEAST_WORDS and (hits >= 0.5 * (len(v) - n + 1) or hits >= templates.ENOUGH_WINDOWS):
                want.add((i, j))
    assert set(found(docs_of(docs), items(spark, bench))) == want and len(want) >= 40


def test_short_items_and_poor_templates_match_as_copies_alone(spark, docs_of):
    bench = items(
        spark,
        [(1, "one two three four"), (2, "1 2 3 4 5 6 7 8 9 10"), (3, None), (4, "two words"), (None, "a plain item without an id here")],
    )
    docs = docs_of(
        [
            (1, "one two three four"),
            (2, "1 2 3 4 5 6 7 8 9 10"),
            (3, "see a plain item without an id here now"),
            (4, "11 12 13 14 15 16 17 18 19 20"),
            (5, "two words"),
            (6, "one two three five"),
        ]
    )
    assert found(docs, bench) == {(1, 1): "copy", (2, 2): "copy", (3, None): "copy"}


def test_copies_whatever_their_words(spark, docs_of):
    rich = "On 12.03.1998 Anna Berg, Paul Stone and Mary Hill paid 1,250 kg, 17 km and 300 EUR to Bob Lake in Rome"
    seven = "Which river runs through Paris and Rouen?"
    eleven = "In what year did Marie Curie and Pierre Curie meet first?"
    bench = items(spark, [(1, rich), (2, seven), (3, eleven)])
    docs = docs_of(
        [
            (1, f"{prose(11, 20)} {rich} {prose(12, 20)}"),
            (2, f"{prose(13, 20)}\n{seven}\n{prose(14, 20)}"),
            (3, f"{prose(15, 20)} and {eleven.lower()} {prose(16, 20)}"),
            (4, prose(17, 80)),
            (5, "Which river runs through London and Oxford?"),
        ]
    )
    got = found(docs, bench)
    assert {k: v for k, v in got.items() if k[0] < 4} == {(1, 1): "copy", (2, 2): "copy", (3, 3): "copy"}
    assert not any(k[0] == 4 for k in got)
    assert got.get((5, 2), "reparameterised") == "reparameterised"


def test_words_are_cut_as_python_cuts_them():
    text = " a\x1cb\u2003c  12kg\n\u00a0d\u0085e 5m "
    words = templates.Words()
    got = words.template([text, "", "  ", "7kg x"])
    assert [words.bare[n] for n in got.numbers] == ["a", "b", "c", "12", "kg", "d", "e", "5", "m", "7", "kg", "x"]
    assert got.starts.tolist() == [0, 9, 9, 9, 12]


def test_clean_keeps_the_rest(spark, docs_of, edge_rows):
    bench = items(spark, [(1, "He says that " + ITEM)])
    rows = edge_rows + [(20, "He says that " + ITEM), (21, prose(8, 30)), (None, "He says that " + ITEM)]
    got = templates.clean(docs_of(rows).withColumn("hash", F.lit(1)), bench)
    assert got.count() == len(edge_rows) + 1 and "hash" in got.columns
    assert templates.clean(docs_of([]), bench).count() == 0
    assert templates.clean(docs_of(rows), items(spark, [])).count() == len(rows)


def test_one_contradiction_does_not_hide_a_copy(spark, docs_of):
    """Sixty words are copied; one later mention of a repeated number is changed, so the alignment contradicts itself."""
    plain = prose(901, 50).split()
    item = plain[:5] + ["17"] + plain[5:44] + ["17"] + plain[44:]
    copy = list(item)
    copy[45] = "18"
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = templates.contaminations(docs_of([(1, " ".join(copy)), (2, prose(902, 60))]), benchmark).collect()
    assert [(r.doc_id, r.item_id, r.kind) for r in got] == [(1, 1, "copy")]
