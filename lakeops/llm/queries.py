"""One query for each operator, over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import bpe, clustering, html_text, lm, packing, quality, secret_scan, shards, simhash, templates, topk, toxicity, whitening
from lakeops.llm.common import fold, table, whole_text
from lakeops.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_block_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs, WORD_BPE)
    decimal = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = fold("doc_id", 2, 4)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    scored = quality.score(docs, model)
    accepted = (F.col("score") >= quality.ACCEPT).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", accepted.alias("predicted"))


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return done.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "kind", "windows", "n_windows")


@query
def op6_gated_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 2, 7)
    scored = lm.score(table(spark, sf_dir, "documents"), learn_from=~held_out)
    wanted = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", held_out.alias("held_out"), *wanted)


@query
def op7_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = whole_text("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(data).cast("long") + 8).alias("size"), F.crc32(data).alias("text_crc32")
    )
    done = shards.shuffle_into_shards(docs, shards=24, seed=2)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return done.select("doc_id", "size", "text_crc32", law, F.col("shard").cast("int").alias("shard"), "slot", grown)


@query
def op8_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    kinds = F.transform("secrets", lambda s: s["kind"])
    of_kind = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{secret_scan.KINDS[k]}") for k in range(3)]
    digest = F.sha2(secret_scan.spelled(base).cast("binary"), 256)
    return found.select("doc_id", *of_kind, digest.alias("base_sha256"), secret_scan.spelled(F.col("secrets")).alias("spans"))


@query
def op9_token_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    packing.write_token_files(docs, path, packing.library_encoder(BYTE_BPE), vocabulary=50_257, end_id=2)
    return packing.read_token_files(spark, path, with_ids=False)


@query
def op10_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    sound = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    vectors = table(spark, sf_dir, "embeddings").where(sound).select(F.col("vec_id").alias("id"), whole.alias("vector"))
    return topk.top_k(vectors, F.col("id") % 50 == 0, k=5)


ORACLES["op10_pivot_top_k"] = """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vector FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
    SELECT q.rid AS query, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.vector, c.vector) AS BIGINT) AS score
    FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0
), numbered AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM ranked
)
SELECT query_id, rank, vec_id, score FROM numbered WHERE rank <= 5
"""


@query
def op11_polarisation_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    wanted = ["whitened", "explained", "identity_error"]
    return white.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), *wanted)


@query
def op12_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 0, 5)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    toxic = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.score(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", toxic.alias("predicted"), "n_hits", "n_words")


@query
def op13_bisector_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = clustering.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=16, rounds=3, size=64)
    spelled = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    whole = [F.col(c).try_cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")]
    return done.select("vec_id", "cluster", *whole, F.sha2(spelled.cast("binary"), 256).alias("centroid_sha256"))


def _clustering_sql(k: int = 16, rounds: int = 3) -> str:
    """The contract's rounds in SQL, distances by plain comparison with every centroid."""
    apart = "CAST(list_sum(list_transform(range(1, 65), lambda d: (v.x[d] - c.x[d]) * (v.x[d] - c.x[d]))) AS BIGINT)"
    steps = [
        """v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
)""",
        f"""c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS INTEGER) AS cluster, x
    FROM v ORDER BY cluster LIMIT {k}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
    SELECT rid, min(struct_pack(distance := distance, cluster := cluster)) AS best
    FROM (SELECT v.rid, c.cluster, {apart} AS distance FROM v, c{n} c) GROUP BY rid
)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT o.cluster, coalesce(m.x, o.x) AS x FROM c{n} o LEFT JOIN (
        SELECT cluster, list(mean ORDER BY d) AS x FROM (
            SELECT cluster, d, CAST((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
            FROM (SELECT a.best.cluster AS cluster, unnest(range(1, 65)) AS d, unnest(v.x) AS e FROM a{n} a JOIN v USING (rid)) GROUP BY cluster, d
        ) GROUP BY cluster
    ) m USING (cluster)
)""")
    return f"""WITH {", ".join(steps)}
SELECT v.vec_id, a.best.cluster AS cluster, a.best.distance AS distance,
       CAST(sum(a.best.distance) OVER (PARTITION BY a.best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (rid) JOIN c{rounds} c ON c.cluster = a.best.cluster
"""


ORACLES["op13_bisector_tournament"] = _clustering_sql()
