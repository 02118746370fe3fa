"""Registered queries of the operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, concat_packing, exact_dedup, fim, langid, merkle, mixing, packing, sharding, simhash, topk_search, url_rules, warc

#: Shipped with the Python environment of every worker, like the tokenizer library.
TOKENIZER_FILE = "byte_bpe_50k.json"
WORD_TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_branch_and_bound_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors.filter(topk_search.is_query(F.col("vec_id"))), vectors)


def op3_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_pages(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The rules of the url filter: action, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op4_rarest_token_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op5_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_rows(table(spark, sf_dir, "documents")).withColumns({
        "size": (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"),
        "text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
        "law": F.lit("rows"),
        "grown_shard": F.lit(None).cast("int"),
    })
    return sharded.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ","))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = concat_packing.concat_and_cut(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER_FILE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", merkle.UPPER, merkle.UPPER.lower())
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        "doc_id", "lang", merkle.leaf_hash(*merkle.FIELDS).alias("leaf"),
        F.when(hit, merkle.leaf_hash(*[lower if f == "text" else f for f in merkle.FIELDS])).alias("tampered"),
    )
    proofs = merkle.prove(leaves).withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf")))
    proofs = proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
    return proofs.select("doc_id", "leaf", "subroot", "root", merkle.path_hash().alias("proof_sha256"), "folded_root", "verified")


def op13_boundary_set_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fim.restored()).alias("restored_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_branch_and_bound_topk": op2_branch_and_bound_topk,
    "op3_warc_dictionary": op3_warc_dictionary,
    "op4_rarest_token_rules": op4_rarest_token_rules,
    "op5_hypergeometric_shards": op5_hypergeometric_shards,
    "op6_poisson_mix": op6_poisson_mix,
    "op7_perspective_rotation": op7_perspective_rotation,
    "op8_language_id": op8_language_id,
    "op9_simhash_anchors": op9_simhash_anchors,
    "op10_block_naming_dedup": op10_block_naming_dedup,
    "op11_concatenate_and_cut": op11_concatenate_and_cut,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_boundary_set_fim": op13_boundary_set_fim,
}

_RULE_ROWS = ", ".join(str(r) for r in RULES)

#: The same results in DuckDB's SQL, where it can express them.
ORACLE: dict[str, str] = {
    "op2_branch_and_bound_topk": """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op3_warc_dictionary": """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN first <> page_id THEN first END AS refers_to FROM f
    """,
    "op4_rarest_token_rules": f"""
    WITH r(action, host, path) AS (VALUES {_RULE_ROWS}),
    u AS (SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '') AS h,
            coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
    l AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
    b AS (SELECT l.page_id, max({{'n': length(r.host || r.path), 'rule': r.host || r.path, 'action': r.action}}) AS best
          FROM l JOIN r ON (l.host = r.host OR ends_with(l.host, '.' || r.host)) AND starts_with(l.path, r.path) GROUP BY l.page_id)
    SELECT l.page_id, l.host, l.path, b.best.rule AS rule, coalesce(b.best.action, 'allow') AS verdict FROM l LEFT JOIN b USING (page_id)
    """,
    "op6_poisson_mix": mixing.oracle(),
    "op7_perspective_rotation": chat.oracle(),
    "op10_block_naming_dedup": r"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
    "op12_merkle_manifest": merkle.oracle(),
    "op13_boundary_set_fim": fim.oracle(),
}
