"""The registered corpus queries: opN_<name> -> builder (spark, sf_dir), and oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, html_text, linededup, merkle, mixing, neardup_vectors, packing, quality, simhash, topk, toxicity, urls
from .common import held_out, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex16("fp").alias("fingerprint"), "component_id")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "n_lines", "n_dropped")


ORACLE["op1_line_dedup"] = linededup.line_dedup_sql()


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.toxicity_fit(docs, labels).toArrow()
    scored = toxicity.toxicity_scores(docs.select("doc_id", "text"), weights)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text",
                        F.length("text").cast("long").alias("n_chars"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.quality_scores(docs.select("doc_id", "text", "n_chars"), quality.quality_fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


ORACLE["op6_topk"] = topk.top_products_sql()


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.filter_urls(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score")


@query
def op8_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup_vectors.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.text", "row.lang", "row.source", "row.n_chars", "copy", "shuffle_key")


ORACLE["op9_mixing"] = mixing.mixing_sql()


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = byte_bpe.shared_table(docs, public_tokenizers.path(byte_bpe.VOCABULARY))
    coded = byte_bpe.encode_texts(docs, tokens, public_tokenizers.PATTERN).select("doc_id", "ids")
    both = byte_bpe.decode_ids(coded, tokens)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


ORACLE["op12_merkle_manifest"] = merkle.manifest_sql()


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


ORACLE["op13_centroids"] = centroids.clusters_sql()
