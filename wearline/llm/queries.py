"""One registered query per operator: production parameters, whole tables, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import alignment, decontamination, hard_negatives, line_dedup, near_dedup, packing, pii, quality, suffix_dedup, token_counts, token_files, vptree, warc
from wearline.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_near_dedup")
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "keeper")


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", token_counts.derived_edits())
    trees = token_counts.build(docs).withColumnRenamed("tokens", "tokens_before").withColumn("tokens", F.col("tokens_before"))
    edited = token_counts.apply_edits(trees)
    return edited.select("doc_id", "tokens_before", F.col("tokens").alias("tokens_after"), F.md5("text").alias("text_md5"), "encoded_again")


@query("op3_warc_round_trip")
def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    got = warc.read_archives(spark, folder, verify="true").where(F.col("record_type").isin("response", "revisit"))
    return got.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        # A revisit has no payload of its own; the HTTP header keeps the full length.
        F.coalesce(F.length("payload").cast("long"), F.col("http_length")).alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


@query("op4_bm25_packing")
def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op5_quality_crf")
def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "held_out", "score", "predicted")


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op7_line_dedup", line_dedup.ORACLE_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("kept", F.lit(""))).alias("kept_md5"))


@query("op8_vantage_point_search")
def op8_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query("op9_benchmark_decontamination")
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.benchmark_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "end", "equal")


@query("op10_pii_sanitisation")
def op10_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.KINDS),
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "n_terms",
    )


@query("op11_token_ids")
def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-ids")
    token_files.write_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), folder, "byte_bpe_50k.json", end_id=0)
    return token_files.read_documents(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op12_hard_negatives", hard_negatives.ORACLE_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), "vec_id % 100 = 0", label)


@query("op13_cross_tokenizer_alignment")
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), "byte_bpe_50k.json", "piece_bpe_32k.model")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
