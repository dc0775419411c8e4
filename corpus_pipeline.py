"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of `docs`; n_chars follows the text. Rows with clashing extra columns pass through;
null and empty texts are handled as each operator defines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import decontamination, line_dedup, near_dedup, packing, quality
from wearline.session import stage


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__hash", F.xxhash64("text"))


def _same_document(docs: DataFrame, found: DataFrame):
    return docs["doc_id"].eqNullSafe(found["__doc_id"]) & (docs["__hash"] == found["__found_hash"])


def _named(found: DataFrame) -> DataFrame:
    return found.select(F.col("doc_id").alias("__doc_id"), F.col("__hash").alias("__found_hash")).distinct()


def _bundled(docs: DataFrame) -> DataFrame:
    """doc_id, text and the other columns as one struct, so that no name clashes with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0)]).alias("__row"))


def _unbundled(docs: DataFrame, new: dict[str, Column] | None = None) -> list[Column]:
    """The columns of `docs` from the bundle, with `new` ones in place."""
    new = {"doc_id": F.col("doc_id"), "text": F.col("text")} | (new or {})
    return [new[c].alias(c) if c in new else F.col(f"__row.`{c}`") for c in docs.columns]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds good."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(_bundled(docs), model).where("predicted = 1").select(*_unbundled(docs))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated three-line windows; those left blank go."""
    found = line_dedup.remove_repeated_windows(_bundled(docs)).where("n_removed = 0 or trim(kept) <> ''")
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(kind)).otherwise(F.col("__row.n_chars"))
    return found.select(*_unbundled(docs, new))


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    keepers = _named(near_dedup.near_duplicates(docs.select("doc_id", "text")).where("keeper"))
    hashed = _hashed(docs)
    kept = hashed.join(keepers, _same_document(hashed, keepers), "left_semi")
    return kept.dropDuplicates(["doc_id", "__hash"]).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = _named(decontamination.benchmark_overlaps(docs.select("doc_id", "text"), benchmark))
    hashed = _hashed(docs)
    return hashed.join(leaks, _same_document(hashed, leaks), "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = packing.pack(docs.select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("line_dedup", cut_repeated_lines),
    ("minhash_near_dedup", keep_one_near_duplicate),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bm25_packing", pack_sequences),
]

# A trained classifier, consistent sampling and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
