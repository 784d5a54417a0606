"""The registered query of each operator, with production parameters, over whole tables; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontam import contamination
from .embeddings import near_vectors
from .langid import fit_language, predict_language
from .lm import score_texts
from .oracles import ORACLES as ORACLES
from .packing import pack
from .quality import fit_quality, score_quality
from .sentencepieces import decode_texts, encode_texts
from .shared import table
from sluiceway.workspace import new_work_path
from .sharding import shard_by_bytes
from .simhash import simhash_groups
from .substrings import remove_repeats
from .variants import spelling_variants
from .warc import read_warc, write_warc
from .whitening import whiten


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return hits.select("doc_id", "n_words", "n_hit", "n_items", named, "contaminated")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_by_bytes(table(spark, sf_dir, "documents"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, fit_language(docs))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode_texts(encode_texts(table(spark, sf_dir, "documents"), model), model)
    written = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), written, F.sha2("text", 256).alias("decoded_sha256"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), slips=199)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_substrings": op4_substrings,
    "op5_sharding": op5_sharding,
    "op6_warc": op6_warc,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_embeddings": op9_embeddings,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_variants": op12_variants,
    "op13_whitening": op13_whitening,
}
