"""The registered queries of this folder, one per operator: the operator over its whole table, digests derived from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorline.llm.bit_sliced import top_k
from floorline.llm.decontamination import benchmark_hits
from floorline.llm.html_main import extract_main_text
from floorline.llm.language import fit_language, predict_language
from floorline.llm.merkle import FIELDS, folded, leaf_digest, merkle_manifest, proof_digest
from floorline.llm.minhash import near_duplicates
from floorline.llm.phrases import collocations
from floorline.llm.quality import fit_quality, score_quality
from floorline.llm.quotations import reply_ordered
from floorline.llm.segmentations import sample_segmentations
from floorline.llm.substring_dedup import substring_dedup
from floorline.llm.token_files import read_token_files, write_token_files
from floorline.llm.warc import read_warc, write_warc
from floorline.streaming.workspace import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


def op2_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_quality_attention(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, folder, "labels")))


def op4_wavelet_token_files(spark: SparkSession, folder: str) -> DataFrame:
    shards = shared_folder(spark, "tokens")
    write_token_files(table(spark, folder, "documents"), shards).agg(F.sum("tokens")).collect()  # one number; it runs the writer
    return read_token_files(spark, shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_sampled_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and sample; ``text_crc32`` is that of the text decoded from the ids."""
    found = sample_segmentations(table(spark, folder, "documents"), decode=True)
    return found.select("doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                        "log_prob", "log_inclusion", F.crc32(F.col("decoded").cast("binary")).alias("text_crc32"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    named = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(named.cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = shared_folder(spark, "warc")
    write_warc(table(spark, folder, "pages"), archives).agg(F.sum("records")).collect()  # one number; it runs the writer
    return read_warc(spark, archives).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return reply_ordered(table(spark, folder, "conversations"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Where 5 divides the id's checksum, the root is folded from a leaf whose text has lost its upper case."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf_digest(*(lower if name == "text" else F.col(name) for name in FIELDS))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, changed)
    found = merkle_manifest(table(spark, folder, "documents"), keep={"tampered": tampered})
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op13_byte_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return predict_language(docs, fit_language(docs))


def registered() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_minhash_near_dedup, op2_html_main_text, op3_quality_attention,
                                    op4_wavelet_token_files, op5_sampled_segmentations, op6_decontamination, op7_warc, op8_substring_dedup,
                                    op9_bit_sliced_top_k, op10_quotation_linking, op11_collocations, op12_merkle_manifest, op13_byte_language)}
