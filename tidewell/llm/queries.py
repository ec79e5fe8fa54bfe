"""The queries of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import alignment, chunk_store, language_id, media, oracles, quality
from tidewell.llm.decontamination import contamination
from tidewell.llm.html_text import extracted
from tidewell.llm.jaccard_join import near_duplicates
from tidewell.llm.licences import licence_labels
from tidewell.llm.sentencepiece_codec import encoding_report
from tidewell.llm.sharding import bounded_ring_shards
from tidewell.llm.spelling import variants
from tidewell.llm.token_counts import token_counts


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_report(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("set_class")


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.to_media(table(spark, sf_dir, "documents")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_ring_shards(table(spark, sf_dir, "documents"))


def remainder(folds: int) -> Column:
    """crc32 of doc_id as text, modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return quality.score(docs, model, held_out=remainder(5) == 0)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(remainder(4) != 2), F.col("lang"))
    return language_id.identify(docs, model, held_out=remainder(4) == 2)


def op9_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = chunk_store.write(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return chunk_store.verified(spark, store)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_labels(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_media_columns": op5_media_columns,
    "op6_sharding": op6_sharding,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_language_id": op8_language_id,
    "op9_chunk_store": op9_chunk_store,
    "op10_html_extraction": op10_html_extraction,
    "op11_alignment": op11_alignment,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_licence_scan": op13_licence_scan,
}

#: SQL for the queries that it can express.
ORACLE: dict[str, str] = {"op1_decontamination": oracles.OP1, "op4_jaccard_join": oracles.OP4}
