"""From raw documents to token ids: language, quality, near duplicates, test passages, encoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of
documents. A stage sees what its predecessor kept, nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import language_id, quality
from tidewell.llm.decontamination import decontaminate
from tidewell.llm.jaccard_join import one_of_each
from tidewell.llm.queries import remainder, table, tokenizer_path
from tidewell.llm.sentencepiece_codec import encoded
from tidewell.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters and a language. The trees are fitted on the stage's own input."""
    return language_id.in_some_language(docs, language_id.fit(docs, F.col("lang")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as label 1, by labels of the training fold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return quality.good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items, which are cut out; what then has no word goes."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its SentencePiece ids."""
    return encoded(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

#: Trained models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
