"""The corpus pipeline: toxicity, quality rules, near-duplicates, repeated passages, packing.

Each stage takes what the one before kept, with all columns of documents; the last returns batches with their text. `run`
writes each stage's result to the shared folder and reads it back, so a lost executor costs one stage's tasks at most.

Defined results, for every stage. Null and empty texts: toxicity leaves them, the quality rules drop them (under 50 words).
Rows without doc_id or lang, repeated rows, ties and very long texts: as each operator's docstring says. Empty table: empty
result. The stages return the columns of documents; a column more passes through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import materialize

#: The tokenizer whose pieces the last stage counts; any sentencepiece model's path will do.
PIECES = "piece_bpe_32k.model"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose calibrated score reaches the threshold; trained on the labels of rows of docs."""
    from gridloom.llm.toxicity import drop_toxic, train

    return drop_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject."""
    from gridloom.llm.quality import keep_good

    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates."""
    from gridloom.llm.simhash import keep_first

    return keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 20 words and more that stand earlier in the corpus; drops documents of which nothing is left."""
    from gridloom.llm.substrings import remove_repeats

    left = remove_repeats(docs).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of at most 65,536 tokens inside optimal length buckets: doc_id, text, its tokens plus an end mark as length,
    and bucket, width, batch, slot and padding. Null and empty texts: length 1."""
    from gridloom.llm.packing import pack
    from gridloom.llm.queries import tokenizer_path
    from gridloom.llm.tokens import load_vocabulary, token_counts

    counted = token_counts(docs, load_vocabulary(tokenizer_path(PIECES)), keep=("text",))
    return pack(counted.withColumn("n_tokens", F.col("n_tokens") + 1), "n_tokens", keep=("text",))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("packing", packing),
]

#: The first stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
