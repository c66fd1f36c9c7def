"""The registered query of each operator, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table in fewer parts than there are cores (one small file) is dealt out; larger ones stay where they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.quality import quality_rules

    return quality_rules(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {"op2_quality_rules": op2_quality_rules}

ORACLE_SQL: dict[str, str] = {}


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.simhash import hexed, near_duplicates

    return near_duplicates(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", hexed("fp").alias("fingerprint"), "component_id")


QUERIES["op6_simhash_near_dedup"] = op6_simhash_near_dedup


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.toxicity import score, train

    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES["op4_toxicity"] = op4_toxicity


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers lie; any other path will do."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.tokens import load_vocabulary, token_counts

    return token_counts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), load_vocabulary(tokenizer_path("piece_bpe_32k.model")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.bpe import encode_decode

    return encode_decode(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), tokenizer_path("word_bpe_49k.json"))


QUERIES["op1_token_counts"] = op1_token_counts
QUERIES["op10_bpe"] = op10_bpe


#: action, host, path
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.urlrules import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from gridloom.llm.sharding import shard_by_bytes

    dealt = shard_by_bytes(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.packing import pack, with_lengths

    return pack(with_lengths(table(spark, sf_dir, "documents")))


QUERIES |= {"op3_url_filters": op3_url_filters, "op8_sharding": op8_sharding, "op9_packing": op9_packing}
ORACLE_SQL["op3_url_filters"] = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM cut),
urls AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(tail, '^[^?#]*') AS path FROM parts),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
         FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM urls u LEFT JOIN fits f USING (page_id)
"""


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.winnow import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES["op5_document_fingerprints"] = op5_document_fingerprints


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.substrings import repeat_report

    return repeat_report(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES["op7_substring_dedup"] = op7_substring_dedup


def _more_sql() -> None:
    from gridloom.llm import oracles

    ORACLE_SQL["op2_quality_rules"] = oracles.quality_sql()
    ORACLE_SQL["op5_document_fingerprints"] = oracles.winnow_sql()
    ORACLE_SQL["op6_simhash_near_dedup"] = oracles.simhash_sql()
    ORACLE_SQL["op7_substring_dedup"] = oracles.SUBSTRINGS
    ORACLE_SQL["op8_sharding"] = oracles.sharding_sql()
    ORACLE_SQL["op9_packing"] = oracles.packing_sql()


_more_sql()
