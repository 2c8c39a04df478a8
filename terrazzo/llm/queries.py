"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, common, main_text, mixture, neighbours, ngram_join, pieces, quality, repeats, secrets, token_store

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.count_tokens(table(spark, sf_dir, "documents"), common.vocabulary("byte_bpe_50k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf_dir, "documents"), common.vocabulary("piece_bpe_32k.model"), digest=True)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.scan(table(spark, sf_dir, "documents")))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_store.write_store(table(spark, sf_dir, "documents"), common.vocabulary("byte_bpe_50k.json"), END_ID)
    return token_store.read_store(shards)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.expr(mixture.DOMAIN).alias("domain"))
    mixed = mixture.mix(table(spark, sf_dir, "documents"), labels, mixture.TARGETS, keep=("source",))
    shares = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(mixture.TARGETS)]
    return mixed.select("doc_id", "source", "n_tokens", *shares, "rate")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_pieces": op3_pieces,
    "op4_secret_scans": op4_secret_scans,
    "op5_neighbours": op5_neighbours,
    "op6_repeats": op6_repeats,
    "op7_token_store": op7_token_store,
    "op8_ngram_join": op8_ngram_join,
    "op9_main_text": op9_main_text,
    "op10_mixture": op10_mixture,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality.assess_sql(),
    "op4_secret_scans": secrets.scan_sql(),
}
