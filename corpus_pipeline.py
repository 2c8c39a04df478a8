"""The document pipeline: five stages over `documents`, each on what the one before kept.

Every stage is (name, function) with function(spark, docs, sf_dir) -> DataFrame;
`run` writes each result as Parquet in the shared folder and reads it as the next
one's docs. All but the last return the columns of documents. An empty table stays
empty through every stage; other columns than those of documents are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm import common, mixture, ngram_join, pieces, quality, secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps; null and empty texts go, repeated rows get one verdict and null ids are judged alike."""
    verdicts = quality.assess(docs, keep=COLUMNS)
    return verdicts.filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of five-word shingle sets alike by 0.8 or more; those without words or with a null id all stay, and so do all rows of an id that stays."""
    classes = ngram_join.join_components(docs, width=5, percent=80)
    keys = classes.filter("doc_id is null or doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(keys, docs["doc_id"].eqNullSafe(F.col("kept_id")), "left_semi").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret; null texts stay null, and n_chars follows the text."""
    found = secrets.scan(docs, keep=COLUMNS)
    text = F.when(F.size("spans") > 0, F.expr(secrets.redacted())).otherwise(F.col("text")).alias("text")
    clean = found.select(*[text if c == "text" else F.col(c) for c in COLUMNS])
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say; null and empty texts have no tokens and the rate of the prior, null ids share one draw."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.expr(mixture.DOMAIN).alias("domain"))
    mixed = mixture.mix(docs, labels, mixture.TARGETS, keep=COLUMNS)
    return mixture.repeated(mixed).select(*COLUMNS)


def piece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of what is left, as counts and digests; a null text has none, a repeated row gives its result again."""
    return pieces.encode_decode(docs, common.vocabulary("piece_bpe_32k.model"), digest=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", piece_codec),
]

#: SQL can't express the join's components, the classifier and the codec; tests hold the stages and the whole run against slow versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
