"""A training corpus from the table ``documents``, stage by stage.

Every stage reads what the one before it wrote as Parquet in the shared folder. All but the last return
the columns of ``documents``; the last one returns the token count of every text that is left, and hashes
of its ids and of the text they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import aligned_lines, bayes_jaccard, byte_bpe, ordinal_toxicity, spaced_seeds
from forecourt.llm.common import prepared, table, written


# Rows of a batch that tasks hand to Python. Texts are large, and executors keep the batches of several stages.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> None:
    """The session as the operators need it, with small batches."""
    prepared(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that an ordinal model of the labelled ones grades above 0."""
    ready(spark)
    model = ordinal_toxicity.learn_from_tables(docs, table(spark, sf_dir, "labels"), "toxic")
    return ordinal_toxicity.accepted(docs, model)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete passages of fifty words or more that an earlier document has, and documents that are nothing else."""
    ready(spark)
    return aligned_lines.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    ready(spark)
    return bayes_jaccard.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with an item of the benchmark."""
    ready(spark)
    return spaced_seeds.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the ids and of the text they decode to."""
    import public_tokenizers

    ready(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeats),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

# Learned weights, alignments and byte-pair merges have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
