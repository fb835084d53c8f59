"""Corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.bpe import tokenize
from inboxlens.llm.line_dedup import dedup_lines
from inboxlens.llm.mixing import mixed_documents
from inboxlens.llm.near_dedup import one_per_group
from inboxlens.llm.quality import good_documents
from inboxlens.llm.shared import new_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, n_chars counted from the text."""
    return df.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts as good."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document without lines that nearly repeat an earlier one; documents
    of which nothing is left go."""
    return _documents(dedup_lines(docs)).where(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_per_group(docs).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: a document is a row per epoch that
    takes it, the one at a source's budget cut there."""
    return _documents(mixed_documents(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it again."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = tokenize(docs.select("doc_id", "lang", "source", "text"), path, pattern, exact="exact", keep_text=False)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_copies),
          ("mixing sources", mixture), ("BPE encoding", encoding)]

# The classifier, MinHash lines and BPE have no SQL form. tests/llm/test_pipeline.py
# checks each stage row by row on its own input: the classifier against the scores
# of operator 1, the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    folder = new_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
