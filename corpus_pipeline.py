"""From raw documents to tokens: the stages of the training-data pipeline.

Each stage takes (spark, docs, folder of tables) and returns the documents it keeps,
with all their columns; the last one returns their pieces. `run` writes every stage as
Parquet into the shared folder and reads it again, which cuts the lineage: a lost
executor costs one stage at most. No stage depends on the names of further columns, and
each passes an empty table on as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import langid, pieces, secret_ledger
from tidemart.llm.decontaminate import clean_documents
from tidemart.llm.neardup import drop_near_duplicates
from tidemart.llm.rows import packed, unpacked
from tidemart.session import bounded_batches, work_dir
from tidemart.sources.tables import read_table

# A document whose language is less certain than this goes.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without letters, and those whose language is uncertain, go."""
    bounded_batches(spark)
    found = langid.predict(packed(docs), langid.train(docs))
    sure = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return unpacked(sure, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies (five words, 80 %) the document with the least id stays."""
    bounded_batches(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return clean_documents(docs, read_table(spark, folder, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secret_ledger.redact(docs, work_dir(spark, "secret-ledger"))


def encode_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_pieces, pieces) of every document."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = pieces.encode(rows, pieces.load())
    return found.select("doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Languages are decided by trained weights and pieces by a vocabulary file, which SQL
# cannot express; tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    root = work_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
