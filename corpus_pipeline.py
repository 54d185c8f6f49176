"""From raw documents to packed sequences: five stages, each by one operator of ``weir.llm``.

Each stage takes all documents its predecessor kept and returns them with the columns of ``documents``; the last returns
the pieces of packed sequences. ``run`` writes each stage's documents to the shared folder and reads them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import tune, work_folder
from weir.llm import dart_minhash, mixing, packing, pii, toxicity
from weir.llm.queries import TOXIC_FROM, table, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose whole text scores below the threshold; the model learns from the labelled ones among them."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.column() < TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near copies."""
    return dart_minhash.keep_first(docs, dart_minhash.near_duplicates(docs))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def interleave(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the target mixture; the files hold that order, and packing reads it from them."""
    return mixing.in_mixed_order(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and the sequences they are packed into, in the order of the documents' rows."""
    return packing.pack(mixing.row_place(docs, "place"), tokenizer_path(), place=F.col("place"))


STAGES = [("toxicity", drop_toxic), ("near-duplicates", drop_near_copies), ("pii", redact_personal),
          ("mixing", interleave), ("packing", pack_sequences)]

# Learned scores, sketches and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = work_folder(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
