"""Corpus pipeline: toxic, duplicate and leaked documents go, secrets are masked, the rest is packed.

Each stage is a function (spark, docs, sf_dir) of the documents its predecessor
kept. All but the last return the columns of documents; a stage's result is
written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.llm import credentials, decontam, packing, simhash, toxicity
from costloom.llm.common import kept, prepare, table

# Models and hashes are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among ``docs``, does not call toxic."""
    prepare(spark)
    model = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model, score="__toxic").filter("__toxic < 0.5").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return simhash.deduplicated(docs, shingle=4, distance=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    prepare(spark)
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark and n_chars counted anew."""
    prepare(spark)
    masked = credentials.find_secrets(docs, spans="__spans", clean="__clean")
    changed = F.size("__spans") > 0
    new = {"text": F.col("__clean"), "n_chars": F.when(changed, F.length("__clean").cast("long")).otherwise(F.col("n_chars"))}
    return masked.withColumns(new).select(*docs.columns)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into sequences of the permitted lengths."""
    prepare(spark)
    return packing.packed(docs, packing.n_tokens())


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", into_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = kept(docs, f"stage-{name}")
    return docs
