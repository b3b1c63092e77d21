"""The corpus pipeline: stages over `documents`, each written and read again.

1. language ID: texts without a language go (no letters, or nothing like any profile).
2. near duplicates: of each group of documents with similar shingle sets one stays.
3. decontamination: passages of the benchmark are cut out of the texts.
4. secrets: found secrets are replaced by a mark.
5. packing: what is left is cut into token pieces and packed into sequences.

Stages that filter or clean return the columns they were given. Where the table has n_chars,
it is set anew for texts that change. Each stage learns from its own input only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontaminate, jaccard, language, packing, secrets
from tallyloom.llm.common import shared_folder
from tallyloom.llm.queries import vocabulary


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_recognised(docs, language.learned(docs))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs, secrets.ratios(secrets.labelled(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary())


STAGES = [("language ID", recognised), ("near duplicates", distinct),
          ("decontamination", decontaminated), ("secrets", redacted), ("packing", packed)]

#: The stages run models and indexes that SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = f"{shared_folder(spark, 'pipeline')}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
