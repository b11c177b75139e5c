"""From raw documents to token ids, in five stages of the llm subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs:

1. toxicity: documents scored 0.5 or more go;
2. near duplicates: of each component of the n-gram Jaccard join the document
   of smallest id stays;
3. decontamination: documents with a twentieth or more of their words in
   benchmark windows go;
4. personal data is masked in place;
5. SentencePiece ids, with the text that they decode to checked.

All but the last return the columns of ``documents``. SQL cannot express the
trained stages, so ORACLE_SQL is None; tests hold the run against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, jaccard_join, pii, sentence_pieces, toxicity
from tessera.llm.base import give_back, stage, table

PIECES = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.filter_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("sentencepiece", to_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        give_back()  # what the driver's Python freed of a stage (a trained model's steps) is not held through the next
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
