"""A training-data pipeline of the text operators; each stage's result is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bisque.llm import common, op01_pii, op03_mixing, op04_sentencepiece, op09_quality, op10_jaccard

#: Stages of Python workers write their results themselves, in small Arrow batches whatever the session holds when they are read.
STAGES = [
    ("quality", common.written(op09_quality.stage)),
    ("near_copies", op10_jaccard.stage),
    ("pii", common.written(op01_pii.stage)),
    ("mixing", op03_mixing.stage),
    ("sentencepiece", common.written(op04_sentencepiece.stage)),
]
WRITTEN = ("quality", "pii", "sentencepiece")

#: Near copies, pseudonyms, rounding and piece ids cannot be written in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES one after the other over the documents, each through Parquet in the shared folder.

    Defined results: an empty table gives an empty result; null and empty texts fail the quality rules; a null id, repeated ids and repeated rows
    are treated as each stage's docstring says; other columns of documents are carried through the stages.
    """
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name in WRITTEN else common.stored(docs)
    return docs
