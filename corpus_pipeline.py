"""Documents to training sequences: toxic texts out, one of each group of near copies, benchmark
passages out, packed. Each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirefold.llm import decontaminate, packing, setjoin, toxicity
from quirefold.llm.tables import stored, table
from quirefold.llm.tokens import byte_bpe


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is fitted on the labelled documents of the source tables."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setjoin.one_of_each(docs).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, byte_bpe(), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL has no tokenizer and no model; tests/llm/test_pipeline.py holds the result against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
