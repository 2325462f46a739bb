"""Documents to a training mix, in five stages.

Each stage gets the documents that its predecessor left, as a table, and returns the documents that it leaves; the last adds
each document's place in the mix. Between stages the documents are written to the shared scratch folder and read again,
so a lost executor costs the current stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import table
from sensorloom.llm.decontaminate import decontaminated
from sensorloom.llm.mixing import mixed, target_weight
from sensorloom.llm.near_dedup import deduplicated
from sensorloom.llm.suffixes import without_repeats
from sensorloom.llm.toxicity import learn, toxicity
from sensorloom.session import written

#: Documents at or above this score are rejected.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below TOXIC; the lexicon is learnt from the labels of these documents."""
    lexicon = learn(docs, table(spark, sf_dir, "labels"), cut=TOXIC)
    # a column of the table may be called score
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    return toxicity(marked, lexicon, ["row"]).filter(F.col("score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8 or more): that with the least id."""
    return deduplicated(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that a document of smaller id has too; n_chars follows."""
    return without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no item of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix of the sources by their target weights."""
    return mixed(docs, target_weight)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Learnt weights, signatures and suffix order are not SQL: tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
