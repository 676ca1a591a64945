"""Corpus pipeline: quality filter, near-dedup, decontamination, source mixing, token output.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes
each stage's result as Parquet into the shared checkpoint folder and reads it
back as the next one's input; a stage's own tables, and its input, are removed
once its result is written.

Nulls, empty and very long texts, ties, repeated rows, empty tables and
columns with clashing names are settled by the operators; their docstrings
state how.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrarank.llm.common import materialize, scratch, table
from terrarank.llm.decontaminate import drop_contaminated
from terrarank.llm.mixing import mix
from terrarank.llm.quality import keep_good
from terrarank.llm.queries import token_digests
from terrarank.llm.simhash import keep_one_per_component
from terrarank.sources.sinks import remove_dataset


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of ``docs``, does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return keep_one_per_component(docs, width=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards written and read back: (doc_id, start, n_tokens, ids_crc32)."""
    return token_digests(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: A fitted classifier, a similarity join and a tokenizer have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", result=True)
        if before is not None:
            remove_dataset(spark, before)
        before = docs.written_to
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
