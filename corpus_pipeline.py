"""A cleaning pipeline over ``documents``: each stage is written as Parquet and read by the next.

No single SQL statement can express it, since its classifier is learned from data.

Every stage takes and returns whole rows: columns beside the five named ones are carried along, whatever
their names, and only the last stage adds its own. Texts are read whole, of any length. An empty table
passes every stage as an empty table of the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postmill.llm import jaccard, mix, quality, shard, suffixes
from postmill.llm.common import read, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like any other, by structure alone, and mostly go. Equal texts share their
    fate whatever their ids, null ones included; each repeated row stays or goes by itself. A score at the
    threshold stays. Without usable labels all have one score, and all stay or all go.
    """
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id.

    A row without an id stays only where none of its group has one; then, and between rows of one id, a hash of
    the whole row decides. Of repeated rows one stays. Texts without words, null ones included, are in
    no group and all stay.
    """
    return jaccard.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go.

    Null and empty texts hold none and stay, as does everything if the benchmark has no words. Repeated rows
    and rows without an id are judged each by its text. There are no ties.
    """
    return suffixes.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, so that sources come near their target weights.

    A null source is one source, the last. Null and empty texts have no words, add nothing to a source and
    are left out. Repeated rows count each; the order of rows equal in all columns is of no account.
    """
    return mix.mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document gets its shard and slot of a reproducible shuffle.

    Rows are numbered by id and a hash of the whole row, null ids first; rows equal in all columns are
    interchangeable. Names of the added columns that a row has already are taken over. Null texts count as empty.
    """
    return shard.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for step, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{step}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
