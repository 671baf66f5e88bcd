"""From raw documents to byte-balanced shards of training text, in five written stages.

Quality first drops junk, so that later stages do not compare it; near duplicates leave one document
of each group; documents that hold a benchmark item go; mixing drops documents until toxic
text has at most its target share (clean ones may repeat to keep their tokens); sharding deals the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm.common import DOC_COLS, pick, table
from salescast.llm.decontamination import without_contaminated
from salescast.llm.mixing import mixed_documents
from salescast.llm.ngram_join import one_of_each_group
from salescast.llm.quality import scorer, train
from salescast.llm.sharding import shard
from salescast.session import scratch_path

#: Target shares of tokens; the clean domain keeps what it has. Low quality has no target: its stage has rejected it.
TARGETS = {"clean": 0.95, "toxic": 0.05}

#: The quality model, the 64-bit shingle sets and the fitted rates are beyond SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.5 or more."""
    score = scorer(train(docs, table(spark, sf_dir, "labels")))
    return pick(docs, *DOC_COLS).where(score("text") >= F.lit(0.5))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that give domains their target shares; a rate over 1 may repeat a document."""
    return mixed_documents(docs, table(spark, sf_dir, "labels"), TARGETS, "clean", thin=True)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document."""
    return shard(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
