"""A corpus pipeline: filter by quality, drop repeated lines and near copies, mix, and encode.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet in
the shared scratch folder and read back as the next stage's ``docs``. All stages but the last return
the columns of ``documents``.

* quality classifier: texts below a probability of 0.3 of being good go.
* line dedup: repeated passages of three or more lines stay at their first occurrence; a text of
  which nothing is left goes.
* near duplicates: of the documents that are linked, the one with the smallest id stays.
* mixing: the documents as often, and as far, as the mix takes them. A document that is taken
  again is another row with the same id.
* encoding: number of ids and hashes of the ids and of the decoded text of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.llm import bpe, compression_classifier, line_dedup, mixing, ngram_join
from postlark.llm.queries import byte_bpe, documents, labels
from postlark.session import discard, stored

QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = compression_classifier.fit(docs, labels(spark, sf_dir))
    scored = compression_classifier.score(docs, model, name="_quality")
    return scored.where(F.col("_quality") >= QUALITY_THRESHOLD).drop("_quality")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, byte_bpe())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mix),
    ("encoding", encode),
]

# The scores of a trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    before = []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
