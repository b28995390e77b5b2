"""A corpus from raw documents to packed sequences: five stages, each an operator of ``llm`` on all its predecessor kept.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. ``run`` writes each stage's result to the shared folder and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.common import table, written
from llm.jaccard import one_of_each
from llm.lines import dedup_lines
from llm.mixing import mix_sources
from llm.packing import pack_documents
from llm.quality import quality_rules, train_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bytes of the Arrow batches in which texts go to Python and back. Spark's own bounds, 10,000 rows and 64 MB, let a task
#: hold all its texts several times, as buffers on both sides.
BATCH_BYTES = 4 << 20


def _bounded(spark: SparkSession) -> None:
    """For all that runs in the session from now on: a stage's result is computed when its caller writes it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the classifier reject."""
    _bounded(spark)
    docs = docs.select(*COLUMNS)
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, model, COLUMNS[1:]).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that are near copies of an earlier one."""
    _bounded(spark)
    return dedup_lines(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    _bounded(spark)
    return one_of_each(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by draws until every source has the same share of the characters, in random order."""
    return mix_sources(docs.select(*COLUMNS)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    _bounded(spark)
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: SQL can express neither the trained classifier nor the tokenizer; tests/llm holds the stages after the classifier, and
#: run() from what the classifier keeps, against plain versions on sf0.001.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return docs
