"""From documents to token ids: language ID, near-dedup, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import langid
from pagemill.llm.common import read
from pagemill.llm.decontam import decontaminate
from pagemill.llm.mixing import mixed
from pagemill.llm.queries import token_digests
from pagemill.llm.simhash import survivors
from pagemill.session import ensure_checkpoint_dir


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(stage):
    """Documents are long rows: Arrow batches of 1,000, unless the session has a size of its own."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BATCH) == "10000":        # Spark's default
            spark.conf.set(_BATCH, "1000")
        return stage(spark, docs, sf_dir)
    return run_stage


@small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows whose language cannot be told: null texts and texts without a letter (`und`)."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    return langid.keep_known(docs, model)


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash component: 3-word shingles, at most 2 differing bits."""
    return survivors(docs, shingle=3, max_bits=2)


@small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold a window of 10 consecutive words of a benchmark item."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"), n=10, remove="documents")


@small_batches
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: cut texts, a second row for words taken twice, ``n_chars`` anew."""
    out = mixed(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


@small_batches
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode, write and read back: (doc_id, start, n_tokens, ids_crc32) of every row."""
    # workers still hold some of the earlier stages' memory: texts in slices of 1 MB
    return token_digests(spark, docs, slice_chars=1 << 20)


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("token output", token_output)]

#: Language ID and the mix's seeded blocks are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again."""
    root = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
