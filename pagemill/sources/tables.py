"""Table sources (S1, S2, S5) and the run-wide derived inputs.

Everything is read with ``spark.read.parquet`` so filters and column
selections reach the scan (PushedFilters / ReadSchema).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SiteSpec
from ..functions.urls import url_parts

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: partitions for texts and pages whose files a scan cannot split (few files, one row
#: group each).  Unset, the scan's own splits stand and nothing is shuffled.
INPUT_PARTITIONS = "pagemill.input.partitions"


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the session asks for, if it does."""
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents"))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_pages`` view of the bundled ``pages`` table (no fetch time/kind in it)."""
    return dealt(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def list_pages(pages: DataFrame, spec: SiteSpec) -> DataFrame:
    """List pages with their page counter (query parameter, default 0).

    With a ``kind`` column only ``kind = 'list'`` rows are taken; with a seed
    URL only pages on the seed's host are.
    """
    df = pages.where(F.col("kind") == "list") if "kind" in pages.columns else pages
    if spec.seed_url:
        host = url_parts(F.lit(spec.seed_url))["netloc"]
        df = df.where(url_parts(F.col("url"))["netloc"] == host)
    counter = F.regexp_extract(F.col("url"), rf"[?&]{spec.page_param}=([0-9]+)", 1)
    return df.withColumn("page_counter", F.coalesce(counter.try_cast("bigint"), F.lit(0)))


def detail_pages(pages: DataFrame) -> DataFrame:
    """Detail pages (``kind = 'detail'`` when the column exists)."""
    return pages.where(F.col("kind") == "detail") if "kind" in pages.columns else pages


def media_files(spark: SparkSession, store_path: str) -> DataFrame:
    """Fetched files in the media store as (path, length), no content read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(store_path)
            .select(F.col("path"), F.col("length")))
