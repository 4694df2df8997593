"""Running numbers over large groups (W7) without a one-task window.

``row_number() OVER (PARTITION BY g ORDER BY t)`` sorts a whole group in one
task; when one group holds a large share of the rows (one source, one batch)
that task is the job.  ``running_number`` gives the same numbers in three
distributed steps: range-partition the rows by (group, order) - Spark samples
the keys, so a group of any size or time span falls into ranges of like
*count* - then count rows per (group, range), turn the small count table into
offsets with a prefix sum, and number rows inside each range plus the offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def ranged(df: DataFrame, group_cols: list[str], order_cols: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` with ``_range``: the number of its range in (group, order), about equal in rows.

    Cut with a reliable checkpoint: the sampled range bounds must be the same
    for every reader.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *group_cols, *order_cols)
            .withColumn("_range", F.spark_partition_id()).checkpoint())


def running_number(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str = "n",
                   ranges: int | None = None) -> DataFrame:
    """Exact ``row_number`` per group in ``order_cols`` order (a total order)."""
    b = ranged(df, group_cols, order_cols, ranges)
    counts = b.groupBy(*group_cols, "_range").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group_cols).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    inner = Window.partitionBy(*group_cols, "_range").orderBy(*order_cols)
    numbered = b.withColumn("_n", F.row_number().over(inner))
    same = [numbered[c].eqNullSafe(offsets[c]) for c in group_cols] + [numbered["_range"] == offsets["_range"]]
    return numbered.join(offsets, same).select(
        *[numbered[c] for c in df.columns], (F.col("_n") + F.col("_off")).alias(out))
