"""Operations on the per-iteration snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.vector import natural_number


def label_join(snapshots: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach each point's label to every frame (J11): (iter, row_id, label, x, y); null where it has none."""
    return snapshots.join(labels, "row_id", "left").select("iter", "row_id", "label", F.col("y0").alias("x"),
                                                   F.col("y1").alias("y"))


def frame_limits(snapshots: DataFrame) -> DataFrame:
    """Largest absolute coordinate per axis and iteration (A10): (iter, xmax, ymax)."""
    return snapshots.groupBy("iter").agg(F.max(F.abs("y0")).alias("xmax"), F.max(F.abs("y1")).alias("ymax"))


def running_frame_limits(limits: DataFrame) -> DataFrame:
    """Running maximum of the frame limits over iterations.

    The input has one row per iteration (bounded by the iteration count), so
    the un-partitioned ordered window stays small.
    """
    w = Window.orderBy("iter").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return limits.select("iter", F.max("xmax").over(w).alias("xmax"), F.max("ymax").over(w).alias("ymax"))


def natural_order(names: DataFrame, col: str = "name") -> DataFrame:
    """Names ordered by the number inside them (O6), e.g. exportIter_2 < exportIter_10."""
    return names.withColumn("num", natural_number(col)).orderBy("num", col)
