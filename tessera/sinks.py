"""Snapshot sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_snapshot(y: DataFrame, path: str, iteration: int) -> str:
    """Write one iteration's coordinates under ``path/iter=<n>`` as Parquet.

    Each iteration is its own folder, so a rerun of one iteration replaces
    exactly that folder and readers see ``iter`` as a partition column.
    """
    target = f"{path.rstrip('/')}/iter={int(iteration)}"
    y.write.mode("overwrite").parquet(target)
    return target


def snapshot_lines(y: DataFrame, k: int) -> DataFrame:
    """The original text form of a snapshot: one "y0, y1" line per point.

    Returns (row_id, line); ordering for a single text file is applied by
    the writer (``write_snapshot_text``), not here.
    """
    parts = [F.col(f"y{c}").cast("string") for c in range(k)]
    return y.select("row_id", F.concat_ws(", ", *parts).alias("line"))


def write_snapshot_text(y: DataFrame, k: int, path: str) -> str:
    """Text snapshot in id order: range-partitioned by id and sorted in each
    part, so part files read in name order give id order."""
    lines = snapshot_lines(y, k).repartitionByRange("row_id").sortWithinPartitions("row_id")
    lines.select("line").write.mode("overwrite").text(path)
    return path


def write_labels_text(labels: DataFrame, path: str) -> str:
    """Labels (row_id, label), one to a line in id order across part files (the text form of S6)."""
    lines = labels.repartitionByRange("row_id").sortWithinPartitions("row_id")
    lines.selectExpr("CAST(label AS STRING) AS line").write.mode("overwrite").text(path)
    return path


def write_vector_text(vectors: DataFrame, path: str) -> str:
    """Vectors as whitespace-separated text lines, in id order across part files.

    Read back with ``read_vector_text(spark, path + "/part-*")``: Hadoop
    returns globbed files sorted by name, so line positions equal ids when
    the ids are dense from 0.
    """
    line = F.concat_ws(" ", F.transform("features", lambda x: x.cast("string")))
    lines = vectors.select("row_id", line.alias("line")).repartitionByRange("row_id").sortWithinPartitions("row_id")
    lines.select("line").write.mode("overwrite").text(path)
    return path
