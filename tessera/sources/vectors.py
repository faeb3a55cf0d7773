"""Vector and label sources (S1, S2, S6) and the snapshot reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.vector import parse_vector

VECTORS_SCHEMA = "row_id bigint, features array<double>"


def read_vectors(spark: SparkSession, path: str, id_col: str = "vec_id", vec_col: str = "embedding",
                 limit_rows: int | None = None) -> DataFrame:
    """Vectors from a table with an id column (S2): (row_id bigint, features array<double>).

    Only the two columns are read (column pruning reaches the Parquet scan);
    ``limit_rows`` keeps ids below n (the original's "first n rows") and is
    pushed to the scan as a filter.
    """
    df = spark.read.parquet(path)
    if limit_rows is not None:
        df = df.where(F.col(id_col) < F.lit(int(limit_rows)))
    return df.select(F.col(id_col).cast("bigint").alias("row_id"),
                     F.col(vec_col).cast("array<double>").alias("features"))


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, start, m): text lines with their file, the start of their split and a running number.

    Blank lines are kept; a caller filters before it numbers.
    """
    return spark.read.text(path).selectExpr("value AS line", "_metadata.file_path AS file", "_metadata.file_block_start AS start")


def _numbered(lines: DataFrame, group: list[str], number: str) -> DataFrame:
    """``lines`` (line, file, start, group columns..) with their 0-based place within their group.

    A split's lines are read in order by one task, so a line's place is its running number less its split's
    first, after the lines of the splits before it.  Counts per split are the only thing that is gathered: a
    window over a row per split.  The two reads must agree about the splits; a line whose place would not fit
    its split raises an error.
    """
    tagged = lines.withColumn("m", F.monotonically_increasing_id())
    splits = tagged.groupBy(*group, "file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("first"))
    part = F.coalesce(F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).try_cast("bigint"), F.lit(0))
    before = (Window.partitionBy(*group) if group else Window.partitionBy()).orderBy(part, "file", "start")
    placed = splits.withColumn("ahead", F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = tagged.join(placed, [*group, "file", "start"], "left")
    at = F.col("m") - F.col("first")
    good = at.isNotNull() & (at >= 0) & (at < F.col("n"))
    return out.select(*group, "line", F.when(good, F.col("ahead") + at).otherwise(
        F.raise_error(F.lit("the splits of a text source changed between two reads"))).cast("bigint").alias(number))


def numbered_lines(spark: SparkSession, path: str, blank: bool = True) -> DataFrame:
    """(line, line_no): text lines with their 0-based place in the input (W2 on files), all in the JVM.

    Several files, as a folder or a glob, count in the order of their part numbers, then of their names.
    ``blank=False`` skips lines of white space before numbering.
    """
    lines = _split_lines(spark, path)
    if not blank:
        lines = lines.where(F.trim(F.regexp_replace("line", r"\s", " ")) != "")
    return _numbered(lines, [], "line_no")


def read_vector_text(spark: SparkSession, path: str, limit_rows: int | None = None) -> DataFrame:
    """Whitespace-separated vectors, one per line, id = position among non-blank lines.

    Leading/trailing blanks and tabs are allowed; blank lines are skipped
    before numbering.
    """
    df = numbered_lines(spark, path, blank=False)
    if limit_rows is not None:
        df = df.where(F.col("line_no") < F.lit(int(limit_rows)))
    return df.select(F.col("line_no").alias("row_id"), parse_vector("line").alias("features"))


def read_labels_text(spark: SparkSession, path: str, limit_rows: int | None = None) -> DataFrame:
    """One label per line, no header, aligned by position (S6): (row_id, label string)."""
    df = numbered_lines(spark, path, blank=False)
    if limit_rows is not None:
        df = df.where(F.col("line_no") < F.lit(int(limit_rows)))
    return df.selectExpr("line_no AS row_id", r"regexp_replace(line, r'^\s+|\s+$', '') AS label")


FRAME_NAME = "exportIter_"


def read_snapshots_text(spark: SparkSession, path: str, k: int = 2) -> DataFrame:
    """All text frames of a folder (S8): (iter, row_id, y0..), from ``exportIter_<n>`` folders of "y0, y1" lines.

    The frames are those that the folder holds, whatever numbers are absent; a frame's number is that of its
    folder's name, a point's that of its line.
    """
    lines = _split_lines(spark, f"{path.rstrip('/')}/{FRAME_NAME}*").withColumn(
        "iter", F.regexp_extract("file", rf"{FRAME_NAME}(\d+)", 1).cast("int"))
    vals = F.split(F.col("line"), ", ").cast("array<double>")
    return _numbered(lines, ["iter"], "row_id").select("iter", "row_id", *[vals[c].alias(f"y{c}") for c in range(k)])


def read_labels(spark: SparkSession, path: str, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """Labels from the label column of a table (S6, table form)."""
    return spark.read.parquet(path).select(F.col(id_col).cast("bigint").alias("row_id"),
                                           F.col(label_col).alias("label"))


def validate_vectors(vectors: DataFrame) -> dict:
    """Shape check (A9): rows, min/max width, null ids, null or non-finite vectors.

    The original silently cuts ragged rows to the shorter one; we refuse
    them instead, with a count.
    """
    width = F.size("features")
    bad = (F.col("row_id").isNull() | F.col("features").isNull()
           | F.exists("features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    r = vectors.agg(F.count(F.lit(1)).alias("n"), F.min(width).alias("dmin"), F.max(width).alias("dmax"),
                    F.sum(F.when(bad, 1).otherwise(0)).alias("bad"),
                    F.min("row_id").alias("id_min"), F.max("row_id").alias("id_max")).first()
    return r.asDict()


def require_valid(vectors: DataFrame) -> dict:
    info = validate_vectors(vectors)
    if info["n"] and (info["bad"] or info["dmin"] != info["dmax"]):
        raise ValueError(f"vectors must be finite, with an id, and of one width: {info}")
    twice = vectors.groupBy("row_id").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"ids must be unique: {twice['row_id']} has {twice['count']} rows")
    return info


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots written by ``write_snapshot`` (S8): (iter int, row_id, y...).

    ``iter`` is an int partition column, so it orders naturally and filters
    on it prune folders.
    """
    return spark.read.option("basePath", path).parquet(path)
