"""Tables stored by key, so that repeated joins leave them where they are.

A bucketed table keeps its rows hashed by key into a fixed number of files.  A join on that key reads one
file per task and shuffles only its other side -- what an iteration needs that joins the same large, fixed
table (edges, blocks) with something small and new each time.  The files live in the session's checkpoint
folder, so a lost executor costs a read of its files and nothing else.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.session import drop_table, scratch_path


@dataclass
class KeyedTable:
    name: str
    path: str
    buckets: int
    spark: SparkSession

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_table(self.spark, self.path)


def bucket_count(spark: SparkSession, total_bytes: int = 0, bucket_bytes: int = 32 << 20) -> int:
    """Buckets of about ``bucket_bytes``, and at least ``spark.sql.shuffle.partitions``: with fewer, Spark
    would rather shuffle both sides of a join than keep the table's layout."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // bucket_bytes), 1)


def placement_keys(spark: SparkSession, buckets: int) -> list[int]:
    """For every bucket a long that hashes into it: keys that put a numbered owner in a bucket of its own."""
    for draw in (8, 32, 128):  # all buckets are met by 8 draws each but for one time in some hundred
        rows = (spark.range(draw * buckets + 64).selectExpr("id", f"pmod(hash(id), {buckets}) AS b")
                .groupBy("b").agg({"id": "min"}).collect())
        if len(rows) == buckets:
            return [k for _, k in sorted((r[0], r[1]) for r in rows)]
    raise RuntimeError(f"no keys found for {buckets} buckets")


def write_keyed(df: DataFrame, key: str, buckets: int, name: str = "keyed", dealt: bool = False) -> KeyedTable:
    """Write ``df`` bucketed and sorted by ``key``: one shuffle here, none in later joins on ``key``.

    ``dealt`` says that a task holds few keys already, so that the shuffle here is not needed either.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"tessera_{name}_{uuid.uuid4().hex[:12]}"
    ((df if dealt else df.repartition(buckets, key)).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return KeyedTable(table, path, buckets, spark)
