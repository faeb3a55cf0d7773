"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Each source gets a target number of words (weights, capped at a multiple of its
size).  A document's expected number of copies is target / size of its source;
the prefix sum of the expected copies within the source, plus one offset per
source, is cut at the integers, and a document is emitted once per integer it
crosses.  Documents are ordered by size first, so the words taken follow the
copies closely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_RE, read_table, tmp_col
from tessera.session import write_table


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(source, source_size, target): water-filling of the total by weight under cap * source_size.

    ``sizes`` has one row per source (so the two unpartitioned windows sort as many rows as there are
    sources, not documents).  Sources are ranked by code point, null last; weights repeat along the rank.
    Capping the source with the lowest cap / weight first gives the same targets as resharing the excess
    round by round until no target is above its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]),
                        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("w", pick.cast("long")).withColumn("top", F.col("source_size") * F.lit(cap))
         .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
         .withColumn("all_w", F.sum("w").over(Window.partitionBy())))
    before = (Window.orderBy((F.col("top") / F.col("w")).asc(), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    s = (s.withColumn("used", F.coalesce(F.sum("top").over(before), F.lit(0)))
         .withColumn("used_w", F.coalesce(F.sum("w").over(before), F.lit(0)))
         # what a weight of one gets if this source and those after it share the rest
         .withColumn("unit", (F.col("total") - F.col("used")) / (F.col("all_w") - F.col("used_w")))
         .withColumn("full", F.col("w") * F.col("unit") >= F.col("top")))
    rest = F.min(F.when(~F.col("full"), F.struct("used_w", "unit"))).over(Window.partitionBy())
    return s.select("source", "source_size", F.when(F.col("full"), F.col("top").cast("double"))
                    .otherwise(F.col("w") * rest["unit"]).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: doc (id), th (text hash), size, source, source_size, target, copies.

    Nulls and edges: a null text has size 0; null is a source of its own, ranked last; rows with a null id
    count and are sampled like others; repeated rows are each sampled; a source without words has target 0
    and no copies; an empty table gives an empty result.  The offset comes from a hash of the seed and the
    source and the order from size and a hash of the id, so reruns agree.
    """
    d = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("th"), F.col(source_col).alias("source"),
        F.coalesce(F.expr(rf"regexp_count(`{text_col}`, r'{WORD_RE}')"), F.lit(0)).cast("long").alias("size"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.md5(F.col("doc").cast("string")).asc_nulls_last(),
             F.col("th")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges of the order, written once so that the counts and the ranks below see the same partitions
    d, _ = write_table(d.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "mixrange")
    per = d.groupBy("source", "part").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    per, _ = write_table(per, "mixcounts")  # partitions plus sources rows at most
    targets = source_targets(per.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("source", "part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"))
    targets = targets.withColumnRenamed("source", "s1")
    per = per.join(targets, F.col("source").eqNullSafe(F.col("s1")))
    # no key spans more than one partition here: a source's rows are ranked range by range
    rank = Window.partitionBy("part", "source").orderBy(*order[1:])
    d = d.withColumn("rank", F.row_number().over(rank) - 1)
    p = per.select(F.col("source").alias("s2"), F.col("part").alias("p2"), "ahead", "source_size", "target")
    d = (d.join(p, (F.col("part") == F.col("p2")) & F.col("source").eqNullSafe(F.col("s2")))
         .withColumn("k", F.col("ahead") + F.col("rank")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    offset = F.conv(F.substring(F.md5(key), 1, 5), 16, 10).cast("long") / F.lit(1048576.0)
    copies = F.floor(offset + rate * (F.col("k") + 1)) - F.floor(offset + rate * F.col("k"))
    return d.select("doc", "th", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = mix_sources(docs)
    return m.select(F.col("doc").alias("doc_id"), "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies")


def emit_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                **kw) -> DataFrame:
    """``docs`` with each row repeated by its number of copies (rows without copies go); same columns.

    Rows alike in id, text and source share the sum of their copies evenly.
    """
    base = tmp_col(docs, "mix")
    th, n, r, j = (base + x for x in ("h", "n", "r", "j"))
    m = mix_sources(docs, id_col, text_col, source_col, **kw)
    m = (m.groupBy("doc", "th", "source").agg(F.sum("copies").alias(n), F.count("*").alias(r)).filter(F.col(n) > 0)
         .select(F.col("doc").alias(base + "1"), F.col("th").alias(base + "2"), F.col("source").alias(base + "3"), n, r))
    left = docs.withColumn(th, F.xxhash64(text_col))
    both = left.join(m, left[id_col].eqNullSafe(m[base + "1"]) & (left[th] == m[base + "2"])
                     & left[source_col].eqNullSafe(m[base + "3"]))
    alike = Window.partitionBy(base + "1", base + "2", base + "3").orderBy(F.lit(0))
    both = both.withColumn(j, F.row_number().over(alike))
    times = F.expr(f"int(floor(`{j}` * `{n}` / `{r}`) - floor((`{j}` - 1) * `{n}` / `{r}`))")
    return (both.withColumn(j, F.explode(F.array_repeat(F.lit(1), times)))
            .select(*[both[c] for c in docs.columns]))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM src),
u AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(w) OVER () AS BIGINT) AS all_w,
         CAST(coalesce(sum(3 * source_size) OVER o, 0) AS BIGINT) AS used,
         CAST(coalesce(sum(w) OVER o, 0) AS BIGINT) AS used_w FROM w
  WINDOW o AS (ORDER BY 3 * source_size / CAST(w AS DOUBLE), encode(source) NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (total - used) / CAST(all_w - used_w AS DOUBLE) AS unit FROM u),
t AS (
  SELECT source, source_size,
         CASE WHEN w * unit >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
              ELSE w * (SELECT arg_min(unit, used_w) FROM v WHERE w * unit < 3 * source_size) END AS target,
         CAST('0x' || substr(md5('mix:' || coalesce('s' || source, 'null')), 1, 5) AS BIGINT) / 1048576.0 AS shift
  FROM v),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(CAST(d.doc_id AS VARCHAR)) NULLS LAST) - 1 AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CAST(floor(shift + rate * (k + 1)) - floor(shift + rate * k) AS BIGINT) AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""
