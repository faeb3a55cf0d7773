"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Every shard owns ``vnodes`` points of a ring of 2**60 positions; a row's key is hashed to a position and
belongs to the shard of the next point clockwise.  Shards have room for a bounded number of rows; rows whose
shard is full continue clockwise to the next shard with room.  Rows are placed in ring order, so the whole
placement follows from the number of rows between two points (one number per point, whatever the size of
the table) and from each row's rank on the ring.  Equal keys share a position: they stay together until
their shard is full, and a key with a third of all rows fills one shard after the other.

Ranks come from ranges of (position, tie, row), which split a key of any size; no task gathers a key, and
nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.session import drop_table, write_table

SHARDS = 8
VNODES = 128
ROWS_A_RANGE = 1_000_000
_CELL = 48  # positions are looked up by their upper 12 bits
_IN_PART = 33  # monotonically_increasing_id: partition above, row below


def position(text) -> Column:
    """Place on the ring: the first 60 bits of the MD5 digest of a string column."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def ring_arcs(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """(arc, lo, hi, pref): positions in (lo, hi] belong to arc, pref lists the shards met clockwise from it.

    ``shards * vnodes + 1`` rows: the last arc leads over position 0 to the first point again.
    """
    points = (spark.range(shards * vnodes)
              .select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("v"))
              .select("shard", position(F.concat_ws(":", F.lit("point"), "shard", "v")).alias("at")))
    # one row, bounded by the parameters
    ring = points.agg(F.array_sort(F.collect_list(F.struct("at", "shard"))).alias("r")).select(
        F.transform("r", lambda p: p["at"]).alias("at"), F.transform("r", lambda p: p["shard"]).alias("who"))
    m = shards * vnodes
    arc = ring.select("at", "who", F.explode(F.sequence(F.lit(0), F.lit(m))).alias("arc"))
    return arc.select(
        "arc",
        F.when(F.col("arc") == 0, F.lit(-1)).otherwise(F.expr("element_at(at, arc)")).cast("long").alias("lo"),
        F.when(F.col("arc") == m, F.lit((1 << 60) - 1)).otherwise(F.expr("at[arc]")).cast("long").alias("hi"),
        F.expr(f"array_distinct(concat(slice(who, arc % {m} + 1, {m}), slice(who, 1, arc % {m})))").alias("pref"))


def _sweep(counts: DataFrame, shards: int, slack: float) -> DataFrame:
    """(arc, g0, g1, shard, base): rows of ranks g0 to g1 - 1 go to slots base and on of a shard.

    ``counts`` is (arc, pref, n), a row per arc; they are folded in ring order in one row.  A shard's room is
    its even share of the rows, counts at most one apart, or with ``slack`` the share times 1 + slack, rounded up.
    """
    total = "aggregate(arcs, 0L, (s, a) -> s + a.n)"
    if slack > 0:
        caps = f"transform(sequence(0, {shards - 1}), s -> cast(ceil({total} / {shards}D * {1 + slack!r}D) as bigint))"
    else:
        caps = f"transform(sequence(0, {shards - 1}), s -> {total} div {shards} + if(s < {total} % {shards}, 1L, 0L))"
    take = "least(x.left, x.room[s])"
    fold = f"""
      aggregate(arcs,
        named_struct('room', caps, 'g', 0L, 'out', cast(array() as array<struct<arc:int,g0:bigint,g1:bigint,shard:int,base:bigint>>)),
        (acc, a) -> aggregate(if(a.n > 0, a.pref, cast(array() as array<int>)),
          named_struct('left', a.n, 'room', acc.room, 'g', acc.g, 'out', acc.out),
          (x, s) -> if({take} = 0, x, named_struct(
            'left', x.left - {take},
            'room', transform(x.room, (r, i) -> if(i = s, r - {take}, r)),
            'g', x.g + {take},
            'out', concat(x.out, array(named_struct('arc', a.arc, 'g0', x.g, 'g1', x.g + {take}, 'shard', s,
                                                    'base', caps[s] - x.room[s]))))),
          x -> named_struct('room', x.room, 'g', x.g, 'out', x.out)),
        acc -> acc.out)"""
    one = counts.agg(F.array_sort(F.collect_list(F.struct("arc", "n", "pref"))).alias("arcs"))
    one = one.select("arcs", F.expr(caps).alias("caps"))
    return one.select(F.expr(f"inline({fold})"))


def _free_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` has."""
    p = "__ring"
    while any(c.lower().startswith(p) for c in df.columns):
        p += "_"
    return p


def place_rows(rows: DataFrame, key: Column, tie: Column, shards: int = SHARDS, vnodes: int = VNODES,
               slack: float = 0.0) -> DataFrame:
    """``rows`` with shard (int, from 0) and slot (long, gapless from 0 in each shard).

    ``key`` and ``tie`` are string columns: equal keys share a place on the ring, ``tie`` orders rows of one
    key.  With ``slack`` 0 the shards' counts are at most one apart; with more, fewer rows move when rows or
    shards come and go, and no shard exceeds its share times 1 + slack.

    Nulls and edges: null keys and ties count as the empty string; rows alike in every respect are placed one
    by one; columns named shard or slot are replaced; an empty table gives an empty result; with fewer rows
    than shards some shards stay empty.  Texts travel only if ``rows`` holds them, and then once.
    """
    if shards < 1 or vnodes < 1 or slack < 0:
        raise ValueError("shards and vnodes are at least 1, slack at least 0")
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    own = _free_prefix(rows)
    pos, by, row, arc, part, nth, cell, lo, hi, ahead = (own + x for x in (
        "pos", "by", "row", "arc", "part", "nth", "cell", "lo", "hi", "ahead"))
    arcs = ring_arcs(spark, shards, vnodes)
    cells = arcs.select(F.col("arc").alias(arc), F.col("lo").alias(lo), F.col("hi").alias(hi),
                        F.explode(F.expr(f"sequence(greatest(lo, 0) >> {_CELL}, hi >> {_CELL})")).alias(cell))
    d = rows.select(*keep, position(F.coalesce(key, F.lit(""))).alias(pos), position(F.coalesce(tie, F.lit(""))).alias(by),
                    F.monotonically_increasing_id().alias(row))
    # at most 2**12 + shards * vnodes rows, whatever the table's size
    d = d.join(F.broadcast(cells), (F.shiftright(F.col(pos), _CELL) == F.col(cell))
               & (F.col(pos) > F.col(lo)) & (F.col(pos) <= F.col(hi))).select(*keep, pos, by, row, arc)
    d, raw = write_table(d, "ringrows")  # hashed once: the ranges are sampled from it
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-d.count() // ROWS_A_RANGE))
    order = [pos, by, row]
    # the number of a row: its range above, its place in the sorted range below
    o = d.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(
        row, F.monotonically_increasing_id())
    o, _ = write_table(o.select(*keep, arc, F.shiftright(F.col(row), _IN_PART).alias(part),
                                F.col(row).bitwiseAND(F.lit((1 << _IN_PART) - 1)).alias(nth)), "ring")
    drop_table(spark, raw)
    per = o.groupBy(part, arc).agg(F.count("*").alias("n"))  # ranges plus arcs rows at most
    per, _ = write_table(per, "ringcounts")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = per.groupBy(part).agg(F.sum("n").alias("n")).select(
        F.col(part).alias(cell), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(ahead))
    counts = arcs.join(per.groupBy(arc).agg(F.sum("n").alias("n")), F.col("arc") == F.col(arc), "left").select(
        "arc", "pref", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    # at most an entry per arc and per shard
    runs = _sweep(counts, shards, slack).select(F.col("arc").alias(cell), F.col("g0").alias(lo), F.col("g1").alias(hi),
                                                "shard", F.col("base").alias(ahead))
    g = o.join(F.broadcast(first), F.col(part) == F.col(cell)).select(*keep, arc, (F.col(nth) + F.col(ahead)).alias(nth))
    g = g.join(F.broadcast(runs), (F.col(arc) == F.col(cell)) & (F.col(nth) >= F.col(lo)) & (F.col(nth) < F.col(hi)))
    return g.select(*keep, "shard", (F.col(ahead) + F.col(nth) - F.col(lo)).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    **kw) -> DataFrame:
    """``docs``, whole, with shard and slot: the key is the text, so equal texts stay together while there is room."""
    return place_rows(docs, F.col(text_col), F.col(id_col).cast("string"), shards, **kw)


def op11_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: the loads are bounded by counts that are at most one apart; texts stay out of the exchange."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.md5(text).alias("key"))
    return place_rows(docs, F.col("key"), F.col("doc_id").cast("string")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, CAST(strlen(x) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(x)), '..'),
               lambda h: CAST('0x' || h AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
         CAST('0x' || substr(md5(md5(x)), 1, 15) AS BIGINT) AS pos
  FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents), crc),
v AS (
  SELECT s AS shard, CAST('0x' || substr(md5('point:' || s || ':' || v), 1, 15) AS BIGINT) AS spot
  FROM range(8) a(s), range(128) b(v)),
ring AS (SELECT row_number() OVER (ORDER BY spot, shard) - 1 AS arc, spot, shard FROM v),
twice AS (SELECT arc, shard FROM ring UNION ALL SELECT arc + 1024, shard FROM ring),
met AS (
  SELECT arc, list(s ORDER BY nxt) AS pref FROM (
    SELECT r.arc, t.shard AS s, min(t.arc) AS nxt
    FROM (SELECT arc FROM ring UNION ALL SELECT 1024) r JOIN twice t ON t.arc >= r.arc % 1024 AND t.arc < r.arc % 1024 + 1024
    GROUP BY ALL) GROUP BY arc),
placed AS (
  SELECT d.*, coalesce(r.arc, 1024) AS arc FROM d ASOF LEFT JOIN ring r ON d.pos <= r.spot),
n AS (SELECT met.arc, pref, (SELECT count(*) FROM placed p WHERE p.arc = met.arc) AS n FROM met),
walk AS (
  SELECT CAST(-1 AS BIGINT) AS arc, 0 AS k, CAST(0 AS BIGINT) AS rest, CAST(0 AS BIGINT) AS took, CAST(-1 AS BIGINT) AS shard,
         list_transform(range(8), lambda s: total // 8 + CASE WHEN s < total % 8 THEN 1 ELSE 0 END) AS room
  FROM (SELECT count(*) AS total FROM d)
  UNION ALL
  SELECT arc, k, rest - take, take, who, list_transform(room, lambda r, i: CASE WHEN i = who + 1 THEN r - take ELSE r END)
  FROM (SELECT *, least(rest, room[who + 1]) AS take FROM (
    SELECT n.arc, CASE WHEN w.rest > 0 THEN w.k + 1 ELSE 1 END AS k, CASE WHEN w.rest > 0 THEN w.rest ELSE n.n END AS rest,
           n.pref[CASE WHEN w.rest > 0 THEN w.k + 1 ELSE 1 END] AS who, w.room
    FROM walk w JOIN n ON n.arc = CASE WHEN w.rest > 0 THEN w.arc ELSE w.arc + 1 END))),
runs AS (
  SELECT shard, sum(took) OVER (ORDER BY arc, k) - took AS g0, took,
         sum(took) OVER (PARTITION BY shard ORDER BY arc, k) - took AS base FROM walk WHERE took > 0),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY pos, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)) - 1 AS g FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(base + g - g0 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM ranked r JOIN runs ON g >= g0 AND g < g0 + took
"""
