"""Line deduplication across documents, in DataFrame operations only.

Lines are exploded with their position, normalised and hashed; documents are
counted per hash; lines of hashes over the threshold go, and each document is
put together again from the positions that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, read_table, tmp_col
from tessera.session import write_table

_WHITE = " \t\n\x0b\x0c\r"
_LINES = "split({}, '\\n', -1)"


def line_key(line):
    """White space off both ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(_WHITE)))


def _exploded(docs: DataFrame, id_col: str, text_col: str, min_len: int) -> DataFrame:
    """(doc, pos, k1, k2) of every line whose key is long enough; k1, k2 are 128 bits of the key's digest."""
    lines = (docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("th"),
                     F.posexplode(F.expr(_LINES.format("`" + text_col + "`"))).alias("pos", "line"))
             .filter(F.char_length(F.trim("line", F.lit(_WHITE))) >= min_len)
             .select("doc", "th", "pos", line_key(F.col("line")).alias("key")))
    return lines.select("doc", "th", "pos", F.unhex(F.md5("key")).alias("k"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 10,
                        min_docs: int = 2) -> DataFrame:
    """``docs`` with three more columns: ``n_lines``, ``n_dropped`` (long) and ``kept_text``.

    A key of ``min_len`` code points or more found in at least ``min_docs`` different documents loses all
    its lines except those in the smallest id that holds it.

    Nulls and edges: a null or empty text is one empty line; a row without an id is returned unchanged and
    never counted; repeated rows are one document, so the keys they share with themselves alone stay, and
    each copy of the row gets the same result; other columns pass through (existing columns named like the
    three new ones are replaced).
    """
    lines = _exploded(docs, id_col, text_col, min_len)
    agg = [F.min("doc").alias("least")]
    if min_docs == 2:
        # two different ids, without a distinct count
        common = lines.groupBy("k").agg(*agg, F.max("doc").alias("most")).filter("least < most")
    else:
        common = (lines.select("k", "doc").distinct().groupBy("k").agg(*agg, F.count("*").alias("n"))
                  .filter(F.col("n") >= max(1, min_docs)))
    common, _ = write_table(common.select("k", "least"), "linekeys")
    # both sides come straight from an exchange, so a very common line's rows can be split between tasks
    hits = lines.join(common, "k").filter("doc <> least").select("doc", "th", "pos")
    hits, _ = write_table(hits, "linehits")
    # one entry per dropped line of one document: bounded by the document's own lines
    dropped = hits.groupBy("doc", "th").agg(F.collect_set("pos").alias("gone"))
    th, gone, parts = tmp_col(docs, "th"), tmp_col(docs, "gone"), tmp_col(docs, "parts")
    out = docs.drop("n_lines", "n_dropped", "kept_text").withColumn(th, F.xxhash64(text_col))
    right = dropped.select(F.col("doc").alias(th + "d"), F.col("th").alias(th + "t"), F.col("gone").alias(gone))
    joined = (out.join(right, (out[id_col] == right[th + "d"]) & (out[th] == right[th + "t"]), "left")
              .drop(th, th + "d", th + "t")
              .withColumn(parts, F.expr(_LINES.format(f"coalesce(`{text_col}`, '')"))))
    stay = F.expr(f"transform(array_except(sequence(0, size(`{parts}`) - 1), `{gone}`), i -> `{parts}`[i])")
    return (joined
            .withColumn("n_lines", F.size(parts).cast("long"))
            .withColumn("n_dropped", F.coalesce(F.size(F.col(gone)), F.lit(0)).cast("long"))
            .withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("long")))
            .withColumn("kept_text", F.when(F.col(gone).isNull(), F.coalesce(F.col(text_col), F.lit("")))
                        .otherwise(F.array_join(stay, "\n")))
            .drop(gone, parts))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (
  SELECT k, min(doc_id) AS least FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT y.*, c.k IS NOT NULL AND y.doc_id <> c.least AS gone FROM keyed y LEFT JOIN common c ON y.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
