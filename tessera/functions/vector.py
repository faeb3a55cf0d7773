"""Column expressions on vectors (JVM side, no Python in the hot path)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_vector(line) -> Column:
    """Trim a text line, split on runs of whitespace, parse doubles."""
    c = F.col(line) if isinstance(line, str) else line
    return F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " ").cast("array<double>")


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance of two equal-length arrays (F1 squared)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def l2_norm(a) -> Column:
    """L2 norm of an array (F2)."""
    a = F.col(a) if isinstance(a, str) else a
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda s, v: s + v))


# Deterministic standard normals: two uniforms from 52 bits of an md5 of
# (seed, row, col, tag), then Box-Muller.  Unlike F.randn the value does not
# depend on partitioning, so a recomputed partition redraws the same start.
_TWO_52 = float(2 ** 52)


def hash_uniform(seed: int, row, col, tag: str) -> Column:
    key = F.concat(F.lit(f"{seed}|"), row.cast("string"), F.lit("|"), col.cast("string"), F.lit(f"|{tag}"))
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(_TWO_52)


def hash_normal(seed: int, row, col) -> Column:
    ua = hash_uniform(seed, row, col, "a")
    ub = hash_uniform(seed, row, col, "b")
    return F.sqrt(F.lit(-2.0) * F.log(ua)) * F.cos(F.lit(2.0 * math.pi) * ub)


def natural_number(name) -> Column:
    """The first run of digits of a name as a bigint, for natural ordering (O6); null without digits."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("bigint")


def rnd(c, digits: int = 9) -> Column:
    """Round for comparison and clear negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def cell_address(flat_index, k: int) -> tuple[Column, Column]:
    """(row, col) of a flat cell index in an n x k grid: floor(i / k), i % k."""
    c = F.col(flat_index) if isinstance(flat_index, str) else flat_index
    return F.floor(c / F.lit(k)).cast("bigint"), F.pmod(c, F.lit(k)).cast("int")
