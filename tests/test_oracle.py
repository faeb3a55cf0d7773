"""A sample of the driver's check: Spark queries against their DuckDB oracles."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
SAMPLE = ["knn_topk", "perplexity_beta", "joint_affinity_knn", "gradient_full", "pairwise_sq_dist",
          "covariance", "momentum_step", "tsne_fit_3", "frame_limits", "vectors_text_scan"]


def _norm(df):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(None if isinstance(v, float) and math.isnan(v) else (v.item() if hasattr(v, "item") else v)
                         for v in rec))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    # the corpus operators' own tests cover theirs
    assert set(QUERIES) - set(s) == {"pca_project", "embed_pipeline"}


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["row_id", "y0", "y1"] and df.count() == 500
