"""Every catalogue query against its DuckDB oracle on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from trendlens.plans import catalogue, features
from trendlens.sources.tables import TABLES

from .conftest import SF_SMALL

# Model queries at full width: no closed form, so their metrics are only held to be sound.
WIDE = {"multi_target_report", "feature_set_report", "gbt_metrics", "log_target_metrics"}
ROWS_ONLY = {"sample_fraction", "random_split", "hashed_features", "batch_score"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 6) if isinstance(v, float) else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = catalogue.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(catalogue.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY - {"batch_score"}))
def test_rows_only_queries_run(spark, name):
    assert catalogue.queries()[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(WIDE))
def test_wide_models_evaluate_on_rows(spark, name):
    rows = catalogue.queries()[name](spark, SF_SMALL).collect()
    assert rows and all(r.n > 0 and math.isfinite(r.rmse) and math.isfinite(r.r2) for r in rows)


def test_batch_score_returns_every_request(spark, con):
    rows = catalogue.queries()["batch_score"](spark, SF_SMALL).collect()
    n = con.execute(f"WITH {features.RECORDS_SQL} SELECT count(*) FROM rec WHERE split = 'test'").fetchone()[0]
    assert len(rows) == n
    assert all(r.error is None and math.isfinite(r.pred_likes_ratio) for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tag", "count"] and df.count() > 0


def test_every_query_has_oracle_or_is_known():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == ROWS_ONLY | WIDE
    assert set(catalogue.queries()) <= set(E.queries())
