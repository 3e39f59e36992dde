"""The registry is sound, and a spread of queries equals its SQL."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from conftest import SF

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
TABLES = ("events", "orders")
SPREAD = (
    "f5_amount_bins", "f13_domain_parts", "f20_screen", "w3_rolling_median", "w5_transactions_last_hour", "w8_product_forward_fill",
    "a6_uid_statistics", "a8_out_of_fold_rate", "a13_describe_by_class", "a19_average_precision", "a20_classification_report",
    "g3_card_features", "g4_email_features", "g13_velocity_features", "g14_feature_chain", "p8_row_errors", "s10_delimited_text",
    "m1_stratified_split", "m4_ordinal_codes", "t1_prediction_window_stream", "t4_drift_report", "t6_latency_p99", "t10_sustained_condition",
    "t12_streaming_scoring",
)


def test_registry():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) > 130


def test_flagship(spark):
    out = entry_module.entry(spark)
    assert out.count() == 10 and out.schema.names == ["card_id", "top_jump", "rows"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SPREAD)
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    got, want = (
        d[cols].astype(object).where(d[cols].notna(), None).sort_values(cols, key=lambda s: s.map(str)).reset_index(drop=True)
        for d in (got, want)
    )
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
