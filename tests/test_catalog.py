"""The registered queries against their SQL, on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "part", "customer", "nation", "embeddings")
CHECKED = [
    "src_transactions", "src_csv_roundtrip", "src_parse_ts", "sink_tables", "sink_customers", "sink_prepared_lines",
    "clean_rescue_discount", "clean_cast_ints", "clean_lines", "feat_mtbt", "onehot_month", "scale_apply", "trim_lines_p99",
    "filter_positive_qty", "filter_horizon", "join_label_lookup", "extract_customers", "broadcast_scalar", "features_unmatched",
    "describe_numeric", "quantile_p99", "basket_amount_summary", "basket_stats", "rfm_assemble", "trim_customers_p99",
    "revenue_by_month", "revenue_share_by_country", "distinct_countries", "pareto_customers", "pareto_products", "histogram",
    "summary_rfm", "corr_matrix_all", "pair_density", "segment_profile_mean", "customer_label", "basket_occurrence",
    "first_basket_features", "features_assemble", "horizon_recency", "horizon_sweep_features", "union_slices", "dedupe_keep_first",
    "special_codes_tail", "nearest_pairs", "knn_classify", "stratified_split", "stratified_folds", "dummy_stratified", "sample_customers",
    "silhouette", "silhouette_euclidean", "calinski_harabasz", "assign_nearest_centre", "hard_vote", "class_metrics", "class_metrics_table",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_every_sql_statement_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    result = con.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = sorted(map(repr, result.fetchall()))
    df = entry_point.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == want and got


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
