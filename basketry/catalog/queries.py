"""Registered queries: one per operator, each over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.catalog.stage import HOME, Stage, tidy
from basketry.functions.columns import days_to_reference, year_month
from basketry.materialize import checkpointed, scratch_path
from basketry.operators import baskets as bk
from basketry.operators import classifiers as cf
from basketry.operators import cleaning as cl
from basketry.operators import clustering as ct
from basketry.operators import evaluation as ev
from basketry.operators import explore as ex
from basketry.operators import features as ft
from basketry.operators import neighbours as nb
from basketry.operators import sampling as sm
from basketry.operators.scaling import Scaler, one_hot_month
from basketry.plans import prediction, scoring
from basketry.schema import (
    BASKET_MEANS, CLEAN_LINES, CLUSTER_COLUMNS, CORE_COLUMNS, CUSTOMER_NUMERIC, CUSTOMERS, FIRST_BASKET_COLUMNS,
    FLAGS, HORIZON_COLUMNS, HORIZONS, MEASURES, MONTH_COLUMNS, PAIR_COLUMNS, PREPARED_LINES,
    SUMMARY_COLUMNS,
)
from basketry.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


#: What baskets and customers are made of; first baskets count descriptions as well.
BASKET_LINES = ("CustomerID", "InvoiceDate", *FLAGS, "Is_UK")
FIRST_LINES = (*BASKET_LINES, "Description")


def query(name: str, *columns: str):
    """Register a query; ``columns`` are those it uses of the clean lines, if not all."""

    def register(build: Callable[[Stage], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Stage(spark, folder, columns))
        return build

    return register


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


# Sources and sinks ------------------------------------------------------------------------------


@query("src_transactions")
def src_transactions(s: Stage):
    return tidy(s.raw)


@query("src_csv_roundtrip")
def src_csv_roundtrip(s: Stage):
    path = scratch_path(s.spark, "lines-csv")
    files.write_table(s.lines.select(*names(CLEAN_LINES)), path, "csv")
    return tidy(files.read_table(s.spark, path, CLEAN_LINES, "csv"))


@query("src_parse_ts")
def src_parse_ts(s: Stage):
    text = s.raw.select("InvoiceNo", "StockCode", F.col("InvoiceDate").cast("string"))
    return files.parse_timestamps(text, "InvoiceDate")


@query("src_drop_index_col")
def src_drop_index_col(s: Stage):
    saved = s.raw.withColumn("Unnamed: 0", F.monotonically_increasing_id())
    return tidy(files.drop_index_column(saved))


@query("sink_tables")
def sink_tables(s: Stage):
    path = scratch_path(s.spark, "lines")
    files.write_table(s.lines.select(*names(CLEAN_LINES)), path, partition_by="Year_Month")
    return tidy(files.read_table(s.spark, path, CLEAN_LINES))


@query("sink_customers", *BASKET_LINES)
def sink_customers(s: Stage):
    path = scratch_path(s.spark, "customers")
    files.write_table(s.segments, path)
    return tidy(files.read_table(s.spark, path, CUSTOMERS))


@query("sink_prepared_lines")
def sink_prepared_lines(s: Stage):
    path = scratch_path(s.spark, "prepared")
    prepared = bk.prepare_lines(s.lines, s.segments)
    files.write_table(prepared.select(*names(PREPARED_LINES)), path, partition_by="Year_Month")
    return tidy(files.read_table(s.spark, path, PREPARED_LINES))


# Cleaning and scalar columns --------------------------------------------------------------------


@query("clean_rescue_discount")
def clean_rescue_discount(s: Stage):
    return cl.rescue_discounts(s.raw).select("InvoiceNo", "StockCode", "InvoiceDate", "CustomerID")


@query("clean_drop_cancelled")
def clean_drop_cancelled(s: Stage):
    return cl.drop_cancelled(cl.rescue_discounts(s.raw)).select(
        "InvoiceNo", "StockCode", "InvoiceDate", "CustomerID"
    )


@query("clean_upper_code")
def clean_upper_code(s: Stage):
    return cl.upper_codes(s.raw).select("InvoiceNo", "StockCode", "Description")


@query("clean_cast_ints")
def clean_cast_ints(s: Stage):
    floats = cl.known_customers(s.raw).withColumns(
        {"Quantity": F.col("Quantity").cast("double"), "CustomerID": F.col("CustomerID").cast("double")}
    )
    return cl.cast_integers(floats).select("InvoiceNo", "StockCode", "Quantity", "CustomerID")


@query("clean_lines")
def clean_lines(s: Stage):
    return tidy(s.cleaned.select(*names(CLEAN_LINES)))


@query("feat_amount")
def feat_amount(s: Stage):
    return tidy(cl.add_amount(s.raw).select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "Amount"))


@query("feat_line_flags")
def feat_line_flags(s: Stage):
    return cl.add_line_flags(cl.upper_codes(s.raw)).select("InvoiceNo", "StockCode", *FLAGS)


@query("feat_is_home")
def feat_is_home(s: Stage):
    return cl.add_home_flag(s.raw, HOME).select("InvoiceNo", "StockCode", "Country", "Is_UK")


@query("feat_year_month")
def feat_year_month(s: Stage):
    return s.raw.select("InvoiceNo", "InvoiceDate", year_month(F.col("InvoiceDate")).alias("Year_Month"))


@query("split_year_month")
def split_year_month(s: Stage):
    return ex.revenue_by_month(s.cleaned).select("Year_Month", "Year", "Month")


@query("feat_month", "CustomerID", "InvoiceDate")
def feat_month(s: Stage):
    return s.lines.groupBy("CustomerID").agg(F.month(F.min("InvoiceDate")).alias("Month"))


@query("feat_abs_days_to_ref")
def feat_abs_days_to_ref(s: Stage):
    return s.raw.select(
        "InvoiceNo", "InvoiceDate", days_to_reference(F.col("InvoiceDate"), s.ref).alias("Days")
    )


@query("feat_elapsed_days", "CustomerID", "InvoiceDate")
def feat_elapsed_days(s: Stage):
    return bk.basket_timeline(bk.distinct_baskets(s.lines)).select("CustomerID", "InvoiceDate", "Dist_first_trans")


@query("feat_mtbt", *BASKET_LINES)
def feat_mtbt(s: Stage):
    return tidy(s.all_customers.select("CustomerID", "Latency", "Recency", "Frequency", "MTBT"))


@query("feat_amount_mean", *BASKET_LINES)
def feat_amount_mean(s: Stage):
    return tidy(s.all_customers.select("CustomerID", "Amount", "Frequency", "Amount_mean"))


@query("project_columns", *BASKET_LINES)
def project_columns(s: Stage):
    return tidy(
        s.all_customers.drop(*BASKET_MEANS, *FLAGS)
        .withColumnRenamed("InvoiceDate", "LastPurchase")
        .select("CustomerID", "LastPurchase", "Recency", "Is_UK", "Amount")
    )


@query("onehot_month", "CustomerID", "InvoiceDate")
def onehot_month(s: Stage):
    return one_hot_month(feat_month(s))


@query("scale_fit", *BASKET_LINES)
def scale_fit(s: Stage):
    return tidy(Scaler.fit(s.customers, CLUSTER_COLUMNS).to_frame(s.spark))


@query("scale_apply", *BASKET_LINES)
def scale_apply(s: Stage):
    scaler = Scaler.fit(s.customers, CLUSTER_COLUMNS)
    return tidy(scaler.apply(s.customers.select("CustomerID", *CLUSTER_COLUMNS)))


# Filters ----------------------------------------------------------------------------------------


@query("filter_known_customer")
def filter_known_customer(s: Stage):
    return tidy(cl.known_customers(s.raw))


@query("trim_lines_p99")
def trim_lines_p99(s: Stage):
    return tidy(s.lines.select(*names(CLEAN_LINES)))


@query("trim_customers_p99", *BASKET_LINES)
def trim_customers_p99(s: Stage):
    return tidy(s.customers.select("CustomerID", "Frequency", "Amount"))


@query("filter_positive_qty", "InvoiceNo", "StockCode", "CustomerID")
def filter_positive_qty(s: Stage):
    return tidy(cl.positive_quantities(s.lines).select("InvoiceNo", "StockCode", "CustomerID", "Quantity", "UnitPrice"))


@query("filter_labelled", *BASKET_LINES, "InvoiceNo", "StockCode")
def filter_labelled(s: Stage):
    return ft.labelled_only(s.lines, s.segments).select("CustomerID", "InvoiceNo", "StockCode", "Label")


@query("filter_horizon", "CustomerID", "InvoiceDate", "InvoiceNo", "StockCode")
def filter_horizon(s: Stage):
    return bk.prepare_lines(s.lines).where(F.col("Dist_first_trans") < 180).select(
        "CustomerID", "InvoiceNo", "StockCode", "Dist_first_trans"
    )


# Joins ------------------------------------------------------------------------------------------


@query("join_label_lookup", *BASKET_LINES, "InvoiceNo", "StockCode")
def join_label_lookup(s: Stage):
    return ft.attach_labels(s.lines, s.segments).select("CustomerID", "InvoiceNo", "StockCode", "Label")


@query("rfm_assemble", *BASKET_LINES)
def rfm_assemble(s: Stage):
    return tidy(s.all_customers)


@query("features_assemble", *FIRST_LINES)
def features_assemble(s: Stage):
    features = ft.first_basket_features(s.lines)
    return tidy(ft.assemble_features(features, s.segments.select("CustomerID", "Label")))


@query("features_unmatched", *BASKET_LINES)
def features_unmatched(s: Stage):
    listed = cl.known_customers(s.raw).select("CustomerID").distinct()
    return ft.unmatched_customers(s.customers, listed)


@query("extract_customers", *BASKET_LINES, "InvoiceNo", "StockCode")
def extract_customers(s: Stage):
    chosen = sm.sample_rows(s.customers.select("CustomerID"), "CustomerID", 100)
    return ft.extract_customers(s.lines, chosen).select("CustomerID", "InvoiceNo", "StockCode", "Quantity")


@query("broadcast_scalar")
def broadcast_scalar(s: Stage):
    whole = ex.revenue_total(s.cleaned).scalar()
    part = s.cleaned.groupBy("CustomerID").agg(bk.total("Amount").alias("Amount"))
    return tidy(part.withColumn("Share", F.try_divide("Amount", whole)), Share=8)


@query("horizon_theta_join", *FIRST_LINES)
def horizon_theta_join(s: Stage):
    return tidy(
        ft.horizon_features(s.lines, HORIZONS, s.ref).select("horizon", "CustomerID", "Frequency", "TotalAmount")
    )


@query("nearest_pairs", *BASKET_LINES)
def nearest_pairs(s: Stage):
    scaler = Scaler.fit(s.customers, CLUSTER_COLUMNS)
    split = checkpointed(sm.stratified_split(s.segments, "CustomerID"))
    rows = split.select(
        F.col("CustomerID").alias("id"), F.col("Label").alias("label"),
        F.array(*ct.scaled_columns(CLUSTER_COLUMNS, scaler)).alias("vec"), "is_test",
    )
    near = nb.nearest(rows.where(~F.col("is_test")), rows.where(F.col("is_test")), 5)
    return tidy(near.select("query_id", "id", "label", "distance", "rank"))


# Aggregates -------------------------------------------------------------------------------------


@query("null_counts")
def null_counts(s: Stage):
    return ex.null_counts(s.raw)


@query("describe_numeric")
def describe_numeric(s: Stage):
    columns = ["Quantity", "UnitPrice", "CustomerID", "Amount", *FLAGS]
    return tidy(ex.describe(s.stored_lines(*columns), columns))


@query("quantile_p99")
def quantile_p99(s: Stage):
    return tidy(ex.quantile_table(s.stored_lines(*MEASURES), MEASURES))


@query("basket_amount", "CustomerID", "InvoiceDate")
def basket_amount(s: Stage):
    return tidy(ex.basket_sums(s.lines, "Amount"))


@query("basket_amount_summary", "CustomerID", "InvoiceDate")
def basket_amount_summary(s: Stage):
    return tidy(ex.describe(checkpointed(ex.basket_sums(s.lines, "Amount")), ["Amount"]))


@query("basket_quantity", "CustomerID", "InvoiceDate")
def basket_quantity(s: Stage):
    return ex.basket_sums(s.lines, "Quantity")


@query("basket_quantity_summary", "CustomerID", "InvoiceDate")
def basket_quantity_summary(s: Stage):
    return tidy(ex.describe(checkpointed(ex.basket_sums(s.lines, "Quantity")), ["Quantity"]))


@query("basket_stats", *BASKET_LINES)
def basket_stats(s: Stage):
    return tidy(s.baskets)


@query("customer_basket_means", *BASKET_LINES)
def customer_basket_means(s: Stage):
    return tidy(s.all_customers.select("CustomerID", *BASKET_MEANS))


@query("customer_monetary", *BASKET_LINES)
def customer_monetary(s: Stage):
    return tidy(s.all_customers.select("CustomerID", "Amount"))


@query("customer_flag_sums", *BASKET_LINES)
def customer_flag_sums(s: Stage):
    return s.all_customers.select("CustomerID", *FLAGS)


@query("customer_frequency", "CustomerID", "InvoiceDate")
def customer_frequency(s: Stage):
    return bk.distinct_baskets(s.lines).groupBy("CustomerID").agg(F.count(F.lit(1)).alias("Frequency"))


@query("product_count_first", *FIRST_LINES)
def product_count_first(s: Stage):
    return ft.first_basket_features(s.lines).select("CustomerID", "Product_nb")


@query("revenue_by_month", "Year_Month")
def revenue_by_month(s: Stage):
    return tidy(ex.revenue_by_month(s.lines), 2)


@query("revenue_total", "Year_Month")
def revenue_total(s: Stage):
    return tidy(ex.revenue_total(s.lines), 2)


@query("revenue_share_by_country", "Country")
def revenue_share_by_country(s: Stage):
    return tidy(ex.revenue_share(s.lines), Amount=2)


@query("distinct_countries", "Country")
def distinct_countries(s: Stage):
    return ex.distinct_values(s.lines, "Country")


@query("histogram", *BASKET_LINES)
def histogram(s: Stage):
    per_line = ex.histogram(s.lines, {"UnitPrice": 10})
    per_basket = ex.histogram(checkpointed(ex.basket_sums(s.lines, "Amount")), {"Amount": 30})
    positive = ex.histogram(
        checkpointed(ex.basket_sums(cl.positive_quantities(s.lines), "Quantity")), {"Quantity": 30}
    )
    per_customer = ex.histogram(s.customers, {c: 50 for c in SUMMARY_COLUMNS})
    parts = {"line": per_line, "basket": per_basket, "positive": positive, "customer": per_customer}
    out = None
    for grain, part in parts.items():
        part = part.withColumn("grain", F.lit(grain))
        out = part if out is None else out.unionByName(part)
    return out


@query("summary_rfm", *BASKET_LINES)
def summary_rfm(s: Stage):
    return tidy(ex.describe(s.customers, SUMMARY_COLUMNS))


@query("corr_matrix_all", *BASKET_LINES)
def corr_matrix_all(s: Stage):
    return tidy(ex.correlations(s.customers, CUSTOMER_NUMERIC), 6)


@query("corr_matrix_core", *BASKET_LINES)
def corr_matrix_core(s: Stage):
    return tidy(ex.correlations(s.customers, CORE_COLUMNS), 6)


@query("pair_density", *BASKET_LINES)
def pair_density(s: Stage):
    return ex.pair_density(s.customers, PAIR_COLUMNS)


@query("segment_population", *BASKET_LINES)
def segment_population(s: Stage):
    return ct.segment_population(s.segments)


@query("segment_profile_sum", *BASKET_LINES)
def segment_profile_sum(s: Stage):
    return tidy(ct.segment_sums(s.segments, CUSTOMER_NUMERIC), 2)


@query("segment_profile_mean", *BASKET_LINES)
def segment_profile_mean(s: Stage):
    return tidy(ct.segment_means(s.segments, CUSTOMER_NUMERIC))


@query("customer_label", *BASKET_LINES)
def customer_label(s: Stage):
    return ft.customer_label(ft.labelled_only(s.lines, s.segments))


@query("horizon_total_amount", *FIRST_LINES)
def horizon_total_amount(s: Stage):
    return tidy(ft.horizon_features(s.lines, [180], s.ref).select("CustomerID", "TotalAmount"))


@query("horizon_frequency", *FIRST_LINES)
def horizon_frequency(s: Stage):
    return ft.horizon_features(s.lines, [180], s.ref).select("CustomerID", "Frequency")


# Windows and first / last rows ------------------------------------------------------------------


@query("basket_occurrence", "CustomerID", "InvoiceDate", "InvoiceNo", "StockCode")
def basket_occurrence(s: Stage):
    return bk.prepare_lines(s.lines).select("CustomerID", "InvoiceDate", "InvoiceNo", "StockCode", "Occurence")


@query("dist_first_trans", "CustomerID", "InvoiceDate", "InvoiceNo", "StockCode")
def dist_first_trans(s: Stage):
    return bk.prepare_lines(s.lines).select("CustomerID", "InvoiceDate", "InvoiceNo", "StockCode", "Dist_first_trans")


@query("amount_first", *BASKET_LINES)
def amount_first(s: Stage):
    return tidy(s.all_customers.select("CustomerID", "Amount_first"))


@query("first_basket_features", *FIRST_LINES)
def first_basket_features(s: Stage):
    return tidy(ft.first_basket_features(s.lines))


@query("recency", *BASKET_LINES)
def recency(s: Stage):
    return s.all_customers.select("CustomerID", "InvoiceDate", "Is_UK", "Recency")


@query("latency", *BASKET_LINES)
def latency(s: Stage):
    return s.all_customers.select("CustomerID", "Latency")


@query("first_row_month_home", *FIRST_LINES)
def first_row_month_home(s: Stage):
    return ft.first_basket_features(s.lines).select("CustomerID", "Month", "Is_UK")


@query("horizon_recency", *FIRST_LINES)
def horizon_recency(s: Stage):
    latencies = s.all_customers.select("CustomerID", "Latency")
    period = ft.horizon_features(s.lines, [180], s.ref).select("CustomerID", "Periode")
    return period.join(latencies, "CustomerID").select(
        "CustomerID", (F.col("Latency") - F.col("Periode")).alias("Recency")
    )


@query("horizon_periode", *FIRST_LINES)
def horizon_periode(s: Stage):
    return ft.horizon_features(s.lines, [180], s.ref).select("CustomerID", "Periode")


@query("pareto_customers", "CustomerID")
def pareto_customers(s: Stage):
    return tidy(ex.pareto(s.lines, "CustomerID"), Keys_pct=1, Revenue_pct=1)


@query("pareto_products", "StockCode")
def pareto_products(s: Stage):
    return tidy(ex.pareto(s.lines, "StockCode"), Keys_pct=1, Revenue_pct=1)


# Sorts, limits, sets ----------------------------------------------------------------------------


@query("preview", *BASKET_LINES)
def preview(s: Stage):
    return tidy(ex.preview(s.all_customers, ["CustomerID"]).select("CustomerID", "Recency", "Amount", "Frequency"))


@query("special_codes_tail")
def special_codes_tail(s: Stage):
    return ex.special_codes(s.cleaned)


@query("country_rank_skip_top", "Country")
def country_rank_skip_top(s: Stage):
    return tidy(ex.revenue_share(s.lines).offset(1), Amount=2)


@query("distinct_baskets", "CustomerID", "InvoiceDate")
def distinct_baskets(s: Stage):
    return bk.distinct_baskets(s.lines)


@query("dedupe_keep_first", "CustomerID", "InvoiceDate")
def dedupe_keep_first(s: Stage):
    return tidy(
        bk.keep_first(ex.basket_sums(s.lines, "Amount"), ["CustomerID"], [F.asc("InvoiceDate")])
    )


@query("union_slices", *FIRST_LINES)
def union_slices(s: Stage):
    early = ft.horizon_features(s.lines, [30], s.ref)
    late = ft.horizon_features(s.lines, [360], s.ref)
    return tidy(early.unionByName(late).select("horizon", "CustomerID", "Frequency", "TotalAmount"))


# Segmentation and scores ------------------------------------------------------------------------


@query("kmeans_segments", *BASKET_LINES)
def kmeans_segments(s: Stage):
    done = ct.segment(s.customers)
    return tidy(done.customers.select("CustomerID", *CLUSTER_COLUMNS, "Label"))


@query("kmeans_k_sweep", *BASKET_LINES)
def kmeans_k_sweep(s: Stage):
    return ct.k_sweep(s.customers)


@query("segment_tree", *BASKET_LINES)
def segment_tree(s: Stage):
    return ct.explain_segments(checkpointed(ct.segment(s.customers).customers))[1]


@query("silhouette")
def silhouette(s: Stage):
    return tidy(ct.silhouette(s.vectors, "vec", "label"), 6)


@query("silhouette_euclidean")
def silhouette_euclidean(s: Stage):
    return tidy(ct.euclidean_silhouette(s.vectors, "vec", "label"), 6)


@query("calinski_harabasz")
def calinski_harabasz(s: Stage):
    return tidy(ct.calinski_harabasz(s.vectors, "vec", "label"))


@query("assign_nearest_centre", *BASKET_LINES)
def assign_nearest_centre(s: Stage):
    scaler = Scaler.fit(s.customers, CLUSTER_COLUMNS)
    rows = s.segments.select(
        "CustomerID", "Label", F.array(*ct.scaled_columns(CLUSTER_COLUMNS, scaler)).alias("vec")
    )
    centres = {r["Label"]: r["mean"] for r in ct.group_means(rows, "vec", "Label").collect()}
    return ct.assign_nearest(rows, "vec", centres).select("CustomerID", "centre")


@query("update_centres")
def update_centres(s: Stage):
    means = ct.group_means(s.vectors, "vec", "label")
    return tidy(means.select("label", F.posexplode("mean").alias("dim", "mean")))


@query("stratified_split", *BASKET_LINES)
def stratified_split(s: Stage):
    return sm.stratified_split(s.segments.select("CustomerID", "Label"), "CustomerID")


@query("stratified_folds", *BASKET_LINES)
def stratified_folds(s: Stage):
    return sm.stratified_folds(s.segments.select("CustomerID", "Label"), "CustomerID")


@query("dummy_stratified", *BASKET_LINES)
def dummy_stratified(s: Stage):
    shares = sm.class_shares(s.segments)
    return sm.dummy_predict(s.segments.select("CustomerID", "Label"), shares, "CustomerID")


@query("sample_customers", *BASKET_LINES)
def sample_customers(s: Stage):
    return sm.sample_rows(s.customers.select("CustomerID"), "CustomerID", 500)


@query("knn_classify")
def knn_classify(s: Stage):
    rows = checkpointed(sm.stratified_split(s.vectors, "id", "label"))
    train, test = rows.where(~F.col("is_test")), rows.where(F.col("is_test"))
    return nb.knn_classify(train, test, 5, "distance", 2)


@query("knn_classify_uniform")
def knn_classify_uniform(s: Stage):
    rows = checkpointed(sm.stratified_split(s.vectors, "id", "label"))
    train, test = rows.where(~F.col("is_test")), rows.where(F.col("is_test"))
    return nb.knn_classify(train, test, 10, "uniform", 1)


def _votes(s: Stage) -> DataFrame:
    """Three simple predictions of the embedding label: nearest class mean (Euclidean and
    Manhattan) and a random draw from the class shares."""
    means = {r["label"]: r["mean"] for r in ct.group_means(s.vectors, "vec", "label").collect()}
    rows = ct.assign_nearest(s.vectors, "vec", means, 2, "pred_euclidean")
    rows = ct.assign_nearest(rows, "vec", means, 1, "pred_manhattan")
    drawn = sm.dummy_predict(rows, sm.class_shares(s.vectors, "label"), "id")
    return drawn.withColumnRenamed("prediction", "pred_drawn").drop("vec")


@query("hard_vote")
def hard_vote(s: Stage):
    return cf.hard_vote(_votes(s), ["pred_euclidean", "pred_manhattan", "pred_drawn"])


@query("accuracy")
def accuracy(s: Stage):
    return tidy(ev.accuracy(hard_vote(s), "label"), 6)


def _confusion(s: Stage) -> DataFrame:
    return ev.confusion_matrix(hard_vote(s), range(10), "label")


@query("confusion_matrix")
def confusion_matrix(s: Stage):
    return _confusion(s)


@query("confusion_normalized")
def confusion_normalized(s: Stage):
    return tidy(ev.normalised(_confusion(s)), 6)


@query("class_metrics")
def class_metrics(s: Stage):
    return tidy(ev.class_metrics(_confusion(s)), 6)


@query("class_metrics_table")
def class_metrics_table(s: Stage):
    return tidy(ev.metrics_table(ev.class_metrics(_confusion(s)), range(10)), 6)


# Fitted classifiers -----------------------------------------------------------------------------

#: The best published kind of setting of each voter, for queries that fit one model.
SETTINGS = {
    "gbt": [{"learning_rate": 0.1, "n_estimators": 100, "max_depth": 3}],
    "lr": [{"C": 1.0, "penalty": "l2"}],
    "svm": [{"C": 1.0, "penalty": "l2"}],
}
#: Whole linear grids; boosted trees at one setting (their own grid is a query of its own).
LINEAR_GRIDS = SETTINGS | {"lr": cf.LOGISTIC_GRID, "svm": cf.SVM_GRID}
#: For all horizons together: the whole logistic grid, the other voters at one setting.
HORIZON_GRIDS = SETTINGS | {"lr": cf.LOGISTIC_GRID}


def _segments(s: Stage) -> DataFrame:
    return checkpointed(ct.segment(s.customers).customers.select("CustomerID", "Label"))


def _split_features(s: Stage) -> tuple[DataFrame, DataFrame]:
    features = ft.assemble_features(ft.first_basket_features(s.lines), _segments(s))
    split = checkpointed(sm.stratified_split(one_hot_month(features), "CustomerID"))
    scaled = Scaler.fit(split, FIRST_BASKET_COLUMNS).apply(split)
    data = cf.model_input(scaled, [*FIRST_BASKET_COLUMNS, *MONTH_COLUMNS])
    return data.where(~F.col("is_test")), data.where(F.col("is_test"))


def _held_out(s: Stage, name: str) -> DataFrame:
    train, test = _split_features(s)
    model = cf.search_voter(name, cf.folded(train, 0), SETTINGS[name], 0)[0].models[0]
    return model.transform(test).select(
        "id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    )


@query("logreg_classify", *FIRST_LINES)
def logreg_classify(s: Stage):
    return _held_out(s, "lr")


@query("linear_svm_classify", *FIRST_LINES)
def linear_svm_classify(s: Stage):
    return _held_out(s, "svm")


@query("gbt_classify", *FIRST_LINES)
def gbt_classify(s: Stage):
    return _held_out(s, "gbt")


@query("cv_grid_search", *FIRST_LINES)
def cv_grid_search(s: Stage):
    train, _ = _split_features(s)
    return cf.grid_table(s.spark, "lr", cf.grid_search("lr", train, cf.LOGISTIC_GRID)[1])


@query("svm_grid_search", *FIRST_LINES)
def svm_grid_search(s: Stage):
    train, _ = _split_features(s)
    return cf.grid_table(s.spark, "svm", cf.grid_search("svm", train, cf.SVM_GRID)[1])


@query("gbt_grid_search", *FIRST_LINES)
def gbt_grid_search(s: Stage):
    train, _ = _split_features(s)
    return cf.grid_table(s.spark, "gbt", cf.grid_search("gbt", train, cf.BOOSTED_GRID)[1])


@query("knn_grid_search", *FIRST_LINES)
def knn_grid_search(s: Stage):
    train, _ = _split_features(s)
    return cf.grid_table(s.spark, "knn", cf.knn_grid_search(train)[1])


@query("first_purchase_model", *FIRST_LINES)
def first_purchase_model(s: Stage):
    return prediction.first_purchase_model(s.lines, _segments(s), grids=LINEAR_GRIDS).predictions


@query("horizon_features", *FIRST_LINES)
def horizon_features(s: Stage):
    return tidy(prediction.transform_extraction(s.lines, 180, s.segments.select("CustomerID", "Label"), s.ref))


@query("horizon_sweep_features", *FIRST_LINES)
def horizon_sweep_features(s: Stage):
    features = ft.horizon_features(s.lines, HORIZONS, s.ref)
    return tidy(ft.assemble_features(features, s.segments.select("CustomerID", "Label")))


@query("horizon_sweep", *FIRST_LINES)
def horizon_sweep(s: Stage):
    return prediction.horizon_sweep(
        s.lines, _segments(s), s.ref, classes=range(5), grids=HORIZON_GRIDS
    )


def _stored_model(s: Stage) -> tuple[DataFrame, str, prediction.Evaluation]:
    """Segments, the path of a stored model of 180 days, and the model itself."""
    segments = _segments(s)
    done = prediction.horizon_model(s.lines, segments, s.ref, 180, grids=LINEAR_GRIDS)
    path = scratch_path(s.spark, "models")
    scores = done.grid_scores.collect()  # one row per grid point
    cf.save_bundle(s.spark, path, 180, done.scaler, done.vote, [*HORIZON_COLUMNS, *MONTH_COLUMNS], scores)
    return segments, path, done


@query("model_persist", *FIRST_LINES)
def model_persist(s: Stage):
    segments, path, _ = _stored_model(s)
    return scoring.batch_score(s.lines, segments, s.ref, path, range(5), 180).predictions


@query("model_roundtrip", *FIRST_LINES)
def model_roundtrip(s: Stage):
    """Customers scored by the stored model, and how many of the held-out ones it scores unlike the model in memory."""
    segments, path, done = _stored_model(s)
    again = scoring.batch_score(s.lines, segments, s.ref, path, range(5), 180).predictions
    votes = ["pred_gbt", "pred_lr", "pred_svm", "prediction"]
    first = done.predictions.select("id", F.struct(*votes).alias("first"))
    unlike = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.struct(*votes))
    return again.join(first, "id", "left").agg(F.count(F.lit(1)).alias("customers"), F.count_if(unlike).alias("differences"))


@query("batch_score", *FIRST_LINES)
def batch_score(s: Stage):
    segments, path, _ = _stored_model(s)
    return scoring.batch_score(s.lines, segments, s.ref, path, range(5), 180, sample=300).metrics
