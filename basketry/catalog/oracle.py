"""Independent SQL statements of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from basketry.schema import (
    BASKET_MEANS, CLUSTER_COLUMNS, CORE_COLUMNS, CUSTOMER_NUMERIC, FIRST_BASKET_COLUMNS, FLAGS,
    HORIZONS, MEASURES, PAIR_COLUMNS, SUMMARY_COLUMNS,
)

DIMS = 64


def rnd(expr: str, digits: int = 4) -> str:
    return f"round(({expr}) + 1e-{digits + 3}, {digits}) + 0.0"


def rcol(column: str, digits: int = 4, alias: str | None = None) -> str:
    return f"{rnd(column, digits)} AS {alias or column}"


# Shared table expressions: name -> body. ``sql`` prepends the ones a statement needs, in this order.
TABLES: dict[str, str] = {
    "raw": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS InvoiceNo,
               CASE WHEN l_discount >= CAST(0.095 AS DOUBLE) THEN 'D' WHEN l_tax >= CAST(0.075 AS DOUBLE) THEN 'POST'
                    WHEN l_linenumber = 7 THEN 'M' ELSE 'p' || CAST(p_partkey AS VARCHAR) END AS StockCode,
               p_name AS Description,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
               o_orderdate + to_minutes(o_orderkey % 1440) AS InvoiceDate,
               l_extendedprice / l_quantity AS UnitPrice,
               CASE WHEN o_custkey % 50 <> 7 THEN o_custkey END AS CustomerID,
               n_name AS Country
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "refday": "SELECT CAST(max(InvoiceDate) AS DATE) AS ref FROM raw",
    "rescued": """
        SELECT * REPLACE (CASE WHEN StockCode = 'D' THEN replace(InvoiceNo, 'C', 'D') ELSE InvoiceNo END AS InvoiceNo)
        FROM raw""",
    "cleaned": """
        SELECT InvoiceNo, upper(StockCode) AS StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID,
               Country, Quantity * UnitPrice AS Amount,
               CASE WHEN upper(StockCode) = 'D' THEN 1 ELSE 0 END AS Discount,
               CASE WHEN upper(StockCode) = 'POST' THEN 1 ELSE 0 END AS POST,
               CASE WHEN upper(StockCode) = 'M' THEN 1 ELSE 0 END AS Manual,
               CASE WHEN Country = 'NATION_7' THEN 1 ELSE 0 END AS Is_UK,
               CAST(year(InvoiceDate) AS VARCHAR) || '_' || CAST(month(InvoiceDate) AS VARCHAR) AS Year_Month
        FROM rescued
        WHERE CustomerID IS NOT NULL AND NOT coalesce(lower(InvoiceNo) LIKE 'c%', false)""",
    "limits": """
        SELECT quantile_cont(Amount, 0.99) AS a, quantile_cont(CAST(Quantity AS DOUBLE), 0.99) AS q,
               quantile_cont(UnitPrice, 0.99) AS u
        FROM cleaned""",
    "kept": "SELECT cleaned.* FROM cleaned, limits WHERE Amount < a AND Quantity < q AND UnitPrice < u",
    "bask": """
        SELECT CustomerID, InvoiceDate,
               min(UnitPrice) AS UnitPriceMin, max(UnitPrice) AS UnitPriceMax, avg(UnitPrice) AS UnitPriceMean,
               sum(Amount) AS AmountSum, min(Amount) AS AmountMin, max(Amount) AS AmountMax, avg(Amount) AS AmountMean,
               CAST(sum(Quantity) AS DOUBLE) AS QuantitySum, CAST(min(Quantity) AS DOUBLE) AS QuantityMin,
               CAST(max(Quantity) AS DOUBLE) AS QuantityMax, avg(Quantity) AS QuantityMean,
               CAST(sum(Discount) AS BIGINT) AS Discount, CAST(sum(POST) AS BIGINT) AS POST,
               CAST(sum(Manual) AS BIGINT) AS Manual, max(Is_UK) AS Is_UK,
               count(DISTINCT Description) + max(CASE WHEN Description IS NULL THEN 1 ELSE 0 END) AS Product_nb,
               row_number() OVER (PARTITION BY CustomerID ORDER BY InvoiceDate) AS Occurence,
               min(InvoiceDate) OVER (PARTITION BY CustomerID) AS First
        FROM kept GROUP BY CustomerID, InvoiceDate""",
    "timed": """
        SELECT *, CAST(floor(epoch(InvoiceDate - First) / 86400) AS INTEGER) AS Dist_first_trans FROM bask""",
    "rfm0": f"""
        SELECT CustomerID, max(InvoiceDate) AS InvoiceDate, arg_max(Is_UK, InvoiceDate) AS Is_UK,
               sum(AmountSum) AS Amount, arg_min(AmountSum, InvoiceDate) AS Amount_first, count(*) AS Frequency,
               {", ".join(f"avg({c}) AS {c}" for c in BASKET_MEANS)},
               {", ".join(f"CAST(sum({f}) AS BIGINT) AS {f}" for f in FLAGS)},
               CAST(abs(CAST(max(InvoiceDate) AS DATE) - (SELECT ref FROM refday)) AS INTEGER) AS Recency,
               CAST(abs(CAST(min(InvoiceDate) AS DATE) - (SELECT ref FROM refday)) AS INTEGER) AS Latency
        FROM bask GROUP BY CustomerID""",
    "rfm": """
        SELECT *, CASE WHEN trunc((Latency - Recency) / Frequency) = 0 THEN CAST(0 AS DOUBLE)
                       ELSE (Latency - Recency) / Frequency END AS MTBT,
               Amount / Frequency AS Amount_mean
        FROM rfm0""",
    "climits": """
        SELECT quantile_cont(CAST(Frequency AS DOUBLE), 0.99) AS f, quantile_cont(Amount, 0.99) AS a FROM rfm""",
    "cust": """
        SELECT rfm.*, CAST(CustomerID % 5 AS INTEGER) AS Label FROM rfm, climits WHERE Frequency < f AND Amount < a""",
    "scalestats": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CAST({c} AS DOUBLE)) AS mean, stddev_pop(CAST({c} AS DOUBLE)) AS std FROM cust"
        for c in CLUSTER_COLUMNS
    ),
    "scaled": f"""
        SELECT CustomerID, Label, {", ".join(
            f"coalesce((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) "
            f"/ nullif(stddev_pop(CAST({c} AS DOUBLE)) OVER (), 0), 0) AS {c}" for c in CLUSTER_COLUMNS)}
        FROM cust""",
    "firsts": """
        SELECT *, CAST(month(InvoiceDate) AS INTEGER) AS Month FROM bask WHERE Occurence = 1""",
    "steps": "SELECT CAST(unnest([" + ", ".join(map(str, HORIZONS)) + "]) AS INTEGER) AS horizon",
    "byhorizon": """
        SELECT horizon, CustomerID, count(*) AS Frequency, sum(AmountSum) AS TotalAmount,
               CAST(abs(CAST(min(First) AS DATE) - (SELECT ref FROM refday))
                    - abs(CAST(max(InvoiceDate) AS DATE) - (SELECT ref FROM refday)) AS INTEGER) AS Periode,
               CAST(abs(CAST(max(InvoiceDate) AS DATE) - (SELECT ref FROM refday)) AS INTEGER) AS Recency
        FROM timed JOIN steps ON Dist_first_trans < horizon GROUP BY horizon, CustomerID""",
    "split": """
        SELECT CustomerID, Label,
               row_number() OVER (PARTITION BY Label ORDER BY md5('42:' || CAST(CustomerID AS VARCHAR)), CustomerID) AS rn,
               count(*) OVER (PARTITION BY Label) AS size
        FROM cust""",
    "parted": "SELECT *, rn <= round(size * CAST(0.3 AS DOUBLE)) AS is_test FROM split",
    "vecs": """
        SELECT vec_id AS id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings""",
    "vsplit": """
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(id AS VARCHAR)), id)
                  <= round(count(*) OVER (PARTITION BY label) * CAST(0.3 AS DOUBLE)) AS is_test
        FROM vecs""",
    "cells": f"SELECT id, label, unnest(vec) AS x, unnest(range(1, {DIMS + 1})) AS dim FROM vecs",
    "vmeans": "SELECT label, dim, avg(x) AS m, count(*) AS n, sum(x) AS s FROM cells GROUP BY label, dim",
    "vdist": """
        SELECT id, vmeans.label AS c, sum((x - m) * (x - m)) AS d2, sum(abs(x - m)) AS d1
        FROM cells JOIN vmeans USING (dim) GROUP BY id, vmeans.label""",
    "vshares": """
        SELECT label, sum(count(*)) OVER (ORDER BY label) / CAST(sum(count(*)) OVER () AS DOUBLE) AS upto
        FROM vecs GROUP BY label""",
    "votes": """
        SELECT id, label,
               (SELECT c FROM vdist WHERE vdist.id = vecs.id ORDER BY d2, c LIMIT 1) AS pred_euclidean,
               (SELECT c FROM vdist WHERE vdist.id = vecs.id ORDER BY d1, c LIMIT 1) AS pred_manhattan,
               (SELECT min(vshares.label) FROM vshares
                WHERE CAST('0x' || substr(md5('42:' || CAST(vecs.id AS VARCHAR)), 1, 8) AS BIGINT)
                      / CAST(4294967296 AS DOUBLE) < upto) AS pred_drawn
        FROM vecs""",
    "voted": """
        SELECT *, CASE WHEN pred_euclidean = pred_manhattan OR pred_euclidean = pred_drawn THEN pred_euclidean WHEN pred_manhattan = pred_drawn THEN pred_manhattan
                       ELSE least(pred_euclidean, pred_manhattan, pred_drawn) END AS prediction
        FROM votes""",
    "conf": """
        SELECT a.label, b.label AS prediction,
               (SELECT count(*) FROM voted v WHERE v.label = a.label AND v.prediction = b.label) AS n
        FROM (SELECT CAST(unnest(range(10)) AS INTEGER) AS label) a,
             (SELECT CAST(unnest(range(10)) AS INTEGER) AS label) b""",
    "scores": """
        SELECT label AS class,
               coalesce(sum(CASE WHEN label = prediction THEN n END) / nullif(CAST(sum(n) AS DOUBLE), 0), 0) AS recall,
               coalesce(sum(CASE WHEN label = prediction THEN n END)
                        / nullif(CAST((SELECT sum(n) FROM conf p WHERE p.prediction = conf.label) AS DOUBLE), 0), 0)
                   AS precision
        FROM conf GROUP BY label""",
    "fscores": """
        SELECT class, CAST(recall AS DOUBLE) AS recall, CAST(precision AS DOUBLE) AS precision,
               CAST(coalesce(2 * recall * precision / nullif(recall + precision, 0), 0) AS DOUBLE) AS f1
        FROM scores""",
}


def sql(body: str, *needed: str) -> str:
    """``body`` with every shared table up to the last one needed that it can refer to."""
    wanted = set(needed)
    order = list(TABLES)
    for name in reversed(order):
        if name in wanted:
            words = set(TABLES[name].replace("(", " ").replace(")", " ").replace(".", " ").replace(",", " ").split())
            wanted |= {t for t in order[: order.index(name)] if t in words}
    ctes = ", ".join(f"{n} AS ({TABLES[n]})" for n in order if n in wanted)
    return f"WITH {ctes} {body}" if ctes else body


LINE = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", rcol("UnitPrice"), "CustomerID", "Country"]
CLEAN = [*LINE, rcol("Amount"), *FLAGS, "Is_UK", "Year_Month"]
FIRST = ["Is_UK", "Product_nb", *[rcol(c) for c in FIRST_BASKET_COLUMNS if c[-3:] in ("Min", "Max", "ean", "Sum")], *FLAGS]
CUSTOMER = [
    "CustomerID", "InvoiceDate", "Recency", "Is_UK", "Frequency", "Latency", *FLAGS,
    *[rcol(c) for c in ("Amount", "Amount_first", "MTBT", "Amount_mean", *BASKET_MEANS)],
]


def cols(items: list[str]) -> str:
    return ", ".join(items)


def describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {rnd(f"avg(CAST({c} AS DOUBLE))")} AS mean,
            {rnd(f"stddev_samp(CAST({c} AS DOUBLE))")} AS std, {rnd(f"min(CAST({c} AS DOUBLE))")} AS "min",
            {rnd(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)")} AS p25,
            {rnd(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)")} AS p50,
            {rnd(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)")} AS p75,
            {rnd(f"max(CAST({c} AS DOUBLE))")} AS "max" FROM {table}"""
        for c in columns
    )


def corr_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, {rnd(
            f"covar_samp(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)", 6)} AS r
            FROM cust"""
        for a, b in combinations(columns, 2)
    )


def bin_sql(x: str, lo: str, hi: str, bins: int) -> str:
    return (
        f"CAST(least(floor((CAST({x} AS DOUBLE) - CAST({lo} AS DOUBLE)) * {bins}.0 "
        f"/ nullif(CAST({hi} AS DOUBLE) - CAST({lo} AS DOUBLE), 0)), {bins - 1}) AS INTEGER)"
    )


def hist_sql(grain: str, table: str, x: str, bins: int) -> str:
    b = bin_sql(x, "lo", "hi", bins)
    return f"""SELECT '{grain}' AS grain, '{x}' AS "column", {b} AS bin, count(*) AS n
        FROM {table}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}) GROUP BY ALL"""


def pair_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS a, '{b}' AS b, {bin_sql(a, "lo_a", "hi_a", 10)} AS bin_a,
        {bin_sql(b, "lo_b", "hi_b", 10)} AS bin_b, count(*) AS n
        FROM cust, (SELECT min({a}) AS lo_a, max({a}) AS hi_a, min({b}) AS lo_b, max({b}) AS hi_b FROM cust) GROUP BY ALL"""


def pareto_sql(key: str) -> str:
    return f"""SELECT {key}, {rcol("Amount")},
        round(coalesce(position / nullif(max(position) OVER (), 0), 0) * 100, 1) AS Keys_pct,
        round(running / sum(Amount) OVER () * 100, 1) AS Revenue_pct
        FROM (SELECT {key}, Amount, row_number() OVER (ORDER BY Amount DESC, {key}) - 1 AS position,
                     sum(Amount) OVER (ORDER BY Amount DESC, {key} ROWS UNBOUNDED PRECEDING) AS running
              FROM (SELECT {key}, sum(Amount) AS Amount FROM kept GROUP BY {key}))"""


def knn_sql(k: int, distance: str, weighted: bool) -> str:
    score = (
        "count(*) FILTER (WHERE d = 0) AS e, sum(CASE WHEN d = 0 THEN 0 ELSE 1 / d END) AS w"
        if weighted else "0 AS e, count(*) AS w"
    )
    return f"""SELECT qid AS id, label AS prediction FROM (
          SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY e DESC, w DESC, label) AS place FROM (
            SELECT qid, label, {score} FROM (
              SELECT q.id AS qid, t.label, {distance} AS d,
                     row_number() OVER (PARTITION BY q.id ORDER BY {distance}, t.id) AS rn
              FROM vsplit q, vsplit t WHERE q.is_test AND NOT t.is_test) WHERE rn <= {k}
            GROUP BY qid, label)) WHERE place = 1"""


EUCLID = "sqrt(" + " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in CLUSTER_COLUMNS) + ")"
ORACLE: dict[str, str] = {}


def add(name: str, body: str, *needed: str) -> None:
    ORACLE[name] = sql(body, *needed)


add("src_transactions", f"SELECT {cols(LINE)} FROM raw", "raw")
add("src_csv_roundtrip", f"SELECT {cols(CLEAN)} FROM kept", "kept")
add("src_parse_ts", "SELECT InvoiceNo, StockCode, InvoiceDate FROM raw", "raw")
add("src_drop_index_col", f"SELECT {cols(LINE)} FROM raw", "raw")
add("sink_tables", f"SELECT {cols(CLEAN)} FROM kept", "kept")
add("sink_customers", f"SELECT {cols(CUSTOMER)}, Label FROM cust", "cust")
add("sink_prepared_lines", f"""
    SELECT {cols(["kept." + c if c in ("CustomerID", "InvoiceDate", *FLAGS, "Is_UK") else c for c in CLEAN])},
           Label, Occurence, Dist_first_trans
    FROM kept JOIN timed USING (CustomerID, InvoiceDate) JOIN (SELECT CustomerID, Label FROM cust) USING (CustomerID)
    """, "kept", "timed", "cust")
add("clean_rescue_discount", "SELECT InvoiceNo, StockCode, InvoiceDate, CustomerID FROM rescued", "rescued")
add("clean_drop_cancelled", """
    SELECT InvoiceNo, StockCode, InvoiceDate, CustomerID FROM rescued WHERE lower(substr(InvoiceNo, 1, 1)) <> 'c'
    """, "rescued")
add("clean_upper_code", "SELECT InvoiceNo, upper(StockCode) AS StockCode, Description FROM raw", "raw")
add("clean_cast_ints", "SELECT InvoiceNo, StockCode, Quantity, CustomerID FROM raw WHERE CustomerID IS NOT NULL", "raw")
add("clean_lines", f"SELECT {cols(CLEAN)} FROM cleaned", "cleaned")
add("feat_amount", f"""
    SELECT InvoiceNo, StockCode, Quantity, {rcol("UnitPrice")}, {rnd("Quantity * UnitPrice")} AS Amount FROM raw""", "raw")
add("feat_line_flags", """
    SELECT InvoiceNo, upper(StockCode) AS StockCode, CAST(StockCode = 'D' AS INTEGER) AS Discount,
           CAST(StockCode = 'POST' AS INTEGER) AS POST, CAST(StockCode = 'M' AS INTEGER) AS Manual FROM raw""", "raw")
add("feat_is_home", """
    SELECT InvoiceNo, StockCode, Country, CAST(Country = 'NATION_7' AS INTEGER) AS Is_UK FROM raw""", "raw")
add("feat_year_month", """
    SELECT InvoiceNo, InvoiceDate, strftime(InvoiceDate, '%Y_%-m') AS Year_Month FROM raw""", "raw")
add("split_year_month", """
    SELECT DISTINCT Year_Month, CAST(year(InvoiceDate) AS INTEGER) AS "Year", CAST(month(InvoiceDate) AS INTEGER) AS "Month"
    FROM cleaned""", "cleaned")
add("feat_month", "SELECT CustomerID, Month FROM firsts", "firsts")
add("feat_abs_days_to_ref", """
    SELECT InvoiceNo, InvoiceDate, CAST(abs(floor(epoch(InvoiceDate - CAST(ref AS TIMESTAMP)) / 86400)) AS INTEGER) AS Days
    FROM raw, refday""", "raw", "refday")
add("feat_elapsed_days", "SELECT CustomerID, InvoiceDate, Dist_first_trans FROM timed", "timed")
add("feat_mtbt", f"SELECT CustomerID, Latency, Recency, Frequency, {rcol('MTBT')} FROM rfm", "rfm")
add("feat_amount_mean", f"SELECT CustomerID, {rcol('Amount')}, Frequency, {rcol('Amount_mean')} FROM rfm", "rfm")
add("project_columns", f"""
    SELECT CustomerID, InvoiceDate AS LastPurchase, Recency, Is_UK, {rcol('Amount')} FROM rfm""", "rfm")
add("onehot_month", "SELECT CustomerID, " + ", ".join(
    f"CAST(Month = {m} AS INTEGER) AS Month_{m}" for m in range(1, 13)) + " FROM firsts", "firsts")
add("scale_fit", f"SELECT \"column\", {rcol('mean')}, {rcol('std')} FROM scalestats", "scalestats")
add("scale_apply", f"SELECT CustomerID, {cols([rcol(c) for c in CLUSTER_COLUMNS])} FROM scaled", "scaled")
add("filter_known_customer", f"SELECT {cols(LINE)} FROM raw WHERE CustomerID IS NOT NULL", "raw")
add("trim_lines_p99", f"SELECT {cols(CLEAN)} FROM kept", "kept")
add("trim_customers_p99", f"SELECT CustomerID, Frequency, {rcol('Amount')} FROM cust", "cust")
add("filter_positive_qty", f"""
    SELECT InvoiceNo, StockCode, CustomerID, Quantity, {rcol('UnitPrice')} FROM kept WHERE Quantity > 0""", "kept")
add("filter_labelled", """
    SELECT CustomerID, InvoiceNo, StockCode, Label FROM kept JOIN (SELECT CustomerID, Label FROM cust) USING (CustomerID)
    """, "kept", "cust")
add("filter_horizon", """
    SELECT CustomerID, InvoiceNo, StockCode, Dist_first_trans
    FROM kept JOIN timed USING (CustomerID, InvoiceDate) WHERE Dist_first_trans < 180""", "kept", "timed")
add("join_label_lookup", """
    SELECT CustomerID, InvoiceNo, StockCode, Label
    FROM kept LEFT JOIN (SELECT CustomerID, Label FROM cust) USING (CustomerID)""", "kept", "cust")
add("rfm_assemble", f"SELECT {cols(CUSTOMER)} FROM rfm", "rfm")
add("features_assemble", f"""
    SELECT CustomerID, Label, Month, {cols(FIRST)} FROM firsts JOIN (SELECT CustomerID, Label FROM cust) USING (CustomerID)
    """, "firsts", "cust")
add("features_unmatched", """
    SELECT DISTINCT CustomerID FROM raw
    WHERE CustomerID IS NOT NULL AND CustomerID NOT IN (SELECT CustomerID FROM cust)""", "raw", "cust")
add("extract_customers", """
    SELECT CustomerID, InvoiceNo, StockCode, Quantity FROM kept WHERE CustomerID IN (
        SELECT CustomerID FROM cust ORDER BY md5('42:' || CAST(CustomerID AS VARCHAR)), CustomerID LIMIT 100)
    """, "kept", "cust")
add("broadcast_scalar", f"""
    SELECT CustomerID, {rcol('Amount')}, {rnd('Amount / sum(Amount) OVER ()', 8)} AS Share
    FROM (SELECT CustomerID, sum(Amount) AS Amount FROM cleaned GROUP BY CustomerID)""", "cleaned")
add("horizon_theta_join", f"SELECT horizon, CustomerID, Frequency, {rcol('TotalAmount')} FROM byhorizon", "byhorizon")
add("nearest_pairs", f"""
    SELECT query_id, id, label, {rcol('distance')}, CAST(rn AS INTEGER) AS rank FROM (
        SELECT q.CustomerID AS query_id, t.CustomerID AS id, t.Label AS label, {EUCLID} AS distance,
               row_number() OVER (PARTITION BY q.CustomerID ORDER BY {EUCLID}, t.CustomerID) AS rn
        FROM (SELECT scaled.*, is_test FROM scaled JOIN parted USING (CustomerID)) q,
             (SELECT scaled.*, is_test FROM scaled JOIN parted USING (CustomerID)) t
        WHERE q.is_test AND NOT t.is_test) WHERE rn <= 5""", "scaled", "parted")
add("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM raw"
    for c in ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")
), "raw")
add("describe_numeric", describe_sql("cleaned", ["Quantity", "UnitPrice", "CustomerID", "Amount", *FLAGS]), "cleaned")
add("quantile_p99", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.99)')} AS quantile FROM cleaned"
    for c in MEASURES), "cleaned")
TABLES["bamount"] = "SELECT CustomerID, InvoiceDate, sum(Amount) AS Amount FROM kept GROUP BY CustomerID, InvoiceDate"
TABLES["bquantity"] = """
    SELECT CustomerID, InvoiceDate, CAST(sum(Quantity) AS BIGINT) AS Quantity FROM kept GROUP BY CustomerID, InvoiceDate"""
TABLES["bpositive"] = """
    SELECT CustomerID, InvoiceDate, CAST(sum(Quantity) AS BIGINT) AS Quantity FROM kept WHERE Quantity > 0
    GROUP BY CustomerID, InvoiceDate"""
add("basket_amount", f"SELECT CustomerID, InvoiceDate, {rcol('Amount')} FROM bamount", "bamount")
add("basket_amount_summary", describe_sql("bamount", ["Amount"]), "bamount")
add("basket_quantity", "SELECT CustomerID, InvoiceDate, Quantity FROM bquantity", "bquantity")
add("basket_quantity_summary", describe_sql("bquantity", ["Quantity"]), "bquantity")
add("basket_stats", f"""
    SELECT CustomerID, InvoiceDate, Is_UK, {cols(FLAGS)},
           {cols([rcol(c) for c in FIRST_BASKET_COLUMNS if c[-3:] in ("Min", "Max", "ean", "Sum")])} FROM bask""", "bask")
add("customer_basket_means", f"SELECT CustomerID, {cols([rcol(c) for c in BASKET_MEANS])} FROM rfm", "rfm")
add("customer_monetary", f"SELECT CustomerID, {rnd('sum(Amount)')} AS Amount FROM kept GROUP BY CustomerID", "kept")
add("customer_flag_sums", "SELECT CustomerID, " + ", ".join(
    f"CAST(sum({f}) AS BIGINT) AS {f}" for f in FLAGS) + " FROM kept GROUP BY CustomerID", "kept")
add("customer_frequency", """
    SELECT CustomerID, count(DISTINCT InvoiceDate) AS Frequency FROM kept GROUP BY CustomerID""", "kept")
add("product_count_first", "SELECT CustomerID, Product_nb FROM firsts", "firsts")
add("revenue_by_month", f"""
    SELECT Year_Month, {rnd('sum(Amount)', 2)} AS Amount, CAST(year(min(InvoiceDate)) AS INTEGER) AS "Year",
           CAST(month(min(InvoiceDate)) AS INTEGER) AS "Month" FROM kept GROUP BY Year_Month""", "kept")
add("revenue_total", f"SELECT {rnd('sum(Amount)', 2)} AS Revenue FROM kept", "kept")
SHARE = f"""
    SELECT Country, {rcol('Amount', 2)}, {rnd('round(Amount / sum(Amount) OVER (), 3) * 100')} AS Share
    FROM (SELECT Country, sum(Amount) AS Amount FROM kept GROUP BY Country)"""
add("revenue_share_by_country", SHARE, "kept")
add("distinct_countries", "SELECT count(DISTINCT coalesce(Country, '')) AS n FROM kept", "kept")
add("histogram", " UNION ALL ".join(
    [hist_sql("line", "kept", "UnitPrice", 10), hist_sql("basket", "bamount", "Amount", 30),
     hist_sql("positive", "bpositive", "Quantity", 30)]
    + [hist_sql("customer", "cust", c, 50) for c in SUMMARY_COLUMNS]), "kept", "bamount", "bpositive", "cust")
add("summary_rfm", describe_sql("cust", SUMMARY_COLUMNS), "cust")
add("corr_matrix_all", corr_sql(CUSTOMER_NUMERIC), "cust")
add("corr_matrix_core", corr_sql(CORE_COLUMNS), "cust")
add("pair_density", " UNION ALL ".join(
    pair_sql(a, b) for a, b in combinations_with_replacement(PAIR_COLUMNS, 2)), "cust")
add("segment_population", "SELECT Label, count(*) AS customers FROM cust GROUP BY Label", "cust")
WHOLE = ("Recency", "Is_UK", "Frequency", "Latency", *FLAGS)
add("segment_profile_sum", "SELECT Label, " + ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" if c in WHOLE else f"{rnd(f'sum({c})', 2)} AS {c}" for c in CUSTOMER_NUMERIC
) + " FROM cust GROUP BY Label", "cust")
add("segment_profile_mean", "SELECT Label, " + ", ".join(
    f"{rnd(f'avg({c})')} AS {c}" for c in CUSTOMER_NUMERIC) + " FROM cust GROUP BY Label", "cust")
add("customer_label", "SELECT CustomerID, Label FROM cust", "cust")
add("horizon_total_amount", f"SELECT CustomerID, {rcol('TotalAmount')} FROM byhorizon WHERE horizon = 180", "byhorizon")
add("horizon_frequency", "SELECT CustomerID, Frequency FROM byhorizon WHERE horizon = 180", "byhorizon")
add("basket_occurrence", """
    SELECT CustomerID, InvoiceDate, InvoiceNo, StockCode,
           dense_rank() OVER (PARTITION BY CustomerID ORDER BY InvoiceDate) AS Occurence FROM kept""", "kept")
add("dist_first_trans", """
    SELECT CustomerID, InvoiceDate, InvoiceNo, StockCode,
           CAST(floor(epoch(InvoiceDate - min(InvoiceDate) OVER (PARTITION BY CustomerID)) / 86400) AS INTEGER)
               AS Dist_first_trans FROM kept""", "kept")
add("amount_first", f"SELECT CustomerID, {rnd('AmountSum')} AS Amount_first FROM firsts", "firsts")
add("first_basket_features", f"SELECT CustomerID, Month, {cols(FIRST)} FROM firsts", "firsts")
add("recency", "SELECT CustomerID, InvoiceDate, Is_UK, Recency FROM rfm", "rfm")
add("latency", "SELECT CustomerID, Latency FROM rfm", "rfm")
add("first_row_month_home", "SELECT CustomerID, Month, Is_UK FROM firsts", "firsts")
add("horizon_recency", "SELECT CustomerID, Recency FROM byhorizon WHERE horizon = 180", "byhorizon")
add("horizon_periode", "SELECT CustomerID, Periode FROM byhorizon WHERE horizon = 180", "byhorizon")
add("pareto_customers", pareto_sql("CustomerID"), "kept")
add("pareto_products", pareto_sql("StockCode"), "kept")
add("preview", f"""
    SELECT CustomerID, Recency, {rcol('Amount')}, Frequency FROM rfm ORDER BY CustomerID LIMIT 5""", "rfm")
add("special_codes_tail", """
    SELECT DISTINCT StockCode, Description FROM cleaned ORDER BY StockCode DESC, Description DESC LIMIT 7""", "cleaned")
add("country_rank_skip_top", SHARE + " ORDER BY Amount DESC, Country OFFSET 1", "kept")
add("distinct_baskets", "SELECT DISTINCT CustomerID, InvoiceDate FROM kept", "kept")
add("dedupe_keep_first", f"""
    SELECT CustomerID, InvoiceDate, {rcol('Amount')} FROM bamount
    QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY InvoiceDate) = 1""", "bamount")
add("union_slices", f"""
    SELECT horizon, CustomerID, Frequency, {rcol('TotalAmount')} FROM byhorizon WHERE horizon IN (30, 360)""", "byhorizon")
TABLES["sizes"] = "SELECT label, count(*) AS n FROM vecs GROUP BY label"
TABLES["spread"] = """
    SELECT q.id, q.label, t.label AS c, sum(list_sum(list_transform(list_zip(q.vec, t.vec), lambda x: (x[1] - x[2]) ** 2))) AS d
    FROM vecs q, vecs t GROUP BY q.id, q.label, t.label"""
add("silhouette", f"""
    SELECT {rnd('avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)', 6)} AS score FROM (
        SELECT id, max(n) FILTER (WHERE c = spread.label) AS own_n,
               sum(d / (n - 1)) FILTER (WHERE c = spread.label) AS a, min(d / n) FILTER (WHERE c <> spread.label) AS b
        FROM spread JOIN sizes ON c = sizes.label GROUP BY id)""", "spread", "sizes")
TABLES["apart"] = """
    SELECT q.id, q.label, t.label AS c, sum(sqrt(list_sum(list_transform(list_zip(q.vec, t.vec), lambda x: (x[1] - x[2]) ** 2)))) AS d
    FROM vecs q, vecs t GROUP BY q.id, q.label, t.label"""
add("silhouette_euclidean", f"""
    SELECT {rnd('avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)', 6)} AS score FROM (
        SELECT id, max(n) FILTER (WHERE c = apart.label) AS own_n,
               sum(d / (n - 1)) FILTER (WHERE c = apart.label) AS a, min(d / n) FILTER (WHERE c <> apart.label) AS b
        FROM apart JOIN sizes ON c = sizes.label GROUP BY id)""", "apart", "sizes")
add("model_roundtrip", "SELECT count(*) AS customers, CAST(0 AS BIGINT) AS differences FROM cust", "cust")
add("calinski_harabasz", f"""
    SELECT {rnd("(b / (k - 1)) / (w / (n - k))")} AS score FROM
      (SELECT sum((x - m) * (x - m)) AS w, count(DISTINCT id) AS n, count(DISTINCT cells.label) AS k
       FROM cells JOIN vmeans ON cells.label = vmeans.label AND cells.dim = vmeans.dim),
      (SELECT sum(n * (m - g) * (m - g)) AS b FROM vmeans JOIN (SELECT dim, avg(x) AS g FROM cells GROUP BY dim) USING (dim))
    """, "cells", "vmeans")
add("assign_nearest_centre", """
    SELECT CustomerID, c AS centre FROM (
        SELECT q.CustomerID, t.c, row_number() OVER (PARTITION BY q.CustomerID ORDER BY """
    + " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in CLUSTER_COLUMNS)
    + """, t.c) AS rn FROM scaled q, (SELECT Label AS c, """
    + ", ".join(f"avg({c}) AS {c}" for c in CLUSTER_COLUMNS)
    + " FROM scaled GROUP BY Label) t) WHERE rn = 1", "scaled")
add("update_centres", f"SELECT label, CAST(dim - 1 AS INTEGER) AS dim, {rnd('m')} AS mean FROM vmeans", "vmeans")
add("stratified_split", "SELECT CustomerID, Label, is_test FROM parted", "parted")
add("stratified_folds", "SELECT CustomerID, Label, CAST(rn % 5 AS INTEGER) AS fold FROM split", "split")
TABLES["cshares"] = """
    SELECT Label, sum(count(*)) OVER (ORDER BY Label) / CAST(sum(count(*)) OVER () AS DOUBLE) AS upto
    FROM cust GROUP BY Label"""
add("dummy_stratified", """
    SELECT CustomerID, Label,
           (SELECT min(cshares.Label) FROM cshares
            WHERE CAST('0x' || substr(md5('42:' || CAST(cust.CustomerID AS VARCHAR)), 1, 8) AS BIGINT)
                  / CAST(4294967296 AS DOUBLE) < upto) AS prediction
    FROM cust""", "cust", "cshares")
add("sample_customers", """
    SELECT CustomerID FROM cust ORDER BY md5('42:' || CAST(CustomerID AS VARCHAR)), CustomerID LIMIT 500""", "cust")
add("knn_classify", knn_sql(5, "list_distance(q.vec, t.vec)", True), "vsplit")
add("knn_classify_uniform", knn_sql(
    10, "list_sum(list_transform(list_zip(q.vec, t.vec), lambda x: abs(x[1] - x[2])))", False), "vsplit")
add("hard_vote", "SELECT * FROM voted", "voted")
add("accuracy", f"SELECT {rnd('avg(CAST(label = prediction AS DOUBLE))', 6)} AS accuracy FROM voted", "voted")
add("confusion_matrix", "SELECT label, prediction, n FROM conf", "conf")
add("confusion_normalized", f"""
    SELECT label, prediction, n, {rnd('n / nullif(CAST(sum(n) OVER (PARTITION BY label) AS DOUBLE), 0)', 6)} AS share
    FROM conf""", "conf")
add("class_metrics", f"""
    SELECT class, {rcol('recall', 6)}, {rcol('precision', 6)}, {rcol('f1', 6)} FROM fscores""", "fscores")
add("class_metrics_table", " UNION ALL ".join(
    f"SELECT '{m}' AS score, " + ", ".join(
        f"{rnd(f'max(CASE WHEN class = {c} THEN {m} END)', 6)} AS class_{c}" for c in range(10)) + " FROM fscores"
    for m in ("recall", "precision", "f1")), "fscores")
FEATURES = f"""CustomerID, Label, Month, {cols(FIRST)}, horizon, byhorizon.Frequency, Periode, {rcol('TotalAmount')}
    FROM byhorizon JOIN firsts USING (CustomerID) JOIN (SELECT CustomerID, Label FROM cust) USING (CustomerID)"""
add("horizon_features", f"SELECT {FEATURES} WHERE horizon = 180".replace("horizon, byhorizon", "byhorizon", 1),
    "byhorizon", "firsts", "cust")
add("horizon_sweep_features", f"SELECT {FEATURES}", "byhorizon", "firsts", "cust")
