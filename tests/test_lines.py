"""Cleaning, baskets and the customer table on small hand-made lines."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketry.operators import baskets as bk
from basketry.operators import cleaning as cl
from basketry.operators import features as ft
from basketry.operators.customers import customer_table
from basketry.schema import LINES

REF = date(2011, 12, 9)


def make(spark, *rows):
    """Rows of (invoice, code, description, quantity, time, price, customer)."""
    return spark.createDataFrame([(*r, "United Kingdom") for r in rows], LINES)


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M")


@pytest.fixture(scope="module")
def history(spark):
    return cl.clean(
        make(
            spark,
            ("1", "A", "a", 2, at("2011-01-01 10:00"), 1.0, 1),
            ("2", "B", None, 1, at("2011-01-01 10:00"), 3.0, 1),
            ("2", "B", None, 1, at("2011-01-01 10:00"), 3.0, 1),
            ("3", "A", "a", 1, at("2011-01-03 09:00"), 1.0, 1),
            ("4", "A", "a", 1, at("2011-01-31 10:00"), 1.0, 1),
            ("5", "M", "m", 5, at("2011-12-09 12:00"), 2.0, 2),
            ("6", "A", "a", 1, at("2011-12-08 10:00"), 2.0, 3),
        )
    )


def test_discount_credits_survive_cancellation(spark):
    t = at("2011-01-01 10:00")
    lines = make(spark, ("C1", "D", "d", -1, t, 1.0, 1), ("C2", "d", "d", -1, t, 1.0, 1), ("C3", "X", "x", 1, t, 1.0, 1))
    assert [r.InvoiceNo for r in cl.clean(lines).collect()] == ["D1"]


def test_null_invoice_and_code_are_kept(spark):
    lines = make(spark, (None, None, "x", 1, at("2011-01-01 10:00"), 1.0, 1), ("1", "A", "x", 1, at("2011-01-01 10:00"), 1.0, None))
    rows = cl.clean(lines).collect()
    assert len(rows) == 1
    assert (rows[0].Discount, rows[0].POST, rows[0].Manual) == (0, 0, 0)
    assert rows[0].Year_Month == "2011_1"


def test_a_cancelled_invoice_changes_nothing(spark, history):
    extra = make(spark, ("c9", "A", "a", 9, at("2011-02-01 10:00"), 9.0, 1))
    assert cl.clean(extra).count() == 0


def test_same_minute_invoices_are_one_basket(history):
    row = {r.CustomerID: r for r in customer_table(bk.baskets(history), REF).collect()}
    assert row[1].Frequency == 3
    assert row[1].Amount_first == 8.0
    assert row[1].Latency == 342 and row[1].Recency == 312
    assert row[2].Recency == 0 and row[3].Recency == 1
    assert row[2].Frequency == 1 and row[2].MTBT == 0.0
    assert row[1].MTBT == pytest.approx(10.0)
    assert row[1].UnitPriceMean == pytest.approx(((1 + 3 + 3) / 3 + 1 + 1) / 3)


def test_timeline_counts_elapsed_days(history):
    rows = bk.basket_timeline(bk.baskets(history)).where("CustomerID = 1").orderBy("InvoiceDate").collect()
    assert [(r.Occurence, r.Dist_first_trans) for r in rows] == [(1, 0), (2, 1), (3, 30)]


def test_product_count_treats_null_as_a_value(history):
    row = ft.first_basket_features(history).where("CustomerID = 1").first()
    assert row.Product_nb == 2 and row.Month == 1


def test_horizon_is_strict_and_everything_beyond_it_equals_full_history(history):
    rows = {
        (r.horizon, r.CustomerID): r
        for r in ft.horizon_features(history, [30, 31, 10_000], REF).collect()
    }
    assert rows[30, 1].Frequency == 2 and rows[31, 1].Frequency == 3
    assert rows[30, 1].Periode == 2
    assert rows[30, 2].Periode == 0
    full = {r.CustomerID: r for r in customer_table(bk.baskets(history), REF).collect()}
    for c, r in full.items():
        assert rows[10_000, c].Frequency == r.Frequency
        assert rows[10_000, c].TotalAmount == pytest.approx(r.Amount)
        assert rows[10_000, c].Periode == r.Latency - r.Recency


def test_horizon_features_send_wide_rows_only_once(history):
    plan = ft.horizon_features(history, [30, 60], REF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by(UnitPriceMean") == 0  # measures of later baskets are not carried to the customer


def test_horizon_features_without_dates_and_with_many_baskets(spark):
    t = at("2011-01-01 10:00")
    many = [(str(i), "A", f"p{i % 3}", 1, t + timedelta(days=i), 2.0, 1) for i in range(40)]
    lines = cl.clean(make(spark, *many, ("x", "A", "q", 1, None, 5.0, 3), ("z", "A", "q", 1, t, 5.0, 3), ("y", "A", "q", 1, None, 5.0, 2)))
    rows = {(r.horizon, r.CustomerID): r for r in ft.horizon_features(lines, [10, 100], REF).collect()}
    assert set(rows) == {(10, 1), (100, 1), (10, 3), (100, 3)}
    assert (rows[100, 3].Frequency, rows[100, 3].TotalAmount, rows[100, 3].Periode, rows[100, 3].AmountSum) == (0, 0.0, None, 5.0)
    assert (rows[10, 1].Frequency, rows[10, 1].TotalAmount, rows[100, 1].Frequency, rows[100, 1].TotalAmount) == (10, 20.0, 40, 80.0)
    assert rows[10, 1].Product_nb == 1 and rows[10, 1].AmountSum == 2.0


def test_partitioning_and_order_do_not_matter(history):
    once = sorted(map(tuple, customer_table(bk.baskets(history), REF).collect()))
    again = sorted(
        map(tuple, customer_table(bk.baskets(history.orderBy(F.rand(1)).repartition(5)), REF).collect())
    )
    assert once == again


def test_constant_quantity_is_trimmed_away(spark):
    t = at("2011-01-01 10:00")
    lines = cl.clean(make(spark, *[(str(i), "A", "a", 3, t, float(i), i) for i in range(20)]))
    assert cl.trim_lines(lines).count() == 0


def test_missing_customers_are_reported(spark, history):
    listed = spark.createDataFrame([(1,), (77,)], "CustomerID bigint")
    features = ft.first_basket_features(history)
    assert [r.CustomerID for r in ft.unmatched_customers(features, listed).collect()] == [77]
    assert ft.extract_customers(history, listed).count() == 5


def test_keep_first(history):
    rows = bk.keep_first(bk.distinct_baskets(history), ["CustomerID"], [F.desc("InvoiceDate")]).collect()
    assert {r.CustomerID: r.InvoiceDate for r in rows}[1] == at("2011-01-31 10:00")


def test_csv_and_partitioned_parquet_round_trip(spark, history, tmp_path):
    from basketry.schema import CLEAN_LINES
    from basketry.sources import files

    columns = [f.name for f in CLEAN_LINES.fields]
    want = sorted(map(str, history.select(*columns).collect()))
    files.write_table(history.select(*columns), f"{tmp_path}/c", "csv")
    files.write_table(history.select(*columns), f"{tmp_path}/p", partition_by="Year_Month")
    assert sorted(map(str, files.read_table(spark, f"{tmp_path}/c", CLEAN_LINES, "csv").collect())) == want
    assert sorted(map(str, files.read_table(spark, f"{tmp_path}/p", CLEAN_LINES).select(*columns).collect())) == want


def test_csv_is_read_by_name(spark, tmp_path):
    from pyspark.sql import types as T

    from basketry.sources.files import read_table

    schema = T.StructType.fromDDL("InvoiceNo string, Description string, InvoiceDate timestamp_ntz, CustomerID bigint, Quantity int")
    (tmp_path / "a.csv").write_text(
        'Unnamed: 0,Quantity,CustomerID,InvoiceNo,Description,InvoiceDate\n'
        '0,6,17850.0,536365,"A ""RED"" BOX, LARGE",2010-12-01 08:26:00\n'
        "1,-1,,C536379,,2010-12-01 09:41:00\n"
    )
    got = sorted(map(tuple, read_table(spark, str(tmp_path / "a.csv"), schema, "csv").collect()))
    assert got[0][0] == "536365" and got[0][1] == 'A "RED" BOX, LARGE' and got[0][3:] == (17850, 6)
    assert got[1][0] == "C536379" and got[1][1] is None and got[1][3:] == (None, -1)
    (tmp_path / "b.csv").write_text(",InvoiceNo,Description,InvoiceDate,CustomerID,Quantity\n0,1,x,2010-12-01 08:26:00,1,2\n")
    assert read_table(spark, str(tmp_path / "b.csv"), schema, "csv").count() == 1
    header = "InvoiceNo,Description,InvoiceDate,CustomerID,Quantity\n"
    for name, row in (("c", "1,x,2010-12-01 08:26:00,1,two"), ("d", "1,x,2010-12-01 08:26:00,1,2,3"), ("e", "1,x,2010-12-01 08:26:00,1.5,2")):
        path = tmp_path / f"{name}.csv"
        path.write_text(header + row + "\n")
        with pytest.raises(ValueError, match="malformed"):
            read_table(spark, str(path), schema, "csv")
        assert read_table(spark, str(path), schema, "csv", allow_malformed=True).count() == 1
    (tmp_path / "f.csv").write_text("InvoiceNo,Quantity\n1,2\n")
    with pytest.raises(ValueError, match="no column"):
        read_table(spark, str(tmp_path / "f.csv"), schema, "csv")


def test_lines_of_listed_customers_are_shuffled_once(spark):
    rows = [(c, f"2020-01-{1 + (3 * i) % 28:02d} 10:00:00", f"p{i}") for c in (1, 2, 3) for i in range(12)]
    lines = spark.createDataFrame(rows, "CustomerID bigint, t string, Description string").selectExpr(
        "CustomerID", "cast(t as timestamp_ntz) InvoiceDate", "Description"
    )
    segments = spark.createDataFrame([(1, 0), (3, 4), (3, 5), (9, 1)], "CustomerID bigint, Label int")
    columns = ["CustomerID", "InvoiceDate", "Description", "Label", "Occurence", "Dist_first_trans"]
    got = bk.prepare_lines(lines, segments).select(*columns)
    apart = bk.prepare_lines(lines.join(segments, "CustomerID")).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, apart.collect())) and got.count() == 36
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # Only the join with the baskets' marks moves the lines: what is below an exchange shows their columns.
        plan = bk.prepare_lines(lines, segments).select(*columns)._jdf.queryExecution().executedPlan().toString().splitlines()
        wide = [i for i, x in enumerate(plan) if "Exchange hashpartitioning" in x and "Description" in " ".join(plan[i + 1 : i + 2])]
        assert len(wide) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
