import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.operators import wide
from tidemart.operators.metrics import bin_sales, order_hour_amount, order_total_amount, share_by


def make_lines(spark, groups):
    """groups: {order: (total, [line amounts])}"""
    rows = [
        (o, i, Decimal(str(total)), Decimal(str(w)))
        for o, (total, ws) in groups.items()
        for i, w in enumerate(ws)
    ]
    return spark.createDataFrame(rows, "o bigint, i bigint, total decimal(18,2), w decimal(18,2)")


def expected(total, weights):
    """The definition, one group at a time, in whole cents."""
    cents = [round(Decimal(str(w)) * 100) for w in weights]
    amount, everything = round(Decimal(str(total)) * 100), sum(cents)
    parts = [amount * c // everything if everything else 0 for c in cents[:-1]]
    return [Decimal(p) / 100 for p in [*parts, amount - sum(parts)]]


def check(df, groups):
    got = {}
    for r in df.orderBy("o", "i").collect():
        got.setdefault(r.o, []).append(r.share)
    assert got == {o: expected(*g) for o, g in groups.items()}


CASES = {
    1: (10, [5]),
    2: (10, [0, 0, 0]),
    3: (100, [1, 1, 1]),
    4: ("0.01", [3, 3, 4]),
    5: (0, [1, 2]),
    6: ("9999999999999999.99", ["9999999999999999.99", "9999999999999999.98", "0.01"]),
}


def test_split_adds_up_to_the_cent(spark):
    df = make_lines(spark, CASES)
    check(wide.split_amount(df, "total", "w", "o", ["i"], "share"), CASES)


def test_split_of_random_groups(spark):
    rng = random.Random(5)
    groups = {
        o: (rng.randint(0, 10**7) / 100, [rng.randint(0, 10**6) / 100 for _ in range(rng.randint(1, 40))])
        for o in range(60)
    }
    df = make_lines(spark, groups)
    check(wide.split_amount(df, "total", "w", "o", ["i"], "share"), groups)


def test_split_of_repeated_lines_and_refunds(spark):
    """Copies of the last line share its place, and only one of them takes the rest."""
    df = make_lines(spark, {1: (10, [1, 1, 1]), 2: (-10, [1, 2]), 3: (10, [1])})
    df = df.unionByName(df.where("o = 1 and i = 2")).unionByName(df.where("o = 3"))
    got = {}
    for r in wide.split_amount(df, "total", "w", "o", ["i"], "share").collect():
        got.setdefault(r.o, []).append(r.share)
    assert sorted(got[1]) == [Decimal("2.50")] * 4
    assert sorted(got[2]) == [Decimal("-6.66"), Decimal("-3.34")]
    assert sorted(got[3]) == [Decimal("5.00")] * 2


def test_split_of_a_group_with_a_third_of_all_rows(spark):
    df = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 2000).alias("o"),
        F.col("id").alias("i"),
        F.lit("99.99").cast("decimal(18,2)").alias("total"),
        (F.col("id") % 7).cast("decimal(18,2)").alias("w"),
    )
    shares = wide.split_amount(df, "total", "w", "o", ["i"], "share")
    assert "Window" not in shares._jdf.queryExecution().executedPlan().toString()
    sums = shares.groupBy("o").agg(F.sum("share").alias("s"), F.count("*").alias("n"))
    assert sums.where("s <> 99.99").count() == 0
    assert sums.where("o = 0").first().n == 10_000 and shares.count() == 30_000


def sides(spark):
    orders = spark.createDataFrame(
        [(1, "s", 9, "2024-01-01", Decimal("5.00")), (2, "s", 9, "2024-01-01", Decimal("6.00"))],
        "id bigint, order_status string, user_id bigint, create_date string, final_total_amount decimal(18,2)",
    )
    details = spark.createDataFrame(
        [(11, 1, 7, "n", Decimal("5.00"), 2), (12, 3, 7, "n", Decimal("1.00"), 1)],
        "id bigint, order_id bigint, sku_id bigint, sku_name string, order_price decimal(18,2), sku_num bigint",
    )
    return orders, details


def test_missing_side_has_zero_numbers_and_null_text(spark):
    orders, details = sides(spark)
    rows = {(r.order_id, r.order_detail_id): r for r in wide.widen(orders, details, "full").collect()}
    assert set(rows) == {(1, 11), (2, 0), (0, 12)}
    no_line, no_order = rows[(2, 0)], rows[(0, 12)]
    assert no_line.sku_num == 0 and no_line.sku_price == 0 and no_line.sku_name is None
    assert no_order.user_id == 0 and no_order.dt is None and no_order.sku_num == 1
    assert len(wide.widen(orders, details).collect()) == 1
    assert {r.order_id for r in wide.widen(orders, details, "left").collect()} == {1, 2}
    assert [r.id for r in wide.orders_without_detail(orders, details).collect()] == [2]


def test_details_of_orders_of_any_size_are_sets(spark):
    lines = spark.range(2_500).select(
        F.col("id"), F.when(F.col("id") < 2_400, 1).otherwise(2).cast("bigint").alias("order_id")
    )
    sets = wide.collect_details(lines.unionByName(lines.limit(10)), ["id"])
    assert {r.order_id: r["count"] for r in sets.groupBy("order_id").count().collect()} == {1: 2400, 2: 100}


def test_amounts_of_a_day_and_shares(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "2024-01-01 05:10:00"), ("2024-01-01", "2024-01-01 05:20:00"), ("2024-01-02", "2024-01-02 23:00:00")],
        "dt string, create_time string",
    ).withColumn("final_detail_amount", F.lit("1.50").cast("decimal(18,2)"))
    assert str(order_total_amount(df, "2024-01-01").first().order_total_amount) == "3.00"
    assert float(order_total_amount(df, "2030-01-01").first().order_total_amount) == 0
    assert [(r.hr, str(r.order_amount)) for r in order_hour_amount(df, "2024-01-01").collect()] == [("05", "3.00")]
    shares = {r.dt: round(r.share, 6) for r in share_by(df, "dt").collect()}
    assert shares == {"2024-01-01": 0.666667, "2024-01-02": 0.333333}


def test_bins_are_open_at_the_top(spark):
    df = spark.createDataFrame([(0.0,), (99.9,), (100.0,), (550.0,), (10_000.0,)], "v double")
    assert sorted((r.bin, r.n) for r in bin_sales(df, "v").collect()) == [(0, 2), (1, 1), (5, 2)]
