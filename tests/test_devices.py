from datetime import datetime, timezone

from tidemart.operators import devices
from tidemart.operators.metrics import hour_compare, hour_map, realtime_total


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def logs(spark, *rows):
    data = [(i, mid, "u" + mid, "1", "2", "3", ms(t)) for i, (mid, t) in enumerate(rows)]
    return spark.createDataFrame(
        data, "log_id bigint, mid string, uid string, ar string, ch string, vc string, ts bigint"
    )


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_device_counts_once_in_its_first_hour(spark):
    df = logs(
        spark,
        ("a", "2024-01-01T09:30:00"),
        ("a", "2024-01-01T08:05:00"),
        ("a", "2024-01-01T08:50:00"),
    )
    assert rows(devices.first_log_per_day(df), "mid", "dt", "hr", "mi") == [("a", "2024-01-01", "08", "05")]
    assert rows(devices.dau_hour_count(devices.device_days(df)), "hr", "n") == [("08", 1)]


def test_same_device_on_two_days_is_new_only_once(spark):
    df = logs(spark, ("a", "2024-01-01T01:00:00"), ("a", "2024-01-02T01:00:00"), ("b", "2024-01-02T02:00:00"))
    dau = devices.device_days(df)
    assert rows(devices.dau_total(dau), "dt", "n") == [("2024-01-01", 1), ("2024-01-02", 2)]
    assert rows(devices.new_mid_total(dau), "dt", "n") == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_equal_times_are_decided_by_the_log_id(spark):
    df = logs(spark, ("a", "2024-01-01T01:00:00"), ("a", "2024-01-01T01:00:00"))
    first = devices.first_log_per_day(df.withColumn("uid", df.log_id.cast("string")))
    assert rows(first, "uid") == [("0",)]


def test_empty_day_has_a_zero_total_and_24_zero_hours(spark):
    dau = devices.device_days(logs(spark, ("a", "2024-01-01T05:00:00")))
    assert rows(devices.dau_total(dau, "2030-01-01"), "dt", "n") == [("2030-01-01", 0)]
    filled = hour_compare(devices.dau_hour_count(dau), "n", "2024-01-01").collect()
    assert len(filled) == 24
    assert sum(r.today for r in filled) == 1 and sum(r.yesterday for r in filled) == 0
    after = hour_compare(devices.dau_hour_count(dau), "n", "2024-01-02").collect()
    assert sum(r.today for r in after) == 0
    assert [(r.hr, r.yesterday) for r in after if r.yesterday] == [("05", 1)]


def test_hours_add_up_to_the_total(spark):
    df = logs(spark, *[(str(i % 7), f"2024-01-0{1 + i % 3}T{i % 24:02d}:00:00") for i in range(60)])
    dau = devices.device_days(df)
    totals = dict(rows(devices.dau_total(dau), "dt", "n"))
    hours = {}
    for dt, n in devices.dau_hour_count(dau).select("dt", "n").collect():
        hours[dt] = hours.get(dt, 0) + n
    assert hours == totals
    maps = {r.dt: r.hours for r in hour_map(devices.dau_hour_count(dau), "n").collect()}
    assert {d: sum(m.values()) for d, m in maps.items()} == totals


def test_single_day_keeps_the_largest_hours_first(spark):
    df = logs(spark, ("a", "2024-01-01T03:00:00"), ("b", "2024-01-01T04:00:00"), ("c", "2024-01-01T04:10:00"))
    top = devices.dau_hour_count(devices.device_days(df), "2024-01-01").collect()
    assert [(r.hr, r.n) for r in top] == [("04", 2), ("03", 1)]


def test_cards_are_complete_even_for_an_empty_day(spark):
    dau = devices.device_days(logs(spark, ("a", "2024-01-01T05:00:00")))
    wide = spark.createDataFrame([("2024-01-01", "2024-01-01 05:00:00", 1)], "dt string, create_time string, x int")
    wide = wide.selectExpr("dt", "create_time", "cast(12.34 as decimal(18,2)) as final_detail_amount")
    cards = rows(realtime_total(dau, wide, "2024-01-01"), "id", "value")
    assert [(i, str(v)) for i, v in cards] == [("dau", "1.00"), ("new_mid", "1.00"), ("order_amount", "12.34")]
    empty = rows(realtime_total(dau, wide, "2030-01-01"), "id", "value")
    assert [(i, float(v)) for i, v in empty] == [("dau", 0), ("new_mid", 0), ("order_amount", 0)]
