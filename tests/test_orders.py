import pytest

from tidemart.functions.times import age_group, order_time_parts
from tidemart.operators import first_order
from tidemart.operators.dimensions import enrich, upsert_latest
from tidemart.sources.tables import previous_day


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, user_id bigint, create_time string")


def flags(df):
    return {r.id: r.if_first_order for r in df.collect()}


def test_earliest_order_is_first_and_ties_go_to_the_smaller_id(spark):
    df = orders(
        spark,
        (3, 1, "2024-01-01 10:00:00"),
        (2, 1, "2024-01-01 10:00:00"),
        (1, 1, "2024-01-01 11:00:00"),
        (4, 2, "2024-01-02 00:00:00"),
    )
    assert flags(first_order.first_order_flag(df)) == {1: "0", 2: "1", 3: "0", 4: "1"}


def test_user_with_state_has_no_first_order(spark):
    df = orders(spark, (1, 1, "2024-01-01 10:00:00"), (2, 2, "2024-01-01 10:00:00"))
    state = spark.createDataFrame([("1", "1"), ("2", "0")], "user_id string, if_consumed string")
    assert flags(first_order.first_order_flag(df, state)) == {1: "0", 2: "1"}
    joined = first_order.with_user_state(orders(spark, (1, 1, ""), (3, 3, "")), state)
    assert {r.user_id: r.if_consumed for r in joined.collect()} == {1: "1", 3: "0"}


def test_short_time_text_gives_null_parts(spark):
    df = order_time_parts(orders(spark, (1, 1, "2024-01-01"), (2, 1, "x"), (3, 1, "2024-01-01 07:08:09")))
    parts = {r.id: (r.create_date, r.create_hour) for r in df.collect()}
    assert parts == {1: ("2024-01-01", None), 2: ("x", None), 3: ("2024-01-01", "07")}


def test_age_groups_use_completed_years(spark):
    df = spark.createDataFrame(
        [("2004-06-15",), ("2004-06-16",), ("1993-06-16",), ("1993-06-15",), (None,)], "birthday string"
    )
    groups = [r.age_group for r in age_group(df, "birthday", "2024-06-15").collect()]
    assert groups == ["20-30岁", "20岁以下", "20-30岁", "30岁以上", None]


def test_previous_day():
    assert previous_day("2024-03-01") == "2024-02-29"
    with pytest.raises(ValueError):
        previous_day("yesterday")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("a", "old a"), ("b", "old b")], "id string, name string")


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, name string, version bigint, type string")


def test_newest_version_wins_within_and_across_batches(spark, dim):
    first = upsert_latest(
        dim, changes(spark, ("a", "a2", 2, "update"), ("a", "a1", 1, "insert"), ("c", "c1", 1, "insert")), ["id"], ["version"]
    )
    assert {r.id: r.name for r in first.collect()} == {"a": "a2", "b": "old b", "c": "c1"}
    # An older version that comes later changes nothing; the same batch again neither.
    second = upsert_latest(first, changes(spark, ("a", "a1", 1, "update"), ("a", "a2", 2, "update")), ["id"], ["version"])
    assert {r.id: r.name for r in second.collect()} == {"a": "a2", "b": "old b", "c": "c1"}


def test_deletes_upsert_by_default_and_remove_on_request(spark, dim):
    gone = changes(spark, ("a", "last a", 5, "delete"), ("b", "b1", 1, "delete"), ("b", "b2", 2, "insert"))
    kept = upsert_latest(dim, gone, ["id"], ["version"])
    assert {r.id: r.name for r in kept.collect()} == {"a": "last a", "b": "b2"}
    removed = upsert_latest(dim, gone, ["id"], ["version"], deletes="remove")
    assert {r.id: r.name for r in removed.collect()} == {"b": "b2"}
    with pytest.raises(ValueError):
        upsert_latest(dim, gone, ["id"], ["version"], deletes="maybe")


def test_enrich_keeps_every_fact_row_and_casts_keys(spark):
    fact = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id bigint, province_id bigint")
    dim = spark.createDataFrame([("7", "seven"), ("x", "bad key")], "id string, name string")
    rich = enrich(fact, dim, {"province_id": "id"}, {"name": "province_name"})
    assert {r.id: r.province_name for r in rich.collect()} == {1: "seven", 2: None, 3: None}
