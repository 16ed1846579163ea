import json

from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.text import highlight, mask_cols, parse_json, raw_elements, to_json_rows
from tidemart.operators.routing import change_records, route_app_log, route_cdc
from tidemart.operators.search import search_page
from tidemart.sources.tables import sql_to_json_rows
from tidemart.sources.topics import kafka_options


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_start_logs_and_event_logs(spark):
    lines = [
        '{"ts":1}',
        '{"start":null,"ts":2}',
        '{"start":"","ts":3}',
        '{"start":{"entry":"icon"},"ts":4}',
        '{"start":"x","ts":5}',
    ]
    topics = {json.loads(r.value)["ts"]: r.topic for r in route_app_log(text(spark, *lines)).collect()}
    assert topics == {1: "EVENT_LOG", 2: "EVENT_LOG", 3: "EVENT_LOG", 4: "START_LOG", 5: "START_LOG"}


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "table string, type string, data string")


def test_object_payloads(spark):
    df = records(
        spark,
        ("order_info", "insert", '{"id":1}'),
        ("order_info", "update", '{"id":2}'),
        ("order_detail", "insert", '{"id":3}'),
        ("user_info", "delete", '{"id":4}'),
        ("user_info", "insert", "{}"),
        ("user_info", "insert", None),
        ("cart_info", "insert", '{"id":5}'),
        ("order_info", "INSERT", '{"id":6}'),
    )
    got = sorted((r.topic, r.value) for r in route_cdc(df, "object").collect())
    assert got == [
        ("ODS_ORDER_DETAIL", '{"id":3}'),
        ("ODS_ORDER_INFO", '{"id":1}'),
        ("ODS_USER_INFO", '{"id":4}'),
    ]


def test_array_payloads_give_one_row_per_element(spark):
    df = records(
        spark,
        ("order_info", "INSERT", '[{"id":1,"a":1.20},{"id":2,"s":"}, {"}]'),
        ("order_info", "UPDATE", '[{"id":3}]'),
        ("user_info", "INSERT", '[{"id":4}]'),
        ("order_detail", "INSERT", "[]"),
    )
    got = sorted((r.topic, r.value) for r in route_cdc(df, "array").collect())
    assert got == [("ODS_ORDER_INFO", '{"id":1,"a":1.20}'), ("ODS_ORDER_INFO", '{"id":2,"s":"}, {"}')]


def test_payload_text_is_not_rewritten(spark):
    payload = '{"id":1, "amount":304340.20,"big":12345678901234567890.123456789,"s":"\\"data\\": {","n":{"x":1.0}}'
    line = '{"table":"order_info","type":"insert","note":"\\"data\\":{}","data":' + payload + ',"old":{"data":"x"}}'
    row = change_records(text(spark, line)).first()
    assert (row.table, row.type, row.data) == ("order_info", "insert", payload)
    array = '{"table":"order_info","type":"INSERT","data":[{"a":1.10}, {"a":2.20}]}'
    assert change_records(text(spark, array)).first().data == '[{"a":1.10}, {"a":2.20}]'


def test_payloads_of_any_depth_are_not_rewritten(spark):
    deep = '{"x": 1.20, "s":"}]\\"{"}'
    for level in range(10):
        deep = '{"l%d": [%s , 12345678901234567890.123456789]}' % (level, deep)
    line = '{"table":"t","note":{"data":{"a":1}},"type":"insert", "data" : ' + deep + ',"old":{"data":"x"}}'
    assert change_records(text(spark, line)).first().data == deep
    array = f"[{deep}, {deep} ,3]"
    line = '{"table":"t","type":"insert","data":' + array + "}"
    assert change_records(text(spark, line)).first().data == array
    got = text(spark, array).select(raw_elements(F.col("value")).alias("e")).first().e
    assert got == [deep, deep, "3"]


def test_plain_elements_are_the_parsed_json(spark):
    df = spark.createDataFrame([("[1,2]",), ("oops",), (None,), ("[]",), ('["a,b"]',)], "v string")
    got = [r.e for r in df.select(raw_elements(F.col("v")).alias("e")).collect()]
    assert got[0] == ["1", "2"] and not got[1] and not got[2] and got[3] == [] and got[4] == ["a,b"]


def test_malformed_json_goes_to_the_rejects(spark):
    df = text(spark, '{"id":1,"user_id":2,"final_total_amount":3.5}', "{oops", None)
    good, bad = parse_json(df, schemas.ORDER_INFO)
    assert [(r.id, r.user_id, str(r.final_total_amount)) for r in good.collect()] == [(1, 2, "3.50")]
    assert sorted(str(r.value) for r in bad.collect()) == ["None", "{oops"]


def test_json_rows_leave_nulls_out(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [r.value for r in to_json_rows(df).collect()] == ['{"a":1}', '{"a":2,"b":"x"}']
    df.createOrReplaceTempView("json_rows")
    got = sql_to_json_rows(spark, "SELECT b, a + 1 AS c FROM json_rows ORDER BY a").collect()
    assert [r.json for r in got] == ['{"c":2}', '{"b":"x","c":3}']


def test_mask_and_highlight(spark):
    df = spark.createDataFrame([("Ann 42", "a.b A.B axb")], "name string, note string")
    assert mask_cols(df, ["name"]).first().name == "Xxx nn"
    marked = df.select(highlight(F.col("note"), "a.b").alias("m")).first().m
    assert marked == "<em>a.b</em> <em>A.B</em> axb"


def test_search_modes_pages_and_total(spark):
    df = spark.range(50).select("id", F.when(F.col("id") % 5 == 0, "Red sea").otherwise("blue").alias("name"))
    score = search_page(df, F.col("id") >= 10, "red", "name", ["id"], 0, 3).collect()
    assert [(r.id, r.matched, r.total) for r in score] == [(10, True, 40), (11, False, 40), (12, False, 40)]
    assert score[0].highlighted == "<em>Red</em> sea"
    hits = search_page(df, F.col("id") >= 10, "red", "name", ["id"], 2, 3, "filter").collect()
    assert [(r.id, r.total) for r in hits] == [(20, 8), (25, 8), (30, 8)]
    assert [r.id for r in search_page(df, None, "", "name", ["id"], 48, 20, "filter").collect()] == [48, 49]


def test_kafka_options():
    assert kafka_options("t", "h:1")["startingOffsets"] == "latest"
    stored = kafka_options("t", "h:1", {1: 5, 0: 7})
    assert json.loads(stored["startingOffsets"]) == {"t": {"0": 7, "1": 5}}
