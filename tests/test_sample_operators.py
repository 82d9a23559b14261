import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.functions import text
from clickloom.operators import audience, engagement, exposure, feature_slots, joins, quality, samples
from clickloom.plans import hourly_samples as hourly

IMPRESSION = "uid string, device string, content string, props string"


def impressions(spark, *data):
    return spark.createDataFrame([(f"u{i}", "d_1", c, p) for i, (c, p) in enumerate(data)], IMPRESSION)


PROPS = json.dumps({"1": {"from": 3}, "2": {"x": 1}, "3": {"from": 4}, "4": 5, "5": {"from": None}})


def test_positions_are_dense_over_kept_items(spark):
    shows = exposure.explode_positions(impressions(
        spark, ("1,2,,3,1,4,5,9", PROPS), ("1", "{bad"), (None, PROPS), ("1", None)))
    assert rows(shows, "uid", "content_id", "recall_from", "pos") == [
        ("u0", "1", 3, 1), ("u0", "1", 3, 3), ("u0", "3", 4, 2)]


def test_props_are_parsed_once_per_impression(spark):
    shows = exposure.explode_positions(impressions(spark, ("1,3", PROPS)))
    plan = shows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_distinct_items_keep_blanks(spark):
    assert rows(exposure.distinct_items(impressions(spark, ("1,,2", None), ("2,3", PROPS), (None, None)))) == [
        ("",), ("1",), ("2",), ("3",)]


def test_rejects(spark):
    data = impressions(spark, ("1", PROPS), ("1", "{bad"), (None, PROPS), ("1", None))
    data = data.union(spark.createDataFrame([("u9", "0", "1", PROPS)], IMPRESSION))
    good, bad = quality.split_rejects(data, quality.impression_problem())
    assert rows(good, "uid") == [("u0",)]
    assert rows(bad, "uid", "problem") == [
        ("u1", "bad props"), ("u2", "no content"), ("u3", "no props"), ("u9", "no device")]
    counts = quality.count_rejects(data, quality.impression_problem()).first()
    assert (counts.good, counts.rejected) == (1, 4)


def click_log(spark, *data):
    out = []
    for user, device, item, channel, source, view in data:
        entries = {"content_id": item, "channel": channel, "from": source, "is_appview": view}
        out.append((user, device, {k: (v,) for k, v in entries.items() if v is not None}))
    return spark.createDataFrame(out, "cookie_id string, device string, field map<string,struct<string_type:string>>")


def test_click_without_app_view_is_dropped(spark):
    log = click_log(
        spark, ("a", "d", "1", "255", "11", "1"), ("b", "d", "1", "255", "11", "2"),
        ("c", "d", "1", "255", "11", None), ("e", "d", "1", "254", "11", "1"), ("f", "d", "1", "255", None, "1"))
    assert rows(engagement.feed_clicks(log), "user_id") == [("a",)]


def read_log(spark, *data):
    out = [(d, h, {k: (v,) for k, v in {"useTime": t, "selectedId": i, "channel": "255"}.items() if v is not None})
           for d, h, i, t in data]
    return spark.createDataFrame(out, "device string, header_mi string, field map<string,struct<string_type:string>>")


def test_read_time(spark):
    got = engagement.read_time_by_item(read_log(
        spark, ("d1", "u", "7", "3.5"), ("d1", "u", "7", "9"), ("d1", "u", "7", "bad"), ("d2", "u", "7", "1"),
        ("d3", None, "7", "2"), ("", "u", "7", "5"), ("0", "u", "7", "5"), (None, "u", "7", "5"), ("d1", "u", None, "5")))
    assert rows(got, "user_id", "device", "read_time") == [("d3", "d3", 2.0), ("u", "d1", 9.0), ("u", "d2", 1.0)]


def users(spark, *data):
    return audience.new_users(spark.createDataFrame(data, S.NEW_USER_SCHEMA))


def test_repeated_dimension_rows_multiply(spark):
    dim = users(spark, ("d_1", 5), ("d_1", 5), ("d_1", 6), ("d_1", 0), ("x", 5))
    shown = impressions(spark, ("1", PROPS))
    assert rows(audience.attach_new_user(shown, dim), "wlx_content_id") == [(5,), (5,), (6,)]
    clicks = spark.createDataFrame([("u", "d_1", "1"), ("u", "none", "1")], "user_id string, device string, content_id string")
    assert audience.keep_new_user_clicks(clicks, dim).count() == 3
    assert audience.only_new_users(clicks, dim).count() == 1


def test_clicks_meet_every_device_of_the_user(spark):
    clicks = spark.createDataFrame(
        [("u", "d", "7"), ("u", "d", "8"), (None, "d", "7")], "user_id string, device string, content_id string")
    times = engagement.read_time_by_item(read_log(spark, ("d1", "u", "7", "3"), ("d2", "u", "7", "3"), ("d3", "u", "7", "4")))
    assert rows(engagement.add_read_time(clicks, times), "user_id", "content_id", "read_time") == [
        (None, "7", 0.0), ("u", "7", 3.0), ("u", "7", 3.0), ("u", "7", 4.0), ("u", "8", 0.0)]


def test_labels_keep_all_pairs(spark):
    shows = spark.createDataFrame([("d_1", "1", 1), ("d_1", "2", 2), ("d_1", "1", 3)], "device string, content_id string, pos int")
    clicks = spark.createDataFrame(
        [("d_1", "1", 0.0), ("d_1", "1", 0.0), ("d_1", "1", 2.0), ("d", "1", 9.0)],
        "device string, content_id string, read_time double")
    assert rows(engagement.label_clicks(shows, clicks), "pos", "click", "read_time") == [
        (1, 1, 0.0), (1, 1, 0.0), (1, 1, 2.0), (2, 0, 0.0), (3, 1, 0.0), (3, 1, 0.0), (3, 1, 2.0)]


# --- skew ---------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_salted_join_equals_the_plain_one(spark, how, broadcast):
    left = spark.range(900).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 50) end as k",
        "id % 5 as j")
    right = spark.range(60).selectExpr("if(id < 4, 'hot', concat('k', id)) as k", "id % 5 as j", "id as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for keys, hot_on in ((["k"], ["k"]), (["k", "j"], ["k"]), (["k", "j"], ["k", "j"])):
            hot = joins.hot_keys(left, hot_on, rows_per_task=20)
            assert hot.count() > 0 and hot.agg(F.max("_pieces")).first()[0] > 1
            side = right if "j" in keys else right.drop("j")
            salted = joins.skew_join(left, side, keys, how, hot)
            unsalted = joins.skew_join(left, side, keys, how)
            plain = left.join(side, keys, how)
            assert rows(salted, *plain.columns) == rows(plain) == rows(unsalted, *plain.columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_spread(spark):
    left = spark.range(3000).selectExpr("id", "'hot' as k")
    hot = joins.hot_keys(left, "k", rows_per_task=100)
    assert hot.first()._pieces == 30
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.createDataFrame([("hot", 1)], "k string, v int")
        parts = joins.skew_join(left, right, "k", "left", hot).groupBy(F.spark_partition_id().alias("p")).count()
        counts = [r["count"] for r in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(counts) == 4 and max(counts) < 1500


def test_copies_fold_and_expand(spark):
    data = spark.range(20000).selectExpr("id % 2 as k")
    folded = joins.count_copies(data, ["k"], "copies")
    assert rows(folded) == [(0, 10000), (1, 10000)]
    assert rows(joins.expand_copies(folded, "copies").groupBy("k").count()) == [(0, 10000), (1, 10000)]


# --- feature slots -----------------------------------------------------------------------


def snapshot(spark, *data):
    return spark.createDataFrame(data, S.FEATURE_SNAPSHOT_SCHEMA)


def test_slots_from_values(spark):
    table = feature_slots.slot_table(snapshot(
        spark,
        ("7", 0, 0, "d_dy_2_subcategory", "first", None, None),
        ("7", 0, 3, "d_dy_2_subcategory", "last", None, None),
        ("7", 0, 4, "d_dy_2_subcategory", None, ["wrong"], None),
        ("7", 0, 1, "d_st_3_playtime", None, None, -1.7),
        ("7", 0, 2, "d_dy_5_topics", None, ["a:1", "b"], None),
        ("7", 0, 5, "unlisted", "x", None, None),
        ("8", 1, 0, "d_dy_2_subcategory", "failed", None, None),
    ), S.ITEM_SLOTS)
    only = table.first().asDict()
    assert table.count() == 1 and only["entity_id"] == "7"
    assert (only["i_subcate"], only["i_playtime"], only["i_topics"]) == ("last", "-1", "a|b")
    assert (only["i_keywords"], only["i_read"]) == ("", "0.0")


def test_trailing_newline_of_the_app_list(spark):
    table = feature_slots.slot_table(
        snapshot(spark, ("u", 0, 0, "u_dy_5_app_list_yd", None, ["a:1", "b\n"], None)), S.USER_SLOTS)
    first = table.first()
    assert first.u_applist == "a|b" and first.u_gender == "5" and first.u_regtime == "0.0"


def test_replies_are_flattened_in_order(spark):
    reply = json.dumps({"Errcode": 0, "Features": [
        {"Uid": "u", "Feature": [{"FeatureName": "a", "FeatureValue": {"StringValue": "x"}}]},
        {"Uid": "u", "Feature": [{"FeatureName": "b", "FeatureValue": {"StringArrayValue": ["p:1"]}},
                                 {"FeatureName": "a", "FeatureValue": {"FloatValue": 2.5}}]}]})
    data = spark.createDataFrame([("1", reply), ("2", "{bad"), ("3", '{"Errcode": 3, "Features": []}')], "entity_id string, reply string")
    got = feature_slots.flatten_replies(data)
    assert rows(got, "entity_id", "ord", "feature_name", "string_value", "float_value") == [
        ("1", 0, "a", "x", None), ("1", 1, "b", None, None), ("1", 2, "a", None, 2.5)]


def test_missing_and_null_keys_get_defaults(spark):
    table = feature_slots.slot_table(snapshot(spark, ("7", 0, 0, "d_st_2_type", "4", None, None)), S.ITEM_SLOTS)
    data = spark.createDataFrame([("7",), ("8",), (None,)], "content_id string")
    got = feature_slots.attach_slots(data, "content_id", table, S.ITEM_SLOTS)
    assert rows(got, "content_id", "i_cate", "i_show") == [(None, "", "0.0"), ("7", "4", "0.0"), ("8", "", "0.0")]
    once = feature_slots.lookup_once(data.union(data), "content_id", table, S.ITEM_SLOTS)
    assert rows(once, "entity_id", "i_cate") == [(None, ""), ("7", "4"), ("8", "")]


# --- the whole build ------------------------------------------------------------------------


def small_inputs(spark):
    shown = spark.createDataFrame(
        [("u1", "d_1", "1,2,3", PROPS, "2024-01-01", "05"), (None, "d_2", "3", PROPS, "2024-01-01", "05"),
         ("u3", "old", "3", PROPS, "2024-01-01", "05")], IMPRESSION + ", ds string, hh string")
    return hourly.SampleInputs(
        impressions=shown,
        click_log=click_log(spark, ("u1", "d_1", "3", "255", "11", "1")),
        read_log=read_log(spark, ("d_1", "u1", "3", "12.5")),
        new_users=users(spark, ("d_1", 9), ("d_2", 9)),
        item_features=snapshot(spark, ("3", 0, 0, "d_st_3_playtime", None, None, 30.2)),
        user_features=snapshot(spark, ("u1", 0, 0, "u_st_2_city", "Oslo", None, None)),
    )


@pytest.mark.parametrize("rows_per_task", [None, 0])
def test_sample_build(spark, rows_per_task):
    inputs = small_inputs(spark)
    hot = None if rows_per_task is None else hourly.HotKeys.of(inputs.impressions, rows_per_task=1)
    built = hourly.build_samples(inputs, hot)
    assert built.columns == [*S.SAMPLE_COLUMNS, "ds", "hh"]
    assert [f.dataType for f in built.schema][:38] == [f.dataType for f in S.SAMPLE_SCHEMA]
    assert rows(built, "u_id", "u_device_id", "u_content_id", "i_pos", "l_click", "l_read_time", "i_playtime", "u_city") == [
        ("d_2", "d_2", 3, 1, 0, 0.0, 30, ""),
        ("u1", "d_1", 1, 1, 0, 0.0, 0, "Oslo"),
        ("u1", "d_1", 3, 2, 1, 12.5, 30, "Oslo"),
    ]
    first = built.where("u_content_id = 1").first()
    assert (first.u_age, first.u_gender, first.u_regtime, first.i_recall_from, first.l_share) == (0, 5, 0, 3, 0)
    lines = [r.value for r in hourly.build_records(inputs, hot).collect()]
    assert len(lines) == 3 and all(line.count(",") == 37 for line in lines)
    assert any(line.startswith("u1,d_1,3,9,0,5,") and ",2,1,12.500000,0,0,0," in line for line in lines)


def test_training_rows(spark):
    built = hourly.build_samples(small_inputs(spark))
    got = samples.training_rows(built, samples.NUMERIC_FEATURES)
    assert got.columns == [*samples.NUMERIC_FEATURES, "label"]
    assert got.where("label").count() == 1


def test_of_a_repeated_props_key_the_last_counts(spark):
    rows = spark.createDataFrame([("7,8", '{"7":{"from":1},"8":{"from":3},"7":{"from":2}}')], "content string, props string")
    assert [(r.content_id, r.recall_from, r.pos) for r in exposure.explode_positions(rows).collect()] == [("7", 2, 1), ("8", 3, 2)]


def test_a_record_quotes_what_would_break_it(spark):
    rows = spark.createDataFrame([("a,b", None, 'say "x"', "l\nm", "")], "a string, b string, c string, d string, e string")
    line = rows.select(text.record("a", "b", "c", "d", "e").alias("v")).first().v
    assert line == '"a,b",None,"say ""x""","l\nm",'


def test_snapshots_are_cut_to_the_ids_at_hand_before_the_pivot(spark):
    snapshot = spark.createDataFrame(
        [], "entity_id string, errcode int, ord int, feature_name string, value_type string, string_value string,"
            " array_value array<string>, float_value double")
    wanted = spark.createDataFrame([("a",)], "content_id string")
    plan = feature_slots.slot_table(snapshot, S.ITEM_SLOTS, wanted, "content_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
