import dataclasses
import datetime as dt
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.operators import feature_slots
from clickloom.plans import hourly_samples as hourly
from clickloom.sources import delimited, logs, scratch, sinks, snapshots, synthetic, trainlog

SMALL = T.StructType([S.SAMPLE_SCHEMA["u_id"], S.SAMPLE_SCHEMA["u_topics"], S.SAMPLE_SCHEMA["i_pos"]])


def small(spark, *data):
    return spark.createDataFrame(data, "u_id string, u_topics string, i_pos int, ds string, hh string")


def test_schema_has_38_columns_in_file_order():
    assert len(S.SAMPLE_COLUMNS) == 38
    assert S.SAMPLE_COLUMNS[4:19] == [s.column for s in S.USER_SLOTS]
    assert S.SAMPLE_COLUMNS[20:31] == [s.column for s in S.ITEM_SLOTS]
    assert S.TRAINING_DEFAULTS["u_age"] == -1 and S.TRAINING_DEFAULTS["u_gender"] == 5
    assert S.TRAINING_DEFAULTS["u_city"] == "0" and S.TRAINING_DEFAULTS["l_click"] == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rerun_replaces_its_partition_only(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    sinks.write_partitions(small(spark, ("a", "x|y", 1, "2024-01-01", "00"), ("b", "p,q", 2, "2024-01-01", "01")), path, fmt=fmt)
    for _ in range(2):
        sinks.write_partitions(small(spark, ("c", "z", 3, "2024-01-01", "00")), path, fmt=fmt)
    got = sinks.read_partitions(spark, path, SMALL, fmt=fmt)
    assert rows(got) == [("b", "p,q", 2, "2024-01-01", "01"), ("c", "z", 3, "2024-01-01", "00")]


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame(
        [("u", "d", "100", {"content": ("1",)}, "2024-01-01", "00"), ("u", "d", "300", {}, "2024-01-01", "01")], S.EVENT_LOG_SCHEMA)
    log.write.partitionBy("ds", "hh").parquet(path)
    table = logs.read_table(spark, path, S.EVENT_LOG_SCHEMA, row_id=True)
    hour = logs.impressions_of(logs.log_hour(table, "2024-01-01", "00", "100"))
    assert hour.count() == 1 and hour.first().content == "1" and hour.first().hh == "00"
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "PushedFilters: [IsNotNull(cmd), EqualTo(cmd,100)]" in plan


def test_row_ids_part_exact_copies_and_are_stable(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.createDataFrame([("d", 1)] * 50, S.NEW_USER_SCHEMA).coalesce(2).write.parquet(path)
    ids = [r.row_id for r in logs.read_table(spark, path, S.NEW_USER_SCHEMA, row_id=True).collect()]
    again = [r.row_id for r in logs.read_table(spark, path, S.NEW_USER_SCHEMA, row_id=True).collect()]
    assert len(set(ids)) == 50 and sorted(ids) == sorted(again)


def test_delimited_defaults(spark, tmp_path):
    path = str(tmp_path / "text.csv")
    with open(path, "w") as f:
        f.write("7\tx\t\n\t\t3\n")
    got = delimited.read_delimited(spark, path, sep="\t", schema=SMALL, defaults={"u_id": "0", "u_topics": "0", "i_pos": 9})
    assert rows(got) == [("0", "0", 3), ("7", "x", 9)]
    lines = spark.createDataFrame([(1, "7,\"a,b\","), (2, ",,")], "id int, value string")
    parsed = delimited.parse_delimited(lines, schema=SMALL, defaults={"u_id": "0", "u_topics": "0", "i_pos": 9})
    assert rows(parsed) == [(1, "7", "a,b", 9), (2, "0", "0", 9)]


def test_delimited_files_quote_the_delimiter(spark, tmp_path):
    path = str(tmp_path / "text")
    sinks.write_delimited(small(spark, ("a", "x,y", 1, "d", "h")).drop("ds", "hh"), path, files=3)
    assert rows(delimited.read_delimited(spark, path, schema=SMALL, defaults={})) == [("a", "x,y", 1)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_delimited(small(spark), path, overwrite=False)


def test_register_partition_once(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_partitions(small(spark, ("a", "x", 1, "2024-01-01", "00"), ("b", "y", 2, "2024-01-01", "01")), path, fmt="csv")
    sinks.create_sample_table(spark, "reg_test", path, SMALL)
    for _ in range(2):
        sinks.add_partition(spark, "reg_test", f"{path}/ds=2024-01-01/hh=00", ds="2024-01-01", hh="00")
    assert rows(spark.table("reg_test")) == [("a", "x", 1, "2024-01-01", "00")]
    comments = {r.col_name: r.comment for r in spark.sql("describe reg_test").collect()}
    assert comments["u_topics"] == "topics, pipe list"
    sinks.create_sample_table(spark, "reg_test", path, SMALL)
    assert spark.table("reg_test").count() == 0 and os.path.exists(f"{path}/ds=2024-01-01/hh=00")
    spark.sql("drop table reg_test")


def test_metric_log_and_run_store(spark, tmp_path):
    record = ("r", "loss", 0.5, None, 10, "2024-01-01T00:00:00.000000Z", [("a", "1")])
    metrics = spark.createDataFrame([record], S.METRIC_SCHEMA)
    for _ in range(2):
        sinks.append_metrics(metrics, str(tmp_path / "metric.log"))
    got = sinks.read_metrics(spark, str(tmp_path / "metric.log")).collect()
    assert len(got) == 2 and got[0].extras[0].name == "a" and got[0].unit is None
    store = sinks.RunStore(spark, str(tmp_path / "store"))
    statuses = [("r", "running", dt.datetime(2024, 1, 1)), ("r", "success", dt.datetime(2024, 1, 2))]
    for status in statuses:
        store.append("statuses", spark.createDataFrame([status], S.STATUS_SCHEMA))
    assert store.read("statuses").count() == 2


def test_constant_rows(spark):
    got = synthetic.constant_rows(spark, 3, {"x": (2,), "y": ()}, input_value=1.5, label_shape=(), label_value=1)
    assert rows(got) == [(i, [1.5, 1.5], 1.5, 1) for i in range(3)]


def test_training_log_lines(spark):
    head = "2024-02-03 04:05:06,789 INFO (MainThread-7) "
    lines = spark.createDataFrame([
        (head + "loss = 12.5, step = 4000 (3.25 sec)",),
        (head + "Loss for final step: 11.75.",),
        (head + "Saving dict for global step 9000: accuracy = 0.75, auc_precision_recall = 0.0625,"
         " global_step = 9000, label/mean = 0.125, loss = 7.2e+01",),
    ], "value string")
    assert rows(trainlog.progress(lines)) == [(12.5, 4000, 3.25)]
    assert rows(trainlog.evaluations(lines), "global_step", "name", "value") == [
        (9000, "accuracy", 0.75), (9000, "auc_precision_recall", 0.0625), (9000, "label/mean", 0.125), (9000, "loss", 72.0)]


def test_scratch_is_the_shared_folder(spark):
    base = spark.conf.get(scratch.CHECKPOINT_DIR)
    one, two = (scratch.scratch_path(spark, "x") for _ in range(2))
    assert one.startswith(base) and one != two
    staged = scratch.stage(spark.range(5).withColumn("m", F.col("id") * 2), "t")
    assert staged.count() == 5 and staged.columns == ["id", "m"]


def test_previous_hour_crosses_midnight():
    assert hourly.previous_hour(dt.datetime(2024, 3, 1, 0, 30)) == ("2024-02-29", "23")


def test_hourly_job_end_to_end(spark, tmp_path):
    def entries(**fields):
        return {k: (v,) for k, v in fields.items()}

    props = '{"1":{"from":3},"2":{"from":4}}'
    hours = [("05", "d1"), ("06", "d2")]
    log = [("u" + d, d, "100", entries(content="1,2", props=props), "2024-01-01", h) for h, d in hours]
    log += [("u" + d, d, "300", entries(content_id="2", channel="255", is_appview="1", **{"from": "11"}), "2024-01-01", h)
            for h, d in hours]
    log += [(None, "d9", "100", entries(content="1", props="{bad"), "2024-01-01", "05"), (None, "0", "100", entries(content="1", props=props), "2024-01-01", "05"),
            ("ud1", "d1", "100", entries(props=props), "2024-01-01", "05")]
    spark.createDataFrame(log, S.EVENT_LOG_SCHEMA).write.partitionBy("ds", "hh").parquet(str(tmp_path / "log"))
    read = [("d1", "ud1", "4034", entries(useTime="8", selectedId="2", channel="255"), "2024-01-01", "20")]
    spark.createDataFrame(read, S.COLLECT_LOG_SCHEMA).write.partitionBy("ds", "hh").parquet(str(tmp_path / "collect"))
    spark.createDataFrame([("d1", 5), ("d2", 6)], S.NEW_USER_SCHEMA).write.parquet(str(tmp_path / "users"))
    features = [("1", 0, 0, "d_st_2_type", "9", None, None)]
    spark.createDataFrame(features, S.FEATURE_SNAPSHOT_SCHEMA).write.parquet(str(tmp_path / "items"))
    spark.createDataFrame([], S.FEATURE_SNAPSHOT_SCHEMA).write.parquet(str(tmp_path / "profiles"))
    job = hourly.HourlyJob(
        event_log=str(tmp_path / "log"), collect_log=str(tmp_path / "collect"), new_users=str(tmp_path / "users"),
        item_features=str(tmp_path / "items"), user_features=str(tmp_path / "profiles"),
        samples=str(tmp_path / "samples"), item_ids=str(tmp_path / "ids"), rejects=str(tmp_path / "rejects"), table="hourly_test", fmt="csv")
    folder = spark.conf.get("spark.checkpoint.dir")
    left = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    reports = {hour: hourly.run_hour(spark, job, "2024-01-01", hour) for hour in ("05", "06", "05")}
    assert set(os.listdir(folder)) == left  # nothing staged stays
    assert reports["05"] == hourly.HourReport(4, {"no device": 1, "no content": 1, "bad props": 1}, 2)
    assert reports["06"] == hourly.HourReport(1, {}, 2)
    rejected = spark.read.parquet(str(tmp_path / "rejects" / "ds=2024-01-01" / "hh=05"))
    assert rows(rejected, "device", "uid", "problem") == [("0", None, "no device"), ("d1", "ud1", "no content"), ("d9", None, "bad props")]
    got = rows(spark.table("hourly_test"), "hh", "u_id", "u_content_id", "i_cate", "l_click", "l_read_time")
    assert got == [("05", "ud1", 1, 9, 0, 0.0), ("05", "ud1", 2, None, 1, 8.0),
                   ("06", "ud2", 1, 9, 0, 0.0), ("06", "ud2", 2, None, 1, 0.0)]
    assert rows(spark.read.text(str(tmp_path / "ids" / "2024-01-01" / "05"))) == [("1",), ("2",)]
    # the same hour from bucketed slot values
    snapshots.create_slot_table(spark, "hourly_test_slots", str(tmp_path / "slots"), S.ITEM_SLOTS, buckets=4)
    made = feature_slots.slot_table(spark.createDataFrame(features, S.FEATURE_SNAPSHOT_SCHEMA), S.ITEM_SLOTS)
    snapshots.publish_slots(made, "hourly_test_slots", "2024-01-01")
    shutil.copytree(tmp_path / "items", tmp_path / "dated" / "ds=2024-01-01")
    shutil.copytree(tmp_path / "profiles", tmp_path / "dated-profiles" / "ds=2024-01-01")
    bucketed = dataclasses.replace(job, item_slots="hourly_test_slots", item_features=str(tmp_path / "dated"),
                                   user_features=str(tmp_path / "dated-profiles"))
    with pytest.raises(ValueError):
        hourly.run_hour(spark, bucketed, "2024-01-01", "05")
    assert hourly.run_hour(spark, dataclasses.replace(bucketed, snapshot_ds="2024-01-01"), "2024-01-01", "05") == reports["05"]
    assert rows(spark.table("hourly_test"), "hh", "u_id", "u_content_id", "i_cate", "l_click", "l_read_time") == got
    spark.sql("drop table hourly_test_slots")
    spark.sql("drop table hourly_test")


def test_texts_come_back_as_they_were(spark, tmp_path):
    texts = ["a\nb", "q\"uo\"te", "back\\slash \\n \\\\", "  pad  ", "", None, "com,ma", "\r", "\\", "é", "\"", ","]
    frame = spark.createDataFrame([(i, t, "2024-01-01") for i, t in enumerate(texts)], "i int, t string, ds string")
    schema = frame.drop("ds").schema
    sinks.write_partitions(frame, str(tmp_path / "p"), by=["ds"], fmt="csv")
    assert dict(sinks.read_partitions(spark, str(tmp_path / "p"), schema, by=["ds"], fmt="csv").select("i", "t").collect()) == dict(enumerate(texts))
    sinks.write_delimited(frame.drop("ds"), str(tmp_path / "d"), sep="\t")
    back = delimited.read_delimited(spark, str(tmp_path / "d"), "\t", schema, {})
    assert dict(back.collect()) == dict(enumerate(texts))
    assert spark.read.text(str(tmp_path / "d")).count() == len(texts)
    assert delimited.read_bad_lines(spark, str(tmp_path / "d"), "\t", schema).count() == 0


def test_lines_that_do_not_fit_are_kept_apart(spark):
    schema = T.StructType([T.StructField("u", T.StringType()), T.StructField("age", T.IntegerType()), T.StructField("c", T.StringType())])
    lines = spark.createDataFrame([(1, "u1,abc,x"), (2, "u2,5"), (3, "u3,5,x,y"), (4, "u4,,x"), (5, "u5,7,"), (6, "")], "n int, value string")
    good = delimited.parse_delimited(lines, "value", schema=schema, defaults={"age": -1, "c": "none"})
    assert sorted(tuple(r) for r in good.collect()) == [(4, "u4", -1, "x"), (5, "u5", 7, "none")]
    assert sorted(r.n for r in delimited.bad_lines(lines, "value", schema=schema).collect()) == [1, 2, 3]
    by_column = delimited.parse_delimited(lines.select(F.struct("value").alias("s")), F.col("s.value"), schema=schema, defaults={})
    assert by_column.count() == 2 and by_column.columns[0] == "s"


def test_an_hour_written_again_without_rows_is_empty(spark, tmp_path):
    path = str(tmp_path / "samples")
    rows = spark.createDataFrame([(1, "d", "01"), (2, "d", "02")], "v int, ds string, hh string")
    for hh in ("01", "02"):
        sinks.write_partitions(rows.where(F.col("hh") == hh), path, one_partition={"ds": "d", "hh": hh})
    sinks.write_partitions(rows.where("false"), path, one_partition={"ds": "d", "hh": "01"})
    assert [tuple(r) for r in sinks.read_partitions(spark, path, rows.select("v").schema).collect()] == [(2, "d", "02")]
