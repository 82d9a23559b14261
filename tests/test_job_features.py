"""Spread copies, weighted hot keys, trigger sampling, exact areas, switched partitions, dated runs, merged metric logs."""

import datetime as dt
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.operators import audience, evaluation, feature_slots, joins, runlog, triggers
from clickloom.plans import hourly_samples as hourly
from clickloom.sources import sinks, snapshots
from workload import views

# --- copies and hot keys ------------------------------------------------------------------------------


def test_copies_of_one_row_are_written_by_many_tasks(spark):
    folded = spark.createDataFrame([("hot", 400_000), ("one", 1), ("few", 7)], "k string, copies long")
    spread = joins.expand_copies(folded, "copies", tasks=8, most=1000)
    assert {r.k: r["count"] for r in spread.groupBy("k").count().collect()} == {"hot": 400_000, "one": 1, "few": 7}
    per_task = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * sum(per_task) / 8
    plan = spread._jdf.queryExecution().executedPlan().toString()
    # what is shuffled are parts, and copies are written out after it
    assert plan.count("REPARTITION_BY_NUM") == 1 and plan.index("_copy") < plan.index("Exchange") < plan.rindex("Generate explode")


def test_split_copies_adds_up(spark):
    folded = spark.createDataFrame([(n,) for n in (1, 9, 10, 11, 100, 101)], "copies long").withColumn("n", F.col("copies"))
    split = joins.split_copies(folded, "copies", 10)
    assert split.agg(F.max("copies")).first()[0] == 10
    assert {r.n: (r.total, r.parts) for r in split.groupBy("n").agg(F.sum("copies").alias("total"), F.count_distinct("_part").alias("parts")).collect()} == {
        n: (n, -(-n // 10)) for n in (1, 9, 10, 11, 100, 101)}


def test_hot_keys_by_weight(spark):
    frame = spark.createDataFrame([("a", 50), ("a", 60), ("b", 100), (None, 500)], "k string, w int")
    assert rows(joins.hot_keys(frame, "k", 100, weight="w")) == [("a", 2)]
    assert rows(joins.hot_keys(frame, "k", 1)) == [("a", 2)]


def test_hot_keys_are_those_of_the_rows_joined(spark):
    """A user of few impressions with long lists is hot, and so is a device that only clicks."""
    shown = spark.createDataFrame([("u1", "d1", ",".join(map(str, range(40)))), ("u2", "d2", "1"), ("u2", "d2", "2"), ("u2", "d2", None)],
                                  "uid string, device string, content string")
    clicks = spark.createDataFrame([(f"m{i}", "d9", "5") for i in range(30)] + [("u1", "d1", "5")] * 50, "user_id string, device string, content_id string")
    hot = hourly.HotKeys.of(shown, clicks, rows_per_task=20)
    assert rows(hot.users) == [("u1", 2)] and rows(hot.devices) == [] and rows(hot.click_devices) == [("d9", 2)]
    labelled = spark.createDataFrame([("u7", "i1", 90), ("u8", "i2", 3)], "uid string, content_id string, copies long")
    later = hot.of_labelled(labelled, rows_per_task=20)
    assert rows(later.users) == [("u7", 5)] and rows(later.items) == [("i1", 5)]
    users = spark.createDataFrame([("d9", 4), ("d1", 4)], "device string, wlx_content_id long")
    got = audience.keep_new_user_clicks(clicks, users, hot.click_devices)
    assert got.count() == 80
    assert "_salt" in got._jdf.queryExecution().analyzed().toString()


# --- trigger sampling -----------------------------------------------------------------------------------


def plainly(values, gap):
    out = []
    for v in sorted(set(values)):
        if not out or v >= out[-1] + gap:
            out.append(v)
    return out


@pytest.mark.parametrize(("gap", "chunk"), [(1, 4), (7, 7), (7, 20), (30, 64), (500, None), (5, 10_000)])
def test_trigger_equals_a_step_by_step_one(spark, gap, chunk):
    rng = random.Random(gap)
    ticks = [("a", v) for v in rng.sample(range(-300, 2500), 900)] + [("b", 5)] + [("c", v) for v in (0, 1000, 1001, 2400)] + [(None, 3), (None, 90), ("d", None)]
    ticks += ticks[:40]
    frame = spark.createDataFrame(ticks, "run string, step long")
    got = {}
    for r in triggers.triggered(frame, F.col("step"), gap, ["run"], chunk).collect():
        got.setdefault(r.run, []).append(r._at)
    want = {run: plainly([v for k, v in ticks if k == run and v is not None], gap) for run in ("a", "b", "c", None)}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_small_chunks_of_a_trigger_are_worked_on_together(spark):
    """Chunks that end in the middle of batches, far apart and below zero; none has a call of its own."""
    rng = random.Random(3)
    steps = {run: [*rng.sample(range(-500, 4000), 300), 10 ** 12 + run] for run in range(6)}
    frame = spark.createDataFrame([(r, s) for r, many in steps.items() for s in many], "run int, step long").coalesce(1)
    taken = triggers.triggered(frame, F.col("step"), 11, ["run"], 37)
    plan = taken._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((r.run, r._at) for r in triggers.triggered(frame, F.col("step"), 11, ["run"], 37).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(run, s) for run in range(6) for s in plainly(steps[run], 11)]


def test_trigger_rows_and_arguments(spark):
    at = dt.datetime(2024, 1, 1)
    metrics = spark.createDataFrame(
        [("r", "m", step, float(step), at + dt.timedelta(seconds=s)) for step, s in ((1, 0), (2, 4), (2, 3), (4, 11), (9, 12), (10, 22))],
        "run_id string, name string, global_step long, value double, ts timestamp")
    by_steps = runlog.sample_by_trigger(metrics, every_n_steps=3)
    assert by_steps.columns == metrics.columns and [r.global_step for r in by_steps.orderBy("global_step").collect()] == [1, 4, 9]
    by_time = runlog.sample_by_trigger(metrics, every_n_secs=10)
    assert [r.global_step for r in by_time.orderBy("ts").collect()] == [1, 4, 10]
    # slots would take step 9 as well as step 10, or neither in its place
    assert runlog.sample_by_trigger(metrics.where("false"), every_n_steps=3).count() == 0
    for bad in ({}, {"every_n_steps": 1, "every_n_secs": 1}):
        with pytest.raises(ValueError, match="exactly one"):
            runlog.sample_by_trigger(metrics, **bad)
    with pytest.raises(ValueError, match="positive"):
        triggers.triggered(metrics, F.col("global_step"), 0, ["run_id"])


# --- exact areas ----------------------------------------------------------------------------------------


def areas_plainly(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    if not pos or not neg:
        return None
    roc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    area, before = 0.0, None
    for s in sorted({s for _, s in pairs}, reverse=True):
        above = [y for y, v in pairs if v >= s]
        precision = sum(above) / len(above)
        here = sum(y for y, v in pairs if v == s)
        area += here * (precision + (precision if before is None else before)) / 2
        before = precision
    return roc, area / len(pos)


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_exact_areas_equal_all_pairs(spark, slices):
    rng = random.Random(4)
    data = [(g, y, round(rng.random() * 0.7 + 0.2 * y, 2)) for g in ("a", "b") for y in (0, 1) for _ in range(80)]
    data += [("c", 1, 0.5), ("d", 0, 0.5), ("d", 0, 0.1), ("b", 1, -0.0), ("b", 0, 0.0)]
    frame = spark.createDataFrame([*data, ("a", None, 0.5), ("a", 1, None)], "g string, label int, score double")
    got = {r.g: (r.auc, r.auc_precision_recall) for r in evaluation.areas_exact(frame, by=["g"], slices=slices).collect()}
    for g in ("a", "b"):
        assert got[g] == pytest.approx(areas_plainly([(y, s) for k, y, s in data if k == g]))
    assert got["c"][0] is None and got["d"] == (None, None)
    one = evaluation.areas_exact(frame, slices=slices).first()
    assert (one.auc, one.auc_precision_recall) == pytest.approx(areas_plainly([(y, s) for _, y, s in data]))
    assert evaluation.areas_exact(frame.where("false"), slices=slices).first().auc is None


def test_exact_areas_use_no_window_over_all_scores(spark):
    frame = spark.range(1000).selectExpr("cast(id % 2 as int) as label", "id / 1000D as score")
    plan = evaluation.areas_exact(frame, slices=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 2 and "partitionBy" not in plan
    assert "_slice" in plan


# --- switched partitions ----------------------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_write_leaves_the_old_hour(spark, tmp_path, fmt):
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("t", T.StringType())])
    table, path, hour = f"switched_{fmt}", str(tmp_path / "t"), {"ds": "2024-01-01", "hh": "05"}
    sinks.create_sample_table(spark, table, path, schema, fmt=fmt)
    old = spark.createDataFrame([(i, f"old,{i}") for i in range(50)], schema)
    first = sinks.publish_partition(old, table, path, hour, fmt=fmt)
    held = spark.table(table)  # planned before the switch
    broken = old.repartition(5).withColumn("v", F.when(F.col("v") == 49, F.raise_error(F.lit("half-way"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="half-way"):
        sinks.publish_partition(broken, table, path, hour, fmt=fmt)
    assert sorted(r.v for r in spark.table(table).collect()) == list(range(50))
    assert sinks.partition_location(spark, table, hour).rstrip("/").endswith(first.rsplit("/", 1)[1])
    second = sinks.publish_partition(old.withColumn("v", F.col("v") + 100), table, path, hour, fmt=fmt)
    assert spark.table(table).agg(F.min("v")).first()[0] == 100 and spark.table(table).count() == 50
    assert os.path.isdir(first) and held.count() == 50  # the old folder stands for those who read it
    assert spark.table(table).where("ds = '2024-01-01' and hh = '05'").count() == 50
    assert sinks.expire_versions(spark, table, path, hour, keep=0) == 1
    assert not os.path.isdir(first) and os.path.isdir(second) and spark.table(table).count() == 50
    sinks.publish_partition(old.where("false"), table, path, hour, fmt=fmt)
    assert spark.table(table).count() == 0
    spark.sql(f"drop table {table}")


# --- run store ---------------------------------------------------------------------------------------------


def test_updates_rewrite_the_days_they_touch(spark, tmp_path):
    store = sinks.DatedRunStore(spark, str(tmp_path / "store"))
    at = dt.datetime(2024, 1, 1)
    schema = "run_id string, status string, ts timestamp_ntz, day string"
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert store.read("statuses").count() == 0
    store.upsert("statuses", spark.createDataFrame([(f"r{d}{i}", "running", at, d) for d in days for i in range(3)], schema))
    before = {d: sorted(os.listdir(tmp_path / "store" / "statuses" / f"day={d}")) for d in days}
    store.upsert("statuses", spark.createDataFrame([(f"r{days[1]}0", "success", at, days[1]), ("new", "running", None, days[1])], schema))
    got = rows(store.read("statuses", [days[1]]), "run_id", "status")
    assert got == [("new", "running"), ("r2024-01-020", "success"), ("r2024-01-021", "running"), ("r2024-01-022", "running")]
    assert store.read("statuses").count() == 10
    after = {d: sorted(os.listdir(tmp_path / "store" / "statuses" / f"day={d}")) for d in days}
    assert [before[d] == after[d] for d in days] == [True, False, True]  # a day not touched is not written
    plan = store.read("statuses", [days[1]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and days[1] in plan
    store.upsert("statuses", store.read("statuses").where("false"))
    assert store.read("statuses").count() == 10


# --- metric log ----------------------------------------------------------------------------------------------


def record(spark, *steps):
    return spark.createDataFrame([(f"r{s}", "m", float(s), None, s, "t", [("a", "b")]) for s in steps], S.METRIC_SCHEMA)


def test_merging_a_metric_log_loses_nobody(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for i in range(6):
        sinks.append_metrics(record(spark, i, i + 100).coalesce(1), path)
    early = sinks.read_metrics(spark, path)  # a reader that has its files
    assert len(sinks.metric_files(spark, path)) == 6
    assert sinks.merge_metrics(spark, path) == 6
    assert len(sinks.metric_files(spark, path)) == 1
    assert early.count() == sinks.read_metrics(spark, path).count() == 12
    sinks.append_metrics(record(spark, 500).coalesce(1), path)
    assert sinks.read_metrics(spark, path).count() == 13 and sinks.merge_metrics(spark, path) == 2
    assert sinks.remove_merged(spark, path) == 8 and sinks.remove_merged(spark, path) == 0
    assert rows(sinks.read_metrics(spark, path), "global_step") == sorted([(s,) for i in range(6) for s in (i, i + 100)] + [(500,)], key=str)
    assert sinks.merge_metrics(spark, path) == 0 and sinks.merge_metrics(spark, path, small=1) == 0


def test_an_append_during_a_merge_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    for i in range(3):
        sinks.append_metrics(record(spark, i).coalesce(1), path)
    plain = sinks.metric_files

    def listed(*args):
        found = plain(*args)
        sinks.append_metrics(record(spark, 77).coalesce(1), path)  # after the merge has listed its files
        return found

    monkeypatch.setattr(sinks, "metric_files", listed)
    assert sinks.merge_metrics(spark, path) == 3
    monkeypatch.undo()
    sinks.remove_merged(spark, path)
    assert rows(sinks.read_metrics(spark, path), "global_step") == [(0,), (1,), (2,), (77,)]
    assert sinks.read_metrics(spark, path).first().extras[0].name == "a"


# --- bucketed snapshots ---------------------------------------------------------------------------


@pytest.fixture
def item_slots(spark, tmp_path):
    """A table of two days, the first written twice, and its values of the first day by id."""
    table = f"item_slots_{os.path.basename(tmp_path).replace('-', '_')}"
    snapshots.create_slot_table(spark, table, str(tmp_path / "slots"), S.ITEM_SLOTS, buckets=8)
    first, *others = S.ITEM_SLOTS

    def day(values):
        made = spark.createDataFrame([(i, v) for i, v in values.items()], f"entity_id string, {first.column} string")
        return made.withColumns({s.column: F.lit(s.default) for s in others})

    values = {str(i): f"v{i}" for i in range(200)}
    snapshots.publish_slots(day({"1": "old", "gone": "old"}), table, "2024-01-01")
    snapshots.publish_slots(day({"1": "later"}), table, "2024-01-02")
    snapshots.publish_slots(day(values), table, "2024-01-01")
    yield table, values, first
    spark.sql(f"drop table {table}")


def test_a_published_day_replaces_that_day_only(spark, item_slots):
    table, values, first = item_slots
    assert snapshots.buckets_of(spark, table) == 8
    assert dict(snapshots.slots_of_day(spark, table, "2024-01-01").select("entity_id", first.column).collect()) == values
    assert rows(snapshots.slots_of_day(spark, table, "2024-01-02"), "entity_id", first.column) == [("1", "later")]
    assert snapshots.slots_of_day(spark, table, "2024-01-03").count() == 0
    files = [f for f in spark.table(table).where("ds = '2024-01-01'").inputFiles() if "2024-01-01" in f]
    assert len(files) == 8  # one file for each bucket
    with pytest.raises(ValueError):
        snapshots.buckets_of(spark, _plain_table(spark, table))


def _plain_table(spark, near):
    spark.sql(f"create or replace temporary view {near}_plain as select 1 as x")
    return f"{near}_plain"


def test_bucketed_values_are_joined_where_they_lie(spark, item_slots):
    table, values, first = item_slots
    shown = [(i, "7" if i % 3 == 0 else None if i % 3 == 1 else str(i)) for i in range(600)]
    left = spark.createDataFrame(shown, "n int, content_id string").withColumn("m", F.create_map(F.lit("k"), F.col("n")))
    want = {n: values.get(c, first.default) for n, c in shown}
    slots = snapshots.slots_of_day(spark, table, "2024-01-01")
    hot = joins.hot_keys(left, "content_id", 50)
    assert [r.content_id for r in hot.collect()] == ["7"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keys in (None, hot):
            got = feature_slots.attach_bucketed_slots(left, "content_id", slots, S.ITEM_SLOTS, keys)
            assert got.columns == [*left.columns, *(s.column for s in S.ITEM_SLOTS)]
            found = got.select("n", first.column).collect()
            assert len(found) == len(shown) and dict(found) == want
        plan = feature_slots.attach_bucketed_slots(left, "content_id", slots, S.ITEM_SLOTS)._jdf.queryExecution().executedPlan().toString()
        # one exchange, of the rows: none lies between the table and the join
        assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_at" in plan
        assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
        # a third of the rows have one key, a third have none: the buckets' tasks stay even
        marked = feature_slots.attach_bucketed_slots(left, "content_id", slots, S.ITEM_SLOTS, hot)
        text = marked._jdf.queryExecution().analyzed().toString()
        assert "_salt" in text and "_calm" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slot_values_are_dealt_before_they_are_folded(spark):
    """A file's values are not sorted in one task; the last one of a name wins, wherever its rows lie."""
    names = [s.feature for s in S.ITEM_SLOTS[:2]]
    values = spark.range(4000).selectExpr(
        "cast(id % 7 as string) as entity_id", "cast(id div 14 as int) as ord", f"if(id div 7 % 2 = 0, '{names[0]}', '{names[1]}') as feature_name",
        "cast(id as string) as value").coalesce(1)
    values = values.union(spark.createDataFrame([(None, 1, names[0], "n")], values.schema))
    filled = feature_slots.fill_slots(values, S.ITEM_SLOTS[:2])
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange") > plan.rindex("Aggregate")
    first, second = (s.column for s in S.ITEM_SLOTS[:2])
    last = {r.entity_id: (r[first], r[second]) for r in filled.collect()}
    assert len(last) == 8 and last.pop(None) == ("n", S.ITEM_SLOTS[1].default)
    for entity, found in last.items():
        mine = [i for i in range(4000) if str(i % 7) == entity]
        assert found == tuple(str(max(i for i in mine if i // 7 % 2 == k)) for k in (0, 1))


def test_snapshot_rows_are_spread_before_their_values_are_made(spark, tmp_path):
    parts = spark.range(60).selectExpr("if(id = 3, null, id % 50) as p_partkey", "concat('red ', id) as p_name", "'b' as p_brand", "'t' as p_type",
                                       "cast(id % 8 + 1 as int) as p_size", "id * 1.5D as p_retailprice").coalesce(1)
    parts.write.parquet(str(tmp_path / "part.parquet"))
    made = views.item_snapshot(spark, str(tmp_path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("REBALANCE_PARTITIONS_BY_NONE") < plan.index("Scan parquet")
    named = made.where("feature_name = 'd_dy_2_subcategory' and ord = 2 or ord = 1")
    assert named.count() == 60 and named.where("entity_id is null").count() == 1
