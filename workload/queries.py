"""One query per operator; each takes the session and a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.functions import text
from clickloom.functions.buckets import even_edges
from clickloom.functions.hashing import bucket, split_flag
from clickloom.functions.records import hour_of
from clickloom.operators import (
    audience, batching, encoding, engagement, evaluation, exposure, feature_slots, quality, runlog, samples,
)
from clickloom.operators.joins import split_copies
from clickloom.plans import hourly_samples as hourly
from clickloom.plans import training
from clickloom.sources import delimited, logs, sinks, snapshots, synthetic, trainlog
from clickloom.sources.scratch import scratch_path, stage
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources -----------------------------------------------------------------


@query
def scan_log_hour(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.log_hour(views.event_log(spark, sf), "2024-01-15", "12", logs.IMPRESSION_CMD)
    return log.select(F.col("row_id"), F.col("cookie_id").alias("uid"), "device",
                      exposure.log_field("content").alias("content"))


@query
def scan_log_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every (day, hour, command) of the log."""
    log = views.event_log(spark, sf)
    return log.groupBy("ds", "hh", "cmd").agg(F.count(F.lit(1)).alias("n"), F.count("cookie_id").alias("members"))


@query
def scan_collect_day(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.log_day(views.collect_log(spark, sf), "2024-01-15", logs.READ_TIME_CMD)
    return log.select("device", "header_mi", exposure.log_field("selectedId").alias("content_id"),
                      text.to_double(exposure.log_field("useTime")).alias("use_time"), "hh")


@query
def scan_new_users(spark: SparkSession, sf: str) -> DataFrame:
    return views.new_users(spark, sf)


def _attribute_table(spark: SparkSession, sf: str) -> DataFrame:
    part = views.table(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        key.alias("id"), F.col("p_brand").alias("subcategory"), (size % 7).alias("type"),
        (size % 4).alias("cover_show_type"), (key % 3).alias("content_type"),
        F.when(key % 6 != 0, F.col("p_type")).alias("source_name"), size.alias("video_play_time"),
        F.regexp_replace("p_name", " ", ":2  ").alias("keywords_v2"),
        F.when(key % 5 != 0, F.concat(F.lit(" t1:0.5 "), F.col("p_type"))).alias("topic"),
        F.when(key % 2 == 0, "2024-01-15").otherwise("2024-01-16").alias("ds"),
    )


@query
def scan_item_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Item attributes of a day, as feature records."""
    return feature_slots.item_attribute_record(logs.item_attributes(_attribute_table(spark, sf), "2024-01-15"))


@query
def scan_profiles(spark: SparkSession, sf: str) -> DataFrame:
    customer = views.table(spark, sf, "customer")
    key = F.col("c_custkey")
    profiles = customer.select(
        key.cast("string").alias("member_id"), F.concat(F.lit("d"), key.cast("string")).alias("last_login_device"),
        F.col("c_nationkey").alias("reg_prov"), F.col("c_mktsegment").alias("reg_city"), (key % 2).alias("sex"),
        F.when(key % 2 == 0, "ios").otherwise("android").alias("last_login_client"),
        F.when(key % 3 == 0, F.concat(F.lit("w"), key.cast("string"))).alias("wlx_package_code"),
        F.when(key % 4 != 0, F.concat(F.lit("n"), key.cast("string"))).alias("nlx_source_code"),
        F.lit("mail|map").alias("install_app_list"),
        F.when(key % 10 < 5, "2024-01-15").otherwise("2024-01-16").alias("day"),
    )
    return logs.user_profiles(profiles, "2024-01-15")


_TEXT_SCHEMA = T.StructType([
    T.StructField("u_age", T.IntegerType()), T.StructField("u_dtu", T.StringType()),
    T.StructField("u_content_id", T.LongType()), T.StructField("i_topics", T.StringType()),
    T.StructField("u_gender", T.IntegerType()),
])
_TEXT_DEFAULTS = {f: S.TRAINING_DEFAULTS[f] for f in _TEXT_SCHEMA.fieldNames()}


@query
def delimited_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Tab separated lines with declared types; empty fields take their defaults."""
    lines = views.sample_lines(spark, sf)
    return delimited.parse_delimited(lines, "line", "\t", _TEXT_SCHEMA, _TEXT_DEFAULTS)


@query
def file_shards(spark: SparkSession, sf: str) -> DataFrame:
    """128 part files (by order key) over 70 workers: files and rows of each."""
    rows = views.table(spark, sf, "lineitem")
    return batching.shard_report(rows, F.pmod("l_orderkey", F.lit(128)), 70)


@query
def constant_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.table(spark, sf, "orders").select("o_orderkey")
    made = synthetic.with_constants(
        rows, {"x": (2, 3), "w": ()}, input_value=0.5, input_dtype="double", label_shape=(), label_value=1
    )
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v)
    return made.select("o_orderkey", F.size("x").alias("outer_size"), F.size(F.col("x")[0]).alias("inner_size"),
                       total.alias("total"), "w", "label")


@query
def training_log_progress(spark: SparkSession, sf: str) -> DataFrame:
    return trainlog.progress(views.log_lines(spark, sf))


@query
def training_log_evaluations(spark: SparkSession, sf: str) -> DataFrame:
    return trainlog.evaluations(views.log_lines(spark, sf))


# --- filters and scalar functions ----------------------------------------------


@query
def feed_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.feed_clicks(views.click_log(spark, sf))


@query
def usable_devices(spark: SparkSession, sf: str) -> DataFrame:
    """Usable rows with the user id: member, else device."""
    log = views.collect_log(spark, sf).where(text.usable_id("device"))
    return log.select("device", "header_mi", F.coalesce("header_mi", "device").alias("user_id"))


@query
def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_rejects(views.impressions(spark, sf), quality.impression_problem(), "ds")


@query
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = quality.split_rejects(views.impressions(spark, sf), quality.impression_problem())
    return rejects.select("row_id", "device", "problem")


@query
def number_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Half-up text, plain parse and whole-number parse of order prices, negatives and bad text included."""
    orders = views.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    hundredths = F.round(F.col("o_totalprice") * 100).cast("bigint") - 20000000
    number = hundredths / F.lit(100)
    raw = F.when(key % 11 == 0, "n/a").otherwise(F.format_string("%d.25", hundredths))
    return orders.select("o_orderkey", text.rounded_text(number).alias("rounded"),
                         text.to_double(raw).alias("parsed"), text.to_whole(raw).alias("whole"))


@query
def tag_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Tag clean-up from arrays, comma lists and words."""
    part = views.table(spark, sf, "part")
    weighted = F.concat_ws(",", F.concat("p_brand", F.lit(":0.5")), "p_type", F.concat(F.lit(":"), F.col("p_size")))
    words = F.concat(F.lit("  "), F.regexp_replace("p_name", " ", ":1 \t "), F.lit(" "))
    return part.select(
        "p_partkey", text.tag_list(text.comma_list(weighted)).alias("from_array"),
        text.tag_list_from_commas(weighted).alias("from_commas"), text.tag_list_from_words(words).alias("from_words"),
    )


@query
def newline_strip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents stripped of newlines at both ends, whole texts."""
    documents = views.table(spark, sf, "documents")
    padded = F.concat(F.lit("\n"), F.col("text"), F.lit("\n\n"))
    stripped = text.strip_newlines(padded)
    return documents.select("doc_id", F.length(padded).alias("before"), F.length(stripped).alias("after"),
                            F.md5(stripped).alias("digest"))


@query
def composite_keys(spark: SparkSession, sf: str) -> DataFrame:
    shows = exposure.explode_positions(views.impressions(spark, sf))
    keyed = shows.select("row_id", "pos", text.composite_key("content_id", "device").alias("show_key"))
    return keyed.select("*", text.key_content("show_key").alias("content_id"), text.key_device("show_key").alias("device"))


@query
def previous_hours(spark: SparkSession, sf: str) -> DataFrame:
    """The hour before each event, as partition values."""
    ds, hh = hour_of(F.col("ts"), back=1)
    return views.table(spark, sf, "events").select("event_id", ds.alias("ds"), hh.alias("hh"))


@query
def split_share(spark: SparkSession, sf: str) -> DataFrame:
    """Hash buckets and the train flag of every order."""
    orders = views.table(spark, sf, "orders")
    uid = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey").cast("string"))
    parts = [uid, F.col("o_orderpriority"), F.col("o_orderkey")]
    joined = F.concat(F.coalesce(uid, F.lit("None")), *[p.cast("string") for p in parts[1:]])
    return orders.select("o_orderkey", bucket(joined, 100).alias("hash_bucket"), split_flag(*parts).alias("r_type"))


# --- impressions, clicks, labels ---------------------------------------------------


@query
def positions(spark: SparkSession, sf: str) -> DataFrame:
    shows = exposure.explode_positions(views.impressions(spark, sf))
    return shows.select("row_id", "uid", "device", "content_id", "recall_from", "pos")


@query
def distinct_items(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.impressions(spark, sf)
    shown = audience.only_new_users(rows, views.new_users(spark, sf), audience.hot_devices(rows))
    return exposure.distinct_items(shown)


@query
def new_user_impressions(spark: SparkSession, sf: str) -> DataFrame:
    rows, users = views.impressions(spark, sf), views.new_users(spark, sf)
    return audience.attach_new_user(rows, users, audience.hot_devices(rows)).select(
        "row_id", "uid", "device", "wlx_content_id")


@query
def new_user_clicks(spark: SparkSession, sf: str) -> DataFrame:
    clicks = engagement.feed_clicks(views.click_log(spark, sf))
    return audience.keep_new_user_clicks(clicks, views.new_users(spark, sf), audience.hot_devices(clicks))


@query
def new_user_clicks_semi(spark: SparkSession, sf: str) -> DataFrame:
    return audience.only_new_users(engagement.feed_clicks(views.click_log(spark, sf)), views.new_users(spark, sf))


@query
def read_time_by_item(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.read_time_by_item(views.collect_log(spark, sf))


@query
def clicks_with_read_time(spark: SparkSession, sf: str) -> DataFrame:
    clicks = engagement.feed_clicks(views.click_log(spark, sf))
    return engagement.add_read_time(clicks, engagement.read_time_by_item(views.collect_log(spark, sf)))


@query
def labelled_positions(spark: SparkSession, sf: str) -> DataFrame:
    """The core of the sample build: shown positions of new users, labelled."""
    inputs = views.sample_inputs(spark, sf)
    rows = hourly.labelled_positions(inputs, hourly.HotKeys.of(inputs.impressions))
    return rows.select("row_id", "uid", "device", "wlx_content_id", "content_id", "recall_from", "pos",
                       "click", "read_time", "ds", "hh")


@query
def labelled_positions_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a log with a hot user and item: every key salted, the copies of each row written by several tasks."""
    inputs = views.sample_inputs(spark, sf, views.hot_events(spark, sf))
    hot = hourly.HotKeys.of(inputs.impressions, engagement.feed_clicks(inputs.click_log), rows_per_task=20)
    rows = hourly.labelled_positions(inputs, hot, tasks=16)
    keys = ["row_id", "wlx_content_id", "content_id", "pos", "click", "read_time"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


# --- features --------------------------------------------------------------------


@query
def reply_values(spark: SparkSession, sf: str) -> DataFrame:
    """Replies flattened to one row per named value; lists shown joined."""
    flat = feature_slots.flatten_replies(views.replies(spark, sf))
    return flat.select("entity_id", "errcode", "ord", "feature_name", "string_value",
                       F.array_join("array_value", ";").alias("array_text"), "float_value")


@query
def reply_slots(spark: SparkSession, sf: str) -> DataFrame:
    return feature_slots.slot_table(feature_slots.flatten_replies(views.replies(spark, sf)), S.ITEM_SLOTS)


@query
def typed_values(spark: SparkSession, sf: str) -> DataFrame:
    return feature_slots.parse_values(views.item_snapshot(spark, sf), S.ITEM_SLOTS)


@query
def item_slots(spark: SparkSession, sf: str) -> DataFrame:
    return feature_slots.slot_table(views.item_snapshot(spark, sf), S.ITEM_SLOTS)


@query
def user_slots(spark: SparkSession, sf: str) -> DataFrame:
    return feature_slots.slot_table(views.user_snapshot(spark, sf), S.USER_SLOTS)


@query
def item_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Features of each distinct shown item, looked up once."""
    shows = exposure.explode_positions(views.impressions(spark, sf))
    items = feature_slots.slot_table(views.item_snapshot(spark, sf), S.ITEM_SLOTS)
    return feature_slots.lookup_once(shows, "content_id", items, S.ITEM_SLOTS)


@query
def item_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    impressions = views.impressions(spark, sf)
    items = feature_slots.slot_table(views.item_snapshot(spark, sf), S.ITEM_SLOTS)
    rows = feature_slots.attach_slots(
        exposure.explode_positions(impressions), "content_id", items, S.ITEM_SLOTS,
        hourly.HotKeys.of(impressions).items,
    )
    return rows.select("row_id", "content_id", "pos", feature_slots.slot_record(S.ITEM_SLOTS).alias("item_feature"))


@query
def user_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    impressions = views.impressions(spark, sf)
    users = feature_slots.slot_table(views.user_snapshot(spark, sf), S.USER_SLOTS)
    rows = feature_slots.attach_slots(
        impressions, "uid", users, S.USER_SLOTS, hourly.HotKeys.of(impressions).users)
    return rows.select("row_id", "uid", feature_slots.slot_record(S.USER_SLOTS).alias("user_feature"))


def _bucketed(spark: SparkSession, name: str, snapshot: DataFrame, slots: list[S.FeatureSlot]) -> DataFrame:
    """A snapshot's slot values written to a bucketed table as one day beside an emptied other one, and read back."""
    path = scratch_path(spark, name)
    table = f"{name}_" + path.rsplit("-", 1)[1]
    snapshots.create_slot_table(spark, table, path, slots, buckets=16)
    made = feature_slots.slot_table(snapshot, slots)
    snapshots.publish_slots(made, table, "2024-01-15")
    snapshots.publish_slots(made.limit(0), table, "2024-01-16")
    return snapshots.slots_of_day(spark, table, "2024-01-15")


@query
def item_enrichment_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Items of shown positions with the values of a bucketed snapshot, hot ones cut from 50 rows on."""
    impressions = views.impressions(spark, sf)
    rows = feature_slots.attach_bucketed_slots(
        exposure.explode_positions(impressions), "content_id", _bucketed(spark, "item_slots", views.item_snapshot(spark, sf), S.ITEM_SLOTS),
        S.ITEM_SLOTS, hourly.HotKeys.of(impressions, rows_per_task=50).items)
    return rows.select("row_id", "content_id", "pos", feature_slots.slot_record(S.ITEM_SLOTS).alias("item_feature"))


@query
def user_enrichment_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Users of impressions with the values of a bucketed snapshot."""
    rows = feature_slots.attach_bucketed_slots(
        views.impressions(spark, sf), "uid", _bucketed(spark, "user_slots", views.user_snapshot(spark, sf), S.USER_SLOTS), S.USER_SLOTS)
    return rows.select("row_id", "uid", feature_slots.slot_record(S.USER_SLOTS).alias("user_feature"))


# --- samples -----------------------------------------------------------------------


@query
def full_samples(spark: SparkSession, sf: str) -> DataFrame:
    inputs = views.sample_inputs(spark, sf)
    return hourly.build_samples(inputs, hourly.HotKeys.of(inputs.impressions))


@query
def full_samples_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The samples by way of the staged tables of the job, hot keys counted on the rows of each join and cut from 50 rows on."""
    inputs = views.sample_inputs(spark, sf)
    clicks = stage(audience.folded_clicks(engagement.feed_clicks(inputs.click_log)), "clicks")
    hot = hourly.HotKeys.of(inputs.impressions, clicks, rows_per_task=50)
    labelled = hourly.labelled_positions(inputs, hot, expand=False, clicks=clicks)
    labelled = stage(split_copies(labelled, "copies", 10), "labelled")
    return hourly.build_samples(inputs, hot.of_labelled(labelled, rows_per_task=50), labelled=labelled)


@query
def job_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The whole hourly job over all events as one hour: rejected impressions by device and problem, with the report's count of the problem."""
    base = scratch_path(spark, "job")
    hour = {"ds": F.lit("2024-01-15"), "hh": F.lit("12")}
    tables = {
        "events": views.event_log(spark, sf).drop("row_id").withColumns(hour), "collect": views.collect_log(spark, sf).withColumns(hour),
        "users": views.new_user_dimension(spark, sf), "items": views.item_snapshot(spark, sf), "profiles": views.user_snapshot(spark, sf)}
    for name, rows in tables.items():
        writer = rows.write.partitionBy("ds", "hh") if "ds" in rows.columns else rows.write
        writer.parquet(f"{base}/{name}")
    job = hourly.HourlyJob(
        event_log=f"{base}/events", collect_log=f"{base}/collect", new_users=f"{base}/users", item_features=f"{base}/items",
        user_features=f"{base}/profiles", samples=f"{base}/samples", rejects=f"{base}/rejects", rows_per_task=5000)
    report = hourly.run_hour(spark, job, "2024-01-15", "12")
    reported = F.create_map(*[x for p, n in report.problems.items() for x in (F.lit(p), F.lit(n).cast("bigint"))])
    rejects = spark.read.parquet(f"{base}/rejects/ds=2024-01-15/hh=12")
    written = spark.read.parquet(f"{base}/samples/ds=2024-01-15/hh=12").count()
    return rejects.groupBy("device", "problem").agg(F.count(F.lit(1)).alias("n")).select(
        "device", "problem", "n", reported[F.col("problem")].alias("reported"), F.lit(report.impressions).cast("bigint").alias("impressions"),
        F.lit(written == report.samples).alias("all_written"))


@query
def sample_records(spark: SparkSession, sf: str) -> DataFrame:
    inputs = views.sample_inputs(spark, sf)
    return hourly.build_records(inputs, hourly.HotKeys.of(inputs.impressions))


@query
def training_label(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen features with a boolean label."""
    rows = hourly.build_samples(views.sample_inputs(spark, sf))
    picked = samples.training_rows(rows, samples.NUMERIC_FEATURES)
    return picked.withColumn("label", F.col("label").cast("int"))


# --- sinks, read back ----------------------------------------------------------------


def _light_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Sample-shaped rows straight from the positions, by day."""
    shows = exposure.explode_positions(views.impressions(spark, sf))
    return shows.select(
        F.coalesce("uid", "device").alias("u_id"), F.col("device").alias("u_device_id"),
        F.col("content_id").cast("bigint").alias("u_content_id"),
        F.concat_ws(",", "content_id", "pos").alias("u_favocate5"), F.col("pos").alias("i_pos"), "ds", "hh",
    )


_LIGHT_SCHEMA = T.StructType([
    S.SAMPLE_SCHEMA[c] for c in ("u_id", "u_device_id", "u_content_id", "u_favocate5", "i_pos")
])


@query
def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """All partitions written, one day written again with changed rows, everything read back."""
    path = scratch_path(spark, "overwrite")
    rows = _light_samples(spark, sf)
    sinks.write_partitions(rows, path)
    again = rows.where(F.col("ds") == "2024-01-15").withColumn("i_pos", F.col("i_pos") + 100)
    sinks.write_partitions(again, path)
    return sinks.read_partitions(spark, path, _LIGHT_SCHEMA)


@query
def partition_switched(spark: SparkSession, sf: str) -> DataFrame:
    """Days published in a table; one published again with changed rows, and once more by a write that fails half-way."""
    path = scratch_path(spark, "switched")
    table = "samples_" + path.rsplit("-", 1)[1]
    rows = stage(_light_samples(spark, sf).withColumn("hh", F.concat("hh", F.lit(""))), "light")
    sinks.create_sample_table(spark, table, path, T.StructType([*_LIGHT_SCHEMA, T.StructField("hh", T.StringType())]), by=["ds"], fmt="parquet")
    days = [r["ds"] for r in rows.select("ds").distinct().collect()]
    for day in days:
        sinks.publish_partition(rows.where(F.col("ds") == day), table, path, {"ds": day}, files=1)
    changed = rows.where(F.col("ds") == "2024-01-15").withColumn("i_pos", F.col("i_pos") + 100)
    sinks.publish_partition(changed, table, path, {"ds": "2024-01-15"})
    broken = changed.withColumn("i_pos", F.when(F.col("i_pos") == 102, F.raise_error(F.lit("half-way"))).otherwise(F.col("i_pos")).cast("int"))
    try:
        sinks.publish_partition(broken, table, path, {"ds": "2024-01-15"})
    except Exception as error:  # noqa: BLE001
        if "half-way" not in str(error):
            raise
    sinks.expire_versions(spark, table, path, {"ds": "2024-01-15"}, keep=0)
    return spark.table(table)


@query
def partition_emptied(spark: SparkSession, sf: str) -> DataFrame:
    """Hours written one by one, one of them written again without rows, everything read back."""
    path = scratch_path(spark, "emptied")
    rows = _light_samples(spark, sf)
    sinks.write_partitions(rows, path)
    hour = {"ds": "2024-01-15", "hh": "12"}
    gone = rows.where("false")
    sinks.write_partitions(gone, path, one_partition=hour)
    return sinks.read_partitions(spark, path, _LIGHT_SCHEMA)


_ODD_TEXTS = """case doc_id % 6 when 0 then text when 1 then concat('  ', substr(text, 1, 30), '  ') when 2 then ''
                when 3 then null when 4 then replace(replace(text, ' ', '\\\\n'), 'e', '"') else concat(',', substr(text, 1, 5), '\\r') end"""


@query
def texts_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks, quotes, backslashes, outer spaces, empty and missing, written as delimited text and read."""
    path = scratch_path(spark, "texts")
    rows = views.table(spark, sf, "documents").select("doc_id", F.expr(_ODD_TEXTS).alias("text"))
    sinks.write_delimited(rows, path, files=3)
    return delimited.read_delimited(spark, path, schema=rows.schema, defaults={})


@query
def lines_kept_apart(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the right form, and those with a bad number, too few or too many fields, by the kind of line."""
    schema = T.StructType([T.StructField("who", T.StringType()), T.StructField("age", T.IntegerType()), T.StructField("what", T.StringType())])
    line = F.expr("""concat('u', o_custkey, case o_orderkey % 5 when 0 then ',abc,x' when 1 then ',7' when 2 then ',7,x,y' when 3 then ',,x'
                     else ',7,' end)""")
    lines = views.table(spark, sf, "orders").select((F.col("o_orderkey") % 5).alias("kind"), line.alias("value"))
    good = delimited.parse_delimited(lines, "value", schema=schema, defaults={"age": -1, "what": "none"})
    bad = delimited.bad_lines(lines, "value", schema=schema)
    return good.groupBy("kind", "age", "what").count().unionByName(bad.groupBy("kind").count(), allowMissingColumns=True)


@query
def registered_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """An external delimited table whose day partitions are registered one by one, twice."""
    path = scratch_path(spark, "registered")
    table = "samples_" + path.rsplit("-", 1)[1]
    rows = _light_samples(spark, sf).drop("hh")
    sinks.write_partitions(rows, path, by=["ds"], fmt="csv")
    sinks.create_sample_table(spark, table, path, _LIGHT_SCHEMA, by=["ds"])
    for day in ("2024-01-15", "2024-01-16", "2024-01-15"):
        sinks.add_partition(spark, table, f"{path}/ds={day}", ds=day)
    return spark.table(table)


@query
def recovered_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with all partitions found by a repair."""
    path = scratch_path(spark, "recovered")
    table = "samples_" + path.rsplit("-", 1)[1]
    sinks.write_partitions(_light_samples(spark, sf).drop("hh"), path, by=["ds"], fmt="csv")
    sinks.create_sample_table(spark, table, path, _LIGHT_SCHEMA, by=["ds"])
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


@query
def delimited_files(spark: SparkSession, sf: str) -> DataFrame:
    """Delimited text with commas inside fields, written to 4 files and read with defaults."""
    path = scratch_path(spark, "delimited")
    sinks.write_delimited(_light_samples(spark, sf).drop("ds", "hh"), path, files=4)
    return delimited.read_delimited(spark, path, schema=_LIGHT_SCHEMA, defaults={"i_pos": 0})


@query
def item_id_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "items")
    sinks.write_text(exposure.distinct_items(views.impressions(spark, sf)), path)
    return spark.read.text(path).withColumnRenamed("value", "content_id")


@query
def metric_log_files(spark: SparkSession, sf: str) -> DataFrame:
    """Metric records appended as JSON lines in two goes."""
    path = scratch_path(spark, "metrics")
    records = runlog.metric_records(views.metrics(spark, sf))
    sinks.append_metrics(records.where(F.col("unit").isNull()), path)
    sinks.append_metrics(records.where(F.col("unit").isNotNull()), path)
    return _flat_metrics(sinks.read_metrics(spark, path))


@query
def merged_metric_files(spark: SparkSession, sf: str) -> DataFrame:
    """Metric records appended in many goes, merged, appended to again, replaced files removed; everything read back."""
    path = scratch_path(spark, "merged-metrics")
    records = stage(runlog.metric_records(views.metrics(spark, sf)), "records")
    part = F.pmod("global_step", F.lit(5))
    for i in range(4):
        sinks.append_metrics(records.where(part == i), path)
    sinks.merge_metrics(spark, path)
    sinks.append_metrics(records.where(part == 4), path)
    sinks.merge_metrics(spark, path)
    sinks.remove_merged(spark, path)
    return _flat_metrics(sinks.read_metrics(spark, path))


@query
def run_description_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    sinks.write_runs(runlog.run_records(views.runs(spark, sf)), path)
    return _flat_runs(sinks.read_runs(spark, path))


@query
def run_store(spark: SparkSession, sf: str) -> DataFrame:
    """Runs, statuses and metrics appended to a store; each run with its latest status and metric count."""
    store = sinks.RunStore(spark, scratch_path(spark, "store"))
    store.append("runs", runlog.run_records(views.runs(spark, sf)))
    store.append("statuses", views.statuses(spark, sf))
    store.append("metrics", runlog.metric_records(views.metrics(spark, sf)))
    counts = store.read("metrics").groupBy("run_id").agg(F.count(F.lit(1)).alias("metrics"))
    return (
        store.read("runs").select("run_id", F.col("dataset.name").alias("dataset"))
        .join(runlog.latest_status(store.read("statuses")).drop("ts"), "run_id", "left")
        .join(counts, "run_id", "left")
        .select("run_id", "dataset", "status", F.coalesce("metrics", F.lit(0)).alias("metrics"))
    )


@query
def run_store_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses by day, all running at first, those of the runs that ended replaced."""
    store = sinks.DatedRunStore(spark, scratch_path(spark, "dated-store"))
    store.upsert("statuses", views.run_statuses(spark, sf, ended=False))
    store.upsert("statuses", views.run_statuses(spark, sf, ended=True))
    return store.read("statuses").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


# --- encoding ----------------------------------------------------------------------------

_SPEC = encoding.EncoderSpec()
_KEYS = ["l_orderkey", "l_linenumber", "fea2"]


def _encoded(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*_KEYS, *names)


@query
def even_edge_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows fall in each bucket of fea17, with the edges around it."""
    lo, hi, n = encoding.EVEN_EDGES["fea17"]
    rows = encoding.add_bucket_ids(views.features(spark, sf)).select(
        F.col("fea17_bucket").alias("bucket"), even_edges(lo, hi, n).alias("edges"))
    edge = F.round(F.try_element_at("edges", F.col("bucket").cast("int")), 6)
    return rows.where(F.col("bucket") > 0).groupBy("bucket", edge.alias("lower_edge")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def bucket_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encoding.add_bucket_ids(views.features(spark, sf)), list(_SPEC.bucket_ids()))


@query
def uneven_buckets(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return encoding.bucketize(rows, "l_quantity", [1, 2, 10, 49.5], "bucket")


@query
def hash_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encoding.add_hash_ids(views.features(spark, sf)), list(_SPEC.hash_ids()))


@query
def cross_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encoding.add_cross_ids(views.features(spark, sf)), list(_SPEC.cross_ids()))


@query
def bucket_cross_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encoding.add_bucket_cross_ids(views.features(spark, sf)), list(_SPEC.bucket_cross_ids()))


@query
def wide_positions(spark: SparkSession, sf: str) -> DataFrame:
    rows = encoding.add_wide_positions(views.features(spark, sf))
    return rows.select(*_KEYS, F.array_join(F.col("wide").cast("array<string>"), " ").alias("wide"))


@query
def numeric_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.features(spark, sf)
    return encoding.numeric(rows, encoding.DEEP_NUMERIC).select("l_orderkey", "l_linenumber", *encoding.DEEP_NUMERIC)


# --- training order -------------------------------------------------------------------------


@query
def shuffled_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return batching.shuffle_rows(orders, "o_orderkey", seed=11)


@query
def epochs(spark: SparkSession, sf: str) -> DataFrame:
    return batching.repeat_epochs(views.table(spark, sf, "orders").select("o_orderkey"), 3)


def _sharded(spark: SparkSession, sf: str) -> DataFrame:
    shard = batching.shard_of(F.col("o_orderkey") % 128, 70)
    return views.table(spark, sf, "orders").select("o_orderkey", shard.alias("shard"))


@query
def batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.add_batches(_sharded(spark, sf), "o_orderkey", 16, seed=11, shard="shard")


@query
def batches_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """One numbering over the whole table and two epochs, with no task that sees all rows."""
    rows = batching.repeat_epochs(views.table(spark, sf, "orders").select("o_orderkey"), 2)
    return batching.add_batches(rows, "o_orderkey", 1024, seed=11, epoch="epoch")


@query
def capped_steps(spark: SparkSession, sf: str) -> DataFrame:
    return batching.cap_steps(batches(spark, sf), 3)


# --- run log -----------------------------------------------------------------------------------


def _flat_metrics(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "extras", F.array_join(F.transform("extras", lambda e: F.concat(e["name"], F.lit("="), e["value"])), ";"))


def _flat_runs(records: DataFrame) -> DataFrame:
    def shown(p: Column) -> Column:
        return F.concat_ws(
            ":", p["name"], F.coalesce(p["string_value"], F.lit("-")),
            F.coalesce(p["long_value"].cast("string"), F.lit("-")), F.coalesce(p["bool_value"], F.lit("-")),
            F.coalesce(p["float_value"].cast("string"), F.lit("-")))

    return records.select(
        "run_id", "model_name", F.col("dataset.name").alias("dataset"), "test_id", "run_date",
        F.array_join(F.transform("run_parameters", shown), ";").alias("parameters"))


@query
def metric_records(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_metrics(runlog.metric_records(views.metrics(spark, sf)))


@query
def run_records(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_runs(runlog.run_records(views.runs(spark, sf)))


@query
def numeric_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.numeric_metrics(views.metrics(spark, sf)).select("run_id", "name", "global_step", "value")


@query
def sorted_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.sorted_metrics(numeric_metrics(spark, sf))


@query
def latest_status(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.latest_status(views.statuses(spark, sf)).withColumn("ts", F.col("ts").cast("string"))


@query
def sampled_by_steps(spark: SparkSession, sf: str) -> DataFrame:
    rows = runlog.numeric_metrics(views.metrics(spark, sf))
    return runlog.sample_metrics(rows, every_n_steps=500).select("run_id", "name", "global_step", "value")


@query
def sampled_by_seconds(spark: SparkSession, sf: str) -> DataFrame:
    rows = runlog.numeric_metrics(views.metrics(spark, sf))
    picked = runlog.sample_metrics(rows, every_n_secs=30 * 86400)
    return picked.select("run_id", "name", "global_step", "value")


@query
def sampled_by_trigger(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics at least 500 steps after the one taken before."""
    rows = runlog.numeric_metrics(views.metrics(spark, sf))
    return runlog.sample_by_trigger(rows, every_n_steps=500, chunk=4000).select("run_id", "name", "global_step", "value")


@query
def ticks_by_trigger(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks with gaps, at least 10 seconds after the one taken before."""
    return runlog.sample_by_trigger(views.gapped_ticks(spark, sf), every_n_secs=10, by=["run_id"], chunk=60_000_000).select("run_id", "global_step")


@query
def throughput_by_trigger(spark: SparkSession, sf: str) -> DataFrame:
    rates = runlog.examples_per_second(views.gapped_ticks(spark, sf), 1024, every_n_steps=4, warm_steps=20, chunk_steps=100, trigger=True)
    return _rounded_rates(rates)


@query
def final_values(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.final_values(runlog.numeric_metrics(views.metrics(spark, sf)))


def _rounded_rates(rates: DataFrame) -> DataFrame:
    return rates.select("run_id", "global_step", F.round("current_examples_per_sec", 4).alias("current_rate"),
                        F.round("average_examples_per_sec", 4).alias("average_rate"))


@query
def throughput_by_steps(spark: SparkSession, sf: str) -> DataFrame:
    rates = runlog.examples_per_second(
        views.ticks(spark, sf), 1024, every_n_steps=4, warm_steps=20, chunk_steps=100)
    return _rounded_rates(rates)


@query
def throughput_by_seconds(spark: SparkSession, sf: str) -> DataFrame:
    rates = runlog.examples_per_second(views.ticks(spark, sf), 1024, every_n_secs=10, warm_steps=5, chunk_steps=100)
    return _rounded_rates(rates)


@query
def stop_steps(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.stop_steps(numeric_metrics(spark, sf), 495000.0)


# --- evaluation and training --------------------------------------------------------------------


_MEASURES = ["accuracy", "accuracy_baseline", "precision", "recall", "label_mean", "prediction_mean",
             "average_loss", "loss"]


def _rounded(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.withColumns({c: F.round(c, 5) for c in names})


@query
def evaluation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.evaluate(views.scored(spark, sf), by=["l_linestatus"]), _MEASURES)


@query
def evaluation_overall(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.evaluate(views.scored(spark, sf)), _MEASURES)


@query
def areas_under_curves(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        evaluation.areas(views.scored(spark, sf), bins=512, by=["l_linestatus"]), ["auc", "auc_precision_recall"])


@query
def areas_overall(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.areas(views.scored(spark, sf), bins=512), ["auc", "auc_precision_recall"])


@query
def areas_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.areas_exact(views.scored(spark, sf), by=["l_linestatus"], slices=7), ["auc", "auc_precision_recall"])


@query
def areas_exact_overall(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.areas_exact(views.scored(spark, sf)), ["auc", "auc_precision_recall"])


def _training(spark: SparkSession) -> training.TrainingSpec:
    return training.TrainingSpec()


def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Features, a label that they tell, and the split."""
    rows = views.features(spark, sf)
    keys = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("fea2")]
    label = F.expr("cast(l_linenumber in (1, 2) and fea7 < 45 or fea22 = 7 as int)").alias("label")
    return rows.select(*_KEYS[:2], *_SPEC.hashed, label, split_flag(*keys).alias("r_type"))


def _trained(model_type: str, least_auc: float = 0.75) -> Query:
    """What the data alone tell of the test part, and whether the model beats knowing no more than that."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        _, metrics = training.train_and_evaluate(_training_rows(spark, sf), model_type, _training(spark))
        mean = F.col("label_mean")
        entropy = -(mean * F.ln(mean) + (1 - mean) * F.ln(1 - mean))
        return metrics.select(
            "examples", "unscored", F.round(mean, 6).alias("label_mean"), F.round("accuracy_baseline", 6).alias("accuracy_baseline"),
            (F.col("auc") > least_auc).alias("ranks"), (F.col("average_loss") < entropy).alias("beats_the_mean"))

    return run


@query
def wide_vector(spark: SparkSession, sf: str) -> DataFrame:
    """Size and places of the vectors that the wide model is fitted on."""
    spec = training.TrainingSpec(encoder=_SPEC)
    rows = views.features(spark, sf)
    for step in training.build_pipeline(training.WIDE, spec).getStages()[:2]:
        rows = step.transform(rows)
    parts = F.from_json(F.get_json_object(F.to_json(F.struct("wide_features")), "$.wide_features"), "size int, indices array<bigint>")
    return rows.select(*_KEYS[:2], parts["size"].alias("size"), F.array_join(parts["indices"].cast("array<string>"), " ").alias("wide"))


@query
def train_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(training.WIDE)(spark, sf)


@query
def train_deep(spark: SparkSession, sf: str) -> DataFrame:
    # the hashed dense form alone ranks less well: README
    return _trained(training.DEEP, least_auc=0.65)(spark, sf)


@query
def train_wide_deep(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(training.WIDE_DEEP)(spark, sf)


@query
def export_and_score(spark: SparkSession, sf: str) -> DataFrame:
    """A model saved, loaded and applied to all rows, by label: does it score as before, and does it tell them apart?"""
    path = scratch_path(spark, "model")
    rows = _training_rows(spark, sf)
    model = training.fit(rows.where(F.col("r_type") == 1), training.WIDE, _training(spark))
    training.export_model(model, path)
    before = training.score(model, training.spread(rows), training.WIDE, rows.columns).withColumnRenamed("score", "before")
    both = training.score(training.load_model(path), before, training.WIDE, ["label", "before"])
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("score") == F.col("before")).alias("same"),
        ((F.avg("score") > 0.5) == (F.first("label") == 1)).alias("right"))
