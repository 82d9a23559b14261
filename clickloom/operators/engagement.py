"""Clicks, read time and the labels made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import to_double, usable_id
from clickloom.operators.exposure import log_field
from clickloom.operators.joins import count_copies, expand_copies, skew_join

# Log codes of the click and read-time filters.
FEED_CHANNEL = "255"
FEED_SOURCE = "11"
APP_VIEW = "2"


def feed_clicks(log: DataFrame) -> DataFrame:
    """Clicks from the feed. A click without ``is_appview`` is dropped: NULL <> '2' is not true."""
    return log.where(
        (log_field("channel") == FEED_CHANNEL)
        & (log_field("from") == FEED_SOURCE)
        & (log_field("is_appview") != APP_VIEW)
    ).select(
        F.col("cookie_id").alias("user_id"), "device", log_field("content_id").alias("content_id")
    )


def read_time_by_item(log: DataFrame) -> DataFrame:
    """Longest read time per (device, member, item).

    The user is the member id or else the device. A user on several devices has
    several rows here and meets each of them in :func:`add_read_time`.
    """
    return (
        log.where(
            (log_field("channel") == FEED_CHANNEL)
            & log_field("selectedId").isNotNull()
            & usable_id("device")
        )
        .groupBy("device", "header_mi", log_field("selectedId").alias("content_id"))
        .agg(F.max(to_double(log_field("useTime"))).alias("read_time"))
        # the user follows from the keys; a text maximum would turn this into a sort aggregate
        .select(
            F.coalesce("header_mi", "device").alias("user_id"), "header_mi", "device", "read_time", "content_id"
        )
    )


def add_read_time(
    clicks: DataFrame, read_time: DataFrame, hot_users: DataFrame | None = None, expand: bool = True
) -> DataFrame:
    """Clicks with the read time of (user, item), 0.0 when there is none.

    Equal clicks (``clicks`` may carry ``copies`` already) and equal read times of a
    pair are folded before the join.
    """
    if "copies" not in clicks.columns:
        clicks = count_copies(clicks, clicks.columns, "copies")
    folded = count_copies(read_time, ["user_id", "content_id", "read_time"], "_times")
    joined = skew_join(clicks, folded, ["user_id", "content_id"], "left", hot_users)
    rows = joined.select(
        *[c for c in clicks.columns if c != "copies"],
        F.coalesce("read_time", F.lit(0.0)).alias("read_time"),
        (F.col("copies") * F.coalesce("_times", F.lit(1))).alias("copies"),
    )
    return expand_copies(rows, "copies") if expand else rows


def label_clicks(
    shows: DataFrame, clicks: DataFrame, hot_pairs: DataFrame | None = None, expand: bool = True, tasks: int | None = None
) -> DataFrame:
    """Shows with ``click`` and ``read_time``: clicked when a click of (item, device) exists.

    All pairs are kept, so n clicks of one show give n rows. Clicks are folded
    by read time before they are shuffled. ``tasks`` spreads the copies of a row that stands for many when they are written out.
    """
    if "copies" not in shows.columns:
        shows = shows.withColumn("copies", F.lit(1).cast("bigint"))
    weight = "copies" if "copies" in clicks.columns else None
    folded = count_copies(clicks, ["content_id", "device", "read_time"], "_clicks", weight)
    joined = skew_join(shows, folded, ["content_id", "device"], "left", hot_pairs)
    # the flag asks for the match, so it comes before the default fills read_time
    rows = joined.select(
        *[c for c in shows.columns if c != "copies"],
        F.col("_clicks").isNotNull().cast("int").alias("click"),
        F.coalesce("read_time", F.lit(0.0)).alias("read_time"),
        (F.col("copies") * F.coalesce("_clicks", F.lit(1))).alias("copies"),
    )
    return expand_copies(rows, "copies", tasks) if expand else rows
