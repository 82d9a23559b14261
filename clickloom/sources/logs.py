"""Scans of the partitioned logs, the dimension and the snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.operators.exposure import log_field

IMPRESSION_CMD = "100"
CLICK_CMD = "300"
READ_TIME_CMD = "4034"


def read_table(spark: SparkSession, path: str, schema: T.StructType, row_id: bool = False) -> DataFrame:
    """Partitioned Parquet with a declared schema (partition values stay text).

    ``row_id`` adds a number per row from file and position. It is the same on
    every run of a task, and tells exact copies apart.
    """
    table = spark.read.schema(schema).parquet(path)
    if row_id:
        table = table.withColumn("row_id", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    return table


def log_hour(log: DataFrame, ds: str, hh: str, cmd: str) -> DataFrame:
    """One hour and one command of the event log; prunes partitions ``ds`` and ``hh``."""
    return log.where((F.col("ds") == ds) & (F.col("hh") == hh) & (F.col("cmd") == cmd))


def log_day(log: DataFrame, ds: str, cmd: str) -> DataFrame:
    """All hours of one day."""
    return log.where((F.col("ds") == ds) & (F.col("cmd") == cmd))


def impressions_of(log: DataFrame) -> DataFrame:
    """What the impression side needs; two texts leave the map here, so no join shuffles the rest of it."""
    extra = [c for c in ("row_id", "ds", "hh") if c in log.columns]
    return log.select(
        F.col("cookie_id").alias("uid"),
        "device",
        log_field("content").alias("content"),
        log_field("props").alias("props"),
        *extra,
    )


def item_attributes(table: DataFrame, ds: str) -> DataFrame:
    """Item attributes of one day."""
    return table.where(F.col("ds") == ds).select(
        "id",
        F.col("type").alias("cate"),
        "cover_show_type",
        "content_type",
        "subcategory",
        "source_name",
        "video_play_time",
        F.col("keywords_v2").alias("keywords"),
        "topic",
    )


def user_profiles(table: DataFrame, day: str) -> DataFrame:
    """User profiles of one day; the install source falls back to the second code."""
    return table.where(F.col("day") == day).select(
        F.col("member_id").alias("user_id"),
        F.col("last_login_device").alias("device"),
        F.col("reg_prov").alias("prov"),
        F.col("reg_city").alias("city"),
        F.col("sex").alias("gender"),
        F.col("last_login_client").alias("phone_client"),
        F.coalesce("wlx_package_code", "nlx_source_code").alias("dtu"),
        F.col("install_app_list").alias("app_list"),
    )


def feature_snapshot(spark: SparkSession, path: str, ds: str | None = None) -> DataFrame:
    """Long-form feature values that stand in for the feature services.

    ``ds`` is the day of the snapshot: values are those of that day, where a
    live service would answer with those of the moment.
    """
    if ds is None:
        return spark.read.schema(S.FEATURE_SNAPSHOT_SCHEMA).parquet(path)
    schema = T.StructType([*S.FEATURE_SNAPSHOT_SCHEMA, T.StructField("ds", T.StringType())])
    return spark.read.schema(schema).parquet(path).where(F.col("ds") == ds).drop("ds")
