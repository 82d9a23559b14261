"""Daily slot snapshots, bucketed by entity, so that the hourly joins of a day don't shuffle them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas as S

#: Buckets of a new table: about as many as the tasks of the joins that read it.
BUCKETS = 1024


def create_slot_table(spark: SparkSession, table: str, location: str, slots: Sequence[S.FeatureSlot], buckets: int = BUCKETS) -> None:
    """External table of slot values by day, each day in ``buckets`` by entity id; one that exists is left as it is."""
    columns = ", ".join(["entity_id string", *(f"`{s.column}` string" for s in slots)])
    spark.sql(f"create table if not exists {table} ({columns}, ds string) using parquet partitioned by (ds)"
              f" clustered by (entity_id) into {buckets} buckets location '{location}'")


def buckets_of(spark: SparkSession, table: str) -> int:
    found = spark.sql(f"describe table extended {table}").where(F.col("col_name") == "Num Buckets").first()
    if found is None:
        raise ValueError(f"{table} is not bucketed")
    return int(found["data_type"])


def publish_slots(made: DataFrame, table: str, ds: str) -> None:
    """Write one row of slot values per entity (``feature_slots.slot_table``) as the day ``ds``, replacing that day only.

    Rows are dealt as the table's buckets are, so each bucket is one file. An id is in one bucket, however many rows join it later.
    """
    spark = made.sparkSession
    names = [c for c in spark.table(table).columns if c != "ds"]
    day = ds.replace("'", "''")
    dealt = made.select(*names).repartition(buckets_of(spark, table), "entity_id")
    spark.sql(f"insert overwrite table {table} partition (ds = '{day}') select * from {{made}}", made=dealt)


def slots_of_day(spark: SparkSession, table: str, ds: str) -> DataFrame:
    """``entity_id`` and slot values of a day, read by bucket; other days are pruned."""
    return spark.table(table).where(F.col("ds") == ds).drop("ds")
