"""Where staged tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder the session names.

    A session without that setting stages under its warehouse. On a cluster that must not be a folder of the driver's
    machine, as it is by default.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("/", "file:")):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share: the warehouse {warehouse} is a local folder")
        base = f"{warehouse}/_staged"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write once, read many: cuts the lineage and survives the loss of executors."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def drop_staged(rows: DataFrame) -> None:
    """Remove the folder of a staged frame; later reads of it fail."""
    spark = rows.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
