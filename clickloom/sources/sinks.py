"""Writers: partition tables, text files, registered partitions, run-log records."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.sources.delimited import READ_OPTIONS, TEXT_OPTIONS, escape_lines, unescape_lines
from clickloom.sources.scratch import drop_staged, stage


def _sized(rows: DataFrame, files: int | None, *by: str) -> DataFrame:
    """Even output files: ``files`` of them, or as many as AQE finds right (it splits large ones)."""
    return rows.repartition(files) if files else rows.hint("rebalance", *by)


def write_partitions(
    rows: DataFrame,
    path: str,
    by: Sequence[str] = ("ds", "hh"),
    fmt: str = "parquet",
    files: int | None = None,
    sep: str = ",",
    one_partition: Mapping[str, str] | None = None,
    spread: bool = False,
) -> None:
    """Replace just the partitions that ``rows`` has; all others stay. Safe to run again.

    Rows are brought together by partition so that each gets few files. When all
    rows belong to ``one_partition`` (its values) they are spread evenly instead, and its folder is
    replaced even if there are no rows: then it is left empty. Rows that are ``spread`` already are written as they lie.
    """
    rows = escape_lines(rows) if fmt == "csv" else rows
    if one_partition is not None:
        path = "/".join([path.rstrip("/"), *(f"{c}={one_partition[c]}" for c in by)])
        rows = rows.drop(*by)
        writer = (rows if spread else _sized(rows, files)).write.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = _sized(rows, files, *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    (writer.options(sep=sep, **TEXT_OPTIONS).csv(path) if fmt == "csv" else writer.format(fmt).save(path))


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ("ds", "hh"),
    fmt: str = "parquet", sep: str = ",",
) -> DataFrame:
    """Read a partitioned folder back with declared types, partition values as text; texts come back as they were written."""
    full = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in schema],
        *[T.StructField(c, T.StringType()) for c in by],
    ])
    reader = spark.read.schema(full)
    if fmt == "csv":
        return unescape_lines(reader.options(sep=sep, **READ_OPTIONS).csv(path), *by)
    return reader.format(fmt).load(path)


def write_text(rows: DataFrame, path: str, files: int | None = None, overwrite: bool = True) -> None:
    """One text column as part files. ``overwrite=False`` refuses an existing folder."""
    _sized(rows, files).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_delimited(
    rows: DataFrame, path: str, sep: str = ",", files: int | None = None, overwrite: bool = True
) -> None:
    """Rows as delimited text; a value that holds the delimiter is quoted, line breaks inside values are escaped."""
    mode = "overwrite" if overwrite else "errorifexists"
    _sized(escape_lines(rows), files).write.mode(mode).options(sep=sep, **TEXT_OPTIONS).csv(path)


#: As SQL text: backslashes and quotes inside an option's value are doubled or escaped there.
_TABLE_OPTIONS = {k: v.replace("\\", "\\\\").replace("\0", "\\0") for k, v in READ_OPTIONS.items()}


def _ddl(field: T.StructField) -> str:
    comment = (field.metadata or {}).get("comment", "").replace("'", "''")
    return f"{field.name} {field.dataType.simpleString()}" + (f" comment '{comment}'" if comment else "")


def create_sample_table(
    spark: SparkSession, table: str, location: str, schema: T.StructType = S.SAMPLE_SCHEMA,
    by: Sequence[str] = ("ds", "hh"), sep: str = ",", fmt: str = "csv", replace: bool = True,
) -> None:
    """External partitioned table with column comments; ``replace`` drops an older definition.

    Dropping an external table leaves its files in place. Through a table over text,
    escaped line breaks are seen as they lie in the files.
    """
    if replace:
        spark.sql(f"drop table if exists {table}")
    columns = ", ".join([_ddl(f) for f in schema] + [f"{c} string" for c in by])
    listed = ", ".join(f"{k} '{v}'" for k, v in {"sep": sep, **_TABLE_OPTIONS}.items())
    options = f" options ({listed})" if fmt == "csv" else ""
    spark.sql(
        f"create table if not exists {table} ({columns}) using {fmt}{options}"
        f" partitioned by ({', '.join(by)}) location '{location}'"
    )


def add_partition(spark: SparkSession, table: str, location: str, **values: str) -> None:
    """Register a partition at its folder unless it is there already."""
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    spark.sql(f"alter table {table} add if not exists partition ({spec}) location '{location}'")


VERSIONS = "_versions"


def _partition_folder(values: Mapping[str, str]) -> str:
    return "/".join(f"{k}={v}" for k, v in values.items())


def publish_partition(
    rows: DataFrame, table: str, path: str, values: Mapping[str, str], fmt: str = "parquet", files: int | None = None,
    sep: str = ",", spread: bool = False,
) -> str:
    """Replace one partition of a registered table at once: readers see all of the old rows or all of the new ones.

    The rows go to a folder of their own below ``path`` first. Only when all are written does the table's catalog get the
    new location, in one step; a write that fails leaves the table as it was. The old folder stays for those who
    are reading it, until :func:`expire_versions`. Returns the new folder.
    """
    spark = rows.sparkSession
    folder = f"{path.rstrip('/')}/{VERSIONS}/{_partition_folder(values)}/{uuid.uuid4().hex}"
    made = rows.drop(*values)
    made = escape_lines(made) if fmt == "csv" else made
    writer = (made if spread else _sized(made, files)).write.mode("errorifexists")
    (writer.options(sep=sep, **TEXT_OPTIONS).csv(folder) if fmt == "csv" else writer.format(fmt).save(folder))
    add_partition(spark, table, folder, **values)
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    spark.sql(f"alter table {table} partition ({spec}) set location '{folder}'")
    return folder


def partition_location(spark: SparkSession, table: str, values: Mapping[str, str]) -> str:
    """Folder that the catalog has for a partition."""
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    described = spark.sql(f"describe extended {table} partition ({spec})").where("col_name = 'Location'").first()
    return described["data_type"]


def expire_versions(spark: SparkSession, table: str, path: str, values: Mapping[str, str], keep: int = 1) -> int:
    """Delete the older folders of a partition but ``keep`` of them and the current one; returns how many went.

    ``keep`` is what a reader that started before the last switch may need.
    """
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    base = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{VERSIONS}/{_partition_folder(values)}")
    system = base.getFileSystem(conf)
    current = partition_location(spark, table, values).rstrip("/").rsplit("/", 1)[1]
    old = sorted((f for f in system.listStatus(base) if f.getPath().getName() != current), key=lambda f: -f.getModificationTime())
    for f in old[keep:]:
        system.delete(f.getPath(), True)
    return len(old[keep:])


def append_metrics(records: DataFrame, path: str) -> None:
    """Add metric records as JSON lines."""
    records.write.mode("append").json(path)


_MERGED = "_merged"


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm.org.apache.hadoop.fs.Path


def _merges(spark: SparkSession, path: str) -> list[dict]:
    """The records of all merges so far, in order."""
    base, system, path_of = _file_system(spark, f"{path.rstrip('/')}/{_MERGED}")
    if not system.exists(base):
        return []
    names = sorted(f.getPath().getName() for f in system.listStatus(base) if f.getPath().getName().endswith(".json"))
    out = []
    for name in names:
        stream = system.open(path_of(base, name))
        try:
            out.append(json.loads(bytes(stream.readAllBytes())))
        finally:
            stream.close()
    return out


def metric_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Files that hold the metric log now, with their sizes: what was appended and not merged, and what merges made."""
    base, system, _ = _file_system(spark, path)
    merges = _merges(spark, path)  # before the listing: a merge that ends in between only replaces files that still stand
    found = {}
    for folder in [base, *(_file_system(spark, m["folder"])[0] for m in merges)]:
        for f in system.listStatus(folder) if system.exists(folder) else []:
            if f.isFile() and not f.getPath().getName().startswith(("_", ".")):
                found[f.getPath().toString()] = f.getLen()
    gone = {f for m in merges for f in m["replaced"]}
    return {f: n for f, n in found.items() if f not in gone}


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metric log; appends and merges that end later are not seen by this read."""
    files = list(metric_files(spark, path))
    reader = spark.read.schema(S.METRIC_SCHEMA)
    return reader.json(files) if files else spark.createDataFrame([], S.METRIC_SCHEMA)


def merge_metrics(spark: SparkSession, path: str, small: int = 16 << 20, target: int = 128 << 20) -> int:
    """Merge files of less than ``small`` bytes into ones of about ``target``; returns how many were replaced.

    The merged files go to a hidden folder. One record, created under a fresh number, then names them and the files they
    replace: until it stands readers take the old files, from then on the new ones, never both. Files appended meanwhile are not
    named and stay. Of two merges at a time the second finds its number taken and gives up; replaced files are removed by
    :func:`remove_merged`.
    """
    before = _merges(spark, path)
    few = {f: n for f, n in metric_files(spark, path).items() if n < small}
    if len(few) < 2:
        return 0
    folder = f"{path.rstrip('/')}/{_MERGED}/{uuid.uuid4().hex}"
    lines = spark.read.text(list(few))
    lines.repartition(max(1, -(-sum(few.values()) // target))).write.mode("errorifexists").text(folder)
    record = json.dumps({"folder": folder, "replaced": sorted(few)}).encode()
    base, system, path_of = _file_system(spark, f"{path.rstrip('/')}/{_MERGED}")
    stream = system.create(path_of(base, f"{len(before):012d}.json"), False)  # fails if it is there
    try:
        stream.write(bytearray(record))
    finally:
        stream.close()
    return len(few)


def remove_merged(spark: SparkSession, path: str) -> int:
    """Delete files that merges have replaced; for when no reader is left that started before the merges."""
    gone = 0
    for f in {f for m in _merges(spark, path) for f in m["replaced"]}:
        at, system, _ = _file_system(spark, f)
        gone += bool(system.delete(at, False))
    return gone


def write_runs(records: DataFrame, path: str) -> None:
    """Run descriptions as JSON lines, replacing what was there."""
    records.write.mode("overwrite").json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RUN_SCHEMA).json(path)


class RunStore:
    """Tables of runs, statuses and metrics, keyed by ``run_id``; appended to, never changed (see :class:`DatedRunStore`)."""

    SCHEMAS = {"runs": S.RUN_SCHEMA, "statuses": S.STATUS_SCHEMA, "metrics": S.METRIC_SCHEMA}

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def append(self, table: str, rows: DataFrame) -> None:
        fields = self.SCHEMAS[table].fieldNames()
        rows.select(*fields).write.mode("append").parquet(f"{self.path}/{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.SCHEMAS[table]).parquet(f"{self.path}/{table}")


class DatedRunStore:
    """Run tables by day, whose records can be replaced: the status of a run is one record that changes.

    ``day`` (UTC, of the run's start) parts each table; a record belongs to its run's day for good. An upsert reads and
    rewrites the days it touches and no other. It writes the merged days beside the store first, then Spark's partition overwrite
    swaps the folders of these days, so a failure before that leaves the store as it was. One writer per table at a time.
    """

    KEYS = {"runs": ["run_id"], "statuses": ["run_id"], "metrics": ["run_id", "name", "global_step"]}

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _schema(self, table: str) -> T.StructType:
        return T.StructType([*RunStore.SCHEMAS[table], T.StructField("day", T.StringType())])

    def _exists(self, table: str) -> bool:
        at, system, _ = _file_system(self.spark, f"{self.path}/{table}")
        return system.exists(at)

    def read(self, table: str, days: Sequence[str] | None = None) -> DataFrame:
        """All records, or those of some days: only their folders are read."""
        schema = self._schema(table)
        if not self._exists(table):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        return rows if days is None else rows.where(F.col("day").isin(list(days)))

    def upsert(self, table: str, rows: DataFrame) -> None:
        """Add records; where one of the same key and day is there, it is replaced. ``rows`` has a key once, and ``day``."""
        keys = [*self.KEYS[table], "day"]
        rows = stage(rows.select(*self._schema(table).fieldNames()), "upsert")
        days = [r["day"] for r in rows.select("day").distinct().collect()]  # as many as days are touched
        if not days:
            return
        merged = stage(self._others(table, days, rows, keys).unionByName(rows), "merged")
        merged.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(
            f"{self.path}/{table}")
        drop_staged(merged)
        drop_staged(rows)

    def _others(self, table: str, days: Sequence[str], rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        old, new = self.read(table, days).alias("old"), rows.select(*keys).alias("new")
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
        return old.join(new, same, "left_anti")
