"""Queries over finished run logs: records, sampling, throughput, status, stop decision."""

from __future__ import annotations

import numbers
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.records import run_parameters, sorted_entries, utc_text
from clickloom.operators.triggers import triggered

RUNNING = "running"
SUCCESS = "success"
FAILURE = "failure"


def numeric_metrics(metrics: DataFrame, value: str = "value") -> DataFrame:
    """Metrics whose value is a number, as double; the others are dropped."""
    return metrics.withColumn(value, F.col(value).try_cast("double")).where(F.col(value).isNotNull())


def metric_records(metrics: DataFrame) -> DataFrame:
    """Metric rows (``ts``, map ``extras``) in the shape of the metric log."""
    return numeric_metrics(metrics).select(
        "run_id",
        "name",
        "value",
        "unit",
        F.col("global_step").cast("bigint").alias("global_step"),
        utc_text(F.col("ts")).alias("timestamp"),
        sorted_entries(F.col("extras")).alias("extras"),
    )


def run_records(runs: DataFrame) -> DataFrame:
    """Run rows (``ts``, map ``params``) in the shape of the run description."""
    machine = F.col("machine_config") if "machine_config" in runs.columns else F.create_map().cast("map<string,string>")
    return runs.select(
        "run_id",
        "model_name",
        F.struct(F.col("dataset_name").alias("name")).alias("dataset"),
        machine.alias("machine_config"),
        "test_id",
        utc_text(F.col("ts")).alias("run_date"),
        run_parameters(F.col("params")).alias("run_parameters"),
    )


def sorted_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics by run, name and step (the step also parts a long run over several tasks)."""
    return metrics.orderBy("run_id", "name", "global_step")


#: Of statuses at one time the later one here counts: a run that ended did run before.
_STATUSES = [None, RUNNING, SUCCESS, FAILURE]


def latest_status(statuses: DataFrame) -> DataFrame:
    """Status and time of the last record of each run; a status of no known name is NULL.

    Time and rank of the status are packed in one number, so the groups are hashed, not sorted.
    """
    rank = F.coalesce(*[F.when(F.col("status") == s, n) for n, s in enumerate(_STATUSES) if s], F.lit(0))
    last = statuses.groupBy("run_id").agg(F.max(_micros(F.col("ts")) * 4 + rank).alias("_last"))
    names = F.array(*[F.lit(s).cast("string") for s in _STATUSES])
    return last.select(
        "run_id", F.element_at(names, F.pmod("_last", F.lit(4)).cast("int") + 1).alias("status"),
        F.timestamp_micros(F.floor(F.col("_last") / 4)).alias("ts"))


def _first_of(rows: DataFrame, by: Sequence[str | Column], order: Column) -> DataFrame:
    """The whole first row of every group, by aggregation: merged before the shuffle, though groups are sorted for it."""
    keys = [k.alias(f"_k{i}") if isinstance(k, Column) else F.col(k).alias(f"_k{i}") for i, k in enumerate(by)]
    first = F.min_by(F.struct(*[F.col(c) for c in rows.columns]), order).alias("_first")
    return rows.groupBy(*keys).agg(first).select("_first.*")


def sample_metrics(
    metrics: DataFrame,
    every_n_steps: int | None = None,
    every_n_secs: int | None = None,
    by: Sequence[str] = ("run_id", "name"),
    first_step: int = 0,
) -> DataFrame:
    """The first row of every ``n`` steps or ``n`` seconds, exactly one of the two.

    Steps count from ``first_step``; seconds are fixed windows of the clock.
    """
    if (every_n_steps is None) == (every_n_secs is None):
        raise ValueError("give exactly one of every_n_steps and every_n_secs")
    if every_n_steps is not None:
        if every_n_steps <= 0:
            raise ValueError("every_n_steps must be positive")
        slot = F.floor((F.col("global_step") - first_step) / F.lit(every_n_steps))
        return _first_of(metrics, [*by, slot], F.struct("global_step", "ts"))
    if every_n_secs <= 0:
        raise ValueError("every_n_secs must be positive")
    slot = F.window("ts", f"{every_n_secs} seconds")["start"]
    return _first_of(metrics, [*by, slot], F.struct("ts", "global_step"))


def sample_by_trigger(
    metrics: DataFrame,
    every_n_steps: int | None = None,
    every_n_secs: float | None = None,
    by: Sequence[str] = ("run_id", "name"),
    chunk: int | None = None,
) -> DataFrame:
    """The rows a trigger lets through, exactly one of the two options given.

    The first row, then each next one that is at least ``n`` steps or seconds after the last one taken, whatever gaps the
    steps have. Of rows at one step (or time) the first by time (or step) counts.
    """
    if (every_n_steps is None) == (every_n_secs is None):
        raise ValueError("give exactly one of every_n_steps and every_n_secs")
    if every_n_steps is not None:
        at, gap, order = F.col("global_step"), every_n_steps, F.struct("global_step", "ts")
    else:
        at, gap, order = _micros(F.col("ts")), round(every_n_secs * 1_000_000), F.struct("ts", "global_step")
    keyed = metrics.withColumn("_at", at.cast("bigint"))
    taken = triggered(metrics, at, gap, by, chunk)
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"taken.{c}")) for c in [*by, "_at"]]
    picked = keyed.alias("rows").join(taken.alias("taken"), same, "left_semi")
    return _first_of(picked, [*by, F.col("_at")], order).drop("_at")


def final_values(metrics: DataFrame) -> DataFrame:
    """Value at the last step of every run and metric; of one step's records one without a time, or step, is the first."""
    # step and time as one decimal, which a hashed group can hold in place; what is missing lies below all there are
    step = F.coalesce(F.col("global_step").cast("decimal(38,0)"), F.lit(Decimal(-10 ** 19)).cast("decimal(38,0)"))
    place = step * F.lit(10 ** 18).cast("decimal(38,0)") + F.coalesce(_micros(F.col("ts")), F.lit(-5 * 10 ** 17))
    return metrics.withColumn("_place", place.cast("decimal(38,0)")).groupBy("run_id", "name").agg(
        F.max("global_step").alias("global_step"), F.max_by("value", "_place").alias("value")
    )


def examples_per_second(
    ticks: DataFrame,
    batch_size: int,
    every_n_steps: int | None = None,
    every_n_secs: int | None = None,
    warm_steps: int = 0,
    chunk_steps: int = 1_000_000,
    trigger: bool = False,
) -> DataFrame:
    """Current and running examples per second at each sampled step after the warm-up.

    ``ticks`` has ``run_id, global_step, ts``, a step once per run. Steps are sampled by slots, or by
    a ``trigger`` that counts from the last sampled one. The first
    sampled step starts the clock and gives no row. The sums of step and time
    gains telescope, so the running figure needs the run's first sampled step
    only. A run is cut in chunks of ``chunk_steps`` steps: the previous step is
    found inside a chunk, or is the last one of the chunk before, so a run of any
    length is never in one task; the window over chunks sees one row for each.
    """
    warm = ticks.select("run_id", "global_step", "ts").where(F.col("global_step") > warm_steps)
    if trigger:
        sampled = sample_by_trigger(warm, every_n_steps, every_n_secs, by=["run_id"])
    else:
        sampled = sample_metrics(warm, every_n_steps, every_n_secs, by=["run_id"], first_step=warm_steps + 1)
    tick = F.struct("global_step", "ts")
    chunked = sampled.select(
        "*", tick.alias("_tick"), F.floor(F.col("global_step") / F.lit(chunk_steps)).alias("_chunk")
    )
    in_run = Window.partitionBy("run_id").orderBy("_chunk")
    chunks = (
        chunked.groupBy("run_id", "_chunk")
        .agg(F.min("_tick").alias("_lo"), F.max("_tick").alias("_hi"))
        .select(
            "run_id",
            "_chunk",
            F.lag("_hi").over(in_run).alias("_carried"),
            F.min("_lo").over(in_run.rowsBetween(Window.unboundedPreceding, 0)).alias("_start"),
        )
    )
    in_chunk = Window.partitionBy("run_id", "_chunk").orderBy("global_step")
    joined = chunked.withColumn("_before", F.lag("_tick").over(in_chunk)).join(chunks, ["run_id", "_chunk"])
    previous = F.coalesce("_before", "_carried")

    def rate(since: Column) -> Column:
        steps = F.col("global_step") - since["global_step"]
        seconds = (_micros(F.col("ts")) - _micros(since["ts"])) / F.lit(1_000_000)
        return F.try_divide(F.lit(batch_size) * steps, seconds)

    return (
        joined.withColumn("_previous", previous)
        .where(F.col("_previous").isNotNull())
        .select(
            "run_id",
            "global_step",
            rate(F.col("_previous")).alias("current_examples_per_sec"),
            rate(F.col("_start")).alias("average_examples_per_sec"),
        )
    )


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _check_threshold(threshold: object) -> None:
    if threshold is not None and not isinstance(threshold, numbers.Number):
        raise ValueError("the stop threshold must be a number")


def past_stop_threshold(value: Column, threshold: float | None) -> Column:
    """True from the threshold on; never without one; a value that is no number is an error."""
    _check_threshold(threshold)
    if threshold is None:
        return F.lit(False)
    number = value.try_cast("double")
    checked = F.when(value.isNotNull() & number.isNull(), F.raise_error(F.lit("the metric must be a number")))
    return F.coalesce(checked.otherwise(number).cast("double") >= F.lit(float(threshold)), F.lit(False))


def stop_steps(metrics: DataFrame, threshold: float | None) -> DataFrame:
    """First step of every run at which the metric passed the threshold; NULL if it never did."""
    passed = past_stop_threshold(F.col("value"), threshold)
    return metrics.groupBy("run_id").agg(F.min(F.when(passed, F.col("global_step"))).alias("stop_step"))
