"""The hourly sample build: logs to labelled, featured, split samples."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.functions.text import comma_list
from clickloom.operators import audience, engagement, exposure, feature_slots, quality, samples
from clickloom.operators.joins import COPIES_TOGETHER, ROWS_PER_TASK, expand_copies, hot_keys, split_copies
from clickloom.sources import logs, sinks, snapshots
from clickloom.sources.scratch import drop_staged, stage


@dataclass(frozen=True)
class SampleInputs:
    """Logs already cut to the hour (clicks, impressions) and the day (read time)."""

    impressions: DataFrame  # uid, device, content, props
    click_log: DataFrame  # cookie_id, device, field
    read_log: DataFrame  # device, header_mi, field
    new_users: DataFrame  # device, wlx_content_id
    item_features: DataFrame  # snapshot rows
    user_features: DataFrame  # snapshot rows
    item_slots: DataFrame | None = None  # bucketed slot values, in place of snapshot rows
    user_slots: DataFrame | None = None


@dataclass(frozen=True)
class HotKeys:
    """Keys to cut in pieces, each found on the rows that its join has on its left.

    Impressions (all or staged) tell their own keys before any props are parsed: a user's rows are the positions listed. Clicks tell theirs
    where they are given. :meth:`of_labelled` replaces items and users by those of the rows that the feature joins get.
    """

    devices: DataFrame
    items: DataFrame
    users: DataFrame
    pairs: DataFrame
    click_devices: DataFrame | None = None
    click_pairs: DataFrame | None = None

    @staticmethod
    def of(impressions: DataFrame, clicks: DataFrame | None = None, **limits: int) -> HotKeys:
        """``clicks``: feed clicks, folded or not."""
        devices = hot_keys(impressions.select("device"), "device", **limits)
        items = exposure.listed_items(impressions.select("content"))
        # a hot (item, device) pair needs a hot device, so only those lists are opened
        pairs = exposure.listed_items(
            impressions.select("device", "content").join(devices, "device", "left_semi")
        )
        listed = impressions.select("uid", F.size(comma_list(F.col("content"))).alias("_listed")).where(F.col("_listed") > 0)
        folded = audience.folded_clicks(clicks) if clicks is not None else None
        return HotKeys(
            devices=devices,
            items=hot_keys(items, "content_id", **limits),
            users=hot_keys(listed, "uid", weight="_listed", **limits),
            pairs=hot_keys(pairs, ["content_id", "device"], **limits),
            click_devices=None if folded is None else hot_keys(folded.select("device"), "device", **limits),
            click_pairs=None if folded is None else hot_keys(folded, ["user_id", "content_id"], **limits),
        )

    def of_labelled(self, rows: DataFrame, **limits: int) -> HotKeys:
        """Items and users as labelled rows have them, every row counted with its copies: that many are written out after the last join."""
        return replace(
            self, items=hot_keys(rows, "content_id", weight="copies", **limits), users=hot_keys(rows, "uid", weight="copies", **limits))


def shown_to_new_users(inputs: SampleInputs, hot_devices: DataFrame | None = None) -> DataFrame:
    """Impressions of new users, equal dimension rows folded in ``copies``."""
    return audience.attach_new_user(inputs.impressions, inputs.new_users, hot_devices, expand=False)


def labelled_positions(
    inputs: SampleInputs, hot: HotKeys | None = None, expand: bool = True, shown: DataFrame | None = None,
    clicks: DataFrame | None = None, tasks: int | None = None,
) -> DataFrame:
    """Shown (item, position) rows of new users with ``click`` and ``read_time``.

    Equal rows travel folded (``copies``) through the joins and are written out at
    the end, so the fan-out of repeated dimension and click rows is never shuffled.
    ``shown`` takes :func:`shown_to_new_users` from a staged table, ``clicks`` the feed clicks (folded or not). ``tasks`` spreads the
    copies of a row that stands for many.
    """
    if shown is None:
        shown = shown_to_new_users(inputs, hot.devices if hot else None)
    if clicks is None:
        clicks = engagement.feed_clicks(inputs.click_log)
    clicks = audience.keep_new_user_clicks(clicks, inputs.new_users, hot.click_devices if hot else None, expand=False)
    clicks = engagement.add_read_time(
        clicks, engagement.read_time_by_item(inputs.read_log), hot.click_pairs if hot else None, expand=False)
    shows = exposure.explode_positions(shown)
    return engagement.label_clicks(shows, clicks, hot.pairs if hot else None, expand=expand, tasks=tasks)


def featured_rows(
    inputs: SampleInputs, hot: HotKeys | None = None, shown: DataFrame | None = None, labelled: DataFrame | None = None
) -> DataFrame:
    """Labelled rows with all item and user slots.

    Features are looked up for the ids at hand alone: the snapshots are cut to them before they are
    pivoted. Bucketed slot values are joined where they lie. Item slots first, user slots last: the long user texts are then attached
    by the final join and no later shuffle carries them. ``labelled`` takes :func:`labelled_positions`, folded, from a staged table.
    """
    if shown is None:
        shown = shown_to_new_users(inputs, hot.devices if hot else None)
    rows = labelled_positions(inputs, hot, expand=False, shown=shown) if labelled is None else labelled
    if inputs.item_slots is not None:
        rows = feature_slots.attach_bucketed_slots(rows, "content_id", inputs.item_slots, S.ITEM_SLOTS, hot.items if hot else None)
    else:
        items = feature_slots.slot_table(inputs.item_features, S.ITEM_SLOTS, exposure.distinct_items(shown), "content_id")
        rows = feature_slots.attach_slots(rows, "content_id", items, S.ITEM_SLOTS, hot.items if hot else None)
    if inputs.user_slots is not None:
        return feature_slots.attach_bucketed_slots(rows, "uid", inputs.user_slots, S.USER_SLOTS, hot.users if hot else None)
    users = feature_slots.slot_table(inputs.user_features, S.USER_SLOTS, shown.select("uid").distinct(), "uid")
    return feature_slots.attach_slots(rows, "uid", users, S.USER_SLOTS, hot.users if hot else None)


def build_samples(
    inputs: SampleInputs, hot: HotKeys | None = None, shown: DataFrame | None = None, labelled: DataFrame | None = None
) -> DataFrame:
    """The 38-column samples, with ``ds`` and ``hh`` where the impressions have them."""
    partitions = [c for c in ("ds", "hh") if c in inputs.impressions.columns]
    made = samples.finish_samples(featured_rows(inputs, hot, shown, labelled), "copies", *partitions)
    return expand_copies(made, "copies").select(*S.SAMPLE_COLUMNS, *partitions)


def build_records(inputs: SampleInputs, hot: HotKeys | None = None, sep: str = ",") -> DataFrame:
    """The samples as delimited lines."""
    return samples.sample_record(expand_copies(featured_rows(inputs, hot), "copies"), sep)


def previous_hour(now: dt.datetime) -> tuple[str, str]:
    """``ds`` and ``hh`` of the hour before ``now``; the caller owns the clock."""
    hour = now - dt.timedelta(hours=1)
    return f"{hour:%Y-%m-%d}", f"{hour:%H}"


@dataclass(frozen=True)
class HourlyJob:
    """Where the tables of the job live, and how many rows a task should hold.

    ``item_slots`` and ``user_slots`` name bucketed tables (:mod:`~clickloom.sources.snapshots`) that are read, at ``snapshot_ds``, in
    place of the snapshots.
    """

    event_log: str
    collect_log: str
    new_users: str
    item_features: str
    user_features: str
    samples: str
    item_ids: str | None = None
    rejects: str | None = None
    table: str | None = None
    snapshot_ds: str | None = None
    item_slots: str | None = None
    user_slots: str | None = None
    files: int | None = None
    fmt: str = "parquet"
    rows_per_task: int = ROWS_PER_TASK


@dataclass(frozen=True)
class HourReport:
    """What an hour read and wrote: impressions, how many of them had which problem, and the samples."""

    impressions: int
    problems: dict[str, int]
    samples: int


def run_hour(spark: SparkSession, job: HourlyJob, ds: str, hh: str) -> HourReport:
    """Build and write one hour, replacing it if it is there, and register the partition.

    The hour's log texts are read once: the impressions of new users, a small part
    of them, are staged, together with those that have a problem, and the others as empty rows that only count; the report, rejects,
    item ids, hot keys and samples come from there. Feed clicks are staged folded, labelled positions with rows of many copies split: each
    join's hot keys are counted on the staged rows it gets. A registered table gets the hour in one step
    (:func:`~clickloom.sources.sinks.publish_partition`), a folder alone is overwritten. Staged tables are removed at the end.
    """
    limits = {"rows_per_task": job.rows_per_task}
    if (job.item_slots or job.user_slots) and job.snapshot_ds is None:
        raise ValueError("bucketed slots are read by day: snapshot_ds is missing")
    log = logs.read_table(spark, job.event_log, S.EVENT_LOG_SCHEMA, row_id=True)
    collect = logs.read_table(spark, job.collect_log, S.COLLECT_LOG_SCHEMA)
    impressions = logs.impressions_of(logs.log_hour(log, ds, hh, logs.IMPRESSION_CMD))
    users = audience.new_users(logs.read_table(spark, job.new_users, S.NEW_USER_SCHEMA))
    inputs = SampleInputs(
        impressions=impressions,
        click_log=logs.log_hour(log, ds, hh, logs.CLICK_CMD),
        read_log=logs.log_day(collect, ds, logs.READ_TIME_CMD),
        new_users=users,
        item_features=logs.feature_snapshot(spark, job.item_features, job.snapshot_ds),
        user_features=logs.feature_snapshot(spark, job.user_features, job.snapshot_ds),
        item_slots=snapshots.slots_of_day(spark, job.item_slots, job.snapshot_ds) if job.item_slots else None,
        user_slots=snapshots.slots_of_day(spark, job.user_slots, job.snapshot_ds) if job.user_slots else None,
    )
    checked = impressions.withColumn("problem", quality.impression_problem())
    joined = audience.attach_new_user(checked, users, audience.hot_devices(impressions, **limits), expand=False, unmatched=True)
    # the impressions of others that are fine stay as empty rows: they only count
    wanted = F.col("copies").isNotNull() | F.col("problem").isNotNull()
    staged = stage(joined.withColumns({c: F.when(wanted, F.col(c)) for c in impressions.columns}), "shown")
    counts = quality.count_checked(staged)
    hour = {"ds": ds, "hh": hh}
    if job.rejects:
        rejected = staged.where(F.col("problem").isNotNull()).drop("wlx_content_id", "copies").dropDuplicates(["row_id"])
        sinks.write_partitions(rejected, job.rejects, one_partition=hour)
    shown = staged.where(F.col("copies").isNotNull()).drop("problem")
    if job.item_ids:
        sinks.write_text(exposure.distinct_items(shown), f"{job.item_ids}/{ds}/{hh}")
    clicks = stage(audience.folded_clicks(engagement.feed_clicks(inputs.click_log)), "clicks")
    hot = HotKeys.of(shown, clicks, **limits)
    labelled = labelled_positions(inputs, hot, expand=False, shown=shown, clicks=clicks)
    labelled = stage(split_copies(labelled, "copies", max(1, min(COPIES_TOGETHER, job.rows_per_task))), "labelled")
    total = labelled.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    built = build_samples(inputs, hot.of_labelled(labelled, **limits), shown, labelled)
    if job.table:
        sinks.create_sample_table(spark, job.table, job.samples, fmt=job.fmt, replace=False)
        sinks.publish_partition(built, job.table, job.samples, hour, fmt=job.fmt, files=job.files)
    else:
        sinks.write_partitions(built, job.samples, fmt=job.fmt, files=job.files, one_partition=hour)
    for table in (staged, clicks, labelled):
        drop_staged(table)
    return HourReport(sum(counts.values()), {p: n for p, n in counts.items() if p is not None}, total)
