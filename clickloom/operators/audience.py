"""Keep the traffic of new users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.joins import count_copies, expand_copies, hot_keys, skew_join


def new_users(dimension: DataFrame) -> DataFrame:
    """``device``, ``wlx_content_id`` of dimension rows with a positive item id."""
    return dimension.where(F.col("content_id") > 0).select(
        F.col("device_id").alias("device"), F.col("content_id").alias("wlx_content_id")
    )


def attach_new_user(
    impressions: DataFrame, users: DataFrame, hot_devices: DataFrame | None = None, expand: bool = True,
    tasks: int | None = None, unmatched: bool = False,
) -> DataFrame:
    """Impressions of new users with the item that brought the user.

    An outer join followed by a match-required filter, hence an inner join. A
    device listed m times yields m rows per impression; ``expand=False`` keeps
    equal rows folded in ``copies`` for the joins to come, ``tasks`` spreads the copies when they are written out.
    ``unmatched`` keeps the impressions of others as well, folded, with NULL ``copies``.
    """
    folded = count_copies(users, ["device", "wlx_content_id"], "copies")
    joined = skew_join(impressions, folded, "device", "left" if unmatched else "inner", hot_devices)
    if unmatched:
        return joined
    return expand_copies(joined, "copies", tasks) if expand else joined


def keep_new_user_clicks(
    clicks: DataFrame, users: DataFrame, hot_devices: DataFrame | None = None, expand: bool = True
) -> DataFrame:
    """Clicks of new users; the dimension adds no column but a device listed m times gives m clicks.

    Equal clicks are folded into ``copies`` before anything is joined, which also
    melts down a device or pair that holds a large share of them.
    """
    columns = [c for c in clicks.columns if c != "copies"]
    folded = folded_clicks(clicks)
    listed = count_copies(users, ["device"], "_listed")
    joined = skew_join(folded, listed, "device", "inner", hot_devices).select(
        *columns, (F.col("copies") * F.col("_listed")).alias("copies")
    )
    return expand_copies(joined, "copies") if expand else joined


def only_new_users(rows: DataFrame, users: DataFrame, hot_devices: DataFrame | None = None) -> DataFrame:
    """The same filter without the fan-out: a row stays as often as it came in."""
    devices = users.select("device").distinct()
    if hot_devices is None:
        return rows.join(devices, "device", "left_semi")
    return skew_join(rows, devices, "device", "inner", hot_devices).select(*rows.columns)


def hot_devices(rows: DataFrame, **limits: int) -> DataFrame:
    return hot_keys(rows.select("device"), "device", **limits)


def folded_clicks(clicks: DataFrame) -> DataFrame:
    """Equal clicks as one row with ``copies``: what :func:`keep_new_user_clicks` joins, and its hot devices are counted on."""
    columns = [c for c in clicks.columns if c != "copies"]
    return count_copies(clicks, columns, "copies", "copies" if "copies" in clicks.columns else None)
