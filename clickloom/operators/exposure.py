"""From impressions to (item, position) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import comma_list


def log_field(name: str) -> Column:
    """Text of one entry of the log's ``field`` map; NULL when absent."""
    return F.col("field")[name]["string_type"]


def _kept_items(content: Column, props: Column) -> Column:
    """List entries that have a ``from`` in the props object, as ``{content_id, recall_from}``.

    The object is parsed once per impression: the one-entry outer transform binds
    the parsed map to a variable, which keeps the optimizer from moving the parse
    into the inner function, where it would run for every list entry. Text values
    are used since one ill-typed entry would void a map of structs.
    """
    entries = F.from_json(props, "map<string,string>")

    def keep(parsed: Column) -> Column:
        looked_up = F.transform(
            comma_list(content),
            lambda item: F.struct(
                item.alias("content_id"),
                # of a repeated key the last entry counts, as JSON readers have it
                F.get_json_object(
                    F.try_element_at(F.filter(F.map_entries(parsed), lambda e: e["key"] == item), F.lit(-1))["value"], "$.from"
                ).alias("recall_from"),
            ),
        )
        return F.filter(looked_up, lambda x: x["recall_from"].isNotNull())

    return F.transform(F.array(entries), keep)[0]


def explode_positions(impressions: DataFrame, content: str = "content", props: str = "props") -> DataFrame:
    """One row per kept list entry with its 1-based ``pos`` among the kept ones.

    A skipped entry takes no position; an entry listed twice takes two. Missing
    or malformed lists and props give no row. Positions come from the array, so
    neither a window nor a shuffle is needed. The outer generator plus filter
    stops Spark from inferring a ``size > 0`` filter that would parse again.
    """
    rest = [c for c in impressions.columns if c not in (content, props)]
    return (
        impressions.select(*rest, _kept_items(F.col(content), F.col(props)).alias("_kept"))
        .select(*rest, F.posexplode_outer("_kept").alias("_index", "_item"))
        .where(F.col("_item").isNotNull())
        .select(
            *rest,
            F.col("_item.content_id").alias("content_id"),
            F.col("_item.recall_from").try_cast("int").alias("recall_from"),
            (F.col("_index") + 1).alias("pos"),
        )
    )


def listed_items(impressions: DataFrame, content: str = "content") -> DataFrame:
    """Every list entry, kept or not, blanks included; all other columns stay."""
    rest = [c for c in impressions.columns if c != content]
    return impressions.select(*rest, F.explode(comma_list(content)).alias("content_id"))


def distinct_items(impressions: DataFrame, content: str = "content") -> DataFrame:
    """Distinct list entries; duplicates fall out before the shuffle."""
    return listed_items(impressions.select(content), content).distinct()
