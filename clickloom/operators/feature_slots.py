"""Feature replies and snapshots to fixed slots, and the joins that attach them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.functions.text import strip_newlines, tag_list_from_words, typed_value
from clickloom.operators.joins import skew_join


def flatten_replies(replies: DataFrame, entity: str = "entity_id", reply: str = "reply") -> DataFrame:
    """JSON replies to one row per named value, in reply order (``ord``).

    A reply that does not parse, or is empty, gives no row.
    """
    parsed = F.from_json(F.col(reply), S.FEATURE_REPLY)
    values = F.flatten(F.transform(F.col("_reply.Features"), lambda f: f["Feature"]))
    return (
        replies.select(F.col(entity).alias("entity_id"), parsed.alias("_reply"))
        .select("entity_id", F.coalesce("_reply.Errcode", F.lit(0)).alias("errcode"), values.alias("_values"))
        .select("entity_id", "errcode", F.posexplode_outer("_values").alias("ord", "_value"))
        .where(F.col("_value").isNotNull())
        .select(
            "entity_id",
            "errcode",
            "ord",
            F.col("_value.FeatureName").alias("feature_name"),
            F.col(f"_value.FeatureValue.{S.STRING_VALUE}").alias("string_value"),
            F.col(f"_value.FeatureValue.{S.STRING_ARRAY_VALUE}").alias("array_value"),
            F.col(f"_value.FeatureValue.{S.FLOAT_VALUE}").alias("float_value"),
        )
    )


def _declared_type(slots: Sequence[S.FeatureSlot]) -> Column:
    types = ", ".join(f"'{s.feature}', '{s.value_type}'" for s in slots)
    return F.expr(f"map({types})[feature_name]")


def parse_values(snapshot: DataFrame, slots: Sequence[S.FeatureSlot]) -> DataFrame:
    """``entity_id, ord, feature_name, value``: listed features, present under their declared type.

    Entities with a nonzero error code are left out and later get the defaults.
    """
    value = typed_value(_declared_type(slots), "string_value", "array_value", "float_value")
    stripped = F.when(F.col("feature_name") == S.NEWLINE_FEATURE, strip_newlines(value)).otherwise(value)
    return (
        snapshot.where((F.col("errcode") == 0) & F.col("feature_name").isin([s.feature for s in slots]))
        .select("entity_id", "ord", "feature_name", stripped.alias("value"))
        .where(F.col("value").isNotNull())
    )


_DEALT = "_dealt"


def fill_slots(values: DataFrame, slots: Sequence[S.FeatureSlot]) -> DataFrame:
    """One row per entity with a column per slot; the last occurrence of a name wins.

    Text is folded by sorting, so values are first dealt by entity: no task sorts all that one file of a snapshot holds. They are
    dealt by a hash of the id, which leaves Spark free to cut a large partition; each part is folded and the few rows left
    are merged, so an entity with a large share of the rows costs no more than another.
    """
    dealt = values.withColumn(_DEALT, F.xxhash64("entity_id")).hint("rebalance", _DEALT)
    return dealt.groupBy("entity_id").agg(*[
        F.expr(
            f"coalesce(max_by(if(feature_name = '{s.feature}', value, null),"
            f" if(feature_name = '{s.feature}', ord, null)), '{s.default}') as {s.column}"
        )
        for s in slots
    ])


def with_slot_defaults(rows: DataFrame, slots: Sequence[S.FeatureSlot]) -> DataFrame:
    """Fill the slots an outer join left empty."""
    defaults = {s.column: s.default for s in slots}
    return rows.selectExpr(
        *[f"coalesce(`{c}`, '{defaults[c]}') as `{c}`" if c in defaults else f"`{c}`" for c in rows.columns]
    )


def slot_table(
    snapshot: DataFrame, slots: Sequence[S.FeatureSlot], wanted: DataFrame | None = None, key: str = "entity_id"
) -> DataFrame:
    """Snapshot rows to one row of slot values per entity, or per one of the ``wanted`` ids in column ``key``."""
    if wanted is not None:
        ids = wanted.select(F.col(key).cast("string").alias("entity_id"))
        snapshot = snapshot.join(ids, "entity_id", "left_semi")
    return fill_slots(parse_values(snapshot, slots), slots)


def lookup_once(rows: DataFrame, key: str, table: DataFrame, slots: Sequence[S.FeatureSlot]) -> DataFrame:
    """Slot values of each distinct key of ``rows``, defaults where the table has none."""
    keys = rows.select(F.col(key).alias("entity_id")).distinct()
    return with_slot_defaults(keys.join(table, "entity_id", "left"), slots)


def attach_slots(
    rows: DataFrame, key: str, table: DataFrame, slots: Sequence[S.FeatureSlot], hot: DataFrame | None = None
) -> DataFrame:
    """Rows with the slot values of ``key``; an unknown or NULL key gets the defaults."""
    joined = skew_join(rows, table.withColumnRenamed("entity_id", key), key, "left", hot)
    return with_slot_defaults(joined, slots)


_AT, _CALM, _HOT_SLOT = "_at", "_calm", "_hot_"


def attach_bucketed_slots(
    rows: DataFrame, key: str, table: DataFrame, slots: Sequence[S.FeatureSlot], hot: DataFrame | None = None
) -> DataFrame:
    """:func:`attach_slots` for a ``table`` bucketed by entity id, which stays where it lies: ``rows`` alone are shuffled, to its buckets.

    Rows of a hot or NULL key have no bucket to go to: they are spread by their content and match nothing there. Hot keys
    then get their values from a second join with the few table rows that are theirs, salted unless Spark broadcasts them.
    """
    spread = F.base64(F.xxhash64(*[f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]).cast("string").cast("binary"))
    marked = rows if hot is None else rows.join(hot.withColumn(_CALM, F.lit(False)).select(key, _CALM), key, "left")
    calm = F.col(key).isNotNull() & (F.lit(True) if hot is None else F.col(_CALM).isNull())
    marked = marked.withColumn(_CALM, calm).withColumn(_AT, F.when(F.col(_CALM), F.col(key)).otherwise(spread))
    values = table.select(F.col("entity_id"), *[s.column for s in slots])
    joined = marked.join(values, (F.col(_AT) == F.col("entity_id")) & F.col(_CALM), "left").drop("entity_id", _AT, _CALM)
    if hot is not None:
        ids = hot.select(F.col(key).alias("entity_id"))
        few = values.join(ids, "entity_id", "left_semi").select(
            F.col("entity_id").alias(key), *[F.col(s.column).alias(_HOT_SLOT + s.column) for s in slots])
        joined = skew_join(joined, few, key, "left", hot).withColumns(
            {s.column: F.coalesce(s.column, _HOT_SLOT + s.column) for s in slots})
    return with_slot_defaults(joined.select(*rows.columns, *[s.column for s in slots]), slots)


def slot_record(slots: Sequence[S.FeatureSlot], sep: str = ",") -> Column:
    """Slot values as one delimited text."""
    return F.concat_ws(sep, *[F.col(s.column) for s in slots])


def item_attribute_record(attributes: DataFrame) -> DataFrame:
    """Table form of the item features: ``(content_id, feature text)`` from the daily attribute table."""
    columns = [
        tag_list_from_words("keywords"),
        F.col("subcategory"),
        tag_list_from_words("topic"),
        F.col("cate"),
        F.col("content_type"),
        F.col("source_name"),
        F.col("cover_show_type"),
    ]
    text = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("None")) for c in columns])
    return attributes.select(F.col("id").cast("string").alias("content_id"), text.alias("content_feature"))
