"""Labelled rows to the 38-column sample and its text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.functions.hashing import split_flag
from clickloom.functions.text import fixed_point, record
from clickloom.operators.feature_slots import slot_record

# Where a sample column comes from, when not from the slot of its name.
_MADE = {
    "u_id": "coalesce(uid, device)",
    "u_device_id": "device",
    "u_content_id": "content_id",
    "u_wlx_content_id": "wlx_content_id",
    "i_recall_from": "recall_from",
    "i_pos": "pos",
    "l_click": "click",
    "l_read_time": "read_time",
    "l_share": "0",
    "l_comment": "0",
    "l_praise": "0",
}
_SPLIT_INPUTS = ["uid", "device", "wlx_content_id"]


def _split() -> Column:
    return split_flag(*[F.col(c) for c in _SPLIT_INPUTS], slot_record(S.USER_SLOTS))


def finish_samples(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows with labels and slot texts to the sample schema, plus the columns to ``keep``.

    Number columns are cut from their texts (``'0.0'`` to 0). The split hash takes
    the user id as logged, before the device stands in for a missing one. Share,
    comment and praise are not logged and are 0.
    """
    columns: list[Column] = []
    for field in S.SAMPLE_SCHEMA:
        source, kind = _MADE.get(field.name, field.name), field.dataType.simpleString()
        if field.name == "r_type":
            columns.append(_split().alias("r_type"))
        elif field.name in _MADE or kind == "string":
            columns.append(F.expr(f"try_cast({source} as {kind}) as {field.name}"))
        else:
            columns.append(F.expr(f"try_cast(try_cast({source} as double) as {kind}) as {field.name}"))
    return rows.select(*columns, *keep)


def sample_record(rows: DataFrame, sep: str = ",") -> DataFrame:
    """Labelled rows with slot texts as delimited lines; read time has six decimals."""
    line = record(
        F.coalesce("uid", "device"),
        "device",
        "content_id",
        "wlx_content_id",
        *[s.column for s in S.USER_SLOTS],
        "recall_from",
        *[s.column for s in S.ITEM_SLOTS],
        "pos",
        "click",
        fixed_point("read_time"),
        F.lit(0),
        F.lit(0),
        F.lit(0),
        _split(),
        sep=sep,
    )
    return rows.select(line.alias("value"))


def training_rows(samples: DataFrame, features: list[str], label: str = "l_click") -> DataFrame:
    """The chosen features and a boolean label."""
    return samples.select(*features, (F.col(label) == 1).alias("label"))


# Named feature groups of the sample.
NUMERIC_FEATURES = [
    "u_age", "u_gender", "i_cate", "i_type", "i_recall_from", "i_covershowtype",
    "i_pos", "i_show", "i_read", "i_playtime", "i_avg_readtime",
]
INDICATOR_FEATURES = ["u_phone_client", "u_province", "u_city", "u_dtu", "i_source_name"]
