"""Declared schemas and the fixed values a sample consumer depends on."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

STRING_VALUE = "StringValue"
STRING_ARRAY_VALUE = "StringArrayValue"
FLOAT_VALUE = "FloatValue"


class FeatureSlot(NamedTuple):
    """One catalogued feature: where its value goes and what stands in for it."""

    column: str
    feature: str
    value_type: str
    default: str


# The feature catalogue, in slot order.
USER_SLOTS = [
    FeatureSlot("u_age", "u_st_5_predict_age", STRING_VALUE, "0"),
    FeatureSlot("u_gender", "u_dy_5_sex", STRING_VALUE, "5"),
    FeatureSlot("u_phone_client", "u_dy_5_phone_client", STRING_VALUE, ""),
    FeatureSlot("u_province", "u_st_2_province", STRING_VALUE, ""),
    FeatureSlot("u_city", "u_st_2_city", STRING_VALUE, ""),
    FeatureSlot("u_dtu", "u_dy_5_dtu_code", STRING_VALUE, ""),
    FeatureSlot("u_applist", "u_dy_5_app_list_yd", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_readsourcename", "u_dy_5_sourceName_zw", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_regtime", "u_st_7_regtime", FLOAT_VALUE, "0.0"),
    FeatureSlot("u_favocate5", "u_dy_6_favocate5", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_keywords_vread", "u_dy_5_keywords_vread", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_keyword_cates", "u_dy_5_keyword_rh", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_type_readlist", "u_dy_5_type_readlist", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_subcates", "u_dy_5_subcats_vread", STRING_ARRAY_VALUE, ""),
    FeatureSlot("u_topics", "u_dy_5_topics", STRING_ARRAY_VALUE, ""),
]

ITEM_SLOTS = [
    FeatureSlot("i_keywords", "d_dy_5_keyword_pts", STRING_ARRAY_VALUE, ""),
    FeatureSlot("i_subcate", "d_dy_2_subcategory", STRING_VALUE, ""),
    FeatureSlot("i_topics", "d_dy_5_topics", STRING_ARRAY_VALUE, ""),
    FeatureSlot("i_cate", "d_st_2_type", STRING_VALUE, ""),
    FeatureSlot("i_type", "d_st_2_contenttype", STRING_VALUE, ""),
    FeatureSlot("i_source_name", "d_st_2_sourcename", STRING_VALUE, ""),
    FeatureSlot("i_covershowtype", "d_st_2_covershowtype", STRING_VALUE, ""),
    FeatureSlot("i_playtime", "d_st_3_playtime", FLOAT_VALUE, "0.0"),
    FeatureSlot("i_avg_readtime", "d_dy_3_recavgreadlong", FLOAT_VALUE, "0.0"),
    FeatureSlot("i_show", "d_dy_4_recshow", FLOAT_VALUE, "0.0"),
    FeatureSlot("i_read", "d_dy_4_recread", FLOAT_VALUE, "0.0"),
]

#: The one user feature whose text arrives with trailing newlines.
NEWLINE_FEATURE = "u_dy_5_app_list_yd"


def _f(name: str, data_type: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, data_type, True, {"comment": comment})


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# The 38 sample columns, in file order.
SAMPLE_SCHEMA = T.StructType([
    _f("u_id", _S, "user id, the device when the user is unknown"),
    _f("u_device_id", _S, "device"),
    _f("u_content_id", _L, "item shown"),
    _f("u_wlx_content_id", _L, "item that brought the new user, 0 if unknown"),
    _f("u_age", _I, "predicted age band"),
    _f("u_gender", _I, "1 male, 2 female, 5 unknown"),
    _f("u_phone_client", _S, "android or ios"),
    _f("u_province", _S, "province"),
    _f("u_city", _S, "city"),
    _f("u_dtu", _S, "install source of the app"),
    _f("u_applist", _S, "installed apps, pipe list"),
    _f("u_readsourcename", _S, "sources read, pipe list"),
    _f("u_regtime", _L, "registration time, epoch seconds"),
    _f("u_favocate5", _S, "favourite categories, pipe list"),
    _f("u_keywords_vread", _S, "keywords read, pipe list"),
    _f("u_keyword_cates", _S, "keywords with category, pipe list"),
    _f("u_type_readlist", _S, "reading history, pipe list"),
    _f("u_subcates", _S, "second-level categories, pipe list"),
    _f("u_topics", _S, "topics, pipe list"),
    _f("i_recall_from", _I, "recall source of the impression"),
    _f("i_keywords", _S, "item keywords, pipe list"),
    _f("i_subcate", _S, "item second-level category"),
    _f("i_topics", _S, "item topics, pipe list"),
    _f("i_cate", _I, "item first-level category"),
    _f("i_type", _I, "item type: video, article or gallery"),
    _f("i_source_name", _S, "item source"),
    _f("i_covershowtype", _I, "cover layout"),
    _f("i_playtime", _I, "play length"),
    _f("i_avg_readtime", _I, "mean read time"),
    _f("i_show", _I, "times shown"),
    _f("i_read", _I, "times read"),
    _f("i_pos", _I, "1-based position in the impression"),
    _f("l_click", _I, "clicked"),
    _f("l_read_time", _D, "read time in seconds"),
    _f("l_share", _I, "shared"),
    _f("l_comment", _I, "commented"),
    _f("l_praise", _I, "praised"),
    _f("r_type", _I, "1 train, 0 test"),
])
SAMPLE_COLUMNS = SAMPLE_SCHEMA.fieldNames()
SAMPLE_PARTITIONS = T.StructType([T.StructField("ds", _S), T.StructField("hh", _S)])

#: Where an empty field of a training text row is not simply 0 (numbers) or '0' (text).
_TEXT_DEFAULT_EXCEPTIONS = {"u_age": -1, "u_gender": 5}
TRAINING_DEFAULTS = {
    f.name: _TEXT_DEFAULT_EXCEPTIONS.get(f.name, "0" if f.dataType == _S else 0)
    for f in SAMPLE_SCHEMA
}

FIELD_MAP = T.MapType(_S, T.StructType([T.StructField("string_type", _S)]))
EVENT_LOG_SCHEMA = T.StructType([
    T.StructField("cookie_id", _S), T.StructField("device", _S), T.StructField("cmd", _S),
    T.StructField("field", FIELD_MAP), T.StructField("ds", _S), T.StructField("hh", _S),
])
COLLECT_LOG_SCHEMA = T.StructType([
    T.StructField("device", _S), T.StructField("header_mi", _S), T.StructField("cmd", _S),
    T.StructField("field", FIELD_MAP), T.StructField("ds", _S), T.StructField("hh", _S),
])
NEW_USER_SCHEMA = T.StructType([T.StructField("device_id", _S), T.StructField("content_id", _L)])

FEATURE_VALUE = T.StructType([
    T.StructField(STRING_VALUE, _S),
    T.StructField(STRING_ARRAY_VALUE, T.ArrayType(_S)),
    T.StructField(FLOAT_VALUE, _D),
])
FEATURE_REPLY = T.StructType([
    T.StructField("Errcode", _I),
    T.StructField("Features", T.ArrayType(T.StructType([
        T.StructField("Uid", _S),
        T.StructField("Feature", T.ArrayType(T.StructType([
            T.StructField("FeatureName", _S),
            T.StructField("FeatureValue", FEATURE_VALUE),
        ]))),
    ]))),
])
#: Flat form of the replies, one row per named value.
FEATURE_SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("entity_id", _S), T.StructField("errcode", _I), T.StructField("ord", _I),
    T.StructField("feature_name", _S), T.StructField("string_value", _S),
    T.StructField("array_value", T.ArrayType(_S)), T.StructField("float_value", _D),
])

NAME_VALUE = T.StructType([T.StructField("name", _S), T.StructField("value", _S)])
METRIC_SCHEMA = T.StructType([
    T.StructField("run_id", _S), T.StructField("name", _S), T.StructField("value", _D),
    T.StructField("unit", _S), T.StructField("global_step", _L), T.StructField("timestamp", _S),
    T.StructField("extras", T.ArrayType(NAME_VALUE)),
])
RUN_PARAMETER = T.StructType([
    T.StructField("name", _S), T.StructField("string_value", _S), T.StructField("long_value", _L),
    T.StructField("bool_value", _S), T.StructField("float_value", _D),
])
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", _S), T.StructField("model_name", _S),
    T.StructField("dataset", T.StructType([T.StructField("name", _S)])),
    T.StructField("machine_config", T.MapType(_S, _S)), T.StructField("test_id", _S),
    T.StructField("run_date", _S), T.StructField("run_parameters", T.ArrayType(RUN_PARAMETER)),
])
STATUS_SCHEMA = T.StructType([
    T.StructField("run_id", _S), T.StructField("status", _S), T.StructField("ts", T.TimestampNTZType()),
])
