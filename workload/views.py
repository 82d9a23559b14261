"""The library's input tables, derived row by row from the test tables.

Every view reads whole tables and keeps one derived row per base row, so no
group has to be collected and the views grow with their tables. The columns are
SQL text: one call per view instead of one per expression node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import audience
from clickloom.plans.hourly_samples import SampleInputs
from clickloom.sources import logs

# Declared schemas of the test tables, so that no scan starts by inferring one.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _field(**entries: str) -> str:
    """The log's map of tagged values; a NULL value stands for a missing entry."""
    pairs = [f"'{k}', named_struct('string_type', cast({v} as string))" for k, v in entries.items()]
    return f"map({', '.join(pairs)})"


def _device(key: str) -> str:
    """Some devices have an underscore in their name."""
    return f"concat(if({key} % 7 = 0, 'd_', 'd'), {key})"


_K = "cast(get_json_object(props, '$.k') as int)"
#: User id as text; a fifth of the users has none.
_MEMBER = "if(user_id % 5 <> 0, cast(user_id as string), null)"
_DS = "date_format(ts, 'yyyy-MM-dd') as ds"
_HH = "date_format(ts, 'HH') as hh"


def _props_entry(item: str) -> str:
    """``"7":{"from":0}``; nothing for multiples of 10, no ``from`` for other multiples of 5."""
    return (
        f"if({item} % 10 <> 0, concat('\"', {item}, '\":', "
        f"if({item} % 5 = 0, '{{\"x\":1}}', concat('{{\"from\":', {item} % 7, '}}'))), null)"
    )


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with a hot user and a hot item: a third of all events are of user 1, a third of those of item 7."""
    return table(spark, sf_dir, "events").withColumns({
        "user_id": F.expr("if(event_id % 3 = 0, 1, user_id)"), "props": F.expr("if(event_id % 9 = 0, '{\"k\": 7}', props)")})


def event_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Impressions (views) and clicks in one hourly log, cmd 100 and 300.

    An impression lists three to five items: some blank, some twice, some
    without props. One in 23 has no list and one in 17 has broken props.
    """
    items = ["k", "((k + event_id) % 100)", "((k * 7 + 3) % 100)"]
    listed = (
        f"concat_ws(',', {', '.join(f'cast({i} as string)' for i in items)},"
        " if(event_id % 4 = 0, cast(k as string), null), if(event_id % 3 = 0, '', null))"
    )
    shown = _field(
        content=f"if(event_id % 23 <> 0, {listed}, null)",
        props=f"if(event_id % 17 = 0, '{{bad', concat('{{', concat_ws(',', {', '.join(map(_props_entry, items))}), '}}'))",
    )
    clicked = _field(**{
        "content_id": "k",
        "channel": "if(event_id % 11 = 0, '254', '255')",
        "from": "if(event_id % 13 = 0, '12', '11')",
        "is_appview": "case event_id % 3 when 1 then '1' when 2 then '2' end",
    })
    return (
        (events or table(spark, sf_dir, "events"))
        .where("event_type in ('view', 'click')")
        .selectExpr("*", f"{_K} as k")
        .selectExpr(
            "event_id as row_id",
            f"{_MEMBER} as cookie_id",
            f"{_device('user_id')} as device",
            f"if(event_type = 'view', '{logs.IMPRESSION_CMD}', '{logs.CLICK_CMD}') as cmd",
            f"if(event_type = 'view', {shown}, {clicked}) as field",
            _DS,
            _HH,
        )
    )


def impressions(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    return logs.impressions_of(event_log(spark, sf_dir, events).where(f"cmd = '{logs.IMPRESSION_CMD}'"))


def click_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    return event_log(spark, sf_dir, events).where(f"cmd = '{logs.CLICK_CMD}'")


def collect_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Read-time log from purchases: bad devices, bad numbers, missing items, second devices."""
    field = _field(
        useTime="if(event_id % 19 = 0, 'n/a', cast(value as string))",
        selectedId=f"if(event_id % 29 <> 0, {_K}, null)",
        channel="if(event_id % 11 = 0, '254', '255')",
    )
    return (events or table(spark, sf_dir, "events")).where("event_type = 'purchase'").selectExpr(
        "case when event_id % 31 = 0 then '' when event_id % 31 = 1 then '0' when event_id % 31 = 2 then null"
        f" when event_id % 4 = 0 then concat('e', user_id) else {_device('user_id')} end as device",
        f"{_MEMBER} as header_mi",
        f"'{logs.READ_TIME_CMD}' as cmd",
        f"{field} as field",
        _DS,
        _HH,
    )


def new_user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per device, some equal, some with item 0."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{_device('o_custkey')} as device_id", "o_orderkey % 3 as content_id"
    )


def new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.new_users(new_user_dimension(spark, sf_dir))


def _value(ord_: int, name: str, when: str | None = None, string: str = "null", array: str = "null",
           number: str = "null") -> str:
    value = (
        f"named_struct('ord', {ord_}, 'feature_name', '{name}', 'string_value', cast({string} as string),"
        f" 'array_value', cast({array} as array<string>), 'float_value', cast({number} as double))"
    )
    return value if when is None else f"if({when}, {value}, null)"


def _long_form(rows: DataFrame, entity: str, errcode: str, values: list[str]) -> DataFrame:
    # a small file with one row group is one task's to read; the values, many for each of its rows, are made by all
    return (
        rows.hint("rebalance")
        .selectExpr(f"cast({entity} as string) as entity_id", f"cast({errcode} as int) as errcode",
                        f"explode_outer(array({', '.join(values)})) as v")
        .where("v is not null")
        .select("entity_id", "errcode", "v.*")
    )


def item_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item features from ``part``; some items missing, failed, mistyped or repeated."""
    part = table(spark, sf_dir, "part").where("p_size % 9 <> 0")
    return _long_form(part, "p_partkey", "if(p_size % 11 = 0, 1, 0)", [
        _value(0, "d_dy_5_keyword_pts", array="transform(split(p_name, ' '), w -> concat(w, ':', p_size))"),
        _value(1, "d_dy_2_subcategory", string="p_brand"),
        _value(2, "d_dy_5_topics", array="array(concat(p_type, ':0.5'), p_brand)"),
        _value(3, "d_st_2_type", string="p_size % 7"),
        _value(4, "d_st_2_contenttype", string="p_partkey % 3 + 1"),
        _value(5, "d_st_2_sourcename", string="p_type"),
        _value(6, "d_st_2_covershowtype", when="p_partkey % 4 = 0", number="p_size"),
        _value(6, "d_st_2_covershowtype", when="p_partkey % 4 <> 0", string="p_size % 4"),
        _value(7, "d_st_3_playtime", number="p_retailprice"),
        _value(8, "d_dy_3_recavgreadlong", number="p_size * 1.5D - 20"),
        _value(9, "d_dy_4_recshow", number="p_size * 100"),
        _value(10, "d_dy_4_recread", number="p_size + 0.5D"),
        _value(11, "d_dy_9_unlisted", string="'x'"),
        _value(12, "d_dy_2_subcategory", when="p_partkey % 5 = 0", string="concat('again ', p_brand)"),
    ])


def user_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User features from ``customer`` with its nation and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = (
        table(spark, sf_dir, "customer")
        .where("c_acctbal >= 0")
        .join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .join(region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    )
    return _long_form(customer, "c_custkey", "0", [
        _value(0, "u_st_5_predict_age", string="c_custkey % 60 + 10"),
        _value(1, "u_dy_5_sex", when="c_custkey % 3 <> 0", string="c_custkey % 2 + 1"),
        _value(2, "u_dy_5_phone_client", string="if(c_custkey % 2 = 0, 'ios', 'android')"),
        _value(3, "u_st_2_province", string="r_name"),
        _value(4, "u_st_2_city", string="n_name"),
        _value(5, "u_dy_5_dtu_code", string="c_mktsegment"),
        _value(6, "u_dy_5_app_list_yd", array="array('mail:1', concat(c_mktsegment, '\\n'))"),
        _value(7, "u_dy_5_sourceName_zw", array="array(concat(c_mktsegment, ':3'), 'wire')"),
        _value(8, "u_st_7_regtime", number="1500000000 + c_custkey * 1000.5D"),
        _value(9, "u_dy_6_favocate5", array="array('12:0.9', concat(c_custkey % 40, ':0.1'))"),
        _value(10, "u_dy_5_keywords_vread", array="array('rain:2', 'coal')"),
        _value(11, "u_dy_5_keyword_rh", array="array(concat('rain~', n_name))"),
        _value(12, "u_dy_5_type_readlist", array="array(string(c_custkey * 3), string(c_custkey * 5))"),
        _value(13, "u_dy_5_subcats_vread", when="c_custkey % 4 <> 0", array="array('sub:1', c_mktsegment)"),
        _value(14, "u_dy_5_topics", array="array('t1:0.5', 't2:0.25', r_name)"),
    ])


def sample_inputs(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> SampleInputs:
    return SampleInputs(
        impressions=impressions(spark, sf_dir, events),
        click_log=click_log(spark, sf_dir, events),
        read_log=collect_log(spark, sf_dir, events),
        new_users=new_users(spark, sf_dir),
        item_features=item_snapshot(spark, sf_dir),
        user_features=user_snapshot(spark, sf_dir),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature service replies as JSON texts, one per part; some fail, one in 37 does not parse."""

    def entry(name: str, member: str, value: str) -> str:
        return f"""concat('{{"FeatureName":"{name}","FeatureValue":{{"{member}":', {value}, '}}}}')"""

    first = "concat_ws(',', {}, {})".format(
        entry("d_dy_2_subcategory", "StringValue", "concat('\"', p_brand, '\"')"),
        entry("d_dy_5_topics", "StringArrayValue", "concat('[\"', p_type, ':0.5\",\"b\"]')"),
    )
    second = "concat_ws(',', {}, {})".format(
        entry("d_st_3_playtime", "FloatValue", "concat(p_size, '.5')"),
        f"if(p_size % 2 = 0, {entry('d_dy_2_subcategory', 'StringValue', chr(39) + chr(34) + 'last' + chr(34) + chr(39))}, null)",
    )
    uid = """concat('{"Uid":"', p_partkey, '","Feature":[')"""
    good = (
        f"""concat('{{"Errcode":', if(p_size % 11 = 0, 1, 0), ',"Features":[', {uid}, {first}, ']}},',"""
        f""" {uid}, {second}, ']}}]}}')"""
    )
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as entity_id", f"""if(p_partkey % 37 = 0, '{{"Errcode":', {good}) as reply"""
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven raw features and a label per lineitem."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "cast(l_linenumber * 30 as bigint) as fea1",
        "l_partkey * 6000 as fea2",
        "cast(l_quantity as bigint) as fea7",
        "cast(floor(l_extendedprice) as bigint) * 50 as fea9",
        "l_orderkey * 150000 as fea15",
        "l_suppkey * 20000000 as fea16",
        "cast(round(l_tax * 100) as bigint) * 2500 as fea17",
        "l_partkey * 1000003 % 2147483648 as fea18",
        "cast(round(l_discount * 100) as bigint) as fea22",
        "cast(l_quantity as bigint) * 3 as fea23",
        "l_partkey % 2000 as fea24",
        "cast(l_returnflag = 'R' as int) as label",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label and a score with exact binary fractions (multiples of 1/1024) per lineitem; some have no score."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("*", "cast(l_returnflag = 'R' as int) as label")
        .selectExpr(
            "l_linestatus",
            "label",
            "if(l_linenumber = 6 and l_partkey % 40 = 3, null,"
            " ((l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 900 + label * 60 + 30) / 1024.0D) as score",
        )
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric log: run by customer, name by priority, step by order key, some values no number."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('run', o_custkey % 100) as run_id",
        "o_orderpriority as name",
        "if(o_orderkey % 13 = 0, 'nope', cast(cast(round(o_totalprice * 100) as bigint) / 100D as string)) as value",
        "if(o_orderkey % 2 = 0, 'sec', null) as unit",
        "o_orderkey as global_step",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400) as ts",
        "if(o_orderkey % 3 = 0, map('z', o_orderstatus, 'a', '1'), null) as extras",
    )


_START = "timestamp_ntz'2024-01-01 00:00:00'"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step ticks of ten runs: one per order, steps without gaps, times growing with the step."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('run', o_orderkey % 10) as run_id",
        "o_orderkey div 10 + 1 as global_step",
        f"{_START} + make_dt_interval(0, 0, 0,"
        " cast((o_orderkey div 10 * 15 + o_orderkey % 7) * 0.1BD as decimal(18, 6))) as ts",
    )


def gapped_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks of two customers in seven: steps with gaps."""
    kept = table(spark, sf_dir, "orders").where("o_custkey % 7 < 2").selectExpr(
        "concat('run', o_orderkey % 10) as run_id", "o_orderkey div 10 + 1 as global_step")
    return ticks(spark, sf_dir).join(kept, ["run_id", "global_step"], "left_semi")


def run_statuses(spark: SparkSession, sf_dir: str, ended: bool) -> DataFrame:
    """A run per event, by the event's day: running, or, for runs that ``ended``, how they did an hour later."""
    events = table(spark, sf_dir, "events")
    if not ended:
        return events.selectExpr("concat('run', event_id) as run_id", "'running' as status", "ts", "date_format(ts, 'yyyy-MM-dd') as day")
    return events.where("event_type in ('error', 'purchase')").selectExpr(
        "concat('run', event_id) as run_id", "if(event_type = 'error', 'failure', 'success') as status",
        "ts + interval 1 hour as ts", "date_format(ts, 'yyyy-MM-dd') as day")


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('run', o_custkey) as run_id",
        "case o_orderstatus when 'O' then 'running' when 'F' then 'success' else 'failure' end as status",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey) as ts",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run description per customer with parameters of every type."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('run', c_custkey) as run_id",
        "'wide_deep' as model_name",
        "c_mktsegment as dataset_name",
        "if(c_custkey % 2 = 0, concat('t', c_custkey), null) as test_id",
        f"{_START} + make_dt_interval(0, 0, 0, cast(c_custkey * 1.001BD as decimal(18, 6))) as ts",
        "map('train_epochs', cast(c_custkey % 5 as string), 'batch_size', '1024', 'rate', concat(c_custkey % 10, '.25'),"
        " 'shuffle', if(c_custkey % 2 = 0, 'True', 'False'), 'dataset', c_mktsegment) as params",
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training log lines from events: progress, evaluation and other lines."""
    head = "date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',123 INFO (MainThread-7) '"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_type"
        f" when 'view' then concat({head}, 'loss = ', value, ', step = ', event_id, ' (', event_id % 50, '.25 sec)')"
        f" when 'click' then concat({head}, 'Saving dict for global step ', event_id, ': accuracy = 0.5, auc = ', value,"
        " ', global_step = ', event_id, ', label/mean = 0.', event_id % 90 + 10)"
        f" else concat({head}, 'Loss for final step: ', value, '.') end as value",
    )


def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training text, tab separated, with empty fields: five columns per lineitem."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "concat_ws('\\t', if(l_linenumber = 3, '', string(l_linenumber * 7)), if(l_linenumber = 5, '', l_returnflag),"
        " if(l_orderkey % 4 = 0, '', string(l_partkey)), if(l_orderkey % 9 = 0, '', l_linestatus),"
        " if(l_linenumber = 2, '', string(cast(l_quantity as bigint)))) as line",
    )
