"""DuckDB SQL for the queries, written from the definitions and not from the Spark code.

Expected feature slots, for one, are stated directly from the base tables here,
while the queries go through long-form snapshots.
"""

from __future__ import annotations

from clickloom.operators.encoding import CROSS_SIZES, DEEP_NUMERIC, EVEN_EDGES, HASH_SIZES
from clickloom.schemas import ITEM_SLOTS, SAMPLE_SCHEMA, USER_SLOTS

ORACLE: dict[str, str] = {}

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (needs, sql)


def _with(*names: str) -> str:
    """WITH clause of the named parts and all they need, in order."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name not in done:
            for need in CTES[name][0]:
                visit(need)
            done.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in done) + "\n"


def _hash32(s: str) -> str:
    return f"CAST(('0x' || substring(md5({s}), 1, 8)) AS BIGINT)"


_DEVICE = "(CASE WHEN {0} % 7 = 0 THEN 'd_' ELSE 'd' END || {0})"

# --- the logs -----------------------------------------------------------------

_cte("ev", f"""
SELECT event_id AS id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS member,
       {_DEVICE.format('user_id')} AS device,
       strftime(ts, '%Y-%m-%d') AS ds, strftime(ts, '%H') AS hh
FROM events""")


def _entry(i: str) -> str:
    return (f"CASE WHEN {i} % 10 <> 0 THEN '\"' || {i} || '\":' ||"
            f" CASE WHEN {i} % 5 = 0 THEN '{{\"x\":1}}' ELSE '{{\"from\":' || ({i} % 7) || '}}' END END")


_ITEMS = ["k", "((k + id) % 100)", "((k * 7 + 3) % 100)"]
_cte("impressions", f"""
SELECT id AS row_id, member AS uid, device, ds, hh,
       CASE WHEN id % 23 <> 0 THEN concat_ws(',', {', '.join(_ITEMS)},
            CASE WHEN id % 4 = 0 THEN k END, CASE WHEN id % 3 = 0 THEN '' END) END AS content,
       CASE WHEN id % 17 = 0 THEN '{{bad' ELSE '{{' || concat_ws(',', {', '.join(map(_entry, _ITEMS))}) || '}}' END AS props
FROM ev WHERE event_type = 'view'""", "ev")

_cte("shows", """
SELECT row_id, uid, device, ds, hh, content_id, CAST(fr AS INTEGER) AS recall_from,
       CAST(row_number() OVER (PARTITION BY row_id ORDER BY ord) AS INTEGER) AS pos
FROM (
  SELECT *, CASE WHEN content_id <> '' AND json_valid(props)
                 THEN json_extract_string(props, '$."' || content_id || '".from') END AS fr
  FROM (SELECT *, unnest(string_split(content, ',')) AS content_id,
               generate_subscripts(string_split(content, ','), 1) AS ord
        FROM impressions WHERE content IS NOT NULL))
WHERE fr IS NOT NULL""", "impressions")

_cte("clicks", """
SELECT member AS user_id, device, CAST(k AS VARCHAR) AS content_id
FROM (SELECT *, CASE WHEN id % 11 = 0 THEN '254' ELSE '255' END AS channel,
             CASE WHEN id % 13 = 0 THEN '12' ELSE '11' END AS source,
             CASE id % 3 WHEN 1 THEN '1' WHEN 2 THEN '2' END AS is_appview
      FROM ev WHERE event_type = 'click')
WHERE channel = '255' AND source = '11' AND is_appview <> '2'""", "ev")

_cte("collect", """
SELECT id, member AS header_mi, ds, hh,
       CASE WHEN id % 31 = 0 THEN '' WHEN id % 31 = 1 THEN '0' WHEN id % 31 = 2 THEN NULL
            WHEN id % 4 = 0 THEN 'e' || user_id ELSE device END AS device,
       CASE WHEN id % 19 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS use_time,
       CASE WHEN id % 29 <> 0 THEN CAST(k AS VARCHAR) END AS selected,
       CASE WHEN id % 11 = 0 THEN '254' ELSE '255' END AS channel
FROM ev WHERE event_type = 'purchase'""", "ev")

_cte("read_time", """
SELECT header_mi, device, selected AS content_id, coalesce(header_mi, device) AS user_id,
       max(TRY_CAST(use_time AS DOUBLE)) AS read_time
FROM collect
WHERE channel = '255' AND selected IS NOT NULL AND coalesce(device, '') NOT IN ('', '0')
GROUP BY ALL""", "collect")

_cte("dim", f"""
SELECT {_DEVICE.format('o_custkey')} AS device_id, o_orderkey % 3 AS content_id FROM orders""")

# a new user's rows of the dimension, told apart by what they carry, with how often each is there
_cte("new_user", """
SELECT device_id AS device, content_id AS wlx_content_id, count(*) AS times
FROM dim WHERE content_id > 0 AND device_id IS NOT NULL GROUP BY ALL""", "dim")

_cte("new_impressions", """
SELECT shown.*, known.wlx_content_id
FROM (SELECT * FROM impressions) shown
INNER JOIN new_user known USING (device), range(known.times) AS copy(n)""", "impressions", "new_user")

_cte("new_clicks", """
SELECT clicked.*
FROM clicks clicked
INNER JOIN (SELECT device, sum(times) AS times FROM new_user GROUP BY device) known USING (device),
     range(CAST(known.times AS BIGINT)) AS copy(n)""", "clicks", "new_user")


def _timed(source: str) -> str:
    return f"""
SELECT clicked.user_id, clicked.device, clicked.content_id, coalesce(spent.read_time, 0.0) AS read_time
FROM {source} clicked
LEFT JOIN (SELECT user_id, content_id, read_time FROM read_time) spent USING (user_id, content_id)"""


_cte("new_timed", _timed("new_clicks"), "new_clicks", "read_time")

_cte("labelled", """
SELECT s.row_id, s.uid, s.device, b.content_id AS wlx_content_id, s.content_id, s.recall_from, s.pos, s.ds, s.hh,
       CASE WHEN c.device IS NOT NULL THEN 1 ELSE 0 END AS click, coalesce(c.read_time, 0.0) AS read_time
FROM shows s
JOIN (SELECT * FROM dim WHERE content_id > 0) b ON s.device = b.device_id
LEFT JOIN new_timed c ON s.content_id = c.content_id AND s.device = c.device""", "shows", "dim", "new_timed")

# --- features -------------------------------------------------------------------

_cte("items", """
SELECT CAST(p_partkey AS VARCHAR) AS entity_id,
       replace(p_name, ' ', '|') AS i_keywords,
       CASE WHEN p_partkey % 5 = 0 THEN 'again ' ELSE '' END || p_brand AS i_subcate,
       p_type || '|' || p_brand AS i_topics,
       CAST(p_size % 7 AS VARCHAR) AS i_cate,
       CAST(p_partkey % 3 + 1 AS VARCHAR) AS i_type,
       p_type AS i_source_name,
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_size % 4 AS VARCHAR) END AS i_covershowtype,
       CAST(CAST(trunc(p_retailprice + 0.5) AS BIGINT) AS VARCHAR) AS i_playtime,
       CAST(CAST(trunc(p_size * 1.5 - 19.5) AS BIGINT) AS VARCHAR) AS i_avg_readtime,
       CAST(p_size * 100 AS VARCHAR) AS i_show,
       CAST(p_size + 1 AS VARCHAR) AS i_read
FROM part WHERE p_size % 9 <> 0 AND p_size % 11 <> 0""")

_cte("users", """
SELECT CAST(c_custkey AS VARCHAR) AS entity_id,
       CAST(c_custkey % 60 + 10 AS VARCHAR) AS u_age,
       CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 2 + 1 AS VARCHAR) ELSE '5' END AS u_gender,
       CASE WHEN c_custkey % 2 = 0 THEN 'ios' ELSE 'android' END AS u_phone_client,
       r_name AS u_province, n_name AS u_city, c_mktsegment AS u_dtu,
       'mail|' || c_mktsegment AS u_applist, c_mktsegment || '|wire' AS u_readsourcename,
       CAST(CAST(trunc(1500000000 + c_custkey * 1000.5 + 0.5) AS BIGINT) AS VARCHAR) AS u_regtime,
       '12|' || (c_custkey % 40) AS u_favocate5, 'rain|coal' AS u_keywords_vread, 'rain~' || n_name AS u_keyword_cates,
       (c_custkey * 3) || '|' || (c_custkey * 5) AS u_type_readlist,
       CASE WHEN c_custkey % 4 <> 0 THEN 'sub|' || c_mktsegment ELSE '' END AS u_subcates,
       't1|t2|' || r_name AS u_topics
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_acctbal >= 0""")

_ITEM_COLS = ", ".join(f"coalesce(i.{s.column}, '{s.default}') AS {s.column}" for s in ITEM_SLOTS)
_USER_COLS = ", ".join(f"coalesce(u.{s.column}, '{s.default}') AS {s.column}" for s in USER_SLOTS)
_cte("featured", f"""
SELECT l.*, {_USER_COLS}, {_ITEM_COLS}
FROM labelled l LEFT JOIN items i ON l.content_id = i.entity_id LEFT JOIN users u ON l.uid = u.entity_id""",
     "labelled", "items", "users")

_USER_TEXT = " || ',' || ".join(s.column for s in USER_SLOTS)
_ITEM_TEXT = " || ',' || ".join(s.column for s in ITEM_SLOTS)
_R_TYPE = (f"CASE WHEN {_hash32('coalesce(uid, ' + chr(39) + 'None' + chr(39) + ') || device || wlx_content_id || ' + _USER_TEXT)}"
           " % 100 > 80 THEN 0 ELSE 1 END")

# --- one entry per query ------------------------------------------------------------

ORACLE["scan_log_hour"] = _with("impressions") + """
SELECT row_id, uid, device, content FROM impressions WHERE ds = '2024-01-15' AND hh = '12'"""

ORACLE["scan_log_hours"] = _with("ev") + """
SELECT ds, hh, CASE event_type WHEN 'view' THEN '100' ELSE '300' END AS cmd, count(*) AS n, count(member) AS members
FROM ev WHERE event_type IN ('view', 'click') GROUP BY ALL"""

ORACLE["scan_collect_day"] = _with("collect") + """
SELECT device, header_mi, selected AS content_id, TRY_CAST(use_time AS DOUBLE) AS use_time, hh
FROM collect WHERE ds = '2024-01-15'"""

ORACLE["scan_new_users"] = _with("dim") + """
SELECT device_id AS device, content_id AS wlx_content_id FROM dim WHERE content_id > 0"""

ORACLE["scan_item_attributes"] = """
SELECT CAST(p_partkey AS VARCHAR) AS content_id,
       replace(p_name, ' ', '|') || ',' || p_brand || ',' ||
       CASE WHEN p_partkey % 5 <> 0 THEN 't1|' || p_type ELSE '' END || ',' || (p_size % 7) || ',' ||
       (p_partkey % 3) || ',' || CASE WHEN p_partkey % 6 <> 0 THEN p_type ELSE 'None' END || ',' || (p_size % 4)
         AS content_feature
FROM part WHERE p_partkey % 2 = 0"""

ORACLE["scan_profiles"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'd' || c_custkey AS device, c_nationkey AS prov, c_mktsegment AS city,
       c_custkey % 2 AS gender, CASE WHEN c_custkey % 2 = 0 THEN 'ios' ELSE 'android' END AS phone_client,
       CASE WHEN c_custkey % 3 = 0 THEN 'w' || c_custkey WHEN c_custkey % 4 <> 0 THEN 'n' || c_custkey END AS dtu,
       'mail|map' AS app_list
FROM customer WHERE c_custkey % 10 < 5"""

ORACLE["delimited_defaults"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 3 THEN -1 ELSE l_linenumber * 7 END AS u_age,
       CASE WHEN l_linenumber = 5 THEN '0' ELSE l_returnflag END AS u_dtu,
       CASE WHEN l_orderkey % 4 = 0 THEN 0 ELSE l_partkey END AS u_content_id,
       CASE WHEN l_orderkey % 9 = 0 THEN '0' ELSE l_linestatus END AS i_topics,
       CASE WHEN l_linenumber = 2 THEN 5 ELSE CAST(l_quantity AS INTEGER) END AS u_gender
FROM lineitem"""

ORACLE["file_shards"] = """
SELECT f % 70 AS shard, count(*) AS files, CAST(sum(n) AS BIGINT) AS "rows", max(n) AS largest_file
FROM (SELECT l_orderkey % 128 AS f, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1"""

ORACLE["constant_rows"] = """
SELECT o_orderkey, 2 AS outer_size, 3 AS inner_size, 3.0::DOUBLE AS total, 0.5::DOUBLE AS w, 1 AS label FROM orders"""

ORACLE["training_log_progress"] = """
SELECT event_id, value AS loss, event_id AS step, CAST(event_id % 50 AS DOUBLE) + 0.25 AS seconds
FROM events WHERE event_type = 'view'"""

ORACLE["training_log_evaluations"] = """
SELECT event_id, event_id AS global_step, unnest(['accuracy', 'auc', 'label/mean']) AS name,
       unnest([0.5, value, CAST('0.' || (event_id % 90 + 10) AS DOUBLE)]) AS value
FROM events WHERE event_type = 'click'"""

ORACLE["feed_clicks"] = _with("clicks") + "SELECT * FROM clicks"

ORACLE["usable_devices"] = _with("collect") + """
SELECT device, header_mi, coalesce(header_mi, device) AS user_id
FROM collect WHERE device IS NOT NULL AND device NOT IN ('', '0')"""

_cte("checked", """
SELECT *, CASE WHEN content IS NULL THEN 'no content' WHEN NOT json_valid(props) THEN 'bad props' END AS problem
FROM impressions""", "impressions")
ORACLE["reject_counts"] = _with("checked") + """
SELECT ds, count(*) FILTER (WHERE problem IS NULL) AS good, count(problem) AS rejected FROM checked GROUP BY ds"""
ORACLE["rejected_rows"] = _with("checked") + "SELECT row_id, device, problem FROM checked WHERE problem IS NOT NULL"

ORACLE["job_rejects"] = _with("checked") + """
SELECT device, problem, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY problem) AS BIGINT) AS reported,
       (SELECT count(*) FROM checked) AS impressions, true AS all_written
FROM checked WHERE problem IS NOT NULL GROUP BY device, problem"""

ORACLE["number_texts"] = """
SELECT o_orderkey, CAST(CAST(trunc(h / 100.0::DOUBLE + 0.5) AS BIGINT) AS VARCHAR) AS rounded,
       CASE WHEN o_orderkey % 11 <> 0 THEN CASE WHEN h < 0 THEN h - 0.25::DOUBLE ELSE h + 0.25::DOUBLE END END AS parsed,
       CASE WHEN o_orderkey % 11 <> 0 THEN h END AS whole
FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) - 20000000 AS h FROM orders)"""

ORACLE["tag_lists"] = """
SELECT p_partkey, p_brand || '|' || p_type || '|' AS from_array, p_brand || '|' || p_type || '|' AS from_commas,
       replace(p_name, ' ', '|') AS from_words
FROM part"""

ORACLE["newline_strip"] = """
SELECT doc_id, length(text) + 3 AS before, length(trim(text, chr(10))) AS after, md5(trim(text, chr(10))) AS digest
FROM documents"""

ORACLE["composite_keys"] = _with("shows") + """
SELECT row_id, pos, content_id || '_' || device AS show_key, content_id, device FROM shows"""

ORACLE["previous_hours"] = """
SELECT event_id, strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d') AS ds, strftime(ts - INTERVAL 1 HOUR, '%H') AS hh FROM events"""

ORACLE["split_share"] = f"""
SELECT o_orderkey, b AS hash_bucket, CASE WHEN b > 80 THEN 0 ELSE 1 END AS r_type
FROM (SELECT o_orderkey, {_hash32("(CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'None' END)"
                                  " || o_orderpriority || o_orderkey")} % 100 AS b FROM orders)"""

ORACLE["positions"] = _with("shows") + "SELECT row_id, uid, device, content_id, recall_from, pos FROM shows"

ORACLE["distinct_items"] = _with("impressions", "dim") + """
SELECT DISTINCT unnest(string_split(content, ',')) AS content_id
FROM impressions WHERE content IS NOT NULL AND device IN (SELECT device_id FROM dim WHERE content_id > 0)"""

ORACLE["new_user_impressions"] = _with("new_impressions") + """
SELECT row_id, uid, device, wlx_content_id FROM new_impressions"""
ORACLE["new_user_clicks"] = _with("new_clicks") + "SELECT * FROM new_clicks"
ORACLE["new_user_clicks_semi"] = _with("clicks", "dim") + """
SELECT * FROM clicks WHERE device IN (SELECT device_id FROM dim WHERE content_id > 0)"""
ORACLE["read_time_by_item"] = _with("read_time") + "SELECT * FROM read_time"
ORACLE["clicks_with_read_time"] = _with("clicks", "read_time") + _timed("clicks")
ORACLE["labelled_positions"] = _with("labelled") + "SELECT * FROM labelled"
ORACLE["labelled_positions_spread"] = _with("labelled").replace("FROM events", """FROM (SELECT * REPLACE (
    CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, CASE WHEN event_id % 9 = 0 THEN '{"k": 7}' ELSE props END AS props)
    FROM events)""") + """
SELECT row_id, wlx_content_id, content_id, pos, click, read_time, count(*) AS copies FROM labelled GROUP BY ALL"""

# Replies: the parts that parse, their values in order.
_cte("reply", """
SELECT CAST(p_partkey AS VARCHAR) AS entity_id, CASE WHEN p_size % 11 = 0 THEN 1 ELSE 0 END AS errcode,
       p_brand, p_type, p_size FROM part WHERE p_partkey % 37 <> 0""")
ORACLE["reply_values"] = _with("reply") + """
SELECT entity_id, errcode, 0 AS ord, 'd_dy_2_subcategory' AS feature_name, p_brand AS string_value,
       NULL AS array_text, NULL::DOUBLE AS float_value FROM reply
UNION ALL SELECT entity_id, errcode, 1, 'd_dy_5_topics', NULL, p_type || ':0.5;b', NULL FROM reply
UNION ALL SELECT entity_id, errcode, 2, 'd_st_3_playtime', NULL, NULL, p_size + 0.5 FROM reply
UNION ALL SELECT entity_id, errcode, 3, 'd_dy_2_subcategory', 'last', NULL, NULL FROM reply WHERE p_size % 2 = 0"""
_GIVEN = {"i_subcate": "CASE WHEN p_size % 2 = 0 THEN 'last' ELSE p_brand END", "i_topics": "p_type || '|b'",
          "i_playtime": "CAST(p_size + 1 AS VARCHAR)"}
ORACLE["reply_slots"] = _with("reply") + (
    "SELECT entity_id, " + ", ".join(f"{_GIVEN.get(s.column, repr(s.default))} AS {s.column}" for s in ITEM_SLOTS)
    + " FROM reply WHERE errcode = 0")

_cte("ok_part", """
SELECT *, CAST(p_partkey AS VARCHAR) AS entity_id FROM part WHERE p_size % 9 <> 0 AND p_size % 11 <> 0""")
_LONG = [
    (0, "d_dy_5_keyword_pts", "replace(p_name, ' ', '|')", None),
    (1, "d_dy_2_subcategory", "p_brand", None),
    (2, "d_dy_5_topics", "p_type || '|' || p_brand", None),
    (3, "d_st_2_type", "CAST(p_size % 7 AS VARCHAR)", None),
    (4, "d_st_2_contenttype", "CAST(p_partkey % 3 + 1 AS VARCHAR)", None),
    (5, "d_st_2_sourcename", "p_type", None),
    (6, "d_st_2_covershowtype", "CAST(p_size % 4 AS VARCHAR)", "p_partkey % 4 <> 0"),
    (7, "d_st_3_playtime", "CAST(CAST(floor(p_retailprice + 0.5) AS BIGINT) AS VARCHAR)", None),
    (8, "d_dy_3_recavgreadlong", "CAST(CAST(trunc(p_size * 1.5 - 19.5) AS BIGINT) AS VARCHAR)", None),
    (9, "d_dy_4_recshow", "CAST(p_size * 100 AS VARCHAR)", None),
    (10, "d_dy_4_recread", "CAST(p_size + 1 AS VARCHAR)", None),
    (12, "d_dy_2_subcategory", "'again ' || p_brand", "p_partkey % 5 = 0"),
]
ORACLE["typed_values"] = _with("ok_part") + "\nUNION ALL ".join(
    f"SELECT entity_id, {o} AS ord, '{n}' AS feature_name, {v} AS value FROM ok_part" + (f" WHERE {w}" if w else "")
    for o, n, v, w in _LONG)
ORACLE["item_slots"] = _with("items") + "SELECT * FROM items"
ORACLE["user_slots"] = _with("users") + "SELECT * FROM users"
ORACLE["item_lookup"] = _with("shows", "items") + f"""
SELECT k.content_id AS entity_id, {_ITEM_COLS}
FROM (SELECT DISTINCT content_id FROM shows) k LEFT JOIN items i ON k.content_id = i.entity_id"""
ORACLE["item_enrichment"] = _with("shows", "items") + f"""
SELECT row_id, content_id, pos, {_ITEM_TEXT} AS item_feature
FROM (SELECT s.row_id, s.content_id, s.pos, {_ITEM_COLS} FROM shows s LEFT JOIN items i ON s.content_id = i.entity_id)"""
ORACLE["user_enrichment"] = _with("impressions", "users") + f"""
SELECT row_id, uid, {_USER_TEXT} AS user_feature
FROM (SELECT s.row_id, s.uid, {_USER_COLS} FROM impressions s LEFT JOIN users u ON s.uid = u.entity_id)"""

_MADE = {
    "u_id": "coalesce(uid, device)", "u_device_id": "device", "u_content_id": "CAST(content_id AS BIGINT)",
    "u_wlx_content_id": "wlx_content_id", "i_recall_from": "recall_from", "i_pos": "pos", "l_click": "click",
    "l_read_time": "CAST(read_time AS DOUBLE)", "l_share": "0", "l_comment": "0", "l_praise": "0", "r_type": _R_TYPE,
}


def _sample_column(name: str, kind: str) -> str:
    if name in _MADE:
        return f"{_MADE[name]} AS {name}"
    if kind in ("int", "bigint"):
        return f"CAST(trunc(TRY_CAST({name} AS DOUBLE)) AS {kind.upper()}) AS {name}"
    return name


_cte("samples", "SELECT " + ", ".join(_sample_column(f.name, f.dataType.simpleString()) for f in SAMPLE_SCHEMA)
     + ", ds, hh FROM featured", "featured")
for _name in ("item_enrichment", "user_enrichment"):
    ORACLE[f"{_name}_bucketed"] = ORACLE[_name]

ORACLE["full_samples"] = _with("samples") + "SELECT * FROM samples"
ORACLE["full_samples_salted"] = ORACLE["full_samples"]
ORACLE["sample_records"] = _with("featured") + f"""
SELECT coalesce(uid, device) || ',' || device || ',' || content_id || ',' || wlx_content_id || ',' || {_USER_TEXT}
       || ',' || recall_from || ',' || {_ITEM_TEXT} || ',' || pos || ',' || click || ','
       || printf('%.6f', CAST(read_time AS DOUBLE)) || ',0,0,0,' || ({_R_TYPE}) AS value
FROM featured"""
ORACLE["training_label"] = _with("samples") + """
SELECT u_age, u_gender, i_cate, i_type, i_recall_from, i_covershowtype, i_pos, i_show, i_read, i_playtime,
       i_avg_readtime, l_click AS label FROM samples"""

_cte("light", """
SELECT coalesce(uid, device) AS u_id, device AS u_device_id, CAST(content_id AS BIGINT) AS u_content_id,
       content_id || ',' || pos AS u_favocate5, pos AS i_pos, ds, hh FROM shows""", "shows")
ORACLE["partition_overwrite"] = _with("light") + """
SELECT * REPLACE (CASE WHEN ds = '2024-01-15' THEN i_pos + 100 ELSE i_pos END AS i_pos) FROM light"""
ORACLE["partition_switched"] = ORACLE["partition_overwrite"]
ORACLE["partition_emptied"] = _with("light") + "SELECT * FROM light WHERE NOT (ds = '2024-01-15' AND hh = '12')"
ORACLE["texts_round_trip"] = """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN text WHEN 1 THEN '  ' || substr(text, 1, 30) || '  ' WHEN 2 THEN '' WHEN 3 THEN NULL
       WHEN 4 THEN replace(replace(text, ' ', '\\n'), 'e', '"') ELSE ',' || substr(text, 1, 5) || chr(13) END AS text
FROM documents"""
ORACLE["lines_kept_apart"] = """
SELECT o_orderkey % 5 AS kind, CASE o_orderkey % 5 WHEN 3 THEN -1 WHEN 4 THEN 7 END AS age,
       CASE o_orderkey % 5 WHEN 3 THEN 'x' WHEN 4 THEN 'none' END AS what, count(*) AS count
FROM orders GROUP BY ALL"""
ORACLE["registered_partitions"] = _with("light") + """
SELECT * EXCLUDE (hh) FROM light WHERE ds IN ('2024-01-15', '2024-01-16')"""
ORACLE["recovered_partitions"] = _with("light") + "SELECT * EXCLUDE (hh) FROM light"
ORACLE["delimited_files"] = _with("light") + "SELECT * EXCLUDE (ds, hh) FROM light"
ORACLE["item_id_files"] = _with("impressions") + """
SELECT DISTINCT unnest(string_split(content, ',')) AS content_id FROM impressions WHERE content IS NOT NULL"""

# --- encoding ----------------------------------------------------------------------

_cte("fea", """
SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 30 AS BIGINT) AS fea1, l_partkey * 6000 AS fea2,
       CAST(l_quantity AS BIGINT) AS fea7, CAST(floor(l_extendedprice) AS BIGINT) * 50 AS fea9,
       l_orderkey * 150000 AS fea15, l_suppkey * 20000000 AS fea16,
       CAST(round(l_tax * 100) AS BIGINT) * 2500 AS fea17, l_partkey * 1000003 % 2147483648 AS fea18,
       CAST(round(l_discount * 100) AS BIGINT) AS fea22, CAST(l_quantity AS BIGINT) * 3 AS fea23,
       l_partkey % 2000 AS fea24
FROM lineitem""")
_FEA_KEYS = "l_orderkey, l_linenumber, fea2"


def _bucket(text: str, size: int) -> str:
    return f"{_hash32(text)} % {size}"


def _cross(a: str, b: str, size: int) -> str:
    return f"({_hash32(a)} * 1000003 + {_hash32(b)}) % {size}"


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


for _c, (_lo, _hi, _n) in EVEN_EDGES.items():
    _cte(f"edges_{_c}", f"""
SELECT CAST(i AS INTEGER) + 1 AS b, CASE WHEN i = {_n - 1} THEN {_hi}::DOUBLE
       ELSE {_lo}::DOUBLE + i * (({_hi}::DOUBLE - {_lo}::DOUBLE) / {_n - 1}) END AS edge
FROM range({_n}) t(i)""")
_cte("bucketed", "SELECT f.*, " + ", ".join(f"coalesce(e_{c}.b, 0) AS {c}_bucket" for c in EVEN_EDGES)
     + " FROM fea f" + "".join(
         f" ASOF LEFT JOIN edges_{c} e_{c} ON CAST(f.{c} AS DOUBLE) >= e_{c}.edge" for c in EVEN_EDGES),
     "fea", *[f"edges_{c}" for c in EVEN_EDGES])

ORACLE["even_edge_buckets"] = _with("bucketed") + """
SELECT b.fea17_bucket AS bucket, round(e.edge, 6) AS lower_edge, count(*) AS n
FROM bucketed b JOIN edges_fea17 e ON b.fea17_bucket = e.b GROUP BY ALL"""
ORACLE["bucket_ids"] = _with("bucketed") + f"SELECT {_FEA_KEYS}, {', '.join(f'{c}_bucket' for c in EVEN_EDGES)} FROM bucketed"
ORACLE["uneven_buckets"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity,
       (l_quantity >= 1)::INTEGER + (l_quantity >= 2)::INTEGER + (l_quantity >= 10)::INTEGER
       + (l_quantity >= 49.5)::INTEGER AS bucket
FROM lineitem"""
ORACLE["hash_ids"] = _with("fea") + f"SELECT {_FEA_KEYS}, " + ", ".join(
    f"{_bucket(f'CAST({c} AS VARCHAR)', n)} AS {c}_id" for c, n in HASH_SIZES.items()) + " FROM fea"
ORACLE["cross_ids"] = _with("fea") + f"SELECT {_FEA_KEYS}, " + ", ".join(
    f"{_cross(_text(a), _text(b), n)} AS {a}_x_{b}" for (a, b), n in CROSS_SIZES.items()) + " FROM fea"
ORACLE["bucket_cross_ids"] = _with("bucketed") + f"SELECT {_FEA_KEYS}, " + ", ".join(
    f"{_cross(_text(a + '_bucket'), _text(b + '_bucket'), n)} AS {a}_bx_{b}" for (a, b), n in CROSS_SIZES.items()) + " FROM bucketed"


def _wide() -> str:
    start, parts = 0, []
    for c, n in HASH_SIZES.items():
        parts.append(f"({start} + {_bucket(f'CAST({c} AS VARCHAR)', n)})")
        start += n
    for (a, b), n in CROSS_SIZES.items():
        parts.append(f"({start} + {_cross(_text(a), _text(b), n)})")
        start += n
    return " || ' ' || ".join(parts)


ORACLE["wide_positions"] = _with("fea") + f"SELECT {_FEA_KEYS}, {_wide()} AS wide FROM fea"
ORACLE["numeric_features"] = _with("fea") + "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in DEEP_NUMERIC) + " FROM fea"

# --- training order ------------------------------------------------------------------

ORACLE["shuffled_rows"] = f"""
SELECT o_orderkey, o_custkey, {_hash32("'11|' || o_orderkey")} AS shuffle_key FROM orders"""
ORACLE["epochs"] = "SELECT o_orderkey, CAST(e AS INTEGER) AS epoch FROM orders, range(3) t(e)"
_cte("batched", f"""
SELECT *, position // 16 AS batch FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY shuffle_key, o_orderkey) - 1 AS position
  FROM (SELECT o_orderkey, (o_orderkey % 128) % 70 AS shard, {_hash32("'11|' || o_orderkey")} AS shuffle_key
        FROM orders))""")
ORACLE["batches"] = _with("batched") + "SELECT * FROM batched"
ORACLE["capped_steps"] = _with("batched") + "SELECT * FROM batched WHERE batch < 3"
ORACLE["batches_of_all"] = f"""
SELECT *, position // 1024 AS batch FROM (
  SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY shuffle_key, o_orderkey) - 1 AS position
  FROM (SELECT o_orderkey, CAST(e AS INTEGER) AS epoch, {_hash32("'11|' || e || '|' || o_orderkey")} AS shuffle_key
        FROM orders, range(2) t(e)))"""

# --- run log ----------------------------------------------------------------------------

_cte("metric", """
SELECT 'run' || (o_custkey % 100) AS run_id, o_orderpriority AS name,
       CASE WHEN o_orderkey % 13 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) / 100.0::DOUBLE END AS value,
       CASE WHEN o_orderkey % 2 = 0 THEN 'sec' END AS unit, o_orderkey AS global_step,
       o_orderdate + to_seconds(o_orderkey % 86400) AS ts,
       CASE WHEN o_orderkey % 3 = 0 THEN 'a=1;z=' || o_orderstatus ELSE '' END AS extras
FROM orders""")
_cte("number", "SELECT * FROM metric WHERE value IS NOT NULL", "metric")
_RECORDS = _with("number") + """
SELECT run_id, name, value, unit, global_step, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, extras FROM number"""
ORACLE["metric_records"] = _RECORDS
ORACLE["metric_log_files"] = _RECORDS
ORACLE["merged_metric_files"] = _RECORDS
_RUNS = """
SELECT 'run' || c_custkey AS run_id, 'wide_deep' AS model_name, c_mktsegment AS dataset,
       CASE WHEN c_custkey % 2 = 0 THEN 't' || c_custkey END AS test_id,
       strftime(TIMESTAMP '2024-01-01' + to_microseconds(c_custkey * 1001000), '%Y-%m-%dT%H:%M:%S.%fZ') AS run_date,
       'batch_size:-:1024:-:-;dataset:' || c_mktsegment || ':-:-:-;rate:-:-:-:' || (c_custkey % 10) || '.25;shuffle:-:-:'
       || CASE WHEN c_custkey % 2 = 0 THEN 'True' ELSE 'False' END || ':-;train_epochs:-:' || (c_custkey % 5) || ':-:-'
         AS parameters
FROM customer"""
ORACLE["run_records"] = _RUNS
ORACLE["run_description_files"] = _RUNS
ORACLE["numeric_metrics"] = _with("number") + "SELECT run_id, name, global_step, value FROM number"
ORACLE["sorted_metrics"] = ORACLE["numeric_metrics"] + " ORDER BY run_id, name, global_step"
_cte("latest", """
SELECT run_id, status, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC) AS r
  FROM (SELECT 'run' || o_custkey AS run_id, o_orderdate + to_seconds(o_orderkey) AS ts,
               CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'success' ELSE 'failure' END AS status
        FROM orders))
WHERE r = 1""")
ORACLE["latest_status"] = _with("latest") + "SELECT run_id, status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM latest"
ORACLE["run_store"] = _with("latest", "number") + """
SELECT 'run' || c_custkey AS run_id, c_mktsegment AS dataset, l.status, coalesce(m.n, 0) AS metrics
FROM customer LEFT JOIN latest l ON l.run_id = 'run' || c_custkey
LEFT JOIN (SELECT run_id, count(*) AS n FROM number GROUP BY 1) m ON m.run_id = 'run' || c_custkey"""
ORACLE["sampled_by_steps"] = _with("number") + """
SELECT run_id, name, global_step, value FROM number
QUALIFY row_number() OVER (PARTITION BY run_id, name, global_step // 500 ORDER BY global_step) = 1"""
ORACLE["sampled_by_seconds"] = _with("number") + """
SELECT run_id, name, global_step, value FROM number
QUALIFY row_number() OVER (PARTITION BY run_id, name, epoch_us(ts) // (30 * 86400 * 1000000::BIGINT)
                           ORDER BY ts, global_step) = 1"""


def _triggered(source: str, by: str, at: str, gap: int) -> str:
    """Keys and place of the rows a trigger takes: from each place the next one that is due, followed from the first."""
    return f"""
, follows AS MATERIALIZED (
  SELECT *, min({at}) OVER (PARTITION BY {by} ORDER BY {at} RANGE BETWEEN {gap} FOLLOWING AND UNBOUNDED FOLLOWING) AS due
  FROM (SELECT DISTINCT {by}, {at} FROM {source})
), taken AS (
  SELECT {by}, min({at}) AS {at} FROM follows GROUP BY {by}
  UNION ALL
  SELECT {by}, follows.due AS {at} FROM taken JOIN follows USING ({by}, {at}) WHERE follows.due IS NOT NULL
)"""


_cte("gapped", """
SELECT 'run' || (o_orderkey % 10) AS run_id, o_orderkey // 10 + 1 AS global_step, (o_orderkey // 10) * 1500 + o_orderkey % 7 * 100 AS ms
FROM orders WHERE o_custkey % 7 < 2""")
ORACLE["sampled_by_trigger"] = _with("number").replace("WITH ", "WITH RECURSIVE ", 1) + _triggered("number", "run_id, name", "global_step", 500) + """
SELECT run_id, name, global_step, value FROM number SEMI JOIN taken USING (run_id, name, global_step)"""
ORACLE["ticks_by_trigger"] = _with("gapped").replace("WITH ", "WITH RECURSIVE ", 1) + _triggered("gapped", "run_id", "ms", 10000) + """
SELECT run_id, global_step FROM gapped SEMI JOIN taken USING (run_id, ms)"""
ORACLE["throughput_by_trigger"] = (_with("gapped") + ", warm AS (SELECT * FROM gapped WHERE global_step > 20)").replace("WITH ", "WITH RECURSIVE ", 1) \
    + _triggered("warm", "run_id", "global_step", 4) + """
SELECT run_id, global_step,
       round(1024 * (global_step - lag(global_step) OVER w) / ((ms - lag(ms) OVER w) / 1000.0::DOUBLE), 4) AS current_rate,
       round(1024 * (global_step - first(global_step) OVER w) / ((ms - first(ms) OVER w) / 1000.0::DOUBLE), 4) AS average_rate
FROM warm SEMI JOIN taken USING (run_id, global_step)
WINDOW w AS (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
QUALIFY lag(global_step) OVER w IS NOT NULL"""
ORACLE["run_store_updates"] = """
SELECT 'run' || event_id AS run_id, CASE event_type WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'success' ELSE 'running' END AS status,
       strftime(CASE WHEN event_type IN ('error', 'purchase') THEN ts + INTERVAL 1 HOUR ELSE ts END, '%Y-%m-%d %H:%M:%S') AS ts,
       strftime(ts, '%Y-%m-%d') AS day
FROM events"""
ORACLE["final_values"] = _with("number") + """
SELECT run_id, name, global_step, value FROM number
QUALIFY row_number() OVER (PARTITION BY run_id, name ORDER BY global_step DESC) = 1"""

_cte("tick", """
SELECT 'run' || (o_orderkey % 10) AS run_id, o_orderkey // 10 + 1 AS global_step,
       (o_orderkey // 10) * 1500 + o_orderkey % 7 * 100 AS ms
FROM orders""")


def _rates(slot: str, warm: int, order: str) -> str:
    return _with("tick") + f"""
SELECT run_id, global_step,
       round(1024 * (global_step - lag(global_step) OVER w) / ((ms - lag(ms) OVER w) / 1000.0::DOUBLE), 4) AS current_rate,
       round(1024 * (global_step - first(global_step) OVER w) / ((ms - first(ms) OVER w) / 1000.0::DOUBLE), 4) AS average_rate
FROM (SELECT * FROM tick WHERE global_step > {warm}
      QUALIFY row_number() OVER (PARTITION BY run_id, {slot} ORDER BY {order}) = 1)
WINDOW w AS (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
QUALIFY lag(global_step) OVER w IS NOT NULL"""


ORACLE["throughput_by_steps"] = _rates("(global_step - 21) // 4", 20, "global_step")
ORACLE["throughput_by_seconds"] = _rates("ms // 10000", 5, "ms, global_step")
ORACLE["stop_steps"] = _with("number") + """
SELECT run_id, min(global_step) FILTER (WHERE value >= 495000) AS stop_step FROM number GROUP BY run_id"""

# --- evaluation ------------------------------------------------------------------------------

_cte("scored", """
SELECT l_linestatus, label, CASE WHEN l_linenumber = 6 AND l_partkey % 40 = 3 THEN NULL
            ELSE ((l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 900 + label * 60 + 30) / 1024.0::DOUBLE END AS score
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)""")


def _evaluation(by: str) -> str:
    return _with("scored") + f"""
SELECT {by + ',' if by else ''} count(score) AS examples, count(*) - count(score) AS unscored,
       round(avg(CASE WHEN (score > 0.5) = (label = 1) THEN 1.0::DOUBLE WHEN label IS NOT NULL THEN 0.0 END), 5) AS accuracy,
       round(greatest(avg(label), 1 - avg(label)), 5) AS accuracy_baseline,
       round(coalesce(avg(label) FILTER (WHERE score > 0.5), 0.0), 5) AS precision,
       round(coalesce(avg(CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0 END) FILTER (WHERE label = 1), 0.0), 5) AS recall,
       round(avg(label), 5) AS label_mean, round(avg(score), 5) AS prediction_mean,
       round(avg(CASE WHEN label = 1 THEN -ln(score) ELSE -ln(1 - score) END), 5) AS average_loss,
       round(sum(CASE WHEN label = 1 THEN -ln(score) ELSE -ln(1 - score) END) / ceil(count(score) / 1024.0::DOUBLE), 5) AS loss
FROM (SELECT l_linestatus, score, CASE WHEN score IS NOT NULL THEN label END AS label FROM scored) {'GROUP BY ' + by if by else ''}"""


ORACLE["evaluation_metrics"] = _evaluation("l_linestatus")
ORACLE["evaluation_overall"] = _evaluation("")


def _areas(by: str) -> str:
    group = f"PARTITION BY {by} " if by else ""
    keys = by + "," if by else ""
    return _with("scored") + f"""
, hist AS (SELECT {keys} CAST(floor(score * 512) AS INTEGER) AS bin, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
           FROM scored WHERE score IS NOT NULL GROUP BY {keys} bin),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM hist WINDOW w AS ({group}ORDER BY bin DESC)),
steps AS (SELECT *, tp / (tp + fp) AS prec, lag(tp, 1, 0) OVER w AS tp0, lag(fp, 1, 0) OVER w AS fp0,
                 lag(tp / (tp + fp), 1, tp / (tp + fp)) OVER w AS prec0
          FROM curve WINDOW w AS ({group}ORDER BY bin DESC))
SELECT {keys} round(sum((fp - fp0) * (tp + tp0) / 2) / (sum(pos) * sum(neg)), 5) AS auc,
       round(sum((tp - tp0) * (prec + prec0) / 2) / sum(pos), 5) AS auc_precision_recall
FROM steps {'GROUP BY ' + by if by else ''}"""


ORACLE["areas_under_curves"] = _areas("l_linestatus")
ORACLE["areas_overall"] = _areas("")



def _exact_areas(by: str) -> str:
    """Pairs in order by ranks, ties counting half; precision after each different score."""
    group = f"PARTITION BY {by} " if by else ""
    keys = by + "," if by else ""
    joined = f"USING ({by})" if by else "ON true"
    return _with("scored") + f"""
, known AS (SELECT {keys} label, score FROM scored WHERE score IS NOT NULL),
ranked AS (SELECT {keys} label, (rank() OVER up + rank() OVER up + count(*) OVER tied - 1) / 2.0::DOUBLE AS place
           FROM known WINDOW up AS ({group}ORDER BY score), tied AS (PARTITION BY {keys} score)),
roc AS (SELECT {keys} (sum(place) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) / (sum(label) * sum(1 - label)) AS auc
        FROM ranked {'GROUP BY ' + by if by else ''}),
steps AS (SELECT {keys} score, sum(label) AS pos, count(*) AS n FROM known GROUP BY {keys} score),
curve AS (SELECT *, sum(pos) OVER w / (sum(n) OVER w)::DOUBLE AS prec FROM steps WINDOW w AS ({group}ORDER BY score DESC)),
pr AS (SELECT {keys} sum(pos * (prec + before) / 2) / sum(pos) AS area FROM (
         SELECT *, coalesce(lag(prec) OVER (ORDER BY score DESC), prec) AS before FROM curve) {'GROUP BY ' + by if by else ''})
SELECT {keys} round(auc, 5) AS auc, round(area, 5) AS auc_precision_recall FROM roc JOIN pr {joined}""".replace(
        "lag(prec) OVER (ORDER", f"lag(prec) OVER ({group}ORDER")


ORACLE["areas_exact"] = _exact_areas("l_linestatus")
ORACLE["areas_exact_overall"] = _exact_areas("")

# --- training: what the test part tells of itself; the flags say what a useful model must do ---------------------

_cte("learnt", f"""
SELECT *, CASE WHEN l_linenumber IN (1, 2) AND fea7 < 45 OR fea22 = 7 THEN 1 ELSE 0 END AS label,
       {_hash32("CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) || CAST(fea2 AS VARCHAR)")} % 100 > 80 AS held_out
FROM fea""", "fea")

for _name in ("train_wide", "train_deep", "train_wide_deep"):
    ORACLE[_name] = _with("learnt") + """
SELECT count(*) AS examples, 0::BIGINT AS unscored, round(avg(label), 6) AS label_mean,
       round(greatest(avg(label), 1 - avg(label)), 6) AS accuracy_baseline, true AS ranks, true AS beats_the_mean
FROM learnt WHERE held_out"""
ORACLE["export_and_score"] = _with("learnt") + """
SELECT label, count(*) AS n, true AS same, true AS "right" FROM learnt GROUP BY label"""
ORACLE["wide_vector"] = f"SELECT l_orderkey, l_linenumber, {sum(HASH_SIZES.values()) + sum(CROSS_SIZES.values())} AS size, wide FROM ({ORACLE['wide_positions']})"
