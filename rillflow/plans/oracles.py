"""SQL of the check queries, for another engine over the same tables."""

from __future__ import annotations

LOCATION = """case o_orderpriority when '1-URGENT' then 'IN' when '2-HIGH' then 'US' when '3-MEDIUM' then '-1'
    when '4-NOT SPECIFIED' then 'I' else case when o_orderstatus = 'F' then 'X' else 'NA' end end"""

LOCATIONS = f"(select o_orderkey, {LOCATION} as country from orders) l"

VALID = "country <> 'NA' and not starts_with(country, '-') and length(country) = 2"

TEXT_LINES = """select value, count(*) as n
    from (select unnest(string_split(text, chr(10))) as value from {0}) l group by value"""

LOCATION_JSON = f"select '{{\"' || country || '\":' || count(*) || '}}' as json from {LOCATIONS} where {VALID} group by country"

NATION_NAMES = """select c_nationkey as k, 0 as t, c_name as v from customer
    union all select s_nationkey, 1, s_name from supplier"""

ALARM_DOC = r"""'{"alarmid":"' || event_id || '","alarmTitle":"' || event_type || '","deviceModel":"M' || user_id
    || '","alarmSource":' || (user_id % 7)
    || case when event_type <> 'error' then ',"alarmMsg":"' || replace(props, '"', '\"') || '"' else '' end || '}'"""

# Events whose alarm text is one record.
GOOD = "event_type <> 'purchase'"

SAMPLE = "select count(*) as n, count(distinct event_id) as n_distinct, count(*) as n_known from {} e"


def group_lines(source: str) -> str:
    return f"select k || ' : [' || string_agg(v, ', ' order by v) || ']' as line from ({source}) s group by k"



def digests(name: str, own: str, value: str) -> str:
    """Count and order-free digest of the values of the rows that are ``own``."""
    number = f"cast('0x' || md5({value})[1:15] as bigint)"
    mine = f"filter (where {own})"
    return f"""count(*) {mine} as n_{name}, coalesce(min({number}) {mine}, 0) as min_{name}, coalesce(max({number}) {mine}, 0) as max_{name},
        cast(coalesce(sum({number}) {mine}, 0) as varchar) as sum_{name}"""


def grouped_digests(rows: str, names: tuple[str, ...]) -> str:
    """Digests per key ``k`` of rows ``(k, t, v)``, of which ``t`` numbers the input."""
    each = ", ".join(digests(name, f"t = {t}", "v") for t, name in enumerate(names))
    return f"select k, {each}, true as same_sizes from ({rows}) u group by k"


ORACLES: dict[str, str] = {
    "src_values": """select word, count(*) as n from (
        select * from (values ('apple'), ('quince'), ('1-URGENT')) t(word)
        union all select o_orderpriority from orders) u group by word""",
    "src_text_lines": TEXT_LINES.format("documents"),
    "src_zip_lines": TEXT_LINES.format("documents"),
    "src_zip_locations": LOCATION_JSON,
    "src_dated_paths": "select strftime(ts, '%Y%m%d') as day, count(*) as n from events group by 1",
    "stream_log_source": "select event_id, event_type from events",
    "stream_bounded_read": "select event_id from events where ts >= timestamp '2024-01-10' order by ts, event_id limit 10",
    "queue_bounded_read": SAMPLE.format("(select * from events limit (select count(*) // 2 from events))"),
    "lim_cap_rows": SAMPLE.format("(select * from events limit (select count(*) // 2 from events))"),
    "job_dated_location_counts": LOCATION_JSON,
    "job_receive_bytes": "select 'pkey' as key, cast(event_id as varchar) as payload from events",
    "job_file_words": """select word, count(*) as n from (
        select unnest(string_split(replace(text, chr(10), ' '), ' ')) as word from conversations) w where word <> '' group by word""",
    "job_main_route": "select p_name as value, count(*) as n from part where starts_with(p_name, 's') group by 1",
    "job_union": "select c_name as value from customer union all select s_name from supplier",
    "join_cogroup_paged": grouped_digests(
        f"{NATION_NAMES} union all select -1, 2, o_orderpriority from orders", ("customers", "suppliers", "orders")
    ),
    "snk_text_roundtrip": "select p_partkey || ',' || p_name as value from part",
    "snk_text_copy": TEXT_LINES.format("conversations"),
    "snk_keyed_bytes": "select 'pkey' as key, cast(event_id as varchar) as payload from events",
    "snk_routed_outputs": """select substr(p_name, 1, 1) as output, p_name as value, count(*) as n from part
        where starts_with(p_name, 's') or starts_with(p_name, 'r') group by 1, 2""",
    "sink_idempotent_replay": "select event_id, event_type, 2 * count(*) as n from events group by 1, 2",
    "sink_compacted_batches": "select event_id, event_type, count(*) as n from events group by 1, 2",
    "stream_failure_restart": "select event_id, event_type, count(*) as n from events group by 1, 2",
    "stream_time_cap": "select true as whole_files, true as whole_first_step, cast(0 as bigint) as n_repeated, count(*) as n_source from events",
    "stream_batched_sink": f"""select case when {GOOD} then cast(event_id as varchar) end as alarmid,
        case when {GOOD} then cast(user_id % 7 as int) end as "alarmSource", case when not {GOOD} then {ALARM_DOC} || ' and more' end as bad_text from events""",
    "stream_json_documents": f"""select {ALARM_DOC} || case when {GOOD} then '' else ' and more' end as doc,
        case when {GOOD} then 'good' else 'bad' end as outcome from events""",
    "stream_kv_concat": "select case when event_type <> 'error' then event_type else 'null' end || ' # ' || props as line from events",
    "fanout_country_equals": f"select o_orderkey from {LOCATIONS} where country = 'IN'",
    "doc_count_by_location": LOCATION_JSON.replace(" as json ", " as doc "),
    "prj_bytes_payload": "select event_id, cast(event_id as varchar) as payload from events",
    "prj_tokenise": """select word, count(*) as n from (
        select unnest(string_split(replace(text, chr(10), ' '), ' ')) as word from documents) w where word <> '' group by word""",
    "prj_field": "select p_partkey, p_brand as label from part",
    "prj_location": f"select o_orderkey, country from {LOCATIONS}",
    "prj_json_parse": """select cast(event_id as varchar) as alarmid, event_type as "alarmTitle", 'M' || user_id as "deviceModel",
        cast(user_id % 7 as int) as "alarmSource", case when event_type <> 'error' then props end as "alarmMsg" from events""",
    "prj_json_quarantine": """select case when event_type in ('purchase', 'error', 'signup') or more then 'bad' else 'good' end as outcome,
        case when event_type in ('purchase', 'error') or more then 'malformed' when event_type = 'signup' then 'NULL in alarmSource' else '' end as reason,
        event_type, count(*) as n, cast(sum(case when event_type in ('click', 'view') and not more then user_id else 0 end) as bigint) as sum_source
        from (select *, event_type = 'click' and user_id % 5 in (1, 2, 3) as more from events) e group by 1, 2, 3""",
    "prj_json_serialise": f"select {ALARM_DOC} as doc from events",
    "prj_key_value": """select line, count(*) as n from (
        select case when event_type <> 'error' then event_type else 'null' end || ' # ' || props as line from events) l group by line""",
    "prj_observe_tap": "select count(*) as n from events",
    "udf_map_records": "select event_id, value * 2 as value2 from events where event_type = 'click'",
    "flt_prefix": "select p_partkey, p_name from part where starts_with(p_name, 's')",
    "flt_route": """select p_partkey, case when starts_with(p_name, 's') then 'A' else 'B' end as tag
        from part where starts_with(p_name, 's') or starts_with(p_name, 'r')""",
    "flt_route_main": "select p_partkey from part where starts_with(p_name, 's')",
    "agg_count_per_element": "select o_orderpriority as element, count(*) as n from orders group by o_orderpriority",
    "agg_count_by_location": f"select country, count(*) as n from {LOCATIONS} where {VALID} group by country",
    "agg_count_by_location_literal": f"""select country, count(*) as n from {LOCATIONS}
        where country <> 'NA' and starts_with(country, '-') and length(country) = 2 group by country""",
    "agg_count_json": LOCATION_JSON,
    "agg_count_json_quoted": "select '{\"' || p_brand || '\": \"' || count(*) || '\"}' as json from part group by p_brand",
    "agg_group_by_key": group_lines("select o_custkey as k, 0 as t, cast(o_orderkey as varchar) as v from orders"),
    "agg_group_by_key_paged": f"""select k, name, n_names, min_names, max_names, sum_names, few_pages
        from (select p_brand as k, p_name as name from part) v
        join (select p_brand as k, {digests('names', 'true', 'p_name')}, true as few_pages from part group by 1) g using (k)""",
    "join_cogroup": f"""select k || ';[' || coalesce(string_agg(v, ', ' order by v) filter (where t = 0), '')
        || '];[' || coalesce(string_agg(v, ', ' order by v) filter (where t = 1), '') || '];' as line
        from ({NATION_NAMES}) s group by k""",
    "join_cogroup3": grouped_digests(
        """select c_custkey as k, 0 as t, c_name as v from customer union all select o_custkey, 1, cast(o_orderkey as varchar) from orders
              union all select user_id, 2, event_type from events""",
        ("customers", "orders", "events"),
    ),
    "set_flatten": "select c_nationkey as k from customer union all select s_nationkey from supplier",
    "lim_sample_any": SAMPLE.format("(select * from events limit 10)"),
}
