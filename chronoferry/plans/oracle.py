"""The same results in SQL, for checking the registered queries on another engine."""

from __future__ import annotations

from chronoferry.plans import queries as q

# Building blocks ------------------------------------------------------------


def _ms(column: str) -> str:
    return f"epoch_us({column}) // 1000"


def _sliced(table: str, ts: str, slices: int = q.SLICES) -> str:
    """CTEs `r` (range), `g` (grid of slices) and `s` (rows with their slice)."""
    return f"""
    r AS (SELECT epoch_us(min({ts})) AS lo, epoch_us(max({ts})) + 1 AS hi FROM {table}),
    g AS (SELECT lo, hi, lo // 1000 * 1000 AS origin,
                 (hi // 1000 - lo // 1000) // {slices} * 1000 AS width FROM r),
    s AS (SELECT t.*, least((epoch_us(t.{ts}) - g.origin) // g.width, {slices - 1}) AS part_id
          FROM {table} t CROSS JOIN g)"""


def _edges() -> str:
    return f"""
    e AS (SELECT i AS part_id,
                 CASE WHEN i = 0 THEN lo ELSE origin + i * width END AS lo_us,
                 CASE WHEN i = {q.SLICES - 1} THEN hi ELSE origin + (i + 1) * width END AS hi_us
          FROM g CROSS JOIN range({q.SLICES}) AS n(i))"""


def _text(us: str) -> str:
    """Timestamp text with one to six fraction digits."""
    return f"regexp_replace(strftime(make_timestamp({us}), '%Y-%m-%d %H:%M:%S.%f'), '0{{1,5}}$', '')"


def _escaped(column: str) -> str:
    return rf"replace(replace(replace({column}, ',', '\,'), '=', '\='), ' ', '\ ')"


def _tag(key: str, value: str) -> str:
    return f"CASE WHEN {value} <> '' THEN '{key}=' || {_escaped(value)} END"


def _f64(key: str, value: str) -> str:
    return f"'{key}=' || CAST({value} AS VARCHAR)"


def _i64(key: str, value: str) -> str:
    return f"'{key}=' || CAST({value} AS VARCHAR) || 'i'"


def _line(measurement: str, tags: list[str], fields: list[str], ms: str, source: str, *others: str) -> str:
    head = ", ".join([f"'{measurement}'", *tags])
    kept = "".join(f", {c}" for c in others)
    return f"""
    SELECT head || ' ' || body || ' ' || CAST(ms AS VARCHAR) AS line{kept}
    FROM (SELECT concat_ws(',', {head}) AS head, concat_ws(',', {", ".join(fields)}) AS body, {ms} AS ms{kept} FROM {source})
    WHERE body <> ''"""


def _long(keys: str, source: str, ms: str, columns: list[tuple[str, str]]) -> str:
    """UNION of one SELECT per tag or field."""
    value = {
        "tag": "{c} AS s, CAST(NULL AS DOUBLE) AS f, CAST(NULL AS BIGINT) AS i",
        "f64": "CAST(NULL AS VARCHAR) AS s, {c} AS f, CAST(NULL AS BIGINT) AS i",
        "i64": "CAST(NULL AS VARCHAR) AS s, CAST(NULL AS DOUBLE) AS f, CAST({c} AS BIGINT) AS i",
    }
    return " UNION ALL ".join(
        f"SELECT {keys}, {ms} AS ts_ms, '{kind}' AS kind, '{c}' AS key, {value[kind].format(c=c)} "
        f"FROM {source} WHERE {c} IS NOT NULL"
        for kind, c in columns
    )


_LINE_KEYS = ", ".join(q.LINE_KEYS)
_LINE_KEYS_BIG = ", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in q.LINE_KEYS)
_EVENT_TAGS = [_tag("event_type", "event_type"), _tag("props", "props")]
_EVENT_FIELDS = [_i64("event_id", "event_id"), _i64("user_id", "user_id"), _f64("value", "value")]
_EVENT_POINTS = f"'events' AS measurement, {_ms('ts')} AS ts_ms, event_type, props, event_id, user_id, value"
_EVENT_LINES = _line("events", _EVENT_TAGS, _EVENT_FIELDS, _ms("ts"), "events")

_GAPS = """
    SELECT event_id AS id, ts,
           CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
           CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type,
           CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value
    FROM events"""

_LINEITEM_FIELDS = [
    ("f64", "l_discount"),
    ("f64", "l_extendedprice"),
    ("i64", "l_linenumber"),
    ("i64", "l_orderkey"),
    ("i64", "l_partkey"),
    ("f64", "l_quantity"),
    ("i64", "l_suppkey"),
    ("f64", "l_tax"),
]


def _line_fields(columns: list[tuple[str, str]]) -> list[str]:
    return [_f64(c, c) if kind == "f64" else _i64(c, c) for kind, c in columns]


def _merged(source: str, columns: list[tuple[str, str]]) -> str:
    """Last present value of each field: carried forward in order, then the last row taken."""
    names = [c for _, c in columns]
    order = "PARTITION BY l_returnflag, l_linestatus, l_shipdate ORDER BY " + _LINE_KEYS
    whole = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    last = ", ".join(f"last_value({c} IGNORE NULLS) OVER {whole} AS {c}" for c in names)
    return f"""
    SELECT 'lineitem' AS measurement, {_ms("l_shipdate")} AS ts_ms, l_linestatus, l_returnflag,
           {", ".join(f"CAST({c} AS BIGINT) AS {c}" if k == "i64" else c for k, c in columns)}, merged_rows
    FROM (SELECT l_returnflag, l_linestatus, l_shipdate, {last},
                 count(*) OVER {whole} AS merged_rows,
                 row_number() OVER ({order}) AS rn
          FROM {source})
    WHERE rn = merged_rows"""


_LINEITEM_GAPS = """(SELECT * REPLACE (CASE WHEN l_tax > 0.02 THEN l_tax END AS l_tax,
                           CASE WHEN l_discount < 0.03 THEN l_discount END AS l_discount) FROM lineitem)"""

_PAGED = "row_number() OVER (PARTITION BY part_id ORDER BY {order}) - 1"


def _page_index(table: str, ts: str, order: str) -> str:
    return f"""
    WITH {_sliced(table, ts)},
    p AS (SELECT part_id, {ts} AS t, ({_PAGED.format(order=order)}) // {q.PAGE_ROWS} AS page_no FROM s)
    SELECT part_id, page_no, count(*) AS n, min({_ms("t")}) AS first_ms, max({_ms("t")}) AS last_ms
    FROM p GROUP BY part_id, page_no"""


_LOG_LINES = f"""
    {_sliced("events", "ts")}, {_edges()},
    l AS (SELECT event_id AS pos, event_type, {_text("lo_us")} AS lo, {_text("hi_us")} AS hi
          FROM s JOIN e USING (part_id)),
    logs AS (
      SELECT pos, CASE event_type
        WHEN 'error' THEN 'ERROR Error fetching row ' || pos
        WHEN 'purchase' THEN 'Warning: slow write of row ' || pos
        WHEN 'signup' THEN 'INFO Completed processing time partition ' || lo || ' to ' || hi || ', total records: ' || pos
        ELSE 'INFO Processed ' || pos || ' records from time partition ' || lo || ' to ' || hi END AS value
      FROM l)"""

_LINEITEM_TAGS = [_tag("l_linestatus", "l_linestatus"), _tag("l_returnflag", "l_returnflag")]
_LINEITEM_MERGED = _line(
    "lineitem",
    _LINEITEM_TAGS,
    _line_fields(_LINEITEM_FIELDS),
    "ts_ms",
    f"({_merged('lineitem', _LINEITEM_FIELDS)})",
)

# The queries ----------------------------------------------------------------

ORACLE: dict[str, str] = {
    "range_full": "SELECT epoch_us(min(ts)) AS lo_us, epoch_us(max(ts)) + 1 AS hi_us FROM events",
    "range_full_compat": """
        WITH r AS (SELECT max(l_shipdate) AS last FROM lineitem)
        SELECT count(*) AS table_rows, count(*) FILTER (WHERE l_shipdate <= last) AS kept_rows,
               count(*) FILTER (WHERE l_shipdate < last) AS compat_rows
        FROM lineitem CROSS JOIN r""",
    "range_from": f"""
        SELECT epoch_us(min(o_orderdate)) AS lo_us, epoch_us(max(o_orderdate)) + 1 AS hi_us
        FROM orders WHERE o_orderdate >= TIMESTAMP '{q.ORDERS_FROM}'""",
    "range_until": f"""
        SELECT epoch_us(min(o_orderdate)) AS lo_us, epoch_us(max(o_orderdate)) + 1 AS hi_us
        FROM orders WHERE o_orderdate < TIMESTAMP '{q.ORDERS_UNTIL}'""",
    "range_explicit": f"""
        SELECT epoch_us(TIMESTAMP '{q.WEEK_FROM}') AS lo_us, epoch_us(TIMESTAMP '{q.WEEK_UNTIL}') AS hi_us,
               count(*) AS n
        FROM events WHERE ts >= TIMESTAMP '{q.WEEK_FROM}' AND ts < TIMESTAMP '{q.WEEK_UNTIL}'""",
    "range_fallback": f"""
        SELECT 'end' AS unreadable, epoch_us(min(ts)) AS lo_us, epoch_us(max(ts)) + 1 AS hi_us
        FROM events WHERE ts >= TIMESTAMP '{q.WEEK_FROM}'
        UNION ALL
        SELECT 'start', epoch_us(min(ts)), epoch_us(max(ts)) + 1 FROM events WHERE ts < TIMESTAMP '{q.WEEK_UNTIL}'
        UNION ALL
        SELECT 'both', epoch_us(min(ts)), epoch_us(max(ts)) + 1 FROM events
        UNION ALL
        SELECT 'end after a date', epoch_us(min(ts)), epoch_us(max(ts)) + 1
        FROM events WHERE ts >= DATE '{q.WEEK_FROM[:10]}'""",
    "range_empty": f"""
        SELECT count(lo) AS ranges, coalesce(sum(n), 0)::BIGINT AS n
        FROM (SELECT min(ts) AS lo, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{q.AFTER_ALL}')""",
    "time_partitions": f"WITH {_sliced('events', 'ts')}, {_edges()} SELECT part_id, lo_us, hi_us FROM e",
    "partition_counts": f"""
        WITH {_sliced("lineitem", "l_shipdate")} SELECT part_id, count(*) AS n FROM s GROUP BY part_id""",
    "quantile_slices": f"""
        SELECT count(*) AS n, {q.WEIGHTED_SLICES}::BIGINT AS slices, true AS covered, true AS even FROM lineitem""",
    "range_scan": f"""
        SELECT event_id, {_ms("ts")} AS ts_ms, user_id, event_type, value, props
        FROM events WHERE ts >= TIMESTAMP '{q.WEEK_FROM}' AND ts < TIMESTAMP '{q.WEEK_UNTIL}'""",
    "full_scan": "SELECT * REPLACE (epoch_us(o_orderdate) AS o_orderdate) FROM orders",
    "page_fetch": f"""
        SELECT {_ms("l_shipdate")} AS ts_ms, {_LINE_KEYS_BIG}, * EXCLUDE (l_shipdate, {_LINE_KEYS}) FROM lineitem
        ORDER BY l_shipdate, {_LINE_KEYS} LIMIT {q.FETCH_LIMIT} OFFSET {q.FETCH_OFFSET}""",
    "page_fetch_deep": f"""
        SELECT {_ms("l_shipdate")} AS ts_ms, {_LINE_KEYS_BIG}, * EXCLUDE (l_shipdate, {_LINE_KEYS}) FROM lineitem
        ORDER BY l_shipdate, {_LINE_KEYS} LIMIT {q.DEEP_LIMIT} OFFSET {q.DEEP_OFFSET}""",
    "page_index": _page_index("events", "ts", "ts, event_id"),
    "page_index_ties": _page_index("lineitem", "l_shipdate", f"l_shipdate, {_LINE_KEYS}"),
    "page_walk": f"""
        WITH p AS (SELECT *, (row_number() OVER (ORDER BY l_shipdate, {_LINE_KEYS}) - 1) // {q.WALK_ROWS} AS page_no FROM lineitem)
        SELECT page_no, count(*) AS n, min({_ms("l_shipdate")}) AS first_ms, max({_ms("l_shipdate")}) AS last_ms,
               sum(l_orderkey)::BIGINT AS orders, sum(l_partkey)::BIGINT AS parts
        FROM p GROUP BY page_no""",
    "page_batches": f"""
        WITH {_sliced("events", "ts")},
        p AS (SELECT *, ({_PAGED.format(order="ts, event_id")}) // {q.PAGE_ROWS} AS page_no FROM s)
        SELECT part_id, page_no, count(*) AS n,
               arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id,
               min({_ms("ts")}) AS first_ms, max({_ms("ts")}) AS last_ms
        FROM p GROUP BY part_id, page_no""",
    "page_columns": f"""
        SELECT {_ms("ts")} AS ts_ms, event_id AS rn, user_id AS _pos, event_type AS _run, value AS page_no FROM events""",
    "batch_explode": f"SELECT {_EVENT_POINTS} FROM events",
    "null_ts_filter": """
        SELECT CASE WHEN event_type = 'error' THEN 'reject' ELSE 'point' END AS outcome, count(*) AS n
        FROM events GROUP BY 1""",
    "points_long": _long(
        "event_id",
        "events",
        _ms("ts"),
        [("tag", "event_type"), ("tag", "props"), ("f64", "value"), ("i64", "event_id"), ("i64", "user_id")],
    ),
    "points_long_lineitem": _long(
        _LINE_KEYS_BIG,
        "lineitem",
        _ms("l_shipdate"),
        [("tag", "l_returnflag"), ("tag", "l_linestatus")]
        + [("f64", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
    ),
    "points_wide": f"SELECT {_EVENT_POINTS} FROM events",
    "points_as_maps": f"""
        SELECT 'events' AS measurement, {_ms("ts")} AS ts_ms, CAST(2 AS BIGINT) AS n_tags, event_type, value,
               event_id, 'event_id,user_id' AS int_keys
        FROM events""",
    "points_nulls": f"""
        SELECT id, {_ms("ts")} AS ts_ms,
               CAST((event_id IS NOT NULL)::INT + (user_id IS NOT NULL)::INT + (value IS NOT NULL)::INT AS BIGINT)
                 AS n_fields, event_type, value
        FROM ({_GAPS})""",
    "lines_with_gaps": _line("events", _EVENT_TAGS[:1], _EVENT_FIELDS, _ms("ts"), f"({_GAPS})"),
    "points_decimal": f"""
        WITH c AS (SELECT *, CAST(round(l_extendedprice * 100) AS HUGEINT) AS cents FROM lineitem),
        h AS (SELECT *, TRY_CAST(cents * 1000000000000 AS BIGINT) AS huge FROM c)
        SELECT {_LINE_KEYS_BIG}, CAST(huge IS NULL AS BIGINT) AS lost, {_ms("l_shipdate")} AS ts_ms,
               CAST(cents // 100 AS BIGINT) AS price, huge
        FROM h""",
    "points_decimal_double": f"""
        SELECT 'orders' AS measurement, {_ms("o_orderdate")} AS ts_ms, o_orderstatus, o_orderpriority,
               o_orderkey, o_custkey, o_totalprice
        FROM orders""",
    "points_binary": "SELECT 'documents' AS measurement, doc_id AS ts_ms, text AS body, doc_id FROM documents",
    "points_bool_ts": f"""
        SELECT 'orders' AS measurement, {_ms("o_orderdate")} AS ts_ms, o_orderkey,
               CASE WHEN o_totalprice > 200000 THEN 'true' ELSE 'false' END AS large,
               {_text("epoch_us(o_orderdate) + o_orderkey * 500")} AS booked,
               {_text("epoch_us(o_orderdate)")} AS placed,
               strftime(o_orderdate, '%Y-%m-%d') AS day
        FROM orders""",
    "rejects": """
        SELECT CASE event_type WHEN 'view' THEN 'time is null' ELSE 'time is not a timestamp' END AS reason,
               count(*) AS n, count(event_id) AS n_with_row
        FROM events WHERE event_type IN ('view', 'error') GROUP BY 1""",
    "points_text_time": f"SELECT {_EVENT_POINTS} FROM events WHERE event_type NOT IN ('view', 'error')",
    "line_protocol": _EVENT_LINES,
    "line_protocol_lineitem": _line(
        r"line\ item\,\ all",
        [_tag("l_linestatus", "l_linestatus"), _tag("l_returnflag", "l_returnflag")],
        _line_fields(_LINEITEM_FIELDS),
        _ms("l_shipdate"),
        "lineitem",
    ),
    "point_merge": _merged("lineitem", _LINEITEM_FIELDS),
    "point_merge_nulls": _merged(_LINEITEM_GAPS, _LINEITEM_FIELDS),
    "sink_roundtrip": f"SELECT {_EVENT_POINTS} FROM events",
    "migrate_events": _EVENT_LINES,
    "migrate_merged": _LINEITEM_MERGED,
    "migrate_resumed": f"""
        WITH {_sliced("lineitem", "l_shipdate")},
        t AS (SELECT *, CASE WHEN part_id < {q.FAILING_SLICE} THEN 1 ELSE 2 END::BIGINT AS run FROM s)
        {_line("lineitem", _LINEITEM_TAGS, _line_fields(_LINEITEM_FIELDS), _ms("l_shipdate"), "t", "run")}
        UNION ALL SELECT count(*) || ' rows read', 2 FROM t WHERE run = 2""",
    "migrate_resumed_merged": _LINEITEM_MERGED,
    "migration_slices": f"""
        WITH {_sliced("lineitem", "l_shipdate", q.MANY_SLICES)}
        SELECT merged, i AS part_id, count(s.part_id) AS n
        FROM range({q.MANY_SLICES}) AS n(i) CROSS JOIN (VALUES (false), (true)) AS m(merged)
        LEFT JOIN s ON s.part_id = i GROUP BY ALL""",
    "migration_report": f"""
        WITH kept AS (SELECT * FROM lineitem WHERE l_returnflag <> 'R'),
        {_sliced("kept", "l_shipdate")},
        m AS (SELECT count(*) AS written FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM kept))
        SELECT (SELECT count(*) FROM kept) AS read, written, (SELECT count(*) FROM kept) - written AS merged,
               (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rejected, i AS part_id, count(s.part_id) AS n
        FROM m CROSS JOIN range({q.SLICES}) AS n(i) LEFT JOIN s ON s.part_id = i GROUP BY written, i""",
    "progress_totals": f"""
        WITH {_sliced("lineitem", "l_shipdate")}, {_edges()}
        SELECT e.part_id, lo_us, hi_us, count(s.part_id) AS total
        FROM e LEFT JOIN s ON s.part_id = e.part_id GROUP BY ALL""",
    "progress_milestones": f"""
        WITH {_sliced("lineitem", "l_shipdate")},
        t AS (SELECT part_id, count(*) AS total FROM s GROUP BY part_id)
        SELECT part_id, unnest(generate_series({q.PAGE_ROWS * 10}, total, {q.PAGE_ROWS * 10})) AS processed FROM t""",
    "log_latest_progress": f"""
        WITH {_LOG_LINES}
        SELECT lo AS slice_start, hi AS slice_end, max(pos) AS records,
               arg_max(event_type, pos) = 'signup' AS done, max(pos) AS pos
        FROM l WHERE event_type NOT IN ('error', 'purchase') GROUP BY lo, hi""",
    "log_progress_tail": f"""
        WITH {_LOG_LINES} SELECT pos, value FROM logs WHERE contains(value, 'Processed') ORDER BY pos DESC LIMIT 100""",
    "log_problems": f"""
        WITH {_LOG_LINES} SELECT pos, value FROM logs
        WHERE regexp_matches(value, '(?i)error|warn|exception') ORDER BY pos DESC LIMIT 20""",
    "log_from_job": f"""
        WITH {_sliced("lineitem", "l_shipdate")}, {_edges()}
        SELECT {_text("lo_us")} AS slice_start, {_text("hi_us")} AS slice_end, count(s.part_id) AS records, true AS done,
               1 + count(s.part_id) // {q.PAGE_ROWS * 10} AS reports
        FROM e LEFT JOIN s USING (part_id) GROUP BY ALL""",
    "log_job_problems": f"""
        WITH {_sliced("lineitem", "l_shipdate")}, {_edges()},
        n AS (SELECT part_id, count(*) // {q.PAGE_ROWS * 10} AS reports FROM s WHERE part_id < {q.FAILING_SLICE} GROUP BY part_id)
        SELECT 'ERROR Error in time partition ' || {_text("lo_us")} || ' to ' || {_text("hi_us")} || ': SparkRuntimeException' AS value,
               (SELECT sum(reports)::BIGINT FROM n) AS reports
        FROM e WHERE part_id = {q.FAILING_SLICE}""",
    "log_follow": f"""
        WITH {_LOG_LINES} SELECT value FROM logs WHERE regexp_matches(value, '(?i)error|warn|exception')""",
    "log_follow_growing": f"""
        WITH {_LOG_LINES} SELECT value FROM logs WHERE regexp_matches(value, '(?i)error|warn|exception')""",
    "endpoint_lines": _EVENT_LINES,
    "endpoint_bodies": f"""
        SELECT lines, count(*) AS bodies FROM (
            SELECT count(*) AS lines FROM (SELECT (row_number() OVER () - 1) // {q.PAGE_ROWS} AS body FROM orders) GROUP BY body)
        GROUP BY lines""",
    "lines_scan": f"""
        SELECT {_EVENT_POINTS} FROM events WHERE ts >= TIMESTAMP '{q.WEEK_FROM}' AND ts < TIMESTAMP '{q.WEEK_UNTIL}'""",
    "stream_migrate": f"SELECT {_EVENT_POINTS} FROM events",
    "stream_rejects": f"""
        SELECT 'point' AS outcome, line AS text FROM ({_line("events", _EVENT_TAGS, _EVENT_FIELDS, _ms("ts"), "events", "event_type")})
        WHERE event_type NOT IN ('view', 'error')
        UNION ALL
        SELECT CASE event_type WHEN 'view' THEN 'time is null' ELSE 'time is not a timestamp' END, CAST(event_id AS VARCHAR)
        FROM events WHERE event_type IN ('view', 'error')""",
    "stream_merge": _merged("lineitem", _LINEITEM_FIELDS),
    "stream_lines": _line(
        "orders",
        [_tag("o_orderpriority", "o_orderpriority"), _tag("o_orderstatus", "o_orderstatus")],
        [_i64("o_custkey", "o_custkey"), _i64("o_orderkey", "o_orderkey"), _f64("o_totalprice", "o_totalprice")],
        _ms("o_orderdate"),
        "orders",
    ),
}
