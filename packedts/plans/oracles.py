"""What the registered queries must return, as SQL over the driver's tables.

The SQL never sees a cell: it states the expected points straight from the
events, so packing and decoding are checked as a pair.
"""

from __future__ import annotations

_EVENTS = """
    SELECT event_id, event_type AS metric, CAST(user_id % 2 AS INTEGER) AS bot, event_id // 3600 AS block,
           date_trunc('hour', ts) AS hour, date_trunc('second', ts) AS time, value
    FROM events"""

# One row per expected point, with what is known of its cell.
_POINTS = f"""
    SELECT metric, time, value, event_id,
           bot AS lsp_id,
           CASE WHEN metric <> 'error' THEN 10 + bot END AS circuit_id,
           CASE WHEN bot = 0 THEN 'p' END AS power_sign,
           CASE WHEN metric <> 'signup' THEN 'web' END AS src,
           CAST(CASE WHEN metric <> 'signup' THEN 1 ELSE 0 END AS INTEGER) AS tag_count,
           max(event_id) OVER (PARTITION BY metric, bot, hour, block) AS version,
           CAST(row_number() OVER (PARTITION BY metric, bot, hour, block ORDER BY time, event_id) - 1 AS INTEGER) AS idx,
           strftime(hour, '%Y-%m-%d') AS day
    FROM ({_EVENTS})"""

# One row per expected cell.
_CELLS = f"""
    SELECT metric, bot, CASE WHEN bot = 0 THEN 'packed' ELSE 'append' END AS kind, max(event_id) AS version,
           count(*) AS points, strftime(hour, '%Y-%m-%d') AS day, hour
    FROM ({_EVENTS}) GROUP BY metric, bot, hour, block"""

_KINDS = f"""
    SELECT kind, count(*) AS cells FROM (
        SELECT kind FROM ({_CELLS})
        UNION ALL SELECT 'annotation' FROM ({_CELLS}) WHERE version % 5 = 0
        UNION ALL SELECT 'ignored' FROM ({_CELLS}) WHERE version % 7 = 0)
    GROUP BY kind"""


def _dense(step: int) -> str:
    """Each event as 60 points of a cell of 60 events, whose points are ``step`` seconds an event apart."""
    return f"""
        SELECT metric, CAST(block % 2 AS INTEGER) AS lsp_id, event_id, count(*) AS points, CAST(sum(value) AS BIGINT) AS value,
               CAST(sum((k + 1) * value) AS BIGINT) AS weighted, min(time) AS first, max(time) AS last
        FROM (
            SELECT block, event_id, k, min(event_type) OVER (PARTITION BY block) AS metric,
                   [1, -100, 10000, -1000000000][(event_id + k) % 4 + 1] * (event_id % 100 + k) AS value,
                   TIMESTAMP '2024-01-01' + to_seconds(block * 3600 + event_id % 60 * {step} + k) AS time
            FROM (SELECT *, event_id // 60 AS block FROM events), range(60) AS r(k))
        GROUP BY metric, block, event_id"""


# Points of the dense cells that the search for a day of one series looks for, and the days with cells in that time.
_DENSE_CELLS = """
    SELECT block, min(event_type) AS metric, block % 2 AS lsp_id, TIMESTAMP '2024-01-01' + to_seconds(block * 3600) AS base,
           strftime(TIMESTAMP '2024-01-01' + to_seconds(block * 3600), '%Y-%m-%d') AS day, max(event_id % 60) * 60 + 59 AS reach
    FROM (SELECT *, event_id // 60 AS block FROM events) GROUP BY block"""
_DENSE_SEARCH = f"""
    SELECT DISTINCT day AS file FROM ({_DENSE_CELLS})
    WHERE metric = 'click' AND lsp_id = 0
      AND base <= TIMESTAMP '2024-01-02 03:20:00' AND base + to_seconds(reach) >= TIMESTAMP '2024-01-01 05:10:00'"""
_DENSE_SKIPS = f"""
    SELECT count(*) > count(*) FILTER (first <= TIMESTAMP '2024-01-02 03:20:00') AS skips
    FROM (SELECT day, min(base) AS first FROM ({_DENSE_CELLS}) GROUP BY day)"""


# What is wrong with each cell of the damaged table.
_FAULTS = f"""
    SELECT day AS file, version, CASE version % 10
        WHEN 0 THEN 'odd qualifier length'
        WHEN 1 THEN 'row key of wrong length'
        WHEN 2 THEN 'unknown metric id'
        WHEN 3 THEN 'unknown tag value id'
        WHEN 4 THEN 'unknown tag key id'
        WHEN 5 THEN CASE WHEN kind = 'packed' AND points > 1
                         THEN 'value bytes left over' ELSE 'value too short' END
        WHEN 6 THEN CASE WHEN kind = 'packed' THEN 'value bytes left over' ELSE 'value too short' END
        WHEN 7 THEN CASE WHEN kind = 'packed' THEN 'offset over one hour' END
        WHEN 8 THEN 'unsupported value width' END AS error
    FROM ({_CELLS})"""

_FLAT = "metric, time, value, lsp_id, circuit_id, power_sign, src, tag_count, version, idx"
_NO_TAGS = "metric, time, value, lsp_id, circuit_id, power_sign, version, idx"
_METRIC_IDS = "SELECT CAST(min(event_id) + 1 AS INTEGER) AS uid, event_type AS name FROM events GROUP BY event_type"

_UIDS = f"""
    SELECT uid, 'metrics' AS qualifier, name FROM ({_METRIC_IDS})
    UNION ALL
    SELECT uid, qualifier, name FROM (VALUES
        (1, 'tagk', 'bot'), (2, 'tagk', 'circuit'), (3, 'tagk', 'sign'), (4, 'tagk', 'src'),
        (1, 'tagv', '0'), (2, 'tagv', '1'), (3, 'tagv', '10'), (4, 'tagv', '11'),
        (5, 'tagv', 'n/a'), (6, 'tagv', 'p'), (7, 'tagv', 'web')) AS t(uid, qualifier, name)"""

_LISTING = """
    SELECT 'archive/' || strftime(ts, '%Y-%m-%d') || '/' || event_type AS path,
           CAST(sum(event_id % 1000 + 1) AS BIGINT) AS length
    FROM events GROUP BY 1"""

_SEARCH = f"""
    SELECT DISTINCT day AS file FROM ({_POINTS})
    WHERE metric = 'view' AND lsp_id = 0
      AND time BETWEEN TIMESTAMP '2024-01-05 10:50:00' AND TIMESTAMP '2024-01-08 10:50:00'"""

# Cells that also show up as a cell of another family, with one point's qualifier.
_COUNTED = "CASE WHEN bot = 0 THEN points ELSE 0 END + CASE WHEN version % 7 = 0 THEN 1 ELSE 0 END"

ORACLES: dict[str, str] = {
    "decode_points": f"SELECT {_FLAT} FROM ({_POINTS})",
    "decode_id3": f"SELECT {_FLAT} FROM ({_POINTS})",
    "decode_compact_names": f"SELECT {_FLAT} FROM ({_POINTS})",
    "decode_series_table": f"SELECT {_FLAT} FROM ({_POINTS})",
    "decode_without_broadcast": f"SELECT {_FLAT} FROM ({_POINTS})",
    "decode_float32": f"""
        SELECT metric, lsp_id, time, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, version, idx FROM ({_POINTS})""",
    # Whole numbers have no negative zero, hence the way over BIGINT.
    "decode_ints": f"""
        SELECT metric, lsp_id, time, version, idx,
               CAST(CAST(CASE event_id % 5 WHEN 0 THEN round(value * 100) WHEN 1 THEN -round(value * 100)
                    WHEN 2 THEN round(value * 100) * 1000 WHEN 3 THEN round(value * 100) * -1000000000
                    ELSE event_id % 128 - 64 END AS BIGINT) AS DOUBLE) AS value
        FROM ({_POINTS})""",
    "uid_dictionary": _UIDS,
    "uid_duplicates": f"""
        SELECT 'metrics' AS qualifier, uid, CAST(2 AS BIGINT) AS entries, 'duplicate id' AS fault
        FROM ({_METRIC_IDS}) WHERE uid % 2 = 0
        UNION ALL
        SELECT 'other', uid, CAST(1 AS BIGINT), 'unknown kind' FROM ({_METRIC_IDS}) WHERE uid % 2 = 1""",
    "promoted_tags": f"""
        SELECT metric, lsp_id, circuit_id, power_sign, src, count(*) AS points,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM ({_POINTS}) GROUP BY metric, lsp_id, circuit_id, power_sign, src""",
    "search_files": _SEARCH,
    "search_files_pruned": _SEARCH,
    "search_files_indexed": f"SELECT file, true AS skips FROM ({_SEARCH})",
    "file_index": f"""
        SELECT day AS file, CAST(sum(CASE WHEN version % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS cells,
               CAST(min(epoch(hour)) AS BIGINT) AS first_base, CAST(max(epoch(hour)) AS BIGINT) AS last_base
        FROM ({_CELLS}) GROUP BY day""",
    "count_points": f"SELECT CAST(sum({_COUNTED}) AS BIGINT) AS points FROM ({_CELLS})",
    "count_points_by_file": f"""
        SELECT day AS file, CAST(sum({_COUNTED}) AS BIGINT) AS points FROM ({_CELLS}) GROUP BY day""",
    "row_count": "SELECT count(*) AS points FROM events",
    "time_range": """
        SELECT min(date_trunc('second', ts)) AS min_time, max(date_trunc('second', ts)) AS max_time FROM events""",
    "header_profile": """
        SELECT count(*) AS points, min(date_trunc('second', ts)) AS min_time, max(date_trunc('second', ts)) AS max_time FROM events""",
    "search_dense": _DENSE_SEARCH,
    "search_dense_pruned": _DENSE_SEARCH,
    "search_dense_indexed": f"SELECT file, skips FROM ({_DENSE_SEARCH}), ({_DENSE_SKIPS})",
    "decode_dense": _dense(60),
    "decode_dense_append": _dense(68),
    "missing_files": "SELECT CAST(0 AS BIGINT) AS cells",
    "long_ids": "SELECT DISTINCT 'metrics' AS qualifier, event_type AS name, 5 AS bytes FROM events",
    "point_files": f"""
        SELECT day AS file, metric, printf('%02X', (uid + lsp_id) % 4) AS salt, count(*) AS points
        FROM ({_POINTS}) JOIN ({_METRIC_IDS}) ON metric = name GROUP BY 1, 2, 3""",
    "series_table": f"""
        SELECT metric, bot AS lsp_id, CASE WHEN metric <> 'error' THEN 10 + bot END AS circuit_id,
               CASE WHEN bot = 0 THEN 'p' END AS power_sign, CASE WHEN metric <> 'signup' THEN 'web' END AS src,
               CAST(sum(CASE WHEN version % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS cells,
               CAST(NULL AS VARCHAR) AS series_error
        FROM ({_CELLS}) GROUP BY metric, bot""",
    "cell_kinds": _KINDS,
    "empty_files": _KINDS,
    "invalid_cells": f"SELECT file, version, error FROM ({_FAULTS}) WHERE error IS NOT NULL",
    # An append cell may hold an offset beyond its hour, which moves the first point of some.
    "quarantine": f"""
        SELECT strftime(CASE WHEN version % 10 = 7 AND idx = 0 THEN date_trunc('hour', time) + INTERVAL 3840 SECOND ELSE time END,
                        '%Y-%m-%d') AS day, 'good' AS outcome, count(*) AS rows
        FROM (SELECT * FROM ({_POINTS}) WHERE version NOT IN (SELECT version FROM ({_FAULTS}) WHERE error IS NOT NULL))
        GROUP BY 1
        UNION ALL
        SELECT file, error, count(*) FROM ({_FAULTS}) WHERE error IS NOT NULL GROUP BY file, error""",
    "dedupe_points": f"SELECT {_NO_TAGS} FROM ({_POINTS})",
    "dedupe_resumed": f"SELECT {_NO_TAGS} FROM ({_POINTS})",
    "dedupe_sliced": f"SELECT {_NO_TAGS} FROM ({_POINTS})",
    "slice_plan": f"""
        SELECT slice, predicate, CAST(2 * count(time) AS BIGINT) AS points
        FROM (
            SELECT CAST(k AS INTEGER) AS slice,
                CASE WHEN k > 0 THEN TIMESTAMP '2023-12-16' + to_days(CAST(10 * (k - 1) AS INTEGER)) END AS lower,
                CASE WHEN k < 7 THEN TIMESTAMP '2023-12-16' + to_days(CAST(10 * k AS INTEGER)) END AS upper,
                concat_ws(' and ', strftime(lower, 'time>=''%Y-%m-%d %H:%M:%SZ'''),
                    strftime(upper, 'time<''%Y-%m-%d %H:%M:%SZ''')) AS predicate
            FROM range(8) AS r(k)
        ) LEFT JOIN ({_POINTS}) ON time >= coalesce(lower, TIMESTAMP '1900-01-01')
            AND time < coalesce(upper, TIMESTAMP '9999-01-01')
        GROUP BY slice, predicate""",
    "write_day_partitioned": f"""
        SELECT strftime(time, '%Y-%m-%d') AS day, count(*) AS points, CAST(0 AS BIGINT) AS unsorted, CAST(0 AS BIGINT) AS overlapping
        FROM ({_POINTS}) GROUP BY 1""",
    "write_exact_order": f"""
        SELECT strftime(time, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS points, CAST(0 AS BIGINT) AS overlapping
        FROM ({_POINTS}) GROUP BY 1""",
    "write_fanout": f"""
        SELECT strftime(time, '%Y-%m-%d') AS day, metric, count(*) AS points FROM ({_POINTS}) GROUP BY 1, 2""",
    "write_ordered": f"""
        SELECT strftime(time, '%Y-%m-%d') AS day, count(*) AS points, CAST(0 AS BIGINT) AS unsorted
        FROM ({_POINTS}) GROUP BY 1""",
    "input_budget": f"""
        SELECT path, length FROM (
            SELECT path, length, coalesce(sum(length) OVER (
                ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({_LISTING}))
        WHERE before <= 2000000""",
    "file_order": f"SELECT path, length FROM ({_LISTING}) ORDER BY length DESC, path",
    "source_files": f"""
        SELECT path, length FROM (
            SELECT path || CASE WHEN path LIKE '%signup' THEN '.d/f3' ELSE '' END AS path, length FROM ({_LISTING})
            WHERE path NOT LIKE '%click' AND path NOT LIKE '%view')""",
    "big_endian": """
        SELECT l_orderkey, l_linenumber,
               CAST(n % 32768 AS SMALLINT) AS short_value, CAST(n * 299 AS INTEGER) AS int_value,
               CAST(abs(n) AS INTEGER) AS three_byte_value,
               CASE WHEN n < 0 THEN n + 4294967296 ELSE n END AS unsigned_value, n * 1000000007 AS long_value
        FROM (SELECT l_orderkey, l_linenumber,
                     CAST(CASE WHEN l_linenumber % 2 = 0 THEN -l_orderkey ELSE l_orderkey END AS BIGINT) AS n
              FROM lineitem)""",
    "value_bytes": """
        SELECT event_id, CAST(CAST(v AS FLOAT) AS DOUBLE) AS float32_value, v AS float64_value
        FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN -value ELSE value END AS v FROM events)""",
}
