"""Derived tables that the registered queries and their SQL share: one text for both engines, {name} stands for a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

TEXT = {
    "src_orders": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 13 <> 5",
    "tgt_orders": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 10 <> 3
        UNION ALL
        SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 50 = 0""",
    "src_cust": "SELECT c_custkey, c_name FROM {customer}",
    "tgt_cust": """
        SELECT CASE WHEN c_custkey % 20 = 0 THEN c_custkey + 500000000 ELSE c_custkey END AS c_custkey,
               CASE WHEN c_custkey % 20 = 1 THEN NULL ELSE c_name END AS c_name FROM {customer}""",
    "messages": """
        SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS partition_id, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS msg_offset,
               ts AS msg_ts, CAST(user_id AS VARCHAR(20)) AS msg_key, props AS msg_value, event_id, user_id, event_type, value
        FROM {events}""",
    "gappy_messages": """
        SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS partition_id, event_id AS msg_offset, user_id, event_type FROM {events}""",
    "ragged": """
        SELECT event_id, event_type, CASE event_type WHEN 'error' THEN chr(123) || '"k": "' || user_id || '", "why": ' || chr(123) || '"code": ' || user_id || ', "tags": ["a", "b"]' || chr(125) || chr(125)
               WHEN 'click' THEN chr(123) || '"k": ' || user_id || '.5, "at": null' || chr(125) WHEN 'view' THEN chr(123) || '"k": true' || chr(125) WHEN 'purchase' THEN chr(123) || '"other": 1' ELSE props END AS doc
        FROM {events}""",
    "parts_log": """
        SELECT 1 AS taken, table_name, partition_key, part_rows, part_bytes, part_level FROM {parts} UNION ALL
        SELECT 2 AS taken, table_name, partition_key, CAST(SUM(part_rows) AS BIGINT) AS part_rows, CAST(SUM(part_bytes) AS BIGINT) AS part_bytes, 1 AS part_level FROM {parts} GROUP BY table_name, partition_key, substring(part_name, 1, 7)""",
    "bad_messages": """
        SELECT event_id, CASE WHEN event_id % 97 = 0 THEN '[1]' WHEN event_id % 89 = 0 THEN 'bad' WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN chr(123) || '"k": "text"' || chr(125) WHEN event_id % 73 = 0 THEN chr(123) || '"k": 1.5' || chr(125) ELSE props END AS msg_value
        FROM {events}""",
    "offsets": """
        SELECT topic, partition_id, low_offset, high_offset, CASE WHEN partition_id = 3 THEN -1 ELSE high_offset - 10 * partition_id END AS committed_offset
        FROM (SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS partition_id, CAST(0 AS BIGINT) AS low_offset, COUNT(*) AS high_offset
              FROM {events} GROUP BY user_id % 4) p""",
    "src_stores": """
        SELECT CAST(o.o_custkey % 25 AS INT) AS store, n.n_name AS store_name, o.o_orderkey, o.o_orderstatus, o.o_totalprice
        FROM {orders} o JOIN {nation} n ON n.n_nationkey = o.o_custkey % 25 WHERE o.o_orderkey % 13 <> 5""",
    "tgt_stores": """
        SELECT CAST(t.o_custkey % 25 AS INT) AS store, n.n_name AS store_name, t.o_orderkey, t.o_orderstatus, t.o_totalprice
        FROM {tgt_orders} t JOIN {nation} n ON n.n_nationkey = t.o_custkey % 25""",
    "runs": """
        SELECT event_id AS run_no, CAST(user_id % 25 AS INT) AS store, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CAST(event_id % 100 AS BIGINT) AS inserted, CAST(event_id % 30 AS BIGINT) AS updated, CAST(event_id % 7 AS BIGINT) AS deleted,
               CAST(event_id % 1300 AS BIGINT) AS duration_seconds, event_type,
               CASE WHEN event_type <> 'error' THEN NULL WHEN event_id % 5 = 0 THEN 'Login timeout expired' WHEN event_id % 5 = 1 THEN 'Communication link failure'
                    WHEN event_id % 5 = 2 THEN 'Invalid column name ''foo''' WHEN event_id % 5 = 3 THEN '(40001) Transaction was deadlocked (1205)'
                    ELSE 'Violation of PRIMARY KEY constraint' END AS error
        FROM {events}""",
    "parts": """
        SELECT 'lineitem' AS table_name, CAST(EXTRACT(YEAR FROM l_shipdate) AS INT) AS partition_key, CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS part_name,
               COUNT(*) AS part_rows, COUNT(*) * 100 AS part_bytes, CAST(SUM(l_linenumber) AS BIGINT) * 90 AS raw_bytes, MAX(l_shipdate) AS modified, MAX(CAST(EXTRACT(DAY FROM l_shipdate) AS INT)) % 3 AS part_level
        FROM {lineitem} GROUP BY EXTRACT(YEAR FROM l_shipdate), CAST(l_shipdate AS DATE)""",
    "twice": "SELECT * FROM {lineitem} UNION ALL SELECT * FROM {lineitem} WHERE l_orderkey % 10 = 0",
}
_NAME = re.compile(r"\{(\w+)\}")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver's table or a derived one."""
    if name not in TEXT:
        return table(spark, sf_dir, name)
    return spark.sql(TEXT[name], **{n: fixture(spark, sf_dir, n) for n in set(_NAME.findall(TEXT[name]))})


def with_fixtures(sql: str) -> str:
    """SQL for DuckDB: the derived tables that {names} in it stand for come before it as common table expressions."""
    order: list[str] = []

    def need(text: str) -> None:
        for n in _NAME.findall(text):
            if n in TEXT and n not in order:
                need(TEXT[n])
                order.append(n)

    need(sql)
    plain = lambda t: _NAME.sub(r"\1", t)
    ctes = ", ".join(f"{n} AS ({plain(TEXT[n])})" for n in order)
    text = plain(sql).strip()
    if not ctes:
        return text
    return f"WITH {ctes}, {text[5:]}" if text[:5].upper() == "WITH " else f"WITH {ctes} {text}"
