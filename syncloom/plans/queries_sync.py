"""Queries of sources, filters, joins, chunks, change detection and table apply, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, documents
from ..operators import apply, changes, chunks, digests, keys, snapshots
from ..sources import sinks, tables
from ..sources.scratch import shared_folder
from .fixtures import fixture as fx
from .registry import registered
from .spec import SyncSpec

ORDERS = SyncSpec(["o_orderkey"], scope="o_orderkey")
KEY = ["o_orderkey"]
_ACTION = """
    CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'target_only'
         WHEN s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
              OR s.o_orderdate IS DISTINCT FROM t.o_orderdate OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'update' ELSE 'unchanged' END"""
_FULL = "{src_orders} s FULL OUTER JOIN {tgt_orders} t ON s.o_orderkey = t.o_orderkey"
_BOUNDS = "(SELECT MIN(o_orderkey) AS low, MAX(o_orderkey) AS high FROM {src_orders}) b"
_SYNCED = f"""
    SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL AND t.o_orderkey BETWEEN b.low AND b.high THEN 'delete' WHEN s.o_orderkey IS NULL THEN 'outside' ELSE {_ACTION} END AS action
    FROM {_FULL} CROSS JOIN {_BOUNDS}"""


# --- sources


@registered("SELECT * FROM {orders}")
def scan_table(spark: SparkSession, d: str) -> DataFrame:
    return tables.scan(fx(spark, d, "orders"))


@registered("""
    WITH p AS (SELECT l_orderkey, SUM(l_linenumber) AS lines FROM {lineitem} GROUP BY l_orderkey)
    SELECT o.o_orderkey, CAST(p.lines AS BIGINT) AS lines FROM {orders} o JOIN p ON p.l_orderkey = o.o_orderkey WHERE o.o_orderdate >= TIMESTAMP '1995-01-01' AND o.o_orderpriority = '1-URGENT'""")
def scan_query(spark: SparkSession, d: str) -> DataFrame:
    text = """
        WITH p AS (SELECT l_orderkey, SUM(l_linenumber) AS lines FROM {lineitem} GROUP BY l_orderkey)
        SELECT o.o_orderkey, p.lines FROM {orders} o JOIN p ON p.l_orderkey = o.o_orderkey
        WHERE o.o_orderdate >= to_timestamp_ntz(:ds) AND o.o_orderdate >= to_timestamp_ntz('{{ ds }}') AND o.o_orderpriority = :priority"""
    return tables.query(spark, text, {"priority": "1-URGENT"}, ds="1995-01-01", lineitem=fx(spark, d, "lineitem"), orders=fx(spark, d, "orders"))


@registered("SELECT event_id, user_id, event_type FROM {events} WHERE event_type <> 'error' AND event_id BETWEEN 10 AND 5000")
def collection_find(spark: SparkSession, d: str) -> DataFrame:
    return tables.find(fx(spark, d, "events"), F.col("event_type") != "error", ["event_id", "user_id", "event_type"], [("user_id", 1), ("event_id", -1)], "event_id", 10, 5000)


@registered("SELECT user_id, COUNT(*) AS events, MAX(event_id) AS last_event FROM {events} WHERE event_type <> 'error' GROUP BY user_id HAVING COUNT(*) > 2")
def collection_aggregate(spark: SparkSession, d: str) -> DataFrame:
    stages = lambda df: df.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_event")).filter("events > 2")
    return tables.aggregate(fx(spark, d, "events"), F.col("event_type") != "error", stages)


@registered("""
    SELECT event_id, CASE WHEN json_valid(doc) THEN TRY_CAST(json_extract_string(doc, '$.k') AS DOUBLE) END AS k, CASE WHEN json_valid(doc) THEN TRY_CAST(json_extract_string(doc, '$.why.code') AS BIGINT) END AS code,
           CASE WHEN json_valid(doc) THEN json_extract_string(doc, '$.why.tags[1]') END AS tag FROM {ragged} WHERE event_type <> 'view'""")
def ragged_find(spark: SparkSession, d: str) -> DataFrame:
    """Documents of several shapes in one column: fields by path, whatever their types; a broken document has none."""
    docs = documents.ragged(fx(spark, d, "ragged"), "doc")
    picked = [documents.at_path("document", p, t).alias(n) for n, p, t in (("k", "$.k", "double"), ("code", "$.why.code", "bigint"), ("tag", "$.why.tags[1]", "string"))]
    return tables.find(docs, F.col("event_type") != "view").select("event_id", *picked)


@registered("""
    SELECT event_type, CASE WHEN NOT json_valid(doc) THEN 'broken' WHEN json_type(doc, '$.k') = 'VARCHAR' THEN 'STRING' WHEN json_type(doc, '$.k') = 'DOUBLE' THEN 'DECIMAL' WHEN json_type(doc, '$.k') IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' ELSE json_type(doc, '$.k') END AS kind,
           COUNT(*) AS "rows" FROM {ragged} GROUP BY 1, 2""")
def ragged_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Which types a field has, by kind of document."""
    docs = documents.ragged(fx(spark, d, "ragged"), "doc")
    kind = F.when(F.col("document").isNull(), "broken").otherwise(F.regexp_extract(documents.kind_at("document", "$.k"), r"^\w+", 0))
    return tables.aggregate(docs, None, lambda df: df.groupBy("event_type", kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows")))


@registered("SELECT COUNT(*) AS \"rows\" FROM {lineitem} WHERE l_quantity > 25")
def source_count(spark: SparkSession, d: str) -> DataFrame:
    return tables.count(tables.scan(fx(spark, d, "lineitem"), where=F.col("l_quantity") > 25))


@registered("SELECT MIN(l_orderkey) AS min_key, MAX(l_orderkey) AS max_key FROM {lineitem} WHERE l_returnflag = 'R'")
def key_bounds(spark: SparkSession, d: str) -> DataFrame:
    return tables.key_bounds(tables.scan(fx(spark, d, "lineitem"), where=F.col("l_returnflag") == "R"), "l_orderkey")


@registered("SELECT * FROM {supplier} WHERE s_nationkey = 7 ORDER BY s_suppkey LIMIT 1")
def store_lookup(spark: SparkSession, d: str) -> DataFrame:
    return tables.lookup(fx(spark, d, "supplier"), F.col("s_nationkey") == 7, ["s_suppkey"])


# --- projections and filters


@registered("SELECT o_orderkey, o_orderdate FROM {orders}")
def project_columns(spark: SparkSession, d: str) -> DataFrame:
    return tables.scan(fx(spark, d, "orders"), ["o_orderkey", "o_orderdate"])


@registered("SELECT l_orderkey, l_linenumber, l_shipdate FROM {lineitem} WHERE CAST(l_shipdate AS DATE) = DATE '1995-06-17'")
def date_slice(spark: SparkSession, d: str) -> DataFrame:
    return tables.scan(fx(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_shipdate"], "l_shipdate", "19950617")


@registered("SELECT * FROM {orders} WHERE o_custkey BETWEEN 100 AND 800")
def chunk_filter(spark: SparkSession, d: str) -> DataFrame:
    return chunks.chunk_filter(fx(spark, d, "orders"), "o_custkey", 100, 800)


@registered("SELECT store, o_orderkey, o_orderstatus FROM {src_stores} WHERE store = 7")
def store_slice(spark: SparkSession, d: str) -> DataFrame:
    text = "SELECT store, o_orderkey, o_orderstatus FROM {stores} WHERE store = :store"
    return tables.query(spark, text, {"store": 7}, stores=fx(spark, d, "src_stores"))


@registered("SELECT * FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def first_page(spark: SparkSession, d: str) -> DataFrame:
    return tables.first_page(fx(spark, d, "orders"), [F.desc("o_totalprice"), F.col("o_orderkey")], 100)


# --- joins


@registered("""
    SELECT s.c_name, s.s_rows, t.t_rows, s.s_rows * t.t_rows AS pairs FROM (SELECT c_name, COUNT(*) AS s_rows FROM {src_cust} GROUP BY c_name UNION ALL SELECT NULL, 1) s
    JOIN (SELECT c_name, COUNT(*) AS t_rows FROM {tgt_cust} GROUP BY c_name) t ON s.c_name IS NOT DISTINCT FROM t.c_name""")
def nullsafe_join(spark: SparkSession, d: str) -> DataFrame:
    """Names of both sides, one of them without a name, matched NULL-safely; each side is counted by name first, so that no pairs of a group are made."""
    n = F.count(F.lit(1))
    s = fx(spark, d, "src_cust").groupBy("c_name").agg(n.alias("s_rows"))
    s = s.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("c_name"), F.lit(1).cast("bigint").alias("s_rows")))
    t = fx(spark, d, "tgt_cust").groupBy("c_name").agg(n.alias("t_rows"))
    return s.join(t, keys.same_keys(s, t, ["c_name"])).select(t["c_name"], "s_rows", "t_rows", (F.col("s_rows") * F.col("t_rows")).alias("pairs"))


@registered("SELECT s.* FROM {src_orders} s WHERE NOT EXISTS (SELECT 1 FROM {tgt_orders} t WHERE t.o_orderkey = s.o_orderkey)")
def missing_in_target(spark: SparkSession, d: str) -> DataFrame:
    return apply.missing_in_target(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), KEY)


@registered("SELECT t.* FROM {tgt_orders} t CROSS JOIN " + _BOUNDS.replace(" b", " b") + " WHERE t.o_orderkey BETWEEN b.low AND b.high AND NOT EXISTS (SELECT 1 FROM {src_orders} s WHERE s.o_orderkey = t.o_orderkey)", columns="o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority")
def missing_in_source(spark: SparkSession, d: str) -> DataFrame:
    return apply.missing_in_source(fx(spark, d, "tgt_orders"), fx(spark, d, "src_orders"), KEY, "o_orderkey")


@registered("SELECT t.c_custkey, t.c_name FROM {tgt_cust} t WHERE EXISTS (SELECT 1 FROM {src_cust} s WHERE s.c_name IS NOT DISTINCT FROM t.c_name AND s.c_custkey IS DISTINCT FROM t.c_custkey)")
def unique_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return keys.unique_conflicts(fx(spark, d, "tgt_cust"), fx(spark, d, "src_cust"), ["c_custkey"], [["c_name"]])


@registered(f"SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey, {_ACTION} AS action FROM {_FULL}")
def change_set(spark: SparkSession, d: str) -> DataFrame:
    found = changes.change_set(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), KEY)
    return found.select(F.coalesce("s.o_orderkey", "t.o_orderkey").alias("o_orderkey"), "action")


# --- chunks


@registered("SELECT chunk_no, MIN(o_orderkey) AS min_key, MAX(o_orderkey) AS max_key, COUNT(*) AS row_count FROM (SELECT o_orderkey, CAST(ntile(8) OVER (ORDER BY o_orderkey) AS INT) AS chunk_no FROM {src_orders}) x GROUP BY chunk_no")
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    return chunks.chunk_plan(fx(spark, d, "src_orders"), "o_orderkey", 8)


@registered("""
    WITH k AS (SELECT l_partkey, COUNT(*) AS n FROM {lineitem} GROUP BY l_partkey),
         c AS (SELECT l_partkey, n, COALESCE(SUM(n) OVER (ORDER BY l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_row, SUM(n) OVER () AS total FROM k),
         q AS (SELECT *, total // 16 AS q, total % 16 AS r FROM c),
         t AS (SELECT *, CASE WHEN first_row < r * (q + 1) THEN first_row // (q + 1) + 1 ELSE r + (first_row - r * (q + 1)) // q + 1 END AS tile FROM q)
    SELECT CAST(row_number() OVER (ORDER BY tile) AS INT) AS chunk_no, MIN(l_partkey) AS min_key, MAX(l_partkey) AS max_key, CAST(SUM(n) AS BIGINT) AS row_count FROM t GROUP BY tile""")
def bucket_plan(spark: SparkSession, d: str) -> DataFrame:
    return chunks.bucket_plan(fx(spark, d, "lineitem"), "l_partkey", 16)


@registered("""
    SELECT CAST(row_number() OVER (PARTITION BY topic ORDER BY partition_id) AS INT) AS chunk_no, topic, partition_id, row_count
    FROM (SELECT topic, partition_id, GREATEST(high_offset - CASE WHEN committed_offset >= 0 THEN committed_offset ELSE low_offset END, 0) AS row_count FROM {offsets}) x WHERE row_count > 0""")
def partition_plan(spark: SparkSession, d: str) -> DataFrame:
    return chunks.partition_plan(fx(spark, d, "offsets")).drop("committed_offset")


@registered("SELECT chunk_no, MIN(o_custkey) AS min_scope, MAX(o_custkey) AS max_scope FROM (SELECT o_custkey, CAST(ntile(8) OVER (ORDER BY o_orderkey) AS INT) AS chunk_no FROM {src_orders}) x GROUP BY chunk_no")
def chunk_scope_bounds(spark: SparkSession, d: str) -> DataFrame:
    return chunks.chunk_scope_bounds(fx(spark, d, "src_orders"), "o_orderkey", "o_custkey", 8)


@registered("SELECT event_id, user_id, CAST(ntile(7) OVER (ORDER BY user_id, event_id) AS INT) AS chunk_no FROM {events}")
def chunk_assign(spark: SparkSession, d: str) -> DataFrame:
    return chunks.chunk_assign(fx(spark, d, "events").select("event_id", "user_id"), "user_id", 7, ("event_id",))


# --- change detection


_HASHED = "concat_ws(chr(31), CAST(o_custkey AS VARCHAR), COALESCE(o_orderstatus, 'NULL'), COALESCE(o_orderpriority, 'NULL'))"


@registered(f"SELECT o_orderkey, sha256({_HASHED}) AS row_sha256, md5({_HASHED}) AS row_md5 FROM {{tgt_orders}}")
def row_hash(spark: SparkSession, d: str) -> DataFrame:
    cols = [F.col(c) for c in ("o_custkey", "o_orderstatus", "o_orderpriority")]
    return fx(spark, d, "tgt_orders").select("o_orderkey", changes.row_hash(cols).alias("row_sha256"), changes.row_hash(cols, "md5").alias("row_md5"))


@registered(f"SELECT s.o_orderkey FROM {{src_orders}} s JOIN {{tgt_orders}} t ON s.o_orderkey = t.o_orderkey WHERE {_ACTION} = 'update'")
def changed_by_hash(spark: SparkSession, d: str) -> DataFrame:
    found = changes.change_set(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), KEY, compare="sha256")
    return found.filter("action = 'update'").select("s.o_orderkey")


@registered(f"SELECT s.o_orderkey FROM {{src_orders}} s JOIN {{tgt_orders}} t ON s.o_orderkey = t.o_orderkey WHERE {_ACTION} = 'update'")
def changed_by_column(spark: SparkSession, d: str) -> DataFrame:
    found = changes.change_set(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), KEY)
    return found.filter("action = 'update'").select("s.o_orderkey")


@registered("""
    SELECT s.o_orderkey, CASE WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus AND s.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'o_orderstatus,o_totalprice'
                              WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus THEN 'o_orderstatus' ELSE 'o_totalprice' END AS changed
    FROM {src_orders} s JOIN {tgt_orders} t ON s.o_orderkey = t.o_orderkey WHERE s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_totalprice IS DISTINCT FROM t.o_totalprice""")
def changed_columns(spark: SparkSession, d: str) -> DataFrame:
    found = changes.change_set(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), KEY).filter("action = 'update'")
    names = changes.changed_columns({c: (F.col(f"s.{c}"), F.col(f"t.{c}")) for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")})
    return found.select("s.o_orderkey", F.concat_ws(",", names).alias("changed"))


# --- table apply


@registered("SELECT * FROM {tgt_orders} UNION ALL SELECT * FROM {src_orders} WHERE o_orderkey % 10 = 3")
def insert_rows(spark: SparkSession, d: str) -> DataFrame:
    return apply.insert_rows(fx(spark, d, "tgt_orders"), fx(spark, d, "src_orders").filter("o_orderkey % 10 = 3"))


@registered("""
    SELECT t.o_orderkey, COALESCE(s.o_custkey, t.o_custkey) AS o_custkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
           COALESCE(s.o_totalprice, t.o_totalprice) AS o_totalprice, COALESCE(s.o_orderdate, t.o_orderdate) AS o_orderdate, COALESCE(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority
    FROM {tgt_orders} t LEFT JOIN {src_orders} s ON s.o_orderkey = t.o_orderkey""")
def update_rows(spark: SparkSession, d: str) -> DataFrame:
    return apply.update_rows(fx(spark, d, "tgt_orders"), fx(spark, d, "src_orders"), KEY)


@registered("SELECT * FROM {tgt_orders} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {src_orders} WHERE o_orderstatus = 'F')")
def delete_rows(spark: SparkSession, d: str) -> DataFrame:
    gone = fx(spark, d, "src_orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return apply.delete_rows(fx(spark, d, "tgt_orders"), gone)


@registered("SELECT * FROM {src_orders} UNION ALL SELECT * FROM {tgt_orders} t WHERE NOT EXISTS (SELECT 1 FROM {src_orders} s WHERE s.o_orderkey = t.o_orderkey)")
def upsert_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return apply.full_sync(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), SyncSpec(KEY))[0]


@registered("SELECT * FROM {tgt_orders} UNION ALL SELECT * FROM {src_orders} s WHERE NOT EXISTS (SELECT 1 FROM {tgt_orders} t WHERE s.o_orderkey = t.o_orderkey)")
def upsert_insert_only(spark: SparkSession, d: str) -> DataFrame:
    return apply.insert_only(fx(spark, d, "tgt_orders"), fx(spark, d, "src_orders"), KEY)


@registered("SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}")
def key_set(spark: SparkSession, d: str) -> DataFrame:
    return keys.key_set(fx(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered("""
    SELECT * FROM {src_orders} UNION ALL
    SELECT t.* FROM {tgt_orders} t WHERE NOT EXISTS (SELECT 1 FROM {src_orders} s WHERE s.o_orderkey = t.o_orderkey)
        AND NOT (t.o_orderkey BETWEEN (SELECT MIN(o_orderkey) FROM {src_orders}) AND (SELECT MAX(o_orderkey) FROM {src_orders}))""")
def full_sync(spark: SparkSession, d: str) -> DataFrame:
    return apply.full_sync(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), ORDERS)[0]


@registered("SELECT " + ", ".join(f"COUNT(CASE WHEN action = '{a}' THEN 1 END) AS \"{a}\"" for a in apply.ACTIONS) + f" FROM ({_SYNCED}) x")
def full_sync_summary(spark: SparkSession, d: str) -> DataFrame:
    return apply.full_sync(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), ORDERS)[1]


@registered("SELECT " + ", ".join(f"COUNT(CASE WHEN action = '{a}' THEN 1 END) AS \"{a}\"" for a in apply.ACTIONS) + f" FROM ({_SYNCED}) x")
def observed_sync(spark: SparkSession, d: str) -> DataFrame:
    """The same counts, taken by the job that writes the new snapshot."""
    path = shared_folder(spark)
    told = apply.written_sync(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), ORDERS, lambda df: sinks.write_snapshot(df, path))
    return spark.createDataFrame([tuple(told.values())], ", ".join(f"`{a}` bigint" for a in told))


@registered("SELECT " + ", ".join(f"COUNT(CASE WHEN action = '{a}' THEN 1 END) AS \"{a}\"" for a in apply.ACTIONS) + f" FROM ({_SYNCED}) x")
def digest_changes(spark: SparkSession, d: str) -> DataFrame:
    """The same counts, where only buckets of keys whose digests differ are joined row by row."""
    return digests.digest_changes(fx(spark, d, "src_orders"), fx(spark, d, "tgt_orders"), ORDERS, 512)[1]


@registered("""
    SELECT * FROM {src_orders} UNION ALL
    SELECT t.* FROM {tgt_orders} t WHERE NOT EXISTS (SELECT 1 FROM {src_orders} s WHERE s.o_orderkey = t.o_orderkey)
        AND NOT (t.o_orderkey BETWEEN (SELECT MIN(o_orderkey) FROM {src_orders}) AND (SELECT MAX(o_orderkey) FROM {src_orders}))""")
def digest_sync(spark: SparkSession, d: str) -> DataFrame:
    """A table with stored digests after a sync that has read and written its unlike buckets only."""
    path = shared_folder(spark)
    sinks.write_digested(fx(spark, d, "tgt_orders"), path, KEY, 32)
    snapshots.sync_digested(fx(spark, d, "src_orders"), path, ORDERS, 32)
    return sinks.read_digested(spark, path)


@registered("SELECT * FROM {src_orders} UNION ALL SELECT * FROM {tgt_orders} t WHERE NOT EXISTS (SELECT 1 FROM {src_orders} s WHERE s.o_orderkey = t.o_orderkey)")
def upsert_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """An upsert into a snapshot that is bucketed by its key: the table isn't shuffled."""
    path = shared_folder(spark)
    sinks.write_snapshot(fx(spark, d, "tgt_orders"), path, bucket_by=(KEY, 8))
    return apply.full_sync(fx(spark, d, "src_orders"), sinks.read_snapshot(spark, path), SyncSpec(KEY, null_safe=False))[0]


@registered("""
    WITH x AS (SELECT COALESCE(s.store, t.store) AS store, s.o_orderkey AS sk, t.o_orderkey AS tk, b.low, b.high,
                      s.store_name IS DISTINCT FROM t.store_name OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_totalprice IS DISTINCT FROM t.o_totalprice AS changed
               FROM {src_stores} s FULL OUTER JOIN {tgt_stores} t ON s.store = t.store AND s.o_orderkey = t.o_orderkey
               LEFT JOIN (SELECT store, MIN(o_orderkey) AS low, MAX(o_orderkey) AS high FROM {src_stores} GROUP BY store) b ON b.store = COALESCE(s.store, t.store))
    SELECT store, COUNT(CASE WHEN tk IS NULL THEN 1 END) AS "insert", COUNT(CASE WHEN sk IS NOT NULL AND tk IS NOT NULL AND changed THEN 1 END) AS "update",
           COUNT(CASE WHEN sk IS NOT NULL AND tk IS NOT NULL AND NOT changed THEN 1 END) AS "unchanged", COUNT(CASE WHEN sk IS NULL AND tk BETWEEN low AND high THEN 1 END) AS "delete"
    FROM x GROUP BY store""")
def store_fanout_summary(spark: SparkSession, d: str) -> DataFrame:
    return apply.store_summary(fx(spark, d, "src_stores"), fx(spark, d, "tgt_stores"), SyncSpec(["store", "o_orderkey"], scope="o_orderkey"))


@registered("""
    SELECT s.* FROM {src_stores} s UNION ALL
    SELECT t.* FROM {tgt_stores} t JOIN (SELECT store, MIN(o_orderkey) AS low, MAX(o_orderkey) AS high FROM {src_stores} GROUP BY store) b ON b.store = t.store
    WHERE NOT EXISTS (SELECT 1 FROM {src_stores} s WHERE s.store = t.store AND s.o_orderkey = t.o_orderkey) AND NOT t.o_orderkey BETWEEN b.low AND b.high""")
def store_fanout(spark: SparkSession, d: str) -> DataFrame:
    """All stores' tables after a fan-out, written with a slice for each store and read again."""
    path = shared_folder(spark)
    done = apply.store_snapshots(fx(spark, d, "src_stores"), fx(spark, d, "tgt_stores"), SyncSpec(["store", "o_orderkey"], scope="o_orderkey"))
    sinks.write_snapshot(done, path, ("store",))
    return sinks.read_snapshot(spark, path).select("store", "store_name", "o_orderkey", "o_orderstatus", "o_totalprice")


def _documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    lines = lineitem.groupBy(F.col("l_orderkey").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    docs = orders.select(F.col("o_orderkey").alias("_id"), "o_orderstatus", F.struct("o_custkey", "o_orderpriority").alias("meta"), F.to_date("o_orderdate").alias("ordered"))
    return docs.join(lines, "_id", "left")


@registered("""
    SELECT o_orderkey AS id, o_orderstatus, '{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS meta,
           CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ordered, l.lines
    FROM {orders} o LEFT JOIN (SELECT l_orderkey, '[' || string_agg('{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey) || ']' AS lines
                              FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey""")
def document_rows(spark: SparkSession, d: str) -> DataFrame:
    return documents.document_rows(_documents(fx(spark, d, "orders"), fx(spark, d, "lineitem")))


@registered(f"SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS _id, CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'outside' WHEN s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'update' ELSE 'unchanged' END AS action FROM {_FULL}")
def document_upsert(spark: SparkSession, d: str) -> DataFrame:
    shape = lambda df: df.select(F.col("o_orderkey").alias("_id"), "o_orderstatus", F.struct("o_custkey", "o_orderpriority").alias("meta"))
    found = apply.document_changes(shape(fx(spark, d, "src_orders")), shape(fx(spark, d, "tgt_orders")))
    return found.select(F.coalesce("s._id", "t._id").alias("_id"), "action")


@registered("SELECT l_orderkey, l_linenumber, COUNT(*) AS \"rows\" FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def key_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return keys.key_duplicates(fx(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day, strftime(o_orderdate + INTERVAL 30 DAY, '%Y%m%d') AS later, 7 AS days, TRUE AS valid FROM {orders}""")
def date_keys(spark: SparkSession, d: str) -> DataFrame:
    day = calendar.date_key(F.col("o_orderdate"))
    week = calendar.key_range(F.col("day"), calendar.shifted_key(F.col("day"), 6))
    return fx(spark, d, "orders").select("o_orderkey", day.alias("day")).select("o_orderkey", "day", calendar.shifted_key(F.col("day"), 30).alias("later"), F.size(week).alias("days"), calendar.is_date_key(F.col("day")).alias("valid"))


@registered("SELECT event_id, substring(regexp_replace(event_type || '/' || props, '[^a-zA-Z0-9_]', '_', 'g'), 1, 50) AS name FROM {events}")
def safe_names(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d, "events").select("event_id", calendar.safe_name(F.concat_ws("/", "event_type", "props")).alias("name"))


_JALALI = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, date_diff('day', DATE '2024-03-20', CAST(o_orderdate AS DATE)) + 154863 AS n FROM {orders}"""
_JALALI_SQL = f"""
    WITH a AS ({_JALALI}), b AS (SELECT *, n % 12053 AS c FROM a), e AS (SELECT *, c % 1461 AS r FROM b),
         f AS (SELECT *, 979 + 33 * (n // 12053) + 4 * (c // 1461) + CASE WHEN r > 365 THEN (r - 1) // 365 ELSE 0 END AS y, CASE WHEN r > 365 THEN (r - 1) % 365 ELSE r END AS g FROM e),
         j AS (SELECT *, CASE WHEN g < 186 THEN g // 31 + 1 ELSE (g - 186) // 30 + 7 END AS m, CASE WHEN g < 186 THEN g % 31 + 1 ELSE (g - 186) % 30 + 1 END AS d FROM f)"""


@registered(_JALALI_SQL + " SELECT o_orderkey, CAST(y AS INT) AS \"year\", CAST(m AS INT) AS \"month\", CAST(d AS INT) AS \"day\" FROM j")
def jalali_dates(spark: SparkSession, d: str) -> DataFrame:
    j = calendar.jalali(F.to_date("o_orderdate"))
    return fx(spark, d, "orders").select("o_orderkey", j.alias("j")).select("o_orderkey", "j.year", "j.month", "j.day")


@registered(_JALALI_SQL + " SELECT o_orderkey, strftime(day, '%Y%m') AS gregorian, CAST(y AS VARCHAR) || lpad(CAST(m AS VARCHAR), 2, '0') AS persian_month, CAST(y AS VARCHAR) || '/' || lpad(CAST(m AS VARCHAR), 2, '0') || '/' || lpad(CAST(d AS VARCHAR), 2, '0') AS persian_day FROM j")
def partition_values(spark: SparkSession, d: str) -> DataFrame:
    c = calendar.date_key(F.col("o_orderdate"))
    return fx(spark, d, "orders").select("o_orderkey", calendar.partition_value(c, "YYYYMM").alias("gregorian"), calendar.partition_value(c, "jalali_yyyymm").alias("persian_month"), calendar.partition_value(c, "SHAMSI_YYYY/MM/DD").alias("persian_day"))
