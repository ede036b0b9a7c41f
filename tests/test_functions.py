from __future__ import annotations

import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from syncloom.functions import calendar, documents, messages
from syncloom.operators import keys, verify, versions
from syncloom.sources import tables, topics


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize("day,expected", [("20260321", "14050101"), ("2025-03-21", "14040101"), ("20260723", "14050501"), ("20240320", "14030101"), ("20240319", "14021229"), ("20210320", "13991230")])
def test_jalali(spark, day, expected):
    assert one(spark, calendar.jalali_text(calendar.jalali(calendar.to_day(F.lit(day))))) == expected


@pytest.mark.parametrize("style,expected", [("YYYYMM", "202607"), ("persian_yyyymm", "140505"), ("SHAMSI_YYYY/MM/DD", "1405/05/01"), ("Jalali_YYYY", "1405"), ("YYYY", "2026")])
def test_partition_value(spark, style, expected):
    assert one(spark, calendar.partition_value(F.lit("20260723"), style)) == expected


def test_partition_value_edges(spark):
    assert one(spark, calendar.partition_value(F.lit("20260723"), "YYYY", None)) is None
    with pytest.raises(ValueError):
        calendar.partition_value(F.lit("20260723"), "INVALID")


def test_date_keys(spark):
    assert one(spark, calendar.key_range(F.lit("20240228"), F.lit("20240301"))) == ["20240228", "20240229", "20240301"]
    assert one(spark, calendar.key_range(F.lit("20240302"), F.lit("20240301"))) == []
    assert one(spark, calendar.is_date_key(F.lit("20240231"))) is False
    assert one(spark, calendar.shifted_key(F.lit("20240301"), -1)) == "20240229"
    assert one(spark, calendar.version_id(F.lit("2024-01-15T03"))) == 20240115030000


def test_message_round_trip(spark):
    schema = "i int, s string, d decimal(10,2), t timestamp_ntz, day date, b binary, n struct<a:int,b:array<int>>"
    row = (1, "é\"", decimal.Decimal("1.50"), datetime.datetime(2024, 1, 2, 3, 4, 5, 600), datetime.date(2024, 1, 2), b"x", (None, [1, 2]))
    df = spark.createDataFrame([row, (None,) * 7], schema)
    sent = messages.to_messages(df, "t", "i").collect()
    first = json.loads(sent[0].value)
    assert first == {"i": 1, "s": "é\"", "d": 1.5, "t": "2024-01-02T03:04:05.000600", "day": "2024-01-02", "b": "x", "n": {"a": None, "b": [1, 2]}}
    assert sent[0].key == "1" and sent[1].key is None
    assert json.loads(sent[1].value) == dict.fromkeys(["i", "s", "d", "t", "day", "b", "n"])
    back = messages.message_rows(messages.to_messages(df, "t", "i"), "i int, s string, d double, t timestamp_ntz, day date").collect()
    assert tuple(back[0]) == (1, "é\"", 1.5, row[3], row[4])


def test_bad_messages(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("[1]",), ("bad",), (None,), ('"text"',)], "value string")
    assert [r.error for r in messages.quarantined(df, "k int").collect()] == ["not an object", "bad json", "null payload", "not an object"]
    assert messages.message_rows(df, "k int", mode="quarantine").collect()[0].k == 1
    with pytest.raises(Exception, match="message can't be read"):
        messages.message_rows(df, "k int").collect()


def test_headers(spark):
    h = one(spark, messages.message_headers("t", "20240101"))
    assert [x.key for x in h] == ["source_table", "execution_date", "timestamp"]


def test_id_rename(spark):
    df = spark.createDataFrame([(1, 2)], "_id int, id int")
    assert documents.renamed_id(df).collect()[0].asDict() == {"id": 1}


@pytest.mark.parametrize("message,kind", [("Login timeout expired", "transient"), ("TCP Provider: x", "transient"), ("Broken PIPE", "transient"), ("HYT00 something", "transient"), ("Invalid column name 'foo'", "permanent"), ("Deadlock victim 1205", "deadlock"), ("error 1205", "permanent"), (None, None)])
def test_error_classes(spark, message, kind):
    assert one(spark, verify.error_class(F.lit(message).cast("string"))) == kind


def test_reconcile_thresholds(spark):
    for n, m, status in ((1000, 1000, "success"), (10_000, 9_991, "success_with_warning"), (1000, 990, "failed"), (0, 0, "success")):
        assert verify.reconciled(spark.range(n), spark.range(m)).first().status == status


def test_topic_health(spark):
    offsets = spark.createDataFrame([("t", 0, 0, 10, 10), ("t", 1, 0, 0, -1), ("u", 0, 5, 105, -1)], "topic string, partition_id int, low_offset long, high_offset long, committed_offset long")
    found = {r.topic: r for r in verify.topic_health(offsets, 100).collect()}
    assert (found["t"].status, found["t"].uneven, found["t"].imbalance) == ("healthy", True, None)
    assert (found["u"].status, found["u"].total_lag) == ("critical", 100)


def test_identifiers(spark):
    assert keys.bad_names(["a", "dbo.t", "[my table].[x]", "id]; DROP TABLE dbo.Users; --", "a.b.c"]) == ["id]; DROP TABLE dbo.Users; --", "a.b.c"]
    with pytest.raises(ValueError):
        keys.ensure_names(spark.range(1).toDF("bad name;"))


def test_compact_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (2, "c", 1)], "k int, v string, version_id int").withColumn("p", F.col("k") % 2)
    df.repartition(4).write.partitionBy("p").parquet(str(tmp_path / "t"))
    r = versions.compact_files(spark, str(tmp_path / "t"), str(tmp_path / "o"), "p", keys=["k"])
    assert tuple(r.first()) == (4, 2)
    assert sorted(tuple(x) for x in spark.read.parquet(str(tmp_path / "o")).select("k", "v").collect()) == [(1, "b"), (2, "c")]


def test_business_date_kinds(spark):
    df = spark.createDataFrame([(20240102, "2024-01-02", datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 5))], "a int, b string, c date, d timestamp_ntz")
    for column, key in (("a", "20240102"), ("a", "2024-01-02"), ("b", "2024-01-02"), ("c", "20240102"), ("d", "20240102")):
        assert tables.scan(df, date_column=column, date_key=key).count() == 1
        assert tables.scan(df, date_column=column, date_key="20240103").count() == 0


def test_pushdown(spark, sf):
    df = tables.scan(tables.table(spark, sf, "orders"), ["o_orderkey"], "o_orderdate", "19950617")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_totalprice" not in plan


def test_topic_window(spark):
    m = spark.range(20).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition_id"), F.floor(F.col("id") / 2).alias("msg_offset"))
    assert topics.window_of(m, {0: 4}, 3).count() == 6


def test_jdbc_round_trip(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    from syncloom.sources import sinks

    sinks.write_jdbc(spark.range(100).select(F.col("id").cast("int").alias("K"), F.lit("x").alias("V")), url, "T", "overwrite", driver=driver)
    back = tables.jdbc(spark, url, "T", partition_column="K", bounds=(0, 100), partitions=4, driver=driver)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 100
    assert tables.jdbc(spark, url, sql="SELECT COUNT(*) AS N FROM T", driver=driver).first()[0] == 100


def test_wrong_types(spark):
    df = spark.createDataFrame([('{"k": "abc"}',), ('{"k": 1.5}',), ('{"k": null}',), ("{}",), ('{"k": 2, "more": [1]}',), ('{"k": true}',), ('{"k": 3} x',)], "value string")
    assert [r.error for r in messages.quarantined(df, "k int").collect()] == ["wrong type", "wrong type", "wrong type", "bad json"]
    assert [r.k for r in messages.message_rows(df, "k int", mode="quarantine").collect()] == [None, None, 2]
    with pytest.raises(Exception, match="wrong type"):
        messages.message_rows(df.limit(1), "k int").collect()


def test_date_tokens(spark):
    text = "SELECT '{{ ds }}' AS a, '{{ds}}' AS b, '{{ ds_nodash }}' AS c, '{{ds_nodash}}' AS d, :p AS e, id FROM {r}"
    got = tables.query(spark, text, {"p": "on {{ ds }}"}, ds="2024-01-15", r=spark.range(1)).first()
    assert tuple(got) == ("2024-01-15", "2024-01-15", "20240115", "20240115", "on 2024-01-15", 0)
    with pytest.raises(ValueError):
        tables.with_date("x", "2024'; --")


def test_rollup_tells_bounded_alerts(spark):
    checks = spark.range(40).select(F.lit("t").alias("topic"), F.format_string("check %02d", "id").alias("check"), F.when(F.col("id") % 2 == 0, "warning").otherwise("healthy").alias("status"))
    checks = checks.unionByName(spark.createDataFrame([("u", "c", "skipped"), ("v", "c", "odd"), (None, "c", "error")], "topic string, check string, status string"))
    got = {r.topic: r for r in verify.health_rollup(checks).collect()}
    assert got["t"].alerts == "; ".join(f"check {2 * i:02d}: warning" for i in range(verify.MOST_ALERTS)) and got["t"].alert_count == 20
    assert (got["u"].status, got["v"].status, got[None].status, got["u"].alerts) == ("healthy", "unknown", "error", "")


def test_run_cap_and_last_messages_with_gaps(spark):
    m = spark.range(60).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition_id"), (F.col("id") * F.col("id")).alias("msg_offset"), F.lit("v").alias("msg_value"))
    assert topics.capped(m, 7).count() == 7 and topics.capped(m, 100).count() == 60
    last = topics.sampled(m, 4).groupBy("partition_id").agg(F.count("*").alias("n"), F.min("msg_offset").alias("low")).collect()
    assert sorted((r.partition_id, r.n, r.low) for r in last) == [(0, 4, 48**2), (1, 4, 49**2), (2, 4, 50**2)]


def test_conditional_compaction(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, "b", 1), (2, "b", 1)], "p int, v string, version_id int")
    parts = spark.createDataFrame([(1,)] * 3 + [(2,)], "partition_key int")
    got = versions.compacted_if_fragmented(df, F.col("p"), parts, 3)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", 1), (2, "b", 1), (2, "b", 1)]


def test_failfast_cant_be_pruned(spark):
    """A bad message ends the run whichever columns are asked for."""
    m = spark.createDataFrame([(1, '{"k": 1}'), (2, "junk")], "at int, value string")
    rows = messages.message_rows(m, "k int", keep=["at"])
    for ask in (lambda: rows.count(), lambda: rows.select("at").collect(), lambda: rows.limit(9).collect(), lambda: rows.agg({"at": "max"}).collect()):
        with pytest.raises(Exception, match="bad json"):
            ask()
    assert messages.message_rows(m, "k int", mode="quarantine", keep=["at"]).count() == 1


def test_footers_equal_another_reader(spark, sf, tmp_path):
    """Rows and bytes of each file as DuckDB's parquet_metadata has them; no data column is read."""
    import duckdb

    path = str(tmp_path / "a b")
    tables.table(spark, sf, "lineitem").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    found = versions.file_parts(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    want = duckdb.sql(f"""SELECT file_name, SUM(total_uncompressed_size), SUM(total_compressed_size), (SELECT SUM(n) FROM (SELECT DISTINCT row_group_id, row_group_num_rows AS n FROM parquet_metadata('{path}/*.parquet') b WHERE b.file_name = a.file_name))
                          FROM parquet_metadata('{path}/*.parquet') a GROUP BY file_name""").fetchall()
    got = {r.part_name.rsplit("/", 1)[1]: (r.raw_bytes, r.packed_bytes, r.part_rows) for r in found.collect()}
    assert got == {name.rsplit("/", 1)[1]: (int(raw), int(stored), int(n)) for name, raw, stored, n in want} and len(got) == 3
    stats = versions.file_stats(df).first()
    assert stats.total_rows == df.count() and stats.parts == 3 and stats.raw_bytes == sum(v[0] for v in got.values())
    away = spark.createDataFrame([("nowhere://x/y.parquet", 1)], "part_name string, part_bytes long")
    assert versions.with_footers(away).first().raw_bytes is None


def test_health_changes_by_look(spark):
    part = lambda taken, table, n: [(taken, table, i, 10, 5, 0 if n > 60 else 1) for i in range(n)]
    rows = part(1, "a", 400) + part(2, "a", 20) + part(3, "a", 25) + part(1, "b", 3)
    df = spark.createDataFrame(rows, "taken int, table_name string, part int, part_rows long, part_bytes long, part_level int")
    log = None
    for n in (1, 2, 3):
        look = versions.logged_health(df.filter(F.col("taken") == n), F.lit(n))
        log = look if log is None else log.unionByName(look)
    got = [(r.table_name, r.taken, r.parts_before, r.parts_after, r.parts_reduced, r.health_before, r.health_after) for r in versions.health_changes(log).orderBy("table_name", "taken").collect()]
    assert got == [("a", 2, 400, 20, 380, "critical", "healthy"), ("a", 3, 20, 25, -5, "healthy", "healthy")]


def test_jdbc_in_chunks_of_equal_rows(spark, tmp_path):
    """Nine tenths of the rows lie in a hundredth of the key range, some keys are NULL: tasks differ by less than two times, and no row is lost."""
    from syncloom.sources import sinks

    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    key = F.when(F.col("id") < 900, F.col("id") % 300).when(F.col("id") < 990, F.col("id") * 40).cast("int")
    rows = spark.range(1000).select(key.alias("K"), F.col("id").cast("int").alias("N"), F.concat(F.lit("o'"), F.col("id").cast("string")).alias("V"))
    sinks.write_jdbc(rows, url, "T", "overwrite", driver=driver, createTableColumnTypes="V VARCHAR(20)")
    back = tables.jdbc_by_plan(spark, url, "T", "K", 5, driver=driver)
    sizes = sorted(r["count"] for r in back.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert back.rdd.getNumPartitions() == 6 and sizes[0] == 10 and max(sizes[1:]) < 2 * min(sizes[1:])
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    text = tables.jdbc_by_plan(spark, url, "T", "V", 3, driver=driver)
    assert text.rdd.getNumPartitions() == 3 and text.count() == 1000
    sinks.write_jdbc(rows.limit(0), url, "E", "overwrite", driver=driver)
    assert tables.jdbc_by_plan(spark, url, "E", "K", 5, driver=driver).count() == 0
    with pytest.raises(ValueError):
        tables.jdbc_by_plan(spark, url, "T", "K; --", 5, driver=driver)


def test_literals():
    values = [1, -2.5, decimal.Decimal("3.10"), "it's", datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3, 4, 5), True]
    assert [tables.sql_literal(v) for v in values] == ["1", "-2.5", "3.10", "'it''s'", "DATE '2024-01-02'", "TIMESTAMP '2024-01-02 03:04:05'", "TRUE"]
    with pytest.raises(ValueError):
        tables.sql_literal(b"x")


def test_ragged_documents(spark):
    texts = ['{"k": 1, "a": {"b": [1, 2]}}', '{"k": "7", "new": null}', '{"k": 2.5}', '{"k": {"deep": true}}', "broken", None, "[1]"]
    docs = documents.ragged(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text")
    got = docs.orderBy("id").select(documents.at_path("document", "$.k", "double").alias("k"), documents.at_path("document", "$.a.b[1]", "int").alias("b"), documents.kind_at("document", "$.k").alias("kind")).collect()
    assert [r.k for r in got] == [1.0, 7.0, 2.5, None, None, None, None] and [r.b for r in got] == [2] + [None] * 6
    assert [r.kind for r in got] == ["BIGINT", "STRING", "DECIMAL(2,1)", "OBJECT<deep: BOOLEAN>", None, None, None]
    assert documents.merged_schema(docs.filter("id < 3")).first().schema == "OBJECT<a: OBJECT<b: ARRAY<BIGINT>>, k: VARIANT, new: VOID>"
    names = documents.fields(docs.filter("id < 4"), "document", ["id"])
    assert sorted((r.id, r.key) for r in names.collect()) == [(0, "a"), (0, "k"), (1, "k"), (1, "new"), (2, "k"), (3, "k")]
