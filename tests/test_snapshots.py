"""Snapshots: observed counts, digests, buckets, compaction, and two sinks that can be retried."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from syncloom.operators import apply, digests, snapshots, verify
from syncloom.plans.registry import queries
from syncloom.plans.spec import SyncSpec, TopicSpec
from syncloom.sources import sinks, topics
from syncloom.streaming import topics as streaming

SCHEMA = "k int, s int, v string, m map<string,int>"


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, seed, n=80):
    rng = random.Random(seed)
    ks = rng.sample(range(120), n)
    return spark.createDataFrame([(k, k * 3 % 50, rng.choice([None, "a", "b"]), rng.choice([None, {"x": 1}, {"x": 2, "y": None}])) for k in ks], SCHEMA)


def flat(df):
    return df.drop("m")


def test_counts_are_observed_in_the_writing_job(spark, tmp_path):
    jobs = spark.sparkContext._jsc.sc().statusTracker()
    df = spark.range(1000).repartition(3)
    told = verify.observed_write(df, lambda d: d.write.parquet(str(tmp_path / "a")), biggest=F.max("id"))
    assert told == {"records": 1000, "biggest": 999}
    assert verify.observed_write(df.limit(0), lambda d: d.write.parquet(str(tmp_path / "b")))["records"] == 0
    assert verify.run_row(spark, 1000, 300, 2000).first().progress_percent == 50.0 and jobs is not None
    s, t = flat(table(spark, 1)), flat(table(spark, 2))
    spec = SyncSpec(["k"], scope="s")
    told = apply.written_sync(s, t, spec, lambda d: sinks.write_snapshot(d, str(tmp_path / "c")))
    want, counts = apply.full_sync(s, t, spec)
    assert told == counts.first().asDict() and rows(sinks.read_snapshot(spark, str(tmp_path / "c"))) == rows(want)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("scope", [None, "s"])
def test_digests_give_the_plain_result(spark, tmp_path, seed, scope):
    """Whatever differs, the counts and the table are those of the full join."""
    t = flat(table(spark, seed))
    s = [t, flat(table(spark, seed + 9)), t.limit(0), t.withColumn("v", F.when(F.col("k") % 40 == 1, "changed").otherwise(F.col("v"))).filter("k % 37 <> 3")][seed]
    spec = SyncSpec(["k"], scope=scope)
    want, counts = apply.full_sync(s, t, spec)
    assert digests.digest_changes(s, t, spec, 16)[1].first() == counts.first()
    path = str(tmp_path / "t")
    sinks.write_digested(t, path, ["k"], 16)
    assert snapshots.sync_digested(s, path, spec, 16) == counts.first().asDict()
    assert rows(sinks.read_digested(spark, path).select("k", "s", "v")) == rows(want)
    again = snapshots.sync_digested(s, path, spec, 16)
    assert again["insert"] == again["update"] == again["delete"] == 0


def test_only_unlike_buckets_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "t")
    t = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    sinks.write_digested(t, path, ["k"], 64)
    before = {f: p for p in sinks._current(spark, path) for f in p["folders"]}
    told = snapshots.sync_digested(t.withColumn("v", F.when(F.col("k") < 3, -1).otherwise(F.col("v"))), path, SyncSpec(["k"]), 64)
    assert (told["update"], told["unchanged"]) == (3, 4997)
    parts = sinks._current(spark, path)
    assert len(parts) == 2 and len(parts[1]["folders"]) <= 3 and len(parts[0]["folders"]) + len(parts[1]["folders"]) == len(before)
    assert sinks.read_digests(spark, path).agg(F.sum("rows")).first()[0] == 5000
    some = sinks.read_digested(spark, path, [5, 6])
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"_bucket=5", "_bucket=6"}


def test_digests_see_moved_nulls_and_maps(spark):
    digest = lambda data: digests.bucket_digests(spark.createDataFrame(data, "k int, a string, b string, m map<string,int>"), ["k"], ["a", "b", "m"], 4)
    base = [(1, None, "x", {"p": 1, "q": 2}), (2, "y", "y", None)]
    assert digests.unlike_buckets(digest(base), digest(list(reversed(base)))).count() == 0
    assert digests.unlike_buckets(digest(base), digest([(1, None, "x", {"q": 2, "p": 1}), base[1]])).count() == 0
    for other in ([(1, "x", None, {"p": 1, "q": 2}), base[1]], [base[0]], [*base, base[1]], [(1, None, "x", {"p": 1}), base[1]]):
        assert digests.unlike_buckets(digest(base), digest(other)).count() == 1
    deep = lambda x: digests.bucket_digests(spark.createDataFrame([(1, ({"p": x},))], "k int, s struct<m:map<string,int>>"), ["k"], ["s"], 4)
    assert digests.unlike_buckets(deep(1), deep(1)).count() == 0 and digests.unlike_buckets(deep(1), deep(2)).count() == 1
    with pytest.raises(ValueError):
        digests.digest_changes(table(spark, 1), table(spark, 1), SyncSpec(["k"], unique_keys=[["v"]]), 4)


def test_a_bucketed_snapshot_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    t = spark.range(3000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    sinks.write_snapshot(t, path, bucket_by=(["k"], 6))
    base = sinks.read_snapshot(spark, path)
    fresh = spark.range(2990, 3010).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    with_setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = apply.full_sync(fresh, base, SyncSpec(["k"], null_safe=False))[0]
        plan = plan_of(done)
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert plan_of(apply.full_sync(fresh, t, SyncSpec(["k"], null_safe=False))[0]).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_setting)
    assert done.count() == 3010 and done.filter("v = 'new'").count() == 20
    sinks.write_snapshot(done, path, bucket_by=(["k"], 6))
    sinks.write_snapshot(sinks.read_snapshot(spark, path), path, bucket_by=(["k"], 6))
    assert len(list((tmp_path / "t").glob("v=*"))) == 2 and sinks.read_snapshot(spark, path).count() == 3010
    for name in [r.tableName for r in spark.sql("SHOW TABLES LIKE 'snapshot_*'").collect()]:
        spark.sql(f"DROP TABLE {name}")  # as another session has it: the pointer alone tells the buckets
    assert sinks.read_snapshot(spark, path).count() == 3010
    with pytest.raises(Exception, match="key of a bucketed snapshot is NULL"):
        sinks.write_snapshot(t.unionByName(spark.createDataFrame([(None, "x")], "k bigint, v string")), path, bucket_by=(["k"], 6))
    assert sinks.read_snapshot(spark, path).count() == 3010


def test_stream_into_buckets(spark, tmp_path):
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    spec = TopicSpec(["k"], "k int, v string", buckets=4)
    sinks.write_snapshot(spark.createDataFrame([(k, "old") for k in range(9)], "k int, v string"), target, bucket_by=(["k"], 4))
    data = [("t", 0, i, None, None, f'{{"k": {7 + i}, "v": "new"}}') for i in range(4)]
    spark.createDataFrame(data, topics.MESSAGE_SCHEMA).write.parquet(files)
    streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, spec, merge_after=False)
    read = streaming.read_table(spark, target, spec)
    assert "Bucketed: true" in plan_of(read)
    assert rows(read) == sorted([(str(k), "old") for k in range(7)] + [(str(k), "new") for k in range(7, 11)], key=str)
    streaming.compact(spark, target, spec)
    assert rows(sinks.read_snapshot(spark, target)) == rows(read)


def pieces(spark, path, sizes):
    """A table on files with so many parts for each partition, the first row of each repeated."""
    df = spark.createDataFrame([(p, i, f"row {i}") for p, n in sizes.items() for i in range(n) for _ in range(1 + (i == 0))], "p string, i int, v string")
    sinks.replace_folders(df.repartition(16, "p", "i"), path, "p")


def test_due_partitions_are_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    pieces(spark, path, {"a+ b": 60, "c": 3, None: 40})
    before = {r.part_name for r in snapshots.folder_parts(spark, path, "p").collect()}
    told = {r.partition_key: tuple(r)[1:] for r in snapshots.compact_due(spark, path, "p", 8).collect()}
    assert told["p=a+ b"][0] == "compact" and told["p=a+ b"][1] > 8 and told["p=a+ b"][2:] == (1, 61, 60)
    assert told["p=c"][0] == "skip" and told["p=c"][1] == told["p=c"][2] and told["p=c"][3:] == (4, 4)
    assert told["p=__HIVE_DEFAULT_PARTITION__"][0] == "compact" and told["p=__HIVE_DEFAULT_PARTITION__"][3:] == (41, 40)
    after = {r.part_name for r in snapshots.folder_parts(spark, path, "p").collect()}
    assert {n for n in before if "/p=c/" in n} <= after and len(after) < len(before)
    found = sinks.read_snapshot(spark, path)
    assert found.count() == 60 + 4 + 40 and found.filter("p is null").count() == 40 and found.filter("p = 'a+ b'").count() == 60
    assert {r.decision for r in snapshots.compact_due(spark, path, "p", 8).collect()} == {"skip"}


def test_compaction_keeps_the_latest_by_key_and_the_planned_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4000).select(F.lit(7).alias("p"), (F.col("id") % 1000).alias("k"), F.col("id").alias("version_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    sinks.replace_folders(df.repartition(12), path, "p")
    size = snapshots.folder_parts(spark, path, "p").agg(F.sum("part_bytes")).first()[0]
    told = snapshots.compact_due(spark, path, "p", 2, size // 3 + 1, keys=["k"]).first()
    assert (told.parts_before, told.rows_before, told.rows_after) == (12, 4000, 1000) and told.parts_after in (2, 3)
    assert sinks.read_snapshot(spark, path).agg(F.min("version_id")).first()[0] == 3000


def test_without_a_target_a_due_partition_is_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    pieces(spark, path, {"a": 60, "b": 60, "c": 1})
    told = {r.partition_key: tuple(r)[1:] for r in snapshots.compact_due(spark, path, "p", 2, target_bytes=None).collect()}
    assert {k: (r[0], *r[2:]) for k, r in told.items()} == {"p=a": ("compact", 1, 61, 60), "p=b": ("compact", 1, 61, 60), "p=c": ("skip", 1, 2, 2)}
    assert sorted(r.i for r in sinks.read_snapshot(spark, path).filter("p = 'a'").collect()) == list(range(60))


@pytest.mark.parametrize("megabytes", [29, 200])
def test_the_report_tells_one_part_whatever_the_size(spark, sf, monkeypatch, megabytes):
    """Files that are said to be as large as those of 60 times sf0.1, and so large that each passes the usual target alone."""
    small = snapshots.folder_parts
    monkeypatch.setattr(snapshots, "folder_parts", lambda *a: small(*a).withColumn("part_bytes", F.lit(megabytes << 20).cast("bigint")))
    told = {r.partition_key: (r.decision, r.parts_before, r.parts_after) for r in queries()["compaction_report"](spark, sf).collect()}
    assert told == {"l_returnflag=R": ("compact", 8, 1), "l_returnflag=A": ("skip", 1, 1), "l_returnflag=N": ("skip", 1, 1)}


def test_a_compaction_that_loses_rows_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    pieces(spark, path, {"a": 60})
    before = rows(sinks.read_snapshot(spark, path))
    monkeypatch.setattr(snapshots, "_all_there", lambda *_: (_ for _ in ()).throw(RuntimeError("rows are missing")))
    with pytest.raises(RuntimeError):
        snapshots.compact_due(spark, path, "p", 2)
    assert rows(sinks.read_snapshot(spark, path)) == before


def test_bins_cover_all_parts(spark):
    parts = spark.createDataFrame([("a", f"f{i}", 10 + i) for i in range(20)] + [("b", "one", 500)], "partition_key string, part_name string, part_bytes int")
    got = snapshots.packed(parts, 100).groupBy("partition_key", "bin").agg(F.sum("part_bytes").alias("size"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 21 and max(r["size"] for r in got if r.partition_key == "a") <= 100 + 29
    plan = {r.partition_key: (r.decision, r.files) for r in snapshots.compaction_plan(parts, 5, 100).collect()}
    assert plan == {"a": ("compact", 4), "b": ("skip", 1)}


def test_two_sinks_survive_a_crash_between_them(spark, tmp_path):
    a, b, ledger = (str(tmp_path / x) for x in ("a", "b", "ledger"))
    df, broken = spark.range(5), [True]

    def second(d):
        if broken[0]:
            raise RuntimeError("no connection")
        d.write.mode("append").parquet(b)

    run = lambda name: sinks.write_both(df, lambda d: d.write.mode("append").parquet(a), second, ledger=ledger, run=name)
    with pytest.raises(RuntimeError):
        run("r1")
    broken[0] = False
    assert run("r1") == {"first": "written before", "second": "written"}
    assert run("r1") == {"first": "written before", "second": "written before"}
    assert spark.read.parquet(a).count() == spark.read.parquet(b).count() == 5
    assert run("r2") == {"first": "written", "second": "written"} and spark.read.parquet(a).count() == 10
    with pytest.raises(ValueError):
        sinks.write_both(df, None, None, ledger=ledger)


def test_two_sinks_in_a_stream(spark, tmp_path):
    """A batch that failed between the sinks is repeated by the stream; each row is there once in both."""
    files, a, b, ledger, commits = (str(tmp_path / x) for x in ("f", "a", "b", "l", "c"))
    spark.range(30).repartition(3).write.parquet(files)
    failing = {1}

    def both(batch, number):
        def second(d):
            if number in failing:
                raise RuntimeError("lost")
            sinks.append_once(d, b, str(number))

        sinks.write_both(batch, lambda d: sinks.append_once(d, a, str(number)), second, ledger=ledger, run=str(number))

    def run():
        source = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(files)
        source.writeStream.foreachBatch(both).option("checkpointLocation", commits).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    failing.clear()
    run()
    for path in (a, b):
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(30))
