from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from syncloom.plans.spec import TopicSpec
from syncloom.sources import sinks, topics
from syncloom.streaming import topics as streaming

SPEC = TopicSpec(["k"], "k int, v string, n int", guard="n")


def put(spark, path, rows):
    data = [("t", 0, o, None, None, f'{{"k": {k}, "v": "{v}", "n": {n}}}') for o, k, v, n in rows]
    spark.createDataFrame(data, topics.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_restart_and_stale_messages(spark, tmp_path):
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    sinks.write_snapshot(spark.createDataFrame([(9, "z", 0)], "k int, v string, n int"), target)
    put(spark, files, [(0, 1, "a", 1), (1, 2, "b", 1), (2, 1, "c", 2)])
    run = lambda: streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, SPEC)
    assert run() == 1
    assert sorted(map(tuple, sinks.read_snapshot(spark, target).collect())) == [(1, "c", 2), (2, "b", 1), (9, "z", 0)]
    assert run() == 0
    put(spark, files, [(3, 1, "old", 1), (4, 2, "new", 5)])
    assert run() == 1
    assert sorted(map(tuple, sinks.read_snapshot(spark, target).collect())) == [(1, "c", 2), (2, "new", 5), (9, "z", 0)]


def test_batches_are_read_with_their_base(spark, tmp_path, monkeypatch):
    """A batch writes only its own rows; merging by number of batches, at the end of a run or not at all gives the same table."""
    want = [(1, "c", 2), (2, "b", 1), (9, "z", 5)]
    for n, merge_after in ((99, False), (99, True), (1, False)):
        monkeypatch.setattr(streaming, "COMPACT_BATCHES", n)
        files, target, commits = (str(tmp_path / f"{x}{n}{merge_after}") for x in ("m", "t", "c"))
        sinks.write_snapshot(spark.createDataFrame([(9, "z", 5)], "k int, v string, n int"), target)
        for row in ((0, 1, "c", 2), (1, 2, "b", 1), (2, 1, "a", 1), (3, 9, "stale", 4)):
            put(spark, files, [row])
        assert streaming.stream_upsert(topics.from_files(spark, files, stream=True, max_files=1), target, commits, SPEC, merge_after=merge_after) == 4
        assert sorted(map(tuple, streaming.read_table(spark, target, SPEC).collect())) == want
        base = sorted(map(tuple, sinks.read_snapshot(spark, target).collect()))
        assert base == ([(9, "z", 5)] if (n, merge_after) == (99, False) else want)


def test_run_stops_at_its_cap(spark, tmp_path):
    """Exactly three messages a run, though one file holds fifty; the next run goes on behind them, and nothing is passed over."""
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    sinks.write_snapshot(spark.createDataFrame([], "k int, v string, n int"), target)
    put(spark, files, [(7 * i, i, "a", 1) for i in range(50)])
    spec = TopicSpec(["k"], "k int, v string, n int", max_messages=3)
    run = lambda s=spec: streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, s)
    for n in range(1, 6):
        assert run() == 1
        assert sorted(r.k for r in sinks.read_snapshot(spark, target).collect()) == list(range(3 * n))
    put(spark, files, [(400 + i, 100 + i, "b", 1) for i in range(4)])
    rest = TopicSpec(["k"], "k int, v string, n int", max_messages=36)
    assert run(rest) == 2  # the other 35 of the first batch and one of the second
    assert sinks.read_snapshot(spark, target).count() == 51
    assert run(rest) == 1 and sinks.read_snapshot(spark, target).count() == 54
    assert run(rest) == 0


def test_capped_runs_quarantine_each_message_once(spark, tmp_path):
    files, target, commits, bad = (str(tmp_path / x) for x in ("m", "t", "c", "q"))
    sinks.write_snapshot(spark.createDataFrame([], "k int, v string, n int"), target)
    data = [("t", 0, i, None, None, f'{{"k": {i}, "v": "a", "n": 1}}' if i % 3 else "junk") for i in range(10)]
    spark.createDataFrame(data, topics.MESSAGE_SCHEMA).coalesce(1).write.parquet(files)
    spec = TopicSpec(["k"], "k int, v string, n int", mode="quarantine", max_messages=4)
    while streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, spec, bad):
        pass
    assert sorted(r.msg_offset for r in spark.read.parquet(bad).collect()) == [0, 3, 6, 9]
    assert sorted(r.k for r in sinks.read_snapshot(spark, target).collect()) == [1, 2, 4, 5, 7, 8]


def test_capped_partitions_are_read_once_each(spark, tmp_path):
    """Partitions that end earlier stay read while the others go on."""
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    sinks.write_snapshot(spark.createDataFrame([], "k int, v string, n int"), target)
    sizes = {0: 1, 1: 9, 2: 4}
    data = [("t", p, 10 * i, None, None, f'{{"k": {100 * p + i}, "v": "{p}", "n": 1}}') for p, n in sizes.items() for i in range(n)]
    spark.createDataFrame(data, topics.MESSAGE_SCHEMA).coalesce(1).write.parquet(files)
    spec, counts = TopicSpec(["k"], "k int, v string, n int", max_messages=5), []
    while streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, spec):
        counts.append(sinks.read_snapshot(spark, target).count())
    assert counts == [5, 10, 14]


def test_a_failure_is_not_taken_for_the_cap(spark, tmp_path, monkeypatch):
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    sinks.write_snapshot(spark.createDataFrame([], "k int, v string, n int"), target)
    put(spark, files, [(i, i, "a", 1) for i in range(9)])

    def broken(*_, **__):
        raise RuntimeError("the disk is full")

    monkeypatch.setattr(streaming, "write_snapshot", broken)
    with pytest.raises(Exception, match="the disk is full"):
        streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, TopicSpec(["k"], "k int, v string, n int", max_messages=3))


@pytest.mark.parametrize("files_a_batch", [1, 9])
def test_guard_counts_within_a_batch(spark, tmp_path, files_a_batch):
    """The greatest guard wins, in one batch and in two; of equal guards, the later message; a NULL guard is the oldest."""
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    sinks.write_snapshot(spark.createDataFrame([(1, "old", 3), (4, "old", None)], "k int, v string, n int"), target)
    put(spark, files, [(0, 1, "ten", 10), (1, 2, "x", 1), (2, 3, "x", 7), (3, 4, "x", "null")])
    put(spark, files, [(4, 1, "five", 5), (5, 2, "y", 1), (6, 3, "y", "null"), (7, 4, "y", 0)])
    streaming.stream_upsert(topics.from_files(spark, files, stream=True, max_files=files_a_batch), target, commits, SPEC)
    assert sorted(map(tuple, sinks.read_snapshot(spark, target).collect())) == [(1, "ten", 10), (2, "y", 1), (3, "x", 7), (4, "y", 0)]


def test_guard_column_is_kept(spark, tmp_path):
    """version_id is left out by default; as the guard it stays in the table."""
    spec = TopicSpec(["k"], "k int, v string, version_id bigint", guard="version_id", include=["k", "v"])
    files, target, commits = (str(tmp_path / x) for x in ("m", "t", "c"))
    sinks.write_snapshot(spark.createDataFrame([(1, "old", 5)], "k int, v string, version_id bigint"), target)
    data = [("t", 0, i, None, None, f'{{"k": {k}, "v": "new", "version_id": {n}}}') for i, (k, n) in enumerate([(1, 4), (2, 9)])]
    spark.createDataFrame(data, topics.MESSAGE_SCHEMA).write.parquet(files)
    streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, spec)
    assert sorted(map(tuple, sinks.read_snapshot(spark, target).collect())) == [(1, "old", 5), (2, "new", 9)]
    with pytest.raises(ValueError, match="guard"):
        streaming.merged(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 2)], "k int, version_id bigint"), spec)


def messages_at(spark, offsets):
    return spark.createDataFrame([("t", p, o) for p, own in offsets.items() for o in own], "topic string, partition_id int, msg_offset bigint")


def test_caps_lose_no_message_in_gaps(spark):
    m = messages_at(spark, {0: [0, 1000, 2000, 3000], 1: [5, 6, 7], 2: [9 * 10**9, 9 * 10**12, 9 * 10**15], 3: [4]})
    offsets = lambda df: sorted((r.partition_id, r.msg_offset) for r in df.collect())
    assert offsets(topics.window_of(m, cap=3)) == [(0, 0), (0, 1000), (0, 2000), (1, 5), (1, 6), (1, 7), (2, 9 * 10**9), (2, 9 * 10**12), (2, 9 * 10**15), (3, 4)]
    assert offsets(topics.capped(m, 8)) == [(0, 0), (0, 1000), (0, 2000), (1, 5), (1, 6), (2, 9 * 10**9), (2, 9 * 10**12), (3, 4)]
    assert offsets(topics.capped(m, 2)) == [(0, 0), (1, 5)]
    assert topics.capped(m, 99).count() == 11 and topics.capped(m.limit(0), 5).count() == 0
    bounds = topics.run_bounds(m, 8)
    assert [(b.start, b.take) for b in bounds] == [(0, 3), (5, 2), (9 * 10**9, 2), (4, 1)]
    assert topics.broker_offsets(bounds[1:2]) == '{"t": {"1": 7}}' and topics.broker_offsets(bounds[1:2], end=False) == '{"t": {"1": 5}}'


@given(st.lists(st.integers(0, 40), max_size=9), st.integers(0, 120))
def test_water_filling(counts, most):
    takes = topics.water_filled(counts, most)
    assert sum(takes) == min(most, sum(counts)) and all(t <= n for t, n in zip(takes, counts, strict=True))
    short = [t for t, n in zip(takes, counts, strict=True) if t < n]
    assert not short or max(takes) <= min(short) + 1 and short == sorted(short, reverse=True)


@given(st.dictionaries(st.integers(0, 3), st.sets(st.one_of(st.integers(0, 60), st.integers(0, 2**50)), min_size=1, max_size=12), min_size=1), st.integers(1, 20))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_bounds_equal_ranks(spark, offsets, each):
    m = messages_at(spark, {p: sorted(own) for p, own in offsets.items()})
    found = {(r.partition_id, r.msg_offset) for r in topics.window_of(m, cap=each).collect()}
    assert found == {(p, o) for p, own in offsets.items() for o in sorted(own)[:each]}


def test_wrong_types_dont_overwrite(spark, tmp_path):
    """A value of another type ends the run, or goes to the quarantine; it never becomes NULL."""
    files, target, commits, bad = (str(tmp_path / x) for x in ("m", "t", "c", "q"))
    sinks.write_snapshot(spark.createDataFrame([(1, "good", 1)], "k int, v string, n int"), target)
    data = [("t", 0, 0, None, None, '{"k": 1, "v": "x", "n": "many"}'), ("t", 0, 1, None, None, '{"k": "one", "v": "x", "n": 2}')]
    spark.createDataFrame(data, topics.MESSAGE_SCHEMA).write.parquet(files)
    with pytest.raises(Exception, match="wrong type"):
        streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits, SPEC)
    spec = TopicSpec(["k"], "k int, v string, n int", mode="quarantine")
    streaming.stream_upsert(topics.from_files(spark, files, stream=True), target, commits + "2", spec, bad)
    assert [tuple(r) for r in sinks.read_snapshot(spark, target).collect()] == [(1, "good", 1)]
    assert [r.error for r in spark.read.parquet(bad).collect()] == ["wrong type"] * 2


def test_crash_before_the_pointer_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(4):
        sinks.write_snapshot(spark.range(n + 1), path)
    assert sinks.read_snapshot(spark, path).count() == 4
    assert len(list((tmp_path / "t").glob("v=*"))) == 2  # older versions are gone

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "_point", crash)
        with pytest.raises(RuntimeError):
            sinks.write_snapshot(spark.range(99), path)
    assert sinks.read_snapshot(spark, path).count() == 4
    (tmp_path / "t" / "_pointers" / "000000000009").mkdir()  # a pointer that was begun and not finished
    assert sinks.read_snapshot(spark, path).count() == 4
    sinks.write_snapshot(spark.range(7), path)
    assert sinks.read_snapshot(spark, path).count() == 7


def test_snapshot_delete(spark):
    rows = [("t", 0, 0, None, None, '{"k": 1, "v": "a", "n": 1}'), ("t", 0, 1, None, None, '{"k": 5, "v": "e", "n": 1}')]
    m = spark.createDataFrame(rows, topics.MESSAGE_SCHEMA)
    target = spark.createDataFrame([(3, "gone", 0), (7, "kept", 0)], "k int, v string, n int")
    snapshot, counts = streaming.topic_snapshot_sync(m, target, SPEC, "k")
    assert sorted(r.k for r in snapshot.collect()) == [1, 5, 7]
    assert (counts.first().insert, counts.first().delete) == (2, 1)
