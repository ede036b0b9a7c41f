from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from syncloom.operators import chunks


@pytest.mark.parametrize("tiles", [1, 3, 37])
@pytest.mark.parametrize("column,kind", [("k", "bigint"), ("s", "string")])
def test_equals_ntile(spark, tiles, column, kind):
    df = spark.range(1000).select("id", F.when(F.col("id") % 11 > 0, F.col("id") * 7919 % 53).alias("k"))
    df = df.withColumn("s", F.col("k").cast("string"))
    expected = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(F.col(column).asc_nulls_first(), "id")))
    found = chunks.chunk_assign(df, column, tiles, ("id",))
    assert found.count() == 1000
    assert found.join(expected.select("id", "t"), "id").filter("chunk_no <> t").count() == 0


@pytest.mark.parametrize("tiles", [1, 8])
def test_no_single_partition(spark, tiles):
    """Several tasks sort, whatever the number of tiles, at a size as it is."""
    df = spark.range(100_000).select((F.col("id") * 7919 % 30_011).alias("k"), "id")
    plan = chunks.chunk_plan(df, "k", tiles)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assigned = chunks.chunk_assign(df, "k", tiles, ("id",))
    assert assigned.select(F.spark_partition_id().alias("p")).groupBy("p").count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("tiles", [1, 7, 40])
def test_hot_and_null_keys(spark, tiles):
    """A third of the rows have one key and a third none: plans equal ntile, and the rows of a hot key are spread over tasks."""
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id")
    expected = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(F.col("k").asc_nulls_first()))).groupBy("t").agg(F.min("k"), F.max("k"), F.count("*"))
    assert sorted(map(tuple, chunks.chunk_plan(df, "k", tiles).collect())) == sorted(map(tuple, expected.collect()))
    assigned = chunks.chunk_assign(df, "k", tiles)
    sizes = [r["count"] for r in assigned.groupBy("chunk_no").count().collect()]
    assert sum(sizes) == 900 and max(sizes) - min(sizes) <= 1 and assigned.select("id").distinct().count() == 900
    assert assigned.filter("k = 5").select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_empty_and_one_row(spark):
    assert chunks.chunk_plan(spark.range(0).toDF("k"), "k", 8).count() == 0
    assert chunks.bucket_plan(spark.range(0).toDF("k"), "k", 8).count() == 0
    assert [tuple(r) for r in chunks.chunk_plan(spark.range(1).toDF("k"), "k", 8).collect()] == [(1, 0, 0, 1)]


def test_equal_keys_stay_together(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"))
    plan = chunks.bucket_plan(df, "k", 10).collect()
    assert sum(r.row_count for r in plan) == 100
    assert len(plan) == 3
    assert chunks.tile_count(0, 10) == 1 and chunks.tile_count(11, 10) == 2


def test_any_column_names_and_maps(spark):
    """Columns of the operators' own names, of maps, or a key named like them."""
    df = spark.range(60).select(F.col("id").alias("_rows"), (F.col("id") % 7).alias("_part"), F.lit("x").alias("chunk_no"), F.lit(1).alias("_key"), F.create_map(F.lit("a"), "id").alias("m"), F.lit(2).alias("_spread"))
    assert [r.row_count for r in chunks.chunk_plan(df, "_rows", 4).orderBy("chunk_no").collect()] == [15] * 4
    assert sum(r.row_count for r in chunks.bucket_plan(df, "_part", 3).collect()) == 60
    got = chunks.chunk_assign(df, "_rows", 4, ("_part",))
    assert sorted(got.columns) == sorted(df.columns) and sorted(r["count"] for r in got.groupBy("chunk_no").count().collect()) == [15] * 4
    assert got.filter("chunk_no = 1").agg(F.max("_rows")).first()[0] == 14 and got.filter("m['a'] = _rows").count() == 60
    assert chunks.chunk_scope_bounds(df, "_rows", "_part", 4).count() == 4
    assert chunks.chunk_assign(df.limit(0), "_rows", 4).count() == 0
