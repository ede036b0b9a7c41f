"""Sources: tables, queries, collections, keyed look-ups, JDBC. Filters and columns reach the scan."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import counted_bucket_plan
from ..operators.keys import bad_names
from .scratch import checkpoint


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def business_date(df: DataFrame, column: str, date_key: str) -> Column:
    """Equality with a business date YYYYMMDD or YYYY-MM-DD, in the column's own type, so that the filter reaches the scan.

    Numbers hold YYYYMMDD; text holds the key as given; dates and timestamps hold that day.
    """
    kind = dict(df.dtypes)[column]
    day = f"{date_key[:4]}-{date_key[4:6]}-{date_key[6:8]}" if len(date_key) == 8 else date_key
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        return F.col(column) == F.lit(int(day.replace("-", "")))
    if kind.startswith("timestamp"):
        low = F.lit(day).cast(kind)
        return (F.col(column) >= low) & (F.col(column) < (F.lit(day).cast("date") + F.expr("interval 1 day")).cast(kind))
    return F.col(column) == (F.lit(day).cast("date") if kind == "date" else F.lit(date_key))


def scan(df: DataFrame, columns: Sequence[str] | None = None, date_column: str | None = None, date_key: str | None = None, where: Column | None = None) -> DataFrame:
    """A table scan: optional columns, business date and predicate. The whole set; pages are Spark's own matter."""
    if date_column and date_key:
        df = df.filter(business_date(df, date_column, date_key))
    if where is not None:
        df = df.filter(where)
    if columns and (bad := bad_names(columns)):
        raise ValueError(f"not identifiers: {bad}")
    return df.select(*columns) if columns else df


def with_date(text: str, ds: str) -> str:
    """text with its date tokens replaced by a business date YYYY-MM-DD and its form without dashes."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", ds):
        raise ValueError(f"not a date: {ds!r}")
    return re.sub(r"\{\{ ?(ds|ds_nodash) ?\}\}", lambda m: ds if m[1] == "ds" else ds.replace("-", ""), text)


def query(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None, ds: str | None = None, **views: DataFrame) -> DataFrame:
    """A query with named parameters (:name) over DataFrames named as {view}. :ds and :ds_nodash are the business date's two forms.

    The tokens {{ ds }} and {{ ds_nodash }} (spaced or not) in the text or in text parameters are replaced by them.
    """
    args = dict(args or {})
    if ds:
        args |= {"ds": ds, "ds_nodash": ds.replace("-", "")}
        text = with_date(text, ds)
        args = {k: with_date(v, ds) if isinstance(v, str) else v for k, v in args.items()}
    used = {k: v for k, v in args.items() if f":{k}" in text}
    return spark.sql(text, args=used, **views)


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def key_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_key"), F.max(column).alias("max_key"))


def find(df: DataFrame, where: Column | None = None, columns: Sequence[str] | None = None, sort: Sequence[tuple[str, int]] = (), range_column: str | None = None, low: Any = None, high: Any = None) -> DataFrame:
    """A collection's documents: filter, optional key range, sort (1 up, -1 down), projection."""
    if where is not None:
        df = df.filter(where)
    if range_column:
        df = df.filter(F.col(range_column).between(low, high))
    if sort:
        df = df.orderBy(*[F.col(c).asc() if way > 0 else F.col(c).desc() for c, way in sort])
    return df.select(*columns) if columns else df


def aggregate(df: DataFrame, where: Column | None, stages: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A collection's aggregation: the filter first, then the caller's transformation."""
    return (df if where is None else df.filter(where)).transform(stages)


def lookup(df: DataFrame, where: Column, order: Sequence[str]) -> DataFrame:
    """First matching row, by a stated order."""
    return df.filter(where).orderBy(*order).limit(1)


def first_page(df: DataFrame, order: Sequence[str | Column], rows: int) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def jdbc(spark: SparkSession, url: str, table: str | None = None, sql: str | None = None, partition_column: str | None = None, bounds: tuple[Any, Any] | None = None, partitions: int = 8, fetch_rows: int = 10_000, **options: str) -> DataFrame:
    """A JDBC table (read in key ranges by several tasks) or query."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_rows).options(**options)
    if sql:
        return reader.option("query", sql).load()
    reader = reader.option("dbtable", table)
    if partition_column and bounds:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def sql_literal(value: Any) -> str:
    """A value of a key as plain SQL: numbers, text, dates, timestamps, truth values."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int | float | decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"no SQL literal for {type(value).__name__}")


def plan_predicates(plan: DataFrame, key: str, nulls: bool = True) -> list[str]:
    """A condition for each chunk of a `bucket_plan` over keys without NULL, and one for NULL keys. They exclude each other and miss no row. A row a chunk is on the driver."""
    if bad := bad_names([key]):
        raise ValueError(f"not identifiers: {bad}")
    rows = plan.orderBy("chunk_no").collect()
    found = [f"{key} >= {sql_literal(r['min_key'])} AND {key} <= {sql_literal(r['max_key'])}" for r in rows]
    return [*found, *([f"{key} IS NULL"] if nulls else [])]


def jdbc_by_plan(spark: SparkSession, url: str, table: str, key: str, chunks: int = 8, fetch_rows: int = 10_000, **options: str) -> DataFrame:
    """A JDBC table read in chunks of about equal row counts, whatever the keys' distribution: one task a chunk, and one for NULL keys if there are any.

    The store counts its keys (GROUP BY); the plan comes from the counts. Ranges of equal width, as `jdbc` has them, would give a hot range to one task. A
    key isn't split, so one that holds more rows than a chunk is a chunk of its own.
    """
    if bad := bad_names([key, table]):
        raise ValueError(f"not identifiers: {bad}")
    counted = jdbc(spark, url, sql=f"SELECT {key} AS K, COUNT(*) AS N FROM {table} GROUP BY {key}", fetch_rows=fetch_rows, **options).toDF("_key", "_rows")
    counted = checkpoint(counted.select("_key", F.col("_rows").cast("bigint").alias("_rows")))
    nulls = not counted.filter("_key is null").isEmpty()
    predicates = plan_predicates(counted_bucket_plan(counted.filter("_key is not null"), chunks), key, nulls) or ["1 = 0"]
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(fetch_rows), **options})
