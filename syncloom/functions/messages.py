"""Rows as JSON messages and back: values, keys, headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_timestamp(c: Column) -> Column:
    """ISO text; a fraction is there only if it isn't zero, with six digits."""
    whole, fraction = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(c, "SSSSSS")
    return F.when(fraction != "000000", F.concat_ws(".", whole, fraction)).otherwise(whole)


def json_ready(c: Column, kind: T.DataType) -> Column:
    """A column in the form in which it goes into JSON: decimals as double (lossy), times as ISO text, bytes as UTF-8 text."""
    if isinstance(kind, T.DecimalType):
        return c.cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return iso_timestamp(c)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, T.BinaryType):
        return F.decode(c, "UTF-8")
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: json_ready(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[json_ready(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def message_value(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """JSON object of a row; NULL fields are kept."""
    fields = [json_ready(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields if columns is None or f.name in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def message_key(df: DataFrame, column: str | None = None) -> Column:
    """Text of the key column (the first if none is named); NULL if it is absent or NULL."""
    column = column or df.columns[0]
    return F.col(column).cast("string") if column in df.columns else F.lit(None).cast("string")


def message_headers(source_table: str, execution_date: str, batch_number: int | None = None, timestamp: bool = True) -> Column:
    pairs = [("source_table", F.lit(source_table)), ("execution_date", F.lit(execution_date))]
    if timestamp:
        pairs.append(("timestamp", iso_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))))
    if batch_number is not None:
        pairs.append(("batch_number", F.lit(str(batch_number))))
    return F.array(*[F.struct(F.lit(k).alias("key"), F.encode(v, "UTF-8").alias("value")) for k, v in pairs])


def to_messages(df: DataFrame, topic: str, key: str | None = None, headers: Column | None = None, version: Column | None = None) -> DataFrame:
    """topic, key, value, headers: what a topic sink writes. A version is put over the row's own version_id."""
    if version is not None:
        df = df.withColumn("version_id", version)
    none = F.lit(None).cast("array<struct<key:string,value:binary>>")
    return df.select(F.lit(topic).alias("topic"), message_key(df, key).alias("key"), message_value(df).alias("value"), (none if headers is None else headers).alias("headers"))


def parsed(messages: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """messages with row (struct of `schema`) and error: null payload, bad json, not an object, wrong type (of any field), or null."""
    kinds = T._parse_datatype_string(schema).add("_corrupt", "string")
    text = F.col(value).cast("string")
    fields = [f.name for f in kinds.fields if f.name != "_corrupt"]
    read = messages.withColumn("_row", F.from_json(text, kinds, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}))
    unread = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull()
    error = F.when(text.isNull(), "null payload").when(F.try_parse_json(text).isNull(), "bad json").when(~F.ltrim(text).startswith("{"), "not an object").when(~F.rtrim(text).endswith("}"), "bad json").when(unread, "wrong type")
    return read.withColumn("error", error).withColumn("row", F.when(F.col("error").isNull(), F.struct(*[F.col(f"_row.{f}").alias(f) for f in fields]))).drop("_row")


def message_rows(messages: DataFrame, schema: str, value: str = "value", mode: str = "failfast", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of messages. failfast: a null payload, bad JSON, a value that isn't an object or a field of another type ends the run; quarantine: they are left out (see `quarantined`)."""
    p = parsed(messages, schema, value)
    if mode == "failfast":  # a filter, since a column that isn't asked for would be pruned with its check
        p = p.filter(F.when(F.col("error").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("message can't be read: "), F.col("error"))).cast("boolean")))
    else:
        p = p.filter("error is null")
    return p.select(*keep, "row.*")


def quarantined(messages: DataFrame, schema: str, value: str = "value") -> DataFrame:
    return parsed(messages, schema, value).filter("error is not null").drop("row")


def selected(df: DataFrame, exclude: Sequence[str] = ("version_id",), include: Sequence[str] | None = None) -> DataFrame:
    """Columns of a message's row: those to exclude go first, then the ones to include that exist are kept."""
    left = [c for c in df.columns if c not in exclude]
    return df.select(*[c for c in (left if include is None else include) if c in left])
