"""Nested documents as rows: flattening, the _id rename, content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def renamed_id(df: DataFrame, old: str = "_id", new: str = "id") -> DataFrame:
    """_id becomes id. If both are there, _id wins and the alias goes."""
    if old not in df.columns:
        return df
    return (df.drop(new) if new in df.columns else df).withColumnRenamed(old, new)


def document_rows(df: DataFrame, serialize_nested: bool = True, rename: bool = True) -> DataFrame:
    """Flat rows: structs, arrays and maps as JSON text (or as they are), dates as midnight timestamps."""

    def flat(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType) and serialize_nested:
            return F.to_json(c, {"ignoreNullFields": "false"}).alias(f.name)
        return c.cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.DateType) else c

    rows = df.select(*[flat(f) for f in df.schema.fields])
    return renamed_id(rows) if rename else rows


def content_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the JSON of the columns in order of name; NULL fields count."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def ragged(df: DataFrame, text: str, document: str = "document") -> DataFrame:
    """df with documents of any shape as VARIANT; text that isn't JSON gives NULL (it stays beside it)."""
    return df.withColumn(document, F.try_parse_json(F.col(text)))


def at_path(document: Column | str, path: str, kind: str = "string") -> Column:
    """The value at a JSON path as a type; NULL where the path is absent, null, or of a type that can't become it."""
    return F.try_variant_get(document, path, kind)


def kind_at(document: Column | str, path: str) -> Column:
    """What stands at a path: BIGINT, DECIMAL(...), STRING, BOOLEAN, OBJECT<...>, ARRAY<...>, VOID for null; NULL where it is absent."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def merged_schema(df: DataFrame, document: str = "document", by: Sequence[str] = ()) -> DataFrame:
    """One schema that all documents (of a group) fit, as text: fields of several types become VARIANT. Aggregated with map-side combining."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(document).alias("schema"))


def fields(df: DataFrame, document: str, keep: Sequence[str]) -> DataFrame:
    """A row for each top-level field of every document: `keep`, pos, key, value (VARIANT), in the documents' own order. One row per field, as many as the documents hold."""
    return df.select(*keep, F.col(document).alias("_document")).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_document").outer())).select(*keep, "pos", "key", "value")
