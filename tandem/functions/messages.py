"""Rows to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


def to_message(df: DataFrame, key: str, zero_when_missing: tuple[str, ...] = ()) -> DataFrame:
    """(key, value) with one JSON object per row; missing values are JSON null.

    ``zero_when_missing`` names numeric columns published as 0 instead, for readers that expect it.
    """
    fields = [
        F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c) if c in zero_when_missing else F.col(c)
        for c, t in df.dtypes
    ]
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def from_message(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Columns of ``schema`` plus the raw text of any message that does not fit it.

    Bad JSON, a badly typed field and an empty message all land in the corrupt column, so none turns into a
    silent row of nulls.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed: Column = F.from_json(
        F.col(value).cast("string"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    text = F.coalesce(F.col(value).cast("string"), F.lit(""))
    unread = F.when(F.col("message").isNull(), F.col("text")).otherwise(F.col(f"message.{CORRUPT}"))
    return df.select(parsed.alias("message"), text.alias("text")).select(
        *(F.col(f"message.{c}") for c in schema.names), unread.alias(CORRUPT)
    )


def good_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("message"))
