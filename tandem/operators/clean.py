"""Cleaning of whole tables, each in one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tandem.functions.amounts import number
from tandem.functions.text import clean_text

Rule = Callable[[Column], Column]


def blank_to_null(df: DataFrame) -> DataFrame:
    """Trim every text column and turn blanks into null; other types stay as they are."""
    return clean_table(
        df, {f.name: clean_text for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    )


def clean_table(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Apply one rule per named column and keep the others, in the same column order."""
    missing = set(rules) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(*(rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in df.columns))


def zero_when_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null becomes 0 in numeric columns. Text columns are refused: filling them would do nothing."""
    text = [c for c, t in df.dtypes if c in columns and t == "string"]
    if text:
        raise ValueError(f"cast to a number first: {text}")
    return df.fillna(0, subset=list(columns))


def features_as_double(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model input: every feature a double, missing or unreadable as 0."""
    return df.select(
        *(
            F.coalesce(number(F.col(c)), F.lit(0.0)).alias(c) if c in features else F.col(c)
            for c in df.columns
        )
    )
