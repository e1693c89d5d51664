"""Delimited files, Parquet tables, journals and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tandem.functions.messages import CORRUPT
from tandem.operators.monitor import parse_status_log
from tandem.operators.reconcile import journal_row
from tandem.operators.reports import only_columns

TIMINGS = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("etape", T.StringType()),
        T.StructField("duree_s", T.DoubleType()),
    ]
)
BYTE_ORDER_MARK = "\ufeff"
#: In place of a list of columns: the table may leave whole.
ALL_COLUMNS = "*"

# Quotes inside a value are doubled, and values keep their outer spaces.
_QUOTING = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


# --- Readers ------------------------------------------------------------------------------------------
def read_text_table(spark: SparkSession, path: str, sep: str = ";", multi_line: bool = False) -> DataFrame:
    """Delimited file with a header, UTF-8, every column text.

    A line ends a row unless ``multi_line`` is set: then quoted values may hold line breaks, and a file is read
    by one task, since no place in it is known to begin a row.
    """
    return spark.read.csv(path, sep=sep, header=True, encoding="UTF-8", multiLine=multi_line, **_QUOTING)


def read_typed_table(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows as text): a bad value never makes a row vanish. ``multi_line`` as for text.

    The header must agree with the schema, name by name, so two swapped columns raise an error instead of
    trading their content. Values are typed by a cast of every column rather than by the file parser, which
    judges a row only by the columns a query uses. Rejected rows name the columns at fault, or carry the raw
    line when the number of fields is wrong.
    """
    return split_judged(judge_lines(spark, path, schema, sep, multi_line), schema)


def judge_lines(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", multi_line: bool = False
) -> DataFrame:
    """Every line as text, with the columns at fault and the raw line if its fields don't fit: one row a line."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*schema.names, CORRUPT]])
    lines = spark.read.csv(
        path, schema=text, sep=sep, header=True, encoding="UTF-8", mode="PERMISSIVE", enforceSchema=False,
        columnNameOfCorruptRecord=CORRUPT, multiLine=multi_line, **_QUOTING,
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    faults = F.array_compact(
        F.array(*(F.when(F.col(c).isNotNull() & value.isNull(), F.lit(c)) for c, value in typed.items()))
    )
    return lines.withColumn("bad_columns", faults)


def split_judged(judged: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows as text) of judged lines."""
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    is_good = F.col(CORRUPT).isNull() & (F.size("bad_columns") == 0)
    valid = judged.filter(is_good).select(*(value.alias(c) for c, value in typed.items()))
    return valid, judged.filter(~is_good)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """Journal of measured durations."""
    return spark.read.csv(path, schema=TIMINGS, header=True)


def read_status_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_status_log(spark.read.text(path))


# --- Writers ------------------------------------------------------------------------------------------
def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _in_one_line(value: Column) -> Column:
    """Each line break as one space, by plain searches: a pattern would be tried at every character."""
    for line_break in ("\r\n", "\r", "\n"):
        value = F.replace(value, F.lit(line_break), F.lit(" "))
    return value


def write_delimited(df: DataFrame, path: str, sep: str = ";", keep_line_breaks: bool = False) -> None:
    """Delimited files with a header and every field quoted, replacing what is there.

    A line break in a value becomes a space, so that every line is a row for any reader; with ``keep_line_breaks`` it
    stays, for readers that know quoted ones.
    """
    if not keep_line_breaks:
        texts = {c for c, kind in df.dtypes if kind == "string"}
        df = df.select(*((_in_one_line(F.col(f"`{c}`")) if c in texts else F.col(f"`{c}`")).alias(c) for c in df.columns))
    df.write.mode("overwrite").csv(path, sep=sep, header=True, quoteAll=True, encoding="UTF-8", **_QUOTING)


def write_spreadsheet(df: DataFrame, path: str) -> None:
    """``;`` files that a spreadsheet opens with the right accents: each starts with a byte order mark."""
    first, *rest = df.columns
    marked = df.select(F.col(f"`{first}`").alias(BYTE_ORDER_MARK + first), *(F.col(f"`{c}`") for c in rest))
    marked.write.mode("overwrite").csv(path, sep=";", header=True, encoding="UTF-8", **_QUOTING)


def append_journal(control: DataFrame, path: str) -> None:
    """Append control rows, stamped with the time of the run."""
    journal_row(control).write.mode("append").parquet(path)


def export_tables(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], path: str, rows_per_file: int = 5_000_000
) -> None:
    """Reduced copies by allow-list; a table leaves whole only if its list is ``ALL_COLUMNS``.

    A table without a list is an error, raised before anything is written, so a misspelt name leaks nothing.
    """
    unknown = sorted(set(tables) - set(columns))
    if unknown:
        raise ValueError(f"no list of columns for {', '.join(unknown)}")
    for name, df in tables.items():
        reduced = df if columns[name] == ALL_COLUMNS else only_columns(df, columns[name])
        reduced.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/{name}")
