"""Topics: publish keyed JSON messages and read them as a stream.

The broker format is a matter of ``fmt`` and ``options``. Its connector is not part of a plain PySpark
installation, so here only file formats have been run; the broker path is the same call with
``fmt="kafka"``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tandem import catalog
from tandem.functions.messages import to_message
from tandem.functions.vocab import translate_words
from tandem.functions.text import normal_phone

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def topic_name(domain: str, entity: str, version: int = 1) -> str:
    """``domain.entity.v1``: a new version starts a topic from the beginning."""
    return f"{domain}.{entity}.v{version}"


def outgoing(df: DataFrame, entity: str) -> DataFrame:
    """Common-model rows as they are published: phone and client or contract status in normal form."""
    changes = {}
    if entity == "clients":
        words = catalog.STATUS_WORDS["statut_client"]
        changes = {
            "telephone": normal_phone(F.col("telephone")),
            "statut_client": translate_words(F.col("statut_client"), words, "trimmed"),
        }
    elif entity == "contrats":
        words = catalog.STATUS_WORDS["statut_contrat"]
        changes = {"statut_contrat": translate_words(F.col("statut_contrat"), words, "upper")}
    columns = catalog.SCHEMAS[entity].names
    return df.select(*(changes[c].alias(c) if c in changes else F.col(c) for c in columns))


def messages_of(df: DataFrame, entity: str, zero_premiums: bool = False) -> DataFrame:
    """(key, value) messages of one entity; ``zero_premiums`` publishes a missing premium as 0."""
    zeros = ("prime_annuelle", "prime_mensuelle") if zero_premiums and entity == "contrats" else ()
    return to_message(outgoing(df, entity), catalog.MESSAGE_KEYS[entity], zeros)


def publish(messages: DataFrame, fmt: str = "kafka", options: Mapping[str, str] | None = None) -> int:
    """Write messages to a topic or folder; the number attempted is observed on the way, not counted again."""
    seen = Observation("publish")
    observed = messages.observe(seen, F.count(F.lit(1)).alias("attempted"))
    observed.write.format(fmt).options(**(options or {})).mode("append").save()
    return seen.get["attempted"]


def message_stream(spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of (key, value) text from the beginning of a topic or folder."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    else:
        reader = reader.schema(MESSAGE)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
