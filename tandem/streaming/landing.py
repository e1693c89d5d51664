"""Landing: one streaming query per topic, from messages to a Parquet folder.

Good and malformed messages leave in the same exactly-once sink, in the folders ``malformed=false`` and
``malformed=true``: the topic is read once and nothing is lost between two queries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tandem import catalog
from tandem.functions.messages import CORRUPT, bad_messages, from_message, good_messages

_ACTIVE = "_active"
_KEY = "_protection_key"
#: The setting that names the file with the protection key.
KEY_FILE = "spark.tandem.protection.keyFile"
#: The setting that says how many folders a task may hold open.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def protect(df: DataFrame, columns: Sequence[str], secret: str) -> DataFrame:
    """Keyed hash in place of sensitive values: equal values stay equal, none can be read."""
    hidden = {c: F.sha2(F.concat(F.lit(secret), F.col(c)), 256) for c in columns if c in df.columns}
    return df.select(*(hidden[c].alias(c) if c in hidden else F.col(c) for c in df.columns))


def configured_key_file(spark: SparkSession) -> str:
    """The file that the setting ``KEY_FILE`` names; landing protected tables without one is an error."""
    path = spark.conf.get(KEY_FILE, None)
    if not path:
        raise ValueError(f"set {KEY_FILE} to a file that holds the protection key")
    return path


def _with_key(df: DataFrame, key_file: str) -> DataFrame:
    """The rows with the key of the file beside them. The plan and its logs name the file, never the key.

    The file must hold one line; another number of them is an error of the job that reads it.
    """
    lines = df.sparkSession.read.text(key_file).filter(F.trim("value") != "")
    one = lines.agg(F.count("*").alias("n"), F.max("value").alias("value"))
    fault = F.raise_error(F.lit("the file of the protection key must hold one line"))
    key = one.select(F.when(F.col("n") == 1, F.col("value")).otherwise(fault).alias(_KEY), F.lit(1).alias("_one"))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(key), "_one").drop("_one")


def protect_with_key_file(df: DataFrame, columns: Sequence[str], key_file: str, sealed: Sequence[str] = ()) -> DataFrame:
    """As ``protect``, with a key that is read when the job runs; the hash is nested, so that none can be lengthened.

    Columns in ``sealed`` are encrypted instead (AES-256, GCM, a new start value for each row), for whoever has the key to read
    them again with ``unseal``.
    """
    key = F.col(_KEY)
    changes = {c: F.sha2(F.concat(key, F.sha2(F.concat(key, F.col(c)), 256)), 256) for c in columns if c in df.columns}
    changes |= {c: F.base64(F.aes_encrypt(F.col(c).cast("binary"), F.unhex(F.sha2(key, 256)))) for c in sealed}
    rows = _with_key(df, key_file)
    return rows.select(*(changes[c].alias(c) if c in changes else F.col(c) for c in df.columns))


def unseal(df: DataFrame, columns: Sequence[str], key_file: str) -> DataFrame:
    """Sealed columns as text again; a value that was sealed with another key, or not at all, is an error."""
    key = F.unhex(F.sha2(F.col(_KEY), 256))
    rows = _with_key(df, key_file)
    read = {c: F.aes_decrypt(F.unbase64(F.col(c)), key).cast("string") for c in columns}
    return rows.select(*(read[c].alias(c) if c in read else F.col(c) for c in df.columns))


def _keep_folders_open(spark: SparkSession) -> None:
    """Let each task write both folders at once; a session without this setting sorts all rows by folder first."""
    if int(spark.conf.get(WRITERS)) < 2:
        spark.conf.set(WRITERS, "8")


def land_topic(
    messages: DataFrame,
    entity: str,
    path: str,
    checkpoint: str,
    every: str | None = "30 seconds",
    secret: str | None = None,
    key_file: str | None = None,
) -> StreamingQuery:
    """Start landing a topic. ``every`` is the trigger interval; None lands what is there and stops.

    The checkpoint and the log of the file sink make a restart continue without loss or repeats. With a
    ``key_file`` the sensitive columns are hashed before they reach the disk, with the key that the file holds, and
    malformed text is sealed, so that the quarantine can still be repaired. A ``secret`` does the same with a key that
    stands in the plan, and withholds malformed text.
    """
    _keep_folders_open(messages.sparkSession)
    rows = from_message(messages, catalog.SCHEMAS[entity])
    if key_file is not None:
        rows = protect_with_key_file(rows, catalog.SENSITIVE_COLUMNS, key_file, sealed=[CORRUPT])
    elif secret is not None:
        rows = protect(rows, [*catalog.SENSITIVE_COLUMNS, CORRUPT], secret)
    rows = rows.withColumn("malformed", F.col(CORRUPT).isNotNull())
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy("malformed")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def _landed(spark: SparkSession, entity: str, path: str) -> DataFrame:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in catalog.SCHEMAS[entity].fields]
    schema = ", ".join([*columns, f"`{CORRUPT}` string", "malformed boolean"])
    return spark.read.schema(schema).parquet(path)


def read_landed(spark: SparkSession, entity: str, path: str) -> DataFrame:
    """Good rows of a landed table; the folder of malformed ones is not read."""
    rows = _landed(spark, entity, path).filter(~F.col("malformed")).drop("malformed")
    return good_messages(rows)


def read_quarantine(spark: SparkSession, entity: str, path: str, key_file: str | None = None) -> DataFrame:
    """Malformed messages, as received; those that were sealed need the file with the key."""
    messages = bad_messages(_landed(spark, entity, path).filter(F.col("malformed")))
    return messages if key_file is None else unseal(messages, ["message"], key_file)


def replay(
    messages: DataFrame, entity: str, root: str, version: int, secret: str | None = None
) -> str:
    """Land a topic again from its beginning under a new version, then switch readers to it.

    The version before stays as it is; its folder and checkpoint can be removed once nobody reads it.
    """
    spark, path = messages.sparkSession, f"{root}/{entity}/v{version}"
    land_topic(messages, entity, path, f"{root}/_checkpoints/{entity}/v{version}", None, secret).awaitTermination()
    switch_to(spark, entity, root, version)
    return path


def switch_to(spark: SparkSession, entity: str, root: str, version: int) -> None:
    """Make a landed version the one that readers see."""
    switch = spark.createDataFrame([(entity, version)], "entity string, version int")
    switch.withColumn("since", F.current_timestamp()).write.mode("append").parquet(f"{root}/{_ACTIVE}")


def active_path(spark: SparkSession, entity: str, root: str) -> str:
    """Folder of the version switched to last, be it an older one."""
    versions = spark.read.parquet(f"{root}/{_ACTIVE}").filter(F.col("entity") == entity)
    return f"{root}/{entity}/v{versions.agg(F.max_by('version', 'since')).first()[0]}"
