"""Protected landing with a key that only a file holds."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tandem import catalog
from tandem.streaming import landing, topics

SECRET = "un secret de test"


@pytest.fixture
def key_file(spark, tmp_path):
    spark.createDataFrame([(SECRET,), ("  ",)], "value string").coalesce(1).write.text(str(tmp_path / "key"))
    return str(tmp_path / "key")


def keyed(value: str) -> str:
    inner = hashlib.sha256((SECRET + value).encode()).hexdigest()
    return hashlib.sha256((SECRET + inner).encode()).hexdigest()


def test_equal_values_stay_equal_and_the_plan_has_no_key(spark, table, key_file):
    df = table("id int, email string, autre string", (1, "a@b.fr", "x"), (2, "a@b.fr", None), (3, None, "y"), (4, "", "z"))
    found = landing.protect_with_key_file(df, ["email", "telephone"], key_file)
    assert rows(found) == [(1, keyed("a@b.fr"), "x"), (2, keyed("a@b.fr"), None), (3, None, "y"), (4, keyed(""), "z")]
    plan = found._jdf.queryExecution().toString()
    assert SECRET not in plan and "key" in plan


def test_sealed_values_come_back_with_the_key_only(spark, table, tmp_path, key_file):
    df = table("id int, texte string", (1, "{cassé"), (2, "{cassé"), (3, None), (4, ""))
    landing.protect_with_key_file(df, [], key_file, sealed=["texte"]).write.parquet(str(tmp_path / "sealed"))
    stored = spark.read.parquet(str(tmp_path / "sealed"))
    texts = [r["texte"] for r in stored.filter("id < 3").collect()]
    assert len(set(texts)) == 2 and not any("cass" in t for t in texts)
    assert rows(landing.unseal(stored, ["texte"], key_file)) == [(1, "{cassé"), (2, "{cassé"), (3, None), (4, "")]
    spark.createDataFrame([("autre",)], "value string").coalesce(1).write.text(str(tmp_path / "other"))
    with pytest.raises(Exception, match="AES|decrypt"):
        landing.unseal(stored, ["texte"], str(tmp_path / "other")).collect()


@pytest.mark.parametrize("lines", [[], ["a", "b"]])
def test_a_key_file_holds_one_line(spark, table, tmp_path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "key"))
    with pytest.raises(Exception, match="must hold one line"):
        landing.protect_with_key_file(table("email string", ("a@b.fr",)), ["email"], str(tmp_path / "key")).collect()


def test_the_setting_names_the_file(spark, key_file):
    with pytest.raises(ValueError, match=landing.KEY_FILE):
        landing.configured_key_file(spark)
    spark.conf.set(landing.KEY_FILE, key_file)
    try:
        assert landing.configured_key_file(spark) == key_file
    finally:
        spark.conf.unset(landing.KEY_FILE)


def test_landing_with_a_key_file(spark, table, tmp_path, key_file):
    good = '{"client_id":"AB-1","email":"a@b.fr","adresse":null}'
    messages = table("key string, value string", ("1", good), ("2", "{cassé"), ("3", None))
    topic, data = str(tmp_path / "topic"), str(tmp_path / "data")
    topics.publish(messages, "parquet", {"path": topic})
    stream = topics.message_stream(spark, "parquet", {"path": topic})
    landing.land_topic(stream, "clients", data, str(tmp_path / "check"), None, key_file=key_file).awaitTermination()
    row = landing.read_landed(spark, "clients", data).select(*catalog.SCHEMAS["clients"].names).first()
    assert (row["client_id"], row["email"], row["adresse"]) == ("AB-1", keyed("a@b.fr"), None)
    assert rows(landing.read_quarantine(spark, "clients", data, key_file)) == [("",), ("{cassé",)]
    raw_text = landing.read_quarantine(spark, "clients", data).filter(F.col("message").contains("cass"))
    assert raw_text.count() == 0
