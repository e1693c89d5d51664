"""Files, journals and exports; topics and landing on file streams."""

from __future__ import annotations

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from tandem import catalog
from tandem.functions.text import clean_text
from tandem.operators.summaries import count_tables
from tandem.session import shared_folder, store, work_folder
from tandem.sources import files
from tandem.streaming import landing, topics
from tandem.workload.queries import QUERIES

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("nom", T.StringType()), T.StructField("jour", T.DateType()),
])


def put(path, text):
    path.mkdir()
    (path / "f.csv").write_text(text, encoding="utf-8")
    return str(path)


def content(path):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_text_table_with_accents_and_byte_order_mark(spark, tmp_path):
    path = put(tmp_path / "a", '﻿id;nom\n1;Eugène\n2;"a;b ""c"""\n\n')
    df = files.read_text_table(spark, path)
    assert df.dtypes == [("id", "string"), ("nom", "string")]
    assert rows(df) == [("1", "Eugène"), ("2", 'a;b "c"')]


def test_bad_rows_are_kept_as_rejects(spark, tmp_path):
    path = put(tmp_path / "a", "id,nom,jour\n1,A,2024-01-01\nx,B,2024-01-01\n3,C,31/02/2024\n4,,\n5,E\n")
    valid, rejects = files.read_typed_table(spark, path, SCHEMA, sep=",")
    assert [r["id"] for r in valid.orderBy("id").collect()] == [1, 4]
    assert valid.count() == 2 and rejects.count() == 3
    assert {(r["id"], tuple(r["bad_columns"])) for r in rejects.collect()} == {
        ("x", ("id",)), ("3", ("jour",)), ("5", ()),
    }
    assert rejects.select("nom").count() == 3 and valid.select("nom").count() == 2


def test_swapped_header_is_an_error(spark, tmp_path):
    path = put(tmp_path / "a", "id;jour;nom\n1;2024-01-01;A\n")
    with pytest.raises(Exception, match="header"):
        files.read_typed_table(spark, path, SCHEMA)[0].collect()


def test_quoted_file_round_trip(spark, table, tmp_path):
    df = table("a string, b string", ('x;"y"', " é "), ("1", None))
    files.write_delimited(df, str(tmp_path / "o"))
    assert content(tmp_path / "o").startswith('"a";"b"\n')
    assert rows(files.read_text_table(spark, str(tmp_path / "o"))) == rows(df)


def test_spreadsheet_starts_with_a_mark_and_quotes_little(table, tmp_path):
    files.write_spreadsheet(table("a int, `b (%)` string", (1, "é")).coalesce(1), str(tmp_path / "o"))
    assert content(tmp_path / "o") == "﻿a;b (%)\n1;é\n"


def test_journal_grows_by_run(spark, table, tmp_path):
    path = str(tmp_path / "j")
    for _ in range(2):
        files.append_journal(count_tables({"clients": table("i int", (1,))}), path)
    got = spark.read.parquet(path)
    assert got.count() == 2 and got.filter("date_execution is null").count() == 0


def test_timings_and_log_files(spark, tmp_path):
    timings = files.read_timings(spark, put(tmp_path / "t", "date,etape,duree_s\n2026-10-06 14:20:54,Kafka,0.001\n"))
    assert timings.dtypes == [("date", "timestamp"), ("etape", "string"), ("duree_s", "double")]
    assert timings.first()["duree_s"] == 0.001
    log = files.read_status_log(spark, put(tmp_path / "l", "2026-10-06 13:14:04 | OK | Spark | Spark répond\n"))
    assert log.first()["message"] == "Spark répond"


def test_export_leaves_sensitive_columns_out(spark, table, tmp_path):
    clients = table("client_id string, email string, code_postal string", ("1", "a@b.fr", "29617"))
    with pytest.raises(ValueError, match="autre"):
        files.export_tables({"clients": clients, "autre": clients}, catalog.PUBLIC_COLUMNS, str(tmp_path))
    assert not list(tmp_path.iterdir())
    lists = {**catalog.PUBLIC_COLUMNS, "autre": files.ALL_COLUMNS}
    files.export_tables({"clients": clients, "autre": clients}, lists, str(tmp_path))
    assert files.read_table(spark, str(tmp_path / "clients")).columns == ["client_id", "code_postal"]
    assert len(files.read_table(spark, str(tmp_path / "autre")).columns) == 3


def test_store_reads_back_what_it_wrote(spark, table):
    df = table("i int", (1,), (2,))
    assert rows(store(df, "t")) == [(1,), (2,)]
    assert work_folder(spark, "t") != work_folder(spark, "t")


class Unset:
    """A session without a shared folder."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Unset("yarn"))
    local = Unset("local[4]")
    assert shared_folder(local) == shared_folder(local) == local.folder


# --- Streams --------------------------------------------------------------------------------------------
def payment(i, amount="1.5"):
    return (str(i), '{"paiement_id":"%s","contrat_id":"c","montant":%s}' % (i, amount))


@pytest.fixture
def topic(spark, table, tmp_path):
    """send(*messages) puts messages on a topic kept as files; stream() reads it from the beginning."""
    path = str(tmp_path / "topic")

    def send(*messages):
        return topics.publish(table("key string, value string", *messages), "parquet", {"path": path})

    return send, lambda: topics.message_stream(spark, "parquet", {"path": path})


def land(stream, path, entity="paiements", **kw):
    landing.land_topic(stream, entity, f"{path}/data", f"{path}/check", None, **kw).awaitTermination()


def test_publish_observes_the_number_sent(topic):
    assert topic[0](payment(1), payment(2)) == 2


def test_topic_lands_as_a_table_and_bad_messages_in_quarantine(spark, topic, tmp_path):
    send, stream = topic
    send(payment(1), payment(2, ""), payment(3, '"x"'), ("4", ""))
    land(stream(), tmp_path)
    good = landing.read_landed(spark, "paiements", f"{tmp_path}/data")
    assert good.schema == catalog.SCHEMAS["paiements"]
    assert [(r["paiement_id"], r["montant"]) for r in good.collect()] == [("1", 1.5)]
    bad = landing.read_quarantine(spark, "paiements", f"{tmp_path}/data")
    assert rows(bad) == sorted([("",), (payment(2, "")[1],), (payment(3, '"x"')[1],)])


def test_restart_lands_each_message_once(spark, topic, tmp_path):
    send, stream = topic
    send(payment(1), payment(2))
    land(stream(), tmp_path)
    land(stream(), tmp_path)
    send(payment(3))
    land(stream(), tmp_path)
    got = landing.read_landed(spark, "paiements", f"{tmp_path}/data")
    assert sorted(r["paiement_id"] for r in got.collect()) == ["1", "2", "3"]


def test_interval_trigger_keeps_running(spark, topic, tmp_path):
    send, stream = topic
    send(payment(1))
    run = landing.land_topic(stream(), "paiements", f"{tmp_path}/data", f"{tmp_path}/check", "1 second")
    try:
        run.processAllAvailable()
        send(payment(2))
        run.processAllAvailable()
        assert run.isActive
    finally:
        run.stop()
    assert landing.read_landed(spark, "paiements", f"{tmp_path}/data").count() == 2


def test_replay_switches_to_the_new_version(spark, topic, tmp_path):
    send, stream = topic
    send(payment(1))
    first = landing.replay(stream(), "paiements", str(tmp_path), 1)
    send(payment(2))
    second = landing.replay(stream(), "paiements", str(tmp_path), 2)
    assert landing.active_path(spark, "paiements", str(tmp_path)) == second
    assert landing.read_landed(spark, "paiements", first).count() == 1
    assert landing.read_landed(spark, "paiements", second).count() == 2


def test_sensitive_columns_are_hashed_before_landing(spark, topic, tmp_path):
    send, stream = topic
    send(("1", '{"client_id":"1","email":"a@b.fr","nom_prenom":"N"}'), ("2", '{"client_id":"2","email":"a@b.fr"}'),
         ("3", '{"client_id":"3","email":'))
    land(stream(), tmp_path, "clients", secret="cle")
    got = landing.read_landed(spark, "clients", f"{tmp_path}/data").orderBy("client_id").collect()
    assert got[0]["email"] == got[1]["email"] != "a@b.fr" and got[0]["telephone"] is None
    assert got[0]["nom_prenom"] == "N"
    kept = landing.read_quarantine(spark, "clients", f"{tmp_path}/data").first()["message"]
    assert "client_id" not in kept


def test_clients_and_contracts_are_normalised_when_published(table):
    clients = table(", ".join(f"{c} string" for c in catalog.CLIENT_COLUMNS),
                    ("AB-1", *[None] * 3, "+33 4 30 23 51 16", *[None] * 4, " active", "3"))
    got = topics.outgoing(clients, "clients").first()
    assert (got["telephone"], got["statut_client"]) == ("04 30 23 51 16", "ACTIF")
    assert topics.messages_of(clients, "clients").first()["key"] == "AB-1"
    assert topics.topic_name("assurance", "clients", 2) == "assurance.clients.v2"


def test_blank_text_is_null_after_landing(table):
    assert table("a string", ("",)).select(clean_text(F.col("a"))).first()[0] is None


def test_line_breaks_in_values(spark, table, tmp_path):
    df = table("id string, texte string", ("1", "un\r\ndeux"), ("2", 'a "b"\nc;d'), ("3", "e\rf"))
    files.write_delimited(df, str(tmp_path / "plain"))
    assert rows(files.read_text_table(spark, str(tmp_path / "plain"))) == [("1", "un deux"), ("2", 'a "b" c;d'), ("3", "e f")]
    files.write_delimited(df, str(tmp_path / "kept"), keep_line_breaks=True)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("texte", T.StringType())])
    valid, rejects = files.read_typed_table(spark, str(tmp_path / "kept"), schema, multi_line=True)
    assert rows(valid.filter("id < 3")) == [(1, "un\r\ndeux"), (2, 'a "b"\nc;d')] and rejects.count() == 0


def test_readers_can_be_sent_back_to_an_older_version(spark, tmp_path):
    root = str(tmp_path)
    for version in (1, 2, 3):
        landing.switch_to(spark, "clients", root, version)
    assert landing.active_path(spark, "clients", root).endswith("/clients/v3")
    landing.switch_to(spark, "clients", root, 2)
    landing.switch_to(spark, "contrats", root, 9)
    assert landing.active_path(spark, "clients", root).endswith("/clients/v2")


def test_line_breaks_become_spaces_without_a_pattern(spark):
    """Each break is one space, as by the pattern; none is tried at every character of every value."""
    from tandem.sources.files import _in_one_line

    texts = ["a\r\nb", "a\r\r\nb\n", "\n\r", "a\n\nb", "", None, "plain"]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = F.regexp_replace("t", r"\r\n|\r|\n", " ")
    found = table.select(_in_one_line(F.col("t")).alias("new"), pattern.alias("old"))
    assert all(r.new == r.old for r in found.collect())
    assert "regexp" not in table.select(_in_one_line(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_landing_keeps_both_folders_open_in_a_session_without_the_setting(spark, topic, tmp_path):
    """Otherwise each task sorts its rows by folder before it writes them."""
    send, stream = topic
    send(payment(1), payment(2), payment(3, ""))
    before = spark.conf.get(landing.WRITERS)
    try:
        for given, kept in (("0", "8"), ("3", "3")):
            spark.conf.set(landing.WRITERS, given)
            land(stream(), tmp_path / given)
            assert spark.conf.get(landing.WRITERS) == kept
            assert landing.read_landed(spark, "paiements", f"{tmp_path}/{given}/data").count() == 2
    finally:
        spark.conf.set(landing.WRITERS, before)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables not present")
def test_the_topics_of_all_tables_are_landed_side_by_side(spark, monkeypatch):
    met, start = threading.Barrier(4), landing.land_topic

    def land_together(*args, **kw):
        met.wait(120)
        return start(*args, **kw)

    monkeypatch.setattr(landing, "land_topic", land_together)
    got = QUERIES["landed_tables"](spark, "/root/testdata/sf0.001")
    assert {r["table"] for r in got.select("table").distinct().collect()} == {"clients", "contrats", "paiements", "sinistres"}
