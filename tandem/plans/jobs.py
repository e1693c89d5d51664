"""The jobs of the pipeline, from delivered files to scored claims, each a function of paths.

    extract -> judge -> clean -> fuse -> publish -> (landing) -> build_dataset -> train_and_score -> key_figures

Every job reads tables, runs operators and writes tables; nothing but counts comes back to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tandem import catalog
from tandem.operators import folds, quality, reconcile, reports, summaries
from tandem.functions.vocab import translate_channels
from tandem.operators.dedup import REPEAT, mark_merged, mark_repeats
from tandem.plans import dataset, fuse, train
from tandem.session import store
from tandem.sources import files, models
from tandem.streaming import topics


def extract(
    spark: SparkSession, name: str, source: str, schema: T.StructType, target: str, journal: str, sep: str = ","
) -> DataFrame:
    """Copy a delivered file to a typed table, rows that do not fit to ``<target>_rejets``; control the counts.

    The file is parsed once, and the lines are counted as they enter.
    """
    entered = Observation(f"extract {name}")
    lines = files.judge_lines(spark, source, schema, sep).observe(entered, F.count(F.lit(1)).alias("n"))
    valid, rejects = files.split_judged(store(lines, "extract-lines"), schema)
    files.write_table(valid, target)
    files.write_table(rejects, f"{target}_rejets")
    control = reconcile.counted_control(name, entered.get["n"], files.read_table(spark, target))
    files.append_journal(control, journal)
    return control


def clean(spark: SparkSession, table: str, source: str, target: str) -> DataFrame:
    """Clean one source table; unique rows and repeats leave in one pass, a folder each (``doublon=...``)."""
    rows = fuse.clean_source(files.read_table(spark, source), table)
    marked = mark_repeats(rows, [fuse.KEYS[table]])
    marked.write.mode("overwrite").partitionBy(REPEAT).parquet(target)
    return spark.read.parquet(target).groupBy(REPEAT).agg(F.count("*").alias("nb"))


def judge(spark: SparkSession, name: str, source: str, valid: str, rejected: str, journal: str) -> None:
    """Apply the written rules of a source table: accepted and corrected rows, rejected rows, one report row.

    ``clean`` goes on from the accepted rows. Repeats of a key are left to it, which keeps them in a folder.
    """
    key, rules = quality.SOURCE_RULES[name]
    rows = files.read_table(spark, source)
    accepted, refused = quality.split_rejected(store(quality.check_rows(rows, rules), "checked"))
    files.write_table(quality.correct_rows(accepted, rules, catalog.PLACEHOLDER).select(rows.columns), valid)
    files.write_table(refused, rejected)
    files.append_journal(quality.quality_report(rows, name, key, rules), journal)


def fuse_sources(spark: SparkSession, table: str, first: str, second: str, target: str, journal: str) -> DataFrame:
    """Map both cleaned source tables to the common model, unite them and control the counts.

    Clients of both companies, known by their address, become one row; the others go to ``<target>_doublons``.
    Claims of the second company get numbers after those of the first, payment channels one set of words.
    """
    sides = [files.read_table(spark, p).filter(~F.col(REPEAT).cast("boolean")).drop(REPEAT) for p in (first, second)]
    to_a, to_b = fuse.MAPPINGS[table]
    united = fuse.union_sources(to_a(sides[0]), to_b(sides[1]))
    if table == "contracts":
        united = fuse.fill_premiums(united)
    if table == "payments":
        united = translate_channels(united)
    if table == "claims":
        united = fuse.offset_claim_numbers(united)
    if table == "clients":
        marked = store(mark_merged(united, "email", ["A", "B"], ["client_id"]), "merged")
        files.write_table(marked.filter(F.col(REPEAT)).drop(REPEAT), f"{target}_doublons")
        united = marked.filter(~F.col(REPEAT)).drop(REPEAT)
    files.write_table(united, target)
    control = reconcile.fusion_control({table: sides[0]}, {table: sides[1]}, {table: files.read_table(spark, target)})
    files.append_journal(control, journal)
    return control


def publish(
    spark: SparkSession,
    entity: str,
    source: str,
    fmt: str,
    options: Mapping[str, str],
    zero_premiums: bool = False,
    journal: str | None = None,
) -> int:
    """Publish a fused table as keyed messages; the number sent. A journal gets the rows attempted, sent and lost."""
    rows = files.read_table(spark, source)
    sent = topics.publish(topics.messages_of(rows, entity, zero_premiums), fmt, options)
    if journal is not None:
        row = reconcile.sent_control(topics.topic_name("assurance", entity), rows.count(), sent)
        files.append_journal(spark.createDataFrame([row], "topic string, tentes long, reussis long, echoues long"), journal)
    return sent


def build_dataset(claims: DataFrame, contracts: DataFrame, payments: DataFrame, target: str) -> DataFrame:
    """Write the claim dataset, both sets in one pass, and count what was written."""
    dataset.write_dataset(dataset.claim_dataset(claims, contracts, payments), target)
    written = claims.sparkSession.read.parquet(target)
    return written.groupBy("note_connue", "est_suspect").agg(F.count("*").alias("nb"))


def train_and_score(spark: SparkSession, source: str, model: str, metrics: str, predictions: str) -> None:
    """Cross-validate, fit on all scored claims, save the model and score the others."""
    rows = spark.read.parquet(source)
    training = folds.class_weights(
        train.model_input(rows.filter("note_connue = 1")).withColumn("label", F.col("est_suspect").cast("double"))
    )
    files.write_table(train.cross_validate(training), metrics)
    models.save_model(train.fit(training), model)
    files.write_table(train.predict(models.load_model(model), rows.filter("note_connue = 0")), predictions)


def key_figures(tables: Mapping[str, DataFrame], predictions: DataFrame, threshold: float = 0.5) -> dict[str, DataFrame]:
    """The tables of the report, by name; each is a plan to write or show."""
    contracts = tables["contrats"]
    return {
        "lignes": summaries.count_tables(tables),
        "contrats_par_statut": summaries.most_frequent_first(
            summaries.count_by(contracts, {"statut_contrat": catalog.EMPTY_LABEL}), ["statut_contrat"]
        ),
        "contrats_par_statut_et_type": summaries.count_by(
            contracts, {"statut_contrat": catalog.EMPTY_LABEL, "type_assurance": catalog.UNKNOWN_LABEL}
        ),
        "montant_total": summaries.total_amount(tables["sinistres"], "montant_estime", "total_sinistres"),
        "signales": reports.flagged_share(predictions, threshold),
        "a_surveiller": reports.to_watch(predictions, threshold),
    }


def export(tables: Mapping[str, DataFrame], path: str, also: Sequence[str] = ()) -> None:
    """Publish reduced copies of the tables, and spreadsheet files of the tables named in ``also``."""
    files.export_tables(tables, {**catalog.PUBLIC_COLUMNS, "predictions_fraude": files.ALL_COLUMNS}, path)
    for name in also:
        files.write_spreadsheet(tables[name], f"{path}/{name}_csv")
