"""The registered queries: name -> function of (session, folder of the given tables).

Each runs an operator or a job of the library over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tandem import catalog
from tandem.functions import amounts, dates, text
from tandem.functions.messages import bad_messages, from_message, good_messages
from tandem.functions.vocab import translate_channels, translate_statuses
from tandem.operators import (
    clean, dedup, folds, joins, metrics, monitor, quality, reconcile, reports, summaries, trees,
)
from tandem.plans import dataset, fuse, jobs, prepare, train
from tandem.session import store, work_folder
from tandem.sources import files, models
from tandem.streaming import landing, topics
from tandem.workload.inputs import raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ENTITIES = {"clients": "clients", "contracts": "contrats", "payments": "paiements", "claims": "sinistres"}
SOURCE_TABLES = {
    "AB_CLIENT": "A_clients", "AB_CONTRAT": "A_contracts", "AB_PAIEMENT": "A_payments", "AB_SINISTRE": "A_claims",
    "AP_USERS": "B_clients", "AP_CONTRACTS": "B_contracts", "AP_PAYMENTS": "B_payments", "AP_CLAIMS": "B_claims",
}

#: A small tree with fixed limits, so that compiled scoring can be checked without a fit. The field names
#: are the export format of a tree's nodes.
FIXED_TREE = [
    {"id": 0, "stats": [16.5, 25.25], "gauche": 1, "droite": 4, "variable": 1, "seuil": 250000.0},
    {"id": 1, "stats": [11.0, 9.0], "gauche": 2, "droite": 3, "variable": 0, "seuil": 30000.0},
    {"id": 2, "stats": [8.0, 2.0], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
    {"id": 3, "stats": [3.0, 7.0], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
    {"id": 4, "stats": [5.5, 16.25], "gauche": 5, "droite": 8, "variable": 2, "seuil": 400.5},
    {"id": 5, "stats": [5.5, 16.25], "gauche": 6, "droite": 7, "variable": 4, "seuil": 1.5},
    {"id": 6, "stats": [5.0, 5.0], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
    {"id": 7, "stats": [0.5, 11.25], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
    {"id": 8, "stats": [0.0, 0.0], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def fused(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return fuse.fuse(table, raw(spark, sf, f"A_{table}"), raw(spark, sf, f"B_{table}"))


def landed(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Common-model rows without the source column, as readers of the landed tables see them."""
    return fused(spark, sf, table).drop("source")


def claims_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.claim_dataset(*(landed(spark, sf, t) for t in ("claims", "contracts", "payments")))


def _tagged(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.withColumn(tag, F.lit(name)) for name, df in parts.items()))


# --- Flagship: claim dataset ----------------------------------------------------------------------------
@query
def claim_dataset(spark, sf):
    return claims_dataset(spark, sf)


@query
def linked_claims(spark, sf):
    """Every claim with contract and payment columns and the day count, coherent or not."""
    rows = dataset.claim_features(*(landed(spark, sf, t) for t in ("claims", "contracts", "payments")))
    return rows.select(*catalog.DATASET_COLUMNS, "client_id")


@query
def discarded_claims(spark, sf):
    rows = dataset.claim_features(*(landed(spark, sf, t) for t in ("claims", "contracts", "payments")))
    return dataset.discarded_rows(rows).select("sinistre_id", "contrat_id", "motif")


@query
def training_rows(spark, sf):
    return dataset.training_rows(claims_dataset(spark, sf))


@query
def rows_to_predict(spark, sf):
    return dataset.rows_to_predict(claims_dataset(spark, sf))


@query
def label_counts(spark, sf):
    return dataset.label_counts(dataset.training_rows(claims_dataset(spark, sf)))


@query
def stored_dataset_counts(spark, sf):
    """The dataset written once, split by a folder per set, and counted from there."""
    path = work_folder(spark, "dataset")
    dataset.write_dataset(claims_dataset(spark, sf), path)
    return spark.read.parquet(path).groupBy("note_connue", "est_suspect").agg(F.count("*").alias("nb"))


@query
def payments_of_a_hot_contract(spark, sf):
    """Payments joined to contracts and their counts, with the rows of one contract spread over buckets."""
    payments, contracts = raw(spark, sf, "hot_payments"), raw(spark, sf, "A_contracts")
    rights = [
        contracts.groupBy(F.col("ab_policy_number").alias("contrat_id")).agg(F.max("ab_client_id").alias("client_id")),
        payments.groupBy("contrat_id").agg(F.count("*").alias("nb_paiements")),
    ]
    return joins.attach(payments, rights, "contrat_id", ["paiement_id"], share=0.05, at_least=1, spread=16)


@query
def payment_summary(spark, sf):
    return dataset.payment_summary(landed(spark, sf, "payments"))


# --- Cleaning -------------------------------------------------------------------------------------------
def _lines(df: DataFrame, key: str) -> DataFrame:
    """``cle, ligne``: a row as text, its columns in order, a sign where there is no value."""
    return df.select(
        F.col(key).cast("string").alias("cle"),
        F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns)).alias("ligne"),
    )


@query
def blanks_of_all_tables(spark, sf):
    """Every row of the eight source tables with blank text as null."""
    parts = {t: _lines(clean.blank_to_null(raw(spark, sf, t)), fuse.KEYS[t]) for t in SOURCE_TABLES.values()}
    return _tagged(parts, "table")


@query
def phones_of_both_companies(spark, sf):
    parts = {}
    for table, key, phone in (("A_clients", "ab_client_id", "ab_telephone"), ("B_clients", "ap_user_id", "ap_phone_number")):
        rows = raw(spark, sf, table)
        parts[table] = rows.select(F.col(key).alias("cle"), F.col(phone).alias("recu"), text.normal_phone(F.col(phone)).alias("telephone"))
    return _tagged(parts, "table")


@query
def repeated_rows(spark, sf):
    """The rows of all eight cleaned source tables that repeat a key."""
    parts = {}
    for table in SOURCE_TABLES.values():
        rows = fuse.clean_source(raw(spark, sf, table), table)
        marked = dedup.mark_repeats(rows, [fuse.KEYS[table]])
        parts[table] = _lines(marked.filter(F.col(dedup.REPEAT)).select(*rows.columns), fuse.KEYS[table])
    return _tagged(parts, "table")


@query
def blank_to_null(spark, sf):
    return clean.blank_to_null(raw(spark, sf, "A_clients"))


def _clean_query(table: str) -> Query:
    return lambda spark, sf: fuse.clean_source(raw(spark, sf, table), table)


for _t in fuse.CLEANING:
    QUERIES[f"clean_{_t}"] = _clean_query(_t)


@query
def normal_phones(spark, sf):
    phone = F.col("ab_telephone")
    return raw(spark, sf, "A_clients").select(
        "ab_client_id", "ab_telephone", text.normal_phone(phone).alias("telephone")
    )


@query
def unread_dates(spark, sf):
    """Filled dates that fit none of the known forms, per column."""
    rows = raw(spark, sf, "B_clients")
    return rows.agg(*(
        F.count_if(text.clean_text(F.col(c)).isNotNull() & dates.parse_date(F.col(c)).isNull()).alias(c)
        for c in ("ap_birth_date", "ap_created_at")
    ))


@query
def amounts_from_text(spark, sf):
    return raw(spark, sf, "B_contracts").select(
        "ap_contract_ref", "ap_user_id", amounts.clean_amount(F.col("ap_monthly_premium")).alias("prime_mensuelle")
    )


@query
def odd_amounts(spark, sf):
    """Amounts that are no numbers are counted as such, and large ones take part in the total."""
    amount = amounts.clean_amount(F.col("montant"))
    rows = raw(spark, sf, "odd_amounts").select(amount.alias("montant"))
    return rows.agg(
        F.count("*").alias("nb"), F.count("montant").alias("nb_lus"), F.sum(amounts.money(F.col("montant"))).cast("double").alias("total")
    )


@query
def client_statuses(spark, sf):
    return translate_statuses(landed(spark, sf, "clients")).select("client_id", "nom_prenom", "statut_client")


@query
def contract_statuses(spark, sf):
    return translate_statuses(landed(spark, sf, "contracts")).select("contrat_id", "client_id", "statut_contrat")


@query
def claim_statuses(spark, sf):
    return translate_statuses(landed(spark, sf, "claims")).select("sinistre_id", "contrat_id", "statut_sinistre")


@query
def payment_statuses(spark, sf):
    rows = translate_statuses(landed(spark, sf, "payments"))
    return rows.groupBy("statut_transaction").agg(F.count("*").alias("nb"))


@query
def payment_channels(spark, sf):
    rows = translate_channels(clean.blank_to_null(landed(spark, sf, "payments")))
    return rows.groupBy("mode_paiement").agg(F.count("*").alias("nb"))


@query
def completed_contracts(spark, sf):
    return prepare.complete_contracts(prepare.tidy(landed(spark, sf, "contracts")))


@query
def filled_premiums(spark, sf):
    return fuse.fill_premiums(landed(spark, sf, "contracts")).select(
        "contrat_id", "client_id", "prime_annuelle", "prime_mensuelle"
    )


# --- Fusion ---------------------------------------------------------------------------------------------
def _fused_query(table: str) -> Query:
    return lambda spark, sf: fused(spark, sf, table)


for _t in ENTITIES:
    QUERIES[f"fused_{_t}"] = _fused_query(_t)


@query
def claim_number_offset(spark, sf):
    return fuse.offset_claim_numbers(fused(spark, sf, "claims")).select("source", "sinistre_id", "contrat_id")


# --- Duplicates -----------------------------------------------------------------------------------------
def _split_query(table: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = fuse.clean_source(raw(spark, sf, table), table)
        return dedup.mark_repeats(rows, [fuse.KEYS[table]])

    return run


for _t in fuse.KEYS:
    QUERIES[f"split_{_t}"] = _split_query(_t)


def _unique_query(table: str) -> Query:
    return lambda spark, sf: prepare.tidy_entity(landed(spark, sf, table), ENTITIES[table])


for _t in ENTITIES:
    QUERIES[f"unique_{_t}"] = _unique_query(_t)


@query
def merged_clients(spark, sf):
    """Clients found in both companies by e-mail address: survivors and rows dropped, told apart."""
    return dedup.mark_merged(fused(spark, sf, "clients"), "email", ["A", "B"], ["client_id"])


@query
def merged_companies(spark, sf):
    """Three companies, one of them not in the list: its clients never win over a listed one."""
    return dedup.mark_merged(raw(spark, sf, "three_companies"), "email", ["B", "A"], ["client_id"])


@query
def repeated_claims(spark, sf):
    """The rejects of the duplicate split: every claim of A after the first with its number."""
    rows = fuse.clean_source(raw(spark, sf, "A_claims"), "A_claims")
    return dedup.split_duplicates(rows, [fuse.KEYS["A_claims"]])[1]


@query
def duplicate_counts(spark, sf):
    parts = {
        name: reconcile.duplicate_counts(raw(spark, sf, t), fuse.KEYS[t]) for name, t in SOURCE_TABLES.items()
    }
    return _tagged(parts, "table")


# --- Prepared tables ------------------------------------------------------------------------------------
@query
def prepared_clients(spark, sf):
    return prepare.prepare_clients(landed(spark, sf, "clients"))


@query
def prepared_contracts(spark, sf):
    return prepare.prepare_contracts(landed(spark, sf, "contracts"))


@query
def prepared_payments(spark, sf):
    return prepare.prepare_payments(landed(spark, sf, "payments"))


@query
def prepared_claims(spark, sf):
    return prepare.prepare_claims(landed(spark, sf, "claims"))


# --- Reports --------------------------------------------------------------------------------------------
@query
def table_counts(spark, sf):
    return summaries.count_tables({e: landed(spark, sf, t) for t, e in ENTITIES.items()})


@query
def contracts_by_status(spark, sf):
    rows = prepare.tidy(landed(spark, sf, "contracts"))
    return summaries.most_frequent_first(
        summaries.count_by(rows, {"statut_contrat": catalog.EMPTY_LABEL}), ["statut_contrat"]
    )


@query
def contracts_by_status_and_type(spark, sf):
    rows = prepare.tidy(landed(spark, sf, "contracts"))
    labels = {"statut_contrat": catalog.EMPTY_LABEL, "type_assurance": catalog.UNKNOWN_LABEL}
    return summaries.count_by(rows, labels)


@query
def active_contracts_by_type(spark, sf):
    rows = reports.with_status(
        prepare.tidy(landed(spark, sf, "contracts")), "statut_contrat", "ACTIF", catalog.EMPTY_LABEL
    )
    return summaries.count_by(rows, {"type_assurance": catalog.UNKNOWN_LABEL})


@query
def total_claim_amount(spark, sf):
    return summaries.total_amount(landed(spark, sf, "claims"), "montant_estime", "total_sinistres")


def _preview_query(table: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        columns = catalog.PUBLIC_COLUMNS[ENTITIES[table]]
        return reports.first_rows(reports.only_columns(landed(spark, sf, table), columns), columns)

    return run


for _t in ENTITIES:
    QUERIES[f"preview_{_t}"] = _preview_query(_t)


@query
def public_clients(spark, sf):
    return reports.only_columns(landed(spark, sf, "clients"), catalog.PUBLIC_COLUMNS["clients"])


# --- Risk model -----------------------------------------------------------------------------------------
def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Unscored claims with the probability of the fixed tree."""
    rows = train.model_input(dataset.rows_to_predict(claims_dataset(spark, sf)))
    return trees.add_score(rows, FIXED_TREE, catalog.FEATURES).select(
        "sinistre_id", "contrat_id", *catalog.FEATURES, "proba_fraude", "suspect"
    )


@query
def compiled_scores(spark, sf):
    return scored(spark, sf)


@query
def claims_to_watch(spark, sf):
    return reports.to_watch(scored(spark, sf), 0.5)


@query
def flagged_share(spark, sf):
    return reports.flagged_share(scored(spark, sf), 0.5)


@query
def scores_in_percent(spark, sf):
    return reports.as_percent(scored(spark, sf).select("sinistre_id", "contrat_id", "proba_fraude"))


@query
def what_if_scores(spark, sf):
    """Every claim rescored with half and with twice its amount."""
    factors = F.explode(F.array(F.lit(0.5), F.lit(2.0)))
    rows = train.model_input(claims_dataset(spark, sf)).withColumn("facteur", factors)
    changed = rows.withColumn("montant_estime", F.col("montant_estime") * F.col("facteur"))
    return trees.add_score(changed, FIXED_TREE, catalog.FEATURES).select(
        "sinistre_id", "contrat_id", "facteur", "montant_estime", "proba_fraude", "suspect"
    )


@query
def what_if_scenarios(spark, sf):
    """Claims rescored under the scenarios of a table, each of which gives some of the features."""
    rows = train.model_input(claims_dataset(spark, sf))
    changed = trees.apply_scenarios(rows, raw(spark, sf, "scenarios"), ["sinistre_id", "contrat_id"], catalog.FEATURES)
    return trees.add_score(changed, FIXED_TREE, catalog.FEATURES).select(
        "sinistre_id", "contrat_id", "scenario", "montant_estime", "prime_annuelle", "proba_fraude", "suspect"
    )


@query
def rows_per_fixed_rule(spark, sf):
    """Unscored claims that meet each rule; every claim meets one."""
    rows = train.model_input(dataset.rows_to_predict(claims_dataset(spark, sf)))
    met = [F.when(F.expr(rule), F.lit(i)) for i, rule, _ in trees.leaf_rules(FIXED_TREE, catalog.FEATURES)]
    return rows.select(F.explode(F.array_compact(F.array(*met))).alias("id")).groupBy("id").agg(F.count("*").alias("nb"))


@query
def cross_validation_rows(spark, sf):
    """What holds for any cross-validation: all rows and suspects are counted once, shares lie between 0 and 1."""
    shares = F.col("precision_suspects").between(0, 1) & F.col("rappel_suspects").between(0, 1)
    return train.cross_validate(training_table(stored_dataset(spark, sf))).select("nb_lignes", "nb_suspects", shares.alias("parts_en_bornes"))


@query
def model_checks(spark, sf):
    """What holds for any fitted tree, saved and loaded again."""
    claims = stored_dataset(spark, sf)
    fresh, path = train.fit(training_table(claims)), work_folder(spark, "model")
    models.save_model(fresh, path)
    loaded, nodes = models.load_model(path), models.nodes_of(models.read_nodes(spark, path))
    rules = trees.leaf_rules(nodes, catalog.FEATURES)
    met = sum((F.expr(rule).cast("int") for _, rule, _ in rules), F.lit(0))
    shares = [r["importance"] for r in models.importances(loaded, catalog.FEATURES).collect()]
    both = [train.predict(m, dataset.rows_to_predict(claims)) for m in (loaded, fresh)]
    scored = both[0].withColumns({"compilee": trees.tree_score(nodes, catalog.FEATURES), "regles": met})
    proba = F.col("proba_fraude")
    changed = both[0].exceptAll(both[1]).limit(1).count()
    return scored.agg(
        F.count("*").alias("nb_scores"),
        F.bool_and(proba.between(0, 1)).alias("probas_en_bornes"),
        F.bool_and((proba > 0.5) == (F.col("suspect") == 1)).alias("verdicts_justes"),
        F.lit(len(shares)).alias("nb_importances"),
        F.lit(abs(sum(shares) - 1) < 1e-9).alias("importances_somment_a_un"),
        F.lit(len(nodes) == 2 * len(rules) - 1).alias("arbre_binaire"),
        F.bool_and(F.col("regles") == 1).alias("regle_unique"),
        F.bool_and(F.abs(proba - F.col("compilee")) < 1e-6).alias("parite"),
        F.lit(changed == 0).alias("relu_egal"),
    )


@query
def tree_metrics(spark, sf):
    """Precision and recall of the fixed tree on the claims with a known score."""
    rows = train.model_input(dataset.training_rows(claims_dataset(spark, sf)))
    return metrics.precision_recall(
        trees.add_score(rows, FIXED_TREE, catalog.FEATURES), "est_suspect", "suspect"
    )


@query
def class_weights(spark, sf):
    rows = train.with_label_and_weight(dataset.training_rows(claims_dataset(spark, sf)))
    return rows.groupBy("label", "poids").agg(F.count("*").alias("nb"))


@query
def stratified_folds(spark, sf):
    rows = dataset.training_rows(claims_dataset(spark, sf))
    return folds.stratified_folds(rows, ["sinistre_id", "contrat_id"], "est_suspect").select(
        "sinistre_id", "contrat_id", "est_suspect", "pli"
    )


@query
def folds_of_all_claims(spark, sf):
    """Folds of scored and unscored claims alike: those without a label are dealt out too."""
    rows = claims_dataset(spark, sf).withColumn(
        "est_suspect", F.when(F.col("fraud_score").isNotNull(), amounts.suspect_label(F.col("fraud_score")))
    )
    return folds.stratified_folds(rows, ["sinistre_id", "contrat_id"], "est_suspect").select(
        "sinistre_id", "contrat_id", "est_suspect", "pli"
    )


@query
def fold_sizes(spark, sf):
    return folds.fold_sizes(stratified_folds(spark, sf), "est_suspect")


def stored_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The claim dataset as a stored table: weights, training rows and rows to predict each read it."""
    return store(claims_dataset(spark, sf), "dataset")


def training_table(claims: DataFrame) -> DataFrame:
    """Labelled, weighted training rows as a stored table: every fit reads it several times."""
    return store(train.with_label_and_weight(dataset.training_rows(claims)), "training")


def fitted(claims: DataFrame) -> str:
    """Path of a pipeline fitted on all training rows and saved."""
    path = work_folder(claims.sparkSession, "model")
    models.save_model(train.fit(training_table(claims)), path)
    return path


@query
def cross_validation(spark, sf):
    return train.cross_validate(training_table(stored_dataset(spark, sf)))


@query
def model_predictions(spark, sf):
    claims = stored_dataset(spark, sf)
    return train.predict(models.load_model(fitted(claims)), dataset.rows_to_predict(claims))


@query
def feature_importances(spark, sf):
    return models.importances(models.load_model(fitted(stored_dataset(spark, sf))), catalog.FEATURES)


@query
def tree_nodes(spark, sf):
    return models.read_nodes(spark, fitted(stored_dataset(spark, sf)))


@query
def tree_rules(spark, sf):
    nodes = models.nodes_of(models.read_nodes(spark, fitted(stored_dataset(spark, sf))))
    return models.rules_table(spark, nodes, catalog.FEATURES)


@query
def tree_parity(spark, sf):
    """Largest difference between the model's probabilities and those of its compiled expression."""
    claims = stored_dataset(spark, sf)
    path = fitted(claims)
    nodes = models.nodes_of(models.read_nodes(spark, path))
    rows = train.predict(models.load_model(path), dataset.rows_to_predict(claims))
    rows = rows.withColumn("compilee", trees.tree_score(nodes, catalog.FEATURES))
    return metrics.largest_difference(rows, "proba_fraude", "compilee")


# --- Quality --------------------------------------------------------------------------------------------
def _rules_of(name: str) -> tuple[str, list[quality.Rule]]:
    return quality.SOURCE_RULES[name]


@query
def quality_report(spark, sf):
    parts = [
        quality.quality_report(raw(spark, sf, t), name, *_rules_of(name)) for name, t in SOURCE_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def broken_rules(spark, sf):
    parts = {
        name: quality.rule_counts(raw(spark, sf, t), _rules_of(name)[1])
        for name, t in SOURCE_TABLES.items()
    }
    return _tagged(parts, "table")


@query
def rejected_clients(spark, sf):
    checked = quality.check_rows(raw(spark, sf, "A_clients"), _rules_of("AB_CLIENT")[1])
    _, rejected = quality.split_rejected(checked)
    return rejected.select("ab_client_id", F.col(quality.REJECT).alias("motifs"))


@query
def rejected_rows(spark, sf):
    """Rejected rows of all eight source tables, with the rules they break."""
    parts = {}
    for name, table in SOURCE_TABLES.items():
        key, rules = _rules_of(name)
        _, rejected = quality.split_rejected(quality.check_rows(raw(spark, sf, table), rules))
        parts[name] = rejected.select(F.col(key).alias("cle"), F.col(quality.REJECT).alias("motifs"))
    return _tagged(parts, "table")


@query
def corrected_rows(spark, sf):
    """Accepted rows of all eight source tables: corrected values, rules that made corrections, and flags."""
    parts = {}
    for name, table in SOURCE_TABLES.items():
        key, rules = _rules_of(name)
        valid, _ = quality.split_rejected(quality.check_rows(raw(spark, sf, table), rules))
        fixed = quality.correct_rows(valid, rules, catalog.PLACEHOLDER)
        columns = sorted({r.column for r in rules if r.severity == quality.CORRECT})
        parts[name] = fixed.select(
            F.col(key).alias("cle"),
            F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("")) for c in columns)).alias("valeurs"),
            F.col(quality.FLAG).alias("anomalies"),
        )
    return _tagged(parts, "table")


@query
def corrected_clients(spark, sf):
    rules = _rules_of("AB_CLIENT")[1]
    valid, _ = quality.split_rejected(quality.check_rows(raw(spark, sf, "A_clients"), rules))
    return quality.correct_rows(valid, rules, catalog.PLACEHOLDER).select(
        "ab_client_id", "ab_date_naissance", "ab_email", "ab_telephone", "ab_adresse", "ab_date_creation",
        F.col(quality.FLAG).alias("anomalies"),
    )


@query
def incoherent_clients(spark, sf):
    allowed = ["ACTIF", "INACTIF", "SUSPENDU", "ACTIVE", "INACTIVE", "SUSPENDED"]
    return quality.incoherent_rows(landed(spark, sf, "clients"), "statut_client", "date_creation", allowed).select(
        "client_id", "statut_client", "date_creation"
    )


# --- Controls -------------------------------------------------------------------------------------------
CONTRACT_FILE = T.StructType([
    T.StructField("ap_contract_ref", T.StringType()), T.StructField("ap_user_id", T.LongType()),
    T.StructField("ap_product_code", T.StringType()), T.StructField("ap_start_date", T.DateType()),
    T.StructField("ap_end_date", T.TimestampNTZType()), T.StructField("ap_monthly_premium", T.DoubleType()),
    T.StructField("ap_contract_state", T.StringType()), T.StructField("ap_broker_code", T.StringType()),
])


def _contract_file(spark: SparkSession, sf: str) -> str:
    path = work_folder(spark, "contracts-csv")
    files.write_delimited(raw(spark, sf, "B_contracts"), path)
    return path


@query
def typed_file_rows(spark, sf):
    """Contracts written as quoted text and read back by type: the rows that fit."""
    valid, _ = files.read_typed_table(spark, _contract_file(spark, sf), CONTRACT_FILE)
    text_dates = {c: F.col(c).cast("string") for c in ("ap_start_date", "ap_end_date")}
    return valid.withColumns(text_dates)


@query
def typed_file_rejects(spark, sf):
    """The contracts that do not fit the types, and are kept as rejects."""
    _, rejects = files.read_typed_table(spark, _contract_file(spark, sf), CONTRACT_FILE)
    return rejects.select("ap_contract_ref", "ap_user_id", F.array_join("bad_columns", ",").alias("colonnes"))


def _delivered(spark: SparkSession, sf: str, table: str) -> tuple[str, T.StructType]:
    """A source table written as its company delivers it, and the schema of the file."""
    rows, path = raw(spark, sf, table), work_folder(spark, f"{table}-csv")
    files.write_delimited(rows, path)
    return path, catalog.delivered_schema(table, rows.columns)


@query
def typed_lines_of_all_files(spark, sf):
    """Every line of the eight delivered files, read by type: its key, whether it fits, and the columns at fault."""
    parts = {}
    for table in SOURCE_TABLES.values():
        path, schema = _delivered(spark, sf, table)
        valid, rejects = files.read_typed_table(spark, path, schema)
        key = F.col(fuse.KEYS[table]).cast("string").alias("cle")
        parts[table] = valid.select(key, F.lit(True).alias("valide"), F.lit("").alias("colonnes")).union(
            rejects.select(key, F.lit(False), F.array_join(F.array_sort("bad_columns"), ","))
        )
    return _tagged(parts, "table")


@query
def text_lines_of_all_files(spark, sf):
    """The eight delivered files read back as text."""
    parts = {}
    for table in SOURCE_TABLES.values():
        path, _ = _delivered(spark, sf, table)
        parts[table] = _lines(files.read_text_table(spark, path), fuse.KEYS[table])
    return _tagged(parts, "table")


@query
def text_file_rows(spark, sf):
    path = work_folder(spark, "claims-csv")
    files.write_delimited(raw(spark, sf, "A_claims"), path)
    return files.read_text_table(spark, path)


@query
def rows_with_line_breaks(spark, sf):
    """Claims whose text runs over lines, written and read both ways: breaks as spaces, and breaks kept."""
    rows, parts = raw(spark, sf, "long_claims"), {}
    for kept in (False, True):
        path = work_folder(spark, "lines-csv")
        files.write_delimited(rows, path, keep_line_breaks=kept)
        parts["garde" if kept else "espace"] = files.read_text_table(spark, path, multi_line=kept)
    return _tagged(parts, "lecture")


@query
def extraction_control(spark, sf):
    """The extraction job on the delivered files of all eight tables: rows that entered, rows that fit."""
    journal = work_folder(spark, "extract-journal")
    for name, table in SOURCE_TABLES.items():
        rows, path = raw(spark, sf, table), work_folder(spark, "extract")
        files.write_delimited(rows, f"{path}-csv")
        schema = catalog.delivered_schema(table, rows.columns)
        jobs.extract(spark, name, f"{path}-csv", schema, path, journal, ";")
    return spark.read.parquet(journal).drop("date_execution")


def _fused_by_job(spark: SparkSession, sf: str, table: str) -> tuple[str, str]:
    """Folders that the cleaning and fusion jobs wrote: the fused table, and clients that were merged away."""
    root = work_folder(spark, "fusion")
    for side in ("A", "B"):
        name = f"{side}_{table}"
        files.write_table(raw(spark, sf, name), f"{root}/raw/{name}")
        jobs.clean(spark, name, f"{root}/raw/{name}", f"{root}/clean/{name}")
    jobs.fuse_sources(spark, table, f"{root}/clean/A_{table}", f"{root}/clean/B_{table}", f"{root}/{table}", f"{root}/journal")
    return f"{root}/{table}", f"{root}/{table}_doublons"


@query
def clients_fused_by_job(spark, sf):
    """Clients as the jobs leave them: one row for each address known to both companies, the others as duplicates."""
    kept, merged = (files.read_table(spark, p) for p in _fused_by_job(spark, sf, "clients"))
    columns = ["client_id", "email", "source"]
    return kept.select(*columns, F.lit(False).alias("doublon")).union(merged.select(*columns, F.lit(True)))


@query
def claims_fused_by_job(spark, sf):
    """Claims as the jobs leave them: numbers of both companies side by side."""
    return files.read_table(spark, _fused_by_job(spark, sf, "claims")[0]).select("source", "contrat_id", "sinistre_id")


@query
def fusion_control(spark, sf):
    first = {e: raw(spark, sf, f"A_{t}") for t, e in ENTITIES.items()}
    second = {e: raw(spark, sf, f"B_{t}") for t, e in ENTITIES.items()}
    merged = {
        e: dedup.keep_first(fused(spark, sf, t).drop("source"), catalog.DEDUP_KEYS[e]) for t, e in ENTITIES.items()
    }
    return reconcile.fusion_control(first, second, merged)


@query
def publish_control(spark, sf):
    """Messages published per topic, as observed while writing and as found afterwards."""
    attempted, found = {}, {}
    for table, entity in ENTITIES.items():
        path, topic = work_folder(spark, "topic"), topics.topic_name("assurance", entity)
        messages = topics.messages_of(landed(spark, sf, table), entity)
        attempted[topic] = topics.publish(messages, "parquet", {"path": path})
        found[topic] = spark.read.parquet(path)
    return reconcile.publish_control(attempted, found)


@query
def run_journal(spark, sf):
    """Control rows of all four tables, appended by two runs and read back."""
    path = work_folder(spark, "journal")
    tables = {entity: landed(spark, sf, table) for table, entity in ENTITIES.items()}
    for _ in range(2):
        files.append_journal(summaries.count_tables(tables), path)
    return spark.read.parquet(path).filter(F.col("date_execution").isNotNull()).drop("date_execution")


# --- Messages -------------------------------------------------------------------------------------------
def _message_query(table: str) -> Query:
    return lambda spark, sf: topics.messages_of(landed(spark, sf, table), ENTITIES[table])


for _t in ENTITIES:
    QUERIES[f"messages_{_t}"] = _message_query(_t)


@query
def messages_with_zero_premiums(spark, sf):
    return topics.messages_of(landed(spark, sf, "contracts"), "contrats", zero_premiums=True)


@query
def read_messages(spark, sf):
    return good_messages(from_message(raw(spark, sf, "messages"), catalog.SCHEMAS["paiements"]))


@query
def malformed_messages(spark, sf):
    return bad_messages(from_message(raw(spark, sf, "messages"), catalog.SCHEMAS["paiements"]))


@query
def rows_lost_to_nulls(spark, sf):
    """Rows a plain JSON read turns into nulls in every column."""
    rows = raw(spark, sf, "messages")
    plain = rows.select(F.from_json("value", catalog.SCHEMAS["paiements"]).alias("m")).select("m.*")
    return monitor.empty_rows(plain).agg(F.count("*").alias("nb_lignes_vides"))


# --- Streaming ------------------------------------------------------------------------------------------
def _topic(spark: SparkSession, messages: DataFrame) -> str:
    path = work_folder(spark, "topic")
    topics.publish(messages, "parquet", {"path": path})
    return path


def _stream(spark: SparkSession, path: str) -> DataFrame:
    return topics.message_stream(spark, "parquet", {"path": path})


@query
def landed_payments(spark, sf):
    topic, root = _topic(spark, raw(spark, sf, "messages")), work_folder(spark, "landing")
    landing.land_topic(_stream(spark, topic), "paiements", f"{root}/data", f"{root}/check", None).awaitTermination()
    return landing.read_landed(spark, "paiements", f"{root}/data")


@query
def landed_quarantine(spark, sf):
    topic, root = _topic(spark, raw(spark, sf, "messages")), work_folder(spark, "landing")
    landing.land_topic(_stream(spark, topic), "paiements", f"{root}/data", f"{root}/check", None).awaitTermination()
    return landing.read_quarantine(spark, "paiements", f"{root}/data")


@query
def landed_after_restart(spark, sf):
    """Half of the messages, a stop, the other half, a restart: every message landed once."""
    rows, root = raw(spark, sf, "messages"), work_folder(spark, "landing")
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    topic = work_folder(spark, "topic")
    for part in (0, 1):
        topics.publish(rows.filter(half == part), "parquet", {"path": topic})
        landing.land_topic(
            _stream(spark, topic), "paiements", f"{root}/data", f"{root}/check", None
        ).awaitTermination()
    return landing.read_landed(spark, "paiements", f"{root}/data")


@query
def landed_after_replay(spark, sf):
    """A topic landed twice from its beginning, under two versions; readers see the last one."""
    topic, root = _topic(spark, raw(spark, sf, "messages")), work_folder(spark, "landing")
    for version in (1, 2):
        landing.replay(_stream(spark, topic), "paiements", root, version)
    return landing.read_landed(spark, "paiements", landing.active_path(spark, "paiements", root))


@query
def landed_after_switch_back(spark, sf):
    """A topic landed as version 1, again with other channels as version 2, then readers are sent back to version 1."""
    rows, root = raw(spark, sf, "messages"), work_folder(spark, "landing")
    again = rows.withColumn("value", F.replace("value", F.lit('"SUCCESS"'), F.lit('"PENDING"')))
    for version, messages in ((1, rows), (2, again)):
        landing.replay(_stream(spark, _topic(spark, messages)), "paiements", root, version)
    landing.switch_to(spark, "paiements", root, 1)
    return landing.read_landed(spark, "paiements", landing.active_path(spark, "paiements", root))


def _publish_and_land(messages: DataFrame, entity: str) -> str:
    """Folder of an entity's table, landed from a topic of its own."""
    spark = messages.sparkSession
    topic, root = _topic(spark, messages), work_folder(spark, "landing")
    landing.land_topic(_stream(spark, topic), entity, f"{root}/data", f"{root}/check", None).awaitTermination()
    return f"{root}/data"


@query
def landed_tables(spark, sf):
    """The messages of all four entities published, landed and read back."""
    messages = {entity: topics.messages_of(landed(spark, sf, table), entity) for table, entity in ENTITIES.items()}
    # The topics wait for nothing of each other: side by side, the last tasks of one leave no core idle.
    with ThreadPoolExecutor(len(messages)) as pool:
        runs = {e: pool.submit(inheritable_thread_target(spark)(_publish_and_land), m, e) for e, m in messages.items()}
    parts = {}
    for entity, run in runs.items():
        rows = landing.read_landed(spark, entity, run.result())
        amounts_as_cents = {
            f.name: F.round(F.col(f.name) * 100).cast("long") for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)
        }
        parts[entity] = _lines(rows.withColumns(amounts_as_cents), catalog.MESSAGE_KEYS[entity])
    return _tagged(parts, "table")


def _key_file(spark: SparkSession) -> str:
    path = work_folder(spark, "key")
    spark.createDataFrame([("cle de protection",)], "value string").coalesce(1).write.text(path)
    return path


@query
def landed_clients_by_key_file(spark, sf):
    """Clients landed with their sensitive columns hashed by a key that only a file holds."""
    key, root = _key_file(spark), work_folder(spark, "landing")
    topic = _topic(spark, topics.messages_of(landed(spark, sf, "clients"), "clients"))
    landing.land_topic(_stream(spark, topic), "clients", f"{root}/data", f"{root}/check", None, key_file=key).awaitTermination()
    return landing.read_landed(spark, "clients", f"{root}/data")


@query
def unsealed_quarantine(spark, sf):
    """Malformed messages that were sealed on landing and read again with the key."""
    key, root = _key_file(spark), work_folder(spark, "landing")
    topic = _topic(spark, raw(spark, sf, "messages"))
    landing.land_topic(_stream(spark, topic), "paiements", f"{root}/data", f"{root}/check", None, key_file=key).awaitTermination()
    return landing.read_quarantine(spark, "paiements", f"{root}/data", key)


@query
def landed_protected_clients(spark, sf):
    """Clients landed with their sensitive columns hashed."""
    messages = topics.messages_of(landed(spark, sf, "clients"), "clients")
    topic, root = _topic(spark, messages), work_folder(spark, "landing")
    landing.land_topic(
        _stream(spark, topic), "clients", f"{root}/data", f"{root}/check", None, secret="cle"
    ).awaitTermination()
    return landing.read_landed(spark, "clients", f"{root}/data")


# --- Monitoring -----------------------------------------------------------------------------------------
@query
def step_durations(spark, sf):
    return monitor.step_durations(raw(spark, sf, "timings"))


@query
def slow_steps(spark, sf):
    return monitor.slow_steps(raw(spark, sf, "timings"), ["date", "event_id"], factor=1.5, minimum_s=0.5)


@query
def slow_steps_with_gaps(spark, sf):
    """Runs without a duration are no measures."""
    return monitor.slow_steps(raw(spark, sf, "timing_gaps"), ["date", "event_id"], factor=1.5, minimum_s=0.5)


@query
def step_names(spark, sf):
    return monitor.step_names(raw(spark, sf, "timings"))


@query
def step_history(spark, sf):
    return monitor.step_history(raw(spark, sf, "timings"), "purchase", ["date", "event_id"])


@query
def newest_status_lines(spark, sf):
    return monitor.newest_lines(monitor.parse_status_log(raw(spark, sf, "status_lines")), 40, ["message"])


@query
def status_counts(spark, sf):
    return monitor.status_counts(monitor.parse_status_log(raw(spark, sf, "status_lines")))


@query
def status_changes(spark, sf):
    """Lines at which a service's level changes."""
    return monitor.status_changes(monitor.parse_status_log(raw(spark, sf, "status_lines")))


@query
def alert_periods(spark, sf):
    """From when to when each service was in alert."""
    return monitor.alert_periods(monitor.parse_status_log(raw(spark, sf, "status_lines")))


@query
def status_log_file(spark, sf):
    """The status log written as a text file, read back and counted per service."""
    path = work_folder(spark, "log")
    raw(spark, sf, "status_lines").write.text(path)
    return monitor.status_counts(files.read_status_log(spark, path))


@query
def timings_file(spark, sf):
    """The journal of durations written as a file and read back by type."""
    path = work_folder(spark, "timings")
    files.write_delimited(raw(spark, sf, "timings").select("date", "etape", "duree_s"), path, ",")
    return monitor.step_durations(files.read_timings(spark, path))


def _landed_checks(spark: SparkSession, sf: str) -> DataFrame:
    tables = {e: landed(spark, sf, t) for t, e in ENTITIES.items()}
    tables["remboursements"] = landed(spark, sf, "payments").filter(F.col("montant") < 0)
    return monitor.landed_checks(tables)


@query
def landed_checks(spark, sf):
    return _landed_checks(spark, sf)


@query
def failed_checks(spark, sf):
    return monitor.failed_checks(_landed_checks(spark, sf))


# --- Exports --------------------------------------------------------------------------------------------
@query
def exported_clients(spark, sf):
    """Reduced copies of two tables written by allow-list; the client copy read back."""
    path = work_folder(spark, "export")
    tables = {"clients": landed(spark, sf, "clients"), "sinistres": landed(spark, sf, "claims")}
    files.export_tables(tables, catalog.PUBLIC_COLUMNS, path)
    return spark.read.parquet(f"{path}/clients")


@query
def exported_tables(spark, sf):
    """Reduced copies of all four tables written by allow-list and read back."""
    path = work_folder(spark, "export")
    tables = {entity: landed(spark, sf, table) for table, entity in ENTITIES.items()}
    files.export_tables(tables, catalog.PUBLIC_COLUMNS, path)
    parts = {}
    for entity in tables:
        rows = files.read_table(spark, f"{path}/{entity}")
        cents = {f.name: F.round(F.col(f.name) * 100).cast("long") for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)}
        parts[entity] = _lines(rows.withColumns(cents), catalog.MESSAGE_KEYS[entity])
    return _tagged(parts, "table")


@query
def spreadsheet_lines(spark, sf):
    """Lines of the spreadsheet export of the watched claims."""
    path = work_folder(spark, "sheet")
    rows = reports.at_least(scored(spark, sf), "proba_fraude", 0.5).select("sinistre_id", "contrat_id", "proba_fraude")
    files.write_spreadsheet(reports.as_percent(rows), path)
    return spark.read.text(path).filter(~F.col("value").contains("sinistre_id"))
